"""Chat formatting: a finite-state machine over roles, and text segments from a declarative template.

Everything is an expression over the turns of one conversation, which is one row here: it is one
training example, and its digests need it whole.

Markers begin with ``#`` or ``<``. In texts these and the backslash are written as a backslash and a
letter, so that no text holds a marker, and none is lost: every backslash in the output begins such a
pair.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    """What marks a turn, which roles are learned from, and which role may follow which."""

    before: str = "### "
    after_role: str = ": "
    end: str = "\n</turn>\n"
    labels: dict[str, str] = field(
        default_factory=lambda: {"system": "System", "user": "User", "assistant": "Assistant"}
    )
    learned: tuple[str, ...] = ("assistant",)
    #: state -> role -> next state
    turns: dict[str, dict[str, str]] = field(
        default_factory=lambda: {
            "start": {"system": "told", "user": "asked"},
            "told": {"user": "asked"},
            "asked": {"assistant": "answered"},
            "answered": {"user": "asked"},
        }
    )
    ends: tuple[str, ...] = ("answered",)
    #: Character -> the letter that stands for it behind a backslash. The colon ends an unknown role.
    escapes: dict[str, str] = field(default_factory=lambda: {"\\": "b", "#": "h", "<": "l", ":": "c"})


TEMPLATE = Template()
#: Label of a role that the template doesn't know, in front of the role itself.
OTHER = "="


def escaped(text: Column, template: Template = TEMPLATE, also: str = "") -> Column:
    """``text`` without any character that a marker begins with."""
    chars = [c for c in template.escapes if c != ":"] + list(also)  # the backslash first
    return reduce(lambda t, c: F.replace(t, F.lit(c), F.lit("\\" + template.escapes[c])), chars, text)


def unescaped(text: Column, template: Template = TEMPLATE) -> Column:
    chars = [c for c in template.escapes if c != "\\"] + ["\\"]  # the backslash last
    return reduce(lambda t, c: F.replace(t, F.lit("\\" + template.escapes[c]), F.lit(c)), chars, text)


def format_chats(
    turns: DataFrame,
    template: Template = TEMPLATE,
    *,
    id_column: str = "conv_id",
    turn_column: str = "turn",
    role_column: str = "role",
    text_column: str = "text",
) -> DataFrame:
    """conv_id, n_turns, segments (text, loss), formatted (their texts in one) and valid.

    Turns are ordered by turn (NULL first), then role and text; repeated rows are turns like any
    other. NULL texts and roles are empty. An unknown role gets a marker that holds the role. ``valid``
    says whether the order of roles is one that the machine accepts; other conversations are formatted
    too, and it is for the caller to leave them out. A NULL id is a conversation of its own. Further
    columns are not looked at. An empty table has no conversations.
    """
    turn = F.struct(
        F.col(turn_column).alias("turn"),
        F.coalesce(F.col(role_column), F.lit("")).alias("role"),
        F.coalesce(F.col(text_column), F.lit("")).alias("text"),
    )
    grouped = turns.groupBy(F.col(id_column).alias("conv_id")).agg(F.array_sort(F.collect_list(turn)).alias("_turns"))

    def segments(t: Column) -> Column:
        label = F.concat(F.lit(OTHER), escaped(t["role"], template, also=":"))
        for role, name in template.labels.items():
            label = F.when(t["role"] == role, name).otherwise(label)
        head = F.concat(F.lit(template.before), label, F.lit(template.after_role))
        return F.array(
            F.struct(head.alias("text"), F.lit(False).alias("loss")),
            F.struct(escaped(t["text"], template).alias("text"), t["role"].isin(*template.learned).alias("loss")),
            F.struct(F.lit(template.end).alias("text"), F.lit(False).alias("loss")),
        )

    steps = F.create_map(
        *(
            F.lit(x)
            for state, by_role in template.turns.items()
            for role, then in by_role.items()
            for x in (f"{state} {role}", then)
        )
    )

    def step(state: Column, t: Column) -> Column:
        return F.coalesce(F.try_element_at(steps, F.concat(state, F.lit(" "), t["role"])), F.lit("refused"))

    made = grouped.select(
        "conv_id",
        F.size("_turns").cast("long").alias("n_turns"),
        F.flatten(F.transform("_turns", segments)).alias("segments"),
        F.aggregate("_turns", F.lit("start"), step).isin(*template.ends).alias("valid"),
    )
    return made.withColumn("formatted", F.array_join(F.transform("segments", lambda s: s["text"]), ""))


def read_turns(formatted: Column, template: Template = TEMPLATE) -> Column:
    """The turns (role, text) that :func:`format_chats` wrote."""
    whole = F.split(formatted, "\\Q" + template.end + "\\E", -1)
    chunks = F.slice(whole, 1, F.size(whole) - 1)  # behind the last end there is nothing

    def turn(chunk: Column) -> Column:
        head = F.substring_index(chunk, template.after_role, 1)
        label = F.substr(head, F.lit(len(template.before) + 1))
        role = unescaped(F.substr(label, F.lit(len(OTHER) + 1)), template)
        for known, name in template.labels.items():
            role = F.when(label == name, known).otherwise(role)
        text = F.substr(chunk, F.char_length(head) + len(template.after_role) + 1)
        return F.struct(role.alias("role"), unescaped(text, template).alias("text"))

    return F.transform(chunks, turn)


def learned_text(segments: Column, template: Template = TEMPLATE) -> Column:
    """All text under the loss mask, as it was before it was escaped."""
    under = F.filter(segments, lambda s: s["loss"])
    return F.array_join(F.transform(under, lambda s: unescaped(s["text"], template)), "")


def digests(chats: DataFrame, template: Template = TEMPLATE) -> DataFrame:
    """What the formatted chats hold, read back from them, and whether the machine accepts their turns."""
    read = chats.select(
        "conv_id",
        "valid",
        read_turns(F.col("formatted"), template).alias("_read"),
        learned_text(F.col("segments"), template).alias("_learned"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )
    lines = F.transform("_read", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id",
        F.size("_read").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.char_length("_learned").cast("long").alias("loss_chars"),
        F.sha2("_learned", 256).alias("loss_sha256"),
        "formatted_chars",
        "valid",
    )


#: ``op7`` in SQL: what is read back must be what was put in, and the length follows from the template. The
#: machine accepts what may begin with the system and goes on with questions and their answers.
CHAT_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL
  SELECT CAST(-7 AS BIGINT), t, r, '\### Assistant: </turn> ok' FROM (VALUES (0, 'user'), (1, 'assistant')) v(t, r)
), sized AS (
  SELECT *, length(text) + length(text) - length(replace(replace(replace(text, '\', ''), '#', ''), '<', ''))
         + 4 + length(role) + 2 + 9 AS chars,
         CASE role WHEN 'system' THEN 's' WHEN 'user' THEN 'u' WHEN 'assistant' THEN 'a' ELSE '-' END AS kind
  FROM turns
)
SELECT conv_id, CAST(count(*) AS BIGINT) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(chars) AS BIGINT) AS formatted_chars,
       regexp_full_match(string_agg(kind, '' ORDER BY turn, role, text), 's?(ua)+') AS valid
FROM sized GROUP BY conv_id
"""
