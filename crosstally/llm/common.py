"""What the operators share: reading tables, tables kept between steps, tokenizers in the tasks."""

from __future__ import annotations

import os
import shutil
import tempfile
from collections.abc import Callable, Iterator
from functools import cache
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import crosstally
from crosstally.session import apply_settings, scratch
from crosstally.sources.folders import remove

#: White space between words wherever a contract counts or compares words.
WORDS = r"[^\x20\x09-\x0D]+"


def ready(spark: SparkSession) -> SparkSession:
    """Settings, and this package on the workers, where Python doesn't find it by itself.

    On a cluster it is installed or sent with ``--py-files``; a script that only has it on its own path
    gets it sent along here.
    """
    root = Path(crosstally.__file__).resolve().parents[1]
    found = [Path(p).resolve() for p in ("", *os.environ.get("PYTHONPATH", "").split(os.pathsep))]
    context = spark.sparkContext
    if root not in found and "site-packages" not in root.parts and _sent_to.get("to") != context.applicationId:
        _sent_to["to"] = context.applicationId
        packed = shutil.make_archive(f"{tempfile.mkdtemp()}/crosstally", "zip", root, "crosstally")
        context.addPyFile(packed)
    for key, value in BATCHES.items():
        spark.conf.set(key, value)
    return apply_settings(spark)


#: Rows and bytes that a worker is given in one go. Texts are long; the defaults are for short rows.
BATCHES = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2500",
    "spark.sql.execution.arrow.maxBytesPerBatch": "16m",
    # What a query has shuffled is of no use to another one.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}
_sent_to: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables; only Spark opens the path."""
    return ready(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def kept(rows: DataFrame, name: str) -> DataFrame:
    """``rows`` written to the cluster's shared folder and read again.

    This cuts the lineage: an executor that is lost afterwards costs no recomputation of what came
    before. The folder is removed by :func:`release`, or when the driver's JVM ends.
    """
    path = scratch(rows.sparkSession, name)
    rows.write.parquet(path)
    table = rows.sparkSession.read.schema(rows.schema).parquet(path)
    table.kept_at = path
    return table


def release(*tables: DataFrame | None) -> None:
    """Remove tables that were :func:`kept` and that no plan yet to be run reads."""
    for table in tables:
        if table is not None and hasattr(table, "kept_at"):
            remove(table.sparkSession, table.kept_at)


def tidy(task: Callable) -> Callable:
    """``task`` for ``mapInArrow``, which gives memory back when it is done: workers live on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from task(batches)
        pa.default_memory_pool().release_unused()

    return run


def text_of(column: str = "text") -> F.Column:
    """A text column with NULL as the empty text."""
    return F.coalesce(F.col(column), F.lit(""))


@cache
def tokenizer(path: str):
    """The tokenizer at ``path``, loaded once per worker process and run on one thread."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def sliced(items: list, size: int) -> Iterator[list]:
    for start in range(0, len(items), size):
        yield items[start : start + size]
