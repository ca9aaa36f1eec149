from datetime import datetime
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from crosstally import read_report, write_counted, write_report

SCHEMA = "id bigint, name string, amount decimal(10,2), at timestamp_ntz, ok boolean"
ROWS = [
    (1, 'say "hi", you', Decimal("1.50"), datetime(2025, 8, 26, 10, 30), True),
    (2, "two\nlines", None, None, False),
    (3, None, Decimal("0.00"), datetime(2025, 1, 1, 0, 0, 0, 250000), None),
    (4, "back\\slash", Decimal("-2.00"), datetime(2025, 1, 1), True),
]


@pytest.fixture
def rows(spark):
    return spark.createDataFrame(ROWS, SCHEMA).coalesce(1)


def text_of(path) -> str:
    return "".join(part.read_text() for part in sorted(Path(path).glob("*.csv")))


def test_round_trip(spark, rows, tmp_path):
    path = write_report(rows, str(tmp_path / "report"))
    back = read_report(spark, path, rows.schema)
    assert back.schema == rows.schema
    assert sorted(map(tuple, back.collect())) == ROWS


def test_text_form(rows, tmp_path):
    path = write_report(rows.where("id <> 2"), str(tmp_path / "report"))
    assert text_of(path).splitlines() == [
        "id,name,amount,at,ok",
        '1,"say ""hi"", you",1.50,2025-08-26 10:30:00,True',
        "3,,0.00,2025-01-01 00:00:00.25,",
        "4,back\\slash,-2.00,2025-01-01 00:00:00,True",
    ]


def test_null_and_empty_are_both_nothing(spark, tmp_path):
    rows = spark.createDataFrame([(1, None, "x"), (2, "", "x")], "id int, a string, b string")
    path = write_report(rows.coalesce(1), str(tmp_path / "report"))
    assert text_of(path).splitlines() == ["id,a,b", "1,,x", "2,,x"]


def test_overwrite_replaces_and_append_adds(spark, rows, tmp_path):
    path = str(tmp_path / "report")
    for mode, count in [("append", 4), ("append", 8), ("overwrite", 4), ("append", 8)]:
        write_report(rows, path, mode)
        assert read_report(spark, path, rows.schema).count() == count


def test_append_is_by_name(spark, tmp_path):
    path = str(tmp_path / "report")
    write_report(spark.createDataFrame([(1, "x")], "a int, b string"), path)
    write_report(spark.createDataFrame([("y", 2)], "b string, a int"), path, "append")
    write_report(spark.createDataFrame([(3,)], "a int"), path, "append")
    back = read_report(spark, path, "a int, b string")
    assert sorted(map(tuple, back.collect())) == [(1, "x"), (2, "y"), (3, None)]
    with pytest.raises(ValueError, match="c"):
        write_report(spark.createDataFrame([(4, "z")], "a int, c string"), path, "append")


def test_columns_and_headers(spark, rows, tmp_path):
    path = write_report(
        rows.where("id = 1"),
        str(tmp_path / "report"),
        columns=["ok", "id", "absent"],
        headers=["Ok", "Id", "Absent"],
    )
    assert text_of(path).splitlines() == ["Ok,Id,Absent", "True,1,"]


def test_blank_names_are_dropped(spark, tmp_path):
    rows = spark.createDataFrame([(1, 2, 3, 4)], "a int, b int, c int, d int").toDF(
        "a", " ", "c", ""
    ).coalesce(1)
    path = write_report(rows, str(tmp_path / "report"))
    assert text_of(path).splitlines() == ["a,c", "1,3"]


def test_empty_result_has_a_header(spark, rows, tmp_path):
    path = write_report(rows.where("id > 9"), str(tmp_path / "report"))
    assert text_of(path).splitlines() == ["id,name,amount,at,ok"]
    assert read_report(spark, path, rows.schema).count() == 0
    write_report(rows, path, "append")
    assert read_report(spark, path, rows.schema).count() == 4


def test_names_with_dots(spark, tmp_path):
    rows = spark.createDataFrame([(1, 2)], "a int, b int").toDF("x.y", "z").coalesce(1)
    path = write_report(rows, str(tmp_path / "report"), columns=["z", "x.y"])
    assert text_of(path).splitlines() == ["z,x.y", "2,1"]


def test_a_bad_value_is_an_error(spark, tmp_path):
    path = tmp_path / "report"
    write_report(spark.createDataFrame([(1, "x")], "a int, b string"), str(path))
    (path / "part-more.csv").write_text("a,b\nseven,y\n")
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|seven"):
        read_report(spark, str(path), "a int, b string").collect()


def test_columns_are_read_by_name(spark, tmp_path):
    path = str(tmp_path / "report")
    write_report(spark.createDataFrame([("y", 2, 0.5)], "b string, a int, c double"), path)
    assert read_report(spark, path, "a int, b string").collect() == [(2, "y")]
    with pytest.raises(ValueError, match="no column d"):
        read_report(spark, path, "a int, d string")


def test_only_an_absent_report_counts_as_none(spark, tmp_path):
    rows = spark.createDataFrame([(1,)], "a int")
    write_report(rows, str(tmp_path / "new"), "append")
    (tmp_path / "empty").mkdir()
    write_report(rows, str(tmp_path / "empty"), "append")
    assert read_report(spark, str(tmp_path / "empty"), "a int").count() == 1


# Appends that can be repeated, and rows counted as they are written -----------------------------------


def test_a_run_is_appended_once(spark, rows, tmp_path):
    path = str(tmp_path / "report")
    write_report(rows.limit(1), path)
    first = write_counted(rows, path, "append", run="2025-09-01")
    again = write_counted(rows, path, "append", run="2025-09-01")
    assert (first.rows, again.rows) == (4, 0)
    assert write_counted(rows, path, "append", run="2025-09-02").rows == 4
    assert read_report(spark, path, rows.schema).count() == 9
    write_report(rows, path, "append")
    assert read_report(spark, path, rows.schema).count() == 13
    write_report(rows, path)
    assert read_report(spark, path, rows.schema).count() == 4


def test_a_run_that_fails_before_its_commit_leaves_nothing(spark, rows, tmp_path, monkeypatch):
    path = str(tmp_path / "report")
    write_report(rows, path)
    with monkeypatch.context() as broken:
        broken.setattr("crosstally.sinks.csv_report.move", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            write_report(rows, path, "append", run="b")
    assert (tmp_path / "report" / "_staged-b").is_dir()
    assert read_report(spark, path, rows.schema).count() == 4
    assert write_counted(rows.where("id < 3"), path, "append", run="b").rows == 2
    assert read_report(spark, path, rows.schema).count() == 6
    assert not (tmp_path / "report" / "_staged-b").exists()


def test_a_run_whose_rows_fail_leaves_nothing(spark, rows, tmp_path):
    path = str(tmp_path / "report")
    write_report(rows, path, "append", run="a")
    failing = rows.withColumn("name", F.when(F.col("id") == 4, F.raise_error(F.lit("no"))).otherwise(F.col("name")))
    with pytest.raises(Exception, match="no"):
        write_report(failing, path, "append", run="b")
    assert read_report(spark, path, rows.schema).count() == 4
    assert write_counted(rows, path, "append", run="b").rows == 4


def test_runs_are_appended_by_name_and_to_what_is_there(spark, tmp_path):
    path = str(tmp_path / "report")
    write_report(spark.createDataFrame([(1, "x")], "a int, b string"), path, "append", run="a")
    write_report(spark.createDataFrame([("y", 2)], "b string, a int"), path, "append", run="b")
    back = read_report(spark, path, "a int, b string")
    assert sorted(map(tuple, back.collect())) == [(1, "x"), (2, "y")]
    with pytest.raises(ValueError, match="no column c"):
        write_report(spark.createDataFrame([(4, "z")], "a int, c string"), path, "append", run="c")
    for mode, run in (("overwrite", "d"), ("append", "d/e"), ("append", "")):
        with pytest.raises(ValueError, match="a run is appended"):
            write_report(back, path, mode, run=run)


def test_rows_are_counted_as_they_are_written(spark, tmp_path):
    rows = spark.range(1000, numPartitions=7).selectExpr("id", "IF(id % 10 = 0, NULL, concat('t', id % 3)) AS tenant")
    found = write_counted(rows, str(tmp_path / "report"), columns=["id"], counted=["t0", "t1", "t9"])
    by_tenant = {row.tenant: row["count"] for row in rows.groupBy("tenant").count().collect()}
    assert found.rows == 1000 and found.counts == {"t0": by_tenant["t0"], "t1": by_tenant["t1"], "t9": 0}
    none = write_counted(rows.where("id < 0"), str(tmp_path / "none"), counted=["t0"])
    assert (none.rows, none.counts) == (0, {"t0": 0})
    nothing = write_counted(spark.createDataFrame([], "tenant string"), str(tmp_path / "nothing"), counted=["t0"])
    assert (nothing.rows, nothing.counts) == (0, {"t0": 0})
