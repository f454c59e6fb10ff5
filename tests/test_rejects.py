"""Rejected rows are kept, told apart and counted in one pass."""

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException

from labelweave.sources import (
    Dialect,
    kept_rows,
    read_delimited,
    read_observed,
    read_split,
    rejected_rows,
    scan_with_rejects,
    write_split,
)

SCHEMA = "id bigint, score double, text string"
LINES = ['1,0.5,"two\nlines"', "2,high,b", "3", "4,1,c,d", "x,2,e", "5,,f", '6,7.0,"say ""hi"""', "y,z,g"]
FINE = [(1, 0.5, "two\nlines"), (5, None, "f"), (6, 7.0, 'say "hi"')]
REASONS = {
    "2,high,b": "score is no double", "3": "number of fields", "4,1,c,d": "number of fields",
    "x,2,e": "id is no bigint", "y,z,g": "id is no bigint",
}


@pytest.fixture
def path(tmp_path):
    (tmp_path / "a.csv").write_text("id,score,text\n" + "\n".join(LINES[:4]) + "\n")
    (tmp_path / "b.csv").write_text("id,score,text\n" + "\n".join(LINES[4:]) + "\n")
    return str(tmp_path)


def test_every_row_is_kept_or_rejected(spark, path):
    scan = scan_with_rejects(spark, path, SCHEMA)
    assert sorted(map(tuple, kept_rows(scan).collect())) == FINE
    assert {r.record: r.reason for r in rejected_rows(scan).collect()} == REASONS
    assert {r.record for r in rejected_rows(scan).collect() if r.file.endswith("b.csv")} == {"x,2,e", "y,z,g"}
    # What a query picks does not decide which rows are rejected.
    assert rejected_rows(scan).select("reason").count() == kept_rows(scan).select("text").count() + 2 == 5
    dropped = read_delimited(spark, path, SCHEMA, bad_rows="drop")
    assert sorted(map(tuple, dropped.collect())) == FINE


@pytest.mark.parametrize("mode", ["drop", "keep"])
def test_counts_are_observed(spark, path, mode):
    rows, seen = read_observed(spark, path, SCHEMA, bad_rows=mode)
    assert len(rows.collect()) == (3 if mode == "drop" else 8)
    assert seen.get == {"n_rows": 8, "n_rejected": 5, "n_wrong_fields": 2}


def test_raising(spark, path, tmp_path):
    rows, _ = read_observed(spark, path, SCHEMA, bad_rows="raise")
    with pytest.raises((PySparkException, Py4JJavaError), match="rejected: "):
        rows.collect()
    fine = tmp_path / "fine"
    fine.mkdir()
    (fine / "a.csv").write_text("id,score,text\n" + LINES[0] + "\n" + LINES[5] + "\n")
    rows, seen = read_observed(spark, str(fine), SCHEMA, bad_rows="raise")
    assert rows.count() == 2 and seen.get["n_rejected"] == 0
    with pytest.raises(ValueError):
        read_observed(spark, path, SCHEMA, bad_rows="null")


def test_one_pass_writes_both(spark, path, tmp_path):
    folder = str(tmp_path / "out")
    tracker, group = spark.sparkContext.statusTracker(), "one-pass"
    scan = scan_with_rejects(spark, path, SCHEMA)
    spark.sparkContext.setJobGroup(group, group)
    counts = write_split(scan, folder)
    assert len(tracker.getJobIdsForGroup(group)) == 1
    assert counts == {"n_rows": 8, "n_rejected": 5, "n_wrong_fields": 2}
    kept, rejected = read_split(spark, folder)
    assert sorted(map(tuple, kept.collect())) == FINE
    assert {r.record: r.reason for r in rejected.collect()} == REASONS


def test_dialects(spark, tmp_path):
    (tmp_path / "a.txt").write_text("1\t`a\tb`\nx\t`c\\`d`\n")
    dialect = Dialect(sep="\t", quote="`", escape="\\", header=False, multi_line=False)
    scan = scan_with_rejects(spark, str(tmp_path), "id int, text string", dialect)
    assert [tuple(r) for r in kept_rows(scan).collect()] == [(1, "a\tb")]
    assert [r.reason for r in rejected_rows(scan).collect()] == ["id is no int"]
