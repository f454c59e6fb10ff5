"""Where another SQL engine and Spark differ, this is what we do."""

import pytest
from pyspark.sql import functions as F

from labelweave.sources.delimited import HEADERS_PER_JOB, _first_lines
from labelweave.functions import (
    map_codes,
    multi_hot,
    normalize_columns,
    null_to,
    pair_votes,
    parse_number,
    row_mean,
    strip_text,
    title_case,
)
from labelweave.operators import (
    append_by_position,
    keep_parseable,
    pivot_any_value,
    pivot_count,
    pivot_flag,
    pivot_presence,
)
from labelweave.sources import (
    Dialect,
    count_malformed,
    read_delimited,
    read_by_header,
    read_header_cast,
    read_headerless,
    read_union_by_name,
    regex_records,
)


def values(df):
    return [tuple(r) for r in df.collect()]


def test_null_label_keeps_its_row_and_adds_no_column(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "zzz")], "k int, l string")
    assert values(pivot_count(df, "l", ["a", "b"]).orderBy("k")) == [(1, 1, 0), (2, 0, 0), (3, 0, 0)]
    assert values(pivot_presence(df, "l", ["a", "b"]).orderBy("k")) == [
        (1, True, None), (2, None, None), (3, None, None),
    ]
    assert values(pivot_flag(df, "l", ["a", "b"]).orderBy("k")) == [
        (1, True, False), (2, False, False), (3, False, False),
    ]


def test_duplicate_rows_collapse_into_the_count(spark):
    df = spark.createDataFrame([("t", "a")] * 3 + [("t", "b")], "text string, l string")
    assert values(pivot_count(df, "l", ["a", "b"])) == [("t", 3, 1)]


def test_any_value_skips_nulls(spark):
    df = spark.createDataFrame([("t", "a", None), ("t", "a", False)], "text string, l string, v boolean")
    assert values(pivot_any_value(df, "l", ["a", "b"], "v")) == [("t", False, None)]


def test_default_has_the_column_type(spark):
    df = spark.createDataFrame([(None,), (2,)], "n bigint")
    assert values(df.select(null_to(F.col("n"), 0))) == [(0,), (2,)]


def test_unknown_code(spark):
    df = spark.createDataFrame([("1",), ("x",), (None,)], "c string")
    assert values(df.select(map_codes(F.col("c"), {"1": "one"}))) == [("one",), (None,), (None,)]
    for bad in ("x", None):
        one = spark.createDataFrame([(bad,)], "c string")
        with pytest.raises(Exception, match="unknown label code"):
            one.select(map_codes(F.col("c"), {"1": "one"}, strict=True)).collect()


def test_multi_hot_strictness(spark):
    table = {"1": "a", "2": "b"}
    df = spark.createDataFrame([(" 1 , 2",), ("2",)], "c string")
    assert values(df.select(*multi_hot(F.col("c"), table))) == [(True, True), (False, True)]
    bad = spark.createDataFrame([("1, 9",)], "c string")
    assert values(bad.select(*multi_hot(F.col("c"), table, strict=False))) == [(True, False)]
    with pytest.raises(Exception, match="unknown label code"):
        bad.select(*multi_hot(F.col("c"), table)).collect()


def test_pair_votes_ignores_a_missing_rater(spark):
    df = spark.createDataFrame([("x", "x"), ("x", None)], "a string, b string")
    assert values(df.select(*pair_votes([F.col("a"), F.col("b")], ["x", "y"]))) == [(2, 0), (1, 0)]


def test_tolerant_scan_counts_the_same_whatever_is_selected(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text("id,x,y\n1,2,3\n2,3\n3,4,5,6\n4,q,1\nz,q,1\n")
    plain = Dialect(multi_line=False)
    for dialect in (plain, Dialect()):
        scan = read_delimited(spark, str(path), "id int, x string, y int", dialect, bad_rows="drop")
        assert values(scan) == [(1, "2", 3), (4, "q", 1)]
        assert scan.count() == 2
        assert values(scan.select("id")) == [(1,), (4,)]
    audit = count_malformed(spark, str(path), "id int, x string, y int", plain)
    assert values(audit) == [("a.csv", 5, 3)]
    with pytest.raises(Exception, match="MALFORMED"):
        read_delimited(spark, str(path), "id int, x string, y int", plain).collect()


def test_quotes_and_line_breaks(spark, tmp_path):
    path = tmp_path / "q.csv"
    path.write_text('id,text\n1,"he said ""hi"", ok"\n2,"two\nlines"\n3,\n4,""\n5,日本\n')
    scan = read_delimited(spark, str(path), "id int, text string")
    assert values(scan.orderBy("id")) == [
        (1, 'he said "hi", ok'), (2, "two\nlines"), (3, None), (4, None), (5, "日本"),
    ]


def test_header_order_is_never_ignored(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a,b\n1,2\n")
    (tmp_path / "b.csv").write_text("b,a\n3,4\n")
    with pytest.raises(Exception, match="header|schema"):
        read_delimited(spark, str(tmp_path), "a int, b int").collect()
    by_name = read_union_by_name(spark, str(tmp_path / "*.csv"))
    assert set(values(by_name.select("a", "b"))) == {("1", "2"), ("4", "3")}


@pytest.mark.parametrize("jobs", [1, 100])
def test_union_by_name_fills_missing_columns(spark, tmp_path, monkeypatch, jobs):
    monkeypatch.setattr("labelweave.sources.delimited.HEADERS_PER_JOB", jobs)
    (tmp_path / "a.csv").write_text("a,b\n1,2\n")
    (tmp_path / "b +ü 100% [1].csv").write_text("a,c\n3,4\n")
    (tmp_path / "empty.csv").write_text("")
    both = read_union_by_name(spark, str(tmp_path / "*.csv"))
    assert set(values(both.select("a", "b", "c"))) == {("1", "2", None), ("3", None, "4")}


def test_headers_are_read_from_the_first_split_only(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a,b\n" + "1,2\n" * 5000)
    (tmp_path / "b.csv").write_text('\ufeffa,"c, d"\r\n' + "3,4\r\n" * 5000, newline="")
    files = [str(tmp_path / name) for name in ("a.csv", "b.csv")]
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    spark.sparkContext.setJobGroup("headers", "headers")
    try:
        assert [line for _, line in _first_lines(spark, files)] == ["a,b", 'a,"c, d"']
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    tracker = spark.sparkContext.statusTracker()
    stages = [s for job in tracker.getJobIdsForGroup("headers") for s in tracker.getJobInfo(job).stageIds]
    # Of several splits, whichever answers first gives the row that a limit takes.
    assert max(tracker.getStageInfo(s).numTasks for s in stages) <= len(files)


def test_header_cast_picks_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text("z,b,a\nx,2.5,7\n")
    assert values(read_header_cast(spark, str(tmp_path), "a int, b double")) == [(7, 2.5)]


def test_dialect_of_backticks_and_backslashes(spark, tmp_path):
    path = tmp_path / "t.tsv"
    path.write_text("1\t`a\tb`\n2\t`c \\` d`\n")
    dialect = Dialect(sep="\t", quote="`", escape="\\")
    assert values(read_headerless(spark, str(path), "id int, t string", dialect)) == [
        (1, "a\tb"), (2, "c ` d"),
    ]


def test_numbers_that_are_none(spark):
    texts = ["1", " 2.5 ", "5d", "1e3", "", "abc", None, "-.5", "1_0"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert values(df.select(parse_number(F.col("t")))) == [
        (1.0,), (2.5,), (None,), (1000.0,), (None,), (None,), (None,), (-0.5,), (None,),
    ]
    rows = spark.createDataFrame([("50", "x"), ("n/a", "y"), ("10", None)], "p string, t string")
    assert values(keep_parseable(rows, ["p"], ["t"])) == [(0.5, "x")]


def test_row_mean_needs_every_rater(spark):
    df = spark.createDataFrame([(1.0, 2.0), (None, 2.0)], "a double, b double")
    assert values(df.select(row_mean([F.col("a"), F.col("b")]))) == [(1.5,), (None,)]


def test_strip_is_not_only_spaces(spark):
    df = spark.createDataFrame([("  \t a b\n ",), ("",)], "t string")
    assert values(df.select(strip_text(F.col("t")))) == [("a b",), ("",)]


def test_names(spark):
    assert title_case("don't CARE") == "Don't CARE"
    df = spark.createDataFrame([(1, 2, 3)], [" A ", "b.c", " "])
    assert normalize_columns(df, {"a": "z"}).columns == ["z", "b.c"]
    with pytest.raises(ValueError, match="collide"):
        normalize_columns(spark.createDataFrame([(1, 2)], ["a", " A"]))


def test_append_by_position_casts(spark):
    a = spark.createDataFrame([("1", "x")], "id string, t string")
    b = spark.createDataFrame([(2, "y")], "k int, u string")
    assert values(append_by_position(a, b)) == [("1", "x"), ("2", "y")]
    with pytest.raises(ValueError):
        append_by_position(a, b.select("k"))


def test_line_that_misses_the_pattern(spark):
    lines = spark.createDataFrame([("<instance id=1>a<",), ("<instance 2",), ("other",)], "value string")
    args = (lines, r"id=(\d+)>(.*)<", ("id", "t"))
    assert values(regex_records(*args, prefix=(2, "instance"))) == [("1", "a")]
    with pytest.raises(Exception, match="does not match"):
        regex_records(*args, prefix=(2, "instance"), strict=True).collect()


def test_headers_of_many_files(spark, tmp_path):
    # More files than one job fetches the headers of; each scan ends at its limit.
    for i in range(HEADERS_PER_JOB + 5):
        (tmp_path / f"{i:03}.csv").write_text("a,b\n1,2\n" if i % 2 else "b,a\n1,2\n")
    frames = read_by_header(spark, str(tmp_path / "*.csv"))
    assert [f.columns for f in frames] == [["a", "b"], ["b", "a"]]
    assert sum(f.count() for f in frames) == HEADERS_PER_JOB + 5
