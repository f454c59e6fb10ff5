"""Line breaks in quotes, over blocks of any size, against Spark's multi-line scan."""

import gzip
import random

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import types as T

from labelweave.sources import Dialect, quoted_records, read_delimited

SCHEMA = "h string, i string, j string"


@pytest.fixture
def blocks(spark):
    """Sets the size of blocks."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.shuffle.partitions")
    before = {n: spark.conf.get(n) for n in names}

    def of(size):
        for name, value in zip(names, (size, 1, 2), strict=True):
            spark.conf.set(name, str(value))

    yield of
    for name, value in before.items():
        spark.conf.set(name, value)


def cell(rng, sep, quote, escape, newline, wild):
    text = "".join(rng.choice(["a", "b", " ", "é", sep, quote, newline, "\r\n"]) for _ in range(rng.randint(0, 9)))
    if wild and rng.random() < 0.2:
        return "".join(c for c in text if c not in f"\r\n{sep}")  # quotes where none should be
    if rng.random() < 0.5 or any(c in text for c in (sep, quote, "\n", "\r")):
        return quote + text.replace(quote, escape + quote) + quote
    return text


@pytest.mark.parametrize("size", [17, 64, 300, 5000])
@pytest.mark.parametrize(
    "sep,quote,escape,newline,wild",
    [(",", '"', '"', "\n", False), ("|", '"', '"', "\r\n", False), ("\t", "`", "\\", "\n", False), (",", '"', '"', "\n", True)],
)
def test_rows_of_a_multi_line_scan(spark, tmp_path, blocks, size, sep, quote, escape, newline, wild):
    rng = random.Random(f"{size}{sep}{newline}{wild}")
    for name in "xyz":
        lines = [sep.join("hij")]
        for _ in range(rng.randint(0, 50)):
            lines.append(sep.join(cell(rng, sep, quote, escape, newline, wild) for _ in range(3)))
            lines += [""] * (rng.random() < 0.1)
        text = newline.join(lines) + newline * (rng.random() < 0.7)
        (tmp_path / f"{name}.csv").write_bytes(text.encode())
    dialect = Dialect(sep=sep, quote=quote, escape=escape, split=True)
    want = read_delimited(
        spark, str(tmp_path), SCHEMA, Dialect(sep=sep, quote=quote, escape=escape), bad_rows="null"
    ).collect()
    blocks(size)
    got = read_delimited(spark, str(tmp_path), SCHEMA, dialect, bad_rows="null").collect()
    assert sorted(map(repr, got)) == sorted(map(repr, want))


def test_one_file_is_read_by_many_tasks(spark, tmp_path, blocks):
    rows = [(i, "line\n" * (i % 7) + '"quoted", ' + "x" * (i % 50)) for i in range(3000)]
    body = "\n".join('{},"{}"'.format(i, t.replace('"', '""')) for i, t in rows)
    (tmp_path / "one.csv").write_text("id,text\n" + body)
    blocks(4000)
    scan = read_delimited(spark, str(tmp_path), "id long, text string", Dialect(split=True))
    assert sorted(map(tuple, scan.collect())) == rows
    # A union: whole records of every block, then those that cross blocks.
    assert scan.rdd.getNumPartitions() > 20
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "SortMergeJoin" not in plan


def test_a_record_longer_than_many_blocks(spark, tmp_path, blocks):
    long = "\n".join(f"line {i}, still inside" for i in range(500))
    (tmp_path / "a.csv").write_text(f'id,text\n1,"{long}"\n2,plain\n3,"two\nlines"')
    (tmp_path / "b.csv").write_text('"id","te\nxt"\n')
    blocks(100)
    got = quoted_records(spark, str(tmp_path / "a.csv")).collect()
    assert sorted(r.record for r in got) == sorted(["id,text", f'1,"{long}"', "2,plain", '3,"two\nlines"'])
    assert [r.record for r in got if r.first] == ["id,text"]
    assert [tuple(r) for r in quoted_records(spark, str(tmp_path / "b.csv")).collect()] == [('"id","te\nxt"', True)]


def test_compressed_and_empty_files(spark, tmp_path, blocks):
    with gzip.open(tmp_path / "a.csv.gz", "wt") as f:
        f.write('id,text\n1,"a\nb"\n' * 1)
    (tmp_path / "b.csv").write_text("id,text\n")
    (tmp_path / "c.csv").write_text("")
    blocks(5)
    got = read_delimited(spark, str(tmp_path), "id long, text string", Dialect(split=True))
    assert [tuple(r) for r in got.collect()] == [(1, "a\nb")]


def test_bad_rows_and_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,text\n1,"a\nb"\nx,c\n3\n4,d,e\n')

    def read(mode, schema="id long, text string"):
        return read_delimited(spark, str(tmp_path), schema, Dialect(split=True), bad_rows=mode)

    assert [tuple(r) for r in read("drop").collect()] == [(1, "a\nb")]
    kept = sorted(map(tuple, read("null").collect()), key=str)
    assert kept == [(1, "a\nb"), (3, None), (4, "d"), (None, "c")]
    with pytest.raises((PySparkException, Py4JJavaError), match="MALFORMED|Malformed"):
        read("raise").collect()
    with pytest.raises((PySparkException, Py4JJavaError), match="header is not"):
        read("drop", "text string, id long").collect()
    assert read("drop").schema == T.StructType.fromDDL("id long, text string")
