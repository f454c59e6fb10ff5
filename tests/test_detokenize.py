"""Tokens put together as prose: cases made by hand."""

import time

import pytest
from pyspark.sql import functions as F

from labelweave.functions import detokenize

CASES = [
    ('He said , " I am glad , " and left .', 'He said, "I am glad," and left.'),
    ('" One " " two " " three "', '"One" "two" "three"'),
    ('A lone " quote stays , " so " it does', 'A lone "quote stays," so " it does'),
    ("`` Quoted '' the old way", '"Quoted" the old way'),
    ("They ' really ' mean it", "They 'really' mean it"),
    ("I do n't think she 's here , we 'll see , they 'RE late", "I don't think she's here, we'll see, they'RE late"),
    ("I can not , I wan na", "I cannot, I wanna"),
    ("Wait ... and wait . . . now", "Wait... and wait... now"),
    ("either / or , 1 / 2 , a / , / b", "either/or, 1/2, a /, / b"),
    ("( brackets ) [ of ] { all kinds } , $ 5 and 10 %", "(brackets) [of] {all kinds}, $5 and 10%"),
    ("already fine: it's \"quoted\" (here), and/or there.", "already fine: it's \"quoted\" (here), and/or there."),
    ("  spaces \t here  ", "spaces here"),
    ("", ""),
    (" ", ""),
    (None, None),
    ("“ curly ” …", "“curly”…"),
]


def test_cases(spark):
    df = spark.createDataFrame([(i, a) for i, (a, _) in enumerate(CASES)], "i int, t string")
    got = [r.t for r in df.select("i", detokenize(F.col("t")).alias("t")).orderBy("i").collect()]
    assert got == [b for _, b in CASES]


@pytest.mark.parametrize("text", ['" a " ' * 100_000, "( " * 200_000, '" ' * 200_001, "a / " * 100_000])
def test_long_texts_take_time_in_proportion(spark, text):
    df = spark.createDataFrame([(text,)], "t string")
    start = time.time()
    assert df.select(F.length(detokenize(F.col("t")))).first()[0] < len(text)
    assert time.time() - start < 30
