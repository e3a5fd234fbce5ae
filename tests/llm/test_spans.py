import random
import re
import time

import pytest
from pyspark.sql import functions as F

from tillhouse.llm import spans

PATTERN = "[a-c]+[0-9]"


def texts():
    rng = random.Random(6)
    made = ["", " ", "a1", "a1b2c3", "\U0001f600a1中b2", "x" * 50 + "ab1" + "y" * 50, "\n\na1\n"]
    made += ["".join(rng.choice("aab1 2éx\U0001f600") for _ in range(rng.randint(0, 60))) for _ in range(60)]
    return made + ["".join(rng.choice(["a1", "b2 ", "x", "中中"]) for _ in range(5000))]


def brute(text):
    return [
        (m.start(), m.end(), m.group(), m.group(), text[max(0, m.start() - 5) : m.start()], text[m.end() : m.end() + 3])
        for m in re.finditer(PATTERN, text)
    ]


@pytest.mark.parametrize("block", [4, 256])
def test_matches_with_the_text_around_them(spark, monkeypatch, block):
    monkeypatch.setattr(spans, "BLOCK", block)
    df = spark.createDataFrame([(t,) for t in texts()], "text string")
    got = df.select("text", spans.found(F.col("text"), PATTERN, 0, 5, 3).alias("found")).collect()
    assert len(got) == len(texts())
    for row in got:
        assert [tuple(s) for s in row.found] == brute(row.text)


@pytest.mark.parametrize("block", [3, 256])
def test_running_values(spark, monkeypatch, block):
    monkeypatch.setattr(spans, "BLOCK", block)
    rng = random.Random(1)
    lists = [[rng.randint(0, 9) for _ in range(n)] for n in (0, 1, 2, 3, 4, 6, 7, 9, 10, 700)]
    df = spark.createDataFrame([(x,) for x in lists], "v array<int>")
    got = df.select("v", spans.running(F.col("v"), spans._add).alias("s"), spans.largest_before(F.col("v")).alias("m")).collect()
    for row in got:
        assert row.s == [sum(row.v[:k]) for k in range(len(row.v))]
        assert row.m == [max(row.v[:k], default=0) for k in range(len(row.v))]


def test_spans_without_known_ones_and_cuts(spark):
    rng = random.Random(2)
    pairs = [[(rng.randint(0, 9), rng.randint(10, 12)) for _ in range(n)] for n in (0, 1, 5, 40)]
    kind = "array<struct<start:int,end:int>>"
    df = spark.createDataFrame([(a, b) for a in pairs for b in pairs], f"a {kind}, b {kind}")
    codes = F.transform("b", spans.code)
    for row in df.select("a", "b", spans.without(F.col("a"), codes).alias("got")).collect():
        assert [tuple(s) for s in row.got] == sorted(tuple(s) for s in row.a if s not in row.b)
    text = "".join(rng.choice("aé\U0001f600\n") for _ in range(5000))
    cuts = [sorted((rng.randint(0, 5000), rng.randint(0, 5000))) for _ in range(200)] + [[0, 5000], [5000, 5000]]
    df = spark.createDataFrame([(text, cuts)], "text string, cuts array<array<int>>")
    cut = spans.cut_text(F.col("text"), lambda c: F.transform("cuts", lambda ab: c(ab[0], ab[1])))
    assert df.select(cut.alias("c")).first().c == [text[a:b] for a, b in cuts]


def seconds(df):
    best = []
    for _ in range(2):
        start = time.perf_counter()
        df.write.format("noop").mode("overwrite").save()
        best.append(time.perf_counter() - start)
    return min(best)


def test_time_grows_with_the_matches(spark):
    """Four times the matches of one text take no more than about four times as long."""
    def run(n):
        df = spark.range(1).select(F.repeat(F.lit("word 0123456789abcdef0 "), n).alias("text"))
        return seconds(df.select(spans.found(F.col("text"), "[0-9a-f]{16,}", 0, 24, 3).alias("found")))

    run(1000)
    small, large = run(25_000), run(100_000)
    assert large < 8 * small + 1
