import random
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

import tillhouse as th
from tillhouse.operators.ntile import bucket_ends


def scores(spark, values, descending=False, buckets=5):
    df = spark.createDataFrame(list(enumerate(values)), "id bigint, v bigint")
    ranked = th.global_ntile(df, buckets, [th.Measure("v", "score", descending)], "id")
    return {r.id: r.score for r in ranked.collect()}


def test_null_first_ascending_and_last_descending(spark):
    values = [None, 1, 2, 3, 4, 5, 6]
    assert scores(spark, values) == {0: 1, 1: 1, 2: 2, 3: 2, 4: 3, 5: 4, 6: 5}
    assert scores(spark, values, True) == {6: 1, 5: 1, 4: 2, 3: 2, 2: 3, 1: 4, 0: 5}


@pytest.mark.parametrize("n", [0, 1, 3, 5, 7, 50])
def test_small_sizes(spark, n):
    got = scores(spark, list(range(n)))
    small, larger = divmod(n, 5)
    expected = [b for b in range(1, 6) for _ in range(small + (b <= larger))]
    assert [got[i] for i in range(n)] == expected


def test_bucket_ends_spread_the_remainder_first():
    assert bucket_ends(7, 5) == [2, 4, 5, 6]
    assert bucket_ends(3, 5) == [1, 2]
    assert bucket_ends(0, 5) == []
    assert bucket_ends(10, 1) == []


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_matches_the_window_function_with_heavy_ties_and_nulls(spark, staging, seed):
    rng = random.Random(seed)
    rows = [
        (None if i == 5 else i, rng.choice([None, 1, 1, 1, 2, 900]), rng.choice([None, rng.random() * 100]))
        for i in range(rng.randint(200, 400))
    ]
    df = staging.save(
        spark.createDataFrame(rows, "id bigint, few bigint, many double").withColumn(
            "many", F.col("many").cast("decimal(20,4)")
        ),
        "input",
    )
    measures = [th.Measure("few", "a"), th.Measure("few", "b", True), th.Measure("many", "c", True)]
    got = th.global_ntile(df, 5, measures, "id")
    expected = df.withColumns(
        {
            "a": F.ntile(5).over(Window.orderBy(F.asc_nulls_first("few"), "id")),
            "b": F.ntile(5).over(Window.orderBy(F.desc_nulls_last("few"), "id")),
            "c": F.ntile(5).over(Window.orderBy(F.desc_nulls_last("many"), "id")),
        }
    )
    assert got.exceptAll(expected).count() == 0
    assert got.count() == expected.count()


def test_amounts_that_share_a_double_are_ordered_exactly(spark):
    base = Decimal("900719925474099300000.0000")
    amounts = [base + Decimal(i) / 10000 for i in range(40)]
    ids = list(range(40))
    random.Random(5).shuffle(ids)
    df = spark.createDataFrame(list(zip(ids, amounts, strict=True)), "id bigint, v decimal(30,4)")
    for descending in (False, True):
        ranked = th.global_ntile(df, 4, [th.Measure("v", "score", descending)], "id").collect()
        expected = {a: (39 - i if descending else i) // 10 + 1 for i, a in enumerate(amounts)}
        assert {r.v: r.score for r in ranked} == expected


def test_dense_key_follows_the_order_without_gaps(spark, staging):
    df = spark.range(5000).select((F.col("id") * 37 % 5000).alias("id")).repartition(7)
    keyed = th.dense_key(df, ["id"], 100, "key", staging)
    assert keyed.where(F.col("key") != F.col("id") + 100).count() == 0
    assert keyed.count() == 5000


def test_dense_key_on_copies_and_nulls(spark, staging):
    df = spark.createDataFrame([(1,)] * 500 + [(None,)] * 400 + [(2,)], "v int")
    keyed = th.dense_key(df, ["v"], 0, "key", staging).collect()
    assert sorted(r.key for r in keyed) == list(range(901))
    assert max(r.key for r in keyed if r.v is None) == 399


def test_copies_are_spread_over_partitions(spark, staging):
    df = spark.range(20000).select(F.lit(1).alias("v"))
    coalescing = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        keyed = th.dense_key(df, ["v"], 0, "key", staging)
        files = keyed.groupBy(F.input_file_name()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalescing)
    assert len(files) == 4
    assert max(f["count"] for f in files) < 10000


def test_row_number_of_nothing(spark, staging):
    empty = spark.createDataFrame([], "v int")
    numbered = th.global_row_number(empty, ["v"], staging)
    assert numbered.columns == ["v", "row_number"]
    assert numbered.count() == 0


def test_descending_row_number(spark, staging):
    df = spark.range(10)
    numbered = th.global_row_number(df, [F.desc("id")], staging)
    assert {r.id: r.row_number for r in numbered.collect()} == {i: 10 - i for i in range(10)}


def test_nan_is_the_largest_value_and_null_the_smallest(spark):
    nan, inf = float("nan"), float("inf")
    values = [None, -inf, -1.0, 0.0, 2.0, inf, nan]
    df = spark.createDataFrame(list(enumerate(values)), "id int, v double")
    up = th.global_ntile(df, 7, [th.Measure("v", "score")], "id")
    assert [r.score for r in up.orderBy("id").collect()] == [1, 2, 3, 4, 5, 6, 7]
    down = th.global_ntile(df, 7, [th.Measure("v", "score", True)], "id")
    assert [r.score for r in down.orderBy("id").collect()] == [7, 6, 5, 4, 3, 2, 1]


def test_many_buckets(spark):
    df = spark.range(1500).select(F.col("id"), (F.col("id") * 7 % 1500).alias("v"))
    ranked = th.global_ntile(df, 300, [th.Measure("v", "score")], "id")
    assert ranked.where(F.col("score") != F.floor(F.col("v") / 5) + 1).count() == 0


@pytest.mark.parametrize("few", [3, 50, 10**6])
def test_places_are_selected_among_ties_and_missing_ids(spark, staging, monkeypatch, few):
    from tillhouse.operators import selection

    monkeypatch.setattr(selection, "FEW", few)
    rng = random.Random(8)
    rows = [(rng.choice([0.0, 0.0, 0.0, 1.0, rng.random()]), rng.choice([None, 7, i])) for i in range(700)]
    df = staging.save(spark.createDataFrame(rows, "v double, id bigint"), "input")
    key = F.struct("v", "id")
    expected = [(r.v, r.id) for r in df.orderBy("v", F.asc_nulls_first("id")).collect()]
    places = [1, 2, 139, 140, 350, 351, 420, 560, 699, 700]
    got = selection.select_places(df, [key], ["v", "id"], [(0, p) for p in places], 700)
    assert [(r.v, r.id) for r in got] == [expected[p - 1] for p in places]


def test_ids_that_are_no_numbers(spark, staging):
    df = staging.save(spark.createDataFrame([(f"k{i % 40:02}", i % 3) for i in range(40)], "id string, v int"), "input")
    got = {r.id: r.s for r in th.global_ntile(df, 4, [th.Measure("v", "s")], "id").collect()}
    ranked = sorted(got, key=lambda k: (int(k[1:]) % 3, k))
    assert [got[k] for k in ranked] == [b for b in (1, 2, 3, 4) for _ in range(10)]


def test_keys_by_one_column_with_missing_and_repeated_values(spark, staging):
    rng = random.Random(4)
    rows = [(rng.choice([None, 5, 7, i]), f"row {i}") for i in range(60)]
    df = staging.save(spark.createDataFrame(rows, "id bigint, text string"), "input")
    names = spark.createDataFrame([(5, "five"), (8, "eight"), (None, "none")], "id bigint, name string")
    got = th.dense_key_by(df, "id", 100, "key", staging, names).orderBy("key").collect()
    assert [r.key for r in got] == list(range(100, 160))
    assert [r.id for r in got] == sorted((i for i, _ in rows), key=lambda i: (i is not None, i or 0))
    assert sorted((r.id is None, r.id or 0, r.text) for r in got) == sorted((i is None, i or 0, t) for i, t in rows)
    assert {(r.id, r.name) for r in got if r.name} <= {(5, "five"), (8, "eight")}
    assert all(r.name == "five" for r in got if r.id == 5)


@pytest.mark.parametrize("ids", [[], [None, None], [3, 1, 2]])
def test_keys_by_one_column_of_plain_tables(spark, staging, ids):
    df = staging.save(spark.createDataFrame([(i,) for i in ids], "id bigint"), "input")
    got = {r.key: r.id for r in th.dense_key_by(df, "id", 0, "key", staging).collect()}
    assert got == dict(enumerate(sorted(ids, key=lambda i: (i is not None, i or 0))))


def test_a_left_join_keeps_rows_without_a_key(spark, staging):
    left = staging.save(spark.createDataFrame([(1, "a"), (None, "b"), (2, "c"), (1, "d")], "id bigint, l string"), "left")
    right = staging.save(spark.createDataFrame([(1, "x"), (None, "y"), (1, "z")], "id bigint, r string"), "right")
    got = sorted(th.left_join(left, right, "id").collect(), key=lambda r: (r.l, r.r or ""))
    assert [tuple(r) for r in got] == [(1, "a", "x"), (1, "a", "z"), (None, "b", None), (2, "c", None), (1, "d", "x"), (1, "d", "z")]
