"""Benchmark passages in training documents: rare seeds, then local alignment.

Words of the benchmark are numbered; every other word of a document is number 0.
A document's n-grams that the benchmark has too are hits: four words in a row, or
with one between them left open, so that a copy with every third word replaced
has some. How many documents have an n-gram tells how rare it is. Those in few of
the documents are seeds, and of each few neighbouring n-grams of an item the rarest
and those about as rare, so that any run of words copied from an item holds a seed
however common its n-grams are. Documents and items that share a seed are aligned
with Smith-Waterman around it, which scores edited copies.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillhouse.llm.columns import map_batches, row_key, texts, unused
from tillhouse.staging import Staging

# Places of the four words of an n-gram.
SHAPES = ((0, 1, 2, 3), (0, 1, 3, 4), (0, 1, 2, 4), (0, 2, 3, 4))
NEIGHBOURS = 3
RARITY = 4
RARE_SHARE = 0.01
MATCH, MISMATCH, GAP = 2, -1, -1
LEAST_SHARE = 0.5
WORDS = re.compile(rb"[a-z0-9\x80-\xff]+")
# Words of benchmark items that one pass over the documents looks for; beyond it, more passes.
WORDS_PER_PASS = 2_000_000
PAIRS_AT_ONCE = 256


def words(text: str | None) -> list[bytes]:
    return WORDS.findall((text or "").lower().encode())


def shapes_of(n_words: int) -> list[tuple[int, ...]]:
    """The shapes of the n-grams of an item; one of fewer than four words occurs whole."""
    if n_words < len(SHAPES[0]):
        return [tuple(range(n_words))]
    return [shape for shape in SHAPES if shape[-1] < n_words]


def gram_codes(numbers: np.ndarray, shape: tuple[int, ...], base: int) -> np.ndarray:
    """A code for the numbers at the places of a shape from each number on, wrapping around 2^64."""
    length = max(0, len(numbers) - shape[-1])
    codes = np.zeros(length, np.uint64)
    for k in shape:
        codes = codes * np.uint64(base) + numbers[k : k + length].astype(np.uint64)
    return codes.view(np.int64)


def shape_number(shape: tuple[int, ...]) -> int:
    """Tells shapes apart: a bit for each of its places."""
    return sum(1 << k for k in shape)


def _passes(benchmark: DataFrame) -> Iterator[list[tuple[int, list[bytes]]]]:
    """The items in groups of bounded size, streamed through the driver."""
    group, size = [], 0
    for row in benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").toLocalIterator():
        found = words(row.text)
        if found and row.item_id is not None:
            group.append((row.item_id, found))
            size += len(found)
        if size >= WORDS_PER_PASS:
            yield group
            group, size = [], 0
    if group:
        yield group


def align(item: np.ndarray, passages: np.ndarray) -> np.ndarray:
    """The best Smith-Waterman score of one item against each row of `passages`, padded with -1."""
    columns = np.arange(passages.shape[1] + 1, dtype=np.int32)
    above = np.zeros((len(passages), len(columns)), np.int32)
    best = np.zeros(len(passages), np.int32)
    for word in item:
        row = np.zeros_like(above)
        row[:, 1:] = np.maximum(above[:, :-1] + np.where(passages == word, MATCH, MISMATCH), above[:, 1:] + GAP)
        np.maximum(row, 0, out=row)
        # A gap along the row: the best earlier cell less a cost for each step from it.
        row = np.maximum.accumulate(row - GAP * columns, axis=1) + GAP * columns
        np.maximum(best, row.max(axis=1), out=best)
        above = row
    return best


def _hits(docs: DataFrame, items: list[tuple[int, list[bytes]]]) -> DataFrame:
    """Windows of documents around n-grams of the benchmark: their word numbers and where the hits are."""
    vocabulary: dict[bytes, int] = {}
    for _, found in items:
        for word in found:
            vocabulary.setdefault(word, len(vocabulary) + 1)
    base = len(vocabulary) + 1
    codes: dict[tuple[int, ...], set[int]] = defaultdict(set)
    for _, found in items:
        numbers = np.array([vocabulary[w] for w in found])
        for shape in shapes_of(len(found)):
            codes[shape].update(gram_codes(numbers, shape, base).tolist())
    reach = 2 * max(len(found) for _, found in items)
    model = docs.sparkSession.sparkContext.broadcast(
        (vocabulary, {shape: np.array(sorted(found), np.int64) for shape, found in codes.items()}, base, reach)
    )

    def make():
        vocabulary, codes, base, reach = model.value
        number, counter = vocabulary.get, iter(range(1 << 40))
        task = TaskContext.get().partitionId() << 40

        def find(batch: pa.RecordBatch) -> dict:
            out: dict = {name: [] for name in ("window", "doc_id", "id", "digest", "start", "words", "hits")}
            keys = zip(*(batch.column(c).to_pylist() for c in ("doc_id", "id", "digest")), strict=True)
            for (doc_id, key, digest), text in zip(keys, texts(batch), strict=True):
                numbers = np.array([number(w, 0) for w in words(text)], np.int64)
                met = []
                for shape, known in codes.items():
                    grams = gram_codes(numbers, shape, base)
                    inside = np.ones(len(grams), bool)
                    for k in shape:
                        inside &= numbers[k : k + len(grams)] > 0
                    at = np.flatnonzero(inside)
                    near = np.searchsorted(known, grams[at])
                    at = at[known[np.minimum(near, len(known) - 1)] == grams[at]]
                    met += [(int(p), int(grams[p]), shape_number(shape)) for p in at]
                met.sort()
                first = 0
                for k in range(1, len(met) + 1):
                    if k == len(met) or met[k][0] - met[k - 1][0] > 2 * reach:
                        start, end = max(0, met[first][0] - reach), met[k - 1][0] + reach
                        row = (
                            task | next(counter), doc_id, key, digest, start, numbers[start:end],
                            [{"at": p - start, "gram": g, "n": n} for p, g, n in met[first:k]],
                        )
                        for name, value in zip(out, row, strict=True):
                            out[name].append(value)
                        first = k
            return out

        return find

    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").select(
        "doc_id", "text", row_key()["id"].alias("id"), row_key()["digest"].alias("digest")
    )
    found = map_batches(
        keyed,
        make,
        "window long, doc_id long, id long, digest long, start long, words array<int>,"
        " hits array<struct<at:int,gram:long,n:int>>",
    )
    return found, vocabulary, base


def _item_grams(spark, items, vocabulary, base) -> DataFrame:
    rows = []
    for item_id, found in items:
        numbers = np.array([vocabulary[w] for w in found])
        for shape in shapes_of(len(found)):
            codes = enumerate(gram_codes(numbers, shape, base).tolist())
            rows += [(item_id, at, code, shape_number(shape)) for at, code in codes]
    return spark.createDataFrame(rows, "item_id long, place int, gram long, n int")


def _seeds(hits: DataFrame, item_grams: DataFrame, rows: int) -> DataFrame:
    """The n-grams of each item that are rare, or about as rare as the rarest of a run of neighbours they stand in.

    Rare is an n-gram in at most `RARE_SHARE` of the documents, of which there are
    `rows`. So every run of neighbouring n-grams has a seed, and where none of
    them is common, all are seeds.
    """
    spread = hits.select("digest", "id", "gram", "n").distinct().groupBy("gram", "n").agg(F.count("*").alias("documents"))
    ranked = item_grams.join(spread, ["gram", "n"], "left").na.fill(0, ["documents"])
    # An item is a test question: its n-grams are few, so its window stays small.
    item = W.partitionBy("item_id", "n").orderBy("place")
    last = F.max("place").over(W.partitionBy("item_id", "n"))
    full = (F.col("place") + NEIGHBOURS - 1 <= last) | (F.col("place") == 0)
    rarest = F.when(full, F.min("documents").over(item.rowsBetween(0, NEIGHBOURS - 1)))
    bound = F.max("rarest").over(item.rowsBetween(1 - NEIGHBOURS, 0))
    judged = ranked.withColumn("rarest", rarest).withColumn("bound", bound)
    most = F.greatest(RARITY * F.greatest(F.lit(1), "bound"), F.lit(RARE_SHARE * rows))
    return judged.where(F.col("documents") <= most).select("item_id", "n", "place", "gram").distinct()


def _scored(pairs: DataFrame, items: DataFrame) -> DataFrame:
    """Aligns each window with its item, a few hundred pairs of an item at a time."""

    def make():
        def score(batch: pa.RecordBatch) -> dict:
            out = {name: batch.column(name) for name in ("doc_id", "id", "digest", "item_id", "n_words")}
            shapes = defaultdict(list)
            items = batch.column("item").to_pylist()
            passages = [np.array(p, np.int64) for p in batch.column("passage").to_pylist()]
            for k, item in enumerate(items):
                shapes[tuple(item)].append(k)
            best = np.zeros(len(items), np.int64)
            for item, members in shapes.items():
                members.sort(key=lambda k: len(passages[k]))
                for at in range(0, len(members), PAIRS_AT_ONCE):
                    some = members[at : at + PAIRS_AT_ONCE]
                    block = np.full((len(some), len(passages[some[-1]])), -1, np.int64)
                    for row, k in enumerate(some):
                        block[row, : len(passages[k])] = passages[k]
                    best[some] = align(np.array(item), block)
            return out | {"score": pa.array(best)}

        return score

    joined = pairs.join(items, "item_id").select(
        "doc_id", "id", "digest", "item_id", "n_words", "item",
        F.slice("words", F.col("from") + 1, F.col("length")).alias("passage"),
    )
    return map_batches(joined, make, "doc_id long, id long, digest long, item_id long, n_words int, score long")


def contaminated(docs: DataFrame, benchmark: DataFrame, staging: Staging, least_share: float = LEAST_SHARE) -> DataFrame:
    """`doc_id`, `item_id`, `n_words`, `score`, `share` of each document and item that align well enough.

    `share` is the alignment's score as a share of the item's score against
    itself; pairs below `least_share` are left out. Null and empty texts and items
    match nothing. Rows that repeat, in either table, give one pair; a null doc_id
    is kept, a null item_id is not. Of several alignments of a pair, in texts of
    any length, the best counts. Two empty tables give no rows. Other columns are
    not read.
    """
    spark, found, rows = docs.sparkSession, None, docs.count()
    for items in _passes(benchmark):
        raw, vocabulary, base = _hits(docs, items)
        windows = staging.save(raw, "windows")
        hits = windows.select("window", "id", "digest", F.explode("hits").alias("hit")).select("window", "id", "digest", "hit.*")
        seeds = _seeds(hits, _item_grams(spark, items, vocabulary, base), rows)
        listed = [(item_id, len(f), [vocabulary[w] for w in f]) for item_id, f in items]
        table = spark.createDataFrame(listed, "item_id long, n_words int, item array<int>").distinct()
        # Hits on one diagonal, give or take half the item, are the same stretch of the document.
        begin = F.col("at") - F.col("place")
        stretch = F.floor(begin / F.greatest(F.lit(1), F.col("n_words") / 2))
        pairs = (
            hits.join(seeds, ["gram", "n"])
            .join(table.groupBy("item_id").agg(F.max("n_words").alias("n_words")), "item_id")
            .groupBy("window", "item_id", stretch.alias("stretch"))
            .agg(F.min(begin).alias("begin"), F.max("n_words").alias("n_words"))
            .select(
                "window",
                "item_id",
                F.greatest(F.lit(0), F.col("begin") - F.ceil(F.col("n_words") / 2)).cast("int").alias("from"),
                (F.col("n_words") * 3).cast("int").alias("length"),
            )
        )
        placed = windows.select("window", "doc_id", "id", "digest", "words").join(pairs, "window")
        scored = _scored(placed, table)
        found = scored if found is None else found.union(scored)
    if found is None:
        empty = "doc_id long, item_id long, n_words int, score long, share double, id long, digest long"
        return spark.createDataFrame([], empty)
    share = F.col("score") / (F.col("n_words") * MATCH)
    return (
        found.withColumn("share", share)
        .where(F.col("share") >= least_share)
        .groupBy("id", "digest", "item_id")
        .agg(*(F.max(c).alias(c) for c in ("doc_id", "n_words", "score", "share")))
        .select("doc_id", "item_id", "n_words", "score", "share", "id", "digest")
    )


def without_contaminated(docs: DataFrame, benchmark: DataFrame, staging: Staging) -> DataFrame:
    """The rows of `docs` that hold no benchmark item, all columns kept, whatever their names."""
    leaks = contaminated(docs, benchmark, staging).select("id", "digest").distinct()
    key = unused(docs, "key")
    leaks = staging.save(leaks, "leaks").select(F.struct("id", "digest").alias(key))
    return docs.withColumn(key, row_key()).join(leaks, key, "left_anti").select(*docs.columns)
