"""SimHash near-duplicates: fingerprints linked at a few differing bits.

The comparison is bit-sliced. A block of fingerprints is stored as 64 vertical
bit planes; the distances of one fingerprint to all of the block grow together,
plane by plane, in carry-save counters of a few bit vectors, and a row of the
comparison is abandoned as soon as every lane has passed the radius.

Which fingerprints meet in a block is decided exactly: with the 64 bits cut into
`radius + k` pieces, two fingerprints within the radius agree on at least `k`
pieces, so there is one table for each choice of `k` pieces.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillhouse.llm.columns import LAST_ID, map_batches, row_key, texts, unused
from tillhouse.llm.graphs import components
from tillhouse.staging import Staging

WORDS_PER_SHINGLE = 3
RADIUS = 3
SEED = 42
BLOCK = 1024
ALL_ONES = np.uint64(0xFFFFFFFFFFFFFFFF)


def fingerprint(text: str, shingle: int = WORDS_PER_SHINGLE) -> int:
    """The 64-bit SimHash of a text as an unsigned number; zero if it has no word."""
    words = text.encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(joined, SEED)]
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        digest = xxhash.xxh64_intdigest
        hashes = [
            digest(joined[s:e], SEED)
            for s, e in zip(starts[: 1 - shingle].tolist(), ends[shingle - 1 :].tolist(), strict=True)
        ]
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        rows = np.array(hashes[at : at + (1 << 16)], ">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(rows, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = WORDS_PER_SHINGLE) -> DataFrame:
    """`id`, `digest` of the row key and the fingerprint `fp` (as a signed long) of every row."""

    def make():
        def convert(batch: pa.RecordBatch) -> dict:
            prints = np.array([fingerprint(text, shingle) for text in texts(batch)], np.uint64)
            return {
                "doc_id": batch.column("doc_id"),
                "id": batch.column("id"),
                "digest": batch.column("digest"),
                "fp": pa.array(prints.view(np.int64)),
            }

        return convert

    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").select(
        "doc_id", "text", row_key()["id"].alias("id"), row_key()["digest"].alias("digest")
    )
    return map_batches(keyed, make, "doc_id long, id long, digest long, fp long")


def _pieces(radius: int, agreeing: int) -> list[tuple[int, int]]:
    """First bit and width of each of the `radius + agreeing` pieces."""
    n = radius + agreeing
    cuts = [64 * i // n for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def agreeing_pieces(n_prints: int, radius: int) -> int:
    """The least number of pieces whose bits tell `n_prints` into buckets of about a block."""
    agreeing = 1
    while agreeing < 3 and n_prints / 2 ** (64 * agreeing / (radius + agreeing)) > BLOCK:
        agreeing += 1
    return agreeing


def _tables(fp: Column, radius: int, agreeing: int) -> Column:
    """One struct (`tab`, `piece`) for each table that a fingerprint is entered in."""
    pieces = _pieces(radius, agreeing)
    entries = []
    for number, chosen in enumerate(combinations(pieces, agreeing)):
        mask = sum(((1 << width) - 1) << start for start, width in chosen)
        signed = mask - (1 << 64) if mask >= 1 << 63 else mask
        entries.append(
            F.struct(F.lit(number).alias("tab"), fp.bitwiseAND(F.lit(signed).cast("long")).alias("piece"))
        )
    return F.array(*entries)


def bit_sliced_pairs(prints: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs i < j of a block whose fingerprints differ in at most `radius` bits."""
    n = len(prints)
    lanes = -(-n // 64)
    bits = ((prints[None, :] >> np.arange(64, dtype=np.uint64)[:, None]) & np.uint64(1)).astype(np.uint8)
    padded = np.zeros((64, lanes * 64), np.uint8)
    padded[:, :n] = bits
    planes = np.packbits(padded, axis=1, bitorder="little").view(np.uint64)
    unused = np.ones(lanes * 64, np.uint8)
    unused[:n] = 0
    unused = np.packbits(unused, bitorder="little").view(np.uint64)
    n_counters = max(1, radius.bit_length())
    found_i, found_j = [], []
    for start in range(0, n, 256):
        rows = np.arange(start, min(start + 256, n))
        counters = [np.zeros((len(rows), lanes), np.uint64) for _ in range(n_counters)]
        passed = np.repeat(unused[None, :], len(rows), axis=0)
        for plane in range(64):
            carry = planes[plane][None, :] ^ (np.uint64(0) - bits[plane, rows].astype(np.uint64))[:, None]
            for k in range(n_counters):
                counters[k], carry = counters[k] ^ carry, counters[k] & carry
            passed |= carry
            if plane % 8 == 7:
                alive = (passed != ALL_ONES).any(axis=1)
                if not alive.any():
                    rows = rows[:0]
                    break
                if not alive.all():
                    rows, passed = rows[alive], passed[alive]
                    counters = [c[alive] for c in counters]
        if len(rows):
            left = np.unpackbits((~passed).view(np.uint8), axis=1, bitorder="little")
            i, j = np.nonzero(left)
            i = rows[i]
            keep = i < j
            found_i.append(i[keep])
            found_j.append(j[keep])
    if not found_i:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    i, j = np.concatenate(found_i), np.concatenate(found_j)
    near = np.bitwise_count(prints[i] ^ prints[j]) <= radius
    return i[near], j[near]


def local_roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest index that each of n indexes reaches over the pairs."""
    roots = np.arange(n)
    while True:
        low = np.minimum(roots[i], roots[j])
        new = roots.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = new[new]
        if (new == roots).all():
            return roots
        roots = new


def _links_of_blocks(radius: int):
    """Turns a stream of (`unit`, `fp`), sorted by unit, into the spanning links of each block.

    Small units are packed into one block; comparing across units is harmless,
    since any pair within the radius is a link.
    """

    def link(prints: list[np.ndarray]) -> pa.RecordBatch | None:
        block = np.unique(np.concatenate(prints))
        i, j = bit_sliced_pairs(block.view(np.uint64), radius)
        roots = local_roots(len(block), i, j)
        tied = np.flatnonzero(roots != np.arange(len(block)))
        if len(tied):
            return pa.RecordBatch.from_arrays([pa.array(block[tied]), pa.array(block[roots[tied]])], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size, open_unit = 0, None
        for batch in batches:
            units = batch.column("unit").to_numpy(zero_copy_only=False)
            prints = batch.column("fp").to_numpy(zero_copy_only=False)
            cuts = np.concatenate(([0], np.flatnonzero(units[1:] != units[:-1]) + 1, [len(units)]))
            for start, end in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                if end == start:
                    continue
                if units[start] != open_unit:
                    if size >= BLOCK:
                        if (out := link(held)) is not None:
                            yield out
                        held, size = [], 0
                    open_unit = units[start]
                held.append(prints[start:end])
                size += end - start
        if held and (out := link(held)) is not None:
            yield out

    return run


def links(classes: DataFrame, radius: int, agreeing: int) -> DataFrame:
    """A spanning set (`a`, `b`) of the links between the distinct fingerprints `fp`.

    A bucket of more than a block's rows is dealt into sub-blocks, and each pair
    of sub-blocks is a unit of its own, so no bucket has to fit in one task.
    """
    entries = classes.select("fp", F.explode(_tables(F.col("fp"), radius, agreeing)).alias("at")).select("fp", "at.*")
    sizes = entries.groupBy("tab", "piece").agg(F.count("*").alias("size")).where("size > 1")
    n_sub = F.ceil(F.col("size") / BLOCK)
    units = (
        entries.join(sizes, ["tab", "piece"])
        .select(
            "tab", "piece", "fp", n_sub.alias("n"), F.pmod(F.xxhash64("fp"), n_sub).alias("own")
        )
        .select("tab", "piece", "fp", "own", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("other"))
        .select(
            "fp",
            F.xxhash64("tab", "piece", F.least("own", "other"), F.greatest("own", "other")).alias("unit"),
        )
    )
    dealt = units.repartition("unit").sortWithinPartitions("unit")
    return dealt.mapInArrow(_links_of_blocks(radius), "a long, b long")


def simhash_groups(
    docs: DataFrame, staging: Staging, shingle: int = WORDS_PER_SHINGLE, radius: int = RADIUS
) -> DataFrame:
    """One row per row of `docs`: `doc_id`, `fingerprint`, `component_id`, `kept`.

    `component_id` is the smallest doc_id reachable over links of at most `radius`
    bits; `kept` marks one row of each group, that with the smallest (doc_id, text
    hash), a null doc_id last. Null and wordless texts have fingerprint zero and
    link like any other. Exactly repeated rows are all kept or all dropped; see
    `keep_one`. Ties cannot arise, as a bit needs more than half the hashes. Texts
    count whole, however long. Columns but `doc_id` and `text` are not read. An
    empty table gives no rows.
    """
    prints = staging.save(fingerprints(docs, shingle), "prints")
    classes = staging.save(
        prints.groupBy("fp").agg(F.min(F.struct("id", "digest")).alias("first"), F.min("doc_id").alias("least")), "classes"
    )
    agreeing = agreeing_pieces(classes.count(), radius)
    found = components(staging.save(links(classes, radius, agreeing), "links"), staging)
    member = classes.join(found, classes["fp"] == found["node"], "left").select(
        "fp", "first", "least", F.coalesce("component", "fp").alias("component")
    )
    member = staging.save(member, "members")
    heads = member.groupBy("component").agg(F.min("least").alias("component_id"), F.min("first").alias("head"))
    by_print = member.join(heads, "component").select("fp", "component_id", "head")
    return prints.join(by_print, "fp").select(
        "doc_id",
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        "component_id",
        (F.struct("id", "digest") == F.col("head")).alias("kept"),
        "id",
        "digest",
    )


def keep_one(docs: DataFrame, staging: Staging, shingle: int = WORDS_PER_SHINGLE, radius: int = RADIUS) -> DataFrame:
    """The rows of `docs` with one row of each group, all columns kept.

    Rows are dealt once, to meet the keys of those that go; only exactly repeated
    rows are dealt again, and one of them stays.
    """
    groups = simhash_groups(docs, staging, shingle, radius)
    # `kept` is the same for all rows of one key.
    keys = groups.groupBy("id", "digest").agg(F.min("kept").alias("kept"), F.count("*").alias("copies"))
    marks = staging.save(keys.where("NOT kept OR copies > 1").select("id", "digest", "kept"), "marks")
    key, repeated = unused(docs, "key"), unused(docs, "repeated")
    named = marks.select(F.struct("id", "digest").alias(key), F.col("kept").alias(repeated))
    # The plan is that of large inputs on small ones as well.
    marked = docs.withColumn(key, row_key()).join(named.hint("merge"), key, "left")
    chosen = marked.where(F.col(repeated).isNull())
    if not marks.where("kept").isEmpty():
        chosen = chosen.unionAll(marked.where(repeated).dropDuplicates([key]))
    return chosen.select(*docs.columns)


__all__ = ["LAST_ID", "fingerprint", "fingerprints", "keep_one", "simhash_groups"]
