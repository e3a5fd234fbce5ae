import numpy as np
import xxhash

from tillhouse.llm import simhash
from tillhouse.llm.simhash import bit_sliced_pairs, fingerprint, keep_one, simhash_groups


def brute_print(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for blank in "\t\n\x0b\x0c\r":
        lowered = lowered.replace(blank, " ")
    words = [w for w in lowered.split(" ") if w]
    if not words:
        return 0
    shingles = [words[k : k + 3] for k in range(len(words) - 2)] if len(words) >= 3 else [words]
    hashes = [xxhash.xxh64(" ".join(s).encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(prints):
    """component of each distinct fingerprint, by flood fill."""
    group, left = {}, set(prints)
    while left:
        seen, front = set(), [left.pop()]
        while front:
            one = front.pop()
            seen.add(one)
            near = {other for other in left if (one ^ other).bit_count() <= 3}
            left -= near
            front += near
        for one in seen:
            group[one] = min(seen)
    return group


def expected(rows):
    prints = [(doc_id, brute_print(text)) for doc_id, text in rows]
    group = brute_groups({p for _, p in prints})
    least = {}
    for doc_id, p in prints:
        if doc_id is not None:
            least[group[p]] = min(doc_id, least.get(group[p], doc_id))
    return sorted((-1 if d is None else d, f"{p:016x}", least.get(group[p])) for d, p in prints)


def found(docs, staging):
    rows = simhash_groups(docs, staging).collect()
    return rows, sorted((-1 if r.doc_id is None else r.doc_id, r.fingerprint, r.component_id) for r in rows)


def test_fingerprint_by_its_definition(odd_texts):
    for text in [*odd_texts, "A b\x0bC D\x1ce f"]:
        assert fingerprint(text or "") == brute_print(text)


def test_bit_sliced_pairs_against_all_pairs():
    rng = np.random.default_rng(3)
    centres = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    flips = [np.uint64(sum(1 << int(b) for b in rng.choice(64, k, replace=False))) for k in range(6) for _ in range(9)]
    prints = np.unique(np.concatenate([centres, *[centres ^ f for f in flips]]))
    for radius in (0, 1, 3, 5):
        i, j = bit_sliced_pairs(prints, radius)
        distance = np.bitwise_count(prints[:, None] ^ prints[None, :])
        a, b = np.nonzero(np.triu(distance <= radius, 1))
        assert sorted(zip(i.tolist(), j.tolist())) == sorted(zip(a.tolist(), b.tolist()))


def test_odd_rows(documents, staging, odd_texts):
    texts = [*odd_texts, odd_texts[10] + " end", odd_texts[10].upper()]
    docs = documents(texts, extra=[(None, "no id", None, None, None)], repeat=True)
    _, got = found(docs, staging)
    assert got == expected(2 * [*enumerate(texts), (None, "no id")])


def test_empty_table(documents, staging):
    assert simhash_groups(documents([]), staging).count() == 0
    assert keep_one(documents([]), staging).count() == 0


def test_whole_table_and_one_kept_of_each_group(spark, sf_dir, staging):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows, got = found(docs, staging)
    assert got == expected([(r.doc_id, r.text) for r in docs.collect()])
    groups = {r.component_id for r in rows}
    assert sorted(r.component_id for r in rows if r.kept) == sorted(groups)
    kept = keep_one(docs, staging)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(groups)


def test_keep_one_of_repeated_rows(documents, staging):
    assert keep_one(documents(["same words again"], repeat=True), staging).count() == 1


def test_keep_one_keeps_columns_of_any_name(documents, staging):
    texts = ["a b c d e", "a b c d e", "quite another text here", None]
    docs = documents(texts, extra=[(None, "no id at all", None, None, None)], repeat=True).selectExpr(
        "*", "1 AS key", "2 AS __key", "'r' AS repeated", "3 AS kept", "4 AS digest"
    )
    rows = keep_one(docs, staging).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in rows) == [(False, 0), (False, 2), (False, 3), (True, 0)]
    assert all((r.key, r["__key"], r.repeated, r.kept, r.digest) == (1, 2, "r", 3, 4) for r in rows)


def test_buckets_over_a_block_are_dealt(spark, staging, monkeypatch):
    """Chained fingerprints in one bucket, with blocks too small for it."""
    monkeypatch.setattr(simhash, "BLOCK", 8)
    gray = [(k ^ (k >> 1)) << 3 for k in range(200)]
    classes = spark.createDataFrame([(g,) for g in gray], "fp long")
    for agreeing in (1, 2, 3):
        pairs = simhash.links(classes, 1, agreeing)
        roots = simhash.components(pairs, staging).collect()
        assert {r.node for r in roots} == set(gray)
        assert {r.component for r in roots} == {0}
