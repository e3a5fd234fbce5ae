import random

import numpy as np
import pytest

from tillhouse.llm import decontamination
from tillhouse.llm.decontamination import align, contaminated, without_contaminated, words

BENCHMARK = "item_id long, text string"
RNG = random.Random(4)
VOCABULARY = ["".join(RNG.choice("abcdefghij") for _ in range(RNG.randint(2, 7))) for _ in range(400)]


def prose(n, rng=RNG):
    return " ".join(rng.choice(VOCABULARY) for _ in range(n))


ITEMS = [prose(n) for n in (8, 15, 30, 60)]


def edited(text, share):
    return " ".join("changed" if RNG.random() < share else w for w in text.split())


def smith_waterman(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a, 1):
        for j, y in enumerate(b, 1):
            table[i][j] = max(
                0, table[i - 1][j - 1] + (2 if x == y else -1), table[i - 1][j] - 1, table[i][j - 1] - 1
            )
    return max(map(max, table))


def leaking(items, texts):
    """The pairs of numbers of items and texts that align for at least half the item's own score, without any seed."""
    found = set()
    for i, item in enumerate(items):
        codes = {word: k for k, word in enumerate(dict.fromkeys(item))}
        rows = [[codes.get(w, -2) for w in text] for text in texts]
        for at in range(0, len(rows), 50):
            some = rows[at : at + 50]
            block = np.full((len(some), max(map(len, some), default=0)), -1)
            for k, row in enumerate(some):
                block[k, : len(row)] = row
            best = align(np.array([codes[w] for w in item]), block) if item else []
            found |= {(i, at + k) for k, score in enumerate(best) if score >= len(item)}
    return found


def test_alignment_against_the_plain_recurrence():
    rng = np.random.default_rng(2)
    for _ in range(40):
        item = rng.integers(1, 5, rng.integers(1, 9))
        passages = rng.integers(0, 5, (4, rng.integers(1, 14)))
        got = align(item, passages)
        assert got.tolist() == [smith_waterman(item.tolist(), p.tolist()) for p in passages]


def test_copies_are_found_and_clean_documents_are_not(spark, documents, staging):
    bench = spark.createDataFrame(list(enumerate(ITEMS)) + [(9, None), (10, ""), (11, "?!"), (None, "x y")], BENCHMARK)
    leaks = [f"{prose(50)} {item} {prose(30)}" for item in ITEMS]
    leaks += [ITEMS[2].upper().replace(" ", ", \n"), ITEMS[3] + " " + ITEMS[1], "x " + ITEMS[0]]
    leaks += [f"{prose(20)} {edited(item, 0.2)} {prose(20)}" for item in ITEMS[2:]]
    holds = [{0}, {1}, {2}, {3}, {2}, {1, 3}, {0}, {2}, {3}]
    clean = [prose(200) for _ in range(40)] + [" ".join(ITEMS[3].split()[:10]), None, ""]
    docs = documents(leaks + clean, extra=[(None, ITEMS[0], None, None, None)], repeat=True)
    got = {}
    for row in contaminated(docs, bench, staging).collect():
        assert row.item_id not in got.setdefault(row.doc_id, set())
        got[row.doc_id].add(row.item_id)
    assert got == {k: h for k, h in enumerate(holds)} | {None: {0}}
    kept = without_contaminated(docs, bench, staging)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(2 * [len(leaks) + k for k in range(len(clean))])


def test_a_passage_in_most_documents_is_still_found(spark, documents, staging):
    docs = documents([f"{prose(5)} {ITEMS[1]} {prose(5)}" for _ in range(60)])
    bench = spark.createDataFrame([(1, ITEMS[1])], BENCHMARK)
    assert contaminated(docs, bench, staging).count() == 60


@pytest.mark.parametrize("words_per_pass", [1, 40, 10**6])
def test_whole_table_in_any_number_of_passes(spark, sf_dir, staging, monkeypatch, words_per_pass):
    monkeypatch.setattr(decontamination, "WORDS_PER_PASS", words_per_pass if words_per_pass > 1 else 600)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    got = {(r.doc_id, r.item_id): r.share for r in contaminated(docs, bench, staging).collect()}
    items, texts = bench.collect(), docs.collect()
    pairs = leaking([words(i.text) for i in items], [words(d.text) for d in texts])
    want = {(texts[d].doc_id, items[i].item_id) for i, d in pairs}
    assert want and set(got) <= want and len(set(got)) >= 0.99 * len(want)
    assert all(share >= 0.5 for share in got.values())


def test_edited_copies_are_found_as_without_seeds(spark, documents, staging):
    """Random replacements and regular ones, insertions and deletions."""
    rng = random.Random(12)
    items = [prose(n, rng) for n in range(14, 44) for _ in range(2)]

    def changed(text, edit):
        return " ".join(filter(None, (edit(k, w) for k, w in enumerate(text.split()))))

    edits = [
        *(lambda k, w, share=share: "other" if rng.random() < share else w for share in (0.2, 0.25, 0.3, 0.33)),
        *(lambda k, w, n=n: "other" if k % n == n - 1 else w for n in (3, 4, 5)),
        lambda k, w: f"{w} more" if rng.random() < 0.2 else w,
        lambda k, w: "" if rng.random() < 0.2 else w,
    ]
    texts = [f"{prose(40, rng)} {changed(item, edit)} {prose(40, rng)}" for item in items for edit in edits]
    bench = spark.createDataFrame(list(enumerate(items)), BENCHMARK)
    got = {(r.item_id, r.doc_id) for r in contaminated(documents(texts), bench, staging).collect()}
    want = leaking([words(i) for i in items], [words(t) for t in texts])
    assert len(want) > 400
    assert got <= want and len(got) >= 0.99 * len(want), sorted(want - got)[:5]


def test_columns_of_any_name_are_kept(spark, documents, staging):
    docs = documents([ITEMS[1], "clean text"]).selectExpr("*", "1 AS key", "2 AS __key", "3 AS digest", "4 AS window")
    bench = spark.createDataFrame([(1, ITEMS[1])], BENCHMARK)
    (row,) = without_contaminated(docs, bench, staging).collect()
    assert (row.text, row.key, row["__key"], row.digest, row.window) == ("clean text", 1, 2, 3, 4)


def test_empty_tables(spark, documents, staging):
    bench = spark.createDataFrame([(1, "some words here")], BENCHMARK)
    assert contaminated(documents([]), bench, staging).count() == 0
    assert contaminated(documents(["some words here"]), bench.limit(0), staging).count() == 0
    assert without_contaminated(documents(["a"]), bench.limit(0), staging).count() == 1
