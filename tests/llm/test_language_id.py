import math
from collections import Counter

from pyspark.sql import functions as F

from tillhouse.llm.language_id import UNKNOWN, held_out, predict, train


def test_held_out_accuracy_on_the_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = train(docs.where(~held_out()))
    rows = predict(docs.where(held_out()), model).collect()
    assert len(rows) > 20
    right = sum(r.lang_pred == r.lang for r in rows)
    assert right >= 0.95 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)
    assert sum(r.rejected for r in rows) <= 0.02 * len(rows)


def test_held_out_rows_follow_the_crc(documents):
    import zlib

    docs = documents(["x"] * 50, extra=[(None, "x", None, None, None)])
    rows = docs.select("doc_id", held_out().alias("held")).collect()
    for row in rows:
        assert row.held == (None if row.doc_id is None else zlib.crc32(str(row.doc_id).encode()) % 4 == 2)


def languages(documents):
    a = ["the cat sat on the mat and then it ran away from them all"] * 30
    b = ["der hund lief durch den wald und suchte nach seinem ball"] * 30
    docs = documents(a + b)
    return docs.withColumn("lang", F.when(F.col("doc_id") < 30, "en").otherwise("de"))


def test_odd_texts_and_repeated_rows(documents, odd_texts):
    model = train(languages(documents))
    docs = documents(odd_texts, extra=[(None, "der wald und der hund", None, None, None)], repeat=True)
    rows = predict(docs.drop("lang", "source", "n_chars").withColumn("score", F.lit("clash")), model).collect()
    assert len(rows) == 2 * (len(odd_texts) + 1)
    by_id = {r.doc_id: r for r in rows}
    for key, text in enumerate(odd_texts):
        lettered = any(map(str.isalpha, text or ""))
        assert (by_id[key].lang_pred == UNKNOWN) == (not lettered)
    assert by_id[None].lang_pred == "de"
    assert max(Counter(rows).values()) == 2


def test_foreign_text_is_rejected(documents):
    model = train(languages(documents))
    docs = documents(["xqzw jkvp wqxz zzqk vvjq " * 10, "the cat ran from the mat and sat"])
    rows = {r.doc_id: r for r in predict(docs, model).collect()}
    assert rows[0].rejected and not rows[1].rejected


def test_without_training_rows_everything_is_rejected(documents):
    for docs in (documents([]), documents(["text"]).withColumn("lang", F.lit(None).cast("string"))):
        model = train(docs)
        row = predict(documents(["some text"]), model).first()
        assert (row.lang_pred, row.score, row.rejected) == (UNKNOWN, 0.0, True)


def test_empty_table(documents):
    assert predict(documents([]), train(languages(documents))).count() == 0


def test_the_sample_is_bounded(documents):
    docs = documents([f"text {k} of many" for k in range(2000)])
    from tillhouse.llm.language_id import _bounded_sample

    assert 50 < _bounded_sample(docs.select("doc_id", "text", "lang"), 100).count() < 150


def plain_grams(text):
    """Feature numbers and counts by walking over the bytes."""
    letters = [32] + [b if b >= 128 or chr(b).isalpha() else 32 for b in text.lower().encode()] + [32]
    found = Counter()
    for a, b, c in zip(letters, letters[1:], letters[2:]):
        if b != 32:
            mixed = (a * 0x9E3779B1 & 0xFFFFFFFF) ^ (b * 0x85EBCA77 & 0xFFFFFFFF) ^ (c * 0xC2B2AE3D & 0xFFFFFFFF)
            mixed = (mixed ^ mixed >> 15) * 0x2C1B3C6D & 0xFFFFFFFF
            found[mixed >> 19] += 1
    return found


def test_predictions_against_plain_cosines(spark, sf_dir, odd_texts):
    """TF-IDF weights, cosines to all centroids, nearest centroid and distance limit, worked out one by one."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    training = docs.where(~held_out()).where("lang IS NOT NULL")
    model = train(training)
    texts = [r.text for r in training.collect() if r.text]
    frequency = Counter(g for text in texts for g in plain_grams(text))
    assert len(texts) < 2400  # the sample is the whole table
    for g in list(frequency)[::37]:
        assert math.isclose(model.idf[g], math.log((1 + len(texts)) / (1 + frequency[g])) + 1, rel_tol=1e-5)
    centroids = model.centroids.T.astype(float)
    assert all(math.isclose(sum(x * x for x in c), 1, rel_tol=1e-4) for c in centroids)
    assert sorted(set(model.owner)) == list(range(len(model.languages))) and len(centroids) > len(model.languages)

    tried = odd_texts + [r.text for r in docs.where(held_out()).collect()]
    rows = predict(spark.createDataFrame(list(enumerate(tried)), "doc_id long, text string"), model).collect()
    for row in rows:
        text = tried[row.doc_id]
        found = plain_grams(text or "")
        if not any(map(str.isalpha, text or "")) or not found:
            assert row.rejected and row.score == 0
            continue
        weights = {g: math.sqrt(n) * float(model.idf[g]) for g, n in found.items()}
        norm = math.sqrt(sum(w * w for w in weights.values()))
        cosines = [sum(w / norm * c[g] for g, w in weights.items()) for c in centroids]
        best = max(cosines)
        assert math.isclose(row.score, min(1, max(0, best)), abs_tol=1e-4)
        near = {model.languages[o] for o, c in zip(model.owner, cosines) if c > best - 1e-4}
        assert row.lang_pred in near
        limit = model.limits[sum(len(found) >= b for b in (8, 32, 128, 512))]
        assert row.rejected == (row.score < limit) or abs(row.score - limit) < 1e-4
