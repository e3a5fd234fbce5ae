import test_chunk_encoding
import test_decontamination
import test_personal_data
import test_simhash

from pyspark.sql import functions as F

import corpus_pipeline
from tillhouse.llm import decontamination, language_id, personal_data


def test_stages_in_their_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language_id", "simhash_near_dedup", "benchmark_decontamination", "pii", "bpe",
    ]
    assert corpus_pipeline.ORACLE_SQL is None


def test_each_stage_against_brute_force_on_its_own_input(spark, sf_dir, staging):
    docs = staging.save(spark.read.parquet(f"{sf_dir}/documents.parquet"), "documents")
    columns = docs.columns
    held = {}
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r for r in docs.collect()}
        docs = staging.save(stage(spark, docs, sf_dir), name)
        rows = docs.collect()
        held[name] = rows
        if name != "bpe":
            assert docs.columns == columns
        if name == "language_id":
            model = language_id.train(spark.read.parquet(f"{sf_dir}/documents.parquet").where(~language_id.held_out()))
            assert {r.doc_id for r in rows} == {d for d, r in before.items() if not model.predict(r.text)[2]}
            assert len(rows) >= 0.97 * len(before)
        elif name == "simhash_near_dedup":
            groups = test_simhash.expected([(d, r.text) for d, r in before.items()])
            assert sorted(r.doc_id for r in rows) == sorted({least for _, _, least in groups})
        elif name == "benchmark_decontamination":
            items = [decontamination.words(r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
            ids = list(before)
            pairs = test_decontamination.leaking(items, [decontamination.words(before[d].text) for d in ids])
            leaks = {ids[k] for _, k in pairs}
            gone = set(before) - {r.doc_id for r in rows}
            assert gone <= leaks and len(gone) >= 0.99 * len(leaks)
        elif name == "pii":
            assert {r.doc_id for r in rows} == set(before)
            for row in rows:
                assert sum(test_personal_data.brute(row.text)[0][:4]) == 0
                assert row.n_chars == len(row.text)
                if sum(test_personal_data.brute(before[row.doc_id].text)[0][:4]) == 0 and row.text != before[row.doc_id].text:
                    assert any(f"[{kind.upper()}]" in row.text for kind in personal_data.KINDS)
        else:
            test_chunk_encoding.check(rows, [(d, r.text) for d, r in before.items()])
    result = corpus_pipeline.run(spark, sf_dir).collect()
    assert sorted(result) == sorted(held["bpe"])


def test_odd_rows_go_through(spark, sf_dir, documents, odd_texts, staging):
    """What has letters of a known language stays, once; null, empty and wordless texts go at the first stage."""
    table = spark.read.parquet(f"{sf_dir}/documents.parquet")
    plain = "the of and to in that is was for it " + table.where("lang = 'en'").orderBy("doc_id").first().text[:400]
    texts = odd_texts + [plain] * 3
    docs = documents(texts, repeat=True)
    docs = table.limit(0).unionByName(docs).unionByName(table.withColumn("doc_id", F.col("doc_id") + 1000))
    for name, stage in corpus_pipeline.STAGES:
        docs = staging.save(stage(spark, docs, sf_dir), name)
    kept = [r.doc_id for r in docs.collect()]
    assert len(kept) == len(set(kept))
    nothing = [k for k, text in enumerate(texts) if not any(c.isalpha() for c in text or "")]
    assert not set(nothing) & set(kept) and len(set(kept) & set(range(len(odd_texts), len(texts)))) <= 1
    assert sum(k >= 1000 for k in kept) > 0.5 * table.count()


def test_empty_documents(spark, sf_dir, documents):
    docs = documents([])
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
    assert docs.count() == 0
