import re

import pytest

from tillhouse.llm.license_scan import UNKNOWN, find_licences, train
from tillhouse.llm.license_templates import TEMPLATES

CLEAN = [
    "the cat sat on the mat and the dog was in the garden",
    "she had a license to drive but no car to drive with",
    "this work was hard and the version of the story was long",
]


@pytest.fixture(scope="module")
def classifier(spark, sf_dir, tmp_path_factory):
    from tillhouse.staging import Staging

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    with Staging(spark) as area:
        return train(docs, area)


def found(docs, classifier):
    return sorted(
        (-1 if r.doc_id is None else r.doc_id, r.place, r.family) for r in find_licences(docs, classifier).collect() if r.confirmed
    )


def test_every_template_is_found_in_place(documents, classifier):
    notices = [(family, notice) for family, some in TEMPLATES.items() for notice in some]
    texts = [f"some words here\n{notice}\r\nand more of them\n" for _, notice in notices]
    got = found(documents(texts), classifier)
    right = sum((k, 1, family) in got for k, (family, _) in enumerate(notices))
    assert right >= 0.95 * len(notices)
    assert {place for _, place, _ in got} == {1}


def test_edited_notices_and_clean_text(documents, classifier):
    texts = [
        "RELEASED under the MIT license!",
        "Licensed under the Apache License , version 2.0 , see the file",
        "This work is licensed under the GNU General Public License, version 2.",
        *CLEAN,
    ]
    assert found(documents(texts), classifier) == [(0, 0, "MIT"), (1, 0, "Apache"), (2, 0, "GPL")]


def test_odd_texts_and_repeated_rows(documents, classifier, odd_texts):
    docs = documents(odd_texts, extra=[(None, "Licensed under CC BY-NC 4.0.", None, None, None)], repeat=True)
    assert found(docs, classifier) == [(-1, 0, "CC-BY-NC")] * 2
    assert find_licences(documents([]), classifier).count() == 0


def test_whole_table_by_its_planted_lines(spark, sf_dir, classifier):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    want = set()
    for doc in docs.collect():
        for place, line in enumerate(re.split("\r?\n", doc.text or "")):
            if re.search("licen[cs]ed? under|released under", line, re.I):
                want.add((doc.doc_id, place))
    got = {(d, p) for d, p, _ in found(docs, classifier)}
    assert got == want


def test_training_on_nothing(documents, staging):
    """Without corpus paragraphs there is no unknown class to learn, but notices are still told apart."""
    classifier = train(documents([None, ""]), staging)
    assert UNKNOWN in classifier.families
    assert found(documents(["Released under the MIT License."]), classifier) == [(0, 0, "MIT")]


def test_no_python_in_the_plan(documents, classifier):
    plan = find_licences(documents(CLEAN), classifier)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_the_sample_is_bounded_whatever_the_documents(documents):
    from tillhouse.llm.license_scan import sampled_paragraphs

    long = ["\n".join(f"line {k} of document {d}" for k in range(400)) for d in range(600)]
    one = ["\n".join(f"line {k}" for k in range(100_000)), *["short text"] * 500]
    copies = ["\n".join(f"copied line {k}" for k in range(100))] * 2000
    for texts in (long, one, copies, ["few\nlines", None, ""]):
        n = sampled_paragraphs(documents(texts), 3000).count()
        lines = sum(t.count("\n") + 1 for t in texts if t)
        assert (2700 <= n <= 3300) if lines > 3000 else n == 2


def test_training_reads_every_paragraph(spark, documents):
    from tillhouse.staging import Staging

    saved = {}

    class Watched(Staging):
        def save(self, df, name, partition_by=None):
            saved[name] = super().save(df, name, partition_by)
            return saved[name]

    lines = [[f"the work {k} of document {d} and the rest" for k in range(20)] for d in range(400)]
    texts = ["\n".join([*some, "", "Released under the MIT License."]) for some in lines]
    with Watched(spark) as area:
        classifier = train(documents(texts), area)
        assert saved["unknown"].count() == 400 * 20
    assert found(documents([texts[0]]), classifier) == [(0, 21, "MIT")]


def test_paragraphs_like_a_template_are_those_of_the_similarity(documents, odd_texts):
    from pyspark.sql import functions as F

    from tillhouse.llm.license_scan import _corpus_paragraphs, _with_similarity, paragraphs, word_list

    texts = [*odd_texts, *CLEAN, "The licence, the License; version 2\r\nThe  CAT on\u00a0the mat_the", "Released under\nthe MIT License."]
    texts += ["Released under the MIT License", "MIT License here, not released", "under the terms of the gnu general public license as such"]
    docs = documents(texts)
    got = sorted(r.words for r in _corpus_paragraphs(docs).collect())
    worded = paragraphs(docs).withColumn("words", word_list(F.col("paragraph")))
    per_family = [_with_similarity(worded.withColumn("family", F.lit(family))) for family in TEMPLATES]
    alike = {(r.doc_id, r.place) for rows in per_family for r in rows.where("similarity >= 0.6").collect()}
    assert got == sorted(r.words for r in worded.collect() if (r.doc_id, r.place) not in alike)
    assert alike


def test_rows_left_out_before_scoring_are_unknown(spark, classifier):
    from dataclasses import replace

    from pyspark.sql import functions as F

    from tillhouse.llm.license_scan import word_list

    texts = [*CLEAN, *(notice for some in TEMPLATES.values() for notice in some), "under the version of the", "no warranty"]
    rows = spark.createDataFrame([(text,) for text in texts], "text string").select(word_list(F.col("text")).alias("words"))
    whole = replace(classifier, families=("none of them", *classifier.families[1:]))
    kinds = [c.scored(rows, "words").where(F.col("family") != c.families[0]).collect() for c in (classifier, whole)]
    assert classifier._telling() and whole._telling() is None
    assert sorted(map(str, kinds[0])) == sorted(map(str, kinds[1])) and kinds[0]


def test_the_least_probability_is_exact_over_many_rows(spark):
    from tillhouse.llm.license_scan import _exceeded_by

    values = [(k * 7919 % 10_007) / 10_007 for k in range(20_000)]
    rows = spark.createDataFrame([(v,) for v in values], "probability double")
    for few in (0, 1, 19, 5_000, 19_999):
        assert _exceeded_by(rows, few) == sorted(values, reverse=True)[few]
    assert _exceeded_by(rows, 20_000) == 0.0
