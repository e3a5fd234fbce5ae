"""Licence notices, found by a trained paragraph classifier.

A paragraph's words and word pairs are its features. Multinomial logistic
regression with an L1 penalty learns the families from templates and the unknown
class from all paragraphs of the corpus; the penalty leaves few weights, and a
paragraph with none of those n-grams is unknown without further work. The
probability that a prediction needs is set so that few corpus paragraphs pass,
and a prediction stands only if the paragraph's word runs are mostly those of
one of the family's templates. Everything is built from DataFrame expressions.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillhouse.llm.license_templates import TEMPLATES
from tillhouse.operators.selection import select_places
from tillhouse.staging import Staging

UNKNOWN = "unknown"
VOCABULARY = 8192
PENALTY = 0.002
ROUNDS = 60
FALSE_SHARE = 0.001
LEAST_PROBABILITY = 0.5
LEAST_SIMILARITY = 0.6
RUN = 3
COMMON = frozenset("a an and as at be by for in is it of on or that the this to with".split())


def word_list(text: Column) -> Column:
    # The plain ranges say nothing new, but are looked up faster.
    return F.array_remove(F.split(F.lower(text), r"[^a-z0-9\p{L}\p{N}]+"), "")


def _runs(words: Column, n: int) -> Column:
    """The runs of n words, joined; the whole list if it is shorter."""
    length = F.greatest(F.size(words) - (n - 1), F.lit(0))
    joined = F.slice(words, 1, length)
    for k in range(1, n):
        joined = F.zip_with(joined, F.slice(words, k + 1, length), lambda a, b: F.concat_ws(" ", a, b))
    return F.when(F.size(words) < n, F.array(F.array_join(words, " "))).otherwise(joined)


def computed(rows: DataFrame, name: str, column: Column) -> DataFrame:
    """`rows` with a column that later steps read as it is, where a plain one would be worked out in each of them."""
    return rows.select("*", F.explode(F.array(column)).alias(name))


def with_runs(rows: DataFrame) -> DataFrame:
    return computed(rows, "runs", F.array_distinct(_runs(F.col("words"), RUN)))


def features(words: Column) -> Column:
    return F.concat(words, F.when(F.size(words) > 1, _runs(words, 2)).otherwise(F.array().cast("array<string>")))


def paragraphs(docs: DataFrame) -> DataFrame:
    """`doc_id`, `place` and `paragraph` of every line of every text that has a letter or digit."""
    lines = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.posexplode(F.split("text", r"\r?\n")).alias("place", "paragraph"))
    return lines.where(F.col("paragraph").rlike(r"[\p{L}\p{N}]"))


def sampled_paragraphs(docs: DataFrame, sample: int) -> DataFrame:
    """About `sample` lines of the corpus, those without a letter or digit left out: a number `place` and the `paragraph`.

    For looking at some lines of a corpus; training reads all of them.
    Each line is chosen for itself, by a hash of document and line against the
    number of all lines, so no document, however long, and no copies of one can
    make the sample much larger.
    """
    line_ends = F.length("text") - F.length(F.replace("text", F.lit("\n")))
    total = docs.agg(F.sum(line_ends + 1)).first()[0] or 0
    share = int((1 << 30) * min(1.0, sample / max(1, total)))
    number = lambda k: F.xxhash64(F.col("digest"), k)
    lines = F.transform(F.split("text", r"\r?\n"), lambda line, k: F.struct(number(k).alias("place"), line.alias("paragraph")))
    digest = F.xxhash64(F.lit(6), "doc_id", "text").alias("digest")
    kept = F.filter(lines, lambda line: F.pmod(line["place"], F.lit(1 << 30)) < share)
    chosen = docs.select("text", digest).select(F.explode(kept).alias("line")).select("line.*")
    return chosen.where(F.col("paragraph").rlike(r"[\p{L}\p{N}]"))


@dataclass(frozen=True)
class Classifier:
    """Families in order, their intercepts, and the weights of the n-grams that have any."""

    families: tuple[str, ...]
    intercepts: tuple[float, ...]
    weights: dict[str, tuple[float, ...]]
    least_probability: float = LEAST_PROBABILITY

    def _telling(self) -> list[str] | None:
        """N-grams of which a paragraph with a family has one; None if there may be a family without any.

        Those left out, common words and small weights first, speak for a family
        too, but all of them together less than the intercepts for the unknown class.
        """
        if UNKNOWN not in self.families:
            return None
        unknown = self.families.index(UNKNOWN)
        others = [k for k in range(len(self.families)) if k != unknown]
        room = 0.999 * (self.intercepts[unknown] - max(self.intercepts[k] for k in others))
        gains = {gram: max(row[k] for k in others) - row[unknown] for gram, row in self.weights.items()}
        telling = []
        for gram in sorted(gains, key=lambda g: (not COMMON.issuperset(g.split(" ")), gains[g], g)):
            if 0 < gains[gram] < room:
                room -= gains[gram]
            elif gains[gram] > 0:
                telling.append(gram)
        return telling if room > 0 else None

    def scored(self, rows: DataFrame, words: str) -> DataFrame:
        """`rows` that may have a family, with `family` and `probability`; the others are unknown.

        Left out are those without a weighted n-gram, and, before their n-grams
        are made, those without a word of the n-grams that a family needs.
        """
        weighted, n = sorted(self.weights), len(self.families)
        index = _constant(weighted)
        flat = _constant([repr(w) for g in weighted for w in self.weights[g]]).cast("array<double>")
        start = _constant([repr(w) for w in self.intercepts]).cast("array<double>")

        def add(scores: Column, gram: Column) -> Column:
            row = F.slice(flat, (F.array_position(index, gram).cast("int") - 1) * n + 1, n)
            return F.zip_with(scores, row, lambda a, b: a + b)

        telling = self._telling()
        if telling is not None:
            rows = rows.where(F.arrays_overlap(F.col(words), _constant(_marks(telling))))
        found = computed(rows, "__met", F.array_intersect(features(F.col(words)), index)).where(F.size("__met") > 0)
        found = computed(found, "__scores", F.aggregate("__met", start, add))
        found = found.withColumn("__top", F.array_max("__scores"))
        total = F.aggregate(F.transform("__scores", lambda x: F.exp(x - F.col("__top"))), F.lit(0.0), lambda s, x: s + x)
        return (
            found.withColumn("family", F.element_at(_constant(self.families), F.array_position("__scores", F.col("__top")).cast("int")))
            .withColumn("probability", 1 / total)
            .drop("__met", "__scores", "__top")
        )


def _constant(values) -> Column:
    """An array of strings as one constant; the separator occurs in no n-gram."""
    return F.split(F.lit("|".join(values)), r"\|")


def _template_rows(spark: SparkSession) -> DataFrame:
    """Every template, and each of its sentences, as a training paragraph."""
    rows = []
    for family, notices in TEMPLATES.items():
        for notice in notices:
            parts = {notice, *(part for part in notice.split(". ") if len(part.split()) > 3)}
            rows += [(family, part) for part in sorted(parts)]
    return spark.createDataFrame(rows, "family string, paragraph string").select("family", word_list(F.col("paragraph")).alias("words"))


def _notices(spark: SparkSession) -> DataFrame:
    """The word runs of each template; as few rows as there are templates."""
    rows = []
    for family, notices in TEMPLATES.items():
        for notice in notices:
            rows.append((family, sorted(_word_runs(_plain_words(notice)))))
    return spark.createDataFrame(rows, "family string, own array<string>")


def _share(shared: Column, runs: Column, own: Column) -> Column:
    return F.greatest(shared / F.size(runs), shared / F.size(own))


def _with_similarity(predicted: DataFrame) -> DataFrame:
    """The largest share of the paragraph's word runs, or of a template's, that one template of its family has too."""
    owned = _notices(predicted.sparkSession).groupBy("family").agg(F.collect_list("own").alias("notices"))
    met = with_runs(predicted).join(F.broadcast(owned), "family", "left")
    shares = F.transform("notices", lambda own: _share(F.size(F.array_intersect("runs", own)), F.col("runs"), own))
    return met.withColumn("similarity", F.coalesce(F.array_max(shares), F.lit(0.0)))


def _plain_words(text: str) -> list[str]:
    return "".join(c if c.isalnum() else " " for c in text.lower()).split()


def _word_runs(words: list[str]) -> set[str]:
    """What `with_runs` gives for a list of words."""
    return {" ".join(words[k : k + RUN]) for k in range(max(1, len(words) - RUN + 1))}


def _like_a_template(words: Column) -> Column:
    """Whether one template shares as many of its word runs, or of the paragraph's, as `LEAST_SIMILARITY` asks for.

    A shared run brings its marking word along, so most paragraphs need no runs.
    Runs of common words alone are less than that share of any template, and of
    any paragraph but a very short one.
    """
    notices = [_word_runs(_plain_words(notice)) for some in TEMPLATES.values() for notice in some]
    every = sorted(set().union(*notices))
    marked = [run for run in every if not COMMON.issuperset(run.split(" "))]
    owned = F.array(*[_constant(sorted(own)) for own in notices])

    def alike(runs: Column) -> Column:
        shares = F.transform(owned, lambda own: _share(F.size(F.array_intersect(runs, own)), runs, own))
        return F.when(F.arrays_overlap(runs, _constant(every)), F.array_max(shares) >= LEAST_SIMILARITY)

    met = F.transform(F.array(F.array_distinct(_runs(words, RUN))), alike)[0]
    return F.coalesce(F.when((F.size(words) <= 2 * RUN) | F.arrays_overlap(words, _constant(_marks(marked))), met), F.lit(False))


def _marks(grams: list[str]) -> list[str]:
    """Words of which every one of the n-grams has one, none of them common unless all of an n-gram's are."""
    return sorted({max(gram.split(" "), key=lambda word: (word not in COMMON, len(word))) for gram in grams})


def _corpus_paragraphs(docs: DataFrame) -> DataFrame:
    """All paragraphs unlike every template: `line`, a hash of document, place and text, and their `words`."""
    worded = computed(paragraphs(docs), "words", word_list(F.col("paragraph")))
    line = F.xxhash64("doc_id", "place", "paragraph").alias("line")
    return worded.where(~_like_a_template(F.col("words"))).select(line, "words")


def train(docs: DataFrame, staging: Staging) -> Classifier:
    """Fits on the templates and on all paragraphs of the corpus, as vectors over the templates' n-grams.

    Paragraphs like a template are not taken for unknown ones. Every fourth
    corpus paragraph, by a hash of document and place, is held out of the fit;
    these set the least probability.
    """
    spark = docs.sparkSession
    known = _template_rows(spark).select("family", features(F.col("words")).alias("grams"))
    families = (UNKNOWN, *TEMPLATES)
    number = F.array_position(_constant(families), F.col("family")) - 1
    counter = CountVectorizer(inputCol="grams", outputCol="vector", vocabSize=VOCABULARY, binary=True).fit(known)
    fits = F.col("line") % 4 != 0
    grams = F.when(fits, features(F.col("words"))).otherwise(F.array().cast("array<string>"))
    read = _corpus_paragraphs(docs).select("line", F.when(~fits, F.col("words")).alias("words"), grams.alias("grams"))
    unknown = staging.save(counter.transform(read).drop("grams"), "unknown")
    seen = unknown.where(fits)
    # Templates weigh as much as the corpus, however many paragraphs that has.
    n_known, n_seen = known.count(), seen.count()
    # Equal vectors are one row with their number as weight.
    alike = staging.save(seen.groupBy("vector").agg(F.count(F.lit(1)).cast("double").alias("weight")), "vectors")
    table = (
        counter.transform(known)
        .select("vector", number.cast("double").alias("label"), F.lit(max(1.0, n_seen / n_known)).alias("weight"))
        .union(alike.select("vector", F.lit(float(families.index(UNKNOWN))), "weight"))
    )
    fitted = LogisticRegression(
        featuresCol="vector", labelCol="label", weightCol="weight", family="multinomial",
        regParam=PENALTY, elasticNetParam=1.0, maxIter=ROUNDS,
    ).fit(table)
    matrix = fitted.coefficientMatrix.toArray()
    held = [k for k in range(matrix.shape[1]) if matrix[:, k].any()]
    present = sorted(set(range(matrix.shape[0])) & set(range(len(families))))
    classifier = Classifier(
        tuple(families[k] for k in present),
        tuple(float(fitted.interceptVector[k]) for k in present),
        {counter.vocabulary[k]: tuple(float(matrix[c, k]) for c in present) for k in held},
    )
    test = unknown.where(~fits).select("words")
    passed = classifier.scored(test, "words").where(F.col("family") != UNKNOWN)
    beyond = _exceeded_by(staging.save(passed.select("probability"), "passed"), math.floor(FALSE_SHARE * test.count()))
    least = min(max(LEAST_PROBABILITY, beyond), 0.99)
    return Classifier(classifier.families, classifier.intercepts, classifier.weights, least)


def _exceeded_by(passed: DataFrame, few: int) -> float:
    """The largest probability that at most `few` rows exceed; 0 if there are no more rows than that."""
    total = passed.count()
    if total <= few:
        return 0.0
    key = F.struct(F.col("probability").alias("value"))
    return select_places(passed, [key], ["value"], [(0, total - few)], total)[0]["value"]


def find_licences(docs: DataFrame, classifier: Classifier) -> DataFrame:
    """`doc_id`, `place`, `family`, `probability`, `similarity`, `confirmed`: a row for each paragraph predicted to be a notice.

    `place` counts the lines of the text from 0. A prediction is confirmed if the
    paragraph shares enough word runs with a template of its family. Null and
    empty texts have no paragraphs; repeated rows give their paragraphs again. Of
    families with equal scores the first in order is taken. Every line of a text
    is looked at, however many; columns but `doc_id` and `text` are not read. An
    empty table gives no rows.
    """
    worded = computed(paragraphs(docs), "words", word_list(F.col("paragraph"))).drop("paragraph")
    predicted = classifier.scored(worded, "words").where(
        (F.col("family") != UNKNOWN) & (F.col("probability") > classifier.least_probability)
    )
    return _with_similarity(predicted).select(
        "doc_id", "place", "family", "probability", "similarity", (F.col("similarity") >= LEAST_SIMILARITY).alias("confirmed")
    )
