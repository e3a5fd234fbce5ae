"""Language identification by the nearest of several centroids per language.

A text becomes a normalised TF-IDF vector over hashed letter trigrams. Spherical
k-means finds a few centroids in each language's sample; a text gets the language
of the centroid with the largest cosine, and is rejected when that cosine is far
below what training texts of about its length reach.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillhouse.llm.columns import map_batches, texts

N_GRAM = 3
FEATURES = 1 << 13
CENTROIDS = 4
SAMPLE_ROWS = 2400
ROUNDS = 10
UNKNOWN = "und"
# Distinct n-grams of a text, in bands; each band has its own distance limit.
BANDS = np.array([8, 32, 128, 512])
PREFIX_WORDS = (1, 4, 16, 64)
REJECT_QUANTILE, REJECT_SHARE = 0.01, 0.2
LETTERS_ONLY = bytes(b if chr(b).isalpha() or b >= 128 else 32 for b in range(256))


def grams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams of the whole text with their counts; other ASCII than letters counts as blank."""
    letters = b" " + text.lower().encode().translate(LETTERS_ONLY) + b" "
    codes = np.frombuffer(letters, np.uint8).astype(np.uint32)
    inner = codes[1:-1] != 32
    mixed = codes[:-2] * np.uint32(0x9E3779B1) ^ codes[1:-1] * np.uint32(0x85EBCA77) ^ codes[2:] * np.uint32(0xC2B2AE3D)
    mixed = (mixed ^ (mixed >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    counts = np.bincount((mixed[inner] >> np.uint32(19)).astype(np.int64), minlength=FEATURES)
    at = np.flatnonzero(counts)
    return at, counts[at]


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


@dataclass
class Model:
    languages: list[str] = field(default_factory=list)
    idf: np.ndarray = field(default_factory=lambda: np.ones(FEATURES, np.float32))
    centroids: np.ndarray = field(default_factory=lambda: np.zeros((FEATURES, 0), np.float32))
    owner: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    limits: np.ndarray = field(default_factory=lambda: np.zeros(len(BANDS) + 1))

    def vector(self, at: np.ndarray, counts: np.ndarray) -> np.ndarray:
        weights = np.sqrt(counts) * self.idf[at]
        norm = np.sqrt((weights * weights).sum())
        return (weights / norm if norm else weights).astype(np.float32)

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """Language, cosine to its nearest centroid, and whether that is too far away."""
        if not self.languages or not has_letter(text):
            return UNKNOWN, 0.0, True
        at, counts = grams(text)
        if not len(at):  # letters outside the features, such as combining forms only
            return self.languages[0], 0.0, True
        cosines = self.vector(at, counts) @ self.centroids[at]
        best = int(cosines.argmax())
        score = min(1.0, max(0.0, float(cosines[best])))
        return self.languages[self.owner[best]], score, score < self.limits[np.searchsorted(BANDS, len(at), "right")]


def _bounded_sample(docs: DataFrame, rows: int) -> DataFrame:
    """About `rows` training rows, evenly over the languages, by a hash of id and text."""
    sizes = {r.lang: r["count"] for r in docs.groupBy("lang").count().collect()}
    if not sizes:
        return docs.withColumn("place", F.lit(0.0)).limit(0)
    share: Column = F.lit(0.0)
    for lang, size in sizes.items():
        share = F.when(F.col("lang") == lang, F.lit(min(1.0, rows / len(sizes) / size))).otherwise(share)
    place = F.pmod(F.xxhash64("doc_id", F.length("text")), F.lit(1 << 30)) / float(1 << 30)
    return docs.withColumn("place", place).where(F.col("place") < share)


def _clusters(vectors: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Unit centroids of unit row vectors."""
    centres = vectors[rng.choice(len(vectors), min(CENTROIDS, len(vectors)), replace=False)]
    for _ in range(ROUNDS):
        nearest = (vectors @ centres.T).argmax(axis=1)
        sums = [vectors[nearest == k].sum(axis=0) for k in range(len(centres)) if (nearest == k).any()]
        centres = np.stack([s / np.linalg.norm(s) for s in sums])
    return centres


def train(labelled: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Fits on a sample of about `sample_rows` rows of (`doc_id`, `text`, `lang`), which bounds the driver's work.

    Rows without a language or letters are left out; without any row the model
    is empty and rejects everything.
    """
    usable = labelled.select("doc_id", "text", "lang").where("lang IS NOT NULL AND text IS NOT NULL")

    def make():
        def convert(batch: pa.RecordBatch) -> dict:
            out: dict = {"place": [], "lang": [], "whole": [], "at": [], "counts": []}
            told = (batch.column(c).to_pylist() for c in ("place", "lang"))
            for place, lang, text in zip(*told, texts(batch), strict=True):
                words = text.split()
                starts = [(" ".join(words[:n]), False) for n in PREFIX_WORDS if n < len(words)]
                for part, whole in [*starts, (text, True)]:
                    at, counts = grams(part)
                    if len(at):
                        for name, value in zip(out, (place, lang, whole, at, counts), strict=True):
                            out[name].append(value)
            return out

        return convert

    sample = map_batches(
        _bounded_sample(usable, sample_rows),
        make,
        "place double, lang string, whole boolean, at array<int>, counts array<int>",
    ).toArrow().sort_by([("place", "ascending"), ("lang", "ascending")])
    langs, whole = sample["lang"].to_pylist(), sample["whole"].to_numpy()
    ats = [np.array(x) for x in sample["at"].to_pylist()]
    counts = [np.array(x) for x in sample["counts"].to_pylist()]
    model = Model(sorted({lang for lang in langs}))
    if not model.languages:
        return model
    chosen = np.flatnonzero(whole)
    frequency = np.zeros(FEATURES)
    for k in chosen:
        frequency[ats[k]] += 1
    model.idf = (np.log((1 + len(chosen)) / (1 + frequency)) + 1).astype(np.float32)
    rng, centres, owner = np.random.default_rng(11), [], []
    for number, lang in enumerate(model.languages):
        rows = [k for k in chosen if langs[k] == lang]
        dense = np.zeros((len(rows), FEATURES), np.float32)
        for row, k in enumerate(rows):
            dense[row, ats[k]] = model.vector(ats[k], counts[k])
        found = _clusters(dense, rng)
        centres.append(found)
        owner += [number] * len(found)
    model.centroids, model.owner = np.ascontiguousarray(np.concatenate(centres).T), np.array(owner)
    reached = np.array([(model.vector(a, c) @ model.centroids[a]).max() for a, c in zip(ats, counts)])
    bands = np.searchsorted(BANDS, [len(a) for a in ats], "right")
    for band in range(len(BANDS) + 1):
        if (bands == band).any():
            model.limits[band] = REJECT_SHARE * np.quantile(reached[bands == band], REJECT_QUANTILE)
    return model


def predict(docs: DataFrame, model: Model, keep: list[str] | None = None) -> DataFrame:
    """The columns `keep` of `docs` (all of them) with `lang_pred`, `score` and `rejected` for each whole text.

    A null text or one without letters is `und` with score 0, and rejected. Only
    the text is looked at, all of it however long; repeated rows repeat, and ties
    go to the language first in order. Columns of these three names are replaced.
    An empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = [c for c in keep or docs.columns if c not in ("lang_pred", "score", "rejected")]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*kept).schema.fields)

    def make():
        fitted = shared.value

        def label(batch: pa.RecordBatch) -> dict:
            found = [fitted.predict(text) for text in batch.column("text").to_pylist()]
            out = {name: batch.column(name) for name in kept}
            return out | dict(zip(("lang_pred", "score", "rejected"), zip(*found), strict=True)) if found else out | {
                "lang_pred": [], "score": [], "rejected": []
            }

        return label

    read = docs.select(*kept, *({"text"} - set(kept)))
    return map_batches(read, make, f"{schema}, lang_pred string, score double, rejected boolean")


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether crc32 of the id's text leaves 2 modulo 4; null for a null id."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2
