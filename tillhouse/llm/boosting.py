"""Gradient-boosted trees over boolean features, fitted with aggregates only.

Each tree splits twice. One aggregate gives the gradient and curvature of every
feature's two sides, a second one those within both sides of the chosen split;
a tree costs two passes over the sample, and nothing but sums leaves the cluster.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TREES = 6
RATE = 0.5
RIDGE = 1.0


@dataclass(frozen=True)
class Tree:
    """`root` decides which of the two inner splits is asked; `leaves` are (yes-yes, yes-no, no-yes, no-no)."""

    root: str
    inner: tuple[str, str]
    leaves: tuple[float, float, float, float]

    def value(self, feature) -> Column:
        yes, no = (feature(name) for name in self.inner)
        a, b, c, d = map(F.lit, self.leaves)
        return F.when(feature(self.root), F.when(yes, a).otherwise(b)).otherwise(F.when(no, c).otherwise(d))


@dataclass(frozen=True)
class Boosted:
    start: float
    trees: tuple[Tree, ...]
    threshold: float = 1.0

    def probability(self, feature) -> Column:
        """`feature` gives the boolean column of a feature's name."""
        score = F.lit(self.start)
        for tree in self.trees:
            score = score + tree.value(feature)
        return 1 / (1 + F.exp(-score))


def _gain(g: float, h: float) -> float:
    return g * g / (h + RIDGE)


def _leaf(g: float, h: float) -> float:
    return RATE * g / (h + RIDGE)


def _sums(sample: DataFrame, probability: Column, label: str, features: list[str], sides: list[Column]) -> list[dict]:
    """For each side: total gradient and curvature (name None) and those where a feature holds."""
    step, bend = F.col(label).cast("double") - probability, probability * (1 - probability)
    fitted = sample.select(*features, *(s.alias(f"side{k}") for k, s in enumerate(sides)), step.alias("g"), bend.alias("h"))
    wanted, names = [], []
    for k in range(len(sides)):
        for name in [None, *features]:
            held = F.col(f"side{k}") & (F.col(name) if name else F.lit(True))
            names.append((k, name))
            wanted += [F.sum(F.when(held, F.col(c)).otherwise(0.0)).alias(f"{c}{len(names)}") for c in "gh"]
    row = fitted.agg(*wanted).first()
    out: list[dict] = [{} for _ in sides]
    for at, (k, name) in enumerate(names, 1):
        out[k][name] = (row[f"g{at}"] or 0.0, row[f"h{at}"] or 0.0)
    return out


def _split(sums: dict) -> tuple[str, tuple[float, float], tuple[float, float]]:
    """The feature with the largest gain, with the sums of its yes and no side; ties go by name."""
    g, h = sums[None]
    best = max(
        sorted(name for name in sums if name),
        key=lambda name: _gain(*sums[name]) + _gain(g - sums[name][0], h - sums[name][1]),
    )
    yes = sums[best]
    return best, yes, (g - yes[0], h - yes[1])


def fit(sample: DataFrame, features: list[str], label: str, trees: int = TREES) -> Boosted:
    """Fits on a table of boolean columns; a sample of one class only gives a constant."""
    counts = sample.agg(F.count("*").alias("n"), F.sum(F.col(label).cast("long")).alias("hits")).first()
    n, hits = counts["n"], counts["hits"] or 0
    if not hits or hits == n:
        return Boosted(math.log((hits + 0.5) / (n - hits + 0.5)), ())
    model = Boosted(math.log(hits / (n - hits)), ())
    for _ in range(trees):
        probability = model.probability(F.col)
        (whole,) = _sums(sample, probability, label, features, [F.lit(True)])
        root, _, _ = _split(whole)
        sides = _sums(sample, probability, label, features, [F.col(root), ~F.col(root)])
        (first, yes_yes, yes_no), (second, no_yes, no_no) = map(_split, sides)
        leaves = tuple(_leaf(*sums) for sums in (yes_yes, yes_no, no_yes, no_no))
        model = Boosted(model.start, (*model.trees, Tree(root, (first, second), leaves)))
    return model


def calibrated(model: Boosted, sample: DataFrame, label: str, precision: float) -> Boosted:
    """The model with the least threshold whose precision on `sample` is reached, and by all above it.

    Scores are counted per thousandth, so the table brought to the driver has at
    most 1001 rows. If no threshold reaches the precision, nothing is selected.
    """
    bins = (
        sample.groupBy(F.floor(model.probability(F.col) * 1000).alias("bin"))
        .agg(F.count("*").alias("n"), F.sum(F.col(label).cast("long")).alias("hits"))
        .collect()
    )
    threshold, n, hits = 2.0, 0, 0
    for row in sorted(bins, key=lambda r: -r["bin"]):
        n, hits = n + row["n"], hits + row["hits"]
        if hits < precision * n:
            break
        threshold = row["bin"] / 1000
    return Boosted(model.start, model.trees, threshold)
