"""Near-duplicate embeddings by product quantisation.

Unit vectors are put into the inverted list of their nearest coarse centroid, and
what is left of them is coded by one codeword per subspace. A list is probed for
a vector only if the vector lies within the link distance of the plane that
parts the two lists' cells: no partner can be in any other list. In a probed
list, table-lookup distances drop every vector whose code is further away than
link distance and coding error allow. The exact cosine decides on the rest, so
that with the default `slack` no link is lost and none is made up.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillhouse.llm.columns import map_batches
from tillhouse.llm.graphs import components
from tillhouse.llm.simhash import local_roots
from tillhouse.staging import Staging

LEAST_COSINE = 0.98
SAMPLE_ROWS = 4096
ROWS_PER_LIST = 2048
MOST_LISTS = 1024
SUBSPACES = 8
CODEWORDS = 64
ROUNDS = 8
BLOCK = 1024
PAIRS_AT_ONCE = 1 << 17
MARGIN = 1e-4


def _nearest(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres**2).sum(axis=1) - 2 * rows @ centres.T).argmin(axis=1)


def _k_means(rows: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    centres = rows[rng.choice(len(rows), min(k, len(rows)), replace=False)]
    for _ in range(ROUNDS):
        nearest = _nearest(rows, centres)
        centres = np.stack([rows[nearest == c].mean(axis=0) if (nearest == c).any() else centres[c] for c in range(len(centres))])
    return centres


@dataclass
class Quantiser:
    """Coarse centroids, and for each subspace its columns and codewords."""

    centroids: np.ndarray
    columns: list[np.ndarray]
    codewords: list[np.ndarray]

    @classmethod
    def fit(cls, rows: np.ndarray, n_lists: int) -> Quantiser:
        rng = np.random.default_rng(5)
        centroids = _k_means(rows, n_lists, rng)
        left = rows - centroids[_nearest(rows, centroids)]
        columns = [c for c in np.array_split(np.arange(rows.shape[1]), SUBSPACES) if len(c)]
        return cls(centroids, columns, [_k_means(left[:, c], CODEWORDS, rng) for c in columns])

    def encode(self, rows: np.ndarray, lists: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes of the residuals, and the length of what the codes leave out."""
        left = rows - self.centroids[lists]
        codes = np.stack([_nearest(left[:, c], w) for c, w in zip(self.columns, self.codewords)], axis=1).astype(np.uint8)
        for k, (c, w) in enumerate(zip(self.columns, self.codewords)):
            left[:, c] -= w[codes[:, k]]
        return codes, np.linalg.norm(left, axis=1)

    def table_distances(self, queries: np.ndarray, centroid: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """Squared distances from each query to each coded vector of one list, by table lookup."""
        left, total = queries - centroid, np.zeros((len(queries), len(codes)))
        for k, (c, w) in enumerate(zip(self.columns, self.codewords)):
            table = ((left[:, None, c] - w[None]) ** 2).sum(axis=2)
            total += table[:, codes[:, k]]
        return total

    def probes(self, rows: np.ndarray, own: np.ndarray, slack: float) -> np.ndarray:
        """For each row, which lists lie within `slack` beyond the plane to them."""
        squares = ((rows[:, None, :] - self.centroids[None]) ** 2).sum(axis=2)
        apart = np.sqrt(((self.centroids[:, None] - self.centroids[None]) ** 2).sum(axis=2))[own]
        return squares - squares[np.arange(len(rows)), own][:, None] <= 2 * (slack + MARGIN) * apart + MARGIN


def unit_rows(vectors: list) -> np.ndarray:
    rows = np.array(vectors, np.float64)
    return rows / np.linalg.norm(rows, axis=1)[:, None]


def _usable() -> str:
    return (
        "label IS NOT NULL AND embedding IS NOT NULL AND size(embedding) > 0"
        " AND forall(embedding, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity'))"
        " AND exists(embedding, x -> x <> 0)"
    )


def _fit(classes: DataFrame, dim: int) -> Quantiser:
    """Fits on a sample of about `SAMPLE_ROWS` vectors, which bounds the driver's work."""
    n = classes.count()
    place = F.pmod(F.xxhash64("label", "embedding"), F.lit(1 << 30)) / float(1 << 30)
    chosen = classes.where(place <= SAMPLE_ROWS / n).select("embedding", place.alias("place")).toArrow()
    if chosen.num_rows == 0:
        chosen = classes.select("embedding", place.alias("place")).limit(1).toArrow()
    rows = unit_rows(chosen.sort_by("place")["embedding"].to_pylist())
    return Quantiser.fit(rows, min(MOST_LISTS, max(1, n // ROWS_PER_LIST)))


UNIT = ["label", "la", "lb"]


def _listed(classes: DataFrame, quantiser: Quantiser, slack: float) -> DataFrame:
    """Each vector in its list, once for every pair of lists in which it may have a partner."""
    model = classes.sparkSession.sparkContext.broadcast(quantiser)

    def make():
        fitted = model.value

        def place(batch: pa.RecordBatch) -> dict:
            out: dict = {name: [] for name in ("node", "n", "label", "embedding", "own", "codes", "error", "others")}
            if batch.num_rows:
                for at in range(0, batch.num_rows, BLOCK):
                    part = batch.slice(at, BLOCK)
                    rows = unit_rows(part.column("embedding").to_pylist())
                    own = _nearest(rows, fitted.centroids)
                    codes, error = fitted.encode(rows, own)
                    near = fitted.probes(rows, own, slack)
                    for name in ("node", "n", "label", "embedding"):
                        out[name] += part.column(name).to_pylist()
                    out["own"] += own.tolist()
                    out["codes"] += [c.tobytes() for c in codes]
                    out["error"] += error.tolist()
                    out["others"] += [np.flatnonzero(row).tolist() for row in near]
            return out

        return place

    schema = "node long, n long, label string, embedding array<float>, own int, codes binary, error double, others array<int>"
    placed = map_batches(classes.select("node", "n", F.col("label").cast("string").alias("label"), "embedding"), make, schema)
    return placed.withColumn("other", F.explode("others")).select(
        "label",
        F.least("own", "other").alias("la"),
        F.greatest("own", "other").alias("lb"),
        "node", "n", "embedding", "own", "codes", "error",
    )


def _dealt(listed: DataFrame) -> DataFrame:
    """Deals pairs of lists into pairs of blocks, so that a full list need not fit in one task."""
    sizes = listed.groupBy(*UNIT).agg(F.count("*").alias("size"))
    n_blocks = F.ceil(F.col("size") / BLOCK)
    return (
        listed.join(sizes, UNIT)
        .withColumn("blocks", n_blocks)
        .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
        .withColumn("met", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        .withColumn("ba", F.least("block", "met"))
        .withColumn("bb", F.greatest("block", "met"))
        .drop("size", "blocks", "met")
    )


def _linked(unit: dict, quantiser: Quantiser, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of one unit's rows with a cosine of at least `least`."""
    rows = unit_rows(unit["embedding"])
    own, block = np.array(unit["own"]), np.array(unit["block"])
    codes = np.frombuffer(b"".join(unit["codes"]), np.uint8).reshape(len(rows), -1)
    error = np.array(unit["error"])
    la, lb, ba, bb = (unit[name][0] for name in ("la", "lb", "ba", "bb"))
    sides = {(la, ba, lb, bb), (la, bb, lb, ba)} if la != lb else {(la, ba, lb, bb)}
    reach = math.sqrt(2 - 2 * least)
    found_i, found_j = [], []
    for list_i, block_i, list_j, block_j in sides:
        i = np.flatnonzero((own == list_i) & (block == block_i))
        j = np.flatnonzero((own == list_j) & (block == block_j))
        if not len(i) or not len(j):
            continue
        distance = np.sqrt(quantiser.table_distances(rows[i], quantiser.centroids[list_j], codes[j]))
        near_i, near_j = np.nonzero(distance <= reach + MARGIN + error[j][None, :])
        i, j = i[near_i], j[near_j]
        if (list_i, block_i) == (list_j, block_j):
            i, j = i[i < j], j[i < j]
        for at in range(0, len(i), PAIRS_AT_ONCE):
            a, b = i[at : at + PAIRS_AT_ONCE], j[at : at + PAIRS_AT_ONCE]
            close = np.einsum("ij,ij->i", rows[a], rows[b]) >= least
            found_i.append(a[close])
            found_j.append(b[close])
    if not found_i:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(found_i), np.concatenate(found_j)


DEALT = [*UNIT, "ba", "bb"]


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """The rows of each unit of a stream that is sorted by unit."""
    held: dict | None = None
    for batch in batches:
        rows = batch.to_pydict()
        keys = list(zip(*(rows[name] for name in DEALT), strict=True))
        start = 0
        for end in range(1, len(keys) + 1):
            if end < len(keys) and keys[end] == keys[start]:
                continue
            part = {name: values[start:end] for name, values in rows.items()}
            if held and tuple(held[name][0] for name in DEALT) == keys[start]:
                for name, values in part.items():
                    held[name] += values
            else:
                if held:
                    yield held
                held = part
            start = end
    if held:
        yield held


def _links(dealt: DataFrame, quantiser: Quantiser, least: float) -> DataFrame:
    """For every vector linked in a unit: how many rows it links with there, and the unit's root of it."""
    model = dealt.sparkSession.sparkContext.broadcast(quantiser)
    schema = pa.schema([("node", pa.int64()), ("links", pa.int64()), ("root", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for unit in _units(batches):
            i, j = _linked(unit, model.value, least)
            if not len(i):
                continue
            node, n = np.array(unit["node"]), np.array(unit["n"])
            order = np.argsort(node)
            rank = np.empty(len(node), np.int64)
            rank[order] = np.arange(len(node))
            links = np.zeros(len(node), np.int64)
            np.add.at(links, i, n[j])
            np.add.at(links, j, n[i])
            roots = node[order][local_roots(len(node), rank[i], rank[j])][rank]
            met = links > 0
            yield pa.RecordBatch.from_arrays([pa.array(x[met]) for x in (node, links, roots)], schema=schema)

    columns = [*DEALT, "node", "n", "embedding", "own", "block", "codes", "error"]
    sorted_units = dealt.select(*columns).repartition(*DEALT).sortWithinPartitions(*DEALT)
    return sorted_units.mapInArrow(run, "node long, links long, root long")


def vector_links(
    vectors: DataFrame, staging: Staging, least: float = LEAST_COSINE, slack: float | None = None
) -> DataFrame:
    """One row per row of `vectors`: `vec_id`, `n_links`, `component_id`, `kept`.

    Vectors of equal label and dimension link when their cosine in double
    precision is at least `least`. A null label or vector, an empty or zero one,
    and one with a null or non-finite component link with nothing. Equal vectors
    are compared once and counted as often as they occur; repeated rows count as
    vectors of their own. `component_id` is the smallest vec_id reachable, null if
    all are null. `slack` is how far beyond the plane between two cells a vector
    may have partners: by default the link distance, which loses none; less makes
    fewer probes and may lose links. Other columns are not read. An empty table
    gives no rows.
    """
    spark = vectors.sparkSession
    reach = math.sqrt(2 - 2 * least)
    given = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), "label", F.col("embedding").cast("array<float>").alias("embedding")
    )
    usable = given.where(_usable())
    key = ["label", "embedding"]
    classes = usable.groupBy(*key).agg(
        F.min("vec_id").alias("first"), F.count("*").alias("n"), F.min(F.xxhash64(*key)).alias("digest")
    )
    classes = staging.save(classes, "classes").withColumn("node", F.monotonically_increasing_id())
    classes = staging.save(classes, "numbered")
    found = spark.createDataFrame([], "node long, links long, root long")
    for (dim,) in classes.select(F.size("embedding")).distinct().collect():
        one = classes.where(F.size("embedding") == dim)
        quantiser = _fit(one, dim)
        listed = _listed(one, quantiser, reach if slack is None else slack)
        found = found.union(_links(_dealt(listed), quantiser, least))
    found = staging.save(found, "links")
    counted = found.groupBy("node").agg(F.sum("links").alias("links"))
    member = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")), staging)
    known = (
        classes.join(counted, "node", "left")
        .join(member, "node", "left")
        .withColumn("component", F.coalesce("component", "node"))
    )
    known = staging.save(known, "members")
    least_id = known.groupBy("component").agg(F.min("first").alias("component_id"))
    described = known.join(least_id, "component").select(
        *key, (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component_id"
    )
    linked = usable.join(described, key).select("vec_id", "n_links", "component_id")
    alone = given.where(f"NOT coalesce({_usable()}, false)").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return linked.union(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
