import numpy as np
import pytest

from tillhouse.llm import vector_links as module
from tillhouse.llm.vector_links import Quantiser, unit_rows, vector_links

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows):
    """Per row: links and smallest id reachable."""
    def usable(row):
        v = row[1]
        return row[2] is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)

    near = [[] for _ in rows]
    for i, a in enumerate(rows):
        for j, b in enumerate(rows):
            if i != j and usable(a) and usable(b) and a[2] == b[2] and len(a[1]) == len(b[1]):
                x, y = np.array(a[1], np.float32).astype(float), np.array(b[1], np.float32).astype(float)
                if x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= 0.98:
                    near[i].append(j)
    out = []
    for i, row in enumerate(rows):
        seen, front = {i}, [i]
        while front:
            new = [j for j in near[front.pop()] if j not in seen]
            seen.update(new)
            front += new
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        least = min(ids) if ids else None
        out.append((-1 if row[0] is None else row[0], len(near[i]), least, row[0] is not None and row[0] == least))
    return sorted(out, key=str)


def found(spark, staging, rows, **more):
    result = vector_links(spark.createDataFrame(rows, SCHEMA), staging, **more).collect()
    return sorted(((-1 if r.vec_id is None else r.vec_id, r.n_links, r.component_id, r.kept) for r in result), key=str)


def clustered(n, dim=16, labels=2, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, dim))
    rows = []
    for k in range(n):
        v = centres[rng.integers(12)] + rng.normal(size=dim) * rng.choice([0.05, 0.15, 1.0])
        rows.append((k, [float(x) for x in v.astype(np.float32)], int(rng.integers(labels))))
    return rows


def test_odd_vectors(spark, staging):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0], 1), (1, [2.0, 0.0], 1), (2, [1.0, 0.01], 1), (3, [1.0, 0.0], 2), (4, [1.0, 0.0], None),
        (5, None, 1), (6, [0.0, 0.0], 1), (7, [nan, 1.0], 1), (8, [inf, 1.0], 1), (9, [1.0, None], 1), (10, [], 1),
        (11, [1.0, 0.0, 0.0], 1), (12, [1.0, 0.0, 0.1], 1), (None, [5.0, 0.0], 1), (None, [0.0, 1.0], 1), (13, [-1.0, 0.0], 1),
    ]
    assert found(spark, staging, rows) == brute(rows)
    assert found(spark, staging, rows + rows) == brute(rows + rows)


def test_empty_table(spark, staging):
    assert found(spark, staging, []) == []


@pytest.mark.parametrize("lists", [1, 7])
def test_against_brute_force(spark, staging, monkeypatch, lists):
    rows = clustered(400)
    monkeypatch.setattr(module, "ROWS_PER_LIST", -(-400 // lists))
    monkeypatch.setattr(module, "BLOCK", 32)  # full lists are dealt into several blocks
    assert found(spark, staging, rows) == brute(rows)


def test_copies_count_as_often_as_they_occur(spark, staging):
    rows = clustered(60)
    rows += [(1000 + k, rows[0][1], rows[0][2]) for k in range(150)]
    assert found(spark, staging, rows) == brute(rows)


def test_table_distances_and_bounds():
    rows = unit_rows([r[1] for r in clustered(300)])
    quantiser = Quantiser.fit(rows, 6)
    lists = module._nearest(rows, quantiser.centroids)
    codes, error = quantiser.encode(rows, lists)
    for number in range(len(quantiser.centroids)):
        inside = lists == number
        table = np.sqrt(quantiser.table_distances(rows, quantiser.centroids[number], codes[inside]))
        exact = np.linalg.norm(rows[:, None] - rows[inside][None], axis=2)
        assert (np.abs(table - exact) <= error[inside][None] + 1e-9).all()
    probes = quantiser.probes(rows, lists, 0.2)
    i, j = np.nonzero(rows @ rows.T >= 0.98)
    assert probes[i, lists[j]].all()


def test_fewer_probes_keep_most_links(spark, staging, monkeypatch):
    rows = clustered(400)
    monkeypatch.setattr(module, "ROWS_PER_LIST", 60)
    exact, fast = brute(rows), found(spark, staging, rows, slack=0.1)
    assert sum(r[1] for r in fast) >= 0.9 * sum(r[1] for r in exact)
