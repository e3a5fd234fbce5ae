"""Rows at given places of a total order, without sorting the table.

For each place the rows in question are narrowed down: a quantile sketch names
two values that should lie close around it, exact counts tell on which side of
them, between them or on one of them it really is, and only those rows stay in
question. A value that very many rows share is taken apart by the next field of
the key. What is left, at most `FEW` rows a place, goes to the driver. Each step
is one aggregation over the narrow rows for all places at once; nothing is
shuffled but the sketches and counts.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Row

GRID = 1_000
ACCURACY = 10_000
FEW = 4_000
SHARES = ", ".join(f"{k / GRID}D" for k in range(GRID + 1))


@dataclass(frozen=True)
class Search:
    """The place `rank` among `size` rows that meet `rows`, which agree in all key fields before `level`."""

    key: int
    rank: int
    size: int
    level: int = 0
    rows: str = "true"

    def within(self, more: str, before: int, size: int, level: int) -> Search:
        return replace(self, rank=self.rank - before, size=size, level=level, rows=f"{self.rows} AND {more}")


def select_places(
    df: DataFrame,
    keys: Sequence[Column],
    fields: Sequence[str],
    places: Sequence[tuple[int, int]],
    total: int,
    first: Sequence[int] = (),
) -> list[Row]:
    """The keys at `places` of the `total` rows, each a key's number and a 1-based place in its order.

    A key is a struct of numbers with the given fields; NULL comes first, NaN is
    not allowed. `first` names all values of the first field, in order, where
    they are few and known. `df` is read several times; hand in a stored frame.
    """
    narrow = df.select(*[key.alias(f"key{k}") for k, key in enumerate(keys)])
    open_ = {n: Search(key, rank, total) for n, (key, rank) in enumerate(places)}
    done: dict[int, Search] = {}
    known = list(first)
    while open_:
        for n, search in list(open_.items()):
            if search.size <= FEW or search.level == len(fields):
                done[n] = open_.pop(n)
        if open_:
            open_ = _by_values(narrow, fields, open_, known) if known else _by_sketch(narrow, fields, open_)
            known = []
    return _found(narrow, fields, done)


def _literal(value: float | int) -> str:
    return f"double('{value!r}')" if isinstance(value, float) else f"{value}L"


def _by_values(narrow: DataFrame, fields: Sequence[str], open_: dict[int, Search], values: list[int]) -> dict[int, Search]:
    """One step of each search by counting the known values of its field."""
    used = sorted({search.key for search in open_.values()})
    parts = {k: [f"key{k}.{fields[0]} = {_literal(value)}" for value in values] for k in used}
    counted = narrow.selectExpr(*[f"count_if({part}) AS c{k}_{n}" for k in used for n, part in enumerate(parts[k])]).first()
    return {
        n: _part_of(search, 0, [(part, counted[f"c{search.key}_{k}"], True) for k, part in enumerate(parts[search.key])])
        for n, search in open_.items()
    }


def _part_of(search: Search, before: int, parts: list[tuple[str, int, bool]]) -> Search:
    """The search within that of its parts, in order, that holds the place; each has a size and may be of one value."""
    for part, size, alike in parts:
        if search.rank <= before + size:
            return search.within(part, before, size, search.level + alike)
        before += size
    raise AssertionError("the parts hold all rows")


def _by_sketch(narrow: DataFrame, fields: Sequence[str], open_: dict[int, Search]) -> dict[int, Search]:
    """One step of each search by quantiles and counts."""
    # Searches that still have the same rows in question share their sketch.
    names: dict[tuple[str, str], str] = {}
    for search in open_.values():
        names.setdefault((_field(search, fields), search.rows), f"s{len(names)}")
    sketches = [
        sql
        for (field, rows), name in names.items()
        for sql in (
            f"percentile_approx(CASE WHEN {rows} THEN {field} END, array({SHARES}), {ACCURACY}) AS {name}_values",
            f"count_if({rows} AND {field} IS NULL) AS {name}_nulls",
        )
    ]
    sketched = narrow.selectExpr(*sketches).first()

    parts: dict[int, list[tuple[str, bool]]] = {}
    nulls: dict[int, int] = {}
    for n, search in open_.items():
        field = _field(search, fields)
        name = names[field, search.rows]
        values, nulls[n] = sketched[f"{name}_values"], sketched[f"{name}_nulls"]
        parts[n] = []
        if values:
            share = (search.rank - nulls[n]) / (search.size - nulls[n])
            margin = 2 / ACCURACY
            low = _literal(values[max(0, int((share - margin) * GRID))])
            high = _literal(values[min(GRID, int((share + margin) * GRID) + 1)])
            parts[n] = [(f"{field} < {low}", False), (f"{field} = {low}", True)]
            if low != high:
                parts[n] += [(f"{field} > {low} AND {field} < {high}", False), (f"{field} = {high}", True)]
            parts[n].append((f"{field} > {high}", False))
    counts = [
        f"count_if({open_[n].rows} AND {part}) AS c{n}_{k}" for n in open_ for k, (part, _) in enumerate(parts[n])
    ]
    counted = narrow.selectExpr(*counts).first() if counts else None
    stepped = {}
    for n, search in open_.items():
        sized = [(part, counted[f"c{n}_{k}"], alike) for k, (part, alike) in enumerate(parts[n])]
        stepped[n] = _part_of(search, 0, [(f"{_field(search, fields)} IS NULL", nulls[n], True), *sized])
    return stepped


def _field(search: Search, fields: Sequence[str]) -> str:
    return f"key{search.key}.{fields[search.level]}"


def _found(narrow: DataFrame, fields: Sequence[str], done: dict[int, Search]) -> list[Row]:
    """Fetches the few rows left in question and picks each place; of rows alike in all fields one is fetched."""

    def order(key: Row) -> tuple:
        return tuple((value is not None, value if value is not None else 0) for value in key)

    found: dict[int, Row] = {}
    alike = {n: search for n, search in done.items() if search.level == len(fields)}
    if alike:
        row = narrow.selectExpr(
            *[f"first(CASE WHEN {s.rows} THEN key{s.key} END, true) AS p{n}" for n, s in alike.items()]
        ).first()
        found |= {n: row[f"p{n}"] for n in alike}
    few = {n: search for n, search in done.items() if n not in alike}
    if few:
        hits = ", ".join(f"CASE WHEN {s.rows} THEN struct({n} AS place, key{s.key} AS key) END" for n, s in few.items())
        held: dict[int, list[Row]] = {n: [] for n in few}
        for row in narrow.selectExpr(f"explode(filter(array({hits}), hit -> hit IS NOT NULL)) AS hit").collect():
            held[row.hit.place].append(row.hit.key)
        found |= {n: sorted(held[n], key=order)[few[n].rank - 1] for n in few}
    return [found[n] for n in sorted(done)]
