"""Type 2 slowly changing dimension: merge a full snapshot into versioned rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from tillhouse import functions as fn
from tillhouse.metrics import observed
from tillhouse.operators.ranking import dense_key
from tillhouse.staging import Staging

OPEN_END = date(9999, 12, 31)
START = "dw_start_date"
END = "dw_end_date"
ACTION = "action"
INSERTED = ("new", "new_version")
POLICIES = ("safe", "reference")
SIDE = "_side"
DIMENSION, SNAPSHOT = 0, 1


class DuplicateKeyError(ValueError):
    """The snapshot, or the open part of the dimension, repeats a business key."""


def current_rows(dim: DataFrame) -> DataFrame:
    """Versions still open; the date comparison reaches the Parquet scan."""
    return dim.where(F.col(END) == F.lit(OPEN_END))


def quarantine(snapshot: DataFrame, key: str = "product_id") -> DataFrame:
    """Snapshot rows the safe policy leaves out, because they have no key."""
    return snapshot.where(F.col(key).isNull())


def classify(
    open_rows: DataFrame,
    snapshot: DataFrame,
    as_of: date,
    policy: str = "safe",
    key: str = "product_id",
    surrogate: str = "product_key",
    tracked: Sequence[str] = ("product_price",),
    numeric_text: Sequence[str] = ("product_price",),
) -> DataFrame:
    """The dimension's next open and newly closed rows, each with its `action`.

    Inserted rows still have a NULL surrogate key.

    `safe` closes rows missing from the snapshot, treats NULL as a comparable
    value and compares `numeric_text` columns as numbers; keys have to be unique.
    `reference` compares text with ordinary SQL equality, so pairs with a NULL on
    either side drop out, forgets missing rows, and writes one row per matching
    pair when keys repeat. There a left join is enough, and adaptive execution
    can split its snapshot side if one key is hot.
    """
    if policy not in POLICIES:
        raise ValueError(f"policy must be one of {POLICIES}, not {policy!r}")
    names = (key, surrogate, tuple(tracked))
    if policy == "reference":
        return _pairs(open_rows, snapshot, as_of, *names)
    marks = _marks(open_rows, snapshot, key, tracked, numeric_text).where("NOT _repeated AND action IS NOT NULL")
    nameless = marks.where(F.col(ACTION).isin(*INSERTED)).withColumn(
        surrogate, F.lit(None).cast(open_rows.schema[surrogate].dataType)
    )
    return _next_rows(open_rows, snapshot, marks, nameless, as_of, key, surrogate)


def _opened(row: Column, surrogate: Column, as_of: date, action: str, surrogate_name: str) -> Column:
    return (
        row.withField(surrogate_name, surrogate)
        .withField(START, F.lit(as_of))
        .withField(END, F.lit(OPEN_END))
        .withField(ACTION, F.lit(action))
    )


def _pairs(
    open_rows: DataFrame, snapshot: DataFrame, as_of: date, key: str, surrogate: str, tracked: Sequence[str]
) -> DataFrame:
    """One join; every joined pair becomes zero, one or two rows."""
    types = {f.name: f.dataType for f in open_rows.schema.fields}
    attributes = [c for c in open_rows.columns if c not in (surrogate, START, END)]
    old, new = F.col("old"), F.col("new")

    def opened(row: Column, action: str) -> Column:
        return _opened(row, F.lit(None).cast(types[surrogate]), as_of, action, surrogate)

    unchanged = old.withField(ACTION, F.lit("unchanged"))
    expired = old.withField(END, F.lit(as_of)).withField(ACTION, F.lit("expired"))
    changed = F.array(expired, opened(new, "new_version"))
    same = reduce(and_, [old[c] == new[c] for c in tracked])
    # A NULL on either side makes the comparison NULL: no row.
    outcome = F.when(old.isNull(), F.array(opened(new, "new"))).when(same, F.array(unchanged)).when(~same, changed)

    old_row = F.struct(*attributes, surrogate, START, END).alias("old")
    new_row = F.struct(*[F.col(c).cast(types[c]).alias(c) for c in attributes]).alias("new")
    has_key = F.col(key).isNotNull()
    joined = (
        snapshot.where(has_key)
        .select(key, new_row)
        .join(open_rows.where(has_key).select(key, old_row), key, "left")
    )
    # Rows without a key match nothing; keeping them out of the join keeps them
    # from piling up in one shuffle partition.
    blank = F.struct(*[F.lit(None).cast(types[c]).alias(c) for c in attributes])
    keyless_new = snapshot.where(~has_key).select(new_row)
    keyless_old = open_rows.where(~has_key).select(surrogate)
    rows = reduce(
        DataFrame.unionAll,
        [
            joined.select(F.explode(outcome).alias("row")),
            keyless_new.select(opened(new, "new").alias("row")),
            keyless_old.select(opened(blank, "new").alias("row")),
        ],
    )
    return rows.select(*[f"row.{c}" for c in open_rows.columns], f"row.{ACTION}")


def _marks(
    open_rows: DataFrame, snapshot: DataFrame, key: str, tracked: Sequence[str], numeric_text: Sequence[str]
) -> DataFrame:
    """What becomes of each key: `key`, `side`, `repeated`, `action`, a row for each keyed row of both sides.

    Both sides' keys and tracked values are grouped by key in one shuffle, where
    an open row comes right before its successor. So the group tells who is
    missing, who is new, who differs and which keys repeat, without a join:
    repeated keys cannot fan out. `action` is NULL where the snapshot says
    nothing new. Other columns are not read.
    """
    types = {f.name: f.dataType for f in open_rows.schema.fields}
    used = list(dict.fromkeys([key, *tracked]))

    def narrow(df: DataFrame, side: int) -> DataFrame:
        values = [F.col(c).cast(types[c]).alias(c) for c in used]
        return df.where(F.col(key).isNotNull()).select(*values, F.lit(side).alias(SIDE))

    by_key = Window.partitionBy(key).orderBy(SIDE)
    is_new = F.col(SIDE) == SNAPSHOT

    def other(column: str) -> Column:
        return F.when(is_new, F.lag(column).over(by_key)).otherwise(F.lead(column).over(by_key))

    def same_value(column: str) -> Column:
        own, its = F.col(column), F.col(f"_other_{column}")
        if column not in numeric_text:
            return own.eqNullSafe(its)
        return own.eqNullSafe(its) | fn.price_text(own).eqNullSafe(fn.price_text(its))

    grouped = narrow(open_rows, DIMENSION).unionAll(narrow(snapshot, SNAPSHOT)).select(
        "*",
        (other(SIDE) != F.col(SIDE)).alias("_met"),
        F.coalesce(F.lag(SIDE).over(by_key) == F.col(SIDE), F.lit(False)).alias("_repeated"),
        *[other(c).alias(f"_other_{c}") for c in tracked],
    )
    met = F.coalesce("_met", F.lit(False))
    same = reduce(and_, [same_value(c) for c in tracked])
    action = (
        F.when(~is_new & ~(met & same), "expired").when(is_new & ~met, "new").when(is_new & ~same, "new_version")
    )
    return grouped.select(key, SIDE, "_repeated", action.alias(ACTION))


def _next_rows(
    open_rows: DataFrame,
    snapshot: DataFrame,
    marks: DataFrame,
    numbered: DataFrame,
    as_of: date,
    key: str,
    surrogate: str,
    changed_only: bool = False,
) -> DataFrame:
    """Open rows, closed where marked, and the rows of the `numbered` keys of the snapshot."""
    types = {f.name: f.dataType for f in open_rows.schema.fields}
    attributes = [c for c in open_rows.columns if c not in (surrogate, START, END)]
    has_key = F.col(key).isNotNull()
    closing = marks.where(F.col(ACTION) == "expired").select(key, F.lit(True).alias("_closing"))
    # Rows without a key match nothing, and are closed without joining.
    kept = open_rows.where(has_key).join(closing, key, "inner" if changed_only else "left").unionByName(
        open_rows.where(~has_key).withColumn("_closing", F.lit(True))
    )
    new = snapshot.where(has_key).select(*[F.col(c).cast(types[c]).alias(c) for c in attributes])
    return kept.select(
        *[c for c in open_rows.columns if c != END],
        F.when(F.col("_closing"), F.lit(as_of)).otherwise(F.col(END)).alias(END),
        F.when(F.col("_closing"), "expired").otherwise("unchanged").alias(ACTION),
    ).select(*open_rows.columns, ACTION).unionByName(
        new.join(numbered.select(key, surrogate, ACTION), key).withColumns({START: F.lit(as_of), END: F.lit(OPEN_END)})
    )


@dataclass(frozen=True)
class Changes:
    """What a snapshot changes in a dimension, staged: closed and inserted rows, and how many there are.

    `marks` has the keys whose open row closes, `numbered` those inserted with their surrogate keys.
    """

    marks: DataFrame
    numbered: DataFrame
    counts: dict[str, int]


def find_changes(
    dim: DataFrame,
    snapshot: DataFrame,
    as_of: date,
    key: str = "product_id",
    surrogate: str = "product_key",
    tracked: Sequence[str] = ("product_price",),
    numeric_text: Sequence[str] = ("product_price",),
    staging: Staging | None = None,
) -> Changes:
    """Which keys the `safe` policy closes and inserts, with dense keys above the largest one in use.

    Reads keys and tracked values only. Their grouping also counts repeated
    keys, which raise before any row is joined. Only inserted keys are sorted.
    """
    staging = staging or Staging(snapshot.sparkSession)
    open_rows = current_rows(dim)
    used = dim.agg(F.max(surrogate).alias("key"), F.max(START).alias("start")).first()
    if used.start is not None and used.start > as_of:
        raise ValueError(f"run date {as_of} is before the newest version's start {used.start}")
    first_key = 0 if used.key is None else used.key + 1

    counted = Observation()
    sides = {"dimension": DIMENSION, "snapshot": SNAPSHOT}
    marked = _marks(open_rows, snapshot, key, tracked, numeric_text).observe(
        counted,
        *[F.count_if(F.col("_repeated") & (F.col(SIDE) == side)).alias(name) for name, side in sides.items()],
        *[F.count_if(F.col(ACTION) == action).alias(action) for action in ("expired", *INSERTED)],
    )
    marks = staging.save(marked.where("NOT _repeated AND action IS NOT NULL").select(key, ACTION), "marks")
    counts = observed(counted, dict.fromkeys([*sides, "expired", *INSERTED], 0))
    for name, df in (("dimension", open_rows), ("snapshot", snapshot)):
        if counts.pop(name):
            repeats = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n"))
            example = repeats.where("n > 1").first()
            raise DuplicateKeyError(f"{key} {example[key]} occurs {example.n} times in the {name}")
    inserted = marks.where(F.col(ACTION).isin(*INSERTED))
    return Changes(marks, dense_key(inserted, [key], first_key, surrogate, staging), counts)


def changed_rows(
    dim: DataFrame,
    snapshot: DataFrame,
    changes: Changes,
    as_of: date,
    key: str = "product_id",
    surrogate: str = "product_key",
) -> DataFrame:
    """The closed and inserted rows alone, each with its `action`; a closed row keeps its surrogate key."""
    open_rows = current_rows(dim)
    return _next_rows(open_rows, snapshot, changes.marks, changes.numbered, as_of, key, surrogate, changed_only=True)


def scd2_merge(
    dim: DataFrame,
    snapshot: DataFrame,
    as_of: date | None = None,
    policy: str = "safe",
    key: str = "product_id",
    surrogate: str = "product_key",
    tracked: Sequence[str] = ("product_price",),
    numeric_text: Sequence[str] = ("product_price",),
    staging: Staging | None = None,
) -> DataFrame:
    """The whole next dimension, with an `action` column saying what became of each row.

    Only inserted rows are sorted, to give them keys above the largest one in
    use. `safe` finds the changed keys first and stages nothing else: whole rows
    meet the changed keys alone, by broadcast while those are few. It also
    carries closed versions over as `history`, without joining them. `reference`
    loses them, and stages its pairs.
    """
    if policy not in POLICIES:
        raise ValueError(f"policy must be one of {POLICIES}, not {policy!r}")
    spark = snapshot.sparkSession
    staging = staging or Staging(spark)
    as_of = as_of or spark.range(1).select(F.current_date().alias("today")).first().today
    open_rows = current_rows(dim)
    if policy == "safe":
        found = find_changes(dim, snapshot, as_of, key, surrogate, tracked, numeric_text, staging)
        history = dim.where(~F.col(END).eqNullSafe(F.lit(OPEN_END))).withColumn(ACTION, F.lit("history"))
        return _next_rows(open_rows, snapshot, found.marks, found.numbered, as_of, key, surrogate).unionByName(history)

    used = dim.agg(F.max(surrogate).alias("key")).first().key
    staged = staging.save(_pairs(open_rows, snapshot, as_of, key, surrogate, tracked), "merge")
    is_inserted = F.col(ACTION).isin(*INSERTED)
    # Several rows may be inserted for one key.
    order = [key, *[c for c in snapshot.columns if c != key], ACTION]
    first_key = 0 if used is None else used + 1
    inserted = dense_key(staged.where(is_inserted).drop(surrogate), order, first_key, surrogate, staging)
    return staged.where(~is_inserted).unionByName(inserted)
