import json
from collections import Counter
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

import tillhouse as th
from tillhouse import sinks, storage
from tillhouse.plans import flows
from tillhouse.schemas import CUSTOMERS, DIM_CUSTOMER, DIM_PRODUCTS, ORDER_LINES, PRODUCTS_SOURCE
from tillhouse.sinks import releases as rel

DAY = date(2025, 10, 1)
NUMBERED = "key bigint, value string"


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), NUMBERED)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture
def schema(spark):
    return frame(spark).schema


@pytest.fixture
def kept(spark, staging):
    return sinks.Releases(spark, staging.path("warehouse") + "/releases")


def place(kept, name):
    return f"{kept.root.removesuffix('/releases')}/{name}"


def publish(kept, **tables):
    with kept.draft() as draft:
        for name, df in tables.items():
            draft.write(place(kept, name), df)
        return draft.publish()


def test_tables_of_a_release_change_together(spark, kept, schema):
    a, b = place(kept, "a"), place(kept, "b")
    assert kept.current().number == 0 and rows(kept.read(a, schema)) == []
    publish(kept, a=frame(spark, (1, "x")), b=frame(spark, (2, "y")))
    old = kept.current()
    with kept.draft() as draft:
        draft.write(a, frame(spark, (3, "z")))
        draft.write(b, frame(spark, (4, "w")))
        assert rows(kept.read(a, schema)) == [(1, "x")]
        draft.publish()
    assert rows(kept.read(a, schema)) == [(3, "z")] and rows(kept.read(b, schema)) == [(4, "w")]
    assert rows(kept.read(a, schema, old)) == [(1, "x")]
    publish(kept, b=frame(spark))
    assert rows(kept.read(a, schema)) == [(3, "z")] and rows(kept.read(b, schema)) == []


def test_a_plain_folder_is_taken_over(spark, kept, schema):
    sinks.replace_parquet(frame(spark, (1, "x")), place(kept, "a"))
    assert rows(kept.read(place(kept, "a"), schema)) == [(1, "x")]
    with kept.draft() as draft:
        draft.write(place(kept, "a"), draft.read(place(kept, "a"), schema).unionAll(frame(spark, (2, "y"))))
        assert rows(kept.read(place(kept, "a"), schema)) == [(1, "x")]
        draft.publish()
    assert rows(kept.read(place(kept, "a"), schema)) == [(1, "x"), (2, "y")]


def test_a_second_writer_of_the_same_tables_is_refused(spark, kept, schema):
    publish(kept, a=frame(spark, (1, "x")), b=frame(spark, (1, "x")), c=frame(spark, (1, "x")))
    first, second, third = kept.draft(), kept.draft(), kept.draft()
    first.write(place(kept, "a"), frame(spark, (2, "first")))
    second.read(place(kept, "a"), schema)
    second.write(place(kept, "b"), frame(spark, (2, "second")))
    third.write(place(kept, "c"), frame(spark, (2, "third")))
    first.publish()
    with pytest.raises(sinks.ConcurrentRelease, match="/a"), second:
        second.publish()
    third.publish()
    assert kept.current().number == 3
    assert [rows(kept.read(place(kept, t), schema)) for t in "abc"] == [[(2, "first")], [(1, "x")], [(2, "third")]]
    assert len(storage.child_names(spark, place(kept, "b"))) == 1


def test_a_release_that_is_not_written_to_its_end_is_not_read(spark, kept, schema, monkeypatch):
    publish(kept, a=frame(spark, (1, "x")))
    storage.create_new(spark, kept.path(2), '{"number": 2, "tab')
    monkeypatch.setattr(rel, "PATIENCE_SECONDS", 0.5)
    assert kept.current().number == 1
    with pytest.raises(sinks.ConcurrentRelease, match="being written"):
        publish(kept, a=frame(spark, (2, "y")))
    monkeypatch.setattr(rel, "GRACE_SECONDS", 0.0)
    assert publish(kept, a=frame(spark, (2, "y"))).number == 2
    assert rows(kept.read(place(kept, "a"), schema)) == [(2, "y")]


def test_lost_rows_and_other_columns_are_noticed(spark, kept, schema):
    with kept.draft() as draft, pytest.raises(RuntimeError, match="holds 1 rows, 2 were written"):
        draft.write(place(kept, "a"), frame(spark, (1, "x")), expected=2)
    with kept.draft() as draft, pytest.raises(Exception, match="(?i)column"):
        draft.write(place(kept, "a"), spark.range(1), schema)
    assert storage.child_names(spark, place(kept, "a")) == []


def test_old_releases_are_pruned_with_the_folders_only_they_use(spark, kept, schema):
    publish(kept, a=frame(spark, (0, "a")), b=frame(spark, (0, "b")))
    kept.draft().write(place(kept, "a"), frame(spark, (9, "left behind")))
    for k in range(1, 5):
        publish(kept, a=frame(spark, (k, "a")))
    kept.prune(2)
    assert kept.numbers() == [4, 5]
    assert len(storage.child_names(spark, place(kept, "a"))) == 2
    assert rows(kept.read(place(kept, "a"), schema)) == [(4, "a")]
    assert rows(kept.read(place(kept, "b"), schema)) == [(0, "b")]


def changes(kept, df, schema, size=10):
    with kept.draft() as draft:
        result = draft.write_changes(place(kept, "t"), df, schema, "key", size)
        draft.publish()
    return result


def bytes_of(spark, folder):
    return sum(size for _, size, _ in storage.file_marks(spark, folder))


def test_only_buckets_with_changes_are_written(spark, kept, schema, staging):
    first = staging.save(spark.range(1000).selectExpr("id AS key", "repeat(string(id), 50) AS value"), "first")
    changes(kept, first, schema)
    before = kept.current().tables[place(kept, "t")]
    assert len(before.folders) == 100
    # One row in a hundred: ten long known ones close to each other, and ten new ones.
    changed = staging.save(
        spark.range(500, 510).unionAll(spark.range(1000, 1010)).selectExpr("id AS key", "'new' AS value"), "changed"
    )
    got = changes(kept, changed, schema)
    after = kept.current().tables[place(kept, "t")]
    moved = {b for b in after.folders if after.folders[b] != before.folders.get(b)}
    assert moved == {"50", "100"}
    expected = {k: str(k) * 50 for k in range(1000)} | {k: "new" for k in [*range(500, 510), *range(1000, 1010)]}
    assert dict(rows(got)) == dict(rows(kept.read(place(kept, "t"), schema))) == expected
    newest = next(iter(after.folders[b] for b in moved)).rsplit("/", 1)[0]
    assert bytes_of(spark, newest) < 0.05 * sum(bytes_of(spark, p) for p in before.paths)
    kept.prune(1)
    assert dict(rows(kept.read(place(kept, "t"), schema))) == expected


def test_a_table_written_whole_goes_into_buckets_at_its_next_change(spark, kept, schema, staging):
    publish(kept, t=frame(spark, *[(k, "old") for k in range(25)]))
    changes(kept, staging.save(frame(spark, (3, "new"), (25, "new")), "changed"), schema)
    assert sorted(kept.current().tables[place(kept, "t")].folders) == ["0", "1", "2"]
    assert dict(rows(kept.read(place(kept, "t"), schema))) == {k: "old" for k in range(25)} | {3: "new", 25: "new"}
    changes(kept, staging.save(frame(spark), "none"), schema)
    assert kept.read(place(kept, "t"), schema).count() == 26


def test_a_table_in_buckets_is_shown_by_a_view_of_its_columns(spark, kept, schema, staging):
    def show():
        sinks.show_table(spark, "bucketed", schema, kept.current().tables[place(kept, "t")], place(kept, "t"))
        return dict(rows(spark.table("bucketed")))

    publish(kept, t=frame(spark, *[(k, "old") for k in range(15)]))
    assert len(show()) == 15 and spark.catalog.getTable("bucketed").tableType == "EXTERNAL"
    changes(kept, staging.save(frame(spark, (30, "new")), "changed"), schema)
    assert len(show()) == 16 and spark.table("bucketed").columns == ["key", "value"]
    changes(kept, staging.save(frame(spark, (2, "again")), "changed"), schema)
    assert show()[2] == "again" and len(show()) == 16
    assert spark.catalog.getTable("bucketed_buckets").tableType == "EXTERNAL"
    publish(kept, t=frame(spark, (1, "whole")))
    assert show() == {1: "whole"}
    sinks.drop_table(spark, "bucketed")
    sinks.drop_table(spark, "bucketed_buckets")


# Flows


def customers(spark, *ids):
    return spark.createDataFrame(
        [(i, 30, "F", "A", date(2020, 1, 1)) for i in ids],
        "customer_id int, age int, gender string, city string, registration_date date",
    )


def products(spark, *pairs):
    return spark.createDataFrame(
        [(i, "c", "s", p and Decimal(p), "d") for i, p in pairs],
        "product_id int, category string, sub_category string, current_price decimal(10,2), description string",
    )


def logistics(spark):
    return spark.sql(
        "SELECT 1 AS order_id, TIMESTAMP_NTZ'2025-01-03 01:00:00' AS actual_delivery_date, "
        "TIMESTAMP_NTZ'2025-01-01 23:00:00' AS estimated_delivery_date, "
        "CAST(1.5 AS DECIMAL(10,2)) AS shipping_cost, 4 AS warehouse_id"
    )


def write_orders(folder, n, broken=()):
    item = {"product_id": 1, "sales_quantity": 1, "price_per_unit": 2.0}
    order = {"customer_id": 1, "order_date": "2025-09-01", "payment_status": "paid", "items": [item]}
    lines = [json.dumps({"order_id": k, **order}) for k in range(n)] + list(broken)
    (folder / "orders.json").write_text("\n".join(lines))
    return str(folder / "*.json")


@pytest.fixture
def paths(staging):
    return th.WarehousePaths(staging.path("warehouse"))


class Killed(BaseException):
    pass


class Steps:
    """Counts the writes to the file system and the catalog, and stops the run before one of them."""

    def __init__(self, monkeypatch):
        self.at, self.stop = 0, None
        for owner, name in (
            (DataFrameWriter, "parquet"),
            (storage, "create_new"),
            (storage, "delete"),
            (flows, "show_table"),
        ):
            monkeypatch.setattr(owner, name, self.counted(getattr(owner, name)))

    def counted(self, function):
        def run(*args, **named):
            if self.at == self.stop:
                raise Killed
            self.at += 1
            return function(*args, **named)

        return run

    def run(self, stop, function):
        self.at, self.stop = 0, stop
        try:
            function()
        except Killed:
            return False
        finally:
            self.stop = None
        return True


def state(spark, paths):
    current = th.releases(spark, paths)
    release = current.current()
    shown = [(paths.customers, flows.CUSTOMERS), (paths.products, PRODUCTS_SOURCE)]
    shown += [(paths.dim_customer, DIM_CUSTOMER), (paths.dim_products, DIM_PRODUCTS)]
    return [Counter(current.read(table, schema, release).collect()) for table, schema in shown]


def test_a_run_stopped_before_any_step_leaves_all_tables_old_or_all_new(spark, paths, tmp_path, monkeypatch):
    monkeypatch.setattr(rel, "GRACE_SECONDS", 0.0)
    th.run_orders(spark, paths, write_orders(tmp_path, 3))
    th.run_dimensions(spark, paths, customers(spark, 1), products(spark, (1, "1.00")), DAY, date(2025, 1, 1))
    old = state(spark, paths)
    steps = Steps(monkeypatch)

    def again():
        th.run_dimensions(spark, paths, customers(spark, 1, 2), products(spark, (1, "2.00"), (None, "3.00")), DAY, date(2025, 1, 2))

    seen, stop = [], 0
    while not steps.run(stop, again):
        seen.append(state(spark, paths))
        if seen[-1] != old:
            break
        stop += 2
    new = state(spark, paths)
    assert len(seen) >= 5 and all(s == old for s in seen[:-1])
    assert all(a != b for a, b in zip(old, new))
    # Past publishing the run may die at any step: the same tables, and the catalog can be put right.
    for later in range(stop + 1, stop + 4):
        steps.run(later, again)
        assert state(spark, paths) == new
    th.show_release(spark, paths, th.releases(spark, paths).current())
    assert Counter(spark.table("Dim_Products").collect()) == new[3]
    assert Counter(spark.table("Dim_Customer").collect()) == new[2]


def test_a_run_started_again_goes_on_where_it_was_stopped(spark, paths, tmp_path, monkeypatch):
    monkeypatch.setattr(rel, "GRACE_SECONDS", 0.0)
    raw = write_orders(tmp_path, 4)
    run, ran = {}, []
    for step in ("run_orders", "run_dimensions", "run_logistics"):
        run[step] = getattr(flows, step)
        monkeypatch.setattr(flows, step, lambda *a, _step=step, **k: (ran.append(_step), run[_step](*a, **k))[1])

    def all_steps(price="1.00"):
        frames = customers(spark, 1, 2), products(spark, (1, price)), logistics(spark)
        return th.run_all(spark, paths, raw, *frames, DAY, date(2025, 1, 1))

    steps = Steps(monkeypatch)
    stop = 0
    while not steps.run(stop, all_steps):
        stop += 6
    current = th.releases(spark, paths).current()
    assert set(current.steps) == {"orders", "dimensions", "logistics"} and current.number == 3
    assert all_steps() == []
    assert ran.count("run_orders") >= 2 and ran[-1] == "run_logistics"
    finished = [step for step, again in zip(ran, ran[1:]) if step != again]
    assert finished == ["run_orders", "run_dimensions"]
    assert spark.table("staging_orderlines").count() == 4 and spark.table("Dim_Customer").count() == 2
    assert all_steps("2.00") == ["dimensions"]
    write_orders(tmp_path, 5)
    assert all_steps("2.00") == ["orders", "dimensions"]
    assert spark.table("staging_orderlines").count() == 5


def test_malformed_documents_are_kept_on_request(spark, paths, tmp_path):
    raw = write_orders(tmp_path, 3, broken=["{broken", '{"order_id": "x"}'])
    with pytest.raises(Exception, match="(?i)malformed"):
        th.run_orders(spark, paths, raw)
    assert th.run_orders(spark, paths, raw, corrupt="reject").count() == 3
    rejected = th.read_published(spark, paths, paths.rejected_documents)
    assert sorted(r[0] for r in rejected.collect()) == ['{"order_id": "x"}', "{broken"]
    counts = th.read_published(spark, paths, paths.reject_counts).collect()
    assert [tuple(r) for r in counts] == [("documents", 5, 2)]
    th.run_dimensions(spark, paths, customers(spark, 1), products(spark, (1, "1.00"), (None, "2.00")), DAY, date(2025, 1, 1))
    counts = th.read_published(spark, paths, paths.reject_counts).collect()
    assert [tuple(r) for r in counts] == [("documents", 5, 2), ("order_lines", 3, 0), ("products", 2, 1)]
    assert th.run_orders(spark, paths, write_orders(tmp_path, 2), schema=None, corrupt="reject").count() == 2
    with pytest.raises(ValueError, match="corrupt"):
        th.run_orders(spark, paths, raw, corrupt="ignore")


def test_counted_lines_are_read_in_their_five_columns(spark, paths, tmp_path, monkeypatch):
    th.run_orders(spark, paths, write_orders(tmp_path, 3))
    plans = []
    kept = flows.dim_customer
    monkeypatch.setattr(flows, "dim_customer", lambda c, lines, *a: (plans.append(lines), kept(c, lines, *a))[1])
    th.run_dimensions(spark, paths, customers(spark, 1), products(spark, (1, "1.00")), DAY, date(2025, 1, 1))
    text = plans[0].groupBy("customer_id").agg(F.max("order_date"))._jdf.queryExecution().executedPlan().toString()
    assert "order_line_id" not in text and "payment_status" not in text
    assert ORDER_LINES.names[0] == "order_line_id" and CUSTOMERS.names[0] == "customer_id"


def test_dimensions_of_nothing(spark, paths):
    nothing = customers(spark, 1).limit(0), products(spark, (1, "1.00")).limit(0)
    for day in (1, 2):
        dimension, versions = th.run_dimensions(spark, paths, *nothing, DAY, date(2025, 1, day))
        assert dimension.count() == versions.count() == 0
    assert spark.table("Dim_Products").count() == 0
    counts = th.read_published(spark, paths, paths.reject_counts).collect()
    assert [tuple(r) for r in counts] == [("order_lines", 0, 0), ("products", 0, 0)]
    empty = spark.createDataFrame([], nothing[1].schema), spark.createDataFrame([], nothing[0].schema)
    dimension, versions = th.run_dimensions(spark, paths, empty[1], empty[0], DAY, date(2025, 1, 3))
    assert dimension.count() == versions.count() == 0
