import json
from datetime import date, datetime, timedelta

import duckdb
import pyarrow as pa
import pytest
from pyspark.sql import Row

from tillhouse import sources
from tillhouse.schemas import RAW_ORDERS

DOCUMENTS = [
    {
        "order_id": i,
        "customer_id": 5,
        "order_date": "2025-01-01",
        "payment_status": "paid",
        "items": [{"product_id": 1, "sales_quantity": 2, "price_per_unit": 3.5}],
    }
    for i in range(3)
]


def write(tmp_path, name, text):
    path = tmp_path / name
    path.write_text(text)
    return str(path)


def ids(df):
    return sorted(r.order_id for r in df.collect())


def test_line_delimited_documents(spark, tmp_path):
    path = write(tmp_path, "a.json", "\n".join(map(json.dumps, DOCUMENTS)))
    orders = sources.read_orders_json(spark, path)
    assert orders.schema == RAW_ORDERS
    assert ids(orders) == [0, 1, 2]


def test_absent_fields_are_null(spark, tmp_path):
    path = write(tmp_path, "a.json", '{"order_id": 4}')
    assert sources.read_orders_json(spark, path).first().asDict() == {
        "order_id": 4,
        "customer_id": None,
        "order_date": None,
        "payment_status": None,
        "items": None,
    }


@pytest.mark.parametrize("indent", [None, 2])
def test_one_array_over_many_lines(spark, tmp_path, indent):
    text = json.dumps(DOCUMENTS, indent=indent) if indent else "[\n" + ",\n".join(map(json.dumps, DOCUMENTS)) + "]"
    path = write(tmp_path, "a.json", text)
    assert ids(sources.read_orders_json(spark, path, multi_line=True)) == [0, 1, 2]


def test_single_documents_in_multi_line_mode(spark, tmp_path):
    write(tmp_path, "a.json", json.dumps(DOCUMENTS[0], indent=1))
    write(tmp_path, "b.json", "\n" + json.dumps(DOCUMENTS[1]) + "\n\n")
    assert ids(sources.read_orders_json(spark, str(tmp_path), multi_line=True)) == [0, 1]


def test_line_delimited_file_is_refused_in_multi_line_mode(spark, tmp_path):
    write(tmp_path, "a.json", json.dumps(DOCUMENTS, indent=1))
    write(tmp_path, "b.json", "\n\n" + "\n".join(map(json.dumps, DOCUMENTS)))
    with pytest.raises(ValueError, match="one document per line"):
        sources.read_orders_json(spark, str(tmp_path), multi_line=True)


def test_truncated_document_fails_or_is_kept(spark, tmp_path):
    path = write(tmp_path, "a.json", json.dumps(DOCUMENTS[0]) + '\n{"order_id": 9, "items": [')
    with pytest.raises(Exception, match="MALFORMED_RECORD_IN_PARSING"):
        sources.read_orders_json(spark, path).collect()
    kept = sources.read_orders_json(spark, path, corrupt="column").collect()
    assert [r._corrupt_record for r in kept] == [None, '{"order_id": 9, "items": [']


def test_inferred_schema_keeps_other_fields(spark, tmp_path):
    path = write(tmp_path, "a.json", json.dumps(DOCUMENTS[0] | {"channel": "web"}))
    orders = sources.read_orders_json(spark, path, schema=None)
    assert orders.first().channel == "web"
    assert orders.schema["items"].dataType.elementType.names == ["price_per_unit", "product_id", "sales_quantity"]


def test_corrupt_option_is_checked(spark):
    with pytest.raises(ValueError, match="corrupt"):
        sources.read_orders_json(spark, "x", corrupt="drop")


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_snapshot_types(spark, staging, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.sql(
            "SELECT 7 AS `an id`, CAST('12.50' AS DECIMAL(10,2)) AS price, DATE'1969-12-31' AS born, "
            "TIMESTAMP_NTZ'2025-03-09 02:30:00.125' AS local_time, "
            "TIMESTAMP'2025-01-01 00:00:00.001Z' AS instant, true AS ok, 'x' AS name, "
            "CAST(NULL AS DATE) AS never"
        )
        row = sources.land_snapshot(df, staging.path("t")).first().asDict()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert row == {
        "an id": 7,
        "price": "12.50",
        "born": -86_400_000,
        "local_time": 1741487400125,
        "instant": 1735689600001,
        "ok": True,
        "name": "x",
        "never": None,
    }


def test_landing_replaces_the_previous_copy(spark, staging):
    path = staging.path("t")
    sources.land_snapshot(spark.range(5), path)
    sources.land_snapshot(spark.range(3), path)
    assert spark.read.parquet(path).count() == 3


def test_products_are_renamed(spark, staging):
    path = staging.path("p")
    spark.sql("SELECT 1 AS product_id, '2' AS current_price, 'd' AS description").write.parquet(path)
    assert sources.read_products(spark, path).columns == ["product_id", "product_price", "product_description"]


class RecordingReader:
    """Stands in for a session: remembers JDBC reads and answers the bounds query."""

    def __init__(self, extent):
        self.read = self
        self.extent = extent
        self.calls = []

    def jdbc(self, url, table, **options):
        self.calls.append((table, options))
        return self

    def first(self):
        return self.extent


def test_jdbc_read_is_split_between_the_given_bounds():
    reader = RecordingReader(None)
    sources.read_jdbc_table(reader, "jdbc:x", "customers", {"user": "u"}, "customer_id", 16, (1, 900))
    assert reader.calls == [
        (
            "customers",
            {
                "column": "customer_id",
                "lowerBound": 1,
                "upperBound": 900,
                "numPartitions": 16,
                "properties": {"fetchsize": "10000", "user": "u"},
            },
        )
    ]


@pytest.mark.parametrize("extent", [(3, 8), (date(2025, 1, 1), date(2025, 2, 1))])
def test_jdbc_bounds_are_asked_of_the_database(extent):
    reader = RecordingReader(extent)
    sources.read_jdbc_table(reader, "jdbc:x", "logistics", {}, "order_id", 4)
    assert "MIN(order_id)" in reader.calls[0][0] and "FROM logistics" in reader.calls[0][0]
    assert (reader.calls[1][1]["lowerBound"], reader.calls[1][1]["upperBound"]) == extent


class RowsReader(RecordingReader):
    """Answers the query for parts with the first values that SQL finds in a table of its own."""

    def __init__(self, values):
        super().__init__(None)
        self.values = values

    def collect(self):
        connection = duckdb.connect()
        connection.register("held", pa.table({"id": self.values}))
        query = self.calls[-1][0].replace("FROM big_table", "FROM held")
        return [Row(lo=row[0]) for row in connection.execute(f"SELECT * FROM {query}").fetchall()]

    def rows_read(self):
        connection = duckdb.connect()
        connection.register("held", pa.table({"id": self.values}))
        conditions = self.calls[-1][1].get("predicates", ["TRUE"])
        return [connection.execute(f"SELECT count(*) FROM held WHERE {c}").fetchone()[0] for c in conditions]


CLUSTERED = [*range(1000), *range(10**12, 10**12 + 9000), -5, None, None]


@pytest.mark.parametrize(
    "values",
    [
        CLUSTERED,
        [date(2020, 1, 1) + timedelta(days=k * k) for k in range(300)] + [None],
        [datetime(2025, 1, 1) + timedelta(seconds=k) for k in range(300)],
        [f"it's {k:03}" for k in range(300)],
        [7] * 500 + [8, 9, None],
    ],
)
def test_jdbc_parts_hold_about_as_many_rows_each(values):
    reader = RowsReader(values)
    sources.read_jdbc_table(reader, "jdbc:x", "big_table", {"user": "u"}, "id", 8, split="quantiles")
    parts = reader.rows_read()
    assert sum(parts) == len(values) and reader.calls[-1][0] == "big_table"
    if len(set(values)) > 100:
        assert len(parts) == 8 and max(parts) <= len(values) / 8 + 4
    assert reader.calls[-1][1]["properties"] == {"fetchsize": "10000", "user": "u"}


@pytest.mark.parametrize("values", [[], [None], [3, 3]])
def test_jdbc_tables_of_one_value_are_not_parted(values):
    reader = RowsReader(pa.array(values, pa.int64()))
    sources.read_jdbc_table(reader, "jdbc:x", "big_table", {}, "id", 8, split="quantiles")
    assert "predicates" not in reader.calls[-1][1]
    with pytest.raises(ValueError, match="split"):
        sources.read_jdbc_table(reader, "jdbc:x", "big_table", {}, "id", 8, split="halves")


def test_jdbc_read_of_an_empty_table_is_not_split():
    reader = RecordingReader((None, None))
    sources.read_jdbc_table(reader, "jdbc:x", "products", {}, "product_id", 4)
    assert reader.calls[1] == ("products", {"properties": {"fetchsize": "10000"}})


def test_several_spread_documents_in_one_file_are_refused(spark, tmp_path):
    file = tmp_path / "three.json"
    file.write_text("\n".join(json.dumps({"order_id": k}, indent=1) for k in range(3)))
    with pytest.raises(ValueError, match="more than one document"):
        sources.read_orders_json(spark, str(file), multi_line=True)
    file.write_text(json.dumps([{"order_id": k} for k in range(3)], indent=1) + "\n")
    assert sources.read_orders_json(spark, str(file), multi_line=True).count() == 3


def test_the_caller_may_set_the_fetch_size():
    reader = RecordingReader(None)
    sources.read_jdbc_table(reader, "jdbc:x", "products", {"fetchsize": "7"}, "product_id", 4, (1, 9))
    assert reader.calls[0][1]["properties"] == {"fetchsize": "7"}


def test_a_day_with_many_orders_gives_several_arrays(spark, sf_dir):
    from pyspark.sql import functions as F

    from checks import queries, recipes

    raw = recipes.raw_orders(spark, sf_dir).withColumn("order_date", F.lit("2024-01-15"))
    n = raw.count()
    rows = queries._array_files(raw, 100).select("part", F.size(F.split("value", "\n")).alias("lines")).collect()
    assert len(rows) == len({r.part for r in rows}) == -(-n // 100)
    assert sum(r.lines - 1 for r in rows) == n and max(r.lines for r in rows) < 200


@pytest.mark.parametrize("schema", [RAW_ORDERS, None])
@pytest.mark.parametrize("multi_line", [True, False])
def test_files_are_opened_once(spark, staging, tmp_path, schema, multi_line):
    if schema and not multi_line:
        pytest.skip("lines with a declared schema are read when they are used")
    file = tmp_path / "a.json"
    file.write_text(json.dumps(DOCUMENTS, indent=1) if multi_line else "\n".join(map(json.dumps, DOCUMENTS)))
    orders = sources.read_orders_json(spark, str(file), multi_line, schema=schema, staging=staging)
    file.unlink()
    assert ids(orders) == [0, 1, 2]
    assert [r["items"][0].price_per_unit for r in orders.collect()] == [3.5] * 3


def test_declared_schema_is_not_changed_by_reading(spark, tmp_path):
    path = write(tmp_path, "a.json", json.dumps(DOCUMENTS[0]))
    names = list(RAW_ORDERS.names)
    for _ in range(2):
        assert sources.read_orders_json(spark, path, corrupt="column").count() == 1
    assert RAW_ORDERS.names == names == [f.name for f in RAW_ORDERS.fields]


MIXED = [
    {"id": 1, "whole": 3, "part": 1.5, "mixed": "a", "none": None, "big": 12345678901234567890, "tags": [1, 2]},
    {"id": 2, "whole": 4, "part": 2, "mixed": {"x": 1}, "none": None, "tags": [], "deep": {"b": True, "a": [{"z": 1e3}]}},
    {"id": 3, "odd name": "x", "part": 12345.678},
]


@pytest.mark.parametrize("multi_line", [True, False])
def test_inferred_types_are_those_of_the_reader(spark, tmp_path, multi_line):
    text = json.dumps(MIXED, indent=1) if multi_line else "\n".join(map(json.dumps, MIXED))
    path = write(tmp_path, "a.json", text)
    expected = spark.read.option("multiLine", multi_line).json(path)
    got = sources.read_orders_json(spark, path, multi_line, schema=None)
    assert got.schema.simpleString() == expected.schema.simpleString()
    shown = [["".join(str(r).replace("\\n", "").split()) for r in df.orderBy("id").collect()] for df in (got, expected)]
    assert shown[0] == shown[1]


def test_broken_files_fail_or_are_kept_in_multi_line_mode(spark, tmp_path):
    write(tmp_path, "a.json", json.dumps(DOCUMENTS, indent=1))
    broken = json.dumps(DOCUMENTS, indent=1)[:-20]
    write(tmp_path, "b.json", broken)
    write(tmp_path, "c.json", " \n\n")
    for schema in (RAW_ORDERS, None):
        with pytest.raises(Exception, match="MALFORMED_RECORD_IN_PARSING"):
            sources.read_orders_json(spark, str(tmp_path), multi_line=True, schema=schema).collect()
        kept = sources.read_orders_json(spark, str(tmp_path), True, "column", schema).collect()
        assert [r._corrupt_record for r in kept if r._corrupt_record] == [broken]
        assert sorted(r.order_id for r in kept if not r._corrupt_record) == [0, 1, 2]


def test_documents_of_a_wrong_type_are_kept_one_by_one(spark, tmp_path):
    path = write(tmp_path, "a.json", json.dumps([DOCUMENTS[0], DOCUMENTS[1] | {"customer_id": "five"}]))
    kept = sources.read_orders_json(spark, path, True, "column").collect()
    assert [r.order_id for r in kept if not r._corrupt_record] == [0]
    assert [json.loads(r._corrupt_record)["customer_id"] for r in kept if r._corrupt_record] == ["five"]


def test_no_documents_at_all(spark, tmp_path):
    path = write(tmp_path, "a.json", "\n")
    assert sources.read_orders_json(spark, path, True).count() == 0
    assert sources.read_orders_json(spark, path, schema=None).columns == []
