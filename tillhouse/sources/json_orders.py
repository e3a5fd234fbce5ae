"""Nested order documents in JSON."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    DataType,
    DecimalType,
    DoubleType,
    NullType,
    StringType,
    StructField,
    StructType,
    VariantType,
)

from tillhouse.metrics import observed
from tillhouse.schemas import RAW_ORDERS
from tillhouse.staging import Staging

CORRUPT_COLUMN = "_corrupt_record"
LONG_DIGITS = 18


def read_orders_json(
    spark: SparkSession,
    path: str,
    multi_line: bool = False,
    corrupt: str = "fail",
    schema: StructType | None = RAW_ORDERS,
    staging: Staging | None = None,
) -> DataFrame:
    """Read orders with a declared schema, or with None every field as inferred from the documents.

    The default expects one document per line, which Spark can split between
    tasks. `multi_line` is for files holding one document or one array spread
    over lines: each such file is one task's work, and one with text after its
    first document is refused. `corrupt="fail"` stops at a malformed document,
    `"column"` keeps its text in `_corrupt_record`.

    Lines with a declared schema are read when the result is used. In the other
    cases every file is opened once, now: its documents are kept in `staging`,
    without a schema as VARIANT, from which their types are then taken.
    """
    if corrupt not in ("fail", "column"):
        raise ValueError(f"corrupt must be 'fail' or 'column', not {corrupt!r}")
    if schema is not None and not multi_line:
        return _read_lines(spark, path, corrupt, schema)
    staging = staging or Staging(spark)
    documents = _documents(spark, path, multi_line)
    if schema is not None:
        return _stored(staging, documents, _parsed(F.col("document"), corrupt, schema))
    return _inferred(staging, documents, corrupt)


def _with_corrupt_column(schema: StructType, corrupt: str) -> StructType:
    extra = [] if corrupt == "fail" else [StructField(CORRUPT_COLUMN, StringType())]
    return StructType([*schema.fields, *extra])


def _options(corrupt: str) -> dict[str, str]:
    if corrupt == "fail":
        return {"mode": "FAILFAST"}
    return {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COLUMN}


def _read_lines(spark: SparkSession, path: str, corrupt: str, schema: StructType) -> DataFrame:
    return spark.read.options(**_options(corrupt)).schema(_with_corrupt_column(schema, corrupt)).json(path)


def _documents(spark: SparkSession, path: str, multi_line: bool) -> DataFrame:
    """`file`, `refused` and the texts of its `documents`, for each file or line with text.

    A text has one root if putting brackets around it makes an array of one
    element. One whose first root can be read although that fails has text after
    it. Broken texts are a document of their own, which parsing rejects.
    """
    text = F.col("value")
    read = spark.read.text(path, wholetext=multi_line)
    read = read.select(F.col("_metadata.file_path").alias("file"), text).where(F.trim(F.regexp_replace(text, r"\s", " ")) != "")
    is_array = text.rlike(r"\A\s*\[")
    elements = F.when(is_array, F.from_json(text, "array<string>"))
    documents = F.coalesce(elements, F.array(text))
    if not multi_line:
        return read.select("file", F.lit(None).cast("string").alias("refused"), documents.alias("documents"))
    roots = F.json_array_length(F.concat(F.lit("["), text, F.lit("]")))
    first_line = F.regexp_extract(text, r"\A\s*([^\n]*)", 1)
    more = (roots > 1) | (roots.isNull() & F.get_json_object(text, "$").isNotNull())
    refused = F.when(more, F.when(F.get_json_object(first_line, "$").isNotNull(), "lines").otherwise("more"))
    return read.select("file", refused.alias("refused"), F.when(F.coalesce(more, F.lit(False)), F.array()).otherwise(documents).alias("documents"))


def _stored(staging: Staging, documents: DataFrame, parsed: Column) -> DataFrame:
    """The parsed documents as rows in the shared folder; files with more than one root raise."""
    counted = Observation()
    kinds = ("lines", "more")
    seen = documents.observe(counted, *[F.max(F.when(F.col("refused") == kind, F.col("file"))).alias(kind) for kind in kinds])
    rows = seen.select(F.explode("documents").alias("document")).select(parsed.alias("parsed")).select("parsed.*")
    stored = staging.save(rows, "orders")
    files = observed(counted, dict.fromkeys(kinds))
    if files["lines"]:
        raise ValueError(f"{files['lines']} holds one document per line; read it without multi_line")
    if files["more"]:
        raise ValueError(f"{files['more']} holds more than one document; multi_line would keep the first only")
    return stored


def _parsed(document: Column, corrupt: str, schema: StructType) -> Column:
    return F.from_json(document, _with_corrupt_column(schema, corrupt), _options(corrupt))


def _inferred(staging: Staging, documents: DataFrame, corrupt: str) -> DataFrame:
    """Every field of the documents, with the types that a JSON reader would give them."""
    document = F.col("document")
    if corrupt == "fail":
        parsed = F.struct(F.parse_json(document).alias("fields"))
    else:
        fields = F.try_parse_json(document)
        parsed = F.struct(fields.alias("fields"), F.when(fields.isNull(), document).alias(CORRUPT_COLUMN))
    stored = _stored(staging, documents, parsed)
    found = stored.agg(F.schema_of_variant_agg("fields").alias("found")).first().found
    schema = _reader_type(found)
    if not isinstance(schema, StructType):
        raise ValueError(f"the documents are no objects but {found}")
    kept = [c for c in stored.columns if c != "fields"]
    typed = stored.select(F.col("fields").cast(schema).alias("fields"), *kept)
    return typed.select(*[F.col("fields").getField(f.name).alias(f.name) for f in schema.fields], *kept)


def _reader_type(found: str) -> DataType:
    """A variant's schema as Spark types: fractions as doubles, fields of mixed or no type as text."""

    def of(kind: DataType) -> DataType:
        if isinstance(kind, StructType):
            return StructType([StructField(f.name, of(f.dataType)) for f in kind.fields])
        if isinstance(kind, ArrayType):
            return ArrayType(of(kind.elementType))
        # Whole numbers are decimals only beyond 18 digits; 1000.0 is one of four digits and no places.
        if isinstance(kind, DecimalType) and (kind.scale or kind.precision <= LONG_DIGITS):
            return DoubleType()
        return StringType() if isinstance(kind, (VariantType, NullType)) else kind

    if found == "VOID":
        return StructType([])
    return of(DataType.fromDDL(re.sub(r"\bOBJECT<", "STRUCT<", found)))
