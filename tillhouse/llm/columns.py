"""Small expressions and row helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LAST_ID = 2**63 - 1
ROWS_AT_ONCE = 1000


def texts(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """The strings of a column, null as the empty text."""
    return [value or "" for value in batch.column(name).to_pylist()]


def sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in parts of at most `ROWS_AT_ONCE` rows, so that few texts are Python strings at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS_AT_ONCE):
            yield batch.slice(at, ROWS_AT_ONCE)


def map_batches(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], dict]], schema: str) -> DataFrame:
    """`mapInArrow` for a function of one batch that returns columns by name.

    `make` runs once per task and returns that function, so that models are
    loaded where they are used.
    """
    fields = df.sparkSession.createDataFrame([], schema).schema
    arrow_schema = pa.schema([(f.name, _arrow_type(f.dataType)) for f in fields.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        function = make()
        for batch in sliced(batches):
            columns = function(batch)
            yield pa.RecordBatch.from_arrays(
                [
                    column if isinstance(column, pa.Array) else pa.array(column, field.type)
                    for field, column in ((f, columns[f.name]) for f in arrow_schema)
                ],
                schema=arrow_schema,
            )

    return df.mapInArrow(run, schema)


def _arrow_type(data_type) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(data_type)


def row_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """Equal for repeated rows only: a collision needs the same id and the same 64-bit hash."""
    return F.struct(
        F.coalesce(F.col(doc_id), F.lit(LAST_ID)).alias("id"),
        F.xxhash64(F.col(doc_id), F.col(text)).alias("digest"),
    )


def unused(df: DataFrame, name: str) -> str:
    """A column name that `df` does not have, in any letter case."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
