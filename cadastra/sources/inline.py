"""Small tables written down by hand."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql.pandas.types import to_arrow_schema


def local_table(spark: SparkSession, rows: list[tuple], schema: str | T.StructType) -> DataFrame:
    """Rows from the driver as a local relation.

    Built through Arrow because Spark then knows its true size, so a join with it is broadcast; a
    frame made from Python rows counts as infinitely large.
    """
    shape = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    columns = zip(*rows) if rows else [[] for _ in shape]
    arrays = [
        pa.array(list(values), type=field.type) for values, field in zip(columns, to_arrow_schema(shape))
    ]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, names=shape.fieldNames()), shape)
