"""Small driver-side result tables built JVM-side.

Fitted-model summaries (one row per model, per feature, per grid point) are created
from literals — ``inline(array(struct(...)))`` over a one-row range — instead of
``createDataFrame`` on Python rows, which ships pickled rows and starts Python workers.
Callers pass only results bounded by the model family or the catalog, never data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _schema(schema: T.StructType | str) -> T.StructType:
    if isinstance(schema, T.StructType):
        return schema
    return T.StructType.fromDDL(schema)


def local_frame(spark: SparkSession, rows: Sequence[Sequence], schema: T.StructType | str) -> DataFrame:
    """A DataFrame of ``rows`` (tuples in schema order) with the given schema."""
    st = _schema(schema)
    if not rows:
        return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in st.fields])
    structs = [F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, st.fields)])
               for row in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))
