import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])


@pytest.fixture
def make_docs(spark):
    """documents from (doc_id, text[, lang[, source]]) tuples, in several partitions."""
    def make(rows, partitions=3):
        rows = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s",
                 len(r[1]) if r[1] is not None else None) for r in rows]
        return spark.createDataFrame(rows, DOCS).repartition(partitions)
    return make


@pytest.fixture
def write_tables(spark, tmp_dir):
    """A folder of tables, as the registered queries read them."""
    def write(**frames):
        for name, df in frames.items():
            df.write.mode("overwrite").parquet(f"{tmp_dir}/{name}.parquet")
        return tmp_dir
    return write
