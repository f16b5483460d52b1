"""Lines that are no record (S4, S5): kept with the line and the reason, instead of a row of nulls.

A file of JSON lines or CSV is read as text; every line is parsed once and comes out either as
a record (keys as text, features as doubles) or with a reason.  Records go on to scoring,
which rejects those with a missing feature, so that scored + rejected + corrupt = lines.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.catalog import FeatureCatalog
from riskloom.errors import CatalogMismatch
from riskloom.sources.tables import as_records

EMPTY, NOT_JSON, NOT_AN_OBJECT = "empty", "not_json", "not_an_object"
OPEN_QUOTE, TOO_FEW, TOO_MANY = "open_quote", "too_few_fields", "too_many_fields"


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line) of a folder of text files."""
    return spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("line"))


def _json(line: Column, fields: Sequence[str]) -> tuple[Column, Column]:
    """(record, reason) of a line of JSON; the reason is null for a JSON object."""
    value = F.try_parse_json(line)
    schema = T.StructType([T.StructField(f, T.StringType()) for f in fields])
    reason = F.when(value.isNull(), NOT_JSON).when(~F.schema_of_variant(value).startswith("OBJECT"), NOT_AN_OBJECT)
    return F.from_json(line, schema), reason


def _csv(line: Column, columns: Sequence[str]) -> tuple[Column, Column]:
    """(record, reason) of a line of CSV with these columns, quoted by double quotes."""
    open_quotes = F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))
    bare = F.regexp_replace(line, '"[^"]*"', "")
    n = F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit(""))) + 1
    reason = (F.when(open_quotes % 2 == 1, OPEN_QUOTE).when(n < len(columns), TOO_FEW).when(n > len(columns), TOO_MANY))
    schema = ", ".join(f"`{c}` string" for c in columns)
    return F.from_csv(line, schema, {"escape": '"'}), reason


def classify_lines(lines: DataFrame, catalog: FeatureCatalog, fmt: str = "json", columns: Sequence[str] | None = None,
                   line_col: str = "line") -> DataFrame:
    """Every line with ``reason`` (null: it is a record) and ``record``, a struct of the catalog's keys and features as text.

    For CSV ``columns`` are the names in the files' header; lines that repeat the header are left out.
    A line without any character but white space, or null, is 'empty'.  A key that the columns
    don't have is left out of the record; a feature they don't have raises ``CatalogMismatch``.
    """
    line = F.col(line_col)
    wanted = [*catalog.key_cols, *catalog.names]
    if fmt == "csv":
        missing = [c for c in catalog.names if c not in (columns or ())]
        if missing:
            raise CatalogMismatch(f"missing columns: {', '.join(missing)}")
        wanted = [c for c in wanted if c in columns]
        lines = lines.filter(~line.eqNullSafe(F.lit(",".join(columns))))
        parsed, reason = _csv(line, columns)
        parsed = F.struct(*[parsed[c].alias(c) for c in wanted])
    elif fmt == "json":
        parsed, reason = _json(line, wanted)
    else:
        raise ValueError(f"no lines in {fmt!r}")
    reason = F.when(F.coalesce(line, F.lit("")).rlike(r"^\s*$"), EMPTY).otherwise(reason)
    return lines.withColumn("reason", reason).withColumn("record", F.when(F.col("reason").isNull(), parsed))


def corrupt_records(classified: DataFrame) -> DataFrame:
    """The lines that are no record, with their reasons and whatever else came with the lines."""
    return classified.filter("reason is not null").drop("record")


def line_records(classified: DataFrame, catalog: FeatureCatalog) -> DataFrame:
    """The records among the lines: keys as text, features as doubles (null where the text is no number)."""
    return as_records(classified.filter("reason is null").select("record.*"), catalog)
