"""Feature selection, invalid-row handling, domain checks, defaults, decoding.

All checks are per-row Column expressions derived from the catalog, evaluated in a
single projection/filter, so they fuse into the scan's codegen stage.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.catalog import FeatureCatalog, FeatureSpec


def select_features(df: DataFrame, catalog: FeatureCatalog, keep_keys: bool = False) -> DataFrame:
    """Catalog features in catalog order; label and key columns are dropped unless kept."""
    cols = (catalog.keys_in(df) if keep_keys else []) + catalog.names
    return df.select(*cols)


def is_invalid(df: DataFrame, name: str) -> Column:
    """Null, or NaN for floating columns (what the assembler's ``skip`` drops)."""
    dtype = df.schema[name].dataType
    bad = F.col(name).isNull()
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        bad = bad | F.isnan(F.col(name))
    return bad


def any_invalid(df: DataFrame, cols: Sequence[str]) -> Column:
    cond = F.lit(False)
    for c in cols:
        cond = cond | is_invalid(df, c)
    return cond


def valid_rows(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows whose listed columns are all non-null and non-NaN (the ``skip`` rule)."""
    return df.filter(~any_invalid(df, cols))


def invalid_names(df: DataFrame, cols: Sequence[str]) -> Column:
    """Names of the listed columns that are null or NaN in a row."""
    return F.array_compact(F.array(*[F.when(is_invalid(df, c), F.lit(c)) for c in cols]))


def rejected_rows(df: DataFrame, key_cols: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Complement of ``valid_rows``: key plus the names of the offending columns.

    One condition over all columns must stay out of the optimiser's constraint propagation, which
    rewrites it once for every subset of renamed or cast columns (2^21 here).  A draw that is
    always true makes the filter non-deterministic, which keeps it where it stands.
    """
    return (df.select(*key_cols, invalid_names(df, cols).alias("bad_columns"))
            .filter(F.when(F.rand() >= 0, F.size("bad_columns") > 0)))


def domain_rule(spec: FeatureSpec, col: Column) -> Column | None:
    """True when a non-null value breaks the spec's domain; None if the spec has no domain."""
    conds = []
    if spec.values is not None:
        conds.append(~col.cast("double").isin(*[float(v) for v in spec.values]))
    if spec.lo is not None:
        conds.append(col < F.lit(spec.lo))
    if spec.hi is not None:
        conds.append(col > F.lit(spec.hi))
    if not conds:
        return None
    out = conds[0]
    for c in conds[1:]:
        out = out | c
    return col.isNotNull() & out


def domain_violations(df: DataFrame, catalog: FeatureCatalog) -> DataFrame:
    """Long form (keys, feature, value) of every out-of-domain value.

    One pass: each row carries an array of its violations, which is exploded; rows
    without violations produce nothing.
    """
    items = []
    for spec in catalog.features:
        rule = domain_rule(spec, F.col(spec.name))
        if rule is not None:
            items.append(F.when(rule, F.struct(F.lit(spec.name).alias("feature"),
                                               F.col(spec.name).cast("double").alias("value"))))
    found = F.array_compact(F.array(*items))
    keys = catalog.identity_in(df)
    return (df.select(*keys, F.explode(found).alias("v"))
            .select(*keys, "v.feature", "v.value"))


def domain_summary(df: DataFrame, catalog: FeatureCatalog) -> DataFrame:
    """Per feature: values checked and values out of domain, from one aggregate."""
    aggs, names = [], []
    for i, spec in enumerate(catalog.features):
        rule = domain_rule(spec, F.col(spec.name))
        names.append(spec.name)
        aggs.append(F.count(F.col(spec.name)).alias(f"c{i}"))
        aggs.append((F.count(F.when(rule, 1)) if rule is not None else F.lit(0).cast("long")).alias(f"v{i}"))
    wide = df.agg(*aggs)
    args = ", ".join(f"'{n}', c{i}, v{i}" for i, n in enumerate(names))
    return wide.selectExpr(f"stack({len(names)}, {args}) AS (feature, n_checked, n_violations)")


def fill_defaults(df: DataFrame, catalog: FeatureCatalog, cols: Sequence[str] | None = None) -> DataFrame:
    """Replace null (and NaN) values by the catalog defaults of the listed features."""
    wanted = set(cols) if cols is not None else set(catalog.names)
    values = {k: v for k, v in catalog.defaults().items() if k in wanted and k in df.columns}
    return df.fillna(values)


def decode_column(col: str | Column, labels: Sequence[tuple[float, str]]) -> Column:
    """Code → display name through a literal map (bounded by the catalog's code list)."""
    c = F.col(col) if isinstance(col, str) else col
    pairs = []
    for code, name in labels:
        pairs += [F.lit(float(code)), F.lit(name)]
    return F.create_map(*pairs)[c.cast("double")]


def decode_categories(df: DataFrame, catalog: FeatureCatalog, cols: Sequence[str] | None = None) -> DataFrame:
    """Adds ``<feature>_label`` for every coded feature that has display names."""
    out = df
    for spec in catalog.features:
        if spec.labels and spec.name in df.columns and (cols is None or spec.name in cols):
            out = out.withColumn(f"{spec.name}_label", decode_column(spec.name, spec.labels))
    return out
