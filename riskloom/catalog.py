"""Ordered feature catalogs.

A catalog fixes, for one modelling table: the key columns, the label, and the ordered
feature list.  Feature order is the vector index used by the assembler, the scaler
statistics and the importances, so it is part of the model contract.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from riskloom.errors import CatalogMismatch


@dataclass(frozen=True)
class FeatureSpec:
    """One numeric feature: its domain (for validation) and default (for filling).

    ``values`` lists the allowed codes of a coded feature; ``lo``/``hi`` bound a
    numeric range (inclusive).  ``labels`` maps codes to display names.
    """

    name: str
    lo: float | None = None
    hi: float | None = None
    values: tuple[float, ...] | None = None
    default: float | None = None
    labels: tuple[tuple[float, str], ...] | None = None


def binary(name: str, default: float, labels: tuple[str, str] | None = None) -> FeatureSpec:
    lab = None if labels is None else ((0.0, labels[0]), (1.0, labels[1]))
    return FeatureSpec(name, values=(0.0, 1.0), default=default, labels=lab)


def ranged(name: str, lo: float | None, hi: float | None, default: float | None = None) -> FeatureSpec:
    return FeatureSpec(name, lo=lo, hi=hi, default=default)


@dataclass(frozen=True)
class FeatureCatalog:
    """Ordered features plus label and key columns of one modelling table."""

    features: tuple[FeatureSpec, ...]
    label: str
    key_cols: tuple[str, ...] = field(default_factory=tuple)

    @property
    def names(self) -> list[str]:
        return [f.name for f in self.features]

    def spec(self, name: str) -> FeatureSpec:
        for f in self.features:
            if f.name == name:
                return f
        raise KeyError(name)

    def defaults(self) -> dict[str, float]:
        return {f.name: f.default for f in self.features if f.default is not None}

    def different_rows(self) -> int | None:
        """How many rows the features' allowed codes tell apart; None if a feature has no list of codes."""
        if any(f.values is None for f in self.features):
            return None
        return math.prod(len(f.values) for f in self.features)

    def feature_schema(self) -> T.StructType:
        return T.StructType([T.StructField(n, T.DoubleType(), True) for n in self.names])

    def record_schema(self) -> T.StructType:
        """Schema of a record to score: keys (string) then the features (double)."""
        keys = [T.StructField(k, T.StringType(), True) for k in self.key_cols]
        return T.StructType(keys + list(self.feature_schema().fields))

    def keys_in(self, df: DataFrame) -> list[str]:
        """The key columns that a table has; a table or record without a key is as good."""
        return [k for k in self.key_cols if k in df.columns]

    def identity_in(self, df: DataFrame) -> list[str]:
        """What tells its rows apart in results: the key, or without one the features themselves."""
        return self.keys_in(df) or self.names

    def check(self, df: DataFrame, require_label: bool = False) -> None:
        """Raise ``CatalogMismatch`` naming every missing or non-numeric feature (and label)."""
        present = {f.name: f.dataType for f in df.schema.fields}
        wanted = self.names + ([self.label] if require_label else [])
        missing = [c for c in wanted if c not in present]
        if missing:
            raise CatalogMismatch(f"missing columns: {', '.join(missing)}")
        numeric = (T.NumericType, T.BooleanType)
        bad = [n for n in wanted if not isinstance(present[n], numeric)]
        if bad:
            raise CatalogMismatch(f"non-numeric columns: {', '.join(bad)}")


def _age_bands():
    """Age codes: 1 = 18-24, then five-year bands (2 = 25-29 ...), 13 = 80 and over."""
    yield 1.0, "18-24"
    for code in range(2, 13):
        start = 15 + 5 * code
        yield float(code), f"{start}-{start + 4}"
    yield 13.0, "80+"


# --- Fixed values: the 21 health indicators of the reference's training table, in the
# --- reference's feature order, with its form bounds and defaults.
YES_NO = ("no", "yes")
CDC_CATALOG = FeatureCatalog(
    features=(
        binary("HighBP", 0.0, YES_NO),
        binary("HighChol", 0.0, YES_NO),
        binary("CholCheck", 1.0, YES_NO),
        ranged("BMI", 10.0, 100.0, 25.0),
        binary("Smoker", 0.0, YES_NO),
        binary("Stroke", 0.0, YES_NO),
        binary("HeartDiseaseorAttack", 0.0, YES_NO),
        binary("PhysActivity", 1.0, ("sedentary", "active")),
        binary("Fruits", 1.0, YES_NO),
        binary("Veggies", 1.0, YES_NO),
        binary("HvyAlcoholConsump", 0.0, YES_NO),
        binary("AnyHealthcare", 1.0, YES_NO),
        binary("NoDocbcCost", 0.0, YES_NO),
        FeatureSpec("GenHlth", values=(1.0, 2.0, 3.0, 4.0, 5.0), default=3.0),
        ranged("MentHlth", 0.0, 30.0, 0.0),
        ranged("PhysHlth", 0.0, 30.0, 0.0),
        binary("DiffWalk", 0.0, YES_NO),
        binary("Sex", 0.0, ("female", "male")),
        FeatureSpec("Age", values=tuple(float(v) for v in range(1, 14)), default=5.0,
                    labels=tuple(_age_bands())),
        FeatureSpec("Education", values=tuple(float(v) for v in range(1, 7)), default=4.0),
        FeatureSpec("Income", values=tuple(float(v) for v in range(1, 9)), default=5.0),
    ),
    label="Diabetes_binary",
    key_cols=("ID",),
)


# --- Fixed values: TPC-H order priority names, in code order 1..5.
ORDER_PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")

# Stand-in catalog over the TPC-H-shaped test tables (see sources/fixtures.py).
RISK_ROWS_CATALOG = FeatureCatalog(
    features=(
        ranged("qty", 1, 50, 25),
        ranged("price", 0, None),
        ranged("discount_pct", 0, 10, 0),
        ranged("tax_pct", 0, 8, 0),
        binary("is_returned", 0.0, YES_NO),
        binary("is_accepted", 0.0, YES_NO),
        binary("is_finished", 0.0, YES_NO),
        ranged("line_no", 1, 7, 1),
        ranged("order_total", 0, None),
        binary("order_open", 0.0, YES_NO),
        binary("order_partial", 0.0, YES_NO),
        FeatureSpec("priority", values=(1.0, 2.0, 3.0, 4.0, 5.0), default=3.0,
                    labels=tuple(enumerate(ORDER_PRIORITIES, start=1))),
        ranged("cust_balance", None, None),
        binary("seg_building", 0.0, YES_NO),
        binary("seg_household", 0.0, YES_NO),
        ranged("part_size", 1, 50),
        ranged("part_price", 0, None),
        ranged("supp_balance", None, None),
        ranged("ship_lag_days", None, None),
        FeatureSpec("ship_month", values=tuple(float(v) for v in range(1, 13))),
        binary("same_nation", 0.0, YES_NO),
    ),
    label="label",
    key_cols=("row_key",),
)


# Stand-in catalog over document text statistics (see sources/fixtures.doc_quality).
DOC_QUALITY_CATALOG = FeatureCatalog(
    features=(
        ranged("n_chars", 0, None),
        ranged("n_words", 0, None),
        ranged("n_lines", 1, None),
        ranged("distinct_share", 0, 1),
        ranged("digit_share", 0, 1),
        binary("lang_de", 0.0),
        binary("lang_en", 0.0),
        binary("lang_es", 0.0),
        binary("lang_fr", 0.0),
    ),
    label="quality",
    key_cols=("doc_id",),
)
