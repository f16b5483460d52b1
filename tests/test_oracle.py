"""Every registered query with an oracle agrees with DuckDB (sf0.001, same tables)."""

import math

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL

ORACLE = E.oracle_sql()


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])

    def norm(v):
        if isinstance(v, float):
            return "nan" if math.isnan(v) else float(f"{v:.9g}")
        return v

    return [cols[i] for i in order], sorted((tuple(norm(r[i]) for i in order) for r in rows), key=repr)


def test_every_oracle_key_is_registered():
    assert set(ORACLE) <= set(E.queries())


def _family(t) -> str:
    t = str(t).lower()
    if t.startswith("decimal"):
        return "decimal"
    return {"bigint": "int64", "long": "int64", "hugeint": "int64", "int": "int32", "integer": "int32",
            "double": "float", "float": "float", "string": "string", "varchar": "string"}.get(t, t)


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_matches_duckdb(spark, duck, key):
    df = E.queries()[key](spark, SF_SMALL)
    ours = _canon(df.columns, [tuple(r) for r in df.collect()])
    rel = duck.sql(ORACLE[key])
    theirs = _canon(rel.columns, rel.fetchall())
    assert ours[0] == theirs[0]
    assert {n: _family(t) for n, t in df.dtypes} == {n: _family(t) for n, t in zip(rel.columns, rel.types)}
    assert len(ours[1]) == len(theirs[1])
    assert ours[1] == theirs[1]
