"""Physical-plan guards for every registered query: no cross products or nested-loop
joins, and scans of the given tables read only referenced columns."""

import contextlib
import io

import pytest

from conftest import SF_SMALL
from riskloom.plans.registered import QUERIES

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin")
#: Their results are a few literal rows; the closed-form oracle tests run them.
VALIDATED = {"cross_validate", "cross_validate_trees"}


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


@pytest.mark.parametrize("key", sorted(set(QUERIES) - VALIDATED))
def test_no_cross_products(spark, key):
    plan = _plan(QUERIES[key](spark, SF_SMALL))
    for bad in FORBIDDEN:
        assert bad not in plan, f"{key} plans a {bad}"


def test_single_pass_queries_read_only_what_they_use(spark):
    """label_distribution on the given tables: no dimension attribute, no text, no date is read."""
    plan = _plan(QUERIES["label_distribution"](spark, SF_SMALL))
    read = " ".join(line for line in plan.splitlines() if line.startswith("ReadSchema"))
    assert "l_quantity" in read
    for unused in ("o_totalprice", "l_shipdate", "p_retailprice", "s_acctbal", "c_acctbal", "l_tax", "l_linestatus"):
        assert unused not in read


def test_leaderboard_scans_once(spark):
    df = QUERIES["leaderboard_from_scores"](spark, SF_SMALL)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    final = plan.split("Initial Plan")[0]
    assert final.count("Generate ") == 1 and final.count("ReusedExchange") >= 1


def test_star_join_prunes_and_pushes(spark):
    from riskloom.sources.fixtures import risk_rows

    plan = _plan(risk_rows(spark, SF_SMALL).select("row_key", "label"))
    assert "ReadSchema: struct<c_custkey:bigint>" in plan          # customer: key only
    assert "p_retailprice" not in plan and "s_acctbal" not in plan  # unused columns never read
    assert "PushedFilters: [IsNotNull(l_orderkey)" in plan
