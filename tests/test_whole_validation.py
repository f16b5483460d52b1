"""Cross-validation of the registered queries takes every training row."""

import pytest

from conftest import SF_SMALL
from riskloom.plans import registered as R
from riskloom.sources import fixtures as fx


@pytest.mark.parametrize("query", [R.cross_validate_q, R.cross_validate_trees])
def test_every_training_row_takes_part(spark, monkeypatch, query):
    seen = {}

    def validate(estimators, data, label_col, num_folds, **_):
        seen.update(folds=sorted(r["fold"] for r in data.select("fold").distinct().collect()), rows=data.count(), n=num_folds)
        return [{"estimator": type(e).__name__, "point": g, "mean_auc": 0.5} for e, grid in estimators for g in range(len(grid))]

    monkeypatch.setattr(R, "cross_validate", validate)
    assert query(spark, SF_SMALL).count() in (4, 8)
    train = fx.risk_rows(spark, SF_SMALL).filter(f"split_bucket < {fx.TRAIN_PERCENT}").count()
    assert seen == {"folds": list(range(fx.NUM_FOLDS)), "rows": train, "n": fx.NUM_FOLDS}
