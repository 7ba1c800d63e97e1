"""From monthly predictors and observed targets to a fitted ensemble and its hold-out scores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from basinspark.operators.ensemble import union_models
from basinspark.operators.features import date_split, fit_scaler, training_table
from basinspark.operators.models import Ensemble, KernelFeatures, fit_ensemble, holdout_scores
from basinspark.operators.windows import lag_lead
from basinspark.session import persisted

# Training and hold-out periods.
TRAIN_PERIOD = ("1979-01-01", "2004-12-01")
TEST_PERIOD = ("2005-01-01", "2011-01-01")


def train(
    features: DataFrame,
    targets: DataFrame,
    feature_names: Sequence[str],
    target_names: Sequence[str],
    train_period: tuple[str, str] = TRAIN_PERIOD,
    test_period: tuple[str, str] = TEST_PERIOD,
    kernel: KernelFeatures | None = None,
    trees: int = 100,
    seed: int = 42,
    depth: int = 30,
) -> tuple[Ensemble, DataFrame]:
    """Fit on the training months and score on the hold-out months, both standardised by the training months.

    Both tables are keyed by ``year, month``. The result is the ensemble and one row of MSE and R² per model and
    target.
    """
    # Written once, as scalers, models and scores read it again and again.
    table = persisted(
        training_table(
            lag_lead(features, [], ["year", "month"], list(feature_names)),
            lag_lead(targets, [], ["year", "month"], list(target_names)),
        )
    )
    train_rows, test_rows = date_split(table, "month_start", train_period, test_period)
    x_scaler, y_scaler = fit_scaler(train_rows, feature_names), fit_scaler(train_rows, target_names)
    ensemble = fit_ensemble(train_rows, feature_names, target_names, x_scaler, y_scaler, kernel, trees, seed, depth=depth)
    observed = {target: f"{target}_obs" for target in target_names}
    inputs = y_scaler.scale(test_rows, target_names).withColumnsRenamed(observed)
    scores = {}
    for name in ensemble.models:
        predicted = y_scaler.scale(ensemble.predict(inputs, name, list(observed.values())), target_names)
        scores[name] = holdout_scores(predicted, {observed[target]: target for target in target_names})
    return ensemble, union_models(scores)
