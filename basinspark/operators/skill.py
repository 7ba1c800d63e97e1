"""Verification: observation and lead formats, skill scores, CRPS and plot feeds."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basinspark.functions.calendar import (
    LEAD_WORDS,
    lead_offset,
    month_start,
    parse_month_name,
    valid_month,
)
from basinspark.functions.numbers import rounded
from basinspark.operators.ensemble import ensemble_mean
from basinspark.operators.groups import SMALL_GROUP, split_groups, stacked
from basinspark.operators.positions import running_counts, value_counts_in_order
from basinspark.operators.quantiles import exact_quantiles
from basinspark.operators.records import null_sentinel
from basinspark.operators.shape import to_long
from basinspark.schemas import MONTH_NAMES
from basinspark.session import size_checked

SCORES = ["rmse", "r2", "bias", "variance", "crps"]
MISSING_OBSERVATION = -99990.0


def format_observed(
    wide: DataFrame,
    year: str = "Year",
    ids: Sequence[str] = (),
    months: Sequence[str] = tuple(MONTH_NAMES),
    sentinel: float = MISSING_OBSERVATION,
    out: str = "observed",
) -> DataFrame:
    """Year × 12 months to one row per month; the sentinel and missing values are left out."""
    long = to_long(wide, [*ids, year], months, "_name", out)
    dated = long.withColumn("month_start", parse_month_name(year, "_name"))
    return null_sentinel(dated, [out], sentinel, drop=True).select(*ids, "month_start", out)


def format_leads(
    wide: DataFrame,
    year: str = "year",
    month: str = "month",
    ids: Sequence[str] = (),
    leads: Sequence[str] = tuple(LEAD_WORDS),
    out: str = "nbs",
) -> DataFrame:
    """Lead columns ``one`` … ``six`` to one row per forecast date and valid month."""
    dated = wide.withColumn("forecast_date", month_start(year, month))
    long = to_long(dated, [*ids, "forecast_date"], leads, "_lead", out)
    return long.withColumn("valid_month", valid_month("forecast_date", lead_offset("_lead"))).select(
        *ids, "forecast_date", "valid_month", out
    )


def _moments(pred: Column, obs: Column) -> dict[str, Column]:
    error = pred - obs
    return {
        "n_pairs": F.count(F.lit(1)),
        "_mse": F.avg(error * error),
        "_bias": F.avg(error),
        "_var_p": F.var_pop(pred),
        "_var_o": F.var_pop(obs),
        "_mean_p": F.avg(pred),
        "_mean_o": F.avg(obs),
        "_mae": F.avg(F.abs(error)),
    }


def _spread(variance: str) -> Column:
    """Scale of a standardiser: the population deviation, or 1 for a constant."""
    return F.when(F.col(variance) > 0, F.sqrt(variance)).otherwise(F.lit(1.0))


def _determination(mse: Column, variance: Column) -> Column:
    """R²; for constant observations 1 when the fit is exact, else 0."""
    return F.when(variance > 0, 1 - mse / variance).otherwise(F.when(mse == 0, 1.0).otherwise(0.0))


def skill(
    pairs: DataFrame,
    by: Sequence[str] = (),
    pred: str = "pred",
    obs: str = "obs",
    scaling: str = "obs_raw",
    digits: int | None = None,
) -> DataFrame:
    """Scores of prediction–observation pairs per group; pairs with a missing side are left out.

    ``obs_raw``: rmse and r² on data standardised by the observations, bias, variance and crps on raw values.
    ``obs_std``: all of them on data standardised by the observations.
    ``own``: each side standardised by its own moments.

    The first two need one aggregate, since a common scaling divides out; ``own`` joins the moments back to the pairs.
    """
    if scaling not in ("obs_raw", "obs_std", "own"):
        raise ValueError("scaling must be 'obs_raw', 'obs_std' or 'own'")
    p, o = F.col(pred).cast("double"), F.col(obs).cast("double")
    whole = pairs.where(p.isNotNull() & o.isNotNull() & ~F.isnan(p) & ~F.isnan(o))
    moments = whole.groupBy(*by).agg(*[m.alias(name) for name, m in _moments(p, o).items()])

    if scaling == "own":
        # One row per group; a scalar subquery if there is only one.
        scales = moments.select(
            *by, "_mean_p", "_mean_o", _spread("_var_p").alias("_sp"), _spread("_var_o").alias("_so")
        )
        keyed = whole.select(*by, p.alias("_p"), o.alias("_o"))
        if by:
            scaled = keyed.join(size_checked(scales), list(by))
        else:
            one = scales.select(F.struct("*").alias("s")).scalar()
            scaled = keyed.withColumn("_s", one).select("_p", "_o", "_s.*")
        zp = (F.col("_p") - F.col("_mean_p")) / F.col("_sp")
        zo = (F.col("_o") - F.col("_mean_o")) / F.col("_so")
        moments = scaled.groupBy(*by).agg(*[m.alias(name) for name, m in _moments(zp, zo).items()])
    return scores_of(moments, by, scaling, digits)


def scores_of(moments: DataFrame, by: Sequence[str], scaling: str = "obs_raw", digits: int | None = None) -> DataFrame:
    """Scores from the moments of each group: mean squared, signed and absolute error, and both variances."""
    scale = F.lit(1.0) if scaling == "own" else _spread("_var_o")
    unit = F.lit(1.0) if scaling == "obs_raw" else scale
    scores = {
        "rmse": F.sqrt("_mse") / scale,
        "r2": _determination(F.col("_mse"), F.col("_var_o")),
        "bias": F.col("_bias") / unit,
        "variance": F.col("_var_p") / (unit * unit),
        "crps": F.col("_mae") / unit,
    }
    return moments.select(*by, "n_pairs", *[rounded(score, digits).alias(name) for name, score in scores.items()])


def grouped_pairs(
    wide: DataFrame,
    by: Sequence[str],
    pairs: Mapping[str, tuple[str, str]],
    groups: Mapping[str, Sequence[str]],
    group: str = "group",
) -> DataFrame:
    """Pairs of a wide table, once per skill group they belong to.

    A row counts for a group only if all variables of that group are present on both sides, whatever the others are.
    Groups may overlap. The groups are expanded within the row, without a join.
    """
    entries = []
    for name, variables in groups.items():
        columns = [column for variable in variables for column in pairs[variable]]
        whole = " AND ".join(f"{_column(column)} IS NOT NULL" for column in columns)
        members = ", ".join(
            f"named_struct({_text(group)}, {_text(name)}, 'variable', {_text(variable)}, "
            f"'pred', {_column(pairs[variable][0])}, 'obs', {_column(pairs[variable][1])})"
            for variable in variables
        )
        entries.append(f"CASE WHEN {whole} THEN array({members}) END")
    return wide.select(*by, F.expr(f"inline(flatten(array_compact(array({', '.join(entries)}))))"))


def _column(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def skill_groups(
    wide: DataFrame,
    pairs: Mapping[str, tuple[str, str]],
    groups: Mapping[str, Sequence[str]],
    by: Sequence[str] = ("model",),
    scaling: str = "obs_raw",
    digits: int | None = 3,
) -> DataFrame:
    """Scores of every model and group in one aggregate."""
    return skill(grouped_pairs(wide, by, pairs, groups), [*by, "group"], scaling=scaling, digits=digits)


def crps(
    df: DataFrame, keys: Sequence[str], member: str, obs: str, small_group: int = SMALL_GROUP
) -> DataFrame:
    """Ensemble CRPS per observation: mean distance to the observation minus half the mean distance of members.

    ``keys`` name an observation and ``obs`` repeats its value on each member row. The distance among members comes
    from ranks, so no pairs are formed. Up to ``small_group`` members are sorted as an array; more are ranked across
    tasks. With one member the score is the absolute error.
    """
    members = df.na.drop(subset=[*keys, member, obs]).select(
        *keys, F.col(member).cast("double").alias("_x"), F.col(obs).cast("double").alias("_y")
    )
    small, large, _ = split_groups(members, keys, small_group)
    parts = []
    if small is not None:
        # A member at index i of the sorted array has the weight 2(i + 1) − m − 1.
        terms = F.transform("_sorted", lambda x, i: x * (2 * i + 1 - F.col("n_members")))
        parts.append(
            small.groupBy(*keys)
            .agg(*_distance(), F.sort_array(F.collect_list("_x")).alias("_sorted"))
            .withColumn("_sum", F.aggregate(terms, F.lit(0.0), lambda total, term: total + term))
        )
    if large is not None:
        ranks = running_counts(*value_counts_in_order(large.select(*keys, "_x"), keys, "_x"), keys, "_x")
        # The same weights summed over a run of n equal values that follows ``before`` smaller ones.
        weight = F.col("n") * (2 * F.col("before") + F.col("n") - F.col("total"))
        sums = ranks.groupBy(*keys).agg(F.sum(F.col("_x") * weight).alias("_sum"))
        parts.append(large.groupBy(*keys).agg(*_distance()).join(sums, list(keys)))
    return stacked([part.select(*keys, "n_members", "_distance", "_sum") for part in parts]).select(
        *keys,
        "n_members",
        (F.col("_distance") - F.col("_sum") / F.pow(F.col("n_members").cast("double"), 2)).alias("crps"),
    )


def _distance() -> list[Column]:
    return [F.avg(F.abs(F.col("_x") - F.col("_y"))).alias("_distance"), F.count(F.lit(1)).alias("n_members")]


def predictor_medians(
    wide: DataFrame, keys: Sequence[str], columns: Sequence[str], observations: DataFrame
) -> DataFrame:
    """Median of each predictor per month next to the observations; incomplete months are dropped."""
    medians = exact_quantiles(wide, keys, columns, {"median": 0.5})
    named = medians.withColumnsRenamed({f"{column}_median": column for column in columns})
    return named.join(observations, list(keys), "left").na.drop("any")


def plot_feed(
    predictions: DataFrame,
    series: str,
    model: str,
    year: str,
    month: str,
    value: str,
    first: str | None = None,
    last: str | None = None,
) -> DataFrame:
    """Monthly mean of each model and the band over all models, per series, with dates, within a date window."""
    dated = predictions.withColumn("date", month_start(year, month))
    if first is not None:
        dated = dated.where(F.col("date") >= F.lit(first).cast("date"))
    if last is not None:
        dated = dated.where(F.col("date") <= F.lit(last).cast("date"))
    means = ensemble_mean(dated, [series, "date", model], {value: "model_mean"})
    band = exact_quantiles(dated, [series, "date"], [value], {"lower": 0.025, "upper": 0.975})
    return means.join(
        band.withColumnsRenamed({f"{value}_lower": "lower", f"{value}_upper": "upper"}), [series, "date"]
    )
