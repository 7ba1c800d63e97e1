"""Skill and means from stored moments, so that a new run adds its own without reading the old ones again.

The moments of prediction–observation pairs, or of values alone, are counts and sums, which add up. They are stored per
part (a run, a file) and group; a part that comes again replaces its rows. Sums are taken around a fixed ``centre``, which
keeps the squares small when values lie far from zero.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basinspark.functions.numbers import rounded
from basinspark.operators.skill import scores_of
from basinspark.sources.tables import read_table, upsert_into

SUMS = ["n_pairs", "sum_p", "sum_o", "sum_pp", "sum_oo", "sum_ee", "sum_e", "sum_ae"]


def pair_moments(pairs: DataFrame, by: Sequence[str], pred: str = "pred", obs: str = "obs", centre: float = 0.0) -> DataFrame:
    """Counts, sums, squares and errors per group; pairs with a missing side are left out."""
    p, o = F.col(pred).cast("double"), F.col(obs).cast("double")
    whole = pairs.where(p.isNotNull() & o.isNotNull() & ~F.isnan(p) & ~F.isnan(o))
    p, o, error = p - centre, o - centre, p - o
    sums = [F.lit(1), p, o, p * p, o * o, error * error, error, F.abs(error)]
    return whole.groupBy(*by).agg(*[F.sum(s).cast("long" if i == 0 else "double").alias(name) for i, (name, s) in enumerate(zip(SUMS, sums, strict=True))])


def store_moments(spark: SparkSession, path: str, pairs: DataFrame, part: str, by: Sequence[str], pred: str = "pred", obs: str = "obs", centre: float = 0.0) -> None:
    """Moments of the parts in ``pairs``, in place of those of the same parts that are stored already."""
    keys = [part, *by]
    upsert_into(spark, path, pair_moments(pairs, keys, pred, obs, centre), keys, [part])


def merged(moments: DataFrame, by: Sequence[str]) -> DataFrame:
    """Moments of larger groups, such as all parts together."""
    return moments.groupBy(*by).agg(*[F.sum(name).alias(name) for name in SUMS])


def skill_of(moments: DataFrame, by: Sequence[str], scaling: str = "obs_raw", digits: int | None = None) -> DataFrame:
    """The scores that :func:`basinspark.operators.skill.skill` gives for the pairs behind the moments."""
    n = F.col("n_pairs")
    variance = lambda total, squares: F.greatest(F.lit(0.0), F.col(squares) / n - F.pow(F.col(total) / n, 2))
    known = merged(moments, by).select(
        *by, "n_pairs", (F.col("sum_ee") / n).alias("_mse"), (F.col("sum_e") / n).alias("_bias"), (F.col("sum_ae") / n).alias("_mae"),
        variance("sum_p", "sum_pp").alias("_var_p"), variance("sum_o", "sum_oo").alias("_var_o"),
    )
    return scores_of(known, by, scaling, digits)


def means_of(moments: DataFrame, by: Sequence[str], centre: float = 0.0, digits: int | None = None) -> DataFrame:
    """Mean prediction and observation per group."""
    total = merged(moments, by)
    return total.select(*by, *[rounded(F.col(f"sum_{side}") / F.col("n_pairs") + centre, digits).alias(f"mean_{side}") for side in ("p", "o")])


def stored_skill(spark: SparkSession, path: str, by: Sequence[str], scaling: str = "obs_raw", digits: int | None = None) -> DataFrame:
    """Scores over all stored parts."""
    return skill_of(read_table(spark, path), by, scaling, digits)
