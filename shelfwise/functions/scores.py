"""Weights, reorder rule and score normalisation as expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfwise.config import RecommendationConfig


def log_weight(weight: Column, alpha: float) -> Column:
    return F.log1p(F.lit(float(alpha)) * weight) if alpha > 0 else weight


def bm25_weight(
    weight: Column,
    length: Column,
    mean_length: Column,
    holders: Column,
    population: Column,
    k1: float,
    b: float,
) -> Column:
    """Okapi weight of an item (term) for an entity (document)."""
    norm = F.lit(1.0 - b) + F.lit(float(b)) * length / mean_length
    idf = F.log(population.cast("double")) - F.log1p(holders.cast("double"))
    return weight * F.lit(k1 + 1.0) / (F.lit(float(k1)) * norm + weight) * idf


def is_due(days: Column, median: Column, mean: Column, config: RecommendationConfig) -> Column:
    """Days since the last order reach the threshold share of the usual cycle.

    The median cycle wins over the mean; without either a fixed number of days counts.
    """
    share = F.lit(float(config.due_threshold))
    limit = F.coalesce(share * median, share * mean, F.lit(float(config.default_cycle_days)))
    return F.coalesce(days >= limit, F.lit(False))


def rank_score(rank: Column, count: Column) -> Column:
    return F.lit(1.0) - (rank - F.lit(1.0)) / F.greatest(count - F.lit(1), F.lit(1))


def normalised_score(
    raw: Column, rank: Column, count: Column, low: Column, high: Column, config: RecommendationConfig
) -> Column:
    """Robust min-max blended with the rank; rank alone for short or flat lists."""
    by_rank = rank_score(rank, count)
    span = high - low
    scaled = F.least(F.greatest(F.try_divide(raw - low, span), F.lit(0.0)), F.lit(1.0))
    blend = F.lit(1.0 - config.rank_blend) * scaled + F.lit(config.rank_blend) * by_rank
    plain = (count < config.min_items) | (span < config.min_span)
    return F.when(plain, by_rank).otherwise(blend)


def descending_quantile(values: Column, percent: float) -> Column:
    """Linearly interpolated quantile of an array sorted from high to low."""
    last = F.size(values) - 1
    at = last * F.lit(percent / 100.0)
    below = F.floor(at).cast("int")
    above = F.ceil(at).cast("int")
    low = F.get(values, last - below)
    high = F.get(values, last - above)
    return low + (high - low) * (at - below)
