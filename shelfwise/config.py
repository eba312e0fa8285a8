"""Job parameters. One frozen dataclass per job; the defaults are fixed values."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, fields
from typing import ClassVar

TRUE_WORDS = frozenset({"1", "true", "yes"})


def parse_flag(text: str) -> bool:
    return text.strip().lower() in TRUE_WORDS


# Environment variables and the parameters they set, per job.
RECOMMENDATION_ENV = {
    "ALS_FACTORS": "factors",
    "ALS_REG": "regularization",
    "ALS_ITERS": "iterations",
    "ALS_TOPK": "topk",
    "ALS_ALPHA": "weight_alpha",
    "DUE_THRESHOLD": "due_threshold",
    "DEFAULT_CYCLE_DAYS": "default_cycle_days",
    "EXPORT_FILTER_OOS": "filter_out_of_stock",
    "WAREHOUSE_ID": "warehouse_id",
    "MIN_AVAIL_QTY": "min_available",
    "SAFETY_FRAC": "safety_fraction",
    "ALS_BACKFILL_FLOOR": "backfill_floor",
}
SIMILARITY_ENV = {
    "LOOKBACK_DAYS": "lookback_days",
    "ALS_K": "factors",
    "ALS_CONF_ALPHA": "confidence_alpha",
    "ALS_ITERS": "iterations",
    "ALS_REG": "regularization",
    "ALS_TOP_M": "top_m",
}


class FromOptions:
    """Build a config from string options; unknown names are rejected."""

    ENV: ClassVar[Mapping[str, str]] = {}

    @classmethod
    def from_env(cls, environment: Mapping[str, str]):
        """Only the variables this job knows count; the others keep their defaults."""
        return cls.from_options(
            {field: environment[name] for name, field in cls.ENV.items() if name in environment}
        )

    @classmethod
    def from_options(cls, options: Mapping[str, str]):
        known = {f.name: f for f in fields(cls)}
        unknown = sorted(set(options) - set(known))
        if unknown:
            raise ValueError(f"unknown options for {cls.__name__}: {', '.join(unknown)}")
        return cls(**{name: _parse(str(known[name].type), text) for name, text in options.items()})


def _parse(declared: str, text: str):
    optional = "None" in declared
    if optional and not text.strip():
        return None
    if declared.startswith("bool"):
        return parse_flag(text)
    if declared.startswith("int"):
        return int(text)
    if declared.startswith("float"):
        return float(text)
    if declared.startswith("tuple"):
        return tuple(part.strip() for part in text.split(",") if part.strip())
    return text


@dataclass(frozen=True)
class RecommendationConfig(FromOptions):
    """Order recommendations: one ranked item list per (customer, sales org)."""

    ENV: ClassVar[Mapping[str, str]] = RECOMMENDATION_ENV

    factors: int = 64
    regularization: float = 0.08
    iterations: int = 15
    topk: int = 200
    weight_alpha: float = 40.0
    bm25_k1: float = 100.0
    bm25_b: float = 0.8
    due_threshold: float = 0.8
    default_cycle_days: int = 30
    filter_out_of_stock: bool = False
    warehouse_id: int | None = None
    min_available: int = 1
    safety_fraction: float = 0.10
    backfill_below: int = 10
    backfill_items: int = 10
    backfill_rank: int = 999
    backfill_floor: float = 0.05
    low_percent: float = 5.0
    high_percent: float = 95.0
    min_items: int = 15
    min_span: float = 1e-4
    rank_blend: float = 0.30
    seed: int = 7
    # Blocks per side of Spark ML's solver; another number gives other factors for the same seed.
    # A billion cells in 32 x 32 blocks are about a million cells (12 MB) each.
    blocks: int = 32
    # "blocks" (Spark ML), "slices" (partial normal equations), or "auto": see operators.factors.fit.
    solver: str = "auto"
    # Whether the regularisation is multiplied by the number of cells of a key.
    scale_regularization: bool = True
    # Cells of one key beyond which it is solved in slices of that size.
    hot_cells: int = 1_000_000


@dataclass(frozen=True)
class SimilarityConfig(FromOptions):
    """Similar customers: latent factors and nearest neighbours inside a block."""

    ENV: ClassVar[Mapping[str, str]] = SIMILARITY_ENV

    lookback_days: int = 365
    doc_types: tuple[str, ...] = ("invoice", "return")
    factors: int = 32
    confidence_alpha: float = 1.0
    iterations: int = 25
    regularization: float = 0.05
    write_neighbors: bool = True
    top_m: int = 100
    block_scope: str | None = "segment"
    k_window: int = 50
    blend_alpha: float = 0.60
    min_overlap_items: int = 3
    seed: int = 7
    # Blocks per side of Spark ML's solver; another number gives other factors for the same seed.
    # A billion cells in 32 x 32 blocks are about a million cells (12 MB) each.
    blocks: int = 32
    # "blocks" (Spark ML), "slices" (partial normal equations), or "auto": see operators.factors.fit.
    solver: str = "auto"
    # Whether the regularisation is multiplied by the number of cells of a key.
    scale_regularization: bool = True
    # Cells of one key beyond which it is solved in slices of that size.
    hot_cells: int = 1_000_000
