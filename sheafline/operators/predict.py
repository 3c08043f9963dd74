"""Three-way decisions on scores."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LOWER, UPPER = 0.3317, 0.6511


def resolve(lower: float, upper: float, override_lower: str | None = None, override_upper: str | None = None) -> tuple[float, float]:
    """Thresholds with overrides given as text; invalid ones are ignored, lower never exceeds upper."""

    def read(v, d):
        try:
            return float(v) if v is not None else d
        except ValueError:
            return d

    up = read(override_upper, upper)
    return min(read(override_lower, lower), up), up


def decide(score: Column, lower: float = LOWER, upper: float = UPPER) -> Column:
    """Positive from ``upper`` up, negative to ``lower``, review between and for no score."""
    return F.when(score >= upper, "automatic_positive").when(score <= lower, "automatic_negative").otherwise("needs_review")


def prediction(score: Column, status: Column, lower: float = LOWER, upper: float = UPPER) -> dict[str, Column]:
    """The columns of a prediction; an unreadable document has no score."""
    s = F.when(status == "classified", score)
    d = decide(s, lower, upper)
    return {
        "is_module_handbook": F.when(s.isNotNull(), s >= upper), "score": F.round(s, 4), "decision": d,
        "review_status": F.when(d == "needs_review", "required").otherwise("not_required"),
    }
