"""Suggestions that go with a support category."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from marklens.spec import DEFAULT_SPEC, ScorecardSpec

# Three sentences for each category, in category order.
HIGH_SUPPORT = (
    "Review the topics with the lowest marks with a teacher or tutor.",
    "Build a manageable daily study routine and practise regularly.",
    "Check attendance barriers and seek help if classes are being missed.",
)
MODERATE_SUPPORT = (
    "Focus practice on the weakest subject.",
    "Aim for consistent attendance and review notes weekly.",
    "Track quiz results to see whether your study plan is helping.",
)
ON_TRACK = (
    "Maintain the current study routine and attendance.",
    "Practise challenging questions to deepen understanding.",
    "Review progress regularly rather than relying on one prediction.",
)


def _sentences(texts: tuple[str, ...]) -> Column:
    return F.array(*[F.lit(t) for t in texts])


def suggestions(category: str, spec: ScorecardSpec = DEFAULT_SPEC) -> Column:
    """Array of sentences; an unknown category gets the on-track ones."""
    high, moderate, _ = spec.support.categories
    return (
        F.when(F.col(category) == high, _sentences(HIGH_SUPPORT))
        .when(F.col(category) == moderate, _sentences(MODERATE_SUPPORT))
        .otherwise(_sentences(ON_TRACK))
    )
