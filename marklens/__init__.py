"""Scorecard analytics over tables of scored records, as Spark DataFrame plans."""

from marklens.spec import DEFAULT_SPEC, ScorecardSpec

__all__ = ["DEFAULT_SPEC", "ScorecardSpec"]
