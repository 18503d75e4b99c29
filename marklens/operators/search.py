"""Lookup by key and search in text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marklens.functions.text import contains_text, matches_pattern
from marklens.spec import DEFAULT_SPEC, ScorecardSpec


def find_by_key(df: DataFrame, key: int, spec: ScorecardSpec = DEFAULT_SPEC) -> DataFrame:
    """The record with this key; the filter reaches the scan's row-group statistics."""
    return df.filter(F.col(spec.key) == key).limit(1)


def find_by_keys(
    df: DataFrame, keys: DataFrame, spec: ScorecardSpec = DEFAULT_SPEC
) -> DataFrame:
    """Records whose key is in a key table; repeated keys collapse before the join."""
    return df.join(keys.select(spec.key).distinct(), spec.key, "left_semi")


def search(
    df: DataFrame, query: str, literal: bool = False, spec: ScorecardSpec = DEFAULT_SPEC
) -> DataFrame:
    """Records with the query in name or key; a blank query keeps all.

    The query is a regular expression unless ``literal`` is set.
    """
    if not query.strip():
        return df
    test = contains_text if literal else matches_pattern
    return df.filter(test(query, spec))
