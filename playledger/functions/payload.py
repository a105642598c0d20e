"""Expressions over raw service payloads."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def first_field(items: Column, field: str) -> Column:
    """Field of the first array element; NULL if the array is empty or NULL."""
    return F.get(items, 0)[field]
