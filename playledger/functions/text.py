"""Text expressions: escaping for markup, and cleaning of fenced replies."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The ampersand has to come first, or it would escape the other entities again.
_ENTITIES = (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#39;"))


def escape_markup(value: Column) -> Column:
    """Value as markup-safe text; NULL becomes the empty text."""
    text = F.coalesce(value.cast("string"), F.lit(""))
    for raw, entity in _ENTITIES:
        text = F.replace(text, F.lit(raw), F.lit(entity))
    return text


def strip_fences(reply: Column) -> Column:
    """Reply without code fences: every opening ```json, then every remaining ```."""
    opened = F.replace(reply, F.lit("```json"), F.lit(""))
    return F.replace(opened, F.lit("```"), F.lit(""))
