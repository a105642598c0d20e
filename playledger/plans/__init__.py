"""Compositions of operators: the recaps, the routing of plays, the report."""

from playledger.plans.recap import (
    SECTIONS,
    forgotten_songs,
    forgotten_songs_at,
    recap_table,
    recap_tables,
    recaps,
    top_albums,
    top_artists,
    top_songs,
)
from playledger.plans.report import report_bodies, report_sections
from playledger.plans.routing import route

__all__ = [
    "SECTIONS",
    "forgotten_songs",
    "forgotten_songs_at",
    "recap_table",
    "recap_tables",
    "recaps",
    "report_bodies",
    "report_sections",
    "route",
    "top_albums",
    "top_artists",
    "top_songs",
]
