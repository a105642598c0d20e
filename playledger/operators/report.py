"""Operators of the recap report: cards, sections, bodies, replies, final text.

All of them work on tables with one report per ``as_of``. A section holds at most k cards and a
report four sections, so the ordered text aggregates stay small however many reports there are.
The markup is minimal and its values are escaped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from playledger.functions import escape_markup, strip_fences
from playledger.schemas import (
    BY_ARTIST,
    DAYS_AGO,
    MINUTES_LISTENED,
    NO_DATA,
    RECAPS_HEADING,
    RECOMMENDATIONS_HEADING,
    REPLY,
    SECTION_NAMES,
    WAS_PLAYED,
)


def _text(name: str) -> Column:
    return escape_markup(F.col(name))


def _card(cover: Column | None, title: str, *lines: Column) -> Column:
    start = F.lit("<div class='play'>")
    if cover is not None:
        start = F.concat(F.lit("<div class='play' style='background-image: url("), cover,
                         F.lit(");'>"))
    body = [F.concat(F.lit("<p>"), line, F.lit("</p>")) for line in lines]
    return F.concat(start, F.lit("<b>"), _text(title), F.lit("</b>"), *body, F.lit("</div>"))


def cards(recap: DataFrame) -> DataFrame:
    """A recap table with one card text per row: ``as_of, section_no, rank, card``."""
    cover = _text("album_art")
    by_artist = F.concat(F.lit(BY_ARTIST), _text("artist"))
    listened = F.concat(_text("total_minute_listened"), F.lit(MINUTES_LISTENED))
    last = F.concat(F.lit(WAS_PLAYED), _text("days_ago"), F.lit(DAYS_AGO))
    number = F.col("section_no")
    card = (
        F.when(number == 1, _card(cover, "song_name", by_artist, listened))
        .when(number == 2, _card(cover, "album", by_artist, listened))
        .when(number == 3, _card(None, "artist", listened))
        .when(number == 4, _card(cover, "song_name", last))
    )
    return recap.select("as_of", "section_no", "rank", card.alias("card"))


def sections(cards: DataFrame, reports: DataFrame) -> DataFrame:
    """Section texts of each report, cards in rank order: ``as_of, section_no, section, html``.

    ``reports`` lists the reports by ``as_of``. Each gets all four sections; one without cards
    says so.
    """
    listed = F.array(
        *[
            F.struct(F.lit(number).alias("section_no"), F.lit(name).alias("section"))
            for number, name in SECTION_NAMES.items()
        ]
    )
    wanted = reports.select("as_of", F.inline(listed))
    filled = cards.groupBy("as_of", "section_no").agg(
        F.expr("listagg(card, '') WITHIN GROUP (ORDER BY rank)").alias("cards")
    )
    heading = F.concat(F.lit("<h3>"), F.col("section"), F.lit("</h3>"))
    content = F.coalesce(
        F.concat(F.lit("<div class='plays'>"), F.col("cards"), F.lit("</div>")),
        F.lit(f"<p>{NO_DATA}</p>"),
    )
    return wanted.join(filled, ["as_of", "section_no"], "left").select(
        "as_of", "section_no", "section", F.concat(heading, content).alias("html")
    )


def body(sections: DataFrame) -> DataFrame:
    """Sections in order as one text per report: ``as_of, body``."""
    return sections.groupBy("as_of").agg(
        F.expr("listagg(html, '') WITHIN GROUP (ORDER BY section_no)").alias("body")
    )


def reply_fields(replies: DataFrame) -> DataFrame:
    """The five texts of each reply, and ``is_valid`` if none is missing.

    ``replies`` has a text column ``reply``; its other columns are kept. A reply that cannot be
    read gives NULLs.
    """
    others = [c for c in replies.columns if c != "reply"]
    parsed = replies.select(*others, F.from_json(strip_fences(F.col("reply")), REPLY).alias("r"))
    complete = [F.col("r")[name].isNotNull() for name in REPLY.names]
    valid = complete[0]
    for present in complete[1:]:
        valid &= present
    return parsed.select(*others, "r.*", valid.alias("is_valid"))


def final_report(bodies: DataFrame, replies: DataFrame) -> DataFrame:
    """Report documents: ``as_of, is_valid, html``.

    Order: opening, weekly recap, mood recap, the recap sections, recommendations, closing. A
    report without a readable reply keeps its sections, and is flagged as not valid. Of several
    replies for one date a complete one is used; among those, the one with the greatest texts.
    """
    fields = reply_fields(replies.select("as_of", "reply"))
    texts = F.struct("is_valid", *REPLY.names)
    chosen = fields.groupBy("as_of").agg(F.max(texts).alias("r")).select("as_of", "r.*")
    joined = bodies.join(chosen, "as_of", "left")

    def paragraph(name: str) -> Column:
        return F.concat(F.lit("<p>"), _text(name), F.lit("</p>"))

    html = F.concat_ws(
        "\n",
        F.lit("<html><body>"),
        paragraph("opening_statement"),
        F.lit(f"<h2>{RECAPS_HEADING}</h2>"),
        paragraph("weekly_recap"),
        paragraph("mood_recap"),
        F.col("body"),
        F.lit(f"<h2>{RECOMMENDATIONS_HEADING}</h2>"),
        paragraph("recommendations"),
        paragraph("closing_statement"),
        F.lit("</body></html>"),
    )
    valid = F.coalesce(F.col("is_valid"), F.lit(False))
    return joined.select("as_of", valid.alias("is_valid"), html.alias("html"))
