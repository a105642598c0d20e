"""Message, payload and warehouse schemas, and the topic registry.

Field names, topic names, table names and the timestamp format are fixed values: producers and
existing warehouses depend on them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# --- fixed values -------------------------------------------------------------------------------
SONG_TOPIC = "song_topic"
ALBUM_TOPIC = "album_topic"
ARTIST_TOPIC = "artist_topic"
ITEM_TOPIC = "item_topic"

SONG_TABLE = "dim_song"
ALBUM_TABLE = "dim_album"
ARTIST_TABLE = "dim_artist"
FACT_TABLE = "fact_history"

#: Key of the link to an entity's page in the payload's ``external_urls``.
LINK_FIELD = "spotify"
NO_PREVIEW = "No preview available"
NO_DATA = "No data available"

#: Recap sections in report order, by number.
SECTION_NAMES = {
    1: "Top 10 Songs",
    2: "Top 5 Albums",
    3: "Top 5 Artists",
    4: "Songs you haven't listened to in a while",
}
#: Texts of the cards and headings of a report.
BY_ARTIST = "by "
MINUTES_LISTENED = "m listened"
WAS_PLAYED, DAYS_AGO = "was played ", " days ago"
RECAPS_HEADING, RECOMMENDATIONS_HEADING = "Recaps", "Recommendations"
# ------------------------------------------------------------------------------------------------

STRING, INT, BOOLEAN = T.StringType(), T.IntegerType(), T.BooleanType()


def struct(**fields: T.DataType) -> T.StructType:
    """A struct type of nullable fields, in the order given."""
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


SONG_MESSAGE = struct(
    song_id=STRING,
    title=STRING,
    disc_number=INT,
    duration_ms=INT,
    explicit=BOOLEAN,
    external_url=STRING,
    preview_url=STRING,
    popularity=INT,
)
ALBUM_MESSAGE = struct(
    album_id=STRING,
    title=STRING,
    total_tracks=INT,
    release_date=STRING,
    external_url=STRING,
    image_url=STRING,
    label=STRING,
    popularity=INT,
)
ARTIST_MESSAGE = struct(
    artist_id=STRING,
    name=STRING,
    external_url=STRING,
    follower_count=INT,
    image_url=STRING,
    popularity=INT,
)
ITEM_MESSAGE = struct(song_id=STRING, album_id=STRING, artist_id=STRING, played_at=STRING)

#: One page of play history as the service returns it.
HISTORY_PAYLOAD = struct(
    items=T.ArrayType(
        struct(
            played_at=STRING,
            track=struct(
                id=STRING,
                album=struct(id=STRING),
                artists=T.ArrayType(struct(id=STRING)),
            ),
        )
    )
)
#: The five texts a recap reply must carry.
REPLY = struct(
    opening_statement=STRING,
    weekly_recap=STRING,
    mood_recap=STRING,
    recommendations=STRING,
    closing_statement=STRING,
)

#: A topic record as the broker source delivers it.
TOPIC_RECORD = struct(value=T.BinaryType(), topic=STRING)


@dataclass(frozen=True)
class Topic:
    """How the records of one topic become rows of one warehouse table.

    ``key`` is the column without which a row can never take part in a recap: the id of a
    dimension, and the song of a play (every recap joins the song).
    """

    name: str
    table: str
    key: str
    message: T.StructType
    casts: tuple[tuple[str, T.DataType], ...] = ()

    @property
    def row(self) -> T.StructType:
        """Schema of the parsed rows, after the casts."""
        casts = dict(self.casts)
        return T.StructType(
            [T.StructField(f.name, casts.get(f.name, f.dataType)) for f in self.message]
        )

    @property
    def is_fact(self) -> bool:
        return self.table == FACT_TABLE


#: Dimensions come first: a batch writes them before the plays that refer to them.
TOPICS: dict[str, Topic] = {
    t.name: t
    for t in (
        Topic(SONG_TOPIC, SONG_TABLE, "song_id", SONG_MESSAGE),
        Topic(ALBUM_TOPIC, ALBUM_TABLE, "album_id", ALBUM_MESSAGE,
              (("release_date", T.DateType()),)),
        Topic(ARTIST_TOPIC, ARTIST_TABLE, "artist_id", ARTIST_MESSAGE),
        Topic(ITEM_TOPIC, FACT_TABLE, "song_id", ITEM_MESSAGE,
              (("played_at", T.TimestampNTZType()),)),
    )
}

TABLES: dict[str, Topic] = {t.table: t for t in TOPICS.values()}
