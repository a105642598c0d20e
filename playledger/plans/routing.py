"""Fan-out of plays to the four topics."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame

from playledger.operators.entities import (
    enrich,
    flatten_album,
    flatten_artist,
    flatten_song,
    new_keys,
)
from playledger.operators.messages import to_messages
from playledger.operators.plays import fact_rows
from playledger.schemas import ALBUM_TOPIC, ARTIST_TOPIC, ITEM_TOPIC, SONG_TOPIC
from playledger.sources.landing import Entities
from playledger.star import Dimensions, Star

_DETAILS = (
    ("song_id", SONG_TOPIC, flatten_song),
    ("album_id", ALBUM_TOPIC, flatten_album),
    ("artist_id", ARTIST_TOPIC, flatten_artist),
)


def route(plays: DataFrame, known: Dimensions | Star, entities: Entities) -> DataFrame:
    """Topic records of a batch of plays: details of each key not known yet, and every play.

    ``plays`` is read once per topic; persist it if it is expensive to compute. Of
    ``known`` only the dimensions are read.
    """

    def details(key: str, topic: str, flatten: Callable[[DataFrame], DataFrame]) -> DataFrame:
        keys = new_keys(plays, known.dim(key), key, persisted=plays.is_cached)
        return to_messages(flatten(enrich(keys, entities.raw(key), key)), topic)

    items = to_messages(fact_rows(plays), ITEM_TOPIC)
    return reduce(DataFrame.unionByName, [*[details(*d) for d in _DETAILS], items])
