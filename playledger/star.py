"""The warehouse star: one table of plays and three dimensions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class Dimensions:
    """Songs, albums and artists, without the plays."""

    song: DataFrame
    album: DataFrame
    artist: DataFrame

    def dim(self, key: str) -> DataFrame:
        """The dimension that ``key`` identifies."""
        return {"song_id": self.song, "album_id": self.album, "artist_id": self.artist}[key]


@dataclass(frozen=True)
class Star:
    """Plays (song_id, album_id, artist_id, played_at) and the dimensions they refer to."""

    fact: DataFrame
    song: DataFrame
    album: DataFrame
    artist: DataFrame

    def dim(self, key: str) -> DataFrame:
        """The dimension that ``key`` identifies."""
        return {"song_id": self.song, "album_id": self.album, "artist_id": self.artist}[key]


#: The id columns of a play, one for each dimension.
DIM_KEYS = ("song_id", "album_id", "artist_id")
