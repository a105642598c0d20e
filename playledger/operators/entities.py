"""Operators over songs, albums and artists: which are new, and their details.

Landing tables hold one JSON text per fetch of an entity: ``(<key>, payload, fetched_at)``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from playledger.schemas import BOOLEAN, INT, LINK_FIELD, NO_PREVIEW, STRING


def without_known(rows: DataFrame, known: DataFrame, key: str, many: bool = False) -> DataFrame:
    """Rows whose key is not among the known ones.

    The known keys are first cut down to those of the rows. If the rows are a persisted batch, Spark
    knows their size: a small batch is broadcast and the known keys are scanned in place; otherwise
    they are shuffled, once. ``many``: the keys of the rows are not to be broadcast, even if their files are small.
    """
    keys = rows.select(key)
    ours = known.select(key).join(keys.hint("merge") if many else keys, key, "left_semi")
    return rows.join(ours, key, "left_anti")


def new_keys(plays: DataFrame, dim: DataFrame, key: str, persisted: bool = False) -> DataFrame:
    """Distinct non-null keys of the plays that the dimension does not hold yet.

    The keys are made distinct map-side before they are shuffled, so a key that most plays share
    costs one row per task. Plays and dimension are scanned once. ``persisted``: the plays are a batch that is held, so that it
    costs little to cut the known keys down to its own first.
    """
    keys = plays.select(key).filter(F.col(key).isNotNull()).dropDuplicates([key])
    return without_known(keys, dim, key) if persisted else keys.join(dim.select(key), key, "left_anti")


def enrich(keys: DataFrame, raw: DataFrame, key: str) -> DataFrame:
    """Landing rows of the given keys, ``<key>, payload``, one per key; keys without details give no
    row.

    Of several copies of one entity the one fetched last wins; equal or unknown times go by the
    greater text, so that the pick is the same on every run. The landing rows are cut down to the
    keys before the copies are merged, so that no payload of another entity is sorted.
    """
    wanted = raw.join(keys.select(key), key, "left_semi")
    latest = F.max(F.struct("fetched_at", "payload")).alias("latest")
    return wanted.groupBy(key).agg(latest).select(key, "latest.payload")


def _read(raw: DataFrame, key: str, **fields: tuple[str, T.DataType] | Column) -> DataFrame:
    """Landing rows as messages: the payload is parsed once, and each field read from it by path.

    A number or truth value of another type than the field's gives NULL; any value but a null counts as text.
    Text that is no JSON gives NULLs.
    """

    def value(path: str, kind: T.DataType) -> Column:
        found = F.try_variant_get(_PARSED, path, kind.simpleString())
        if isinstance(kind, T.StringType):
            return found
        return F.when(F.schema_of_variant(F.try_variant_get(_PARSED, path, "variant")) == _JSON_TYPES[type(kind)], found)

    columns = [(f if isinstance(f, Column) else value(*f)).alias(name) for name, f in fields.items()]
    return raw.select(key, F.try_parse_json("payload").alias("parsed")).select(key, *columns)


_PARSED = "parsed"
#: How the types of JSON values are called that fit a field.
_JSON_TYPES = {T.IntegerType: "BIGINT", T.BooleanType: "BOOLEAN"}
_LINK = f"$.external_urls.{LINK_FIELD}"


def flatten_song(raw: DataFrame) -> DataFrame:
    """Song landing rows as song messages. A song without a preview key has the default; a null preview stays null."""
    preview = F.try_variant_get(_PARSED, "$.preview_url", "variant")
    is_object = F.schema_of_variant(_PARSED).startswith("OBJECT")
    return _read(
        raw,
        "song_id",
        title=("$.name", STRING),
        disc_number=("$.disc_number", INT),
        duration_ms=("$.duration_ms", INT),
        explicit=("$.explicit", BOOLEAN),
        external_url=(_LINK, STRING),
        preview_url=F.when(preview.isNull() & is_object, F.lit(NO_PREVIEW)).otherwise(
            F.try_variant_get(_PARSED, "$.preview_url", "string")
        ),
        popularity=("$.popularity", INT),
    )


def flatten_album(raw: DataFrame) -> DataFrame:
    """Album landing rows as album messages."""
    return _read(
        raw,
        "album_id",
        title=("$.name", STRING),
        total_tracks=("$.total_tracks", INT),
        release_date=("$.release_date", STRING),
        external_url=(_LINK, STRING),
        image_url=("$.images[0].url", STRING),
        label=("$.label", STRING),
        popularity=("$.popularity", INT),
    )


def flatten_artist(raw: DataFrame) -> DataFrame:
    """Artist landing rows as artist messages."""
    return _read(
        raw,
        "artist_id",
        name=("$.name", STRING),
        external_url=(_LINK, STRING),
        follower_count=("$.followers.total", INT),
        image_url=("$.images[0].url", STRING),
        popularity=("$.popularity", INT),
    )
