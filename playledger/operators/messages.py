"""Topic records: rows to JSON values, and JSON values back to typed rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DateType, TimestampNTZType

from playledger.functions import parse_played_at, parse_release_date
from playledger.schemas import TOPICS

_CASTS = {DateType(): parse_release_date, TimestampNTZType(): parse_played_at}


def to_messages(rows: DataFrame, topic: str) -> DataFrame:
    """Each row as a record of the topic: JSON in UTF-8, null fields kept."""
    value = F.to_json(F.struct("*"), {"ignoreNullFields": "false"})
    return rows.select(value.cast("binary").alias("value"), F.lit(topic).alias("topic"))


def decode(records: DataFrame) -> DataFrame:
    """Topic records with the value as text, and with their origin if they have one."""
    return records.select(F.col("value").cast("string").alias("json_value"), "topic", *_origin(records))


def _origin(records: DataFrame) -> list[str]:
    return ["origin"] if "origin" in records.columns else []


def _typed(rows: DataFrame, topic: str, parsed: Column) -> DataFrame:
    casts = dict(TOPICS[topic].casts)

    def column(name: str) -> Column:
        value = parsed[name]
        return (_CASTS[casts[name]](value) if name in casts else value).alias(name)

    return rows.select(*[column(name) for name in TOPICS[topic].message.names])


def parse_topic(decoded: DataFrame, topic: str) -> DataFrame:
    """Rows of one topic, permissively typed: what does not fit its field is NULL.

    Malformed text gives a row of NULLs.
    """
    parsed = F.from_json("json_value", TOPICS[topic].message).alias("parsed_data")
    records = decoded.filter(F.col("topic") == topic).select(parsed)
    return _typed(records, topic, F.col("parsed_data"))


def parse_records(decoded: DataFrame) -> DataFrame:
    """Records of all topics, each parsed once, by its own schema.

    There is one struct column per topic, named like it and NULL for the records of the others.
    ``json_value`` is kept only for records that lack their key. Persist the result if more than
    one topic is taken from it: a filter on a parsed field would otherwise parse again.
    """
    structs = [
        F.when(F.col("topic") == name, F.from_json("json_value", spec.message)).alias(name)
        for name, spec in TOPICS.items()
    ]
    key = F.coalesce(*[F.col(name)[spec.key] for name, spec in TOPICS.items()])
    return decoded.select("topic", "json_value", *_origin(decoded), *structs).withColumn(
        "json_value", F.when(key.isNull(), F.coalesce("json_value", F.lit("")))
    )


def all_rows(parsed: DataFrame, topic: str) -> DataFrame:
    """Rows of one topic out of the parsed records, with or without their key."""
    return _typed(parsed.filter(F.col("topic") == topic), topic, F.col(topic))


def accepted(parsed: DataFrame, topic: str) -> DataFrame:
    """Rows of one topic out of the parsed records that have their key."""
    return all_rows(parsed.filter(F.col(topic)[TOPICS[topic].key].isNotNull()), topic)


def rejected(parsed: DataFrame) -> DataFrame:
    """Records without their key, as they came: ``topic, json_value``, and ``origin`` if they have one."""
    return parsed.filter(F.col("json_value").isNotNull()).select("topic", "json_value", *_origin(parsed))
