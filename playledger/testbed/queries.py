"""The registered queries, by name. Each takes a session and the folder of the test tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F

from playledger import plans
from playledger.functions import format_played_at, played_ms, week_bounds
from playledger.operators import entities as ent
from playledger.operators import listening as lis
from playledger.operators import messages as msg
from playledger.operators import plays as pl
from playledger.operators import report as rep
from playledger.operators.intervals import read_intervals, write_intervals
from playledger.operators.listening import PLAY_MS
from playledger.schemas import (
    ALBUM_TABLE,
    ALBUM_TOPIC,
    ARTIST_TABLE,
    ARTIST_TOPIC,
    FACT_TABLE,
    ITEM_TOPIC,
    SONG_TABLE,
    SONG_TOPIC,
)
from playledger.sources import (
    REJECTS_TABLE,
    FolderTopics,
    FolderWarehouse,
    shared_folder,
    stream_history,
    stream_pages,
)
from playledger.star import DIM_KEYS, Star
from playledger.streaming import BatchMetrics, Redelivery, dispatch, ingest, mend, with_arrival
from playledger.testbed import views as v

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

#: 2024-01-15T12:00:00.000Z and 2025-01-01T00:00:00.000Z
CURSOR_MS = 1_705_320_000_000
LATE_CURSOR_MS = 1_735_689_600_000

REPORT_DATES = (v.EVENTS_WEEK, v.EVENTS_END, v.EMPTY_WEEK)


def _as_text(df: DataFrame, *names: str) -> DataFrame:
    """Nullable numbers and dates as text, which compares alike on both engines."""
    return df.withColumns({name: F.col(name).cast("string") for name in names})


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


# --- recaps -------------------------------------------------------------------------------------


@query
def recap_top_songs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.top_songs(v.lineitem_star(spark, sf_dir), v.LINEITEM_WEEK)


@query
def recap_top_albums(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.top_albums(v.lineitem_star(spark, sf_dir), v.LINEITEM_WEEK)


@query
def recap_top_artists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.top_artists(v.lineitem_star(spark, sf_dir), v.LINEITEM_WEEK)


@query
def recap_forgotten_songs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.forgotten_songs(v.lineitem_star(spark, sf_dir), v.LINEITEM_END)


@query
def recap_forgotten_songs_past(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As it was on a date before most plays."""
    return plans.forgotten_songs(v.lineitem_star(spark, sf_dir), v.LINEITEM_PAST)


@query
def recap_top_songs_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.top_songs(v.events_star(spark, sf_dir), v.EVENTS_WEEK)


@query
def recap_top_albums_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.top_albums(v.events_star(spark, sf_dir), v.EVENTS_WEEK)


@query
def recap_top_artists_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.top_artists(v.events_star(spark, sf_dir), v.EVENTS_WEEK)


@query
def recap_forgotten_songs_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.forgotten_songs(v.events_star(spark, sf_dir), v.EVENTS_END)


@query
def recap_suite(spark: SparkSession, sf_dir: str) -> DataFrame:
    recap = plans.recap_table(v.events_star(spark, sf_dir), v.EVENTS_END)
    return _as_text(recap, "as_of", "total_minute_listened", "days_ago")


@query
def recap_suite_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The suite for several dates, from one scan of the plays; one date is given twice."""
    recap = plans.recap_tables(v.events_star(spark, sf_dir), [*REPORT_DATES, REPORT_DATES[0]])
    return _as_text(recap, "as_of", "total_minute_listened", "days_ago")


@query
def recap_forgotten_songs_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As it was on several days, one before all plays and one after, from the table of intervals."""
    star = v.lineitem_star(spark, sf_dir)
    path = shared_folder(spark, "intervals")
    write_intervals(star.fact, path)
    found = plans.forgotten_songs_at(read_intervals(star.fact.schema, path, spark), star, v.LINEITEM_DAYS)
    return _as_text(found.select("as_of", "rank", "song_name", "album_art", "last_played", "days_ago"), "as_of", "days_ago")


@query
def join_fact_song(spark: SparkSession, sf_dir: str) -> DataFrame:
    star = v.lineitem_star(spark, sf_dir)
    plays = lis.resolve(lis.plays_by(star.fact, "song_id"), star, "song_id")
    return plays.groupBy("song_id", "song_name").agg(
        F.sum("plays").alias("plays"), lis.listened_ms().alias("ms")
    )


@query
def join_fact_album(spark: SparkSession, sf_dir: str) -> DataFrame:
    star = v.lineitem_star(spark, sf_dir)
    plays = lis.resolve(lis.plays_by(star.fact, "album_id"), star, "album_id")
    return plays.groupBy("album_id", "album", "album_art").agg(F.sum("plays").alias("plays"))


@query
def join_fact_artist(spark: SparkSession, sf_dir: str) -> DataFrame:
    star = v.lineitem_star(spark, sf_dir)
    plays = lis.resolve(lis.plays_by(star.fact, "artist_id"), star, "artist_id")
    return plays.groupBy("artist_id", "artist").agg(F.sum("plays").alias("plays"))


@query
def week_bounds_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    plays = v.lineitem_star(spark, sf_dir).fact.select("played_at")
    plays = plays.unionAll(v.events_star(spark, sf_dir).fact.select("played_at"))
    day = F.col("played_at").cast("date")
    start, end = week_bounds(F.col("day"))
    return plays.select(day.alias("day")).distinct().select(
        F.col("day").cast("string").alias("day"), start.alias("week_start"), end.alias("week_end")
    )


@query
def week_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lis.in_week(v.events_star(spark, sf_dir).fact, v.EVENTS_WEEK)


@query
def minutes_by_song(spark: SparkSession, sf_dir: str) -> DataFrame:
    star = v.lineitem_star(spark, sf_dir)
    plays = lis.resolve(lis.plays_by(star.fact, "song_id"), star, "song_id")
    return lis.minutes_by(plays, "song_name")


@query
def last_played_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    star = v.lineitem_star(spark, sf_dir)
    plays = lis.resolve(lis.last_play_by(star.fact, "song_id"), star, "song_id")
    last = plays.groupBy("song_name").agg(F.max("last_played").alias("last_played"))
    as_of = F.lit(v.LINEITEM_END).cast("date")
    return last.withColumn("days_ago", F.datediff(as_of, "last_played"))


@query
def topk_tiebreak(spark: SparkSession, sf_dir: str) -> DataFrame:
    star = v.lineitem_star(spark, sf_dir)
    plays = lis.resolve(lis.plays_by(star.fact, "song_id"), star, "song_id")
    total = plays.groupBy("song_id", "song_name").agg(F.sum("plays").alias("plays"))
    return lis.top_k(total, 25, "plays", "song_id", "song_name")


@query
def unresolved_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    star = v.known_star(spark, sf_dir)
    return lis.unresolved(star.fact, star)


# --- topics -------------------------------------------------------------------------------------


def _messages(spark: SparkSession, sf_dir: str, topic: str) -> DataFrame:
    raw = v.entities(spark, sf_dir)
    rows = {
        SONG_TOPIC: lambda: ent.flatten_song(raw.song),
        ALBUM_TOPIC: lambda: ent.flatten_album(raw.album),
        ARTIST_TOPIC: lambda: ent.flatten_artist(raw.artist),
        ITEM_TOPIC: lambda: pl.fact_rows(pl.explode_plays(v.history_pages(spark, sf_dir))),
    }[topic]
    return msg.to_messages(rows(), topic)


@query
def parse_song_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return msg.parse_topic(msg.decode(_messages(spark, sf_dir, SONG_TOPIC)), SONG_TOPIC)


@query
def parse_album_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = msg.parse_topic(msg.decode(_messages(spark, sf_dir, ALBUM_TOPIC)), ALBUM_TOPIC)
    return _as_text(rows, "release_date")


@query
def parse_artist_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return msg.parse_topic(msg.decode(_messages(spark, sf_dir, ARTIST_TOPIC)), ARTIST_TOPIC)


@query
def parse_item_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = v.lineitem_star(spark, sf_dir).fact
    plays = fact.withColumn("played_at", format_played_at(F.col("played_at")))
    records = msg.decode(msg.to_messages(pl.fact_rows(plays), ITEM_TOPIC))
    return msg.parse_topic(records, ITEM_TOPIC)


@query
def parse_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = msg.parse_topic(msg.decode(v.broken_messages(spark, sf_dir)), SONG_TOPIC)
    counted = rows.groupBy(*rows.columns).agg(F.count("*").alias("n")).select(
        "song_id", "title", "duration_ms", "explicit", "popularity", "n"
    )
    return _as_text(counted, "duration_ms", "explicit", "popularity")


@query
def rejected_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return msg.rejected(msg.parse_records(msg.decode(v.broken_messages(spark, sf_dir))))


def _table_counts(spark: SparkSession, warehouse: FolderWarehouse) -> DataFrame:
    total = {
        SONG_TABLE: F.sum("duration_ms"),
        ALBUM_TABLE: F.sum("total_tracks"),
        ARTIST_TABLE: F.sum("follower_count"),
        FACT_TABLE: F.sum(F.date_part(F.lit("DAY"), "played_at")),
        REJECTS_TABLE: F.sum(F.length("json_value")),
    }
    key = {
        SONG_TABLE: "song_id",
        ALBUM_TABLE: "album_id",
        ARTIST_TABLE: "artist_id",
        FACT_TABLE: "song_id",
        REJECTS_TABLE: "topic",
    }
    return _union(
        [
            warehouse.read(spark, table).agg(
                F.lit(table).alias("table_name"),
                F.count("*").alias("n_rows"),
                F.count_distinct(key[table]).alias("n_keys"),
                total[table].cast("bigint").alias("total"),
            )
            for table in total
        ]
    )


@query
def stream_dispatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All four topics and broken records through the stream; songs are published twice."""
    root = shared_folder(spark, "stream-dispatch")
    topics, warehouse = FolderTopics(f"{root}/topics"), FolderWarehouse(f"{root}/warehouse")
    names = (SONG_TOPIC, ALBUM_TOPIC, ARTIST_TOPIC, ITEM_TOPIC, SONG_TOPIC)
    records = [_messages(spark, sf_dir, name) for name in names]
    topics.append(_union([*records, v.broken_messages(spark, sf_dir)]), "first")
    for _ in range(2):  # the second run finds nothing new
        stream = topics.read_stream(spark)
        dispatch(stream, warehouse, f"{root}/checkpoint", {"availableNow": True}).awaitTermination()
    return _table_counts(spark, warehouse)


#: Ends of the first batches of plays, and what lies past all of them.
CUTS = ("2024-01-08", "2024-01-16", "2024-01-24")
HEARTBEAT = "2100-01-01"
DELAY, WAIT, BEFORE = "36 hours", "3 days", "10 days"


@query
def redelivered_plays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plays in batches that each hold all plays until a time, so that those of the batches before are delivered again."""
    root = shared_folder(spark, "redelivered")
    topics, warehouse = FolderTopics(f"{root}/topics"), FolderWarehouse(f"{root}/warehouse")
    again = Redelivery(f"{root}/staged", DELAY)
    plays = v.events_star(spark, sf_dir).fact
    plays = plays.withColumn("played_at", format_played_at(F.col("played_at")))
    for cut in (*CUTS, HEARTBEAT):
        topics.append(msg.to_messages(plays.filter(F.col("played_at") < cut), ITEM_TOPIC), cut)
        dispatch(topics.read_stream(spark), warehouse, f"{root}/dispatch", {"availableNow": True},
                 redelivery=again).awaitTermination()
        again.settle(spark, warehouse, f"{root}/settle", {"availableNow": True}).awaitTermination()
    rejects = warehouse.read(spark, REJECTS_TABLE)
    late = msg.parse_topic(rejects.select("json_value", "topic"), ITEM_TOPIC).drop("played_at")
    late = late.withColumn("played_at", F.lit(None).cast("timestamp_ntz"))
    found = warehouse.read(spark, FACT_TABLE).drop("play_date").withColumn("rejected", F.lit(False))
    every = found.unionByName(late.withColumn("rejected", F.lit(True)))
    return every.groupBy("rejected", "song_id", "album_id", "artist_id", "played_at").agg(F.count("*").alias("n"))


@query
def late_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plays that wait for the arrival of their song's details, in batches by time; both streams end with a heartbeat."""
    root = shared_folder(spark, "late")
    plays = v.events_star(spark, sf_dir).fact
    arrivals = v.song_arrivals(spark, sf_dir)
    beat = F.lit(HEARTBEAT).cast("timestamp_ntz")
    for rows, time, name in ((plays, "played_at", "plays"), (arrivals, "arrived_at", "arrivals")):
        for start, end in zip(("1970-01-01", *CUTS), (*CUTS, HEARTBEAT)):
            part = rows.filter((F.col(time) >= start) & (F.col(time) < end))
            part.coalesce(1).write.mode("append").parquet(f"{root}/{name}")
        nobody = [F.lit(-1).cast(f.dataType).alias(f.name) for f in rows.schema if f.name != time]
        spark.range(1).select(*nobody, beat.alias(time)).coalesce(1).write.mode("append").parquet(f"{root}/{name}")
    streams = [
        spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/{name}")
        for rows, name in ((plays, "plays"), (arrivals, "arrivals"))
    ]
    found = with_arrival(*streams, "song_id", WAIT, BEFORE)
    sink = found.writeStream.format("parquet").option("checkpointLocation", f"{root}/checkpoint")
    sink.trigger(availableNow=True).start(f"{root}/found").awaitTermination()
    settled = spark.read.schema(found.schema).parquet(f"{root}/found")
    return settled.filter(F.col("played_at") < HEARTBEAT)


@query
def mended_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Broken records, rejected with their origin; two runs mend them, the second all that the first did and more, and is run twice."""
    root = shared_folder(spark, "mended")
    topics, warehouse = FolderTopics(f"{root}/topics"), FolderWarehouse(f"{root}/warehouse")
    topics.append(v.broken_messages(spark, sf_dir), "first")
    dispatch(topics.read_stream(spark), warehouse, f"{root}/checkpoint", {"availableNow": True}).awaitTermination()
    rejects = warehouse.batches(spark, REJECTS_TABLE).drop("batch")
    cut_off = F.col("json_value").contains("cut off")
    title = F.get_json_object("json_value", "$.title")
    closed = F.concat(F.col("json_value"), F.lit('"}'))
    named = F.concat(F.lit('{"song_id":"user '), title, F.lit('","title":"mended"}'))
    first = rejects.filter(cut_off).select("origin", closed.alias("json_value"))
    second = first.withColumn("json_value", F.lit('{"song_id":"too late"}'))
    # Those of the users are mended to one key each, of which one row stays.
    second = second.union(rejects.filter(~cut_off & (F.length(title) > 1)).select("origin", named))
    for run, records in (("m.0", first), ("m.1", second), ("m.1", second)):
        rest = mend(spark, warehouse, records, run)
    songs = warehouse.read(spark, SONG_TABLE).select(F.lit("song").alias("kind"), F.col("song_id").alias("value"), "title")
    still = rest.select(F.lit("rejected").alias("kind"), F.col("json_value").alias("value"), F.lit(None).cast("string").alias("title"))
    return songs.union(still).groupBy("kind", "value", "title").agg(F.count("*").alias("n"))


@query
def batch_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records and rejects by batch and topic, out of what the streams have observed."""
    root = shared_folder(spark, "metrics")
    topics, warehouse = FolderTopics(f"{root}/topics"), FolderWarehouse(f"{root}/warehouse")
    metrics = BatchMetrics(spark, f"{root}/metrics")
    spark.streams.addListener(metrics)
    try:
        songs = _messages(spark, sf_dir, SONG_TOPIC)
        others = [_messages(spark, sf_dir, name) for name in (ALBUM_TOPIC, ARTIST_TOPIC, ITEM_TOPIC)]
        for name, records in (("first", [songs, *others]), ("second", [songs, v.broken_messages(spark, sf_dir)])):
            topics.append(_union(records), name)
            stream = dispatch(topics.read_stream(spark), warehouse, f"{root}/checkpoint", {"availableNow": True})
            stream.awaitTermination()
            if not metrics.wait(stream.runId):
                raise TimeoutError("the listener has not seen the end of the query")
    finally:
        spark.streams.removeListener(metrics)
    return metrics.read().select("batch_id", "topic", "n_records", "n_rejects")


@query
def warehouse_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Append, replay and read back every table."""
    warehouse = FolderWarehouse(shared_folder(spark, "warehouse"))
    for topic, table in ((SONG_TOPIC, SONG_TABLE), (ALBUM_TOPIC, ALBUM_TABLE),
                         (ARTIST_TOPIC, ARTIST_TABLE), (ITEM_TOPIC, FACT_TABLE)):
        rows = msg.parse_topic(msg.decode(_messages(spark, sf_dir, topic)), topic)
        for batch in ("a.0", "a.0", "a.1"):
            warehouse.append(rows, table, batch)
    warehouse.append(rejected_records(spark, sf_dir), REJECTS_TABLE, "a.0")
    return _table_counts(spark, warehouse)


@query
def compaction_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches of two streams, merged twice, with replays of the newest in between."""
    warehouse = FolderWarehouse(shared_folder(spark, "compaction"))
    for topic, table in ((SONG_TOPIC, SONG_TABLE), (ALBUM_TOPIC, ALBUM_TABLE),
                         (ARTIST_TOPIC, ARTIST_TABLE), (ITEM_TOPIC, FACT_TABLE)):
        # Parsed once for all batches.
        rows = msg.parse_topic(msg.decode(_messages(spark, sf_dir, topic)), topic).persist(StorageLevel.DISK_ONLY)
        for batches in (("a.0", "a.1", "a.2", "b.0"), ("a.2", "a.3", "b.0", "b.1"), ("a.3",)):
            for batch in batches:
                warehouse.append(rows, table, batch)
            warehouse.compact(spark, table)
        rows.unpersist()
    warehouse.append(rejected_records(spark, sf_dir), REJECTS_TABLE, "a.0")
    return _table_counts(spark, warehouse)


@query
def pipeline_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """History pages to recaps through both streams."""
    root = shared_folder(spark, "pipeline")
    v.history_pages(spark, sf_dir).write.json(f"{root}/pages")
    raw = v.entities(spark, sf_dir)
    raw.song.write.parquet(f"{root}/entities/song")
    raw.album.write.parquet(f"{root}/entities/album")
    raw.artist.write.parquet(f"{root}/entities/artist")
    topics, warehouse = FolderTopics(f"{root}/topics"), FolderWarehouse(f"{root}/warehouse")
    once = {"availableNow": True}
    ingest(stream_pages(spark, f"{root}/pages"), warehouse, f"{root}/entities", topics,
           f"{root}/ingest", once).awaitTermination()
    dispatch(topics.read_stream(spark), warehouse, f"{root}/dispatch", once).awaitTermination()
    recap = plans.recap_table(warehouse.star(spark), v.EVENTS_END)
    return _as_text(recap, "as_of", "total_minute_listened", "days_ago")


@query
def recap_suite_from_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The suite for several dates from counts kept per batch: late plays come in a second batch, which is written twice."""
    star = v.star_of_text_ids(v.events_star(spark, sf_dir))
    warehouse = FolderWarehouse(shared_folder(spark, "counted"), keep_counts=True)
    plays = star.fact.select(*[F.col(k).cast("string").alias(k) for k in DIM_KEYS], "played_at")
    late = F.expr("dayofweek(played_at)").isin(2, 5)
    for batch, part in (("a.0", plays.filter(~late)), ("a.1", plays.filter(late)), ("a.1", plays.filter(late))):
        warehouse.append(part, FACT_TABLE, batch)
    counts = warehouse.counted_star(spark).fact
    recap = plans.recap_tables(Star(counts, star.song, star.album, star.artist), [*REPORT_DATES, REPORT_DATES[0]])
    return _as_text(recap, "as_of", "total_minute_listened", "days_ago")


# --- ingest -------------------------------------------------------------------------------------


def _plays(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pl.explode_plays(v.history_pages(spark, sf_dir))


@query
def explode_plays(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plays(spark, sf_dir)


@query
def history_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All plays through the history source: those up to a time, and after a restart those that came since."""
    root = shared_folder(spark, "history")
    plays = _plays(spark, sf_dir).withColumn(PLAY_MS, played_ms(F.col("played_at")))
    for part in (F.col(PLAY_MS) <= CURSOR_MS, F.col(PLAY_MS) > CURSOR_MS):
        plays.filter(part).write.mode("append").parquet(f"{root}/history")
        stream = stream_history(spark, f"{root}/history", after=0, range_ms=str(86_400_000))
        sink = stream.writeStream.format("parquet").option("checkpointLocation", f"{root}/checkpoint")
        sink.trigger(availableNow=True).start(f"{root}/plays").awaitTermination()
    return spark.read.schema(plays.drop(PLAY_MS).schema).parquet(f"{root}/plays")


@query
def event_id_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    plays = pl.with_event_id(_plays(spark, sf_dir))
    return plays.agg(
        F.count("*").alias("n_plays"),
        F.count_distinct("id").alias("n_ids"),
        F.count_if(F.col("id").rlike("^[0-9a-f]{32}$")).alias("n_hex"),
    )


@query
def flatten_song(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ent.flatten_song(v.entities(spark, sf_dir).song)


@query
def flatten_album(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ent.flatten_album(v.entities(spark, sf_dir).album)


@query
def flatten_artist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ent.flatten_artist(v.entities(spark, sf_dir).artist)


@query
def preview_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    songs = ent.flatten_song(v.entities(spark, sf_dir).song)
    kind = F.when(F.col("preview_url").isNull(), "null").when(
        F.col("preview_url").startswith("http"), "url"
    )
    return songs.groupBy(kind.otherwise(F.col("preview_url")).alias("preview")).agg(
        F.count("*").alias("n"), F.min("popularity").alias("least"), F.max("popularity").alias("most")
    )


@query
def route_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = v.star_of_text_ids(v.known_star(spark, sf_dir))
    # On disk: in memory a task would hold all plays of a file that cannot be split.
    plays = _plays(spark, sf_dir).persist(StorageLevel.DISK_ONLY)
    records = msg.decode(plans.route(plays, known, v.entities(spark, sf_dir)))
    key = F.coalesce(*[F.get_json_object("json_value", f"$.{k}")
                       for k in ("song_id", "album_id", "artist_id")])
    return records.groupBy("topic").agg(
        F.count("*").alias("n_messages"),
        F.count_distinct(key).alias("n_keys"),
        F.sum(key.cast("bigint")).alias("key_sum"),
    )


def _new_keys(spark: SparkSession, sf_dir: str, key: str) -> DataFrame:
    known = v.known_star(spark, sf_dir)
    return ent.new_keys(known.fact, known.dim(key), key)


@query
def new_keys_song(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _new_keys(spark, sf_dir, "song_id")


@query
def new_keys_album(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _new_keys(spark, sf_dir, "album_id")


@query
def new_keys_artist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _new_keys(spark, sf_dir, "artist_id")


@query
def enrich_new_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Details of the new albums. The landing table has three copies of each: an old one whose text is
    the greatest, the newest, and one without a time."""
    keys = _new_keys(spark, sf_dir, "album_id").withColumn(
        "album_id", F.col("album_id").cast("string")
    )
    raw = v.entities(spark, sf_dir).album
    stale = F.concat(F.lit('{"popularity":-1,"name":"~old~ '), F.col("album_id"), F.lit('"}'))
    old = raw.withColumn("payload", stale).withColumn(
        "fetched_at", F.lit("2023-06-01 00:00:00").cast("timestamp_ntz")
    )
    unknown = old.withColumn("fetched_at", F.lit(None).cast("timestamp_ntz"))
    copies = old.unionByName(raw).unionByName(unknown)
    return ent.flatten_album(ent.enrich(keys, copies, "album_id")).select(
        "album_id", "title", "total_tracks", "release_date", "popularity"
    )


@query
def batch_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    plays = _plays(spark, sf_dir)
    return _union(
        [
            pl.batch_summary(pl.plays_after(plays, after)).withColumn("after_ms", F.lit(after))
            for after in (0, CURSOR_MS, LATE_CURSOR_MS)
        ]
    ).withColumn("after_ms", F.col("after_ms").cast("bigint"))


@query
def plays_after_cursor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pl.plays_after(_plays(spark, sf_dir), CURSOR_MS)


# --- report -------------------------------------------------------------------------------------


@query
def report_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_text(rep.cards(plans.recap_table(v.events_star(spark, sf_dir), v.EVENTS_END)), "as_of")


@query
def report_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_text(plans.report_sections(v.events_star(spark, sf_dir), REPORT_DATES), "as_of")


@query
def report_body(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_text(plans.report_bodies(v.events_star(spark, sf_dir), REPORT_DATES), "as_of")


@query
def reply_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rep.reply_fields(v.replies(spark, sf_dir))


@query
def report_final(spark: SparkSession, sf_dir: str) -> DataFrame:
    bodies = plans.report_bodies(v.events_star(spark, sf_dir), REPORT_DATES)
    return _as_text(rep.final_report(bodies, v.report_replies(spark, sf_dir)), "as_of")
