"""Time a weekly recap of generated plays, a third of which are of one song.

    python tools/hot_key.py [number of plays]

Broadcast joins are off, as for dimensions beyond the threshold. The recap is timed as the library
plans it, and with the plays joined before they are aggregated.
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession, functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from playledger.operators.listening import in_week, resolve, top_k, whole_minutes  # noqa: E402
from playledger.plans import top_songs  # noqa: E402
from playledger.star import DIM_KEYS, Star  # noqa: E402

AS_OF = "2024-07-03"
SONGS = 500_000
NAMES = ("song_name", "album", "artist", "album_art")


def generated_star(spark: SparkSession, plays: int) -> Star:
    def pick(salt: int, n: int):
        return F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(n))

    song = F.when(pick(0, 3) == 0, F.lit(0)).otherwise(pick(1, SONGS))
    after = F.make_dt_interval(secs=pick(2, 500_000).cast("decimal(18,6)"))
    fact = spark.range(plays).select(
        song.alias("song_id"),
        F.floor(song / 10).alias("album_id"),
        F.floor(song / 50).alias("artist_id"),
        (F.lit("2024-06-30 00:01:00").cast("timestamp_ntz") + after).alias("played_at"),
    )
    name = F.concat(F.lit("n"), F.col("id")).alias("name")
    return Star(
        fact,
        spark.range(SONGS).select(
            F.col("id").alias("song_id"), name.alias("title"), F.lit(200_000).alias("duration_ms")
        ),
        spark.range(SONGS // 10).select(
            F.col("id").alias("album_id"), name.alias("title"), F.lit("u").alias("image_url")
        ),
        spark.range(SONGS // 50).select(F.col("id").alias("artist_id"), name),
    )


def joined_first(star: Star):
    plays = resolve(in_week(star.fact, AS_OF), star, *DIM_KEYS)
    total = plays.groupBy(*NAMES).agg(F.sum(F.col("duration_ms").cast("bigint")).alias("ms"))
    minutes = total.select(*NAMES, whole_minutes(F.col("ms")).alias("total_minute_listened"))
    return top_k(minutes, 10, "total_minute_listened", *NAMES)


def main(plays: int) -> None:
    builder = SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
    for key, value in {
        "spark.driver.memory": "16g",
        "spark.sql.shuffle.partitions": "32",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    }.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    star = generated_star(spark, plays)
    results = []
    for name, query in (
        ("warm-up", lambda: top_songs(generated_star(spark, 1000), AS_OF)),
        ("aggregated first", lambda: top_songs(star, AS_OF)),
        ("joined first", lambda: joined_first(star)),
    ):
        start = time.perf_counter()
        results.append(query().collect())
        print(f"{name}: {time.perf_counter() - start:.1f} s", flush=True)
    print("same result:", results[1] == results[2])


if __name__ == "__main__":
    main(int(sys.argv[1]) if len(sys.argv) > 1 else 30_000_000)
