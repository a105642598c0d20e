"""Topic sources and sinks: the broker, and a folder with the same record shape."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

import pyspark
from pyspark.sql import DataFrame, SparkSession, functions as F

from playledger.schemas import TOPIC_RECORD, TOPICS
from playledger.sources.landing import bounded

#: Where a record comes from: partition and offset, or file and row. A record that is read again has the same.
ORIGIN = "origin"


def kafka_package() -> str:
    """Maven coordinates of the broker connector that fits the running Spark version."""
    return f"org.apache.spark:spark-sql-kafka-0-10_2.13:{pyspark.__version__}"


def kafka_options(servers: str, topics: Iterable[str] = TOPICS,
                  starting_offsets: str = "latest") -> dict[str, str]:
    """Options of a streaming read of the topics."""
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(topics),
        "startingOffsets": starting_offsets,
    }


@dataclass(frozen=True)
class KafkaTopics:
    """Topics on a broker.

    ``extra`` are client settings (security, ...); those named ``kafka.*`` go to the reader and the
    writer, all others to the reader. ``max_offsets`` bounds the records of a batch; the rest comes
    in the next batches.
    """

    servers: str
    topics: tuple[str, ...] = tuple(TOPICS)
    starting_offsets: str = "latest"
    extra: dict[str, str] = field(default_factory=dict)
    max_offsets: int | None = None

    def read_options(self) -> dict[str, str]:
        bound = {"maxOffsetsPerTrigger": str(self.max_offsets)} if self.max_offsets else {}
        return kafka_options(self.servers, self.topics, self.starting_offsets) | bound | self.extra

    def write_options(self) -> dict[str, str]:
        client = {k: v for k, v in self.extra.items() if k.startswith("kafka.")}
        return {"kafka.bootstrap.servers": self.servers} | client

    def read_stream(self, spark: SparkSession) -> DataFrame:
        options = self.read_options()
        origin = F.concat_ws("/", "topic", "partition", "offset").alias(ORIGIN)
        return spark.readStream.format("kafka").options(**options).load().select("value", "topic", origin)

    def append(self, records: DataFrame, batch: str) -> None:
        """Publish the records, without keys. Delivery is at least once."""
        records.write.format("kafka").options(**self.write_options()).save()


@dataclass(frozen=True)
class FolderTopics:
    """Topics as Parquet files in a shared folder.

    A batch is one ``batch=<tag>`` folder: writing it again replaces it. A reader that has seen the
    first version may see the second one too, so delivery is at least once, as on a broker.
    """

    root: str
    max_files: int | None = None
    max_bytes: int | None = None

    def read_stream(self, spark: SparkSession) -> DataFrame:
        reader = bounded(spark.readStream.schema(TOPIC_RECORD), self.max_files, self.max_bytes)
        records = reader.option("pathGlobFilter", "*.parquet").parquet(f"{self.root}/batch=*")
        origin = F.concat_ws("/", "_metadata.file_name", "_metadata.row_index").alias(ORIGIN)
        return records.select("value", "topic", origin)

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(TOPIC_RECORD).parquet(self.root)

    def append(self, records: DataFrame, batch: str) -> None:
        (
            records.withColumn("batch", F.lit(batch))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("batch")
            .parquet(self.root)
        )
