"""Where records, payloads and tables come from and go to."""

from playledger.sources.history import HistorySource, HistoryService, stream_history
from playledger.sources.landing import Entities, read_entities, stream_pages
from playledger.sources.scratch import shared_folder
from playledger.sources.topics import FolderTopics, KafkaTopics, kafka_options, kafka_package
from playledger.sources.warehouse import (
    COUNTS_TABLE,
    MENDED_TABLE,
    REJECTS_TABLE,
    FolderWarehouse,
    JdbcWarehouse,
    MissingTable,
    unseen_plays,
)

__all__ = [
    "Entities",
    "COUNTS_TABLE",
    "FolderTopics",
    "FolderWarehouse",
    "HistoryService",
    "HistorySource",
    "JdbcWarehouse",
    "MENDED_TABLE",
    "MissingTable",
    "KafkaTopics",
    "REJECTS_TABLE",
    "kafka_options",
    "kafka_package",
    "read_entities",
    "shared_folder",
    "stream_history",
    "stream_pages",
    "unseen_plays",
]
