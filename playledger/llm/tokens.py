"""Encoding and decoding of documents by the transducer of ``bpe``."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playledger.llm import bpe


def encode(docs: DataFrame, tokenizer: str = bpe.TOKENIZER) -> DataFrame:
    """``doc_id, ids``: the ids of each whole text, an array. Null texts have none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = bpe.tokenizer(tokenizer)
        for batch in batches:
            ids = [encoder.encode(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"]
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, tokenizer: str = bpe.TOKENIZER) -> DataFrame:
    """``doc_id, text``: readable text of ``doc_id, ids``, through the incremental decoder."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = bpe.tokenizer(tokenizer).text_decoder()
        for batch in batches:
            texts = [machine.feed(x.as_py() or []) + machine.end() for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select(F.col("doc_id").cast("long"), "ids").mapInArrow(run, "doc_id long, text string")


def digests(docs: DataFrame, tokenizer: str = bpe.TOKENIZER) -> DataFrame:
    """Encodes and decodes each whole text: ``doc_id, n_tokens, ids_sha256, decoded_sha256``.

    Null texts are empty: no ids, and the digests of nothing. Rows that repeat are coded each; null ids
    pass through; other columns are ignored. Each text is coded where it lies: nothing is shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = bpe.tokenizer(tokenizer)
        for batch in batches:
            counts, of_ids, of_texts = [], [], []
            for text in batch.column(1):
                ids = coder.encode(text.as_py())
                counts.append(len(ids))
                of_ids.append(hashlib.sha256(ids.tobytes()).hexdigest())
                of_texts.append(hashlib.sha256(coder.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_texts, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
