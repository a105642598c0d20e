"""Structured Streaming jobs."""

from playledger.streaming.batches import run_until_stopped
from playledger.streaming.dispatch import dispatch
from playledger.streaming.ingest import ingest
from playledger.streaming.late import with_arrival
from playledger.streaming.mend import mend, open_rejects
from playledger.streaming.metrics import BatchMetrics
from playledger.streaming.redelivery import Redelivery

__all__ = ["BatchMetrics", "Redelivery", "dispatch", "ingest", "mend", "open_rejects", "run_until_stopped", "with_arrival"]
