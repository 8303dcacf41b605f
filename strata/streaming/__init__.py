"""Structured Streaming form of the facts cleaning job (incremental C4)."""

from strata.streaming.facts_stream import (
    ForeignTargetError,
    batches,
    read_facts_stream,
    read_streamed_facts,
    start_curated_facts,
    write_batch,
)

__all__ = ["ForeignTargetError", "batches", "read_facts_stream", "read_streamed_facts", "start_curated_facts", "write_batch"]
