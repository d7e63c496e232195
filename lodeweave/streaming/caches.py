"""Caches on streams: completions of which the first of a key wins, unless a later one completes it, and paged caches of tokens."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter

from lodeweave.sources.sinks import put_cache

SINK, BUFFER = 32, 128


def cache_stream(entries: DataFrame, path: str, checkpoint: str, upgrade: bool = True) -> DataStreamWriter:
    """A writer that appends each micro-batch's entries (key, completion, accepted) where their key is not there.

    With `upgrade` an entry that brings a completion to a key without one is appended too, and readers take it. A batch
    that runs again finds its own keys and appends nothing.
    """

    def put(batch: DataFrame, number: int) -> None:
        put_cache(batch.sparkSession, path, batch, upgrade)

    return entries.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint)


def after(state: tuple[int, int, int] | None, tokens: int, sink: int = SINK, buffer: int = BUFFER) -> tuple[int, int, int]:
    """(length, end of the quantized keys, end of the quantized values) once `tokens` more are cached; state None: they are the prefill.

    A prefill quantizes whole pages of keys behind the sink, and values up to the buffer. A decoded token quantizes
    one value, and a page of keys whenever a page has filled behind the buffer.
    """
    if state is None:
        if tokens <= sink:
            raise ValueError(f"a prefill of {tokens} tokens is no longer than the sink")
        behind = tokens - sink
        return (tokens, sink + behind - behind % buffer, tokens - buffer) if behind > buffer else (tokens, sink, sink)
    length, keys, values = state
    length += tokens
    past = length - sink - buffer
    if past > 0:
        filled = past - (past - 1) % buffer  # the last length at which a page was due, counted from there
        if filled > length - tokens - sink - buffer:
            keys = max(keys, sink + buffer + filled - 1)
        values = max(values, length - buffer)
    return length, keys, values


def paged(tokens: DataFrame, sink: int = SINK, buffer: int = BUFFER) -> DataFrame:
    """(sequence, length, keys, values) of each sequence that a micro-batch of (sequence, step, tokens) reaches: tokens cached, and how
    many keys and values of them are quantized. A sequence's first step is its prefill; steps come in order."""

    def run(key: tuple[Any, ...], batches: Iterator[pd.DataFrame], state: Any) -> Iterable[pd.DataFrame]:
        at = tuple(state.get) if state.exists else None
        for n in pd.concat(list(batches)).sort_values("step")["tokens"]:
            at = after(at, int(n), sink, buffer)
        state.update(at)
        yield pd.DataFrame({"sequence": [key[0]], "length": [at[0]], "keys": [at[1] - sink], "values": [at[2] - sink]})

    return tokens.groupBy("sequence").applyInPandasWithState(run, "sequence long, length long, keys long, values long", "length long, keys long, values long", "update", "NoTimeout")
