"""Small results of tasks, merged in a tree.

A task turns its rows into one partial result of fixed size (bytes). Partials
are merged FAN_IN at a time by further tasks until few are left, so the
driver merges at most FAN_IN of them however many tasks there were.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from riskloom.operators.ordered import materialize

FAN_IN = 64
_SCHEMA = pa.schema([("part", pa.binary())])


def merged(rows: DataFrame, start: Callable[[Iterator[pa.RecordBatch]], bytes | None], merge: Callable[[bytes, bytes], bytes]) -> bytes | None:
    """``start`` of every partition, merged pairwise; None where no partition gives one."""

    def emit(part: bytes | None) -> Iterator[pa.RecordBatch]:
        if part is not None:
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.binary())], schema=_SCHEMA)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for part in batch.column(0).to_pylist():
                total = part if total is None else merge(total, part)
        yield from emit(total)

    parts = materialize(rows.mapInArrow(lambda batches: emit(start(batches)), "part binary"), "partials")
    n = parts.count()
    while n > FAN_IN:
        n = math.ceil(n / FAN_IN)
        parts = materialize(parts.repartition(n).mapInArrow(join, "part binary"), "partials")
    total = None
    for r in parts.collect():
        total = bytes(r[0]) if total is None else merge(total, bytes(r[0]))
    return total
