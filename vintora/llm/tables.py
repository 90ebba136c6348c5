"""Sums of large fixed-size count tables over tasks, moved as compressed blocks."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK = 1 << 16
SCHEMA = "block int, part int, counts binary"
NAMES = ["block", "part", "counts"]


def blocks(table: np.ndarray, part: int) -> Iterator[tuple[int, int, bytes]]:
    """The blocks of a table that hold counts."""
    for k in range(0, len(table), BLOCK):
        if (held := table[k : k + BLOCK]).any():
            yield k // BLOCK, part, zlib.compress(held.astype("<u8").tobytes(), 1)


def summed(rows: DataFrame, size: int, shown=lambda counts: counts, kind=np.uint64) -> np.ndarray:
    """The table whose blocks all tasks gave (columns of SCHEMA): first 16 sums of each block, then one.

    A task adds blocks up as they come and holds one at a time; only the sum, of fixed size, gets to the driver. There
    `shown` makes a block's counts into what the table holds, of type `kind`, before the next block comes.
    """

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, total = None, np.zeros(BLOCK, np.uint64)
        out = lambda: pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([0], pa.int32()), pa.array([zlib.compress(total.astype("<u8").tobytes(), 1)])], names=NAMES)
        for batch in batches:
            for k, counts in zip(batch.column("block").to_pylist(), batch.column("counts").to_pylist()):
                if k != now and now is not None:
                    yield out()
                    total[:] = 0
                now = k
                held = np.frombuffer(zlib.decompress(counts), "<u8")
                total[: len(held)] += held
        if now is not None:
            yield out()

    sums = rows.select(*NAMES)
    for key in (F.col("part") % 16, F.lit(0)):
        sums = sums.withColumn("part", key).repartition("block", "part").sortWithinPartitions("block", "part").mapInArrow(add_up, SCHEMA)
    table = np.zeros(-(-size // BLOCK) * BLOCK, kind)
    table[:] = shown(np.zeros(1, np.uint64))[0]
    for r in sums.toLocalIterator():
        table[r["block"] * BLOCK : (r["block"] + 1) * BLOCK] = shown(np.frombuffer(zlib.decompress(bytes(r["counts"])), "<u8"))
    return table[:size]
