"""Sums of equally long arrays over all tasks, added up in two levels before the driver sees them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Groups of the two levels: a group of the first adds tasks / WIDE arrays, the driver adds NARROW.
WIDE, NARROW = 4096, 16

#: A partial sum: the task it comes from and its array, compressed, since small tasks leave most cells 0.
PART = "part long, total binary"


def part_row(part: int, total: np.ndarray) -> pa.RecordBatch:
    """The row of PART with which a task hands over its array."""
    packed = zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(total).tobytes())
    return pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([packed], pa.binary())], names=["part", "total"])


def _unpack(packed: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), kind)


def tree_sum(parts: DataFrame, length: int, kind: str = "f8", tasks: int | None = None) -> np.ndarray:
    """Sum of the arrays in rows of PART, all of ``length`` cells of numpy type ``kind``; zeros without a row.

    Tasks meet in groups of a fixed number, each of which holds one running sum; what the driver
    collects is NARROW arrays whatever the number of tasks (``tasks``, if known to be no more than
    that, saves the levels). Rows are added in the order of ``part``, so that a repeated task
    changes no digit.
    """
    def add(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = []
        for batch in batches:
            found += [(p, x) for p, x in zip(batch.column("part").to_pylist(), batch.column("total").to_pylist())]
        total = np.zeros(length, kind)
        for _, packed in sorted(found, key=lambda x: x[0]):
            total += _unpack(packed, kind)
        yield part_row(key[0].as_py(), total)

    for groups in () if tasks is not None and tasks <= NARROW else (WIDE, NARROW):
        parts = parts.withColumn("slot", F.pmod("part", F.lit(groups))).groupBy("slot").applyInArrow(add, PART)
    total = np.zeros(length, kind)
    # sorted here: ordering a table first runs all of it once more, to sample its keys
    for row in sorted(parts.collect(), key=lambda r: r["part"]):
        total += _unpack(bytes(row["total"]), kind)
    return total
