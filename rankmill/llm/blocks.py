"""Sums of fixed-size integer vectors over all tasks of a job, block by block.

A task adds up what it sees and emits its blocks once, so a shuffle moves one vector per task and no
row per key. The blocks are merged by streams that hold one block at a time, in two rounds: first in
`FAN` groups per block, then the groups. No task meets more than one vector per `FAN`-th of all tasks
and block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FAN = 16
SCHEMA = "block int, cells binary"


def block_batch(first_block: int, cells: np.ndarray, block_cells: int) -> pa.RecordBatch:
    """The blocks of a vector of longs that have any cell other than zero."""
    blocks = [(first_block + n, cells[at : at + block_cells]) for n, at in enumerate(range(0, len(cells), block_cells))]
    used = [(n, part.astype("<i8").tobytes()) for n, part in blocks if part.any()]
    arrays = [pa.array([n for n, _ in used], pa.int32()), pa.array([part for _, part in used], pa.binary())]
    return pa.RecordBatch.from_arrays(arrays, ["block", "cells"])


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums neighbouring rows of the same block."""
    block, total = None, None
    for batch in batches:
        for name, cells in zip(batch.column(0), batch.column(1), strict=True):
            values = np.frombuffer(cells.as_buffer(), dtype="<i8")
            if name.as_py() == block:
                total += values
                continue
            if block is not None:
                yield _row(block, total)
            block, total = name.as_py(), values.copy()
    if block is not None:
        yield _row(block, total)


def _row(block: int, cells: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([cells.tobytes()], pa.binary())], ["block", "cells"])


def summed_blocks(parts: DataFrame) -> DataFrame:
    """One row per block of (block, cells) rows, with the sums of their cells."""
    teams = parts.withColumn("team", F.pmod(F.spark_partition_id(), F.lit(FAN)))
    for keys in (["block", "team"], ["block"]):
        parts = (teams if "team" in keys else parts).repartition(*keys).sortWithinPartitions("block")
        parts = parts.select("block", "cells").mapInArrow(_added, SCHEMA)
    return parts


def collected(blocks: DataFrame, size: int, block_cells: int) -> np.ndarray:
    """The whole vector of `size` cells on the driver; its size does not depend on the input."""
    out = np.zeros(size, dtype=np.int64)
    for row in blocks.toLocalIterator():
        values = np.frombuffer(row["cells"], dtype="<i8")
        at = row["block"] * block_cells
        out[at : at + len(values)] += values
    return out
