"""A table of fixed size that estimates how common hashes are in the whole corpus."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tarmac.llm.common import map_arrow

CELLS = 1 << 20
SLICES = 64      # rows the table is summed in


def cell(hashes: np.ndarray) -> np.ndarray:
    return (hashes & np.uint64(CELLS - 1)).astype(np.int64)


def _add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(CELLS // SLICES, np.int64)
    for batch in batches:
        for x in batch.column("counts"):
            total += np.frombuffer(x.as_py(), np.int32)
        at = batch.column("slice").slice(0, 1)
    total = np.minimum(total, np.iinfo(np.int32).max).astype(np.int32)
    yield pa.RecordBatch.from_arrays([at, pa.array([total.tobytes()], pa.binary())], ["slice", "counts"])


def counted(texts: DataFrame, hashes: Callable) -> np.ndarray:
    """Counts per cell of what ``hashes(column)`` yields for the one column of ``texts``.

    Tasks add up their own part; Spark sums the parts slice by slice, and the driver
    gets CELLS counters (4 MB), whatever the input.
    """

    def count(batches):
        seen = np.zeros(CELLS, np.int64)
        for batch in batches:
            for got in hashes(batch.column(0)):
                seen += np.bincount(cell(got), minlength=CELLS)
        part = np.minimum(seen, np.iinfo(np.int32).max).astype(np.int32).reshape(SLICES, -1)
        if part.any():
            yield pa.RecordBatch.from_arrays([pa.array(range(SLICES), pa.int32()),
                                              pa.array([x.tobytes() for x in part], pa.binary())], ["slice", "counts"])

    kind = "slice int, counts binary"
    out = np.zeros((SLICES, CELLS // SLICES), np.int32)
    for part in map_arrow(texts, count, kind).groupBy("slice").applyInArrow(_add, kind).collect():
        out[part["slice"]] = np.frombuffer(part["counts"], np.int32)
    return out.reshape(-1)
