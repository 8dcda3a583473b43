"""Tables of vectors, cut into blocks of bounded size that Spark deals out in pairs."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tarmac.session import ship_package

# Values (rows times length) a block holds on average: 8192 vectors of 64, 2 MB of floats.
BLOCK_VALUES = 1 << 19


def usable(vec: Column) -> Column:
    """Whether a vector is there and every component a finite number."""
    return F.coalesce(F.forall(vec, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False))), F.lit(False))


def floats(df: DataFrame, name: str) -> Column:
    """The vector column as it is if it holds floats, else as doubles."""
    kind = df.select(df[name]).dtypes[0][1]
    return df[name] if kind == "array<float>" else df[name].cast("array<double>")


def n_blocks(vectors: DataFrame, vec: str = "vec") -> int:
    total = vectors.agg(F.sum(F.size(vec).cast("long"))).first()[0]
    return max(1, -(-(total or 0) // BLOCK_VALUES))


def blocks(vectors: DataFrame, n: int, row: str, pack, name: str = "block") -> DataFrame:
    """(dim, <name>, data): ``pack(table)`` of every block, as Arrow bytes.

    Rows fall into ``n`` blocks by the hash of their ``row`` number, so blocks are even
    whatever the vectors are; vectors of another length are in other blocks.
    """
    ship_package(vectors.sparkSession)

    def task(key, rows):
        dim, block = (k.as_py() for k in key)
        return pa.table({"dim": pa.array([dim], pa.int32()), name: pa.array([block], pa.int32()),
                         "data": pa.array([to_bytes(pack(rows))], pa.binary())})

    keyed = vectors.withColumns({"dim": F.size("vec"), name: F.pmod(F.xxhash64(row), F.lit(n)).cast("int")})
    return keyed.groupBy("dim", name).applyInArrow(task, f"dim int, {name} int, data binary")


def to_bytes(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def from_bytes(data: bytes) -> pa.Table:
    return pa.ipc.open_stream(data).read_all()


def matrix(column: pa.ChunkedArray | pa.Array, n: int) -> np.ndarray:
    """A list column of ``n`` equally long vectors as rows of a matrix."""
    flat = column.combine_chunks().flatten() if isinstance(column, pa.ChunkedArray) else column.flatten()
    if isinstance(flat, pa.ChunkedArray):
        flat = flat.combine_chunks()
    return flat.to_numpy(zero_copy_only=False).reshape(n, -1)
