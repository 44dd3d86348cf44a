"""Vector expressions, and the Arrow bridge for dense blocks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def doubles(v: Column | str) -> Column:
    return _col(v).cast("array<double>")


def dot(a: Column | str, b: Column | str) -> Column:
    products = F.zip_with(_col(a), _col(b), lambda x, y: x * y)
    return F.aggregate(products, F.lit(0.0), lambda s, x: s + x)


def norm(v: Column | str) -> Column:
    return F.sqrt(F.aggregate(_col(v), F.lit(0.0), lambda s, x: s + x * x))


def normalise(v: Column | str) -> Column:
    """v / |v|; a zero vector stays zero."""
    v = doubles(v)
    # the one-element outer array binds the norm once per row, not once per element
    scaled = F.transform(F.array(norm(v)), lambda n: F.transform(
        v, lambda x: x / F.when(n == 0, 1.0).otherwise(n)))
    return F.element_at(scaled, 1)


def finite(v: Column | str) -> Column:
    return ~F.exists(doubles(v), lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))


def usable(v: Column | str, dimension: int | None = None) -> Column:
    """Finite, and of the expected length when one is given."""
    v = _col(v)
    ok = v.isNotNull() & (F.size(v) > 0) & finite(v)
    return ok if dimension is None else ok & (F.size(v) == dimension)


def sign_code(v: Column | str, dimension: int) -> Column:
    """One bit per dimension (1 where positive), packed 64 to a long."""
    v = _col(v)
    words = []
    for start in range(0, dimension, 64):
        width = min(64, dimension - start)
        bits = F.transform(F.slice(v, start + 1, width),
                           lambda x, i: F.when(x > 0, F.call_function("shiftleft", F.lit(1).cast("long"), i))
                           .otherwise(F.lit(0).cast("long")))
        words.append(F.aggregate(bits, F.lit(0).cast("long"), lambda s, x: s + x))
    return F.array(*words)


def hamming(a: Column | str, b: Column | str) -> Column:
    """Number of differing bits of two packed codes."""
    return F.aggregate(
        F.zip_with(_col(a), _col(b), lambda x, y: F.bit_count(x.bitwiseXOR(y))),
        F.lit(0), lambda s, x: s + x)


def vector_key(v: Column | str) -> Column:
    """128-bit digest by which identical vectors are grouped."""
    v = _col(v)
    return F.concat_ws("-", F.hex(F.xxhash64(v)), F.hex(F.xxhash64(F.lit(7), v)))


def settled(df: DataFrame, column: str) -> DataFrame:
    """``df`` with ``column`` computed before anything that follows.

    Spark does not evaluate an Arrow function whose argument holds a lambda, and the
    optimizer would fold ``transform(...)`` into that argument. Unfolding a
    one-element array keeps the two apart at the cost of a copy.
    """
    return df.select(*[f"`{c}`" for c in df.columns if c != column],
                     F.explode(F.array(column)).alias(column)).select(*[f"`{c}`" for c in df.columns])


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Arrow list column to an (n, d) matrix; all lists must have one length."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(n, -1) if n else flat.reshape(0, 0)


def lists(rows: np.ndarray, kind: pa.DataType | None = None) -> pa.ListArray:
    """(n, d) matrix back to an Arrow list column."""
    n, d = rows.shape
    offsets = np.arange(0, (n + 1) * d, d, dtype=np.int32) if d else np.zeros(n + 1, np.int32)
    return pa.ListArray.from_arrays(offsets, pa.array(rows.reshape(-1), type=kind))
