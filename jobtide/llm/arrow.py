"""Text columns as byte arrays: what the operators that work inside Arrow tasks share."""

import ctypes

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

#: Text bytes that an operator works on at once; a longer text is worked on alone.
CHUNK_BYTES = 4 << 20


def quoted(name: str) -> Column:
    """The column of this very name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def packed(docs: DataFrame, text: str, carried: list[str]) -> DataFrame:
    """``text`` and, in one struct ``row``, the columns to hand through; no name of theirs can clash."""
    row = F.struct(F.lit(True).alias("_"), *[quoted(c).alias(f"c{i}") for i, c in enumerate(carried)])
    return docs.select(row.alias("row"), quoted(text).cast("string").alias("text"))


def row_type(frame: DataFrame) -> tuple[str, pa.DataType]:
    """The type of ``row`` as Spark's text form and for Arrow; all of it may be null."""
    text = frame.schema["row"].dataType.simpleString()
    return text, to_arrow_type(T.DataType.fromDDL(text))


def unpacked(carried: list[str]) -> list[Column]:
    """The columns that ``packed`` put into ``row``."""
    return [F.col(f"row.c{i}").alias(c) for i, c in enumerate(carried)]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all values on end, and where each begins (one more place than values). Null is empty."""
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    _, places, data = column.buffers()
    offsets = np.frombuffer(places, np.int64)[column.offset : column.offset + len(column) + 1]
    if not len(column) or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def give_back() -> None:
    """Return memory that is free in this process to the machine: a worker waits for its next task for a while, and an
    executor has little room besides Spark's own heap."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def chunks(batch: pa.RecordBatch, column: str = "text", size: int = CHUNK_BYTES):
    """Slices of a batch with at most ``size`` bytes of text each, or one row."""
    if not batch.num_rows:
        return
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends, first = np.cumsum(lengths, dtype=np.int64), 0
    while first < batch.num_rows:
        before = ends[first - 1] if first else 0
        after = max(first + 1, int(np.searchsorted(ends, before + size, "right")))
        yield batch.slice(first, after - first)
        give_back()
        first = after


def binary_array(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Values laid end to end in ``data``, the i-th from ``offsets[i]`` to ``offsets[i + 1]``."""
    places = np.ascontiguousarray(offsets, np.int64)
    return pa.Array.from_buffers(pa.large_binary(), len(places) - 1, [None, pa.py_buffer(places), pa.py_buffer(np.ascontiguousarray(data))])


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IN_WORD = np.zeros(256, bool)
_IN_WORD[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True


def sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs of ``values``: the i-th from ``offsets[i]`` to ``offsets[i + 1]``."""
    out, full = np.zeros(len(offsets) - 1, np.int64), offsets[1:] > offsets[:-1]
    if full.any():
        values = values.view(np.uint8) if values.dtype == bool else values
        out[full] = np.add.reduceat(values, offsets[:-1][full], dtype=np.int64)
    return out


def runs(inside: np.ndarray, offsets: np.ndarray, data: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """Runs of ``inside`` bytes, none across a document's end: their bytes, and the first run of each document."""
    starts, ends = inside.copy(), inside.copy()
    starts[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    starts[edges] = inside[edges]
    ends[edges - 1] = inside[edges - 1]
    at = np.flatnonzero(starts)
    places = np.concatenate([[0], np.cumsum(np.flatnonzero(ends) + 1 - at)])
    return binary_array(data[inside], places), np.searchsorted(at, offsets)


def words(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the texts with A-Z lower-cased, and the first word of each text."""
    data, offsets = text_bytes(column)
    data = _LOWER[data]
    return runs(_IN_WORD[data], offsets, data)


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All of ``starts[i]``, ``starts[i] + 1``, ... (``lengths[i]`` of them) on end."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lengths), lengths)
