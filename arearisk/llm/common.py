"""Pieces that several corpus operators share."""

from __future__ import annotations

from collections.abc import Callable, Hashable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Texts are worked on in blocks of about this many bytes inside a task.
BLOCK_BYTES = 16 << 20


def quoted(name: str) -> Column:
    """A column by its exact name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only `doc_id` and `text`, NULL text as empty: other columns cannot clash with an operator's own."""
    return docs.select(quoted(id_col).alias("doc_id"), F.coalesce(quoted(text_col), F.lit("")).alias("text"))


def blocks(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = BLOCK_BYTES) -> Iterator[pa.Table]:
    """Regroup Arrow batches into tables of about `limit` bytes in `column`; a longer text makes its own block."""
    held, size = [], 0
    for batch in batches:
        start = 0
        sizes = np.diff(np.frombuffer(batch.column(column).buffers()[1], _offset_type(batch, column), batch.num_rows + 1,
                                      batch.column(column).offset * _offset_type(batch, column)().itemsize))
        total = np.cumsum(sizes, dtype=np.int64)
        while start < batch.num_rows:
            done = total[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(total, done + limit - size, "right")))
            held.append(batch.slice(start, stop - start))
            size += int(total[stop - 1] - done)
            start = stop
            if size >= limit or start < batch.num_rows:
                yield pa.Table.from_batches(held)
                held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


def _offset_type(batch: pa.RecordBatch, column: str) -> type:
    kind = batch.schema.field(column).type
    return np.int64 if pa.types.is_large_string(kind) or pa.types.is_large_binary(kind) else np.int32


def offsets_of(lengths) -> np.ndarray:
    """0 followed by the running total."""
    out = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=out[1:])
    return out


def is_held_out(doc_id: Column, folds: int = 5, fold: int = 0) -> Column:
    """True where crc32 of the id as text leaves `fold` divided by `folds`; a NULL id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds == fold


_kept: dict[Hashable, object] = {}


def kept(name: Hashable, make: Callable[[], object]):
    """What a Python worker keeps between tasks under `name`. Only one thing is kept, so what an earlier operator left goes."""
    if name not in _kept:
        forget()
        _kept[name] = make()
    return _kept[name]


def forget() -> None:
    """Drop what an earlier operator left in this worker."""
    _kept.clear()
