"""Vector bin packing of token sequences with the dot-product heuristic.

A sequence has three limits that hold at once: tokens, segments and loss-bearing
tokens. Each bin is filled before the next is opened: of the items that still
fit in every dimension, the one with the largest dot product of its vector and
the bin's remaining capacity (both in shares of the limits) goes in, until none
fits. If items may be cut, the gap that is left takes the front of the best
item, so every bin but the last of a task is full in one dimension.

Packing is a map over the rows of a task: items wait in a pool bounded by
`POOL` items, so memory does not grow with the input and nothing is shuffled.
Only the last bins of each task can have padding.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arearisk.llm.bpe import BLOCK, encoder
from arearisk.llm.common import blocks, id_and_text, quoted

#: Items that wait in a task while bins are filled from them.
POOL = 2048


@dataclass(frozen=True)
class Limits:
    """What one sequence holds at most; a cut leaves at least `least` tokens where a bin has room for them.

    As many segments as tokens is no limit of its own.
    """

    tokens: int = 2048
    segments: int = 64
    loss_tokens: int = 2048
    least: int = 1

    def __post_init__(self) -> None:
        if min(self.tokens, self.segments, self.loss_tokens, self.least) < 1:
            raise ValueError("every limit must be at least 1")


class Pool:
    """Items waiting for a bin: per item its row, its first token, its tokens and its loss-bearing tokens."""

    def __init__(self, limits: Limits, cut: bool):
        self.limits, self.cut = limits, cut
        self.items = np.empty((0, 4), np.int64)

    def add(self, rows: np.ndarray) -> None:
        self.items = np.concatenate([self.items, rows])

    def fill(self) -> list[tuple[int, int, int, int]]:
        """Take the items of one bin out of the pool, in the order of the bin."""
        lim = self.limits
        cap = np.array([lim.tokens, 1, lim.loss_tokens], np.float64)
        room_tokens, room_segments, room_loss = lim.tokens, lim.segments, lim.loss_tokens
        size, loss = self.items[:, 2], self.items[:, 3]
        waiting, out = np.ones(len(size), bool), []
        while room_segments:
            fits = waiting & (size <= room_tokens) & (loss <= room_loss)
            if not fits.any():
                break
            score = size * (room_tokens / cap[0] ** 2) + loss * (room_loss / cap[2] ** 2) + room_segments / lim.segments ** 2
            best = int(np.argmax(np.where(fits, score, -1.0)))
            alike = np.flatnonzero(fits & (size == size[best]) & (loss == loss[best]))
            if len(alike) == np.count_nonzero(fits):
                # Whatever else fits is the same: as many as there is room for go in at once.
                n, bearing = int(size[best]), int(loss[best])
                alike = alike[:min(room_segments, room_tokens // n if n else len(alike), room_loss // bearing if bearing else len(alike))]
                out += map(tuple, self.items[alike].tolist())
                waiting[alike] = False
                room_segments -= len(alike)
                room_tokens, room_loss = room_tokens - n * len(alike), room_loss - bearing * len(alike)
                continue
            out.append(tuple(self.items[best].tolist()))
            waiting[best] = False
            room_tokens, room_segments, room_loss = room_tokens - int(size[best]), room_segments - 1, room_loss - int(loss[best])
        if self.cut and room_segments and waiting.any():
            best = int(np.argmax(np.where(waiting, size, -1)))
            row, start, tokens, bearing = self.items[best].tolist()
            # Loss-bearing tokens are the last ones of an item, so the front bears what the rest cannot.
            plain = tokens - bearing
            front = min(room_tokens, plain + room_loss, tokens - 1)
            if front >= lim.least:
                spent = max(0, front - plain)
                out.append((row, start, front, spent))
                self.items[best] = (row, start + front, tokens - front, bearing - spent)
        self.items = self.items[waiting]
        return out


def pack_block(tokens: np.ndarray, loss: np.ndarray, limits: Limits, cut: bool = True) -> list[list[tuple[int, int, int, int]]]:
    """Bins of (row, first token, tokens, loss-bearing tokens) for items given whole."""
    pool, out = Pool(limits, cut), []
    for row, (n, bearing) in enumerate(zip(tokens.tolist(), loss.tolist())):
        out += _offer(pool, row, n, bearing)
        if len(pool.items) >= POOL:
            out.append(pool.fill())
    while len(pool.items):
        out.append(pool.fill())
    return out


def _offer(pool: Pool, row: int, n: int, bearing: int) -> list[list[tuple[int, int, int, int]]]:
    """Put an item into the pool; what exceeds a whole bin makes bins of its own."""
    lim, start, full = pool.limits, 0, []
    if not pool.cut and (n > lim.tokens or bearing > lim.loss_tokens):
        raise ValueError(f"an example of {n} tokens, {bearing} of them loss-bearing, is over the limits and may not be cut")
    while n - start > lim.tokens or bearing > lim.loss_tokens:
        plain = n - start - bearing
        front = min(lim.tokens, plain + lim.loss_tokens)
        spent = max(0, front - plain)
        full.append([(row, start, front, spent)])
        start, bearing = start + front, bearing - spent
    if n > start:
        pool.items = np.concatenate([pool.items, [[row, start, n - start, bearing]]])
    return full


def _packed(rows: Iterator[tuple[pa.Array, list[bytes], list[int]]], limits: Limits, cut: bool) -> Iterator[pa.Table]:
    """Pieces of all rows of a task; `rows` gives ids of rows, packed tokens and numbers of loss-bearing tokens."""
    context = TaskContext.get()
    serial = (context.partitionId() if context else 0) << 40
    pool = Pool(limits, cut)
    held: dict[int, tuple[object, bytes]] = {}
    number = 0

    def table(bins: list[list[tuple[int, int, int, int]]]) -> pa.Table:
        nonlocal serial
        cols: list[list] = [[] for _ in range(8)]
        for members in bins:
            offset = 0
            for row, start, n, bearing in members:
                name, data = held[row]
                whole = len(data) // 4
                for col, v in zip(cols, (name, start, n, data[4 * start:4 * (start + n)], whole, bearing, serial, offset)):
                    col.append(v)
                offset += n
            serial += 1
        kinds = [None, pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
        names = ["doc_id", "start", "length", "ids", "doc_tokens", "loss_tokens", "sequence_id", "offset"]
        return pa.table({k: pa.array(c, t or id_type) for k, c, t in zip(names, cols, kinds)})

    id_type = pa.int64()
    for names, data, bearing in rows:
        id_type, bins = names.type, []
        fresh = []
        for name, packed, loss in zip(names.to_pylist(), data, bearing):
            held[number] = (name, packed)
            before = pool.items
            pool.items = before[:0]
            bins += _offer(pool, number, len(packed) // 4, loss)
            fresh.append(pool.items)
            pool.items = before
            number += 1
        pool.add(np.concatenate([np.empty((0, 4), np.int64), *fresh]))
        while len(pool.items) >= POOL:
            bins.append(pool.fill())
        if bins:
            yield table(bins)
        waiting = set(pool.items[:, 0].tolist())
        held = {k: v for k, v in held.items() if k in waiting}
    bins = []
    while len(pool.items):
        bins.append(pool.fill())
    if bins:
        yield table(bins)


_SCHEMA = ("doc_id {id}, start long, length long, ids binary, doc_tokens long, loss_tokens long, sequence_id long, offset long")


#: Plain documents: any number of segments, so that short ones fill a sequence too.
PLAIN = Limits(segments=2048)


def pack_documents(docs: DataFrame, path: str, end_id: int = 1, limits: Limits = PLAIN, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """Encode every whole text, add `end_id` and pack all ids; documents may be cut anywhere.

    One row per piece: `doc_id`, `start` and `length` in the document's ids, `ids` (little-endian unsigned
    32-bit numbers), `doc_tokens`, `loss_tokens` (all ids but a document's first are predicted), `sequence_id`
    and `offset` in the sequence. Every id lies in one piece. A NULL or empty text is its end id alone; equal
    rows and NULL ids are packed like any other; an empty table gives no pieces; other columns are not read.
    """
    tail = int(end_id).to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)

        def rows():
            for t in blocks(batches, limit=BLOCK):
                data = [x + tail for x in own.encode(t["text"].to_pylist())]
                yield t["doc_id"].combine_chunks(), data, [len(x) // 4 - 1 for x in data]

        for t in _packed(rows(), limits, True):
            yield from t.to_batches()

    rows = id_and_text(docs, id_col, text_col)
    return rows.mapInArrow(run, _SCHEMA.format(id=rows.schema["doc_id"].dataType.simpleString()))


def pack_examples(examples: DataFrame, limits: Limits = Limits(), cut: bool = False, id_col: str = "doc_id",
                  ids_col: str = "ids", loss_col: str = "loss_tokens") -> DataFrame:
    """Pack encoded instruction examples: `ids` (array of int) of which the last `loss_tokens` bear loss.

    Same result as `pack_documents`. Without `cut` an example stays whole and one over the limits is an error.
    NULL ids count as none and give no piece; a NULL number of loss-bearing tokens as zero, one above the length
    as the length.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for b in batches:
                data = [np.asarray(x or [], np.uint32).tobytes() for x in b.column("ids").to_pylist()]
                bearing = [max(0, min(n or 0, len(x) // 4)) for n, x in zip(b.column("loss").to_pylist(), data)]
                yield b.column("doc_id"), data, bearing

        for t in _packed(rows(), limits, cut):
            yield from t.to_batches()

    rows = examples.select(quoted(id_col).alias("doc_id"), quoted(ids_col).alias("ids"), F.col(loss_col).cast("long").alias("loss"))
    return rows.mapInArrow(run, _SCHEMA.format(id=rows.schema["doc_id"].dataType.simpleString()))
