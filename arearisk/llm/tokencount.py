"""Token counts by heap-and-linked-list byte-pair merging, without emitting ids.

A word's characters form a linked list; a heap holds the adjacent pairs that
some piece of the vocabulary spells, best rank first and leftmost among equals.
Popping a pair merges it if both sides are still as they were entered. The count
is the number of initial symbols minus the merges; a character that no piece
spells starts as one symbol per UTF-8 byte.

No piece of the vocabulary has a space mark after another character, so a text
is counted word by word. A worker remembers the counts of the words it has met
in a bounded table. The operator is a map over the rows.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from itertools import filterfalse

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from arearisk.llm.common import blocks, id_and_text, kept

#: Fixed value: the mark that stands for a space.
SPACE = "▁"

#: Distinct words that a worker remembers.
REMEMBERED = 700_000

_AFTER_WORD = re.compile("(?<=[^ ]) ")


class Counter:
    """Counts tokens as the sentencepiece library does for one BPE model."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        every = range(model.get_piece_size())
        self.rank = {model.id_to_piece(i): -model.get_score(i) for i in every
                     if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))}
        spelled = {c for piece in self.rank if len(piece) > 1 for c in piece}
        if any(SPACE in piece.lstrip(SPACE) for piece in self.rank) or not spelled <= self.rank.keys():
            raise ValueError(f"{path}: words cannot be counted one by one with this vocabulary")
        self.known: dict[str, int] = {}

    def merges(self, s: str) -> int:
        """Merges in one word."""
        rank, n = self.rank.get, len(s)
        end, before, done = list(range(1, n + 1)), list(range(-1, n - 1)), 0
        live = [True] * n
        heap = [(r, i, i + 1, i + 2) for i in range(n - 1) if (r := rank(s[i:i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, j, stop = heapq.heappop(heap)
            if not live[i] or end[i] != j or end[j] != stop:
                continue
            live[j], end[i] = False, stop
            done += 1
            if stop < n:
                before[stop] = i
                if (r := rank(s[i:end[stop]])) is not None:
                    heapq.heappush(heap, (r, i, stop, end[stop]))
            h = before[i]
            if h >= 0 and (r := rank(s[h:stop])) is not None:
                heapq.heappush(heap, (r, h, i, stop))
        return done

    def word(self, s: str) -> int:
        symbols = sum(1 if c in self.rank else len(c.encode()) for c in s)
        return symbols - self.merges(s)

    def count(self, texts: list[str]) -> list[int]:
        """Tokens of each whole text."""
        if len(self.known) > REMEMBERED:
            self.known.clear()
        known, out = self.known, []
        for text in texts:
            words = self.words(text)
            for w in set(filterfalse(known.__contains__, words)):
                known[w] = self.word(SPACE + w.replace(" ", SPACE))
            out.append(sum(map(known.__getitem__, words)))
        return out

    def words(self, text: str) -> list[str]:
        """A text's words without the one space mark before each; further spaces stay in front."""
        text = text.replace(SPACE, " ")
        if not text:
            return []
        return text.split(" ") if "  " not in text and text[0] != " " else _AFTER_WORD.split(text)


def counter(path: str) -> Counter:
    """This worker's counter for a model file."""
    return kept(("counter", path), lambda: Counter(path))


def count_tokens(docs: DataFrame, path: str, limit: int = 4096, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`doc_id`, `n_bytes` (UTF-8), `n_tokens` and `over_limit` (more than `limit` tokens) of every whole text.

    A NULL or empty text has no bytes and no tokens. Equal rows and NULL ids are counted like any other, an
    empty table gives an empty result, and no other column is read. `path` must be readable on the executors.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter(path)
        for t in blocks(batches):
            n = pa.array(own.count(t["text"].to_pylist()), pa.int64())
            size = pc.cast(pc.binary_length(t["text"]), pa.int64())
            yield from pa.table({"doc_id": t["doc_id"], "n_bytes": size, "n_tokens": n, "over_limit": pc.greater(n, limit)}).to_batches()

    rows = id_and_text(docs, id_col, text_col)
    return rows.mapInArrow(
        run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_bytes long, n_tokens long, over_limit boolean")
