"""Byte-pair encoding and decoding with a pair occurrence index.

The distinct words of a block of texts are laid out as one chain of symbols.
An index maps the rank of every mergeable adjacent pair to all its positions in
that chain. Active ranks are applied in ascending order from a heap: all
occurrences of the pair merge at once, and only the pairs to their left and
right are entered into the index anew. Stale positions are recognised when their
rank comes up. Each word is encoded once per block, and a bounded table keeps
what a worker has encoded before.

Encoding is a map over the rows: no shuffle, and the memory of a task is one
block of texts plus the table of words.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from arearisk.llm.common import blocks, id_and_text, kept, offsets_of

#: How the two supported vocabularies cut normalised text into words. L, N and S stand for letters,
#: numbers and white space.
WORD_LAYOUT = "'s|'t|'re|'ve|'m|'ll|'d|[L]+|[N]|[^SLN]+"
BYTE_LAYOUT = "'s|'t|'re|'ve|'m|'ll|'d| ?[L]+| ?[N]+| ?[^SLN]+|[S]+(?![^S])|[S]+"

#: Distinct words after which a worker forgets those that it has not met since it last forgot some.
REMEMBERED = 400_000

#: Bytes of texts whose new words are encoded together.
BLOCK = 8 << 20

#: Outside these code points Unicode versions may differ in what a letter is; the library's own splitter decides there.
_COMMON = (range(0x530), range(0x2000, 0x20d0))
_RARE = re.compile("[^" + "".join(f"{chr(r[0])}-{chr(r[-1])}" for r in _COMMON) + "]")


def _members(belongs: Callable[[str], bool]) -> str:
    """The common characters of a class, as ranges of a regular expression."""
    out: list[list[int]] = []
    for c in (c for r in _COMMON for c in r if belongs(chr(c))):
        if out and out[-1][1] == c - 1:
            out[-1][1] = c
        else:
            out.append([c, c])
    return "".join(f"{re.escape(chr(a))}-{re.escape(chr(b))}" for a, b in out)


def _splitter(layout: str) -> Callable[[str], list[str]]:
    """Cuts text of common characters into words. Plain ranges are twice as fast as classes of properties."""
    kinds = {"L": lambda c: unicodedata.category(c)[0] == "L", "N": lambda c: unicodedata.category(c)[0] == "N",
             # Information separators are no white space to Unicode.
             "S": lambda c: c.isspace() and not "\x1c" <= c <= "\x1f"}
    # Quoted endings such as 's are in small letters, so only the stand-ins are replaced.
    return re.compile(re.sub("[LNS]", lambda m: _members(kinds[m[0]]), layout)).findall


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself, or the next one from U+0100 on."""
    own = [33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255 for b in range(256)]
    spare = iter(range(256, 512))
    return [chr(b) if own[b] else chr(next(spare)) for b in range(256)]


def distinct(values: np.ndarray) -> np.ndarray:
    """Sorted values without repeats."""
    values.sort()
    return values[np.concatenate([[True], values[1:] != values[:-1]])] if len(values) > 1 else values


class PairIndex:
    """Merge rules of a vocabulary, applied to many words at once."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], suffix: str = ""):
        symbols = byte_symbols()
        self.inner = np.array([vocab[s] for s in symbols], np.int64)
        self.final = np.array([vocab[s + suffix] for s in symbols], np.int64)
        self.size = max(vocab.values()) + 1
        self.rules = [(vocab[a], vocab[b], vocab[a + b]) for a, b in merges]
        keys = np.array([a * self.size + b for a, b, _ in self.rules], np.int64)
        self.rank = np.argsort(keys, kind="stable")
        self.keys = keys[self.rank]

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, -1 without one."""
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.rank[at], -1)

    def encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words one after the other, and where each word's begin. Words are not empty."""
        bound = offsets_of([len(w) for w in words])
        raw = np.frombuffer(b"".join(words), np.uint8)
        n, last = raw.size, bound[1:] - 1
        sym = self.inner[raw]
        sym[last] = self.final[raw[last]]
        after, before, live = np.arange(1, n + 1), np.arange(-1, n - 1), np.ones(n, bool)
        after[last], before[bound[:-1]] = -1, -1
        index: dict[int, list[np.ndarray]] = {}
        active: list[int] = []

        def enter(pos: np.ndarray) -> None:
            rank = self.ranks(sym[pos], sym[after[pos]])
            known = np.flatnonzero(rank >= 0)
            if not known.size:
                return
            known = known[np.argsort(rank[known], kind="stable")]
            rank, pos = rank[known], pos[known]
            cut = np.flatnonzero(rank[1:] != rank[:-1]) + 1
            starts = [0, *cut.tolist(), len(rank)]
            for k, r in enumerate(rank[starts[:-1]].tolist()):
                if r not in index:
                    index[r] = []
                    heapq.heappush(active, r)
                index[r].append(pos[starts[k]:starts[k + 1]])

        enter(np.flatnonzero(after >= 0))
        while active:
            rank = heapq.heappop(active)
            found = index.pop(rank)
            a, b, made = self.rules[rank]
            pos = found[0] if len(found) == 1 else distinct(np.concatenate(found))
            right = after[pos]
            good = live[pos] & (sym[pos] == a) & (right >= 0)
            good &= sym[right] == b
            pos, right = pos[good], right[good]
            if a == b and len(pos) > 1:
                # In a run such as aaaa the first, third ... pair merges.
                at = np.arange(len(pos))
                head = np.concatenate([[True], pos[1:] != right[:-1]])
                good = (at - np.maximum.accumulate(np.where(head, at, 0))) % 2 == 0
                pos, right = pos[good], right[good]
            if not len(pos):
                continue
            beyond = after[right]
            linked = beyond >= 0
            sym[pos], after[pos], live[right] = made, beyond, False
            before[beyond[linked]] = pos[linked]
            left = before[pos]
            enter(distinct(np.concatenate([left[left >= 0], pos[linked]])))
        return sym[live].astype(np.int32), offsets_of(np.add.reduceat(live, bound[:-1], dtype=np.int64) if n else [])


class Encoder:
    """Whole texts to ids, exactly as the tokenizers library gives them for the same vocabulary file."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, splitter = spec["model"], spec["pre_tokenizer"]["type"]
        if model["type"] != "BPE" or splitter not in ("Sequence", "ByteLevel"):
            raise ValueError(f"{path}: only the word-end and the byte-level BPE layouts are supported")
        self.lower = splitter == "Sequence"
        self.cut = _splitter(WORD_LAYOUT if self.lower else BYTE_LAYOUT)
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.rules = PairIndex(model["vocab"], merges, model.get("end_of_word_suffix") or "")
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_pattern = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        self.library = Tokenizer.from_file(path)
        self.names = [""] * (1 + max([*model["vocab"].values(), *self.special.values()]))
        for name, i in [*model["vocab"].items(), *self.special.items()]:
            self.names[i] = name
        self.byte_of = {s: b for b, s in enumerate(byte_symbols())}
        self.raw = [bytes(self.byte_of[c] for c in x) if all(c in self.byte_of for c in x) else x.encode() for x in self.names]
        self.known: dict[str, bytes] = {}
        self.forget()

    def forget(self) -> None:
        """Words known now must be met again to stay known. The ids of special tokens, which are never words, stay."""
        self.older, self.known = self.known, {t: i.to_bytes(4, "little") for t, i in self.special.items()}

    def words(self, text: str) -> list[str]:
        """Words of a text and special tokens, in their order."""
        if self.special_pattern.search(text):
            out = []
            for part in self.special_pattern.split(text):
                out += [part] if part in self.special else self._plain_words(part)
            return out
        return self._plain_words(text)

    def _plain_words(self, text: str) -> list[str]:
        if _RARE.search(text):
            norm = self.library.normalizer.normalize_str(text) if self.lower else text
            return [bytes(self.byte_of[c] for c in w).decode() for w, _ in self.library.pre_tokenizer.pre_tokenize_str(norm)]
        if self.lower:
            # Character by character, so that a capital sigma never becomes a final one.
            text = text.lower() if text.isascii() else unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
        return self.cut(text)

    def learn(self, fresh: list[str]) -> None:
        """Encode distinct words, all together."""
        ids, bound = self.rules.encode([w.encode() for w in fresh])
        flat, cuts = ids.tobytes(), (4 * bound).tolist()
        self.known.update((w, flat[a:b]) for w, a, b in zip(fresh, cuts, cuts[1:]))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit numbers. Each text is cut once; new words of all are encoded together."""
        if len(self.known) > REMEMBERED:
            self.forget()
        known, older, get, fresh = self.known, self.older, self.known.get, {}
        waiting, out = [], []
        for text in texts:
            words = self.words(text)
            got = list(map(get, words))
            if None in got:
                for i, x in enumerate(got):
                    if x is None:
                        word = words[i]
                        x = older.get(word)
                        if x is None:
                            # Until it is known, a new word stands for itself; equal ones are kept once.
                            x = fresh.setdefault(word, word)
                        else:
                            known[word] = x
                        got[i] = x
                waiting.append(len(out))
                out.append(got)
            else:
                out.append(b"".join(got))
        if fresh:
            self.learn(list(fresh))
        for i in waiting:
            out[i] = b"".join([x if x.__class__ is bytes else known[x] for x in out[i]])
        return out

    def decode(self, ids: np.ndarray) -> str:
        """Text of the ids as the library's decode gives it, special tokens kept."""
        if self.lower:
            return " ".join(map(self.names.__getitem__, ids.tolist()))
        return b"".join(map(self.raw.__getitem__, ids.tolist())).decode("utf-8", "replace")


def encoder(path: str) -> Encoder:
    """This worker's encoder for a vocabulary file."""
    return kept(("encoder", path), lambda: Encoder(path))


def _ids_array(encoded: list[bytes]) -> pa.Array:
    bound = offsets_of([len(e) // 4 for e in encoded])
    return pa.LargeListArray.from_arrays(pa.array(bound), pa.array(np.frombuffer(b"".join(encoded), np.int32))).cast(pa.list_(pa.int32()))


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`doc_id` and `ids` (array of int) of every whole text. `path` must be readable on the executors.

    A NULL or empty text has no ids; rows with equal or NULL ids are kept as they are; an empty table gives
    an empty result. No other column is read, so none can clash.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        for t in blocks(batches, limit=BLOCK):
            ids = _ids_array(own.encode(t["text"].to_pylist()))
            yield from pa.table({"doc_id": t["doc_id"], "ids": ids}).to_batches()

    rows = id_and_text(docs, id_col, text_col)
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids array<int>")


def decode(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """`doc_id` and the decoded `text` of every row of ids. NULL ids count as none and give an empty text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        for b in batches:
            texts = [own.decode(np.asarray(x if x is not None else [], np.int64)) for x in b.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    from pyspark.sql import functions as F

    rows = encoded.select(F.col(id_col).alias("doc_id"), F.col(ids_col).alias("ids"))
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, text string")


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`encode` and `decode` in one pass: `doc_id`, `ids`, `decoded`. Same rules for missing and repeated rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        for t in blocks(batches, limit=BLOCK):
            got = own.encode(t["text"].to_pylist())
            back = [own.decode(np.frombuffer(g, np.int32)) for g in got]
            yield from pa.table({"doc_id": t["doc_id"], "ids": _ids_array(got), "decoded": pa.array(back, pa.string())}).to_batches()

    rows = id_and_text(docs, id_col, text_col)
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids array<int>, decoded string")
