"""Language identification by hierarchical discrimination.

A text's family of languages is decided first, then the language among the closely
related ones of that family. Both decisions are votes of linear support vector
machines, one for each two classes, on hashed runs of one to four bytes of the whole
text. The machines are fitted on a bounded sample of the labelled documents, one
Spark task per machine; predicting is a map over all rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from arearisk.llm.common import blocks, is_held_out, offsets_of, quoted

#: Languages by family. A language that is not listed is a family of its own.
FAMILIES = {
    "germanic": ("en", "de", "nl", "af", "sv", "da", "no", "nb", "nn", "is"),
    "romance": ("fr", "es", "it", "pt", "ca", "gl", "ro", "oc"),
    "slavic": ("pl", "cs", "sk", "sl", "hr", "bs", "sr", "bg", "mk", "ru", "uk", "be"),
    "baltic": ("lt", "lv"),
    "finnic": ("fi", "et"),
    "turkic": ("tr", "az", "kk", "uz"),
    "indic": ("hi", "mr", "ne", "bn", "gu", "pa", "ur"),
    "malayic": ("id", "ms"),
    "semitic": ("ar", "he", "am"),
}

#: The fit reads at most this many documents of each language, and of each so many pieces of at most so many characters.
DOCS, PIECES, PIECE_CHARS = 500, 5, 1500

#: Hashed features, and the lengths of runs in bytes.
DIMENSIONS, RUNS = 1 << 15, 4
_SHIFT = np.uint32(32 - (DIMENSIONS.bit_length() - 1))

#: Bytes of texts that are scored together.
BLOCK = 4 << 20

UNKNOWN = "und"


def _letters() -> np.ndarray:
    """ASCII letters in lower case and all bytes of other characters; the rest counts as a space."""
    out = np.full(256, 32, np.uint8)
    for b in range(256):
        if chr(b).isalpha() and b < 128:
            out[b] = ord(chr(b).lower())
        elif b >= 128:
            out[b] = b
    return out


_LETTERS = _letters()


def runs_of(data: np.ndarray, bound: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Hashed runs of each length in texts of raw bytes, with where each text's begin.

    `bound` cuts `data` into texts. A text gets a space at either end, and several spaces count as one; no run spans two
    texts.
    """
    n = len(bound) - 1
    own = np.full(data.size + 2 * n, 32, np.uint8)
    text = np.repeat(np.arange(n), np.diff(bound))
    own[np.arange(data.size) + 2 * text + 1] = _LETTERS[data]
    starts = bound + 2 * np.arange(n + 1)
    keep = np.ones(own.size, bool)
    keep[1:] = (own[1:] != 32) | (own[:-1] != 32)
    keep[starts[:-1]] = True
    starts = offsets_of(keep)[starts]
    code = own[keep].astype(np.uint32)
    h = code * np.uint32(2654435761)
    for length in range(1, RUNS + 1):
        if length > 1:
            h = (h[:-1] ^ code[length - 1:]) * np.uint32(2654435761)
            h = h ^ (h >> np.uint32(15))
        # A run belongs to a text if it ends in it: all but the last `length` - 1 places of a text.
        counts = np.maximum(np.diff(starts) - (length - 1), 0)
        begin = offsets_of(counts)
        at = np.arange(begin[-1]) + np.repeat(starts[:-1] - begin[:-1], counts)
        yield h[at] >> _SHIFT, begin


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Places and values of a text's vector of unit length."""
    raw = np.frombuffer(text.encode(), np.uint8)
    at, n = np.unique(np.concatenate([h for h, _ in runs_of(raw, np.array([0, raw.size]))]), return_counts=True)
    return at.astype(np.int32), (n / np.linalg.norm(n)).astype(np.float32)


def pieces(text: str, seed: int, count: int = PIECES, most: int = PIECE_CHARS) -> list[str]:
    """Parts of a text of many lengths, from random places of the whole, so that short texts are learned as well."""
    rng = np.random.default_rng(seed & 0xFFFFFFFF)
    out = []
    for i in range(count):
        n = most if i == 0 else int(2 ** rng.uniform(3, np.log2(most)))
        at = int(rng.integers(0, max(1, len(text) - n + 1)))
        out.append(text[at:at + n])
    return [p for p in dict.fromkeys(out) if any(map(str.isalpha, p))]


def linear_machine(examples: list[tuple[np.ndarray, np.ndarray]], sides: np.ndarray, cost: float = 1.0, rounds: int = 10) -> np.ndarray:
    """Weights of a linear support vector machine with squared hinge loss, by descent on the dual, one example at a time."""
    weights, dual = np.zeros(DIMENSIONS), np.zeros(len(examples))
    slack, rng = 1 / (2 * cost), np.random.default_rng(0)
    for _ in range(rounds):
        for i in rng.permutation(len(examples)):
            at, x = examples[i]
            new = max(dual[i] - (sides[i] * (weights[at] @ x) - 1 + slack * dual[i]) / (1 + slack), 0.0)
            if new != dual[i]:
                weights[at] += (new - dual[i]) * sides[i] * x
                dual[i] = new
    return weights.astype(np.float32)


class Hierarchy:
    """Families of the learned languages, and the two sides of every machine: family against family, then within one."""

    def __init__(self, languages: list[str], families: Mapping[str, tuple[str, ...]] = FAMILIES):
        named = {lang: name for name, members in families.items() for lang in members}
        self.members: dict[str, list[str]] = {}
        for lang in sorted(languages):
            # A family of one is kept apart from any listed name.
            self.members.setdefault(named.get(lang, f"={lang}"), []).append(lang)
        self.families = sorted(self.members)
        self.machines = [(self.members[a], self.members[b]) for a, b in combinations(self.families, 2)]
        self.machines += [([a], [b]) for f in self.families for a, b in combinations(self.members[f], 2)]

    def decide(self, margins: np.ndarray) -> tuple[list[str], np.ndarray]:
        """Language and score of each row of margins, one column per machine."""
        family, sure = _vote(margins[:, :len(self.families) * (len(self.families) - 1) // 2], len(self.families))
        out, column = np.empty(len(margins), object), len(self.families) * (len(self.families) - 1) // 2
        for i, name in enumerate(self.families):
            own, size = np.flatnonzero(family == i), len(self.members[name])
            within, surer = _vote(margins[own, column:column + size * (size - 1) // 2], size)
            column += size * (size - 1) // 2
            out[own] = np.array(self.members[name], object)[within]
            sure[own] *= surer
        return out.tolist(), sure


def _vote(margins: np.ndarray, classes: int) -> tuple[np.ndarray, np.ndarray]:
    """Class with the most wins (ties: the larger sum of margins, then the first) and how surely it wins its closest pair."""
    wins, total = np.zeros((len(margins), classes)), np.zeros((len(margins), classes))
    closest = np.full((len(margins), classes), np.inf)
    for column, (a, b) in enumerate(combinations(range(classes), 2)):
        m = margins[:, column]
        for side, value in ((a, m), (b, -m)):
            wins[:, side] += (value > 0) + 0.5 * (value == 0)
            total[:, side] += value
            closest[:, side] = np.minimum(closest[:, side], value)
    best = np.lexsort((np.broadcast_to(-np.arange(classes), wins.shape), total, wins), axis=1)[:, -1]
    return best, 1 / (1 + np.exp(-np.clip(closest[np.arange(len(best)), best], -50, 50)))


def sample(labelled: DataFrame, sizes: dict[str, int], docs: int = DOCS) -> DataFrame:
    """At most `docs` rows (lang, text, place) of each language, spread by hash.

    A threshold from the exact numbers of rows leaves about four times `docs`, of which those with the smallest hashes stay.
    """
    place = F.xxhash64("doc_id", "text")
    share = F.element_at(F.create_map(*[F.lit(v) for k, n in sizes.items() for v in (k, 4 * docs / n)]), F.col("lang"))
    few = labelled.withColumn("place", place).where(F.pmod("place", F.lit(1 << 31)) < share * (1 << 31))
    order = Window.partitionBy("lang").orderBy("place", "doc_id", "text")
    return few.withColumn("nr", F.row_number().over(order)).where(F.col("nr") <= docs).select("lang", "text", "place")


def fit(labelled: DataFrame, families: Mapping[str, tuple[str, ...]] = FAMILIES, docs: int = DOCS) -> tuple[Hierarchy, np.ndarray]:
    """Machines for rows (doc_id, text, lang) without NULLs; a column of weights for each.

    The weights (4 x DIMENSIONS bytes per machine) pass the driver; their number follows the languages only.
    """
    sizes = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    tree = Hierarchy(list(sizes), families)
    weights = np.zeros((DIMENSIONS, len(tree.machines)), np.float32)
    if not tree.machines:
        return tree, weights
    sides: dict[str, list[tuple[int, int]]] = {lang: [] for lang in sizes}
    for number, (a, b) in enumerate(tree.machines):
        for lang in a:
            sides[lang].append((number, 1))
        for lang in b:
            sides[lang].append((number, -1))

    def examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in batches:
            for lang, text, place in zip(*(t.column(c).to_pylist() for c in ("lang", "text", "place"))):
                found = [features(p) for p in pieces(text, place)]
                rows = [(m, s, at, x) for m, s in sides[lang] for at, x in found]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int32()),
                     pa.array([r[2].tobytes() for r in rows], pa.binary()), pa.array([r[3].tobytes() for r in rows], pa.binary())],
                    ["machine", "side", "at", "x"])

    def machine(t: pa.Table) -> pa.Table:
        # The same order in every run.
        t = t.sort_by([("side", "ascending"), ("at", "ascending"), ("x", "ascending")])
        found = [(np.frombuffer(a, np.int32), np.frombuffer(x, np.float32)) for a, x in zip(t["at"].to_pylist(), t["x"].to_pylist())]
        own = linear_machine(found, t["side"].to_numpy())
        return pa.table({"machine": t["machine"].slice(0, 1), "weights": pa.array([own.tobytes()], pa.binary())})

    spread = sample(labelled, sizes, docs).repartition("place")
    done = spread.mapInArrow(examples, "machine int, side int, at binary, x binary") \
        .groupBy("machine").applyInArrow(machine, "machine int, weights binary")
    for r in done.collect():
        weights[:, r["machine"]] = np.frombuffer(r["weights"], np.float32)
    return tree, weights


def margins(texts: pa.ChunkedArray, weights: np.ndarray) -> np.ndarray:
    """Sums of weights over all runs of each text, over the root of their number."""
    column = texts.combine_chunks().cast(pa.large_string())
    bound = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    raw = np.frombuffer(column.buffers()[2] or b"", np.uint8)[bound[0]:bound[-1]]
    total, number = np.zeros((len(column), weights.shape[1])), np.zeros(len(column))
    for h, begin in runs_of(raw, bound - bound[0]):
        held = np.flatnonzero(np.diff(begin))
        number += np.diff(begin)
        for machine in range(weights.shape[1]):
            if held.size:
                total[held, machine] += np.add.reduceat(weights[h, machine], begin[held], dtype=np.float64)
    return total / np.sqrt(np.maximum(number, 1))[:, None]


def _has_letter(text: Column) -> Column:
    return text.rlike(r"\p{L}")


def identify(docs: DataFrame, families: Mapping[str, tuple[str, ...]] = FAMILIES, folds: int = 4, fold: int = 2,
             sample_docs: int = DOCS, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """`doc_id`, `held_out`, `lang_pred` and `score` (0 to 1) of every whole text.

    Learns from rows with text and language outside the held-out fold. A text that is NULL or without a letter is `und`
    with score 0, and so is every text if nothing could be learned; a single learned language is given to all others
    with score 1. Repeated rows and NULL ids are judged like any other (a NULL id counts as empty text for the fold);
    an empty table gives an empty result. Only the three named columns are read, so others cannot clash.
    """
    rows = docs.select(quoted(id_col).alias("doc_id"), quoted(text_col).alias("text"), quoted(lang_col).cast("string").alias("lang"))
    labelled = rows.where(F.col("lang").isNotNull() & ~is_held_out(F.col("doc_id"), folds, fold) & _has_letter(F.col("text")))
    tree, weights = fit(labelled, families, sample_docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in blocks(batches, limit=BLOCK):
            known = np.array(t["lettered"].to_pylist(), bool) & bool(tree.families)
            lang, score = np.full(t.num_rows, UNKNOWN, object), np.zeros(t.num_rows)
            at = np.flatnonzero(known)
            if at.size:
                own, sure = tree.decide(margins(t["text"].take(pa.array(at)), weights)) if tree.machines else (
                    tree.members[tree.families[0]] * at.size, np.ones(at.size))
                lang[at], score[at] = own, sure
            yield from pa.table({"doc_id": t["doc_id"], "held_out": t["held_out"], "lang_pred": pa.array(lang.tolist(), pa.string()),
                                 "score": pa.array(score)}).to_batches()

    given = rows.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), is_held_out(F.col("doc_id"), folds, fold).alias("held_out"),
                        F.coalesce(_has_letter(F.col("text")), F.lit(False)).alias("lettered"))
    return given.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, held_out boolean, lang_pred string, score double")
