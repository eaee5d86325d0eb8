"""Quality rules judged by an isolation forest on rule statistics.

One pass computes the rule statistics of every whole text. Trees split a bounded
sample of those rows at random features and places; documents whose mean path is
short are anomalous. The threshold comes from labelled rows: the one that finds
most low-quality rows while it flags at most `CLEAN_LOSS` of the good ones.
Statistics that grow with the length of a text enter as shares, so that a long
text is no anomaly.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arearisk.llm.common import blocks, id_and_text, quoted
from arearisk.scratch import materialize

TREES = 200
ROWS_PER_TREE = 32
CLEAN_LOSS = 0.01
BINS = 2000

#: Fixed values of the base rules.
SYMBOLS = b"#*$%&|<>"
LEAST_WORDS = 50
MOST_REPEATED = 0.5

#: Share of repeated lines that the published quality rules for web text allow; what is over it is a statistic of the trees.
MOST_DUP_LINES = 0.3

_UPPER = bytes(range(65, 91))
_MARKS = b"!?;:,."

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
SHARES = ["symbols", "capitals", "marks", "repeats", "word_length", "dup_lines"]


def repeated_words(words: list[bytes]) -> int:
    """Words inside three-word windows that occur more than once."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    often = {w for w, n in Counter(windows).items() if n > 1}
    end = total = 0
    for i, w in enumerate(windows):
        if w in often:
            total += i + 3 - max(i, end)
            end = i + 3
    return total


def statistics(text: bytes) -> tuple:
    """The counts of the base rules and the shares for the forest."""
    words = text.split()
    n, n_bytes = len(words), len(text)
    in_words = sum(map(len, words))
    # Bytes that continue a character are 0x80 to 0xBF; white space is one byte each.
    chars = in_words - (n_bytes - len(text.translate(None, _CONTINUED)))
    lines = [line for line in text.split(b"\n") if line.strip()]
    n_dup, n_repeat = len(lines) - len(set(lines)), repeated_words(words)

    def share(of: bytes) -> float:
        return (n_bytes - len(text.translate(None, of))) / max(chars, 1)

    symbols = n_bytes - len(text.translate(None, SYMBOLS))
    return (n, chars, symbols, n_dup, n_repeat,
            symbols / max(chars, 1), share(_UPPER), share(_MARKS), n_repeat / max(n, 1), min(chars / max(n, 1), 40.0),
            max(n_dup / max(len(lines), 1) - MOST_DUP_LINES, 0.0))


_CONTINUED = bytes(range(0x80, 0xC0))


def rule_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`doc_id`, the base counts and the shares of every whole text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in blocks(batches):
            rows = list(zip(*[statistics(x) for x in t["text"].to_pylist()])) or [[]] * len(COUNTS + SHARES)
            kinds = [pa.int64()] * len(COUNTS) + [pa.float64()] * len(SHARES)
            yield from pa.table({"doc_id": t["doc_id"]} | {c: pa.array(r, k) for c, r, k in zip(COUNTS + SHARES, rows, kinds)}).to_batches()

    rows = id_and_text(docs, id_col, text_col).withColumn("text", F.col("text").cast("binary"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, " + ", ".join([f"{c} long" for c in COUNTS] + [f"{c} double" for c in SHARES]))


def mean_path(n: np.ndarray | float) -> np.ndarray:
    """Mean path of an unsuccessful search in a random tree of n rows."""
    n = np.asarray(n, np.float64)
    with np.errstate(divide="ignore", invalid="ignore"):
        full = 2 * (np.log(n - 1) + 0.5772156649015329) - 2 * (n - 1) / n
    return np.where(n > 2, full, np.where(n == 2, 1.0, 0.0))


@dataclass
class Forest:
    """Trees as heaps: children of node i are 2i + 1 and 2i + 2; a leaf has feature -1 and its path length."""

    feature: np.ndarray
    place: np.ndarray
    path: np.ndarray
    rows: int

    def score(self, x: np.ndarray) -> np.ndarray:
        """Anomaly score of each row, from 0 to 1: 1 is a path of no length."""
        out = np.zeros(len(x))
        every = np.arange(len(x))
        for feature, place, path in zip(self.feature, self.place, self.path):
            node = np.zeros(len(x), np.int64)
            for _ in range(int(math.log2(len(feature) + 1)) - 1):
                f = feature[node]
                node = np.where(f >= 0, 2 * node + 1 + (x[every, f] >= place[node]), node)
            out += path[node]
        return 2.0 ** (-out / max(len(self.feature), 1) / max(float(mean_path(self.rows)), 1e-9))


def grow(x: np.ndarray, trees: int = TREES, rows: int = ROWS_PER_TREE, seed: int = 7) -> Forest:
    """Forest from sampled rows; each tree takes its own part of them, or draws one if there are too few."""
    rng = np.random.default_rng(seed)
    rows = max(1, min(rows, len(x)))
    depth = max(1, math.ceil(math.log2(max(rows, 2))))
    size = 2 ** (depth + 1) - 1
    forest = Forest(np.full((trees, size), -1), np.zeros((trees, size)), np.zeros((trees, size)), rows)
    order = rng.permutation(len(x))
    for t in range(trees):
        own = order[t * rows:(t + 1) * rows] if len(x) >= (t + 1) * rows else rng.choice(len(x), rows, replace=False)
        todo = [(0, 0, x[own])]
        while todo:
            node, level, part = todo.pop()
            low, high = part.min(axis=0), part.max(axis=0)
            able = np.flatnonzero(high > low)
            if level == depth or not len(able):
                forest.path[t, node] = level + mean_path(len(part))
                continue
            f = int(rng.choice(able))
            place = rng.uniform(low[f], high[f])
            place = high[f] if place <= low[f] else place
            forest.feature[t, node], forest.place[t, node] = f, place
            right = part[:, f] >= place
            todo += [(2 * node + 1, level + 1, part[~right]), (2 * node + 2, level + 1, part[right])]
    return forest


def threshold(good: np.ndarray, bad: np.ndarray, clean_loss: float = CLEAN_LOSS) -> float:
    """Lowest score bound that flags at most `clean_loss` of the good rows, given rows of both kinds per score bin.

    Above 1, so nothing is flagged, where no bad row is found that way.
    """
    lost, found = good[::-1].cumsum()[::-1], bad[::-1].cumsum()[::-1]
    able = np.flatnonzero((lost <= clean_loss * max(good.sum(), 1)) & (found > 0))
    return float(able[0]) / len(good) if len(able) else 1.01


def judge_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  label_col: str = "quality", clean_loss: float = CLEAN_LOSS) -> DataFrame:
    """`doc_id`, the base counts, `base_failed`, `anomaly` and `kept` of every whole text.

    `base_failed`: fewer than 50 words, or more than half of them in repeated three-word windows; such rows are
    not kept, nor are rows whose anomaly reaches the threshold. A NULL or empty text has no words and fails.
    The trees take up to TREES x ROWS_PER_TREE rows that passed the base rules, those with the smallest hash.
    Equal texts are judged alike; NULL ids are judged, but have no label; a label of an id counts as low if any
    says so; without labels of low quality nothing is flagged. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    failed = (F.col("n_words") < LEAST_WORDS) | (F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    stats = materialize(rule_statistics(docs, id_col, text_col).withColumn("base_failed", failed), "rule-statistics")
    sample = (stats.filter("NOT base_failed").orderBy(F.xxhash64(*COUNTS, "doc_id"), "doc_id", *COUNTS)
              .limit(TREES * ROWS_PER_TREE).select(*SHARES).toArrow())
    shares = np.column_stack([sample[c].to_numpy() for c in SHARES]) if len(sample) else np.zeros((1, len(SHARES)))
    shared = spark.sparkContext.broadcast(grow(shares))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.column_stack([b.column(c).to_numpy() for c in SHARES])
            score = shared.value.score(x) if len(x) else np.zeros(0)
            keep = [b.column(c) for c in ["doc_id", *COUNTS, "base_failed"]]
            yield pa.RecordBatch.from_arrays([*keep, pa.array(score)], ["doc_id", *COUNTS, "base_failed", "anomaly"])

    kind = stats.schema["doc_id"].dataType.simpleString()
    scored = materialize(stats.mapInArrow(
        run, f"doc_id {kind}, " + ", ".join(f"{c} long" for c in COUNTS) + ", base_failed boolean, anomaly double"), "anomalies")
    low = labels.select(quoted(id_col).alias("doc_id"), quoted(label_col).cast("int").alias("good")).dropna()
    low = low.groupBy("doc_id").agg(F.min("good").alias("good"))
    bins = (scored.filter("NOT base_failed").join(low, "doc_id").groupBy(F.floor(F.col("anomaly") * BINS).cast("int").alias("bin"))
            .agg(F.sum((F.col("good") > 0).cast("long")).alias("good"), F.sum((F.col("good") <= 0).cast("long")).alias("bad")).collect())
    good, bad = np.zeros(BINS + 1), np.zeros(BINS + 1)
    for r in bins:
        good[min(r["bin"], BINS)], bad[min(r["bin"], BINS)] = r["good"], r["bad"]
    bound = threshold(good[:BINS], bad[:BINS], clean_loss)
    return scored.withColumn("kept", ~F.col("base_failed") & (F.col("anomaly") < bound))
