"""Toxicity scores from class-conditional Kneser-Ney models.

Two character models, one of toxic and one of ordinary words, give each word of
a text a log-likelihood. Both interpolate absolute discounting with continuation
counts from order `ORDER` down; the orders up to `SHARED` use counts pooled over
both classes, so an expression that is rare in either falls back on the same
estimate. The difference of the two log-likelihoods, per character, is turned
into a score by a logistic curve.

Labels are read only for documents outside the held-out fold. The n-grams of every
labelled document of the learning folds are counted with Spark: words, then n-grams
per class, then the distinct characters before them. The driver gets one row per
distinct n-gram and makes the table that is shared. Only the logistic curve, three
numbers, is fitted on a bounded sample, `CURVE_DOCS` documents of a fold of their
own. Scoring is a map over all rows; a worker remembers the words it has met in a
bounded table.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain, count, filterfalse

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arearisk.llm.common import blocks, id_and_text, is_held_out, kept, offsets_of, quoted
from arearisk.scratch import materialize

ORDER = 4
SHARED = 2
CURVE_DOCS = 4000
REMEMBERED = 500_000

#: Bytes of texts that a worker cuts into words at a time.
BLOCK = 4 << 20

_WORD = re.compile(r"\w+")
_BASE = 0x9E3779B97F4A7C15
_START, _END = "\x02", "\x03"


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


class Chars:
    """Characters of many words with the hash of the k characters that end at each place.

    A word is its start mark, its characters and its end mark. Characters of a
    word are scored from the one after the start mark on.
    """

    def __init__(self, words: list[str], order: int):
        framed = [_START + w + _END for w in words]
        self.bound = offsets_of([len(w) for w in framed])
        code = np.frombuffer("".join(framed).encode("utf-32-le"), np.uint32).astype(np.uint64) + np.uint64(1)
        n = len(code)
        #: Characters of the word up to and including this one.
        self.depth = (np.arange(1, n + 1) - np.repeat(self.bound[:-1], np.diff(self.bound))).astype(np.int32)
        running = np.zeros(n, np.uint64)
        self.mixed = [np.broadcast_to(np.uint64(0), n)]
        power, modulus = 1, 1 << 64
        for k in range(1, order + 1):
            running = running.copy()
            running[k - 1:] += code[:n - k + 1] * np.uint64(power)
            self.mixed.append(running ^ (running >> np.uint64(29)))
            power = power * _BASE % modulus
    def context(self, k: int, at: np.ndarray) -> np.ndarray:
        """Hash of the k - 1 characters before each place."""
        return self.mixed[k - 1][at - 1]


def find(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Place of each wanted key among sorted keys, -1 where it is not there."""
    if not len(keys):
        return np.full(len(wanted), -1)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, at, -1)


@dataclass
class Model:
    """Per order: known n-grams with both log-probabilities, known contexts with both back-off weights."""

    grams: list[np.ndarray] = field(default_factory=list)
    logs: list[np.ndarray] = field(default_factory=list)
    contexts: list[np.ndarray] = field(default_factory=list)
    weights: list[np.ndarray] = field(default_factory=list)
    floor: float = 0.0
    curve: np.ndarray = field(default_factory=lambda: np.array([50.0, 0.0, 0.0]))

    def logp(self, chars: Chars, at: np.ndarray, order: int) -> np.ndarray:
        """Log-probabilities (toxic, ordinary) of the characters at `at` given up to order - 1 before them."""
        out = np.zeros((len(at), 2))
        left, place = np.arange(len(at)), at
        for k in range(order, 0, -1):
            able = chars.depth[place] >= k
            hit = np.where(able, find(self.grams[k], chars.mixed[k][place]), -1)
            found = hit >= 0
            out[left[found]] += self.logs[k][hit[found]]
            missed = ~found
            known = np.where(able, find(self.contexts[k], chars.context(k, place)), -1)
            back = missed & (known >= 0)
            out[left[back]] += self.weights[k][known[back]]
            left, place = left[missed], place[missed]
        out[left] += self.floor
        return out

    def words(self, words: list[str]) -> np.ndarray:
        """Both log-likelihoods and the number of characters of each word, the end counted as one."""
        if not words:
            return np.zeros((0, 3))
        chars = Chars(words, ORDER)
        scored = np.flatnonzero(chars.depth > 1)
        both = np.zeros((len(chars.depth), 2))
        both[scored] = self.logp(chars, scored, ORDER)
        total = np.add.reduceat(both, chars.bound[:-1], axis=0)
        return np.column_stack([total, np.diff(chars.bound) - 1])

    def score(self, sums: np.ndarray) -> np.ndarray:
        """Score from both log-likelihoods and the number of characters."""
        return 1.0 / (1.0 + np.exp(-np.clip(margins(sums) @ self.curve, -50, 50)))


def margins(sums: np.ndarray) -> np.ndarray:
    """Difference of the log-likelihoods per character and per root of the length, and a constant."""
    n, gap = np.maximum(sums[:, 2], 1), sums[:, 0] - sums[:, 1]
    return np.column_stack([gap / n, gap / np.sqrt(n), np.ones(len(n))])


_GRAMS = "order int, gram long, context long, suffix long, longer long, whole boolean, toxic long, ordinary long"


def grams_of(words: list[str], counts: np.ndarray) -> pa.Table:
    """How often each class has the n-grams of distinct words: one row per order, n-gram and the same with the character before it.

    `whole` n-grams, those of the highest order and at the start of a word, count as often as they occur and have no
    character before them (`longer` is 0); the others once per distinct character before them (see `continued`).
    """
    chars = Chars(words, ORDER)
    raw = np.repeat(counts.astype(np.int64), np.diff(chars.bound), axis=0)
    parts = []
    for k in range(1, ORDER + 1):
        at = np.flatnonzero((chars.depth >= k) & (chars.depth > 1))
        plain = (chars.depth[at] == k) | (k == ORDER)
        for whole, place in ((True, at[plain]), (False, at[~plain]))[:1 if k == ORDER else 2]:
            _, first, group = np.unique(chars.mixed[k if whole else k + 1][place], return_index=True, return_inverse=True)
            n = np.zeros((len(first), 2), np.int64)
            np.add.at(n, group, raw[place])
            one = place[first]
            longer = np.zeros(len(one), np.uint64) if whole else chars.mixed[k + 1][one]
            hashes = [x.astype(np.uint64).view(np.int64) for x in (chars.mixed[k][one], chars.context(k, one), chars.mixed[k - 1][one], longer)]
            parts.append(pa.table([pa.array(np.full(len(one), k, np.int32)), *map(pa.array, hashes), pa.array(np.full(len(one), whole)),
                                   pa.array(n[:, 0]), pa.array(n[:, 1])],
                                  names=["order", "gram", "context", "suffix", "longer", "whole", "toxic", "ordinary"]))
    return pa.concat_tables(parts)


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for t in blocks(batches, "word", 1 << 20):
        yield from grams_of(t["word"].to_pylist(), np.column_stack([t["toxic"].to_numpy(), t["ordinary"].to_numpy()])).to_batches()


def continued(words: DataFrame) -> DataFrame:
    """Counts of every n-gram of the distinct `word`s with their `toxic` and `ordinary` counts: plain or continuation counts."""
    found = words.select("word", "toxic", "ordinary").mapInArrow(_count_grams, _GRAMS)
    found = found.groupBy("order", "gram", "context", "suffix", "longer", "whole").agg(F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary"))
    return found.groupBy("order", "gram", "context", "suffix").agg(
        *[F.sum(F.when(F.col("whole"), F.col(c)).otherwise((F.col(c) > 0).cast("long"))).alias(c) for c in ("toxic", "ordinary")])


def finished(found: pa.Table) -> Model:
    """Model from the counts of all n-grams."""
    model = Model([np.empty(0, np.uint64)], [np.empty((0, 2))], [np.empty(0, np.uint64)], [np.empty((0, 2))])
    orders = found["order"].to_numpy()
    if len(orders):
        # Every distinct character, the start mark, which is never scored, and one for unknown ones.
        model.floor = -float(np.log(int((orders == 1).sum()) + 2))
    for k in range(1, ORDER + 1):
        own = found.filter(pa.array(orders == k))
        gram, context, suffix = (own[c].to_numpy().view(np.uint64) for c in ("gram", "context", "suffix"))
        order = np.argsort(gram)
        gram, suffix = gram[order], suffix[order]
        n = np.column_stack([own["toxic"].to_numpy(), own["ordinary"].to_numpy()]).astype(np.float64)[order]
        if k <= SHARED:
            n = np.repeat(n.sum(axis=1, keepdims=True), 2, axis=1)
        context, inverse = np.unique(context[order], return_inverse=True)
        total, kinds = np.zeros((len(context), 2)), np.zeros((len(context), 2))
        np.add.at(total, inverse, n)
        np.add.at(kinds, inverse, (n > 0).astype(np.float64))
        ones, twos = (n == 1).sum(axis=0), (n == 2).sum(axis=0)
        discount = np.clip((ones + 0.5) / (ones + 2 * twos + 1.0), 0.1, 0.9)
        with np.errstate(divide="ignore", invalid="ignore"):
            weight = np.where(total > 0, discount * kinds / total, 1.0)
            # The n-gram without its first character is known: it occurs wherever the whole one does.
            lower = np.exp(model.logs[k - 1][find(model.grams[k - 1], suffix)]) if k > 1 else np.full((len(gram), 2), np.exp(model.floor))
            share = np.where(total[inverse] > 0, np.maximum(n - discount, 0) / total[inverse], 0.0)
        model.grams.append(gram)
        model.logs.append(np.log(share + weight[inverse] * lower).astype(np.float32))
        model.contexts.append(context)
        model.weights.append(np.log(weight).astype(np.float32))
    return model


def fit(words: list[str], counts: np.ndarray) -> Model:
    """Model from distinct words and how often each class (toxic, ordinary) has them, without Spark."""
    rows = grams_of(words, counts).group_by(["order", "gram", "context", "suffix", "longer", "whole"]).aggregate([("toxic", "sum"), ("ordinary", "sum")])
    for c in ("toxic", "ordinary"):
        n = rows[f"{c}_sum"]
        rows = rows.append_column(c, pc.if_else(rows["whole"], n, pc.cast(pc.greater(n, 0), pa.int64())))
    rows = rows.group_by(["order", "gram", "context", "suffix"]).aggregate([("toxic", "sum"), ("ordinary", "sum")])
    return finished(rows.rename_columns([c.removesuffix("_sum") for c in rows.column_names]))


def fit_curve(model: Model, sums: np.ndarray, toxic: np.ndarray) -> None:
    """Logistic curve through labelled documents by Newton's method; the rarer class weighs more, by the root of the odds."""
    if not toxic.any() or toxic.all():
        return
    x, y = margins(sums), toxic.astype(np.float64)
    scale = np.where(x.std(axis=0) > 0, x.std(axis=0), 1.0)
    x = x / scale
    odds = np.sqrt((1 - y.mean()) / y.mean())
    w, beta = np.where(toxic, odds, 1 / odds), np.zeros(3)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -50, 50)))
        step = np.linalg.solve((x * (w * p * (1 - p))[:, None]).T @ x + 0.01 * np.eye(3), x.T @ (w * (y - p)) - 0.01 * beta)
        beta += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    model.curve = beta / scale


class Scorer:
    """Scores whole texts, remembering words."""

    def __init__(self, model: Model):
        self.model, self.known, self.table = model, {}, np.zeros((0, 3))

    def sums(self, texts: list[str]) -> np.ndarray:
        """Both log-likelihoods and the number of characters of each text; zeros for a text without words."""
        if len(self.known) > REMEMBERED:
            self.known, self.table = {}, self.table[:0]
        cut = [words_of(t) for t in texts]
        fresh: set[str] = set()
        for words in cut:
            fresh.update(filterfalse(self.known.__contains__, words))
        new = sorted(fresh)
        parts = [self.table]
        for start in range(0, len(new), 50_000):
            parts.append(self.model.words(new[start:start + 50_000]))
        self.known.update(zip(new, range(len(self.table), len(self.table) + len(new))))
        self.table = np.concatenate(parts)
        n = np.array([len(words) for words in cut], np.int64)
        at = np.fromiter(map(self.known.__getitem__, chain.from_iterable(cut)), np.int64, int(n.sum()))
        out, some = np.zeros((len(texts), 3)), n > 0
        if some.any():
            out[some] = np.add.reduceat(self.table[at], offsets_of(n)[:-1][some], axis=0)
        return out


def _scorer(shared) -> Scorer:
    """This worker's scorer for a broadcast model."""
    return kept(("scorer", shared.id), lambda: Scorer(shared.value))


class _Shared:
    """A broadcast model that knows its number, so that a worker keeps one scorer for it."""

    def __init__(self, broadcast, number: int):
        self.broadcast, self.id = broadcast, number

    @property
    def value(self) -> Model:
        return self.broadcast.value


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for t in blocks(batches):
        counts: dict[int, Counter] = {0: Counter(), 1: Counter()}
        for label, text in zip(t["toxic"].to_pylist(), t["text"].to_pylist()):
            counts[label].update(words_of(text))
        for label, own in counts.items():
            yield pa.RecordBatch.from_arrays([
                pa.array([label] * len(own), pa.int32()), pa.array(own.keys(), pa.string()), pa.array(own.values(), pa.int64()),
            ], ["toxic", "word", "n"])


def fold_of(doc_id: Column, folds: int = 5) -> Column:
    """The fold of an id; fold 0 is held out."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def labelled_rows(labels: DataFrame, folds: int = 5, id_col: str = "doc_id", label_col: str = "toxic") -> tuple[DataFrame, DataFrame]:
    """Ids to learn from, `doc_id` and `toxic`: all for the models, and a sample of a fold of their own for the curve, stored.

    An id with several labels counts as toxic if any says so; NULL ids and labels are left out, the held-out fold too.
    """
    rows = (labels.select(quoted(id_col).alias("doc_id"), quoted(label_col).cast("int").alias("toxic"))
            .filter("doc_id IS NOT NULL AND toxic IN (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
            .filter(~is_held_out(F.col("doc_id"), folds)))
    rows = rows.withColumn("fold", fold_of(F.col("doc_id"), folds))
    curve = rows.filter(f"fold = {folds - 1}").orderBy(F.xxhash64("doc_id"), "doc_id").limit(CURVE_DOCS)
    return (materialize(rows.filter(f"fold < {folds - 1}").select("doc_id", "toxic"), "toxic-labels"),
            materialize(curve.select("doc_id", "toxic"), "toxic-curve"))


def train(docs: DataFrame, labels: DataFrame, folds: int = 5, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Fit both models on all labelled documents of the learning folds, the curve on a bounded sample of the last one."""
    learned, sample = labelled_rows(labels, folds)
    rows = id_and_text(docs, id_col, text_col).filter("doc_id IS NOT NULL")
    # The same plan at every size: the texts of the learning folds, labelled or not, are shuffled once, by id.
    words = (rows.filter(fold_of(F.col("doc_id"), folds).between(1, folds - 2)).join(learned.hint("merge"), "doc_id")
             .select("toxic", "text").mapInArrow(_count_words, "toxic int, word string, n long")
             .groupBy("word").agg(F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("toxic"),
                                 F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("ordinary")))
    model = finished(continued(words).toArrow())
    # At most CURVE_DOCS rows of an id and a label: bounded, so it may be broadcast.
    texts = rows.join(F.broadcast(sample), "doc_id")
    curve = _sums(texts.select(F.col("toxic").alias("doc_id"), "text"), model).toArrow()
    sums = np.column_stack([curve[c].to_numpy() for c in ("toxic_sum", "ordinary_sum", "characters")]).astype(np.float64)
    order = np.lexsort([*sums.T, curve["doc_id"].to_numpy()])
    fit_curve(model, sums[order], curve["doc_id"].to_numpy()[order] == 1)
    return model


def _sums(rows: DataFrame, model: Model) -> DataFrame:
    """`doc_id`, both log-likelihoods, the number of characters and the score of every row."""
    shared = _Shared(rows.sparkSession.sparkContext.broadcast(model), next(_numbers))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _scorer(shared)
        for t in blocks(batches, limit=BLOCK):
            sums = own.sums(t["text"].to_pylist())
            yield from pa.table({
                "doc_id": t["doc_id"], "toxic_sum": sums[:, 0], "ordinary_sum": sums[:, 1],
                "characters": sums[:, 2].astype(np.int64), "score": own.model.score(sums)}).to_batches()

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, toxic_sum double, ordinary_sum double, characters long, score double")


_numbers = count()


def score_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Score every whole text: `doc_id`, `held_out`, both log-likelihoods per character, `score`, `predicted`.

    A NULL or empty text, or one without a word, has log-likelihoods of zero and the score that the curve gives
    to no evidence. Equal texts get equal scores; NULL ids are scored, not learned from; without labels of both
    classes the curve is a fixed one; an empty table gives an empty result. Other columns are not read.
    """
    done = _sums(id_and_text(docs, id_col, text_col), train(docs, labels, id_col=id_col, text_col=text_col))
    n = F.greatest(F.col("characters"), F.lit(1))
    return done.select(
        "doc_id", is_held_out(F.col("doc_id")).alias("held_out"), (F.col("toxic_sum") / n).alias("toxic_logp"),
        (F.col("ordinary_sum") / n).alias("ordinary_logp"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, bound: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs`, all columns as they are, whose text scores below `bound`; same rules as `score_toxicity`."""
    shared = _Shared(docs.sparkSession.sparkContext.broadcast(train(docs, labels, id_col=id_col, text_col=text_col)), next(_numbers))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _scorer(shared)
        for t in blocks(batches, text_col, BLOCK):
            texts = [x or "" for x in t[text_col].to_pylist()]
            yield from t.filter(pa.array(own.model.score(own.sums(texts)) < bound)).to_batches()

    return docs.mapInArrow(run, docs.schema)
