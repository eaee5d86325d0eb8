"""Spelling variants by composing a minimised vocabulary acceptor with a one-edit transducer and the acceptor again.

A path of the composed machine reads a word on one side and a word at one edit on
the other. Until the edit both sides are in the same state; after it they must go
on alike to the end. So the edit leaves a state q by two different letters
(replacement) or by one letter on one side only (insertion, deletion), and what
remains is the common language of the two states reached.

The machine is cut by its initial states: two words at one edit either begin with
the same `KEY` letters or end with the same `KEY` (words have at least 2 x `KEY`
letters), so each group of words with one beginning, and of reversed words with one
ending, is an acceptor of its own, minimised and composed in one task. A beginning
that more than `WORDS` words share is cut by its next letter, again until none is
left; pairs whose edit lies right at a cut agree in all that follows it, which is an
equality join on the rest of the word. No pair is lost at any size, and no task
holds more than `WORDS` words.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arearisk.llm.common import id_and_text
from arearisk.scratch import materialize

#: A word: maximal runs of these letters.
LETTERS = r"[A-Za-zÀ-ÿ]+"

#: Letters of a word's beginning or ending that name its group.
KEY = 3

#: Words of one acceptor at most.
WORDS = 20_000


class Acceptor:
    """Minimal deterministic acceptor of sorted distinct words, built by merging equal states as words are finished.

    State 0 is the start. `arcs[q]` maps letters to states, `final[q]` says whether a word ends in q.
    """

    def __init__(self, words: list[str]):
        self.arcs: list[dict[str, int]] = [{}]
        self.final = [False]
        known: dict[tuple, int] = {}
        open_states, before = [0], ""
        for word in [*words, None]:
            same = 0
            if word is not None:
                for a, b in zip(word, before):
                    if a != b:
                        break
                    same += 1
            # States beyond the common beginning get no more arcs: an equal one may stand in.
            while len(open_states) - 1 > same:
                state = open_states.pop()
                own = (self.final[state], tuple(self.arcs[state].items()))
                twin = known.setdefault(own, state)
                if twin != state:
                    self.arcs[open_states[-1]][before[len(open_states) - 1]] = twin
                    if state == len(self.arcs) - 1:
                        self.arcs.pop()
                        self.final.pop()
            if word is None:
                break
            for letter in word[same:]:
                self.arcs.append({})
                self.final.append(False)
                self.arcs[open_states[-1]][letter] = len(self.arcs) - 1
                open_states.append(len(self.arcs) - 1)
            self.final[open_states[-1]] = True
            before = word


class Composition:
    """The acceptor, one edit, and the acceptor again."""

    def __init__(self, acceptor: Acceptor):
        self.arcs, self.final = acceptor.arcs, acceptor.final
        self._meets: dict[tuple[int, int], bool] = {}
        self._edited: dict[int, list[tuple[str, str]]] = {}

    def meets(self, a: int, b: int) -> bool:
        """Whether some word leads from both states to an end. No recursion: a word may be very long."""
        known, waiting = self._meets, [(a, b)]
        while waiting:
            pair = waiting[-1]
            if pair in known:
                waiting.pop()
                continue
            x, y = pair
            if x == y or (self.final[x] and self.final[y]):
                known[pair] = True
                continue
            beyond = self.arcs[y]
            steps = [(to, beyond[letter]) for letter, to in self.arcs[x].items() if letter in beyond]
            fresh = [p for p in steps if p not in known]
            if any(known.get(p) for p in steps):
                known[pair] = True
            elif fresh:
                waiting.append(fresh[0])
            else:
                known[pair] = False
        return known[a, b]

    def common(self, a: int, b: int, but: str = "") -> Iterator[str]:
        """Words that lead from both states to an end and do not begin with the letter `but`."""
        waiting = [(a, b, "")]
        while waiting:
            x, y, path = waiting.pop()
            if self.final[x] and self.final[y]:
                yield path
            beyond = self.arcs[y]
            for letter, to in self.arcs[x].items():
                if letter in beyond and (path or letter != but) and self.meets(to, beyond[letter]):
                    waiting.append((to, beyond[letter], path + letter))

    def edited(self, q: int) -> list[tuple[str, str]]:
        """What the two sides read from state q on if they part there. Of a run of equal letters one more is read at its end."""
        found = self._edited.get(q)
        if found is None:
            found, arcs = [], list(self.arcs[q].items())
            for i, (x, to) in enumerate(arcs):
                found += [(x + rest, rest) for rest in self.common(to, q, x)]
                for y, other in arcs[i + 1:]:
                    found += [(x + rest, y + rest) for rest in self.common(to, other)]
            self._edited[q] = found
        return found

    def leading(self) -> set[int]:
        """States from which some state with an edit is reached."""
        out, done, waiting = set(), set(), [(0, False)]
        while waiting:
            q, seen = waiting.pop()
            if seen:
                if self.edited(q) or not out.isdisjoint(self.arcs[q].values()):
                    out.add(q)
            elif q not in done:
                done.add(q)
                waiting.append((q, True))
                waiting += [(to, False) for to in self.arcs[q].values()]
        return out

    def pairs(self) -> Iterator[tuple[str, str]]:
        """Accepted pairs, each once: where its words first differ is one place."""
        leading = self.leading()
        waiting = [(0, "")]
        while waiting:
            q, path = waiting.pop()
            for u, v in self.edited(q):
                yield path + u, path + v
            for letter, to in self.arcs[q].items():
                if to in leading:
                    waiting.append((to, path + letter))


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", every: int = 199) -> DataFrame:
    """`word` and its occurrences `n` over all documents.

    Runs of letters with only A-Z lower-cased; a run whose crc32 with its document's id is divisible by `every`
    loses the letter that the crc32 names. NULL texts have no runs, a NULL id counts as empty text.
    """
    rows = id_and_text(docs, id_col, text_col)
    capitals, small = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    name = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"))
    runs = rows.select(name.alias("name"), F.explode(F.regexp_extract_all(
        F.translate("text", capitals, small), F.lit(LETTERS), F.lit(0))).alias("run"))
    h = F.crc32(F.concat("name", "run").cast("binary"))
    at = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring(F.col("run"), at + 2, F.length("run")))
    return runs.withColumn("h", h).select(F.when(F.col("h") % every == 0, cut).otherwise(F.col("run")).alias("word")) \
        .groupBy("word").agg(F.count("*").alias("n"))


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, int]]:
    """Words and their n of one key after another, from rows sorted by key."""
    key, held = None, {}
    for b in batches:
        for own, word, n in zip(*(b.column(c).to_pylist() for c in ("key", "word", "n"))):
            if own != key and held:
                yield held
                held = {}
            key = own
            held[word] = n
    if held:
        yield held


def _pairs_of(words: DataFrame, ending: bool) -> DataFrame:
    """Pairs (a, a_n, b, b_n) of words with the same key; from reversed words only those whose beginnings differ."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple[str, int, str, int]] = []

        def batch() -> pa.RecordBatch:
            columns = list(zip(*found))
            found.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64()) * 2)], ["a", "a_n", "b", "b_n"])

        for held in _groups(batches):
            if len(held) == 1:
                continue
            for u, v in Composition(Acceptor(sorted(held))).pairs():
                if not ending:
                    found.append((u, held[u], v, held[v]))
                elif u[-KEY:] != v[-KEY:]:
                    found.append((u[::-1], held[u], v[::-1], held[v]))
                if len(found) >= 10_000:
                    yield batch()
        if found:
            yield batch()

    return words.repartition("key").sortWithinPartitions("key").mapInArrow(run, "a string, a_n long, b string, b_n long")


def _cut(words: DataFrame, most: int) -> tuple[DataFrame, list[DataFrame]]:
    """Words with the beginning that names their acceptor, and the pairs whose edit lies at a cut.

    A beginning of `KEY` letters or more that over `most` words share is cut by the next letter. The lists of such
    beginnings stay tables.
    """
    done, pairs = words.select("word", "n", F.substring("word", 1, KEY).alias("key")), []
    length = KEY
    while True:
        # Words that were cut before have a key of `length` letters (or end before it).
        hot = done.where(F.length("key") == length).groupBy("key").agg(F.count("*").alias("size")).where(F.col("size") > most)
        hot = materialize(hot.select(F.col("key").alias("hot")), "spelling-hot")
        if hot.isEmpty():
            return done, pairs
        inside = materialize(done.join(hot, done["key"] == hot["hot"], "left"), "spelling-cut")
        at_cut = inside.where("hot IS NOT NULL")
        # Both sides of the edit: with its letter taken out of the place of the cut, and as it is.
        gone = at_cut.select("word", "n", "hot", F.substring("word", F.lit(length + 2), F.length("word")).alias("rest"),
                             F.lit(1).alias("out")).where(F.length("word") > length)
        kept = at_cut.select("word", "n", "hot", F.substring("word", F.lit(length + 1), F.length("word")).alias("rest"),
                             F.lit(0).alias("out"))
        met = gone.unionByName(kept).groupBy("hot", "rest").agg(
            F.collect_list(F.struct("word", "n", "out")).alias("w")).where(F.size("w") > 1)
        # At most one word as it is and one per letter of the alphabet.
        both = met.select(F.explode("w").alias("x"), "w").select("x", F.explode("w").alias("y")).where(
            (F.col("x.word") < F.col("y.word")) & (F.col("x.out") + F.col("y.out") > 0))
        # A run of equal letters at the cut is met again further on: only the place where letters first differ counts.
        differ = F.substring("x.word", length + 1, 1) != F.substring("y.word", length + 1, 1)
        pairs.append(both.where(differ).select(F.col("x.word").alias("a"), F.col("x.n").alias("a_n"),
                                               F.col("y.word").alias("b"), F.col("y.n").alias("b_n")))
        length += 1
        done = inside.select("word", "n", F.when(F.col("hot").isNotNull(), F.substring("word", 1, length))
                             .otherwise(F.col("key")).alias("key"))


def near_words(words: DataFrame, most: int = WORDS) -> DataFrame:
    """All pairs (a, a_n, b, b_n) of different words at one edit, each once, for words of at least 2 x `KEY` letters."""
    stored = materialize(words.select("word", "n"), "spelling-words")
    begun, pairs = _cut(stored, most)
    # Reversed: the edit lies within the first `KEY` letters, so reversed words agree in their first `KEY`.
    turned, at_cut = _cut(stored.select(F.reverse("word").alias("word"), "n"), most)
    found = _pairs_of(begun, False)
    found = found.unionByName(_pairs_of(turned, True))
    for p in pairs:
        found = found.unionByName(p)
    for p in at_cut:
        differ = F.right("a", F.lit(KEY)) != F.right("b", F.lit(KEY))
        found = found.unionByName(p.where(differ).select(F.reverse("a").alias("a"), "a_n", F.reverse("b").alias("b"), "b_n"))
    return found


def spelling_forms(counts: DataFrame, factor: int = 5, most: int = WORDS) -> DataFrame:
    """`word`, `n`, `n_near`, `form`, `form_n`, `root` for distinct words with their numbers of occurrences.

    A word's form is its near word of largest n (ties: smallest), if that is at least `factor` times its own n. As n
    grows by that factor along forms, a word is no more than some 27 forms from its root, so five doublings of the
    steps reach it.
    """
    words = materialize(counts.select("word", "n"), "spelling-counts")
    pairs = near_words(words, most)
    both = pairs.select(F.inline(F.array(F.struct("a", "b", "b_n"), F.struct(
        F.col("b").alias("a"), F.col("a").alias("b"), F.col("a_n").alias("b_n")))))
    best = both.groupBy("a").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("b_n")).alias("less"), "b")).alias("best"))
    best = best.select(F.col("a").alias("word"), "n_near", F.col("best.b").alias("b"), (-F.col("best.less")).alias("b_n"))
    fits = F.col("b_n") >= factor * F.col("n")
    formed = materialize(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(fits, F.col("b")).alias("form"), F.when(fits, F.col("b_n")).alias("form_n")), "spelling-forms")
    steps = formed.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    for _ in range(5):
        steps = materialize(steps, "spelling-steps")
        on = steps.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        steps = steps.join(on, "root", "left").select("word", F.coalesce("beyond", "root").alias("root"))
    return formed.join(steps, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame, least_letters: int = 2 * KEY, least_count: int = 5, factor: int = 5,
                      id_col: str = "doc_id", text_col: str = "text", most: int = WORDS) -> DataFrame:
    """`spelling_forms` of the words of all whole texts with enough letters and occurrences.

    NULL and empty texts have no words; a very long text is one row among others; repeated rows count each time; an
    empty table gives an empty result. No other column is read, so none can clash.
    """
    if least_letters < 2 * KEY:
        raise ValueError(f"words need at least {2 * KEY} letters: their beginnings and endings of {KEY} must not overlap")
    counts = word_counts(docs, id_col, text_col).where((F.length("word") >= least_letters) & (F.col("n") >= least_count))
    return spelling_forms(counts, factor, most)
