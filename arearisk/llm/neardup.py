"""Near-duplicates by improved consistent weighted sampling over TF-IDF shingles.

A document is the weighted set of its five-word shingles, weight = count x idf.
Document frequencies are exact. Blocks of texts give out their distinct shingles, packed,
and exchange them in rounds of bounded fan-out until each range of the hash is summed in one
task; the same way back, each block gets the shingles that more than one document has. A text
carries the frequencies of its shingles from there on.

`BANDS` x `ROWS` consistent samples, banded, give buckets. One rule holds at every size: two
texts are linked if they share a bucket and their weighted Jaccard similarity, computed on whole
texts, reaches the threshold; pairs that links already join are not compared again. How texts
come together in tasks of bounded size depends on the number that hang together (see `links`).
Only links that join classes leave a task, never all pairs of a group. Equal texts are one text
throughout; their rows come back as members at the end.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arearisk.llm.common import blocks, forget, offsets_of, quoted
from arearisk.scratch import materialize

WORDS = 5
THRESHOLD = 0.8
BANDS = 14
ROWS = 4
SEED = 11

#: Most texts, and bytes of text, that meet in one task; about how many hubs a larger group has.
FAMILY = 4096
FAMILY_BYTES = 64 << 20
HUBS = 64

#: Most pieces that a run of document frequencies is cut into in one round.
RADIX = 256

#: Texts of a block and shingles of a chunk; the second keeps the sampling arrays in the processor's cache.
BLOCK = 4 << 20
CHUNK = 32_768

_U = np.uint64
_STEPS = 4096


def stored(df: DataFrame, label: str) -> DataFrame:
    """`materialize`, with the shuffle files of the write dropped at its end: nothing reads them again."""
    conf, name = df.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(name, None)
    conf.set(name, "true")
    try:
        return materialize(df, label)
    finally:
        conf.unset(name) if before is None else conf.set(name, before)


def mix(x: np.ndarray) -> np.ndarray:
    """Scatter the bits of 64-bit numbers."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _gamma_quantiles(steps: int) -> np.ndarray:
    """Quantiles of the Gamma(2, 1) distribution at the middle of equal shares."""
    p = (np.arange(steps) + 0.5) / steps
    low, high = np.zeros(steps), np.full(steps, 60.0)
    for _ in range(60):
        at = (low + high) / 2
        below = 1 - np.exp(-at) * (1 + at) < p
        low, high = np.where(below, at, low), np.where(below, high, at)
    return ((low + high) / 2).astype(np.float32)


_GAMMA = _gamma_quantiles(_STEPS)


def shingles(texts: list[str], size: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text number of every shingle of lower-cased words, text after text. A shorter text is one shingle."""
    raw = np.frombuffer(("\n".join([" ".join(t.lower().split()) for t in texts]) + "\n").encode("utf-8", "surrogatepass"), np.uint8)
    line_ends = np.flatnonzero(raw == 10)
    ends = np.flatnonzero((raw == 32) | (raw == 10))
    starts = np.concatenate([[0], ends[:-1] + 1])
    real = ends > starts
    starts, ends = starts[real], ends[real]
    if not len(starts):
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    doc = np.searchsorted(line_ends, starts)
    length = ends - starts
    flat = offsets_of(length)
    within = np.arange(flat[-1]) - np.repeat(flat[:-1], length)
    power = np.cumprod(np.concatenate([[1], np.full(int(length.max()), 0x100000001B3, np.uint64)]).astype(np.uint64))
    terms = (raw[np.repeat(starts, length) + within].astype(np.uint64) + _U(1)) * power[within]
    word = mix(np.add.reduceat(terms, flat[:-1]))
    n = len(word)
    if n >= size:
        whole = word[:n - size + 1].copy()
        for k in range(1, size):
            whole = whole * _U(0x9E3779B97F4A7C15) + word[k:n - size + 1 + k]
        inside = doc[:n - size + 1] == doc[size - 1:]
        out, owner = whole[inside], doc[:n - size + 1][inside]
    else:
        out, owner = np.empty(0, np.uint64), np.empty(0, np.int64)
    first = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
    count = np.diff(np.append(first, n))
    short = np.flatnonzero(count < size)
    if len(short):
        extra = np.array([_fold(word[first[i]:first[i] + count[i]]) for i in short.tolist()], np.uint64)
        out, owner = np.concatenate([out, extra]), np.concatenate([owner, doc[first[short]]])
        order = np.argsort(owner, kind="stable")
        out, owner = out[order], owner[order]
    return mix(out), owner


def _fold(words: np.ndarray) -> int:
    h = len(words)
    for w in words.tolist():
        h = (h * 0x9E3779B97F4A7C15 + w) % (1 << 64)
    return h


def counted(h: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each text, text after text: hash, text number, count; and their order by hash."""
    order = np.argsort(h, kind="stable")
    sh, sd = h[order], doc[order]
    fresh = np.ones(len(h), bool)
    fresh[1:] = (sh[1:] != sh[:-1]) | (sd[1:] != sd[:-1])
    first = np.flatnonzero(fresh)
    times = np.zeros(len(h), np.int64)
    times[order[first]] = np.diff(np.append(first, len(h)))
    kept = np.flatnonzero(times)
    place = np.cumsum(times > 0) - 1
    return h[kept], doc[kept], times[kept], place[order[first]]


class Weights:
    """idf of shingles, ln((N + 1) / (df + 1)) + 1: a table of those that more than one document has; others have that of one."""

    def __init__(self, hashes: np.ndarray, df: np.ndarray, total: int):
        order = np.argsort(hashes)
        self.hashes, self.df, self.total = hashes[order], df[order], total
        self.idf = self.weigh(self.df, 1)
        self.usual = float(self.weigh(np.ones(1), 1)[0])

    def weigh(self, df: np.ndarray, times) -> np.ndarray:
        """Weights of shingles by their document frequencies."""
        return (np.log((self.total + 1) / (df + 1)) + 1) * times

    def df_of(self, h: np.ndarray) -> np.ndarray:
        out = np.ones(len(h), np.uint32)
        if len(self.hashes):
            at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
            out = np.where(self.hashes[at] == h, self.df[at], out).astype(np.uint32)
        return out

    def of(self, h: np.ndarray, times: np.ndarray) -> np.ndarray:
        out = np.full(len(h), self.usual)
        if len(self.hashes):
            at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
            out = np.where(self.hashes[at] == h, self.idf[at], out)
        return out * times


_KEYS = mix(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64) * _U(0x9E3779B97F4A7C15) + _U(SEED))


def samples(h: np.ndarray, w: np.ndarray, bound: np.ndarray) -> np.ndarray:
    """Consistent weighted samples: one 32-bit value per text (rows of `bound`) and function."""
    out = np.empty((len(bound), len(_KEYS)), np.uint64)
    log_w = np.log(w).astype(np.float32)
    for k, key in enumerate(_KEYS):
        x = mix(h ^ key)
        r = _GAMMA[(x & _U(_STEPS - 1)).astype(np.int32)]
        beta = ((x >> _U(12)) & _U(_STEPS - 1)).astype(np.float32) * np.float32(1 / _STEPS)
        u1 = ((x >> _U(24)) & _U(0xFFFFF)).astype(np.float32) + np.float32(0.5)
        u2 = (x >> _U(44)).astype(np.float32) + np.float32(0.5)
        c = np.float32(40 * np.log(2)) - np.log(u1) - np.log(u2)
        t = np.floor(log_w / r + beta)
        height = np.log(np.maximum(c, np.float32(1e-7))) - r * (t - beta + np.float32(1)) + np.float32(100)
        value = ((x >> _U(32)) ^ (t.astype(np.int64).astype(np.uint64) * _U(0x9E3779B1))) & _U(0xFFFFFFFF)
        out[:, k] = np.minimum.reduceat((height.view(np.uint32).astype(np.uint64) << _U(32)) | value, bound) & _U(0xFFFFFFFF)
    return out


def bands(h: np.ndarray, doc: np.ndarray, w: np.ndarray, n: int) -> list[np.ndarray | None]:
    """Bucket numbers of each of n texts; none for a text without words."""
    out: list[np.ndarray | None] = [None] * n
    if not len(h):
        return out
    first = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
    ends = np.append(first[1:], len(h))
    start = 0
    while start < len(first):
        stop = max(start + 1, int(np.searchsorted(ends, first[start] + CHUNK, "right")))
        low, high = first[start], ends[stop - 1]
        got = samples(h[low:high], w[low:high], first[start:stop] - low)
        key = np.repeat(np.arange(1, BANDS + 1, dtype=np.uint64)[None, :], len(got), axis=0)
        for r in range(ROWS):
            key = mix(key * _U(0x9E3779B97F4A7C15) + got[:, r::ROWS])
        for i, d in enumerate(doc[first[start:stop]].tolist()):
            out[d] = key[i].view(np.int64)
        start = stop
    return out


def _df_of_block(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of a block in ascending order, and how many of its texts have them."""
    h, _, _, order = counted(*shingles(texts))
    by_hash = h[order]
    first = np.flatnonzero(np.concatenate([[True], by_hash[1:] != by_hash[:-1]])) if len(by_hash) else np.empty(0, np.int64)
    return by_hash[first], np.diff(np.append(first, len(by_hash))).astype(np.uint32)


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    forget()
    task = TaskContext.get().partitionId()
    for n, t in enumerate(blocks(batches, limit=BLOCK)):
        yield from t.append_column("block", pa.array(np.full(len(t), (task << 32) + n))).to_batches()


_PIECE = "node long, origin long, hashes binary, df binary"
_FOUND = "origin long, hashes binary, df binary"


def rounds_of(n: int) -> tuple[int, int]:
    """Rounds and pieces per round for n runs: as few rounds as `RADIX` allows, then as few pieces."""
    rounds = 1
    while RADIX ** rounds < n:
        rounds += 1
    radix = 1
    while radix ** rounds < n:
        radix += 1
    return rounds, radix


def _packed(rows: list[tuple], names: list[str]) -> pa.Table:
    columns = list(zip(*rows)) or [[]] * len(names)
    return pa.table([pa.array(c, pa.binary() if n in ("hashes", "df") else pa.int64()) for n, c in zip(names, columns)], names=names)


def _summed(t: pa.Table) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Distinct hashes of the pieces in ascending order, their sums, and where each piece's hashes lie among them."""
    hashes = [np.frombuffer(x, np.uint64) for x in t["hashes"].to_pylist()]
    names, inverse = np.unique(np.concatenate(hashes), return_inverse=True)
    df = np.bincount(inverse, np.concatenate([np.frombuffer(x, np.uint32) for x in t["df"].to_pylist()]), len(names)).astype(np.uint32)
    return names, df, np.split(inverse, offsets_of([len(x) for x in hashes])[1:-1])


def frequencies(blocked: DataFrame, n: int) -> DataFrame:
    """For each `block` of texts, packed, the `hashes` and `df` of its shingles that more than one row has; n is the number of blocks.

    A node's number has a digit per round. In a round the nodes that differ in its digit alone exchange pieces, cut by
    the same digit of the hash range, the highest first, and sum what they get; after the last round a node has all of
    its range. The sums go back the way the pieces came. A round moves at most `RADIX` pieces per node, and the
    number of rounds grows with the logarithm of n.
    """
    rounds, radix = rounds_of(n)
    nodes = radix ** rounds

    def cut(origin: int, node: int, h: np.ndarray, df: np.ndarray, place: int) -> list[tuple]:
        step = radix ** place
        digit = ((((h >> _U(32)) * _U(nodes)) >> _U(32)) // _U(step) % _U(radix)).astype(np.int64)
        names, first = np.unique(digit, return_index=True)
        bound, rest = [*first.tolist(), len(h)], node - node // step % radix * step
        return [(rest + d * step, origin, h[x:y].tobytes(), df[x:y].tobytes()) for d, x, y in zip(names.tolist(), bound, bound[1:])]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in blocks(batches, limit=BLOCK):
            for block in pc.unique(t["block"]).to_pylist():
                run = _df_of_block(t.filter(pc.equal(t["block"], block))["text"].to_pylist())
                node = int(mix(np.array([block], np.uint64))[0]) % nodes
                yield from _packed(cut(block, node, *run, rounds - 1), ["node", "origin", "hashes", "df"]).to_batches()

    def onward(place: int):
        def run(t: pa.Table) -> pa.Table:
            names, df, _ = _summed(t)
            node = t["node"][0].as_py()
            return _packed(cut(node, node, names, df, place), ["node", "origin", "hashes", "df"])
        return run

    def given_back(origins: list[int], names: np.ndarray, df: np.ndarray, lies: list[np.ndarray]) -> pa.Table:
        out = []
        for origin, at in zip(origins, lies):
            at = at[df[at] > 1]
            out.append((origin, names[at].tobytes(), df[at].tobytes()))
        return _packed(out, ["origin", "hashes", "df"])

    def add(t: pa.Table) -> pa.Table:
        return given_back(t["origin"].to_pylist(), *_summed(t))

    def back(t: pa.Table, found: pa.Table) -> pa.Table:
        names, _, lies = _summed(t)
        return given_back(t["origin"].to_pylist(), names, _unpacked(found, 1).df_of(names), lies)

    levels = [blocked.select("block", "text").mapInArrow(pack, _PIECE)]
    for place in range(rounds - 2, -1, -1):
        levels[-1] = stored(levels[-1], "runs")
        levels.append(levels[-1].groupBy("node").applyInArrow(onward(place), _PIECE))
    found = levels[-1].groupBy("node").applyInArrow(add, _FOUND)
    for level in reversed(levels[:-1]):
        found = level.groupBy("node").cogroup(found.groupBy("origin")).applyInArrow(back, _FOUND)
    return found.withColumnRenamed("origin", "block")


def _unpacked(t: pa.Table, total: int) -> Weights:
    return Weights(*(np.frombuffer(b"".join(t[c].to_pylist()), kind) for c, kind in (("hashes", np.uint64), ("df", np.uint32))), total)


def weights(rows: DataFrame) -> Weights:
    """The weights of the texts of all rows as one table, for corpora that fit the driver."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in blocks(batches, limit=BLOCK):
            h, df = _df_of_block(t["text"].to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(df.astype(np.int64))], ["shingle", "df"])

    found = rows.select("text").mapInArrow(run, "shingle long, df long").groupBy("shingle").agg(F.sum("df").alias("df")).filter("df > 1").toArrow()
    return Weights(found["shingle"].to_numpy().view(np.uint64), found["df"].to_numpy(), rows.count())


def spanning(texts: list[str], own: Weights, threshold: float = THRESHOLD, part: list[int] | None = None,
             apart=None, dfs: list[bytes] | None = None) -> tuple[list[tuple[int, int, float]], list[int]]:
    """Near pairs that join the texts of a bounded group as classes, and the class of each text.

    Every pair of texts that are not in one class yet is compared by its weighted Jaccard similarity. `part` holds
    the classes at the start, each named by its first text; `apart(text, others)` says which pairs are compared here;
    `dfs` are the document frequencies of the distinct shingles of each text, by default those of the table.
    """
    part, kept = list(range(len(texts))) if part is None else list(part), []

    def find(x: int) -> int:
        while part[x] != x:
            part[x] = part[part[x]]
            x = part[x]
        return x

    h, doc, times, _ = counted(*shingles(texts))
    w = own.of(h, times) if dfs is None else own.weigh(np.frombuffer(b"".join(dfs), np.uint32), times)
    first = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]])) if len(h) else np.empty(0, np.int64)
    here, ends = doc[first].tolist(), np.append(first[1:], len(h))
    total = np.add.reduceat(w, first) if len(h) else w
    names, number = np.unique(h, return_inverse=True)
    mine = np.zeros(len(names))
    size = ends - first
    for i, text in enumerate(here[:-1]):
        # The smaller total weight is at least the similarity times the larger one.
        able = np.flatnonzero((total[i + 1:] >= (threshold - 1e-6) * total[i]) & (total[i] >= (threshold - 1e-6) * total[i + 1:])) + i + 1
        root = find(text)
        others = np.array([j for j in able.tolist() if find(here[j]) != root], np.int64)
        if apart is not None and len(others):
            others = others[apart(text, np.array(here, np.int64)[others])]
        if not len(others):
            continue
        if len(others) == len(here) - i - 1:
            at = slice(int(first[i + 1]), len(h))
        else:
            bound = offsets_of(size[others])
            at = np.arange(bound[-1]) + np.repeat(first[others] - bound[:-1], size[others])
        low, high = first[i], ends[i]
        mine[number[low:high]] = w[low:high]
        shared = np.add.reduceat(np.minimum(mine[number[at]], w[at]), offsets_of(size[others])[:-1])
        mine[number[low:high]] = 0
        union = total[i] + total[others] - shared
        for k in np.flatnonzero(shared >= (threshold - 1e-9) * union).tolist():
            x, y = find(text), find(here[others[k]])
            if x != y:
                part[max(x, y)] = min(x, y)
                kept.append((text, here[others[k]], float(shared[k] / union[k])))
    return kept, [find(x) for x in range(len(texts))]


def _bodies(column: pa.ChunkedArray) -> tuple[list[str], list[bytes] | None]:
    """Texts, and the document frequencies that they carry."""
    texts, dfs = (pc.struct_field(column, c).to_pylist() for c in ("text", "dfs"))
    return texts, None if None in dfs else dfs


_LINK = "a binary, b binary, similarity double"


def _buckets(t: pa.Table) -> np.ndarray:
    return t["buckets"].combine_chunks().flatten().to_numpy().reshape(len(t), -1)


def _as_links(keys: list[bytes], pairs: list[tuple[int, int, float]]) -> pa.Table:
    return pa.table({"a": pa.array([keys[x] for x, _, _ in pairs], pa.binary()), "b": pa.array([keys[y] for _, y, _ in pairs], pa.binary()),
                     "similarity": pa.array([similarity for _, _, similarity in pairs], pa.float64())})


def _grouped(groups: DataFrame, by: list[str], shared, threshold: float) -> DataFrame:
    """Spanning links between the texts of every bounded group that share a bucket."""
    def run(t: pa.Table) -> pa.Table:
        t = t.take(pc.sort_indices(t["key"]))
        buckets, (texts, dfs) = _buckets(t), _bodies(t["text"])

        def apart(x: int, others: np.ndarray) -> np.ndarray:
            return (buckets[others] == buckets[x]).any(axis=1)

        return _as_links(t["key"].to_pylist(), spanning(texts, shared.value, threshold, apart=apart, dfs=dfs)[0])

    return groups.select(*by, "key", "text", "buckets").groupBy(*by).applyInArrow(run, _LINK)


def _sized(texts: DataFrame) -> DataFrame:
    """`texts` with the `size` of their group `root`: what counts is the number of chunks, so long texts count as several."""
    sized = texts.groupBy("root").agg(F.count("*").alias("n"), F.sum(F.octet_length("text.text")).alias("bytes"))
    return texts.join(sized.select("root", F.greatest("n", F.ceil(F.col("bytes") * (FAMILY / FAMILY_BYTES))).cast("long").alias("size")), "root")


def leading(texts: DataFrame, shared, threshold: float) -> DataFrame:
    """`key` and `shingle`: the rarest shingles of each text, without which the rest weighs less than the threshold asks.

    Two texts whose similarity reaches the threshold share one of them: let s be the rarest shingle that both have (ties by
    hash). All they share weighs at most as much as s and what follows it in either text, and at least the threshold
    times the text's weight, so s is among the leading ones of both. Shingles of one document alone are left out.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for t in blocks(batches, limit=BLOCK):
            h, doc, times, _ = counted(*shingles(t["text"].to_pylist()))
            dfs = t["dfs"].to_pylist()
            df = own.df_of(h) if None in dfs else np.frombuffer(b"".join(dfs), np.uint32)
            order = np.lexsort((h, df, doc))
            upto = np.concatenate([[0.0], np.cumsum(own.weigh(df, times)[order])])
            bound = upto[np.searchsorted(doc, np.arange(len(t) + 1))]
            # What a shingle and those after it weigh, against the whole text.
            keep = bound[doc + 1] - upto[:-1] >= (threshold - 1e-6) * (bound[doc + 1] - bound[doc])
            if None not in dfs:
                keep &= df[order] > 1
            yield pa.RecordBatch.from_arrays([t["key"].take(pa.array(doc[keep])).combine_chunks(), pa.array(h[order][keep].view(np.int64))], ["key", "shingle"])

    return texts.select("key", "text.text", "text.dfs").mapInArrow(run, "key binary, shingle long")


def _families(edges: DataFrame) -> DataFrame:
    """`node` and `root` of all texts that are linked by `key` and `least`."""
    family = components(edges, "key", "least")
    return family.union(family.select(F.col("root").alias("node"), "root").distinct())


def _stars(entries: DataFrame, by: str) -> DataFrame:
    """Each `key` with the smallest one that it shares a value of `by` with."""
    sizes = entries.groupBy(by).agg(F.count("*").alias("n"), F.min("key").alias("least")).filter("n > 1")
    return entries.select(by, "key").join(sizes, by).filter("key <> least").select("key", "least").distinct()


def links(rows: DataFrame, keys: DataFrame, own: Weights, threshold: float = THRESHOLD) -> DataFrame | None:
    """Links (`a`, `b`, `similarity`) that join near texts as classes; None if no two texts share a bucket.

    `rows`: `key` and `text` of all documents; `keys`: the distinct keys with their `buckets` and `dfs`, the document
    frequencies of their distinct shingles, packed; where these are not given they are looked up in `own`. Pairs are near
    if they share a bucket and reach the threshold. Texts that share buckets, directly or through others, are a family,
    and a family of up to `FAMILY` texts meets in one task. A larger one, as of texts that share a passage, falls into
    those that share `leading` shingles, which loses no near pair. What is still larger is dealt once into random chunks
    that all hold the same hubs, which joins most of a group of near copies; then all pairs that share a bucket and
    still lie in different classes are compared, chunk by chunk.
    """
    shared = rows.sparkSession.sparkContext.broadcast(own)
    entries = keys.select("key", F.explode("buckets").alias("bucket"))
    entries = stored(entries.join(entries.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1"), "bucket"), "buckets")
    stars = _stars(entries, "bucket")
    if stars.isEmpty():
        return None
    # The same plan at every size: the texts are shuffled once, by key. A text with copies comes once for each; any will do.
    given = keys.select("key", "buckets", "dfs" if "dfs" in keys.columns else F.lit(None).cast("binary").alias("dfs"))
    family = _families(stars).join(given, F.col("key") == F.col("node")).drop("key")
    texts = rows.join(family.hint("merge"), F.col("key") == F.col("node")).select("key", "root", F.struct("text", "dfs").alias("text"), "buckets")
    texts = _sized(stored(texts.dropDuplicates(["key"]), "member-texts"))
    found = stored(_grouped(texts.filter(F.col("size") <= FAMILY), ["root"], shared, threshold), "family-links")
    large = texts.filter(F.col("size") > FAMILY).drop("size")
    if large.isEmpty():
        return found
    large = large.drop("root")
    tied = _families(_stars(stored(leading(large, shared, threshold), "leading"), "shingle"))
    large = _sized(stored(large.join(tied, F.col("key") == F.col("node")).drop("node"), "large-texts"))
    found = found.union(stored(_grouped(large.filter(F.col("size") <= FAMILY), ["root"], shared, threshold), "tied-links"))
    large = large.filter(F.col("size") > FAMILY)
    if large.isEmpty():
        return found
    is_hub = F.pmod(F.xxhash64("key"), F.ceil(F.col("size") / HUBS)) == 0
    chunks = F.ceil(F.col("size") * 2 / FAMILY).cast("long")
    dealt = F.when(is_hub, F.sequence(F.lit(0).cast("long"), chunks - 1)).otherwise(F.array(F.pmod(F.xxhash64("key", F.lit(1)), chunks)))
    dealt = large.withColumn("chunk", F.explode(dealt))
    joined = stored(_grouped(dealt, ["root", "chunk"], shared, threshold).distinct(), "chunk-links")
    return found.union(joined).union(_crossed(entries, large, joined, shared, threshold))


def _crossed(entries: DataFrame, large: DataFrame, joined: DataFrame, shared, threshold: float) -> DataFrame:
    """Links between classes of large groups: all pairs that share a bucket and lie in different classes.

    The members of a bucket are dealt into chunks, those of its largest class into chunks of their own, which
    meet all others but not each other. A task compares one chunk with one other, or with itself. A pair is compared
    only in the first bucket that it shares.
    """
    roots = components(joined, "a", "b").withColumnRenamed("root", "part")
    part = large.select("key", F.octet_length("text.text").alias("bytes")).join(roots, F.col("key") == F.col("node"), "left")
    part = stored(part.select("key", "bytes", F.coalesce("part", "key").alias("part")), "large-parts")
    part = entries.select("bucket", "key").join(part, "key")
    classes = part.groupBy("bucket", "part").agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes"))
    largest = F.max(F.struct("n", "bytes", "part"))
    mixed = classes.groupBy("bucket").agg(F.count("*").alias("kinds"), F.sum("n").alias("n"), F.sum("bytes").alias("bytes"), largest.alias("most")).filter("kinds > 1")

    def chunks(n, size):
        return F.greatest(F.lit(1), F.ceil(n * 2 / FAMILY), F.ceil(size * 2 / FAMILY_BYTES)).cast("long")

    n, size, most = F.col("n"), F.col("bytes"), F.col("most")
    mixed = stored(mixed.select("bucket", most["part"].alias("most"), chunks(most["n"], most["bytes"]).alias("main"),
                                chunks(n - most["n"], size - most["bytes"]).alias("more")), "mixed")
    here = part.drop("bytes").join(mixed, "bucket").withColumn("in_main", F.col("part") == F.col("most"))
    turn = F.xxhash64("key", F.lit(2))
    here = here.withColumn("own", F.when(F.col("in_main"), F.pmod(turn, "main")).otherwise(F.col("main") + F.pmod(turn, "more")))
    here = here.withColumn("other", F.explode(F.sequence(F.when(F.col("in_main"), F.col("main")).otherwise(F.lit(0).cast("long")), F.col("main") + F.col("more") - 1)))
    here = here.select("bucket", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "key", "part")
    tiles = here.join(large.select("key", "text", "buckets"), "key")

    def run(t: pa.Table) -> pa.Table:
        t = t.take(pc.sort_indices(t["key"]))
        first: dict[bytes, int] = {}
        part = [first.setdefault(p, x) for x, p in enumerate(t["part"].to_pylist())]
        bucket, own, buckets = t["bucket"][0].as_py(), t["own"].to_numpy(), _buckets(t)
        two_sided = t["i"][0].as_py() != t["j"][0].as_py()

        def apart(x: int, others: np.ndarray) -> np.ndarray:
            alike = buckets[others] == buckets[x]
            at = buckets[x][alike.argmax(axis=1)] == bucket
            return at & (own[others] != own[x]) if two_sided else at

        texts, dfs = _bodies(t["text"])
        return _as_links(t["key"].to_pylist(), spanning(texts, shared.value, threshold, part, apart, dfs)[0] if len(first) > 1 else [])

    return stored(tiles.groupBy("bucket", "i", "j").applyInArrow(run, _LINK).distinct(), "crossed")


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """`node` and `root`, the smallest node that it is linked with, by alternating large and small stars."""
    now = stored(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct(), "stars")
    mark = None
    while True:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stored(large.filter("u <> v").distinct(), "large-stars")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v")))
        now = stored(small.filter("u <> v").distinct(), "small-stars")
        seen = now.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
        if seen == mark:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        mark = seen


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: `doc_id`, `key` (MD5 of its text), `class_id`, `class_key`, `class_size` and `links` of its text.

    `class_id` is the smallest id of the documents whose texts are equal or linked, directly or through others;
    `class_key` is the key of that document's text, the smallest if several texts have that id or no text has an id.
    `links` counts the verified links found at a text (a star per group, not all pairs). A NULL text is empty;
    texts without words are near only to equal ones; a text of fewer than five words is a single shingle. NULL
    ids are members of a class but do not name it unless it has no other id, repeated rows are members each; an
    empty table gives an empty result. Other columns are not read.
    """
    text = F.coalesce(quoted(text_col), F.lit(""))
    rows = docs.select(quoted(id_col).alias("doc_id"), text.alias("text"), F.unhex(F.md5(text.cast("binary"))).alias("key"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    # Stored, so that a block is the same rows each time.
    blocked = stored(rows.mapInArrow(_numbered, f"doc_id {kind}, text string, key binary, block long"), "blocks")
    total, parts = blocked.groupBy("block").agg(F.count("*").alias("n")).agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    own = Weights(np.empty(0, np.uint64), np.empty(0), total)
    heavy = stored(frequencies(blocked, parts), "frequencies")

    def run(t: pa.Table, found: pa.Table) -> pa.Table:
        known = _unpacked(found, total)
        texts, keys = t["text"].to_pylist(), t["key"].to_pylist()
        first: dict[bytes, int] = {}
        for i, k in enumerate(keys):
            first.setdefault(k, i)
        at = list(first.values())
        h, doc, times, _ = counted(*shingles([texts[i] for i in at]))
        df = known.df_of(h)
        ends = np.searchsorted(doc, np.arange(len(at) + 1))
        got: list[np.ndarray | None] = [None] * len(keys)
        dfs: list[bytes | None] = [None] * len(keys)
        for x, (i, b) in enumerate(zip(at, bands(h, doc, known.weigh(df, times), len(at)))):
            got[i], dfs[i] = b, None if b is None else df[ends[x]:ends[x + 1]].tobytes()
        return pa.table({"doc_id": t["doc_id"], "key": t["key"], "buckets": pa.array(got, pa.list_(pa.int64())), "dfs": pa.array(dfs, pa.binary())})

    members = blocked.groupBy("block").cogroup(heavy.groupBy("block")).applyInArrow(run, f"doc_id {kind}, key binary, buckets array<long>, dfs binary")
    members = stored(members, "members")
    keys = members.filter("buckets IS NOT NULL").select("key", "buckets", "dfs").groupBy("key").agg(F.first("buckets").alias("buckets"), F.first("dfs").alias("dfs"))
    tested = links(blocked.select("key", "text"), stored(keys, "keys"), own, threshold)
    texts = members.groupBy("key").agg(F.min("doc_id").alias("least"), F.count("*").alias("copies"))
    if tested is None:
        classes = texts.select("key", F.col("least").alias("class_id"), F.col("key").alias("class_key"), F.col("copies").alias("class_size"), F.lit(0).cast("long").alias("links"))
    else:
        near = stored(tested, "links")
        roots = components(near, "a", "b")
        degree = near.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count("*").alias("links"))
        texts = texts.join(roots, F.col("key") == F.col("node"), "left").drop("node")
        texts = texts.join(degree, F.col("key") == F.col("node"), "left").drop("node")
        texts = stored(texts.withColumn("root", F.coalesce("root", "key")), "texts")
        first = F.min(F.struct(F.col("least").isNull(), "least", "key"))
        named = texts.groupBy("root").agg(first["least"].alias("class_id"), first["key"].alias("class_key"), F.sum("copies").alias("class_size"))
        classes = texts.join(named, "root").select("key", "class_id", "class_key", "class_size", F.coalesce("links", F.lit(0)).cast("long").alias("links"))
    return members.select("doc_id", "key").join(classes, "key").select("doc_id", "key", "class_id", "class_key", "class_size", "links")


def drop_near(docs: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs`, all columns as they are, but one document of each class: the one that names it.

    That is the smallest id, NULL only if there is no other, and of the texts with this id the one with the smallest key.
    Rows that repeat both id and text of that document stay with it; `drop_copies` removes such repeats. NULL texts count
    as empty; an empty table gives an empty one; a row's columns stay together inside, so their names cannot clash.
    """
    classes = near_duplicates(docs, threshold, id_col, text_col)
    stays = F.col("doc_id").eqNullSafe(F.col("class_id")) & (F.col("key") == F.col("class_key"))
    gone = stored(classes.filter(~stays).select(
        F.col("key").alias("gone_key"), F.col("doc_id").alias("gone_id")).distinct(), "near-copies")
    rows = docs.select(F.struct(*[quoted(c) for c in docs.columns]).alias("row"))
    own_id, own_text = F.col("row").getField(id_col), F.col("row").getField(text_col)
    key = F.unhex(F.md5(F.coalesce(own_text, F.lit("")).cast("binary")))
    return rows.join(gone.hint("merge"), (key == F.col("gone_key")) & own_id.eqNullSafe(F.col("gone_id")), "left_anti").select("row.*")
