"""Exact and near duplicates and sharding against brute force."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from arearisk.llm import exactdup, neardup, shards


def lowered(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")


@pytest.mark.parametrize("keep", ["max", "min"])
@pytest.mark.parametrize("table", ["odd", "docs"])
def test_exact_groups(table, keep, request):
    df = request.getfixturevalue(table)
    groups = defaultdict(list)
    for r in df.collect():
        groups[lowered(r["text"])].append(r["doc_id"])
    best = {t: (max if keep == "max" else min)([i for i in ids if i is not None], default=None) for t, ids in groups.items()}
    got = exactdup.exact_groups(df, keep).collect()
    sha = {hashlib.sha256(t.encode()).hexdigest(): t for t in groups}
    assert len(got) == df.count()
    for r in got:
        t = sha[r["text_sha256"]]
        assert r["keep_id"] == best[t] and r["group_size"] == len(groups[t])
        assert not r["kept"] or r["doc_id"] == best[t]
    assert Counter(r["text_sha256"] for r in got if r["kept"]) == Counter(sha.keys())
    kept = exactdup.drop_copies(df, keep)
    assert kept.schema.names == df.schema.names
    assert sorted(lowered(r["text"]) for r in kept.collect()) == sorted(groups)


def test_many_runs_meet(docs):
    """Three rounds of exchange give what one grouping gives."""
    own = exactdup.text_digests(docs.repartition(20)).cache()
    got = exactdup.merged_runs(own, nodes=100)
    want = own.groupBy("sha").agg({"doc_id": "max", "*": "count"})
    assert sorted((bytes(r["sha"]), r["keep_id"], r["n"]) for r in got.collect()) == sorted((bytes(r[0]), r["max(doc_id)"], r["count(1)"]) for r in want.collect())


def test_empty_tables(none):
    assert exactdup.exact_groups(none).count() == 0 and exactdup.drop_copies(none).count() == 0
    assert neardup.near_duplicates(none).count() == 0 and neardup.drop_near(none).count() == 0
    assert shards.shards(shards.external_shuffle(none)).count() == 0


def brute_classes(rows, own):
    texts = sorted({t or "" for _, t in rows})
    h, doc, times, _ = neardup.counted(*neardup.shingles(texts))
    w = own.of(h, times)
    sets = defaultdict(dict)
    for a, d, x in zip(h.tolist(), doc.tolist(), w.tolist()):
        sets[d][a] = x
    part = list(range(len(texts)))

    def find(x):
        while part[x] != x:
            x = part[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            both = sum(min(x, sets[j][a]) for a, x in sets[i].items() if a in sets[j])
            if both and both / (sum(sets[i].values()) + sum(sets[j].values()) - both) >= 0.8 - 1e-9:
                a, b = find(i), find(j)
                part[max(a, b)] = min(a, b)
    ids = defaultdict(list)
    for i, t in rows:
        ids[find(texts.index(t or ""))].append(i)
    return {find(k): min([i for i in ids[find(k)] if i is not None], default=None) for k in range(len(texts))}, texts, find, ids


@pytest.mark.parametrize(("family", "hubs"), [(4096, 64), (5, 3)])
@pytest.mark.parametrize("table", ["odd", "docs"])
def test_near_classes(table, family, hubs, request, monkeypatch):
    monkeypatch.setattr(neardup, "FAMILY", family)
    monkeypatch.setattr(neardup, "HUBS", hubs)
    df = request.getfixturevalue(table)
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    own = neardup.weights(df.selectExpr("coalesce(text, '') AS text"))
    named, texts, find, ids = brute_classes(rows, own)
    want = Counter((i, named[find(texts.index(t or ""))], len(ids[find(texts.index(t or ""))])) for i, t in rows)
    got = neardup.near_duplicates(df).collect()
    assert Counter((r["doc_id"], r["class_id"], r["class_size"]) for r in got) == want
    kept = neardup.drop_near(df)
    assert kept.schema.names == df.schema.names
    assert {r["doc_id"] for r in kept.collect()} == {c for c in named.values()}


def test_passages_weigh_by_their_exact_frequency(spark):
    """Texts that share only a passage of 0.9 % of the documents are apart by exact idf, which flat weights would join."""
    passage = " ".join(f"p{i}" for i in range(94))
    texts = [passage + f" own{k} a{k} b{k} c{k} d{k} e{k} f{k} g{k} h{k} i{k}" for k in range(9)]
    texts += [f"single{k} text{k} of{k} its{k} own{k}" for k in range(991)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    shingles = [Counter(zip(*[t.split()[i:] for i in range(5)])) for t in texts]
    frequency = Counter(x for s in shingles for x in s)
    idf = {x: np.log(1001 / (n + 1)) + 1 for x, n in frequency.items()}
    shared = sum(idf[x] for x in shingles[0] if x in shingles[1])
    similarity = shared / (sum(idf[x] for x in shingles[0]) + sum(idf[x] for x in shingles[1]) - shared)
    assert similarity < 0.79 and len(shingles[0] & shingles[1]) / len(shingles[0] | shingles[1]) > 0.8
    assert {r["class_size"] for r in neardup.near_duplicates(df).collect()} == {1}


def test_one_of_a_class_without_ids_stays(spark):
    """Near texts without any id, or with one and the same id, leave one document."""
    base = " ".join(f"w{i}" for i in range(100))
    rows = [(None, base), (None, base + " end"), (None, base + " stop"), (7, base.replace("w", "v")), (7, base.replace("w", "v") + " end"),
            (None, base.replace("w", "v") + " stop"), (None, "something else")]
    kept = neardup.drop_near(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert Counter(r["doc_id"] for r in kept) == {None: 2, 7: 1}


def test_chain_in_a_large_family(spark, monkeypatch):
    """Texts of one bucket that are near to the next one only, in a family of many chunks, form the classes of brute force."""
    monkeypatch.setattr(neardup, "FAMILY", 20)
    monkeypatch.setattr(neardup, "HUBS", 4)
    rows = [(k, " ".join(f"w{i}" for i in range(10 * k, 10 * k + 105))) for k in range(60)]
    named, *_ = brute_classes(rows, own := neardup.Weights(np.empty(0, np.uint64), np.empty(0), len(rows)))
    assert set(named.values()) == {0}
    table = spark.createDataFrame([(bytearray(hashlib.md5(t.encode()).digest()), t) for _, t in rows], "key binary, text string")
    got = neardup.links(table, table.selectExpr("key", "array(7L, 8L) AS buckets"), own).collect()
    part = {bytes(r["key"]): {bytes(r["key"])} for r in table.collect()}
    for r in got:
        both = part[bytes(r["a"])] | part[bytes(r["b"])]
        part.update(dict.fromkeys(both, both))
    assert {len(p) for p in part.values()} == {len(rows)}


@pytest.mark.parametrize(("radix", "rounds"), [(256, 1), (6, 2), (3, 3)])
def test_frequencies_by_rounds(docs, monkeypatch, radix, rounds):
    """Every block gets the exact frequencies of its shingles, whatever the number of rounds."""
    monkeypatch.setattr(neardup, "RADIX", radix)
    rows = docs.selectExpr("coalesce(text, '') AS text").repartition(20)
    blocked = rows.withColumn("block", F.pmod(F.xxhash64("text"), F.lit(20))).repartition(5, "block")
    assert neardup.rounds_of(20)[0] == rounds
    own = neardup.weights(rows)
    want = {}
    for b in {r["block"] for r in blocked.collect()}:
        h, _ = neardup._df_of_block([r["text"] for r in blocked.filter(F.col("block") == b).collect()])
        df = own.df_of(h)
        want[b] = dict(zip(h[df > 1].tolist(), df[df > 1].tolist()))
    got = defaultdict(dict)
    for r in neardup.frequencies(blocked, 20).collect():
        h, df = np.frombuffer(r["hashes"], np.uint64).tolist(), np.frombuffer(r["df"], np.uint32).tolist()
        assert not got[r["block"]].keys() & set(h)
        got[r["block"]].update(zip(h, df))
    assert got == want


@pytest.mark.parametrize("family", [4096, 3])
def test_one_rule_at_every_size(spark, monkeypatch, family):
    """Near texts without a common bucket are not linked, in a small group or a large one; those with one are."""
    monkeypatch.setattr(neardup, "FAMILY", family)
    base = [f"w{i}" for i in range(200)]
    texts = [" ".join([*base, f"x{k}"]) for k in range(6)]
    buckets = [[1, 10], [1, 11], [2, 11], [2, 12], [3, 14], [3, 15]]
    keys = [hashlib.md5(t.encode()).digest() for t in texts]
    table = spark.createDataFrame([(bytearray(k), t, b) for k, t, b in zip(keys, texts, buckets)], "key binary, text string, buckets array<long>")
    got = neardup.links(table.select("key", "text"), table.select("key", "buckets"), neardup.Weights(np.empty(0, np.uint64), np.empty(0), 6))
    pairs = {frozenset((keys.index(bytes(r["a"])), keys.index(bytes(r["b"])))) for r in got.collect()}
    assert pairs == {frozenset(p) for p in [(0, 1), (1, 2), (2, 3), (4, 5)]}


def test_unrelated_texts_with_one_passage(spark, monkeypatch):
    """A family that shares buckets and a passage only falls apart by its leading shingles; near pairs in it are found."""
    monkeypatch.setattr(neardup, "FAMILY", 8)
    passage = " ".join(f"p{i}" for i in range(120))
    texts = [passage + " " + " ".join(f"o{k}a{i}" for i in range(60)) for k in range(80)]
    texts += [texts[k] + " end" for k in range(0, 80, 9)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    sizes = Counter(r["class_size"] for r in neardup.near_duplicates(df).collect())
    assert sizes == {1: 71, 2: 18}
    keys = df.select(F.unhex(F.md5(F.col("text").cast("binary"))).alias("key"), F.array(F.lit(5).cast("long")).alias("buckets"))
    rows = df.select(F.unhex(F.md5(F.col("text").cast("binary"))).alias("key"), "text")
    assert neardup.links(rows, keys, neardup.weights(df)).count() == 9


def test_near_texts_share_a_leading_shingle(spark):
    """No pair of texts at the threshold or above is without a common leading shingle."""
    rng = np.random.default_rng(3)
    base = [[f"{c}{i}" for i in range(80)] for c in "abc"]
    texts = [" ".join(w if rng.random() > 0.02 else f"n{rng.integers(40)}" for w in base[k % 3]) for k in range(60)]
    df = spark.createDataFrame([(bytearray(hashlib.md5(t.encode()).digest()), t) for t in texts], "key binary, text string")
    own = neardup.weights(df)
    shared = spark.sparkContext.broadcast(own)
    leads = defaultdict(set)
    for r in neardup.leading(df.select("key", F.struct("text", F.lit(None).cast("binary").alias("dfs")).alias("text")), shared, 0.8).collect():
        leads[bytes(r["key"])].add(r["shingle"])
    weights = [Counter(zip(*[t.split()[i:] for i in range(5)])) for t in texts]
    frequency = Counter(x for w in weights for x in w)
    near = 0
    for i, a in enumerate(weights):
        for j, b in enumerate(weights[:i]):
            idf = {x: np.log(61 / (frequency[x] + 1)) + 1 for x in a | b}
            both, either = sum(idf[x] * n for x, n in (a & b).items()), sum(idf[x] * n for x, n in (a | b).items())
            if both >= 0.8 * either:
                near += 1
                assert leads[hashlib.md5(texts[i].encode()).digest()] & leads[hashlib.md5(texts[j].encode()).digest()]
    assert near > 10


def test_samples_agree_as_often_as_the_similarity_says():
    rng = np.random.default_rng(5)
    base = [f"w{i}" for i in range(300)]
    texts = [" ".join(base)] + [" ".join(b if rng.random() > 0.03 else f"x{k}{i}" for i, b in enumerate(base)) for k in range(40)]
    texts = [t for pair in zip([f"q{k} " + " ".join(rng.permutation(base)) for k in range(41)], texts) for t in pair]
    h, doc, times, _ = neardup.counted(*neardup.shingles(texts))
    own = neardup.Weights(np.empty(0, np.uint64), np.empty(0), 1000)
    first = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
    got = neardup.samples(h, own.of(h, times), first)
    exact, seen = [], []
    for k in range(3, len(texts), 2):
        a, b = set(h[doc == 1].tolist()), set(h[doc == k].tolist())
        exact.append(len(a & b) / len(a | b))
        seen.append((got[1] == got[k]).mean())
    assert abs(np.mean(exact) - np.mean(seen)) < 0.08


def test_heavy_shingles_weigh_less(spark):
    df = spark.createDataFrame([(f"license text that all of them share {i} a{i} b{i} c{i} d{i} e{i}",) for i in range(300)], "text string")
    own = neardup.weights(df)
    h, _, times, _ = neardup.counted(*neardup.shingles(["license text that all of them share", "one two three four five"]))
    w = own.of(h, times)
    assert w[0] < w[-1] and w[-1] == pytest.approx(own.usual)


@pytest.mark.parametrize("table", ["odd", "docs"])
def test_shards_are_even_and_gapless(table, request):
    df = request.getfixturevalue(table)
    got = shards.shards(shards.external_shuffle(df, bucket_bytes=20_000), 8).collect()
    assert Counter((r["doc_id"], r["text"]) for r in got) == Counter((r["doc_id"], r["text"]) for r in df.collect())
    sizes = Counter(r["shard"] for r in got)
    assert max(sizes.values()) - min(sizes.get(k, 0) for k in range(8)) <= 1
    for k, n in sizes.items():
        assert sorted(r["slot"] for r in got if r["shard"] == k) == list(range(n))


def test_order_depends_on_the_seed_alone(docs):
    def order(df, seed):
        return {r["doc_id"]: (r["bucket"], r["place"]) for r in shards.external_shuffle(df, seed, 30_000).collect()}

    assert order(docs, 1) == order(docs.repartition(7), 1) != order(docs, 2)


def test_equal_rows_are_scattered(spark, monkeypatch):
    """A row that occurs thousands of times fills no bucket, and its copies lie the same however the input is split."""
    monkeypatch.setattr(shards, "STRETCH", 70)
    rows = [(None, "", 1)] * 3000 + [(k, f"text {k}", k % 2) for k in range(500)] + [(3, "text 3", 1)] * 2 + [(None, "", None)] * 5
    df = spark.createDataFrame(rows, "doc_id long, text string, more int")
    # A row counts 16 bytes and its text.
    got = [shards.external_shuffle(d, bucket_bytes=3000).collect() for d in (df.repartition(3), df.repartition(11))]
    assert Counter(map(str, [tuple(r["row"]) for r in got[0]])) == Counter(map(str, rows))
    assert max(Counter(r["bucket"] for r in got[0]).values()) < 300
    assert sorted(map(str, got[0])) == sorted(map(str, got[1]))


def test_written_shards(docs, spark, tmp_path):
    done = shards.shards(shards.external_shuffle(docs), 4)
    shards.write_shards(done, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert {c for c in back.columns} == {*docs.columns, "slot", "shard"} and back.count() == docs.count()


def test_names_that_clash_with_our_own(spark, tmp_path):
    """Rows with columns named like those that the operators add."""
    text = " ".join(f"word{i}" for i in range(60))
    rows = [(1, text, "a", 7, 0, "x"), (2, text + " more", "b", 8, 1, "y"), (None, "alone in its class here", None, None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, gone_key string, gone_id long, shard int, slot string")
    left = neardup.drop_near(df)
    assert left.columns == df.columns and sorted(r["text"] for r in left.collect()) == sorted([text, rows[2][1]])
    shards.write_shards(shards.shards(shards.external_shuffle(df), 2), str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert {"shard", "slot", "shard_", "slot_"} <= set(back.columns)
    assert sorted(map(str, map(tuple, back.select(df.columns).collect()))) == sorted(map(str, rows))
