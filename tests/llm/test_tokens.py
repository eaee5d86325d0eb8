"""BPE, token counts and packing against the libraries' own results."""

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from arearisk.llm import bpe, packing, tokencount

WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
PIECE = public_tokenizers.path("piece_bpe_32k.model")


def library(path):
    from tokenizers import Tokenizer
    return Tokenizer.from_file(path)


def same_ids(path, text):
    want = library_of(path).encode(text, add_special_tokens=False).ids
    got = np.frombuffer(bpe.encoder(path).encode([text])[0], np.int32)
    assert got.tolist() == want
    assert bpe.encoder(path).decode(got) == library_of(path).decode(want, skip_special_tokens=False)


_libraries = {}


def library_of(path):
    return _libraries.setdefault(path, library(path))


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.sampled_from("abAB 's<|endoftx>\n\t\x1ćéΣ　’日한1￿"), max_size=40))
@pytest.mark.parametrize("path", [WORD, BYTE])
def test_ids_are_the_librarys(path, text):
    same_ids(path, text)


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab the▁ \n<s>é日￾"), max_size=40))
def test_counts_are_the_librarys(text):
    import sentencepiece
    assert tokencount.counter(PIECE).count([text]) == [len(sentencepiece.SentencePieceProcessor(model_file=PIECE).encode(text))]


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_merges_only_lead_to_later_ones(path):
    """All occurrences of a pair may merge at once, as no merge makes a pair of a lower rank."""
    rules = bpe.encoder(path).rules.rules
    first = {}
    for rank, (a, b, _) in enumerate(rules):
        first.setdefault(a, rank)
        first.setdefault(b, rank)
    assert all(first.get(made, len(rules)) > rank for rank, (_, _, made) in enumerate(rules))


@pytest.mark.parametrize("table", ["odd", "docs"])
def test_encode_and_decode(table, request):
    df = request.getfixturevalue(table)
    texts = sorted((r["doc_id"] or -1, r["text"] or "") for r in df.collect())
    done = bpe.round_trip(df, WORD)
    own = library_of(WORD)
    want = [(i, own.encode(t, add_special_tokens=False).ids) for i, t in texts]
    assert sorted((r["doc_id"] or -1, list(r["ids"])) for r in done.collect()) == sorted(want)
    back = bpe.decode(bpe.encode(df, WORD), WORD)
    assert sorted((r["doc_id"] or -1, r["text"]) for r in back.collect()) == sorted((i, own.decode(x, skip_special_tokens=False)) for i, x in want)


def test_nothing_comes_of_nothing(none):
    assert bpe.round_trip(none, WORD).count() == 0
    assert tokencount.count_tokens(none, PIECE).count() == 0
    assert packing.pack_documents(none, BYTE).count() == 0


@pytest.mark.parametrize("table", ["odd", "docs"])
def test_token_counts(table, request):
    import sentencepiece
    own = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    df = request.getfixturevalue(table)
    want = sorted((r["doc_id"] or -1, len((r["text"] or "").encode()), len(own.encode(r["text"] or ""))) for r in df.collect())
    got = tokencount.count_tokens(df, PIECE).collect()
    assert sorted((r["doc_id"] or -1, r["n_bytes"], r["n_tokens"]) for r in got) == want
    assert all(r["over_limit"] == (r["n_tokens"] > 4096) for r in got)


@pytest.mark.parametrize("table", ["odd", "docs"])
def test_packing_holds_every_id_once(table, request):
    df = request.getfixturevalue(table)
    own = library_of(BYTE)
    want = sorted((r["doc_id"] or -1, tuple(own.encode(r["text"] or "", add_special_tokens=False).ids) + (1,)) for r in df.collect())
    pieces = packing.pack_documents(df, BYTE).withColumn("crc", F.crc32("ids")).collect()
    sequences, documents = defaultdict(list), defaultdict(list)
    for p in pieces:
        ids = np.frombuffer(p["ids"], np.uint32)
        assert p["length"] == len(ids) > 0 and p["crc"] == zlib.crc32(ids.tobytes())
        sequences[p["sequence_id"]].append((p["offset"], p["length"], p["loss_tokens"]))
        documents[p["doc_id"] or -1].append((p["start"], p["doc_tokens"], tuple(ids.tolist())))
    for members in sequences.values():
        members.sort()
        assert [m[0] for m in members] == [sum(x[1] for x in members[:i]) for i in range(len(members))]
        assert sum(m[1] for m in members) <= 2048 and len(members) <= 64 and sum(m[2] for m in members) <= 2048
    tokens = sum(len(ids) for _, ids in want)
    assert sum(len(x[2]) for d in documents.values() for x in d) == tokens
    single = {i: ids for i, ids in want if sum(j == i for j, _ in want) == 1}
    for i, ids in single.items():
        assert tuple(x for _, _, part in sorted(documents[i]) for x in part) == ids


def test_padding_is_little(docs):
    pieces = packing.pack_documents(docs, BYTE)
    row = pieces.agg(F.sum("length").alias("n"), F.countDistinct("sequence_id").alias("s")).first()
    assert row["n"] > 0.98 * 2048 * row["s"]


def test_empty_documents_fill_sequences(spark):
    """No limit on segments leaves a sequence of short documents padded; mixed with longer ones they fill the gaps."""
    empty = spark.range(5000).select(F.col("id").alias("doc_id"), F.lit(None).cast("string").alias("text")).coalesce(1)
    found = packing.pack_documents(empty, BYTE).groupBy("sequence_id").count().collect()
    assert sorted(r["count"] for r in found) == [5000 - 2 * 2048, 2048, 2048]
    texts = F.when(F.col("doc_id") % 9 == 0, F.repeat(F.lit("some words "), F.col("doc_id").cast("int"))).alias("text")
    found = packing.pack_documents(empty.select("doc_id", texts), BYTE).groupBy("sequence_id").agg(F.sum("length").alias("n")).collect()
    assert sum(r["n"] for r in found) > 0.99 * 2048 * len(found)


def test_words_are_encoded_once():
    """Also where the memory of words was cleared in between; special tokens stay known."""
    own, texts = bpe.Encoder(BYTE), ["Some words, some words. <|endoftext|>some “words”…\n", "", "Some other words\x1f x"]
    asked = []
    learn = own.learn
    own.learn = lambda fresh: (asked.extend(fresh), learn(fresh))
    want = [own.library.encode(t, add_special_tokens=False).ids for t in texts]
    assert [np.frombuffer(x, np.int32).tolist() for x in own.encode(texts)] == want
    assert len(asked) == len(set(asked)) and "<|endoftext|>" not in asked
    own.encode(texts)
    assert len(asked) == len(set(asked))
    own.forget()
    own.forget()
    assert [np.frombuffer(x, np.int32).tolist() for x in own.encode(texts)] == want


def test_all_three_limits_bind(spark):
    rows = [(i, [7] * n, loss) for i, (n, loss) in enumerate([(100, 90), (60, 5), (50, 50), (30, 0), (30, None), (1, 1), (90, 2), (0, 0)])]
    df = spark.createDataFrame(rows, "doc_id long, ids array<int>, loss_tokens long").coalesce(1)
    bins = defaultdict(list)
    for p in packing.pack_examples(df, packing.Limits(100, 2, 90)).collect():
        assert p["start"] == 0 and p["length"] == p["doc_tokens"]
        bins[p["sequence_id"]].append((p["length"], p["loss_tokens"]))
    assert sorted(x for b in bins.values() for x in b) == sorted((len(i), n or 0) for _, i, n in rows if i)
    for b in bins.values():
        assert sum(n for n, _ in b) <= 100 and len(b) <= 2 and sum(x for _, x in b) <= 90
    with pytest.raises(Exception, match="over the limits"):
        packing.pack_examples(df, packing.Limits(80, 2, 80)).collect()


@given(st.lists(st.tuples(st.integers(1, 300), st.integers(0, 300)), max_size=40), st.integers(1, 5))
def test_bins_with_cuts(items, segments):
    tokens = np.array([n for n, _ in items], np.int64)
    loss = np.array([min(n, x) for n, x in items], np.int64)
    limits = packing.Limits(100, segments, 60)
    seen = defaultdict(list)
    for b in packing.pack_block(tokens, loss, limits):
        assert sum(x[2] for x in b) <= 100 and len(b) <= segments and sum(x[3] for x in b) <= 60
        for row, start, n, bearing in b:
            seen[row].append((start, n, bearing))
    for row, parts in seen.items():
        parts.sort()
        assert [s for s, _, _ in parts] == [sum(p[1] for p in parts[:k]) for k in range(len(parts))]
        assert sum(p[1] for p in parts) == tokens[row] and sum(p[2] for p in parts) == loss[row]
    assert len(seen) == len(items)
