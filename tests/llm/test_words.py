"""Language identification, spelling variants and whitening against brute force, numpy and held-out labels."""

import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arearisk.llm import language, spelling, whitening

LANG_SCHEMA = "doc_id long, text string, lang string, lang_pred string, score string, machine int, place long"


def test_languages_of_the_held_out_fold(docs):
    got = language.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(got) == docs.count()
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1
    held = [r for r in got if r["held_out"]]
    assert sum(r["lang"] == r["lang_pred"] for r in held) >= 0.97 * len(held)


def test_families_come_first(spark):
    """Related languages share a family; a third family and an unlisted language are told apart too."""
    words = {"en": "the weather here is that", "de": "das wetter ist nicht hier", "fr": "le temps est avec nous",
             "es": "el tiempo que para los", "qq": "zuxu wxyz qzzq xxyx", "pl": "szcz przy jest nie dla"}
    rng, rows = np.random.default_rng(3), []
    for i in range(600):
        lang = sorted(words)[i % 6]
        rows.append((i, " ".join(rng.choice(words[lang].split(), 1 + i % 9)), lang, "x", None, 0, 0))
    rows += [(9001, None, "en", None, None, 0, 0), (9002, "123 --", "en", None, None, 0, 0), (9003, "", None, None, None, 0, 0),
             (None, "the weather " * 60_000, None, None, None, 0, 0), (9004, "das wetter", None, None, None, 0, 0),
             (9004, "das wetter", None, None, None, 0, 0)]
    got = language.identify(spark.createDataFrame(rows, LANG_SCHEMA).repartition(3)).collect()
    assert len(got) == len(rows)
    by = defaultdict(list)
    for r in got:
        by[r["doc_id"]].append(r)
    held = [i for i in range(600) if zlib.crc32(str(i).encode()) % 4 == 2]
    assert sum(by[i][0]["lang_pred"] == rows[i][2] for i in held) >= 0.95 * len(held)
    assert [by[i][0]["lang_pred"] for i in (9001, 9002, 9003)] == ["und"] * 3 and by[9001][0]["score"] == 0
    assert by[None][0]["lang_pred"] == "en" and [r["lang_pred"] for r in by[9004]] == ["de", "de"]


def test_languages_without_a_choice(spark, none):
    assert language.identify(none.withColumn("lang", F.lit("en"))).count() == 0
    alone = spark.createDataFrame([(i, "some words", "en") for i in range(9)] + [(50, "?", None)], "doc_id long, text string, lang string")
    assert Counter(r["lang_pred"] for r in language.identify(alone).collect()) == {"en": 9, "und": 1}
    unlabelled = alone.withColumn("lang", F.lit(None).cast("string"))
    assert {r["lang_pred"] for r in language.identify(unlabelled).collect()} == {"und"}


def test_runs_do_not_cross_texts():
    texts = ["Ab  c", "", "é9x", "   "]
    raw = [t.encode() for t in texts]
    bound = np.cumsum([0] + [len(r) for r in raw])
    together = list(language.runs_of(np.frombuffer(b"".join(raw), np.uint8), bound))
    for i, r in enumerate(raw):
        alone = list(language.runs_of(np.frombuffer(r, np.uint8), np.array([0, len(r)])))
        for (h, at), (own, _) in zip(together, alone):
            assert h[at[i]:at[i + 1]].tolist() == own.tolist()


def one_edit(a, b):
    """Whether exactly one inserted, deleted or replaced code point separates two words."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[i + 1:] == b[i + 1:] if len(a) == len(b) else a[i:] == b[i + 1:]


@settings(max_examples=200, deadline=None)
@given(st.sets(st.text("abé", min_size=1, max_size=7), max_size=40))
def test_composition_accepts_all_pairs_once(words):
    machine = spelling.Composition(spelling.Acceptor(sorted(words)))
    found = Counter(frozenset(p) for p in machine.pairs())
    assert found == Counter(frozenset((a, b)) for a in words for b in words if a < b and one_edit(a, b))


@settings(max_examples=100, deadline=None)
@given(st.sets(st.text("ab", min_size=1, max_size=6), min_size=1, max_size=40))
def test_acceptor_is_minimal(words):
    own = spelling.Acceptor(sorted(words))
    languages = set()
    for q in range(len(own.arcs)):
        read, waiting = set(), [(q, "")]
        while waiting:
            s, path = waiting.pop()
            if own.final[s]:
                read.add(path)
            waiting += [(to, path + c) for c, to in own.arcs[s].items()]
        if q == 0:
            assert read == words
        languages.add(frozenset(read))
    assert len(languages) == len(own.arcs)


def test_very_long_words_take_no_recursion():
    words = ["a" * 5000, "a" * 5001, "b" + "a" * 5000, "a" * 2500 + "c" + "a" * 2500]
    found = {frozenset(p) for p in spelling.Composition(spelling.Acceptor(sorted(words))).pairs()}
    assert found == {frozenset((a, b)) for a in words for b in words if one_edit(a, b)}


def counted(rows):
    out = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % 199 == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            out[w] += 1
    return {w: n for w, n in out.items() if len(w) >= 6 and n >= 5}


@pytest.mark.parametrize("most", [20_000, 3])
@pytest.mark.parametrize("table", ["odd", "docs"])
def test_variants_against_brute_force(table, most, request):
    """Also where nearly every beginning is cut."""
    df = request.getfixturevalue(table)
    held = counted([(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()])
    near = defaultdict(set)
    for w in held:
        for i in range(len(w)):
            for c in {x for v in held for x in v} | {""}:
                v = w[:i] + c + w[i + 1:]
                if v != w and v in held:
                    near[w].add(v)
                    near[v].add(w)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-held[v], v))
        if held[best] >= 5 * held[w]:
            form[w] = best
    expected = {}
    for w, n in held.items():
        root = w
        while root in form:
            root = form[root]
        expected[w] = (form.get(w), root, n, len(near[w]), held[form[w]] if w in form else None)
    got = spelling.spelling_variants(df, most=most).collect()
    assert len(got) == len(held)
    assert {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in got} == expected


def test_forms_chain_to_their_root(spark, none):
    """Each word is near the next only; ties go to the smaller; equal runs are cut anywhere."""
    chain = [("abcdef", 5), ("abcdeg", 25), ("abcdhg", 125), ("abcihg", 625), ("abjihg", 3125), ("akjihg", 15625),
             ("zzzzzz", 5), ("zzzzzzz", 25), ("zzzzzzy", 25), ("qqqqqqqq", 7)]
    for most in (100, 1):
        got = {r["word"]: r for r in spelling.spelling_forms(spark.createDataFrame(chain, "word string, n long"), most=most).collect()}
        assert {got[w]["root"] for w, _ in chain[:6]} == {"akjihg"} and got["akjihg"]["form"] is None
        assert got["zzzzzz"]["form"] == "zzzzzzy" and got["zzzzzz"]["n_near"] == 2 and got["zzzzzzz"]["n_near"] == 2
        assert got["qqqqqqqq"]["n_near"] == 0 and got["qqqqqqqq"]["root"] == "qqqqqqqq"
    assert spelling.spelling_variants(none).count() == 0
    with pytest.raises(ValueError):
        spelling.spelling_variants(none, least_letters=5)


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 6), st.integers(0, 2 ** 32))
def test_polynomial_and_roots(d, seed):
    rng = np.random.default_rng(seed)
    half = rng.integers(-50, 50, (d, rng.integers(1, 9)))
    if d > 2:
        half[1] = half[0]
    matrix = half @ half.T
    p = 2 ** 31 - 1
    # Leibniz by expansion along a row, on polynomials.
    def determinant(rows):
        if not rows:
            return [1]
        out = [0] * (len(rows) + 1)
        for j, entry in enumerate(rows[0]):
            minor = determinant([r[:j] + r[j + 1:] for r in rows[1:]])
            for a, x in enumerate(entry):
                for b, y in enumerate(minor):
                    out[a + b] += (-1) ** j * x * y
        return out

    plain = determinant([[[-int(v), int(i == j)] for j, v in enumerate(r)] for i, r in enumerate(matrix)])
    assert whitening.polynomial_modulo(matrix % p, p) == [c % p for c in plain]
    expected = np.linalg.eigvalsh(matrix)[::-1]
    if expected[0] > 0:
        found = [float(r) for r, m in whitening.Roots(plain).largest(d, 60) for _ in range(m)]
        assert len(found) <= np.linalg.matrix_rank(matrix) + 1
        assert np.allclose(found, expected[:len(found)], rtol=1e-6, atol=1e-6 * expected[0])


def test_double_roots_keep_their_space():
    matrix = np.diag([9, 4, 4, 1])
    roots = whitening.Roots([144 * 1, -(9 * 16 + 9 * 4 * 2 + 16), 9 * 8 + 16 + 9 + 8, -18, 1]).largest(4)
    assert [(round(float(r), 20), m) for r, m in roots] == [(9, 1), (4, 2), (1, 1)]
    both = whitening.null_space(matrix.tolist(), roots[1][0], 2)
    assert np.allclose(both.T @ both, np.eye(2)) and np.allclose(both[[0, 3]], 0)
    assert whitening.null_space(matrix.tolist(), Fraction(9), 1)[0, 0] ** 2 == pytest.approx(1)


VECTORS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
                        T.StructField("vector", T.StringType()), T.StructField("n", T.LongType()), T.StructField("component", T.LongType())])


def check_whitening(got, ids, vectors, components=32):
    """Against numpy's eigenvectors; the sign of a component is free."""
    x = np.floor(64 * np.asarray(vectors, np.float64)) + 1_000_000
    n, mean = len(x), x.mean(axis=0)
    cov = (x - mean).T @ (x - mean) / n
    e, v = np.linalg.eigh(cov)
    e, v = e[::-1], v[:, ::-1]
    k = min(components, int((e > 1e-9 * e[0]).sum()))
    z = (x - mean) @ v[:, :k] / np.sqrt(e[:k])
    exact = [sum((n * int(a) - int(s)) ** 2 for a, s in zip(r, x.sum(axis=0))) for r in x]
    assert len(got) == n * k
    rows = defaultdict(list)
    for r in got:
        assert r["n"] == n and abs(r["identity_error"]) < 1e-9 and r["explained"] == pytest.approx(e[r["component"] - 1] / e.sum(), rel=1e-9)
        rows[r["vec_id"], r["component"]].append(r)
    for c in range(1, k + 1):
        ours = np.array([rows[i, c][0]["whitened"] for i in ids])
        sign = np.sign(ours @ z[:, c - 1])
        assert np.abs(ours - sign * z[:, c - 1]).max() < 1e-7
    for i, far in zip(ids, exact):
        assert int(rows[i, 1][0]["deviation"]) == far


def test_whitened_embeddings(spark, sf):
    df = spark.read.parquet(f"{sf}/embeddings.parquet")
    held = df.select("vec_id", "embedding").collect()
    check_whitening(whitening.whiten(df).collect(), [r[0] for r in held], [r[1] for r in held])


def test_whitening_of_odd_rows(spark):
    rng = np.random.default_rng(5)
    good = [(i, [float(v) for v in rng.normal(0, 50, 3)] + [0.0]) for i in range(40)]
    good += [(100, good[0][1]), (101, [3e6, -4e6, 1.0, 0.0])]
    bad = [(200, None), (201, [1.0, None, 2.0, 3.0]), (202, [float("nan")] * 4), (203, [float("inf"), 0.0, 0.0, 0.0]), (204, []),
           (205, [1.0] * 5)]
    df = spark.createDataFrame([(i, v, "clash", 1, 2) for i, v in good + bad], VECTORS).repartition(3)
    check_whitening(whitening.whiten(df).collect(), [i for i, _ in good], [np.float32(v) for _, v in good])
    alike = spark.createDataFrame([(i, [1.0, 2.0], None, None, None) for i in range(5)], VECTORS)
    assert whitening.whiten(alike).count() == 0
    assert whitening.whiten(spark.createDataFrame([], VECTORS)).count() == 0


@given(st.integers(1, 4), st.integers(1, 30), st.booleans())
@settings(max_examples=30, deadline=None)
def test_exact_cross_products(d, n, wide):
    x = np.random.default_rng(n).integers(-(1 << 40 if wide else 1000), 1 << 40 if wide else 1000, (n, d))
    plain = [[sum(int(r[i]) * int(r[j]) for r in x) for j in range(d)] for i in range(d)]
    assert whitening.cross_products(x).tolist() == plain
