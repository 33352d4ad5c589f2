"""Whitening, spelling variants, SentencePiece: numpy's solver, brute force, the library itself."""

import hashlib
import itertools
import math
import random
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import __spark_entry__ as E
from cartpulse.llm import pieces, spelling, whitening
from cartpulse.llm.common import table

SF = "/root/testdata/sf0.001"


# ---------------------------------------------------------------- op11

def brute_whitening(x, k):
    """x: whole numbers, one row a vector."""
    n, d = x.shape
    dev = n * x.astype(object) - x.astype(object).sum(axis=0)
    y = (dev / n).astype(float)
    values, vectors = np.linalg.eigh(y.T @ y / n)
    values, vectors = values[::-1][:k], vectors[:, ::-1][:, :k]
    return (dev ** 2).sum(axis=1).tolist(), values / np.trace(y.T @ y / n), y @ vectors / np.sqrt(values)


def test_op11_against_numpy(spark):
    rows = E.queries()["op11_whitening"](spark, SF).collect()
    t = table(spark, SF, "embeddings").orderBy("vec_id").collect()
    x = np.floor(64 * np.array([r.embedding for r in t], float)).astype(np.int64) + 1_000_000
    deviation, explained, whitened = brute_whitening(x, 32)
    by = {(r.vec_id, r.component): r for r in rows}
    assert len(by) == len(rows) == 32 * len(t)
    got = np.array([[by[r.vec_id, c + 1].whitened for c in range(32)] for r in t])
    sign = np.sign((got * whitened).sum(axis=0))
    np.testing.assert_allclose(got * sign, whitened, atol=1e-8)
    for r, dev in zip(t, deviation):
        assert by[r.vec_id, 1].deviation == dev and by[r.vec_id, 7].n == len(t)
    np.testing.assert_allclose([by[t[0].vec_id, c + 1].explained for c in range(32)], explained, rtol=1e-9)
    assert len({r.identity_error for r in rows}) == 1 and rows[0].identity_error < 1e-9


@pytest.mark.parametrize("d, seed", [(1, 0), (2, 1), (3, 2), (17, 3), (40, 4)])
def test_components_of_matrices(d, seed):
    rnd = np.random.default_rng(seed)
    q = np.linalg.qr(rnd.standard_normal((d, d)))[0]
    spectra = [rnd.random(d), np.ones(d), np.r_[np.ones(d // 2), rnd.random(d - d // 2)], np.r_[np.zeros(d - 1), 5.0], np.zeros(d),
               1 + 1e-12 * rnd.random(d), 10.0 ** -np.arange(d)]
    for values in spectra:
        for basis in (q, np.eye(d)):
            m = basis @ np.diag(values) @ basis.T
            m = (m + m.T) / 2
            k = min(d, 9)
            e, v = whitening.leading_components(m, k)
            want = np.linalg.eigvalsh(m)[::-1][:k]
            scale = max(1e-300, np.abs(values).max())
            np.testing.assert_allclose(e, want, atol=1e-13 * scale * d)
            np.testing.assert_allclose(v @ v.T, np.eye(k), atol=1e-12)
            np.testing.assert_allclose(m @ v.T, v.T * e, atol=1e-12 * scale * d)


def test_sturm_counts():
    rnd = np.random.default_rng(5)
    diag, off = rnd.standard_normal(30), rnd.standard_normal(29)
    off[[4, 11]] = 0
    values = np.linalg.eigvalsh(np.diag(diag) + np.diag(off, 1) + np.diag(off, -1))
    at = np.linspace(-4, 4, 81)
    assert whitening.count_below(diag, off, at).tolist() == [(values < a).sum() for a in at]


ODD_VECTORS = [(1, [0.5, 1.0, -2.0]), (2, None), (3, []), (4, [1.0, None, 2.0]), (5, [float("nan"), 0.0, 0.0]), (6, [float("inf"), 0.0, 0.0]),
               (7, [1.0, 2.0]), (8, [0.25, -1.5, 3.0]), (8, [0.25, -1.5, 3.0]), (None, [9.0, 0.0, 1.0]), (9, [1e300, 0.0, 0.0]), (10, [4.0, 4.0, 4.0])]


def test_whiten_odd_rows(spark):
    rows = spark.createDataFrame(ODD_VECTORS, "vec_id long, embedding array<double>").withColumn("n", F.lit("x")).withColumn("a.b", F.lit(1)).withColumn("vec", F.lit(2))
    got = whitening.per_component(whitening.whiten(rows)).collect()
    kept = [1, 8, 8, None, 10]
    assert sorted((str(r.vec_id), r.component) for r in got) == sorted((str(i), c) for i in kept for c in (1, 2, 3))
    x = np.array([[math.floor(64 * c) + 1_000_000 for c in v] for i, v in ODD_VECTORS if i in kept and v and len(v) == 3 and i not in (4, 5, 6, 9)])
    deviation, explained, _ = brute_whitening(x, 3)
    assert {r.n for r in got} == {5} and sorted({int(r.deviation) for r in got}) == sorted(set(deviation))
    np.testing.assert_allclose([next(r.explained for r in got if r.component == c) for c in (1, 2, 3)], explained, rtol=1e-9)
    assert got[0].identity_error < 1e-9


def test_whiten_flat_and_empty(spark):
    same = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], "vec_id long, embedding array<float>")
    got = whitening.whiten(same).collect()
    assert [(int(r.deviation), r.whitened, r.explained, r.identity_error) for r in got] == [(0, [None, None], [None, None], None)] * 2
    line = spark.createDataFrame([(i, [float(i), 2.0 * i]) for i in range(5)], "vec_id long, embedding array<float>")
    got = whitening.whiten(line).collect()
    assert all(r.whitened[0] is not None and r.whitened[1] is None for r in got) and got[0].identity_error < 1e-12
    for rows in (same.limit(0), spark.createDataFrame([(1, None)], same.schema)):
        assert whitening.per_component(whitening.whiten(rows)).collect() == []
    with pytest.raises(ValueError):
        whitening.whiten(same, max_dim=1)


def test_deviation_beyond_a_long(spark):
    rows = spark.createDataFrame([(i, [c]) for i, c in enumerate([1e12, -1e12, 3e9])], "vec_id long, embedding array<double>")
    x = [64 * int(c) + 1_000_000 for c in (1e12, -1e12, 3e9)]
    got = {r.vec_id: int(r.deviation) for r in whitening.whiten(rows).collect()}
    assert got == {i: (3 * v - sum(x)) ** 2 for i, v in enumerate(x)} and max(got.values()) > 2**63


# ---------------------------------------------------------------- op12

def near(a, b):
    """One inserted, deleted or replaced letter, by the definition."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute_counts(docs):
    n = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1:]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= 5 and c >= 3}


def brute_variants(docs):
    n = brute_counts(docs)
    by = {}
    for w in n:  # words that agree but for one place, the place left open
        for i in range(len(w) + 1):
            by.setdefault((w[:i], w[i + 1:]), set()).add(w)
            by.setdefault((w[:i], w[i:]), set()).add(w)
    close = {w: set() for w in n}
    for group in by.values():
        for a, b in itertools.combinations(group, 2):
            if near(a, b):
                close[a].add(b)
                close[b].add(a)
    form = {}
    for w, others in close.items():
        best = min(others, key=lambda o: (-n[o], o), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
    rows = set()
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        rows.add((w, form[w], root, n[w], len(close[w]), n[form[w]] if form[w] else None))
    return rows


def test_op12_against_brute_force(spark):
    docs = [tuple(r) for r in table(spark, SF, "documents").select("doc_id", "text").collect()]
    got = [tuple(r) for r in E.queries()["op12_spelling"](spark, SF).collect()]
    want = brute_variants(docs)
    assert len(got) == len(set(got)) and set(got) == want
    assert any(f for _, f, *_ in want) and any(r not in (f, w) for w, f, r, *_ in want)  # forms, and chains of them


@pytest.mark.parametrize("tile", [2, 7, 2048])
def test_near_pairs_against_all_pairs(spark, tile):
    rnd = random.Random(tile)
    words = {"".join(rnd.choice("abÿ") for _ in range(rnd.randint(5, 8))) for _ in range(220)} | {"aaaaa", "aaaaaa", "aaaaaaa"}
    got = [tuple(sorted(r)) for r in spelling.near_pairs(spark.createDataFrame([(w,) for w in sorted(words)], "word string"), tile).collect()]
    assert len(got) == len(set(got))
    assert set(got) == {tuple(sorted(p)) for p in itertools.combinations(words, 2) if near(*p)}


@given(st.text("abé", max_size=6), st.text("abé", max_size=6))
@settings(max_examples=300, deadline=None)
def test_one_edit(a, b):
    assert spelling.one_edit(a, b) == near(a, b)


def test_spelling_odd_rows(spark):
    docs = [(1, None), (2, ""), (3, "Hello hello, HELLO helo"), (3, "Hello hello, HELLO helo"), (None, "hallo hallo hallo école École ÉCOLE ecole"),
            (5, "\U0001F600wordy漢wordy×wordÿ " * 5), (6, "stone " * 40_000 + "stone " * 3), (7, "hellos " * 3), (8, "abcde" * 3000 + " ")]
    rows = spark.createDataFrame(docs, "doc_id long, text string").withColumn("word", F.lit(1)).withColumn("n", F.lit(2)).withColumn("a.b", F.lit(3))
    got = {tuple(r) for r in spelling.spelling_variants(rows).select("word", "form", "root", "n", "n_near", "form_n").collect()}
    assert got == brute_variants(docs) and ("hellos", "hello", "hello", 3, 1, 6) in got
    assert spelling.spelling_variants(rows.limit(0)).collect() == []
    assert spelling.spelling_variants(rows.filter("doc_id < 3")).collect() == []
    with pytest.raises(ValueError):
        spelling.spelling_variants(rows, ratio=1)


def test_roots_of_long_chains(spark):
    links = [(f"w{i:03}", f"w{i + 1:03}") for i in range(37)] + [("x", "w010"), ("y", "x")]
    got = dict(tuple(r) for r in spelling.roots(spark.createDataFrame(links, "word string, form string")).collect())
    assert got == {w: "w037" for w, _ in links}


# ---------------------------------------------------------------- op13

MODEL = public_tokenizers.path(pieces.VOCABULARY)
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=MODEL)
ENCODER = pieces.Encoder(MODEL)


def library_ids(text):
    return np.array(LIBRARY.encode(text or "", add_bos=True, add_eos=True), "<u4").tobytes()


@given(st.lists(st.one_of(st.none(), st.text(max_size=120), st.text(" \n\t▁aeinrt<s>/0x漢字é😀", max_size=120)), max_size=8))
@settings(max_examples=300, deadline=None)
def test_encoding_is_the_librarys(texts):
    assert ENCODER.encode(pa.array(texts, pa.string()), "words") == [library_ids(t) for t in texts]


@given(st.text("▁ aeinrthé\n漢😀", min_size=1, max_size=pieces.LANE))
@settings(max_examples=300, deadline=None)
def test_columns_and_heap_agree(word):
    assert ENCODER.columns([word, word[::-1]]) == [ENCODER.heap(word), ENCODER.heap(word[::-1])]


def test_long_words_and_cache_generations(monkeypatch):
    monkeypatch.setattr(pieces, "CACHE_WORDS", 5)
    own, rnd = pieces.Encoder(MODEL), random.Random(3)
    texts = ["in" * 5000, " " * 300, "漢字" * 500, "abcdefghij" * 40 + "\n\n" + "the" * 90, "a  b", " edge ", "<0x0A></s><s>", "\x00"]
    texts += [" ".join(rnd.choice(["the", "cat", "mat", "on", "sat", "dog", "ran"]) for _ in range(rnd.randint(0, 9))) for _ in range(40)]
    for i in range(0, len(texts), 3):
        assert own.encode(pa.array(texts[i:i + 3]), "words") == [library_ids(t) for t in texts[i:i + 3]]


def test_a_difference_is_an_error():
    own = pieces.Encoder(MODEL)
    own.bytes = own.bytes[::-1].copy()
    with pytest.raises(ValueError):
        own.encode(pa.array(["漢字 \x01"]), "words")
    with pytest.raises(ValueError):
        own.encode(pa.array(["漢字 \x01"]), "texts")


def test_op13_against_the_library(spark):
    rows = {r.doc_id: r for r in E.queries()["op13_pieces"](spark, SF).collect()}
    docs = table(spark, SF, "documents").select("doc_id", "text").collect()
    assert len(rows) == len(docs)
    for d in docs:
        ids, r = library_ids(d.text), rows[d.doc_id]
        assert (r.n_tokens, r.ids_sha256) == (len(ids) // 4, hashlib.sha256(ids).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(LIBRARY.decode(np.frombuffer(ids, "<u4").tolist()).encode()).hexdigest()


def test_pieces_odd_rows(spark):
    docs = [(1, None), (2, ""), (3, "a b"), (3, "a b"), (None, "漢字 \n x"), (4, "long word " * 60_000 + "x" * 50_000)]
    rows = spark.createDataFrame(docs, "doc_id long, text string").withColumn("ids", F.lit(1)).withColumn("decoded", F.lit(2)).withColumn("a.b", F.lit(3))
    coded = pieces.encode_pieces(rows, check="texts", decode=True)
    got = [(r.doc_id, bytes(r.ids), r.decoded) for r in coded.collect()]
    assert sorted(got, key=str) == sorted([(d, library_ids(t), t or "") for d, t in docs], key=str)
    again = pieces.decode_pieces(coded.drop("decoded").withColumn("my col", F.lit(1)))
    assert {(r.doc_id, r.decoded) for r in again.collect()} == {(d, t or "") for d, t in docs}
    few = coded.filter("doc_id < 4").select("doc_id", pieces.unpacked("ids").alias("ids")).collect()
    assert {(r.doc_id, tuple(r.ids)) for r in few} == {(d, tuple(np.frombuffer(library_ids(t), "<u4").tolist())) for d, t in docs if d and d < 4}
    assert pieces.encode_pieces(rows.limit(0)).collect() == []
    with pytest.raises(ValueError):
        pieces.encode_pieces(rows, check="all")
