"""SimHash, token files, WARC, sharding, packing: brute force and exact round trips."""

import io
import itertools
import math
import os
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as E
from cartpulse.llm import files, packing, range_coder, sharding, simhash, token_files, warc
from cartpulse.llm.common import qualified, scratch_uri, table
from cartpulse.llm.components import components

SF = "/root/testdata/sf0.001"
ODD = [(1, None), (2, ""), (3, "a b c d"), (4, "a b c d"), (5, " \t\n"), (None, "a b c d"), (3, "a b c d"), (6, "word " * 30_000), (None, None)]


def frame(spark, rows, extra=""):
    return spark.createDataFrame(rows, "doc_id long, text string" + extra)


def brute_fingerprint(text, k=3):
    words = [w for w in "".join(c.lower() if c.isascii() else c for c in text or "").translate(dict.fromkeys(range(9, 14), " ")).split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps, bits=3):
    parent = {f: f for f in fps}

    def find(f):
        while parent[f] != f:
            f = parent[f]
        return f

    for a, b in itertools.combinations(parent, 2):
        if (a ^ b).bit_count() <= bits:
            parent[find(a)] = find(b)
    return {f: find(f) for f in fps}


@given(st.text(alphabet=" \t\n\x0b\x1cAbcé漢.K", max_size=60))
@settings(max_examples=200, deadline=None)
def test_fingerprint(text):
    assert simhash.fingerprint(text.encode()) == brute_fingerprint(text)


def test_op2_against_brute_force(spark):
    rows = E.queries()["op2_simhash"](spark, SF).collect()
    texts = {r.doc_id: r.text for r in table(spark, SF, "documents").select("doc_id", "text").collect()}
    fps = {d: brute_fingerprint(t) for d, t in texts.items()}
    root, least = brute_components(set(fps.values())), {}
    for d, f in fps.items():
        least[root[f]] = min(d, least.get(root[f], d))
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in rows} == {d: (f"{f:016x}", least[root[f]]) for d, f in fps.items()}
    assert len(rows) == len(texts)


@pytest.mark.parametrize("bits", [0, 1, 2, 3])
def test_links_connect_what_all_pairs_connect(spark, bits):
    rnd = random.Random(bits)
    fps = set()
    for _ in range(12):  # chains and clusters a few bits apart, within and across the halves
        f = rnd.getrandbits(64)
        for _ in range(25):
            fps.add(f)
            for b in rnd.sample(range(64), rnd.randint(1, 4)):
                f ^= 1 << b
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    found = components(simhash.links(simhash.screen(spark.createDataFrame([(f,) for f in signed], "fp long")), bits)).collect()
    got = defaultdict(set)
    for r in found:
        got[r.root].add(r.u & (1 << 64) - 1)
    want = defaultdict(set)
    for f, r in brute_components(fps, bits).items():
        want[r].add(f)
    assert sorted(map(sorted, got.values())) == sorted(sorted(c) for c in want.values() if len(c) > 1)


def test_components_of_a_long_chain(spark):
    rnd = random.Random(1)
    names = rnd.sample(range(10_000), 300)
    edges = spark.createDataFrame(list(zip(names, names[1:])) + [(7, 7), (None, 3)], "u long, v long")
    found = components(edges).collect()
    assert {r.root for r in found} == {min(names)} and {r.u for r in found} == set(names)


def test_simhash_odd_rows(spark):
    rows = simhash.near_duplicates(frame(spark, ODD)).collect()
    by = defaultdict(set)
    for r in rows:
        by[r.fp].add(r.component_id)
    assert len(rows) == len(ODD) and by[0] == {1} and by[simhash.fingerprint(b"a b c d") - (0 if simhash.fingerprint(b"a b c d") < 1 << 63 else 1 << 64)] == {3}
    assert simhash.near_duplicates(frame(spark, [])).count() == 0


def test_dedup_of_an_id_with_different_texts(spark):
    """The second row of id 5 is the one that names its component; the first is a copy of 2."""
    a, b = "one text that is here twice", "quite other words stand in this one"
    assert sorted(map(tuple, simhash.dedup(frame(spark, [(2, a), (5, a), (5, b)])).collect())) == [(2, a), (5, b)]
    assert sorted(map(tuple, simhash.dedup(frame(spark, [(2, a), (None, a), (5, b)])).collect())) == [(2, a), (5, b)]


def test_dedup_keeps_one_row_and_all_columns(spark):
    rows = [(d, t, "x") for d, t in ODD]
    kept = simhash.dedup(frame(spark, rows, ", fp string")).collect()
    assert sorted(r.doc_id for r in kept) == [1, 3, 6] and kept[0].__fields__ == ["doc_id", "text", "fp"]
    only_null = simhash.dedup(frame(spark, [(None, "q r s"), (None, "q r s")])).collect()
    assert len(only_null) == 1
    assert simhash.dedup(frame(spark, [])).columns == ["doc_id", "text"]


# ------------------------------------------------------------------ token files

@given(st.lists(st.integers(0, 70_000), min_size=1, max_size=400), st.integers(1, 50))
@settings(max_examples=60, deadline=None)
def test_range_coder_round_trip(ids, block):
    raw = range_coder.encode_group(np.array(ids, np.uint32), block)
    assert range_coder.decode_group(io.BytesIO(raw)).tolist() == ids


def test_range_coder_finds_damage():
    ids = np.random.default_rng(0).integers(0, 500, 9000).astype(np.uint32)
    raw = bytearray(range_coder.encode_group(ids))
    raw[-400] ^= 1
    with pytest.raises(ValueError):
        range_coder.decode_group(io.BytesIO(bytes(raw)))


def test_range_coder_learns():
    ids = np.tile(np.arange(50, dtype=np.uint32), 400)
    assert len(range_coder.encode_group(ids)) < len(ids) // 4


def test_order_0_adapts_inside_a_block():
    """Each block draws from eight ids of its own in random order: what the group holds as a whole says little."""
    rng = np.random.default_rng(3)
    ids = np.concatenate([rng.integers(8 * b, 8 * b + 8, 2048) for b in range(40)]).astype(np.uint32)
    assert 8 * len(range_coder.encode_group(ids)) / len(ids) < 4.0  # 3 bits at best, 8.3 by the group's distribution


@pytest.mark.parametrize("cells", [1, 5000, 1 << 25])
def test_one_block_decodes_alone(cells, monkeypatch):
    monkeypatch.setattr(range_coder, "SEEN_CELLS", cells)
    rng = np.random.default_rng(1)
    ids = (rng.zipf(1.3, 9000) % 900).astype(np.uint32)
    raw = range_coder.encode_group(ids, 2000)
    assert (range_coder.decode_group(io.BytesIO(raw)) == ids).all()
    for k in range(5):
        assert (range_coder.read_block(io.BytesIO(raw), k) == ids[k * 2000:(k + 1) * 2000]).all()
    spoiled = bytearray(raw)
    spoiled[-100] ^= 1  # in the last block: the others do not notice
    assert (range_coder.read_block(io.BytesIO(bytes(spoiled)), 0) == ids[:2000]).all()
    with pytest.raises(ValueError):
        range_coder.read_block(io.BytesIO(bytes(spoiled)), 4)
    with pytest.raises(IndexError):
        range_coder.read_block(io.BytesIO(raw), 5)


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def test_pieces_are_the_tokenizer(tokenizer, monkeypatch):
    """All texts at once, in chunks of every size, with a cache that starts anew: always the library's ids."""
    rnd = random.Random(5)
    pool = list("aZ9'stredvllm.,!<>|éÉßÿ×÷Ωǅİ\u0301\u00a0\u2028\x1c\x85漢🙂½ªµ \t\n\x00") + ["<|endoftext|>", "don't", "WE'RE", "ﬁ", "ẞ", " 'S", "word "]
    texts = ["".join(rnd.choice(pool) for _ in range(rnd.randint(0, 14))) for _ in range(4000)]
    texts += [None, "", " \n ", "a" * 3000, "word, " * 2000, "É×é÷ Þþ<b>x</b> 12:30"]
    want = [tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]
    raw = [None if t is None else t.encode() for t in texts]
    assert [x.tolist() for x in token_files.encoder().encode(raw)] == want
    for chunk, pieces in ((50, 5), (5000, 200)):
        monkeypatch.setattr(token_files, "CHUNK_BYTES", chunk)
        monkeypatch.setattr(token_files, "CACHE_PIECES", pieces)
        assert [x.tolist() for x in token_files.PieceCache(tokenizer).encode(raw)] == want
    assert token_files.PieceCache(tokenizer).encode([]) == []


def test_writer_splits_groups_inside_documents():
    rnd, docs = random.Random(2), []
    for n in (0, 3, 250, 1, 0, 99, 40, 1000, 7):
        docs.append((len(docs) or None, np.array([rnd.randrange(900) for _ in range(n)], np.uint32)))

    class Keep(io.BytesIO):
        def close(self):
            self.raw = self.getvalue()

    out = Keep()
    writer = token_files.TokenWriter(out, group_ids=100)
    for d, ids in docs:
        writer.add(d, ids)
    writer.close()
    assert [(d, ids.tolist()) for d, ids in token_files.read_documents(io.BytesIO(out.raw))] == [(d, ids.tolist()) for d, ids in docs]


def test_op8_against_brute_force(spark, tokenizer):
    rows = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in E.queries()["op8_token_files"](spark, SF).collect()}
    at, want = 0, {}
    for r in sorted(table(spark, SF, "documents").select("doc_id", "text").collect()):
        ids = [*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 2]
        want[r.doc_id] = (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    assert rows == want


def test_another_tokenizer_file_is_given_whole_texts(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    other, rows = Tokenizer.from_file(path), [(1, "Two  Words\n here, HERE's"), (2, None), (3, " lead <|endoftext|> x")]
    got = {r.doc_id: (r.n_tokens, r.ids_crc32) for r in token_files.tokenize(frame(spark, rows), tokenizer_file=path).collect()}
    for d, t in rows:
        ids = [*other.encode(t or "", add_special_tokens=False).ids, 2]
        assert got[d] == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
    assert isinstance(token_files.encoder(), token_files.PieceCache)


def test_files_lie_on_the_file_system_of_the_tables(spark):
    """A folder without scheme is qualified by the default file system; a file system that tasks cannot
    open is an error, never a local folder. Signs of a URI in a folder's name stay part of it."""
    base = scratch_uri(spark, "any#sign?x").removeprefix("file:")
    assert base.startswith("/")
    for out in (warc.write_archives(table(spark, SF, "pages").limit(5), f"{base}/w"), token_files.write_tokens(table(spark, SF, "documents").limit(5), f"{base}/t")):
        paths = [r["path"] for r in out.select("path").collect()]
        assert paths and all(p.startswith(f"file:{base}/") and os.path.exists(p.removeprefix("file:")) for p in paths)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    old = conf.get("fs.defaultFS")
    conf.set("fs.viewfs.mounttable.cartllm.link./shared", f"file:{base}")
    conf.set("fs.defaultFS", "viewfs://cartllm/")
    try:
        assert qualified(spark, "/shared/x") == "viewfs://cartllm/shared/x"
        with pytest.raises(Exception, match="viewfs|Unrecognized"):
            warc.write_archives(table(spark, f"file:{SF}", "pages").limit(5), "/shared/only")
    finally:
        conf.set("fs.defaultFS", old)
    assert not os.path.exists("/shared/only") and not os.path.exists(f"{base}/only")
    with pytest.raises(ValueError):
        files._store("/no/scheme")


def test_token_files_odd_rows(spark):
    rows = token_files.tokenize(frame(spark, ODD, "")).collect()
    assert sorted((r.doc_id or -1, r.n_tokens) for r in rows) == [(-1, 1), (-1, 5), (1, 1), (2, 1), (3, 5), (3, 5), (4, 5), (5, 1), (6, 30_001)]
    assert sorted(r.start for r in rows)[0] == 0 and all(r.doc_id is None for r in rows if r.start < 6)
    assert token_files.tokenize(frame(spark, [])).count() == 0


# ------------------------------------------------------------------ WARC

def page_frame(spark, rows, extra=""):
    return spark.createDataFrame(rows, "page_id long, url string, html string" + extra)


def test_warc_round_trip_and_revisits(spark):
    big = "é" * 600
    odd = [(1, "u", big), (2, None, big), (9, "u\r\nX: y", big), (3, "u", "s"), (4, "u", "s"), (5, "u", None), (6, "u", ""), (None, "u", big), (9, "u", big)]
    rows = warc.archive_pages(page_frame(spark, [(*r, "x") for r in odd], ", payload string")).collect()
    got = Counter((r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in rows)
    assert got == Counter([(1, 1200, "revisit", 9), (2, 1200, "revisit", 9), (9, 1200, "response", None), (9, 1200, "response", None), (None, 1200, "revisit", 9),
                           (3, 1, "response", None), (4, 1, "response", None), (5, 0, "response", None), (6, 0, "response", None)])
    assert warc.archive_pages(page_frame(spark, [])).count() == 0


def test_warc_dictionary_leads_and_records_stand_alone(spark):
    manifest = warc.write_archives(table(spark, SF, "pages"), scratch_uri(spark, "warc-test")).collect()
    raw = open(manifest[0]["path"].replace("file:", ""), "rb").read()
    n = int.from_bytes(raw[4:8], "little")
    assert int.from_bytes(raw[:4], "little") == warc.SKIPPABLE and n > 0
    records = list(warc.read_archive(io.BytesIO(raw)))
    assert records[0][0]["WARC-Type"] == "warcinfo" and len(records) == manifest[0]["records"] + 1
    with pytest.raises(ValueError):
        list(warc.read_archive(io.BytesIO(raw[:-3])))


# ------------------------------------------------------------------ sharding

def brute_capacity(sizes, shards):
    best = [0] + [float("inf")] * len(sizes)
    for _ in range(shards):
        best = [0] + [min(max(best[i], sum(sizes[i:j])) for i in range(j + 1)) for j in range(1, len(sizes) + 1)]
    return best[-1]


@given(st.lists(st.integers(0, 50), min_size=1, max_size=12), st.integers(1, 5))
@settings(max_examples=150, deadline=None)
def test_smallest_capacity(sizes, shards):
    want = brute_capacity(sizes, shards)
    assert sharding.smallest_capacity(np.array(sizes), shards) == want
    cuts = [0, *sharding.cut_points(np.array(sizes), shards), len(sizes)]
    assert len(cuts) == shards + 1 and cuts == sorted(cuts) and max(sum(sizes[a:b]) for a, b in zip(cuts, cuts[1:])) <= want


def test_op10(spark):
    rows = E.queries()["op10_sharding"](spark, SF).collect()
    texts = {r.doc_id: r.text for r in table(spark, SF, "documents").select("doc_id", "text").collect()}
    where, slots, load = {}, defaultdict(list), Counter()
    for r in rows:
        raw = (texts[r.doc_id] or "").encode()
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(raw) + 16, zlib.crc32(raw), "bytes", None)
        assert where.setdefault(texts[r.doc_id], r.shard) == r.shard
        slots[r.shard].append(r.slot)
        load[r.shard] += r["size"]
    assert len(rows) == len(texts) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    groups = Counter()
    for t in texts.values():
        groups[t] += len((t or "").encode()) + 16
    assert max(load.values()) <= sum(load.values()) / 40 + max(groups.values())


def test_sharding_odd_rows(spark):
    rows = sharding.shard_documents(frame(spark, [(*r, 1) for r in ODD], ", shard int"), shards=3).collect()
    assert sorted(r["size"] for r in rows)[:2] == [16, 16] and len(rows) == len(ODD)
    assert len({r.shard for r in rows if r["size"] == 23}) == 1
    assert sharding.shard_documents(frame(spark, [])).count() == 0


# ------------------------------------------------------------------ packing

@given(st.dictionaries(st.integers(1, 60), st.integers(1, 9), min_size=1, max_size=9), st.integers(1, 4))
@settings(max_examples=100, deadline=None)
def test_bounds_minimise_padding(hist, buckets):
    lengths = sorted(hist)
    n = np.array([hist[x] for x in lengths])

    def padding(bounds):
        return sum(hist[x] * (min(b for b in bounds if b >= x) - x) for x in lengths)

    want = min(padding([*c, lengths[-1]]) for k in range(buckets) for c in itertools.combinations(lengths[:-1], k))
    got = packing.bucket_bounds(np.array(lengths), n, n * np.array(lengths), buckets)
    assert len(got) <= buckets and padding(got) == want


def test_op5(spark):
    rows = E.queries()["op5_packing"](spark, SF).collect()
    texts = {r.doc_id: r.text for r in table(spark, SF, "documents").select("doc_id", "text").collect()}
    batches = defaultdict(list)
    for r in rows:
        assert r.n_tokens == len((texts[r.doc_id] or "").encode().split()) + 1 <= r.padded_len
        batches[r.batch].append(r)
    assert len(rows) == len(texts)
    for b in batches.values():
        assert len({x.padded_len for x in b}) == 1 and sorted(x.slot for x in b) == list(range(len(b)))
        assert len(b) == 1 or sum(x.padded_len for x in b) <= 16_384
    top = {r.bucket: r.padded_len for r in rows}
    assert all(min((p for p in top.values() if p >= r.n_tokens)) == r.padded_len for r in rows)


def test_cells_rise_with_the_length(spark):
    rows = spark.range(1, 200_000, 37).select("id", packing.cell_of(F.col("id")).alias("c")).orderBy("id").collect()
    cells = [r.c for r in rows]
    assert cells == sorted(cells) and max(cells) < 512 + 256 * 10


def test_packing_odd_rows(spark):
    rows = packing.pack(frame(spark, [(*r, 1) for r in ODD], ", bucket int"), buckets=2, budget=100).collect()
    assert sorted(r.n_tokens for r in rows) == [1, 1, 1, 1, 5, 5, 5, 5, 30_001]
    empty = packing.pack(frame(spark, []))
    assert empty.count() == 0 and empty.columns == ["doc_id", "n_tokens", "bucket", "padded_len", "batch", "slot"]


def least_padding(hist, buckets):
    """Least total padding by the plain quadratic recurrence over the exact lengths."""
    lengths = sorted(hist)
    best = [0] + [math.inf] * len(lengths)
    for _ in range(buckets):
        best = [0] + [min(best[i] + sum(hist[x] * (lengths[j - 1] - x) for x in lengths[i:j]) for i in range(j)) for j in range(1, len(lengths) + 1)]
    return best[-1]


def test_bounds_are_exact_over_512_tokens(spark):
    """Long lengths a few words apart are told apart: the one of 4007 tokens goes with those of 5000, not with those of 4000."""
    hist = {3: 5, 4000: 200, 4007: 1, 5000: 200, 5007: 1, 6000: 200, 6007: 1}
    rows = packing.pack(frame(spark, list(enumerate("w " * (x - 1) for x, n in hist.items() for _ in range(n)))), buckets=4).collect()
    assert Counter(r.n_tokens for r in rows) == hist
    assert sum(r.padded_len - r.n_tokens for r in rows) == least_padding(hist, 4)


def test_bounds_of_many_long_lengths():
    rnd = np.random.default_rng(5)
    hist = {int(x): int(n) for x, n in zip(rnd.choice(40_000, 70, replace=False) + 500, rnd.integers(1, 4_000, 70))}
    lengths = np.array(sorted(hist))
    n = np.array([hist[x] for x in lengths.tolist()])
    bounds = packing.bucket_bounds(lengths, n, n * lengths, 9)
    assert len(bounds) == 9 and sum(c * (min(b for b in bounds if b >= x) - x) for x, c in hist.items()) == least_padding(hist, 9)
