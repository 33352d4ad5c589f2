"""Benchmark decontamination by a broadcast hash set of test n-grams.

The benchmark's windows (ten words; a shorter item whole) are numbered words:
the vocabulary of the benchmark fits the bounded set, so a document turns into
an array of word numbers in which a word unknown to the benchmark breaks every
window. Rolling hashes of those numbers are looked up in the sorted window
hashes, and every hash hit is verified word by word.

A benchmark of more than ``max_set_words`` words is scanned in blocks: its windows,
made on the executors, are split by window hash, one block's set is broadcast and scanned with, the
documents' findings are written, and the block is released before the next one. So one set is alive at a time,
an item of any length is split, and a larger benchmark costs more scans, not more memory.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartpulse.llm.common import stored

WINDOW = 10
MAX_SET_WORDS = 2_000_000
# bytes of the words: digits, letters lower-cased, everything from 0x80 on; the rest separates
WORD_BYTES = bytes(c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else c + 32 if 0x41 <= c <= 0x5A else 0x20 for c in range(256))
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def tokens(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(WORD_BYTES).split()


def _hashes(ids: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` numbers."""
    n = len(ids) - size + 1
    h = np.zeros(max(0, n), np.uint64)
    for k in range(size if n > 0 else 0):
        h *= MULTIPLIER
        h += ids[k:k + n]
        h ^= h >> np.uint64(29)
    return h


def windows_of(text: bytes | None, window: int = WINDOW) -> set[tuple[bytes, ...]]:
    """Distinct windows of an item's words; the whole item if it is shorter."""
    words = tokens(text)
    size = min(window, len(words))
    return {tuple(words[i:i + size]) for i in range(len(words) - size + 1)} if words else set()


def numbered(found) -> tuple:
    """Windows ``(item, words)`` as a set to scan with: word numbers, windows with their items per length, sorted hashes per length."""
    words: dict[bytes, int] = {}
    windows: dict[int, dict[tuple, set]] = {}
    for item, gram in found:
        ids = tuple(words.setdefault(w, len(words) + 1) for w in gram)
        windows.setdefault(len(ids), {}).setdefault(ids, set()).add(item)
    hashes = {size: np.unique(np.array([_hashes(np.array(w, np.uint64), size)[0] for w in ws], np.uint64)) for size, ws in windows.items()}
    return words, windows, hashes


def window_set(items: list[tuple[str, bytes | None]], window: int = WINDOW) -> tuple:
    """The set of some items' windows."""
    return numbered((item, gram) for item, text in items for gram in windows_of(text, window))


def merge(ranges) -> list[tuple[int, int]]:
    """Sorted, overlapping or touching [start, end) ranges joined."""
    out: list[tuple[int, int]] = []
    for s, e in sorted(ranges):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def scan(text: bytes | None, one: tuple) -> tuple[int, list[tuple[int, int]], set]:
    """Number of words, merged [start, end) word ranges that are hit, items found."""
    words, (numbers, windows, sorted_hashes) = tokens(text), one
    get = numbers.get
    ids = np.fromiter((get(w, 0) for w in words), np.uint64, len(words))
    known, hits, items = np.concatenate(([0], np.cumsum(ids != 0))), [], set()
    for size, hashes in sorted_hashes.items():
        at = np.nonzero(known[size:] - known[:-size] == size)[0]  # runs of known words only
        if not len(at):
            continue
        h = _hashes(ids, size)[at]
        place = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
        for i in at[hashes[place] == h].tolist():
            found = windows[size].get(tuple(ids[i:i + size].tolist()))
            if found:
                items |= found
                hits.append((i, i + size))
    return len(words), merge(hits), items


def window_sets(benchmark: DataFrame, window: int = WINDOW, max_set_words: int = MAX_SET_WORDS, item_col: str = "item_id", text_col: str = "text"):
    """Number of blocks, and the benchmark's sets of about ``max_set_words`` words one after the other."""
    items = benchmark.select(F.col(item_col).cast("string").alias("item_id"), F.col(text_col).cast("string").alias("text")).filter("item_id is not null and text is not null")
    size = items.agg(F.sum(F.octet_length("text") / 2 + 1)).first()[0] or 0  # a word has a byte and a separator at least
    if size <= max_set_words:
        return 1, iter([window_set([(r["item_id"], r["text"].encode()) for r in items.toLocalIterator()], window)])

    def run(batches):
        for b in batches:
            for item, text in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary()).to_pylist()):
                grams = [b" ".join(g).decode() for g in windows_of(text, window)]
                for at in range(0, len(grams), 10_000):
                    some = grams[at:at + 10_000]
                    yield pa.RecordBatch.from_arrays([pa.array([item] * len(some), pa.string()), pa.array(some, pa.string())], ["item_id", "gram"])

    grams = stored(items.mapInArrow(run, "item_id string, gram string"), "benchmark-windows")
    size = grams.agg(F.sum(F.octet_length("gram") / 2 + 1)).first()[0] or 0
    blocks = int(size // max_set_words) + 1
    split = stored(grams.withColumn("block", F.pmod(F.xxhash64("gram"), F.lit(blocks)).cast("int")), "benchmark-blocks", "block")
    return blocks, (numbered((r["item_id"], tuple(r["gram"].encode().split())) for r in split.filter(F.col("block") == k).toLocalIterator()) for k in range(blocks))


def scan_documents(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, max_set_words: int = MAX_SET_WORDS,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(row, doc_id, n_words, hits, items)`` per input row: all input columns, merged
    [start, end) word ranges that occur in the benchmark, and the item ids, sorted as strings.

    NULL texts and texts without words have no hits; NULL items are left out; an
    item id that repeats counts once. An empty benchmark hits nothing; an empty table gives no rows.
    """
    sc = docs.sparkSession.sparkContext
    base = docs.select(F.struct("*").alias("row"), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    out = base.select("row", "doc_id", "text", F.lit(0).cast("long").alias("n_words"), F.array().cast("array<struct<s:long,e:long>>").alias("hits"),
                      F.array().cast("array<string>").alias("items"))
    schema = out.schema  # a type object, not its text: column names may hold any sign
    arrow_hits = pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64())]))
    blocks, sets = window_sets(benchmark, window, max_set_words)
    for k, block in enumerate(sets, 1):
        shared = sc.broadcast(block)
        del block

        def run(batches, shared=shared):
            one = shared.value
            for b in batches:
                n, hits, items = [], [], []
                for text, had, known in zip(b.column(2).cast(pa.binary()).to_pylist(), b.column(4).to_pylist(), b.column(5).to_pylist()):
                    words, found, ids = scan(text, one)
                    n.append(words)
                    hits.append([{"s": s, "e": e} for s, e in merge(found + [(x["s"], x["e"]) for x in had])])
                    items.append(sorted(ids.union(known)))
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(n, pa.int64()), pa.array(hits, arrow_hits),
                                                  pa.array(items, pa.list_(pa.string()))], ["row", "doc_id", "text", "n_words", "hits", "items"])

        out = out.mapInArrow(run, schema)
        if k < blocks:  # the findings are written, so this set may go before the next one comes
            out = stored(out, "benchmark-findings")
            shared.destroy()
    return out.drop("text")


def contamination_report(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``(doc_id, n_words, n_hit, n_items, items_sha256, contaminated)`` per input row."""
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda t, x: t + x["e"] - x["s"])
    return scan_documents(docs, benchmark, **options).select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows without any benchmark window, columns as they came."""
    clean = scan_documents(docs, benchmark, **options).filter(F.size("hits") == 0)
    return clean.select([F.col("row").getField(c).alias(c) for c in docs.columns])


def remove_spans(text: str, hits: list[tuple[int, int]]) -> str:
    """The text without the hit word ranges (from each range's first word to its last)."""
    spans, at, raw = [], 0, text.encode()
    marks = raw.translate(WORD_BYTES)
    for w in marks.split():
        s = marks.index(w, at)
        spans.append((s, at := s + len(w)))
    out, last = [], 0
    for s, e in hits:
        out.append(raw[last:spans[s][0]])
        last = spans[e - 1][1]
    return b"".join([*out, raw[last:]]).decode()


SQL = r"""
WITH dw AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
iw AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                          '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
ipos AS (SELECT item_id, ws, least(10, len(ws)) AS k, unnest(generate_series(1, len(ws) - least(10, len(ws)) + 1)) AS i FROM iw WHERE len(ws) > 0),
iwin AS (SELECT DISTINCT item_id, k, array_to_string(list_slice(ws, i, i + k - 1), ' ') AS g FROM ipos),
ks AS (SELECT DISTINCT k FROM iwin),
dpos AS (SELECT doc_id, ws, k, unnest(generate_series(1, len(ws) - k + 1)) AS i FROM dw, ks WHERE len(ws) >= k),
dwin AS (SELECT doc_id, k, i, array_to_string(list_slice(ws, i, i + k - 1), ' ') AS g FROM dpos),
hit AS (SELECT d.doc_id, d.i, d.k, w.item_id FROM dwin d JOIN iwin w ON d.k = w.k AND d.g = w.g),
hitw AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(generate_series(i, i + k - 1)) AS p FROM hit) x GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n, string_agg(s, ',' ORDER BY s) AS s FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM hit) x GROUP BY doc_id)
SELECT dw.doc_id, CAST(len(dw.ws) AS BIGINT) AS n_words, CAST(coalesce(hitw.n, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(items.n, 0) AS BIGINT) AS n_items, sha256(coalesce(items.s, '')) AS items_sha256, coalesce(hitw.n, 0) > 0 AS contaminated
FROM dw LEFT JOIN hitw USING (doc_id) LEFT JOIN items USING (doc_id)
"""
