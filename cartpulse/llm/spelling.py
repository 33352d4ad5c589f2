"""Spelling variant grouping: counted words, pairs one edit apart, each word's form and root.

Words are compared by their letters' counts: one inserted or deleted letter makes
a squared distance of 1, one replaced letter 2. The distances of a block of words
against another are one NumPy product (a Gram matrix) and two squared
norms; pairs at most two apart, in the same or the next length, are
kept and their edit is verified letter by letter.

*Blocks.* Let m be the shorter word's length. An edit leaves either the
first m // 2 letters or the last m - m // 2 of the shorter word in place
at the same end of the longer one. So words meet only in blocks of one such end and one
length m (with words of m letters on both sides, and of m + 1 on one): nothing
is lost, and the work does not grow with the square of the vocabulary. A block
over ``tile`` words is cut by word hash into tiles, and each pair of tiles is a
block of its own: memory is bounded, and a common ending is spread over many tasks.
Small blocks of one task run together in one stacked product.
"""

from __future__ import annotations

import itertools
from collections import Counter
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartpulse.llm.common import id_text, stored

#: Latin-1 bytes of the words: A-Z lower-cased, a-z and U+00C0 to U+00FF as they are; the rest separates.
LETTERS = bytes(c + 32 if 0x41 <= c <= 0x5A else c if 0x61 <= c <= 0x7A or c >= 0xC0 else 0x20 for c in range(256))
KINDS = 26 + 64  # letters that are counted
HELD_WORDS = 300_000  # distinct words that a task counts before it passes them on
TILE = 2048
STACK = 1 << 20  # cells of one stacked product


def noisy_words(doc_id, text: str | None, every: int = 97, least: int = 5) -> Counter:
    """Words of one text and their numbers. Of every ``every``-th (document, word) by checksum
    one letter is gone. Words of under ``least`` letters are left out."""
    # a letter beyond Latin-1 becomes one "?", which separates as it did
    runs = Counter(w for w in (text or "").encode("latin-1", "replace").translate(LETTERS).split() if len(w) >= least)
    start, out = crc32(f"{'' if doc_id is None else doc_id}:".encode()), Counter()
    for w, n in runs.items():
        h = crc32(w if w.isascii() else w.decode("latin-1").encode(), start)
        if h % every == 0:
            k = h % len(w)
            w = w[:k] + w[k + 1:]
            if len(w) < least:
                continue
        out[w] += n
    return out


def count_words(docs: DataFrame, every: int = 97, least: int = 5, min_count: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(word, n)`` of all words with at least ``least`` letters and ``min_count`` occurrences."""

    def run(batches):
        held: Counter = Counter()

        def out():
            words = pa.array([w.decode("latin-1") for w in held], pa.string())
            return pa.RecordBatch.from_arrays([words, pa.array(list(held.values()), pa.int64())], ["word", "n"])

        for b in batches:
            for doc, text in zip(b.column(0).to_pylist(), b.column(1)):
                held.update(noisy_words(doc, text.as_py(), every, least))
                if len(held) >= HELD_WORDS:
                    yield out()
                    held.clear()
        if held:
            yield out()

    counted = id_text(docs, id_col, text_col).mapInArrow(run, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)


def one_edit(a: str, b: str) -> bool:
    """Exactly one letter inserted, deleted or replaced."""
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[i + (len(a) == len(b)):] == b[i + 1:]


def _counts(words: list[bytes], sizes: np.ndarray) -> np.ndarray:
    """Letter counts, one row a word."""
    letters = np.frombuffer(b"".join(words), np.uint8).astype(np.int64)
    kind = np.where(letters < 0x80, letters - 0x61, letters - 0xC0 + 26)
    row = np.repeat(np.arange(len(words)), sizes)
    return np.bincount(row * KINDS + kind, minlength=len(words) * KINDS).reshape(len(words), KINDS).astype(np.float32)


def _gram(counts: np.ndarray, left: np.ndarray, right: np.ndarray):
    """Row pairs of (stacked) blocks at most two apart: ``left`` and ``right`` are (blocks, words) row numbers, -1 for none."""
    a, b = counts[left], counts[right]
    apart = (a * a).sum(axis=2)[:, :, None] + (b * b).sum(axis=2)[:, None, :] - 2 * np.matmul(a, b.transpose(0, 2, 1))
    at = np.nonzero((apart <= 2.5) & (left >= 0)[:, :, None] & (right >= 0)[:, None, :])
    return left[at[0], at[1]], right[at[0], at[2]]


def block_pairs(words: list[str], keys: np.ndarray, tile_l: np.ndarray, tile_r: np.ndarray, tile: np.ndarray, length: np.ndarray):
    """Near pairs within blocks: rows come block by block (``keys`` number the blocks); ``length``
    is a block's m. Yields arrays of row numbers; each pair in one block only."""
    if not words:
        return
    raw = [w.encode("latin-1") for w in words]
    sizes = np.fromiter(map(len, raw), np.int64, len(raw))
    counts = np.vstack([_counts(raw, sizes), np.zeros((1, KINDS), np.float32)])  # row -1: no word
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    ends = np.r_[starts[1:], len(keys)]
    jobs: list[tuple[np.ndarray, np.ndarray]] = []
    for s, e in zip(starts.tolist(), ends.tolist()):
        at = np.arange(s, e)
        short = sizes[s:e] == length[s]
        if tile_l[s] == tile_r[s]:
            if short.any():
                jobs.append((at[short], at))
            continue
        first = tile[s:e] == tile_l[s]
        jobs.append((at[first & short], at[~first]))
        jobs.append((at[~first & short], at[first & ~short]))
    jobs = [j for j in jobs if len(j[0]) and len(j[1])]
    jobs.sort(key=lambda j: (len(j[0]), len(j[1])))
    i = 0
    while i < len(jobs):
        k, wide, high = i, 0, 0
        while k < len(jobs):  # jobs of like size stand in one product
            h, w = max(high, len(jobs[k][0])), max(wide, len(jobs[k][1]))
            if k > i and (w > 2 * len(jobs[i][1]) + 8 or (k + 1 - i) * (h * w + (h + w) * KINDS) > 4 * STACK):
                break
            high, wide, k = h, w, k + 1
        for top in range(0, high, max(1, STACK // max(1, wide))):  # a large block: some rows at a time
            bottom = min(high, top + max(1, STACK // max(1, wide)))
            left, right = np.full((k - i, bottom - top), -1), np.full((k - i, wide), -1)
            for n, (a, b) in enumerate(jobs[i:k]):
                a = a[top:bottom]
                left[n, :len(a)], right[n, :len(b)] = a, b
            u, v = _gram(counts, left, right)
            ok = (sizes[v] > sizes[u]) | (u < v) | (tile_l[u] != tile_r[u])  # within a tile, equal lengths meet from both sides
            yield u[ok], v[ok]
        i = k


def near_pairs(words: DataFrame, tile: int = TILE) -> DataFrame:
    """``(a, b)`` of all words one edit apart, each pair once; ``words`` holds distinct words ``word``
    of the letters a-z and U+00C0 to U+00FF, at least two each."""
    n = F.length("word")

    def ends(m, longer):
        half = F.floor(m / 2).cast("int")
        return [F.struct(m.cast("int").alias("m"), F.lit(p).alias("part"), piece.alias("piece"), F.lit(longer).alias("longer"))
                for p, piece in ((0, F.substring("word", F.lit(1), half)), (1, F.substring("word", n - (m - half) + 1, m - half)))]

    met = words.select("word", F.explode(F.array(*ends(n, False), *ends(n - 1, True))).alias("e")).select("word", "e.*")
    # a block needs a word of m letters and another one
    sizes = met.groupBy("m", "part", "piece").agg(F.count(F.lit(1)).alias("size"), F.count_if(~F.col("longer")).alias("short")).filter("size > 1 and short > 0")
    sizes = sizes.select("m", "part", "piece", F.ceil(F.col("size") / tile).cast("int").alias("tiles"))
    placed = met.join(sizes, ["m", "part", "piece"]).withColumn("tile", F.pmod(F.xxhash64("word"), F.col("tiles")).cast("int"))
    both = F.transform(F.sequence(F.lit(0), F.col("tiles") - 1), lambda t: F.struct(F.least("tile", t).alias("l"), F.greatest("tile", t).alias("r")))
    rows = placed.withColumn("t", F.explode(both)).select("m", "part", "piece", F.col("t.l").alias("l"), F.col("t.r").alias("r"), "tile", "word")
    block = ["m", "part", "piece", "l", "r"]
    rows = rows.repartition(*block).sortWithinPartitions(*block)

    def numbered(t: pa.Table) -> np.ndarray:
        """Number of each row's block."""
        piece = t.column("piece").to_pylist()
        change = np.fromiter((a != b for a, b in itertools.pairwise(piece)), bool, len(piece) - 1)
        for c in ("m", "part", "l", "r"):
            change |= np.diff(t.column(c).to_numpy()) != 0
        return np.concatenate(([0], np.cumsum(change)))

    def pairs(t: pa.Table, keys: np.ndarray):
        m, part, left, right, own = (t.column(c).to_numpy() for c in ("m", "part", "l", "r", "tile"))
        words, us, vs = t.column("word").to_pylist(), [], []
        for u, v in block_pairs(words, keys, left, right, own, m):
            for i, j in zip(u.tolist(), v.tolist()):
                a, b = words[i], words[j]
                # a pair that shares both ends meets in two blocks: the one of the first letters counts
                if one_edit(a, b) and not (part[i] and a[:m[i] // 2] == b[:m[i] // 2]):
                    us.append(a)
                    vs.append(b)
        return pa.RecordBatch.from_arrays([pa.array(us, pa.string()), pa.array(vs, pa.string())], ["a", "b"])

    def run(batches):
        held = None
        for b in batches:
            t = pa.Table.from_batches([b]) if held is None else pa.concat_tables([held, pa.Table.from_batches([b])]).combine_chunks()
            if t.num_rows >= 4 * TILE:
                keys = numbered(t)
                cut = int(np.searchsorted(keys, keys[-1]))  # the last block may go on
                if cut:
                    yield pairs(t.slice(0, cut), keys[:cut])
                t = t.slice(cut)
            held = t
        if held is not None and held.num_rows:
            yield pairs(held, numbered(held))

    return rows.mapInArrow(run, "a string, b string")


def spelling_variants(docs: DataFrame, every: int = 97, least: int = 5, min_count: int = 3, ratio: int = 2, tile: int = TILE,
                      id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(word, n, n_near, form, form_n, root)``, one row per word of the corpus.

    ``form`` is the near word of largest ``n`` (ties: the smallest) if that is at least ``ratio`` (over 1)
    times the word's; ``root`` is where following the forms ends. NULL and
    empty texts have no words; a NULL id counts as an empty one in the
    checksum; rows that repeat count again; an empty table gives no rows;
    extra columns are not read. Texts of any length are read whole.
    """
    if ratio <= 1:
        raise ValueError("ratio must be over 1, or forms could go round")
    words = stored(count_words(docs, every, least, min_count, id_col, text_col), "spelling-words")
    pairs = stored(near_pairs(words.select("word"), tile), "spelling-pairs")
    each = pairs.select(F.explode(F.array(F.struct(F.col("a").alias("word"), F.col("b").alias("near")), F.struct(F.col("b").alias("word"), F.col("a").alias("near")))).alias("p")).select("p.*")
    known = each.join(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
    best = known.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("minus"), "near")).alias("best"))
    formed = words.join(best, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
                                                     F.when(-F.col("best.minus") >= ratio * F.col("n"), F.col("best.near")).alias("form"),
                                                     F.when(-F.col("best.minus") >= ratio * F.col("n"), -F.col("best.minus")).alias("form_n"))
    formed = stored(formed, "spelling-forms")
    return formed.join(roots(formed.filter("form is not null").select("word", "form")), "word", "left") \
        .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def roots(forms: DataFrame) -> DataFrame:
    """``(word, root)`` of links ``(word, form)`` without rings, one a word: pointers double every round,
    so a chain of k links takes log2(k) rounds."""
    now = stored(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = now.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        step = stored(step, "spelling-roots")
        if not step.filter("moved").limit(1).count():
            return step.select("word", "root")
        now = step.select("word", "root")
