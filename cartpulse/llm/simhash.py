"""SimHash near-duplicates by meet-in-the-middle ball hashing.

A document's fingerprint holds, per bit, the majority over the XXH64 hashes of
its word shingles. Two fingerprints link when they differ in at most
``max_bits`` (3) bits. Linking never compares pairs:

1. *Screen*: two fingerprints within 3 bits agree up to one bit in one of their
   32-bit halves. Every fingerprint emits each half and its 32 one-bit variants
   (66 rows); those that meet nobody have no partner and leave.
2. *Balls*: each remaining fingerprint emits its variants within one bit (the
   inner ball). For 3 bits the middle of a pair lies two bits from one end. The
   ends then differ in parity, and two of the three bits lie in the same half,
   so only odd-parity fingerprints emit two-bit variants, and only those with
   both bits in one half (992 instead of 2016, for half of the fingerprints).
3. *Meet*: rows meet on the variant. Members of its inner ball are within two
   bits of each other and within three of the outer members, so linking all
   members to the smallest inner one gives every connection with one link per
   member. The links are deduplicated and their distance verified.
4. Connected components of the links (``components``).

Exact copies share a fingerprint and are folded before step 1, so a text with
millions of copies is one row there.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from cartpulse.llm.common import id_text, stored
from cartpulse.llm.components import components

SEED = 42
HASH_BLOCK = 1 << 16


def fingerprint(text: bytes | None, shingle_words: int = 3) -> int:
    """Unsigned 64-bit fingerprint of a whole UTF-8 text; no words (or None) give 0."""
    words = (text or b"").lower().split()
    n = len(words) - shingle_words + 1
    if not words:
        return 0
    joined = b" ".join(words)
    if n < 1:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[:n].tolist()
    ends = ends[shingle_words - 1:].tolist()
    ones = np.zeros(64, np.int64)
    digest = xxhash.xxh64_digest  # big-endian bytes
    for at in range(0, n, HASH_BLOCK):
        block = b"".join([digest(joined[s:e], SEED) for s, e in zip(starts[at:at + HASH_BLOCK], ends[at:at + HASH_BLOCK])])
        ones += np.unpackbits(np.frombuffer(block, np.uint8)).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle_words: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, fp)`` per input row; ``fp`` holds the 64 bits as a signed long."""

    def run(batches):
        for b in batches:
            fps = [fingerprint(t, shingle_words) for t in b.column(1).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.array(fps, np.uint64).view(np.int64))], ["doc_id", "fp"])

    return id_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, fp long")


def _bit(i) -> "F.Column":
    return F.call_function("shiftleft", F.lit(1).cast("long"), i.cast("int"))


def screen(fps: DataFrame) -> DataFrame:
    """Distinct ``fp`` that meet another one in a 32-bit half, up to one bit."""
    halves = F.array(F.struct(F.lit(0).alias("half"), F.shiftrightunsigned("fp", 32).alias("key")),
                     F.struct(F.lit(1).alias("half"), F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF)).alias("key")))
    flips = F.transform(F.sequence(F.lit(-1), F.lit(31)), lambda i: F.when(i >= 0, _bit(F.greatest(i, F.lit(0)))).otherwise(F.lit(0).cast("long")))
    keyed = (fps.select("fp", F.explode(halves).alias("h")).select("fp", "h.half", "h.key", F.explode(flips).alias("flip"))
             .select("fp", "half", F.col("key").bitwiseXOR(F.col("flip")).alias("key"), (F.col("flip") == 0).cast("int").alias("home")))
    w = Window.partitionBy("half", "key")
    met = keyed.withColumn("homes", F.sum("home").over(w)).withColumn("n", F.count(F.lit(1)).over(w))
    # a home meets anyone else under its key; a variant meets the homes there
    return met.filter((F.col("n") > 1) & (F.col("homes") > 0)).select("fp").distinct()


def ball_variants(fps: DataFrame, max_bits: int) -> DataFrame:
    """``(variant, fp, inner)``: the inner ball of every fingerprint, the outer shell of odd-parity ones."""
    all_bits = F.sequence(F.lit(0), F.lit(63))
    zero = F.array(F.lit(0).cast("long"))
    ones = F.transform(all_bits, _bit)
    same_half = F.flatten(F.transform(all_bits, lambda i: F.when(
        i % 32 < 31, F.transform(F.sequence(i + 1, F.floor(i / 32).cast("int") * 32 + 31), lambda j: _bit(i).bitwiseOR(_bit(j))))
        .otherwise(F.array().cast("array<bigint>"))))
    inner, outer = {0: (zero, None), 1: (zero, ones), 2: (F.concat(zero, ones), None), 3: (F.concat(zero, ones), same_half)}[max_bits]
    rows = fps.select("fp", F.explode(inner).alias("flip")).select(F.col("fp").bitwiseXOR(F.col("flip")).alias("variant"), "fp", F.lit(True).alias("inner"))
    if outer is not None:
        odd = fps.filter(F.bit_count("fp") % 2 == 1)
        rows = rows.unionByName(odd.select("fp", F.explode(outer).alias("flip")).select(F.col("fp").bitwiseXOR(F.col("flip")).alias("variant"), "fp", F.lit(False).alias("inner")))
    return rows


def links(fps: DataFrame, max_bits: int) -> DataFrame:
    """Verified links ``(u, v)`` between distinct fingerprints that connect exactly
    what all pairs within ``max_bits`` would connect (not all those pairs)."""
    met = ball_variants(fps, max_bits).withColumn("hub", F.min(F.when(F.col("inner"), F.col("fp"))).over(Window.partitionBy("variant")))
    found = met.filter("hub is not null and hub <> fp").select(F.col("fp").alias("u"), F.col("hub").alias("v")).distinct()
    return found.filter(F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= max_bits)


def near_duplicates(docs: DataFrame, shingle_words: int = 3, max_bits: int = 3,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, fp, root, component_id)``, one row per input row.

    ``root`` is a representative fingerprint of the component, ``component_id``
    its smallest doc_id. NULL and empty texts have fingerprint 0 and link like
    any other. Rows that repeat a doc_id are all returned; a NULL doc_id never
    names a component (it is NULL only where no member has an id). An empty
    table gives no rows; extra columns are not read.
    """
    if max_bits not in (0, 1, 2, 3):
        raise ValueError("max_bits must be 0, 1, 2 or 3")
    rows = stored(fingerprints(docs, shingle_words, id_col, text_col), "simhash-fp")
    nodes = rows.groupBy("fp").agg(F.min("doc_id").alias("least"))
    near = stored(screen(nodes.select("fp")), "simhash-near") if max_bits else nodes.select("fp").limit(0)
    comp = components(links(near, max_bits))
    rooted = nodes.join(comp, nodes["fp"] == comp["u"], "left").select(nodes["fp"], F.coalesce("root", "fp").alias("root"), "least")
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    found = stored(rooted.select("fp", "root").join(named, "root"), "simhash-roots")
    return rows.join(found, "fp").select("doc_id", "fp", "root", "component_id")


def dedup(docs: DataFrame, shingle_words: int = 3, max_bits: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The input rows, all columns as they came, of which one per component stays:
    that of the smallest doc_id. Repeats of that row go too; rows without an id
    stay only where no member of the component has one (one of them)."""
    near = near_duplicates(docs, shingle_words, max_bits, id_col, text_col)
    ids = near.groupBy("doc_id").agg(F.count(F.lit(1)).alias("copies"), F.max(F.col("component_id").isNull()).alias("unnamed"))
    if not ids.filter("(doc_id is not null and copies > 1) or unnamed").limit(1).count():
        keep = near.filter("doc_id = component_id").select(F.col("doc_id").alias("__keep_id"))
        return docs.join(keep, docs[id_col] == keep["__keep_id"], "left_semi")
    # an id on several rows, or a row kept without one: the row is named by its id and its component's root
    roots = near.filter(F.col("doc_id").eqNullSafe(F.col("component_id"))).select("doc_id", "fp", "root").distinct()
    cols = docs.columns
    tagged = docs.select(F.struct("*").alias("row"), F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("txt"))

    def tag(batches):
        for b in batches:
            fps = [fingerprint(t, shingle_words) for t in b.column("txt").cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("row"), b.column("id"), pa.array(np.array(fps, np.uint64).view(np.int64))], ["row", "id", "fp"])

    tagged = tagged.mapInArrow(tag, StructType([tagged.schema["row"], tagged.schema["id"], StructField("fp", LongType())]))
    kept = tagged.join(roots, tagged["id"].eqNullSafe(roots["doc_id"]) & (tagged["fp"] == roots["fp"])).select("row", "id", "root")
    return kept.dropDuplicates(["id", "root"]).select([F.col("row").getField(c).alias(c) for c in cols])
