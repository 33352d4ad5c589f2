"""Folding of ``batch_id`` folders while others read: leveled merges behind a versioned manifest.

A stream leaves one folder a date and micro-batch. :func:`fold` merges closed batches of a
date into one folder, and several such folders into one of the next level (``fan`` at a time, so a row is
rewritten once per level and a date keeps at most ``fan`` folders a level). What belongs to the table is said
by the manifest of the highest number, which is written whole and renamed into place: a reader takes
one version and sees every batch once, before, during and after a fold. Two folds at a time cannot both take
the next number; the later one fails and changes nothing. :func:`vacuum` removes what
only older versions name.

``combine`` merges rows while folding: :func:`first_rows` (of repeated keys the earliest
batch's row stays, also where the stream's state had forgotten a key) or :func:`added_up` (partial sums).

:func:`fold_documents` does the same for keyed documents: a snapshot in buckets of the key's
hash, of which a merge rewrites only those that new versions touch.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartpulse.operators.dedup import _null_safe_join, first_per_key
from cartpulse.streaming.sinks import HIVE_DEFAULT_PARTITION, _fs_path, read_table

MANIFESTS, FOLDS = "_manifest", "_folds"  # Spark's readers of the table skip names that begin so
KEEP_NEWEST = 1  # the newest batch may still be written again


def _children(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs_path(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def manifest(spark: SparkSession, table: str) -> tuple[int, dict]:
    """The newest version's number and content; (0, {}) before the first fold."""
    names = sorted(n for n in _children(spark, f"{table}/{MANIFESTS}") if n.startswith("v") and n[1:].isdigit())
    if not names:
        return 0, {}
    fs, p = _fs_path(spark, f"{table}/{MANIFESTS}/{names[-1]}")
    stream = fs.open(p)
    try:
        return int(names[-1][1:]), json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def publish(spark: SparkSession, table: str, version: int, content: dict) -> None:
    """Make ``content`` version ``version``; ``FileExistsError`` if there is one."""
    jvm, sc = spark.sparkContext._jvm, spark.sparkContext
    fs, folder = _fs_path(spark, f"{table}/{MANIFESTS}")
    fs.mkdirs(folder)
    fresh = jvm.org.apache.hadoop.fs.Path(folder, f".{uuid.uuid4().hex}")
    out = fs.create(fresh, False)
    out.write(bytearray(json.dumps(content).encode()))
    out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), sc._jsc.hadoopConfiguration())
    no_overwrite = sc._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(fs.makeQualified(fresh), fs.makeQualified(jvm.org.apache.hadoop.fs.Path(folder, f"v{version:012d}")), no_overwrite)
    except Exception as e:
        fs.delete(fresh, False)
        if "already exists" in str(e) or "FileAlreadyExists" in str(e):
            raise FileExistsError(f"{table}: version {version} was published by another fold") from e
        raise


def _batches(spark: SparkSession, table: str, date: str, date_col: str) -> list[int]:
    return sorted(int(n.removeprefix("batch_id=")) for n in _children(spark, f"{table}/{date_col}={date}") if n.startswith("batch_id="))


def _dates(spark: SparkSession, table: str, date_col: str, content: dict) -> list[str]:
    here = {n.removeprefix(f"{date_col}=") for n in _children(spark, table) if n.startswith(f"{date_col}=")}
    return sorted(here | set(content.get("folds", {})))


def _date_text(date) -> str:
    return HIVE_DEFAULT_PARTITION if date is None else str(date)


def _visible(spark: SparkSession, table: str, date_col: str, content: dict, dates: Sequence[str]) -> tuple[list[str], list[str]]:
    """Folders of one version: folded ones, and batches that no fold covers."""
    folded, raw = [], []
    for d in dates:
        folds = content.get("folds", {}).get(d, [])
        folded += [f"{table}/{x['path']}" for x in folds]
        covered = max((x["hi"] for x in folds), default=-1)
        raw += [f"{table}/{date_col}={d}/batch_id={b}" for b in _batches(spark, table, d, date_col) if b > covered]
    return folded, raw


def _read(spark: SparkSession, table: str, folded: list[str], raw: list[str]) -> DataFrame | None:
    parts = ([spark.read.parquet(*folded)] if folded else []) + ([spark.read.option("basePath", table).parquet(*raw)] if raw else [])
    if len(parts) == 2:
        parts[1] = parts[1].select(*[F.col(c).cast(parts[0].schema[c].dataType).alias(c) for c in parts[0].columns])
    return (parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])) if parts else None


def read_folded(spark: SparkSession, table: str, date_col: str, dates: Sequence | None = None) -> DataFrame | None:
    """The table, or the given dates of it, as of its newest version; None without rows.
    Only those dates' folders are listed; their number does not grow with a day's batches."""
    table = table.rstrip("/")
    content = manifest(spark, table)[1]
    wanted = _dates(spark, table, date_col, content) if dates is None else sorted({_date_text(d) for d in dates})
    return _read(spark, table, *_visible(spark, table, date_col, content, wanted))


Combine = Callable[[DataFrame], DataFrame]


def first_rows(keys: Sequence[str], order: Sequence[str]) -> Combine:
    """Of rows with one key the earliest batch's stays."""
    return lambda rows: first_per_key(rows, keys, ["batch_id", *order]).select(*rows.columns)


def added_up(keys: Sequence[str], **sums: str) -> Combine:
    """Rows of one key become one: ``sums`` names each added column and its type."""
    return lambda rows: rows.groupBy(*keys).agg(*[F.sum(c).cast(t).alias(c) for c, t in sums.items()], F.max("batch_id").alias("batch_id")).select(*rows.columns)


def fold(spark: SparkSession, table: str, date_col: str, combine: Combine | None = None, fan: int = 8) -> int:
    """Fold what is due, one job per level over all dates; returns the version now current."""
    table = table.rstrip("/")
    version, content = manifest(spark, table)
    folds: dict[str, list[dict]] = {d: list(x) for d, x in content.get("folds", {}).items()}
    known = {d: _batches(spark, table, d, date_col) for d in _dates(spark, table, date_col, content)}
    newest = max((b for bs in known.values() for b in bs), default=-1)
    due = {}
    for d, batches in known.items():
        covered = max((x["hi"] for x in folds.get(d, [])), default=-1)
        closed = [b for b in batches if covered < b <= newest - KEEP_NEWEST]
        if len(closed) >= fan:
            due[d] = ([f"{table}/{date_col}={d}/batch_id={b}" for b in closed], {"lo": closed[0], "hi": closed[-1], "level": 1})
    changed = _merge(spark, table, date_col, due, folds, combine, raw=True)
    level = 1
    while any(x["level"] >= level for xs in folds.values() for x in xs):
        due = {}
        for d, xs in folds.items():
            run = [x for x in xs if x["level"] == level]
            if len(run) >= fan:
                due[d] = ([f"{table}/{x['path']}" for x in run], {"lo": run[0]["lo"], "hi": run[-1]["hi"], "level": level + 1})
                folds[d] = [x for x in xs if x["level"] != level]
        changed |= _merge(spark, table, date_col, due, folds, combine, raw=False)
        level += 1
    if not changed:
        return version
    publish(spark, table, version + 1, {"folds": folds})
    return version + 1


def _merge(spark, table: str, date_col: str, due: dict, folds: dict, combine: Combine | None, raw: bool) -> bool:
    if not due:
        return False
    paths = [p for ps, _ in due.values() for p in ps]
    rows = _read(spark, table, [] if raw else paths, paths if raw else [])
    rows = rows.withColumn("batch_id", F.col("batch_id").cast("bigint")).withColumn(date_col, F.col(date_col).cast("date"))
    name = f"{FOLDS}/{uuid.uuid4().hex}"
    merged = combine(rows) if combine else rows
    day = F.coalesce(F.col(date_col).cast("string"), F.lit("none"))
    merged.withColumn("_d", day).repartition("_d").write.partitionBy("_d").parquet(f"{table}/{name}")
    for d, (_, entry) in due.items():
        folder = "none" if d == HIVE_DEFAULT_PARTITION else d
        folds[d] = sorted([*folds.get(d, []), {**entry, "path": f"{name}/_d={folder}"}], key=lambda x: x["lo"])
    return True


def vacuum(spark: SparkSession, table: str, date_col: str, keep_versions: int = 2) -> int:
    """Remove folders that none of the newest ``keep_versions`` versions names; returns how many.
    A reader that still holds an older version must have ended."""
    table = table.rstrip("/")
    names = sorted(n for n in _children(spark, f"{table}/{MANIFESTS}") if n.startswith("v") and n[1:].isdigit())
    if len(names) < keep_versions:
        return 0
    fs, _ = _fs_path(spark, table)
    jvm, gone, used, oldest = spark.sparkContext._jvm, 0, set(), {}
    for i, n in enumerate(names[-keep_versions:]):
        stream = fs.open(jvm.org.apache.hadoop.fs.Path(f"{table}/{MANIFESTS}/{n}"))
        content = json.loads(jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        stream.close()
        oldest = content if i == 0 else oldest
        used |= {x["path"].split("/")[1] for xs in content["folds"].values() for x in xs}
    doomed = [f"{table}/{FOLDS}/{n}" for n in _children(spark, f"{table}/{FOLDS}") if n not in used]
    for d, xs in oldest["folds"].items():
        covered = max((x["hi"] for x in xs), default=-1)
        doomed += [f"{table}/{date_col}={d}/batch_id={b}" for b in _batches(spark, table, d, date_col) if b <= covered]
    doomed += [f"{table}/{MANIFESTS}/{n}" for n in names[:-keep_versions]]
    for p in doomed:
        gone += bool(fs.delete(jvm.org.apache.hadoop.fs.Path(p), True))
    return gone


# ---------------------------------------------------------------- keyed documents

def _newest(log: DataFrame, key: str, version: Sequence[str]) -> DataFrame:
    rest = [c for c in log.columns if c != key]
    return log.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(*version)).alias("_v")).select(key, "_v.*").select(*log.columns)


def _tail(spark: SparkSession, table: str, after: int, schema: str | None) -> DataFrame | None:
    ids = [int(n.removeprefix("batch_id=")) for n in _children(spark, table) if n.startswith("batch_id=")]
    paths = [f"{table}/batch_id={b}" for b in sorted(ids) if b > after]
    if not paths:
        return None
    reader = spark.read.option("basePath", table)
    rows = (reader.schema(schema) if schema else reader).parquet(*paths)
    return rows.withColumn("batch_id", F.col("batch_id").cast("bigint"))


def fold_documents(spark: SparkSession, table: str, key: str, version: Sequence[str], gone: str | None = None, buckets: int = 64,
                   schema: str | None = None) -> int:
    """Merge the log's new versions (``version`` orders them, ``batch_id`` first) into the snapshot.

    Only the buckets of the new versions' keys are read and written again. Keys whose newest version has ``gone`` leave
    the snapshot. Returns the version now current.
    """
    table = table.rstrip("/")
    number, content = manifest(spark, table)
    tail = _tail(spark, table, content.get("upto", -1), schema)
    if tail is None:
        return number
    buckets = content.get("n", buckets)
    bucket = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")
    held = dict(content.get("buckets", {}))
    newest = tail.agg(F.max("batch_id")).first()[0]
    if newest is None:  # batches without a document
        return number
    touched = [str(r[0]) for r in tail.select(bucket.alias("b")).distinct().collect()]  # at most ``buckets`` numbers
    old = [f"{table}/{held[b]}" for b in touched if b in held]
    rows = _newest(tail, key, version) if not old else _newest(spark.read.parquet(*old).select(*tail.columns).unionByName(tail), key, version)
    if gone:
        rows = rows.where(~F.col(gone))
    name = f"{FOLDS}/{uuid.uuid4().hex}"
    rows.withColumn("_b", bucket).repartition("_b").write.partitionBy("_b").parquet(f"{table}/{name}")
    written = {n.removeprefix("_b=") for n in _children(spark, f"{table}/{name}") if n.startswith("_b=")}
    for b in touched:
        held.pop(b, None)
        if b in written:
            held[b] = f"{name}/_b={b}"
    publish(spark, table, number + 1, {"upto": newest, "n": buckets, "buckets": held})
    return number + 1


def read_documents(spark: SparkSession, table: str, key: str, version: Sequence[str], gone: str | None = None, schema: str | None = None,
                   only: Sequence[str] | None = None) -> DataFrame | None:
    """The documents as of the newest batch: the snapshot without the keys that newer versions name, and the newest of
    those. Only the versions since the last merge are grouped. ``only``: documents of these keys, read from their buckets."""
    table = table.rstrip("/")
    content = manifest(spark, table)[1]
    held, tail = content.get("buckets", {}), _tail(spark, table, content.get("upto", -1), schema)
    if only is not None:
        wanted = spark.createDataFrame([(k,) for k in only], f"{key} string").select(F.pmod(F.xxhash64(key), F.lit(content.get("n", 1))).cast("int").cast("string"))
        held = {r[0]: held[r[0]] for r in wanted.distinct().collect() if r[0] in held}
        tail = tail.where(F.col(key).isin(*only)) if tail is not None else None
    old = spark.read.parquet(*[f"{table}/{p}" for p in held.values()]) if held else None
    old = old.where(F.col(key).isin(*only)) if old is not None and only is not None else old
    if tail is None:
        return old
    new = _newest(tail, key, version)
    if old is not None:
        kept = _null_safe_join(old, new, [key], "left_anti")
        new = new.where(~F.col(gone)) if gone else new
        return kept.select(*new.columns).unionByName(new)
    return new.where(~F.col(gone)) if gone else new
