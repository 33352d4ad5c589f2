"""Stored pages and the name index: the same rows as a sort and a scan, from few folders."""

import random

import pytest

from cartpulse.operators import paging as PG
from cartpulse.operators import search_index as SI
from cartpulse.session import scratch_path


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_pages_equal_slices_of_the_sorted_rows(spark):
    rnd, path = random.Random(1), scratch_path(spark, "test_pages")
    rows = [(rnd.choice([None, 7, 7, 7, *range(60)]), f"k{i:04}", i) for i in range(700)]  # one key holds many rows
    PG.write_pages(spark.createDataFrame(rows, "a int, b string, v int"), path, ("a", "b"), parts=9)
    pages = PG.Pages(spark, path)
    want = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    assert pages.total == 700
    for start, n in ((0, 10), (5, 100), (333, 20), (690, 20), (699, 1), (700, 5), (0, 1000), (350, 0)):
        got = pages.page(start, n)
        assert [tuple(r)[:3] for r in got.collect()] == want[start:start + n] and all(r["total"] == 700 for r in got.collect())
    at = next(i for i, r in enumerate(want) if r[0] is not None)
    for i in (at, at + 100, 500, 698, 699):
        assert [tuple(r) for r in pages.after(want[i][:2], 15).collect()] == want[i + 1:i + 16]
    p = plan(pages.page(333, 20))
    assert "PartitionFilters: [_part" in p or "_part#" in p.split("PartitionFilters")[1][:60]
    assert sum(r["n"] for r in pages.index if r["n"] > 300) == 0


def test_no_rows_no_pages(spark):
    path = scratch_path(spark, "test_no_pages")
    PG.write_pages(spark.range(3).selectExpr("id a", "id b"), path, ("a", "b"), parts=2)
    pages = PG.Pages(spark, path)
    assert pages.page(3, 5).count() == 0 and pages.after((2, 2), 5).count() == 0 and pages.after((-1, 0), 2).count() == 2


@pytest.mark.parametrize("word", ["ring", "RING", "in", "g r", "zzz", "été", "aaaa", "", "g", "😀 x"])
def test_search_equals_a_scan(spark, word):
    rnd, path = random.Random(2), scratch_path(spark, "test_names")
    rows = [(i, "".join(rnd.choice("ring aé") for _ in range(rnd.randint(0, 12)))) for i in range(400)]
    rows += [(500, None), (None, "ring"), (501, "Hot RING été"), (501, "Hot RING été"), (502, "aaaaaa"), (503, "a😀 x"), (504, "")]
    names = spark.createDataFrame(rows, "id int, name string")
    SI.write_index(names, path, "id", "name", buckets=16)
    got = sorted(map(str, map(tuple, SI.search(spark, path, names, "id", "name", word, buckets=16).collect())))
    want = [r for r in rows if r[1] is not None and word.lower() in r[1].lower() and (r[0] is not None or len(word) < 3)]
    assert got == sorted(map(str, want))


def test_search_reads_only_its_pieces_folders(spark):
    path = scratch_path(spark, "test_pieces")
    names = spark.range(50).selectExpr("id", "concat('item ', id) name")
    SI.write_index(names, path, "id", "name", buckets=64)
    found = SI.search(spark, path, names, "id", "name", "item", buckets=64)
    assert "PartitionFilters: [bucket" in plan(found) or "bucket#" in plan(found).split("PartitionFilters")[1][:80]
    assert found.count() == 50
