import random

import pytest
from pyspark.sql import functions as F

from millrace.operators import history
from millrace.operators.store import BucketStore
from tests_shared import membership, snapshots

D = ["2024-01-31", "2024-02-29", "2024-03-31", "2024-04-30"]


def chains(spark, rows):
    s = snapshots(spark, rows)
    return sorted((r.symbol, r.gics_sector, str(r.valid_from), str(r.valid_to) if r.valid_to else None) for r in history.snapshot_chains(s, history.calendar(s)).collect())


def test_versions_from_snapshots(spark):
    rows = [
        ("a", "A", "x", "i", D[0], "2024-01-31T20:00"), ("A ", "A", "X ", "i", D[1], "2024-02-29T20:00"), ("A", "A", "y", "i", D[2], "2024-03-31T20:00"), ("A", "A", None, "i", D[3], "2024-04-30T20:00"),
        ("B", "B", "x", "i", D[0], "2024-01-31T20:00"), ("B", "B", "x", "i", D[2], "2024-03-31T20:00"),
        ("C", "C", None, None, D[3], None), (None, "N", "x", "i", D[0], None), ("D", "D", "x", "i", None, None),
    ]
    assert chains(spark, rows + rows) == [
        ("A", "x", D[0], "2024-03-30"), ("A", "y", D[2], None), ("B", "x", D[0], "2024-02-28"), ("B", "x", D[2], "2024-04-29"), ("C", None, D[3], None),
    ]


def test_latest_capture_counts(spark):
    rows = [("A", "A", "wrong", "i", D[0], "2024-01-31T20:00"), ("A", "A", "right", "i", D[0], "2024-05-01T20:00")]
    assert chains(spark, rows) == [("A", "right", D[0], None)]


def test_rebuild_equals_full_build(spark):
    rng = random.Random(5)
    every = [(f"S{rng.randrange(8)}", "n", rng.choice("xyz"), rng.choice(["i", "j", None]), rng.choice(D), f"2024-06-{rng.randrange(1, 28):02d}T0{rng.randrange(9)}:00:00.{k:06d}") for k in range(120)]
    for cut in (1, 40, 119):
        raw, new = snapshots(spark, every[:cut]), snapshots(spark, every[cut:])
        got = history.rebuild_affected(history.snapshot_chains(raw, history.calendar(raw)), raw, new)
        full = raw.unionByName(new)
        assert sorted(map(str, got.collect())) == sorted(map(str, history.snapshot_chains(full, history.calendar(full)).select(got.columns).collect()))


def test_only_touched_symbols_are_rebuilt(spark):
    raw = snapshots(spark, [(s, s, "x", "i", d, f"{d}T20:00") for s in "AB" for d in D[:2]])
    late = snapshots(spark, [("A", "A", "y", "i", D[1], "2024-05-01T20:00")])
    dates = history.calendar(raw).select("snapshot_date")
    assert [r.symbol for r in history.touched_symbols(history.snapshot_chains(raw, history.calendar(raw)), dates, late).collect()] == ["A"]


def test_stored_rows(spark):
    rows = [
        ("A", "A", "x", "i", "2020-01-01", "2020-12-31", None), ("A", "A", "x", "i", "2020-01-01", "2020-12-31", None), ("A", "a", "X ", "i", "2021-01-01", None, "2021-05-01T00:00:00Z"),
        ("A", "A", "y", "i", "2022-01-01", "2022-03-31", None), ("A", "A", "y", "i", "2022-06-01", None, None), ("B", "B", "x", "i", "2020-01-01", "2020-01-01", None), ("B", "B", "x", "i", None, None, None),
    ]
    got = sorted((r.symbol, str(r.valid_from), str(r.valid_to)) for r in history.stored_chains(membership(spark, rows)).collect())
    assert got == [("A", "2020-01-01", "2021-12-31"), ("A", "2022-01-01", "2022-03-31"), ("A", "2022-06-01", "None"), ("B", "2020-01-01", "2020-01-01")]


def test_empty(spark):
    assert history.versions(snapshots(spark, []), membership(spark, [])).count() == 0


def test_store_swaps_only_touched_buckets(spark, tmp_path):
    store = BucketStore(spark, f"file://{tmp_path}/chains", ["id"], 4)
    assert store.generation() is None
    store.replace(spark.range(100))
    old, before = store.read(), store.manifest()
    touched = store.touched(spark.range(1))
    store.swap(store.read(touched).filter("id <> 0"), touched)
    after = store.manifest()
    assert store.generation() == 2 and store.read().count() == 99 and old.count() == 100
    with pytest.raises(ValueError):
        store.swap(spark.range(100), touched)
    assert store.read().count() == 99
    assert [b for b in before["folders"] if before["folders"][b] != after["folders"][b]] == [str(b) for b in touched] and len(touched) == 1
    for _ in range(3):  # old folders go, what is named stays
        store.replace(spark.range(7))
    assert store.read().count() == 7 and len(list(tmp_path.glob("chains/data-*"))) == 2


def test_a_writer_that_dies_or_comes_late_changes_nothing(spark, tmp_path):
    store = BucketStore(spark, f"file://{tmp_path}/chains", ["id"], 4)
    store.replace(spark.range(5))
    broken = spark.range(5).withColumn("id", F.expr("CASE WHEN id > 2 THEN raise_error('gone') ELSE id END").cast("long"))
    with pytest.raises(Exception):
        store.replace(broken)
    assert store.generation() == 1 and store.read().count() == 5
    (tmp_path / "chains" / "claim-2").write_text("another")
    with pytest.raises(RuntimeError):
        store.replace(spark.range(9))
    assert store.read().count() == 5


def test_updates_of_a_store_equal_a_build_from_all(spark, tmp_path):
    raw = snapshots(spark, [(s, s, "x", "i", d, f"{d}T20:00") for s in "ABCDEFGH" for d in D[:2]])
    late = snapshots(spark, [("A", "A", "y", "i", D[1], "2024-05-01T20:00"), ("B", "B", "x", "i", D[2], f"{D[2]}T20:00")])
    store = BucketStore(spark, f"file://{tmp_path}/chains", ["symbol"], 4)
    store.replace(history.snapshot_chains(raw, history.calendar(raw)))
    history.update_store(store, raw, late)
    every = raw.unionByName(late)
    key = lambda df: sorted(tuple(map(str, r)) for r in df.select("symbol", "gics_sector", "valid_from", "valid_to").collect())
    assert key(store.read()) == key(history.snapshot_chains(every, history.calendar(every)))
