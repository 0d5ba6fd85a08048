"""Published tables: crashes after every step, refresh against a full rebuild, compaction, migration."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from sievewright.operators.published import Published, migrate

SCHEMA = "k long, v string, n int"


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


class Planted(Exception):
    pass


def crash_at(wanted):
    def after(step):
        if step == wanted:
            raise Planted(step)

    return after


def test_refresh_keeps_what_did_not_change(spark, tmp_path):
    table = Published(spark, f"file://{tmp_path}/t", "k", SCHEMA, buckets=8)
    first = spark.createDataFrame([(i, f"v{i}", None if i % 5 == 0 else i) for i in range(100)], SCHEMA)
    assert table.refresh(first, "one") == 1 and rows_of(table.read()) == rows_of(first)
    before = table.manifest()["buckets"]
    second = first.where("k <> 7").withColumn("v", F.when(F.col("k") == 3, "new").otherwise(F.col("v")))
    for step in ("copied", "verified", "published"):
        with pytest.raises(Planted):
            table.refresh(second, f"two-{step}", after=crash_at(step))
        assert rows_of(table.read()) == rows_of(second if step == "published" else first)
        table.refresh(second, f"two-{step}")
        assert rows_of(table.read()) == rows_of(second)
        changed = {b for b, e in table.manifest()["buckets"].items() if before.get(b, {}).get("folder") != e["folder"]}
        hit = {str(r[0]) for r in first.where("k in (3, 7)").select(table.bucket(F.col("k"))).collect()}
        assert changed == hit
        table.refresh(first, f"back-{step}")
        before = table.manifest()["buckets"]
    assert rows_of(table.read(1)) == rows_of(first)  # old versions can be read until they go
    table.vacuum()
    assert len(table.versions()) == 1 and rows_of(table.read()) == rows_of(first)
    table.refresh(first.limit(0), "none")
    assert table.read().count() == 0


def test_upserts_tombstones_and_compaction(spark, tmp_path):
    rng, held = random.Random(4), {}
    table = Published(spark, f"file://{tmp_path}/t", "k", SCHEMA, buckets=8)
    for nth in range(4):
        some = {rng.randrange(20 if nth < 3 else 3): rng.random() < 0.3 for _ in range(12)}
        rows = spark.createDataFrame([(k, f"v{nth}", nth, gone) for k, gone in some.items()], f"{SCHEMA}, gone boolean")
        if nth == 2:
            with pytest.raises(Planted):
                table.upsert(rows, f"u{nth}", F.col("gone"), after=crash_at("copied"))
        table.upsert(rows, f"u{nth}", F.col("gone"))
        table.upsert(rows, f"u{nth}", F.col("gone"))  # again: nothing happens
        held |= {k: (k, f"v{nth}", nth) for k in some}
        held = {k: v for k, v in held.items() if not some.get(k)}
        want = sorted(held.values(), key=repr)
        assert rows_of(table.read()) == want
        if nth in (1, 3):
            folders = table.manifest()["buckets"]
            touched, reading = table.touched(), table.read()
            for step in ("copied", "verified", "published"):
                with pytest.raises(Planted):
                    table.compact(f"c{nth}", after=crash_at(step))
                assert rows_of(table.read()) == want and rows_of(reading) == want  # during, and what was begun before
            table.compact(f"c{nth}")
            now = table.manifest()
            assert rows_of(table.read()) == want and not now["deltas"]
            assert all(now["buckets"].get(b) == e for b, e in folders.items() if int(b) not in touched)
    table.vacuum()
    assert rows_of(table.read()) == want


STEPS = [f"{t} {s}" for t in ("beside", "records", "moved") for s in ("copied", "verified", "published")] + ["old artifacts deleted"]


def test_migration_resumes_after_every_step(spark, tmp_path):
    moved = lambda p: F.regexp_replace(p, "^old/(a.*)$", "new/$1")
    for nth, step in enumerate(STEPS):
        artifacts = Published(spark, f"file://{tmp_path}/{nth}/a", "path", "path string, content string", buckets=2)
        records = Published(spark, f"file://{tmp_path}/{nth}/r", "id", "id long, path string", buckets=2)
        artifacts.refresh(spark.createDataFrame([(f"old/{x}{i}", f"c{x}{i}") for x in "ab" for i in range(3)], "path string, content string"), "start")
        records.refresh(spark.createDataFrame([(i, f"old/{'ab'[i % 2]}{i % 3}") for i in range(6)] + [(9, None)], "id long, path string"), "start")
        with pytest.raises(Planted):
            migrate(artifacts, records, moved, "m", after=crash_at(step))
        content = dict(map(tuple, artifacts.read().collect()))
        assert all(p is None or p in content for _, p in map(tuple, records.read().collect()))  # references resolve
        migrate(artifacts, records, moved, "m")
        assert rows_of(artifacts.read()) == sorted((f"{'new' if x == 'a' else 'old'}/{x}{i}", f"c{x}{i}") for x in "ab" for i in range(3))
        assert {p for _, p in map(tuple, records.read().collect())} == {None, *(p for p, _ in map(tuple, artifacts.read().collect()))}
        assert len(artifacts.versions()) == len(records.versions()) == 1


def test_a_view_kept_up_by_batches_equals_a_rebuild(spark, tmp_path):
    from sievewright.plans.tables import per_source
    from sievewright.streaming.refresh import RefreshSink

    schema = "event_id long, source_id long, outcome string, spent long"
    ledger = Published(spark, f"file://{tmp_path}/l", "event_id", schema, buckets=8, by="source_id")
    view = Published(spark, f"file://{tmp_path}/v", "source_id", "source_id long, attempts long, accepted long, spent long", buckets=8)
    sink = RefreshSink(ledger, view, per_source, F.col("outcome") == "gone", compact_every=2)
    rng, held = random.Random(1), {}
    for number in range(3):
        sources = [s for s in range(12) if number == 0 or s % 4 == number]
        batch = [(rng.randrange(4) * 100 + s, s, rng.choice(["purchase", "error", "gone"]), number) for s in sources]
        batch = list({r[0]: r for r in batch}.values())
        before = view.manifest()["buckets"]
        rows = spark.createDataFrame(batch, schema)
        sink(rows, number)
        sink(rows, number)  # replayed
        held |= {r[0]: r for r in batch}
        held = {k: r for k, r in held.items() if r[2] != "gone"}
        want = per_source(spark.createDataFrame(list(held.values()), schema))
        assert rows_of(view.read()) == rows_of(want)
        hit = {str(r[0]) for r in rows.select(view.bucket(F.col("source_id"))).collect()}
        assert all(view.manifest()["buckets"].get(b) == e for b, e in before.items() if b not in hit)


def test_a_ledger_has_more_buckets_as_it_grows(spark, tmp_path, monkeypatch):
    from sievewright.plans import tables

    monkeypatch.setattr(tables, "BUCKET_ROWS", 200)
    spark.range(5000).selectExpr("id div 4 AS l_orderkey", "id % 4 AS l_linenumber", "double(id) AS l_quantity", "if(id % 3 = 0, 'R', 'N') AS l_returnflag").write.parquet(str(tmp_path / "lineitem.parquet"))
    out = tables.compacted_ledger(spark, str(tmp_path))
    assert out.count() == 5000 - 1667 and len({f.rpartition("/")[0] for f in out.inputFiles()}) == 25
