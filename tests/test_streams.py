"""Streams with keyed state: random batches, crashes and restarts give what a batch plan gives."""

from __future__ import annotations

import random
import time

import pytest

from sievewright.streaming import attempts, quota

COMPLETIONS = "source_id long, step long, sequence long, outcome string"


def completions(n=400, sources=5, seed=3):
    rng, steps, rows = random.Random(seed), {}, []
    for sequence in range(n):
        s = rng.choice([0] * 4 + list(range(sources)))
        rows.append((s, steps.get(s, 0), sequence, rng.choice(["error", "error", "accepted", "rejected"])))
        steps[s] = steps.get(s, 0) + 1
    return rows


def brute(rows, retries=1):
    out, state = [], {}
    for s, _, sequence, outcome in sorted(rows, key=lambda r: (r[0], r[1])):
        attempt, failures = state.get(s, (0, 0))
        if outcome == "error" and failures < retries:
            state[s] = (attempt, failures + 1)
        else:
            out.append((s, attempt, sequence, outcome, failures + (outcome == "error")))
            state[s] = (attempt + 1, 0)
    return sorted(out)


def write_parts(spark, rows, schema, folder, parts, seed=1):
    rng = random.Random(seed)
    cut = [[] for _ in range(parts)]
    for r in rows:
        cut[rng.randrange(parts)].append(r)
    for i, some in enumerate(cut):
        spark.createDataFrame(some, schema).coalesce(1).write.mode("append").parquet(str(folder))
        assert i >= 0


def test_attempts_survive_random_batches_and_a_restart(spark, tmp_path):
    rows = completions()
    half = [r for r in rows if r[2] % 2]
    write_parts(spark, half, COMPLETIONS, tmp_path / "in", 2)
    stream = lambda: attempts.finished(spark.readStream.schema(COMPLETIONS).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in"))
    attempts.run_to_end(stream(), f"{tmp_path}/state", path=f"{tmp_path}/out")
    write_parts(spark, [r for r in rows if not r[2] % 2], COMPLETIONS, tmp_path / "in", 2, seed=2)
    attempts.run_to_end(stream(), f"{tmp_path}/state", path=f"{tmp_path}/out")  # another query on the same state
    got = sorted(map(tuple, spark.read.schema(attempts.FINISHED).parquet(f"{tmp_path}/out").collect()))
    assert got == brute(rows)


def test_a_gap_is_given_up_after_some_time(spark, tmp_path):
    """Timers need a stream that runs on, not one that ends with its input."""
    write_parts(spark, [(1, 0, 10, "accepted"), (1, 2, 12, "rejected"), (2, 0, 20, "accepted")], COMPLETIONS, tmp_path / "in", 1)
    stream = attempts.finished(spark.readStream.schema(COMPLETIONS).parquet(f"{tmp_path}/in"), patience=2000)
    running = stream.writeStream.format("memory").queryName("gaps").option("checkpointLocation", f"{tmp_path}/state").trigger(processingTime="500 milliseconds").start()
    try:
        wanted = {(1, 0, 10, "accepted", 0), (2, 0, 20, "accepted", 0), (1, 1, None, "interrupted", 0), (1, 2, 12, "rejected", 0)}
        until, got = time.time() + 60, set()
        while got != wanted and time.time() < until:
            time.sleep(1)
            got = set(map(tuple, spark.table("gaps").collect()))
        assert got == wanted
    finally:
        running.stop()


class Crash(quota.QuotaSink):
    """Fails once after a version is written and before the batch is committed."""

    def __call__(self, batch, number):
        super().__call__(batch, number)
        if number == 1:
            raise RuntimeError("planted")


def test_quota_survives_random_batches_and_a_crash(spark, tmp_path):
    rng = random.Random(9)
    rows = [(rng.randrange(40), i) for i in range(300)]
    write_parts(spark, rows, "key long, sequence long", tmp_path / "in", 4)
    stream = lambda: spark.readStream.schema("key long, sequence long").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    with pytest.raises(Exception, match="planted"):
        attempts.run_to_end(attempts.firsts(stream()), f"{tmp_path}/base/state", Crash(f"{tmp_path}/base/accepted", 12))
    sink = quota.accept(stream(), f"{tmp_path}/base", 12)
    first = {}
    for key, sequence in rows:
        first.setdefault(key, sequence)
    assert sorted((r["sequence"], r["key"]) for r in sink.accepted(spark).collect()) == sorted((s, k) for k, s in first.items())[:12]


def test_one_task_writes_the_quota_but_does_not_rank_all_keys(spark, tmp_path, monkeypatch):
    from sievewright.streaming.quota import QuotaSink

    batch = spark.range(1000).selectExpr("id AS key", "1000 - id AS sequence")
    monkeypatch.setattr(type(batch), "coalesce", lambda *a: pytest.fail("ranked in one task"))
    sink = QuotaSink(str(tmp_path), 10)
    sink(batch, 0)
    assert sorted(r["sequence"] for r in sink.accepted(spark).collect()) == list(range(1, 11))


def test_waiting_completions_cost_few_calls_of_the_store():
    from sievewright.streaming.attempts import Attempts

    held, calls = {}, []
    store = type("Store", (), {
        "containsKey": lambda self, k: calls.append(k) or k in held,
        "getValue": lambda self, k: calls.append(k) or held[k],
        "updateValue": lambda self, k, v: calls.append(k) or held.__setitem__(k, v),
        "removeKey": lambda self, k: calls.append(k) or held.pop(k),
    })
    one = Attempts()
    one.held, state = store(), [0, 0, 0, 0]
    assert one._advance(1, state, {s: (10 * s, "accepted") for s in range(1, 2001)}) == [] and state[3] == 2000
    got = one._advance(1, state, {0: (0, "accepted")})
    assert [r[1:3] for r in got] == [(s, 10 * s) for s in range(2001)] and not held and state[3] == 0
    assert len(calls) < 40
