"""Recovery plans over small runs."""

from __future__ import annotations

from sievewright.operators import recovery

PLACE = "source_id string, attempt_index long, sequence long"


def tables(spark):
    runs = spark.createDataFrame([("a", "ready"), ("b", "active")], "run string, status string")
    records = [("a", "c1", "accepted", "eligible", "s", 0, 0), ("a", "c2", "rejected", None, "s", 1, 1), ("a", "c3", "uncertain", "duplicate", "s", 2, 2), ("a", "c4", "accepted", None, "s", 3, 3)]
    records += [("a", "c5", "strange", None, "s", 4, 4), ("a", "c6", "rejected", "eligible", "t", 0, 5), ("b", "c1", "accepted", "eligible", "s", 0, 0), ("a", "c7", "accepted", "eligible", "t", 1, 6)]
    ledger = [("a", "c2", "rejected", "cleaned", "s", 1, 1), ("a", "c7", "accepted", "cleaned", "t", 1, 6), ("a", "c8", "error", "pending", "t", 7, 7), ("a", "c9", "error", "cleaned", "t", 3, 8), ("a", "c10", "interrupted", None, "t", 4, 9), ("b", "c2", "error", "pending", "s", 1, 1)]
    journals = [("a", "c8", "pending"), ("a", "c9", "pending"), ("a", "c2", "cleaned"), ("b", "c2", "pending")]
    frame = spark.createDataFrame
    return runs, frame(records, f"run string, candidate_id string, status string, export_status string, {PLACE}"), frame(ledger, f"run string, candidate_id string, outcome string, cleanup_state string, {PLACE}"), frame(journals, "run string, candidate_id string, state string")


def test_plan_ledger_and_cursors(spark):
    runs, records, ledger, journals = tables(spark)
    plan = recovery.recovery_plan(runs, records, ledger, journals)
    got = {r["candidate_id"]: (r["actions"], r["outcome"]) for r in plan.collect()}
    want = {"c1": (["replay"], "accepted"), "c3": (["convert", "cleanup"], "duplicate"), "c8": (["finish", "cleanup"], "error"), "c9": (["finish"], "error")}
    assert {k: v for k, v in got.items() if v[0] != ["blocked"]} == want
    assert {k for k, v in got.items() if v[0] == ["blocked"]} == {"c4", "c5", "c6"}
    after = recovery.recovered_ledger(ledger, plan)
    assert {(r["run"], r["candidate_id"]): r["outcome"] for r in after.collect()} == {(r, c): o for r, c, o, *_ in map(tuple, ledger.collect())} | {("a", "c1"): "accepted", ("a", "c3"): "duplicate"}
    assert {(r["run"], r["source_id"]): (r["next_attempt"], r["next_sequence"]) for r in recovery.cursors(after).collect()} == {("a", "s"): (3, 3), ("a", "t"): (8, 10), ("b", "s"): (2, 2)}
    # A second plan over the recovered ledger replays nothing; what was to be cleaned still is.
    again = after.join(ledger.select("run", "candidate_id", "cleanup_state"), ["run", "candidate_id"], "left")
    assert {a for r in recovery.recovery_plan(runs, records, again, journals.limit(0)).collect() for a in r["actions"]} == {"blocked", "cleanup"}
