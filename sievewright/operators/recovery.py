"""What runs need after a crash or an upgrade, as one plan over the records, ledgers and journals of all runs.

Only deleting files is work for a driver (:func:`lifecycle.remove_planned`, run by run under its lock); what is to be
done, the ledger that results and where each source goes on are tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievewright.operators.maintenance import legacy_outcome

#: What a record that wasn't accepted may say, and outcomes whose files go.
STATUSES = ("rejected", "uncertain", "verification_error", "generation_error", "accepted", "error", "duplicate")
DISCARDED = ("rejected", "duplicate", "error")
KEYS = ["run", "candidate_id"]
_PLACE = ("source_id", "attempt_index", "sequence")


def recovery_plan(runs: DataFrame, records: DataFrame, ledger: DataFrame, journals: DataFrame) -> DataFrame:
    """(run, candidate_id, actions, outcome): candidates with something to do in runs that nobody writes.

    ``runs``: run, status (ready or active). ``records``: keys, status, export_status, and the candidate's place (source_id,
    attempt_index, sequence). ``ledger``: keys, outcome, cleanup_state, place. ``journals``: keys, state. Actions, in order:
    finish (a removal that a crash cut short), replay (a committed record that the ledger doesn't have as accepted), convert (an
    old record without a ledger entry), cleanup (files of a discarded candidate are still there). A record that can't be
    classified, or that says accepted without being committed, blocks its candidate: blocked is then its only action.
    ``outcome`` is what the ledger says afterwards.
    """
    r = records.select(*KEYS, F.lit(True).alias("_r"), "status", "export_status", *(F.col(c).alias(f"r_{c}") for c in _PLACE))
    e = ledger.select(*KEYS, F.lit(True).alias("_e"), F.col("outcome").alias("_outcome"), "cleanup_state", *(F.col(c).alias(f"e_{c}") for c in _PLACE))
    j = journals.select(*KEYS, (F.col("state") == "pending").alias("_open"))
    met = r.join(e, KEYS, "full").join(j, KEYS, "full").join(runs.where("status = 'ready'").select("run"), "run", "left_semi")
    yes = lambda c: F.coalesce(c, F.lit(False))
    committed = yes(F.col("export_status") == "eligible")
    other = yes(F.col("_r")) & ~committed
    blocked = (committed & ~yes(F.col("status") == "accepted")) | (other & (~yes(F.col("status").isin(*STATUSES)) | (yes(F.col("status") == "accepted") & ~yes(F.col("export_status") == "duplicate"))))
    convert = other & F.col("_e").isNull()
    outcome = F.when(committed, "accepted").when(convert, legacy_outcome()).otherwise(F.col("_outcome"))
    steps = {
        "finish": yes(F.col("_open")),
        "replay": committed & ~yes(F.col("_outcome") == "accepted"),
        "convert": convert,
        "cleanup": yes(outcome.isin(*DISCARDED)) & ~yes(F.col("cleanup_state") == "cleaned"),
    }
    actions = F.when(blocked, F.array(F.lit("blocked"))).otherwise(F.array_compact(F.array(*(F.when(c, name) for name, c in steps.items()))))
    place = [F.coalesce(f"r_{c}", f"e_{c}").alias(c) for c in _PLACE]
    return met.select(*KEYS, actions.alias("actions"), outcome.alias("outcome"), *place).where(F.size("actions") > 0)


def recovered_ledger(ledger: DataFrame, plan: DataFrame) -> DataFrame:
    """The ledger after a plan: replayed and converted entries replace or join the others. Keys, outcome, place."""
    new = plan.where(F.arrays_overlap("actions", F.array(F.lit("replay"), F.lit("convert")))).select(*KEYS, "outcome", *_PLACE)
    return ledger.select(*KEYS, "outcome", *_PLACE).join(new.select(*KEYS), KEYS, "left_anti").unionByName(new)


def cursors(entries: DataFrame) -> DataFrame:
    """(run, source_id, next_attempt, next_sequence): where each source of each run goes on."""
    return entries.groupBy("run", "source_id").agg((F.max("attempt_index") + 1).alias("next_attempt"), (F.max("sequence") + 1).alias("next_sequence"))
