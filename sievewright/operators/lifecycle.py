"""The life of attempts: outcome precedence, retries, memoised receipts, recovery, and files on the driver."""

from __future__ import annotations

import contextlib
import fcntl
import json
import os
import stat
from collections.abc import Iterator
from pathlib import Path

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievewright.operators.acceptance import first_by_key, first_n
from sievewright.operators.reporting import write_small_json

#: Terminal statuses and the order in which an attempt's record advances, fixed values.
STATUSES = ("reserved", "planned", "generated", "scored", "accepted")


def unscored(requests: DataFrame, receipts: DataFrame) -> DataFrame:
    """Requests without a successful receipt of the same identity; failed ones are asked again."""
    return requests.join(receipts.where("ok").select("request_id"), "request_id", "left_anti")


def completion_outcomes(completions: DataFrame, sources: DataFrame, quota: int) -> DataFrame:
    """Every completion with its outcome: error, then rejected, then duplicate, then beyond the quota, then accepted.

    ``completions``: sequence, hash, failed, passed. A duplicate is an artifact of a source, or of an earlier accepted
    one; a repeat of an artifact that came after the quota was met is no duplicate of an accepted one.
    """
    good = completions.where(~F.col("failed") & F.col("passed")).join(sources.select("hash").distinct(), "hash", "left_anti")
    wins = first_n(first_by_key(good.select("hash", "sequence"), "hash", "sequence"), quota, "sequence").select(F.col("hash").alias("_h"), F.col("sequence").alias("_s"))
    known = sources.select(F.col("hash").alias("_sh")).distinct()
    met = completions.join(wins, F.col("hash") == F.col("_h"), "left").join(known, F.col("hash") == F.col("_sh"), "left")
    seen = F.col("_sh").isNotNull() | (F.col("_s") < F.col("sequence"))
    outcome = F.when(F.col("failed"), "error").when(~F.col("passed"), "rejected").when(seen, "duplicate").when(F.col("_s") == F.col("sequence"), "accepted").otherwise("interrupted")
    return met.select(*completions.columns, F.coalesce(outcome, F.lit("interrupted")).alias("outcome"))


def exhausted(stages: DataFrame, most: int = 1) -> DataFrame:
    """Attempts with a stage that failed more often than retries allow; fatal failures aren't retried."""
    return stages.groupBy("candidate_id", "stage").agg(F.count_if(~F.col("ok")).alias("failures"), F.bool_or(F.coalesce("fatal", F.lit(False))).alias("fatal")).where(F.col("fatal") | (F.col("failures") > most))


def resume_stage(status: Column) -> Column:
    """The stage an unfinished attempt goes on with: the one after its stored status."""
    steps = F.array(*(F.lit(s) for s in STATUSES))
    return F.try_element_at(steps, F.array_position(steps, status).cast("int") + 1)


def cursor(entries: DataFrame, pending: DataFrame) -> DataFrame:
    """The next attempt of each source and the next sequence number, over ledger and pending entries together."""
    both = entries.select("source_id", "attempt_index", "sequence").unionByName(pending.select("source_id", "attempt_index", "sequence"))
    return both.groupBy("source_id").agg((F.max("attempt_index") + 1).alias("next_attempt"), (F.max("sequence") + 1).alias("next_sequence"))


def interrupted(pending: DataFrame, ledger: DataFrame) -> DataFrame:
    """Pending attempts without a ledger entry, as entries of outcome interrupted; a later entry replaces them."""
    return pending.join(ledger.select("candidate_id"), "candidate_id", "left_anti").withColumn("outcome", F.lit("interrupted"))


def lanes(workers: DataFrame, width: int = 2) -> DataFrame:
    """Workers grouped into lanes of ``width`` in their order (column pos from 0)."""
    return workers.groupBy(F.floor(F.col("pos") / width).alias("lane")).agg(F.sort_array(F.collect_list("worker")).alias("workers"))


def batches(attempts: DataFrame, size: int) -> DataFrame:
    """Attempts in batches of equal size by sequence; completions of a batch are handled in order of sequence."""
    return attempts.withColumn("batch", F.floor(F.col("sequence") / size)).withColumn("place", F.row_number().over(Window.partitionBy("batch").orderBy("sequence")))


# Files on the driver


class Blocked(ValueError):
    """A path may not be removed."""


@contextlib.contextmanager
def writer_lock(path: str | Path) -> Iterator[None]:
    """One writer a run; fails at once if there is another."""
    with open(path, "w") as f:
        fcntl.flock(f, fcntl.LOCK_EX | fcntl.LOCK_NB)
        yield


def _nodes(top: Path) -> list[Path]:
    found = [top]
    if top.is_dir() and not top.is_symlink():
        for base, dirs, files in os.walk(top, followlinks=False):
            found += [Path(base, n) for n in (*dirs, *files)]
    return found


def _removable(root: Path, relative: str) -> list[Path]:
    """The nodes of a path, deepest first. Links, hard links, special files and paths outside the root block it."""
    parts = Path(relative).parts
    if Path(relative).is_absolute() or ".." in parts:
        raise Blocked(f"{relative}: outside the run")
    at = root
    for part in parts:
        at = at / part
        if at.is_symlink():
            raise Blocked(f"{relative}: link")
    if not at.exists():
        return []
    nodes = _nodes(at)
    for node in nodes:
        info = node.lstat()
        if not (stat.S_ISREG(info.st_mode) or stat.S_ISDIR(info.st_mode)):
            raise Blocked(f"{relative}: not a plain file")
        if stat.S_ISREG(info.st_mode) and info.st_nlink != 1:
            raise Blocked(f"{relative}: hard link")
    return nodes[::-1]


def remove_planned(root: str | Path, candidate: str, paths: list[str], protected: list[str], journal: str | Path) -> int:
    """Remove the planned paths of a candidate below ``root``: everything is checked first, then journaled, then removed.

    A plan is taken up again after a crash by calling this with the journal's paths; the removal is idempotent.
    """
    root, where = Path(root), Path(journal)
    for p in paths:
        if any(v == p or v.startswith(p + "/") for v in protected):
            raise Blocked(f"{p}: accepted artifacts refer to it")
    nodes = [node for p in paths for node in _removable(root, p)]
    write_small_json({"candidate_id": candidate, "state": "pending", "paths": paths}, where)
    for node in nodes:
        node.rmdir() if node.is_dir() else node.unlink()
    write_small_json({"candidate_id": candidate, "state": "cleaned", "paths": paths}, where)
    return len(nodes)


def recover_removals(root: str | Path, journals: str | Path, protected: list[str]) -> list[str]:
    """Finish removals that a crash left pending; their candidates."""
    done = []
    for path in sorted(Path(journals).glob("*.json")):
        entry = json.loads(path.read_text())
        if entry["state"] == "pending":
            remove_planned(root, entry["candidate_id"], entry["paths"], protected, path)
            done.append(entry["candidate_id"])
    return done
