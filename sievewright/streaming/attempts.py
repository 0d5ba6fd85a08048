"""Keyed state over a stream of completions: attempts in order, retries, cursors, and first artifacts.

Completions may come in any order and in any batches. State is kept by key in RocksDB, checkpointed with the stream, so a
restarted stream goes on where it was and gives the rows that one batch plan over all completions gives.
"""

from __future__ import annotations

import json
import sys
import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

# Spark starts a worker of its own beside the driver for stateful processors, which gets no shipped packages: so
# processors are sent whole, not by name.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Failures that an attempt may have and go on.
RETRIES = 1
#: Steps whose waiting completions are kept together.
STRETCH = 512
FINISHED = "source_id long, attempt_index long, sequence long, outcome string, failures long"
FIRST = "key long, sequence long"


class Attempts(StatefulProcessor):
    """The attempts of a source, finished in order of its steps.

    A completion is (source_id, step, sequence, outcome): step counts the completions of a source from 0. One that comes
    before its predecessors is held. An ``error`` is tried again within the attempt, until there are more failures than
    ``retries``; any other outcome ends the attempt. With ``patience`` (milliseconds) a gap that isn't filled for so long is
    given up: its steps count as ``interrupted`` attempts, without a sequence, and what comes for them later is dropped.
    """

    def __init__(self, retries: int = RETRIES, patience: int | None = None) -> None:
        self.retries, self.patience = retries, patience

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.at = handle.getValueState("at", "step long, attempt long, failures long, held long")
        # Completions that wait, as JSON by stretches of steps: a call to the store for each would take most of the time.
        self.held = handle.getMapState("held", "stretch long", "waiting string")

    def _state(self) -> list[int]:
        return list(self.at.get()) if self.at.exists() else [0, 0, 0, 0]

    def _finish(self, key: int, state: list[int], sequence: int | None, outcome: str) -> list[tuple]:
        state[0] += 1
        if outcome == "error":
            state[2] += 1
            if state[2] <= self.retries:
                return []
        row = (key, state[1], sequence, outcome, state[2])
        state[1], state[2] = state[1] + 1, 0
        return [row]

    def _waiting(self, stretch: int) -> dict[int, tuple]:
        if not self.held.containsKey((stretch,)):
            return {}
        return {step: (sequence, outcome) for step, sequence, outcome in json.loads(self.held.getValue((stretch,))[0])}

    def _advance(self, key: int, state: list[int], came: dict[int, tuple]) -> list[tuple]:
        """Finish what is next in order, of what came and what is held; hold the rest."""
        out, read, changed = [], {}, set()

        def waiting(step: int) -> dict[int, tuple]:
            stretch = step // STRETCH
            if stretch not in read:
                read[stretch] = self._waiting(stretch)
            return read[stretch]

        while state[0] in came or state[3]:
            step = state[0]
            if step in came:
                found = came.pop(step)
            elif step in waiting(step):
                found = waiting(step).pop(step)
                changed.add(step // STRETCH)
                state[3] -= 1
            else:
                break
            out += self._finish(key, state, *found)
        for step, found in came.items():
            if step not in waiting(step):
                waiting(step)[step] = found
                changed.add(step // STRETCH)
                state[3] += 1
        for stretch in changed:
            if read[stretch]:
                self.held.updateValue((stretch,), (json.dumps([(step, *found) for step, found in read[stretch].items()]),))
            else:
                self.held.removeKey((stretch,))
        return out

    def _settle(self, state: list[int], timers, rows: list[tuple]) -> Iterator[pd.DataFrame]:
        """Keep the state, with one timer while something is held and none otherwise."""
        self.at.update(tuple(state))
        if self.patience is not None:
            for old in list(self.handle.listTimers()):
                self.handle.deleteTimer(old)
            if state[3]:
                self.handle.registerTimer(timers.getCurrentProcessingTimeInMs() + self.patience)
        yield self._table(rows)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        state, came = self._state(), {}
        for part in rows:
            for step, sequence, outcome in zip(part["step"].tolist(), part["sequence"].tolist(), part["outcome"].tolist(), strict=True):
                if step >= state[0]:
                    came.setdefault(step, (sequence, outcome))
        yield from self._settle(state, timerValues, self._advance(key[0], state, came))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        state, out = self._state(), []
        stretch = min((k[0] for k in self.held.keys()), default=None)
        first = state[0] if stretch is None else min(self._waiting(stretch))
        while state[0] < first:
            out += self._finish(key[0], state, None, "interrupted")
        yield from self._settle(state, timerValues, out + self._advance(key[0], state, {}))

    @staticmethod
    def _table(rows: list[tuple]) -> pd.DataFrame:
        names = [c.split()[0] for c in FINISHED.split(", ")]
        return pd.DataFrame(rows, columns=names).astype({c: "Int64" for c in names if c != "outcome"})

    def close(self) -> None:
        pass


class FirstOfKey(StatefulProcessor):
    """The smallest sequence of each key so far, told whenever it falls."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.least = handle.getValueState("least", "sequence long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        least = min(int(part["sequence"].min()) for part in rows)
        if not self.least.exists() or least < self.least.get()[0]:
            self.least.update((least,))
            yield pd.DataFrame({"key": [key[0]], "sequence": [least]})

    def close(self) -> None:
        pass


def keyed_state(spark: SparkSession) -> None:
    """State by key needs the RocksDB store."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)


def finished(completions: DataFrame, retries: int = RETRIES, patience: int | None = None) -> DataFrame:
    """A stream of (source_id, step, sequence, outcome) as finished attempts (``FINISHED``).

    With ``patience`` the stream has timers, so it must run on; one that ends with its input would wait for them for ever.
    """
    keyed_state(completions.sparkSession)
    mode = "None" if patience is None else "ProcessingTime"
    rows = completions.select("source_id", "step", "sequence", "outcome").groupBy("source_id")
    return rows.transformWithStateInPandas(statefulProcessor=Attempts(retries, patience), outputStructType=FINISHED, outputMode="Append", timeMode=mode)


def firsts(rows: DataFrame) -> DataFrame:
    """A stream of (key, sequence) as the falling minima of each key."""
    keyed_state(rows.sparkSession)
    return rows.select("key", "sequence").groupBy("key").transformWithStateInPandas(statefulProcessor=FirstOfKey(), outputStructType=FIRST, outputMode="Append", timeMode="None")


def shared_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``; only a local master may leave the setting out."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        shared = "file:///tmp/checkpoints"
    return f"{shared.rstrip('/')}/sievewright/{label}-{uuid.uuid4().hex}"


def run_to_end(stream: DataFrame, checkpoint: str, write: Callable[[DataFrame, int], None] | None = None, path: str | None = None) -> None:
    """Process what there is: into a function of batches, or a table that gets each row once."""
    started = stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    (started.foreachBatch(write) if write else started.format("parquet").option("path", path)).start().awaitTermination()


def replay_attempts(completions: DataFrame, parts: int, retries: int = RETRIES) -> DataFrame:
    """Finished attempts of a table of completions, streamed in ``parts`` batches that hold rows of all sources, in no order."""
    spark = completions.sparkSession
    base = shared_folder(spark, "attempts")
    completions.select("source_id", "step", "sequence", "outcome").repartition(parts, F.xxhash64("sequence")).write.parquet(f"{base}/in")
    stream = spark.readStream.schema("source_id long, step long, sequence long, outcome string").option("maxFilesPerTrigger", 1).parquet(f"{base}/in")
    run_to_end(finished(stream, retries), f"{base}/state", path=f"{base}/out")
    return spark.read.schema(FINISHED).parquet(f"{base}/out")
