"""A derived table kept up with a stream of ledger entries.

Each batch is an upsert to the ledger; then only the buckets of groups that it has entries of are derived anew, and only
those whose rows differ from what is published are rewritten. Both changes carry the batch's number, so a batch that is
replayed after a failure does nothing twice.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievewright.operators.published import Published


class RefreshSink:
    """foreachBatch function: ``derive`` makes the rows of ``view`` from those of ``ledger``, group by group.

    Both tables are dealt by the group, to as many buckets. ``gone`` marks entries that remove theirs. The ledger is
    compacted every ``compact_every`` batches.
    """

    def __init__(self, ledger: Published, view: Published, derive: Callable[[DataFrame], DataFrame], gone: Column | None = None, compact_every: int = 8) -> None:
        if (ledger.by, ledger.buckets) != (view.by, view.buckets):
            raise ValueError("ledger and view must be dealt alike")
        self.ledger, self.view, self.derive, self.gone, self.compact_every = ledger, view, derive, gone, compact_every

    def __call__(self, batch: DataFrame, number: int) -> None:
        self.ledger.upsert(batch, f"batch-{number}", self.gone)
        hit = [r["b"] for r in batch.select(self.ledger.bucket(F.col(self.ledger.by)).alias("b")).distinct().collect()]  # bucket numbers
        self.view.refresh(self.derive(self.ledger.read(only=hit)), f"batch-{number}", only=hit)
        if (number + 1) % self.compact_every == 0:
            self.ledger.compact(f"compact-{number}")
