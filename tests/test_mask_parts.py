"""Parts of all masks against flood filling."""

from __future__ import annotations

from pathlib import Path

import numpy as np
import pyarrow.parquet as pq
import pytest

from sievewright.plans import catalog

SF = "/root/testdata/sf0.001"
catalog.load_all()


def flood(mask):
    free, parts = set(zip(*map(np.ndarray.tolist, np.nonzero(mask)), strict=True)), 0
    while free:
        parts, stack = parts + 1, [free.pop()]
        while stack:
            y, x = stack.pop()
            for at in ((y - 1, x), (y + 1, x), (y, x - 1), (y, x + 1)):
                if at in free:
                    free.remove(at)
                    stack.append(at)
    return parts


@pytest.mark.skipif(not Path(SF).exists(), reason="no test data")
def test_every_order_is_counted(spark):
    masks = {}
    for r in pq.read_table(f"{SF}/lineitem.parquet", columns=["l_orderkey", "l_quantity", "l_partkey", "l_suppkey"]).to_pylist():
        x = r["l_partkey"] % 90
        masks.setdefault(r["l_orderkey"], np.zeros((8, 130), dtype=bool))[int(r["l_quantity"]) % 8, x : x + 1 + r["l_suppkey"] % 30] = True
    got = {r["l_orderkey"]: r["n_parts"] for r in catalog.QUERIES["mask_parts"](spark, SF).collect()}
    assert got == {k: flood(m) for k, m in masks.items()}
