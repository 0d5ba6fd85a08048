"""The registered queries on the small test tables: against their SQL, or against what their contracts say."""

from __future__ import annotations

import zlib
from pathlib import Path

import duckdb
import numpy as np
import pyarrow.parquet as pq
import pytest

from sievewright.llm import queries

SF = "/root/testdata/sf0.001"
TABLES = "documents embeddings pages conversations labels".split()
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="no test data")


def plain(value: object) -> str:
    return f"{value:.9g}" if isinstance(value, float) else str(value)


def compare(spark, name, folder):
    duck = duckdb.connect()
    for t in TABLES:
        if Path(f"{folder}/{t}.parquet").exists():
            duck.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet{'/*.parquet' if Path(f'{folder}/{t}.parquet').is_dir() else ''}'")
    df = queries.queries()[name](spark, folder)
    answer = duck.execute(queries.oracle_sql()[name])
    columns = [d[0] for d in answer.description]
    assert sorted(df.columns) == sorted(columns)
    got = sorted(tuple(plain(r[c]) for c in sorted(columns)) for r in df.collect())
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    assert got == sorted(tuple(plain(r[i]) for i in order) for r in answer.fetchall())
    return got


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_against_sql(spark, name):
    assert compare(spark, name, SF)


def test_chat_with_null_turns(spark, tmp_path):
    rows = [(1, None, "assistant", "a"), (1, 2, "user", "</s>"), (1, None, None, None), (2, 1, "assistant", "[INST]"), (3, 1, "assistant", "x " * 200_000)]
    rows += [(4, i, ("user", "assistant")[i % 2], f"turn {i}") for i in range(400)]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    got = compare(spark, "op1_chat", str(tmp_path))
    assert {r[0] for r in got} == {"-1", "1", "2", "3", "4"}


def documents():
    return {r["doc_id"]: r for r in pq.read_table(f"{SF}/documents.parquet").to_pylist()}


def test_languages(spark):
    docs = documents()
    rows = queries.queries()["op5_langid"](spark, SF).collect()
    assert {r["doc_id"] for r in rows} == set(docs)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1 for r in rows)
    held = [(docs[r["doc_id"]]["lang"], r["lang_pred"]) for r in rows if r["held_out"] and r["lang_pred"] != "und" and docs[r["doc_id"]]["lang"]]
    assert sum(a == b for a, b in held) / len(held) > 0.95


def test_packed_sequences(spark):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(queries.tokenizer_path())
    want = {i: np.array([*tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 1], dtype="<u4") for i, r in documents().items()}
    rows = queries.queries()["op4_packing"](spark, SF).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, queries.queries()["op4_packing"](spark, SF).collect()))
    ids, sequences = {}, {}
    for r in rows:
        ids.setdefault(r["doc_id"], []).append(r)
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for pieces in sequences.values():
        ends = [a + n for a, n in sorted(pieces)]
        assert [a for a, _ in sorted(pieces)] == [0, *ends[:-1]] and ends[-1] <= 2048
    for i, tokens in want.items():
        at = 0
        for r in sorted(ids[i], key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(tokens) and r["ids_crc32"] == zlib.crc32(tokens[at : at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(tokens)
    held = sum(len(t) for t in want.values())
    assert sum(2048 if (n := sum(x for _, x in p)) & (n - 1) else n for p in sequences.values()) == held


def test_secrets_and_fingerprints(spark):
    from test_llm import brute_components, brute_fp, brute_spans

    docs = documents()
    for r in queries.queries()["op2_secrets"](spark, SF).collect():
        base = brute_spans(docs[r["doc_id"]]["text"])
        told = [x.split(":") for x in r["spans"].split(",")] if r["spans"] else []
        assert [(int(a), k, int(b)) for k, a, b in told if k != "random"] == base
        assert r["n_assign"] == sum(k == "assign" for _, k, _ in base)
    order = sorted(docs)
    fps = [brute_fp(docs[i]["text"]) for i in order]
    component = brute_components(len(order), lambda i, j: (fps[i] ^ fps[j]).bit_count() <= 2)
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in queries.queries()["op6_simhash"](spark, SF).collect()}
    assert got == {d: (f"{fps[i]:016x}", order[component[i]]) for i, d in enumerate(order)}
