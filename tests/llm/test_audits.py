"""Filter audit, license scan and periodic runs against brute force, on small tables with nulls, ties, repeats and long texts."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from itertools import permutations
from pathlib import Path

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sievewright.llm import common, filter_audit, licenses, periodic, queries

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, part string, mask int, hash long, n int"


def docs(spark, rows):
    """Documents with columns whose names clash with those that operators make."""
    return spark.createDataFrame([(d, t, "en", s, len(t or ""), "x", 1, 2, 3) for d, t, s in rows], DOCS)


@given(st.binary(max_size=200), st.integers(1, 50))
@settings(max_examples=200, deadline=None)
def test_words_in_steps(text, step):
    assert [w for some in common.word_steps(text, step) for w in some] == text.split()


# Filter audit


def failing(text, doc_id, rows):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    smaller = doc_id is not None and any(d is not None and d < doc_id and (t or "") == text for d, t, _ in rows)
    return (len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * len(re.findall("[A-Z]", text)) > 2 * len(text), re.search(r"[#$%&*|]", text) is not None, smaller)


def brute_audit(rows, labels):
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    out = {}
    marked = [(s or "", failing(t or "", d, rows), d in good, d in toxic) for d, t, s in rows]
    for part in {m[0] for m in marked}:
        mine = [m for m in marked if m[0] == part]
        shapley = dict.fromkeys(range(5), 0)
        for order in permutations(range(5)):
            left = mine
            for step, f in enumerate(order, 1):
                gone = [m for m in left if m[1][f]]
                shapley[f] += len(gone)
                out[part, "".join("ABCDE"[i] for i in order), step] = [len(left) - len(gone), len(gone), sum(m[1][f] for m in mine) - len(gone), sum(m[1][f] and sum(m[1]) == 1 for m in mine), sum(m[2] for m in gone), sum(m[3] for m in gone)]
                left = [m for m in left if not m[1][f]]
        for (p, order, step), v in out.items():
            if p == part:
                v.append(shapley["ABCDE".index(order[step - 1])])
    return out


def audit_rows():
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    texts = [" ".join(word() for _ in range(n)) for n in (250, 199, 200, 201)] + ["AB cd " * 300, "x " * 400, "", "a$b", "ünï " * 250, " ".join(word() for _ in range(300)) + " A|B"]
    rows = [(i, rng.choice(texts), rng.choice(["a", "b", None, ""])) for i in range(60)]
    rows += [(None, texts[0], "a"), (None, texts[0], "a"), (3, texts[1], "b"), (3, texts[1], "b"), (90, None, None), (91, "", "c"), (92, "word " * 300_000, "c")]
    labels = [(i, i % 2, i % 3 == 0) for i in range(0, 60, 2)] + [(4, 0, 1), (4, 1, 0), (4, 1, 1), (None, 1, 1), (6, None, None), (500, 1, 1)]
    return rows, [(d, q, None if t is None else int(t)) for d, q, t in labels]


def test_audit_equals_applying_every_order(spark):
    rows, labels = audit_rows()
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("mask", F.lit(7)).withColumn("part", F.lit("z"))
    got = filter_audit.audit(docs(spark, rows), table).collect()
    want = brute_audit(rows, labels)
    assert {(r["part"], r["filter_order"], r["step"]): [r[c] for c in filter_audit.COUNTS] for r in got} == want and len(got) == len(want)
    assert filter_audit.audit(docs(spark, rows).limit(0), table).count() == 0
    assert filter_audit.audit(docs(spark, rows), table.limit(0)).agg(F.sum("good_lost"), F.sum("removed") > 0).first()[0] == 0


@given(st.lists(st.integers(0, 10**12), min_size=32, max_size=32))
@settings(max_examples=100, deadline=None)
def test_parity_sums_invert_exactly(numbers):
    numbers = np.array(numbers)
    sign = np.array([[1 - 2 * ((w & m).bit_count() & 1) for m in range(32)] for w in range(32)])
    assert (filter_audit.cells(sign @ numbers) == numbers).all()


def test_other_sums_are_refused():
    with pytest.raises(ValueError):
        filter_audit.cells(np.arange(32))


# Licenses

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lowered(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def test_phrases_stand_word_for_word(spark):
    rng = random.Random(2)
    vocabulary = "gnu general public license apache cc by mit of the".split()
    rows = [(i, rng.choice([" ", "-", "\n", "É "]).join(rng.choice(vocabulary) for _ in range(rng.randrange(40))), "a") for i in range(150)]
    rows += [(200, None, "a"), (201, "", "a"), (202, "cc", "a"), (203, "MIT_License", None), (None, "CC-BY", "a"), (None, "CC-BY", "a"), (203, "x", "a")]
    rows += [(204, "filler " * 300_000 + "mit license " + "filler\n" * 300_000 + "Apache  License", "a"), (205, "éMIT license mit license", "a"), (206, "mit\x00license", "a")]
    got = sorted(map(repr, (tuple(r[c] for c in ("doc_id", "n_words", "places", "first_word", "last_word", "base_labels")) for r in licenses.scan(docs(spark, rows), notices=()).collect())))
    want = []
    for d, t, _ in rows:
        words = lowered(t)
        starts = [(i, x.label) for x in licenses.PHRASES for i in range(len(words)) if words[i : i + len(x.text.split())] == x.text.split()]
        want.append((d, len(words), len(starts), min(starts)[0] if starts else None, max(starts)[0] if starts else None, sorted({label for _, label in starts})))
    assert got == sorted(map(repr, want))
    assert licenses.scan(docs(spark, rows).limit(0)).count() == 0


def test_notices_may_differ_in_some_words(spark):
    notice = next(t.text for t in licenses.NOTICES if t.label == "bsd").split()
    other = notice[:]
    other[9:9] = ["changed", "words"]  # two words more
    less = notice[:6] + notice[7:]
    mangled = [w if i % 4 else "zzz" for i, w in enumerate(notice)]
    twice = ["a", *notice, "b", "c", *other, "d"]
    rows = [(1, notice), (2, other), (3, less), (4, mangled), (5, twice), (6, notice[:8]), (7, ["Permission,", *notice[::-1]])]
    got = {r["doc_id"]: r for r in licenses.scan(docs(spark, [(d, " ".join(w).upper(), "a") for d, w in rows])).collect()}
    assert {d: r["labels"] for d, r in got.items()} == {1: ["bsd"], 2: ["bsd"], 3: ["bsd"], 4: [], 5: ["bsd"], 6: [], 7: []}
    assert [(s["start"], s["end"]) for s in got[5]["spans"]] == [(1, 1 + len(notice)), (3 + len(notice), 3 + len(notice) + len(other))]
    assert got[1]["score"] == 1 and 0.8 <= got[2]["score"] < 1 and got[4]["score"] == 0 and got[1]["base_labels"] == []
    assert [(s["start"], s["end"]) for s in got[3]["spans"]] == [(0, len(less))]


def test_template_table_is_bounded(spark):
    with pytest.raises(ValueError):
        licenses.template_grams([licenses.Template("x", "one", True)])
    many = licenses.Template("x", " ".join(str(i) for i in range(licenses.MOST_GRAMS + 10)), True)
    with pytest.raises(ValueError):
        licenses.template_grams([many])


# Periodic runs


def brute_runs(ids):
    n, out = len(ids), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and ids[j] == ids[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(6, 4 * q) and not any(all(ids[x] == ids[x + d] for x in range(i, i + length - d)) for d in range(1, q)):
                out.append((i, length, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


@given(st.lists(st.tuples(st.lists(st.integers(0, 3), min_size=1, max_size=24), st.integers(1, 40)), max_size=6))
@settings(max_examples=300, deadline=None)
def test_runs_of_numbers(parts):
    ids = [x for block, n in parts for x in (block * n)[: 4 * len(block) + n]]
    assert periodic.runs(np.array(ids, dtype=np.int32)) == brute_runs(ids)


def test_all_words_equal_and_long_texts():
    assert periodic.runs(np.zeros(100_000, dtype=np.int32)) == [(0, 100_000, 1)]
    ids = np.random.default_rng(1).permutation(300_000).astype(np.int32)
    assert periodic.runs(ids) == []
    ids[5000:5900] = np.tile(ids[5000:5100], 9)
    assert periodic.runs(ids) == [(5000, 900, 100)]


def brute_row(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and n:
        a = (h // 10) % n
        p = 1 + (n - a) // (3 + h // 10 % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = brute_runs(words)
    gone = {i for s, m, q in found for i in range(s + q, s + m)}
    best = max(found, key=lambda r: (r[1], -r[0], -r[2]), default=None)
    four = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (doc_id, len(found), *four, sha("".join(f"{s},{m},{q}\n" for s, m, q in found)), sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


def test_runs_query(spark, tmp_path):
    rng = random.Random(7)
    rows = [(i, " ".join(rng.choice(["a", "b", "ab", "ü"]) for _ in range(rng.randrange(120))), "a") for i in range(200)]
    rows += [(300, None, "a"), (301, " \t", "a"), (None, "x y " * 30, "a"), (None, "x y " * 30, "a"), (5, "q " * 50, "a"), (5, "q " * 50, "a"), (302, "u v w " * 20, "a")]
    docs(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op13_runs(spark, str(tmp_path)).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(repr(brute_row(d, t)) for d, t, _ in rows)
    assert sum(zlib.crc32(str(d).encode()) % 10 == 0 for d, _, _ in rows) > 5
    assert periodic.find_runs(docs(spark, rows).limit(0)).count() == 0
    plain = {r["doc_id"]: r for r in periodic.find_runs(docs(spark, [(1, "one two " * 200_000, "a")])).collect()}
    assert (plain[1]["start"], plain[1]["length"], plain[1]["period"], plain[1]["exponent_milli"]) == (0, 400_000, 2, 200_000_000)


@pytest.mark.skipif(not Path(SF).exists(), reason="no test data")
def test_runs_of_test_documents(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect() if len(r["text"] or "") < 6000]
    got = {r["doc_id"]: tuple(r) for r in queries.op13_runs(spark, SF).collect()}
    assert all(got[d] == brute_row(d, t) for d, t in rows) and len(rows) > 100
