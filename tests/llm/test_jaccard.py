"""The pipeline's near-duplicate stage: Jaccard similarity of 5-word shingles, 0.8 or more."""

from __future__ import annotations

import random

import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")


def brute_shingles(text, k=5):
    words = (text or "").lower().split()
    return {tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def similarity(a, b):
    a, b = brute_shingles(a), brute_shingles(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def brute_kept(rows):
    at = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if similarity(rows[i][1], rows[j][1]) >= 0.8:
                at = [at[j] if x == at[i] else x for x in at]
    first = [min((rows[i][0] is None, rows[i][0] or 0, i) for i in range(len(rows)) if at[i] == c)[2] for c in set(at)]
    return sorted((str(rows[i][0]), rows[i][1] or "") for i in first)


def replaced(rng, text, n):
    words = text.split()
    for i in rng.sample(range(0, len(words), 7), n):
        words[i] = f"new{rng.randrange(10**9)}"
    return " ".join(words)


def kept(spark, rows):
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    return sorted((str(r["doc_id"]), r["text"] or "") for r in corpus_pipeline.near_duplicates(spark, docs, "").collect())


def test_copies_at_the_similarity_go(spark):
    rng = random.Random(5)
    base = [" ".join(f"w{rng.randrange(5000)}" for _ in range(300)) for _ in range(20)]
    rows = list(enumerate(base))
    for n in (1, 3, 5, 6):  # 0.97 to 0.82
        rows += [(1000 * n + i, replaced(rng, t, n)) for i, t in enumerate(base)]
    got = kept(spark, rows)
    assert got == brute_kept(rows)
    assert len(got) == len(base)


def test_texts_below_the_similarity_stay(spark):
    rng = random.Random(6)
    base = [" ".join(f"w{rng.randrange(5000)}" for _ in range(300)) for _ in range(20)]
    rows = list(enumerate(base)) + [(100 + i, replaced(rng, t, 8)) for i, t in enumerate(base)]
    assert 0.7 < similarity(rows[0][1], rows[20][1]) < 0.8
    assert len(kept(spark, rows)) == 40


def test_components_against_brute_force(spark):
    rng = random.Random(7)
    rows = [(None, "one two three"), (3, "One two  THREE"), (4, None), (5, " "), (6, "a b c d e f"), (6, "other text of the same id here")]
    for group in range(5):
        texts = [" ".join(f"g{group}w{rng.randrange(900)}" for _ in range(120))]
        for _ in range(11):  # chains, whose ends are not alike
            texts.append(replaced(rng, rng.choice(texts[-3:]), rng.randrange(1, 4)))
        rng.shuffle(texts)
        rows += [(10 + 100 * group + i, t) for i, t in enumerate(texts)]
    assert kept(spark, rows) == brute_kept(rows)


@pytest.mark.parametrize("block", [3, 1000])
def test_buckets_that_no_hub_joins(spark, block):
    from sievewright.llm import jaccard

    rng = random.Random(8)
    base = " ".join(f"w{i}" for i in range(140))
    texts = [replaced(rng, base, rng.randrange(0, 7)) for _ in range(40)]
    left = spark.createDataFrame([(1, i, i, 40) for i in range(40)], "key long, node long, component long, members long")
    sets = jaccard.hashed(spark.createDataFrame(list(enumerate(texts)), "node long, text string"))
    at = list(range(40))
    for r in jaccard.compared(left, sets, block).collect():
        assert similarity(texts[r["a"]], texts[r["b"]]) >= 0.8
        at = [at[r["a"]] if x == at[r["b"]] else x for x in at]
    want = list(range(40))
    for i in range(40):
        for j in range(i):
            if similarity(texts[i], texts[j]) >= 0.8:
                want = [want[j] if x == want[i] else x for x in want]
    assert [at.index(x) for x in at] == [want.index(x) for x in want]
