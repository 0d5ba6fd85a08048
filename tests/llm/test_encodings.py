"""The randomness battery finds random tokens of every encoding that it lists, and no written words."""

from __future__ import annotations

import random
import string

import pytest

from sievewright.llm import secret_scan

WORDS = "the weather over northern mountains changed before evening and nobody expected another storm during the following week although several people had noticed unusual clouds".split()
TOKENS = [
    ("digits", string.digits, 1000),
    ("hex", "0123456789ABCDEF", 64),
    ("base32", string.ascii_uppercase + "234567", 64),
    ("upper case", string.ascii_uppercase, 64),
    ("lower", string.ascii_lowercase, 64),
    ("lower, long", string.ascii_lowercase, 1000),
    ("base64", string.ascii_letters + string.digits + "+/", 64),
]


@pytest.mark.parametrize("name, alphabet, n", TOKENS)
def test_random_tokens_of_each_encoding(spark, name, alphabet, n):
    rng = random.Random(3)
    rows = [(i, " ".join(["see", "".join(rng.choice(alphabet) for _ in range(n)), "here"])) for i in range(50)]
    for i in range(50, 150):  # written words without spaces, in the token's case
        text = "".join(rng.choice(WORDS) for _ in range(n))[:n]
        rows.append((i, text.upper() if alphabet[0] == "A" or alphabet[-1] == "F" else text))
    got = {r["doc_id"]: r["spans"] for r in secret_scan.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert sum(bool(got[i]) for i in range(50)) >= 40
    assert not any(got[i] for i in range(50, 150))
