"""Secret scans: patterns and a randomness test battery. DataFrame functions only.

Patterns give the base spans: assignments to a secret's name, access keys, runs of hexadecimal digits. The battery adds
spans of tokens that are far more random than written words of their length:

* the encoding of a token is inferred from its characters (digits, hex, base32, letters of one case, base64);
* chi-squared: its statistic against a uniform alphabet, compared with what a word's letter frequencies would give;
* runs: the number of runs of like characters (lower case, upper case, digits, others) against that of words; where
  that is constant, in letters of one case, the number of runs of vowels and of others, which words have more of, and in
  digits alone no test of runs;
* serial correlation: the correlation of neighbours (vowel or not), which is negative in words, against that of words.

Each gives a z-score under "the token is written language", whose mean and variance depend on the token's length. The
combined (Stouffer) p-value enters a false-discovery control (Benjamini-Hochberg) within length classes, over all
tokens of the corpus: p-values are counted in bins of a fixed number, so the threshold of a class comes from a
pre-aggregated table of at most classes x bins rows, whatever the size of the corpus.

The battery meets tokens of 20 characters or more; shorter ones are left to the patterns, as no test tells them from words.

Positions are code points, end exclusive. Ties: spans that start together go in the order of KINDS. Very long texts are
scanned whole; finding positions of many matches in one text takes n log n. A row's work is linear in its text for texts without findings; nothing is
shuffled but the binned counts. Null text is empty and has no spans; ids and other columns play no part and pass
through (an input column named ``spans`` is replaced). Repeated rows are scanned alike; they count in the p-value
bins like any others. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The base patterns, fixed values.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
ASSIGN_LEAST = 12
#: Tokens that the battery tests.
TOKEN = r"[A-Za-z0-9+/_-]{20,}={0,2}"
KINDS = ("assign", "access", "hex", "random")

FDR, BINS, BIN_WIDTH = 0.001, 400, 0.1
#: Inferred encodings: pattern, alphabet size, chance that two letters of written text in it agree.
ENCODINGS = (
    ("digits", r"^[0-9]+$", 10, 0.13),
    ("hex", r"^(?:[0-9a-f]+|[0-9A-F]+)$", 16, 0.12),
    ("base32", r"^[A-Z2-7]+=*$", 32, 0.075),
    ("lower", r"^[a-z]+$", 26, 0.068),
    ("base64", r".", 64, 0.062),
)
#: Written text: chance that neighbours are of different kinds, correlation of neighbouring vowels.
SWITCH, VOWEL_CORRELATION = 0.12, -0.35
#: Chance that neighbours in written words are a vowel and another letter: the least of four languages (0.53 to 0.70).
VOWEL_SWITCH = 0.53

_SPAN = "array<struct<kind:string,start:int,end:int>>"


def _running(sizes: Column) -> Column:
    """Running sums of an array in log2(n) passes: pass k adds what stands 2^k places before."""
    n = F.size(sizes)
    passes = F.when(n > 1, F.sequence(F.lit(0), F.ceil(F.log2(n.cast("double"))).cast("int") - 1)).otherwise(F.array().cast("array<int>"))

    def shifted(acc: Column, k: Column) -> Column:
        step = F.least(F.pow(F.lit(2.0), k).cast("int"), F.size(acc))
        return F.concat(F.array_repeat(F.lit(0), step), F.slice(acc, F.lit(1), F.size(acc) - step))

    return F.aggregate(passes, sizes, lambda acc, k: F.zip_with(acc, shifted(acc, k), lambda x, y: x + y))


def _finds(text: Column, pattern: str, kind: str, values: Column | None = None, least: int = 0) -> Column:
    """Spans of all leftmost, non-overlapping matches; ``values``: of each match, the part that must be ``least`` long."""
    gaps = F.split(text, pattern, -1)
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    size = lambda x: F.coalesce(F.length(x), F.lit(0))
    parts = F.arrays_zip(gaps.alias("gap"), hits.alias("hit"), (hits if values is None else values).alias("value"))
    lengths = F.transform(parts, lambda x: F.struct(size(x["gap"]).alias("gap"), size(x["hit"]).alias("hit"), size(x["value"]).alias("value")))
    ends = _running(F.transform(lengths, lambda x: x["gap"] + x["hit"]))
    spans = F.zip_with(lengths, ends, lambda x, end: F.struct(F.lit(kind).alias("kind"), (end - x["hit"]).alias("start"), end.alias("end"), ((x["hit"] > 0) & (x["value"] >= least)).alias("good")))
    return F.transform(F.filter(spans, lambda x: x["good"]), lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end")))


def _none() -> Column:
    return F.array().cast(_SPAN)


def _when(text: Column, pattern: str, spans: Column) -> Column:
    return F.when(text.rlike(pattern), spans).otherwise(_none())


def _phi(z: Column) -> Column:
    """Normal distribution function, logistic approximation (its tails are wide, so p-values err to the safe side)."""
    z = F.greatest(F.lit(-12.0), F.least(F.lit(12.0), z))
    # Bound by a lambda, so that z is computed once.
    return F.transform(F.array(z), lambda z: F.lit(1.0) / (F.lit(1.0) + F.exp(-(F.lit(1.5976) * z + F.lit(0.07056) * z * z * z))))[0]


def p_value(token: Column) -> Column:
    """Chance that written language looks as random as the token (column of string)."""
    core = F.regexp_replace(token, "=+$", "")
    n = F.length(core).cast("double")
    pick = lambda i: _choose(core, [e[i] for e in ENCODINGS])
    size, agree = pick(2), pick(3)
    letters = F.split(core, "")
    squares = F.aggregate(F.array_distinct(letters), F.lit(0.0), lambda s, c: s + F.pow(n - F.length(F.replace(core, c, F.lit(""))).cast("double"), F.lit(2.0)))
    chi = size / n * squares - n
    excess = F.greatest(F.lit(0.05), size * agree - 1)
    z_chi = -(chi - (size - 1) - n * excess) / F.sqrt(2 * (size - 1) + 4 * n * excess)
    runs = F.regexp_count(core, F.lit("[a-z]+|[A-Z]+|[0-9]+|[^A-Za-z0-9]+")).cast("double")
    z_runs = (runs - 1 - (n - 1) * SWITCH) / F.sqrt((n - 1) * SWITCH * (1 - SWITCH))
    vowel_runs = F.regexp_count(core, F.lit("[aeiouAEIOU]+|[^aeiouAEIOU]+")).cast("double")
    z_vowels = ((n - 1) * VOWEL_SWITCH - (vowel_runs - 1)) / F.sqrt((n - 1) * VOWEL_SWITCH * (1 - VOWEL_SWITCH))
    vowel = F.transform(letters, lambda c: F.lower(c).isin(*"aeiou").cast("double"))
    mean = F.aggregate(vowel, F.lit(0.0), lambda s, v: s + v) / n
    both = F.zip_with(F.slice(vowel, F.lit(1), F.size(vowel) - 1), F.slice(vowel, F.lit(2), F.size(vowel) - 1), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    shared = F.aggregate(both, F.lit(0.0), lambda s, x: s + (x["a"] - mean) * (x["b"] - mean))
    spread = n * mean * (1 - mean)
    z_serial = F.when(spread > 0.5, (shared / spread - VOWEL_CORRELATION) * F.sqrt(n)).otherwise(F.lit(0.0))
    several, lettered = runs > 1, core.rlike("^[A-Za-z]")
    z_kinds = F.when(several, z_runs).when(lettered, z_vowels).otherwise(F.lit(0.0))
    # Runs and correlation of vowels hang together, so their weights are added before they are squared.
    norm = F.when(several, F.lit((1 + 1.5**2 + 0.5**2) ** 0.5)).when(lettered, F.lit((1 + (1.5 + 0.5) ** 2) ** 0.5)).otherwise(F.lit(1.0))
    return F.lit(1.0) - _phi((z_chi + 1.5 * z_kinds + 0.5 * z_serial) / norm)


def _choose(core: Column, values: list) -> Column:
    out = F.lit(float(values[-1]))
    for (_, pattern, _, _), value in reversed(list(zip(ENCODINGS[:-1], values[:-1], strict=True))):
        out = F.when(core.rlike(pattern), F.lit(float(value))).otherwise(out)
    return out


def length_class(n: Column) -> Column:
    """Classes of length: up to 31, 63, 127, 255, and longer."""
    return F.least(F.lit(8), F.floor(F.log2(n.cast("double")))).cast("int")


def _bin(p: Column) -> Column:
    return F.least(F.lit(BINS - 1), F.floor(-F.log10(F.greatest(p, F.lit(1e-300))) / BIN_WIDTH)).cast("int")


def thresholds(docs: DataFrame, text: str = "text", fdr: float = FDR) -> dict[int, int]:
    """For each length class, the first bin of p-values whose tokens are discoveries. Reads all texts."""
    tokens = docs.where(F.col(text).rlike(TOKEN)).select(F.explode(F.regexp_extract_all(F.col(text), F.lit(TOKEN), F.lit(0))).alias("t"))
    table = tokens.select(length_class(F.length("t")).alias("c"), _bin(p_value(F.col("t"))).alias("b")).groupBy("c", "b").count()
    counts: dict[int, dict[int, int]] = {}
    for row in table.collect():  # at most classes x bins rows
        counts.setdefault(row["c"], {})[row["b"]] = row["count"]
    out = {}
    for c, by_bin in counts.items():
        total, seen = sum(by_bin.values()), 0
        for b in sorted(by_bin, reverse=True):
            seen += by_bin[b]
            if 10 ** (-b * BIN_WIDTH) * total / seen <= fdr:
                out[c] = b
    return out


def scan(docs: DataFrame, text: str = "text", fdr: float = FDR) -> DataFrame:
    """The columns of ``docs`` and spans: array of (kind, start, end) ordered by start, then as KINDS lists them."""
    cut = thresholds(docs, text, fdr)
    body = F.coalesce(F.col(text), F.lit(""))
    base = F.concat(
        _when(body, ASSIGN, _finds(body, ASSIGN, "assign", F.regexp_extract_all(body, F.lit(ASSIGN), F.lit(2)), ASSIGN_LEAST)),
        _when(body, ACCESS, _finds(body, ACCESS, "access")),
        _when(body, HEX, _finds(body, HEX, "hex")),
    )
    rows = docs.withColumn("spans", base)
    if cut:

        def found(x: Column) -> Column:
            token = F.substring(body, x["start"] + 1, x["end"] - x["start"])
            limit = F.lit(BINS)
            for c, b in cut.items():
                limit = F.when(length_class(F.length(token)) == c, F.lit(b)).otherwise(limit)
            clear = ~F.exists("spans", lambda y: (y["start"] < x["end"]) & (x["start"] < y["end"]))
            return clear & (_bin(p_value(token)) >= limit)

        rows = rows.withColumn("spans", F.concat("spans", _when(body, TOKEN, F.filter(_finds(body, TOKEN, "random"), found))))
    place = lambda s: F.array_position(F.array(*(F.lit(k) for k in KINDS)), s["kind"])
    order = lambda a, b: F.when(a["start"] != b["start"], a["start"] - b["start"]).otherwise((place(a) - place(b)).cast("int"))
    return rows.withColumn("spans", F.array_sort("spans", order))


def joined(spans: Column) -> Column:
    """Spans as kind:start:end, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(docs: DataFrame, text: str = "text", mark: str = "[SECRET]", fdr: float = FDR) -> DataFrame:
    """``docs`` with every span replaced by ``mark``; spans that overlap are replaced together."""
    rows = scan(docs, text, fdr)
    body = F.col(text)
    first = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        ahead = s["start"] >= acc["at"]
        piece = F.concat(acc["out"], F.substring(body, acc["at"] + 1, s["start"] - acc["at"]), F.lit(mark))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.when(ahead, piece).otherwise(acc["out"]).alias("out"))

    done = F.aggregate("spans", first, step, lambda acc: F.concat(acc["out"], F.substring(body, acc["at"] + 1, F.length(body))))
    return rows.withColumn(text, F.when(F.size("spans") > 0, done).otherwise(body)).drop("spans")
