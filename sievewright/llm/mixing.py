"""Mixing sources to target weights by Pareto order sampling. DataFrame functions only.

Targets: sources in code point order (null last) get weights in a repeating cycle and share ``share`` times all words;
a target stops at ``most`` times its source, and what it can't take is reshared by weight. The final level of this
water filling is found in closed form from sums over the sources, ordered by cap over weight.

Sampling: each document gets the whole part of target over source size as certain copies. The rest of the target is a
sample without replacement with unequal probabilities: a document's inclusion probability p is in proportion to a power
of two near the square root of its size (:func:`size_class`), at the level at which the expected words are the rest of
the target; documents whose p reaches 1 get one more certain copy. All others are ranked by random odds over inclusion
odds, q = (u / (1 - u)) / (p / (1 - p)), with u a random number fixed by doc_id and seed, and taken in this order up to
the first that doesn't fit the source's remaining words.

What then is left, less than one document, is filled from the others that fit: from large binary sizes to small ones, in
each of them the smallest first, so that in the end no document fits. At last the smallest document that overshoots is
taken if that brings the source nearer to its target. A few documents of a source at most are taken this way.

Scale: texts are read once and leave a short row a document. q is mapped to one of ``BUCKETS`` buckets of the source; sums
by (source, bucket) are pre-aggregated, one bucket a source holds the cut, and only the rows of that bucket, a few
thousandths of the source, are put in order. Filling looks at ``FILL`` rows of a source and binary size, the smallest (a
limit that Spark applies before it shuffles), as one short array a source, and goes on while documents fit that it hasn't
looked at. Decisions are short tables that the documents' rows meet once. Tables with a row a source, or a row a source
and size class, are joined by :func:`joined_by_count`. Ranking the sources puts one short row a source in one task.

Null text: size 0. Size 0: certain copies only. Null source: a source of its own, last. Null doc_id: u from the row's
number. Ties of q go by doc_id, then size. Very long texts are counted whole; one longer than its source's remaining
words is taken only if that is nearer to the target than leaving it out. Repeated rows are documents of their own. Other columns are ignored; ``keep`` names columns to
carry, which may not be named like those of the result or begin with an underscore. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievewright.llm.common import FREQUENT, WORD_PATTERN, joined_by_count, materialise

WEIGHTS = (5, 2, 1)
SHARE, MOST, BUCKETS, SEED = 1.5, 2.0, 4096, 17
#: Rows of a source and binary size that filling looks at in one step.
FILL = 4096


def uniform(key: Column, seed: int = SEED) -> Column:
    """A number in (0, 1) fixed by key and seed: 52 bits of MD5."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("null")))
    return (F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(1 << 52))


def targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """(source, rank, source_size, target) of rows with source and size."""
    by = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), ((F.col("rank") - 1) % len(weights) + 1).cast("int"))
    everything = Window.partitionBy()
    table = by.withColumn("rank", rank).withColumn("w", weight).withColumn("cap", F.lit(most) * F.col("source_size")).withColumn("total", F.lit(share) * F.sum("source_size").over(everything))
    order = Window.orderBy(F.col("cap") / F.col("w"), "rank")
    table = table.withColumn("w_left", F.sum("w").over(order.rowsBetween(0, Window.unboundedFollowing))).withColumn("caps_before", F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
    table = table.withColumn("capped", (F.col("total") - F.col("caps_before")) * F.col("w") >= F.col("cap") * F.col("w_left"))
    table = table.withColumn("caps", F.coalesce(F.sum(F.when(F.col("capped"), F.col("cap"))).over(everything), F.lit(0.0))).withColumn("free_w", F.sum(F.when(~F.col("capped"), F.col("w"))).over(everything))
    share_of = (F.col("total") - F.col("caps")) * F.col("w") / F.col("free_w")
    return table.select("source", "rank", "source_size", F.when(F.col("capped"), F.col("cap")).otherwise(share_of).alias("target"))


def size_class(size: Column) -> Column:
    """Half the number of a size's binary digits, rounded down; size 0 has class -1. 2 to its power is near the root."""
    return F.when(size > 0, F.floor((F.length(F.bin(size)) - 1) / 2)).otherwise(F.lit(-1)).cast("int")


def inclusion(classes: DataFrame) -> DataFrame:
    """Copies that are certain and the inclusion probability of each (source, size class): adds ``base``, ``p``, ``rest``.

    ``classes`` has rank, class, words, source_size, target. The level c with sum(min(1, c x) words) = rest, x being 2 to
    the power of the class, is found in closed form, as classes reach 1 in order of x. ``rest``: words left to draw.
    """
    rows = classes.withColumn("whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long"))
    rows = rows.withColumn("x", F.when(F.col("class") >= 0, F.pow(F.lit(2.0), F.col("class"))).otherwise(F.lit(0.0))).withColumn("extra", F.col("target") - F.col("whole") * F.col("source_size"))
    down = Window.partitionBy("rank").orderBy(F.desc("class"))
    rows = rows.withColumn("larger", F.coalesce(F.sum("words").over(down.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    rows = rows.withColumn("weighed", F.sum(F.col("x") * F.col("words")).over(down.rowsBetween(0, Window.unboundedFollowing)))
    rows = rows.withColumn("certain", (F.col("x") > 0) & ((F.col("extra") - F.col("larger")) * F.col("x") >= F.col("weighed")))
    everything = Window.partitionBy("rank")
    rows = rows.withColumn("rest", F.col("extra") - F.coalesce(F.sum(F.when(F.col("certain"), F.col("words"))).over(everything), F.lit(0)))
    rows = rows.withColumn("free", F.sum(F.when(~F.col("certain"), F.col("x") * F.col("words"))).over(everything))
    p = F.when(~F.col("certain") & (F.col("x") > 0) & (F.col("rest") > 0), F.col("rest") * F.col("x") / F.col("free"))
    return rows.withColumn("p", p).withColumn("base", F.col("whole") + F.col("certain").cast("long")).drop("whole", "x", "extra", "larger", "weighed", "certain", "free")


def _joined(rows: DataFrame, table: DataFrame, key: str, size: int, total: int, how: str = "inner") -> DataFrame:
    """``rows`` with a table of one row a key, ``size`` of them at most; column n: how many of ``total`` rows have the key."""
    if size <= FREQUENT:
        return rows.join(F.broadcast(table.drop("n")), key, how)
    return joined_by_count(rows, table, key, "n", total, how)


def _first_cut(rows: DataFrame, sources: int, total: int) -> tuple[DataFrame, DataFrame]:
    """(gaps, inside): the bucket of q that holds each source's cut, with the words left at the cut; and the rows of those
    buckets that are taken, by uid. A source without a cut takes all its rows."""
    sums = rows.groupBy("rank", "b").agg(F.sum("size").alias("words"), F.max("rest").alias("rest"), F.count("*").alias("n"))
    by = Window.partitionBy("rank").orderBy("b")
    sums = sums.withColumn("past", F.sum("words").over(by)).withColumn("n", F.sum("n").over(Window.partitionBy("rank")))
    cut = sums.where("past > rest").groupBy("rank").agg(F.min_by(F.struct("b", (F.col("rest") - F.col("past") + F.col("words")).alias("gap"), "n"), "b").alias("c"))
    cut = materialise(cut.select("rank", F.col("c.b").alias("cut"), F.col("c.gap").alias("gap"), F.col("c.n").alias("n")), "cuts")
    order = Window.partitionBy("rank").orderBy("q", F.col("doc_id").asc_nulls_last(), "size", "uid").rowsBetween(Window.unboundedPreceding, 0)
    at = _joined(rows, cut, "rank", sources, total).where("b = cut")
    inside = materialise(at.withColumn("upto", F.sum("size").over(order)).where("upto <= gap").select("uid", "rank", "size"), "inside")
    used = inside.groupBy("rank").agg(F.sum("size").alias("used"))
    gaps = cut.join(used, "rank", "left").select("rank", "cut", (F.col("gap") - F.coalesce("used", F.lit(0))).alias("gap"), "n")
    return materialise(gaps, "gaps"), inside


def _fill(left: DataFrame, gaps: DataFrame, sources: int, total: int) -> tuple[DataFrame, DataFrame, bool]:
    """(gaps, taken, more) after one step of filling: what is left of the gaps, the rows taken for it, and whether there
    were more rows of a size than the step looks at."""
    fits = _joined(left, gaps.select("rank", "gap", "n"), "rank", sources, total).where("size <= gap").withColumn("bits", F.length(F.bin("size")))
    rising = Window.partitionBy("rank", "bits").orderBy("size", "q", F.col("doc_id").asc_nulls_last(), "uid")
    some = fits.withColumn("nth", F.row_number().over(rising)).where(F.col("nth") <= FILL)
    some = some.withColumn("upto", F.sum("size").over(rising.rowsBetween(Window.unboundedPreceding, 0)))
    some = materialise(some.select("uid", "rank", "size", "bits", "upto", "gap", "nth"), "fitting")
    sizes = some.groupBy("rank", "bits").agg(F.sort_array(F.collect_list("upto")).alias("upto"), F.max("gap").alias("gap"))
    sizes = sizes.groupBy("rank").agg(F.sort_array(F.collect_list(F.struct("bits", "upto")), asc=False).alias("sizes"), F.max("gap").alias("gap"))

    def step(acc: Column, s: Column) -> Column:
        last = F.coalesce(F.array_max(F.filter(s["upto"], lambda u: u <= acc["gap"])), F.lit(0).cast("long"))
        return F.struct((acc["gap"] - last).alias("gap"), F.map_concat(acc["upto"], F.create_map(s["bits"], last)).alias("upto"))

    nothing = F.struct(F.col("gap").alias("gap"), F.create_map().cast("map<int,bigint>").alias("upto"))
    filled = materialise(sizes.select("rank", F.aggregate("sizes", nothing, step).alias("f")).select("rank", "f.gap", "f.upto"), "filled")
    taken = some.join(filled.select("rank", F.explode("upto").alias("bits", "last")), ["rank", "bits"]).where("upto <= last").select("uid", "rank", "size")
    after = gaps.join(filled.select("rank", F.col("gap").alias("now")), "rank", "left").select("rank", "cut", F.coalesce("now", "gap").alias("gap"), "n")
    return after, taken, not some.where(F.col("nth") == FILL).isEmpty()


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST, seed: int = SEED, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row a document: uid, doc_id, source, size, source_size, target, p (null: not drawn), copies (how often the mix takes it).

    ``uid`` numbers the rows of this call; it tells repeated rows apart. ``keep`` names short columns to carry along.
    """
    size = F.coalesce(F.regexp_count("text", F.lit(WORD_PATTERN)), F.lit(0)).cast("long")
    sized = docs.select("doc_id", "source", *keep, size.alias("size")).withColumn("uid", F.monotonically_increasing_id()).withColumn("class", size_class(F.col("size")))
    key = F.concat_ws(":", F.col("class"), F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n")))
    sized = materialise(sized.withColumn("key", key), "sizes")
    by = materialise(sized.groupBy("source", "class", "key").agg(F.sum("size").alias("words"), F.count("*").alias("n")), "classes")
    goal = targets(by.withColumnRenamed("words", "size"), weights, share, most).withColumnRenamed("source", "of")
    classes, total = by.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    table = inclusion(by.join(F.broadcast(goal) if classes <= FREQUENT else goal, F.col("source").eqNullSafe(F.col("of"))).drop("of", "source"))

    out = [F.col(c) for c in ("uid", "doc_id", "source", "size", "source_size", "target", "p", "copies", *keep)]
    rows = _joined(sized, table.drop("class", "words"), "key", classes, total)
    u = uniform(F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("null:"), F.col("uid").cast("string"))), seed)
    rows = rows.withColumn("q", F.when(F.col("p").isNotNull(), (u / (F.lit(1.0) - u)) / (F.col("p") / (F.lit(1.0) - F.col("p")))))
    rows = materialise(rows.withColumn("b", F.floor(F.lit(float(BUCKETS)) * (F.col("q") / (F.lit(1.0) + F.col("q"))))).drop("key", "class"), "ranked")
    drawn = rows.where("q is not null").select("uid", "doc_id", "rank", "size", "q", "b", "rest")
    # A source has a class at least, so there are no more sources than classes.
    gaps, taken = _first_cut(drawn, classes, total)
    # Rows at the cut or beyond it, which taken ones leave.
    past = _joined(drawn, gaps.select("rank", "cut", "n"), "rank", classes, total).where("b >= cut").drop("cut")
    more = True
    while more:
        left = past.join(taken.select("uid"), "uid", "left_anti")
        gaps, found, more = _fill(left, gaps, classes, total)
        taken = taken.unionByName(found)
    left = past.join(taken.select("uid"), "uid", "left_anti")
    over = _joined(left, gaps.select("rank", "gap", "n"), "rank", classes, total).where("size > gap and size - gap < gap")
    over = over.groupBy("rank").agg(F.min(F.struct("size", "q", "doc_id", "uid")).alias("o")).select(F.col("o.uid").alias("uid"))
    taken = materialise(taken.select("uid").unionByName(over).withColumn("late", F.lit(True)), "taken")
    rows = _joined(rows, gaps.select("rank", "cut", "n"), "rank", classes, total, "left")
    early = F.col("q").isNotNull() & (F.col("cut").isNull() | (F.col("b") < F.col("cut")))
    copies = F.col("base") + (early | F.coalesce("late", F.lit(False))).cast("long")
    few = taken.limit(FREQUENT + 1).count() <= FREQUENT
    return rows.join(F.broadcast(taken) if few else taken.hint("merge"), "uid", "left").withColumn("copies", copies).select(*out)
