"""Integrity checks as violation tables: detections, segments, groups, plans, decisions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievewright.functions.identity import canonical_digest, canonical_json
from sievewright.operators import spans

#: Vehicle classes, operation and sampler of plans, tolerances.
CLASSES = (3, 4, 6, 8)
OPERATION, SAMPLER, PLAN_SCHEMA = "relocation", "accident_group_v1", "2.0"
POINT_TOLERANCE, REGION_TOLERANCE = 1e-8, 1e-4
LEAST_SCORE, LEAST_MASK, LEAST_AREA = 0.5, 0.5, 32
#: Rows of one step of a collection's digest.
BLOCK = 4096


def detected(rows: DataFrame, least_score: float = LEAST_SCORE, least_area: int = LEAST_AREA) -> DataFrame:
    """Detections of a vehicle class with enough score and area."""
    return rows.where(F.col("class_id").isin(*CLASSES) & (F.col("score") >= least_score) & (F.col("area") >= least_area))


def thresholded(pixels: DataFrame, least: float = LEAST_MASK) -> DataFrame:
    """Pixels of a mask probability map that belong to the mask. NaN never does."""
    return pixels.where(~F.isnan("probability") & (F.col("probability") >= least))


def segment_errors(segments: DataFrame, masks: DataFrame) -> DataFrame:
    """(source_id, segment_id, error): repeated ids, unknown classes, empty masks."""
    keys = ["source_id", "segment_id"]
    repeated = segments.groupBy(*keys).count().where("count > 1").select(*keys, F.lit("repeated").alias("error"))
    unknown = segments.where(~F.col("class_id").isin(*CLASSES)).select(*keys, F.lit("class").alias("error"))
    empty = segments.select(*keys).distinct().join(masks.select(*keys).distinct(), keys, "left_anti").select(*keys, F.lit("empty").alias("error"))
    return repeated.unionByName(unknown).unionByName(empty)


def selection_errors(groups: DataFrame, selections: DataFrame) -> DataFrame:
    """(source_id, error): a group must still be what its selection says.

    ``groups``: source_id, member_ids (array), selection_sha256; ``selections``: source_id, record (JSON text with a list of
    decisions, each with segment_id and selected). missing: no selection; digest: the record's canonical digest isn't the
    stored one; members: the selected segments, in their order, aren't the group's members.
    """
    decisions = F.from_json("record", "decisions array<struct<segment_id: string, selected: boolean>>")["decisions"]
    chosen = F.transform(F.filter(decisions, lambda d: d["selected"]), lambda d: d["segment_id"])
    told = selections.select(F.col("source_id").alias("_s"), canonical_digest("record").alias("_digest"), chosen.alias("_chosen"))
    met = groups.join(told, F.col("source_id") == F.col("_s"), "left")
    checks = {"missing": F.col("_s").isNull(), "digest": ~F.col("selection_sha256").eqNullSafe(F.col("_digest")), "members": ~F.col("member_ids").eqNullSafe(F.col("_chosen"))}
    found = F.array_compact(F.array(*(F.when(wrong, name) for name, wrong in checks.items() if name != "missing")))
    return met.select("source_id", F.explode(F.when(checks["missing"], F.array(F.lit("missing"))).otherwise(found)).alias("error"))


def group_errors(groups: DataFrame, members: DataFrame, masks: DataFrame, stored: DataFrame) -> DataFrame:
    """(source_id, error): the stored mask of a group must be the union of all its members' masks, and so its area.

    ``groups``: source_id, area; ``members``: source_id, segment_id; ``masks``: runs of segments; ``stored``: runs of
    group masks.
    """
    union = spans.union(masks.join(members, ["source_id", "segment_id"], "left_semi"), "source_id")
    unequal = spans.differs(union, stored, "source_id").select("source_id").distinct().withColumn("error", F.lit("mask"))
    area = union.groupBy("source_id").agg(F.sum(F.col("x1") - F.col("x0")).alias("true_area"))
    wrong = groups.join(area, "source_id", "left").where(~F.col("area").eqNullSafe(F.col("true_area"))).select("source_id", F.lit("area").alias("error"))
    missing = members.join(masks.select("source_id", "segment_id").distinct(), ["source_id", "segment_id"], "left_anti").select("source_id", F.lit("member").alias("error")).distinct()
    return unequal.unionByName(wrong).unionByName(missing)


def member_changes(planned: DataFrame, cached: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Members that only one side has, or whose values differ; nulls are equal to nulls."""
    a, b = planned.alias("a"), cached.alias("b")
    on = F.lit(True)
    for k in keys:
        on = on & (F.col(f"a.{k}") == F.col(f"b.{k}"))
    same = F.lit(True)
    for v in values:
        same = same & F.col(f"a.{v}").eqNullSafe(F.col(f"b.{v}"))
    first = keys[0]
    change = F.when(F.col(f"b.{first}").isNull(), "removed").when(F.col(f"a.{first}").isNull(), "added").when(~same, "changed")
    met = a.join(b, on, "full_outer").withColumn("change", change)
    return met.where("change is not null").select(*(F.coalesce(f"a.{k}", f"b.{k}").alias(k) for k in keys), "change")


def _near(a: Column, b: Column, tolerance: float) -> Column:
    return F.coalesce(F.abs(a - b) <= tolerance, F.lit(False))


def plan_error() -> Column:
    """Why a plan is invalid, by the first check that fails; null if it is valid.

    Expects the plan's columns (schema_version, source_id, operation, sampler, anchor, sx, sy, tx, ty, dx, dy, area,
    fraction, grid, segment_id, mask_path, mask_sha256), its source's (of_source, width, height), the group that the
    source's selection holds (group_id, group_path, group_sha256, chosen: whether the plan's group equals it), and what was
    computed again from the group's mask (same_mask: whether the plan's mask equals it; cx, cy, true_area, true_grid).
    """
    finite = lambda c: F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))
    inside = lambda x, y: (F.col(x) >= 0) & (F.col(x) < F.col("width")) & (F.col(y) >= 0) & (F.col(y) < F.col("height"))
    equal = lambda a, b: F.col(a).eqNullSafe(F.col(b))
    fixed = F.col("schema_version").eqNullSafe(F.lit(PLAN_SCHEMA)) & F.col("operation").eqNullSafe(F.lit(OPERATION)) & F.col("sampler").eqNullSafe(F.lit(SAMPLER))
    return (
        F.when(~(fixed & equal("source_id", "of_source") & F.col("anchor").isNull()), "schema")
        .when(~(finite("sx") & finite("sy") & finite("tx") & finite("ty")), "point")
        .when(~(inside("sx", "sy") & inside("tx", "ty")), "outside")
        .when(~F.coalesce("chosen", F.lit(False)), "selection")
        .when(~(equal("segment_id", "group_id") & equal("mask_path", "group_path") & equal("mask_sha256", "group_sha256")), "identity")
        .when(~F.coalesce("same_mask", F.lit(False)), "mask")
        .when(~(_near(F.col("sx"), F.col("cx"), POINT_TOLERANCE) & _near(F.col("sy"), F.col("cy"), POINT_TOLERANCE)), "centroid")
        .when(~(_near(F.col("tx") - F.col("sx"), F.col("dx"), POINT_TOLERANCE) & _near(F.col("ty") - F.col("sy"), F.col("dy"), POINT_TOLERANCE)), "displacement")
        .when(~F.col("grid").eqNullSafe(F.col("true_grid")), "geometry")
        .when(~F.col("area").eqNullSafe(F.col("true_area")), "area")
        .when(~_near(F.col("fraction"), F.col("area") / (F.col("width") * F.col("height")), 1e-9), "fraction")
    )


#: What a generator calls an operation.
TASKS = {"relocation": "transformation", "deformation": "deformation", "rotation": "rotation"}


def instruction(operation: Column, source: Column, target: Column, anchor: Column, before: Column, after: Column) -> Column:
    """A plan as the generator is told it; an operation without a task is an error."""
    tasks = F.create_map(*(F.lit(x) for pair in TASKS.items() for x in pair))
    task = F.coalesce(F.try_element_at(tasks, operation), F.raise_error(F.concat(F.lit("no task for operation "), F.coalesce(operation, F.lit("null")))).cast("string"))
    region = F.struct(task.alias("task"), F.array(source, target).alias("centroids"), anchor.alias("anchors"))
    return F.struct(region.alias("region"), before.alias("background_prompt"), F.concat(F.lit(" "), after).alias("editing_prompt"))


def changed_sources(saved: DataFrame, now: DataFrame) -> DataFrame:
    """(source_id, error): sources of a snapshot that are missing, or whose files or pixels hash otherwise now."""
    again = now.select("source_id", F.col("file_sha256").alias("_file"), F.col("pixel_sha256").alias("_pixels"))
    error = F.when(F.col("_pixels").isNull(), "missing").when(F.col("_pixels") != F.col("pixel_sha256"), "pixels").when(F.col("_file") != F.col("file_sha256"), "file")
    return saved.join(again, "source_id", "left").select("source_id", error.alias("error")).where("error is not null")


def geometry_error() -> Column:
    """Why what the generator reports differs from the plan; null if it doesn't.

    Expects drag_pixels, grid_w, grid_h, points of the plan on the grid (sx, sy, tx, ty) and the effective ones with
    an ``e_`` before the name, region and e_region.
    """
    inside = lambda x, y: (F.col(x) >= 0) & (F.col(x) < F.col("grid_w")) & (F.col(y) >= 0) & (F.col(y) < F.col("grid_h"))
    same = F.lit(True)
    for c in ("sx", "sy", "tx", "ty"):
        same = same & F.col(c).eqNullSafe(F.col(f"e_{c}"))
    return (
        F.when(F.coalesce("drag_pixels", F.lit(0)) <= 0, "empty")
        .when(~(inside("e_sx", "e_sy") & inside("e_tx", "e_ty")), "outside")
        .when(~same, "points")
        .when(~_near(F.col("region"), F.col("e_region"), REGION_TOLERANCE), "region")
    )


def criteria_errors(criteria: dict, policy: dict) -> list[str]:
    """What is wrong with a criteria document: policy constants, ids 1 to 5 in order, ten distinct captions."""
    pairs = criteria.get("pairs", [])
    captions = [p.get(side) for p in pairs for side in ("undesired", "preferred")]
    found = [f"policy: {k}" for k, v in policy.items() if canonical_json(criteria.get("policy", {}).get(k)) != canonical_json(v)]
    if [p.get("id") for p in pairs] != [1, 2, 3, 4, 5]:
        found.append("ids")
    if len(captions) != 10 or not all(isinstance(c, str) and c.strip() for c in captions) or len(set(captions)) != 10:
        found.append("captions")
    return found


def interleaved(captions: DataFrame, position: str) -> DataFrame:
    """A flat caption list as pairs: even positions undesired, odd ones preferred."""
    at = F.col(position)
    return captions.withColumn("id", F.floor(at / 2).cast("int") + 1).withColumn("side", F.when(at % 2 == 0, "undesired").otherwise("preferred"))


def collection_digest(rows: DataFrame, order: list[str], value: str) -> DataFrame:
    """One row: a digest of values in order, over block digests.

    Blocks of the order are hashed apart; their digests are hashed in order, in blocks again as long as there are more
    than a block of them, so no task holds more than a block. ``order`` starts with an integer column; rows that tie on
    it make their block larger.
    """
    hashed = lambda fields, last: F.sha2(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(*fields))), lambda x: x[last]), ",").cast("binary"), 256)
    blocks = rows.groupBy(F.floor(F.col(order[0]) / BLOCK).alias("block")).agg(hashed([*order, value], value).alias("d"))
    span = rows.agg(F.max(order[0]) - F.min(order[0])).first()[0] or 0
    while span > BLOCK * BLOCK:
        blocks = blocks.groupBy(F.floor(F.col("block") / BLOCK).alias("block")).agg(hashed(["block", "d"], "d").alias("d"))
        span //= BLOCK
    return blocks.agg(hashed(["block", "d"], "d").alias("digest"))


def resume_errors(saved: dict, now: dict, keys: tuple[str, ...] = ("recipe_sha256", "implementation_sha256", "sources_sha256", "backend")) -> list[str]:
    """Keys in which a saved run differs from the present one; a run resumes only if there are none."""
    return [k for k in keys if saved.get(k) != now.get(k)]
