"""Selection of involved segments: touching masks form groups, and a group is selected if every view prefers it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievewright.operators import contacts, spans
from sievewright.operators.scoring import SELECTOR_BOUND, score_error

#: Captions of a view: a pair for a segment alone, a pair for a group.
CAPTIONS = 4


def groups(masks: DataFrame, frame: str, segment: str) -> DataFrame:
    """(frame, segment, group, members): segments that touch or overlap, directly or through others, share a group.

    ``masks``: runs (frame, segment, y, x0, x1). A group is named by its smallest segment.
    """
    return spans.together(masks, frame, segment)


def associations(grouped: DataFrame, scores: DataFrame, frame: str) -> DataFrame:
    """(frame, group, members, caption_pair, views, least_margin, selected, error) of each group.

    ``scores``: frame, group, view, scores (four of them). A group of one segment is judged by the first pair, others by
    the second; invalid scores select nothing and are named.
    """
    sized = grouped.select(frame, "group", "members").distinct()
    rows = sized.join(scores, [frame, "group"], "left")
    at = F.when(F.col("members") == 1, 1).otherwise(3)
    rows = rows.withColumn("_error", score_error(F.col("scores"), CAPTIONS, SELECTOR_BOUND))
    rows = rows.withColumn("uninvolved", F.when(F.col("_error").isNull(), F.element_at("scores", at))).withColumn("involved", F.when(F.col("_error").isNull(), F.element_at("scores", at + 1)))
    judged = contacts.both_views(rows, frame, "group", "members", error=F.max("_error"))
    good = F.col("error").isNull()
    pair = F.when(F.col("members") == 1, "single").otherwise("contact_group")
    return judged.select(frame, "group", "members", pair.alias("caption_pair"), "views", F.when(good, F.col("least_margin")).alias("least_margin"), (good & F.coalesce("selected", F.lit(False))).alias("selected"), "error")


def decisions(masks: DataFrame, scores: DataFrame, frame: str, segment: str, tasks: int | None = None) -> DataFrame:
    """(frame, segment, group, caption_pair, selected, error) of every segment. ``tasks``: to how many groups are dealt
    (:func:`joins.tasks`)."""
    dealt = lambda rows: rows.repartition(tasks, frame, "group") if tasks else rows
    grouped = dealt(groups(masks, frame, segment))
    judged = associations(grouped, dealt(scores), frame).select(frame, "group", "caption_pair", "selected", "error")
    return grouped.join(judged, [frame, "group"]).select(frame, segment, "group", "caption_pair", "selected", "error")
