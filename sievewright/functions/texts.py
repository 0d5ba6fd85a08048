"""Texts of reports and captions, and the names of runs."""

from __future__ import annotations

import textwrap
import uuid
from datetime import UTC, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed formats of times and of run names.
TIME, RUN = "%Y-%m-%dT%H:%M:%S+00:00", "run_%Y%m%dT%H%M%SZ_"


def wrapped(lines: list[str], width: int) -> list[str]:
    """Lines of at most ``width`` characters, cut at blanks where there are any."""
    return [part for line in lines for part in textwrap.wrap(line, width=max(1, width))]


def shortened(text: Column, most: int) -> Column:
    """At most ``most`` characters; what is cut off is marked by an ellipsis."""
    return F.when(F.length(text) > most, F.concat(F.substring(text, 1, max(0, most - 1)), F.lit("…"))).otherwise(text)


def number(value: Column, digits: int, signed: bool = False) -> Column:
    """Fixed decimals, rounded half up; a sign before positive numbers if ``signed``. Null stays null."""
    text = F.format_string(f"%{'+' if signed else ''}.{digits}f", value.cast("double"))
    return F.when(value.isNotNull(), text)


def point(x: Column, y: Column, digits: int = 2) -> Column:
    return F.concat(F.lit("("), number(x, digits), F.lit(", "), number(y, digits), F.lit(")"))


def tile_label(index: Column, name: Column) -> Column:
    """A gallery tile's number, of three digits at least, and its name."""
    return F.concat(F.format_string("#%03d", index), F.lit("  "), name)


def with_defaults(record: Column, defaults: dict[str, float]) -> Column:
    """A map with ``defaults`` for keys that are absent or null."""
    filled = F.create_map(*(F.lit(x) for k, v in defaults.items() for x in (k, float(v))))
    present = F.map_filter(F.coalesce(record, F.create_map().cast("map<string,double>")), lambda _, v: v.isNotNull())
    return F.map_zip_with(filled, present, lambda _, a, b: F.coalesce(b, a))


def utc_now(at: datetime | None = None) -> str:
    return (at or datetime.now(UTC)).astimezone(UTC).strftime(TIME)


def run_id(at: datetime | None = None) -> str:
    """A new run's name: its time and eight random hexadecimal digits."""
    return (at or datetime.now(UTC)).astimezone(UTC).strftime(RUN) + uuid.uuid4().hex[:8]
