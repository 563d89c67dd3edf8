"""Calendar parts, seasons and burning windows."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import BURN_WINDOW, CROP_BURNING_MONTHS, SEASON_CODES, SEASONS


def _season_case(month: str) -> str:
    arms = " ".join(
        f"WHEN {month} IN ({', '.join(map(str, months))}) THEN '{name}'"
        for name, months in SEASONS.items()
    )
    return f"CASE {arms} END"


def season(month: str) -> Column:
    """Season name of a month column."""
    return F.expr(_season_case(f"`{month}`"))


def season_code(season: str) -> Column:
    """Code of a season-name column."""
    arms = " ".join(f"WHEN `{season}` = '{n}' THEN {code}" for n, code in SEASON_CODES.items())
    return F.expr(f"CASE {arms} END")


def crop_burning(month: Column, state: Column, states: tuple[str, ...]) -> Column:
    """1 in the harvest months of a burning state; a null state counts as 0."""
    hit = month.isin(*CROP_BURNING_MONTHS) & state.isin(*states)
    return F.coalesce(hit, F.lit(False)).cast("int")


def in_burn_window(moment: Column, years: tuple[int, int] | None = None) -> Column:
    """Whether the day lies in 15 October .. 30 November (both included)."""
    (m1, d1), (m2, d2) = BURN_WINDOW
    day = F.month(moment) * 100 + F.dayofmonth(moment)
    inside = day.between(m1 * 100 + d1, m2 * 100 + d2)
    if years:
        inside = inside & F.year(moment).between(*years)
    return F.coalesce(inside, F.lit(False)).cast("int")


def calendar_parts(moment: str) -> dict[str, Column]:
    """Calendar columns of a timestamp column; Monday is day 0."""
    text = {
        "Year": f"year({moment})",
        "Month": f"month({moment})",
        "Day": f"dayofmonth({moment})",
        "Hour": f"hour({moment})",
        "DayOfWeek": f"weekday({moment})",
        "IsWeekend": f"CAST(weekday({moment}) IN (5, 6) AS INT)",
        "Season": _season_case(f"month({moment})"),
    }
    return {name: F.expr(t) for name, t in text.items()}


def cyclic(value: Column, period: int) -> tuple[Column, Column]:
    angle = F.lit(2 * math.pi) * value / F.lit(period)
    return F.sin(angle), F.cos(angle)


def second_of_time(moment: str) -> Column:
    """Seconds since 1970 of a zone-free timestamp column, never decreasing in time."""
    return F.expr(
        f"datediff(CAST({moment} AS DATE), DATE'1970-01-01') * 86400.0D"
        f" + (hour({moment}) * 60 + minute({moment})) * 60"
        f" + CAST(extract(SECOND FROM {moment}) AS DOUBLE)"
    )
