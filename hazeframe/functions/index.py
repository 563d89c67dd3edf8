"""Sub-indices, the index itself, categories and the dominant pollutant.

The case tables are written as SQL text, generated from the fixed values: one
parsed expression instead of a few hundred column calls, and one readable
``CASE`` in the plan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import BREAKPOINTS, CATEGORIES, EXPOSURES, EXTERNAL, INDEX_CAP

Band = tuple[float, float, float, float]


def _double(value: float) -> str:
    return f"{float(value)!r}D"


def _case(arms: Sequence[tuple[str, str]], otherwise: str = "NULL") -> Column:
    text = " ".join(f"WHEN {test} THEN {value}" for test, value in arms)
    return F.expr(f"CASE {text} ELSE {otherwise} END")


def sub_index(name: str, bands: Sequence[Band]) -> Column:
    """Piecewise linear index of a concentration column.

    The first band that holds the value wins; beyond the last band the index
    is capped, below the first band and for null it is null.

    The band's line is taken from a list by the band's number.  A ``CASE`` with a line
    per band makes methods that are too long for the JVM's compiler.
    """
    if _gaps(bands):
        return _sub_index_by_case(name, bands)
    lines = ["CAST(NULL AS STRUCT<a: DOUBLE, x: DOUBLE, y: DOUBLE>)"]
    for c_lo, c_hi, i_lo, i_hi in bands:
        lines.append(_line((i_hi - i_lo) / (c_hi - c_lo), c_lo, i_lo))
    lines.append(_line(0, 0, INDEX_CAP))
    edges = [f"CAST(`{name}` > {_double(band[1])} AS INT)" for band in bands]
    number = " + ".join([f"CAST(`{name}` >= {_double(bands[0][0])} AS INT)", *edges])
    line = f"get(array({', '.join(lines)}), {number})"
    # No NaN or infinity into the flat line above the last band.
    value = f"CASE WHEN `{name}` > {_double(bands[-1][1])} THEN 0.0D ELSE `{name}` END"
    return F.expr(f"{line}.a * ({value} - {line}.x) + {line}.y")


def _gaps(bands: Sequence[Band]) -> bool:
    return any(upper[0] > lower[1] for lower, upper in zip(bands, bands[1:]))


def _line(slope: float, x: float, y: float) -> str:
    return f"named_struct('a', {_double(slope)}, 'x', {_double(x)}, 'y', {_double(y)})"


def _sub_index_by_case(name: str, bands: Sequence[Band]) -> Column:
    """As ``sub_index``, for bands with gaps, in which the index is null."""
    arms = []
    for c_lo, c_hi, i_lo, i_hi in bands:
        slope = (i_hi - i_lo) / (c_hi - c_lo)
        line = f"{_double(slope)} * (`{name}` - {_double(c_lo)}) + {_double(i_lo)}"
        arms.append((f"`{name}` BETWEEN {_double(c_lo)} AND {_double(c_hi)}", line))
    arms.append((f"`{name}` > {_double(bands[-1][1])}", _double(INDEX_CAP)))
    return _case(arms, "CAST(NULL AS DOUBLE)")


def band_numbers(columns: Sequence[str]) -> dict[str, Column]:
    """``_band_<exposure>`` for ``sub_indices``, to be added before them: 0 is the first band.

    Null for null and below the first band, the number of bands beyond the last one.
    """
    made = {}
    for e in EXPOSURES:
        bands = BREAKPOINTS[e.pollutant]
        if e.column in columns and not _gaps(bands):
            arms = [(f"`{e.column}` < {_double(bands[0][0])}", "NULL")]
            arms += [(f"`{e.column}` <= {_double(band[1])}", str(i)) for i, band in enumerate(bands)]
            arms.append((f"`{e.column}` > {_double(bands[-1][1])}", str(len(bands))))
            made[f"_band_{e.column}"] = _case(arms)
    return made


def sub_indices(columns: Sequence[str]) -> dict[str, Column]:
    """Sub-index per exposure; from its band number where ``columns`` has that."""
    made = {}
    for e in EXPOSURES:
        if e.column in columns:
            bands, number = BREAKPOINTS[e.pollutant], f"_band_{e.column}"
            known = number in columns and not _gaps(bands)
            made[e.index] = _sub_index_by_number(e.column, bands, number) if known else sub_index(e.column, bands)
    return made


def _sub_index_by_number(name: str, bands: Sequence[Band], number: str) -> Column:
    """As ``sub_index``, where a column has the band's number: that is not written out for each part of the line."""
    slopes = [(i_hi - i_lo) / (c_hi - c_lo) for c_lo, c_hi, i_lo, i_hi in bands]
    parts = [[*slopes, 0], [*(band[0] for band in bands), 0], [*(band[2] for band in bands), INDEX_CAP]]
    a, x, y = (f"get(array({', '.join(map(_double, part))}), `{number}`)" for part in parts)
    # No NaN or infinity into the flat line above the last band.
    return F.expr(f"{a} * (CASE WHEN `{number}` = {len(bands)} THEN 0.0D ELSE `{name}` END - {x}) + {y}")


def row_max(columns: Sequence[str]) -> Column:
    """Largest non-null value of a row; ``greatest`` needs two arguments."""
    return F.col(columns[0]) if len(columns) == 1 else F.greatest(*columns)


def dominant(columns: Sequence[str]) -> Column:
    """Name of the pollutant with the largest sub-index, the first on a tie."""
    present = [e for e in EXPOSURES if e.index in columns]
    names = ", ".join(f"`{e.index}`" for e in present)
    top = f"greatest({names})" if len(present) > 1 else names
    return _case(
        [(f"`{e.index}` = {top}", f"'{EXTERNAL.get(e.pollutant, e.pollutant)}'") for e in present]
    )


def category(name: str) -> Column:
    """Band name of a column; null below 0 and above the last edge."""
    arms = [(f"`{name}` < 0", "NULL")]
    arms += [(f"`{name}` <= {_double(edge)}", f"'{label}'") for label, edge in CATEGORIES.items()]
    return _case(arms)


def forecast_category(name: str) -> Column:
    """Band name of a prediction: everything above the last but one edge is the worst."""
    *lower, worst = CATEGORIES
    arms = [(f"`{name}` <= {_double(CATEGORIES[label])}", f"'{label}'") for label in lower]
    return _case([*arms, (f"`{name}` IS NOT NULL", f"'{worst}'")])


def category_rank(name: str) -> Column:
    return _case([(f"`{name}` = '{c}'", str(i)) for i, c in enumerate(CATEGORIES)])
