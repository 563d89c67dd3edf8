"""Fixed values of the air-quality domain.

Everything in this module is a fixed value: results are only comparable when
these equal the published index definition and the published study area.

Inside the library a column name never contains a dot or a blank: ``PM2.5`` is
``PM25`` and ``State_Uttar Pradesh`` is ``State_Uttar_Pradesh``.  ``EXTERNAL``
gives the outside spelling; only sources and sinks use it.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import NamedTuple

# --- fixed values: columns ---------------------------------------------------

POLLUTANTS = (
    "PM25", "PM10", "NO", "NO2", "NOx", "NH3",
    "CO", "SO2", "O3", "Benzene", "Toluene", "Xylene",
)
CORE_POLLUTANTS = ("PM25", "PM10", "SO2", "NOx")
INDEX_POLLUTANTS = ("PM25", "PM10", "SO2", "NOx", "NH3", "CO", "O3")
ID_COLUMNS = (
    "StationId", "StationName", "City", "State", "Latitude", "Longitude",
    "Datetime", "Year", "Month", "Day", "Hour", "DayOfWeek", "IsWeekend",
    "Season", "CropBurning",
)
EXTERNAL = {"PM25": "PM2.5"}

# --- fixed values: calendar --------------------------------------------------

SEASONS = {
    "Winter": (12, 1, 2),
    "Spring": (3, 4, 5),
    "Monsoon": (6, 7, 8, 9),
    "Autumn": (10, 11),
}
SEASON_CODES = {"Winter": 0, "Spring": 1, "Monsoon": 2, "Autumn": 3}
CROP_BURNING_MONTHS = (10, 11)
BURN_CHART_MONTHS = (9, 10, 11, 12)
BURN_WINDOW = ((10, 15), (11, 30))
BURN_WINDOW_YEARS = (2015, 2020)

# --- fixed values: index -----------------------------------------------------

# (concentration low, concentration high, index low, index high); the index is
# linear inside a band, a shared edge belongs to the lower band.  All units are
# micrograms per cubic metre, but CO is in milligrams.
BREAKPOINTS = {
    "PM25": (
        (0, 30, 0, 50), (30, 60, 51, 100), (60, 90, 101, 200),
        (90, 120, 201, 300), (120, 250, 301, 400), (250, 500, 401, 500),
    ),
    "PM10": (
        (0, 50, 0, 50), (50, 100, 51, 100), (100, 250, 101, 200),
        (250, 350, 201, 300), (350, 430, 301, 400), (430, 600, 401, 500),
    ),
    "SO2": (
        (0, 40, 0, 50), (40, 80, 51, 100), (80, 380, 101, 200),
        (380, 800, 201, 300), (800, 1600, 301, 400), (1600, 2100, 401, 500),
    ),
    "NOx": (
        (0, 40, 0, 50), (40, 80, 51, 100), (80, 180, 101, 200),
        (180, 280, 201, 300), (280, 400, 301, 400), (400, 800, 401, 500),
    ),
    "NH3": (
        (0, 200, 0, 50), (200, 400, 51, 100), (400, 800, 101, 200),
        (800, 1200, 201, 300), (1200, 1800, 301, 400), (1800, 2400, 401, 500),
    ),
    "CO": (
        (0, 1, 0, 50), (1, 2, 51, 100), (2, 10, 101, 200),
        (10, 17, 201, 300), (17, 34, 301, 400), (34, 46, 401, 500),
    ),
    "O3": (
        (0, 50, 0, 50), (50, 100, 51, 100), (100, 168, 101, 200),
        (168, 208, 201, 300), (208, 748, 301, 400), (748, 987, 401, 500),
    ),
}
INDEX_CAP = 500.0

# Upper edge of each category; an edge belongs to the lower category.
CATEGORIES = {
    "Good": 50, "Satisfactory": 100, "Moderate": 200,
    "Poor": 300, "Very Poor": 400, "Severe": 500,
}

WHO_PM25_LIMIT = 15.0
CPCB_PM25_LIMIT = 60.0
CPCB_PM10_LIMIT = 100.0


class Exposure(NamedTuple):
    """A rolling exposure and the sub-index made from it."""

    pollutant: str
    column: str
    rows: int
    how: str
    index: str


EXPOSURES = (
    Exposure("PM25", "PM25_24h", 24, "mean", "SI_PM25"),
    Exposure("PM10", "PM10_24h", 24, "mean", "SI_PM10"),
    Exposure("SO2", "SO2_24h", 24, "mean", "SI_SO2"),
    Exposure("NOx", "NOx_24h", 24, "mean", "SI_NOx"),
    Exposure("NH3", "NH3_24h", 24, "mean", "SI_NH3"),
    Exposure("CO", "CO_8h", 8, "max", "SI_CO"),
    Exposure("O3", "O3_8h", 8, "max", "SI_O3"),
)

# --- fixed values: features --------------------------------------------------

LAGS = (1, 3, 6, 24)
ROLLS = {3: 2, 6: 3, 24: 12}
DELTAS = (1, 6)
CYCLES = {"Month": ("Month", 12), "Hour": ("Hour", 24), "DoW": ("DayOfWeek", 7)}
REQUEST_YEAR = 2024


@dataclass(frozen=True)
class Region:
    """The study area: which states count, and what is known about them."""

    states: tuple[str, ...]
    burning: tuple[str, ...]
    burn_chart: tuple[str, ...]
    centroids: dict[str, tuple[float, float]] = field(default_factory=dict, hash=False)


# --- fixed values: study area ------------------------------------------------

NORTH_INDIA = Region(
    states=("Delhi", "Punjab", "Haryana", "Uttar Pradesh", "Rajasthan"),
    burning=("Punjab", "Haryana"),
    burn_chart=("Punjab", "Haryana", "Delhi"),
    centroids={
        "Delhi": (28.61, 77.21),
        "Punjab": (31.15, 75.34),
        "Haryana": (29.06, 76.08),
        "Uttar Pradesh": (26.85, 80.99),
        "Rajasthan": (27.02, 74.22),
    },
)


def state_column(state: str) -> str:
    """Name of the one-hot column of a state, free of blanks."""
    return "State_" + state.replace(" ", "_")
