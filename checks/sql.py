"""The panels and their stages as DuckDB SQL, one chain of CTEs per panel.

Written from the definitions, not from the plans: window frames, band tables and
band edges are spelled out again, and rolling sums are DECIMAL sums.
"""

from __future__ import annotations

STATES = "('AFRICA', 'AMERICA', 'ASIA', 'EUROPE')"
BURNING = "('AFRICA', 'AMERICA')"
BURN_CHART = "('AFRICA', 'AMERICA', 'ASIA')"

K = "CAST(regexp_extract(props, '([0-9]+)', 1) AS DOUBLE)"

SENSOR_RAW = f"""raw AS (
  SELECT CAST(user_id AS VARCHAR) AS StationId,
         CASE WHEN event_id % 97 = 0 THEN 'bad' ELSE CAST(ts AS VARCHAR) END AS Datetime,
         CASE WHEN event_type = 'click' THEN value END AS PM25,
         CASE WHEN event_type = 'view' THEN value - CAST(5 AS DOUBLE) END AS PM10,
         CASE WHEN event_type = 'purchase' THEN value END AS NOx,
         CASE WHEN event_type = 'error' THEN value * CAST(6 AS DOUBLE) END AS NH3,
         CASE WHEN event_id % 60 = 0 THEN {K} / CAST(2 AS DOUBLE)
              ELSE {K} / CAST(100 AS DOUBLE) END AS CO,
         CASE WHEN event_type = 'signup' THEN value END AS SO2,
         CASE WHEN event_id % 70 = 0 THEN {K} * CAST(10 AS DOUBLE)
              ELSE {K} * CAST(0.6 AS DOUBLE) END AS O3,
         CASE WHEN event_id % 10 = 0 THEN value * CAST(2 AS DOUBLE) END AS AQI,
         event_id
  FROM events),
st AS (
  SELECT CAST(c_custkey AS VARCHAR) AS StationId, c_name AS StationName, n_name AS City, r_name AS State
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""

DAILY_RAW = """raw AS (
  SELECT CAST(l_suppkey AS VARCHAR) AS StationId, l_shipdate AS Datetime,
         l_quantity
           * CAST(CASE WHEN month(l_shipdate) IN (12, 1, 2) THEN 8 WHEN month(l_shipdate) IN (3, 4, 5) THEN 3
                       WHEN month(l_shipdate) IN (6, 7, 8, 9) THEN 1 ELSE 5 END AS DOUBLE)
           * CAST(CASE l_suppkey % 4 WHEN 0 THEN 0.2 WHEN 1 THEN 0.5 WHEN 2 THEN 1 ELSE 3 END AS DOUBLE) AS PM25,
         floor(l_extendedprice / CAST(400 AS DOUBLE)
           * CAST(CASE WHEN l_suppkey % 5 = 0 THEN 3 ELSE 1 END AS DOUBLE)
           * CAST(CASE WHEN month(l_shipdate) IN (5, 6) THEN 3 ELSE 0.7 END AS DOUBLE)) AS PM10,
         CASE WHEN l_returnflag <> 'R' THEN l_discount * CAST(1000 AS DOUBLE) END AS NOx,
         CASE WHEN l_linestatus <> 'O' THEN l_tax * CAST(1000 AS DOUBLE) END AS SO2,
         l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice,
         l_discount, l_tax, l_returnflag, l_linestatus
  FROM lineitem),
st AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS StationId, s_name AS StationName, n_name AS City, r_name AS State
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""

TIES = {
    "sensor": "event_id",
    "daily": "l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice, "
    "l_discount, l_tax, l_returnflag, l_linestatus",
}
COLS = {
    "sensor": ["PM25", "PM10", "NOx", "NH3", "CO", "SO2", "O3"],
    "daily": ["PM25", "PM10", "NOx", "SO2"],
}
INDEX_COLS = ["PM25", "PM10", "SO2", "NOx", "NH3", "CO", "O3"]
EXPO = {
    "PM25": ("PM25_24h", 24, 12), "PM10": ("PM10_24h", 24, 12), "SO2": ("SO2_24h", 24, 12),
    "NOx": ("NOx_24h", 24, 12), "NH3": ("NH3_24h", 24, 12), "CO": ("CO_8h", 8, 4), "O3": ("O3_8h", 8, 4),
}
# Fixed values, stated here once more so that the oracles stand on their own.
EDGES = {
    "PM25": [0, 30, 60, 90, 120, 250, 500],
    "PM10": [0, 50, 100, 250, 350, 430, 600],
    "SO2": [0, 40, 80, 380, 800, 1600, 2100],
    "NOx": [0, 40, 80, 180, 280, 400, 800],
    "NH3": [0, 200, 400, 800, 1200, 1800, 2400],
    "CO": [0, 1, 2, 10, 17, 34, 46],
    "O3": [0, 50, 100, 168, 208, 748, 987],
}
INDEX_LOW = [0, 51, 101, 201, 301, 401]
INDEX_HIGH = [50, 100, 200, 300, 400, 500]
NAMES = {"PM25": "PM2.5"}


def d(x: float) -> str:
    return f"CAST({x} AS DOUBLE)"


def sub_index(col: str, pollutant: str) -> str:
    edges = EDGES[pollutant]
    out = ["CASE"]
    for i in range(6):
        lo, hi = edges[i], edges[i + 1]
        out.append(
            f"WHEN {col} >= {lo} AND {col} <= {hi} THEN "
            f"({d(INDEX_HIGH[i])} - {d(INDEX_LOW[i])}) / ({d(hi)} - {d(lo)}) * ({col} - {d(lo)}) + {d(INDEX_LOW[i])}"
        )
    out.append(f"WHEN {col} > {edges[-1]} THEN {d(500)} END")
    return " ".join(out)


def category(col: str) -> str:
    return (
        f"CASE WHEN {col} < 0 OR {col} > 500 THEN NULL WHEN {col} <= 50 THEN 'Good' "
        f"WHEN {col} <= 100 THEN 'Satisfactory' WHEN {col} <= 200 THEN 'Moderate' "
        f"WHEN {col} <= 300 THEN 'Poor' WHEN {col} <= 400 THEN 'Very Poor' "
        f"WHEN {col} <= 500 THEN 'Severe' END"
    )


def season_of(month: str) -> str:
    return (
        f"CASE WHEN {month} IN (12, 1, 2) THEN 'Winter' WHEN {month} IN (3, 4, 5) THEN 'Spring' "
        f"WHEN {month} IN (6, 7, 8, 9) THEN 'Monsoon' ELSE 'Autumn' END"
    )


SEASON_CODE = "CASE Season WHEN 'Winter' THEN 0 WHEN 'Spring' THEN 1 WHEN 'Monsoon' THEN 2 ELSE 3 END"
CAT_RANK = (
    "CASE AQI_Category WHEN 'Good' THEN 0 WHEN 'Satisfactory' THEN 1 WHEN 'Moderate' THEN 2 "
    "WHEN 'Poor' THEN 3 WHEN 'Very Poor' THEN 4 ELSE 5 END"
)

CALENDAR = f"""CAST(year(Datetime) AS INTEGER) AS Year, CAST(month(Datetime) AS INTEGER) AS Month,
         CAST(day(Datetime) AS INTEGER) AS Day, CAST(hour(Datetime) AS INTEGER) AS Hour,
         CAST(isodow(Datetime) - 1 AS INTEGER) AS DayOfWeek,
         CAST(CASE WHEN isodow(Datetime) >= 6 THEN 1 ELSE 0 END AS INTEGER) AS IsWeekend,
         {season_of('month(Datetime)')} AS Season,
         CAST(CASE WHEN month(Datetime) IN (10, 11) AND State IN {BURNING} THEN 1 ELSE 0 END AS INTEGER) AS CropBurning"""


def chain(kind: str, stage: str) -> str:
    """``WITH`` clause up to a stage: raw, joined, kept, dated, filled, clipped,
    clean, expo, si, aqi, feat."""
    tie = TIES[kind]
    cols = COLS[kind]
    ids = "StationId, StationName, City, State"
    cal = "Year, Month, Day, Hour, DayOfWeek, IsWeekend, Season, CropBurning"
    rep = ", AQI" if kind == "sensor" else ""
    steps: dict[str, str] = {}
    steps["raw"] = SENSOR_RAW if kind == "sensor" else DAILY_RAW
    steps["joined"] = "joined AS (SELECT raw.*, st.StationName, st.City, st.State FROM raw LEFT JOIN st ON raw.StationId = st.StationId)"
    steps["kept"] = f"kept AS (SELECT * FROM joined WHERE State IN {STATES})"
    parsed = "TRY_CAST(Datetime AS TIMESTAMP)"
    steps["dated"] = f"""dated AS (
  SELECT *, {CALENDAR}
  FROM (SELECT * REPLACE ({parsed} AS Datetime) FROM kept WHERE {parsed} IS NOT NULL))"""
    fills = ", ".join(
        f"coalesce(last_value({c} IGNORE NULLS) OVER past, first_value({c} IGNORE NULLS) OVER everything) AS {c}"
        for c in cols
    )
    w = f"PARTITION BY StationId ORDER BY Datetime, {tie}"
    steps["filled"] = f"""filled AS (
  SELECT * REPLACE ({fills}) FROM dated
  WINDOW past AS ({w} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
         everything AS ({w} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))"""
    clips = ", ".join(f"(CASE WHEN {c} < 0 THEN {d(0)} ELSE {c} END) + {d(0)} AS {c}" for c in cols)
    core = " OR ".join(f"{c} IS NOT NULL" for c in ("PM25", "PM10", "SO2", "NOx"))
    steps["clipped"] = f"clipped AS (SELECT * FROM (SELECT * REPLACE ({clips}) FROM filled) WHERE {core})"
    steps["clean"] = f"""clean AS MATERIALIZED (
  SELECT {ids}, Datetime, {cal}, {', '.join(cols)}{rep}
  FROM (SELECT *, row_number() OVER (PARTITION BY StationId, Datetime ORDER BY {tie}) AS rn FROM clipped)
  WHERE rn = 1)"""
    exps = []
    for p in INDEX_COLS:
        name, n, least = EXPO[p]
        if p not in cols:
            exps.append(f"CAST(NULL AS DOUBLE) AS {name}")
        elif n == 24:
            exps.append(
                f"CASE WHEN count({p}) OVER w24 >= {least} THEN CAST(sum(CAST({p} AS DECIMAL(18, 4))) OVER w24 AS DOUBLE)"
                f" / count({p}) OVER w24 END AS {name}"
            )
        else:
            exps.append(f"CASE WHEN count({p}) OVER w8 >= {least} THEN max({p}) OVER w8 END AS {name}")
    steps["expo"] = f"""expo AS (
  SELECT *, {', '.join(exps)} FROM clean
  WINDOW w24 AS (PARTITION BY StationId ORDER BY Datetime ROWS BETWEEN 23 PRECEDING AND CURRENT ROW),
         w8 AS (PARTITION BY StationId ORDER BY Datetime ROWS BETWEEN 7 PRECEDING AND CURRENT ROW))"""
    si = ", ".join(f"{sub_index(EXPO[p][0], p)} AS SI_{p}" for p in INDEX_COLS)
    steps["si"] = f"si AS (SELECT *, {si} FROM expo)"
    names = ", ".join(f"SI_{p}" for p in INDEX_COLS)
    dom = " ".join(f"WHEN SI_{p} = AQI_Calculated THEN '{NAMES.get(p, p)}'" for p in INDEX_COLS)
    reported = "coalesce(AQI, AQI_Calculated)" if kind == "sensor" else "AQI_Calculated"
    steps["aqi"] = f"""aqi AS MATERIALIZED (
  SELECT *, {category('AQI_Final')} AS AQI_Category, CASE {dom} END AS DominantPollutant
  FROM (SELECT *, round_even({reported}, 2) AS AQI_Final
        FROM (SELECT *, greatest({names}) AS AQI_Calculated FROM si))
  WHERE AQI_Final IS NOT NULL)"""
    lag = ", ".join(f"lag(AQI_Final, {n}) OVER w AS AQI_Lag{n}" for n in (1, 3, 6, 24))
    roll = ", ".join(
        f"CASE WHEN count(AQI_Final) OVER r{n} >= {m} THEN CAST(sum(CAST(AQI_Final AS DECIMAL(18, 2))) OVER r{n} AS DOUBLE)"
        f" / count(AQI_Final) OVER r{n} END AS AQI_Roll{n}"
        for n, m in ((3, 2), (6, 3), (24, 12))
    )
    frames = ", ".join(
        f"r{n} AS (PARTITION BY StationId ORDER BY Datetime ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
        for n in (3, 6, 24)
    )
    cyc = ", ".join(
        f"{f}(2 * pi() * {c} / {n}) AS {label}_{f.capitalize()}"
        for label, c, n in (("Month", "Month", 12), ("Hour", "Hour", 24), ("DoW", "DayOfWeek", 7))
        for f in ("sin", "cos")
    )
    hot = ", ".join(
        f"CAST(CASE WHEN State = '{s}' THEN 1 ELSE 0 END AS INTEGER) AS State_{s}"
        for s in ("AFRICA", "AMERICA", "ASIA", "EUROPE")
    )
    steps["hist"] = f"""hist AS (
  SELECT *, AQI_Final - AQI_Lag1 AS AQI_Delta1, AQI_Final - AQI_Lag6 AS AQI_Delta6
  FROM (SELECT *, {lag}, {roll} FROM aqi
        WINDOW w AS (PARTITION BY StationId ORDER BY Datetime), {frames}))"""
    steps["feat"] = f"""feat AS MATERIALIZED (
  SELECT *, CAST({SEASON_CODE} AS INTEGER) AS Season_Enc, {cyc}, {hot} FROM hist
  WHERE AQI_Lag1 IS NOT NULL AND AQI_Lag3 IS NOT NULL AND AQI_Lag6 IS NOT NULL AND AQI_Lag24 IS NOT NULL)"""
    out = []
    for name, text in steps.items():
        out.append(text)
        if name == stage:
            return "WITH " + ",\n".join(out)
    raise KeyError(stage)


def feature_names(kind: str) -> list[str]:
    names = [f"AQI_Lag{n}" for n in (1, 3, 6, 24)] + [f"AQI_Roll{n}" for n in (3, 6, 24)]
    names += ["AQI_Delta1", "AQI_Delta6", "Month_Sin", "Month_Cos", "Hour_Sin", "Hour_Cos", "DoW_Sin", "DoW_Cos"]
    names += ["Season_Enc", "IsWeekend", "CropBurning", "Year"]
    names += [f"State_{s}" for s in ("AFRICA", "AMERICA", "ASIA", "EUROPE")]
    names += [c for c in INDEX_COLS if c in COLS[kind]] + [EXPO[c][0] for c in INDEX_COLS]
    return names


def mean(col: str = "AQI_Final", where: str | None = None) -> str:
    f = f" FILTER (WHERE {where})" if where else ""
    return f"CAST(sum(CAST({col} AS DECIMAL(18, 2))){f} AS DOUBLE) / nullif(count({col}){f}, 0)"


def r6(expr: str) -> str:
    return f"round({expr}, 6)"


def median(col: str) -> str:
    return f"round(quantile_cont({col}, 0.5), 6)"
