"""SQL shared by the checks: test tables as trips, the fact, and the dimensions.

The SQL works on detail rows throughout; it shares no aggregation step with the
Spark side.
"""

from __future__ import annotations

from datetime import date

from tripstar.sources.dimensions import MEMBERS, SCHEMAS

CALENDAR = (date(1995, 1, 1), date(2001, 12, 31))
AS_OF = date(2000, 6, 15)

_SECONDS = "((l_orderkey * 37 + l_partkey * 11) % 86400)"
_RIDE = "(CAST(l_quantity * 60 AS BIGINT) + l_linenumber * 7)"
_PRICE = "CAST(l_extendedprice AS DECIMAL(10,2))"


def _metered(expression: str, dtype: str) -> str:
    return f"CASE WHEN l_returnflag <> 'R' THEN CAST({expression} AS {dtype}) END"


TRIPS = f"""trips AS (
  SELECT
    l_orderkey * 10 + l_linenumber AS trip_id,
    CASE l_returnflag WHEN 'R' THEN 'fhv' WHEN 'N' THEN 'green' ELSE 'yellow' END AS file_type,
    CAST(year(l_shipdate - INTERVAL 1 DAY) AS INTEGER) AS year,
    CAST(month(l_shipdate - INTERVAL 1 DAY) AS INTEGER) AS month,
    TIMESTAMP '2025-01-01 00:00:00' AS processed_at,
    CASE WHEN l_orderkey % 211 <> 0
      THEN l_shipdate + to_seconds(CAST({_SECONDS} AS BIGINT)) END AS pickup_datetime,
    CASE WHEN l_orderkey % 97 <> 0
      THEN l_shipdate + to_seconds(CAST({_SECONDS} + {_RIDE} AS BIGINT)) END AS dropoff_datetime,
    {_metered("l_linenumber % 6", "INTEGER")} AS passenger_count,
    {_metered("CASE WHEN l_partkey % 41 = 0 THEN 0 ELSE l_quantity / 2 END", "DECIMAL(8,2)")}
      AS trip_distance,
    {_metered("l_orderkey % 7", "INTEGER")} AS payment_type,
    {_metered(f"CASE WHEN l_partkey % 37 = 0 THEN 0 ELSE {_PRICE} END", "DECIMAL(10,2)")}
      AS fare_amount,
    {_metered("l_linenumber", "DECIMAL(10,2)")} AS extra,
    {_metered("0.5", "DECIMAL(10,2)")} AS mta_tax,
    {_metered(f"{_PRICE} * CAST(l_discount AS DECIMAL(4,2))", "DECIMAL(10,2)")} AS tip_amount,
    {_metered(f"{_PRICE} * CAST(l_tax AS DECIMAL(4,2))", "DECIMAL(10,2)")} AS tolls_amount,
    {_metered("1", "DECIMAL(10,2)")} AS improvement_surcharge,
    {_metered(_PRICE, "DECIMAL(10,2)")} AS total_amount,
    {_metered("2.5", "DECIMAL(10,2)")} AS congestion_surcharge,
    CASE WHEN l_returnflag = 'A' THEN CAST(1.25 AS DECIMAL(10,2)) END AS airport_fee,
    CASE WHEN l_returnflag = 'N' THEN CAST(0 AS DECIMAL(10,2)) END AS ehail_fee,
    CASE WHEN l_returnflag = 'N' THEN CAST(l_orderkey % 2 + 1 AS INTEGER) END AS trip_type,
    {_metered("l_linenumber % 4", "INTEGER")} AS vendor_id,
    {_metered("l_partkey % 6 + 1", "INTEGER")} AS ratecode_id,
    CASE WHEN l_returnflag <> 'R' THEN CASE l_linestatus WHEN 'F' THEN 'Y' ELSE 'N' END END
      AS store_and_fwd_flag,
    CASE WHEN l_partkey % 50 <> 0 THEN CAST(l_suppkey % 8 AS INTEGER) END AS pu_location_id,
    CAST(l_partkey % 8 AS INTEGER) AS do_location_id,
    CASE WHEN l_returnflag = 'R' THEN 'B' || lpad(CAST(l_suppkey AS VARCHAR), 5, '0') END
      AS dispatching_base_num,
    CASE WHEN l_returnflag = 'R' THEN 'B' || lpad(CAST(l_partkey AS VARCHAR), 5, '0') END
      AS affiliated_base_number,
    CASE WHEN l_returnflag = 'R' AND l_linenumber = 1 THEN '1' END AS sr_flag,
    l_orderkey, l_linestatus
  FROM lineitem
)"""

FACT = """fact AS (
  SELECT
    trip_id,
    CAST(strftime(pickup_datetime, '%Y%m%d') AS INTEGER) AS pickup_date_key,
    CAST(strftime(dropoff_datetime, '%Y%m%d') AS INTEGER) AS dropoff_date_key,
    CAST(strftime(pickup_datetime, '%H%M') AS INTEGER) AS pickup_time_key,
    CAST(strftime(dropoff_datetime, '%H%M') AS INTEGER) AS dropoff_time_key,
    ifnull(pu_location_id, 0) AS pickup_location_id,
    ifnull(do_location_id, 0) AS dropoff_location_id,
    ifnull(vendor_id, 0) AS vendor_id,
    ifnull(payment_type, 0) AS payment_type_id,
    ifnull(ratecode_id, 1) AS ratecode_id,
    ifnull(trip_type, 0) AS trip_type_id,
    file_type,
    ifnull(store_and_fwd_flag, ' ') AS store_fwd_flag,
    passenger_count, trip_distance,
    CAST(date_diff('minute', pickup_datetime, dropoff_datetime) AS INTEGER)
      AS trip_duration_minutes,
    fare_amount, extra, mta_tax, tip_amount, tolls_amount, improvement_surcharge,
    total_amount, congestion_surcharge, airport_fee, ehail_fee,
    dispatching_base_num, affiliated_base_number, sr_flag,
    year AS source_year, month AS source_month, processed_at
  FROM trips WHERE pickup_datetime IS NOT NULL
)"""

MONEY = [
    "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount", "improvement_surcharge",
    "total_amount", "congestion_surcharge", "airport_fee", "ehail_fee",
]


def as_double(*columns: str) -> str:
    """Star-replace list that shows decimals as doubles."""
    return ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in columns)


def _members(name: str) -> str:
    def literal(value: object) -> str:
        if isinstance(value, bool):
            return str(value).upper()
        return str(value) if isinstance(value, int) else f"'{value}'"

    rows = ", ".join(f"({', '.join(map(literal, m))})" for m in MEMBERS[name])
    columns = ", ".join(c.split()[0] for c in SCHEMAS[name].split(", "))
    return f"{name} AS (SELECT * FROM (VALUES {rows}) AS v({columns}))"


def days(first: str, last: str) -> str:
    return (
        "SELECT CAST(unnest(generate_series("
        f"CAST({first} AS TIMESTAMP), CAST({last} AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS d"
    )


CALENDAR_COLUMNS = """CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS full_date,
    CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month,
    CAST(day(d) AS INTEGER) AS day, CAST(quarter(d) AS INTEGER) AS quarter,
    CAST(dayofweek(d) + 1 AS INTEGER) AS day_of_week, strftime(d, '%a') AS day_name,
    strftime(d, '%b') AS month_name, dayofweek(d) IN (0, 6) AS is_weekend,
    FALSE AS is_holiday, CAST(weekofyear(d) AS INTEGER) AS week_of_year"""

CLOCK_COLUMNS = """CAST(m // 60 * 100 + m % 60 AS INTEGER) AS time_key,
    CAST(m // 60 AS INTEGER) AS hour, CAST(m % 60 AS INTEGER) AS minute,
    printf('%02d:%02d', m // 60, m % 60) AS hour_minute,
    CASE WHEN m >= 300 AND m < 540 THEN 'Early Morning' WHEN m >= 540 AND m < 720 THEN 'Morning'
      WHEN m >= 720 AND m < 1020 THEN 'Afternoon' WHEN m >= 1020 AND m < 1260 THEN 'Evening'
      ELSE 'Night' END AS time_period,
    (m >= 420 AND m < 600) OR (m >= 1020 AND m < 1200) AS rush_hour_flag,
    m >= 540 AND m < 1080 AS business_hours_flag"""

DIMENSIONS = ",\n".join(
    [
        f"dim_date AS (SELECT {CALENDAR_COLUMNS} FROM "
        f"({days(f'''DATE '{CALENDAR[0]}' ''', f'''DATE '{CALENDAR[1]}' ''')}) AS s)",
        f"dim_time AS (SELECT {CLOCK_COLUMNS} FROM range(1440) AS r(m))",
        *[_members(name) for name in MEMBERS],
    ]
)


def query(body: str, *ctes: str) -> str:
    """A check: the shared tables, further named queries, then the result."""
    return "WITH " + ",\n".join([TRIPS, FACT, DIMENSIONS, *ctes]) + "\n" + body


# ---------------------------------------------------------------------------
# Arithmetic with the same result in both engines
# ---------------------------------------------------------------------------
def mean(column: str) -> str:
    return f"CAST(SUM({column}) AS DOUBLE) / COUNT({column})"


def percent(part: str, whole: str, unit: int = 1) -> str:
    """``100 * part / whole`` half away from zero to two places, on integers."""
    p, w = f"CAST(({part}) * {unit} AS HUGEINT)", f"CAST(({whole}) * {unit} AS HUGEINT)"
    return (
        f"CASE WHEN {w} <> 0 THEN CAST((CASE WHEN {p} < 0 THEN -1 ELSE 1 END) * "
        f"((20000 * abs({p}) + {w}) // (2 * {w})) AS DOUBLE) / 100 END"
    )


def money(expression: str) -> str:
    return f"CAST({expression} AS DOUBLE)"


TIP = (
    "CASE WHEN f.fare_amount > 0 THEN CAST(f.tip_amount AS DOUBLE) / "
    "CAST(f.fare_amount AS DOUBLE) * 100 ELSE 0 END"
)
SPEED = (
    "CASE WHEN f.trip_duration_minutes > 0 THEN CAST(f.trip_distance AS DOUBLE) * 60 / "
    "f.trip_duration_minutes ELSE 0 END"
)


def ratio_mean(expression: str) -> str:
    return f"ROUND(AVG({expression}), 6)"
