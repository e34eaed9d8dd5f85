"""SQL counterparts of the registered queries, for an independent engine.

Each statement stands alone over the driver tables. Only the derivation of trips
and weather is shared text; the rules themselves are written out again here.
"""

from __future__ import annotations

from ridelake.catalogue.relations import EVENT_DAYS, EVENT_TRIPS, ORDER_DAYS, ORDER_TRIPS, WEATHER

_ORDERS = [ORDER_TRIPS, ORDER_DAYS, WEATHER]
_EVENTS = [EVENT_TRIPS, EVENT_DAYS, WEATHER]

_HAVERSINE = (
    "ASIN(SQRT(POW(SIN((RADIANS(end_lat) - RADIANS(start_lat)) / 2), 2)"
    " + COS(RADIANS(start_lat)) * COS(RADIANS(end_lat))"
    " * POW(SIN((RADIANS(end_lng) - RADIANS(start_lng)) / 2), 2)))"
)
_MILES = f"ROUND(2 * 3958.8 * {_HAVERSINE}, 2)"
_SECONDS = (
    "(date_diff('second', date_trunc('second', started_at), date_trunc('second', ended_at)))"
)
_MINUTES = f"({_SECONDS} / 60.0)"
_EXACT_MINUTES = "(date_diff('microsecond', started_at, ended_at) / 60000000.0)"
_DAY = "CAST(started_at AS DATE)"
_ISO = "strftime({}, '%Y-%m-%d')"
_ISO_TIME = "strftime({}, '%Y-%m-%d %H:%M:%S')"
_SEASON = (
    "CASE WHEN month({d}) IN (12, 1, 2) THEN 'Winter' WHEN month({d}) IN (3, 4, 5) THEN 'Spring'"
    " WHEN month({d}) IN (6, 7, 8) THEN 'Summer' ELSE 'Fall' END"
)
_CELSIUS = "((temp - 32) * 5.0 / 9.0)"

_CLEAN_WEATHER = """
clean AS (
  SELECT trip_date,
         CASE WHEN temp = 999.9 THEN 0.0 ELSE temp END AS temp,
         CASE WHEN visib = 999.9 THEN 0.0 ELSE visib END AS visib,
         CASE WHEN wdsp = 999.9 THEN 0.0 ELSE wdsp END AS wdsp,
         CASE WHEN prcp = 999.9 THEN 0.0 ELSE prcp END AS prcp,
         CASE WHEN sndp = 999.9 THEN 0.0 ELSE sndp END AS sndp,
         COALESCE(frshtt, '000000') AS frshtt
  FROM weather
)"""

_SILVER = f"""
valid AS (
  SELECT *, {_DAY} AS trip_date, {_MINUTES} AS trip_duration_min FROM trips
  WHERE {_SECONDS} > 0 AND {_SECONDS} <= 86400
    AND start_lat BETWEEN 40.4774 AND 40.9176 AND start_lng BETWEEN -74.2591 AND -73.7004
    AND end_lat BETWEEN 40.4774 AND 40.9176 AND end_lng BETWEEN -74.2591 AND -73.7004
    AND ride_id IS NOT NULL AND start_station_id IS NOT NULL AND end_station_id IS NOT NULL
), silver AS (
  SELECT v.ride_id, v.rideable_type, v.member_casual, v.started_at, v.ended_at, v.trip_date,
         CAST(hour(v.started_at) AS INTEGER) AS start_hour,
         v.start_station_id, v.start_station_name, v.end_station_id, v.end_station_name,
         v.start_lat, v.start_lng, v.end_lat, v.end_lng,
         v.trip_duration_min, {_MILES} AS trip_distance,
         CASE WHEN v.start_station_id = v.end_station_id AND v.start_lat = v.end_lat
                   AND v.start_lng = v.end_lng THEN 1 ELSE 0 END AS is_round_trip,
         dayofweek(v.trip_date) IN (0, 6) AS weekend,
         hour(v.started_at) IN (7, 8, 9, 16, 17, 18) AS is_rush_hour,
         strftime(v.trip_date, '%m-%d') IN ('01-01', '07-04', '12-25') AS is_holiday,
         dayname(v.trip_date) AS day_of_week,
         CAST(month(v.trip_date) AS INTEGER) AS month, CAST(year(v.trip_date) AS INTEGER) AS year,
         {_SEASON.format(d="v.trip_date")} AS season,
         c.temp, c.visib, c.wdsp, c.prcp, c.sndp,
         CAST(substr(COALESCE(c.frshtt, '000000'), 1, 1) AS INTEGER) AS is_fog,
         CAST(substr(COALESCE(c.frshtt, '000000'), 2, 1) AS INTEGER) AS is_rain,
         CAST(substr(COALESCE(c.frshtt, '000000'), 3, 1) AS INTEGER) AS is_snow,
         CAST(substr(COALESCE(c.frshtt, '000000'), 4, 1) AS INTEGER) AS is_hail,
         CAST(substr(COALESCE(c.frshtt, '000000'), 5, 1) AS INTEGER) AS is_thunder,
         CAST(substr(COALESCE(c.frshtt, '000000'), 6, 1) AS INTEGER) AS is_tornado,
         CASE WHEN c.temp >= 75 THEN 'Warm' WHEN c.temp >= 55 THEN 'Moderate' ELSE 'Cool' END
           AS temp_category,
         CASE WHEN c.prcp = 0 THEN 'No Rain' WHEN c.prcp <= 0.1 THEN 'Light'
              WHEN c.prcp <= 0.3 THEN 'Moderate' ELSE 'Heavy' END AS prcp_category
  FROM valid v LEFT JOIN clean c ON v.trip_date = c.trip_date
)"""

_GOLD = """
dim_member AS (
  SELECT row_number() OVER (ORDER BY member_casual) AS member_key, member_casual
  FROM (SELECT DISTINCT member_casual FROM silver) UNION ALL SELECT -1, 'Unknown'
), dim_bike_type AS (
  SELECT row_number() OVER (ORDER BY rideable_type) AS bike_key, rideable_type
  FROM (SELECT DISTINCT rideable_type FROM silver) UNION ALL SELECT -1, 'Unknown'
), dim_temperature AS (
  SELECT row_number() OVER (ORDER BY temp_category) AS temp_key, temp_category
  FROM (SELECT DISTINCT temp_category FROM silver) UNION ALL SELECT -1, 'Unknown'
), pairs AS (
  SELECT station_id, station_name, count(*) AS seen FROM (
    SELECT start_station_id AS station_id, start_station_name AS station_name FROM silver
    UNION ALL SELECT end_station_id, end_station_name FROM silver)
  GROUP BY station_id, station_name
), named AS (
  SELECT station_id, station_name FROM (
    SELECT *, row_number() OVER (
      PARTITION BY station_id ORDER BY seen DESC, station_name NULLS LAST) AS r FROM pairs)
  WHERE r = 1
), dim_station AS (
  SELECT row_number() OVER (ORDER BY station_id) AS station_key, station_id, station_name
  FROM named UNION ALL SELECT -1, 'UNKNOWN', 'Unknown Station'
), fact_trips AS (
  SELECT s.ride_id, s.year * 10000 + s.month * 100 + CAST(day(s.trip_date) AS INTEGER) AS date_key,
         COALESCE(m.member_key, -1) AS member_key, COALESCE(b.bike_key, -1) AS bike_key,
         COALESCE(t.temp_key, -1) AS temp_key,
         COALESCE(d1.station_key, -1) AS start_station_key,
         COALESCE(d2.station_key, -1) AS end_station_key,
         s.year, s.month, s.start_hour, s.trip_date, s.trip_distance, s.trip_duration_min,
         s.temp AS temperature, s.is_rush_hour, s.weekend, s.season,
         s.member_casual, s.rideable_type, s.temp_category, s.start_station_id, s.end_station_id
  FROM silver s
  LEFT JOIN dim_member m ON s.member_casual = m.member_casual
  LEFT JOIN dim_bike_type b ON s.rideable_type = b.rideable_type
  LEFT JOIN dim_temperature t ON s.temp_category = t.temp_category
  LEFT JOIN dim_station d1 ON s.start_station_id = d1.station_id
  LEFT JOIN dim_station d2 ON s.end_station_id = d2.station_id
)"""

_PER_DAY = f"""
joined AS (
  SELECT t.*, {_DAY} AS trip_date, w.temp, w.prcp, w.wdsp, w.visib, w.sndp, w.frshtt
  FROM trips t LEFT JOIN weather w ON {_DAY} = w.trip_date
)"""

# One row per trip end. An end without a station stays apart by direction.
_FLOWS = """
moves AS (
  SELECT strftime(started_at, '%Y-%m') AS month, start_station_id AS station_id, 0 AS arr, 1 AS dep,
         CASE WHEN start_station_id IS NULL THEN 'out' END AS lone FROM trips
  UNION ALL
  SELECT strftime(started_at, '%Y-%m'), end_station_id, 1, 0,
         CASE WHEN end_station_id IS NULL THEN 'in' END FROM trips
), flows AS (
  SELECT month, station_id, CAST(sum(arr) AS BIGINT) AS inflow, CAST(sum(dep) AS BIGINT) AS outflow,
         CAST(sum(arr) - sum(dep) AS BIGINT) AS imbalance_index
  FROM moves {where} GROUP BY month, station_id, lone
)"""
_ALL_FLOWS = _FLOWS.format(where="")
_KNOWN_FLOWS = _FLOWS.format(where="WHERE lone IS NULL")
_CATEGORISED = """
categorised AS (
  SELECT *, CASE WHEN imbalance_index > 20 THEN 'Severe overflow'
                 WHEN imbalance_index >= 5 THEN 'Mild overflow'
                 WHEN imbalance_index >= -5 THEN 'Balanced'
                 WHEN imbalance_index >= -20 THEN 'Mild shortage'
                 ELSE 'Severe shortage' END AS imbalance_category
  FROM flows
)"""


def _sql(ctes: list[str], query: str) -> str:
    text = "WITH " + ", ".join(c.strip() for c in ctes) + " " + query.strip()
    return text.replace("{orders}", "orders").replace("{events}", "events")


def _trips(query: str, *more: str) -> str:
    return _sql([ORDER_TRIPS, *more], query)


def _days(query: str) -> str:
    return _sql([ORDER_DAYS, WEATHER], query)


def _joined(query: str) -> str:
    return _sql([*_ORDERS, _PER_DAY], query)


def _silver(query: str) -> str:
    return _sql([*_ORDERS, _CLEAN_WEATHER, _SILVER], query)


def _gold(query: str) -> str:
    return _sql([*_ORDERS, _CLEAN_WEATHER, _SILVER, _GOLD], query)


def _tall(source: str, label: str, value: str, measures: dict[str, str]) -> str:
    """One SELECT per measure, glued by UNION ALL."""
    return " UNION ALL ".join(
        f"SELECT '{name}' AS {label}, {expr} AS {value} FROM {source}"
        for name, expr in measures.items()
    )


_TRIP_COLUMNS = (
    "ride_id", "rideable_type", "started_at", "ended_at", "start_station_name", "start_station_id",
    "end_station_name", "end_station_id", "start_lat", "start_lng", "end_lat", "end_lng",
    "member_casual",
)
_TRIPS_AS_TEXT = f"""
SELECT ride_id, rideable_type, {_ISO_TIME.format("started_at")} AS started_at,
       {_ISO_TIME.format("ended_at")} AS ended_at, start_station_name, start_station_id,
       end_station_name, end_station_id, start_lat, start_lng, end_lat, end_lng, member_casual
FROM trips"""

_CORR_COLUMNS = ("trip_duration_min", "trip_distance", "start_hour", "temp", "prcp", "wdsp")
_DESCRIBED = ("start_lat", "start_lng", "end_lat", "end_lng", "trip_duration_min", "temp")

_RIDERS_FIRST = """
early AS (
  SELECT rider_id, row_number() OVER (ORDER BY rider_id) AS rider_key
  FROM (SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS rider_id FROM orders
        WHERE year(o_orderdate) < 1997)
)"""


def _histogram(low: str, high: str, bins: int) -> str:
    return _trips(
        f"""
, bounds AS (SELECT {low} AS low, {high} AS high, ({high} - {low}) / {bins}.0 AS width FROM d),
h AS (
  SELECT LEAST(CAST(FLOOR((m - low) / width) AS INTEGER), {bins - 1}) AS bin, count(*) AS n
  FROM d, (SELECT DISTINCT * FROM bounds) b WHERE m BETWEEN low AND high GROUP BY 1
)
SELECT CAST(i AS INTEGER) AS bin, low + i * width AS from_minute, COALESCE(n, 0) AS trips,
       ROUND(COALESCE(n, 0) / ((SELECT sum(n) FROM h) * width), 8) AS density
FROM range({bins}) r(i) CROSS JOIN (SELECT DISTINCT * FROM bounds) b LEFT JOIN h ON h.bin = i
""",
        f"d AS (SELECT {_EXACT_MINUTES} AS m FROM trips WHERE ended_at > started_at)",
    ).replace(") , bounds", "), bounds")


ORACLE: dict[str, str] = {
    "silver_trips": _silver(
        f"""SELECT * REPLACE ({_ISO_TIME.format("started_at")} AS started_at,
        {_ISO_TIME.format("ended_at")} AS ended_at, {_ISO.format("trip_date")} AS trip_date)
        FROM silver"""
    ),
    "silver_stored": _silver(
        """SELECT year, month, count(*) AS trips, ROUND(sum(trip_duration_min), 4) AS minutes,
        CAST(sum(CAST(trip_distance AS DECIMAL(18, 2))) AS DOUBLE) AS miles
        FROM silver GROUP BY year, month"""
    ),
    "legacy_trips": _sql(
        _ORDERS,
        f"""
SELECT {", ".join("t." + c for c in _TRIP_COLUMNS if c not in ("started_at", "ended_at"))},
       {_ISO_TIME.format("started_at")} AS started_at, {_ISO_TIME.format("ended_at")} AS ended_at,
       {_ISO.format(_DAY)} AS trip_date, w.temp, w.visib, w.wdsp, w.prcp,
       CASE WHEN w.sndp = 999.9 THEN 0.0 ELSE w.sndp END AS sndp,
       {", ".join(f"CAST(substr(w.frshtt, {i}, 1) AS INTEGER) AS is_{e}"
                  for i, e in enumerate(("fog", "rain", "snow", "hail", "thunder", "tornado"), 1))},
       {_MINUTES} AS trip_duration_min, dayofweek(started_at) IN (0, 6) AS weekend,
       lower({_SEASON.format(d="started_at")}) AS season,
       ROUND(3958.8 * ACOS(GREATEST(-1.0, LEAST(1.0,
         SIN(RADIANS(start_lat)) * SIN(RADIANS(end_lat)) + COS(RADIANS(start_lat))
         * COS(RADIANS(end_lat)) * COS(RADIANS(end_lng) - RADIANS(start_lng))))), 2) AS trip_distance
FROM trips t LEFT JOIN weather w ON {_DAY} = w.trip_date
WHERE length(start_station_id) > 0 AND length(end_station_id) > 0
  AND {_SECONDS} > 60 AND {_SECONDS} < 86400
  AND start_lat BETWEEN 40 AND 41 AND end_lat BETWEEN 40 AND 41
  AND start_lng BETWEEN -74 AND -73.4 AND end_lng BETWEEN -74 AND -73.4""",
    ),
    "reject_funnel": _trips(
        f"""
SELECT CASE WHEN {_SECONDS} IS NULL THEN 'no duration'
            WHEN NOT ({_SECONDS} > 0 AND {_SECONDS} <= 86400) THEN 'duration out of bounds'
            WHEN start_lat IS NULL OR start_lng IS NULL OR end_lat IS NULL OR end_lng IS NULL
              THEN 'no coordinates'
            WHEN NOT (start_lat BETWEEN 40.4774 AND 40.9176 AND start_lng BETWEEN -74.2591 AND -73.7004
              AND end_lat BETWEEN 40.4774 AND 40.9176 AND end_lng BETWEEN -74.2591 AND -73.7004)
              THEN 'outside area'
            WHEN ride_id IS NULL OR start_station_id IS NULL OR end_station_id IS NULL
              THEN 'missing field'
            ELSE 'kept' END AS reason, count(*) AS trips
FROM trips GROUP BY 1"""
    ),
    "trip_distance_km": _trips(
        f"SELECT ride_id, ROUND(2 * 6371 * {_HAVERSINE}, 2) AS distance_km FROM trips"
    ),
    "weather_clean": _sql(
        [ORDER_DAYS, WEATHER, _CLEAN_WEATHER],
        f"""SELECT {_ISO.format("trip_date")} AS trip_date, temp, visib, wdsp, prcp, sndp,
        {", ".join(f"CAST(substr(frshtt, {i}, 1) AS INTEGER) AS is_{e}"
                   for i, e in enumerate(("fog", "rain", "snow", "hail", "thunder", "tornado"), 1))}
        FROM clean""",
    ),
    "weather_from_text": _joined(
        f"""SELECT DISTINCT {_ISO.format("trip_date")} AS trip_date, temp, visib, wdsp, prcp, sndp,
        frshtt FROM joined"""
    ),
    "dim_date": _silver(
        f"""SELECT DISTINCT year * 10000 + month * 100 + CAST(day(trip_date) AS INTEGER) AS date_key,
        {_ISO.format("trip_date")} AS trip_date, year, month, day_of_week, weekend, season FROM silver"""
    ),
    "dim_member": _gold("SELECT * FROM dim_member"),
    "dim_station": _gold("SELECT * FROM dim_station"),
    "dim_bike_type": _gold("SELECT * FROM dim_bike_type"),
    "dim_temperature": _gold("SELECT * FROM dim_temperature"),
    "station_spellings": _gold(
        """SELECT row_number() OVER (ORDER BY station_id, station_name) AS station_key, station_id,
        station_name FROM pairs UNION ALL SELECT -1, 'UNKNOWN', 'Unknown Station'"""
    ),
    "dim_stable_two_loads": _sql(
        [_RIDERS_FIRST],
        """
SELECT rider_key, rider_id FROM early
UNION ALL
SELECT (SELECT max(rider_key) FROM early) + row_number() OVER (ORDER BY rider_id), rider_id
FROM (SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS rider_id FROM orders
      EXCEPT SELECT rider_id FROM early)
UNION ALL SELECT -1, 'Unknown'""",
    ),
    "dim_rebuild_two_loads": """
SELECT row_number() OVER (ORDER BY rider_id) AS rider_key, rider_id
FROM (SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS rider_id FROM orders)
UNION ALL SELECT -1, 'Unknown'""".strip(),
    "fact_trips": _gold(
        f"""SELECT ride_id, date_key, member_key, bike_key, temp_key, start_station_key,
        end_station_key, year, month, start_hour, {_ISO.format("trip_date")} AS trip_date,
        trip_distance, trip_duration_min, temperature, is_rush_hour, weekend FROM fact_trips"""
    ),
    "avg_duration_monthly": _trips(
        f"""SELECT strftime(started_at, '%Y-%m') AS month,
        ROUND(AVG({_EXACT_MINUTES}), 2) AS avg_trip_duration_min
        FROM trips WHERE ended_at > started_at GROUP BY 1"""
    ),
    "avg_duration_daily": _trips(
        f"""SELECT {_ISO.format("started_at")} AS trip_date,
        ROUND(AVG({_EXACT_MINUTES}), 2) AS avg_trip_duration_min
        FROM trips WHERE ended_at > started_at GROUP BY 1"""
    ),
    "station_demand_top10": _trips(
        """SELECT month, station_id, trips FROM (
          SELECT *, row_number() OVER (PARTITION BY month ORDER BY trips DESC, station_id) AS rn FROM (
            SELECT strftime(started_at, '%Y-%m') AS month, start_station_id AS station_id,
                   count(*) AS trips
            FROM trips WHERE start_station_id IS NOT NULL GROUP BY 1, 2))
        WHERE rn <= 10"""
    ),
    "station_imbalance": _trips("SELECT * FROM flows", _ALL_FLOWS),
    "station_imbalance_category": _trips("SELECT * FROM categorised", _KNOWN_FLOWS, _CATEGORISED),
    "imbalance_summary": _trips(
        """SELECT month, imbalance_category, count(*) AS station_count FROM categorised
        GROUP BY 1, 2""",
        _KNOWN_FLOWS,
        _CATEGORISED,
    ),
    "imbalance_pivot": _trips(
        "SELECT month, "
        + ", ".join(
            f"count(*) FILTER (WHERE imbalance_category = '{c}') AS \"{c}\""
            for c in (
                "Severe overflow", "Mild overflow", "Balanced", "Mild shortage", "Severe shortage",
            )
        )
        + " FROM categorised GROUP BY month",
        _KNOWN_FLOWS,
        _CATEGORISED,
    ),
    "rides_by_month": _trips(
        f"""SELECT {_ISO_TIME.format("CAST(date_trunc('month', started_at) AS TIMESTAMP)")} AS month,
        count(*) AS trips FROM trips GROUP BY 1"""
    ),
    "rides_by_month_label": _trips(
        "SELECT strftime(started_at, '%Y-%m') AS month, count(*) AS trips FROM trips GROUP BY 1"
    ),
    "rides_by_hour": _trips(
        "SELECT CAST(hour(started_at) AS INTEGER) AS hour, count(*) AS trips FROM trips GROUP BY 1"
    ),
    "rides_by_daytype": _trips(
        """SELECT CASE WHEN EXTRACT(DOW FROM started_at) IN (0, 6) THEN 'Weekend' ELSE 'Weekday' END
        AS day_type, count(*) AS trips FROM trips GROUP BY 1"""
    ),
    "rides_by_type": _trips(
        """SELECT member_casual, rideable_type, count(*) AS trips FROM trips
        GROUP BY member_casual, rideable_type"""
    ),
    "rides_by_temp": _joined("SELECT temp, count(*) AS trips FROM joined GROUP BY temp"),
    "rides_by_temp_c": _joined(
        f"""SELECT ROUND({_CELSIUS}, 1) AS temperature_c, count(*) AS trips FROM joined
        WHERE temp IS NOT NULL GROUP BY 1"""
    ),
    "rain_impact": _joined(
        """SELECT CASE WHEN prcp > 0 THEN 'Rainy Day' ELSE 'No Rain' END AS weather_type,
        count(*) AS trips FROM joined GROUP BY 1"""
    ),
    "temp_bucket_impact": _joined(
        f"""SELECT CASE WHEN {_CELSIUS} < 0 THEN 'Below 0°C'
        WHEN {_CELSIUS} <= 10 THEN '0–10°C' WHEN {_CELSIUS} <= 20 THEN '10–20°C'
        WHEN {_CELSIUS} <= 30 THEN '20–30°C' ELSE 'Above 30°C' END AS temp_bucket,
        count(*) AS trips FROM joined WHERE temp IS NOT NULL GROUP BY 1"""
    ),
    "weather_score": _joined(
        f"""SELECT ROUND(AVG(CASE WHEN prcp > 0 THEN -1 WHEN {_CELSIUS} BETWEEN 15 AND 25 THEN 1
        ELSE 0 END), 2) AS weather_impact_score FROM joined"""
    ),
    "kpi_totals": _silver("SELECT count(*) AS total_trips FROM silver"),
    "kpi_bike_type": _silver(
        "SELECT rideable_type, count(*) AS trips FROM silver GROUP BY rideable_type"
    ),
    "kpi_share": _silver(
        """SELECT member_casual, count(*) AS trips,
        ROUND(count(*) / sum(count(*)) OVER (), 6) AS share FROM silver GROUP BY member_casual"""
    ),
    "kpi_distance": _silver(
        """SELECT ROUND(CAST(sum(CAST(trip_distance AS DECIMAL(18, 2))) AS DOUBLE)
        / count(trip_distance), 4) AS avg_trip_distance FROM silver"""
    ),
    "kpi_utilization": _silver(
        """, ends AS (
          SELECT rideable_type, start_station_id AS station_id FROM silver
          UNION ALL SELECT rideable_type, end_station_id FROM silver)
        SELECT rideable_type, station_id, count(*) AS trip_ends,
               ROUND(count(*) / sum(count(*)) OVER (PARTITION BY rideable_type), 6) AS utilisation_rate
        FROM ends GROUP BY rideable_type, station_id"""
    ).replace(") , ends", "), ends"),
    "kpi_fact_imbalance": _silver(
        """, ends AS (
          SELECT year, month, start_station_id AS station_id, 0 AS arr, 1 AS dep FROM silver
          UNION ALL SELECT year, month, end_station_id, 1, 0 FROM silver)
        SELECT year, month, station_id, CAST(sum(arr) AS BIGINT) AS inflow,
               CAST(sum(dep) AS BIGINT) AS outflow,
               CAST(sum(arr) - sum(dep) AS BIGINT) AS imbalance_index
        FROM ends GROUP BY year, month, station_id"""
    ).replace(") , ends", "), ends"),
    "kpi_duration": _silver(
        "SELECT ROUND(AVG(trip_duration_min), 4) AS avg_trip_duration_min FROM silver"
    ),
    "kpi_duration_temp": _silver(
        """SELECT temp_category, count(*) AS trips,
        ROUND(AVG(trip_duration_min), 4) AS avg_trip_duration_min FROM silver GROUP BY temp_category"""
    ),
    "kpi_hours": _silver("SELECT start_hour, count(*) AS trips FROM silver GROUP BY start_hour"),
    "kpi_peak_hour": _silver(
        """SELECT start_hour, count(*) AS trips FROM silver GROUP BY start_hour
        ORDER BY trips DESC, start_hour LIMIT 1"""
    ),
    "kpi_rush_ratio": _silver(
        "SELECT ROUND(AVG(CAST(is_rush_hour AS INTEGER)), 6) AS rush_ratio FROM silver"
    ),
    "kpi_rush_ratio_member": _silver(
        """SELECT member_casual, count(*) AS trips,
        ROUND(AVG(CAST(is_rush_hour AS INTEGER)), 6) AS rush_ratio FROM silver GROUP BY member_casual"""
    ),
    "kpi_weekend_ratio": _silver(
        "SELECT ROUND(AVG(CAST(weekend AS INTEGER)), 6) AS weekend_ratio FROM silver"
    ),
    "kpi_weekend_ratio_member": _silver(
        """SELECT member_casual, count(*) AS trips,
        ROUND(AVG(CAST(weekend AS INTEGER)), 6) AS weekend_ratio FROM silver GROUP BY member_casual"""
    ),
    "kpi_season_daily": _silver(
        """SELECT season, member_casual, count(*) AS trips,
        ROUND(count(*) / count(DISTINCT trip_date), 4) AS avg_daily_trips
        FROM silver GROUP BY season, member_casual"""
    ),
    "null_profile": _joined(
        _tall(
            "joined",
            "column_name",
            "nulls",
            {
                c: f"count(*) - count({c})"
                for c in (
                    *_TRIP_COLUMNS, "trip_date", "temp", "visib", "wdsp", "prcp", "sndp", "frshtt",
                )
            },
        )
    ),
    "rule_counts": _joined(
        _tall(
            "joined",
            "rule",
            "violations",
            {
                "duration not positive": "count(*) FILTER (WHERE ended_at <= started_at)",
                "duration over one day": f"count(*) FILTER (WHERE {_EXACT_MINUTES} > 1440)",
                "negative rain": "count(*) FILTER (WHERE prcp < 0)",
                "wind out of range": "count(*) FILTER (WHERE wdsp < 0 OR wdsp > 150)",
            },
        )
    ),
    "dup_rides": _trips("SELECT count(*) - count(DISTINCT ride_id) AS duplicate_rides FROM trips"),
    "dup_start_slots": _trips(
        f"""SELECT {_ISO_TIME.format("started_at")} AS started_at, count(*) AS copies FROM trips
        GROUP BY 1 HAVING count(*) > 1"""
    ),
    "time_range": _trips(
        f"""SELECT {_ISO_TIME.format("min(started_at)")} AS min_date,
        {_ISO_TIME.format("max(started_at)")} AS max_date FROM trips"""
    ),
    "range_checks": _joined(
        f"""SELECT {_ISO.format("min(trip_date)")} AS first_date,
        {_ISO.format("max(trip_date)")} AS last_date, min(temp) AS min_temp, max(temp) AS max_temp,
        ROUND(min({_CELSIUS}), 6) AS min_temp_c, ROUND(max({_CELSIUS}), 6) AS max_temp_c,
        min(wdsp) AS min_wind, max(wdsp) AS max_wind FROM joined"""
    ),
    "dataset_summary": _trips(
        """SELECT count(*) AS total_rows, count(DISTINCT (start_lat, start_lng)) AS unique_start_points,
        count(*) - count(DISTINCT ride_id) AS duplicate_rides FROM trips"""
    ),
    "trip_dates": _trips(f"SELECT DISTINCT {_ISO.format('started_at')} AS trip_date FROM trips"),
    "date_gaps": _days(
        f"""SELECT {_ISO.format("d")} AS trip_date FROM (
          SELECT CAST(unnest(generate_series(min(trip_date), max(trip_date), INTERVAL 1 DAY)) AS DATE) AS d
          FROM weather)
        WHERE d NOT IN (SELECT trip_date FROM weather)"""
    ),
    "sentinel_counts": _days(
        _tall(
            "weather",
            "column_name",
            "missing_readings",
            {
                c: f"count(*) FILTER (WHERE {c} = 999.9)"
                for c in ("temp", "visib", "wdsp", "prcp", "sndp")
            },
        )
    ),
    "category_audit": _sql(
        [ORDER_DAYS, WEATHER, _CLEAN_WEATHER],
        """
SELECT DISTINCT 'temp, current' AS rule, temp AS reading, CASE WHEN temp >= 75 THEN 'Warm'
  WHEN temp >= 55 THEN 'Moderate' ELSE 'Cool' END AS category FROM clean
UNION ALL SELECT DISTINCT 'temp, notebook', temp, CASE WHEN temp < 40 THEN 'cold'
  WHEN temp <= 70 THEN 'moderate' ELSE 'hot' END FROM clean
UNION ALL SELECT DISTINCT 'prcp, current', prcp, CASE WHEN prcp = 0 THEN 'No Rain'
  WHEN prcp <= 0.1 THEN 'Light' WHEN prcp <= 0.3 THEN 'Moderate' ELSE 'Heavy' END FROM clean
UNION ALL SELECT DISTINCT 'wdsp', wdsp, CASE WHEN wdsp <= 2.5 THEN 'low' WHEN wdsp <= 4.5
  THEN 'moderate' ELSE 'high' END FROM clean""",
    ),
    "short_long_share": _trips(
        f"""SELECT ROUND(count(*) FILTER (WHERE {_EXACT_MINUTES} < 30) / count({_EXACT_MINUTES}), 6)
        AS short_share,
        ROUND(count(*) FILTER (WHERE {_EXACT_MINUTES} > 1440) / count({_EXACT_MINUTES}), 6)
        AS long_share FROM trips"""
    ),
    "station_concentration": _trips(
        """SELECT row_number() OVER w AS place, station_id, trips,
        ROUND(sum(trips) OVER w / sum(trips) OVER (), 6) AS cumulative_share
        FROM (SELECT start_station_id AS station_id, count(*) AS trips FROM trips
              WHERE start_station_id IS NOT NULL GROUP BY 1)
        WINDOW w AS (ORDER BY trips DESC, station_id ROWS UNBOUNDED PRECEDING)"""
    ),
    "weather_events": _days(
        _tall(
            "weather",
            "event",
            "days",
            {
                e: f"count(*) FILTER (WHERE substr(frshtt, {i}, 1) = '1')"
                for i, e in enumerate(("fog", "rain", "snow", "hail", "thunder", "tornado"), 1)
            },
        )
    ),
    "duration_histogram": _histogram("1.0", "120.0", 60),
    "duration_histogram_full": _histogram(
        "(SELECT min(m) FROM d)", "(SELECT max(m) FROM d)", 100
    ),
    "numeric_corr": _silver(
        " UNION ALL ".join(
            f"SELECT '{a}' AS x, '{b}' AS y, ROUND(corr({a}, {b}), 6) AS r FROM silver"
            for i, a in enumerate(_CORR_COLUMNS)
            for b in _CORR_COLUMNS[i:]
        )
    ),
    "describe_trips": _silver(
        " UNION ALL ".join(
            f"""SELECT '{c}' AS column_name, count({c}) AS n, ROUND(avg({c}), 4) AS mean,
            ROUND(stddev_samp({c}), 4) AS stddev, ROUND(min({c}), 4) AS lowest,
            ROUND(max({c}), 4) AS highest FROM silver"""
            for c in _DESCRIBED
        )
    ),
    "describe_text": _trips(
        " UNION ALL ".join(
            f"""SELECT '{c}' AS column_name, count({c}) AS n, min({c}) AS lowest,
            max({c}) AS highest FROM trips"""
            for c in ("ride_id", "rideable_type", "start_station_id", "end_station_name")
        )
    ),
    "dataset_shape": _trips(
        "SELECT count(*) AS total_rows, CAST(13 AS INTEGER) AS total_columns FROM trips"
    ),
    "rows_by_sql": "SELECT count(*) AS total_rows FROM orders",
    "preview": _trips(
        f"""SELECT ride_id, {_ISO_TIME.format("started_at")} AS started_at,
        {_ISO_TIME.format("ended_at")} AS ended_at, rideable_type FROM (
          SELECT * FROM trips ORDER BY trips.started_at, ride_id LIMIT 10)"""
    ),
    "csv_ingest": _trips(_TRIPS_AS_TEXT),
    "layer_roundtrip": _silver(
        """SELECT ride_id, CASE WHEN year >= 1999 THEN 0.0 ELSE trip_distance END AS trip_distance,
        year, month FROM silver"""
    ),
    "missing_layer": _trips(
        "SELECT strftime(started_at, '%Y-%m') AS month, count(*) AS trips FROM trips GROUP BY 1"
    ),
    "gold_catalog": _silver(
        "SELECT year, month, season, count(*) AS trips FROM silver GROUP BY year, month, season"
    ),
    "event_duration_by_day": _sql(
        [EVENT_TRIPS],
        f"""SELECT {_ISO.format("started_at")} AS trip_date,
        ROUND(AVG({_EXACT_MINUTES}), 2) AS avg_trip_duration_min
        FROM trips WHERE ended_at > started_at GROUP BY 1""",
    ),
    "stream_two_drops": _sql(
        [*_EVENTS, _CLEAN_WEATHER, _SILVER],
        """SELECT ride_id, year * 10000 + month * 100 + CAST(day(trip_date) AS INTEGER) AS date_key,
        member_casual, rideable_type, temp_category, start_station_id, end_station_id, start_hour,
        trip_distance, ROUND(trip_duration_min, 6) AS trip_duration_min, is_rush_hour, weekend
        FROM silver""",
    ),
}

ORACLE["zip_ingest"] = _trips(f"SELECT * FROM ({_TRIPS_AS_TEXT})")
ORACLE["season_layer"] = _sql(
    [ORDER_TRIPS],
    f"""SELECT lower({_SEASON.format(d="started_at")}) AS season, count(*) AS trips FROM trips
WHERE length(start_station_id) > 0 AND length(end_station_id) > 0
  AND {_SECONDS} > 60 AND {_SECONDS} < 86400
  AND start_lat BETWEEN 40 AND 41 AND end_lat BETWEEN 40 AND 41
  AND start_lng BETWEEN -74 AND -73.4 AND end_lng BETWEEN -74 AND -73.4 GROUP BY 1""",
)

_NOTEBOOK = f"""
staged AS (
  SELECT *, CASE WHEN ended_at >= started_at AND ROUND({_MINUTES}, 2) <= 1440
                 THEN ROUND({_MINUTES}, 2) END AS trip_duration_minutes,
         COALESCE(start_station_id = end_station_id, FALSE) AS is_round_trip, {_MILES} AS miles
  FROM joined
), notebook AS (
  SELECT *, CASE WHEN is_round_trip THEN NULL ELSE miles END AS trip_distance FROM staged
  WHERE trip_duration_minutes IS NOT NULL AND (is_round_trip OR miles IS NULL OR miles <= 1000)
)"""
ORACLE["notebook_features"] = _sql(
    [*_ORDERS, _PER_DAY, _NOTEBOOK],
    f"""
SELECT ride_id, {_ISO.format("started_at")} AS start_date, strftime(started_at, '%H:%M:%S') AS start_time,
       {_ISO.format("ended_at")} AS end_date, strftime(ended_at, '%H:%M:%S') AS end_time,
       CAST(hour(started_at) AS INTEGER) AS start_hour,
       hour(started_at) BETWEEN 7 AND 9 OR hour(started_at) BETWEEN 16 AND 19 AS is_rush_hour,
       dayname(started_at) AS day_of_week, monthname(started_at) AS month,
       CAST(year(started_at) AS INTEGER) AS year, {_SEASON.format(d="started_at")} AS season,
       trip_duration_minutes, is_round_trip, trip_distance,
       COALESCE(substr(frshtt, 1, 1) = '1', FALSE) AS has_fog,
       COALESCE(substr(frshtt, 2, 1) = '1', FALSE) AS has_rain,
       COALESCE(substr(frshtt, 3, 1) = '1', FALSE) AS has_snow,
       COALESCE(substr(frshtt, 5, 1) = '1', FALSE) AS has_thunder,
       CASE WHEN prcp < 0 THEN 'heavy_rain' WHEN prcp = 0 THEN 'no_rain'
            WHEN prcp <= 0.1 THEN 'light_rain' WHEN prcp <= 0.5 THEN 'moderate_rain'
            ELSE 'heavy_rain' END AS prcp_category,
       CASE WHEN temp < 40 THEN 'cold' WHEN temp <= 70 THEN 'moderate' ELSE 'hot' END
         AS temp_category,
       CASE WHEN wdsp <= 2.5 THEN 'low' WHEN wdsp <= 4.5 THEN 'moderate' ELSE 'high' END
         AS wind_category
FROM notebook""",
)
ORACLE["notebook_distance_summary"] = _sql(
    [*_ORDERS, _PER_DAY, _NOTEBOOK],
    """SELECT ROUND(CAST(sum(CAST(trip_distance AS DECIMAL(18, 2))) AS DOUBLE)
    / count(trip_distance), 4) AS avg_distance, count(*) AS total_trips,
    count(*) - count(trip_distance) AS null_dist_trips FROM notebook""",
)
ORACLE["silver_unknown_weather"] = _sql(
    [*_ORDERS, _CLEAN_WEATHER, _SILVER],
    """SELECT CASE WHEN w.temp >= 75 AND w.temp <> 999.9 THEN 'Warm'
              WHEN w.temp >= 55 AND w.temp <> 999.9 THEN 'Moderate'
              WHEN w.temp <> 999.9 THEN 'Cool' END AS temp_category,
         CASE WHEN w.prcp = 0 THEN 'No Rain' WHEN w.prcp <= 0.1 THEN 'Light'
              WHEN w.prcp <= 0.3 THEN 'Moderate' WHEN w.prcp <> 999.9 THEN 'Heavy' END
           AS prcp_category,
         count(*) AS trips, count(*) FILTER (WHERE w.temp <> 999.9) AS with_temp
  FROM silver s LEFT JOIN weather w ON s.trip_date = w.trip_date GROUP BY 1, 2""",
)
ORACLE["distinct_rides"] = _silver(
    "SELECT year, month, count(*) AS trips FROM silver GROUP BY year, month"
)
ORACLE["event_audit"] = _days(
    """SELECT DISTINCT frshtt, COALESCE(frshtt[1] = '1', FALSE) AS has_fog,
    COALESCE(frshtt[2] = '1', FALSE) AS has_rain, COALESCE(frshtt[3] = '1', FALSE) AS has_snow,
    COALESCE(frshtt[5] = '1', FALSE) AS has_thunder FROM weather"""
)
ORACLE["joined_cast"] = _joined(
    " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count({c}) AS n, ROUND(avg({c}), 4) AS mean,
        ROUND(stddev_samp({c}), 4) AS stddev, ROUND(min({c}), 4) AS lowest,
        ROUND(max({c}), 4) AS highest FROM joined"""
        for c in ("start_lat", "start_lng", "end_lat", "end_lng", "temp", "visib", "wdsp", "prcp", "sndp")
    )
)
ORACLE["excessive_distances"] = _trips(
    """SELECT ride_id, trip_distance, start_lat, start_lng, end_lat, end_lng, end_station_id,
    end_station_name FROM far WHERE trip_distance > 30""",
    f"far AS (SELECT *, {_MILES} AS trip_distance FROM trips)",
)

_FACT_TEXTS = """SELECT ride_id, year * 10000 + month * 100 + CAST(day(trip_date) AS INTEGER) AS date_key,
member_casual, rideable_type, temp_category, start_station_id, end_station_id, start_hour,
trip_distance, ROUND(trip_duration_min, 6) AS trip_duration_min, is_rush_hour, weekend FROM silver"""
ORACLE["lake_two_years"] = _silver(_FACT_TEXTS)
ORACLE["lake_corrected_load"] = _silver(f"{_FACT_TEXTS} WHERE year(started_at) <> 1996")
ORACLE["lake_stream_then_batch"] = _sql([*_EVENTS, _CLEAN_WEATHER, _SILVER], _FACT_TEXTS)
ORACLE["lake_batch_then_stream"] = ORACLE["lake_stream_then_batch"]
_RENAMED = ORDER_TRIPS.replace("), trips AS (", "), plain AS (") + """, trips AS (
  SELECT * REPLACE (CASE WHEN year(started_at) >= 1998 THEN 'New ' || start_station_name
                         ELSE start_station_name END AS start_station_name) FROM plain)"""
ORACLE["dim_station_renamed"] = _sql(
    [_RENAMED, ORDER_DAYS, WEATHER, _CLEAN_WEATHER, _SILVER, _GOLD],
    "SELECT station_id, station_name FROM dim_station",
)

ORACLE["zip_members"] = ORACLE["zip_ingest"]
ORACLE["lake_late_weather"] = ORACLE["stream_two_drops"]
_FULL_WEATHER = WEATHER.replace("SELECT trip_date,", "SELECT trip_date, n,", 1)
ORACLE["season_job"] = (
    ORACLE["legacy_trips"]
    .replace(WEATHER.strip(), _FULL_WEATHER.strip())
    .replace(
        "w.temp, w.visib, w.wdsp, w.prcp,",
        """w.temp, w.visib, w.wdsp, w.prcp, w.temp * 0.5 AS dewp, CAST(1000 + w.n % 40 AS DOUBLE) AS slp,
       CAST(990 + w.n % 30 AS DOUBLE) AS stp, w.wdsp * 2 AS mxspd, w.wdsp * 4 AS gust, w.temp + 5 AS max, w.temp - 5 AS min,""",
    )
)
ORACLE["yearly_job"] = ORACLE["silver_trips"].replace(
    "SELECT * REPLACE (",
    """SELECT * REPLACE (strftime(trip_date, '%m-%d') IN ('01-01', '07-04', '12-25')
                   AND year(trip_date) = year(trip_date - INTERVAL 10 DAY) AS is_holiday, """,
)
ORACLE["feature_table"] = ORACLE["notebook_features"]
ORACLE["typed_views"] = _trips(
    """SELECT member_casual, 'full' AS shape, count(start_station_id) AS with_station, count(ended_at) AS with_end, round(sum(end_lat), 4) AS lat
       FROM trips GROUP BY member_casual
       UNION ALL
       SELECT member_casual, 'short', 0, count(ended_at), round(sum(end_lat), 4) FROM trips GROUP BY member_casual"""
)
_SPARK_TYPES = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "FLOAT": "float", "VARCHAR": "string", "DATE": "date", "TIMESTAMP": "timestamp_ntz"}
ORACLE["schema_of_orders"] = (
    "SELECT CAST(cid + 1 AS INTEGER) AS position, name AS column_name, CASE type "
    + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in _SPARK_TYPES.items())
    + " ELSE type END AS column_type FROM pragma_table_info('orders')"
)
_MOVED = EVENT_TRIPS.replace("), trips AS (", "), plain AS (") + """, trips AS (
  SELECT * REPLACE (started_at + late AS started_at, ended_at + late AS ended_at) FROM (
    SELECT *, CASE WHEN CAST(ride_id AS BIGINT) % 6 = 3 THEN INTERVAL 20 DAY ELSE INTERVAL 0 DAY END AS late FROM plain))"""
ORACLE["lake_moved_rides"] = ORACLE["stream_two_drops"].replace(
    *[text.strip().replace("{events}", "events") for text in (EVENT_TRIPS, _MOVED)]
)
ORACLE["lake_moved_rides_stream_first"] = ORACLE["lake_moved_rides"]

# States after three loads: all of Silver but 1996.
_KEPT = "kept AS (SELECT * FROM silver WHERE year <> 1996)"


def _kept(query: str) -> str:
    return _sql([*_ORDERS, _CLEAN_WEATHER, _SILVER, _KEPT], query)


ORACLE["station_imbalance_incremental"] = _kept(
    """SELECT month, station_id, CAST(sum(i) AS BIGINT) AS inflow, CAST(sum(o) AS BIGINT) AS outflow,
       CAST(sum(i) - sum(o) AS BIGINT) AS imbalance_index
       FROM (SELECT strftime(started_at, '%Y-%m') AS month, start_station_id AS station_id, 0 AS i, 1 AS o FROM kept
             UNION ALL SELECT strftime(started_at, '%Y-%m'), end_station_id, 1, 0 FROM kept) GROUP BY 1, 2"""
)
ORACLE["station_demand_incremental"] = _kept(
    """SELECT month, station_id, trips FROM (
         SELECT *, row_number() OVER (PARTITION BY month ORDER BY trips DESC, station_id) AS rn FROM (
           SELECT strftime(started_at, '%Y-%m') AS month, start_station_id AS station_id, count(*) AS trips FROM kept GROUP BY 1, 2))
       WHERE rn <= 10"""
)
ORACLE["rides_by_hour_incremental"] = _kept("SELECT start_hour, count(*) AS trips FROM kept GROUP BY 1")
ORACLE["corr_from_states"] = _kept(
    " UNION ALL ".join(f"SELECT '{a}' AS x, '{b}' AS y, ROUND(corr({a}, {b}), 6) AS r FROM kept" for i, a in enumerate(_CORR_COLUMNS) for b in _CORR_COLUMNS[i:])
)
ORACLE["distinct_by_sketch"] = _kept("SELECT year, month, count(DISTINCT ride_id) AS exact, TRUE AS near FROM kept GROUP BY 1, 2")
ORACLE["duration_quantiles_by_sketch"] = _kept(
    "SELECT (SELECT count(*) FROM kept) AS trips, share, TRUE AS near FROM (VALUES (0.01E0), (0.25E0), (0.5E0), (0.75E0), (0.99E0)) v(share)"
)

ORACLE["silver_export"] = ORACLE["silver_trips"]
ORACLE["lake_compacted"] = ORACLE["lake_two_years"]
ORACLE["catalog_drift"] = _silver(
    """SELECT year, month, count(*) AS trips, CAST(sum(start_hour) AS BIGINT) AS hours,
       CAST(sum(CAST(round(trip_distance * 100) AS BIGINT)) AS BIGINT) AS distance_cm,
       count(CASE WHEN year <= 1998 THEN weekend END) AS with_weekend,
       count(CASE WHEN year >= 1997 THEN is_rush_hour END) AS with_rush_hour, 'weekend' AS retired
       FROM silver GROUP BY year, month"""
)
_END = """SELECT '{0}' AS role, d.station_id, d.station_name, count(*) AS trips,
       CAST(sum(CAST(round(trip_distance * 100) AS BIGINT)) AS BIGINT) AS distance_cents
       FROM silver s JOIN dim_station d ON s.{0}_station_id = d.station_id GROUP BY 2, 3"""
ORACLE["station_ends_colocated"] = _sql([*_ORDERS, _CLEAN_WEATHER, _SILVER, _GOLD], f"{_END.format('start')} UNION ALL {_END.format('end')}")
ORACLE["fact_unknown_members"] = _sql(
    [*_ORDERS, _CLEAN_WEATHER, _SILVER],
    """SELECT temp_category = 'Unknown' AS unknown, temp_category, count(*) AS trips, count(known) AS with_temperature FROM (
         SELECT CASE WHEN w.temp <> 999.9 THEN w.temp END AS known,
                CASE WHEN w.temp >= 75 AND w.temp <> 999.9 THEN 'Warm' WHEN w.temp >= 55 AND w.temp <> 999.9 THEN 'Moderate'
                     WHEN w.temp <> 999.9 THEN 'Cool' ELSE 'Unknown' END AS temp_category
         FROM silver s LEFT JOIN weather w ON s.trip_date = w.trip_date) GROUP BY temp_category""",
)
_DRAWN = ORDER_TRIPS.replace("), trips AS (", "), plain AS (") + """, trips AS (
  SELECT * REPLACE (CASE WHEN CAST(ride_id AS BIGINT) % 2 = 0 THEN 'HUB' ELSE end_station_id END AS end_station_id,
                    CASE WHEN CAST(ride_id AS BIGINT) % 4 = 1 THEN 'DEPOT' ELSE start_station_id END AS start_station_id) FROM plain)"""
ORACLE["imbalance_of_hubs"] = _sql([_DRAWN, _KNOWN_FLOWS, _CATEGORISED], "SELECT * FROM categorised")
