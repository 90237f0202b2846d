"""DuckDB oracle SQL for the taxi feature queries (the driver registers each table as a view)."""

# The January range of the feature functions, end exclusive (as in the
# reference, the last day of the month is left out), and the split used for upserts.
JAN_START = "2024-01-01 00:00:00"
JAN_END = "2024-01-31 00:00:00"
MID_JAN = "2024-01-16 00:00:00"

TRIPS_CTE = """
trips AS (
  SELECT user_id AS pickup_zip,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS dropoff_zip,
         ts AS tpep_pickup_datetime,
         ts + to_minutes(CAST(json_extract_string(props, '$.k') AS INTEGER) + 5) AS tpep_dropoff_datetime,
         value AS fare_amount,
         CAST(json_extract_string(props, '$.k') AS INTEGER) / 10.0 AS trip_distance
  FROM events)"""


def pickup_sql(start: str = JAN_START, end: str = JAN_END, name: str = "pickup") -> str:
    return f"""{name}_w AS (
  SELECT pickup_zip,
         unnest(range(epoch_us(tpep_pickup_datetime) // 900000000 + 1,
                      epoch_us(tpep_pickup_datetime) // 900000000 + 5)) AS eb,
         fare_amount
  FROM trips
  WHERE tpep_pickup_datetime >= TIMESTAMP '{start}' AND tpep_pickup_datetime < TIMESTAMP '{end}'),
{name} AS (
  SELECT pickup_zip AS zip, CAST(eb * 900 AS INTEGER) AS ts,
         strftime(make_timestamp(eb * 900000000), '%Y-%m') AS yyyy_mm,
         CAST(avg(fare_amount) AS FLOAT) AS mean_fare_window_1h_pickup_zip,
         CAST(count(*) AS INTEGER) AS count_trips_window_1h_pickup_zip
  FROM {name}_w GROUP BY pickup_zip, eb)"""


def dropoff_sql(start: str = JAN_START, end: str = JAN_END, name: str = "dropoff") -> str:
    return f"""{name}_g AS (
  SELECT dropoff_zip, epoch_us(tpep_dropoff_datetime) // 1800000000 + 1 AS eb, count(*) AS n
  FROM trips
  WHERE tpep_dropoff_datetime >= TIMESTAMP '{start}' AND tpep_dropoff_datetime < TIMESTAMP '{end}'
  GROUP BY 1, 2),
{name} AS (
  SELECT dropoff_zip AS zip, CAST(eb * 1800 AS INTEGER) AS ts,
         strftime(make_timestamp(eb * 1800000000), '%Y-%m') AS yyyy_mm,
         CAST(n AS INTEGER) AS count_trips_window_30m_dropoff_zip,
         CAST(isodow(timezone('America/New_York', timezone('UTC', make_timestamp(eb * 1800000000)))) >= 6 AS INTEGER)
           AS dropoff_is_weekend
  FROM {name}_g)"""


PICKUP_FEATURES = f"WITH {TRIPS_CTE},\n{pickup_sql()}\nSELECT * FROM pickup"
DROPOFF_FEATURES = f"WITH {TRIPS_CTE},\n{dropoff_sql()}\nSELECT * FROM dropoff"
RIDES_BY_WEEKEND = f"""WITH {TRIPS_CTE},
{dropoff_sql()}
SELECT CAST(SUM(count_trips_window_30m_dropoff_zip) AS BIGINT) AS num_rides, dropoff_is_weekend
FROM dropoff WHERE dropoff_is_weekend IS NOT NULL GROUP BY dropoff_is_weekend"""


def merged_sql(kind: str, name: str) -> str:
    """Feature table after create on [Jan 1, Jan 16) and a keyed merge of [Jan 16, Jan 31)."""
    fn = pickup_sql if kind == "pickup" else dropoff_sql
    return f"""{fn(JAN_START, MID_JAN, name + '_a')},
{fn(MID_JAN, JAN_END, name + '_b')},
{name} AS (
  SELECT * FROM {name}_a a
  WHERE NOT EXISTS (SELECT 1 FROM {name}_b b WHERE b.zip = a.zip AND b.ts = a.ts)
  UNION ALL SELECT * FROM {name}_b)"""


ROUNDED_CTE = """taxi_data AS (
  SELECT fare_amount, trip_distance, pickup_zip, dropoff_zip,
         CAST(((epoch_us(tpep_pickup_datetime) + 899999999) // 900000000) * 900 AS INTEGER) AS rounded_pickup_datetime,
         CAST(((epoch_us(tpep_dropoff_datetime) + 1799999999) // 1800000000) * 1800 AS INTEGER) AS rounded_dropoff_datetime
  FROM trips)"""

FEATURE_UPSERT = f"WITH {TRIPS_CTE},\n{merged_sql('pickup', 'pk')}\nSELECT * FROM pk"
TAXI_ROUNDED = f"WITH {TRIPS_CTE},\n{ROUNDED_CTE}\nSELECT * FROM taxi_data"
TRAINING_SET = f"""WITH {TRIPS_CTE},
{ROUNDED_CTE},
{merged_sql('pickup', 'pk')},
{merged_sql('dropoff', 'dk')}
SELECT t.fare_amount, t.trip_distance, t.pickup_zip, t.dropoff_zip,
       p.mean_fare_window_1h_pickup_zip, p.count_trips_window_1h_pickup_zip,
       d.count_trips_window_30m_dropoff_zip, d.dropoff_is_weekend
FROM taxi_data t
LEFT JOIN pk p ON p.zip = t.pickup_zip AND p.ts = t.rounded_pickup_datetime
LEFT JOIN dk d ON d.zip = t.dropoff_zip AND d.ts = t.rounded_dropoff_datetime"""


# Complete windows over January: rows read from one window length before the start,
# windows kept when their end lies in (start, end].
PICKUP_FEATURES_COMPLETE = f"""WITH {TRIPS_CTE},
{pickup_sql("2023-12-31 23:00:00", JAN_END)}
SELECT * FROM pickup
WHERE ts > CAST(epoch(TIMESTAMP '{JAN_START}') AS INTEGER) AND ts <= CAST(epoch(TIMESTAMP '{JAN_END}') AS INTEGER)"""

TRIPS_SAMPLE = f"""WITH {TRIPS_CTE}
SELECT * FROM trips
WHERE tpep_pickup_datetime >= TIMESTAMP '{JAN_START}' AND tpep_pickup_datetime < TIMESTAMP '{MID_JAN}'
  AND substr(md5('123|' || pickup_zip || '|' || dropoff_zip || '|' || epoch_us(tpep_pickup_datetime)), 1, 8) < '19999999'"""

SCORE_BATCH = TRAINING_SET.replace("SELECT t.fare_amount,", "SELECT true AS predicted, true AS two_digits, true AS beats_mean, CAST(0.2 AS DOUBLE) AS held_out_share, t.rounded_pickup_datetime, t.rounded_dropoff_datetime, t.fare_amount,")

FEATURE_CATALOG = f"""WITH {TRIPS_CTE},
{merged_sql('pickup', 'pk')},
{merged_sql('dropoff', 'dk')}
SELECT 'trip_pickup_features' AS name, 'Hourly fares and trips by pickup zip, every quarter hour' AS description, 'zip,ts' AS primary_keys,
       'yyyy_mm' AS partition_columns, count(*) AS row_count, CAST(2 AS BIGINT) AS version FROM pk
UNION ALL
SELECT 'trip_dropoff_features', 'Half-hourly trips by drop-off zip, with a weekend flag', 'zip,ts', 'yyyy_mm', count(*), 2 FROM dk"""

UPSERT_TWO_MONTHS = f"""WITH {TRIPS_CTE},
{pickup_sql()},
later AS (
  SELECT zip, CAST(ts + 31 * 86400 AS INTEGER) AS ts, strftime(make_timestamp((CAST(ts AS BIGINT) + 31 * 86400) * 1000000), '%Y-%m') AS yyyy_mm,
         mean_fare_window_1h_pickup_zip, count_trips_window_1h_pickup_zip
  FROM pickup)
SELECT zip, ts, yyyy_mm, mean_fare_window_1h_pickup_zip,
       CAST(count_trips_window_1h_pickup_zip + CASE WHEN ts >= epoch(TIMESTAMP '{MID_JAN}') THEN 1000 ELSE 0 END AS INTEGER) AS count_trips_window_1h_pickup_zip
FROM pickup p WHERE NOT EXISTS (SELECT 1 FROM later l WHERE l.zip = p.zip AND l.ts = p.ts)
UNION ALL SELECT * FROM later"""

TRIP_LABELS = f"""WITH {TRIPS_CTE}
SELECT pickup_zip, dropoff_zip, fare_amount, strftime(tpep_pickup_datetime, '%Y-%m') AS month,
       CAST(isodow(timezone('America/New_York', timezone('UTC', tpep_dropoff_datetime))) >= 6 AS INTEGER) AS is_weekend,
       CAST(((epoch_us(tpep_pickup_datetime) + 899999999) // 900000000) * 900 AS INTEGER) AS pickup_mark,
       CAST(((epoch_us(tpep_dropoff_datetime) + 1799999999) // 1800000000) * 1800 AS INTEGER) AS dropoff_mark
FROM trips"""

CLONE_FEATURES = f"""WITH {TRIPS_CTE},
{merged_sql('pickup', 'pk')}
SELECT 'source' AS table_name, * FROM pk_a UNION ALL SELECT 'clone', * FROM pk"""
