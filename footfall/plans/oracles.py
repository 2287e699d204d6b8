"""The registered queries as DuckDB SQL over the same tables, written on their own and
without Spark."""

from __future__ import annotations

from footfall.plans.registry import (
    AS_OF,
    CUTOFF,
    DAY,
    LAST_DAY,
    LOCATIONS,
    MAX_AGE_HOURS,
    MAX_NULL_RATE,
    MAX_REJECTION_RATE,
    MIN_ROWS,
)

# Named subqueries, each with the ones it needs before it.
_PARTS = {
    "delivered": "SELECT *, unnest(CASE WHEN event_id % 100 = 7 THEN [1, 2] ELSE [1] END) AS delivery FROM events",
    "filed": """
        SELECT 'device_' || chr(CAST(65 + user_id % 8 AS INTEGER)) AS location,
               ts AS "timestamp",
               CASE WHEN event_id % 97 = 0 THEN NULL
                    WHEN event_type IN ('signup', 'view', 'purchase') THEN CAST(floor(value / 10) AS INTEGER)
                    ELSE 0 END AS "in",
               CASE WHEN event_id % 50 = 0 THEN NULL
                    WHEN event_type IN ('click', 'error', 'purchase') THEN CAST(floor(value / 10) AS INTEGER)
                    ELSE 0 END AS "out",
               CAST(ts AS DATE) + CASE WHEN event_id % 200 = 0 THEN 1 ELSE 0 END AS file_date,
               event_type, value
        FROM delivered""",
    "readings": """SELECT location, "timestamp", "in", "out" FROM filed""",
    "filled": """SELECT location, "timestamp", coalesce("in", 0) AS "in", coalesce("out", 0) AS "out" FROM readings""",
    "hourly_totals": """
        SELECT *, total_in - total_out AS net_flow, CAST(hour AS DATE) AS date
        FROM (SELECT location, CAST(date_trunc('hour', "timestamp") AS TIMESTAMP) AS hour,
                     CAST(sum("in") AS BIGINT) AS total_in, CAST(sum("out") AS BIGINT) AS total_out
              FROM filled GROUP BY 1, 2)""",
    "hourly": """
        SELECT *, CAST(sum(net_flow) OVER (PARTITION BY location, date ORDER BY hour
                       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS occupancy
        FROM hourly_totals""",
    "daily": """
        SELECT location, date, CAST(sum(total_in) AS BIGINT) AS total_in, CAST(sum(total_out) AS BIGINT) AS total_out,
               CAST(sum(total_in) - sum(total_out) AS BIGINT) AS net_flow
        FROM hourly GROUP BY location, date""",
    "unfilled_hourly": """
        SELECT *, CAST(sum(net_flow) OVER (PARTITION BY location, date ORDER BY hour
                       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS occupancy
        FROM (SELECT *, total_in - total_out AS net_flow, CAST(hour AS DATE) AS date
              FROM (SELECT location, CAST(date_trunc('hour', "timestamp") AS TIMESTAMP) AS hour,
                           CAST(sum("in") AS BIGINT) AS total_in, CAST(sum("out") AS BIGINT) AS total_out
                    FROM readings GROUP BY 1, 2))""",
    "faulty": """
        SELECT location,
               CASE WHEN event_type = 'error' THEN strftime("timestamp", '%d/%m/%Y %H:%M')
                    ELSE strftime("timestamp", '%Y-%m-%dT%H:%M:%S.%f') END AS timestamp_text,
               CASE WHEN event_type = 'view' AND value < 1 THEN 'n/a' ELSE CAST("in" AS VARCHAR) END AS in_text,
               CASE WHEN event_type = 'click' AND value > 100 THEN '-' ELSE '' END || CAST("out" AS VARCHAR) AS out_text
        FROM filed""",
    "numbered": """
        SELECT *, TRY_CAST(timestamp_text AS TIMESTAMP) AS "timestamp",
               TRY_CAST(in_text AS INTEGER) AS "in", TRY_CAST(out_text AS INTEGER) AS "out",
               row_number() OVER (PARTITION BY location, timestamp_text, in_text, out_text) AS copy
        FROM faulty""",
    "judged": """
        SELECT *, concat_ws(',', CASE WHEN "timestamp" IS NULL THEN 'bad_timestamp' END,
                                 CASE WHEN in_text = 'n/a' THEN 'malformed' END,
                                 CASE WHEN "in" < 0 OR "out" < 0 THEN 'negative' END) AS row_reasons,
               concat_ws(',', nullif(row_reasons, ''), CASE WHEN copy > 1 THEN 'duplicate' END) AS reject_reasons
        FROM numbered""",
    "valid": """SELECT location, "timestamp", "in", "out" FROM judged WHERE reject_reasons = ''""",
    "valid_hours": """SELECT DISTINCT location, date_trunc('hour', "timestamp") AS hour FROM valid""",
    "earliest": "SELECT min(date) AS date FROM hourly",
}
_NEEDS = {
    "filed": ["delivered"],
    "readings": ["filed"],
    "filled": ["readings"],
    "hourly_totals": ["filled"],
    "hourly": ["hourly_totals"],
    "daily": ["hourly"],
    "unfilled_hourly": ["readings"],
    "faulty": ["filed"],
    "numbered": ["faulty"],
    "judged": ["numbered"],
    "valid": ["judged"],
    "valid_hours": ["valid"],
    "earliest": ["hourly"],
}


def _needed(part: str) -> list[str]:
    return [name for need in _NEEDS.get(part, []) for name in [*_needed(need), need]]


def _with(parts: str, query: str) -> str:
    names = dict.fromkeys(name for part in parts.split() for name in [*_needed(part), part])
    return "WITH " + ", ".join(f"{name} AS ({_PARTS[name]})" for name in names) + " " + query


HOURLY_COLUMNS = "location, hour, date, total_in, total_out, net_flow, occupancy"
_HOURLY = _with("hourly", f"SELECT {HOURLY_COLUMNS} FROM hourly")
_DAILY = _with("daily", "SELECT * FROM daily")
_LOOKUP = _with(
    "hourly",
    f"""SELECT hour, total_in, total_out, net_flow, occupancy, strftime(hour, '%H:%M') AS hour_display
        FROM hourly WHERE location = '{LOCATIONS[0]}' AND date = DATE '{DAY}'""",
)
_BOTH = ", ".join(f"'{name}'" for name in LOCATIONS)


def _profile(by: str = "") -> str:
    """The report over all rows, or per ``by``."""
    nulls = [c for c in ("location", "timestamp", "in", "out") if c != by]
    null_counts = ", ".join(f'count(*) FILTER ("{c}" IS NULL) AS null_{c}' for c in nulls)
    key, group = (f"{by}, ", f" GROUP BY {by}") if by else ("", "")
    distinct = f"(SELECT {key}count(*) AS distinct_rows FROM (SELECT DISTINCT * FROM readings){group})"
    join = f"JOIN {distinct} USING ({by})" if by else f"CROSS JOIN {distinct}"
    return _with(
        "readings",
        f"""SELECT totals.*, distinct_rows, total_rows - distinct_rows AS duplicates
            FROM (SELECT {key}count(*) AS total_rows, {null_counts},
                         min("in") AS min_in, max("in") AS max_in, min("out") AS min_out, max("out") AS max_out,
                         min("timestamp") AS earliest, max("timestamp") AS latest
                  FROM readings{group}) AS totals
            {join}""",
    )


def _null_rows(table: str, source: str, columns: str) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{table}' AS "table", '{c}' AS "column", count(*) FILTER ({c} IS NULL) AS null_rows FROM {source}"""
        for c in columns.split(", ")
    )


DAILY_COLUMNS = "location, date, total_in, total_out, net_flow"

ORACLES: dict[str, str] = {
    # sources
    "scan_readings": _with("readings", "SELECT * FROM readings"),
    "scan_partitioned_readings": _with("filed", 'SELECT location, "timestamp", "in", "out", file_date FROM filed'),
    "device_list": _with("filed", "SELECT DISTINCT location FROM filed"),
    "parse_timestamps": _with(
        "faulty", 'SELECT location, timestamp_text, TRY_CAST(timestamp_text AS TIMESTAMP) AS "timestamp" FROM faulty'
    ),
    "union_feeds": _with(
        "readings",
        """SELECT location, "timestamp", "in", CAST(NULL AS INTEGER) AS "out" FROM readings
           UNION ALL SELECT location, "timestamp", NULL, "out" FROM readings""",
    ),
    # profile
    "profile_row_count": _with("readings", "SELECT count(*) AS total_rows FROM readings"),
    "profile_null_counts": _with(
        "readings",
        " UNION ALL ".join(
            f"""SELECT '{c}' AS "column", count(*) FILTER ("{c}" IS NULL) AS nulls, count(*) AS total_rows
                FROM readings"""
            for c in ("location", "timestamp", "in", "out")
        ),
    ),
    "profile_null_pct": _with(
        "readings",
        "SELECT * FROM ("
        + " UNION ALL ".join(
            f"""SELECT '{c}' AS "column", count(*) FILTER ("{c}" IS NULL) AS nulls,
                       round(100.0::DOUBLE * count(*) FILTER ("{c}" IS NULL) / count(*), 1) AS null_pct FROM readings"""
            for c in ("location", "timestamp", "in", "out")
        )
        + ") WHERE nulls > 0",
    ),
    "profile_value_ranges": _with(
        "readings",
        " UNION ALL ".join(
            f"""SELECT '{c}' AS "column", min("{c}") AS min, max("{c}") AS max FROM readings""" for c in ("in", "out")
        ),
    ),
    "profile_duplicates": _with(
        "readings",
        """SELECT count(*) AS total_rows, (SELECT count(*) FROM (SELECT DISTINCT * FROM readings)) AS distinct_rows,
                  count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM readings)) AS duplicates FROM readings""",
    ),
    "profile_time_range": _with(
        "readings", 'SELECT min("timestamp") AS earliest, max("timestamp") AS latest FROM readings'
    ),
    "profile_report": _profile(),
    "profile_by_location": _profile("location"),
    # cleansing
    "fill_missing": _with("filled", "SELECT * FROM filled"),
    "cleanse_counts": _with(
        "readings",
        """SELECT count(*) AS rows_before, count(*) AS rows_after, count(*) FILTER ("in" IS NULL) AS filled_in,
                  count(*) FILTER ("out" IS NULL) AS filled_out FROM readings""",
    ),
    # totals
    "hour_bucket": _with(
        "readings",
        """SELECT location, "timestamp", CAST(date_trunc('hour', "timestamp") AS TIMESTAMP) AS hour FROM readings""",
    ),
    "hourly_totals": _with("hourly_totals", "SELECT * FROM hourly_totals"),
    "hourly_occupancy": _HOURLY,
    "hourly_sorted": _HOURLY + " ORDER BY location, hour",
    "daily_totals": _DAILY,
    "daily_sorted": _DAILY + " ORDER BY location, date",
    # sinks and contract
    "sink_hourly_roundtrip": _HOURLY,
    "sink_daily_roundtrip": _DAILY,
    "sink_full_refresh": _HOURLY,
    "load_report": _with(
        "daily",
        """SELECT 'hourly' AS "table", (SELECT count(*) FROM hourly) AS rows, 'loaded' AS status
           UNION ALL SELECT 'daily', (SELECT count(*) FROM daily), 'loaded'""",
    ),
    "contract_violations": _with(
        "unfilled_hourly",
        f"""SELECT "table", "column", kind, expected, actual, CAST(null_rows AS BIGINT) AS null_rows
            FROM (VALUES ('hourly', 'total_out', 'wrong_type', 'bigint', 'int', NULL),
                         ('hourly', 'net_flow', 'missing_column', 'bigint', NULL, NULL),
                         ('hourly', 'flow', 'unexpected_column', NULL, 'bigint', NULL),
                         ('daily', NULL, 'missing_table', NULL, NULL, NULL))
                 AS found("table", "column", kind, expected, actual, null_rows)
            UNION ALL SELECT "table", "column", 'null_value', NULL, NULL, null_rows
            FROM ({_null_rows("hourly", "unfilled_hourly", "location, hour, date, total_in, total_out, occupancy")})
            WHERE null_rows > 0""",
    ),
    "contract_null_check": _with(
        "daily unfilled_hourly",
        " UNION ALL ".join(
            [
                _null_rows("hourly", "hourly", HOURLY_COLUMNS),
                _null_rows("daily", "daily", DAILY_COLUMNS),
                _null_rows("hourly_unfilled", "unfilled_hourly", HOURLY_COLUMNS),
            ]
        ),
    ),
    # lookups
    "available_dates": _with("hourly", "SELECT DISTINCT date FROM hourly ORDER BY date"),
    "default_date": _with("earliest", "SELECT date FROM earliest"),
    "hourly_lookup": _LOOKUP,
    "day_summary": _with(
        "hourly",
        f"""SELECT CAST(coalesce(sum(total_in), 0) AS BIGINT) AS total_in,
                   CAST(coalesce(sum(total_out), 0) AS BIGINT) AS total_out
            FROM hourly WHERE location = '{LOCATIONS[0]}' AND date = DATE '{DAY}'""",
    ),
    "device_comparison": _with(
        "hourly",
        "SELECT hour, "
        + ", ".join(
            f"""max(net_flow) FILTER (location = '{name}') AS {name}_net_flow,
                max(occupancy) FILTER (location = '{name}') AS {name}_occupancy"""
            for name in LOCATIONS
        )
        + f" FROM hourly WHERE date = DATE '{DAY}' AND location IN ({_BOTH}) GROUP BY hour",
    ),
    "in_out_split": _with(
        "hourly",
        f"""SELECT location, CAST(sum(total_in) AS BIGINT) AS total_in, CAST(sum(total_out) AS BIGINT) AS total_out
            FROM hourly WHERE date = DATE '{DAY}' GROUP BY location""",
    ),
    "daily_lookup": _with(
        "daily",
        f"""SELECT * FROM daily WHERE date BETWEEN DATE '{DAY}' AND DATE '{LAST_DAY}' AND location IN ({_BOTH})""",
    ),
    "dashboard_hours": _with(
        "earliest",
        f"""SELECT location, hour, total_in, total_out, net_flow, occupancy, strftime(hour, '%H:%M') AS hour_display
            FROM hourly WHERE date = (SELECT date FROM earliest) AND location IN ({_BOTH})""",
    ),
    "dashboard_summary": _with(
        "earliest",
        f"""SELECT location, CAST(coalesce(sum(total_in), 0) AS BIGINT) AS total_in,
                   CAST(coalesce(sum(total_out), 0) AS BIGINT) AS total_out
            FROM (SELECT unnest([{_BOTH}, 'device_none']) AS location)
            LEFT JOIN (SELECT * FROM hourly WHERE date = (SELECT date FROM earliest)) USING (location)
            GROUP BY location""",
    ),
    # rejects, monitoring and gates
    "misfiled_readings": _with(
        "filed",
        """SELECT location, file_date, CAST("timestamp" AS DATE) AS event_date, count(*) AS rows,
                  CAST(coalesce(sum("in"), 0) AS BIGINT) AS total_in,
                  CAST(coalesce(sum("out"), 0) AS BIGINT) AS total_out
           FROM filed WHERE CAST("timestamp" AS DATE) <> file_date GROUP BY 1, 2, 3""",
    ),
    "rejected_readings": _with(
        "judged",
        """SELECT location, "timestamp", CASE WHEN "timestamp" IS NULL THEN timestamp_text END AS timestamp_text,
                  "in", "out", reject_reasons, count(*) AS copies
           FROM judged WHERE reject_reasons <> ''
           GROUP BY location, "timestamp", judged.timestamp_text, in_text, out_text, "in", "out", reject_reasons""",
    ),
    "valid_readings": _with("valid", "SELECT * FROM valid"),
    "rejection_rate": _with(
        "judged",
        f"""SELECT *, rejected_rows / total_rows AS rejection_rate,
                   rejected_rows / total_rows > {MAX_REJECTION_RATE} AS alert
            FROM (SELECT location, count(*) AS total_rows, count(*) FILTER (row_reasons <> '') AS rejected_rows
                  FROM judged GROUP BY location)""",
    ),
    "device_progress": _with(
        "filed",
        """SELECT location, max("timestamp") AS last_timestamp, count(DISTINCT file_date) AS files, count(*) AS rows
           FROM filed GROUP BY location""",
    ),
    "stage_row_counts": _with(
        "judged valid valid_hours",
        """SELECT 'raw' AS stage, count(*) AS rows FROM judged
           UNION ALL SELECT 'rejected', count(*) FROM judged WHERE reject_reasons <> ''
           UNION ALL SELECT 'profiled', count(*) FROM judged
           UNION ALL SELECT 'cleaned', count(*) FROM valid
           UNION ALL SELECT 'hourly', count(*) FROM valid_hours
           UNION ALL SELECT 'daily', count(*) FROM (SELECT DISTINCT location, CAST(hour AS DATE) FROM valid_hours)""",
    ),
    "gate_null_rate": _with(
        "readings",
        " UNION ALL ".join(
            f"""SELECT 'null_rate' AS gate, '{c}' AS key, avg(CASE WHEN "{c}" IS NULL THEN 1.0 ELSE 0.0 END) AS value,
                       CAST({MAX_NULL_RATE} AS DOUBLE) AS threshold,
                       count(*) FILTER ("{c}" IS NULL) / count(*) <= {MAX_NULL_RATE} AS passed FROM readings"""
            for c in ("in", "out")
        ),
    ),
    "gate_min_rows": _with(
        "readings",
        f"""SELECT 'min_rows' AS gate, location || '/' || CAST(CAST("timestamp" AS DATE) AS VARCHAR) AS key,
                   CAST(count(*) AS DOUBLE) AS value, CAST({MIN_ROWS} AS DOUBLE) AS threshold,
                   count(*) >= {MIN_ROWS} AS passed
            FROM readings GROUP BY location, CAST("timestamp" AS DATE)""",
    ),
    "gate_max_age": _with(
        "readings",
        f"""SELECT 'max_age' AS gate, location AS key, age AS value, CAST({MAX_AGE_HOURS} AS DOUBLE) AS threshold,
                   age <= {MAX_AGE_HOURS} AS passed
            FROM (SELECT location,
                         date_diff('microsecond', max("timestamp"), TIMESTAMP '{AS_OF}') / CAST(3.6e9 AS DOUBLE) AS age
                  FROM readings GROUP BY location)""",
    ),
    "gate_null_rate_faulty": _with(
        "numbered",
        " UNION ALL ".join(
            f"""SELECT 'null_rate' AS gate, '{c}' AS key, avg(CASE WHEN "{c}" IS NULL THEN 1.0 ELSE 0.0 END) AS value,
                       CAST({MAX_NULL_RATE} AS DOUBLE) AS threshold,
                       count(*) FILTER ("{c}" IS NULL) / count(*) <= {MAX_NULL_RATE} AS passed FROM numbered"""
            for c in ("in", "out")
        ),
    ),
    "gate_min_rows_faulty": _with(
        "judged",
        f"""SELECT 'min_rows' AS gate, location || '/' || CAST(day AS VARCHAR) AS key, CAST(n AS DOUBLE) AS value,
                   CAST({MIN_ROWS} AS DOUBLE) AS threshold, n >= {MIN_ROWS} AS passed
            FROM (SELECT days.location, days.day, count(r.location) AS n
                  FROM (SELECT location, CAST(unnest(generate_series(first, last, INTERVAL 1 DAY)) AS DATE) AS day
                        FROM (SELECT location, min(CAST(ts AS DATE)) AS first, max(CAST(ts AS DATE)) AS last
                              FROM (SELECT 'device_' || chr(CAST(65 + user_id % 8 AS INTEGER)) AS location, ts
                                    FROM events) WHERE CAST(ts AS DATE) <> DATE '{DAY}' GROUP BY location)) AS days
                  LEFT JOIN (SELECT location, CAST("timestamp" AS DATE) AS day FROM judged
                             WHERE row_reasons = '' AND CAST("timestamp" AS DATE) <> DATE '{DAY}') AS r
                  ON r.location = days.location AND r.day = days.day GROUP BY days.location, days.day)""",
    ),
    "batch_profile": _with(
        "numbered",
        """SELECT count(*) AS total_rows, count(*) FILTER (copy = 1) AS distinct_rows,
                  count(*) FILTER (copy > 1) AS duplicates, count(*) FILTER ("timestamp" IS NULL) AS null_timestamp,
                  count(*) FILTER ("in" IS NULL) AS null_in, count(*) FILTER ("out" IS NULL) AS null_out FROM numbered""",
    ),
    "batch_misfiled": _with(
        "filed",
        """SELECT location, file_date, CAST("timestamp" AS DATE) AS event_date, count(*) AS rows,
                  CAST(coalesce(sum("in"), 0) AS BIGINT) AS total_in,
                  CAST(coalesce(sum("out"), 0) AS BIGINT) AS total_out
           FROM filed WHERE CAST("timestamp" AS DATE) <> file_date GROUP BY 1, 2, 3""",
    ),
    "gate_max_age_silent": _with(
        "readings",
        f"""SELECT 'max_age' AS gate, location AS key, age AS value, CAST({MAX_AGE_HOURS} AS DOUBLE) AS threshold,
                   coalesce(age <= {MAX_AGE_HOURS}, false) AS passed
            FROM (SELECT location, date_diff('microsecond', latest, TIMESTAMP '{AS_OF}') / CAST(3.6e9 AS DOUBLE) AS age
                  FROM (SELECT location, max("timestamp") FILTER (location <> '{LOCATIONS[1]}') AS latest
                        FROM readings GROUP BY location
                        UNION ALL SELECT 'device_none', NULL))""",
    ),
    # incremental
    "stream_equals_batch": _HOURLY,
    "ingest_profile": _with(
        "numbered",
        """SELECT 2 * count(*) AS total_rows, count(*) FILTER (copy = 1) AS distinct_rows,
                  count(*) + count(*) FILTER (copy > 1) AS duplicates,
                  2 * count(*) FILTER ("timestamp" IS NULL) AS null_timestamp,
                  2 * count(*) FILTER ("in" IS NULL) AS null_in, 2 * count(*) FILTER ("out" IS NULL) AS null_out FROM numbered""",
    ),
    "ingest_drop_duplicates": _with(
        "readings",
        """SELECT *, CAST(sum(net_flow) OVER (PARTITION BY location, date ORDER BY hour
                         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS occupancy
           FROM (SELECT *, total_in - total_out AS net_flow, CAST(hour AS DATE) AS date
                 FROM (SELECT location, CAST(date_trunc('hour', "timestamp") AS TIMESTAMP) AS hour,
                              CAST(coalesce(sum("in"), 0) AS BIGINT) AS total_in,
                              CAST(coalesce(sum("out"), 0) AS BIGINT) AS total_out
                       FROM (SELECT DISTINCT location, "timestamp", "in", "out" FROM readings) GROUP BY 1, 2))""",
    ),
    "ingest_misfiled": _with(
        "filed",
        """SELECT location, file_date, CAST("timestamp" AS DATE) AS event_date, count(*) AS rows,
                  CAST(coalesce(sum("in"), 0) AS BIGINT) AS total_in,
                  CAST(coalesce(sum("out"), 0) AS BIGINT) AS total_out
           FROM filed WHERE CAST("timestamp" AS DATE) <> file_date GROUP BY 1, 2, 3""",
    ),
    "ingest_monthly_trend": _with(
        "daily",
        """SELECT location, CAST(date_trunc('month', date) AS DATE) AS month,
                  CAST(grouping(location, CAST(date_trunc('month', date) AS DATE)) AS INTEGER) AS level,
                  CAST(sum(total_in) AS BIGINT) AS total_in, CAST(sum(total_out) AS BIGINT) AS total_out,
                  CAST(sum(net_flow) AS BIGINT) AS net_flow
           FROM daily GROUP BY ROLLUP (location, CAST(date_trunc('month', date) AS DATE))""",
    ),
    "retention_then_late_rows": _DAILY + f" WHERE date >= DATE '{CUTOFF}'",
    "incremental_equals_batch": _HOURLY,
    "incremental_grown_files": _HOURLY,
    "incremental_progress": _with(
        "filed",
        """SELECT location, max("timestamp") AS last_timestamp, count(DISTINCT file_date) AS files, count(*) AS rows
           FROM filed GROUP BY location""",
    ),
    "upsert_withdrawn_day": _DAILY + f" WHERE date <> DATE '{LAST_DAY}'",
    "upsert_dates": _HOURLY,
    # partitions and trends
    "partition_pruned_lookup": _LOOKUP,
    "retention_filter": _HOURLY + f" WHERE date >= DATE '{CUTOFF}'",
    "retention_drop": _HOURLY + f" WHERE date >= DATE '{CUTOFF}'",
    "loaded_dates": _with("hourly", "SELECT DISTINCT date FROM hourly"),
    "default_loaded_date": _with("earliest", "SELECT date FROM earliest"),
    "empty_load": """SELECT * FROM (VALUES ('hourly', CAST(0 AS BIGINT), 'skipped'), ('daily', CAST(0 AS BIGINT), 'skipped'))
                     AS loads("table", rows, status)""",
    "monthly_trend": _with(
        "daily",
        """SELECT location, CAST(date_trunc('month', date) AS DATE) AS month,
                  CAST(grouping(location, CAST(date_trunc('month', date) AS DATE)) AS INTEGER) AS level,
                  CAST(sum(total_in) AS BIGINT) AS total_in, CAST(sum(total_out) AS BIGINT) AS total_out,
                  CAST(sum(net_flow) AS BIGINT) AS net_flow
           FROM daily GROUP BY ROLLUP (location, CAST(date_trunc('month', date) AS DATE))""",
    ),
    "day_over_day": _with(
        "daily",
        """SELECT location, date, total_in, previous_in, total_in - previous_in AS change,
                  CAST(total_in - previous_in AS DOUBLE) / nullif(previous_in, 0) AS change_ratio
           FROM (SELECT *, lag(total_in) OVER (PARTITION BY location ORDER BY date) AS previous_in FROM daily)""",
    ),
    "trailing_avg": _with(
        "daily",
        """SELECT location, date, avg(total_in) OVER last_days AS avg_in, avg(total_out) OVER last_days AS avg_out
           FROM daily
           WINDOW last_days AS (PARTITION BY location ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""",
    ),
}
