"""The same results as plain SQL over the same tables."""

from __future__ import annotations

_USERS = """
WITH users AS (
  SELECT CAST(c_custkey AS VARCHAR)                                AS user_id,
         CASE WHEN c_custkey % 2 = 0 THEN 'male' ELSE 'female' END AS gender,
         c_name                                                    AS full_name,
         n_name                                                    AS country,
         CAST(18 + c_custkey % 60 AS INT)                          AS age,
         concat(lower(c_name), '@example.com')                     AS email,
         1704067200 + 10 * CAST(floor(c_custkey / 10) AS BIGINT)   AS ingestion_timestamp,
         make_timestamp(1000000 * (1704067200 + 10 * CAST(floor(c_custkey / 10) AS BIGINT)))
                                                                   AS ingestion_time
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
), stats AS (
  SELECT country, count(*) AS count_users, avg(age) AS avg_age, max(ingestion_time) AS last_update
  FROM users WHERE country IS NOT NULL GROUP BY country
)
"""

_ALL = "SELECT user_id, gender, full_name, country, age, email, ingestion_time FROM users"
_LATEST = f"{_ALL} ORDER BY ingestion_time DESC, user_id LIMIT 10"
_STORED = "SELECT user_id, country, age FROM users"
_STATS = "SELECT country, count_users, avg_age, last_update FROM stats"
_SINKS = """
SELECT s.sink, count(*) AS n
FROM users CROSS JOIN (VALUES ('debug'), ('append'), ('keyed')) AS s(sink) GROUP BY s.sink
"""
# The listing's labels are the public contract.
_LISTING = f"""
SELECT user_id AS "ID", full_name AS "Nom Complet", gender AS "Genre", age AS "Âge",
       country AS "Pays", email AS "Email", ingestion_time AS "Date d'ingestion"
FROM ({_LATEST})
"""

_OVER_USERS = {
    "src_message_stream": _ALL,
    "scan_users": _ALL,
    "scan_country_stats": _STATS,
    "ddl_users_schema": _ALL,
    "src_cadence": """
        SELECT 1704067200 + 10 * CAST(floor(number / 10) AS BIGINT) AS ingestion_timestamp,
               count(*) AS n_users
        FROM (SELECT row_number() OVER (ORDER BY c_custkey) - 1 AS number FROM customer)
        GROUP BY 1
    """,
    "decode_value": "SELECT full_name AS name FROM users",
    "json_props": "SELECT event_id, CAST(json_extract(props, '$.k') AS INT) AS k FROM events",
    "parse_flat_users": """
        SELECT TRY_CAST(user_id AS INT) AS id, full_name AS name, email, age, country FROM users
    """,
    "flatten_users": _ALL,
    "stamp_ingestion": "SELECT user_id, ingestion_timestamp FROM users",
    "ingestion_time": "SELECT user_id, ingestion_timestamp, ingestion_time FROM users",
    "full_name": "SELECT c_custkey, replace(c_name, '#', ' ') AS full_name FROM customer",
    "quarantine": """
        SELECT reason, count(*) AS n FROM (
          SELECT CASE WHEN CAST(user_id AS BIGINT) % 50 = 0 THEN 'no user_id'
                      WHEN ingestion_timestamp % 400 = 0 THEN 'bad ingestion_time' ELSE 'usable' END
                 AS reason FROM users
          UNION ALL
          SELECT 'bad age' FROM users
          WHERE age % 10 = 7 AND CAST(user_id AS BIGINT) % 50 <> 0 AND ingestion_timestamp % 400 <> 0
          UNION ALL
          SELECT CASE WHEN trim(text) = '' THEN 'empty message' ELSE 'malformed' END FROM documents
        ) GROUP BY reason
    """,
    "publish_envelopes": """
        SELECT ingestion_time, count(*) AS n_users, TRUE AS within_size
        FROM users GROUP BY ingestion_time
    """,
    "kpi_total_users": "SELECT count(*) AS total_users FROM users",
    "gender_counts": "SELECT gender, count(*) AS count FROM users GROUP BY gender",
    "gender_share": """
        SELECT gender, count(*) AS count, count(*) / sum(count(*)) OVER () AS share
        FROM users GROUP BY gender
    """,
    "country_stats": _STATS,
    "kpi_countries": "SELECT count(*) AS countries FROM stats HAVING count(*) > 0",
    "kpi_avg_age": """
        SELECT round(avg(avg_age), 6) AS avg_age FROM stats HAVING count(*) > 0
    """,
    "kpi_avg_age_text": """
        SELECT printf('%.1f', avg(avg_age)) || ' ans' AS avg_age_text
        FROM stats HAVING count(*) > 0
    """,
    "kpi_empty_guard": """
        SELECT 'everywhere' AS scope, round(avg(avg_age), 6) AS avg_age FROM stats HAVING count(*) > 0
        UNION ALL
        SELECT 'nowhere', round(avg(age), 6) FROM users WHERE country IS NULL HAVING count(*) > 0
    """,
    "top_countries": """
        SELECT country, count_users FROM stats ORDER BY count_users DESC, country LIMIT 10
    """,
    "top_age_countries": """
        SELECT country, avg_age FROM stats ORDER BY avg_age DESC NULLS LAST, country LIMIT 10
    """,
    "latest_users": _LATEST,
    "user_listing": _LISTING,
    "refresh_text": "SELECT user_id, strftime(ingestion_time, '%Y-%m-%d %H:%M:%S') AS t FROM users",
    "users_last_write": """
        SELECT user_id, gender, full_name, country, CAST(age + 1 AS INT) AS age, email,
               ingestion_time FROM users
    """,
    "dedup_users": _ALL,
    "sink_debug": _STORED,
    "sink_append": _STORED,
    "sink_keyed": _STORED,
    "sink_fanout_counts": _SINKS,
    "sink_shared_counts": _SINKS,
    "restart_no_duplicates": _STORED,
    "country_stats_stream": _STATS,
    "country_stats_latest": _STATS,
    "dashboard_kpis": """
        SELECT (SELECT count(*) FROM users) AS total_users, count(*) AS countries,
               round(avg(avg_age), 6) AS avg_age, printf('%.1f', avg(avg_age)) || ' ans'
               AS avg_age_text
        FROM stats
    """,
    "dashboard_latest": _LISTING,
    "dashboard_charts": """
        SELECT * FROM (SELECT 'top_countries' AS chart, country AS label, CAST(count_users AS DOUBLE) AS value
                       FROM stats ORDER BY count_users DESC, country LIMIT 10)
        UNION ALL
        SELECT * FROM (SELECT 'top_age_countries', country, round(avg_age, 6)
                       FROM stats ORDER BY avg_age DESC NULLS LAST, country LIMIT 10)
        UNION ALL
        SELECT 'gender_share', gender, round(count(*) / sum(count(*)) OVER (), 6) FROM users GROUP BY gender
    """,
    "sink_new_checkpoint": """
        SELECT CAST(d.delivery AS INT) AS delivery, s.sink, count(*) AS n
        FROM users JOIN (VALUES (0), (1), (2)) AS d(delivery)
             ON CAST(user_id AS BIGINT) % 3 <= d.delivery
             CROSS JOIN (VALUES ('documents'), ('users')) AS s(sink)
        GROUP BY d.delivery, s.sink
    """,
    "sink_failure": """
        SELECT s.sink, s.sink = 'keyed' AS failed, 0 AS active, count(*) AS n
        FROM users CROSS JOIN (VALUES ('append'), ('keyed')) AS s(sink) GROUP BY s.sink
    """,
    "tallies_of_odd_rows": """
        SELECT country, gender, count(*) AS n, CAST(sum(age) AS BIGINT) AS age_sum, count(age) AS age_n,
               max(ingestion_time) AS last_update
        FROM (
          SELECT CASE WHEN CAST(user_id AS BIGINT) % 3 = 0 THEN 'HOT'
                      WHEN CAST(user_id AS BIGINT) % 11 <> 0 THEN country END AS country,
                 CASE WHEN CAST(user_id AS BIGINT) % 7 <> 0 THEN gender END AS gender,
                 CASE WHEN CAST(user_id AS BIGINT) % 13 <> 0 THEN age END AS age, ingestion_time
          FROM users
        ) GROUP BY country, gender
    """,
    "statistics_exact": """
        SELECT country, count(*) AS count_users, avg(age) AS avg_age, max(ingestion_time) AS last_update
        FROM (
          SELECT CASE WHEN CAST(user_id AS BIGINT) % 5 = 0 THEN 'ELSEWHERE' ELSE country END AS country,
                 age + CASE WHEN CAST(user_id AS BIGINT) % 3 = 0 THEN 1 ELSE 0 END AS age, ingestion_time
          FROM users
          UNION ALL
          SELECT country, age + CASE WHEN CAST(user_id AS BIGINT) % 3 = 0 THEN 1 ELSE 0 END,
                 ingestion_time - INTERVAL 1 DAY
          FROM users WHERE CAST(user_id AS BIGINT) % 5 = 1
        ) WHERE country IS NOT NULL GROUP BY country
    """,
}

ORACLE = {key: _USERS + sql for key, sql in _OVER_USERS.items()}
