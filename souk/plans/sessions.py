"""Session-log job queries over logs derived from ``events``
(FIXTURES recipe), so DuckDB can compute the expected parse directly."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from souk.operators import sessions as SL
from souk.plans.registry import query
from souk.session import scratch_path
from souk.sources import io

# Fixed value: document searched for by metric 1 on the derived logs.
DERIVED_TARGET = "ACC_3"

DERIVED_SQL = """
WITH ev AS (
  SELECT CAST(user_id AS VARCHAR) AS session, event_id, ts, event_type,
         CAST(json_extract(props, '$.k') AS INTEGER) AS k, event_id % 50 AS sid,
         COALESCE(last_value(CASE WHEN event_type = 'view' THEN event_id % 50 END IGNORE NULLS)
           OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS view_sid
  FROM events),
ev2 AS (
  SELECT *, CASE event_type WHEN 'view' THEN CASE WHEN k % 10 = 0 THEN 1 ELSE 2 END
                            WHEN 'signup' THEN 5 WHEN 'error' THEN 1 + k % 2 ELSE 1 END AS n_lines
  FROM ev),
lin AS (
  SELECT *, SUM(n_lines) OVER (PARTITION BY session ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) - n_lines + 1 AS first_line
  FROM ev2),
lin2 AS (
  SELECT *, LEAD(first_line) OVER (PARTITION BY session ORDER BY ts, event_id) AS next_first FROM lin)
"""


# metric 2 expected from the recipe: distinct hits of views with results,
# dated opens (clicks) joined on (session, search id, doc)
METRIC2_SQL = DERIVED_SQL + """,
hits AS (SELECT DISTINCT session, search_id, doc FROM (
  SELECT session, CAST(sid AS VARCHAR) AS search_id,
         unnest(['LAW_' || (k % 7), 'ACC_' || (k % 5), 'LAW_' || ((k + 1) % 7)]) AS doc
  FROM lin2 WHERE event_type = 'view' AND k % 10 <> 0)),
opens AS (SELECT session, CAST(view_sid AS VARCHAR) AS search_id, 'LAW_' || (k % 7) AS doc,
                 strftime(ts, '%Y-%m-%d') AS day
          FROM lin2 WHERE event_type = 'click')
SELECT day, doc, COUNT(*) AS count FROM opens JOIN hits USING (session, search_id, doc)
GROUP BY day, doc"""


def derived_lines(spark: SparkSession, sf: str) -> DataFrame:
    return SL.synthetic_session_lines(io.load(spark, sf, "events"))


def derived_events(spark: SparkSession, sf: str) -> DataFrame:
    return SL.parse_sessions(derived_lines(spark, sf))


@query("session_events", DERIVED_SQL + """
SELECT session, CAST(first_line AS BIGINT) AS lineno,
  CASE event_type WHEN 'view' THEN 'QS' WHEN 'signup' THEN 'CARD' ELSE 'OPEN' END AS kind,
  CASE WHEN event_type = 'purchase' THEN '' ELSE strftime(ts, '%Y-%m-%d') END AS day,
  CASE WHEN event_type = 'view' THEN CASE WHEN k % 10 <> 0 THEN CAST(sid AS VARCHAR) END
       WHEN event_type = 'signup' THEN CAST(sid AS VARCHAR)
       ELSE CAST(view_sid AS VARCHAR) END AS search_id,
  CASE WHEN event_type = 'view' AND k % 10 <> 0
         THEN 'LAW_' || (k % 7) || ' ACC_' || (k % 5) || ' LAW_' || ((k + 1) % 7)
       WHEN event_type = 'signup' THEN 'ACC_' || (k % 5) ELSE '' END AS docs_text,
  CASE WHEN event_type = 'signup' THEN '0=ACC_' || (k % 5) || '&134=text' ELSE '' END AS params_text,
  CASE WHEN event_type IN ('click', 'purchase') THEN 'LAW_' || (k % 7) END AS doc
FROM lin2 WHERE event_type <> 'error'
""")
def session_events(spark: SparkSession, sf: str) -> DataFrame:
    ev = derived_events(spark, sf)
    params_text = F.concat_ws("&", F.transform(F.array_sort(F.map_entries("params")),
                                               lambda e: F.concat(e["key"], F.lit("="), e["value"])))
    return ev.select("session", F.col("lineno").cast("bigint").alias("lineno"), "kind", "day", "search_id",
                     F.concat_ws(" ", "docs").alias("docs_text"), params_text.alias("params_text"), "doc")


WARNINGS_SQL = DERIVED_SQL + """
SELECT session, CAST(first_line AS BIGINT) AS line, 'unknown_line' AS reason, '?? junk' AS text
FROM lin2 WHERE event_type = 'error'
UNION ALL
SELECT session, CAST(first_line + 1 AS BIGINT), 'unattached_result', CAST(sid AS VARCHAR) || ' LAW_1'
FROM lin2 WHERE event_type = 'error' AND k % 2 = 1
UNION ALL
SELECT session, CAST(next_first AS BIGINT), 'qs_without_result', NULL
FROM lin2 WHERE event_type = 'view' AND k % 10 = 0 AND next_first IS NOT NULL
"""


@query("session_warnings", WARNINGS_SQL)
def session_warnings(spark: SparkSession, sf: str) -> DataFrame:
    w = SL.parse_warnings(derived_lines(spark, sf))
    return w.select("session", F.col("line").cast("bigint").alias("line"), "reason", "text")


@query("card_search_count", DERIVED_SQL + """
SELECT COUNT(*) AS card_searches FROM lin2 WHERE event_type = 'signup' AND 'ACC_' || (k % 5) = 'ACC_3'
""")
def card_search_count(spark: SparkSession, sf: str) -> DataFrame:
    return SL.card_search_count(derived_events(spark, sf), DERIVED_TARGET)


@query("quick_search_opens", METRIC2_SQL + " ORDER BY day, doc")
def quick_search_opens(spark: SparkSession, sf: str) -> DataFrame:
    return SL.quick_search_opens(derived_events(spark, sf))


@query("session_job_files", METRIC2_SQL)
def session_job_files(spark: SparkSession, sf: str) -> DataFrame:
    """The whole job on files: derived logs are written one text file per
    session, then read -> parse -> metric files (metric 1 as one text line,
    metric 2 as one CSV with header), and metric 2 is read back."""
    root = scratch_path(spark, "session-job")
    SL.write_session_files(derived_lines(spark, sf), f"{root}/logs")
    out = SL.session_job(spark, f"{root}/logs", f"{root}/out", DERIVED_TARGET)
    return (spark.read.schema("day string, doc string, count bigint").option("header", "true")
                 .csv(out["metric2"]))


@query("session_job_split_files", METRIC2_SQL)
def session_job_split_files(spark: SparkSession, sf: str) -> DataFrame:
    """The whole job on files read split-parallel (for very large session
    files): lines numbered by split and position, then parsed as usual."""
    root = scratch_path(spark, "session-job-split")
    SL.write_session_files(derived_lines(spark, sf), f"{root}/logs")
    out = SL.session_job(spark, f"{root}/logs", f"{root}/out", DERIVED_TARGET, split_files=True)
    return (spark.read.schema("day string, doc string, count bigint").option("header", "true")
                 .csv(out["metric2"]))


@query("session_warning_sample", f"""
WITH w AS ({WARNINGS_SQL}),
r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY session ORDER BY line, reason) AS rn FROM w)
SELECT session, line, reason, text FROM r WHERE rn <= 3 ORDER BY session, line, reason LIMIT 10
""")
def session_warning_sample(spark: SparkSession, sf: str) -> DataFrame:
    """At most three warnings per session and ten overall (a bounded report)."""
    return SL.warning_sample(session_warnings(spark, sf), 3, 10)


@query("session_diagnostics", f"""
WITH w AS ({WARNINGS_SQL})
SELECT (SELECT COUNT(DISTINCT user_id) FROM events) AS sessions,
       (SELECT COUNT(*) FROM events WHERE event_type <> 'error') AS events,
       (SELECT COUNT(*) FROM w) AS warnings
""")
def session_diagnostics(spark: SparkSession, sf: str) -> DataFrame:
    return SL.session_diagnostics(derived_lines(spark, sf))
