"""Teaching-quality score queries on the FIXTURES stand-in:
teacher = supplier, department = its nation, course = part type, semester =
half-year of the order date; students = mean quantity, peers = share of
non-returned lines, outcomes = share of finished orders (hidden for
teachers with l_suppkey % 9 = 0)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from souk.operators import score as M
from souk.plans.registry import query
from souk.session import written
from souk.sources import io

# Component weights (and the second rule version).
WEIGHTS = {"z_students": 0.5, "z_peers": 0.3, "z_outcomes": 0.2}
RULE_VERSIONS = {"v1": WEIGHTS, "v2": {"z_students": 0.4, "z_peers": 0.4, "z_outcomes": 0.2}}
RAW = {"z_students": "students", "z_peers": "peers", "z_outcomes": "outcomes"}
PEERS = ["course", "department"]
MIN_VALID_SHARE = 0.8


def components(spark: SparkSession, sf: str, by_semester: bool = True) -> DataFrame:
    li, o = io.load(spark, sf, "lineitem"), io.load(spark, sf, "orders")
    p, s = io.load(spark, sf, "part"), io.load(spark, sf, "supplier")
    j = (li.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
           .join(p, F.col("l_partkey") == F.col("p_partkey"))
           .join(s, F.col("l_suppkey") == F.col("s_suppkey")))
    keys = [F.col("l_suppkey").alias("teacher"), F.col("s_nationkey").alias("department"),
            F.col("p_type").alias("course")]
    if by_semester:
        sem = F.concat(F.year("o_orderdate").cast("string"), F.lit("-H"),
                       F.when(F.month("o_orderdate") <= 6, "1").otherwise("2"))
        keys.append(sem.alias("semester"))
    g = j.groupBy(*keys).agg(
        F.avg("l_quantity").alias("students"),
        (F.count(F.when(F.col("l_returnflag") != "R", 1)) / F.count("*")).alias("peers"),
        (F.count(F.when(F.col("o_orderstatus") == "F", 1)) / F.count("*")).alias("_outcomes"),
        F.count("*").alias("responses"))
    g = g.withColumn("outcomes", F.when(F.pmod("teacher", F.lit(9)) != 0, F.col("_outcomes"))).drop("_outcomes")
    # read for the peers' statistics and again for the scores
    return M.normalise_components(written(g, "components"), RAW, PEERS)


def _comp_sql(by_semester: bool = True) -> str:
    sem = ("CAST(year(o_orderdate) AS VARCHAR) || '-H' || CASE WHEN month(o_orderdate) <= 6 THEN '1' ELSE '2' END"
           if by_semester else None)
    keys = "l_suppkey AS teacher, s_nationkey AS department, p_type AS course" + (f", {sem} AS semester" if sem else "")
    nkeys = 4 if sem else 3
    z = ",\n".join(
        f"ROUND(CASE WHEN STDDEV_SAMP({raw}) OVER w > 0 THEN ({raw} - AVG({raw}) OVER w) / STDDEV_SAMP({raw}) OVER w END, 6) AS {zc}"
        for zc, raw in RAW.items())
    return f"""
comp0 AS (
  SELECT {keys}, AVG(l_quantity) AS students,
         CAST(COUNT(*) FILTER (WHERE l_returnflag <> 'R') AS DOUBLE) / COUNT(*) AS peers,
         CASE WHEN l_suppkey % 9 <> 0 THEN CAST(COUNT(*) FILTER (WHERE o_orderstatus = 'F') AS DOUBLE) / COUNT(*) END AS outcomes,
         COUNT(*) AS responses
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
       JOIN supplier ON l_suppkey = s_suppkey
  GROUP BY {', '.join(str(i) for i in range(1, nkeys + 1))}),
comp AS (SELECT *, {z} FROM comp0 WINDOW w AS (PARTITION BY course, department))"""


def _w(x: float) -> str:
    return f"CAST({x} AS DOUBLE)"


def _strict_sql(weights) -> str:
    return "(" + " + ".join(f"{_w(w)} * {c}" for c, w in weights.items()) + ")"


def _partial_sql(weights) -> str:
    num = " + ".join(f"COALESCE({_w(w)} * {c}, {_w(0.0)})" for c, w in weights.items())
    den = " + ".join(f"CASE WHEN {c} IS NOT NULL THEN {_w(w)} ELSE {_w(0.0)} END" for c, w in weights.items())
    return f"(CASE WHEN ({den}) > 0 THEN ({num}) / ({den}) END)"


KEYS = ["teacher", "department", "course", "semester"]
KEYS_SQL = ", ".join(KEYS)


@query("score_normalised", f"WITH {_comp_sql()}\nSELECT {KEYS_SQL}, ROUND(students, 6) AS students, "
       "ROUND(peers, 6) AS peers, ROUND(outcomes, 6) AS outcomes, z_students, z_peers, z_outcomes FROM comp")
def score_normalised(spark: SparkSession, sf: str) -> DataFrame:
    c = components(spark, sf)
    return c.select(*KEYS, *[F.round(r, 6).alias(r) for r in RAW.values()], *RAW.keys())


@query("composite_score", f"WITH {_comp_sql()}\nSELECT {KEYS_SQL}, {_strict_sql(WEIGHTS)} AS score FROM comp")
def composite_score(spark: SparkSession, sf: str) -> DataFrame:
    return M.composite_score(components(spark, sf), WEIGHTS).select(*KEYS, "score")


@query("composite_score_partial", f"""WITH {_comp_sql()}
SELECT {KEYS_SQL}, {_partial_sql(WEIGHTS)} AS score,
       z_students IS NOT NULL AND z_peers IS NOT NULL AND z_outcomes IS NOT NULL AS is_complete
FROM comp""")
def composite_score_partial(spark: SparkSession, sf: str) -> DataFrame:
    return M.composite_score(components(spark, sf), WEIGHTS, partial=True).select(*KEYS, "score", "is_complete")


RESP_ORDER = ["l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag",
              "l_linestatus", "l_shipdate", "l_partkey"]
VALID_SQL = f"""
r AS (SELECT l_suppkey AS teacher, p_type AS course, l_orderkey AS student, l_quantity AS value,
             ROW_NUMBER() OVER (PARTITION BY l_suppkey, p_type, l_orderkey ORDER BY {', '.join(RESP_ORDER)}) AS rn
      FROM lineitem JOIN part ON l_partkey = p_partkey),
one AS (SELECT * FROM r WHERE rn = 1),
q AS (SELECT teacher, course, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM one GROUP BY ALL),
valid AS (
  SELECT teacher, course, COUNT(*) AS responses,
         COUNT(*) FILTER (WHERE value BETWEEN 1 AND 50 AND value >= q1 - 1.5 * (q3 - q1) AND value <= q3 + 1.5 * (q3 - q1)) AS valid,
         CAST(COUNT(*) FILTER (WHERE value BETWEEN 1 AND 50 AND value >= q1 - 1.5 * (q3 - q1) AND value <= q3 + 1.5 * (q3 - q1)) AS DOUBLE) / COUNT(*) AS share_valid
  FROM one JOIN q USING (teacher, course) GROUP BY teacher, course)"""


def valid(spark: SparkSession, sf: str) -> DataFrame:
    li, p = io.load(spark, sf, "lineitem"), io.load(spark, sf, "part")
    r = li.join(p, F.col("l_partkey") == F.col("p_partkey")).withColumnsRenamed(
        {"l_suppkey": "teacher", "p_type": "course", "l_orderkey": "student", "l_quantity": "value"})
    order = ["value" if c == "l_quantity" else c for c in RESP_ORDER]
    return M.valid_responses(r, ["teacher", "course"], "student", "value", order, 1, 50)


@query("valid_responses", f"WITH {VALID_SQL}\nSELECT * FROM valid")
def valid_responses(spark: SparkSession, sf: str) -> DataFrame:
    return valid(spark, sf)


@query("score_ranking", f"""WITH {_comp_sql(False)}, {VALID_SQL},
s AS (SELECT c.teacher, c.department, c.course, {_partial_sql(WEIGHTS)} AS score, v.share_valid
      FROM comp c JOIN valid v ON c.teacher = v.teacher AND c.course = v.course)
SELECT *, CAST(RANK() OVER (PARTITION BY department ORDER BY score DESC NULLS LAST, teacher, course) AS BIGINT) AS rank,
       false AS flagged
FROM s WHERE share_valid >= {MIN_VALID_SHARE}
UNION ALL
SELECT *, NULL, true FROM s WHERE share_valid < {MIN_VALID_SHARE}
""")
def score_ranking(spark: SparkSession, sf: str) -> DataFrame:
    c = M.composite_score(components(spark, sf, by_semester=False), WEIGHTS, partial=True)
    s = c.join(valid(spark, sf), ["teacher", "course"]).select("teacher", "department", "course", "score",
                                                              "share_valid")
    return M.score_ranking(s, ["department"], "score", "share_valid", MIN_VALID_SHARE, ["teacher", "course"])


@query("score_explain", f"""WITH {_comp_sql()}
SELECT {KEYS_SQL}, component, weight, value, weight * value AS contribution,
       ROUND(raw - peer_mean, 6) AS gap_to_peers
FROM (
""" + "\nUNION ALL\n".join(
    f"  SELECT {KEYS_SQL}, '{zc}' AS component, {_w(w)} AS weight, {zc} AS value, {raw} AS raw, "
    f"AVG({raw}) OVER (PARTITION BY course, department) AS peer_mean FROM comp"
    for zc, w in WEIGHTS.items() for raw in [RAW[zc]]) + ")")
def score_explain(spark: SparkSession, sf: str) -> DataFrame:
    return M.score_explain(written(components(spark, sf), "scores"), KEYS, WEIGHTS, RAW, PEERS)


@query("score_history", f"""WITH {_comp_sql()},
s AS (""" + "\nUNION ALL\n".join(
    f"SELECT teacher, course, semester, '{v}' AS rule_version, {_partial_sql(w)} AS score FROM comp"
    for v, w in RULE_VERSIONS.items()) + """)
SELECT *, score - LAG(score) OVER (PARTITION BY teacher, course, rule_version ORDER BY semester) AS change
FROM s""")
def score_history(spark: SparkSession, sf: str) -> DataFrame:
    c = components(spark, sf)
    frames = [M.composite_score(c, w, partial=True).select("teacher", "course", "semester",
                                                         F.lit(v).alias("rule_version"), "score")
              for v, w in RULE_VERSIONS.items()]
    s = frames[0].unionByName(frames[1])
    return M.score_history(s, ["teacher", "course", "rule_version"], "semester", "score")
