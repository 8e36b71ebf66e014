"""Filter interaction audit: all orders of a set of filters from one pass."""

from __future__ import annotations

import hashlib
import string
from itertools import permutations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from souk.llm.common import WORD, importable, map_texts, materialise, query, table

#: the filters of the query, in bit order; the last one is the copy filter
FILTERS = "ABCDE"
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS = 100, 80, 10
CAPITALS, MARKS = string.ascii_uppercase.encode(), b"#$%&*|"

STEP_SCHEMA = ("part string, filter_order string, step int, kept long, removed long, redundant long, "
               "unique_fails long, good_lost long, toxic_lost long, shapley long")


def text_mask(text: str) -> tuple[int, bytes]:
    """Bits of the filters A to D that a text fails, and the text's digest."""
    raw = text.encode()
    words = raw.split()  # at ASCII white space only, as these are bytes
    n, points = len(words), len(text)
    bad = (n < LEAST_WORDS, 100 * len(set(words)) < LEAST_DISTINCT * n,
           100 * (len(raw) - len(raw.translate(None, CAPITALS))) > MOST_CAPITALS * points, len(raw) > len(raw.translate(None, MARKS)))
    return sum(1 << i for i, b in enumerate(bad) if b), hashlib.sha256(raw).digest()


def copy_cells(facts: DataFrame, copy_bit: int) -> DataFrame:
    """``part, mask`` cells of documents with the counts ``n, good, toxic``.

    ``facts`` has ``id, key, part, mask, good, toxic``; rows of one key other
    than those with its smallest id also fail filter ``copy_bit``. Rows of a
    key are combined before each shuffle, so a text that a third of the
    documents share crosses it as a row per task, part and label. A NULL id
    is smaller or larger than none: such a row is no copy.
    """
    group = ["key", "part", "mask", "good", "toxic"]
    # clustered by id from the labels' join; ids that repeat become one row
    ids = facts.groupBy("id", *group).agg(F.count(F.lit(1)).alias("k"))
    named = F.col("id").isNotNull()
    by = ids.groupBy(*group).agg(
        F.sum("k").alias("n"), F.sum(F.when(named, 0).otherwise(F.col("k"))).alias("nameless"),
        F.min("id").alias("least"), F.min_by("k", "id").alias("at_least"))
    by = materialise(by, "audit-cells")  # the texts are read for it once
    first = by.groupBy("key").agg(F.min("least").alias("first"))
    # `first` has one row per key: a key in very many parts is split by adaptive execution
    by = by.join(first, "key", "left").withColumn(
        "kept", F.col("nameless") + F.when(F.col("least") == F.col("first"), F.col("at_least")).otherwise(0))
    both = F.array(F.struct(F.col("mask"), F.col("kept").alias("c")),
                   F.struct((F.col("mask") + (1 << copy_bit)).alias("mask"), (F.col("n") - F.col("kept")).alias("c")))
    return (by.select("part", "good", "toxic", F.explode(both).alias("x"))
              .groupBy("part", F.col("x.mask").alias("mask"))
              .agg(F.sum("x.c").alias("n"), F.sum(F.col("x.c") * F.col("good")).alias("good"),
                   F.sum(F.col("x.c") * F.col("toxic")).alias("toxic")))


def survivors(masks: np.ndarray, counts: np.ndarray, filters: int) -> np.ndarray:
    """``[subset, measure]``: what passes every filter of each subset.

    The subsets come in Gray-code order: each step switches one filter on or
    off and touches only the cells that fail it. A cell's counter holds how
    many active filters it fails; it leaves the running survivors when the
    counter leaves 0 and comes back when it returns there.
    """
    out = np.zeros((1 << filters, counts.shape[1]), dtype=counts.dtype)
    running, failing = counts.sum(axis=0), np.zeros(len(masks), dtype=np.int64)
    out[0], subset = running, 0
    for i in range(1, 1 << filters):
        bit = (i & -i).bit_length() - 1
        subset ^= 1 << bit
        hit = (masks >> bit) & 1 == 1
        if subset >> bit & 1:
            running = running - counts[hit & (failing == 0)].sum(axis=0)
            failing[hit] += 1
        else:
            failing[hit] -= 1
            running = running + counts[hit & (failing == 0)].sum(axis=0)
        out[subset] = running
    return out


def steps(state: np.ndarray, names: str) -> list[tuple]:
    """Rows ``(order, step, kept, removed, redundant, unique_fails, good_lost,
    toxic_lost, shapley)`` of all orders, as differences of the stored states."""
    full = (1 << len(names)) - 1
    rows, credit = [], dict.fromkeys(range(len(names)), 0)
    for order in permutations(range(len(names))):
        before = 0
        for i, f in enumerate(order):
            after = before | 1 << f
            lost = [int(x) for x in state[before] - state[after]]
            fails = int(state[0][0] - state[1 << f][0])
            alone = int(state[full & ~(1 << f)][0] - state[full][0])
            credit[f] += lost[0]
            rows.append((f, "".join(names[x] for x in order), i + 1, int(state[after][0]), lost[0], fails - lost[0], alone, lost[1], lost[2]))
            before = after
    return [(*r[1:], credit[r[0]]) for r in rows]


def filter_audit(cells: DataFrame, names: str = FILTERS) -> DataFrame:
    """Every order and step of the filters for each part of ``cells`` (``part,
    mask, n, good, toxic``, one row per part and mask).

    A part is at most 2^filters rows whatever its documents, so a part is
    walked in one task; parts are spread by Spark. No cells, no rows. Cells
    that repeat a mask are added; NULL counts are 0.
    """
    importable(cells.sparkSession)

    def walk(cells: pd.DataFrame) -> pd.DataFrame:
        counts = cells[["n", "good", "toxic"]].fillna(0).to_numpy(dtype=np.int64)
        state = survivors(cells["mask"].to_numpy(dtype=np.int64), counts, len(names))
        rows = [(cells["part"].iloc[0], *r) for r in steps(state, names)]
        return pd.DataFrame(rows, columns=[c.split()[0] for c in STEP_SCHEMA.split(", ")])

    return cells.groupBy("part").applyInPandas(walk, STEP_SCHEMA)


def document_cells(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The cells of the five filters of the query over ``doc_id, text, lang``.

    NULL text is empty; NULL or empty ``lang`` is the part ''. The texts are
    read once and only their digests travel. Documents without a label count
    as neither good nor toxic; labels of one document listed twice count
    once, as good (toxic) if any of them says so; labels without id belong to
    none. Other columns of either table are not looked at.
    """
    d = docs.select(F.col("doc_id").alias("id"), F.coalesce(F.col("lang"), F.lit("")).alias("part"), "text")

    def judge():
        def of(texts):
            masks, keys = zip(*map(text_mask, texts), strict=True)
            return [pa.array(masks, pa.int32()), pa.array(keys, pa.binary())]
        return of

    facts = map_texts(d, "text", [T.StructField("mask", T.IntegerType()), T.StructField("key", T.BinaryType())], judge, keep=["id", "part"])
    one = lambda c: F.max(F.when(F.col(c) == 1, 1).otherwise(0)).alias(c)
    marks = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("id")).agg(one("quality"), one("toxic"))
    facts = facts.join(marks, "id", "left").select(
        "id", "key", "part", "mask", F.coalesce("quality", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic"))
    return copy_cells(facts, FILTERS.index("E"))


OP13_SQL = rf"""
WITH t AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS body FROM documents),
w AS (SELECT *, regexp_extract_all(body, '{WORD}') AS words FROM t),
l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
      FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
m AS (SELECT w.part, coalesce(l.good, 0) AS good, coalesce(l.toxic, 0) AS toxic,
        CASE WHEN len(words) < {LEAST_WORDS} THEN 1 ELSE 0 END
        + CASE WHEN 100 * len(list_distinct(words)) < {LEAST_DISTINCT} * len(words) THEN 2 ELSE 0 END
        + CASE WHEN 100 * length(regexp_replace(body, '[^A-Z]+', '', 'g')) > {MOST_CAPITALS} * length(body) THEN 4 ELSE 0 END
        + CASE WHEN regexp_matches(body, '[{MARKS.decode()}]') THEN 8 ELSE 0 END
        + CASE WHEN w.doc_id > min(w.doc_id) OVER (PARTITION BY body) THEN 16 ELSE 0 END AS mask
      FROM w LEFT JOIN l ON w.doc_id = l.doc_id),
cells AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM m GROUP BY part, mask),
f(bit, letter) AS (VALUES (1, 'A'), (2, 'B'), (4, 'C'), (8, 'D'), (16, 'E')),
orders AS (SELECT [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits, a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order
           FROM f a, f b, f c, f d, f e WHERE a.bit | b.bit | c.bit | d.bit | e.bit = 31),
s AS (SELECT filter_order, k AS step, bits[k] AS bit, list_sum(bits[1:k]) - bits[k] AS before
      FROM orders, generate_series(1, 5) AS g(k)),
x AS (SELECT part, filter_order, step, bit,
        sum(CASE WHEN mask & before = 0 AND mask & bit = 0 THEN n ELSE 0 END) AS kept,
        sum(CASE WHEN mask & before = 0 AND mask & bit > 0 THEN n ELSE 0 END) AS removed,
        sum(CASE WHEN mask & before > 0 AND mask & bit > 0 THEN n ELSE 0 END) AS redundant,
        sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
        sum(CASE WHEN mask & before = 0 AND mask & bit > 0 THEN good ELSE 0 END) AS good_lost,
        sum(CASE WHEN mask & before = 0 AND mask & bit > 0 THEN toxic ELSE 0 END) AS toxic_lost
      FROM cells, (SELECT filter_order, step, bit, CAST(before AS INTEGER) AS before FROM s) GROUP BY part, filter_order, step, bit)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM x
"""


@query("op13_filter_audit", OP13_SQL)
def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All 120 orders of the five filters over each language's documents."""
    return filter_audit(document_cells(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))
