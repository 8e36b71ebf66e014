"""Mixing sources to target weights by systematic sampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from souk.llm.common import WORD, query, row_struct, table, text_or_empty, unpack
from souk.operators.windows import prefix_scan

#: sources weigh 1, 2, 3 by turns; a target is at most CAP times its source
WEIGHTS = (1, 2, 3)
CAP = 3
#: documents that one block of the prefix sum orders in one task, as a span of ids
BLOCK = 4096
#: fixed values of the random offset: seed text and number of hex digits read
SEED, HEX = "mix-1", 8


def n_words(text: str) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of the text; NULL has none."""
    return F.regexp_count(text_or_empty(text), F.lit(WORD)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = 1.0,
                   cap: float = CAP) -> DataFrame:
    """``(source, source_size)`` -> also ``target``, both as the words wanted.

    Sources in code point order (NULL last) weigh ``weights`` by turns.
    ``share`` of all words is dealt by weight; no source gets more than
    ``cap`` times its size, and the excess is dealt again by weight until no
    target is above. Dealing again and again ends at one level L with
    ``target = min(cap * size, L * weight)``: sources in the order of
    ``cap * size / weight`` are capped up to the first that L leaves whole.
    One row per source; a corpus has few sources next to its documents.
    """
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    turn = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights)))
    s = (sizes.withColumn("_w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn + 1).cast("int")))
              .withColumn("_most", F.col("source_size") * F.lit(float(cap))))
    order = Window.orderBy(F.col("_most") / F.col("_w"), F.col("source").isNull(), "source")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    s = (s.withColumn("_all", F.sum("source_size").over(whole) * F.lit(float(share)))
          .withColumn("_level", (F.col("_all") - F.coalesce(F.sum("_most").over(before), F.lit(0.0)))
                      / (F.sum("_w").over(whole) - F.coalesce(F.sum("_w").over(before), F.lit(0.0))))
          .withColumn("_fits", F.col("_most") > F.col("_level") * F.col("_w"))
          # the level of the first source that is not capped holds for all after it
          .withColumn("_level", F.min(F.when(F.col("_fits"), F.struct(F.col("_most") / F.col("_w"), "_level"))).over(whole)["_level"]))
    return s.select("source", "source_size",
                    F.when(F.col("_level").isNull(), F.col("_most"))
                    .otherwise(F.least("_most", F.col("_level") * F.col("_w"))).alias("target"))


def mix_sources(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                weights: Sequence[float] = WEIGHTS, share: float = 1.0, cap: float = CAP,
                seed: str = SEED, block: int = BLOCK) -> DataFrame:
    """Say for every document how often the mix takes it.

    Every document of a source has the same expected number of copies,
    ``target / source_size``. The documents of a source are put in an order,
    their expected copies are summed up along it, one random offset in
    [0, 1) is added, and a document is emitted once per integer that its
    stretch of the sum crosses. The order goes by size class (eighths of a
    power of two), so that every class is sampled evenly and the words taken
    come near the target; inside a class it goes by id. The running count is
    a blocked prefix sum over ``(source, size class, id div block)``: a
    source with a third of all rows is spread over many tasks, and the offset
    is a hash of seed and source, so reruns agree.

    ``id_col`` must be an integer. Returns the input columns and ``size``
    (words), ``source_size``, ``target``, ``copies`` (long), ``taken`` =
    ``copies * size``. NULL and empty texts have size 0; NULL is a source of
    its own, last in order; NULL ids go first; rows that are equal in id,
    size and source are interchangeable; a source of empty texts has target
    0 and no copies; an empty table gives an empty result.
    """
    d = df.select(row_struct(df), F.col(source_col).cast("string").alias("source"),
                  F.col(id_col).cast("long").alias("_id"), n_words(text_col).alias("size"))
    targets = source_targets(d.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, cap)
    u = F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(seed), F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n")))),
                           1, HEX), 16, 10).cast("double") / F.lit(float(16 ** HEX))
    targets = targets.select(F.struct("source").alias("_gk2"), "source_size", "target",
                             (F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size"))
                              .otherwise(F.lit(0.0))).alias("_rate"), u.alias("_u"))
    d = (d.withColumn("_class", F.floor(F.log2(F.col("size") + F.lit(1.0)) * 8).cast("int"))
          .withColumn("_span", F.floor(F.col("_id") / F.lit(block))))
    d = prefix_scan(d, ["source"], F.struct("_class", "_span"), ["_class", "_span", "_id", "size"],
                    sums={"_before": F.lit(1).cast("long")})
    d = d.withColumn("_gk2", F.struct("source")).join(targets, "_gk2")
    upto = lambda n: F.floor(n * F.col("_rate") + F.col("_u"))
    d = (d.withColumn("copies", F.least(upto(F.col("_before") + 1) - upto(F.col("_before")),
                                        F.lit(int(-(-cap // 1)))).cast("long"))
          .withColumn("taken", F.col("copies") * F.col("size")))
    return unpack(d, ["size", "source_size", "target", "copies", "taken"])


def emit_copies(mixed: DataFrame) -> DataFrame:
    """One row per copy: the documents of the mix, with ``copy`` from 0 on."""
    return mixed.where("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(0), (F.col("copies") - 1).cast("int"))))


#: the level is found as in source_targets; order, prefix sum and offset as in mix_sources
OP1_SQL = r"""
WITH d AS (SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
           FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, CAST((row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1) % 3 + 1 AS DOUBLE) AS w,
             source_size * 3.0::DOUBLE AS most FROM s),
o AS (SELECT *, sum(source_size) OVER () * 1.0::DOUBLE AS allw,
        ((sum(source_size) OVER () * 1.0::DOUBLE) - coalesce(sum(most) OVER p, 0.0::DOUBLE))
        / (sum(w) OVER () - coalesce(sum(w) OVER p, 0.0::DOUBLE)) AS lvl
      FROM w WINDOW p AS (ORDER BY most / w, source IS NULL, encode(source) ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT arg_min(lvl, most / w) AS lvl FROM o WHERE most > lvl * w),
t AS (SELECT source, source_size, CASE WHEN l.lvl IS NULL THEN most ELSE least(most, l.lvl * w) END AS target
      FROM o CROSS JOIN l),
r AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0::DOUBLE END AS rate,
        CAST(('0x' || substr(md5('mix-1|' || coalesce('s' || source, 'n')), 1, 8)) AS BIGINT)::DOUBLE / 4294967296.0::DOUBLE AS u FROM t),
k AS (SELECT d.doc_id, d.size, r.source_size, r.target, r.rate, r.u,
        row_number() OVER (PARTITION BY d.source ORDER BY CAST(floor(log2(d.size + 1.0::DOUBLE) * 8) AS INT),
                           floor(d.doc_id / 4096.0), d.doc_id, d.size) AS n
      FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source)
SELECT doc_id, size, source_size, target,
       CAST(least(floor(n * rate + u) - floor((n - 1) * rate + u), 3) AS BIGINT) * size AS taken FROM k
"""


@query("op1_mixing", OP1_SQL)
def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix of all documents: weights 1, 2, 3, share 100 %, cap 3."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mix_sources(docs).select("doc_id", "size", "source_size", "target", "taken")
