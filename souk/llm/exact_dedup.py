"""Exact dedup by progressive refinement (DataFrame functions only)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from souk.llm.common import WHITE, materialise, query, row_struct, table, text_or_empty, unpack

#: code points that the prefix hash reads
PREFIX = 64


def normalised(text: str) -> Column:
    """The text with each run of ASCII white space as one space; NULL is empty."""
    return F.regexp_replace(text_or_empty(text), WHITE, " ")


def exact_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                carry: Sequence[str] | None = None, prefix: int = PREFIX) -> DataFrame:
    """Decide for every row which row of equal normalised text stays.

    1. Rows are counted by ``(length, prefix hash)``. Length and prefix are
       refined in one pass: the counts are combined before the shuffle, so
       copies that hold a third of the corpus cross it as one row per task.
    2. Only rows of groups with two or more rows go on to the full hash
       (SHA-256) of the whole text; all others are unique already. The group
       table has one row per key, so the join cannot multiply rows and
       adaptive execution may split a hot key of it.
    3. The surviving rows, now without their text, are grouped by full hash
       (again combined before the shuffle), and the group's smallest id and
       size are joined back.

    Returns one row per input row: the ``carry`` columns (default: the id)
    and ``keep_id`` (id of the row that stays), ``group_size`` (long),
    ``kept``. Defined results for odd input: NULL text equals the empty
    text; NULL ids lose against any id, and a group of NULL ids only has
    ``keep_id`` NULL and is kept; rows that repeat both id and text are one
    document listed twice: they share the decision and count twice in
    ``group_size`` (:func:`drop_copies` keeps one of them). An empty table
    gives an empty result. Columns of the input named like the results are
    replaced.
    """
    text = normalised(text_col)
    rows = df.select(row_struct(df, carry if carry is not None else [id_col]),
                     F.col(id_col).alias("_id"), text.alias("_text"))
    rows = (rows.withColumn("_len", F.octet_length("_text"))
                .withColumn("_pre", F.xxhash64(F.substring("_text", 1, prefix))))
    # length and prefix: which groups have more than one row
    again = (rows.groupBy("_len", "_pre").agg(F.count(F.lit(1)).alias("_n"))
                 .where("_n > 1").select("_len", "_pre", F.lit(True).alias("_more")))
    # a table of its own, so that the join below is a plain join of two
    # exchanges, whose hot keys adaptive execution can split
    again = materialise(again, "exact-dedup-groups")
    # full content only for those
    hashed = (rows.join(again, ["_len", "_pre"], "left")
                  .select("_row", "_id", "_len", "_pre",
                          F.when(F.col("_more"), F.unhex(F.sha2("_text", 256))).alias("_full")))
    hashed = materialise(hashed, "exact-dedup")
    groups = materialise(hashed.where(F.col("_full").isNotNull()).groupBy("_full")
                         .agg(F.min("_id").alias("_keep"), F.count(F.lit(1)).alias("_size"))
                         .withColumnRenamed("_full", "_key"), "exact-dedup-kept")
    # rows of no group get a key of their own instead of one common NULL
    own = F.coalesce(F.col("_full"), F.encode(F.concat_ws(",", "_len", "_pre"), "utf-8"))
    out = (hashed.withColumn("_key", own).join(groups, "_key", "left")
                 .withColumn("keep_id", F.when(F.col("_size").isNull(), F.col("_id")).otherwise(F.col("_keep")))
                 .withColumn("group_size", F.coalesce("_size", F.lit(1).cast("long")))
                 .withColumn("kept", F.col("_id").eqNullSafe(F.col("keep_id"))))
    return unpack(out, ["keep_id", "group_size", "kept"])


def drop_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that :func:`exact_dedup` keeps, with all columns of ``df``.

    The decisions travel without text; the rows that stay are found again by
    id and text hash, and rows repeating both are reduced to one (by the hash of the raw text).
    """
    mark = F.xxhash64(normalised(text_col))
    d = df.select(row_struct(df), F.col(id_col).alias("_id"), mark.alias("_mark"))
    marked = df.select(F.col(id_col).alias("_i"), F.col(text_col).alias("_t"),
                       mark.alias("_mark"))
    stay = (exact_dedup(marked, "_i", "_t", carry=["_i", "_mark"]).where("kept")
            .select("_i", F.col("_mark").alias("_m")))
    d = d.join(stay, F.col("_id").eqNullSafe(F.col("_i")) & (F.col("_mark") == F.col("_m")), "left_semi")
    first = F.min_by("_row", F.xxhash64(F.col(f"_row.`{text_col}`")))
    return d.groupBy("_id", "_mark").agg(first.alias("_row")).select("_row.*")


OP8_SQL = r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body FROM documents),
h AS (SELECT doc_id, sha256(body) AS text_sha256 FROM t)
SELECT doc_id, min(doc_id) OVER (PARTITION BY text_sha256) AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY text_sha256) AS kept, text_sha256
FROM h
"""


@query("op8_exact_dedup", OP8_SQL)
def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the document that stays for its text.

    The contract asks for the digest of every text, kept or not, so it is
    computed beside the operator while the text is read and carried along.
    """
    docs = table(spark, sf_dir, "documents").withColumn("text_sha256", F.sha2(normalised("text"), 256))
    out = exact_dedup(docs, carry=["doc_id", "text_sha256"])
    return out.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")
