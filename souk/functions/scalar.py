"""Column-level helpers. All return Catalyst expressions, so
they stay inside whole-stage codegen; none is a Python UDF."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from souk.session import written

# Multiplicative hash constant (Knuth) used wherever a deterministic,
# engine-independent pseudo-random number is derived from an integer key.
KNUTH = 2654435761


def bucket(value: Column, bounds: Sequence[tuple[float, str]], default: str) -> Column:
    """``when(value < b1, l1).when(value < b2, l2)...otherwise(default)``."""
    expr = None
    for bound, label in bounds:
        expr = F.when(value < bound, label) if expr is None else expr.when(value < bound, label)
    return F.lit(default) if expr is None else expr.otherwise(default)


def knuth_bucket(key: Column, n: int | Column) -> Column:
    """``(key * 2654435761) mod n`` for non-negative integer keys, computed as
    ``((key mod n) * (2654435761 mod n)) mod n`` so that no intermediate
    overflows BIGINT for any key (``n`` below 2^31); equal to the plain SQL
    expression wherever that one does not overflow."""
    n = F.lit(n) if isinstance(n, int) else n
    return F.pmod(F.pmod(key.cast("bigint"), n) * F.pmod(F.lit(KNUTH), n), n)


def knuth_mod_2_32(key: Column) -> Column:
    """``(key * 2654435761) mod 2^32`` exactly, via DECIMAL(38,0) (the plain
    BIGINT product overflows for keys above ~3.5e9)."""
    prod = key.cast("decimal(38,0)") * F.lit(KNUTH).cast("decimal(38,0)")
    return F.pmod(prod, F.lit(4294967296).cast("decimal(38,0)")).cast("bigint")


def hash_sample(df: DataFrame, key: str, fraction: float, buckets: int = 10000) -> DataFrame:
    """Deterministic sample: keep keys whose Knuth bucket < fraction * buckets.

    Unlike ``sample(frac, seed)`` the selection depends only on the key, so
    reruns, other engines and other partitionings pick the same rows.
    """
    return df.where(knuth_bucket(F.col(key), buckets) < int(round(fraction * buckets)))


def limit_fraction(df: DataFrame, order: Sequence[Column], fraction: float) -> DataFrame:
    """The first ``floor(count * fraction)`` rows in a total ``order`` (a
    sampling operator: the limit is the feature).

    The rows are dealt out by ranges of ``order`` and written; the ranges are
    counted (one row each), and every row is numbered inside its range, so no
    task holds more than a range and nothing is merged in one place."""
    names = df.columns
    d = written(df.repartitionByRange(*order).withColumn("_blk", F.spark_partition_id()), "ranges")
    sizes = d.groupBy("_blk").agg(F.count("*").alias("_n"))
    upto = Window.orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("_blk", F.coalesce(F.sum("_n").over(upto), F.lit(0)).alias("_before"),
                         F.floor(F.sum("_n").over(Window.partitionBy()).cast("double") * F.lit(float(fraction))).alias("_most"))
    d = d.withColumn("_rn", F.row_number().over(Window.partitionBy("_blk").orderBy(*order)))
    return d.join(sizes, "_blk").where(F.col("_before") + F.col("_rn") <= F.col("_most")).select(*names)


def dedup_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key: the first by ``order`` (which must end in a unique tie-break).

    ``row_number() = 1`` is planned as a WindowGroupLimit below the shuffle,
    so only one candidate per key and partition crosses the Exchange.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return (df.withColumn("_rn", F.row_number().over(w))
              .where(F.col("_rn") == 1).drop("_rn"))


def pseudonymise(col: Column, salt: str) -> Column:
    """Salted SHA-256 of a value (NULL stays NULL)."""
    return F.sha2(F.concat(F.lit(salt), col.cast("string")), 256)


def mask_email(col: Column) -> Column:
    """Keep the first character and the domain: ``j***@example.com``."""
    return F.regexp_replace(col, r"^(.)[^@]*(@.*)$", "$1***$2")


def mask_digits(col: Column) -> Column:
    """Replace every digit with ``*``."""
    return F.regexp_replace(col, r"[0-9]", "*")


def payload_field(payload: Column, path: str, type_: str) -> Column:
    """Typed field of a JSON payload; malformed JSON or a missing field give NULL."""
    return F.try_variant_get(F.try_parse_json(payload), path, type_)


def safe_ratio(num: Column, den: Column) -> Column:
    """``num / den`` as double, NULL when the denominator is 0 or NULL."""
    return F.when(den != 0, num.cast("double") / den.cast("double"))
