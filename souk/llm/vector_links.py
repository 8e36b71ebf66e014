"""Near-duplicate vectors by spherical-cap filters."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from souk.llm.common import importable, materialise, query, row_struct, table, unpack
from souk.llm.graph import components
from souk.llm.near_dedup import mix

COSINE = 0.98
#: turned copies of a code, filters that a vector passes of each on average,
#: and how far below one a filter's expected number of unrelated vectors lies
TURNS, FILTERS_PER_VECTOR, SPARSE = 12, 4, 4
#: codewords of one block at most; balls of a bucket that are paired without
#: a further code, and how many codes refine a bucket at most
CODEWORDS, PAIRED, CODES = 4096, 64, 2
#: bits of a sketch (signs of random projections), and how many standard
#: deviations above the expected number of different bits a pair may lie
SKETCH, SPREAD = 128, 8
#: angles nearer than this to a bound are decided by the cosine itself
SLACK = 1e-6
#: vectors decoded at once, and about how many members of a ball one tile has
PIECE, TILE = 512, 2048


def cap_share(height: float, dim: int) -> float:
    """Share of the unit sphere of ``dim`` dimensions at or above ``height``."""
    if dim == 1:
        return 0.5
    angle = np.linspace(0.0, math.pi, 20001)
    density = np.sin(angle) ** (dim - 2)
    return float(density[angle <= math.acos(height)].sum() / density.sum())


class ProductCode:
    """Filter directions that are sums of one random codeword per block.

    The directions are as many as give each vector FILTERS_PER_VECTOR of them
    at or above ``height``; the height grows with the number of vectors, so
    that unrelated vectors rarely share one at any size, but stays where
    similar vectors still do. A random rotation spreads every vector over the
    blocks.
    """

    def __init__(self, dim: int, vectors: int, cosine: float = COSINE, seed: int = 0):
        theta = math.acos(cosine)
        low, high = 0.0, math.cos(min(3 * theta, math.pi / 2))
        share = 1.0 / (SPARSE * max(vectors, 1))
        if cap_share(high, dim) < share:
            for _ in range(40):
                mid = (low + high) / 2
                low, high = (mid, high) if cap_share(mid, dim) > share else (low, mid)
        self.height = high
        directions = FILTERS_PER_VECTOR / max(cap_share(high, dim), 1e-300)
        self.blocks = 1
        while directions ** (1 / self.blocks) > CODEWORDS and self.blocks < max(1, dim // 8):
            self.blocks += 1
        self.width = -(-dim // self.blocks)
        self.size = max(1, math.ceil(directions ** (1 / self.blocks)))
        rng = np.random.default_rng([seed, dim])
        self.turn = np.linalg.qr(rng.standard_normal((dim, dim)))[0]
        words = rng.standard_normal((self.blocks, self.size, self.width))
        last = dim - self.width * (self.blocks - 1)
        words[-1, :, last:] = 0.0
        self.words = words / np.linalg.norm(words, axis=2, keepdims=True) / math.sqrt(self.blocks)

    def decode(self, unit: np.ndarray) -> list[np.ndarray]:
        """For each unit vector the numbers of all directions at or above the
        height: codewords are tried in falling order of their share of the
        product, and a prefix is left when the best rest cannot lift it."""
        x = np.zeros((len(unit), self.blocks * self.width))
        x[:, :unit.shape[1]] = unit @ self.turn
        x = x.reshape(len(unit), self.blocks, self.width)
        shares = np.einsum("nbw,bsw->nbs", x, self.words, optimize=True)
        best = shares.max(axis=2)
        rest = np.concatenate([np.cumsum(best[:, ::-1], axis=1)[:, ::-1][:, 1:], np.zeros((len(unit), 1))], axis=1)
        out = []
        for share, more in zip(shares, rest, strict=True):
            numbers, sums = np.zeros(1, dtype=np.int64), np.zeros(1)
            for b in range(self.blocks):
                useful = np.flatnonzero(share[b] + sums.max(initial=-math.inf) + more[b] >= self.height)
                total = sums[:, None] + share[b][useful][None, :]
                i, j = np.nonzero(total + more[b] >= self.height)
                numbers, sums = numbers[i] * self.size + useful[j], total[i, j]
            out.append(numbers)
        return out


def unit_rows(column: pa.Array) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """``{dimension: (rows, unit vectors)}`` of an Arrow list column; scaled
    before the norm is taken, so no square over- or underflows."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    ends = np.cumsum(lengths)
    out = {}
    for dim in np.unique(lengths):
        rows = np.flatnonzero(lengths == dim)
        x = flat[(ends[rows] - dim)[:, None] + np.arange(dim)]
        x = x / np.abs(x).max(axis=1, keepdims=True)
        out[int(dim)] = rows, x / np.linalg.norm(x, axis=1, keepdims=True)
    return out


def usable(vector: str):
    """Whether a vector has components, all finite and not all zero."""
    v = F.col(vector)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    return F.coalesce(v.isNotNull() & (F.size(v) > 0) & finite & F.exists(v, lambda x: x != 0), F.lit(False))


def with_filters(nodes: DataFrame, vectors: int, cosine: float, code: int) -> DataFrame:
    """``node, keys, s1, s2``: the filters that each vector passes in all
    turned copies of a code, as numbers that name part, copy and direction,
    and the vector's sketch."""
    importable(nodes.sparkSession)

    def run(batches):
        codes: dict[int, tuple] = {}
        for batch in batches:
            keys = [np.zeros(0, dtype=np.int64)] * batch.num_rows
            sketch = np.zeros((batch.num_rows, SKETCH // 64), dtype=np.int64)
            part = batch.column(1).to_numpy().view(np.uint64)
            for dim, (rows, unit) in unit_rows(batch.column(2)).items():
                if dim not in codes:
                    turns = [ProductCode(dim, vectors, cosine, code * TURNS + t) for t in range(TURNS)]
                    codes[dim] = turns, np.random.default_rng([dim, SKETCH]).standard_normal((dim, SKETCH))
                turns, plane = codes[dim]
                sketch[rows] = np.packbits(unit @ plane > 0, axis=1).view(np.int64)
                for s in range(0, len(rows), PIECE):
                    found = [t.decode(unit[s:s + PIECE]) for t in turns]
                    for r, *mine in zip(rows[s:s + PIECE], *found, strict=True):
                        numbers = np.concatenate([m * TURNS + t for t, m in enumerate(mine)])
                        keys[r] = mix(mix(numbers.astype(np.uint64)) ^ part[r]).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(keys, pa.list_(pa.int64())), *map(pa.array, sketch.T.copy())],
                                             names=["node", "keys", "s1", "s2"])

    return nodes.select("node", "part", "vec").mapInArrow(run, "node long, keys array<long>, s1 long, s2 long")


def most_bits(angle: float) -> int:
    """Bits in which the sketches of vectors at this angle differ at most:
    every bit differs with probability angle / pi."""
    share = min(angle / math.pi, 1.0)
    return math.ceil(SKETCH * share + SPREAD * math.sqrt(SKETCH * share * (1 - share)))


def alike(a: str, b: str, bits: int):
    different = [F.bit_count(F.col(f"{a}{i}").bitwiseXOR(F.col(f"{b}{i}"))) for i in (1, 2)]
    return different[0] + different[1] <= bits


def with_cosine(pairs: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` and ``cos``, the cosine of columns x and y in double precision."""
    importable(pairs.sparkSession)
    schema = ", ".join(f"{c} {pairs.schema[c].dataType.simpleString()}" for c in keep) + ", cos double"

    def run(batches):
        for batch in batches:
            cos = np.zeros(batch.num_rows)
            x, y = unit_rows(batch.column(len(keep))), unit_rows(batch.column(len(keep) + 1))
            for dim, (rows, a) in x.items():
                cos[rows] = np.einsum("nd,nd->n", a, y[dim][1])
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(keep)], pa.array(cos)], names=[*keep, "cos"])

    return pairs.select(*keep, "x", "y").mapInArrow(run, schema)


def balls_of(nodes: DataFrame, shared: DataFrame, sketches: DataFrame, cosine: float) -> DataFrame:
    """``node, ball, radius``: each vector with the smallest vector among the
    first ones of its filters that it is linked with, or itself, and the
    angle between the two."""
    lead = shared.where("leader < node").select("node", "leader").distinct()
    lead = (lead.join(sketches, "node").join(sketches.toDF("leader", "t1", "t2"), "leader")
                .where(alike("s", "t", most_bits(math.acos(cosine)))).select("node", "leader"))
    vec = nodes.select("node", "vec")
    lead = lead.join(vec.withColumnRenamed("vec", "x"), "node").join(vec.toDF("leader", "y"), "leader")
    near = with_cosine(lead, ["node", "leader"]).where(F.col("cos") >= cosine)
    near = near.groupBy("node").agg(F.min("leader").alias("ball"), F.min_by("cos", "leader").alias("cos"))
    # a member that is not the centre itself never has the radius 0
    radius = F.greatest(F.acos(F.least(F.col("cos"), F.lit(1.0))), F.lit(SLACK / 8))
    return nodes.select("node").join(near, "node", "left").select(
        "node", F.coalesce("ball", "node").alias("ball"), F.when(F.col("ball").isNull(), 0.0).otherwise(radius).alias("radius"))


def ball_pairs(nodes: DataFrame, shared: DataFrame, sketches: DataFrame, balls: DataFrame, vectors: int, cosine: float) -> DataFrame:
    """``a, b``: the different balls whose vectors share a filter and whose
    centres' sketches allow a link.

    Buckets of more than PAIRED balls are refined by a further, independent
    code (a vector goes on under each of its new filters) instead of being
    paired; what is left after CODES codes is paired as it is.
    """
    bits = most_bits(3 * math.acos(cosine))  # of centres, with a radius of the angle on each side
    rows = shared.select("key", "node").join(balls.select("node", "ball"), "node")
    found = None
    for code in range(1, CODES + 1):
        held = rows.select("key", "ball").distinct()
        sizes = held.groupBy("key").agg(F.count(F.lit(1)).alias("k")).where("k > 1")
        last = code == CODES
        shut = held.join(sizes if last else sizes.where(F.col("k") <= PAIRED), "key").select("key", "ball")
        shut = materialise(shut.join(sketches.toDF("ball", "s1", "s2"), "ball"), "ball-buckets")
        pairs = shut.toDF("a", "key", "s1", "s2").join(shut.toDF("b", "key", "t1", "t2"), "key").where(F.expr("a < b") & alike("s", "t", bits)).select("a", "b")
        found = pairs if found is None else found.unionByName(pairs)
        wide = materialise(rows.join(sizes.where(F.col("k") > PAIRED).select("key"), "key"), "wide-buckets") if not last else None
        if last or wide.isEmpty():
            break
        again = with_filters(nodes.join(wide.select("node").distinct(), "node", "left_semi"), vectors, cosine, code)
        again = again.select("node", F.explode("keys").alias("next"))
        rows = wide.join(again, "node").select(F.xxhash64("key", "next").alias("key"), "node", "ball")
    return found.distinct()


def vector_links(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", group_col: str = "label",
                 cosine: float = COSINE) -> DataFrame:
    """Decide for every vector which vectors of its group are near copies.

    1. Equal vectors of a group are one node.
    2. Structured random product codes list-decode each node to all filter
       directions above a height that grows with the group; nodes that share
       a filter meet.
    3. Every node joins the ball of the smallest node among the first ones
       of its filters that it is linked with.
    4. Balls that share a filter are compared by their centres and radii: a
       triangle of angles shows that all pairs of members are linked or that
       none is; the undecided balls, and balls too wide to be linked
       throughout, are compared member by member in tiles of bounded size
       that give out each member's number of links, never a pair.

    So a group of copies costs rows in proportion to its members (and to
    their square over TILE where copies are so loose that only their own
    cosines decide), and no link is counted without a proof. A linked pair is
    lost only if it shares no filter (see the README for recall).

    Returns ``df``'s columns and ``n_links`` (other rows linked directly),
    ``component_id`` (smallest id reachable, its own included), ``kept`` (id =
    component_id). Vectors that are NULL, empty, zero or hold NULL or
    non-finite components, and rows without a group, link with nothing;
    vectors of different dimension neither. Repeated rows are linked copies
    and share the result; a NULL id is never a smallest one, and rows that
    reach no other id have ``component_id`` NULL and are kept. An empty table
    gives an empty result. Columns named like the results are replaced.
    """
    v = F.col(vec_col)
    rows = df.select(row_struct(df), F.col(id_col).alias("_id"), F.col(group_col).alias("_group"), v.alias("_vec"),
                     (usable(vec_col) & F.col(group_col).isNotNull()).alias("_ok"))
    key = [F.when(F.col("_ok"), F.xxhash64(F.lit(i), "_group", "_vec")).alias(f"_h{i}") for i in (1, 2)]
    rows = rows.select("_row", "_id", "_group", "_vec", *key)
    # only the vector's hash, not the vector, goes with the rows
    nodes = (rows.where("_h1 is not null").groupBy("_h1", "_h2")
                 .agg(F.first("_vec").alias("vec"), F.first("_group").alias("_group"), F.min("_id").alias("least"), F.count(F.lit(1)).alias("weight")))
    nodes = materialise(nodes.select(F.monotonically_increasing_id().alias("node"), F.xxhash64("_group", F.size("vec")).alias("part"),
                                     "_h1", "_h2", "vec", "least", "weight"), "vectors")
    vectors = nodes.groupBy("part").count().agg(F.max("count")).first()[0] or 0
    passed = materialise(with_filters(nodes, vectors, cosine, 0), "filters")
    sketches = passed.select("node", "s1", "s2")
    hits = passed.select("node", F.explode("keys").alias("key"))
    # most filters have one vector only: they end here
    first = hits.groupBy("key").agg(F.min("node").alias("leader"), F.count(F.lit(1)).alias("k")).where("k > 1").drop("k")
    shared = materialise(hits.join(first, "key"), "shared-filters")
    balls = materialise(balls_of(nodes, shared, sketches, cosine), "balls")
    theta = math.acos(cosine)
    members = nodes.join(balls, "node").select("node", "ball", "radius", "part", "weight", "least", "vec")
    ball = members.groupBy("ball").agg(F.sum("weight").alias("size"), F.count(F.lit(1)).alias("nodes"), F.max("radius").alias("reach"),
                                       F.min("least").alias("least"), F.max("part").alias("part"))
    ball = ball.withColumn("solid", 2 * F.col("reach") <= theta - SLACK).withColumn("chunks", F.ceil(F.col("nodes") / TILE).cast("int"))
    ball = materialise(ball, "ball-sizes")
    centre = ball.join(nodes.select(F.col("node").alias("ball"), "vec"), "ball")
    links = _links(members, ball, centre, ball_pairs(nodes, shared, sketches, balls, vectors, cosine), cosine)
    of_ball = links.where("node is null").groupBy("ball").agg(F.sum("n").alias("by_ball"))
    of_node = links.where("node is not null").groupBy("node").agg(F.sum("n").alias("by_node"))
    edges = links.where("ball <> other").select(F.col("ball").alias("a"), F.col("other").alias("b")).distinct()
    label = components(edges).toDF("ball", "label")
    ball = ball.join(label, "ball", "left").withColumn("label", F.coalesce("label", "ball"))
    smallest = ball.groupBy("label").agg(F.min("least").alias("component"))
    ball = ball.join(smallest, "label").join(of_ball, "ball", "left").select("ball", "size", "solid", "component", "by_ball")
    zero = F.lit(0).cast("long")
    own = F.when(F.col("solid"), F.col("size")).otherwise(F.col("weight")) - 1
    result = (members.select("node", "ball", "weight").join(ball, "ball").join(of_node, "node", "left")
                     .join(nodes.select("node", "_h1", "_h2"), "node")
                     .select("_h1", "_h2", "component", (own + F.coalesce("by_ball", zero) + F.coalesce("by_node", zero)).alias("n")))
    out = rows.drop("_vec", "_group").join(result, ["_h1", "_h2"], "left")
    out = (out.withColumn("n_links", F.coalesce("n", zero))
              .withColumn("component_id", F.coalesce("component", "_id"))
              .withColumn("kept", F.col("_id").eqNullSafe(F.col("component_id"))))
    return unpack(out, ["n_links", "component_id", "kept"])


def _links(members: DataFrame, ball: DataFrame, centre: DataFrame, pairs: DataFrame, cosine: float) -> DataFrame:
    """``ball, other, node, n``: links of every vector of ``ball`` (node NULL)
    or of one of them with ``n`` rows of ball ``other``, written once. Pairs
    inside a ball that is not solid are counted too (other = ball)."""
    theta = math.acos(cosine)

    def side(s):
        return centre.select(F.col("ball").alias(s), F.col("vec").alias("x" if s == "a" else "y"),
                             *[F.col(c).alias(f"{c}_{s}") for c in ("reach", "size", "part", "chunks")])

    keep = ["a", "b", *[f"{c}_{s}" for c in ("reach", "size", "chunks") for s in "ab"]]
    both = with_cosine(pairs.join(side("a"), "a").join(side("b"), "b").where("part_a = part_b"), keep)
    angle = F.acos(F.greatest(F.least(F.col("cos"), F.lit(1.0)), F.lit(-1.0)))
    reach = F.col("reach_a") + F.col("reach_b")
    linked = (F.when(reach == 0, F.when(F.col("cos") >= cosine, 1).otherwise(0))
               .when(angle + reach <= theta - SLACK, 1).when(angle - reach > theta + SLACK, 0))
    both = materialise(both.withColumn("linked", linked), "ball-pairs")
    whole = both.where("linked = 1").select(F.explode(F.array(
        F.struct(F.col("a").alias("ball"), F.col("b").alias("other"), F.col("size_b").alias("n")),
        F.struct(F.col("b").alias("ball"), F.col("a").alias("other"), F.col("size_a").alias("n")))).alias("l"))
    whole = whole.select("l.ball", "l.other", F.lit(None).cast("long").alias("node"), "l.n")
    within = ball.where("not solid").select(F.col("ball").alias("a"), F.col("ball").alias("b"), F.col("chunks").alias("chunks_a"), F.col("chunks").alias("chunks_b"))
    undecided = both.where("linked is null").select("a", "b", "chunks_a", "chunks_b").unionByName(within)
    return materialise(whole.unionByName(tile_links(members, undecided, cosine)), "vector-links")


def tile_links(members: DataFrame, pairs: DataFrame, cosine: float) -> DataFrame:
    """``ball, other, node, n`` of ball pairs compared member by member.

    The members of a ball are dealt into chunks of about TILE by a hash, and
    a chunk of one ball meets a chunk of the other in one group; a ball meets
    itself in the chunk pairs i <= j.
    """
    importable(members.sparkSession)
    dealt = lambda chunks: F.pmod(F.xxhash64("node"), F.col(chunks)).cast("int")
    row = ["node", "weight", "vec"]
    same = F.col("a") == F.col("b")
    left = (pairs.join(members.select(F.col("ball").alias("a"), *row), "a").withColumn("i", dealt("chunks_a"))
                 .withColumn("j", F.explode(F.sequence(F.when(same, F.col("i")).otherwise(0), F.col("chunks_b") - 1))))
    right = (pairs.join(members.select(F.col("ball").alias("b"), *row), "b").withColumn("j", dealt("chunks_b"))
                  .withColumn("i", F.explode(F.sequence(F.lit(0), F.when(same, F.col("j")).otherwise(F.col("chunks_a") - 1)))))
    # the one chunk that a chunk meets as itself is sent once
    right = right.where(~same | (F.col("i") < F.col("j")))
    tile = ["a", "b", "i", "j"]
    rows = left.select(*tile, F.lit(0).alias("side"), *row).unionByName(right.select(*tile, F.lit(1).alias("side"), *row))
    schema = "ball long, other long, node long, n long"

    def count(key, t):
        a, b, i, j = (k.as_py() for k in key)
        t = t.combine_chunks()
        unit = next(iter(unit_rows(t["vec"].combine_chunks()).values()))[1]
        second = t["side"].to_numpy() == 1
        node, weight = t["node"].to_numpy(), t["weight"].to_numpy()
        if a == b and i == j:
            near = unit @ unit.T >= cosine
            np.fill_diagonal(near, False)
            n = near @ weight
            ball, other = np.full(len(n), a), np.full(len(n), a)
        else:
            near = unit[~second] @ unit[second].T >= cosine
            n = np.concatenate([near @ weight[second], near.T @ weight[~second]])
            node = np.concatenate([node[~second], node[second]])
            sizes = [len(near), near.shape[1]]
            ball, other = np.repeat([a, b], sizes), np.repeat([b, a], sizes)
        some = n > 0
        return pa.table([pa.array(c[some].astype(np.int64)) for c in (ball, other, node, n)], names=["ball", "other", "node", "n"])

    return rows.groupBy(*tile).applyInArrow(count, schema)


@query("op11_vector_links")
def op11_vector_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding with its links and the smallest id it reaches."""
    d = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    return vector_links(d).select("vec_id", "n_links", "component_id", "kept")
