"""Near-duplicate vectors by collision counting on one-dimensional projections.

Vectors (scaled to length one) are projected on ``LINES`` random directions.
On each line the other vectors are sorted, and those within a window centred
on the query's value collide with it.  Two vectors at the threshold cosine
have projections that differ by a normal variable of known spread, so the
window and the count that a true pair reaches with probability ``RECALL`` follow from the
binomial distribution (``calibrate``).  Pairs that collide on fewer lines are
dropped, the others are verified by their cosine in double precision.

How it is spread: rows of one label are cut into cells along the first line,
wider than a true pair can differ there (again at ``RECALL``), and each cell into tiles of
at most about ``TILE`` rows by hash.  Only tiles of the same or neighbouring
cells meet, each two in one task of bounded size.  A tile pair does not emit its
pairs: it returns a link count per row and, per row, one link to its local
group's first row, which keeps all connections.  So a group of copies costs
rows, not pairs of rows.

Equal vectors of a label are one row with a multiplicity.

Defined cases: vectors that are null, of length zero, or hold null or
non-finite numbers, and rows without a label link with nothing and stay as
their own component; only vectors of equal size are compared; null ids are
never the smallest of a component, and not kept; repeated rows are further
copies; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.llm.components import component_ids
from vigil.llm.spark import frozen, table

THRESHOLD = 0.98
LINES = 20
RECALL = 0.9999
TILE = 1024
SEED = 7


def _normal(x: float) -> float:
    return 0.5 * (1 + math.erf(x / math.sqrt(2)))


def calibrate(threshold: float = THRESHOLD, lines: int = LINES, recall: float = RECALL) -> tuple[float, int, float]:
    """Half-width of the windows, collisions a pair must have, and the cells' width.

    At the threshold, projections differ by a normal variable with spread
    sqrt(2 - 2 threshold).  The window of 2.25 spreads leaves most unrelated
    pairs outside; the count is the largest that ``recall`` of true pairs reach.
    """
    spread = math.sqrt(2 - 2 * threshold)
    p = 2 * _normal(2.25) - 1
    tail, count = 0.0, lines
    while count > 0:
        tail += math.comb(lines, count) * p**count * (1 - p) ** (lines - count)
        if tail >= recall:
            break
        count -= 1
    reach = 0.0
    while 2 * _normal(reach) - 1 < recall:
        reach += 0.01
    return 2.25 * spread, count, reach * spread


@lru_cache(maxsize=16)
def directions(size: int, lines: int = LINES) -> np.ndarray:
    return np.random.default_rng((SEED, size)).standard_normal((size, lines))


def collisions(a: np.ndarray, b: np.ndarray, half: float) -> np.ndarray:
    """How many lines each pair (row of ``a``, row of ``b``) collides on; columns are lines."""
    n, m = len(a), len(b)
    counts = np.zeros(n * m, np.int64)
    rows = np.arange(n) * m
    for k in range(a.shape[1]):
        order = np.argsort(b[:, k])
        line = b[order, k]
        lo = np.searchsorted(line, a[:, k] - half)
        size = np.searchsorted(line, a[:, k] + half, "right") - lo
        ends = np.cumsum(size)
        if len(ends) and ends[-1]:
            at = np.arange(ends[-1]) + np.repeat(lo - (ends - size), size)
            counts += np.bincount(np.repeat(rows, size) + order[at], minlength=n * m)
    return counts.reshape(n, m)


def _groups(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The smallest row reachable from each of ``n`` rows over the links."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[left], root[right])
        new = root.copy()
        np.minimum.at(new, root[left], low)
        np.minimum.at(new, root[right], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _meet(threshold: float, lines: int, recall: float):
    half, least, _ = calibrate(threshold, lines, recall)

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("node", kind="stable")
        first, second = rows[rows["side"] != 1], rows[rows["side"] != 0]  # side 2: the tile meets itself
        v = np.stack([np.asarray(x, np.float64) for x in rows["vector"]])
        v /= np.linalg.norm(v, axis=1, keepdims=True)
        lines_ = v @ directions(v.shape[1], lines)
        a, b = (np.flatnonzero((rows["side"] != s).to_numpy()) for s in (1, 0))
        i, j = np.nonzero(collisions(lines_[a], lines_[b], half) >= least)
        i, j = a[i], b[j]
        if len(first) and len(second) and rows["side"].iat[0] == 2:
            i, j = i[i < j], j[i < j]
        sure = np.zeros(len(i), bool)
        for k in range(0, len(i), 1 << 16):
            s = slice(k, k + (1 << 16))
            sure[s] = np.einsum("nd,nd->n", v[i[s]], v[j[s]]) >= threshold
        i, j = i[sure], j[sure]
        weight = rows["copies"].to_numpy()
        links = np.bincount(i, weight[j], len(rows)) + np.bincount(j, weight[i], len(rows))
        node = rows["node"].to_numpy()
        there = np.flatnonzero(links > 0)
        return pd.DataFrame({"node": node[there], "links": links[there].astype(np.int64), "root": node[_groups(len(rows), i, j)[there]]})

    return run


def _valid(vector):
    number = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    return F.coalesce(F.forall(vector, number) & F.exists(vector, lambda x: x != 0), F.lit(False))


def _first_line(vector, sizes: list[int], lines: int):
    """The projection on the first line, as a column."""
    total = F.aggregate(vector, F.lit(0.0), lambda s, x: s + x * x)
    out = F.lit(None).cast("double")
    for size in sizes:
        direction = F.array(*[F.lit(float(x)) for x in directions(size, lines)[:, 0]])
        dot = F.aggregate(F.zip_with(vector, direction, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
        out = F.when(F.size(vector) == size, dot).otherwise(out)
    return out / F.sqrt(total)


def near_vectors(
    rows: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    threshold: float = THRESHOLD,
    lines: int = LINES,
    recall: float = RECALL,
    tile: int = TILE,
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row."""
    given = rows.select(
        F.col(id_col).cast("long").alias("vec_id"),
        F.col(vector_col).cast("array<double>").alias("vector"),
        F.col(label_col).alias("label"),
    )
    ok = F.col("label").isNotNull() & _valid(F.col("vector"))
    keyed = frozen(given.withColumn("node", F.when(ok, F.xxhash64("label", "vector"))))
    classes = (
        keyed.where(F.col("node").isNotNull())
        .groupBy("node")
        .agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("copies"), F.first("label").alias("label"), F.first("vector").alias("vector"))
    )
    # vector sizes: usually one; each needs its own directions
    sizes = [r["n"] for r in keyed.where(F.col("node").isNotNull()).select(F.size("vector").alias("n")).distinct().collect()]
    _, _, width = calibrate(threshold, lines, recall)
    line = _first_line(F.col("vector"), sizes, lines)
    classes = frozen(classes.select("*", F.size("vector").alias("dims"), F.floor(line / width).alias("cell")))

    cell = ["label", "dims", "cell"]
    counts = classes.groupBy(*cell).agg(F.ceil(F.count(F.lit(1)) / tile).cast("int").alias("tiles"))

    def beside(step: int, name: str):
        return counts.select("label", "dims", (F.col("cell") + step).alias("cell"), F.col("tiles").alias(name))

    around = counts.join(beside(-1, "above"), cell, "left").join(beside(1, "below"), cell, "left").fillna(0, ["above", "below"])
    placed = classes.join(around, cell).withColumn("tile", F.pmod(F.xxhash64("node", F.lit(1)), "tiles").cast("int"))
    mine = F.col("tile")

    def meetings(first_cell, other, n, side):
        """One meeting per other tile: (cell of the first tile, first tile, second tile, kind, side)."""
        tiles = F.sequence(F.lit(0), n - 1)
        return F.when(
            n > 0,
            F.transform(tiles, lambda t: F.struct(first_cell.alias("at"), *other(t), F.lit(side).alias("side"))),
        ).otherwise(F.array().cast("array<struct<at:bigint,one:int,two:int,kind:int,side:int>>"))

    def named(one, two, kind):
        return one.alias("one"), two.alias("two"), F.lit(kind).alias("kind")

    same = F.transform(
        F.sequence(F.lit(0), F.col("tiles") - 1),
        lambda t: F.struct(
            F.col("cell").alias("at"),
            F.least(mine, t).alias("one"),
            F.greatest(mine, t).alias("two"),
            F.lit(0).alias("kind"),
            F.when(t == mine, 2).when(mine < t, 0).otherwise(1).alias("side"),
        ),
    )
    up = meetings(F.col("cell"), lambda t: named(mine, t, 1), F.col("above"), 0)
    down = meetings(F.col("cell") - 1, lambda t: named(t, mine, 1), F.col("below"), 1)
    dealt = placed.withColumn("_m", F.explode(F.concat(same, up, down))).select("label", "dims", "_m.*", "node", "copies", "vector")
    met = dealt.groupBy("label", "dims", "at", "one", "two", "kind").applyInPandas(
        _meet(threshold, lines, recall), "node long, links long, root long"
    )
    met = frozen(met)
    degrees = met.groupBy("node").agg(F.sum("links").alias("links"))
    links = met.where("node <> root").select(F.greatest("node", "root").alias("src"), F.least("node", "root").alias("dst")).distinct()
    groups = component_ids(links)
    named_ = (
        classes.select("node", "least", "copies")
        .join(degrees, "node", "left")
        .join(groups.withColumnRenamed("id", "node"), "node", "left")
        .select("node", "least", F.coalesce("component", "node").alias("_c"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    )
    least = named_.groupBy("_c").agg(F.min("least").alias("component_id"))
    found = named_.join(least, "_c").select("node", "n_links", "component_id")
    own = F.col("node").isNull()
    return (
        keyed.select("vec_id", "node")
        .join(found, "node", "left")
        .select(
            "vec_id",
            F.when(own, F.lit(0)).otherwise(F.col("n_links")).cast("long").alias("n_links"),
            F.when(own, F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"),
        )
        .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
    )


def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


SQL = """
WITH RECURSIVE good AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS MATERIALIZED (
  SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE len(a.v) = len(b.v) AND list_dot_product(a.v, b.v) / sqrt(list_dot_product(a.v, a.v) * list_dot_product(b.v, b.v)) >= 0.98),
reached AS (
  SELECT vec_id, vec_id AS other FROM embeddings
  UNION SELECT r.vec_id, l.b FROM reached r JOIN links l ON l.a = r.other),
least AS (SELECT vec_id, min(other) AS component_id FROM reached GROUP BY vec_id),
degrees AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings LEFT JOIN degrees USING (vec_id) LEFT JOIN least USING (vec_id)
"""
