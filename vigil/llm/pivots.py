"""Exact top-k by integer inner product, over a pivot-distance index.

Components x become floor(64 x).  One more component, sqrt(M^2 - |x|^2) for rows
and 0 for queries (M: the largest norm), turns the largest inner products into
the smallest Euclidean distances: |q' - x'|^2 = |q|^2 + M^2 - 2 q.x.  Distances
only steer the search; scores are integers.

Index.  Each row is keyed by its nearest pivot and its distance from it; rows
sorted by that key are cut into annuli of one pivot, at most ``ANNULUS`` rows each.
Pivots are fitted on at most ``SAMPLE`` rows; every row is indexed.

Search.  Queries in the same order form bundles.  A bundle meets whole annuli, one
pair per group.  First the annuli that its queries lie in or next to, then those that
half the queries' radius reaches, then all that the radius reaches: a query whose
k-th score is s needs no row farther than sqrt(|q|^2 + M^2 - 2 s), and by the
triangle inequality no annulus whose distances from its pivot all differ by more
from the query's.  After each step the radii shrink; a pair returns at most k rows a
query, and only those that reach its k-th score so far.

How it is spread.  A vector that many rows hold is searched through its k + 1
smallest ids: no other copy can be among k results.  That limit is taken per task
before the shuffle, so a hot vector costs k + 1 rows a task.  Annuli and bundles are
bounded; the directory of annuli has one row per ``ANNULUS`` rows and is joined, not
broadcast.

Defined cases: vectors that are null or hold null or non-finite components take no
part; a shorter vector counts as followed by zeros, so an empty one scores 0
everywhere; a multiple of 64 or a score beyond 64 bits is held at the limit; rows
equal in id and vector are one row; rows of one id with different vectors are
rows of their own, each asked on its own, none a candidate of its id; rows without an
id are no queries, and as candidates come after all ids on equal scores; an empty
table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vigil.llm.spark import frozen, stored, table

K = 20
EVERY = 20
SCALE = 64
PIVOTS = 32
SAMPLE = 4096
ANNULUS = 2048
BUNDLE = 512
#: Parts of the radius that the steps after the first one search.
STEPS = (0.5, 1.0)

_LOW = np.iinfo(np.int64).min
_HIGH = np.iinfo(np.int64).max


def _whole(vector: Column) -> Column:
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    return F.coalesce(F.forall(vector.cast("array<double>"), finite), F.lit(False))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column as one matrix, short rows followed by zeros."""
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(column), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = flat
    return out


def fit_pivots(sample: np.ndarray, largest: float, pivots: int = PIVOTS) -> np.ndarray:
    """Centres of the (augmented) sample: farthest-first starts, then a few rounds of means."""
    x = _augmented(sample, largest)
    centres = [x[0]] if len(x) else []
    far = ((x - x[0]) ** 2).sum(1) if len(x) else np.zeros(0)
    while len(centres) < min(pivots, len(x)) and far.max() > 0:
        centres.append(x[int(far.argmax())])
        far = np.minimum(far, ((x - centres[-1]) ** 2).sum(1))
    c = np.array(centres)
    for _ in range(6 if len(c) > 1 else 0):
        near = _distances(x, c).argmin(1)
        c = np.array([x[near == k].mean(0) if (near == k).any() else c[k] for k in range(len(c))])
    return c


def _augmented(x: np.ndarray, largest: float | None) -> np.ndarray:
    """Rows with their last component; ``largest`` (the squared norm M^2) None: queries."""
    x = x.astype(np.float64)
    last = np.zeros(len(x)) if largest is None else np.sqrt(np.maximum(0.0, largest - (x * x).sum(1)))
    return np.hstack([x, last[:, None]])


def _distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    square = (x * x).sum(1)[:, None] + (centres * centres).sum(1) - 2 * (x @ centres.T)
    return np.sqrt(np.maximum(0.0, square))


def _products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact inner products, held at the limits of 64 bits."""
    bound = float(np.abs(q.astype(np.float64)).max(initial=0)) * float(np.abs(x.astype(np.float64)).max(initial=0)) * max(1, q.shape[1])
    if bound < 2**53:
        return (q.astype(np.float64) @ x.astype(np.float64).T).astype(np.int64)
    exact = q.astype(object) @ x.astype(object).T
    return np.clip(exact, _LOW + 1, _HIGH).astype(np.int64)


def _best(scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of each row's k largest, equal ones by column."""
    n, m = scores.shape
    if m <= k:
        return np.repeat(np.arange(n), m), np.tile(np.arange(m), n)
    if np.abs(scores.astype(np.float64)).max(initial=0) < 2**62 / m:
        keys = scores * m + np.arange(m - 1, -1, -1)
        top = np.argpartition(keys, m - k, axis=1)[:, m - k :]
    else:
        top = np.argsort(-np.maximum(scores, _LOW + 1), axis=1, kind="stable")[:, :k]
    return np.repeat(np.arange(n), k), top.ravel()


class _Cuts:
    """Cuts a sorted stream of rows into packed groups of at most ``size`` rows (of one pivot, if ``apart``)."""

    def __init__(self, size: int, apart: bool):
        self.size, self.apart = size, apart

    def __call__(self, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            held = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
            groups, rest = self._ready(held, False)
            held = held.slice(rest)
            if groups:
                yield self._packed(groups)
        if held is not None and held.num_rows:
            yield self._packed(self._ready(held, True)[0])

    def _ready(self, rows: pa.Table, last: bool) -> tuple[list[pa.Table], int]:
        pivot = rows["pivot"].to_numpy()
        ends = [*(np.flatnonzero(np.diff(pivot)) + 1), len(pivot)] if self.apart else [len(pivot)]
        out, at = [], 0
        for end in ends:
            whole = last or end != len(pivot)
            while at < end and (whole or end - at >= self.size):
                out.append(rows.slice(at, min(self.size, end - at)))
                at += out[-1].num_rows
        return out, at

    def _packed(self, groups: list[pa.Table]) -> pa.RecordBatch:
        rows = []
        for g in groups:
            ids, nil = g["vec_id"].to_numpy(), g["nil"].to_numpy().astype(np.int8)
            order = np.lexsort((ids, nil))  # equal scores then follow the places
            dist = g["dist"].to_numpy()
            vectors = g["vector"].to_pylist()
            rows.append((
                int(g["pivot"][0].as_py()), float(dist.min()), float(dist.max()), len(ids),
                ids[order].tobytes(), nil[order].tobytes(), b"".join(vectors[i] for i in order),
            ))
        columns = list(zip(*rows))
        types = [pa.int32(), pa.float64(), pa.float64(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=_GROUP)


_GROUP = ["pivot", "lo", "hi", "n", "ids", "nils", "vectors"]
_GROUP_SCHEMA = "pivot int, lo double, hi double, n int, ids binary, nils binary, vectors binary"


def _placed(rows: DataFrame, centres: np.ndarray, largest: float | None, width: int, kind: str) -> DataFrame:
    """``vec_id, nil, pivot, dist, vector``: each row under its nearest pivot; the vector as packed numbers."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column("x"), width)
            d = _distances(_augmented(x, largest), centres)
            near = d.argmin(1)
            packed = np.ascontiguousarray(x.astype(kind))
            vectors = [r.tobytes() for r in packed]
            ids = batch.column("vec_id")
            yield pa.RecordBatch.from_arrays(
                [
                    ids.fill_null(_HIGH), ids.is_null(), pa.array(near.astype(np.int32)),
                    pa.array(d[np.arange(len(d)), near]), pa.array(vectors, pa.binary()),
                ],
                names=["vec_id", "nil", "pivot", "dist", "vector"],
            )

    return rows.mapInArrow(run, "vec_id long, nil boolean, pivot int, dist double, vector binary")


def _groups(placed: DataFrame, size: int, apart: bool, label: str, name: str) -> DataFrame:
    """Packed groups of neighbours, numbered, each ``size`` rows at most; stored."""
    key = ["pivot", "dist", "vec_id"]  # the id splits copies of one vector
    ranged = placed.repartitionByRange(*key).sortWithinPartitions(*key)
    return stored(ranged.mapInArrow(_Cuts(size, apart), _GROUP_SCHEMA).withColumn(name, F.monotonically_increasing_id()), label)


def _taus(taus: object, n: int) -> np.ndarray:
    """The k-th score so far of each of a bundle's queries; the lowest number where there is none."""
    out = np.full(n, _LOW, np.int64)
    for row in taus if taus is not None else ():
        out[row["pos"]] = row["tau"]
    return out


def _radius(q: np.ndarray, tau: np.ndarray, largest: float) -> np.ndarray:
    """No better row than the k-th lies farther; a little wider, against rounding."""
    square = (q.astype(np.float64) ** 2).sum(1) + largest
    reach = np.sqrt(np.maximum(0.0, square - 2 * tau.astype(np.float64))) + 1e-7 * np.sqrt(square) + 1e-6
    return np.where(tau == _LOW, np.inf, reach)


class Search:
    """The index of ``rows`` and the steps that search it."""

    def __init__(
        self,
        rows: DataFrame,
        id_col: str = "vec_id",
        vector_col: str = "embedding",
        k: int = K,
        every: int = EVERY,
        pivots: int = PIVOTS,
        annulus: int = ANNULUS,
        bundle: int = BUNDLE,
    ):
        self.k = k
        vector = F.col(vector_col)
        whole = F.transform(vector.cast("array<double>"), lambda x: F.floor(x * SCALE).cast("long"))
        given = rows.where(_whole(vector)).select(F.col(id_col).cast("long").alias("vec_id"), whole.alias("x"))
        given = stored(given.distinct(), "pivot-rows")
        first = Window.partitionBy("x").orderBy(F.col("vec_id").asc_nulls_last())
        kept = given.withColumn("_r", F.row_number().over(first)).where(F.col("_r") <= k + 1).drop("_r")
        square = F.aggregate("x", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
        stats = given.agg(
            F.max(F.size("x")).alias("width"),
            F.max(square).alias("square"),
            F.max(F.coalesce(F.array_max(F.transform("x", lambda x: F.greatest(x, -1 - x))), F.lit(0))).alias("most"),
        ).head()
        self.width = max(1, stats["width"] or 0)
        self.largest = float(stats["square"] or 0.0) * (1 + 1e-9) + 1.0
        most = stats["most"] or 0
        self.kind = "<i2" if most < 1 << 15 else "<i4" if most < 1 << 31 else "<i8"
        drawn = given.orderBy(F.xxhash64("vec_id", "x")).limit(SAMPLE).select("x").toArrow()
        sample = drawn["x"].combine_chunks() if drawn.num_rows else None
        self.empty = sample is None
        if self.empty:
            return
        if isinstance(sample, pa.ChunkedArray):
            sample = sample.chunk(0)
        self.centres = fit_pivots(_matrix(sample, self.width), self.largest, pivots)
        asked = given.where(F.col("vec_id") % every == 0)
        self.annuli = _groups(_placed(kept, self.centres, self.largest, self.width, self.kind), annulus, True, "pivot-annuli", "annulus")
        self.bundles = _groups(_placed(asked, self.centres, None, self.width, self.kind), bundle, False, "pivot-queries", "bundle")

    def _reach(self, part: float, best: DataFrame | None) -> tuple[DataFrame, DataFrame]:
        """Bundles with the k-th scores so far, and the annuli that ``part`` of their queries' radii reach."""
        if best is None:
            bundles = self.bundles.withColumn("taus", F.lit(None).cast("array<struct<pos:int,tau:bigint>>"))
        else:
            tau = best.groupBy("bundle", "pos").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("tau"))
            taus = tau.where(F.col("n") >= self.k).groupBy("bundle").agg(F.collect_list(F.struct("pos", "tau")).alias("taus"))
            bundles = self.bundles.join(taus, "bundle", "left")
        centres, width, kind, largest = self.centres, self.width, self.kind, self.largest

        def spans(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                out = []
                for row in batch.to_pylist():
                    q = np.frombuffer(row["vectors"], kind).reshape(row["n"], width)
                    d = _distances(_augmented(q, None), centres)
                    if part == 0:  # only where the queries themselves lie
                        own = d.argmin(1)
                        for p in np.unique(own):
                            there = d[own == p, p]
                            out.append((row["bundle"], int(p), float(there.min()), float(there.max())))
                        continue
                    r = (_radius(q, _taus(row["taus"], len(q)), largest) * part)[:, None]
                    low, high = (d - r).min(0), (d + r).max(0)
                    out += [(row["bundle"], p, float(low[p]), float(high[p])) for p in range(len(centres))]
                columns = list(zip(*out)) or [(), (), (), ()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, [pa.int64(), pa.int32(), pa.float64(), pa.float64()])],
                    names=["bundle", "pivot", "low", "high"],
                )

        reached = bundles.mapInArrow(spans, "bundle long, pivot int, low double, high double")
        directory = self.annuli.select("annulus", "pivot", "lo", "hi", "n")
        if part == 0:  # also the next annuli, until there are rows enough for a first radius
            gap = F.greatest(F.lit(0.0), F.col("lo") - F.col("high"), F.col("low") - F.col("hi"))
            nearer = Window.partitionBy("bundle", "pivot").orderBy("gap", "annulus").rowsBetween(Window.unboundedPreceding, -1)
            met = reached.join(directory, "pivot").withColumn("gap", gap).withColumn("nearer", F.coalesce(F.sum("n").over(nearer), F.lit(0)))
            met = met.where((F.col("gap") == 0) | (F.col("nearer") <= self.k))
        else:
            met = reached.join(directory, "pivot").where("lo <= high AND hi >= low")
        return bundles, met.select("bundle", "annulus").distinct()

    def _meet(self, bundles: DataFrame, pairs: DataFrame) -> DataFrame:
        """Each pair's best rows: ``bundle, pos, query_id, vec_id, score`` (a missing id is null)."""
        centres, width, kind, largest, k = self.centres, self.width, self.kind, self.largest, self.k

        def run(pair: pd.DataFrame) -> pd.DataFrame:
            found = []
            for row in pair.itertuples(index=False):
                q = np.frombuffer(row.q_vectors, kind).reshape(row.q_n, width)
                q_ids = np.frombuffer(row.q_ids, np.int64)
                tau = _taus(row.taus, row.q_n)
                d = _distances(_augmented(q, None), centres[row.pivot : row.pivot + 1])[:, 0]
                away = np.maximum(0.0, np.maximum(d - row.hi, row.lo - d))
                live = np.flatnonzero(away <= _radius(q, tau, largest))
                if not len(live):
                    continue
                ids, nil = np.frombuffer(row.ids, np.int64), np.frombuffer(row.nils, np.int8)
                x = np.frombuffer(row.vectors, kind).reshape(row.n, width)
                scores = _products(q[live], x)
                own = (q_ids[live][:, None] == ids) & (nil == 0)
                scores[own] = scores.min() - 1  # below all others, so that it takes no other row's place
                i, j = _best(scores, k)
                s = scores[i, j]
                good = ~own[i, j] & (s >= tau[live[i]])
                i, j = live[i[good]], j[good]
                found.append(pd.DataFrame({
                    "bundle": row.bundle, "pos": i, "query_id": q_ids[i],
                    "vec_id": pd.arrays.IntegerArray(ids[j].copy(), nil[j] != 0), "score": s[good],
                }))
            if not found:
                return pd.DataFrame({c: pd.Series(dtype="int64") for c in ("bundle", "pos", "query_id", "vec_id", "score")})
            return pd.concat(found)

        asked = bundles.select("bundle", F.col("n").alias("q_n"), F.col("ids").alias("q_ids"), F.col("vectors").alias("q_vectors"), "taus")
        rows = pairs.join(asked, "bundle").join(self.annuli, "annulus")
        # the join on annulus has already brought a pair's rows together
        return rows.groupBy("annulus", "bundle").applyInPandas(run, "bundle long, pos int, query_id long, vec_id long, score long")

    def _top(self, rows: DataFrame) -> DataFrame:
        order = Window.partitionBy("bundle", "pos").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last())
        return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= self.k)

    def top(self) -> DataFrame:
        """``query_id, rank, vec_id, score`` of every query's k best rows."""
        bundles, seen = self._reach(0, None)
        seen = frozen(seen)
        best = frozen(self._top(self._meet(bundles, seen)))
        for part in STEPS:
            bundles, pairs = self._reach(part, best)
            new = frozen(pairs.join(seen, ["bundle", "annulus"], "left_anti"))
            found = self._meet(bundles, new)
            best = frozen(self._top(best.drop("rank").unionByName(found)))
            seen = seen.unionByName(new)
        self.met = seen
        return best.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def top_products(rows: DataFrame, **options: object) -> DataFrame:
    """``query_id, rank, vec_id, score``: see the module's text; options as in :class:`Search`."""
    search = Search(rows, **options)
    if search.empty:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    return search.top()


def op11_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_products(table(spark, sf_dir, "embeddings"))


SQL = """
WITH rows_ AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM rows_ q JOIN rows_ c ON q.vec_id % 20 = 0 AND c.vec_id IS DISTINCT FROM q.vec_id),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id NULLS LAST) AS INTEGER) AS rank FROM pairs)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""
