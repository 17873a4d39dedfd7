"""Centroid clustering with Ptolemaic pivots.

For any four points of Euclidean space, d(x,c) d(p,s) >= |d(x,p) d(c,s) - d(x,s) d(c,p)|.
The distances of every vector to a few fixed pivots are taken once and kept with
it; with the centroid's own distances to them, each pair of pivots bounds the
vector's distance to a centroid from below. Bounds are rounded down, so that
only centroids that cannot win are left out; the others are measured exactly, in
integers.
"""

import hashlib
import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mendlake.llm.common import settle, table

SCALE = 1024
DIMENSIONS = 64
CLUSTERS = 8
ROUNDS = 10
#: Vectors that serve as pivots; all their pairs give bounds.
PIVOTS = 8
#: Steps a component may have, so that every squared distance is a long.
LIMIT = 1 << 27
#: Relative error allowed for in a bound, some thirty times that of its few roundings.
SLACK = 1e-14


def stepped(vectors, dimensions=DIMENSIONS):
    """``vec_id`` and ``vector``, in steps of 1/1024, of the vectors that take part.

    Those are the ones with just ``dimensions`` components, all of them finite
    numbers below ``LIMIT`` steps: beyond, squared distances are no longs.
    """
    def odd(x):
        return x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) * SCALE >= LIMIT)

    fit = vectors.filter((F.size("embedding") == dimensions) & ~F.exists("embedding", odd))
    return fit.select("vec_id", F.transform("embedding", lambda x: F.floor(x.cast("double") * SCALE)).alias("vector"))


def first_vectors(vectors, n, seed):
    """The ``n`` vectors with the least hash of seed and id, in that order, as lists of integers; ids that are null come last."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    rows = vectors.orderBy(digest.asc_nulls_last(), "vector").limit(n).collect()
    return [list(r["vector"]) for r in rows]


def _matrix(column):
    return column.flatten().to_numpy().reshape(len(column), -1)


def _between(points, others):
    """Exact squared distances, points x others, of integer matrices."""
    return np.stack([((points - o) ** 2).sum(axis=1) for o in others], 1)


class Bounds:
    """Lower bounds of the distances to the centroids from distances to the pivots."""

    def __init__(self, centroids, pivots):
        self.to_pivots = np.sqrt(_between(centroids, pivots).astype(np.float64))
        apart = np.sqrt(_between(pivots, pivots).astype(np.float64))
        pairs = [(a, b) for a, b in itertools.combinations(range(len(pivots)), 2) if apart[a, b] > 0]
        self.pairs = [(a, b, apart[a, b]) for a, b in pairs]

    def squared(self, cached):
        """At most the squared distance of each vector to each centroid; ``cached``: vectors x pivots."""
        low = np.zeros((len(cached), len(self.to_pivots)))
        for a, b, apart in self.pairs:
            left = cached[:, a, None] * self.to_pivots[:, b]
            right = cached[:, b, None] * self.to_pivots[:, a]
            np.maximum(low, (np.abs(left - right) - SLACK * (left + right)) / apart, out=low)
        return low * low * (1 - SLACK)

    def nearest_guess(self, cached):
        """The centroid with the least way round by a pivot."""
        return (cached[:, None, :] + self.to_pivots).min(axis=2).argmin(axis=1)


def nearest(points, cached, centroids, bounds):
    """(cluster, squared distance) of each point, ties to the smaller number, and how many distances were taken."""
    guess = bounds.nearest_guess(cached)
    best = ((points - centroids[guess]) ** 2).sum(axis=1)
    cluster, taken = guess.copy(), len(points)
    open_ = bounds.squared(cached) <= best[:, None] * (1 + SLACK)
    for k in range(len(centroids)):
        rows = np.flatnonzero(open_[:, k] & (guess != k))
        if not len(rows):
            continue
        found = ((points[rows] - centroids[k]) ** 2).sum(axis=1)
        wins = (found < best[rows]) | ((found == best[rows]) & (k < cluster[rows]))
        best[rows[wins]], cluster[rows[wins]] = found[wins], k
        taken += len(rows)
    return cluster, best, taken


def _with_pivots(vectors, pivots):
    """Adds ``to_pivots``, the distances to the pivots."""
    schema = T.StructType([*vectors.schema.fields, T.StructField("to_pivots", T.ArrayType(T.DoubleType()))])

    def run(batches):
        fixed = np.array(pivots, np.int64)
        for batch in batches:
            if batch.num_rows:
                far = np.sqrt(_between(_matrix(batch.column("vector")), fixed).astype(np.float64))
                listed = pa.FixedSizeListArray.from_arrays(pa.array(far.ravel()), len(fixed)).cast(pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([*batch.columns, listed], names=schema.names)

    return vectors.mapInArrow(run, schema)


def _sums(placed, centroids, pivots):
    """Per cluster the vectors that are nearest to it: their number and the sums of their components."""
    def run(batches):
        points, fixed = np.array(centroids, np.int64), np.array(pivots, np.int64)
        bounds = Bounds(points, fixed)
        sums, counts, taken = np.zeros(points.shape, np.int64), np.zeros(len(points), np.int64), 0
        for batch in batches:
            if batch.num_rows:
                rows = _matrix(batch.column("vector"))
                cluster, _, n = nearest(rows, _matrix(batch.column("to_pivots")), points, bounds)
                np.add.at(sums, cluster, rows)
                counts += np.bincount(cluster, minlength=len(points))
                taken += n
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_pydict({
            "cluster": pa.array(some, pa.int32()), "n": pa.array(counts[some]), "sums": sums[some].tolist(),
            "taken": pa.array(np.where(np.arange(len(some)) == 0, taken, 0))})

    parts = placed.mapInArrow(run, "cluster int, n long, sums array<long>, taken long")
    # A row per task and cluster; the sums of a component stay exact beyond longs.
    totals = parts.select("cluster", F.posexplode("sums").alias("at", "sum")).groupBy("cluster", "at").agg(
        F.sum(F.col("sum").cast("decimal(20,0)")).alias("sum"))
    totals = totals.groupBy("cluster").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "sum"))), lambda x: x["sum"]).alias("sums"))
    counts = parts.groupBy("cluster").agg(F.sum("n").alias("n"), F.sum("taken").alias("taken"))
    return counts.join(totals, "cluster")


def _assigned(placed, centroids, pivots):
    schema = T.StructType([
        *placed.select("vec_id").schema.fields, T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType())])

    def run(batches):
        points, fixed = np.array(centroids, np.int64), np.array(pivots, np.int64)
        bounds = Bounds(points, fixed)
        for batch in batches:
            if batch.num_rows:
                cluster, distance, _ = nearest(_matrix(batch.column("vector")), _matrix(batch.column("to_pivots")), points, bounds)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id"), pa.array(cluster, pa.int32()), pa.array(distance, pa.int64())], names=schema.names)

    return placed.mapInArrow(run, schema)


def cluster(vectors, k=CLUSTERS, rounds=ROUNDS, pivots=PIVOTS, seed=3):
    """``vectors(vec_id, vector)`` with integer components, in ``k`` clusters: vec_id, cluster and squared distance.

    Returns the assignment, the centroids as lists, and how many distances were
    measured in the rounds. Centroids start as the ``k`` vectors with the least
    hash of seed and id; each of ``rounds`` rounds gives every vector to the
    nearest one (ties: the smaller number) and moves every centroid that has
    vectors to the floor of their mean; then vectors are assigned once more.
    Rows are vectors: equal ones and ids that come twice all take part. A null
    id is kept and never starts a cluster while others are left; with fewer
    vectors than clusters there are fewer clusters, with none no rows. All
    components have to stay below ``LIMIT``. The driver holds ``k`` centroids and
    the pivots; a round moves one row of sums per task and cluster.
    """
    chosen = first_vectors(vectors, max(k, pivots), seed)
    if not chosen:
        empty = vectors.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance"))
        return empty, [], 0
    fixed, centroids, taken = chosen[:pivots], chosen[:k], 0
    placed = settle(_with_pivots(vectors, fixed), "to-pivots")
    for _ in range(rounds):
        for r in _sums(placed, centroids, fixed).collect():  # a row per cluster
            centroids[r["cluster"]] = [int(s) // r["n"] for s in r["sums"]]
            taken += r["taken"]
    return _assigned(placed, centroids, fixed), centroids, taken


def op11_ptolemaic_clusters(spark, sf_dir):
    """Cluster and squared distance of every vector with 64 finite components, with sums and a digest of the centroid.

    Vectors of another length, null, or with null, infinite or huge components
    (``LIMIT``) have no row. Sums that are no longs are null.
    """
    vectors = settle(stepped(table(spark, sf_dir, "embeddings")), "stepped")
    assigned, centroids, _ = cluster(vectors)
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    assigned = settle(assigned, "assigned")
    per_cluster = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("c"))
    total = per_cluster.agg(F.sum("c").alias("t"))
    sums = per_cluster.join(total).select(  # a row per cluster and one of their sum
        "cluster", F.col("c").try_cast("long").alias("cluster_inertia"), F.col("t").try_cast("long").alias("inertia"))
    digest = F.get(F.array(*map(F.lit, digests)).cast("array<string>"), F.col("cluster"))
    return assigned.join(F.broadcast(sums), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", digest.alias("centroid_sha256"))


def _sql(rounds=ROUNDS):
    """The same rounds in SQL, a pair of tables each."""
    distance = "list_sum(list_transform(list_zip(v.v, c.v), lambda x: (x[1] - x[2]) * (x[1] - x[2])))"
    parts = [f"""fit AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id,
  list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE len(embedding) = {DIMENSIONS} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x) OR abs(CAST(x AS DOUBLE)) * 1024 >= {LIMIT})) = 0),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('3:' || CAST(vec_id AS VARCHAR)) NULLS LAST, v) - 1 AS cluster, v
  FROM (SELECT * FROM fit ORDER BY sha256('3:' || CAST(vec_id AS VARCHAR)) NULLS LAST, v LIMIT {CLUSTERS}) x)"""]
    for n in range(rounds + 1):
        parts.append(f"""a{n} AS MATERIALIZED (SELECT r, min(d) AS distance, arg_min(cluster, (d, cluster)) AS cluster
  FROM (SELECT v.r, c.cluster, {distance} AS d FROM fit v CROSS JOIN c{n} c) x GROUP BY r)""")
        if n < rounds:
            parts.append(f"""c{n + 1} AS MATERIALIZED (SELECT c.cluster, coalesce(m.v, c.v) AS v FROM c{n} c LEFT JOIN
  (SELECT cluster, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS v FROM
    (SELECT cluster, i, sum(x) AS s, count(*) AS n FROM (SELECT a.cluster, unnest(f.v) AS x, generate_subscripts(f.v, 1) AS i
      FROM a{n} a JOIN fit f USING (r)) y GROUP BY cluster, i) z GROUP BY cluster) m USING (cluster))""")
    return f"""WITH {", ".join(parts)}
SELECT f.vec_id, CAST(a.cluster AS INTEGER) AS cluster, CAST(a.distance AS BIGINT) AS distance,
  CAST(sum(a.distance) OVER (PARTITION BY a.cluster) AS BIGINT) AS cluster_inertia, CAST(sum(a.distance) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM a{rounds} a JOIN fit f USING (r) JOIN c{rounds} c USING (cluster)"""


SQL = {"op11_ptolemaic_clusters": _sql()}
