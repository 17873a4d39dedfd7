"""Exact top-k search by inner product with a KD-tree per shard.

Vectors are dealt to shards by a hash of their id. A shard's tree splits at
medians and keeps tight boxes; a query visits its nodes in the order of the best
score their boxes allow, until no box reaches the k-th score found. Each query
first searches one shard; its k-th score there then bounds the search of all
other shards.
"""

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from mendlake.llm.common import settle, table

SHARD_ROWS = 8192
LEAF_ROWS = 64
SCALE = 1024


class KdTree:
    """Median splits of integer points down to small leaves, with the box of each node."""

    def __init__(self, ids, rows, points):
        order, lo, hi, span, children = np.arange(len(ids)), [], [], [], []
        todo = [(0, len(ids), None)]
        while todo:
            start, end, place = todo.pop()
            here, node = order[start:end], len(span)
            lo.append(points[here].min(axis=0))
            hi.append(points[here].max(axis=0))
            span.append((start, end))
            children.append([])
            if place is not None:
                children[place].append(node)
            widths = hi[-1] - lo[-1]
            if end - start > LEAF_ROWS and widths.max() > 0:
                half = (end - start) // 2
                axis = points[here, int(np.argmax(widths))]
                order[start:end] = here[np.argpartition(axis, half)]
                todo += [(start, start + half, node), (start + half, end, node)]
        self.ids, self.rows, self.points = ids[order], rows[order], points[order]
        self.lo, self.hi, self.span, self.children = np.stack(lo), np.stack(hi), span, children

    def bounds(self, queries):
        """The largest inner product that each node's box allows, queries x nodes."""
        return np.maximum(queries, 0) @ self.hi.T + np.minimum(queries, 0) @ self.lo.T

    def search(self, own, query, bounds, k, floor):
        """The k best (score, id, row) but for row ``own``, ties to smaller ids, among those that reach ``floor``."""
        scores, ids, rows, kth = np.empty(0), np.empty(0, np.int64), np.empty(0, np.int64), floor
        heap = [(-bounds[0], 0)]
        while heap and -heap[0][0] >= kth:
            _, node = heapq.heappop(heap)
            if self.children[node]:
                for child in self.children[node]:
                    if bounds[child] >= kth:
                        heapq.heappush(heap, (-bounds[child], child))
                continue
            start, end = self.span[node]
            found = self.points[start:end] @ query
            fit = (found >= kth) & (self.rows[start:end] != own)
            if fit.any():
                scores = np.concatenate([scores, found[fit]])
                ids = np.concatenate([ids, self.ids[start:end][fit]])
                rows = np.concatenate([rows, self.rows[start:end][fit]])
                best = np.lexsort((ids, -scores))[:k]
                scores, ids, rows = scores[best], ids[best], rows[best]
                if len(ids) == k:
                    kth = max(kth, scores[-1])
        return scores, ids, rows


def _search_batches(k):
    """Of each shard the vectors come first and make a tree; then its queries stream by."""
    def flush(shard_rows):
        return KdTree(*(np.concatenate(c) for c in zip(*shard_rows)))

    def answer(tree, own, queries, floors):
        largest = float(np.abs(queries).max(initial=0)) * float(max(np.abs(tree.lo).max(), np.abs(tree.hi).max()))
        if largest * queries.shape[1] >= 2**53:  # beyond exact doubles
            tree = KdTree(tree.ids, tree.rows, np.array([[int(v) for v in p] for p in tree.points], object))
            queries = np.array([[int(v) for v in q] for q in queries], object)
        bounds = tree.bounds(queries)
        for i in range(len(own)):
            scores, ids, rows = tree.search(own[i], queries[i], bounds[i], k, floors[i])
            if len(ids):
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(ids), own[i], np.int64)), pa.array(rows), pa.array(ids),
                    pa.array([int(s) for s in scores], pa.int64()),
                ], names=["query_row", "row", "vec_id", "score"])

    def run(batches):
        shard, rows, tree = None, [], None
        for batch in batches:
            keys = batch.column("shard").to_numpy() * 2 + batch.column("asks").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(keys)) + 1), len(keys)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                part = batch.slice(a, b - a)
                ids, keys_ = part.column("vec_id").to_numpy(), part.column("row").to_numpy()
                values = part.column("vector").flatten().to_numpy().astype(np.float64).reshape(len(ids), -1)
                if shard != keys[a] // 2:
                    shard, rows, tree = keys[a] // 2, [], None
                if keys[a] % 2 == 0:
                    rows.append((ids, keys_, values))
                elif rows or tree:
                    tree = tree or flush(rows)
                    rows = []
                    floors = part.column("floor").to_numpy(zero_copy_only=False).astype(np.float64)
                    yield from answer(tree, keys_, values, np.nan_to_num(floors, nan=-np.inf))
    return run


def _search(vectors, questions, k):
    """Runs each question in the shard it names. ``questions``: shard, row, vec_id, vector, floor."""
    both = vectors.select("shard", F.lit(0).alias("asks"), "row", "vec_id", "vector", F.lit(None).cast("double").alias("floor"))
    both = both.union(questions.select("shard", F.lit(1), "row", "vec_id", "vector", "floor"))
    dealt = both.repartition("shard").sortWithinPartitions("shard", "asks")
    return dealt.mapInArrow(_search_batches(k), "query_row long, row long, vec_id long, score long")


def quantised(vectors):
    """``vec_id``, ``vector`` in 1/1024 steps and ``copies``, of the vectors whose components are all finite numbers.

    Rows that are equal in both come once, with their number.
    """
    def odd(x):
        return x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))

    fit = vectors.filter("embedding IS NOT NULL AND vec_id IS NOT NULL AND size(embedding) > 0")
    fit = fit.filter(~F.exists("embedding", odd))
    steps = F.transform("embedding", lambda x: F.floor(x.cast("double") * SCALE))
    return fit.select("vec_id", steps.alias("vector")).groupBy("vec_id", "vector").agg(F.count(F.lit(1)).alias("copies"))


def top_k(vectors, queries, k=10, shard_rows=SHARD_ROWS):
    """For each of ``queries``, the k best of ``vectors`` other than itself; both have row, vec_id, vector and copies.

    ``row`` is unique and names a vector in both tables; ids may come several
    times, with several vectors. ``copies`` rows that are equal count as so many.
    Returns query_row, query_id, rank from 1, vec_id, score; ties go to the
    smaller vec_id. Only vectors of the query's own number of components are
    compared; empty tables give no rows. A shard is dealt by row and so holds
    about ``shard_rows`` rows; it and a batch of queries are all that a task keeps.
    """
    vectors = vectors.withColumn("dim", F.size("vector"))
    shards = vectors.groupBy("dim").agg(F.ceil(F.count(F.lit(1)) / F.lit(shard_rows)).cast("int").alias("n"))
    # A shard's number holds its dimension, so vectors of different length never meet.
    span = F.lit(1 << 31)
    placed = vectors.join(shards, "dim")
    placed = settle(placed.withColumn("shard", F.col("dim") * span + F.pmod(F.xxhash64("row"), "n")), "vectors")
    asked = queries.withColumn("dim", F.size("vector")).join(shards, "dim")
    asked = asked.withColumn("home", F.pmod(F.xxhash64(F.lit(1), "row"), "n"))
    home = asked.select(
        (F.col("dim") * span + F.col("home")).alias("shard"), "row", "vec_id", "vector", F.lit(None).cast("double").alias("floor"))
    first = settle(_search(placed, home, k), "home-results")
    kth = first.groupBy("query_row").agg(
        F.when(F.count(F.lit(1)) >= k, F.min("score")).cast("double").alias("floor"))
    others = asked.join(kth, asked.row == kth.query_row, "left").select(
        "dim", "home", "row", "vec_id", "vector", "floor", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("other")
    ).filter("other <> home")
    others = others.select((F.col("dim") * span + F.col("other")).alias("shard"), "row", "vec_id", "vector", "floor")
    found = first.union(_search(placed, others, k))
    # Copies share their row's score; those of a query's own row are other rows than it.
    found = found.join(placed.filter("copies > 1").select("row", "copies"), "row", "left")
    square = F.aggregate("vector", F.lit(0).cast("long"), lambda s, x: s + x * x)
    own = asked.filter("copies > 1").select(
        "row", F.col("row").alias("query_row"), "vec_id", square.alias("score"), (F.col("copies") - 1).alias("copies"))
    found = found.select(*own.columns).union(own)
    times = F.least(F.coalesce("copies", F.lit(1).cast("long")), F.lit(k).cast("long"))
    each = found.select("query_row", "vec_id", "score", F.explode(F.sequence(F.lit(1).cast("long"), times)))
    best = F.row_number().over(W.partitionBy("query_row").orderBy(F.desc("score"), "vec_id"))
    top = each.withColumn("rank", best).filter(F.col("rank") <= k)
    named = queries.select(F.col("row").alias("query_row"), F.col("vec_id").alias("query_id"), F.col("copies").alias("_times"))
    # Equal query rows have equal answers, each its own.
    answers = top.join(named, "query_row").withColumn("_turn", F.explode(F.sequence(F.lit(1).cast("long"), "_times")))
    return answers.select("query_row", "query_id", "rank", "vec_id", "score")


def op8_kd_search(spark, sf_dir):
    """The ten best other rows of every row whose id is a multiple of a hundred."""
    vectors = settle(quantised(table(spark, sf_dir, "embeddings")).withColumn("row", F.monotonically_increasing_id()), "quantised")
    return top_k(vectors, vectors.filter("vec_id % 100 = 0")).drop("query_row")


SQL = {"op8_kd_search": """
WITH fit AS (SELECT row_number() OVER () AS r, vec_id, embedding AS e FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
  AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
steps AS MATERIALIZED (SELECT r, vec_id, list_transform(e, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS DOUBLE)) AS v FROM fit),
scored AS (SELECT q.r, q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM steps q JOIN steps c ON q.r <> c.r AND len(q.v) = len(c.v) WHERE q.vec_id % 100 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM
  (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS rank FROM scored) x WHERE rank <= 10"""}
