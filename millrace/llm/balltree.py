"""Exact top-k inner-product search by ball-tree branch and bound.

Candidates are dealt into shards of bounded size; each shard builds a ball tree.  A query visits the
nodes of a tree in the order of their upper bound ``q . centre + |q| * radius`` and stops at the first
bound below its current kth score.  That score is shared between shards: a first round over one shard
per block gives every query a kth score, and the other shards start from it.

Queries come in blocks; each (block, shard) pair is one task's work, so neither side is ever whole
in one place.

Defined results: a vector takes part if it and its id are not null, it has components, and none is null
or non-finite; a vector meets only vectors of its own length; repeated ids are separate candidates, but
none of its own id meets a query, and a repeated query id is answered once (by its smallest vector);
ties go to the smaller vec_id; scores are exact whatever the components, as long as they fit 64 bits: a vector whose
squared length (after scaling) reaches 2**62 is refused, since a score could leave them; empty tables give no rows;
other columns are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import stored

SCALE = 256
EVERY = 50
K = 5
SHARD_ROWS = 16_384
BLOCK_QUERIES = 2_048
LEAF = 128
LONGEST = float(1 << 62)  # squared: the product of two lengths bounds a score


class BallTree:
    """A ball tree over integer vectors, split at the median of the widest component."""

    def __init__(self, vectors: np.ndarray, ids: np.ndarray, leaf: int = LEAF):
        order = np.argsort(ids, kind="stable")
        self.vectors, self.ids = vectors[order], ids[order]
        spans, children, stack = [], [], [(0, len(ids), -1)]
        place = np.arange(len(ids))
        points = self.vectors.astype(np.float64)
        centres, radii = [], []
        while stack:
            lo, hi, parent = stack.pop()
            here = len(spans)
            if parent >= 0:
                children[parent].append(here)
            spans.append((lo, hi))
            children.append([])
            own = points[place[lo:hi]]
            centre = own.mean(axis=0)
            centres.append(centre)
            radii.append(np.sqrt(((own - centre) ** 2).sum(axis=1).max()))
            if hi - lo > leaf and radii[-1] > 0:
                widest = int(np.argmax(own.max(axis=0) - own.min(axis=0)))
                middle = (hi - lo) // 2
                part = np.argpartition(own[:, widest], middle)
                place[lo:hi] = place[lo:hi][part]
                stack += [(lo + middle, hi, here), (lo, lo + middle, here)]
        self.spans, self.children, self.place = spans, children, place
        self.centres, self.radii = np.array(centres), np.array(radii)
        self.visited = 0

    def search(self, queries: np.ndarray, own_ids: np.ndarray, floors: np.ndarray, k: int):
        """Yields (query, id, score) of each query's best ``k`` that are no worse than its floor."""
        wide = queries.astype(np.float64)
        length = np.sqrt((wide**2).sum(axis=1))[:, None]
        bounds = wide @ self.centres.T + length * self.radii
        # Rounding must never lower a bound: it is relative to the products that were summed, not to what is left of them.
        bounds += 1e-9 * length * (np.sqrt((self.centres**2).sum(axis=1)) + self.radii) + 1e-6
        for q, (query, own, floor) in enumerate(zip(queries, own_ids, floors, strict=True)):
            bound = bounds[q]
            open_nodes, best = [(-bound[0], 0)], []
            while open_nodes:
                negative, node = heapq.heappop(open_nodes)
                if -negative < floor:
                    break
                if self.children[node]:
                    for child in self.children[node]:
                        if bound[child] >= floor:
                            heapq.heappush(open_nodes, (-bound[child], child))
                    continue
                self.visited += 1
                lo, hi = self.spans[node]
                rows = self.place[lo:hi]
                scores = self.vectors[rows] @ query
                good = np.flatnonzero((scores >= floor) & (self.ids[rows] != own))
                if len(good):
                    best += zip((-scores[good]).tolist(), self.ids[rows[good]].tolist(), strict=True)
                    best.sort()
                    del best[k:]
                    if len(best) == k:
                        floor = max(floor, -best[-1][0])
            for negative, found in best:
                yield q, found, -negative


def quantised(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, vector of integers) of the vectors that take part."""
    part = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("x"))
    part = part.where("vec_id is not null and size(x) > 0").where(
        F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    )
    whole = F.transform("x", lambda v: F.floor(v * F.lit(float(scale))).cast("long"))
    length = F.aggregate("x", F.lit(0.0), lambda sum_, v: sum_ + F.pow(F.floor(v * F.lit(float(scale))).cast("double"), 2.0))
    refused = F.raise_error(F.lit("a vector is so long that a score could leave 64 bits"))
    return part.select("vec_id", F.when(length >= LONGEST, refused).otherwise(whole).alias("vector"))


FOUND = "query_id long, vec_id long, score long"


def _matrix(table: pa.Table, column: str, size: int) -> np.ndarray:
    flat = table.column(column).combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(-1, size)


def _search(k: int):
    def run(candidates: pa.Table, queries: pa.Table) -> pa.Table:
        out: tuple[list, list, list] = ([], [], [])
        if candidates.num_rows and queries.num_rows:
            size = candidates.column("size")[0].as_py()
            tree = BallTree(_matrix(candidates, "vector", size), candidates.column("vec_id").to_numpy())
            ids = queries.column("vec_id").to_numpy()
            floors = queries.column("floor").to_numpy()
            for q, found, score in tree.search(_matrix(queries, "vector", size), ids, floors, k):
                out[0].append(int(ids[q]))
                out[1].append(found)
                out[2].append(score)
        return pa.table([pa.array(x, pa.int64()) for x in out], names=["query_id", "vec_id", "score"])

    return run


def _best(found: DataFrame, k: int) -> DataFrame:
    """Each query's best k, by group limit on both sides of the shuffle."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(
    vectors: DataFrame, every: int = EVERY, k: int = K, shard_rows: int = SHARD_ROWS, block_queries: int = BLOCK_QUERIES
) -> DataFrame:
    """query_id, rank, vec_id, score: the k best of all vectors for each vec_id divisible by ``every``."""
    whole = stored(quantised(vectors).withColumn("size", F.size("vector")), "quantised")
    rows = whole.count()
    shards = max(1, -(-rows // shard_rows))
    blocks = max(1, -(-rows // (every * block_queries)))
    least = F.min("vector").alias("vector")
    asked = stored(
        whole.where(F.col("vec_id") % every == 0).groupBy("vec_id", "size").agg(least), "query_vectors"
    ).withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int"))
    # A vector's shard depends on its values too, so that a repeated id does not fill one shard.
    dealt = whole.withColumn("shard", F.pmod(F.xxhash64("vector", "vec_id"), F.lit(shards)).cast("int"))

    def meet(candidates: DataFrame, queries: DataFrame) -> DataFrame:
        keys = ("size", "block", "shard")
        spread = candidates.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
        return (
            spread.groupBy(*keys)
            .cogroup(queries.groupBy(*keys))
            .applyInArrow(_search(k), FOUND)
        )

    lowest = F.lit(-(2**63)).cast("long")
    first = asked.withColumn("shard", F.lit(0)).withColumn("floor", lowest)
    pilot = stored(_best(meet(dealt.where("shard = 0"), first), k), "pilot")
    if shards == 1:
        return pilot.select("query_id", "rank", "vec_id", "score")
    floors = pilot.where(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), F.col("score").alias("floor"))
    others = F.sequence(F.lit(1), F.lit(shards - 1))
    rest = (
        asked.join(floors, "vec_id", "left")
        .withColumn("floor", F.coalesce("floor", lowest))
        .withColumn("shard", F.explode(others))
    )
    found = meet(dealt.where("shard > 0"), rest).unionByName(pilot.select("query_id", "vec_id", "score"))
    return _best(found, k).select("query_id", "rank", "vec_id", "score")


def op7_ball_tree(spark, sf_dir: str) -> DataFrame:
    return top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


OP7_SQL = """
with whole as (
  select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)) as v from embeddings
  where vec_id is not null and embedding is not null and len(embedding) > 0
    and list_bool_and(list_transform(embedding, lambda x: x is not null and isfinite(x)))
), scored as (
  select q.vec_id as query_id, c.vec_id, cast(list_inner_product(q.v, c.v) as bigint) as score
  from whole q join whole c on c.vec_id <> q.vec_id where q.vec_id % 50 = 0
)
select query_id, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank, vec_id, score
from scored qualify rank <= 5
"""
