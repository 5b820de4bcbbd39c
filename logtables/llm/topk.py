"""Exact top-k inner products with an impact-ordered index, score at a time.

Vectors are dealt over shards. A shard keeps, per dimension, its postings (vector, value) sorted by quantised impact,
the position of the value's highest bit, so that a segment holds the postings of one dimension and impact. For a
block of queries the segments are processed by descending impact, all dimensions of one impact before the next, and
add to one accumulator per query and vector. What is still to come for a query is at most the largest impact left
times the sum of its absolute components, and at most what Cauchy and Schwarz allow for the postings left; so after
each impact every vector has a lower and an upper bound. A vector whose upper bound is under the k-th largest lower
bound is out for certain; processing stops once the possible members are few enough, and those are scored exactly.
There is no other reason to stop: at the end of all segments the accumulators are exact themselves.

Queries are a stated set and come in blocks; every block meets every shard, and k rows of each leave a shard.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logtables.llm.common import stored

BLOCK = 128
SHARD = 4096
#: Possible members, as a share of the shard, that end the processing of segments.
FEW = 0.02
#: Sums of products below this are exact as doubles; larger ones are made with Python's integers.
EXACT = 1 << 53


def quantised(vectors: DataFrame, vec_id: str, embedding: str, scale: float = 256.0) -> DataFrame:
    """(vec_id, v): components as floor(scale * x), x as double; vectors with a null or non-finite part are left out."""
    bad = F.exists(embedding, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    v = F.transform(embedding, lambda x: F.floor(x.cast("double") * F.lit(scale).cast("double")).cast("bigint"))
    kept = vectors.where(F.col(embedding).isNotNull() & F.col(vec_id).isNotNull() & ~bad)
    return kept.select(F.col(vec_id).cast("bigint").alias("vec_id"), v.alias("v"))


def matrix(lists: list[np.ndarray], width: int) -> np.ndarray:
    """Rows of integers; missing components are 0."""
    out = np.zeros((len(lists), width), "i8")
    for row, values in zip(out, lists):
        row[: min(width, len(values))] = values[:width]
    return out


class ImpactIndex:
    """Posting segments of one shard.

    A segment has the postings of one impact as rows of a matrix: the vectors that have such a posting, with zeros for
    their other components. So a segment meets a block of queries in one matrix product. Sums are whole numbers below
    2^53 and thus exact as doubles.
    """

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors = ids, vectors.astype("f8")
        size = np.abs(self.vectors)
        level = np.frexp(size)[1]  # 0 for zeros, which have no posting
        self.segments: list[tuple[int, np.ndarray, np.ndarray]] = []
        self.left: list[np.ndarray] = []  # lengths of what is left of each vector after a segment
        for impact in np.unique(level[level > 0])[::-1].tolist():
            at = np.flatnonzero((level == impact).any(axis=1))
            self.segments.append((impact, at, np.where(level[at] == impact, self.vectors[at], 0)))
            self.left.append(np.sqrt(np.where(level < impact, size * size, 0).sum(axis=1)))

    def top(self, query_ids: np.ndarray, queries: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each query its k best of the shard, without itself: (query's number, ids, scores)."""
        n, few = len(self.ids), max(4 * k, int(FEW * len(self.ids)))
        queries = queries.astype("f8")
        waiting = np.arange(len(queries))
        sums = np.zeros((len(queries), n))
        own = np.nonzero(query_ids[:, None] == self.ids[None, :])
        sums[own] = -np.inf  # and so it stays
        for step, (impact, at, postings) in enumerate(self.segments):
            part = queries[waiting]
            if len(at) == n:
                sums += part @ postings.T
            else:
                sums[:, at] += part @ postings.T
            last = step == len(self.segments) - 1
            most = 0.0 if last else float((1 << (impact - 1)) - 1)
            bound = most * np.abs(part).sum(axis=1)
            norm = np.sqrt((part * part).sum(axis=1)) * (1 + 1e-9)
            left = self.left[step]
            # nothing can be proven while what is to come outweighs the best sums; saves the bounds, skips no segment
            if not last and np.minimum(bound, norm * np.median(left)).mean() > sums.max(axis=1).mean():
                continue
            rest = np.minimum(norm[:, None] * left[None, :], bound[:, None])
            least = np.full(len(waiting), -np.inf)
            if n > k:
                least = np.partition(sums - rest, n - k, axis=1)[:, n - k]
            possible = (sums + rest >= least[:, None]) & (sums > -np.inf)
            done = (possible.sum(axis=1) <= few) | last
            for row in np.flatnonzero(done):
                at = np.flatnonzero(possible[row])
                exact = (self.vectors[at] @ part[row]).astype("i8")
                yield self.best(int(waiting[row]), at, exact, k)
            waiting, sums = waiting[~done], sums[~done]
            if not len(waiting):
                return
        for row in range(len(waiting)):  # no postings at all: every score is 0
            at = np.flatnonzero(sums[row] > -np.inf)
            yield self.best(int(waiting[row]), at, np.zeros(len(at), "i8"), k)

    def best(self, query: int, at: np.ndarray, exact: np.ndarray, k: int):
        order = np.lexsort((self.ids[at], -exact))[:k]
        return query, self.ids[at][order], exact[order]


def exact_best(ids: np.ndarray, vectors: list, query_id: int, query: list[int], k: int) -> list[tuple[int, int]]:
    """The same with Python's integers, for components of any size."""
    scored = ((-sum(a * b for a, b in zip(query, v)), i) for i, v in zip(ids, vectors) if i != query_id)
    return [(i, -s) for s, i in sorted(scored)[:k]]


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, vec_id: str = "vec_id", embedding: str = "embedding",
          scale: float = 256.0, shard: int = SHARD, block: int = BLOCK) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k largest integer inner products, ties to the smaller vec_id.

    All rows of ``vectors`` but the query's own id are candidates; if there are fewer than k, all are returned.
    Vectors or queries that are null, have a null id, or hold a null or non-finite component take no part. A missing
    component counts as 0. Ids are meant to be unique; of repeated ids every row is a candidate. Scores beyond 64 bits
    stop the job. Without vectors or queries there are no rows.
    """
    spark = vectors.sparkSession
    rows = quantised(vectors, vec_id, embedding, scale)
    asked = stored(quantised(queries, vec_id, embedding, scale), "queries")
    n, q = rows.count(), asked.count()
    shards, blocks = max(1, -(-n // shard)), max(1, -(-q // block))
    # both are dealt evenly, by hash of the id
    indexes = rows.select(F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(shards)).cast("int").alias("shard"), "vec_id", "v")
    shard_rows = indexes.groupBy("shard").agg(F.collect_list(F.struct("vec_id", "v")).alias("vectors"))
    blocked = asked.select(F.pmod(F.xxhash64("vec_id", F.lit(2)), F.lit(blocks)).cast("int").alias("block"), "vec_id", "v")
    block_rows = blocked.groupBy("block").agg(F.collect_list(F.struct("vec_id", "v")).alias("queries"))
    # groups of blocks, so that an index is built once for many queries
    group = 16
    jobs = shard_rows.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit((blocks - 1) // group))))
    block_rows = block_rows.withColumn("group", (F.col("block") / group).cast("int"))
    block_rows = block_rows.groupBy("group").agg(F.collect_list("queries").alias("queries"))
    jobs = jobs.repartition(max(1, shards * ((blocks - 1) // group + 1)), "shard", "group") if shards > 1 else jobs
    joined = jobs.join(block_rows, "group").select("vectors", "queries")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["query_id", "vec_id", "score"]
        for batch in batches:
            for row in range(batch.num_rows):
                ids, lists = unnested(batch.column(0).slice(row, 1))
                width, largest = max(map(len, lists)), largest_of(lists)
                index = None if largest * largest * width >= EXACT else ImpactIndex(ids, matrix(lists, width))
                out: tuple[list, list, list] = ([], [], [])
                groups = batch.column(1).slice(row, 1).flatten()
                for g in range(len(groups)):
                    query_ids, query_lists = unnested(groups.slice(g, 1))
                    if not index or largest_of(query_lists) * largest * width >= EXACT:
                        plain = [x.tolist() for x in lists]
                        for i, x in zip(query_ids.tolist(), query_lists):
                            found = exact_best(ids.tolist(), plain, i, x.tolist(), k)
                            out[0].extend([i] * len(found))
                            out[1].extend(j for j, _ in found)
                            out[2].extend(s for _, s in found)
                        continue
                    for query, best, scores in index.top(query_ids, matrix(query_lists, width), k):
                        out[0].extend([int(query_ids[query])] * len(best))
                        out[1].extend(best.tolist())
                        out[2].extend(scores.tolist())
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], names)

    found = joined.mapInArrow(search, "query_id bigint, vec_id bigint, score bigint")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def largest_of(lists: list[np.ndarray]) -> int:
    return max((max(int(x.max()), -int(x.min())) for x in lists if len(x)), default=0)


def unnested(column: pa.Array) -> tuple[np.ndarray, list[np.ndarray]]:
    """Ids and components of one list of (id, components)."""
    structs = column.flatten()
    values = structs.field("v")
    flat, offsets = values.flatten().to_numpy(zero_copy_only=False), values.offsets.to_numpy()
    base = offsets[0]
    return structs.field("vec_id").to_numpy(), [flat[a - base: b - base] for a, b in zip(offsets, offsets[1:])]
