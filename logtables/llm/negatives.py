"""Hard negatives by exact integer scores: matrix products in a residue number system.

Components are reduced modulo several small primes to balanced residues. For each prime one float32 product of an
anchor block with a shard of rows is exact, as all its sums stay under 2^24; wide vectors are multiplied in pieces of
so many components as that allows. The signed score is put together from the residues by the Chinese remainder
theorem, with as many primes as the largest possible score of the two blocks needs.

Rows are dealt over shards of a bounded size, anchors over blocks, and each block meets each shard once for the positives and once for the
negatives. Only the first few of a shard leave it: for the positives those of the anchor's label, for the negatives those within the window of
scores that a positive opens. Window functions choose among the shards.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logtables.llm.common import stored

SHARD = 16_384
BLOCK = 4_096
#: Anchors whose scores are held at a time.
ROWS = 64
#: Sums of float32 products are exact below this.
EXACT = 1 << 24
#: Components that are multiplied at once, at most; with it, primes up to 2 * sqrt(EXACT / PIECE) serve.
PIECE = 64


def primes_for(most: int, piece: int = PIECE) -> list[int]:
    """The largest primes p with piece * (p // 2)^2 < 2^24, as many as make a product above 2 * most."""
    found, product, p = [], 1, 2 * int((EXACT / piece) ** 0.5) + 1
    while product <= 2 * most:
        if p < 3:
            raise OverflowError("scores are too large")
        if piece * (p // 2) ** 2 < EXACT and all(p % q for q in range(2, int(p ** 0.5) + 1)):
            found.append(p)
            product *= p
        p -= 1
    return found


def balanced(values: np.ndarray, p: int) -> np.ndarray:
    """Residues from -(p // 2) to p // 2 as float32."""
    rest = values % p
    return np.where(rest > p // 2, rest - p, rest).astype("f4")


class ResidueMatrix:
    """Rows of integers as residues modulo several primes."""

    def __init__(self, vectors: np.ndarray, primes: list[int]):
        self.primes, self.parts = primes, [balanced(vectors, p) for p in primes]

    def scores(self, other: ResidueMatrix, rows: slice) -> np.ndarray:
        """Exact inner products of some rows with all rows of the other, signed."""
        digits: list[np.ndarray] = []
        for k, p in enumerate(self.primes):
            a, b = self.parts[k][rows], other.parts[k]
            rest = np.zeros((a.shape[0], b.shape[0]), "i8")
            for i in range(0, a.shape[1], PIECE):
                rest += (a[:, i: i + PIECE] @ b[:, i: i + PIECE].T).astype("i4")
            rest %= p
            # mixed radix: the score is d0 + d1 p0 + d2 p0 p1 + ... modulo the product
            scale = 1
            for digit, q in zip(digits, self.primes):
                rest = (rest - digit * scale) % p
                scale = scale * q % p
            digits.append(rest * pow(scale, -1, p) % p)
        product, total = 1, np.zeros_like(digits[0])
        for digit, p in zip(digits, self.primes):
            total += digit * product
            product *= p
        return np.where(total > product // 2, total - product, total)


def wide(vectors: pa.ChunkedArray, width: int) -> np.ndarray:
    """Vectors as rows of a matrix; components that are missing are 0."""
    column = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    flat = column.flatten().to_numpy(zero_copy_only=False).astype("i8")
    sizes = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(sizes), width), "i8")
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def blocks(anchors: pa.Table, rows: pa.Table) -> Iterator[tuple[int, np.ndarray]]:
    """(number of the anchor, its scores with all rows)."""
    sizes = [int(t.column("size").to_numpy().max()) for t in (anchors, rows)]
    a, b = (wide(t.column("v"), max(sizes)) for t in (anchors, rows))
    most = sum(int(x) * int(y) for x, y in zip(np.abs(a).max(axis=0), np.abs(b).max(axis=0)))
    if most >= 1 << 51:
        for i, row in enumerate(a.tolist()):  # components of any size; scores beyond 64 bits stop the job
            yield i, np.array([sum(x * y for x, y in zip(row, other)) for other in b.tolist()], "i8")
        return
    primes = primes_for(most)
    left, right = ResidueMatrix(a, primes), ResidueMatrix(b, primes)
    for i in range(0, len(a), ROWS):
        for k, scores in enumerate(left.scores(right, slice(i, i + ROWS))):
            yield i + k, scores


def first_of(at: np.ndarray, scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Of some rows the first k, by falling score, then by id."""
    if len(at) > 8 * k:
        least = np.partition(scores[at], len(at) - k)[len(at) - k]
        at = at[scores[at] >= least]
    return at[np.lexsort((ids[at], -scores[at]))[:k]]


def columns(table: pa.Table, *names: str) -> list[np.ndarray]:
    return [table.column(n).to_numpy() for n in names]


def best_of_label(k: int):
    def search(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        out: list[list] = [[], [], [], []]
        if anchors.num_rows and rows.num_rows:
            ids, labels = columns(rows, "vec_id", "label")
            for i, scores in blocks(anchors, rows):
                anchor, label = anchors.column("vec_id")[i].as_py(), anchors.column("label")[i].as_py()
                best = first_of(np.flatnonzero((labels == label) & (ids != anchor)), scores, ids, k)
                out[0] += [anchors.column("anchor")[i].as_py()] * len(best)
                out[1] += [anchor] * len(best)
                out[2] += ids[best].tolist()
                out[3] += scores[best].tolist()
        return pa.table([pa.array(x, pa.int64()) for x in out], ["anchor", "anchor_id", "id", "score"])

    return search


def within_window(k: int, low: int, high: int):
    def search(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        out: list[list] = [[], [], [], [], []]
        if anchors.num_rows and rows.num_rows:
            ids, labels = columns(rows, "vec_id", "label")
            for i, scores in blocks(anchors, rows):
                anchor, label = anchors.column("anchor")[i].as_py(), anchors.column("label")[i].as_py()
                others = np.flatnonzero(labels != label)
                for positive in dict.fromkeys(anchors.column("positives")[i].as_py()):
                    # low * positive <= 100 * score <= high * positive, in whole numbers
                    least, most = -(-low * positive // 100), high * positive // 100
                    if least > most:
                        continue
                    part = scores[others]
                    best = first_of(others[(part >= least) & (part <= most)], scores, ids, k)
                    out[0] += [anchor] * len(best)
                    out[1] += [positive] * len(best)
                    out[2] += ids[best].tolist()
                    out[3] += scores[best].tolist()
        return pa.table([pa.array(x, pa.int64()) for x in out[:4]], ["anchor", "positive_score", "id", "score"])

    return search


def met(anchors: DataFrame, rows: DataFrame, shards: int, block: int, search, schema: str) -> DataFrame:
    """What ``search`` makes of each block of anchors with each shard of rows."""
    groups = max(1, -(-anchors.count() // block))
    size = F.size("v").alias("size")
    shard = F.pmod("number", F.lit(shards)).cast("int").alias("shard")
    left = anchors.select("*", size, F.pmod("anchor", F.lit(groups)).cast("int").alias("group"))
    left = left.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    right = rows.select("vec_id", "label", "v", size, shard, F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group"))
    return left.groupBy("shard", "group").cogroup(right.groupBy("shard", "group")).applyInArrow(search, schema)


def hard_negatives(vectors: DataFrame, anchors: DataFrame, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90, vec_id: str = "vec_id",
                   embedding: str = "embedding", label: str = "label", scale: float = 256.0, shard: int = SHARD, block: int = BLOCK) -> DataFrame:
    """anchor_id, positive_id, rank (from 1), negative_id, positive_score, negative_score.

    Scores are integer inner products with the anchor, of components as floor(scale * x); higher ones come first, ties by smaller id. An anchor's
    positives are its first rows of the same label, its negatives for each of them the first rows of other labels with
    low * positive_score <= 100 * negative_score <= high * positive_score; fewer are returned where there are fewer, and an
    anchor without positives or negatives has no rows.

    Rows of either table with a null id, label or vector, or with a null or non-finite component, take no part. A missing component
    counts as 0. Ids are meant to be unique: rows with the anchor's own id are never its positives; of other repeated ids
    every row counts, and different anchors with one id are ranked each by themselves. Labels can be of any type that can be compared. Scores beyond 64
    bits stop the job.
    """
    def ready(table: DataFrame) -> DataFrame:
        # labels as numbers, by digest
        named = table.select(F.col(vec_id).alias("vec_id"), F.col(embedding).alias("v"), F.xxhash64(F.col(label).cast("string")).alias("label"), F.col(label).isNotNull().alias("known"))
        bad = F.exists("v", lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
        kept = named.where(F.col("known") & F.col("vec_id").isNotNull() & F.col("v").isNotNull() & ~bad)
        floors = F.transform("v", lambda x: F.floor(x.cast("double") * F.lit(scale).cast("double")).cast("bigint"))
        return kept.select(F.col("vec_id").cast("bigint").alias("vec_id"), "label", floors.alias("v"))

    rows = stored(ready(vectors), "rows").withColumn("number", F.monotonically_increasing_id())
    asked = ready(anchors).distinct().select(F.xxhash64("vec_id", "label", "v").alias("anchor"), "vec_id", "label", "v")
    asked = stored(asked, "anchors")
    shards = max(1, -(-rows.count() // shard))
    schema = "anchor bigint, anchor_id bigint, id bigint, score bigint"
    near = met(asked, rows, shards, block, best_of_label(positives), schema)
    order = Window.partitionBy("anchor").orderBy(F.desc("score"), "id")
    chosen = near.withColumn("place", F.row_number().over(order)).where(F.col("place") <= positives)
    chosen = stored(chosen.select("anchor", "anchor_id", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"), "place"), "positives")
    wanted = chosen.groupBy("anchor").agg(F.collect_set("positive_score").alias("positives"))
    opened = stored(asked.join(wanted, "anchor"), "windows")
    schema = "anchor bigint, positive_score bigint, id bigint, score bigint"
    found = met(opened, rows, shards, block, within_window(negatives, low, high), schema)
    order = Window.partitionBy("anchor", "positive_score").orderBy(F.desc("score"), "id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    joined = chosen.join(ranked, ["anchor", "positive_score"])
    return joined.select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
