"""Vector codes by product quantisation in whole numbers, with norm-of-sum bounds.

Vectors are cut into equal parts; each part position has a codebook, which some rounds of assignment and averaging
improve. The driver keeps the codebooks of all rounds, a model of a fixed size, and sends them to the tasks. Each vector carries its assigned entries and,
for every group of 16 entries, a lower bound of its distance to those of them that it isn't assigned to, with the round in which the
bound was measured. In a later round the bound is lowered by the largest true displacement of an entry of the group since that
round: the norm of the summed movements, never more than the sum of their norms. Only groups whose bound doesn't exceed the exact distance to
the own entry are scanned again, exactly, and get a new bound and stamp.

A round is one narrow pass: tasks write the vectors' new state and add up the parts of each entry, so that a few sums per task are
all that is shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logtables.llm.common import stored

#: Entries that share a bound.
GROUP = 16
#: Squared distances below this are exact as doubles.
EXACT = 1 << 53
#: Vectors that are worked on at a time.
ROWS = 4_096


def squares(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows to entries; Python's integers where doubles don't suffice."""
    if x.dtype == object:
        return ((x[:, None, :] - entries[None, :, :]) ** 2).sum(axis=2)
    return (x * x).sum(axis=1)[:, None] + (entries * entries).sum(axis=1)[None, :] - 2 * (x @ entries.T)


def own_squares(x: np.ndarray, entries: np.ndarray, codes: np.ndarray) -> np.ndarray:
    return ((x - entries[codes]) ** 2).sum(axis=1)


def below(values: np.ndarray) -> np.ndarray:
    """Square roots as float32 that aren't above the true ones."""
    roots = np.sqrt(values.astype("f8"))
    return np.nextafter((roots * (1 - 1e-12)).astype("f4"), np.float32(-np.inf))


def displacements(history: list[np.ndarray], part: int) -> np.ndarray:
    """For each round and group of entries the largest distance between an entry then and now; never below the true one."""
    groups = -(-history[-1].shape[1] // GROUP)
    out = np.zeros((len(history), groups))
    for then, books in enumerate(history):
        moved = np.sqrt(((history[-1][part] - books[part]) ** 2).sum(axis=1).astype("f8")) * (1 + 1e-12)
        out[then] = [moved[g * GROUP: g * GROUP + GROUP].max() for g in range(groups)]
    return out


def assign(x: np.ndarray, history: list[np.ndarray], part: int, codes: np.ndarray | None, bounds: np.ndarray | None, stamps: np.ndarray | None):
    """(codes, bounds, stamps, squared distances, groups scanned) by the latest of the codebooks; ties go to the lower entry.

    Without codes from an earlier round, all groups are scanned.
    """
    now, entries = len(history) - 1, history[-1][part]
    n, groups = len(x), -(-len(entries) // GROUP)
    rows = np.arange(n)
    distances = np.full((n, groups * GROUP), np.inf, object if x.dtype == object else "f8")
    if codes is None:
        scanned = np.ones((n, groups), bool)
        lowered = np.zeros((n, groups))
    else:
        own = own_squares(x, entries, codes)
        lowered = bounds - displacements(history, part)[stamps, np.arange(groups)[None, :]]
        scanned = lowered <= (np.sqrt(own.astype("f8")) * (1 + 1e-12))[:, None]
    for g in range(groups):
        at = np.flatnonzero(scanned[:, g])
        if len(at):
            found = squares(x[at], entries[g * GROUP: g * GROUP + GROUP])
            distances[at[:, None], np.arange(g * GROUP, g * GROUP + found.shape[1])[None, :]] = found
    if codes is not None:
        distances[rows, codes] = own
    best = np.argmin(distances, axis=1)
    error = distances[rows, best].copy()
    distances[rows, best] = np.inf
    nearest = below(distances.reshape(n, groups, GROUP).min(axis=2))
    if codes is None:
        return best.astype("u1"), nearest, np.full((n, groups), now, "u1"), error, scanned
    bounds, stamps = bounds.copy(), stamps.copy()
    bounds[scanned], stamps[scanned] = nearest[scanned], now
    # an entry that was left counts among the others of its group again
    left = np.flatnonzero((best != codes) & ~scanned[rows, codes // GROUP])
    group = codes[left] // GROUP
    bounds[left, group] = np.minimum(np.nextafter(lowered[left, group].astype("f4"), np.float32(-np.inf)), below(own[left]))
    stamps[left, group] = now
    return best.astype("u1"), bounds, stamps, error, scanned


class Sums:
    """Counts and sums of the vectors' parts of each entry."""

    def __init__(self, parts: int, entries: int, width: int):
        self.counts = np.zeros((parts, entries), "i8")
        self.sums = np.zeros((parts, entries, width), object)

    def add(self, part: int, codes: np.ndarray, x: np.ndarray) -> None:
        order = np.argsort(codes, kind="stable")
        used, first = np.unique(codes[order], return_index=True)
        self.counts[part, used] += np.diff(np.append(first, len(codes)))
        rows = x[order] if x.dtype == object else x[order].astype("i8")
        self.sums[part, used] += np.add.reduceat(rows, first, axis=0).astype(object)


def quantise(vectors: DataFrame, parts: int = 4, entries: int = 256, rounds: int = 4, vec_id: str = "vec_id", embedding: str = "embedding",
             label: str = "label", scale: float = 1024.0) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256, label: a row per vector that takes part.

    Components are floor(scale * x). The codebooks begin with the parts of the ``entries`` (256 at most) vectors of smallest id; fewer vectors
    make smaller codebooks. After each of the rounds of exact assignment an entry becomes the floor of the mean of its parts, if it has any.
    ``code`` has two hex digits per part, ``error`` is the sum of the squared distances, ``label_error`` its sum over the rows of an equal label, nulls together.

    Vectors that are null or hold a null or non-finite component take no part. Shorter vectors count as if zeros followed, to a multiple of ``parts``.
    Null ids come after all others; rows with one id are rows like any other, in the order of their vectors. Components beyond 62 bits end at that size; an error
    beyond 64 bits stops the job. Without vectors there are no rows.
    """
    if not 1 <= entries <= 256:
        raise ValueError("an entry's index must fit one byte")
    spark = vectors.sparkSession
    named = vectors.select(F.col(vec_id).alias("vec_id"), F.col(label).alias("label"), F.col(embedding).alias("v"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    most = float(1 << 62)
    floors = F.transform("v", lambda x: F.floor(F.least(F.greatest(x.cast("double") * F.lit(scale).cast("double"), F.lit(-most)), F.lit(most))).cast("bigint"))
    rows = stored(named.where(F.col("v").isNotNull() & ~bad).select("vec_id", "label", floors.alias("v")), "vectors")
    longest, low, high = rows.agg(F.max(F.size("v")), F.min(F.array_min("v")), F.max(F.array_max("v"))).first()
    width = -(-(longest or 1) // parts)
    largest = max(-(low or 0), high or 0) + 1
    kind = object if 4 * width * largest * largest >= EXACT else "f8"
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).select("v").collect()
    books = np.zeros((len(first), parts * width), object)
    for row, found in zip(books, first):
        row[: len(found.v)] = found.v
    history = [books.reshape(len(first), parts, width).transpose(1, 0, 2)]
    groups = -(-len(first) // GROUP)
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    state = "codes binary, bounds binary, stamps binary"
    sums = "part int, entry int, n bigint, sums array<decimal(38,0)>"

    def matrix(column: pa.Array) -> np.ndarray:
        flat, offsets = column.flatten().to_numpy(zero_copy_only=False).astype("i8"), column.offsets.to_numpy()
        sizes = np.diff(offsets)
        out = np.zeros((len(sizes), parts * width), "i8")
        at = np.repeat(np.arange(len(sizes)), sizes)
        out[at, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
        return out.reshape(-1, parts, width).astype(kind)

    def packed(values: np.ndarray) -> pa.Array:
        return pa.array([row.tobytes() for row in values], pa.binary())

    def passed(last: bool, known):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            books = [b.astype(kind) for b in known.value]
            total = Sums(parts, len(first), width)
            types = None
            for whole in batches:
                types = types or whole.schema
                for start in range(0, whole.num_rows, ROWS):
                    batch = whole.slice(start, ROWS)
                    v = matrix(batch.column(2))
                    n = len(v)
                    old: list = [None] * 3
                    if len(books) > 1:
                        raw = [np.frombuffer(b"".join(batch.column(i).to_pylist()), t) for i, t in ((3, "u1"), (4, "f4"), (5, "u1"))]
                        old = [raw[0].reshape(n, parts), raw[1].reshape(n, parts, groups), raw[2].reshape(n, parts, groups)]
                    new, error = ([], [], []), np.zeros(n, object)
                    for part in range(parts):
                        x = v[:, part]
                        *found, squared, _ = assign(x, books, part, *(None if o is None else o[:, part] for o in old))
                        for values, value in zip(new, found):
                            values.append(value)
                        error += squared if kind is object else squared.astype("i8").astype(object)
                        if not last:
                            total.add(part, found[0], x)
                    codes = np.stack(new[0], axis=1)
                    if last:
                        arrays = [batch.column(0), batch.column(1), pa.array([r.tobytes().hex() for r in codes]), pa.array(error.tolist(), pa.int64())]
                        yield pa.RecordBatch.from_arrays(arrays, ["vec_id", "label", "code", "error"])
                        continue
                    arrays = [batch.column(i) for i in range(3)] + [packed(codes), packed(np.stack(new[1], axis=1)), packed(np.stack(new[2], axis=1))]
                    nothing = [pa.nulls(n, t) for t in (pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.decimal128(38, 0)))]
                    yield pa.RecordBatch.from_arrays(arrays + nothing, ["vec_id", "label", "v", "codes", "bounds", "stamps", "part", "entry", "n", "sums"])
            if not last and total.counts.any():
                part, entry = np.nonzero(total.counts)
                lists = [[Decimal(int(x)) for x in total.sums[p, e]] for p, e in zip(part, entry)]
                arrays = [pa.nulls(len(part), types.field(i).type) for i in range(3)] + [pa.nulls(len(part), pa.binary())] * 3
                arrays += [pa.array(part.astype("i4")), pa.array(entry.astype("i4")), pa.array(total.counts[part, entry]), pa.array(lists, pa.list_(pa.decimal128(38, 0)))]
                yield pa.RecordBatch.from_arrays(arrays, ["vec_id", "label", "v", "codes", "bounds", "stamps", "part", "entry", "n", "sums"])

        return run

    columns = f"vec_id {kinds['vec_id']}, label {kinds['label']}"
    for _ in range(rounds):
        written = stored(rows.mapInArrow(passed(False, spark.sparkContext.broadcast(history)), f"{columns}, v array<bigint>, {state}, {sums}"), "codes")
        added = written.where("part is not null").groupBy("part", "entry")
        latest = history[-1].copy()
        for r in added.agg(F.sum("n").alias("n"), F.array(*(F.sum(F.col("sums")[i]) for i in range(width))).alias("sums")).collect():
            latest[r.part, r.entry] = [int(x) // r.n for x in r.sums]
        history.append(latest)
        rows = written.where("part is null").drop("part", "entry", "n", "sums")
    coded = rows.mapInArrow(passed(True, spark.sparkContext.broadcast(history)), f"{columns}, code string, error bigint")
    coded = stored(coded, "coded")
    digest = hashlib.sha256(",".join(str(x) for x in history[-1].ravel().tolist()).encode()).hexdigest()
    of_label = coded.groupBy(F.col("label").alias("same")).agg(F.sum("error").alias("label_error"))
    joined = coded.join(of_label, F.col("label").eqNullSafe(F.col("same")))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"), "label")
