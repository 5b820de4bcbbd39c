"""Removal of long repeated strings with a sparse suffix array over the UTF-8 bytes of all texts.

1. Different texts are kept once, in a table bucketed by their digest, so that later steps join them without a shuffle.
2. In each window of ``length - lead + 1`` places the suffix whose first eight bytes hash lowest is chosen. Two equal strings of
   ``length`` bytes choose a suffix at the same place within them, and both suffixes agree in ``lead`` bytes at least. So only
   chosen suffixes, about one in a hundred, have to be sorted.
3. Splitters from a sample range-partition the chosen suffixes by their leading tokens (words of eight bytes); ties are split by text
   and place, so one frequent passage spreads over many buckets. A bucket is sorted by multikey quicksort, and suffixes that agree with
   a neighbour in all leading tokens go on; a bucket's first and last one are compared across the boundaries.
4. Suffixes that go on stand for runs of starts. These are cut into blocks; a block has a digest of what all its starts share
   (others with the same may match) and one of its whole string (others with the same do match at every start). Only blocks that meet
   different strings are taken apart into single starts, whose strings are compared by digest. Digests have 128 bits.

Sums run before every shuffle, groups of any size are only counted, and no text goes through the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logtables.llm.common import stored
from logtables.workspace import new_folder

#: Bytes that are worked on at a time; longer texts are taken in sections.
SECTION = 1 << 19
#: Starts in a block, at most.
BLOCK = 32
#: Suffixes in a bucket, and samples for each.
BUCKET = 100_000
SAMPLES = 100
SAMPLED_TEXTS = 20_000
#: Up to this size a part of a bucket is sorted by whole keys.
SMALL = 4_096
_ODD = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xBF58476D1CE4E5B9)
SPANS = "array<struct<start:bigint,stop:bigint>>"


def lead_of(length: int) -> int:
    """Leading bytes by which suffixes are sorted: whole tokens, about two sevenths of the length."""
    if length < 16:
        raise ValueError("strings of fewer than 16 bytes are not supported")
    return 8 * max(1, length * 28 // 100 // 8)


def sections(texts: list[bytes], reach: int) -> Iterator[tuple[bytes, np.ndarray, np.ndarray, np.ndarray]]:
    """(bytes, numbers of texts, their places in the bytes, offsets in the texts): short texts together, long ones in sections.

    A section of a long text goes on for ``reach`` bytes beyond where the next begins.
    """
    parts, numbers, places, size = [], [], [], 0
    for i, text in enumerate(texts):
        if len(text) > SECTION:
            for base in range(0, len(text), SECTION):
                yield text[base: base + SECTION + reach], np.array([i]), np.array([0]), np.array([base])
            continue
        if size + len(text) > SECTION and parts:
            yield b"".join(parts), np.array(numbers), np.array(places), np.zeros(len(parts), "i8")
            parts, numbers, places, size = [], [], [], 0
        parts.append(text)
        numbers.append(i)
        places.append(size)
        size += len(text)
    if parts:
        yield b"".join(parts), np.array(numbers), np.array(places), np.zeros(len(parts), "i8")


def spread(firsts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """first, first + 1, ... for each first, as many as counted."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(firsts - ends + counts, counts)


def chosen(data: bytes, places: np.ndarray, stops: np.ndarray, length: int, window: int):
    """Chosen suffixes and the starts they stand for: (number of the text, place, first start, last start)."""
    n = len(data)
    counts = np.maximum(0, stops - places - length + 1)
    starts = spread(places, counts)
    if not len(starts):
        return (np.zeros(0, "i8"),) * 4
    value = np.ndarray(n, "<u8", data + bytes(8), 0, (1,)) * np.uint64(_ODD[0])
    value ^= value >> np.uint64(29)
    value *= np.uint64(_ODD[2])
    value &= np.uint64(0xFFFFFFFF00000000)
    value |= np.arange(n, dtype="u8")
    wide = 1
    while 2 * wide <= window:
        value = np.minimum(value[:-wide], value[wide:])
        wide *= 2
    if wide < window:
        value = np.minimum(value[: len(value) - window + wide], value[window - wide:])
    at = (value[starts] & np.uint64(0xFFFFFFFF)).astype("i8")
    of = np.repeat(np.arange(len(places)), counts)
    first = np.flatnonzero(np.diff(at, prepend=-1) | np.diff(of, prepend=-1))
    last = np.append(first[1:], len(at)) - 1
    return of[first], at[first], starts[first], starts[last]


def binary(rows: np.ndarray) -> pa.Array:
    """A row of bytes as a value."""
    rows = np.ascontiguousarray(rows)
    offsets = np.arange(len(rows) + 1, dtype="i4") * rows.shape[1]
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(rows)])


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Values of ``width`` bytes each as rows, without a copy."""
    if not len(column):
        return np.zeros((0, width), "u1")
    _, offsets, data = column.buffers()
    first = np.frombuffer(offsets, "i4")[column.offset]
    return np.frombuffer(data, "u1")[first: first + width * len(column)].reshape(-1, width)


def suffixes(texts: DataFrame, length: int, splitters: np.ndarray | None, share: float = 1.0) -> DataFrame:
    """bucket, lead, key, at, first, last: the chosen suffixes of all texts, or a share of them without splitters."""
    lead = lead_of(length)
    window = length - lead + 1
    cuts = None if splitters is None else splitters.tolist()

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds = None if cuts is None else np.array(cuts, f"S{lead + 24}")
        for batch in batches:
            keys = matrix(batch.column(0), 16)
            for data, numbers, places, bases in sections(batch.column(1).cast(pa.binary()).to_pylist(), length - 1):
                stops = np.append(places[1:], len(data))
                of, at, first, last = chosen(data, places, stops, length, window)
                if bounds is None:
                    taken = np.random.default_rng(len(data)).random(len(at)) < share
                    of, at, first, last = of[taken], at[taken], first[taken], last[taken]
                shift = (bases - places)[of]
                whole = np.empty((len(at), lead + 24), "u1")
                if len(at):
                    whole[:, :lead] = np.lib.stride_tricks.sliding_window_view(np.frombuffer(data, "u1"), lead)[at]
                whole[:, lead: lead + 16] = keys[numbers[of]]
                whole[:, lead + 16:] = (at + shift).astype(">u8").view("u1").reshape(-1, 8)
                bucket = np.zeros(len(at), "i4")
                if bounds is not None and len(bounds):
                    bucket = np.searchsorted(bounds, whole.view(f"S{lead + 24}").ravel(), side="right").astype("i4")
                for i in range(0, len(at), 50_000):
                    j = slice(i, i + 50_000)
                    arrays = [pa.array(bucket[j]), binary(whole[j, :lead]), binary(whole[j, lead: lead + 16])]
                    arrays += [pa.array((x + shift)[j]) for x in (at, first, last)]
                    yield pa.RecordBatch.from_arrays(arrays, ["bucket", "lead", "key", "at", "first", "last"])

    return texts.select("key", "text").mapInArrow(choose, "bucket int, lead binary, key binary, at bigint, first bigint, last bigint")


def multikey_quicksort(tokens: np.ndarray) -> np.ndarray:
    """The order of the rows, by first token, then second and so on: parts above a pivot token, below it, and equal to it, which go on with the next token."""
    order, width = np.arange(len(tokens)), tokens.shape[1]
    names = np.ascontiguousarray(tokens.astype(">u8")).view(f"S{8 * width}").ravel()
    parts = [(0, len(tokens), 0)]
    while parts:
        low, high, at = parts.pop()
        if high - low < 2 or at == width:
            continue
        part = order[low:high]
        if high - low <= SMALL:
            order[low:high] = part[np.argsort(names[part], kind="stable")]
            continue
        values = tokens[part, at]
        pivot = np.sort(values[:: max(1, len(values) // 31)])[len(values[:: max(1, len(values) // 31)]) // 2]
        below, above = values < pivot, values > pivot
        same = ~(below | above)
        order[low:high] = np.concatenate([part[below], part[same], part[above]])
        a, b = low + int(below.sum()), high - int(above.sum())
        parts += [(low, a, at), (a, b, at + 1), (b, high, at)]
    return order


def compared(buckets: DataFrame, lead: int) -> DataFrame:
    """key, first, last, met, border: suffixes that meet an equal one in their bucket, and the ends of each bucket with their leading bytes."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        # a bucket has a bounded size, by the splitters
        rows = pa.Table.from_batches(held).combine_chunks()
        leads = matrix(rows.column("lead").combine_chunks(), lead)
        tokens = np.ascontiguousarray(leads).view(">u8").astype("u8")
        del held
        order = multikey_quicksort(tokens)
        same = (tokens[order[1:]] == tokens[order[:-1]]).all(axis=1)
        met = np.append(same, False) | np.append(False, same)
        out = met.copy()
        out[[0, -1]] = True
        at = order[out]
        ends = np.zeros(len(order), bool)
        ends[[0, -1]] = True
        border = pa.array([x.tobytes() if e else None for x, e in zip(leads[at], ends[out])], pa.binary())
        taken = rows.take(pa.array(at)).combine_chunks()
        arrays = [taken.column(c).combine_chunks() for c in ("key", "at", "first", "last")] + [pa.array(met[out]), border]
        yield from pa.Table.from_arrays(arrays, ["key", "at", "first", "last", "met", "border"]).to_batches(50_000)

    return buckets.drop("bucket").mapInArrow(compare, "key binary, at bigint, first bigint, last bigint, met boolean, border binary")


def _powers(n: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For two odd bases, their powers and the powers of their inverses modulo 2^64."""
    out = []
    for base in _ODD[:2]:
        both = []
        for factor in (base, pow(base, -1, 1 << 64)):
            powers = np.full(n, factor, "u8")
            powers[0] = 1
            both.append(np.multiply.accumulate(powers))
        out.append(tuple(both))
    return out


class Strings:
    """Digests of 128 bits of the substrings of some bytes."""

    def __init__(self, data: bytes, powers: list[tuple[np.ndarray, np.ndarray]]):
        scrambled = (np.frombuffer(data, "u1").astype("u8") + np.uint64(1)) * np.uint64(_ODD[1])
        scrambled ^= scrambled >> np.uint64(31)
        scrambled *= np.uint64(_ODD[2])
        self.sums = []
        for power, inverse in powers:
            sums = np.zeros(len(data) + 1, "u8")
            np.add.accumulate(scrambled * power[: len(data)], out=sums[1:])
            self.sums.append((sums, inverse))

    def digests(self, first: np.ndarray, stop: np.ndarray) -> np.ndarray:
        out = np.empty((len(first), 2), "u8")
        for column, (sums, inverse) in enumerate(self.sums):
            value = (sums[stop] - sums[first]) * inverse[first] + (stop - first).astype("u8") * np.uint64(_ODD[2])
            value ^= value >> np.uint64(32)
            out[:, column] = value * np.uint64(_ODD[0])
        return out.view("u1").reshape(-1, 16)


def flat(column: pa.Array, names: list[str]) -> list[tuple[np.ndarray, ...]]:
    """For each row its list of structs as arrays, sorted by the first name."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    structs = column.flatten()
    values = [structs.field(n).to_numpy(zero_copy_only=False) for n in names]
    ends = np.cumsum([len(x) if x.is_valid else 0 for x in column])
    out, start = [], 0
    for end in ends.tolist():
        order = np.argsort(values[0][start:end], kind="stable")
        out.append(tuple(v[start:end][order] for v in values))
        start = end
    return out


def over_texts(texts: DataFrame, lists: DataFrame, names: list[str], length: int, make, schema: str) -> DataFrame:
    """Rows that ``make`` makes of the sections of texts and the places in them.

    make(strings, key rows, place rows, shift): ``names`` begin with "first"; places are given within the section, and shift is what leads back to
    the text.
    """
    reach = 2 * length
    joined = texts.join(lists, "key").select("key", "text", "places")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = _powers(2 * SECTION + reach + 1)
        for batch in batches:
            if not batch.num_rows:
                continue
            keys, places = matrix(batch.column(0), 16), flat(batch.column(2), names)
            for data, numbers, starts, bases in sections(batch.column(1).cast(pa.binary()).to_pylist(), reach):
                parts, owners, shifts = [], [], []
                for i, start, base in zip(numbers.tolist(), starts.tolist(), bases.tolist()):
                    rows = places[i]
                    low, high = np.searchsorted(rows[0], [base, base + SECTION])
                    if high > low:
                        parts.append([x[low:high] for x in rows])
                        owners.append(np.full(high - low, i))
                        shifts.append(np.full(high - low, base - start))
                if parts:
                    columns, owner, shift = [np.concatenate(x) for x in zip(*parts)], np.concatenate(owners), np.concatenate(shifts)
                    strings = Strings(data, powers)
                    for i in range(0, len(owner), 2_000):
                        part = slice(i, i + 2_000)
                        yield make(strings, keys[owner[part]], [c[part] for c in columns], shift[part])

    return joined.mapInArrow(run, schema)


def blocks_of(length: int):
    size = min(BLOCK, length // 4)

    def make(strings: Strings, keys: np.ndarray, rows: list[np.ndarray], shift: np.ndarray) -> pa.RecordBatch:
        first, at, last = (x - shift for x in rows)
        # blocks by distance from the chosen suffix, so that they lie alike in all places of a string
        near, far = (at - last) // size, (at - first) // size
        count = far - near + 1
        row = np.repeat(np.arange(len(at)), count)
        block = spread(near, count)
        low, high = at[row] - size * block - size + 1, at[row] - size * block
        shared = strings.digests(high, low + length)
        low, high = np.maximum(low, first[row]), np.minimum(high, last[row])
        arrays = [binary(keys[row]), pa.array(low + shift[row]), pa.array(high + shift[row]), binary(shared), binary(strings.digests(low, high + length))]
        return pa.RecordBatch.from_arrays(arrays, ["key", "first", "last", "shared", "whole"])

    return make


def starts_of(length: int):
    def make(strings: Strings, keys: np.ndarray, rows: list[np.ndarray], shift: np.ndarray) -> pa.RecordBatch:
        first, last = rows[0] - shift, rows[1] - shift
        count = last - first + 1
        row, start = np.repeat(np.arange(len(first)), count), spread(first, count)
        arrays = [binary(keys[row]), pa.array(start + shift[row]), pa.array(rows[2][row].astype(bool)), binary(strings.digests(start, start + length))]
        return pa.RecordBatch.from_arrays(arrays, ["key", "first", "asked", "whole"])

    return make


def covered(first: np.ndarray, last: np.ndarray, length: int, size: int, everything: bool) -> list[tuple[int, int]]:
    """Maximal runs of bytes that strings beginning in the given runs of starts cover."""
    if everything:
        return [(0, size)]
    out: list[tuple[int, int]] = []
    for a, b in zip(first.tolist(), (last + length).tolist()):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def repeated_spans(docs: DataFrame, length: int = 400, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans: a row per row of docs.

    ``spans`` are the maximal runs of bytes covered by strings of ``length`` bytes that also start at any other place of any text, the same
    text included; ``kept_sha256`` is the digest of the other bytes. A null text is empty; texts under ``length`` bytes lose nothing. Rows
    with one text lose all of it if it is long enough, whatever their ids; ids may repeat or be null. Other columns are left out. Without
    rows there are none.
    """
    spark = docs.sparkSession
    value = F.coalesce(F.col(text).cast("string"), F.lit(""))
    digest = F.sha2(value, 256)
    key = F.unhex(F.substring(digest, 1, 32)).alias("key")
    ids = docs.select(F.col(doc_id).alias("doc_id"), key, digest.alias("digest"), F.octet_length(value).cast("bigint").alias("n_bytes"))
    ids = stored(ids, "digests")
    long = docs.select(key, value.alias("text")).where(F.octet_length("text") >= length)
    once = long.groupBy("key").agg(F.first("text").alias("text"), F.count("*").alias("copies"))
    # as many buckets as partitions, so that later joins find the texts in place
    folder = new_folder(spark, "texts")
    name = "texts_" + folder.rpartition("-")[2]
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    once.write.format("parquet").bucketBy(buckets, "key").option("path", folder).saveAsTable(name)
    texts = spark.table(name)

    lead = lead_of(length)
    total, n = texts.agg(F.sum(F.octet_length("text")), F.count("*")).first()
    expected = 2 * (total or 0) // (length - lead + 2) + 1
    parts = -(-expected // BUCKET)
    splitters = np.zeros(0, f"S{lead + 24}")
    if parts > 1:
        every = max(1, n // SAMPLED_TEXTS)
        some = texts.where(F.pmod(F.xxhash64("key"), F.lit(every)) == 0)
        sample = suffixes(some, length, None, min(1.0, SAMPLES * parts * every / expected))
        names = sample.select(F.concat("lead", "key", F.unhex(F.lpad(F.hex("at"), 16, "0"))).alias("name"))
        # SAMPLES for each bucket, of lead + 24 bytes
        found = np.sort(np.array([r[0] for r in names.toLocalIterator()], f"S{lead + 24}"))
        splitters = found[np.linspace(0, len(found), parts + 1).astype(int)[1:-1]] if len(found) else splitters
    dealt = suffixes(texts, length, splitters).repartitionById(len(splitters) + 1, F.col("bucket"))
    found = stored(compared(dealt, lead), "suffixes")
    ends = found.where("border is not null")
    across = ends.groupBy("border").agg(F.count("*").alias("n")).where("n > 1").select("border")
    met = found.where("met").select("key", "at", "first", "last")
    met = met.unionByName(ends.where("not met").join(across, "border").select("key", "at", "first", "last"))

    lists = met.groupBy("key").agg(F.collect_list(F.struct("first", "at", "last")).alias("places"))
    schema = "key binary, first bigint, last bigint, shared binary, whole binary"
    blocks = stored(over_texts(texts, lists, ["first", "at", "last"], length, blocks_of(length), schema), "blocks")
    number = F.xxhash64("whole")
    shared = blocks.groupBy("shared").agg(F.count("*").alias("n"), F.min(number).alias("a"), F.max(number).alias("b"))
    shared = stored(shared.where("n > 1").select("shared", (F.col("a") != F.col("b")).alias("mixed")), "shared")
    known = stored(blocks.join(shared, "shared").select("key", "first", "last", "whole", "mixed"), "known")
    own = F.xxhash64("key", "first", "last")
    whole = known.where("mixed").groupBy("whole").agg(F.count("*").alias("n"), F.min(own).alias("one"))
    whole = stored(whole.where("n > 1").select("whole", "one"), "whole")
    mixed = stored(known.where("mixed").join(whole, "whole", "left").select("key", "first", "last", "one", own.alias("own")), "mixed")
    # a block whose string is elsewhere is done; one of its kind stays, for others to meet
    apart = mixed.where("one is null or one = own").select("key", F.struct("first", "last", F.col("one").isNull().cast("int").alias("asked")).alias("place"))
    lists = apart.groupBy("key").agg(F.collect_list("place").alias("places"))
    schema = "key binary, first bigint, asked boolean, whole binary"
    single = stored(over_texts(texts, lists, ["first", "last", "asked"], length, starts_of(length), schema), "starts")
    twice = stored(single.groupBy("whole").agg(F.count("*").alias("n")).where("n > 1").select("whole"), "repeated-starts")
    hits = single.where("asked").join(twice, "whole").select("key", "first", F.col("first").alias("last"))
    runs = known.where("not mixed").select("key", "first", "last")
    runs = runs.unionByName(mixed.where("one is not null").select("key", "first", "last")).unionByName(hits)
    lists = runs.groupBy("key").agg(F.collect_list(F.struct("first", "last")).alias("places"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            out: tuple[list, ...] = ([], [], [], [])
            values = zip(batch.column(1).cast(pa.binary()).to_pylist(), batch.column(2).to_pylist(), flat(batch.column(3), ["first", "last"]))
            for data, copies, (first, last) in values:
                spans = covered(first, last, length, len(data), copies > 1)
                kept, at = hashlib.sha256(), 0
                for a, b in spans:
                    kept.update(data[at:a])
                    at = b
                kept.update(data[at:])
                out[0].append(sum(b - a for a, b in spans))
                out[1].append(len(spans))
                out[2].append(kept.hexdigest())
                out[3].append([{"start": a, "stop": b} for a, b in spans])
            kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
            arrays = [batch.column(0), pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.string()), pa.array(out[3], kind)]
            yield pa.RecordBatch.from_arrays(arrays, ["key", "n_removed", "n_spans", "kept_sha256", "spans"])

    touched = texts.join(lists, "key", "left").where("copies > 1 or places is not null").select("key", "text", "copies", "places")
    results = stored(touched.mapInArrow(cut, f"key binary, n_removed bigint, n_spans bigint, kept_sha256 string, spans {SPANS}"), "spans")
    of_rows = ids.join(results, "key", "left")
    nothing = F.lit(0).cast("bigint")
    return of_rows.select(
        "doc_id", "n_bytes", F.coalesce("n_removed", nothing).alias("n_removed"), F.coalesce("n_spans", nothing).alias("n_spans"),
        F.coalesce("kept_sha256", "digest").alias("kept_sha256"), F.coalesce("spans", F.array().cast(SPANS)).alias("spans"),
    )


def remove_repeats(docs: DataFrame, length: int = 400, text: str = "text") -> DataFrame:
    """The rows of docs, with all their columns, without the spans of ``repeated_spans``.

    What is left of a text is binary, as a span may begin or end within a character; a null text is empty.
    """
    value = F.coalesce(F.col(text).cast("string"), F.lit(""))
    hashed = docs.select(F.sha2(value, 256).alias("digest"), F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    spans = repeated_spans(docs.select(F.sha2(value, 256).alias("digest"), value.alias("text")), length, "digest")
    spans = stored(spans.where("n_removed > 0").select(F.col("doc_id").alias("digest"), "n_bytes", "spans").distinct(), "spans-of-texts")
    joined = hashed.join(spans, "digest", "left")
    data = F.encode(F.coalesce(F.col("row").getField(text).cast("string"), F.lit("")), "UTF-8")
    stops = F.concat(F.array(F.lit(0).cast("bigint")), F.transform("spans", lambda s: s.stop))
    starts = F.concat(F.transform("spans", lambda s: s.start), F.array("n_bytes"))
    pieces = F.transform(F.arrays_zip(stops.alias("a"), starts.alias("b")), lambda z: F.hex(F.substring(data, (z.a + 1).cast("int"), (z.b - z.a).cast("int"))))
    kept = F.when(F.col("spans").isNull(), data).otherwise(F.unhex(F.array_join(pieces, "")))
    return joined.select(*((kept if c == text else F.col("row").getField(c)).alias(c) for c in docs.columns))
