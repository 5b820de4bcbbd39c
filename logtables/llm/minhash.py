"""Near-duplicates by a multi-index Hamming join of b-bit MinHash signatures, confirmed on full sets.

1. One scan makes each document's set of word shingles, its digest and a signature of 64 values of 16 bits. Documents
   with one digest are one class, and only classes go on.
2. Signatures are cut into m chunks. Two that differ in fewer than 2 m values have a chunk with at most one
   difference, by the pigeonhole principle. For each chunk the one allowed error is enumerated: every value in turn is left
   out, and what remains is a key. So all pairs within that distance meet under a key. m is the least for which two
   sets at the similarity threshold differ in more values with a probability below 1e-6: 13 for 0.85, 16 for 0.8.
3. Of a key, every class is compared with the smallest one first, each such pair once, however many keys it shares. Keys whose members
   these links have connected are done; in the others, what isn't in the largest tree is compared by signature with all the rest, in units of
   two blocks of bounded size. A unit gives a spanning forest of the pairs within the distance, not the pairs. Connected, these
   are groups outside of which no link can be.
4. Full sets are made again for the classes in groups. Blocks of a group, each with the group's smallest class, are confirmed from the
   nearest pairs on; that connects most of a group with one copy of each text. Then, as for keys, what isn't in the largest
   tree of a group is confirmed against all the rest. The components of the confirmed links are the result.

What is outside of the largest tree of a group is compared with the whole group, spread over units of a fixed size; what
leaves a unit grows with its members.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import groupby
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logtables.llm.common import stored
from logtables.llm.components import connected_components

VALUES = 64
MISSED = 1e-6
BLOCK = 512
MEMO_WORDS = 400_000
_RANDOM = np.random.default_rng(20)
_FACTORS = _RANDOM.integers(1, 2**63, VALUES, dtype="u8") * np.uint64(2) + np.uint64(1)
_STEPS = _RANDOM.integers(1, 2**63, 64, dtype="u8") * np.uint64(2) + np.uint64(1)
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def chunks_for(percent: int) -> int:
    """Chunks whose distance, less than two errors for each, holds all but ``MISSED`` of pairs at the threshold."""
    p = 1 - percent / 100
    beyond, chunks = 1.0, 0
    while beyond >= MISSED and chunks < VALUES // 2:
        chunks += 1
        beyond = sum(comb(VALUES, k) * p**k * (1 - p) ** (VALUES - k) for k in range(2 * chunks, VALUES + 1))
    return chunks


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class Shingles:
    """Sets of word shingles, as sorted 64-bit hashes."""

    def __init__(self, size: int):
        import xxhash

        self.size, self.hash, self.memo = size, xxhash.xxh3_64_intdigest, {}

    def of(self, text: str | None) -> np.ndarray:
        """Words are runs of anything but ASCII white space, A-Z in small letters. Fewer words than a shingle are one shingle."""
        words = text.encode("utf-8", "surrogatepass").translate(_LOWER).split() if text else []
        if not words:
            return np.zeros(0, "u8")
        memo = self.memo
        if len(memo) > MEMO_WORDS:
            memo.clear()
        for word in set(words).difference(memo):
            memo[word] = self.hash(word)
        numbers = np.fromiter(map(memo.__getitem__, words), "u8", len(words))
        size = min(self.size, len(words))
        sums = np.full(len(words) - size + 1, size, "u8")
        for i in range(size):
            sums = mixed(sums * _STEPS[0] + numbers[i: i + len(sums)])
        return np.unique(sums)


def signature(shingles: np.ndarray) -> np.ndarray:
    lowest = np.full(VALUES, 2**64 - 1, "u8")
    for i in range(0, len(shingles), 4096):
        part = shingles[i: i + 4096]
        np.minimum(lowest, (part[None, :] * _FACTORS[:, None]).min(axis=1), out=lowest)
    return (mixed(lowest) & np.uint64(0xFFFF)).astype("u2")


def chunk_keys(signatures: np.ndarray, chunks: int) -> np.ndarray:
    """All keys of each signature: one for each value, of its chunk without it."""
    bounds = np.linspace(0, VALUES, chunks + 1).round().astype(int)
    values, keys = signatures.astype("u8"), []
    for a, b in zip(bounds, bounds[1:]):
        for left_out in range(a, b):
            key = np.full(len(values), left_out, "u8")
            for i in range(a, b):
                if i != left_out:
                    key = mixed(key * _STEPS[1] + values[:, i])
            keys.append(key)
    return np.column_stack(keys).view("i8")


class Forest:
    """Union-find over positions."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.root(i), self.root(j)
        self.up[max(i, j)] = min(i, j)
        return i != j


def within_distance(signatures: np.ndarray, first: np.ndarray, second: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of the two lists of positions within the distance: (position, position, distance), the nearest first."""
    out = []
    for i in range(0, len(first), 64):
        part = first[i: i + 64]
        distance = (signatures[part][:, None, :] != signatures[second][None, :, :]).sum(axis=2, dtype="u1")
        a, b = np.nonzero(distance <= most)
        out.append((part[a], second[b], distance[a, b]))
    a, b, distance = (np.concatenate(x) for x in zip(*out))
    once = a < b if first is second else a != b
    a, b, distance = a[once], b[once], distance[once]
    order = np.argsort(distance, kind="stable")
    return a[order], b[order], distance[order]


def blocks_with_least(members: DataFrame, group: str, size: str, node: str, block: int) -> DataFrame:
    """Each member in one block of its group, as a unit (group, i, i); the group's smallest member is in all of them."""
    blocks = F.ceil(F.col(size) / block).cast("int")
    own = F.array(F.pmod(F.xxhash64(node, group), blocks).cast("int"))
    # the group is named by its smallest member
    placed = members.withColumn("block", F.explode(F.when(F.col(node) == F.col(group), F.sequence(F.lit(0), blocks - 1)).otherwise(own)))
    return placed.withColumn("first", F.col("block")).withColumn("last", F.col("block"))


def units(members: DataFrame, group: str, node: str, block: int) -> DataFrame:
    """Members in all units (group, i, j) of two blocks, or one, in which two of them may not be connected yet.

    The column ``known`` tells what is connected. Members outside of the group's largest tree meet all others; those in it only
    those outside. Groups of one tree are left out. ``first`` and ``last`` number the blocks of a unit; ``block`` is the member's own.
    """
    trees = members.groupBy(group, "known").agg(F.count("*").alias("n"))
    main = trees.groupBy(group).agg(F.max(F.struct("n", "known")).alias("m"), F.sum("n").alias("n")).where("m.n < n")
    main = main.select(group, F.col("m.known").alias("main"), F.ceil(F.col("m.n") / block).cast("int").alias("mains"), F.ceil((F.col("n") - F.col("m.n")) / block).cast("int").alias("rests"))
    own = members.join(main, group)
    inside = F.col("known") == F.col("main")
    hashed = F.xxhash64(node, group)
    number = F.when(inside, F.col("rests") + F.pmod(hashed, "mains")).otherwise(F.pmod(hashed, "rests")).cast("int")
    others = F.when(inside, F.col("rests")).otherwise(F.col("rests") + F.col("mains")) - 1
    own = own.withColumn("block", number).withColumn("other", F.explode(F.sequence(F.lit(0), others)))
    return own.withColumn("first", F.least("block", "other")).withColumn("last", F.greatest("block", "other")).drop("other", "main", "mains", "rests")


def near_pairs(pairs: DataFrame, nodes: DataFrame, most: int) -> DataFrame:
    """Those of the pairs (a, b) whose signatures are within the distance."""
    kind = nodes.schema["node"].dataType.simpleString()
    left = nodes.select(F.col("node").alias("a"), F.col("signature").alias("_a"))
    right = nodes.select(F.col("node").alias("b"), F.col("signature").alias("_b"))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                a, b = (np.frombuffer(b"".join(batch.column(i).to_pylist()), "u2").reshape(-1, VALUES) for i in (2, 3))
                near = pa.array((a != b).sum(axis=1) <= most)
                yield pa.RecordBatch.from_arrays([batch.column(i).filter(near) for i in range(2)], ["a", "b"])

    joined = pairs.join(left, "a").join(right, "b")
    return joined.select("a", "b", "_a", "_b").mapInArrow(keep, f"a {kind}, b {kind}")


def forests(rows: DataFrame, group: str, node: str, values: list[str], confirm: Callable[[], Callable], most: int) -> DataFrame:
    """Links (a, b) that connect what belongs together in each unit: every member of a tree with its smallest.

    Members that agree in the column ``known``, if there is one, are connected already; of those, one link at most leaves
    the unit.

    ``confirm`` makes, once per task, a function of the unit's value columns that returns (signatures, test), where
    test(i, j) tells whether a pair is a link; pairs that differ in more than ``most`` values aren't tested.
    """
    kind = rows.schema[node].dataType.simpleString()
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [group, "first", "last"]
    known = "known" if "known" in rows.columns else node
    dealt = rows.select(*keys, "block", node, F.col(known).alias("known"), *values).repartition(n, *keys).sortWithinPartitions(*keys)

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prepare = confirm()
        lines = (line for batch in batches for line in zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns))))
        a, b = [], []
        for key, unit in groupby(lines, key=lambda line: line[:3]):
            # a unit has two blocks of a bounded size
            members = sorted(unit, key=lambda line: line[4])
            if len(members) < 2:
                continue
            signatures, test = prepare([m[6:] for m in members])
            blocks = np.array([m[3] for m in members])
            first = np.flatnonzero(blocks == key[1])
            second = first if key[1] == key[2] else np.flatnonzero(blocks == key[2])
            forest, firsts = Forest(len(members)), {}
            for i, member in enumerate(members):
                forest.join(i, firsts.setdefault(member[5], i))
            heads = [i for i in range(len(members)) if forest.root(i) == i]
            if len(first) and len(second):
                for i, j, _ in zip(*(x.tolist() for x in within_distance(signatures, first, second, most))):
                    if forest.root(i) != forest.root(j) and test(i, j):
                        forest.join(i, j)
            for i in heads:
                root = forest.root(i)
                if root != i:
                    a.append(members[i][4])
                    b.append(members[root][4])
            if len(a) > 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])
                a, b = [], []
        if a:
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    return dealt.mapInArrow(link, f"a {kind}, b {kind}")


def by_signature() -> Callable:
    def prepare(rows: list[tuple]):
        return np.frombuffer(b"".join(r[0] for r in rows), "u2").reshape(-1, VALUES), lambda i, j: True

    return prepare


def by_sets(shingle: int, percent: int) -> Callable[[], Callable]:
    def start():
        shingles = Shingles(shingle)

        def prepare(rows: list[tuple]):
            sets = [shingles.of(r[1]) for r in rows]

            def test(i: int, j: int) -> bool:
                a, b = (sets[i], sets[j]) if len(sets[i]) <= len(sets[j]) else (sets[j], sets[i])
                if 100 * len(a) < percent * len(b):
                    return False
                at = np.searchsorted(b, a)
                same = int((b[np.minimum(at, len(b) - 1)] == a).sum())
                return 100 * same >= percent * (len(a) + len(b) - same)

            return np.frombuffer(b"".join(r[0] for r in rows), "u2").reshape(-1, VALUES), test

        return prepare

    return start


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text",
                    block: int = BLOCK) -> DataFrame:
    """doc_id, n_shingles, component_id, kept, a row per row of docs.

    Documents are linked if 100 times the intersection of their sets is at least ``percent`` times the union;
    component_id is the smallest doc_id that links reach, kept tells whether it is the document's own. Documents without words (null, empty or blank texts) are linked with nothing, nor are rows
    without an id, whose component is null and which aren't kept. Rows with one id are one document; of several texts that
    have words, the one with the smallest digest stands for it. Other columns are left out; an empty table gives no rows.
    """
    chunks = chunks_for(percent)
    most = 2 * chunks - 1
    kind = docs.schema[doc_id].dataType.simpleString()
    chosen = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    chosen = chosen.select("doc_id", "text", F.xxhash64("text").alias("content"))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        shingles = Shingles(shingle)
        for batch in batches:
            sizes, high, low, signatures = [], [], [], []
            for value in batch.column(1).to_pylist():
                found = shingles.of(value)
                digest = np.frombuffer(xxhash.xxh3_128_digest(found.tobytes()), "i8").tolist()
                sizes.append(len(found))
                high.append(digest[0])
                low.append(digest[1])
                signatures.append(signature(found).tobytes() if len(found) else None)
            arrays = [batch.column(0), batch.column(2), *(pa.array(x, pa.int64()) for x in (sizes, high, low)), pa.array(signatures, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "content", "n_shingles", "high", "low", "signature"])

    signed = chosen.mapInArrow(sign, f"doc_id {kind}, content bigint, n_shingles bigint, high bigint, low bigint, signature binary")
    signed = stored(signed, "signatures")
    # one text per id; then classes of ids, for which the smallest stands
    linked = signed.where("n_shingles > 0 and doc_id is not null").groupBy("doc_id").agg(F.min(F.struct("high", "low", "content", "signature")).alias("t"))
    linked = stored(linked.select("doc_id", "t.*"), "documents")
    classes = linked.groupBy("high", "low").agg(F.min(F.struct("doc_id", "content", "signature")).alias("t"))
    classes = classes.select("high", "low", F.col("t.doc_id").alias("node"), "t.content", "t.signature")
    classes = stored(classes, "classes")
    nodes = classes.select("node", "content", "signature")

    def enumerate_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                signatures = np.frombuffer(b"".join(batch.column(1).to_pylist()), "u2").reshape(-1, VALUES)
                keys = chunk_keys(signatures, chunks)
                nodes = batch.column(0).take(pa.array(np.repeat(np.arange(len(keys)), keys.shape[1])))
                yield pa.RecordBatch.from_arrays([nodes, pa.array(keys.ravel())], ["node", "key"])

    keys = classes.select("node", "signature").mapInArrow(enumerate_keys, f"node {kind}, key bigint")
    met = keys.groupBy("key").agg(F.count("*").alias("n"), F.min("node").alias("least"), F.max("node").alias("most"),
                                  F.bit_xor(F.xxhash64("node")).alias("members"))
    met = met.where("n > 1").groupBy("n", "least", "most", "members").agg(F.min("key").alias("key"))
    met = stored(met.select("key", "least"), "shared-keys")
    members = stored(keys.join(met, "key").select("key", "least", "node"), "key-members")
    pairs = members.where("node <> least").select(F.col("node").alias("a"), F.col("least").alias("b")).distinct()
    first = stored(near_pairs(pairs, nodes, most), "near-pairs")
    trees = stored(connected_components(first, "near"), "trees")
    known = members.join(trees, "node", "left").select("key", "node", F.coalesce("component", "node").alias("known"))
    late = forests(units(stored(known, "known"), "key", "node", block).join(nodes, "node"), "key", "node", ["signature"], by_signature, most)
    near = trees.where("node <> component").select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(late)
    groups = stored(connected_components(near, "near"), "groups")
    sizes = groups.groupBy("component").agg(F.count("*").alias("n"))
    grouped = groups.join(sizes, "component").join(nodes, "node")
    # the text of a class is that of its smallest id
    wanted = grouped.select("node", "component", "n", "signature", F.col("content").alias("c"))
    texts = chosen.join(wanted, (F.col("doc_id") == F.col("node")) & (F.col("content") == F.col("c")))
    texts = stored(texts.groupBy("node").agg(*(F.first(c).alias(c) for c in ("component", "n", "signature", "text"))), "texts")
    confirm = by_sets(shingle, percent)
    values = ["signature", "text"]
    linked_first = stored(forests(blocks_with_least(texts, "component", "n", "node", block), "component", "node", values, confirm, most), "links")
    joined = stored(connected_components(linked_first, "links"), "linked")
    known = groups.join(joined.select("node", F.col("component").alias("tree")), "node", "left").select("node", "component", F.coalesce("tree", "node").alias("known"))
    # only groups of several trees need their texts again
    rest = units(stored(known, "known"), "component", "node", block).join(texts.select("node", *values), "node")
    confirmed = linked_first.unionByName(forests(rest, "component", "node", values, confirm, most))
    components = connected_components(confirmed, "links")
    of_class = classes.join(components, "node", "left").select("high", "low", F.coalesce("component", "node").alias("component_id"))
    of_id = linked.join(of_class, ["high", "low"]).select("doc_id", "component_id")
    rows = signed.select("doc_id", "n_shingles").join(of_id, "doc_id", "left")
    alone = (F.col("n_shingles") == 0) | F.col("doc_id").isNull()
    component = F.when(alone & F.col("component_id").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return rows.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept"))


def drop_near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of docs without those that aren't the smallest id of their component; all columns stay.

    Of rows that share an id one stays. Rows without an id stay, as they are linked with nothing.
    """
    found = stored(near_duplicates(docs, shingle, percent, doc_id, text).where("doc_id is not null").select("doc_id", "kept"), "near-duplicates")
    gone = found.where("not kept").select(F.col("doc_id").alias(doc_id)).distinct()
    repeated = found.where("kept").groupBy(F.col("doc_id").alias(doc_id)).agg(F.count("*").alias("n")).where("n > 1").select(doc_id)
    rest = docs.join(gone, doc_id, "left_anti")
    if not repeated.isEmpty():
        rest = rest.join(repeated, doc_id, "left_anti").unionByName(rest.join(repeated, doc_id, "left_semi").dropDuplicates([doc_id]))
    return rest.select(*docs.columns)
