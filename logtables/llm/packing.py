"""Best-fit packing of tokenised documents into sequences of a fixed capacity.

Bulk-synchronous best fit. Pieces are range-sorted by length over the executors and ranked within their length.
Pieces of one length are interchangeable, and so are sequences with one gap; so the two sorted lists that a
sweep walks along are kept as runs: (length, first rank, count) and (gap, first sequence, count). There are at most
``capacity`` lengths and as many gaps, whatever the number of documents. In each round

1. every length looks up its successor, the smallest gap that holds it;
2. lengths that want the same gap are served by rank, the longest first, each as far as the gap's sequences last;
3. the gaps of the sequences that were served are updated,

and rounds go on until all pieces have a place. A round serves lengths down to half of the longest one that waits,
so that short pieces never take what a long one needs. A length without any successor opens sequences. At the end
the executors look up each piece's place by its length and rank.
"""

from __future__ import annotations

import json
import re
import zlib
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logtables.llm.common import stored

CAPACITY = 2048
#: Words kept with their ids while a task runs.
MEMO_WORDS = 400_000
#: Texts whose new words are merged in one call.
GROUP = 500
SPECIAL = "<|endoftext|>"
#: The public split pattern of this byte-level vocabulary.
SPLIT = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class ByteTokenizer:
    """Ids of whole texts by a byte-level BPE file of the ``tokenizers`` library, as little-endian bytes.

    Two characters other than white space with one blank between them are never in one token, and the blank belongs
    to what follows it. So texts are cut there, and the ids of each part are looked up if it was seen before.
    ``tiktoken`` merges with the ranks of the same file; the new parts of a batch are merged in one call. The string
    of the special token is a token of its own; texts that hold it go to the ``tokenizers`` library as they are.
    """

    def __init__(self, path: str):
        import tiktoken

        self.path = path
        with open(path, encoding="utf-8") as file:
            vocabulary = json.load(file)["model"]["vocab"]
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        shown = {chr(b): b for b in plain}
        shown |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(plain))}
        ranks = {bytes(shown[c] for c in token): i for token, i in vocabulary.items() if token != SPECIAL}
        self.encode = tiktoken.Encoding("ranks", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.sizes = np.zeros(max(ranks.values()) + 1, "i8")
        self.sizes[list(ranks.values())] = [len(token) for token in ranks]
        self.memo: dict[str, bytes] = {}  # ids of a blank and the word
        self.whole = None

    def slow(self, text: str) -> bytes:
        from tokenizers import Tokenizer

        self.whole = self.whole or Tokenizer.from_file(self.path)
        return np.asarray(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def direct(self, text: str) -> bytes:
        return np.asarray(self.encode(text), "<u4").tobytes()

    def learn(self, words: list[str]) -> None:
        """Put words that neither begin nor end with white space into the memo, each with a blank before it."""
        ids = np.asarray(self.encode(" " + " ".join(words)), "<u4")
        ends = np.cumsum(self.sizes[ids])
        bounds = np.searchsorted(ends, np.cumsum([len(w.encode()) + 1 for w in words]), "left") + 1
        data, start = ids.tobytes(), 0
        for word, end in zip(words, (4 * bounds).tolist()):
            self.memo[word] = data[start:end]
            start = end

    def ids(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text; null and empty texts have none."""
        if len(self.memo) >= MEMO_WORDS:
            self.memo.clear()
        cut = [t.split(" ") if t and SPECIAL not in t and not odd_blanks(t) else None for t in texts]
        new: set[str] = set()
        for words in cut:
            if words:
                new.update(set(words[1:]).difference(self.memo))
        if new:
            self.learn(list(new))
        known, out = self.memo.__getitem__, []
        for text, words in zip(texts, cut):
            if words:
                out.append(self.direct(words[0]) + b"".join(map(known, words[1:])))
            elif not text:
                out.append(b"")
            else:
                out.append(self.slow(text) if SPECIAL in text else self.direct(text))
        return out


ODD_BLANKS = re.compile(r"\A | \s|[^\S ] |\s\Z").search


def odd_blanks(text: str) -> bool:
    """Whether a blank is beside other white space or an end: there the cut at blanks fails, so such a text is merged whole.

    If all white space is single blanks and line feeds inside the text, which is quick to see, none is.
    """
    return len(text.split()) != text.count(" ") + text.count("\n") + 1 and bool(ODD_BLANKS(text))


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, doc_id: str = "doc_id", text: str = "text",
                 with_ids: bool = False) -> DataFrame:
    """Pieces of at most ``capacity`` tokens: doc_id, piece, start, length, ids_crc32 and, if wanted, ids.

    A document is its tokens and then id 0; null and empty texts have id 0 only. Longer ones are cut so that all
    pieces but the first are full. Rows with the same or a null doc_id are documents of their own. ``tokenizer`` is
    the path of a byte-level BPE file that every machine has. An empty table gives no pieces.
    """
    kind = docs.schema[doc_id].dataType
    chosen = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    schema = f"doc_id {kind.simpleString()}, piece int, start bigint, length bigint, ids_crc32 bigint"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = ByteTokenizer(tokenizer)
        for batch in batches:
            rows, pieces, starts, lengths, sums, ids = [], [], [], [], [], []
            texts = batch.column(1)
            data_of = (d for i in range(0, len(texts), GROUP) for d in tokens.ids(texts.slice(i, GROUP).to_pylist()))
            for row, data in enumerate(data_of):
                data += bytes(4)
                n = len(data) // 4
                bounds = [0, *range(n % capacity or capacity, n + 1, capacity)]
                for k, (a, b) in enumerate(zip(bounds, bounds[1:])):
                    part = data[4 * a: 4 * b]
                    rows.append(row)
                    pieces.append(k)
                    starts.append(a)
                    lengths.append(b - a)
                    sums.append(zlib.crc32(part))
                    if with_ids:
                        ids.append(np.frombuffer(part, "<u4").astype("i4"))
            arrays = [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(pieces, pa.int32()),
                      *(pa.array(x, pa.int64()) for x in (starts, lengths, sums))]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                arrays.append(pa.array(ids, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(arrays, names)

    return chosen.mapInArrow(cut, schema + (", ids array<int>" if with_ids else ""))


class Gaps:
    """Open sequences, as runs by gap."""

    def __init__(self):
        self.sizes: list[int] = []
        self.runs: dict[int, list[tuple[int, int]]] = defaultdict(list)
        self.count: dict[int, int] = defaultdict(int)

    def add(self, gap: int, first: int, n: int) -> None:
        if gap and n:
            if not self.count[gap]:
                insort(self.sizes, gap)
            self.runs[gap].append((first, n))
            self.count[gap] += n

    def successor(self, length: int) -> int | None:
        at = bisect_left(self.sizes, length)
        return self.sizes[at] if at < len(self.sizes) else None

    def take(self, gap: int, n: int) -> Iterator[tuple[int, int]]:
        """Runs of n sequences in all, which are no longer open."""
        self.count[gap] -= n
        if not self.count[gap]:
            self.sizes.pop(bisect_left(self.sizes, gap))
        while n:
            first, there = self.runs[gap].pop()
            used = min(n, there)
            if used < there:
                self.runs[gap].append((first + used, there - used))
            n -= used
            yield first, used


def best_fit_places(counts: dict[int, int], capacity: int) -> tuple[np.ndarray, int]:
    """Places of all pieces, given how many there are of each length, and the number of sequences.

    A place is a row (length, first rank, first sequence, pieces in each sequence, offset of the first).
    """
    waiting = {n: c for n, c in counts.items() if c}
    ranks: dict[int, int] = defaultdict(int)
    gaps, places, sequences = Gaps(), [], 0

    def put(length: int, gap: int, runs, n: int) -> list[tuple[int, int, int]]:
        """n pieces go into the runs of sequences; returns their new gaps."""
        each, left = gap // length, []
        for first, there in runs:
            used = min(n, there * each)
            places.append((length, ranks[length], first, each, capacity - gap))
            ranks[length] += used
            n -= used
            full, rest = divmod(used, each)
            left.append((gap - each * length, first, full))
            if rest:
                left.append((gap - rest * length, first + full, 1))
        return left

    while waiting:
        longest = max(waiting)
        wanted: dict[int, list[int]] = defaultdict(list)
        opening = []
        for length in sorted((n for n in waiting if 2 * n > longest), reverse=True):
            gap = gaps.successor(length)
            if gap is None:
                opening.append(length)
            else:
                wanted[gap].append(length)
        served: list[tuple[int, int, int]] = []
        for gap, lengths in wanted.items():
            for length in lengths:
                there = gaps.count[gap]
                if not there:
                    break
                n = min(waiting[length], there * (gap // length))
                served += put(length, gap, list(gaps.take(gap, -(-n // (gap // length)))), n)
                waiting[length] -= n
        for length in opening:
            # pieces of over half a sequence never share one; of the others, the longest opens sequences by itself
            if 2 * length > capacity or length == longest:
                n = -(-waiting[length] // (capacity // length))
                served += put(length, capacity, [(sequences, n)], waiting[length])
                sequences += n
                waiting[length] = 0
        for run in served:
            gaps.add(*run)
        waiting = {n: c for n, c in waiting.items() if c}
    return np.array(sorted(places), "i8").reshape(-1, 5), sequences


def best_fit(pieces: DataFrame, capacity: int = CAPACITY, partitions: int | None = None) -> DataFrame:
    """The pieces with sequence_id and offset. ``pieces`` has an integer column ``length`` from 1 to capacity.

    Other columns pass through, but for ``sequence_id`` and ``offset``, which are set. Pieces of a length are ranked
    in the order in which the range sort leaves them, which the written table fixes. Equal rows are pieces of their
    own. A length that is null or out of range stops the job. No pieces, no rows.
    """
    spark = pieces.sparkSession
    names = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    bad = F.raise_error(F.lit(f"a piece's length must be from 1 to {capacity}")).cast("bigint")
    checked = F.when(F.col("length").between(1, capacity), F.col("length").cast("bigint")).otherwise(bad)
    # the second key spreads equal lengths over several ranges; written first, as a range sort reads its input twice
    rows = pieces.select(F.struct(*names).alias("row"), checked.alias("length"), F.xxhash64(*names).alias("spread"))
    rows = stored(rows, "pieces")
    ranged = rows.repartitionByRange(n, "length", "spread").sortWithinPartitions("length", "spread")

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, seen = -1, 0
        for batch in batches:
            lengths = batch.column(1).to_numpy()
            start = np.r_[0, np.flatnonzero(np.diff(lengths)) + 1] if len(lengths) else np.zeros(0, "i8")
            base = np.repeat(start, np.diff(np.r_[start, len(lengths)]))
            local = np.arange(len(lengths)) - base
            if len(lengths):
                if lengths[0] == last:
                    local[: start[1] if len(start) > 1 else None] += seen
                last, seen = lengths[-1], local[-1] + 1
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(local)], ["row", "length", "local"])

    kind = rows.schema["row"].dataType.simpleString()
    ranged = ranged.select("row", "length").mapInArrow(numbered, f"row {kind}, length bigint, local bigint")
    ranged = stored(ranged.withColumn("range", F.spark_partition_id()), "pieces-by-length")
    # at most one row for each length and one more for each range
    runs = ranged.groupBy("range", "length").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("length").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("base", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    runs = stored(runs, "length-runs")
    counts = {r["length"]: r["n"] for r in runs.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    places, _ = best_fit_places(counts, capacity)
    shared = spark.sparkContext.broadcast(places)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = shared.value
        width = int(runs[:, 1].max()) + 1 if len(runs) else 1
        key = runs[:, 0] * width + runs[:, 1]
        for batch in batches:
            length, rank = batch.column(1).to_numpy(), batch.column(2).to_numpy()
            run = runs[np.searchsorted(key, length * width + np.minimum(rank, width - 1), "right") - 1]
            into, nth = np.divmod(rank - run[:, 1], run[:, 3])
            out = [batch.column(0), pa.array(run[:, 2] + into), pa.array(run[:, 4] + nth * length)]
            yield pa.RecordBatch.from_arrays(out, ["row", "sequence_id", "offset"])

    ranked = ranged.join(runs.select("range", "length", "base"), ["range", "length"])
    ranked = ranked.select("row", "length", (F.col("base") + F.col("local")).alias("rank"))
    done = ranked.mapInArrow(placed, f"row {kind}, sequence_id bigint, offset bigint")
    return done.select("row.*", "sequence_id", "offset")


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, doc_id: str = "doc_id",
                   text: str = "text", with_ids: bool = False) -> DataFrame:
    """Tokenise, cut and pack whole documents: the columns of ``token_pieces`` with sequence_id and offset."""
    return best_fit(token_pieces(docs, tokenizer, capacity, doc_id, text, with_ids), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """The sequences as token ids, from pieces with ``ids``: sequence_id, ids, lengths of the pieces in order."""
    pieces = F.array_sort(F.collect_list(F.struct("offset", "length", "ids")))
    rows = packed.groupBy("sequence_id").agg(pieces.alias("p"))
    return rows.select("sequence_id", F.flatten("p.ids").alias("ids"), F.col("p.length").alias("lengths"))
