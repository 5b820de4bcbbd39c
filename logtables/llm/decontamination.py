"""Benchmark decontamination with suffix arrays over the training texts.

The documents are cut into shards of whole texts (the Arrow batches of a task). Each shard gets a suffix array over
its words. Every suffix of every test item is then looked up by binary search, which gives all places where a
window of the item occurs verbatim; places that follow each other in both texts are joined to the longest matches,
with their locations. Nothing is shuffled: a match lies within one document, and a document within one shard.

A suffix of which a word within the shortest window is unknown to the test items can't begin a match, so it is left
out of the array. Test items go to the executors in blocks of a bounded size, one after the other.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from logtables.llm.common import sent

WINDOW = 13
#: Characters of test items that are broadcast at a time; an item is never cut, and larger sets take several blocks.
BLOCK_CHARS = 16_000_000
SPANS = "array<struct<start:bigint,length:bigint,item_id:{0},item_start:bigint>>"
_TABLE = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    """Words of a text: runs of a-z, digits and characters beyond ASCII, after lower-casing A-Z."""
    return text.encode("utf-8", "surrogatepass").translate(_TABLE).split() if text else []


class TestItems:
    """All windows of some test items, in order.

    An item of fewer words than ``window`` is one window. ``keys`` has a row for each different window: its word
    numbers from 1, then zeros. ``owners`` and ``first`` tell the items of each. ``sides`` has all places of windows
    in items, by the word before and by the word after: (window and word as one number, items, places in them).
    """

    __test__ = False

    def __init__(self, items: list[tuple[object, str | None]], window: int):
        self.window, self.vocabulary = window, {}
        self.ids, rows, owner, at, before, after = [], [], [], [], [], []
        for item_id, text in items:
            words = words_of(text)
            if item_id is None or not words:
                continue
            numbers = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words]
            for start in range(max(1, len(numbers) - window + 1)):
                part = numbers[start: start + window]
                rows.append(part + [0] * (window - len(part)))
                owner.append(len(self.ids))
                at.append(start)
                before.append(numbers[start - 1] if start else 0)
                after.append(numbers[start + window] if start + window < len(numbers) else 0)
            self.ids.append(item_id)
        rows = np.array(rows, ">u4").reshape(-1, window)
        self.lengths = np.zeros(0, "i8")
        if len(rows):
            self.keys, inverse = np.unique(packed(rows), return_inverse=True)
            order = np.argsort(inverse, kind="stable")
            owner, at = np.array(owner), np.array(at)
            self.owners, self.sides = owner[order], []
            for side in (before, after):
                code = inverse.astype("i8") * (len(self.vocabulary) + 1) + np.array(side, "i8")
                by_word = np.argsort(code, kind="stable")
                self.sides.append((code[by_word], owner[by_word], at[by_word]))
            self.first = np.searchsorted(inverse[order], np.arange(len(self.keys) + 1))
            words = np.frombuffer(b"".join(k.ljust(4 * window, b"\0") for k in self.keys.tolist()), ">u4").reshape(-1, window)
            self.words, self.lengths = words, (words > 0).sum(axis=1)


def packed(rows: np.ndarray) -> np.ndarray:
    """Rows of numbers as byte strings that sort in the same order."""
    return np.ascontiguousarray(rows, ">u4").view(f"S{4 * rows.shape[1]}").ravel()


class Shard:
    """Suffix array over the words of several texts. ``numbers``: known words from 1, others 0; texts end with 0."""

    def __init__(self, numbers: np.ndarray, window: int, shortest: int):
        end = np.flatnonzero(numbers == 0)
        starts = np.flatnonzero(numbers)
        if len(starts):
            run = end[np.searchsorted(end, starts)] - starts
            starts, run = starts[run >= shortest], run[run >= shortest]
        if len(starts):
            rows = np.where(np.arange(window) < run[:, None], np.take(numbers, starts[:, None] + np.arange(window), mode="clip"), 0)
            keys = packed(rows)
            order = np.argsort(keys, kind="stable")
            self.suffixes, self.keys = starts[order], keys[order]
        else:
            self.suffixes, self.keys = starts, np.zeros(0, f"S{4 * window}")

    def find(self, items: TestItems) -> tuple[np.ndarray, np.ndarray]:
        """Windows that occur and their places, by binary search."""
        low = np.searchsorted(self.keys, items.keys, "left")
        beyond = np.where(np.arange(items.window) < items.lengths[:, None], items.words, 0xFFFFFFFF)
        high = np.searchsorted(self.keys, packed(beyond), "right")
        n = high - low
        window = np.repeat(np.arange(len(n)), n)
        nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        return window, self.suffixes[low[window] + nth]


def edges(items: TestItems, side: int, window: np.ndarray, word: np.ndarray):
    """Where matches begin (side 0) or end (1): (occurrence, item, place in the item).

    ``word`` is the word beside each occurrence. A match goes on at all places of the window in items that have the
    same word beside them, which are one range and left out; so the work grows with the matches, not with all pairs of
    places.
    """
    codes, owners, starts = items.sides[side]
    code = window * (len(items.vocabulary) + 1) + word
    low = np.searchsorted(codes, code, "left")
    same = np.where(word > 0, np.searchsorted(codes, code, "right") - low, 0)
    n = items.first[window + 1] - items.first[window] - same
    which = np.repeat(np.arange(len(n)), n)
    nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + items.first[window[which]]
    nth += np.where(nth >= low[which], same[which], 0)
    return which, owners[nth], starts[nth]


def spans_of(items: TestItems, window: np.ndarray, place: np.ndarray, numbers: np.ndarray):
    """The longest matches of every item and every place in it: (place, length, item, place in the item), by place."""
    sides = numbers.astype("i8")
    begin, owner, start = edges(items, 0, window, np.where(place > 0, sides[place - 1], 0))
    end, end_owner, end_start = edges(items, 1, window, sides[place + items.lengths[window]])
    # along a diagonal of text and item, beginnings and ends take turns
    order = np.lexsort((place[begin], place[begin] - start, owner))
    begin, owner, start = begin[order], owner[order], start[order]
    end = end[np.lexsort((place[end], place[end] - end_start, end_owner))]
    length = place[end] + items.lengths[window[end]] - place[begin]
    order = np.lexsort((start, owner, place[begin]))
    return place[begin][order], length[order], owner[order], start[order]


def search_block(items: Callable[[], TestItems], item_type: pa.DataType, shortest: int):
    """A function from a batch (row, text, items, spans, ...) to the same batch with this block's matches added."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = items()
        find = block.vocabulary.get
        for batch in batches:
            lists = [words_of(t) for t in batch.column(1).to_pylist()]
            sizes = np.array([len(w) + 1 for w in lists], "i8")
            total, offset = int(sizes.sum()), np.cumsum(sizes) - sizes
            numbers = np.zeros(total, "u4")
            for words, a in zip(lists, offset.tolist()):
                numbers[a: a + len(words)] = np.fromiter(map(find, words, repeat(0)), "u4", len(words))
            text = np.repeat(np.arange(len(sizes)), sizes)
            found, spans = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            window, place = Shard(numbers, block.window, shortest).find(block) if len(block.lengths) else (np.zeros(0, "i8"),) * 2
            if len(window):
                pairs = np.unique(text[place] * len(block.lengths) + window)
                row, occurring = np.divmod(pairs, len(block.lengths))
                n = block.first[occurring + 1] - block.first[occurring]
                nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                owners = block.owners[np.repeat(block.first[occurring], n) + nth]
                pairs = np.unique(np.repeat(row, n) * len(block.ids) + owners)
                for r, o in zip(*(x.tolist() for x in np.divmod(pairs, len(block.ids)))):
                    found[r] = [*found[r], block.ids[o]] if block.ids[o] not in found[r][-1:] else found[r]
                for p, n, o, s in zip(*(x.tolist() for x in spans_of(block, window, place, numbers))):
                    r = int(text[p])
                    spans[r].append({"start": p - int(offset[r]), "length": n, "item_id": block.ids[o], "item_start": s})
            hit = [union_length(s) for s in spans]
            kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("item_id", item_type), ("item_start", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found, pa.list_(item_type)), pa.array(spans, kind),
                 pa.array(sizes - 1), pa.array(hit, pa.int64())], ["row", "text", "items", "spans", "n_words", "n_hit"])

    return search


def union_length(spans: list[dict]) -> int:
    total = end = 0
    for a, b in sorted((s["start"], s["start"] + s["length"]) for s in spans):
        total += max(0, b - max(a, end))
        end = max(end, b)
    return total


def find_matches(docs: DataFrame, benchmark: DataFrame, keep: list[str], text: str = "text", item_id: str = "item_id",
                 item_text: str = "text", window: int = WINDOW, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """For each row of docs: row (a struct of the columns in ``keep``), n_words, n_hit, items, spans.

    n_hit counts the words inside any occurrence of a window, ``items`` are the ids of items with an occurring
    window, ``spans`` the longest matches with their places, in words from 0. Null and empty texts have no words.
    Items without words or without an id take no part; of items that share an id, all windows count. Repeated rows
    of docs stay apart. Without items or documents the result is empty matches or no rows.
    """
    spark = docs.sparkSession
    item_type = benchmark.schema[item_id].dataType
    kind = item_type.simpleString()
    arrow = to_arrow_type(item_type)
    items = benchmark.select(F.col(item_id).alias("id"), F.col(item_text).alias("text")).where("id is not null")
    total = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-total // block_chars))
    nothing = F.array().cast(f"array<{kind}>"), F.array().cast(SPANS.format(kind))
    rows = docs.select(F.struct(*keep).alias("row"), F.col(text).alias("text"), nothing[0].alias("items"), nothing[1].alias("spans"))
    schema = (f"row {rows.schema['row'].dataType.simpleString()}, text string, items array<{kind}>, "
              f"spans {SPANS.format(kind)}, n_words bigint, n_hit bigint")
    for block in range(blocks):
        # all rows of an id are in one block
        part = items.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == block).orderBy("id", "text").collect()
        block_items = TestItems([tuple(r) for r in part], window)
        shortest = int(block_items.lengths.min(initial=window))
        search = search_block(sent(spark, block_items), arrow, shortest)
        rows = rows.select("row", "text", "items", "spans").mapInArrow(search, schema)
    return rows.select("row", "n_words", "n_hit", "items", "spans")


def contamination(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", share: float = 0.05, **options) -> DataFrame:
    """doc_id, n_words, n_hit, items, spans and contaminated: hit words are at least ``share`` of all words."""
    rows = find_matches(docs.select(F.col(doc_id).alias("doc_id"), F.col(options.pop("text", "text")).alias("text")), benchmark, ["doc_id"], **options)
    return rows.select("row.doc_id", "n_words", "n_hit", "items", "spans", is_contaminated(share).alias("contaminated"))


def is_contaminated(share: float):
    return (F.col("n_hit") > 0) & (F.col("n_hit") >= F.col("n_words") * F.lit(share).cast("decimal(9,6)"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, share: float = 0.05, **options) -> DataFrame:
    """The rows of docs that aren't contaminated, with all their columns."""
    rows = find_matches(docs, benchmark, docs.columns, **options)
    return rows.where(~is_contaminated(share)).select("row.*")
