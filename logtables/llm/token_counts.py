"""Token counts under a unigram model, by dynamic programming over a trie of pre-tokens.

A pre-token is a word with a word mark before it; its token count is that of its best segmentation into pieces: the
highest sum of piece scores, of equal ones the fewest pieces. Best scores of prefixes depend on the prefix alone. So
the distinct pre-tokens of a batch of texts form a trie, each node gets its forward score and count once for all
pre-tokens below it, and the counts at the terminals are kept. The trie of a block of pre-tokens is made a level at a
time in arrays; long pre-tokens, whose levels have few nodes, are walked one by one in sorted order, holding the nodes on
the path to the current one. Both give the same counts and cuts.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logtables.llm.common import sent, stored

MARK = "▁"
#: Terminal counts kept while a task runs.
MEMO_WORDS = 500_000
GROUP = 1000
#: Rounds of training, and how far a byte scores below the rarest piece.
ROUNDS = 2
BYTE_PENALTY = 10.0
#: Pre-tokens of more characters are walked one by one; others form tries of so many together.
LONG = 64
BLOCK = 20_000
CHARACTERS = 0x110000
NONE = np.iinfo(np.int64).max


class Unigram:
    """Pieces with scores. A character that no piece holds is written as its bytes, each a token of ``unknown`` score.

    Beginnings of pieces are states, 0 the empty one. ``keys`` are sorted pairs of state and next character, ``targets`` the
    states they lead to.
    """

    def __init__(self, scores: dict[str, float], unknown: float):
        self.scores, self.unknown = scores, unknown
        # beginnings of pieces; None: not itself a piece
        self.beginnings: dict[str, float | None] = {piece[:n]: None for piece in scores for n in range(1, len(piece))}
        self.beginnings.update(scores)
        self.names = ["", *self.beginnings]
        state = {name: i for i, name in enumerate(self.names)}
        # the last key is met by no pair
        keys = np.array([*(state[name[:-1]] * CHARACTERS + ord(name[-1]) for name in self.beginnings), NONE], np.int64)
        order = np.argsort(keys)
        self.keys, self.targets = keys[order], order + 1
        # NaN: not itself a piece
        self.values = np.array([np.nan, *(np.nan if s is None else s for s in self.beginnings.values())])

    @classmethod
    def from_sentencepiece(cls, path: str) -> Unigram:
        """Pieces of a vocabulary file, with the scores that Zipf's law gives to their rank: where fitting starts."""
        import sentencepiece

        file = sentencepiece.SentencePieceProcessor(model_file=path)
        plain = [i for i in range(len(file)) if not (file.is_control(i) or file.is_unknown(i) or file.is_byte(i))]
        # the file's order of preference, best first
        ranked = sorted(plain, key=lambda i: (-file.get_score(i), i))
        total = math.log(sum(1 / r for r in range(1, len(ranked) + 1)))
        scores = {file.id_to_piece(i): -math.log(r) - total for r, i in enumerate(ranked, 1)}
        return cls(scores, -math.log(len(ranked) + 1) - total)

    def refitted(self, counts: dict[str, int]) -> Unigram:
        """The same pieces with scores from counts, each one more than counted; bytes score ``BYTE_PENALTY`` below the rarest."""
        total = math.log(sum(counts.values()) + len(self.scores)) if self.scores else 0.0
        scores = {piece: math.log(counts.get(piece, 0) + 1) - total for piece in self.scores}
        return Unigram(scores, min(scores.values(), default=0.0) - BYTE_PENALTY)

    def _walk(self, words: list[str]) -> Iterator[tuple[str, int, list[int]]]:
        """(pre-token, token count, where the last piece before each place begins) of distinct pre-tokens, through their trie."""
        score, tokens, begin, path = [0.0], [0], [0], ""
        # of each node: places from which what leads to it begins a piece
        alive: list[list[int]] = [[]]
        known, other = self.beginnings.get, math.nan
        for word in sorted(words):
            shared, top = 0, min(len(word), len(path))
            while shared < top and word[shared] == path[shared]:
                shared += 1
            del score[shared + 1:], tokens[shared + 1:], begin[shared + 1:], alive[shared + 1:]
            for end in range(shared + 1, len(word) + 1):
                last = word[end - 1]
                size = 1 if last < "\x80" else 2 if last < "\u0800" else 3 if last < "\U00010000" else 4
                best, fewest, at = score[end - 1] + size * self.unknown, tokens[end - 1] + size, end - 1
                live = []
                for start in (*alive[end - 1], end - 1):
                    s = known(word[start:end], other)
                    if s is other:
                        continue
                    live.append(start)
                    if s is not None:
                        s += score[start]
                        if s > best or s == best and tokens[start] + 1 < fewest:
                            best, fewest, at = s, tokens[start] + 1, start
                score.append(best)
                tokens.append(fewest)
                begin.append(at)
                alive.append(live)
            path = word
            yield word, tokens[-1], begin

    def _trie(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The trie of sorted distinct pre-tokens: the node of each, and of all nodes (0 is the root) the token count, the state
        of the last piece (0: bytes) and the node where it begins.

        A level holds its nodes' live pairs, a node where a piece may begin and the state reached from there, by node and beginning.
        """
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        letters = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
        offsets = np.cumsum(lengths) - lengths
        nodes = 1 + len(letters)
        score, tokens = np.zeros(nodes), np.zeros(nodes, np.int64)
        piece, origin = np.zeros(nodes, np.int64), np.zeros(nodes, np.int64)
        ends, on, node = np.zeros(len(words), np.int64), np.arange(len(words)), np.zeros(len(words), np.int64)
        base, total = 0, 1
        starts, states, first, many = np.zeros(1, np.int64), np.zeros(1, np.int64), np.zeros(1, np.int64), np.ones(1, np.int64)
        for level in range(int(lengths.max(initial=0))):
            longer = lengths[on] > level
            on, node = on[longer], node[longer]
            letter = letters[offsets[on] + level]
            new = np.ones(len(on), bool)
            new[1:] = (node[1:] != node[:-1]) | (letter[1:] != letter[:-1])
            parent, letter = node[new], letter[new]
            here = total + np.arange(len(parent))
            node = total - 1 + np.cumsum(new)
            ends[on] = node
            # the parent's live pairs, each followed by the node's letter
            count = many[parent - base]
            of = np.repeat(np.arange(len(parent)), count)
            pair = np.arange(len(of)) + np.repeat(first[parent - base] - (np.cumsum(count) - count), count)
            key = states[pair] * CHARACTERS + letter[of]
            at = np.searchsorted(self.keys, key)
            alive = self.keys[at] == key
            of, starts, states = of[alive], starts[pair[alive]], self.targets[at[alive]]
            # bytes, unless a piece scores better: the best one, ties to fewest tokens, then to the earliest beginning
            width = 1 + (letter >= 0x80) + (letter >= 0x800) + (letter >= 0x10000)
            best, fewest, by, source = score[parent] + width * self.unknown, tokens[parent] + width, np.zeros(len(parent), np.int64), parent
            value = self.values[states]
            made = np.flatnonzero(~np.isnan(value))
            if len(made):
                sums, n = value[made] + score[starts[made]], tokens[starts[made]] + 1
                opens = np.flatnonzero(np.diff(of[made], prepend=-1))
                run = np.repeat(np.arange(len(opens)), np.diff(opens, append=len(made)))
                n = np.where(sums == np.maximum.reduceat(sums, opens)[run], n, NONE)
                won = np.flatnonzero(n == np.minimum.reduceat(n, opens)[run])
                won = won[np.diff(run[won], prepend=-1) > 0]
                to = of[made[won]]
                better = (sums[won] > best[to]) | (sums[won] == best[to]) & (n[won] < fewest[to])
                won, to = won[better], to[better]
                best[to], fewest[to], by[to], source[to] = sums[won], n[won], states[made[won]], starts[made[won]]
            score[here], tokens[here], piece[here], origin[here] = best, fewest, by, source
            # next level's pairs: those alive, then the node itself
            count = np.bincount(of, minlength=len(parent))
            own, kept = np.cumsum(count) + np.arange(len(parent)), np.arange(len(of)) + of
            pairs = np.zeros((2, len(of) + len(parent)), np.int64)
            pairs[0, kept], pairs[1, kept], pairs[0, own] = starts, states, here
            (starts, states), first, many = pairs, own - count, count + 1
            base, total = total, total + len(parent)
        return ends, tokens, piece, origin

    def terminals(self, words: list[str]) -> Iterator[tuple[str, int]]:
        """(pre-token, token count) of distinct pre-tokens."""
        yield from ((word, tokens) for word, tokens, _ in self._walk([w for w in words if len(w) > LONG]))
        short = sorted(w for w in words if len(w) <= LONG)
        for i in range(0, len(short), BLOCK):
            ends, tokens, _, _ = self._trie(short[i: i + BLOCK])
            yield from zip(short[i: i + BLOCK], tokens[ends].tolist())

    def piece_counts(self, words: dict[str, int]) -> Counter[str]:
        """How often each piece is in the best segmentations of pre-tokens that are there so many times."""
        counts: Counter[str] = Counter()
        for word, _, begin in self._walk([w for w in words if len(w) > LONG]):
            end = len(word)
            while end:
                piece, end = word[begin[end]:end], begin[end]
                if piece in self.scores:
                    counts[piece] += words[word]
        short = sorted(w for w in words if len(w) <= LONG)
        used = np.zeros(len(self.names), np.int64)
        for i in range(0, len(short), BLOCK):
            block = short[i: i + BLOCK]
            at, _, piece, origin = self._trie(block)
            n = np.array([words[w] for w in block], np.int64)
            while len(at):
                np.add.at(used, piece[at], n)
                at = origin[at]
                at, n = at[at > 0], n[at > 0]
        counts.update({self.names[i]: int(used[i]) for i in np.flatnonzero(used) if i})
        return counts


def pretoken_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """word, n: how often each word is in all texts. Tasks add up before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n: Counter[str] = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                n.update((text or "").split())
                if len(n) > MEMO_WORDS:
                    yield pa.RecordBatch.from_arrays([pa.array(n.keys(), pa.string()), pa.array(n.values(), pa.int64())], ["word", "n"])
                    n.clear()
        yield pa.RecordBatch.from_arrays([pa.array(n.keys(), pa.string()), pa.array(n.values(), pa.int64())], ["word", "n"])

    return docs.select(F.col(text).alias("text")).mapInArrow(count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def fit_unigram(docs: DataFrame, vocabulary: str, text: str = "text", rounds: int = ROUNDS) -> Unigram:
    """Piece scores from all texts of docs, by rounds of Viterbi training over their distinct pre-tokens.

    Each round takes the best segmentations under the scores so far, adds up how often each piece is used, and scores pieces by
    these sums. The driver gets one sum per piece of the vocabulary. Without texts all pieces score alike.
    """
    spark = docs.sparkSession
    model = Unigram.from_sentencepiece(vocabulary)
    # neighbours share their beginnings
    words = stored(pretoken_counts(docs, text).sortWithinPartitions("word"), "pre-tokens") if rounds else None
    for _ in range(rounds):
        words_model = sent(spark, model)

        def use(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            model, counts = words_model(), Counter()
            for batch in batches:
                found = zip(*(c.to_pylist() for c in batch.columns))
                counts.update(model.piece_counts({MARK + word: n for word, n in found}))
            yield pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], ["piece", "n"])

        used = words.mapInArrow(use, "piece string, n bigint").groupBy("piece").agg(F.sum("n").alias("n"))
        model = model.refitted({r["piece"]: r["n"] for r in used.collect()})
    return model


def token_counts(docs: DataFrame, vocabulary: str, doc_id: str = "doc_id", text: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """doc_id, n_words, n_tokens of every whole text, one row per row of docs, under scores that these texts give to the pieces.

    Words are what white space separates. Null and empty texts have no words and no tokens; null and repeated ids
    stay as they are; other columns are left out; an empty table gives no rows. ``vocabulary`` is the path of a
    sentencepiece file that the driver has; nothing is trained but its pieces' scores.
    """
    kind = docs.schema[doc_id].dataType.simpleString()
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    model_of_task = sent(docs.sparkSession, fit_unigram(docs, vocabulary, text, rounds))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = model_of_task()
        memo: dict[str, int] = {}
        for batch in batches:
            words, tokens = [], []
            for first in range(0, batch.num_rows, GROUP):
                lists = [(t or "").split() for t in batch.column(1).slice(first, GROUP).to_pylist()]
                if len(memo) > MEMO_WORDS:
                    memo.clear()
                new: set[str] = set()
                for words_of_text in lists:
                    new.update(set(words_of_text).difference(memo))
                memo.update((w[1:], n) for w, n in model.terminals([MARK + w for w in new]))
                words += map(len, lists)
                tokens += [sum(map(memo.__getitem__, w)) for w in lists]
            out = [batch.column(0), pa.array(words, pa.int64()), pa.array(tokens, pa.int64())]
            yield pa.RecordBatch.from_arrays(out, ["doc_id", "n_words", "n_tokens"])

    return rows.mapInArrow(count, f"doc_id {kind}, n_words bigint, n_tokens bigint")
