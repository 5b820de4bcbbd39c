"""Toxicity: gradient-boosted trees over dense features, with isotonic calibration.

Features of a whole text: densities of lexicon words, given ones and those learned from labels, plain and disguised
(digits and marks for letters, letters spaced or repeated), how near they stand to a second person, capitals,
punctuation, and the rates of disguised spellings. Words are learned, trees fitted and scores calibrated on a bounded
sample of labelled rows: a text is measured with words that others taught, and the rows that calibrate are not those
that the trees are fitted to. Every text is scored by itself, in the task that reads it.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logtables.llm.boosting import BoostedTrees, Isotonic
from logtables.llm.common import filter_texts, sent, stored

#: Insults; pronouns of the second person in several languages.
LEXICON = frozenset(
    "idiot idiots moron morons stupid loser losers scum trash pathetic worthless disgusting clown clowns imbecile "
    "dumb fool fools garbage filth vermin hate kill ugly scumbag jerk bastard bitch whore slut crap shit fuck "
    "fucking asshole dumbass retard cretin dimwit dunce nitwit pig swine parasite creep pervert degenerate subhuman "
    "arschloch schwein dummkopf idioten trottel abschaum connard salope crétin imbécile ordure idiota estúpido "
    "estúpida imbécil basura mierda tonto asqueroso inútil".split()
)
SECOND = frozenset(
    "you your yours yourself u ur du dich dir dein deine ihr euch sie tu te toi ton ta tes vous votre vos tú ti usted "
    "ustedes vosotros tus su sus".split()
)
MARKS = ".,;:!?\"'()[]{}*&%#$~_-…“”«»¿¡"
INNER = re.compile(r"[^\W\d_][0-9@$!*+|._-]+[^\W\d_]")
SPACED = re.compile(r"(?<!\w)\w(?:[ .*_-]\w){2,20}(?!\w)")
LEET = str.maketrans("0134578@$!|+", "oieastbasilt")
REPEATS = re.compile(r"([^\W\d_])\1{2,}")
NAMES = ["lexicon_density", "hits", "learned_density", "learned_hits", "learned_weight", "disguised_hits", "near_second_person", "second_person",
         "capitals", "exclamations", "questions", "punctuation", "digits", "disguised_words", "repeats", "length"]
_CLASS = np.array([1 if 65 <= b <= 90 else 2 if 97 <= b <= 122 or b >= 128 else 3 if 48 <= b <= 57 else 4 if b == 33 else 5 if b == 63
                   else 6 if 33 <= b <= 126 else 0 for b in range(256)])
#: Rows of the labelled sample, at most. Every fourth of its texts calibrates.
SAMPLE = 20_000
#: Lengths of word beginnings that are learned beside whole words.
STEMS = (4, 5, 6)
LEARNED = 2_000
NEAR = 5


def stems_of(words: set[str]) -> set[str]:
    """Whole words, with a blank at the end, and beginnings of words, of the words without marks around them."""
    found = set()
    for word in words:
        word = word.strip(MARKS)
        if len(word) >= STEMS[0]:
            found.add(word + " ")
            found.update(word[:n] for n in STEMS if len(word) >= n)
    return found


def features(text: str | None, learned: dict[str, float]) -> list[float]:
    """Features of a whole text; null and empty ones have only zeros."""
    if not text:
        return [0.0] * len(NAMES)
    lower = text.lower()
    words = lower.split()
    fixed, taught = set(), {}
    know = learned.get
    there = set(words)
    for word in there:
        bare = word.strip(MARKS)
        if bare in LEXICON:
            fixed.add(word)
        if len(bare) >= 4:
            weight = know(bare + " ") or know(bare[:6]) or know(bare[:5]) or know(bare[:4])
            if weight:
                taught[word] = weight
    bad = fixed.union(taught)
    places = [i for i, w in enumerate(words) if w in bad] if bad else []
    hits = sum(words[i] in fixed for i in places)
    taught_hits = [taught[words[i]] for i in places if words[i] in taught]
    near = sum(any(w.strip(MARKS) in SECOND for w in words[max(0, i - NEAR): i + NEAR + 1]) for i in places)
    second = sum(map(words.count, there & SECOND)) if len(there & SECOND) < 6 else sum(w in SECOND for w in words)
    classes = np.bincount(_CLASS[np.frombuffer(text.encode("utf-8", "surrogatepass"), "u1")], minlength=7)
    letters = max(1, classes[1] + classes[2])
    disguised = odd = 0
    if INNER.search(lower):
        for word in words:
            if INNER.search(word):
                odd += 1
                core = word.strip(MARKS)
                plain = {re.sub(r"[\W\d_]", "", x) for x in (core, core.translate(LEET))}
                disguised += core not in LEXICON and not plain.isdisjoint(LEXICON)
    for m in SPACED.finditer(lower):
        disguised += re.sub(r"[\W_]", "", m[0]) in LEXICON
    repeats = 0
    if REPEATS.search(lower):
        for word in words:
            if REPEATS.search(word):
                repeats += 1
                disguised += REPEATS.sub(r"\1", word).strip(MARKS) in LEXICON
    n = max(1, len(words))
    return [hits / n, float(hits), len(taught_hits) / n, float(len(taught_hits)), max(taught_hits, default=0.0), float(disguised), near / n,
            second / n, classes[1] / letters, classes[4] / n, classes[5] / n, classes[6] / n, classes[3] / letters, odd / n, repeats / n,
            float(np.log1p(n))]


class ToxicityModel:
    """Learned words, boosted trees and their calibration."""

    def __init__(self, learned: dict[str, float], x: np.ndarray, y: np.ndarray, calibrates: np.ndarray):
        self.learned = learned
        self.trees = BoostedTrees(x[~calibrates], y[~calibrates])
        self.calibration = Isotonic(self.trees.margin(x[calibrates]), y[calibrates])

    def score(self, texts: list[str | None]) -> np.ndarray:
        if not texts:
            return np.zeros(0)
        x = np.array([features(t, self.learned) for t in texts])
        return np.clip(self.calibration.score(self.trees.margin(x)), 0, 1)


def bounded_sample(labels: DataFrame, label: str, learnable, rows: int, doc_id: str) -> DataFrame:
    """At most ``rows`` labelled ids, in the order of a hash: (doc_id, label, hash). Null labels and ids are left out."""
    kept = labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull() & learnable)
    kept = kept.groupBy(F.col(doc_id).alias("doc_id")).agg(F.max(label).cast("double").alias("label"))
    return kept.withColumn("hash", F.xxhash64("doc_id", F.lit(7))).orderBy("hash", "doc_id").limit(rows)


def learn_words(texts: DataFrame, size: int = LEARNED, least: int = 3, odds: float = 3.0) -> list[dict[str, float]]:
    """Words and beginnings of words that toxic texts have and others hardly, with their log-odds: at most ``size``.

    ``texts`` has text, label and fold (0 or 1). The result has what each fold teaches, and what both do together. A word
    counts once per text, and must be in at least ``least`` toxic ones and in one in 200.
    """
    names = ["toxic0", "toxic1", "other0", "other1"]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = {name: Counter() for name in names}
            for text, label, fold in zip(*(c.to_pylist() for c in batch.columns)):
                n[f"{'toxic' if label > 0 else 'other'}{fold}"].update(stems_of(set((text or "").lower().split())))
            stems = list(set().union(*n.values()))
            columns = [pa.array(stems, pa.string()), *(pa.array([n[name][s] for s in stems], pa.int64()) for name in names)]
            yield pa.RecordBatch.from_arrays(columns, ["stem", *names])

    toxic = F.col("label") > 0
    totals = texts.agg(*(
        F.count(F.when((toxic if name.startswith("toxic") else ~toxic) & (F.col("fold") == int(name[-1])), 1)).alias(name) for name in names
    )).first()
    counted = texts.select("text", "label", "fold").mapInArrow(count, "stem string, " + ", ".join(f"{n} bigint" for n in names))
    counted = counted.groupBy("stem").agg(*(F.sum(n).alias(n) for n in names)).where(F.col("toxic0") + F.col("toxic1") >= least)
    counted = stored(counted, "toxicity-words")
    taught = []
    for folds in ("0", "1", "01"):
        t, o = (sum((F.col(f"{kind}{f}") for f in folds), F.lit(0)) for kind in ("toxic", "other"))
        all_t, all_o = (sum(totals[f"{kind}{f}"] for f in folds) + 1 for kind in ("toxic", "other"))
        weight = F.log((t + 0.5) / F.lit(all_t)) - F.log((o + 0.5) / F.lit(all_o))
        best = counted.where(t >= max(least, all_t // 200)).select("stem", weight.alias("weight"), t.alias("t")).where(F.col("weight") >= odds)
        taught.append({r["stem"]: r["weight"] for r in best.orderBy(F.desc("t"), "stem").limit(size).collect()})
    return taught


def fit_toxicity(docs: DataFrame, labels: DataFrame, learnable, label: str = "toxic", rows: int = SAMPLE, doc_id: str = "doc_id",
                 text: str = "text") -> ToxicityModel:
    """Fit on at most ``rows`` labelled documents for which the column ``learnable`` of labels is true.

    Equal texts count once, with the largest label. The texts are dealt into two folds; those of one are measured with
    the words that the other teaches, and texts to come with the words of both. Without labelled rows the model is a
    constant.
    """
    sample = bounded_sample(labels, label, learnable, rows, doc_id)
    # the sample is at most ``rows`` ids, so it is sent to where the texts are
    chosen = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).join(F.broadcast(sample), "doc_id")
    chosen = chosen.groupBy(F.xxhash64("text").alias("hash")).agg(F.first("text").alias("text"), F.max("label").alias("label"))
    chosen = stored(chosen.withColumn("fold", F.pmod("hash", F.lit(2)).cast("int")), "toxicity-sample")
    taught = learn_words(chosen)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())
            x = pa.array([features(t, taught[1 - fold]) for t, fold in rows], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), x], ["hash", "label", "x"])

    measured = chosen.select("hash", "label", "text", "fold").mapInArrow(measure, "hash bigint, label double, x array<double>")
    found = measured.orderBy("hash").collect()
    x = np.array([r["x"] for r in found]).reshape(-1, len(NAMES))
    y = np.array([r["label"] for r in found])
    return ToxicityModel(taught[2], x, y, np.arange(len(y)) % 4 == 3)


def score_toxicity(docs: DataFrame, model: ToxicityModel, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and score (0 to 1) of every row; null and empty texts are scored as texts without words."""
    model_of_task = sent(docs.sparkSession, model)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = model_of_task()
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.score(batch.column(1).to_pylist()))], ["doc_id", "score"])

    return rows.mapInArrow(score, f"doc_id {docs.schema[doc_id].dataType.simpleString()}, score double")


def drop_toxic(docs: DataFrame, model: ToxicityModel, threshold: float = 0.5, text: str = "text") -> DataFrame:
    """The rows of docs that score under the threshold, with all columns."""
    model_of_task = sent(docs.sparkSession, model)

    def verdict():
        model = model_of_task()
        return lambda texts: model.score(texts) < threshold

    return filter_texts(docs, text, verdict)
