"""Quality classifier by attention-based multiple-instance learning.

A document is a bag of passages of a hundred words, and only the bag has a label. Every passage of the whole text is
encoded; gated attention weighs the passages; the weighted mean of their codes is scored. Encoder, attention and
score are learned together from document labels, on a bounded sample. Every text is scored by itself.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logtables.llm.common import filter_texts, sent, stored
from logtables.llm.toxicity import bounded_sample

PASSAGE = 100
#: Documents to learn from, at most, and passages of all of them together (33 MB). Texts are taken whole.
SAMPLE = 4_000
PASSAGES = 200_000
GROUP = 400
_PUNCTUATION = [b for b in range(33, 127) if not chr(b).isalnum()]


def _channels() -> np.ndarray:
    """Which of the counted kinds a byte belongs to: small and capital letters, digits, beyond ASCII, each mark, control."""
    table = np.zeros((256, 5 + len(_PUNCTUATION)), "f4")
    for b in range(256):
        kind = 0 if 97 <= b <= 122 else 1 if 65 <= b <= 90 else 2 if 48 <= b <= 57 else 3 if b >= 128 else 4 if b < 32 or b == 127 else None
        if kind is not None:
            table[b, kind] = 1
        elif b in _PUNCTUATION:
            table[b, 5 + _PUNCTUATION.index(b)] = 1
    return table


CHANNELS = _channels()
WIDTH = CHANNELS.shape[1] + 4


def passages(text: str | None) -> np.ndarray:
    """One row of features per passage; null, empty and blank texts have one row of zeros."""
    words = text.split() if text else []
    if not words:
        return np.zeros((1, WIDTH), "f4")
    data = np.frombuffer(" ".join(words).encode("utf-8", "surrogatepass"), "u1")
    n = -(-len(words) // PASSAGE)
    of = np.cumsum(data == 32) // PASSAGE
    counts = np.bincount(of * 256 + data, minlength=256 * n).reshape(n, 256).astype("f4")
    size = counts.sum(axis=1, keepdims=True)
    parts = [words[i: i + PASSAGE] for i in range(0, len(words), PASSAGE)]
    shape = np.array([[len(set(p)) / len(p), np.log1p(len(p)), sum(map(str.isupper, p)) / len(p), 1.0] for p in parts], "f4")
    shape[:, 3] = np.minimum(size[:, 0] / shape[:, 1].clip(1e-3), 1000) / 100
    return np.hstack([np.sqrt(counts @ CHANNELS / size), shape])


class AttentionMIL:
    """tanh encoder, gated attention, logistic score; weights in ``w``."""

    def __init__(self, width: int, codes: int = 24, gates: int = 12, seed: int = 7):
        random = np.random.default_rng(seed)
        shapes = {"E": (width, codes), "e": (codes,), "V": (codes, gates), "U": (codes, gates), "a": (gates,), "c": (codes,), "b": ()}
        self.w = {k: random.normal(0, 1 / np.sqrt(s[0]) if s else 0, s) for k, s in shapes.items()}
        self.mean, self.spread = np.zeros(width), np.ones(width)

    def forward(self, x: np.ndarray, starts: np.ndarray, bag: np.ndarray):
        w = self.w
        h = np.tanh(((x - self.mean) / self.spread) @ w["E"] + w["e"])
        t, g = np.tanh(h @ w["V"]), 1 / (1 + np.exp(-np.clip(h @ w["U"], -40, 40)))
        s = (t * g) @ w["a"]
        s = np.exp(s - np.maximum.reduceat(s, starts)[bag])
        a = s / np.add.reduceat(s, starts)[bag]
        z = np.add.reduceat(a[:, None] * h, starts)
        p = 1 / (1 + np.exp(-np.clip(z @ w["c"] + w["b"], -40, 40)))
        return h, t, g, a, z, p

    def slopes(self, x: np.ndarray, starts: np.ndarray, bag: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        """Derivatives of the mean log loss by each weight."""
        w, scaled = self.w, (x - self.mean) / self.spread
        h, t, g, a, z, p = self.forward(x, starts, bag)
        dz_out = (p - y) / len(y)
        dz = dz_out[:, None] * w["c"]
        da = (dz[bag] * h).sum(axis=1)
        ds = a * (da - np.add.reduceat(a * da, starts)[bag])
        dt, dg = ds[:, None] * w["a"] * g * (1 - t * t), ds[:, None] * w["a"] * t * g * (1 - g)
        dh = (a[:, None] * dz[bag] + dt @ w["V"].T + dg @ w["U"].T) * (1 - h * h)
        return {"E": scaled.T @ dh, "e": dh.sum(axis=0), "V": h.T @ dt, "U": h.T @ dg, "a": (t * g).T @ ds, "c": z.T @ dz_out, "b": dz_out.sum()}

    def fit(self, bags: list[np.ndarray], y: np.ndarray, steps: int = 250, rate: float = 0.02, decay: float = 1e-4) -> None:
        """Full-batch steps of Adam on the mean log loss."""
        if not bags:
            return
        x = np.concatenate(bags).astype("f8")
        sizes = np.array([len(b) for b in bags])
        starts, bag = np.cumsum(sizes) - sizes, np.repeat(np.arange(len(bags)), sizes)
        self.mean, self.spread = x.mean(axis=0), x.std(axis=0) + 0.02
        m = {k: np.zeros_like(v) for k, v in self.w.items()}
        v = {k: np.zeros_like(u) for k, u in self.w.items()}
        for step in range(1, steps + 1):
            w = self.w
            for k, d in self.slopes(x, starts, bag, y).items():
                d = d + decay * w[k]
                m[k] = 0.9 * m[k] + 0.1 * d
                v[k] = 0.999 * v[k] + 0.001 * d * d
                w[k] = w[k] - rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)

    def score(self, texts: list[str | None]) -> np.ndarray:
        out = [np.zeros(0)]
        for i in range(0, len(texts), GROUP):
            bags = [passages(t) for t in texts[i: i + GROUP]]
            sizes = np.array([len(b) for b in bags])
            *_, p = self.forward(np.concatenate(bags), np.cumsum(sizes) - sizes, np.repeat(np.arange(len(bags)), sizes))
            out.append(p)
        return np.concatenate(out)


def fit_quality(docs: DataFrame, labels: DataFrame, learnable, label: str = "quality", rows: int = SAMPLE, doc_id: str = "doc_id",
                text: str = "text", most: int = PASSAGES) -> AttentionMIL:
    """Fit on at most ``rows`` labelled documents for which the column ``learnable`` of labels is true.

    They are whole texts of at most ``most`` passages together, taken in the order of a hash; a text that doesn't fit any more is passed over.
    Equal texts count once, with the largest label. Without labelled rows the model is as it starts.
    """
    sample = bounded_sample(labels, label, learnable, rows, doc_id)
    # the sample is at most ``rows`` ids, so it is sent to where the texts are
    chosen = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).join(F.broadcast(sample), "doc_id")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, text in enumerate(batch.column(2).to_pylist()):
                # a batch per text, as one may be long
                bag = passages(text)
                part = [batch.column(0).slice(i, 1), batch.column(1).slice(i, 1), pa.array([len(bag)], pa.int64()), pa.array([bag.tobytes()], pa.binary())]
                yield pa.RecordBatch.from_arrays(part, ["hash", "label", "n", "bag"])

    measured = chosen.select(F.xxhash64("text").alias("hash"), "label", "text").mapInArrow(encode, "hash bigint, label double, n bigint, bag binary")
    measured = stored(measured.groupBy("hash").agg(F.max("label").alias("label"), *(F.first(c).alias(c) for c in ("n", "bag"))), "quality-sample")
    fitting, total = [], 0
    for r in measured.select("hash", "n").orderBy("hash").collect():
        if total + r["n"] <= most:
            fitting.append((r["hash"],))
            total += r["n"]
    fitting = docs.sparkSession.createDataFrame(fitting, "hash bigint")
    found = measured.join(F.broadcast(fitting), "hash", "left_semi").orderBy("hash").collect()
    model = AttentionMIL(WIDTH)
    model.fit([np.frombuffer(r["bag"], "f4").reshape(-1, WIDTH) for r in found], np.array([r["label"] for r in found]))
    return model


def score_quality(docs: DataFrame, model: AttentionMIL, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and score (0 to 1) of every row; null and empty texts are bags of one passage of zeros."""
    model_of_task = sent(docs.sparkSession, model)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = model_of_task()
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.score(batch.column(1).to_pylist()))], ["doc_id", "score"])

    return rows.mapInArrow(score, f"doc_id {docs.schema[doc_id].dataType.simpleString()}, score double")


def keep_quality(docs: DataFrame, model: AttentionMIL, threshold: float = 0.7, text: str = "text") -> DataFrame:
    """The rows of docs that score at least the threshold, with all columns."""
    model_of_task = sent(docs.sparkSession, model)

    def verdict():
        model = model_of_task()
        return lambda texts: model.score(texts) >= threshold

    return filter_texts(docs, text, verdict)
