import hashlib
import math

import numpy as np
import pytest

from logtables.llm import codes


def brute(rows, parts=4, entries=256, rounds=4):
    """The same with plain loops over Python's integers."""
    kept = [(i, [math.floor(1024 * float(x)) for x in v], g) for i, v, g in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = -(-max(len(v) for _, v, _ in kept) // parts)
    cut = [[(v + [0] * (parts * width - len(v)))[p * width:(p + 1) * width] for p in range(parts)] for _, v, _ in kept]
    order = sorted(range(len(kept)), key=lambda k: (kept[k][0] is None, kept[k][0] or 0, kept[k][1]))[:entries]
    books = [[cut[k][p] for k in order] for p in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), k) for k, c in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            of = [nearest(x[p], books[p])[1] for x in cut]
            for k in set(of):
                own = [x[p] for x, o in zip(cut, of) if o == k]
                books[p][k] = [sum(c) // len(own) for c in zip(*own)]
    found = [[nearest(x[p], books[p]) for p in range(parts)] for x in cut]
    digest = hashlib.sha256(",".join(str(c) for book in books for e in book for c in e).encode()).hexdigest()
    errors = [sum(d for d, _ in f) for f in found]
    by_label = {}
    for (_, _, g), e in zip(kept, errors):
        by_label[g] = by_label.get(g, 0) + e
    return [(i, "".join(f"{k:02x}" for _, k in f), e, by_label[g], digest) for (i, _, g), f, e in zip(kept, found, errors)]


def key(row):
    return (row[0] is None, row)


@pytest.mark.parametrize("case", ["normal", "ties", "huge", "few", "ragged", "repeated", "one"])
def test_codes(spark, case):
    rng = np.random.default_rng(6)
    n, dim = {"few": (20, 4), "one": (1, 4)}.get(case, (400, 8))
    x = rng.normal(0, 0.02 if case == "normal" else 0.3, (n, dim))
    if case == "ties":
        x = np.round(x * 4) / 1024
    if case == "huge":
        x[::5] *= 1e6
    rows = [(i, [float(np.float32(c)) for c in (v[: 1 + i % dim] if case == "ragged" else v)], None if i % 4 == 0 else i % 4) for i, v in enumerate(x)]
    rows += [(-1, None, 1), (-2, [None, 1.0], 1), (-3, [float("nan")] * dim, 1), (-4, [float("inf")] * dim, 1)]
    if case == "repeated":
        rows += rows[:20] * 3 + [(5, [0.1] * dim, 2), (None, [0.2] * dim, 2)]
    entries = 24 if case != "few" else 256
    table = spark.createDataFrame([(*r, "x", 0) for r in rows], "vec_id bigint, embedding array<float>, label int, code string, error bigint")
    found = codes.quantise(table.repartition(3), entries=entries)
    assert found.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256", "label"]
    assert sorted((tuple(r)[:5] for r in found.collect()), key=key) == sorted(brute(rows, entries=entries), key=key)


def test_nothing(spark):
    table = spark.createDataFrame([(1, None, 1)], "vec_id bigint, embedding array<float>, label int")
    assert codes.quantise(table).count() == 0
    assert codes.quantise(table.limit(0)).count() == 0


def test_bounds_hold_and_spare_groups(monkeypatch):
    """Every bound stays under the distance to all other entries of its group, and later rounds scan less."""
    rng = np.random.default_rng(7)
    x = np.round(rng.normal(0, 400, (60, 6)))[rng.integers(0, 60, 500)] + rng.integers(-9, 10, (500, 6)).astype("f8")
    history = [x[None, :64].copy()]
    state, shares = (None, None, None), []
    for _ in range(5):
        *state, error, scanned = codes.assign(x, history, 0, *state)
        shares.append(scanned.mean())
        full = codes.squares(x, history[-1][0])
        assert (state[0] == full.argmin(axis=1)).all() and (error == full.min(axis=1)).all()
        full[np.arange(len(x)), state[0]] = np.inf
        true = np.sqrt(full.reshape(len(x), -1, codes.GROUP).min(axis=2))
        assert (state[1] - codes.displacements(history, 0)[state[2], np.arange(4)[None, :]] <= true).all()
        total = codes.Sums(1, 64, 6)
        total.add(0, state[0], x)
        latest = history[-1].copy()
        for k in np.flatnonzero(total.counts[0]):
            latest[0, k] = [int(s) // int(total.counts[0, k]) for s in total.sums[0, k]]
        history.append(latest)
    assert shares[0] == 1 and shares[-1] < 0.5
