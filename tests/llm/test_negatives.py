import numpy as np
import pytest

from logtables.llm import negatives
from logtables.llm.negatives import ResidueMatrix, primes_for


def brute(rows, anchors, k=5, n=10, low=30, high=90):
    def ready(rows):
        good = [r for r in rows if None not in r and all(x is not None and np.isfinite(x) for x in r[1])]
        return [(i, [int(np.floor(256 * float(x))) for x in v], g) for i, v, g in good]

    rows, out = ready(rows), []
    asked = {(i, tuple(v), g) for i, v, g in ready(anchors)}
    for i, v, g in asked:
        scored = sorted((-sum(a * b for a, b in zip(v, w)), j, h) for j, w, h in rows)
        for s, p, _ in [x for x in scored if x[2] == g and x[1] != i][:k]:
            s = -s
            window = [x for x in scored if x[2] != g and low * s <= -100 * x[0] <= high * s][:n]
            out += [(i, p, r + 1, j, s, -t) for r, (t, j, _) in enumerate(window)]
    return sorted(out)


@pytest.mark.parametrize("case", ["normal", "ties", "large", "huge", "few", "ragged", "repeated", "one label"])
def test_hard_negatives(spark, case):
    rng = np.random.default_rng(5)
    n, dim = (6, 3) if case == "few" else (300, 80)
    x = rng.normal(0.05, 0.3, (n, dim))
    if case == "ties":
        x = np.round(x)
    if case == "large":
        x[::7] *= 3e3
    if case == "huge":
        x[::7] *= 1e6
        x[1] *= 1e7
    rows = [(i, [float(np.float32(c)) for c in (v[: 1 + i % dim] if case == "ragged" else v)], 1 if case == "one label" else i % 3) for i, v in enumerate(x)]
    rows += [(1000, None, 1), (1001, [None, 1.0], 1), (1002, [float("nan")], 1), (1003, [float("-inf")], 2), (None, [1.0], 2), (1004, [1.0], None), (1010, [], 1)]
    if case == "repeated":
        rows += rows[:30] + [(10, [0.5] * dim, 1), (7, [0.25] * dim, 2)]
    table = spark.createDataFrame([(*r, 0, 0) for r in rows], "vec_id bigint, embedding array<float>, label int, rank int, anchor bigint")
    found = negatives.hard_negatives(table, table.where("vec_id % 10 = 0"), shard=64, block=16)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    expected = brute(rows, [r for r in rows if r[0] is not None and r[0] % 10 == 0])
    assert sorted(tuple(r) for r in found.collect()) == expected
    assert bool(expected) == (case != "one label")


def test_nothing(spark):
    table = spark.createDataFrame([], "vec_id bigint, embedding array<float>, label int")
    assert negatives.hard_negatives(table, table).count() == 0


@pytest.mark.parametrize("most", [1, 1000, 10**9, 2**52])
def test_residues_give_exact_signed_scores(most):
    rng = np.random.default_rng(most % 97)
    dim, size = 200, int((most / 200) ** 0.5) + 1
    a, b = rng.integers(-size, size + 1, (70, dim)), rng.integers(-size, size + 1, (90, dim))
    primes = primes_for(size * size * dim)
    assert all(negatives.PIECE * (p // 2) ** 2 < 1 << 24 for p in primes) and len(set(primes)) == len(primes)
    assert (ResidueMatrix(a, primes).scores(ResidueMatrix(b, primes), slice(3, 50)) == a[3:50] @ b.T).all()
