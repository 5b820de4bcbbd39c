import random
import re

import numpy as np
import pytest

from logtables.llm import components, minhash, topk


# ---------------------------------------------------------------- top-k
def brute_top(rows, k):
    kept = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            kept.setdefault(i, [int(np.floor(256 * float(x))) for x in v])
    out = []
    for q in kept:
        if q % 5 == 0:
            scored = sorted((-sum(a * b for a, b in zip(kept[q], v)), i) for i, v in kept.items() if i != q)[:k]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored)]
    return sorted(out)


@pytest.mark.parametrize("case", ["normal", "ties", "sparse", "large", "few", "ragged"])
def test_top_k(spark, case):
    rng = np.random.default_rng(4)
    n, dim = (4, 3) if case == "few" else (300, 16)
    x = rng.normal(0, 0.3, (n, dim))
    if case == "ties":
        x = np.round(x)
    if case == "sparse":
        x = np.where(rng.random((n, dim)) < 0.9, 0, x)
    if case == "large":
        x[::7] *= 1e6
        x[3] *= 1e4
    rows = [(i, [float(np.float32(c)) for c in (v[: 1 + i % dim] if case == "ragged" else v)]) for i, v in enumerate(x)]
    rows += [(1000, None), (1005, [None, 1.0]), (1010, [float("nan")] * dim), (1015, [float("inf")] * dim), (None, [1.0] * dim)]
    if case != "few":
        rows += [(1020, []), (1025, [0.0] * dim)]
    table = spark.createDataFrame([(i, v, 0, 0) for i, v in rows], "vec_id bigint, embedding array<float>, rank int, score bigint")
    found = topk.top_k(table, table.where("vec_id % 5 = 0"), 5, shard=64, block=16)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(tuple(r) for r in found.collect()) == brute_top(rows, 5)


def test_top_k_of_nothing(spark):
    table = spark.createDataFrame([], "vec_id bigint, embedding array<float>")
    assert topk.top_k(table, table).count() == 0


# ---------------------------------------------------------------- near duplicates
def sets_of(text, size):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", lower)
    n = min(size, len(w))
    return {tuple(w[i: i + n]) for i in range(len(w) - n + 1)} if w else set()


def brute_components(rows, size, percent):
    sets = {i: sets_of(t, size) for i, t in rows}
    up = {i: i for i in sets}
    ids = sorted(sets)
    changed = True
    links = [(a, b) for a in ids for b in ids if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    while changed:
        changed = False
        for a, b in links:
            low = min(up[a], up[b])
            if (up[a], up[b]) != (low, low):
                up[a] = up[b] = low
                changed = True
    return {i: (len(sets[i]), up[i], up[i] == i) for i in ids}


@pytest.mark.parametrize("size, percent, block", [(3, 85, 512), (5, 80, 512), (3, 85, 3)])
def test_near_duplicates_equal_brute_force(spark, docs, size, percent, block):
    rng = random.Random(9)
    vocabulary = [f"w{i}" for i in range(300)]
    base = [[rng.choice(vocabulary) for _ in range(rng.choice([1, 2, 8, 40, 150, 400]))] for _ in range(30)]
    texts = []
    for words in base:
        for _ in range(8):
            copy = list(words)
            for _ in range(rng.randrange(0, 1 + len(words) // 12)):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            texts.append(rng.choice([" ", "\n", "\t "]).join(copy).replace("w1", rng.choice(["w1", "W1"])))
    rng.shuffle(texts)
    rows = list(enumerate(texts)) + [(900, None), (901, ""), (902, " \n"), (903, "one"), (904, "ONE"), (905, "x " * 30_000), (906, "x " * 30_001)]
    found = minhash.near_duplicates(docs(rows), size, percent, block=block)
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in found.collect()} == brute_components(rows, size, percent)


def test_repeated_and_missing_ids(spark, docs):
    rows = docs([(None, "a b c d e f"), (None, "a b c d e f"), (1, "a b c d e f"), (2, "A B c d e f"), (2, "A B c d e f"), (3, "z"), (3, "z"), (4, None)])
    found = sorted((str(r.doc_id), r.component_id, r.kept) for r in minhash.near_duplicates(rows).collect())
    assert found == [("1", 1, True), ("2", 1, False), ("2", 1, False), ("3", 3, True), ("3", 3, True), ("4", 4, True), ("None", None, False), ("None", None, False)]
    kept = minhash.drop_near_duplicates(rows)
    assert kept.columns == rows.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "3", "4", "None", "None"]
    assert minhash.drop_near_duplicates(docs([])).count() == 0


def test_index_meets_all_pairs_within_the_distance():
    rng = np.random.default_rng(1)
    for percent in (80, 85):
        chunks = minhash.chunks_for(percent)
        for _ in range(300):
            a = rng.integers(0, 2**16, minhash.VALUES).astype("u2")
            b = a.copy()
            at = rng.choice(minhash.VALUES, 2 * chunks - 1, replace=False)
            b[at] ^= 1
            x, y = minhash.chunk_keys(np.array([a, b]), chunks)
            assert np.intersect1d(x, y).size


def test_components(spark):
    rng = random.Random(6)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 40)] + [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(45)]
    edges += [(7, 7), (1, 0), (0, 1)]
    found = {r.node: r.component for r in components.connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    up = {n: n for e in edges for n in e if e[0] != e[1]}
    for _ in range(100):
        for a, b in edges:
            up[a] = up[b] = min(up[a], up[b])
    assert found == {n: c for n, c in up.items()}


def test_large_group_of_near_copies(spark, docs):
    """Most of a group is one tree; what is outside of it is compared with all of it, through several blocks."""
    rng = random.Random(11)
    base = [f"w{rng.randrange(400)}" for _ in range(120)]
    rows = []
    for i in range(450):
        copy = list(base)
        for _ in range(rng.choice([0, 1, 1, 2, 2, 3, 5, 7])):
            copy[rng.randrange(120)] = f"v{rng.randrange(10_000)}"
        rows.append((i, " ".join(copy)))
    found = minhash.near_duplicates(docs(rows), 3, 85, block=40)
    expected = brute_components(rows, 3, 85)
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in found.collect()} == expected
    assert len({c for _, c, _ in expected.values()}) > 20
