import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from logtables.llm import repeats


def brute(rows, length):
    """Bytes under strings that start at two places, by a table of all strings."""
    data = [(t or "").encode() for _, t in rows]
    seen = Counter(d[i: i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for (i, _), d in zip(rows, data):
        gone = bytearray(len(d))
        for at in range(len(d) - length + 1):
            if seen[d[at: at + length]] > 1:
                gone[at: at + length] = b"\1" * length
        runs = sum(1 for k, g in enumerate(gone) if g and (not k or not gone[k - 1]))
        kept = bytes(c for c, g in zip(d, gone) if not g)
        out.append((i, len(d), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=lambda r: (r[0] is None, r))


def results(frame):
    rows = frame.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    return sorted((tuple(r) for r in rows), key=lambda r: (r[0] is None, r))


def texts_of(kind, seed):
    rng = random.Random(seed)
    letters = {"few": "ab", "wide": "aé😀 ", "plain": "abcdefghijkl "}[kind]
    word = lambda n: "".join(rng.choice(letters) for _ in range(n))
    passages = [word(rng.randint(30, 200)) for _ in range(6)]
    out = []
    for i in range(60):
        parts = [rng.choice(passages) if rng.random() < 0.4 else word(rng.randint(0, 90)) for _ in range(rng.randint(0, 6))]
        if rng.random() < 0.3:
            a = rng.choice(passages)
            parts.append(a[rng.randint(0, 20):len(a) - rng.randint(0, 20)])
        out.append((i, "".join(parts)))
    out += [(100 + i, t) for i, (_, t) in enumerate(out[:8])]                       # copies
    out += [(200 + i, t[:40] + "Q" + t[41:]) for i, (_, t) in enumerate(out[:20])]  # near copies
    return out + [(300, None), (301, ""), (302, "x" * 300), (303, "ab" * 200), (304, "xyz" * 150), (305, "x" * 299 + "y")]


@pytest.mark.parametrize("kind,length", [("plain", 40), ("wide", 40), ("few", 40), ("plain", 64), ("plain", 17), ("wide", 101)])
def test_equals_a_table_of_all_strings(spark, docs, monkeypatch, kind, length):
    # small buckets, sections and parts, so that all boundaries are met
    monkeypatch.setattr(repeats, "BUCKET", 40)
    monkeypatch.setattr(repeats, "SECTION", 256)
    monkeypatch.setattr(repeats, "SMALL", 8)
    rows = texts_of(kind, length)
    assert results(repeats.repeated_spans(docs(rows), length)) == brute(rows, length)


def test_large_group_of_near_copies_and_a_shared_passage(spark, docs, monkeypatch):
    monkeypatch.setattr(repeats, "BUCKET", 500)
    rng = random.Random(3)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(120))
    rows = [(i, f"{rng.random()} {passage} {rng.random()}") for i in range(400)]
    rows += [(1000 + i, passage[:60] + chr(97 + i % 20) + passage[60:] + str(i % 7)) for i in range(200)]
    assert results(repeats.repeated_spans(docs(rows), 48)) == brute(rows, 48)


def test_repeated_and_null_ids_and_no_rows(spark, docs):
    text = "one text that is long enough to be removed"
    rows = [(1, text), (1, text), (None, text), (None, "short"), (2, "other " + text[:20]), (2, "another text without any equal string")]
    assert results(repeats.repeated_spans(docs(rows), 32)) == brute(rows, 32)
    assert repeats.repeated_spans(docs([]), 32).count() == 0
    assert repeats.repeated_spans(docs([(1, None)]), 32).first().n_removed == 0


def test_texts_without_their_spans(spark, docs):
    rows = texts_of("wide", 9)
    left = repeats.remove_repeats(docs(rows), 40)
    assert left.columns == docs(rows).columns
    expected = {i: k for i, _, _, _, k in brute(rows, 40)}
    got = left.collect()
    assert len(got) == len(rows)
    assert {r.doc_id: hashlib.sha256(bytes(r.text)).hexdigest() for r in got} == expected


@pytest.mark.parametrize("n", [0, 1, 3000])
def test_multikey_quicksort(monkeypatch, n):
    monkeypatch.setattr(repeats, "SMALL", 16)
    rng = np.random.default_rng(n)
    tokens = rng.integers(0, 4, (n, 3)).astype("u8") * np.uint64(1 << 62)
    order = repeats.multikey_quicksort(tokens)
    assert [tuple(r) for r in tokens[order].tolist()] == sorted(tuple(r) for r in tokens.tolist())
