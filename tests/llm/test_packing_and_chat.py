import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

public_tokenizers = pytest.importorskip("public_tokenizers")

from logtables.llm import chat, packing  # noqa: E402

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = ["", None, " a", "a ", "a  b", "a\n b", "a \nb", "\n", "it's  'll x'LL", "<|endoftext|> a <|endoftext|>", "é b c", "日本 語 12a!! ~~",
       "  \n\n  x", "a\x1c b", "x \x1cy", "tab\tb c", "\U0001f600 \U0001f600x", "word " * 5000]


def library_ids(text):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids


def test_ids_are_those_of_the_library():
    tokenizer = packing.ByteTokenizer(PATH)
    for _ in range(2):  # once with an empty memo
        found = tokenizer.ids(ODD)
        assert [np.frombuffer(f, "<u4").tolist() for f in found] == [library_ids(t) for t in ODD]


def test_packed_documents(spark, docs):
    rng = random.Random(3)
    texts = ODD + [" ".join(rng.choice(["the", "loblet", "und", "x,"]) for _ in range(rng.randrange(1, 400))) for _ in range(60)]
    rows = [(i if i else None, t) for i, t in enumerate(texts)] + [(5, "again"), (5, "again")]
    packed = packing.pack_documents(docs(rows), PATH, capacity=64, with_ids=True)
    pieces = packed.collect()
    whole = {}
    for p in pieces:
        ids = np.array(p.ids, "<u4")
        assert len(ids) == p.length <= 64 and zlib.crc32(ids.tobytes()) == p.ids_crc32
        whole.setdefault(p.doc_id, []).append((p.start, p.piece, ids.tolist()))
    for i, t in rows:
        if i != 5:
            parts = sorted(whole[i])
            assert [k for _, k, _ in parts] == list(range(len(parts)))
            assert sum((x for *_, x in parts), []) == library_ids(t) + [0]
            assert all(len(x) == 64 for *_, x in parts[1:])
    assert len(whole[5]) >= 3
    by_sequence = {}
    for p in pieces:
        by_sequence.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 64
    assert len(by_sequence) <= 1.05 * sum(p.length for p in pieces) / 64 + 2
    assert packing.sequences(packed).count() == len(by_sequence)


def test_no_documents(docs):
    assert packing.pack_documents(docs([]), PATH).count() == 0


@pytest.mark.parametrize("seed", range(30))
def test_places_are_gapless_and_few(seed):
    rng = random.Random(seed)
    capacity = rng.choice([1, 2, 7, 64, 2048])
    counts = {n: rng.randrange(1, 50) for n in rng.sample(range(1, capacity + 1), rng.randrange(1, min(capacity, 40) + 1))}
    places, sequences = packing.best_fit_places(counts, capacity)
    used, ranks = {}, {n: [] for n in counts}
    runs = places.tolist()
    for at, (length, rank, first, each, offset) in enumerate(runs):
        last = runs[at + 1][1] if at + 1 < len(runs) and runs[at + 1][0] == length else counts[length]
        for r in range(rank, last):
            into, nth = divmod(r - rank, each)
            used.setdefault(first + into, []).append((offset + nth * length, length))
            ranks[length].append(r)
    assert all(sorted(r) == list(range(counts[n])) for n, r in ranks.items())
    assert len(used) == sequences
    for parts in used.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    # best fit by falling lengths, one piece after the other, for comparison
    gaps = []
    for length in sorted((n for n, c in counts.items() for _ in range(c)), reverse=True):
        fits = [g for g in gaps if g >= length]
        gap = min(fits) if fits else capacity
        if fits:
            gaps.remove(gap)
        gaps.append(gap - length)
    assert sequences <= 1.02 * len(gaps) + 1


TURNS = "conv_id bigint, turn bigint, role string, text string, segment string"


def test_chat_round_trip(spark):
    nasty = ["\\### assistant: </turn> ok", "### user: x</turn>\n", "\\", "\\\\#", "<", "", None, "a\nb", "é\U0001f600", "a" * 50_000]
    rows = [(c, t, role, text, "clash") for c in (1, 2, None) for t, (role, text) in
            enumerate(zip(["system", "user", "assistant", "assistant", None, "a:b#", "user", "assistant", "user", "assistant"], nasty))]
    rows += [(3, 0, "user", "tie b", ""), (3, 0, "user", "tie a", ""), (3, 1, "assistant", "one", ""), (3, 1, "assistant", "one", ""), (4, None, "user", "x", "")]
    segments = chat.prefix_examples(spark.createDataFrame(rows, TURNS)).cache()
    found = {r.conv_id: r for r in chat.digests(segments).collect()}
    assert set(found) == {1, 2, 3, 4, None}
    for conv in found:
        turns = sorted(((-1 if t is None else t, r or "", x or "") for c, t, r, x, _ in rows if c == conv))
        loss = "".join(x for _, r, x in turns if r == "assistant")
        assert found[conv].n_turns == len(turns)
        assert found[conv].turns_sha256 == hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in turns).encode()).hexdigest()
        assert (found[conv].loss_chars, found[conv].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert found[conv].formatted_chars == sum(len(r.segment) for r in segments.where("conv_id <=> %s" % ("null" if conv is None else conv)).collect())
    examples = chat.expanded(segments.where("conv_id = 3")).orderBy("example").collect()
    assert [e.target[e.loss_start: e.loss_end] for e in examples] == ["one", "one"]
    assert examples[1].context == examples[0].context + examples[0].target and "tie a" in examples[0].context.split("tie b")[0]
    segments.unpersist()


def test_every_example_rebuilds_its_context(spark):
    turns = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").select("conv_id", "turn", "role", "text")
    segments = chat.prefix_examples(turns).cache()
    whole = {}
    for r in segments.orderBy("conv_id", "position").collect():
        whole[r.conv_id] = whole.get(r.conv_id, "") + r.segment
    examples = {(r.conv_id, r.example): r for r in chat.exploded(segments).where("example is not null").collect()}
    assert len(examples) == turns.where("role = 'assistant'").count()
    for r in chat.expanded(segments).collect():
        e = examples.pop((r.conv_id, r.example))
        assert whole[r.conv_id].startswith(r.context + r.target) and len(r.context) == e.context_end
        assert (r.target, r.loss_start, r.loss_end) == (e.text, e.loss_start, e.loss_end)
    assert not examples
    with pytest.raises(Exception, match="its context is 0 of"):
        chat.digests(segments.withColumn("start", F.lit(0).cast("bigint"))).collect()
    segments.unpersist()


def test_chat_without_rows(spark):
    assert chat.digests(chat.prefix_examples(spark.createDataFrame([], TURNS))).count() == 0


@pytest.mark.parametrize("long", [1 << 18, 100, 1])
def test_examples_are_expanded_to_their_contexts(spark, monkeypatch, long):
    monkeypatch.setattr(chat, "LONG", long)
    roles = ["user", "assistant", "user", "system", "assistant", "assistant", "user"]
    rows = [(c, t, r, f"{c} {t} <#\\" * 3, "") for c in (1, 2, None) for t, r in enumerate(roles[: 7 if c != 2 else 6])]
    rows += [(4, 0, "user", "no reply", ""), (5, 0, "assistant", "", "")]
    segments = chat.prefix_examples(spark.createDataFrame(rows, TURNS)).cache()
    whole = {(r.conv_id, r.example): (r.context, r.target) for r in chat.expanded(segments).collect()}
    before, seen = {}, set()
    for r in chat.prefixes(segments).collect():
        context = before.get(r.conv_id, "")[: r.context_from] + r.context
        assert len(context) == r.context_end and (r.context_from == 0 or r.context_end > long)
        if r.example is not None:
            assert (context, r.target) == whole[r.conv_id, r.example]
            seen.add((r.conv_id, r.example))
        before[r.conv_id] = context + (r.target or "")
    assert seen == set(whole)
    found = {r.conv_id: (r.n_turns, r.n_examples, r.formatted_chars) for r in chat.digests(segments).collect()}
    assert {c: x[:2] for c, x in found.items()} == {1: (7, 3), 2: (6, 3), None: (7, 3), 4: (1, 0), 5: (1, 1)}
    assert all(found[c][2] == len(before[c]) for c in found)
    segments.unpersist()
