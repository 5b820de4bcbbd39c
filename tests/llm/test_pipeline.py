"""Every stage of the pipeline against a plain version, each on its own input, over the smallest tables."""

import pathlib

import pytest

pytest.importorskip("public_tokenizers")

import corpus_pipeline  # noqa: E402
from logtables.llm.common import stored, table  # noqa: E402
from test_pairs import brute_components  # noqa: E402
from test_texts import words  # noqa: E402

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not pathlib.Path(SF).exists(), reason="the test tables are not here")


def test_stages(spark):
    docs = table(spark, SF, "documents")
    labels = {r.doc_id: r for r in table(spark, SF, "labels").collect()}
    columns = docs.columns
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "quality classifier", "near dedup", "benchmark decontamination", "best-fit packing"
    ]
    inputs = {}
    for name, stage in corpus_pipeline.STAGES:
        inputs[name] = {r.doc_id: r.text for r in docs.collect()}
        docs = stored(stage(spark, docs, SF), "stage")
        if name != "best-fit packing":
            assert docs.columns == columns
    after = dict(zip(inputs, [*list(inputs.values())[1:], None]))

    def right(name, bad):
        judged = [(bad(labels[i]), i not in after[name]) for i in inputs[name] if i in labels]
        return sum(b == gone for b, gone in judged) / len(judged)

    assert right("toxicity", lambda r: r.toxic == 1) > 0.9
    assert right("quality classifier", lambda r: r.quality == 0) > 0.9
    expected = brute_components(list(inputs["near dedup"].items()), 5, 80)
    assert set(after["near dedup"]) == {i for i, (_, _, kept) in expected.items() if kept}
    windows = {}
    for item in table(spark, SF, "benchmark").collect():
        w = words(item.text)
        for i in range(max(1, len(w) - 12)):
            windows.setdefault(min(13, len(w)), set()).add(tuple(w[i: i + 13]))
    clean = set()
    for i, text in inputs["benchmark decontamination"].items():
        w, hit = words(text), set()
        for n, known in windows.items():
            for at in range(len(w) - n + 1):
                if n and tuple(w[at: at + n]) in known:
                    hit.update(range(at, at + n))
        if not hit or 20 * len(hit) < len(w):
            clean.add(i)
    assert set(after["benchmark decontamination"]) == clean
    pieces = docs.collect()
    assert {p.doc_id for p in pieces} == set(inputs["best-fit packing"])
    places = sorted((p.sequence_id, p.offset, p.length) for p in pieces)
    end = {}
    for sequence, offset, length in places:
        assert offset == end.get(sequence, 0)
        end[sequence] = offset + length
    assert max(end.values()) <= 2048
    assert len(end) <= sum(n for *_, n in places) / 2048 + 2


def test_no_documents(spark):
    docs = table(spark, SF, "documents").where("false")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.count() == 0
        if "text" not in docs.columns:
            break
