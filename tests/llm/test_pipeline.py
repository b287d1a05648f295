"""The pipeline over a small folder against a plain stage-by-stage version.

Which documents are good is taken from the operator's own scores; all later stages are plain.
"""

import re

import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")

from test_operators import PIECE, plain_spans, prose  # noqa: E402

import corpus_pipeline  # noqa: E402
from storeledger.llm import pii_boosting, quality_crf, unigram  # noqa: E402


def shingle_set(text):
    words = re.findall(r"[^\x20\x09-\x0d]+", text or "")
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def alike(a, b):
    return len(a & b) >= 0.8 * len(a | b)


def plain(rows, good, items):
    """Ids, texts and piece ids that are left of ``rows``, by id."""
    kept = []
    for row in sorted((r for r in rows if r in good), key=lambda r: r[0]):
        if not any(alike(shingle_set(row[1]), shingle_set(other[1])) for other in kept):
            kept.append(row)
    held = [{s for s in shingle_set(text.lower())} for text in items]
    kept = [(i, t) for i, t in kept if not any(len(shingle_set((t or "").lower()) & x) >= 0.8 * len(x) for x in held)]
    clean = [(i, t and pii_boosting.redact(t, plain_spans(t))) for i, t in kept]
    model = unigram.public_model(PIECE)
    return [(i, t, list(model.viterbi(unigram.MARK + t.replace(" ", unigram.MARK))[0]) if t else []) for i, t in clean]


def test_run(spark, folder):
    good = [(k, "\n".join(prose(1000 + 7 * k + j, 40).capitalize() + "." for j in range(1 + k % 4))) for k in range(100)]
    bad = [(500 + k, "\n".join(" | ".join(prose(9000 + k, 12).upper().split()) + " !!" for _ in range(1 + k % 3))) for k in range(100)]
    passage = prose(77, 30)
    rows = good + bad + [
        (200, good[3][1]), (201, good[7][1] + " one more"), (202, f"{good[5][1]}\n{passage.capitalize()}.\n{prose(78, 40).capitalize()}."),
        (203, f"{prose(79, 40).capitalize()} ask ann@example.org or 10.20.30.40 for it.\n{prose(80, 40).capitalize()}."), (204, None), (205, ""),
    ]
    docs = spark.createDataFrame([(i, t, "k", len(t or "")) for i, t in rows], "doc_id long, text string, ids string, n_chars long")
    labels = spark.createDataFrame([(i, 1, 0) for i, _ in good] + [(i, 0, 0) for i, _ in bad], "doc_id long, quality int, toxic int")
    items = [passage.upper(), prose(81, 30)]
    benchmark = spark.createDataFrame([(k, t) for k, t in enumerate(items)], "item_id long, text string")
    for name, table in (("documents", docs), ("labels", labels), ("benchmark", benchmark)):
        table.write.parquet(f"{folder}/{name}.parquet")
    scores = quality_crf.quality_scores(docs, quality_crf.fit(docs, labels), "quality_score")
    passed = {(r.doc_id, r.text) for r in scores.where("quality_score >= 0.5").collect()}
    want = plain(rows, passed, items)
    assert {203} <= {i for i, _, _ in want} and not {200, 201, 202} & {i for i, _, _ in want}

    out = corpus_pipeline.run(spark, folder)
    assert out.columns == [*docs.columns, "ids_", "decoded"]
    got = sorted(out.collect(), key=lambda r: r.doc_id)
    assert [(r.doc_id, r.text) for r in got] == [(i, t) for i, t, _ in want]
    # paths of the same pieces in another order have equal scores
    assert [sorted(r.ids_) for r in got] == [sorted(ids) for _, _, ids in want]
    assert all(r.ids == "k" and r.n_chars == len(r.text or "") and r.decoded == (r.text or "") for r in got)
    assert corpus_pipeline.STAGES[-1][1](spark, docs.limit(0), folder).isEmpty()
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "near_copies", "benchmark_passages", "personal_data", "pieces"]
