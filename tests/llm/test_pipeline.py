from collections import Counter

import pytest
import sentencepiece

import corpus_pipeline as cp
from tessera.llm import queries as q
from test_balance import targets
from test_line_runs import key
from test_simhash_pivots import brute as near_brute


@pytest.fixture(scope="module")
def stages(spark, sf, tmp_path_factory):
    """Rows before the first stage and after each stage, as the driver runs them."""
    d = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    extra = spark.createDataFrame([(10_001, None, "en", "src1", None), (10_002, "", None, "src1", 0), (10_003, "12 34 !!", "en", None, 8),
                                   (10_004, "An entirely new text stands here\n1", None, None, 34)], docs.schema)
    docs = docs.unionByName(extra)
    out = [docs.collect()]
    for i, (_, f) in enumerate(cp.STAGES):
        f(spark, docs, sf).write.parquet(str(d / str(i)))
        docs = spark.read.parquet(str(d / str(i)))
        out.append(docs.collect())
    return out


def test_language_stage_keeps_every_text_with_letters(stages):
    want = sorted(r.doc_id for r in stages[0] if r.text and any(c.isalpha() for c in r.text))
    assert sorted(r.doc_id for r in stages[1]) == want and tuple(stages[1][0].__fields__) == cp.COLUMNS


def test_line_stage(stages):
    first = {}
    for r in stages[1]:
        for x in r.text.split("\n"):
            first[key(x)] = min(first.get(key(x), r.doc_id), r.doc_id)
    want = {r.doc_id: "\n".join(x for x in r.text.split("\n") if len(key(x)) < 10 or first[key(x)] == r.doc_id) for r in stages[1]}
    assert {r.doc_id: r.text for r in stages[2]} == want and all(r.n_chars == len(r.text) for r in stages[2])


def test_near_copies_stage(stages):
    low = {low for _, _, low in near_brute([(r.doc_id, r.text) for r in stages[2]])}
    assert sorted(r.doc_id for r in stages[3]) == sorted(low)
    before = {r.doc_id: r for r in stages[2]}
    assert all(before[r.doc_id] == r for r in stages[3])


def test_mix_stage(stages):
    size, want = targets([(r.doc_id, r.text, r.source) for r in stages[3]])
    before, copies, taken = {r.doc_id: r for r in stages[3]}, Counter(), Counter()
    for r in stages[4]:
        assert before[r.doc_id] == r
        copies[r.doc_id] += 1
        taken[r.source] += len(r.text.encode().split())
    assert max(copies.values()) <= 3
    assert all(abs(taken[s] - want[s]) <= 0.1 * want[s] + 20 for s in size)


def test_encoding_stage(stages):
    sp = sentencepiece.SentencePieceProcessor(model_file=q.PIECE_MODEL)
    assert Counter((r.doc_id, len(sp.encode(r.text or "", add_eos=True))) for r in stages[4]) == Counter((r.doc_id, r.n_tokens) for r in stages[5])


def test_run_and_empty(spark, sf, docs_of, table_dir):
    assert cp.run(spark, sf).count() > 0
    assert cp.run(spark, table_dir(documents=docs_of([], extra=False))).collect() == []


def test_clashing_columns(spark, docs_of, sf):
    docs = docs_of([(1, "a text of some words\nand a line"), (2, "another text entirely\nand a line"), (3, None)])
    for _, f in cp.STAGES[:-1]:
        assert tuple(f(spark, docs, sf).columns) == cp.COLUMNS


def test_language_stage_with_nothing_to_learn_from(spark, docs_of, sf):
    texts = [(i, f"a clean text number {i}\nand a line") for i in range(8)] + [(20, None), (21, "12 34 !!"), (22, "")]
    for docs in (docs_of(texts), docs_of([(i, t, f"l{i}") for i, t in texts if i == 20] + texts),
                 docs_of([(1000 + i, f"text of label {i}", f"l{i}") for i in range(700)] + texts)):
        got = cp.language_id(spark, docs, sf)
        assert tuple(got.columns) == cp.COLUMNS and sorted(r.doc_id for r in got.collect() if r.doc_id < 1000) == list(range(8))
