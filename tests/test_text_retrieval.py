import math

import pytest
from pyspark.sql import functions as F

from tessera.functions import text as tx
from tessera.operators import retrieval as rt
from tessera.operators import text as tops


def test_clean_text_steps(spark):
    df = spark.createDataFrame([(1, "سلام! كتاب ي، خوبییییی 😀 َمرسی"), (2, ""), (3, "The cat, the DOG.")], "id INT, t STRING")
    out = {r["id"]: r["tokens"] for r in tops.clean_tokens(df, "t").collect()}
    assert out[1] == ["سلام", "کتاب", "ی", "خوبیی", "ممنون"]   # punctuation, ك/ي forms, squeeze, emoji, diacritic, slang
    assert out[2] == []
    assert out[3] == ["cat", "dog"]                            # stop words dropped, lower-cased


def test_ngrams_stay_inside_documents(spark):
    df = spark.createDataFrame([(["a", "b"],), (["c"],)], "tokens ARRAY<STRING>")
    bigrams = {r["ngram"] for r in tops.ngram_frequencies(df, "tokens", {2: 10}).collect()}
    assert bigrams == {"a b"}                                  # no "b c" across the border


@pytest.mark.parametrize("heavy,most", [(1, 50_000), (3, 50_000), (3, 1), (50, 50_000)])
def test_pruned_ngrams_match_brute_force(spark, heavy, most):
    import random
    from collections import Counter

    rnd = random.Random(heavy)
    docs = [[f"w{min(int(rnd.expovariate(0.3)), 30)}" for _ in range(rnd.randint(0, 25))] for _ in range(120)] + [None, [], ["z", "z"]]
    df = spark.createDataFrame([(d,) for d in docs], "tokens ARRAY<STRING>")
    top = {1: 5, 2: 7, 3: 4}
    want = set()
    for n, k in top.items():
        c = Counter(" ".join(d[i:i + n]) for d in docs if d for i in range(len(d) - n + 1))
        want |= {(g, m, n) for g, m in sorted(c.items(), key=lambda x: (-x[1], x[0]))[:k]}
    got = tops.ngram_frequencies(df, "tokens", top, heavy=heavy, heavy_most=most).collect()
    assert {(r["ngram"], r["count"], r["n"]) for r in got} == want and len(got) == len(want)


def test_dictionary_map_keeps_order(spark):
    df = spark.createDataFrame([(1, ["running", "dogs", "x"])], "id INT, tokens ARRAY<STRING>")
    d = spark.createDataFrame([("running", "run"), ("dogs", "dog")], "word STRING, lemma STRING")
    assert tops.map_tokens_by_table(df, "id", "tokens", d).first()["tokens"] == ["run", "dog", "x"]


@pytest.mark.parametrize("broadcast_bytes", [1 << 20, 0])
def test_lemma_step_broadcast_and_joined(spark, broadcast_bytes):
    """Same result for small and large dictionaries: repeats, unknown words, NULL and empty lists, a word listed twice."""
    rows = [(i, [f"w{(i * j) % 11}" for j in range(i % 7)] + ["same"] * 3) for i in range(40)] + [(100, []), (101, None)]
    df = spark.createDataFrame(rows, "id INT, tokens ARRAY<STRING>").repartition(5).withColumn("word", F.lit("kept"))
    known = {f"w{k}": f"l{k}" for k in range(0, 11, 2)} | {"same": "a"}
    pairs = [*known.items(), ("same", "b"), (None, "x"), ("w1", None), ("never", "seen")]
    d = spark.createDataFrame(pairs, "word STRING, lemma STRING")
    got = {r["id"]: (r["tokens"], r["word"]) for r in
           tops.map_tokens_by_table(df, "id", "tokens", d, broadcast_bytes=broadcast_bytes).collect()}
    assert got == {i: ([known.get(t, t) for t in toks or []], "kept") for i, toks in rows}


def test_vector_search_exact_with_ties_and_zero(spark):
    corpus = spark.createDataFrame([(1, [0.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 1.0]), (4, [3.0, 4.0])],
                                   "id LONG, v ARRAY<FLOAT>")
    q = spark.createDataFrame([(10, [0.0, 0.0]), (11, [1.0, 1.0])], "qid LONG, qv ARRAY<DOUBLE>")
    r = rt.vector_search(corpus, q, "id", "v", "qid", "qv", k=2).collect()
    got = {(x["query_id"], x["rank"]): (x["id"], round(x["distance"], 6)) for x in r}
    assert got[(10, 1)] == (1, 0.0) and got[(10, 2)] == (2, 1.0)     # tie 2/3 broken by id
    assert got[(11, 1)] == (2, 1.0) and got[(11, 2)] == (3, 1.0)


def test_bm25_matches_brute_force(spark):
    docs = [(1, ["a", "b", "a"]), (2, ["b", "c"]), (3, ["c", "c", "d", "e"]), (4, ["z"])]
    d = spark.createDataFrame(docs, "doc_id LONG, tokens ARRAY<STRING>")
    q = spark.createDataFrame([(7, ["a", "c", "q"])], "item_id LONG, qt ARRAY<STRING>")
    got = {r["doc_id"]: r["score"] for r in rt.bm25_search(rt.bm25_index(d, "doc_id", "tokens"), q, "item_id", "qt",
                                                            "doc_id", k=10).collect()}
    n, avgdl = 4, sum(len(t) for _, t in docs) / 4
    exp = {}
    for did, toks in docs:
        s = 0.0
        for term in {"a", "c", "q"}:
            tf = toks.count(term)
            df = sum(1 for _, t in docs if term in t)
            if tf:
                idf = math.log(1 + (n - df + 0.5) / (df + 0.5))
                s += idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(toks) / avgdl))
        if s:
            exp[did] = s
    assert got.keys() == exp.keys()
    for k in exp:
        assert got[k] == pytest.approx(exp[k], abs=1e-8)


def test_rrf_and_ranking_metrics(spark):
    a = spark.createDataFrame([(1, 10, 1), (1, 11, 2)], "query_id INT, doc_id INT, rank INT")
    b = spark.createDataFrame([(1, 12, 1), (1, 10, 2)], "query_id INT, doc_id INT, rank INT")
    f = {r["doc_id"]: (r["fused_rank"], r["score"]) for r in rt.rrf_fuse(a, b, "doc_id", k=3).collect()}
    assert f[10][0] == 1 and f[10][1] == pytest.approx(1 / 61 + 1 / 62)
    assert f[12][0] == 2 and f[11][0] == 3                    # 1/61 > 1/62; id only in one ranking
    rel = spark.createDataFrame([(10,), (99,)], "doc_id INT")
    m = rt.ranking_metrics(a, rel, "doc_id", 2).first()
    assert m["precision_at_k"] == 0.5 and m["recall_at_k"] == 0.5
    assert m["ndcg_at_k"] == pytest.approx(1 / (1 + 1 / math.log2(3)))
