import zlib

import numpy as np

from tessera.llm import language_mix as lm
from tessera.llm import queries as q

EN, DE = "the cat and the dog were walking with their friends through the old town ", "der hund und die katze gingen mit ihren freunden durch die alte stadt "


def held(i):
    return i is None or zlib.crc32(str(i).encode()) % 5 == 0


def test_traps(spark, docs_of, table_dir):
    rows = [(i, (EN if i % 2 else DE) * (i % 5 + 1), "en" if i % 2 else "de") for i in range(60)]
    rows += [(100, None, "en"), (101, "", None), (102, "123 !!! _ 4", "de"), (103, EN * 3, None), (None, DE, "de"), (1, rows[1][1], "en"),
             (104, EN * 20 + DE * 20, "en"), (105, EN * 3000, "en")]
    got = q.op1_language_mix(spark, table_dir(documents=docs_of(rows))).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    for i, t, _ in rows:
        r = by[i]
        assert r.held_out == held(i) and 0 <= r.score <= 1
        if i in (100, 101, 102):
            assert (r.lang_pred, r.score, r.mixture) == ("und", 0, None)
        elif i != 104:
            assert r.lang_pred == ("en" if "the" in t else "de") and r.score > 0.9
    assert set(by[104].mixture) == {"en", "de"} and abs(by[104].mixture["en"] - 0.5) < 0.1


def test_no_labels_and_empty(spark, docs_of, table_dir):
    assert q.op1_language_mix(spark, table_dir(documents=docs_of([]))).collect() == []
    got = q.op1_language_mix(spark, table_dir(documents=docs_of([(1, EN)]))).collect()
    assert [(r.lang_pred, r.score) for r in got] == [("und", 0.0)]


def test_counts_against_brute_force(docs_of):
    rows = [(i, (EN if i % 2 else DE) + f"wort{i} Éa ß", "en" if i % 2 else "de") for i in range(30)]
    model = lm.learn(docs_of(rows))
    words = [w for _, t, lang in rows if lang == "de" for w in lm.LETTERS.findall(t.lower())]
    tri, context, _ = lm.cells(words)
    want = np.bincount(tri, minlength=lm.BUCKETS), np.bincount(context, minlength=lm.BUCKETS)
    k = model.languages.index("de")
    assert np.allclose(model.tri[k], np.log(want[0] + 0.05).astype("float32"))
    assert np.allclose(model.context[k], np.log(want[1] + 3.2).astype("float32"))


def test_mixture_is_the_likelihood_maximum(docs_of):
    rows = [(i, (EN if i % 2 else DE), "en" if i % 2 else "de") for i in range(30)]
    model = lm.learn(docs_of(rows))
    doc = lm.word_counts(EN * 2 + DE * 5)
    share, _ = model.mixtures([doc, lm.word_counts(EN)], 2.0)
    s = model.word_scores(list(doc))
    c = np.array(list(doc.values()))
    grid = np.linspace(0.001, 0.999, 999)
    ll = [(c * np.log(np.exp(s) @ np.array([g, 1 - g]))).sum() for g in grid]
    assert abs(share[0][0] - grid[int(np.argmax(ll))]) < 0.01 and share[1].max() == 1


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = [r for r in q.op1_language_mix(spark, sf).collect() if r.held_out]
    assert np.mean([lang[r.doc_id] == r.lang_pred for r in got]) > 0.95
