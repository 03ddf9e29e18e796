import re
from collections import defaultdict

from tessera.llm import balance
from tessera.llm import queries as q


def targets(rows, cap=3):
    """Water filling by one source at a time."""
    size = defaultdict(int)
    for _, t, s in rows:
        size[s] += len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    names = sorted(size, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    free, total, out = set(names), sum(size.values()), {}
    while free:
        rest = total - sum(out.values())
        w = sum(weight[s] for s in free)
        over = [s for s in free if rest * weight[s] / w > cap * size[s]]
        if not over:
            return size, out | {s: rest * weight[s] / w for s in free}
        for s in over:
            out[s] = float(cap * size[s])
            free.discard(s)
    return size, out


def check(rows, got, slack):
    size, want = targets(rows)
    src = {(d, len(re.findall(r"[^\x20\x09-\x0D]+", t or "")), s) for d, t, s in rows}
    assert len(got) == len(rows)
    taken, by_id = defaultdict(int), {(d, n): s for d, n, s in src}
    for r in got:
        s = by_id[r["doc_id"], r["size"]]
        assert r["source_size"] == size[s] and abs(r["target"] - want[s]) < 1e-6 * max(1, want[s])
        assert 0 <= r["taken"] <= 3 * r["size"] and (r["size"] == 0 or r["taken"] % r["size"] == 0)
        taken[s] += r["taken"]
    for s in size:
        assert abs(taken[s] - want[s]) <= slack, (s, taken[s], want[s])


def test_targets_and_copies(spark, docs_of, table_dir):
    rows = [(i, "w " * (i * 7 % 90 + 1), "en", f"s{i % 7}" if i % 3 else "s0") for i in range(300)]
    rows += [(1000, None, "en", "s1"), (1001, "", "en", "empty"), (1002, "a b", "en", None), (None, "a b c", "en", "s2"),
             (5, "w " * 36, "en", "s5"), (1003, "é " * 3, "en", "\U0001F600"), (1004, "x\x85y z\x0bq", "en", "￿"), (1005, "big " * 300, "en", "s3")]
    d = table_dir(documents=docs_of(rows))
    got = [r.asDict() for r in q.op10_entropy_balance(spark, d).collect()]
    check([(r[0], r[1], r[3]) for r in rows], got, 2)
    again = [r.asDict() for r in q.op10_entropy_balance(spark, d).collect()]
    key = lambda x: sorted(map(str, x))
    assert key(got) == key(again)


def test_empty_and_wordless(spark, docs_of, table_dir):
    assert q.op10_entropy_balance(spark, table_dir(documents=docs_of([]))).collect() == []
    got = q.op10_entropy_balance(spark, table_dir(documents=docs_of([(1, None, "en", "a"), (2, "", "en", None)]))).collect()
    assert sorted((r.doc_id, r.size, r.target, r.taken) for r in got) == [(1, 0, 0.0, 0), (2, 0, 0.0, 0)]


def test_whole_table(spark, sf):
    rows = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = [r.asDict() for r in q.op10_entropy_balance(spark, sf).collect()]
    size, want = targets(rows)
    check(rows, got, max(0.05 * x for x in want.values()))


def test_hot_cell_is_counted_in_parts(spark, docs_of, table_dir, monkeypatch):
    monkeypatch.setattr(balance, "CELL", 10)
    rows = [(i, "two words", "en", "hot") for i in range(200)] + [(1000 + i, "three words here", "en", "x") for i in range(50)]
    got = [r.asDict() for r in q.op10_entropy_balance(spark, table_dir(documents=docs_of(rows))).collect()]
    check([(r[0], r[1], r[3]) for r in rows], got, 3)


def test_rates_tilt_with_size(spark):
    """Relative-entropy solution: the log odds of a copy are linear in size within a source."""
    import math
    hist = spark.createDataFrame([(0, s, 10) for s in (1, 5, 10, 40, 100)], "sid bigint, size bigint, n bigint")
    src = spark.createDataFrame([(0, 1560, 50, 900.0)], "sid bigint, source_size bigint, docs bigint, target double")
    r = balance.tilt(hist, src).first()
    rates = {s: 3 / (1 + 2 * math.exp(-r.lam * s / r.scale)) for s in (1, 5, 10, 40, 100)}
    assert abs(sum(10 * s * x for s, x in rates.items()) - 900) < 1e-3 and rates[100] < rates[1] < 1


def test_repeated_rows(docs_of):
    rows = [(1, "a b", "en", "s"), (1, "a b", "en", "s"), (2, "c d e", "en", "t"), (None, "x", "en", None)]
    docs = docs_of(rows)
    plan = balance.mix(docs).collect()
    out = balance.repeated_rows(docs)
    assert out.columns == docs.columns and out.count() == sum(r.copies for r in plan)
