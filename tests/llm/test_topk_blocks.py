import math

import duckdb
import numpy as np

from tessera.llm import queries as q
from tessera.llm import topk_blocks


def brute(rows, k=5):
    ok = [(i, [math.floor(256 * x) for x in v]) for i, v in rows
          if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, v in ok:
        if i % 50 == 0:
            s = sorted((-sum(a * b for a, b in zip(v, w)), j) for j, w in ok if j != i)[:k]
            out += [(i, r + 1, j, -x) for r, (x, j) in enumerate(s)]
    return sorted(out)


def run(spark, table_dir, rows):
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").selectExpr("*", "1 AS id", "'x' AS v", "2 AS n")
    return sorted(map(tuple, q.op8_topk_blocks(spark, table_dir(embeddings=df.repartition(3))).collect()))


def test_traps(spark, table_dir, monkeypatch):
    monkeypatch.setattr(topk_blocks, "GROUP", 2)
    rnd = np.random.default_rng(3)
    rows = [(i, rnd.normal(size=8).astype("float32").tolist()) for i in range(0, 320)]
    rows += [(400, None), (450, [1.0, None]), (500, [float("nan")] * 8), (550, [float("inf")] + [0.0] * 7), (600, []), (650, [0.5]),
             (651, rows[3][1]), (652, rows[3][1]), (700, [-1.0] * 8), (None, [1.0] * 8), (750, [3e6, -2e6] + [0.0] * 6)]
    assert run(spark, table_dir, rows) == brute(rows)


def test_few_rows(spark, table_dir):
    assert run(spark, table_dir, []) == []
    assert run(spark, table_dir, [(0, [1.0])]) == []
    assert run(spark, table_dir, [(0, [1.0]), (1, [2.0])]) == [(0, 1, 1, 256 * 512)]


def test_pruning_keeps_ties(spark, table_dir):
    """Blocks of equal vectors: bounds equal the k-th score, the smaller ids must win."""
    rows = [(i, [1.0, 0.0]) for i in range(2000, 0, -1)] + [(3000, [0.0, 1.0]), (0, [1.0, 0.0])]
    got = [r for r in run(spark, table_dir, rows) if r[0] == 0]
    assert got == [(0, r, r, 65536) for r in range(1, 6)]


def test_sql_agrees(spark, sf):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{sf}/embeddings.parquet')")
    assert sorted(map(tuple, q.op8_topk_blocks(spark, sf).collect())) == sorted(con.execute(q.OP8_SQL).fetchall())
