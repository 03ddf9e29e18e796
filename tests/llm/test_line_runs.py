import hashlib

import duckdb

from tessera.llm import line_runs
from tessera.llm import queries as q

BLANKS = " \t\n\x0b\x0c\r"


def key(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(BLANKS))


def brute(rows, min_chars=10):
    """Null ids are one document after all others."""
    order = lambda d: (d is None, d or 0)
    first = {}
    for d, t in rows:
        for x in (t or "").split("\n"):
            if len(key(x)) >= min_chars:
                first[key(x)] = min(first.get(key(x), order(d)), order(d))
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(key(x)) < min_chars or first[key(x)] == order(d)]
        out.append((d, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


ROWS = [(5, "The shared line\nown\n  THE SHARED line \t"), (2, "the shared line\r\n\nshort\nshort"), (9, None), (8, ""), (7, "short\nthe shared line"),
        (2, "another text of doc 2\nthe shared line"), (7, "short\nthe shared line"), (None, "the shared line\nonly null here"),
        (None, "only null here"), (11, "\n\n"), (12, "ÉCOLE longue ligne"), (13, "école longue ligne"), (14, "École Longue LIGNE"),
        (15, "x" * 200_000 + "\n" + "a line in the end"), (16, "a line in the end"), (17, "nine char"), (18, "nine char"),
        (19, "line with inner    blanks\x85"), (20, "line with inner    blanks\x85 "), (21, "\n".join(["same line again"] * 5))]


def test_traps(spark, docs_of, table_dir):
    got = q.op6_line_runs(spark, table_dir(documents=docs_of(ROWS))).collect()
    assert sorted(map(tuple, got), key=str) == brute(ROWS)


def test_many_batches_and_compactions(docs_of):
    got = line_runs.dedup_lines(docs_of(ROWS).select("doc_id", "text"), batches=9, fanout=2).collect()
    import hashlib as h
    assert sorted([(r.doc_id, r.n_lines, r.n_dropped, h.sha256((r.text or "").encode()).hexdigest()) for r in got], key=str) == brute(ROWS)


def test_text_and_columns_are_kept(docs_of):
    out = line_runs.dedup_lines(docs_of([(1, "a shared line here\nx"), (2, "y\na shared line here"), (3, None)]))
    assert {r.doc_id: r.text for r in out.collect()} == {1: "a shared line here\nx", 2: "y", 3: None}
    assert "size" in out.columns and "lang" in out.columns


def test_empty(spark, docs_of, table_dir):
    assert q.op6_line_runs(spark, table_dir(documents=docs_of([]))).collect() == []


def test_sql_agrees(spark, sf):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf}/documents.parquet')")
    want = sorted(con.execute(q.OP6_SQL).fetchall())
    assert sorted(tuple(r) for r in q.op6_line_runs(spark, sf).select("doc_id", "n_lines", "n_dropped", "kept_sha256").collect()) == want
