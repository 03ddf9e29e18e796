import hashlib

import sentencepiece

from tessera.llm import piece_bpe
from tessera.llm import queries as q

TEXTS = ["Hello  world ", "  a\tb\nc ", "ﬁ ½ é é 　x\xa0y", "", None, " ", "\n", "</s> <s> a<unk>", "日本語 𝔘",
         "▁x ▁▁ y", "a" * 3000, " " * 50 + "x" + " " * 33, "ab" * 500, "return" * 200, "word*** word&&& word.\nNext line", "word*** word&&& word.\nNext line"]


def _expected(sp, rows):
    out = []
    for i, t in rows:
        ids = sp.encode(t or "", add_eos=True)
        out.append((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                    hashlib.sha256(sp.decode(ids).encode()).hexdigest()))
    return sorted(out, key=str)


def test_traps_match_the_library(docs_of):
    sp = sentencepiece.SentencePieceProcessor(model_file=q.PIECE_MODEL)
    rows = [*enumerate(TEXTS), (None, "no id"), (3, "")]
    got = piece_bpe.digests(piece_bpe.encode_documents(docs_of(rows), q.PIECE_MODEL)).collect()
    assert sorted(map(tuple, got), key=str) == _expected(sp, rows)


def test_empty_table(docs_of):
    assert piece_bpe.encode_documents(docs_of([]), q.PIECE_MODEL).count() == 0


def test_whole_table_matches_the_library(spark, sf):
    sp = sentencepiece.SentencePieceProcessor(model_file=q.PIECE_MODEL)
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = q.op7_piece_encoding(spark, sf).collect()
    assert sorted(map(tuple, got), key=str) == _expected(sp, rows)


def test_small_slices(docs_of, monkeypatch):
    import pyarrow as pa

    from tessera.llm.common import slices
    b = pa.RecordBatch.from_pydict({"i": [1, 2, 3, 4], "t": ["aaaa", None, "b" * 50, "cc"]})
    parts = list(slices([b], 1, 10))
    assert [x for p in parts for x in p.column(0).to_pylist()] == [1, 2, 3, 4] and len(parts) == 3
