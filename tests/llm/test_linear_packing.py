import random
import zlib
from collections import Counter

import numpy as np
import pytest
from tokenizers import Tokenizer

from tessera.llm import byte_bpe as bb
from tessera.llm import linear_packing as lp
from tessera.llm import queries as q

TEXTS = ["Hello  world ", "  a\tb\nc ", "ﬁ ½ é é 　x\xa0y", "", " ", "\n", "<|endoftext|> a<|endoftext|>", "日本語 𝔘 \x1c x\x1c y", "a\n\nb\n c \n\td", "don't we'll I'm",
         "a" * 3000, " " * 50 + "x" + " " * 33, "x \x00 y\x00", "word*** word&&& word.\nNext line\r\nAnother", "a\x85b   c d ​e", "tail \n", "123 4567 8.9e10"]


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(q.BYTE_BPE)
    t.encode_special_tokens = True
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


def expected_pieces(rows, library, capacity=2048):
    out = []
    for i, text in rows:
        ids = [*library(text), 0]
        first = (len(ids) - 1) % capacity + 1
        cut = [0, *range(first, len(ids) + 1, capacity)]
        out += [(i, p, a, b - a, zlib.crc32(np.array(ids[a:b], dtype="<u4").tobytes())) for p, (a, b) in enumerate(zip(cut, cut[1:]))]
    return sorted(out, key=str)


def check_packing(rows, capacity=2048):
    """Sequences are filled without gap or overlap; returns their number."""
    held = {}
    for r in rows:
        held.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in held.values():
        places.sort()
        assert places[0][0] == 0 and places[-1][0] + places[-1][1] <= capacity
        assert all(a + n == b for (a, n), (b, _) in zip(places, places[1:]))
    return len(held)


def check_plan(count, lots, capacity):
    used = Counter()
    for n, held in lots:
        assert n > 0 and sum(s * k for s, k in held.items()) <= capacity
        for s, k in held.items():
            used[s] += n * k
    assert used == Counter(count)
    return sum(n for n, _ in lots)


def best_fit_decreasing(sizes, capacity):
    rooms = []
    for s in sorted(sizes, reverse=True):
        fits = [i for i, r in enumerate(rooms) if r >= s]
        if fits:
            i = min(fits, key=lambda i: rooms[i])
            rooms[i] -= s
        else:
            rooms.append(capacity - s)
    return len(rooms)


def test_ids_match_the_library(library, monkeypatch):
    rnd = random.Random(2)
    texts = TEXTS + ["".join(rnd.choice(["a", "B", " ", " ", "\n", "é", "\t", "1", ".", "'s", " ", "日"]) for _ in range(rnd.randint(0, 40))) for _ in range(3000)]
    bpe = bb.ByteBpe(q.BYTE_BPE)
    for limit in (bb.MEMO_BYTES, 100):
        monkeypatch.setattr(bb, "MEMO_BYTES", limit)
        for at in range(0, len(texts), 500):
            part = texts[at:at + 500]
            for t, got in zip(part, bpe.ids(part)):
                assert np.frombuffer(got, dtype="<u4").tolist() == library(t), repr(t)


def test_plans_hold_every_length_and_are_near_the_bound():
    rnd = random.Random(3)
    for trial in range(30):
        kind = trial % 3
        sizes = [rnd.randint(1, 2048) if kind == 0 else rnd.randint(700, 1500) if kind == 1 else rnd.choice([1, 5, 300, 700, 1025, 2048]) for _ in range(rnd.choice([1, 3, 40, 2000]))]
        count = Counter(sizes)
        n = check_plan(count, lp.plan(count), 2048)
        assert n <= best_fit_decreasing(sizes, 2048) * 1.01 + 1
    assert lp.plan({}) == []


def test_configurations_solve_a_known_case():
    # 100 of each of 1000, 700, 340: one of each fills a sequence almost, and nothing does better.
    columns, times = lp.configurations(np.array([1000, 700, 340]), np.array([100.0, 100.0, 100.0]), 2048)
    assert np.allclose(columns @ times, 100) and times.sum() <= 100 + 1e-6


def test_groups_have_equal_cardinality():
    cut = lp.grouped({10: 7, 9: 1, 8: 4, 3: 8}, 4)
    assert [sum(n for _, n in g) for g in cut] == [5, 5, 5, 5]
    assert [s for g in cut for s, _ in g] == sorted((s for g in cut for s, _ in g), reverse=True)
    assert [sum(n for _, n in g) for g in lp.grouped({5: 2}, 4)] == [1, 1]


def test_pieces_of_traps_and_long_texts(docs_of, library):
    rows = [*enumerate(TEXTS), (None, "no id"), (3, ""), (50, None), (51, "word " * 30_000), (52, "x" * 50_000)]
    cut = lp.pieces(docs_of(rows), q.BYTE_BPE)
    assert sorted(map(tuple, cut.collect()), key=str) == expected_pieces(rows, library)
    got = lp.pack(cut).collect()
    assert sorted((tuple(r)[:5] for r in got), key=str) == expected_pieces(rows, library)
    check_packing(got)


def test_ids_of_pieces(docs_of, library):
    got = lp.pieces(docs_of([(1, "one two three four five")]), q.BYTE_BPE, capacity=4, with_ids=True).orderBy("piece").collect()
    assert [x for r in got for x in r["ids"]] == [*library("one two three four five"), 0]
    assert [r["length"] for r in got] == [2, 4]


def test_empty_table(docs_of):
    assert lp.pack(lp.pieces(docs_of([]), q.BYTE_BPE)).count() == 0


def test_one_length_for_all(spark):
    cut = spark.range(5000, numPartitions=7).selectExpr("id AS doc_id", "0 AS piece", "0L AS start", "500L AS length", "1L AS ids_crc32", "1 AS n", "'x' AS size")
    got = lp.pack(cut).collect()
    assert len(got) == 5000 and check_packing(got) == 1250


def test_whole_table(spark, sf, library):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = q.op12_linear_packing(spark, sf).collect()
    want = expected_pieces(rows, library)
    assert sorted((tuple(r)[:5] for r in got), key=str) == want
    n = check_packing(got)
    assert n <= best_fit_decreasing([r[3] for r in want], 2048)


def test_stretches_are_looked_up_once_for_all_their_places():
    """A slice's lookups number its distinct stretches, not its words (before: one a word)."""
    bpe = bb.ByteBpe(q.BYTE_BPE)
    texts = ["a word and a word\nand a word" * 50, "", " a  word", "\n\n x", "é  b   c", "\0 a\0", " ", "a word and"] * 3
    asked = []

    class Memo(dict):
        def __getitem__(self, key):
            asked.append(key)
            return super().__getitem__(key)

    bpe.memo = Memo()
    got = bpe.ids(texts)
    assert len(asked) == len(set(asked)) < 40
    assert got == [np.array(bpe.tokenizer.encode(t, add_special_tokens=False).ids, dtype="<u4").tobytes() for t in texts]
    cut, at = bb.pieces(texts)
    for t, a, b in zip(texts, at[:-1], at[1:]):
        assert cut[a:b].to_pylist() == [s for s in bb.stretches(t) if s]
    assert bpe.ids([]) == [] and bpe.ids(["", ""]) == [b"", b""]
