import hashlib
import random
from collections import Counter

import pytest
import sentencepiece
from tokenizers import Tokenizer

from tessera.llm import queries as q
from tessera.llm import token_spans as ts

TEXTS = ["Hello  world ", "  a\tb\nc ", "ﬁ ½ é é 　x\xa0y", "", None, " ", "\n", "<|endoftext|> a<|endoftext|> </s><s>", "日本語 𝔘 \x1c x\x1c y", "a\n\nb\n c \n\td",
         "▁x ▁▁ y", "don't we'll", "a" * 3000, " " * 50 + "x" + " " * 33, "x \x00 y\x00", "word*** word&&& word.\nNext line\r\nAnother", "𝔘𝔙 é́ 你好𝔘",
         "a\x85b   c d ​e", "tail \n", "<0x41> é", "Hello  world ", "x\U0001f600\U0001f468‍\U0001f469 \n\n \U0001f600"]


class Brute:
    def __init__(self):
        self.a = Tokenizer.from_file(q.BYTE_BPE)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=q.PIECE_MODEL)
        keep = [b for b in range(256) if chr(b).isprintable() and b not in (32, 173)]
        self.letter = {chr(b): b for b in keep}
        for i, b in enumerate(b for b in range(256) if b not in keep):
            self.letter[chr(256 + i)] = b

    def tokens(self, text):
        if not text:
            return [], []
        a = [(i, bytes(self.letter[c] for c in self.a.id_to_token(i))) for i in self.a.encode(" " + text, add_special_tokens=False).ids]
        b = []
        for i in self.b.encode(text):
            p = self.b.id_to_piece(i)
            b.append((i, bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()))
        want = (" " + text).encode()
        if any(b"".join(x for _, x in t) != want for t in (a, b)):
            return [], []
        return a, b

    def row(self, text):
        a, b = self.tokens(text)
        spans = []
        for t in (a, b):
            at, out = 0, []
            for i, x in t:
                out.append((i, at, at + len(x)))
                at += len(x)
            spans.append(out)
        ends = sorted({e for _, _, e in spans[0]} & {e for _, _, e in spans[1]})
        groups = []
        for side in spans:
            rest, sides = iter(side), []
            for e in ends:
                ids = []
                while not ids or t < e:
                    i, _, t = next(rest)
                    ids.append(str(i))
                sides.append(",".join(ids))
            groups.append(sides)
        groups = ["|".join(g) for g in zip(*groups)]
        links, j = [], 0
        for i, s, t in spans[0]:
            while j and spans[1][j][1] > s:
                j -= 1
            while j < len(b) and spans[1][j][1] < t:
                if spans[1][j][2] > s:
                    links.append((i, spans[1][j][0]))
                j += 1
            j = max(0, j - 1)
        return len(a), len(b), groups, links

    def table(self, rows):
        each = [(i, *self.row(t)) for i, t in rows]
        count = Counter(link for r in each for link in r[4])
        top = {}
        for (_, b), n in count.items():
            top[b] = max(top.get(b, 0), n)
        return sorted([(i, a, b, len(g), len(links), sum(count[x] == top[x[1]] for x in links), sum(count[x] for x in links),
                        hashlib.sha256(";".join(g).encode()).hexdigest() if a else "") for i, a, b, g, links in each], key=str)


@pytest.fixture(scope="module")
def brute():
    return Brute()


def test_traps_match_brute_force(docs_of, brute):
    rows = [*enumerate(TEXTS), (None, "no id"), (3, "again a")]
    got = ts.alignment_table(docs_of(rows), q.BYTE_BPE, q.PIECE_MODEL).collect()
    assert sorted(map(tuple, got), key=str) == brute.table(rows)


def test_random_texts_with_small_memos(brute, monkeypatch):
    rnd = random.Random(4)
    alphabet = ["a", "The", " ", " ", " ", "\n", "é", "\t", "12", ".", "'s", "你", "𝔘", "ing", "\xa0", "ö"]
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(1, 40))) for _ in range(1500)]
    for limit in (ts.MEMO_BYTES, 1000):
        monkeypatch.setattr(ts, "MEMO_BYTES", limit)
        al = ts.Aligner(q.BYTE_BPE, q.PIECE_MODEL)
        for at in range(0, len(texts), 300):
            part = texts[at:at + 300]
            counts, printed, (first, code, times) = al.align(part)
            for k, t in enumerate(part):
                a, b, groups, links = brute.row(t)
                assert counts[k].tolist() == [a, b, len(groups)] and printed[k].as_py() == ";".join(groups), repr(t)
                got = {divmod(c, al.b_size): n for c, n in zip(code[first[k]:first[k + 1]].tolist(), times[first[k]:first[k + 1]].tolist())}
                assert got == Counter(links), repr(t)


def test_rare_pairs_meet_by_a_join(docs_of, brute, monkeypatch):
    rows = [(i, t) for i, t in enumerate(["the cat sat on the mat", "the dog sat", "a cat and a dog", "the the the", "zyzzyva the"] * 3)]
    for limit in (0, 3, 1 << 18):
        monkeypatch.setattr(ts, "LOOKUP", limit)
        got = ts.alignment_table(docs_of(rows), q.BYTE_BPE, q.PIECE_MODEL).collect()
        assert sorted(map(tuple, got), key=str) == brute.table(rows)


def test_empty_table(docs_of):
    assert ts.alignment_table(docs_of([]), q.BYTE_BPE, q.PIECE_MODEL).count() == 0


def test_only_empty_texts(docs_of):
    got = ts.alignment_table(docs_of([(1, None), (2, "")]), q.BYTE_BPE, q.PIECE_MODEL).collect()
    assert sorted(map(tuple, got)) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]


def test_very_long_text(docs_of, brute):
    rows = [(1, "some words é 你 and more.\n" * 20_000), (2, "x" * 5_000)]
    got = ts.alignment_table(docs_of(rows), q.BYTE_BPE, q.PIECE_MODEL).collect()
    assert sorted(map(tuple, got), key=str) == brute.table(rows)


def test_whole_table_matches_brute_force(spark, sf, brute):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = q.op11_token_spans(spark, sf).collect()
    assert sorted(map(tuple, got), key=str) == brute.table(rows)
