"""Operator 7: exact merge-type (BPE) piece encoding by backtracking.

A piece sequence is the merge encoding of a text exactly when every adjacent
pair of pieces is what merging the pair's own characters gives back.  So the
encoder walks the text left to right: an Aho-Corasick automaton lists the
vocabulary matches at each position, the longest that is compatible with the
piece before it is taken, and where nothing fits the walk steps back; a
bitfield marks positions from which no compatible piece leads on, so each is
left only once.

Merging never joins two characters that stand side by side in no piece.  The
normalised text is therefore cut before word markers and at newlines (if the
vocabulary allows), then at each such pair of characters, and the parts are
encoded once per task (memoised; what was not used of late goes when the memo is full: it bounds
memory, not the result).

Defined cases: null and empty texts give only the end id; characters outside
the vocabulary become their UTF-8 byte pieces; repeated rows give repeated
rows; extra columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import only, slices

MARK = "▁"
#: Bytes that the memos of parts and of pairs may hold; an entry takes about ENTRY bytes besides its ids.
MEMO_BYTES, PAIR_BYTES, ENTRY = 96 << 20, 64 << 20, 200
#: Text encoded at once.
SLICE = 1 << 20

_ENCODERS: dict[str, "PieceEncoder"] = {}


class PieceEncoder:
    """Merge encoder over the pieces of a sentencepiece BPE model."""

    def __init__(self, model_path: str):
        import ahocorasick
        import sentencepiece

        self.sp = sp = sentencepiece.SentencePieceProcessor(model_file=model_path)
        self.ids: dict[str, int] = {}
        self.rank: dict[str, float] = {}
        self.bytes = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        for i in range(sp.vocab_size()):
            if sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i):
                continue
            p = sp.id_to_piece(i)
            self.ids[p], self.rank[p] = i, sp.get_score(i)
        self.eos = sp.eos_id()
        self.chars = {p for p in self.ids if len(p) == 1}
        self.joined = {p[i:i + 2] for p in self.ids for i in range(len(p) - 1)}
        self.pairs: dict[tuple[str, str], bool] = {}
        self.memo: dict[str, tuple[int, ...]] = {}
        self.older: dict[str, tuple[int, ...]] = {}
        self.held = 0
        self.automaton = ahocorasick.Automaton()
        for p in self.ids:
            if self.merge(p) == [p]:  # pieces that merging cannot reach never occur
                self.automaton.add_word(p, p)
        self.automaton.make_automaton()
        cuts = [c for c in (MARK, "\n") if not any(c in p.lstrip(c) for p in self.ids)]
        if MARK in cuts and "\n" in cuts:
            self.cut = re.compile(f"{MARK}+[^{MARK}\n]*|\n|[^{MARK}\n]+")
        elif MARK in cuts:
            self.cut = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")
        else:
            self.cut = re.compile(r"(?s).+")

    def merge(self, s: str) -> list[str]:
        """Best-score merging of neighbours, leftmost first on ties."""
        parts, rank = list(s), self.rank
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                r = rank.get(parts[i] + parts[i + 1])
                if r is not None and (best is None or r > best):
                    best, at = r, i
            if best is None:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def compatible(self, left: str, right: str) -> bool:
        key = (left, right)
        ok = self.pairs.get(key)
        if ok is None:
            if len(self.pairs) * ENTRY >= PAIR_BYTES:
                self.pairs.clear()
            ok = self.pairs[key] = self.merge(left + right) == [left, right]
        return ok

    def known(self, s: str) -> list[str]:
        """Pieces of a string whose characters are all in the vocabulary."""
        n = len(s)
        at: list[list[str]] = [[] for _ in range(n)]
        for end, p in self.automaton.iter(s):
            at[end - len(p) + 1].append(p)  # shorter ones come first
        failed = bytearray(n // 8 + 1)
        out: list[str] = []
        left = [len(at[0]) - 1]  # per open position the next match to try
        pos = 0
        while pos < n:
            i, matches = left[-1], at[pos]
            before = out[-1] if out else None
            while i >= 0:
                p = matches[i]
                end = pos + len(p)
                i -= 1
                if not failed[end >> 3] >> (end & 7) & 1 and (before is None or self.compatible(before, p)):
                    left[-1] = i
                    out.append(p)
                    pos = end
                    left.append(len(at[pos]) - 1 if pos < n else -1)
                    break
            else:
                failed[pos >> 3] |= 1 << (pos & 7)
                left.pop()
                pos -= len(out.pop())
        return out

    def chunk(self, s: str) -> tuple[int, ...]:
        joined = self.joined
        cuts = [0, *(k for k in range(1, len(s)) if s[k - 1:k + 1] not in joined), len(s)]
        if len(cuts) == 2:
            return self.part(s)
        ids: list[int] = []
        for i in range(len(cuts) - 1):
            ids += self.remembered(s[cuts[i]:cuts[i + 1]], self.part)
        return tuple(ids)

    def part(self, s: str) -> tuple[int, ...]:
        if len(s) == 1 and s not in self.chars:
            return tuple(self.bytes[b] for b in s.encode("utf-8", "surrogatepass"))
        return tuple(self.ids[p] for p in self.known(s))

    def remembered(self, s: str, make) -> tuple[int, ...]:
        got = self.memo.get(s)
        if got is None:
            got = self.older.get(s)
            if got is None:
                got = make(s)
            if len(s) <= 64:
                if 2 * self.held >= MEMO_BYTES:  # what was not used since the last time goes
                    self.memo, self.older, self.held = {}, self.memo, 0
                self.memo[s] = got
                self.held += ENTRY + 8 * len(got)
        return got

    def encode(self, text: str) -> list[int]:
        """Ids of the normalised text, then the end id."""
        ids: list[int] = []
        for c in self.cut.findall(self.sp.normalize(text)):
            got = self.memo.get(c)  # looked up here for speed; filled by remembered()
            ids += self.remembered(c, self.chunk) if got is None else got
        ids.append(self.eos)
        return ids


def encoder(model_path: str) -> PieceEncoder:
    if model_path not in _ENCODERS:
        _ENCODERS[model_path] = PieceEncoder(model_path)
    return _ENCODERS[model_path]


def encode_documents(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``id_col``, ``ids`` array<int> (end id last), ``decoded`` string.

    ``model_path`` is a file that every executor can open (an installed package)."""
    kept = only(docs, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(model_path)
        for b in slices(batches, 1, SLICE):
            ids = [enc.encode(t or "") for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(ids, pa.list_(pa.int32())), pa.array([enc.sp.decode(x) for x in ids], pa.string())],
                [id_col, "ids", "decoded"])

    kind = kept.schema[id_col].dataType.simpleString()
    return kept.mapInArrow(run, f"`{id_col}` {kind}, ids array<int>, decoded string")


def digests(encoded: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts and SHA-256 digests of ``encode_documents``' ids and decoded text."""
    return encoded.select(
        id_col,
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
