"""Operator 11: which tokens of two tokenizers cover the same bytes of a text.

Tokenizer A is a byte-level BPE of the tokenizers library, B a sentencepiece model
that marks spaces.  Both see space + text (B adds the space itself).

1. Coarse cuts.  A token of A ends where the library's character offsets say, a
   piece of B where the span in sentencepiece's proto says.
2. Refinement.  Tokens that share a character with the next one, and the byte
   pieces of a character outside B's vocabulary, end where their decoded bytes do.
3. Byte offsets where tokens of both end cut the text into groups; between two
   neighbouring ends of any token lies exactly one link, the A and the B token there.
4. Spark adds up how often each pair of ids is linked, finds each B id's highest
   count, and gives every text the sums over its links: the ``LOOKUP`` most
   frequent pairs are broadcast (a bounded table), all others meet by a join, so a
   pair that every text holds is never one task's and no count is approximate.

Both tokenizers begin a new unit at a space or newline after any other character
(for B this is checked against its pieces), so a text's tokens are those of its
stretches between such places (``byte_bpe.stretches``).  A worker aligns each
new stretch once, joined with others, and keeps up to ``MEMO_BYTES`` of them (then those
seen once go).

Defined cases: null and empty texts, and texts whose tokens' bytes are not space +
text (a text with the space mark itself), have no tokens: zeros and no groups;
special tokens' strings are plain text; repeated rows count as often as they come,
with a null id like others; very long texts are aligned by stretch, in one task;
extra columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.byte_bpe import joined, stretches
from tessera.llm.common import only, slices, stored

MARK = "▁"
MEMO_BYTES = 160 << 20
SLICE = 2 << 20
LOOKUP = 1 << 18
_LEAD = " x"

_OPEN: dict[tuple[str, str], "Aligner"] = {}


def byte_letters() -> dict[str, int]:
    """The byte behind each letter of a byte-level vocabulary: printable ones stand for
    themselves, the others follow from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


def _ranges(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """begin[0], begin[0] + 1, ... (size[0] of them), begin[1], ..."""
    return np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))


class Aligner:
    """Aligned stretches in columns; ``memo`` names a stretch's row."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sp = sentencepiece.SentencePieceProcessor(model_file=b_path)
        letters = byte_letters()
        self.a_bytes = [bytes(letters.get(c, 0) for c in self.a.id_to_token(i) or "") for i in range(self.a.get_vocab_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if sp.is_byte(i) else p.replace(MARK, " ").encode() for i, p in enumerate(map(sp.id_to_piece, range(sp.vocab_size())))]
        self.a_length, self.b_length = (np.array([len(x) for x in t]) for t in (self.a_bytes, self.b_bytes))
        self.single = np.array([sp.is_byte(i) for i in range(sp.vocab_size())])
        pieces = [sp.id_to_piece(i) for i in range(sp.vocab_size()) if not sp.is_byte(i)]
        self.cuttable = not any(MARK in p.lstrip(MARK) or "\n" in p for p in pieces)
        self.a_size, self.b_size = len(self.a_bytes), len(self.b_bytes)
        ids = [*(f"{i}{s}" for s in ",|" for i in range(self.a_size)), *(f"{i}{s}" for s in ",;" for i in range(self.b_size))]
        self.printed = pa.array(ids, pa.string())
        self.clear()

    def forget(self) -> None:
        """Drops the stretches seen once; all of them, if those are few."""
        keep = np.flatnonzero(self.uses > 1)
        if 2 * len(keep) > len(self.uses):
            self.clear()
            return
        size = self.code_end[keep + 1] - self.code_end[keep]
        self.codes = self.codes[_ranges(self.code_end[keep], size)]
        self.code_end = np.concatenate([[0], np.cumsum(size)])
        self.held = self.held * len(keep) // max(1, len(self.uses))
        self.counts, self.uses, self.groups = self.counts[keep], np.zeros(len(keep), dtype=np.int64), self.groups.take(pa.array(keep))
        names = list(self.memo)  # in order of their rows
        self.memo = {names[k]: i for i, k in enumerate(keep.tolist())}

    def clear(self) -> None:
        self.memo: dict[str, int] = {}
        self.uses = np.zeros(0, dtype=np.int64)
        self.counts = np.zeros((0, 4), dtype=np.int64)  # tokens of A, of B, groups; 1 if the bytes are right
        self.codes, self.code_end = np.empty(0, dtype=np.int64), np.zeros(1, dtype=np.int64)
        self.groups = pa.array([], pa.string())
        self.held = 0

    def cut_a(self, text: str, byte_at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids and byte ends of A's tokens."""
        e = self.a.encode(text, add_special_tokens=False)
        ids = np.array(e.ids, dtype=np.int64)
        span = np.fromiter(chain.from_iterable(e.offsets), dtype=np.int64, count=2 * len(ids)).reshape(-1, 2)
        end = byte_at[span[:, 1]]
        inside = np.zeros(len(ids), dtype=bool)  # the next token begins within this one's last character
        inside[:-1] = span[1:, 0] < span[:-1, 1]
        decoded = np.cumsum(self.a_length[ids])
        return ids, np.where(inside, decoded, end)

    def cut_b(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids and byte ends of B's pieces, the added space included."""
        got = [x for p in self.b.encode(text, return_type="proto").pieces for x in (p.id, p.begin, p.end)]
        ids, begin, end = np.array(got, dtype=np.int64).reshape(-1, 3).T
        new = np.ones(len(ids), dtype=bool)  # the byte pieces of a character begin at one place
        new[1:] = (begin[1:] != begin[:-1]) | ~self.single[ids[:-1]]
        at = np.arange(len(ids))
        nth = at - np.maximum.accumulate(np.where(new, at, 0)) + 1
        return ids, np.where(self.single[ids], begin + nth, end) + 1

    def learn(self, new: list[str]) -> None:
        """Aligns new stretches; each begins with a space or newline (or is a whole text)."""
        base = 0
        parts: list[tuple[np.ndarray, ...]] = []
        right: list[bool] = []
        for group in joined(new):
            lead = [_LEAD] if self.cuttable else []
            text = "".join([*lead, *group])
            raw = [s.encode() for s in [*lead, *group]]
            char_bytes = np.fromiter((1 + (c > "\x7f") + (c > "߿") + (c > "￿") for c in text), dtype=np.int64, count=len(text)) \
                if not text.isascii() else np.ones(len(text), dtype=np.int64)
            byte_at = np.concatenate([[0], np.cumsum(char_bytes)])
            end = np.cumsum([len(r) for r in raw])
            cut = []
            whole = b"".join(raw)
            all_right = True
            for ids, ends, table, length in ((*self.cut_a(text, byte_at), self.a_bytes, self.a_length), (*self.cut_b(text[1:]), self.b_bytes, self.b_length)):
                all_right = all_right and np.array_equal(np.cumsum(length[ids]), ends) and b"".join([table[i] for i in ids.tolist()]) == whole
                of = np.searchsorted(ends, end[:-1], side="right") if len(lead) else np.zeros(0, dtype=np.int64)
                first = np.concatenate([of, [len(ids)]]) if lead else np.array([0, len(ids)])
                cut.append((ids, ends, table, first.tolist()))
            begin = int(end[0]) if lead else 0
            for k, r in enumerate(raw[len(lead):]):
                right.append(all_right or all(b"".join([table[i] for i in ids[f[k]:f[k + 1]].tolist()]) == r for ids, _, table, f in cut))
            skip = [c[3][0] for c in cut]
            parts.append((*(x[n:] if j == 0 else x[n:] - begin + base for (ids, ends, *_), n in zip(cut, skip, strict=True) for j, x in enumerate((ids, ends))),
                          end[len(lead):] - begin + base))
            base += int(end[-1]) - begin
        ia, ea, ib, eb, stretch = (np.concatenate(c) for c in zip(*parts, strict=True))
        ok = np.array(right)
        good_a, good_b = ok[np.searchsorted(stretch, ea)], ok[np.searchsorted(stretch, eb)]
        ia, ea, ib, eb = ia[good_a], ea[good_a], ib[good_b], eb[good_b]
        cuts = np.union1d(ea, eb)
        codes = ia[np.searchsorted(ea, cuts)] * self.b_size + ib[np.searchsorted(eb, cuts)]
        common = np.intersect1d(ea, eb)

        def per_stretch(ends: np.ndarray) -> np.ndarray:
            return np.bincount(np.searchsorted(stretch, ends), minlength=len(stretch))

        links = per_stretch(cuts)
        counts = np.stack([per_stretch(ea), per_stretch(eb), per_stretch(common), ok.astype(np.int64)], axis=1)
        # A's tokens of a group, then B's: places in the printed row of ids.
        group_a, group_b = np.searchsorted(common, ea), np.searchsorted(common, eb)
        order = np.empty(len(ia) + len(ib), dtype=np.int64)
        last_a, last_b = np.isin(ea, common), np.isin(eb, common)
        order[np.arange(len(ia)) + np.searchsorted(group_b, group_a)] = ia + last_a * self.a_size
        order[np.arange(len(ib)) + np.searchsorted(group_a, group_b, side="right")] = 2 * self.a_size + ib + last_b * self.b_size
        flat = self.printed.take(pa.array(order))
        at = np.frombuffer(flat.buffers()[1], dtype=np.int32, count=len(flat) + 1)
        tokens = np.concatenate([[0], np.cumsum(counts[:, 0] + counts[:, 1])])
        printed = pa.StringArray.from_buffers(len(stretch), pa.py_buffer(at[tokens].astype(np.int32)), flat.buffers()[2] or pa.py_buffer(b""))
        row = len(self.counts)
        self.memo.update(zip(new, range(row, row + len(new)), strict=True))
        self.counts = np.concatenate([self.counts, counts])
        self.uses = np.concatenate([self.uses, np.zeros(len(counts), dtype=np.int64)])
        self.codes = np.concatenate([self.codes, codes])
        self.code_end = np.concatenate([self.code_end, self.code_end[-1] + np.cumsum(links)])
        self.groups = pa.concat_arrays([self.groups, printed])
        self.held += 180 * len(new) + 3 * base + 8 * len(codes) + int(at[-1])

    def align(self, texts: list[str]) -> tuple[np.ndarray, pa.Array, tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Per text tokens of A and B, groups; the printed groups; and (first, code, times) of its distinct links."""
        # A text with the mark never has the right bytes: no piece decodes to the mark.
        cut = [(stretches(" " + t) if self.cuttable else [" " + t]) if t and MARK not in t else [] for t in texts]
        if self.held > MEMO_BYTES:
            self.forget()
        new = list(set().union(*cut) - self.memo.keys())
        if new:
            self.learn(new)
        memo = self.memo
        rows = np.array([memo[s] for c in cut for s in c], dtype=np.int64)
        self.uses += np.bincount(rows, minlength=len(self.uses))
        text = np.repeat(np.arange(len(texts)), [len(c) for c in cut])
        wrong = np.zeros(len(texts), dtype=bool)
        wrong[text[self.counts[rows, 3] == 0]] = True
        keep = ~wrong[text]
        rows, text = rows[keep], text[keep]
        counts = np.stack([np.bincount(text, weights=self.counts[rows, k], minlength=len(texts)) for k in range(3)], axis=1).astype(np.int64)
        flat = self.groups.take(pa.array(rows))
        at = np.frombuffer(flat.buffers()[1], dtype=np.int32, count=len(flat) + 1) if len(flat) else np.zeros(1, dtype=np.int32)
        bounds = at[np.searchsorted(text, np.arange(len(texts) + 1))].astype(np.int32)
        printed = pa.StringArray.from_buffers(len(texts), pa.py_buffer(bounds), (flat.buffers()[2] if len(flat) else None) or pa.py_buffer(b""))
        size = self.code_end[rows + 1] - self.code_end[rows]
        key = np.repeat(text, size) * (self.a_size * self.b_size) + self.codes[_ranges(self.code_end[rows], size)]
        key, times = np.unique(key, return_counts=True)
        of, code = np.divmod(key, self.a_size * self.b_size)
        return counts, pc.utf8_rtrim(printed, ";"), (np.searchsorted(of, np.arange(len(texts) + 1)), code, times)


def aligner(a_path: str, b_path: str) -> Aligner:
    if (a_path, b_path) not in _OPEN:
        _OPEN[a_path, b_path] = Aligner(a_path, b_path)
    return _OPEN[a_path, b_path]


def align(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``id_col``, n_a, n_b, n_groups, n_links bigint, ``groups`` string (``a1,a2|b1;a3|b2,b3``: A and
    B ids of each group in order) and ``links`` array<struct<code bigint, times int>>: its distinct pairs of linked
    ids, ``code = a * (size of B's vocabulary) + b``, with their number of links.

    The paths are files that every executor can open."""
    kept = only(docs, id_col, text_col)
    link = pa.struct([("code", pa.int64()), ("times", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        al = aligner(a_path, b_path)
        for b in slices(batches, 1, SLICE):
            counts, printed, (first, code, times) = al.align([t or "" for t in b.column(1).to_pylist()])
            links = pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.StructArray.from_arrays(
                [pa.array(code), pa.array(times.astype(np.int32))], fields=list(link)))
            n = [*counts.T, counts[:, 0] + counts[:, 1] - counts[:, 2]]
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(np.ascontiguousarray(x)) for x in n), printed, links],
                                             [id_col, "n_a", "n_b", "n_groups", "n_links", "groups", "links"])

    kind = kept.schema[id_col].dataType.simpleString()
    return kept.mapInArrow(run, f"`{id_col}` {kind}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups string, "
                                "links array<struct<code:bigint,times:int>>")


def pair_counts(aligned: DataFrame, b_size: int) -> DataFrame:
    """code, ``n`` (links of the pair in all texts) and ``best`` (no pair with its B id has more)."""
    each = aligned.select(F.explode("links").alias("l")).groupBy(F.col("l.code").alias("code")).agg(F.sum("l.times").alias("n"))
    each = stored(each, "pair-counts")
    top = each.groupBy((F.col("code") % b_size).alias("b")).agg(F.max("n").alias("top"))
    return each.join(top, F.col("code") % b_size == F.col("b")).select("code", "n", (F.col("n") == F.col("top")).alias("best"))


def _frequent(pairs: DataFrame, limit: int) -> int:
    """A count that at most ``limit`` pairs reach, read from a histogram of the counts' logarithms."""
    step = F.floor(F.log2("n") * 8).cast("int")
    held = 0
    least = None
    for r in pairs.groupBy(step.alias("s")).agg(F.count(F.lit(1)).alias("pairs"), F.min("n").alias("n")).orderBy(F.col("s").desc()).collect():  # at most 8 * 64 rows
        held += r["pairs"]
        if held > limit:
            break
        least = r["n"]
    return least if least is not None else (1 << 62)


def link_sums(aligned: DataFrame, pairs: DataFrame, key: str) -> DataFrame:
    """``key``, n_best and count_sum: links whose pair is its B id's most frequent, and the pairs' counts over
    all links, of every row that has links.  ``pairs`` is read several times; ``key`` must be unique."""
    least = _frequent(pairs, LOOKUP)
    often, rare = pairs.filter(F.col("n") >= least), pairs.filter(F.col("n") < least)
    each = aligned.select(key, F.explode("links").alias("l")).select(key, "l.code", "l.times")
    hot = F.broadcast(often.select("code", "n", "best"))  # at most LOOKUP rows
    sums = [F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("n")).alias("count_sum")]
    found = each.join(hot, "code").groupBy(key).agg(*sums)
    rest = each.join(hot, "code", "left_anti").join(rare, "code").groupBy(key).agg(*sums)
    return found.unionByName(rest).groupBy(key).agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))


def alignment_table(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row the counts of ``align`` and ``link_sums`` and ``groups_sha256`` ('' without tokens)."""
    import sentencepiece

    b_size = sentencepiece.SentencePieceProcessor(model_file=b_path).vocab_size()
    digest = F.when(F.col("n_a") > 0, F.sha2(F.col("groups").cast("binary"), 256)).otherwise("")
    rows = align(docs, a_path, b_path, id_col, text_col).withColumn("groups_sha256", digest).drop("groups")
    rows = stored(rows.withColumn("__row", F.monotonically_increasing_id()), "aligned", compression="zstd")
    pairs = stored(pair_counts(rows, b_size), "pairs")
    sums = link_sums(rows, pairs, "__row")
    zero = F.lit(0).cast("bigint")
    return rows.drop("links").join(sums, "__row", "left").select(
        id_col, "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", zero).alias("n_best"),
        F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256")
