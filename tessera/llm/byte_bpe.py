"""Byte-level BPE ids of texts by the tokenizers library, one call for each new stretch of text.

A text is cut before every space and newline that follows a character that is not
white space.  The byte-level pattern starts a new unit at such a place whatever
stands around it, so the ids of a text are those of its stretches in a row.  A
worker remembers stretches (up to ``MEMO_BYTES``, then those not used of late go:
this bounds memory, not the result).  New ones are encoded joined together; the
tokens' lengths in bytes say which ids belong to which.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa

MEMO_BYTES = 256 << 20
#: Stretches encoded in one call, in characters.
JOINED = 1 << 14
_UNEVEN = re.compile(r"\s[ \n]|\0")
_CUT = re.compile(r"(?<=\S)(?=[ \n])")

_OPEN: dict[str, "ByteBpe"] = {}


def stretches(text: str) -> list[str]:
    """The text cut before every space and newline that follows a non-space character."""
    if _UNEVEN.search(text):
        return _CUT.split(text)
    return text.replace(" ", "\0 ").replace("\n", "\0\n").split("\0")


def pieces(texts: list[str]) -> tuple[pa.Array, np.ndarray]:
    """All texts' ``stretches`` in a row, and the number of the first one of each text (then that of all)."""
    coded = [t.encode() for t in texts]
    data = b"".join(coded)
    begin = np.concatenate([[0], np.cumsum(np.fromiter(map(len, coded), dtype=np.int64, count=len(coded)))])
    buf = np.frombuffer(data, dtype=np.uint8)
    new = (buf == 32) | (buf == 10)
    for i, t in enumerate(texts):
        if _UNEVEN.search(t):  # not before every space and newline
            parts = stretches(t)
            new[begin[i]:begin[i + 1]] = False
            new[begin[i] + np.cumsum([0, *(len(p.encode()) for p in parts[:-1])])] = True
    new[begin[:-1][begin[:-1] < begin[1:]]] = True
    first = np.flatnonzero(new)
    offsets = np.append(first, len(data))
    return (pa.LargeStringArray.from_buffers(len(first), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data)),
            np.searchsorted(offsets, begin))


def joined(new: list[str], limit: int = JOINED) -> list[list[str]]:
    """Stretches in groups that may stand in a row: all but the first of a group begin with a space
    or newline, all but the last end with a character that is none."""
    out: list[list[str]] = []
    size, open_end = 0, False
    for s in new:
        if open_end and s[:1] in (" ", "\n") and size < limit:
            out[-1].append(s)
            size += len(s)
        else:
            out.append([s])
            size = len(s)
        open_end = bool(s) and not s[-1].isspace()
    return out


class ByteBpe:
    """``ids`` of texts as little-endian 32-bit numbers."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings are plain text
        # A byte-level token has a letter for each of its bytes.
        self.size = np.array([len(self.tokenizer.id_to_token(i) or "") for i in range(self.tokenizer.get_vocab_size())])
        self.memo: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.held = 0

    def learn(self, new: list[str]) -> None:
        for group in joined(new):
            ids = np.array(self.tokenizer.encode("".join(group), add_special_tokens=False).ids, dtype="<u4")
            end = np.cumsum([len(s.encode()) for s in group])
            cut = (4 * np.searchsorted(np.cumsum(self.size[ids]), end, side="right")).tolist()
            data = ids.tobytes()
            at = 0
            for s, to in zip(group, cut, strict=True):
                self.memo[s] = data[at:to]
                at = to
            self.held += len(data) + int(end[-1]) + 200 * len(group)

    def ids(self, texts: list[str]) -> list[bytes]:
        # Looking up a stretch that is not in the processor's cache is dear, so each is looked up once for all its places.
        cut, at = pieces(texts)
        held = cut.dictionary_encode()
        distinct = held.dictionary.to_pylist()
        if 2 * self.held > MEMO_BYTES:  # what was not used since the last time goes
            self.memo, self.older, self.held = {}, self.memo, 0
        memo, older = self.memo, self.older
        new = [s for s in distinct if s not in memo]
        for s in new:
            if s in older:
                memo[s] = older[s]
                self.held += 200 + len(s) + len(older[s])
        self.learn([s for s in new if s not in memo])
        found = [memo[s] for s in distinct]
        size = np.fromiter(map(len, found), dtype=np.int64, count=len(found)) // 4
        place = held.indices.to_numpy()
        n = size[place]
        end = np.concatenate([[0], np.cumsum(n)])
        take = np.arange(end[-1]) + np.repeat((np.cumsum(size) - size)[place] - end[:-1], n)
        data = np.frombuffer(b"".join(found), dtype="<u4")[take].tobytes()
        bounds = (4 * end[at]).tolist()
        return [data[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


def byte_bpe(path: str) -> ByteBpe:
    if path not in _OPEN:
        _OPEN[path] = ByteBpe(path)
    return _OPEN[path]
