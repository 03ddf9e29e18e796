"""Operator 12: packing token sequences by linear grouping, configurations and best fit.

Documents are encoded and cut into pieces (``pieces``).  Packing needs nothing of
them but how many have each length: at most ``capacity`` numbers, the only thing
collected to the driver (``plan``):

1. Linear grouping.  Large lengths are sorted and cut into groups of equal
   cardinality; in a group all count as its longest.
2. Configurations.  The fewest sequences that hold the rounded lengths are a
   linear programme over the ways to fill a sequence with few sizes; columns
   are priced by a knapsack table.  Whole parts of its solution are used.
3. Substitution.  Every place of a configuration takes an actual piece of its
   group, longest first, so equal places stay equal over long stretches.
4. Best fit.  The pieces that are left and the small ones go, longest first, into
   the fullest sequences that have room, then into new ones.

Where small pieces abound, rounding costs least if only lengths near half a sequence
are large; where there are none, more lengths should be.  ``SETTINGS`` are tried in
turn until the number of sequences is within ``NEAR`` of its lower bound; the
fewest count.

The plan's rows say: pieces of one length numbered from a to b go to sequences
from s on, so many in each, at this offset.  They are bounded by the capacity, not
by the documents, and broadcast.  Pieces are numbered within their length by
counts of (length, task that wrote them), so a length that a third of all pieces
have is dealt over as many tasks as wrote it.

Defined cases: null and empty texts are the end id alone (length 1); a text of any
length is cut into full pieces, only its first piece may be shorter; repeated rows
are packed as often as they come, with a null id like others; equal lengths are
interchangeable; extra columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.llm.byte_bpe import byte_bpe
from tessera.llm.common import only, slices, stored

CAPACITY = 2048
#: Lengths above capacity / share count as large; they are cut into so many groups.
SETTINGS = ((2.1, 128), (4, 96), (6, 64))
NEAR = 0.001
END = 0
#: Bytes of text whose stretches are looked up together.
LOOKED_UP = 8 << 20

#: A lot: that many sequences, all filled with so many pieces of each length.
Lot = tuple[int, dict[int, int]]


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, with_ids: bool = False,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, piece int, start, length, ids_crc32 bigint (and ``ids`` array<int>) of each piece of
    every text's ids and the end id.  ``tokenizer`` is a file that every executor can open."""
    kept = only(docs, id_col, text_col)
    names = [id_col, "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, end = byte_bpe(tokenizer), END.to_bytes(4, "little")
        for b in slices(batches, 1, LOOKED_UP):
            row, piece, start, size, crc, parts = [], [], [], [], [], []
            for r, ids in enumerate(bpe.ids([t or "" for t in b.column(1).to_pylist()])):
                ids += end
                n = len(ids) // 4
                at = 0
                for p in range(-(-n // capacity)):
                    to = (n - 1) % capacity + 1 + p * capacity
                    part = ids[4 * at:4 * to]
                    row.append(r)
                    piece.append(p)
                    start.append(at)
                    size.append(to - at)
                    crc.append(zlib.crc32(part))
                    if with_ids:
                        parts.append(np.frombuffer(part, dtype="<i4"))
                    at = to
            columns = [b.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, size, crc))]
            yield pa.RecordBatch.from_arrays([*columns, *([pa.array(parts, pa.list_(pa.int32()))] if with_ids else [])], names)

    kind = kept.schema[id_col].dataType.simpleString()
    return kept.mapInArrow(run, f"`{id_col}` {kind}, piece int, start bigint, length bigint, ids_crc32 bigint" + (", ids array<int>" if with_ids else ""))


def grouped(count: dict[int, int], groups: int) -> list[list[tuple[int, int]]]:
    """Lengths, longest first, in groups of equal cardinality: (length, how many) of each group."""
    total = sum(count.values())
    out: list[list[tuple[int, int]]] = []
    quota, made = 0, 0
    for size in sorted(count, reverse=True):
        n = count[size]
        while n:
            if not quota:
                quota = total * (len(out) + 1) // groups - made
                out.append([])
                if not quota:
                    continue
            take = min(n, quota)
            out[-1].append((size, take))
            n, quota, made = n - take, quota - take, made + take
    return [g for g in out if g]


def best_configuration(value: np.ndarray, source: np.ndarray, most: int) -> np.ndarray:
    """The most valuable filling with at most ``most`` pieces (a count for each size).

    ``source[i, c]`` is the room left of c after a piece of size i, or the last entry (no room)."""
    room = source.shape[1] - 1
    f, chosen = np.zeros(room + 1), []
    for _ in range(most):
        f[room] = -np.inf
        got = f[source] + value[:, None]
        best = np.argmax(got, axis=0)
        g = got[best, np.arange(room + 1)]
        better = g > f
        chosen.append(np.where(better, best, -1))
        f = np.where(better, g, f)
    out, c = np.zeros(len(value)), room - 1
    for pick in reversed(chosen):
        i = pick[c]
        if i >= 0:
            out[i] += 1
            c = source[i, c]
    return out


def configurations(sizes: np.ndarray, need: np.ndarray, capacity: int, max_rounds: int = 4000) -> tuple[np.ndarray, np.ndarray]:
    """Columns (pieces of each size in a sequence) and how many sequences of each the linear programme takes."""
    k = len(sizes)
    room = np.arange(capacity + 2)[None, :] - sizes[:, None]
    source = np.where((room >= 0) & (np.arange(capacity + 2) <= capacity), room, capacity + 1)
    basis = np.diag(capacity // sizes).astype(float)
    for _ in range(max_rounds):
        x = np.linalg.solve(basis, need)
        value = np.linalg.solve(basis.T, np.ones(k))
        column = best_configuration(value, source, int(capacity // sizes.min()))
        if value @ column <= 1 + 1e-9:
            break
        step = np.linalg.solve(basis, column)
        with np.errstate(divide="ignore", invalid="ignore"):
            ratio = np.where(step > 1e-9, np.maximum(x, 0) / step, np.inf)
        basis[:, int(np.argmin(ratio))] = column
    return basis, np.maximum(np.linalg.solve(basis, need), 0)


def substituted(groups: list[list[tuple[int, int]]], columns: np.ndarray, times: np.ndarray) -> list[Lot]:
    """Lots of the configurations' whole parts, places filled with actual lengths; the groups are used up."""
    queues = [list(reversed(g)) for g in groups]
    lots: list[Lot] = []
    for c in range(columns.shape[1]):
        places = [g for g in range(len(groups)) for _ in range(int(round(columns[g, c])))]
        left = int(times[c] + 1e-6)
        short = Counter(places)
        left = min([left, *(sum(n for _, n in queues[g]) // k for g, k in short.items())])
        taken = []  # per place the lengths it takes, in order
        for g in places:
            want, got = left, []
            while want:
                size, n = queues[g].pop()
                take = min(n, want)
                got.append((size, take))
                want -= take
                if n > take:
                    queues[g].append((size, n - take))
            taken.append(got)
        edges = sorted({0, left}.union(*(np.cumsum([n for _, n in got]).tolist() for got in taken)))
        ends = [np.cumsum([n for _, n in got]) for got in taken]
        for a, b in zip(edges, edges[1:], strict=False):
            lots.append((b - a, dict(Counter(got[int(np.searchsorted(e, a, side="right"))][0] for got, e in zip(taken, ends, strict=True)))))
    for g, q in zip(groups, queues, strict=True):
        g[:] = q
    return lots


def best_fit(lots: list[Lot], count: dict[int, int], capacity: int) -> list[Lot]:
    """Puts the counted lengths, longest first, into the fullest sequences with room, then into new ones."""
    by_room: dict[int, list[Lot]] = {}
    for n, held in lots:
        by_room.setdefault(capacity - sum(s * k for s, k in held.items()), []).append((n, held))

    def put(n: int, held: dict[int, int], room: int, size: int, k: int) -> None:
        if n:
            by_room.setdefault(room - k * size, []).append((n, held | {size: held.get(size, 0) + k} if k else held))

    for size in sorted(count, reverse=True):
        left = count[size]
        while left:
            room = min((r for r in by_room if r >= size and by_room[r]), default=None)
            n, held = by_room[room].pop() if room is not None else (left, {})
            room = capacity if room is None else room
            each = room // size  # equal pieces go on filling a sequence while it is the fullest
            full = min(n, left // each)
            put(full, held, room, size, each)
            left -= full * each
            if full < n and left:
                put(1, held, room, size, left)
                full, left = full + 1, 0
            if held:
                put(n - full, held, room, size, 0)
    return [lot for ls in by_room.values() for lot in ls]


def grouped_plan(count: dict[int, int], capacity: int, least: float, groups: int) -> list[Lot]:
    """Lots that hold the counted lengths; those above ``least`` go through ``groups`` groups."""
    large = {s: n for s, n in count.items() if least < s < capacity}
    lots: list[Lot] = [(count[capacity], {capacity: 1})] if count.get(capacity) else []
    cut = grouped(large, groups)
    if cut:
        columns, times = configurations(np.array([g[0][0] for g in cut]), np.array([sum(n for _, n in g) for g in cut], dtype=float), capacity)
        lots += substituted(cut, columns, times)
    rest = Counter({s: n for s, n in count.items() if s <= least})
    for g in cut:
        for size, n in g:
            rest[size] += n
    return best_fit(lots, rest, capacity)


def plan(count: dict[int, int], capacity: int = CAPACITY, settings: tuple[tuple[float, int], ...] = SETTINGS) -> list[Lot]:
    """The lots of the fewest sequences over ``settings``, tried until one is ``NEAR`` the lower bound."""
    total = sum(s * n for s, n in count.items())
    bound = max(-(-total // capacity), sum(n for s, n in count.items() if 2 * s > capacity))
    best: list[Lot] | None = None
    for share, groups in settings:
        lots = grouped_plan(count, capacity, capacity / share, groups)
        if best is None or sum(n for n, _ in lots) < sum(n for n, _ in best):
            best = lots
        if sum(n for n, _ in best) <= bound * (1 + NEAR):
            break
    return best or []


def _plan_rows(lots: list[Lot]) -> list[tuple[int, int, int, int, int, int]]:
    """(size, first, last, sequence, each, offset): pieces ``first`` to ``last`` of a size, ``each`` in a sequence."""
    used: Counter = Counter()
    rows, sequence = [], 0
    for n, held in lots:
        offset = 0
        for size, k in sorted(held.items(), reverse=True):
            rows.append((size, used[size], used[size] + n * k - 1, sequence, k, offset))
            used[size] += n * k
            offset += size * k
        sequence += n
    return rows


def pack(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces``' rows (any with a ``length`` of 1 to ``capacity``) with sequence_id and offset bigint."""
    spark = cut.sparkSession
    cut = stored(cut.withColumn("__row", F.monotonically_increasing_id()), "pieces")
    # At most ``capacity`` rows of numbers.
    count = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    rows = spark.createDataFrame(_plan_rows(plan(count, capacity)), "__size bigint, __first bigint, __last bigint, __seq bigint, __each bigint, __at bigint")
    part = F.shiftright("__row", 33)  # the task that wrote the row
    counted = cut.groupBy("length", part.alias("__part")).agg(F.count(F.lit(1)).alias("n"))
    before = W.partitionBy("length").orderBy("__part").rowsBetween(W.unboundedPreceding, -1)
    counted = counted.select(F.col("length").alias("__size"), F.col("__part").alias("__p"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__before"))
    numbered = cut.withColumn("__part", part).withColumn("__n", F.row_number().over(W.partitionBy("length", "__part").orderBy("__row")) - 1)
    numbered = numbered.join(counted, (F.col("length") == F.col("__size")) & (F.col("__part") == F.col("__p"))).withColumn(
        "__rank", F.col("__n") + F.col("__before")).drop("__size", "__p")
    placed = numbered.join(F.broadcast(rows), (F.col("length") == F.col("__size")) & F.col("__rank").between(F.col("__first"), F.col("__last")))
    nth = F.col("__rank") - F.col("__first")
    return placed.withColumns({"sequence_id": (F.col("__seq") + F.floor(nth / F.col("__each"))).cast("bigint"),
                               "offset": F.col("__at") + nth % F.col("__each") * F.col("length")}).select(
        *[c for c in cut.columns if c != "__row"], "sequence_id", "offset")
