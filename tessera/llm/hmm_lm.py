"""Operator 2: hidden Markov language model over word tokens.

Tokens are the words of the text (A-Z lower-cased, cut at blanks) and one end.
Spark counts the tokens of the training texts into a vocabulary table.  The
``HMM_HEAD`` most frequent tokens are symbols of their own; every other token
emits the symbol of its class (hash of its last three bytes, ``CLASSES`` of
them) and then itself within the class, known tokens by count + 1 and all
unknown ones as one more.  So the model has STATES * (HMM_HEAD + CLASSES)
parameters whatever the corpus, and gives every text a probability.

Training is Baum-Welch: each task runs the scaled forward and backward
recursions over its training texts and adds up expected counts; Spark sums
them over tasks; the driver holds only the parameters.  All training texts
count in every round.  The score is the exact likelihood of the whole token
sequence by the scaled forward recursion.

Counts of the most frequent tokens (at most ``LOOKUP``, of at most
``TOKEN_BYTES`` bytes: a broadcast of at most LOOKUP * TOKEN_BYTES bytes) are
looked up inside the tasks; all others meet the vocabulary in a join.  Which
ones are frequent is read from a histogram of the counts' logarithms, so only
these tokens come to the driver.

Defined cases: null and empty texts are one end token; rows with a null id are
training rows; without training tokens every token is unknown; repeated rows
are scored (and, if training rows, counted) each; extra columns are ignored;
an empty table gives an empty table.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import only, slices, stored

END = b""
STATES = 8
HMM_HEAD = 1 << 14
CLASSES = 1 << 13
LOOKUP = 1 << 17
TOKEN_BYTES = 64
#: Tokens that one recursion holds in memory; one longer text is a recursion of its own.
CHUNK = 1 << 19


def tokens(text: str | None) -> list[bytes]:
    t = (text or "").encode("utf-8", "surrogatepass").lower().split()  # on bytes: A-Z, \x20 and \x09-\x0D only
    t.append(END)
    return t


def class_of(token: bytes) -> int:
    return xxhash.xxh64_intdigest(token[-3:]) % CLASSES


def held_out(id_col: str = "doc_id", parts: int = 7, held: int = 2) -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % parts == held, F.lit(False))


def vocabulary(texts: DataFrame, text_col: str) -> DataFrame:
    """(token binary, class int, n bigint) of all tokens of the texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c: Counter = Counter()

        def flush() -> pa.RecordBatch:
            t = list(c)
            b = pa.RecordBatch.from_arrays([pa.array(t, pa.binary()), pa.array(list(map(class_of, t)), pa.int32()),
                                            pa.array(list(c.values()), pa.int64())], ["token", "class", "n"])
            c.clear()
            return b

        for b in slices(batches, 0):
            for t in b.column(0).to_pylist():
                c.update(tokens(t))
            if len(c) > 500_000:
                yield flush()
        if c:
            yield flush()

    return (only(texts, text_col).mapInArrow(run, "token binary, class int, n bigint")
            .groupBy("token", "class").agg(F.sum("n").alias("n")))


@dataclass
class Lookup:
    """Counts and symbols of the frequent tokens, class sizes, totals."""

    index: dict[bytes, int]
    count: np.ndarray
    symbol: np.ndarray
    class_total: np.ndarray  # tokens of the class that are no symbols of their own, plus distinct ones, plus one
    total: int
    distinct: int

    @property
    def base_total(self) -> int:
        return self.total + self.distinct + 1


def lookup_of(vocab: DataFrame) -> Lookup:
    sums = vocab.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    short = vocab.filter(F.octet_length("token") <= TOKEN_BYTES).withColumn("size", F.floor(F.log2("n") * 64))
    least, held = None, 0
    for r in sorted(short.groupBy("size").agg(F.count(F.lit(1)).alias("tokens")).collect(), reverse=True):  # at most 64 a power of two
        if held + r["tokens"] > LOOKUP:
            break
        least, held = r["size"], held + r["tokens"]
    top = short.filter(F.col("size") >= least if least is not None else F.lit(False)).select("token", "class", "n").toPandas()
    top = top.assign(token=[bytes(t) for t in top["token"]]).sort_values(["n", "token"], ascending=[False, True], ignore_index=True)
    per_class = vocab.groupBy("class").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).toPandas()
    words = list(top["token"])
    if END not in words[:HMM_HEAD] and END in words:
        i = words.index(END)
        words.insert(0, words.pop(i))
        top = top.iloc[[i, *(j for j in range(len(top)) if j != i)]]
    count, cls = top["n"].to_numpy(dtype=np.int64), top["class"].to_numpy(dtype=np.int64)
    size = np.ones(CLASSES, dtype=np.int64)
    np.add.at(size, per_class["class"].to_numpy(dtype=np.int64), (per_class["n"] + per_class["v"]).to_numpy(dtype=np.int64))
    np.subtract.at(size, cls[:HMM_HEAD], count[:HMM_HEAD] + 1)
    symbol = np.arange(len(words))
    symbol[HMM_HEAD:] = HMM_HEAD + cls[HMM_HEAD:]
    return Lookup({w: i for i, w in enumerate(words)}, count, symbol.astype(np.uint16), size, int(sums[0]), int(sums[1]))


def encoded(docs: DataFrame, shared, id_col: str, text_col: str) -> DataFrame:
    """Per row: id, held_out, n_tokens, n_known and sums over the looked-up tokens, the
    symbol sequence, and the other tokens with counts."""
    kept = docs.select(F.col(id_col), held_out(id_col).alias("held_out"), F.col(text_col))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lk: Lookup = shared.value
        index, log_n = lk.index, np.log10(lk.count + 1.0)
        log_class = np.log10(lk.class_total.astype(np.float64))
        memo: dict[bytes, int] = {}
        for b in slices(batches, 2):
            sym, rest, known, logs, inner, size = [], [], [], [], [], []
            for t in b.column(2).to_pylist():
                toks = tokens(t)
                at = np.array([index.get(x, -1) for x in toks], dtype=np.int64)
                miss = np.flatnonzero(at < 0)
                hit = at[at >= 0]
                s = np.empty(len(at), dtype=np.uint16)
                s[at >= 0] = lk.symbol[hit]
                tail = [toks[i] for i in miss.tolist()]
                for i, x in zip(miss.tolist(), tail, strict=True):
                    k = memo.get(x)
                    if k is None:
                        if len(memo) > 1 << 19:
                            memo.clear()
                        k = memo[x] = class_of(x)
                    s[i] = HMM_HEAD + k
                in_class = s >= HMM_HEAD
                size.append(len(at))
                known.append(len(hit))
                logs.append(float(log_n[hit].sum()))
                inner.append(float(log_n[hit[hit >= HMM_HEAD]].sum() - log_class[s[in_class].astype(np.int64) - HMM_HEAD].sum()))
                sym.append(s.tobytes())
                rest.append([{"token": x, "n": n} for x, n in Counter(tail).items()])
            kind = pa.list_(pa.struct([("token", pa.binary()), ("n", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(size, pa.int64()), pa.array(known, pa.int64()), pa.array(logs, pa.float64()),
                 pa.array(inner, pa.float64()), pa.array(sym, pa.binary()), pa.array(rest, kind)],
                [id_col, "held_out", "n_tokens", "known", "logs", "inner", "symbols", "rest"])

    out = kept.mapInArrow(run, f"`{id_col}` {kept.schema[id_col].dataType.simpleString()}, held_out boolean, n_tokens bigint, "
                               "known bigint, logs double, inner double, symbols binary, rest array<struct<token:binary,n:bigint>>")
    return stored(out.withColumn("row", F.monotonically_increasing_id()).sortWithinPartitions(F.desc("n_tokens")), "encoded")


@dataclass
class Hmm:
    start: np.ndarray  # states
    move: np.ndarray  # states x states
    emit: np.ndarray  # symbols x states

    @classmethod
    def first(cls, unigram: np.ndarray, states: int, seed: int = 7) -> "Hmm":
        """Sticky moves; emissions are the symbol frequencies, shaken state by state."""
        rnd = np.random.default_rng(seed)
        emit = unigram[:, None] * np.exp(rnd.normal(0, 0.5, size=(len(unigram), states)))
        move = np.full((states, states), 0.1 / states) + 0.9 * np.eye(states)
        return cls(np.full(states, 1 / states), move, (emit / emit.sum(axis=0)))


class _Packed:
    """Sequences laid out step by step, longest first: step t is a row for every
    sequence longer than t."""

    def __init__(self, seqs: list[np.ndarray]):
        self.size = np.array([len(s) for s in seqs], dtype=np.int64)
        self.order = np.argsort(-self.size, kind="stable")
        size = self.size[self.order]
        steps = int(size[0])
        self.alive = np.searchsorted(-size, -np.arange(steps), side="left")  # sequences longer than t
        self.at = np.concatenate([[0], np.cumsum(self.alive)])
        flat = np.concatenate([seqs[i] for i in self.order])
        rank = np.repeat(np.arange(len(size)), size)
        t = np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)
        self.place = self.at[t] + rank
        self.symbols = np.empty(len(flat), dtype=np.int64)
        self.symbols[self.place] = flat

    def forward(self, m: Hmm) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Emission rows, scaled forward rows, scales."""
        emit = m.emit.astype(np.float32)[self.symbols]
        move = m.move.astype(np.float32)
        alpha = np.empty_like(emit)
        scale = np.empty(len(emit), dtype=np.float32)
        n = self.alive[0]
        a = emit[:n] * m.start.astype(np.float32)
        at = self.at
        for t, n in enumerate(self.alive.tolist()):
            lo = at[t]
            if t:
                a = a[:n] @ move
                a *= emit[lo:lo + n]
            s = a.sum(axis=1)
            a /= s[:, None]
            alpha[lo:lo + n] = a
            scale[lo:lo + n] = s
        return emit, alpha, scale

    def loglik(self, scale: np.ndarray) -> np.ndarray:
        """Natural log likelihood per sequence, in the given order."""
        logs = np.log(scale.astype(np.float64))[self.place]
        size = self.size[self.order]
        out = np.empty(len(size))
        out[self.order] = np.add.reduceat(logs, np.cumsum(size) - size)
        return out

    def expected(self, m: Hmm, emit: np.ndarray, alpha: np.ndarray, scale: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Expected moves (states x states) and state shares of every row."""
        back = m.move.astype(np.float32).T.copy()
        emit /= scale[:, None]
        states = emit.shape[1]
        moves = np.zeros((states, states))
        last = len(self.alive) - 1
        beta = np.ones((self.alive[last], states), dtype=np.float32)
        for t in range(last, -1, -1):
            lo, n = self.at[t], self.alive[t]
            if t < last:
                full = np.ones((n, states), dtype=np.float32)
                full[:len(beta)] = beta
                beta = full
            w = emit[lo:lo + n] * beta
            alpha_t = alpha[lo:lo + n]
            if t:
                moves += alpha[self.at[t - 1]:self.at[t - 1] + n].T @ w
            alpha_t *= beta  # now the state shares
            beta = w @ back
        return moves * m.move, alpha


def _chunks(seqs: Iterator[np.ndarray], limit: int) -> Iterator[list[np.ndarray]]:
    held, n = [], 0
    for s in seqs:
        if held and n + len(s) > limit:
            yield held
            held, n = [], 0
        held.append(s)
        n += len(s)
    if held:
        yield held


def _sequences(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[np.ndarray]:
    for b in batches:
        for s in b.column(column).to_pylist():
            yield np.frombuffer(s, dtype=np.uint16).astype(np.int64)


def baum_welch(enc: DataFrame, unigram: np.ndarray, states: int = STATES, rounds: int = 4) -> tuple[Hmm, list[float]]:
    """Model after ``rounds`` over the training rows of ``enc``, and the log likelihood before each round."""
    spark = enc.sparkSession
    train = enc.filter("not held_out").select("symbols")
    n_symbols = len(unigram)
    m = Hmm.first(unigram, states)
    history = []
    cols = [f"s{k}" for k in range(states)]
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(m)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            now: Hmm = shared.value
            counts = np.zeros((states, n_symbols))
            moves, start, ll = np.zeros((states, states)), np.zeros(states), 0.0
            for seqs in _chunks(_sequences(batches, 0), CHUNK):
                p = _Packed(seqs)
                emit, alpha, scale = p.forward(now)
                ll += float(np.log(scale.astype(np.float64)).sum())
                mv, share = p.expected(now, emit, alpha, scale)
                moves += mv
                start += share[:p.alive[0]].sum(axis=0)
                for k in range(states):
                    counts[k] += np.bincount(p.symbols, weights=share[:, k], minlength=n_symbols)
            at = np.flatnonzero(counts.any(axis=0))
            # Rows below 0: -1 the start, -2 the log likelihood, -3 - i the moves from state i.
            key = np.concatenate([at, [-1, -2], -3 - np.arange(states)])
            rows = np.concatenate([counts[:, at].T, start[None], np.full((1, states), ll), moves])
            yield pa.RecordBatch.from_arrays([pa.array(key, pa.int64()), *[pa.array(np.ascontiguousarray(rows[:, k])) for k in range(states)]],
                                             ["key", *cols])

        got = (train.mapInArrow(run, "key bigint, " + ", ".join(f"{c} double" for c in cols)).groupBy("key")
               .agg(*[F.sum(c).alias(c) for c in cols]).toPandas())  # at most symbols + states + 2 rows
        shared.unpersist()
        key, val = got["key"].to_numpy(dtype=np.int64), got[cols].to_numpy(dtype=np.float64)
        if not len(key):
            break
        history.append(float(val[key == -2][0, 0]))
        emit = np.zeros((n_symbols, states))
        emit[key[key >= 0]] = val[key >= 0]
        moves = np.zeros((states, states))
        for k, v in zip(key, val, strict=True):
            if k <= -3:
                moves[-3 - k] = v
        start = val[key == -1][0] + 1.0
        moves += 1.0
        emit = emit + unigram[:, None] * 100.0  # every symbol stays possible in every state
        m = Hmm(start / start.sum(), moves / moves.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))
    return m, history


def score_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", states: int = STATES, rounds: int = 4) -> DataFrame:
    """``id_col``, held_out, n_tokens, n_known, train_tokens bigint, base_score, score double (log10) of every row."""
    docs = only(docs, id_col, text_col)
    spark = docs.sparkSession
    vocab = stored(vocabulary(docs.filter(~held_out(id_col)), text_col), "vocabulary")
    lk = lookup_of(vocab)
    shared = spark.sparkContext.broadcast(lk)
    enc = encoded(docs, shared, id_col, text_col)
    unigram = np.ones(HMM_HEAD + CLASSES)
    unigram[:min(HMM_HEAD, len(lk.count))] += lk.count[:HMM_HEAD]
    unigram[HMM_HEAD:] = lk.class_total
    model = spark.sparkContext.broadcast(baum_welch(enc, unigram / unigram.sum(), states, rounds)[0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 1, 2 * CHUNK):
            p = _Packed(list(_sequences(iter([b]), 1)))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(p.loglik(p.forward(model.value)[2]) / np.log(10.0))], ["row", "chain"])

    chain = enc.select("row", "symbols").mapInArrow(run, "row bigint, chain double")
    rest = (enc.select("row", F.explode("rest").alias("t")).select("row", "t.token", F.col("t.n").alias("times"))
            .join(vocab.select("token", "n"), "token").groupBy("row")
            .agg(F.sum("times").alias("rest_known"), F.sum(F.col("times") * F.log10(F.col("n") + F.lit(1.0))).alias("rest_logs")))
    zero = F.lit(0.0)
    logs = F.col("logs") + F.coalesce("rest_logs", zero)
    return (enc.select("row", id_col, "held_out", "n_tokens", "known", "logs", "inner").join(chain, "row").join(rest, "row", "left")
            .select(id_col, "held_out", "n_tokens", (F.col("known") + F.coalesce("rest_known", F.lit(0))).alias("n_known"),
                    F.lit(lk.total).cast("bigint").alias("train_tokens"),
                    (logs - F.col("n_tokens") * F.lit(float(np.log10(lk.base_total)))).alias("base_score"),
                    (F.col("chain") + F.col("inner") + F.coalesce("rest_logs", zero)).alias("score")))
