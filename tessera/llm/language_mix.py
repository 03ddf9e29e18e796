"""Operator 1: language mixtures by expectation-maximisation over n-gram likelihoods.

Learning.  Per language of the labelled rows, letter trigrams of the words
(with word ends) are counted into ``BUCKETS`` hashed cells and their two-letter
contexts into as many.  Each task adds up its own counts; Spark sums the
non-empty cells.  A word's likelihood under a language is the product of its
smoothed conditional trigram probabilities.  The model has
2 * BUCKETS * languages numbers whatever the size of the corpus.

Prediction.  A text is a mixture: each word comes from one language, drawn by
the text's own proportions.  Expectation-maximisation estimates these.  The
language set is selected by penalised likelihood: languages enter by
proportion, and a set of m is kept while the log likelihood gains more than
``penalty * ln(words)`` for each further language.

Defined cases: null texts and texts without a letter give ``und``, score 0 and
no mixture; rows with a null label are not learned from; with nothing to learn
from every text is ``und``; ties go to the language first in code-point order;
repeated rows are predicted alike; extra columns are ignored; an empty table
gives an empty table.  More than ``MAX_LANGUAGES`` labels raise an error.  ``identified``
drops only null texts and texts without a letter where there is nothing to learn
from or too many labels.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import only, slices

BUCKETS = 1 << 16
MAX_LANGUAGES = 500
LETTERS = re.compile(r"[^\W\d_]+")
_PRIME = np.uint64(0x9E3779B97F4A7C15)


class TooManyLabels(ValueError):
    """More than ``MAX_LANGUAGES`` labels."""


def word_counts(text: str | None) -> Counter:
    """Lower-cased runs of letters."""
    return Counter(LETTERS.findall((text or "").lower()))


def cells(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed trigram cell, context cell, and word number of every trigram of the
    words, each written as blank, blank, letters, blank."""
    if not words:
        e = np.empty(0, dtype=np.int64)
        return e, e, e
    code = np.frombuffer(("  " + "   ".join(words) + " ").encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    size = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    start = np.concatenate([[0], np.cumsum(size + 3)[:-1]])
    n = size + 1  # trigrams of a word
    word = np.repeat(np.arange(len(words)), n)
    at = np.arange(len(word)) - np.repeat(np.cumsum(n) - n, n) + start[word]
    context = (code[at] * _PRIME + code[at + 1] + np.uint64(1)) * _PRIME
    tri = (context + code[at + 2]) * _PRIME
    shift = np.uint64(64 - BUCKETS.bit_length() + 1)
    return (tri >> shift).astype(np.int64), (context * _PRIME >> shift).astype(np.int64), word


class LanguageModel:
    """Log conditional trigram probabilities per cell and language."""

    def __init__(self, languages: list[str], tri: np.ndarray, context: np.ndarray, alpha: float = 0.05):
        self.languages = languages
        self.tri = np.log(tri + alpha).astype(np.float32)  # languages x cells
        self.context = np.log(context + alpha * 64).astype(np.float32)

    def word_scores(self, words: list[str]) -> np.ndarray:
        """Natural-log likelihood of each word (rows) under each language."""
        t, c, w = cells(words)
        out = np.empty((len(words), len(self.languages)))
        for k in range(len(self.languages)):
            out[:, k] = np.bincount(w, weights=self.tri[k][t] - self.context[k][c], minlength=len(words))
        return out

    def mixtures(self, docs: list[Counter], penalty: float) -> tuple[np.ndarray, np.ndarray]:
        """Proportions (texts x languages, zero outside the selected set) and log likelihood a word."""
        index: dict[str, int] = {}
        unit = np.array([index.setdefault(w, len(index)) for d in docs for w in d], dtype=np.int64)
        count = np.concatenate([np.fromiter(d.values(), dtype=np.float64, count=len(d)) for d in docs])
        per = np.array([len(d) for d in docs], dtype=np.int64)
        scores = self.word_scores(list(index))
        top = scores.max(axis=1)
        like = np.ascontiguousarray(np.exp(scores - top[:, None]).T[:, unit])  # languages x words of texts
        units = _Units(like, count, per)
        total = np.add.reduceat(count, units.start)
        base = np.add.reduceat(count * top[unit], units.start)
        m, n = like.shape[0], len(docs)
        pi = units.fit(np.full((m, n), 1 / m))
        full = units.value(pi)
        order = np.argsort(-pi, axis=0, kind="stable")
        place = np.argsort(order, axis=0)
        best = (place == 0).astype(np.float64)
        loglike = units.value(best)
        cost = penalty * np.log(total + 1)
        # No set can gain more than all languages together.
        open_ = np.flatnonzero(full - loglike > cost)
        for size in range(2, m + 1):
            if not len(open_):
                break
            part = units.of(open_)
            grown = part.fit(np.where(place < size, pi + 1e-3, 0)[:, open_])
            ll = part.value(grown)
            better = ll - loglike[open_] > cost[open_]
            won = open_[better]
            best[:, won], loglike[won] = grown[:, better], ll[better]
            open_ = won[full[won] - loglike[won] > cost[won]]
        return best.T, (loglike + base) / total


class _Units:
    """The words of some texts: likelihoods (languages x words), counts, words per text."""

    def __init__(self, like: np.ndarray, count: np.ndarray, per: np.ndarray):
        self.like, self.count, self.per = like, count, per
        self.start = np.cumsum(per) - per
        self.doc = np.repeat(np.arange(len(per)), per)
        self.total = np.add.reduceat(count, self.start)

    def of(self, texts: np.ndarray) -> "_Units":
        n = self.per[texts]
        rows = np.repeat(self.start[texts] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        return _Units(self.like[:, rows], self.count[rows], n)

    def value(self, pi: np.ndarray) -> np.ndarray:
        """Log likelihood of each text."""
        p = np.einsum("lw,lw->w", self.like, pi[:, self.doc])
        return np.add.reduceat(self.count * np.log(np.maximum(p, 1e-300)), self.start)

    def fit(self, pi: np.ndarray, rounds: int = 12, steps: int = 4, tolerance: float = 1e-3) -> np.ndarray:
        """Expectation-maximisation from ``pi`` (languages x texts); texts that have settled leave early."""
        pi = pi / pi.sum(axis=0)
        units, at = self, np.arange(pi.shape[1])
        for _ in range(rounds):
            now = pi[:, at]
            for _ in range(steps):
                was = now
                p = units.like * now[:, units.doc]
                p *= units.count / np.maximum(p.sum(axis=0), 1e-300)
                now = np.add.reduceat(p, units.start, axis=1) / units.total
            pi[:, at] = now
            moving = np.abs(now - was).max(axis=0) > tolerance
            if not moving.any():
                break
            if moving.mean() < 0.7:
                units, at = units.of(np.flatnonzero(moving)), at[moving]
        return pi


def learned_rows(id_col: str = "doc_id", parts: int = 5, held: int = 0) -> Column:
    """True where crc32 of the id as text leaves another remainder than ``held``; null ids are held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % parts != held, F.lit(False))


def learn(labelled: DataFrame, text_col: str = "text", label_col: str = "lang") -> LanguageModel | None:
    """Model of the rows with a label; None if there is none."""
    kept = only(labelled, text_col, label_col).filter(F.col(label_col).isNotNull() & F.col(text_col).isNotNull())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, a in sums.items():
                at = np.flatnonzero(a)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at), pa.array(a[at])], ["lang", "cell", "n"])
            sums.clear()

        for b in slices(batches, 0):
            words: dict[str, Counter] = {}
            for t, lang in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                words.setdefault(lang, Counter()).update(LETTERS.findall(t.lower()))
            for lang, c in words.items():
                tri, context, w = cells(list(c))
                n = np.fromiter(c.values(), dtype=np.float64, count=len(c))[w]
                a = sums.setdefault(lang, np.zeros(2 * BUCKETS))
                a[:BUCKETS] += np.bincount(tri, weights=n, minlength=BUCKETS)
                a[BUCKETS:] += np.bincount(context, weights=n, minlength=BUCKETS)
            if len(sums) > 64:
                yield from flush()
        yield from flush()

    total = kept.mapInArrow(run, "lang string, cell bigint, n double").groupBy("lang", "cell").agg(F.sum("n").alias("n"))
    total = total.withColumn("n", F.col("n").cast("double"))
    names = [r[0] for r in kept.select(label_col).distinct().limit(MAX_LANGUAGES + 1).collect()]
    if len(names) > MAX_LANGUAGES:
        raise TooManyLabels(f"more than {MAX_LANGUAGES} labels")
    if not names:
        return None
    names.sort()
    got = total.toPandas()  # at most 2 * BUCKETS * MAX_LANGUAGES cells, whatever the corpus
    a = np.zeros((len(names), 2 * BUCKETS))
    a[np.array([names.index(x) for x in got["lang"]], dtype=np.int64), got["cell"].to_numpy()] = got["n"].to_numpy()
    return LanguageModel(names, a[:, :BUCKETS], a[:, BUCKETS:])


def predict(docs: DataFrame, model: LanguageModel | None, text_col: str = "text", carry: tuple[str, ...] = ("doc_id",),
            penalty: float = 2.0) -> DataFrame:
    """The columns ``carry`` and ``lang_pred``, ``score`` (share of the predicted language), ``mixture``
    (map of the selected languages' shares), ``word_loglik`` double."""
    # The text goes to the tasks once, and back only if it is carried.
    kept = docs.select(docs[text_col].alias("__text"), *[docs[c] for c in carry if c != text_col])
    back = [0 if c == text_col else 1 + i for c, i in zip(carry, np.cumsum([c != text_col for c in carry]) - 1, strict=True)]
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lm = shared.value
        for b in slices(batches, 0, 2 << 20):
            found = [word_counts(t) for t in b.column(0).to_pylist()]
            at = [i for i, c in enumerate(found) if c] if lm else []
            lang, score, mix, ll = ["und"] * len(found), [0.0] * len(found), [None] * len(found), [None] * len(found)
            if at:
                share, per_word = lm.mixtures([found[i] for i in at], penalty)
                for i, p, v, top in zip(at, share.tolist(), per_word.tolist(), share.argmax(axis=1).tolist(), strict=True):
                    lang[i], score[i], ll[i] = lm.languages[top], min(1.0, p[top]), v
                    mix[i] = [(lm.languages[k], x) for k, x in enumerate(p) if x > 0]
            yield pa.RecordBatch.from_arrays(
                [*(b.column(int(i)) for i in back), pa.array(lang, pa.string()), pa.array(score, pa.float64()),
                 pa.array(mix, pa.map_(pa.string(), pa.float64())), pa.array(ll, pa.float64())],
                [*carry, "lang_pred", "score", "mixture", "word_loglik"])

    kinds = "".join(f"`{c}` {docs.schema[c].dataType.simpleString()}, " for c in carry)
    return kept.mapInArrow(run, kinds + "lang_pred string, score double, mixture map<string,double>, word_loglik double")


def identify(docs: DataFrame, penalty: float = 2.0, carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Predictions for all rows of ``docs``, learned from its own labelled rows that are not held out."""
    model = learn(docs.filter(learned_rows()))
    return predict(docs, model, carry=carry, penalty=penalty).withColumn("held_out", ~learned_rows())


def with_letters(docs: DataFrame, columns: tuple[str, ...], text_col: str = "text") -> DataFrame:
    """The named columns of the rows whose text has a letter."""
    kept = only(docs, text_col, *columns)
    names = [f"c{i}" for i in range(len(columns))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 0):
            has = [t is not None and LETTERS.search(t.lower()) is not None for t in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(b.columns[1:], names).filter(pa.array(has, pa.bool_()))

    kinds = ", ".join(f"{n} {f.dataType.simpleString()}" for n, f in zip(names, kept.schema.fields[1:], strict=True))
    return kept.toDF("text", *names).mapInArrow(run, kinds).toDF(*columns)


def identified(docs: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """The named columns of the rows whose language is not ``und``; of all rows with a
    letter where no model can be learned."""
    try:
        model = learn(docs.filter(learned_rows()))
    except TooManyLabels:
        model = None
    if model is None:
        return with_letters(docs, columns)
    return predict(docs, model, carry=columns).filter("lang_pred <> 'und'").select(*columns)
