"""Operator 10: mixing sources to target weights by entropy balancing (DataFrame functions only).

Targets.  Sources in code-point order (null last) weigh 1, 2, 3, repeating, and
share all words by weight; a target stops at ``cap`` times its source's words
and the excess is shared again until none is above.

Rates.  Among the mixes that take a source's target of words, the one of least
relative entropy to "every document once", with at most ``cap`` copies each,
tilts the odds of every copy exponentially in the document's size:

    rate(x) = cap / (1 + (cap - 1) * exp(-lambda * x)),   x = size / mean size

``lambda`` of each source is the root of the convex dual's derivative
(words taken - target), found by Newton steps inside a bracket.  Rates depend
only on (source, size), so every step is a distributed aggregate over the
histogram of sizes, not over documents.

Copies.  Down the sizes of a source the expected copies are summed and rounded
as they run (systematic rounding: the words taken stay within one document of
the target); then single copies are moved by the size nearest to what is left.
Within a (source, size) cell the copies are spread evenly, the odd ones by the
hash of the id, with cells above ``CELL`` rows counted in hashed parts.

Defined cases: null and empty texts have size 0, are taken once and count no
words; a source without words has target 0; targets at the cap take every
document ``cap`` times; repeated rows are mixed like any others; extra columns
are ignored; an empty table gives an empty table.  Reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.llm.common import stored

WORD = r"[^\x20\x09-\x0D]+"
CELL = 50_000


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def source_targets(hist: DataFrame, weights: tuple[int, ...] = (1, 2, 3), cap: int = 3) -> DataFrame:
    """``hist(source, size, n)`` -> (source, source_size, docs, target double, sid)."""
    src = hist.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).cast("bigint").alias("source_size"),
                                     F.sum("n").alias("docs"))
    # Dense numbers in code-point order: place in a range partition plus the rows of earlier partitions.
    src = stored(src.repartitionByRange(F.col("source").asc_nulls_last()).sortWithinPartitions(F.col("source").asc_nulls_last())
                 .withColumn("at", F.monotonically_increasing_id()), "sources")
    src = src.withColumn("part", F.shiftright("at", 33))
    parts = src.groupBy("part").agg(F.count(F.lit(1)).alias("rows"))  # one row per range partition
    before = parts.select("part", F.coalesce(F.sum("rows").over(
        W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    src = (src.join(before, "part").withColumn("sid", F.col("before") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1)))
           .withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("sid") % len(weights) + 1).cast("int"))))
    src = stored(src.select("source", "sid", "source_size", "docs", "weight"), "weighted")
    most = F.col("source_size") * cap
    level, capped = 0.0, -1
    while True:
        over = most < F.col("weight") * F.lit(level)
        r = src.agg(F.sum("source_size").alias("all"), F.sum(F.when(over, most).otherwise(0)).alias("fixed"),
                    F.sum(F.when(~over, F.col("weight")).otherwise(0)).alias("free"), F.sum(over.cast("int")).alias("capped")).first()
        if not r["all"] or not r["free"] or r["capped"] == capped:
            break
        level, capped = (r["all"] - r["fixed"]) / r["free"], r["capped"]
    return src.withColumn("target", F.least(most.cast("double"), F.col("weight") * F.lit(level)))


def tilt(hist: DataFrame, src: DataFrame, cap: int = 3, tolerance: float = 1e-7, max_steps: int = 200) -> DataFrame:
    """``hist(sid, size, n)``, ``src(sid, source_size, docs, target)`` -> (sid, scale, lam);
    ``lam`` is infinite where the target is all or nothing."""
    state = src.select("sid", "source_size", "target", F.when(F.col("source_size") > 0, F.col("source_size") / F.col("docs")).otherwise(F.lit(1.0)).alias("scale"),
                       F.when(F.col("target") >= F.col("source_size") * cap, F.lit(float("inf")))
                       .when(F.col("target") <= 0, F.lit(float("-inf"))).otherwise(F.lit(0.0)).alias("lam"),
                       F.lit(float("-inf")).alias("lo"), F.lit(float("inf")).alias("hi"), F.lit(False).alias("done"))
    state = state.withColumn("done", F.abs("lam") == F.lit(float("inf")))
    state = stored(state, "dual")
    for _ in range(max_steps):
        if not state.filter("not done").limit(1).count():
            return state.select("sid", "scale", "lam")
        open_ = state.filter("not done")
        x = F.col("size") / F.col("scale")
        rate = rate_of(x, F.col("lam"), cap)
        step = (hist.join(open_.select("sid", "scale", "lam"), "sid").withColumn("r", rate).groupBy("sid")
                .agg(F.sum(F.col("n") * F.col("size") * F.col("r")).alias("got"),
                     F.sum(F.col("n") * F.col("size") * x * F.col("r") * (1 - F.col("r") / cap)).alias("slope")))
        gap = F.col("got") - F.col("target")
        lo = F.when(gap < 0, F.col("lam")).otherwise(F.col("lo"))
        hi = F.when(gap > 0, F.col("lam")).otherwise(F.col("hi"))
        s = (open_.join(step, "sid").withColumn("lo", lo).withColumn("hi", hi)
             .withColumn("newton", F.col("lam") - gap / F.greatest(F.col("slope"), F.lit(1e-300))))
        inside = (F.col("newton") > F.col("lo")) & (F.col("newton") < F.col("hi"))
        limited = F.least(F.greatest(F.col("newton"), F.col("lam") * 2 - 4 - F.abs("lam")), F.col("lam") * 2 + 4 + F.abs("lam"))
        bisect = F.when(F.abs("lo") == F.lit(float("inf")), F.col("hi") * 2 - 4 - F.abs("hi")) \
                  .when(F.abs("hi") == F.lit(float("inf")), F.col("lo") * 2 + 4 + F.abs("lo")).otherwise((F.col("lo") + F.col("hi")) / 2)
        near = (F.abs(gap) <= F.lit(tolerance) * F.col("target")) | (F.col("hi") - F.col("lo") <= 1e-12 * (1 + F.abs("lam")))
        nxt = F.when(near, F.col("lam")).when(inside, limited).otherwise(bisect)
        s = s.select("sid", "source_size", "target", "scale", nxt.alias("lam"), "lo", "hi", near.alias("done"))
        state = stored(s.unionByName(state.filter("done")).coalesce(8), "dual")
    raise RuntimeError(f"the dual did not settle in {max_steps} steps")


def rate_of(x: Column, lam: Column, cap: int) -> Column:
    inf = F.lit(float("inf"))
    return (F.when(x <= 0, F.lit(1.0)).when(lam == inf, F.lit(float(cap))).when(lam == -inf, F.lit(0.0))
            .otherwise(cap / (1 + (cap - 1) * F.exp(F.greatest(F.lit(-700.0), F.least(F.lit(700.0), -lam * x))))))


def cell_copies(hist: DataFrame, src: DataFrame, dual: DataFrame, cap: int = 3, repairs: int = 3) -> DataFrame:
    """(sid, size, n, k): copies ``k`` that the ``n`` documents of a cell get together."""
    c = hist.join(dual, "sid").withColumn("e", F.col("n") * rate_of(F.col("size") / F.col("scale"), F.col("lam"), cap))
    # One row per distinct size of a source: bounded by the longest document's words, not by the documents.
    run = F.sum("e").over(W.partitionBy("sid").orderBy(F.col("size").desc()).rowsBetween(W.unboundedPreceding, 0))
    c = c.withColumn("upto", run)
    ends = F.floor(F.round("upto", 6) + 0.5) - F.floor(F.round(F.col("upto") - F.col("e"), 6) + 0.5)
    c = c.select("sid", "size", "n", F.least(F.greatest(ends, F.lit(0)), F.col("n") * cap).cast("bigint").alias("k"))
    c = stored(c, "cells")
    for _ in range(repairs):
        left = (c.groupBy("sid").agg(F.sum(F.col("k") * F.col("size")).alias("got")).join(src.select("sid", "target"), "sid")
                .select("sid", (F.col("target") - F.col("got")).alias("left")))
        able = F.when(F.col("left") > 0, F.col("k") < F.col("n") * cap).otherwise(F.col("k") > 0)
        off = F.abs(F.abs("left") - F.col("size"))
        moved = (c.join(left, "sid").filter(able & (F.col("size") > 0) & (off < F.abs("left"))).groupBy("sid")
                 .agg(F.min_by(F.struct("size", F.signum("left").cast("bigint").alias("move")), F.struct(off, "size")).alias("m"))
                 .select("sid", F.col("m.size").alias("size"), F.col("m.move").alias("move")))
        c = stored(c.join(moved, ["sid", "size"], "left")
                   .select("sid", "size", "n", (F.col("k") + F.coalesce("move", F.lit(0))).alias("k")), "cells")
    return c


def mix_plan(rows: DataFrame, weights: tuple[int, ...] = (1, 2, 3), cap: int = 3) -> DataFrame:
    """``rows(source, size, h, ...)`` -> its columns with source_size, target and ``copies`` bigint.

    ``rows`` is read several times: pass a stored table."""
    hist = stored(rows.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")), "histogram")
    src = stored(source_targets(hist, weights, cap), "targets")
    named = src.select(F.col("source").alias("__source"), "sid")
    hist = stored(hist.join(named, F.col("source").eqNullSafe(F.col("__source"))).select("sid", "size", "n"), "histogram")
    cells = cell_copies(hist, src, tilt(hist, src, cap), cap)
    cells = cells.select("sid", "size", F.floor(F.col("k") / F.col("n")).alias("base"),
                         (F.col("k") % F.col("n")).alias("odd"), F.ceil(F.col("n") / CELL).alias("parts"))
    facts = src.select(F.col("source").alias("__source"), "sid", "source_size", "target")
    r = (rows.join(facts, F.col("source").eqNullSafe(F.col("__source"))).drop("__source").join(cells, ["sid", "size"])
         .withColumn("part", F.pmod("h", "parts")))
    counts = r.groupBy("sid", "size", "part", "odd").agg(F.count(F.lit(1)).alias("m"))
    before = F.coalesce(F.sum("m").over(W.partitionBy("sid", "size").orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    quota = counts.select("sid", "size", "part", F.greatest(F.lit(0), F.least(F.col("m"), F.col("odd") - before)).alias("quota"))
    place = F.row_number().over(W.partitionBy("sid", "size", "part").orderBy("h", "tie"))
    return (r.join(quota, ["sid", "size", "part"]).withColumn("copies", (F.col("base") + (place <= F.col("quota")).cast("int")).cast("bigint"))
            .drop("sid", "part", "parts", "base", "odd", "quota"))


def mix(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), cap: int = 3, id_col: str = "doc_id",
        text_col: str = "text", source_col: str = "source") -> DataFrame:
    """Per row: ``doc_id``, ``digest`` (of the text), source, size, source_size, target, ``copies``."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("digest"), F.col(source_col).alias("source"),
                       words(F.col(text_col)).alias("size"))
    rows = stored(rows.withColumn("h", F.xxhash64("doc_id")).withColumn("tie", F.struct("doc_id", "digest")), "sizes")
    return mix_plan(rows, weights, cap).drop("h", "tie")


def repeated_rows(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), cap: int = 3) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them."""
    cols = docs.columns
    plan = (mix(docs, weights, cap).groupBy("doc_id", "digest", "source")
            .agg(F.sum("copies").alias("__copies"), F.count(F.lit(1)).alias("__rows")).filter("__copies > 0")
            .select(F.col("doc_id").alias("__id"), F.col("digest").alias("__digest"), F.col("source").alias("__source"), "__copies", "__rows"))
    same = (F.col("doc_id").eqNullSafe(F.col("__id")) & (F.xxhash64("text") == F.col("__digest"))
            & F.col("source").eqNullSafe(F.col("__source")))
    once = docs.join(plan.filter("__rows = 1"), same).select(*cols, "__copies")
    again = (docs.join(plan.filter("__rows > 1"), same).groupBy("__id", "__digest", "__source", "__copies")
             .agg(F.min_by(F.struct(*cols), F.xxhash64(*cols)).alias("__row")).select("__row.*", "__copies"))
    out = once.unionByName(again)
    return out.withColumn("__i", F.explode(F.expr("sequence(1L, __copies)"))).select(*cols)
