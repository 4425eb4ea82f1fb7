"""Mixing sources to token targets by entropy balancing.

Targets: sources in code point order (null last) weigh ``weights``, repeating,
and share ``share`` times all words; a target stops at ``cap`` times its
source's words and the excess goes to the others by weight.

Rates: among all document rates in [0, cap] that meet every source's target,
those nearest to 1 in relative entropy are the exponential tilts
``min(cap, exp(lambda_source * size / mean size))``. Newton's method on the
convex dual finds each source's lambda. A rate depends on (source, size) only,
so the distributed iterations run over the exact histogram of sizes, summed in
decimals so that reruns agree in every digit; a step
that leaves the bracket of the root is replaced by bisection.

Rounding: along the sizes of a source, whole copies follow the running sum of
the rates (error of a few documents at most), then single copies are added or
dropped, alone or in pairs, where that brings the words taken nearer to the
target. Which documents of
one (source, size) get the extra copy is decided by a hash of the id, so
reruns agree and repeated rows of one id are treated alike.

Defined cases: null text counts 0 words, null source is a source; a document
without words keeps rate 1 and takes nothing; a source without words has
target 0; an empty table gives an empty result. Columns of ``docs`` named like
an added one are replaced, all others are kept.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ranked, saved, word_count

WEIGHTS, SHARE, CAP = (5, 2, 1), 1.5, 2
TOLERANCE, MAX_STEPS, MOVES = 1e-10, 100, 64
EXACT = "decimal(38,12)"  # in which words are summed, so that no sum depends on the order of the tasks
ADDED = ("size", "source_size", "target", "rate", "copies", "taken")


def targets(sources: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, cap: int = CAP) -> DataFrame:
    """Adds _rank and target to (source, source_size)."""
    shares = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_rank") - 1) % len(weights) + 1)
    table = saved(ranked(sources, "source", "_rank").withColumn("_rank", F.col("_rank").cast("int"))
                  .withColumn("_weight", shares.cast("double")), "sources")
    limit, level, held = F.lit(float(cap)) * F.col("source_size"), 0.0, -1
    while True:  # each round only adds to the sources held at their limit
        over = limit < F.col("_weight") * F.lit(level)
        all_words, fixed, weight, n = table.agg(
            F.sum("source_size"), F.sum(F.when(over, limit)), F.sum(F.when(~over, F.col("_weight"))),
            F.count(F.when(over, 1))).first()
        if n == held or not weight or not all_words:
            break
        held, level = n if level else -1, (share * (all_words or 0) - (fixed or 0.0)) / weight
    return table.withColumn("target", F.least(limit, F.col("_weight") * F.lit(level)))


def tilts(sizes: DataFrame, goals: DataFrame, cap: int = CAP) -> DataFrame:
    """(_rank, lam): the root of each source's dual; null where the target is the cap (every rate is the cap).

    ``sizes``: (_rank, size, n); ``goals``: (_rank, source_size, target, docs).
    """
    start = goals.select("_rank", "target", (F.col("source_size") / F.greatest("docs", F.lit(1))).alias("mean"),
                         F.when(F.col("target") >= cap * F.col("source_size"), None).otherwise(0.0).alias("lam"),
                         F.lit(float("-inf")).alias("lo"), F.lit(float("inf")).alias("hi"))
    state = saved(start, "dual")
    for _ in range(MAX_STEPS):
        x = F.col("size") / F.col("mean")
        e = F.exp(F.least(F.col("lam") * x, F.lit(700.0)))
        words = F.col("n") * F.col("size")
        steps = sizes.where("size > 0").join(state.where("lam is not null"), "_rank").groupBy("_rank").agg(
            F.sum((words * F.least(e, F.lit(float(cap)))).cast(EXACT)).cast("double").alias("mass"),
            F.sum(F.when(e < cap, words * x * e).otherwise(0.0).cast(EXACT)).cast("double").alias("slope"))
        gap = F.col("mass") - F.col("target")
        lo, hi = F.when(gap < 0, F.col("lam")).otherwise(F.col("lo")), F.when(gap > 0, F.col("lam")).otherwise(F.col("hi"))
        newton = F.col("lam") - gap / F.col("slope")
        wide = (F.col("lo") == float("-inf")) | (F.col("hi") == float("inf"))
        middle = F.when(wide, F.when(gap < 0, F.col("lam") + 1 + F.abs("lam")).otherwise(F.col("lam") - 1 - F.abs("lam"))) \
            .otherwise((F.col("lo") + F.col("hi")) / 2)
        moved = (state.join(steps, "_rank", "left").withColumn("lo", F.coalesce(lo, "lo")).withColumn("hi", F.coalesce(hi, "hi"))
                 .withColumn("done", F.col("mass").isNull() | (F.abs(gap) <= F.lit(TOLERANCE) * F.col("target"))
                             | (F.col("hi") - F.col("lo") <= F.lit(1e-14) * (1 + F.abs("lam"))))
                 .withColumn("lam", F.when(F.col("done"), F.col("lam"))
                             .when((F.col("slope") > 0) & (newton > F.col("lo")) & (newton < F.col("hi")), newton)
                             .otherwise(middle)))
        moved = saved(moved.select(*state.columns, "done"), "dual")
        state = moved.drop("done")
        if moved.where("not done").isEmpty():
            break
    return state.select("_rank", "lam", "mean")


def _whole_copies(hist: pd.DataFrame, cap: int) -> pd.DataFrame:
    """One source's (size, n, rate, target) -> per size the sure copies and how many documents get one more."""
    hist = hist.sort_values("size").reset_index(drop=True)
    size, n, rate = hist["size"].to_numpy(), hist["n"].to_numpy(), hist["rate"].to_numpy()
    run = np.cumsum(n * rate)
    copies = np.clip(np.diff(np.floor(run + 0.5 + 1e-9), prepend=0).astype(np.int64), 0, cap * n)
    target = hist["target"].iloc[0]
    for _ in range(MOVES):  # add or drop one copy, or two at once, while that narrows the gap
        gap = target - float((size * copies).sum())
        add, drop = np.flatnonzero((copies < cap * n) & (size > 0)), np.flatnonzero((copies > 0) & (size > 0))
        where, sign = np.concatenate((add, drop)), np.repeat((1, -1), (len(add), len(drop)))
        if not len(where):
            break
        change = sign * size[where]
        order = np.argsort(change, kind="stable")
        where, sign, change = where[order], sign[order], change[order]
        alone = np.abs(gap - change)
        best, move = alone.min(), [int(alone.argmin())]
        near = np.searchsorted(change, gap - change)
        for k in (near - 1, near):
            k = np.clip(k, 0, len(change) - 1)
            both = np.where(where[k] == where, np.inf, np.abs(gap - change - change[k]))
            if both.min() < best:
                best, move = both.min(), [int(both.argmin()), int(k[both.argmin()])]
        if not best < abs(gap):
            break
        for m in move:
            copies[where[m]] += sign[m]
    return pd.DataFrame({"_rank": hist["_rank"], "size": size, "n": n, "rate": rate, "base": copies // n, "more": copies % n})


def mix(docs: DataFrame, size: Column | None = None, id_col: str = "doc_id", source_col: str = "source",
        text_col: str = "text", weights: tuple = WEIGHTS, share: float = SHARE, cap: int = CAP) -> DataFrame:
    """``docs`` with size, source_size, target, rate, copies and taken (= copies * size)."""
    size = word_count(F.col(text_col)) if size is None else size
    order = F.xxhash64(F.col(id_col).cast("string"))
    small = saved(docs.select(F.col(source_col).alias("source"), size.cast("long").alias("size"), order.alias("_hash")), "sizes")
    per = saved(small.groupBy("source", "size").agg(F.count("*").alias("n")), "histogram")
    totals = per.groupBy("source").agg(F.sum(F.col("n") * F.col("size")).alias("source_size"), F.sum("n").alias("docs"))
    goals = saved(targets(totals, weights, share, cap), "targets")
    sizes = per.join(goals.select(F.col("source").alias("_s"), "_rank"), F.col("source").eqNullSafe(F.col("_s"))) \
        .select("_rank", "size", "n")
    lams = tilts(sizes, goals, cap)
    tilt = F.exp(F.least(F.col("lam") * F.col("size") / F.col("mean"), F.lit(700.0)))
    rate = F.when(F.col("size") == 0, 1.0).when(F.col("lam").isNull(), float(cap)).otherwise(F.least(tilt, F.lit(float(cap))))
    rated = sizes.join(lams, "_rank").withColumn("rate", rate) \
        .join(goals.select("_rank", "target"), "_rank").select("_rank", "size", "n", "rate", "target")
    plan = saved(rated.groupBy("_rank").applyInPandas(
        lambda h: _whole_copies(h, cap), "_rank int, size long, n long, rate double, base long, more long"), "copies")

    # the documents of one (source, size) in hash order: the hash up to which there is one more copy
    some = plan.where("more > 0 and more < n").join(goals.select("_rank", F.col("source").alias("_s")), "_rank") \
        .select("_s", F.col("size").alias("_z"), "more")
    same = F.col("source").eqNullSafe(F.col("_s")) & (F.col("size") == F.col("_z"))
    split = small.join(some, same).withColumn("_slice", F.shiftright(F.col("_hash"), 52))
    counts = split.groupBy("_s", "_z", "_slice").agg(F.count("*").alias("c"), F.max("more").alias("more"))
    before = F.coalesce(F.sum("c").over(Window.partitionBy("_s", "_z").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    at = counts.withColumn("b", before).where("b < more and more <= b + c") \
        .select(F.col("_s").alias("_s2"), F.col("_z").alias("_z2"), F.col("_slice").alias("_slice2"), "b")
    inside = split.join(at, F.col("_s").eqNullSafe(F.col("_s2")) & (F.col("_z") == F.col("_z2")) & (F.col("_slice") == F.col("_slice2")))
    rank = F.row_number().over(Window.partitionBy("_s", "_z").orderBy("_hash"))
    cut = inside.withColumn("r", rank).where("r = more - b").select("_s", "_z", F.col("_hash").alias("_upto"))
    rules = (plan.join(goals.select("_rank", F.col("source").alias("_mix_source"), "source_size", "target"), "_rank")
             .join(cut, F.col("_mix_source").eqNullSafe(F.col("_s")) & (F.col("size") == F.col("_z")), "left")
             .select("_mix_source", *[F.col(c).alias(f"_mix_{c}") for c in
                                      ("size", "source_size", "target", "rate", "base", "more", "n", "_upto")]))
    rules = saved(rules, "rules")

    # names with a prefix: the columns of ``docs`` may have any others
    out = docs.withColumns({"_mix_words": size.cast("long"), "_mix_order": order, "_mix_of": F.col(source_col)}).drop(*ADDED)
    out = out.join(rules, F.col("_mix_of").eqNullSafe(F.col("_mix_source")) & (F.col("_mix_words") == F.col("_mix_size")))
    extra = (F.col("_mix_more") > 0) & (F.col("_mix_order") <= F.col("_mix__upto"))
    copies = (F.col("_mix_base") + F.when(extra, 1).otherwise(0)).cast("long")
    added = {"size": F.col("_mix_size"), "source_size": F.col("_mix_source_size"), "target": F.col("_mix_target"),
             "rate": F.col("_mix_rate"), "copies": copies, "taken": copies * F.col("_mix_size")}
    return out.select(*[c for c in docs.columns if c not in ADDED], *[added[c].alias(c) for c in ADDED])


def sized(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size), read from the texts once."""
    return saved(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")), "words")
