"""Mixing sources to target token shares by entropy balancing (problem 9).

Each document d of source s gets a rate w_d, the expected number of its copies. Among all rates that give every
source the same multiple of its target weight in tokens, the ones nearest to one copy each in relative entropy are

    w_d = min(cap_s, exp(lambda_s * t_d / mean_s)),

with t_d the tokens of d and mean_s their mean in s. lambda solves the convex dual, one coordinate per source; Newton's
method runs over the histogram (source, n_tokens, block, n_docs), so an iteration is one map-side aggregated job that
returns one row per source (as many as the target table has). Rates become whole copies by systematic rounding along
the documents of a source in order of size: the copies of any run of documents differ from their summed rates by less
than one, so a source's tokens differ from its goal by less than one document.

Size of the mixture: the largest at which every target is met within the caps, but no more than the tokens of the
sources taken together; or a size given, at which sources with too few tokens fall short. Sources of `documents` that have no target get no copies; targets without tokens can't be
met, are reported with an actual share of 0 and leave their weight to the rest in proportion.
Defined results: null or empty texts have no tokens, no weight and no copies; repeated rows are separate documents;
a null or negative weight counts as 0, a null max_vezes as 1; repeated targets of one source add their weights and
keep the larger cap; empty tables give an empty mixture.
"""

from __future__ import annotations

import math
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.encode import DEFAULT, TOKENIZER_DIR, count_tokens
from tidemark.session import durable

#: Newton iterations at most, and the relative error of a source's tokens that ends them.
ROUNDS, TOLERANCE = 60, 1e-9
#: Blocks in which documents of one source and one size are ranked, so that a hot source or many copies are split.
SALT = 16


def targets(mix: DataFrame) -> DataFrame:
    weight = F.when(F.col("peso") > 0, F.col("peso")).otherwise(0.0)
    return mix.filter(F.col("source").isNotNull()).groupBy("source").agg(F.sum(weight).alias("target"), F.max(F.greatest(F.coalesce("max_vezes", F.lit(1)), F.lit(0))).alias("cap"))


def token_table(docs: DataFrame, name: str = DEFAULT, directory: str = TOKENIZER_DIR) -> DataFrame:
    """(doc_id, source, n_tokens), written to the shared folder as every later step reads it."""
    return durable(count_tokens(docs, ["doc_id", "source"], "text", name, directory), "tokens")


def solve(hist: DataFrame, goals: list[dict], rounds: int = ROUNDS, size: float | None = None) -> list[dict]:
    """Dual variables by safeguarded Newton steps; goals has source, target, cap and comes back with the solution."""
    totals = {r["source"]: r for r in hist.filter(F.col("source").isin([g["source"] for g in goals])).groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("n_docs")).alias("t"), F.sum("n_docs").alias("n")).collect()}
    live = [g for g in goals if g["target"] > 0 and g["cap"] > 0 and g["source"] in totals]
    weight = sum(g["target"] for g in live)
    if not live or weight <= 0:
        return []
    for g in live:
        tokens, docs = totals[g["source"]]["t"], totals[g["source"]]["n"]
        g |= {"share": g["target"] / weight, "tokens": float(tokens), "mean": tokens / docs, "lam": 0.0, "lo": -math.inf, "hi": math.inf}
    # the multiplier of the smallest feasible scale: a target equal to its cap would need an infinite dual variable
    size = size if size is not None else min(sum(g["tokens"] for g in live), min(g["cap"] * g["tokens"] / g["share"] for g in live))
    for g in live:
        g["goal"] = min(size * g["share"], g["cap"] * g["tokens"])
        g["full"] = g["goal"] >= g["cap"] * g["tokens"] * (1 - 1e-12)
    for _ in range(rounds):
        open_ = [g for g in live if not g["full"] and not g.get("done")]
        if not open_:
            break
        lam, mean, cap = (_lookup({g["source"]: float(g[k]) for g in open_}) for k in ("lam", "mean", "cap"))
        tilt = F.least(lam * F.col("n_tokens") / mean, F.log(cap) + 1e-6)
        rate = F.least(cap, F.exp(tilt))
        mass = rate * F.col("n_tokens") * F.col("n_docs")
        slope = F.when(rate < cap, mass * F.col("n_tokens") / mean).otherwise(0.0)
        got = {r["source"]: r for r in hist.filter(F.col("source").isin([g["source"] for g in open_])).groupBy("source").agg(F.sum(mass).alias("mass"), F.sum(slope).alias("slope")).collect()}
        for g in open_:
            r = got[g["source"]]
            gap = r["mass"] - g["goal"]
            if abs(gap) <= TOLERANCE * g["goal"]:
                g["done"] = True
                continue
            g["hi" if gap > 0 else "lo"] = g["lam"]
            step = g["lam"] - gap / r["slope"] if r["slope"] > 0 else math.nan
            if not (g["lo"] < step < g["hi"]):  # outside the bracket: bisect, or widen it while one end is open
                step = (g["lo"] + g["hi"]) / 2 if math.isfinite(g["lo"]) and math.isfinite(g["hi"]) else g["lam"] + (2.0 if gap < 0 else -2.0) * max(1.0, abs(g["lam"]))
            g["lam"] = step
    return live


def _lookup(values: dict[str, float]) -> Column:
    """A literal map over the listed sources, read by the column source."""
    return F.element_at(F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in values.items())), F.col("source"))


def copies(tokens: DataFrame, mix: DataFrame, size: float | None = None) -> DataFrame:
    """(doc_id, source, n_tokens, rate, copies) of every document that is used at least once.

    size: tokens of the whole mixture, where it should rather be large than exact: a source that can't give its share of
    them within its cap gives all it may and falls short, the others give theirs.
    """
    # one row per listed source: as many as the target table, which is fixed
    goals = [r.asDict() for r in targets(mix).collect()]
    used = tokens.filter((F.col("n_tokens") > 0) & F.col("source").isin([g["source"] for g in goals]))
    salt = F.pmod(F.xxhash64("doc_id"), F.lit(SALT)).cast("int").alias("_b")
    blocks = durable(used.groupBy("source", "n_tokens", salt).agg(F.count("*").alias("n_docs")), "token-blocks")
    live = solve(blocks, goals, size=size)
    if not live:
        return used.select("doc_id", "source", "n_tokens", F.lit(0.0).alias("rate"), F.lit(0).alias("copies")).limit(0)
    lam, mean, cap = (_lookup({g["source"]: float(g[k]) for g in live}) for k in ("lam", "mean", "cap"))
    full = F.col("source").isin([g["source"] for g in live if g["full"]])
    rate = F.when(full, cap).otherwise(F.least(cap, F.exp(F.least(lam * F.col("n_tokens") / mean, F.log(cap)))))
    in_mix = F.col("source").isin([g["source"] for g in live])
    # Documents of a source are rounded in order of size, so their copies sum to the goal within one document's tokens.
    order = Window.partitionBy("source").orderBy("n_tokens", "_b")
    before = F.sum(F.col("_rate") * F.col("n_docs")).over(order.rowsBetween(Window.unboundedPreceding, -1))
    start = blocks.filter(in_mix).withColumn("_rate", rate).select("source", "n_tokens", "_b", "_rate", F.coalesce(before, F.lit(0.0)).alias("_from"))
    rank = F.row_number().over(Window.partitionBy("source", "n_tokens", "_b").orderBy("doc_id"))
    placed = used.filter(in_mix).withColumn("_b", salt).withColumn("_k", rank).join(start, ["source", "n_tokens", "_b"])
    upto = lambda k: F.floor(F.round(F.col("_from") + k * F.col("_rate"), 7) + 0.5)
    n = (upto(F.col("_k")) - upto(F.col("_k") - 1)).cast("int")
    return placed.select("doc_id", "source", "n_tokens", F.col("_rate").alias("rate"), n.alias("copies")).filter("copies > 0")


def shares(picked: DataFrame, tokens: DataFrame, mix: DataFrame) -> DataFrame:
    """(source, target, cap, n_docs, n_tokens, used_docs, most_copies, mixed_tokens, share) of each source listed or present."""
    have = tokens.filter(F.col("source").isNotNull()).groupBy("source").agg(F.count("*").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
    got = picked.groupBy("source").agg(F.count("*").alias("used_docs"), F.max("copies").alias("most_copies"), F.sum(F.col("n_tokens") * F.col("copies")).alias("mixed_tokens"))
    zero = [F.coalesce(c, F.lit(0)).alias(c) for c in ("n_docs", "n_tokens", "used_docs", "most_copies", "mixed_tokens")]
    out = targets(mix).join(have, "source", "full").join(got, "source", "left").select("source", F.coalesce("target", F.lit(0.0)).alias("target"), F.coalesce("cap", F.lit(0)).alias("cap"), *zero)
    total = F.sum("mixed_tokens").over(Window.partitionBy())  # one row per source
    return out.withColumn("share", F.coalesce(F.col("mixed_tokens") / F.nullif(total, F.lit(0)), F.lit(0.0)))
