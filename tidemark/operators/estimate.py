"""Coverage estimation by capture and recapture over sightings.

A sighting row has id, fonte, rodada, nivel, publicado_em, hash_texto and ord. A unit is the text's hash, or the page
where there is none; a page's last row decides, over all rows, whatever their level.

Every figure but the curve follows from `subsets`: how many units exactly which channels have. That table has at most
2 ** channels rows a stratum, so each figure is one pass over the sightings and array expressions over a small row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions import text as X
from tidemark.functions import url as U

#: Channels whose window is short: comparable only where all channels are cut to one window.
SHORT_WINDOW = ("gdelt",)


def sightings(items: DataFrame, least: int = 2) -> DataFrame:
    """Sightings of triaged items of at least a level, one row each time; repeats across runs are meant."""
    rows = items.filter((F.col("situacao") == "triado") & (F.coalesce("nivel", F.lit(0)) >= least) & F.col("url").isNotNull())
    return rows.select("ord", U.identity(F.col("url")).alias("id"), X.channel(F.col("fonte")).alias("canal"), "fonte", "rodada", "nivel", "publicado_em", "hash_texto", U.unarchived(F.col("url")).alias("url"))


def observed(seen: DataFrame, strata: DataFrame, least: int = 2, since: Column | None = None) -> DataFrame:
    """(estrato, canal, rodada, unidade) of qualifying sightings, the first run of each channel's page; with `since`,
    undated rows are out.

    Sightings of a page fold to one row for each of its strata and channels before its unit is known, so nothing is
    joined and no page gathers more rows than there are channels.
    """
    level = F.try_to_number(F.col("nivel"), F.lit("9")).cast("int") if dict(seen.dtypes)["nivel"] == "string" else F.col("nivel")
    ok = F.coalesce(level, F.lit(0)) >= least
    if since is not None:
        ok = ok & F.coalesce(F.col("publicado_em") >= since, F.lit(False))
    rows = seen.join(strata.select("fonte", F.col("estrato").alias("_s")), "fonte", "left")
    unit = F.coalesce(F.nullif("hash_texto", F.lit("")), F.col("id"))
    rows = rows.select("id", F.coalesce("_s", F.lit("geral")).alias("estrato"), X.channel(F.col("fonte")).alias("canal"), "rodada", "ord", unit.alias("u"), ok.alias("ok"))
    folded = rows.groupBy("id", "estrato", "canal").agg(F.min(F.when(F.col("ok"), F.col("rodada"))).alias("rodada"), F.bool_or("ok").alias("ok"), F.max_by("u", "ord").alias("u"), F.max("ord").alias("ord"))
    pages = folded.groupBy("id").agg(F.max_by("u", "ord").alias("unidade"), F.collect_list(F.when(F.col("ok"), F.struct("estrato", "canal", "rodada"))).alias("x"))
    return pages.select(F.explode("x").alias("x"), "unidade").select("x.estrato", "x.canal", "x.rodada", "unidade")


def subsets(obs: DataFrame) -> DataFrame:
    """(estrato, canais, n): number of units that exactly these channels, in order, have."""
    units = obs.groupBy("estrato", "unidade").agg(F.array_sort(F.collect_set("canal")).alias("canais"))
    return units.groupBy("estrato", "canais").agg(F.count("*").alias("n"))


def _by_stratum(obs: DataFrame) -> DataFrame:
    """(estrato, x: array of struct<canais, n>, all: its channels)."""
    rows = subsets(obs).groupBy("estrato").agg(F.collect_list(F.struct("canais", "n")).alias("x"))
    return rows.withColumn("all", F.array_sort(F.array_distinct(F.flatten(F.transform("x", lambda s: s["canais"])))))


def _total(keep, start: int = 0) -> Column:
    """Sum of n over the subsets that keep(canais) holds for."""
    return F.aggregate("x", F.lit(start).cast("bigint"), lambda acc, s: acc + F.when(keep(s["canais"]), s["n"]).otherwise(0))


def _comparable(aligned: bool):
    return (lambda c: c) if aligned else (lambda c: F.filter(c, lambda x: ~x.isin(*SHORT_WINDOW)))


def per_channel(obs: DataFrame) -> DataFrame:
    """(estrato, canal, unidades, exclusivas): units of each channel, and those no other channel has."""
    each = subsets(obs).select("estrato", F.explode("canais").alias("canal"), "n", (F.size("canais") == 1).alias("own"))
    return each.groupBy("estrato", "canal").agg(F.sum("n").alias("unidades"), F.sum(F.when(F.col("own"), F.col("n")).otherwise(0)).alias("exclusivas"))


def frequencies(obs: DataFrame, aligned: bool = False) -> DataFrame:
    """(estrato, k, n): number of units that exactly k comparable channels have."""
    k = F.size(_comparable(aligned)(F.col("canais"))).cast("bigint")
    return subsets(obs).groupBy("estrato", k.alias("k")).agg(F.sum("n").alias("n")).filter("k > 0")


def coverage(obs: DataFrame, aligned: bool = False) -> DataFrame:
    """(estrato, observadas, canais, f1, f2, chao, cobertura); the lower bound is null with fewer than two
    comparable channels, and coverage is those channels' units divided by it."""
    mine = _comparable(aligned)
    k = lambda n: _total(lambda c: F.size(mine(c)) == n)
    j = _by_stratum(obs).select("estrato", _total(lambda c: F.lit(True)).alias("observadas"), F.size(mine(F.col("all"))).cast("bigint").alias("canais"), k(1).alias("f1"), k(2).alias("f2"), _total(lambda c: F.size(mine(c)) > 0).alias("s"))
    f1, f2, s = (F.col(c).cast("double") for c in ("f1", "f2", "s"))
    chao = F.when(F.col("canais") >= 2, F.when(f2 > 0, s + f1 * f1 / (2 * f2)).otherwise(s + f1 * (f1 - 1) / 2))
    return j.select("estrato", "observadas", "canais", "f1", "f2", F.round(chao, 6).alias("chao"), F.round(F.when(chao > 0, s / chao), 6).alias("cobertura"))


def pairs(obs: DataFrame, aligned: bool = False) -> DataFrame:
    """(estrato, a, b, n1, n2, m, chapman, baixo, alto, comparavel) of all pairs of channels, those without overlap too."""
    two = F.flatten(F.transform("all", lambda a, i: F.transform(F.slice("all", i + 2, F.size("all")), lambda b: F.struct(a.alias("a"), b.alias("b")))))
    j = _by_stratum(obs).select("estrato", "x", F.explode(two).alias("p")).select("estrato", "x", "p.a", "p.b")
    has = lambda *names: _total(lambda c: F.array_size(F.array_intersect(c, F.array(*names))) == len(names))
    j = j.select("estrato", "a", "b", has("a").alias("n1"), has("b").alias("n2"), has("a", "b").alias("m"))
    n1, n2, m = (F.col(c).cast("double") for c in ("n1", "n2", "m"))
    estimate = (n1 + 1) * (n2 + 1) / (m + 1) - 1
    spread = 1.96 * F.sqrt((n1 + 1) * (n2 + 1) * (n1 - m) * (n2 - m) / ((m + 1) * (m + 1) * (m + 2)))
    short = F.col("a").isin(*SHORT_WINDOW) | F.col("b").isin(*SHORT_WINDOW)
    return j.select("estrato", "a", "b", "n1", "n2", "m", F.round(estimate, 6).alias("chapman"), F.round(F.greatest(n1 + n2 - m, estimate - spread), 6).alias("baixo"), F.round(estimate + spread, 6).alias("alto"), (F.lit(aligned) | ~short).alias("comparavel"))


def curve(obs: DataFrame, runs: DataFrame) -> DataFrame:
    """(estrato, rodada, novas, total): units new in each run and their running sum, from a stratum's first run on.

    runs has every run of the table, those without qualifying rows too; the grid has one row per stratum and run.
    """
    first = obs.groupBy("estrato", "unidade").agg(F.min("rodada").alias("rodada"))
    new = first.groupBy("estrato", "rodada").agg(F.count("*").alias("n"))
    start = new.groupBy("estrato").agg(F.min("rodada").alias("_from"))
    grid = start.join(runs.select("rodada").filter("rodada is not null").distinct(), F.col("rodada") >= F.col("_from")).select("estrato", "rodada")
    w = Window.partitionBy("estrato").orderBy("rodada").rowsBetween(Window.unboundedPreceding, 0)
    each = grid.join(new, ["estrato", "rodada"], "left").withColumn("novas", F.coalesce("n", F.lit(0)))
    return each.select("estrato", "rodada", "novas", F.sum("novas").over(w).alias("total"))
