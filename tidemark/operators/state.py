"""Per-source memory between runs as tables: seen, pending, progress and watermark.

Status of a fetched item: `triado`, `reprovado_sentinela`, `falha_captura` or `bloqueado_robots`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DONE, REJECTED, FAILED, BLOCKED = "triado", "reprovado_sentinela", "falha_captura", "bloqueado_robots"
#: Characters of extra data a pending reference may keep, and days listed anew by default.
EXTRA_LIMIT, DEFAULT_DAYS = 4000, 7


def first_wins(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The row with the smallest `order` per key; ties keep one row. Pre-aggregates before the shuffle, so hot keys fold."""
    rest = [c for c in df.columns if c not in keys]
    packed = F.struct(F.col(order).alias("_order"), *(F.col(f"`{c}`").alias(c) for c in rest))
    got = df.groupBy(*keys).agg(F.min_by(packed, F.struct(F.col(order).isNull(), F.col(order))).alias("_row"))
    return got.select(*keys, *(F.col(f"_row.`{c}`").alias(c) for c in rest)).select(*df.columns)


def last_wins(df: DataFrame, keys: list[str], order: str, value: str) -> DataFrame:
    """(keys..., value) of the row with the greatest `order`."""
    return df.groupBy(*keys).agg(F.max_by(value, order).alias(value))


def to_fetch(listed: DataFrame, pending: DataFrame | None, seen: DataFrame, keys: tuple[str, str] = ("fonte", "id_na_fonte"), order: str = "ord") -> DataFrame:
    """Listed and pending references, each once (a listed one wins over a pending one, then the first), minus those seen."""
    k = list(keys)
    refs = listed.withColumn("_origin", F.lit(0))
    if pending is not None:
        refs = refs.unionByName(pending.withColumn("_origin", F.lit(1)), allowMissingColumns=True)
    rank = F.struct("_origin", order)
    one = first_wins(refs.withColumn("_rank", rank), k, "_rank").drop("_rank", "_origin")
    return one.join(seen.select(*k).distinct(), k, "left_anti")


def window_start(explicit: Column, last_run: Column, margin: Column, configured: Column, today: Column) -> Column:
    """The explicit date, else the last run less its margin, else the configured date, else a week ago."""
    return F.coalesce(explicit, F.date_sub(last_run, F.coalesce(margin, F.lit(0))), configured, F.date_sub(today, DEFAULT_DAYS))


def window_note(start: Column, effective: Column) -> Column:
    """The window's start, with the effective one where the source clipped it."""
    s, e = start.cast("string"), effective.cast("string")
    return F.when(effective.isNotNull() & (effective != start), F.concat(s, F.lit(" (efetivo "), e, F.lit(")"))).otherwise(s)


def next_watermark(last_run: Column, failed: Column, incomplete: Column, today: Column) -> Column:
    """Today where the listing ended whole, else the last run as it was."""
    return F.when(~F.coalesce(failed, F.lit(False)) & ~F.coalesce(incomplete, F.lit(False)), today).otherwise(last_run)


def next_seen(seen: DataFrame, items: DataFrame) -> DataFrame:
    """seen (fonte, id_na_fonte, hash_texto) after a run: triaged items with their hash, blocked ones with an empty one."""
    fresh = items.filter(F.col("situacao").isin(DONE, BLOCKED)).select("fonte", "id_na_fonte", F.when(F.col("situacao") == BLOCKED, "").otherwise(F.coalesce("hash_texto", F.lit(""))).alias("hash_texto"), "ord")
    newest = fresh.groupBy("fonte", "id_na_fonte").agg(F.max_by("hash_texto", "ord").alias("_new"))
    j = seen.join(newest, ["fonte", "id_na_fonte"], "full")
    return j.select("fonte", "id_na_fonte", F.coalesce("_new", "hash_texto").alias("hash_texto"))


def next_pending(pending: DataFrame, items: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """pending (fonte, id_na_fonte, url, extra, motivo, tentativas) after a run: failures counted up, settled items gone.

    keep: more columns of both tables that a reference needs to be fetched again. Extra data above EXTRA_LIMIT characters as JSON are dropped, as the item can be fetched again by its address.
    """
    key = ["fonte", "id_na_fonte"]
    last = items.groupBy(*key).agg(F.max_by(F.struct("situacao", "url", "extra", *keep), "ord").alias("_l"))
    extra = F.when(F.length(F.to_json("_l.extra")) <= EXTRA_LIMIT, F.col("_l.extra"))
    j = pending.select(*key, F.col("url").alias("_u"), F.col("extra").alias("_e"), F.col("motivo").alias("_m"), F.col("tentativas").alias("_n"), *(F.col(c).alias(f"_k_{c}") for c in keep)).join(last, key, "full")
    again = F.col("_l.situacao").isin(FAILED, REJECTED)
    kept = j.filter(F.col("_l").isNull() | again)
    return kept.select(
        *key,
        F.when(again, F.col("_l.url")).otherwise(F.col("_u")).alias("url"),
        F.when(again, extra).otherwise(F.col("_e")).alias("extra"),
        F.when(again, F.col("_l.situacao")).otherwise(F.col("_m")).alias("motivo"),
        (F.coalesce("_n", F.lit(0)) + F.when(again, 1).otherwise(0)).alias("tentativas"),
        *(F.when(again, F.col(f"_l.{c}")).otherwise(F.col(f"_k_{c}")).alias(c) for c in keep),
    )
