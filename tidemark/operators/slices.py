"""Planning of archive listings: slices by prefix and year, what is left of them, and addresses that are no documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

FIRST_DAY = "1996-01-01"
# Fixed value: feeds, copies, listing and search pages, and media files.
NOISE = (
    r"(?i)(/feed/?$|/embed/?$|/amp/?$|/page/\d+/?$|/(tag|tags|categoria|category|autor|author|"
    r"tema|assunto|busca|search)/|[?&](s|q|busca|p|page|paged|replytocom|share|print)=|"
    r"\.(jpe?g|png|gif|svg|webp|pdf|mp3|mp4|css|js)(\?|$))"
)


def is_noise(url: Column, pattern: str = NOISE) -> Column:
    """Whether an address is no document; an empty pattern turns the filter off."""
    return url.rlike(pattern) if pattern else F.lit(False)


def plan(prefixes: DataFrame, since: Column, today: Column, whole: bool = False) -> DataFrame:
    """(fonte, prefixo, ano, inicio, fim) of each slice; the current year stays open (null fim), the first begins at `since`.

    whole: one open slice per prefix instead of one per year.
    """
    start = F.greatest(since, F.lit(FIRST_DAY).cast("date"))
    base = prefixes.select("fonte", "prefixo", start.alias("_s"), today.alias("_t"))
    if whole:
        return base.select("fonte", "prefixo", F.lit(None).cast("int").alias("ano"), F.col("_s").alias("inicio"), F.lit(None).cast("date").alias("fim"))
    years = F.when(F.year("_s") <= F.year("_t"), F.sequence(F.year("_s"), F.year("_t")))
    each = base.select("fonte", "prefixo", "_s", "_t", F.explode(years).alias("ano"))
    begin = F.when(F.col("ano") == F.year("_s"), F.col("_s")).otherwise(F.make_date("ano", F.lit(1), F.lit(1)))
    end = F.when(F.col("ano") < F.year("_t"), F.make_date("ano", F.lit(12), F.lit(31)))
    return each.select("fonte", "prefixo", "ano", begin.alias("inicio"), end.alias("fim"))


def remaining(slices: DataFrame, done: DataFrame, budget: int) -> DataFrame:
    """The first `budget` slices of each source that aren't done, in order of prefix and year.

    One row per prefix and year, so a source's window is a plan, not data.
    """
    left = slices.join(done.select("fonte", "prefixo", "ano").distinct(), ["fonte", "prefixo", "ano"], "left_anti")
    w = Window.partitionBy("fonte").orderBy("prefixo", "ano")
    return left.withColumn("_n", F.row_number().over(w)).filter(F.col("_n") <= budget).drop("_n")


def completed(taken: DataFrame) -> DataFrame:
    """Slices to record as done: closed years only, as the current one goes on."""
    return taken.filter(F.col("fim").isNotNull()).select("fonte", "prefixo", "ano")


def day_windows(since: Column, today: Column, reach: int = 90) -> Column:
    """Days from `since` to `today`, clipped to the last `reach` days."""
    return F.sequence(F.greatest(since, F.date_sub(today, reach)), today)
