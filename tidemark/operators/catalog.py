"""The cumulative catalogue: greedy first-wins deduplication, migration, completion and browsing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import text as X
from tidemark.functions import url as U
from tidemark.session import drop_path, durable_path, scratch

COLUMNS = ["id", "url", "dominio", "estrato", "titulo", "publicado_em", "capturado_em", "snapshot", "hash_texto", "nivel", "identificadores", "categorias", "primeira_rodada", "lexico_versao"]


def entries(items: DataFrame, strata: DataFrame, least: int = 3) -> DataFrame:
    """Catalogue rows (with ord) of triaged items of at least a level; arrays joined by semicolons, missing values empty.

    The title is the displayed one (`exibido`) where the items have it.
    """
    rows = items.filter((F.col("situacao") == "triado") & (F.coalesce("nivel", F.lit(0)) >= least) & F.col("url").isNotNull())
    plain = U.unarchived(F.col("url"))
    s = strata.select("fonte", F.col("estrato").alias("_s"))
    out = rows.join(s, "fonte", "left")
    shown = F.col("exibido" if "exibido" in items.columns else "titulo")
    empty = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    return out.select(
        "ord",
        U.identity(F.col("url")).alias("id"),
        plain.alias("url"),
        U.domain(F.col("url")).alias("dominio"),
        F.coalesce("_s", F.lit("geral")).alias("estrato"),
        F.trim(F.replace(empty(shown), F.lit("\n"), F.lit(" "))).alias("titulo"),
        empty(F.col("publicado_em")).alias("publicado_em"),
        empty(U.snapshot_stamp(F.col("snapshot"))).alias("capturado_em"),
        empty(F.col("snapshot")).alias("snapshot"),
        empty(F.col("hash_texto")).alias("hash_texto"),
        F.when(F.col("nivel") > 0, F.col("nivel").cast("string")).otherwise("").alias("nivel"),
        F.coalesce(F.array_join("chaves", ";"), F.lit("")).alias("identificadores"),
        F.coalesce(F.array_join("categorias", ";"), F.lit("")).alias("categorias"),
        empty(F.col("rodada")).alias("primeira_rodada"),
        empty(F.col("lexico_versao")).alias("lexico_versao"),
    )


def independent(rows: DataFrame, order: str = "ord", id_: str = "id", digest: str = "hash_texto") -> DataFrame:
    """Rows that a scan in order would keep when it skips a row whose id or non-empty hash is already kept.

    The scan is the lexicographically first maximal independent set of the conflict graph. Per round, rows that come
    first both in their id group and in their hash group are kept, and rows that share a value with them leave; random
    orders need O(log^2 n) rounds, a chain in which each row conflicts with the next one needs half its length. Rounds
    are written to the shared folder, and a round's input is deleted when the next one stands. A group holding many rows
    folds in the map-side aggregate. `order` has to be unique; null and empty ids and hashes conflict with nothing: each
    takes a value of its own, so they don't meet under one key either.
    """
    spark = rows.sparkSession
    own = lambda c: F.coalesce(F.nullif(F.col(c).cast("string"), F.lit("")), F.concat(F.lit("\0"), F.col(order).cast("string")))
    kept = scratch(spark, "kept")
    left = rows.select(F.col(order).alias("o"), own(id_).alias("i"), own(digest).alias("h"))
    at, n = durable_path(left, "undecided"), 0
    while not (left := spark.read.parquet(at)).isEmpty():
        # rows that come first in both groups, found by their own number: no value that many rows share is a join key here
        first = left.groupBy("i").agg(F.min("o").alias("o")).select("o").join(left.groupBy("h").agg(F.min("o").alias("o"), F.min_by("i", "o").alias("i")), "o")
        first.select("o", "i", "h").write.parquet(f"{kept}/round={n}")
        now = spark.read.parquet(f"{kept}/round={n}")
        rest = left.join(now.select("o"), "o", "left_anti").join(now.select("i"), "i", "left_anti").join(now.select("h"), "h", "left_anti")
        done, at, n = at, durable_path(rest.select("o", "i", "h"), "undecided"), n + 1
        drop_path(spark, done)
    if not n:
        return rows.limit(0)
    chosen = spark.read.parquet(kept).select(F.col("o").alias(order))
    return rows.join(chosen, order, "left_semi")


def upsert(catalog: DataFrame, fresh: DataFrame, order: str = "ord") -> DataFrame:
    """Rows of `fresh` to append: neither id nor hash is in the catalogue or earlier in the batch. No row is rewritten."""
    new = fresh.join(catalog.select("id").distinct(), "id", "left_anti")
    known = catalog.select("hash_texto").filter("hash_texto <> ''").distinct()
    # rows without a hash don't take part in that join, where they would all meet under one key
    none = F.coalesce("hash_texto", F.lit("")) == ""
    return independent(new.filter(~none).join(known, "hash_texto", "left_anti").select(*new.columns).unionByName(new.filter(none)), order)


def migrate(legacy: DataFrame) -> DataFrame:
    """A catalogue of any older header in today's columns: addresses unarchived, ids and domains computed anew."""
    given = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")) if c in legacy.columns else F.lit("")
    url = given("url")
    fixed = {"id": U.identity(url), "url": U.unarchived(url), "dominio": U.domain(url)}
    snap = F.when((given("snapshot") == "") & (U.unarchived(url) != url), url).otherwise(given("snapshot"))
    return legacy.select(*(fixed.get(c, snap if c == "snapshot" else given(c)).alias(c) for c in COLUMNS))


def complete(catalog: DataFrame, captures: DataFrame) -> DataFrame:
    """Blank snapshots filled from (id, carimbo) captures, the latest of each page; `preenchido` marks filled rows."""
    last = captures.groupBy("id").agg(F.max("carimbo").alias("_c"))
    j = catalog.join(last, "id", "left")
    fill = (F.coalesce("snapshot", F.lit("")) == "") & F.col("_c").isNotNull()
    return j.select(
        *(F.col(c) for c in catalog.columns if c not in ("snapshot", "capturado_em")),
        F.when(fill, U.snapshot(F.col("_c"), F.col("url"))).otherwise(F.col("snapshot")).alias("snapshot"),
        F.when(fill, F.col("_c")).otherwise(F.col("capturado_em")).alias("capturado_em"),
        fill.alias("preenchido"),
    )


def _day() -> Column:
    return F.coalesce(F.nullif(F.col("publicado_em"), F.lit("")), F.nullif(F.col("capturado_em"), F.lit("")))


def search(catalog: DataFrame, words: str = "", stratum: str = "", category: str = "", domain: str = "", decade: str = "") -> DataFrame:
    """Rows that hold the words in their title (or address where it is blank) and match every facet given."""
    shown = F.coalesce(F.nullif(F.trim(F.col("titulo")), F.lit("")), F.col("url"))
    out = catalog
    if words:
        out = out.filter(F.contains(F.lower(shown), F.lit(words.lower())))
    for c, v in (("estrato", stratum), ("dominio", domain)):
        out = out.filter(F.col(c) == v) if v else out
    if category:
        out = out.filter(F.array_contains(F.split("categorias", ";"), category))
    return out.filter(X.decade(_day()) == decade) if decade else out


def newest(catalog: DataFrame, page: int = 0, size: int = 100) -> DataFrame:
    """A page of the catalogue, newest first by the published else captured string, ties by id."""
    return catalog.withColumn("_d", F.coalesce(_day(), F.lit(""))).orderBy(F.desc("_d"), "id").drop("_d").offset(page * size).limit(size)


def tiles(catalog: DataFrame) -> DataFrame:
    """One row: documents, domains, documents with a snapshot, decades."""
    return catalog.agg(F.count("*").alias("documentos"), F.countDistinct("dominio").alias("dominios"), F.count_if(F.coalesce("snapshot", F.lit("")) != "").alias("com_snapshot"), F.countDistinct(X.decade(_day())).alias("decadas"))


def facets(catalog: DataFrame) -> DataFrame:
    """(faceta, valor, n) of strata, categories, domains and decades."""
    values = F.array(
        F.struct(F.lit("estrato").alias("faceta"), F.array("estrato").alias("v")),
        F.struct(F.lit("categoria").alias("faceta"), F.split("categorias", ";").alias("v")),
        F.struct(F.lit("dominio").alias("faceta"), F.array("dominio").alias("v")),
        F.struct(F.lit("decada").alias("faceta"), F.array(X.decade(_day())).alias("v")),
    )
    flat = catalog.select(F.explode(values).alias("x")).select("x.faceta", F.explode("x.v").alias("valor"))
    return flat.filter("valor is not null and valor <> ''").groupBy("faceta", "valor").agg(F.count("*").alias("n"))
