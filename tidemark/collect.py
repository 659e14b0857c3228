"""Runs over a collection: list, fetch, check, grade, publish and remember."""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from datetime import UTC, date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import config as C
from tidemark.operators import catalog, estimate, pipeline, runs, slices, state
from tidemark.operators.lexicon import Lexicon
from tidemark.session import names_below, path_exists, read_text, write_text
from tidemark.sources import payloads, reader
from tidemark.sources.fetch import fetch, latest_captures
from tidemark.sources.listing import archive_prefixes, archive_slice, effective_start, listing_slices, rate

#: What a pending reference keeps besides its state, to be fetched outside the window.
PENDING_KEEP = ("titulo", "publicado_em", "ord")
PENDING = "fonte string, id_na_fonte string, url string, extra map<string,string>, motivo string, tentativas int, titulo string, publicado_em date, ord long"
SEEN = "fonte string, id_na_fonte string, hash_texto string, rodada string"
SLICE = "fonte string, prefixo string, ano int"
NO_BUDGET = 1 << 30


class Memory:
    """What a collection remembers between runs, below root/estado: references seen and pending, slices done, and the day
    of each source's last whole listing. `blank` forgets all of it and writes nothing."""

    def __init__(self, spark: SparkSession, root: str, blank: bool = False):
        self.spark, self.root, self.blank = spark, f"{root}/estado", blank

    def _runs(self, name: str) -> list[str]:
        """Folders of runs that were written to their end."""
        if self.blank:
            return []
        at = f"{self.root}/{name}"
        return [f"{at}/{x}" for x in names_below(self.spark, at) if x.startswith("run=") and path_exists(self.spark, f"{at}/{x}/_SUCCESS")]

    def _json(self, name: str) -> dict:
        text = None if self.blank else read_text(self.spark, f"{self.root}/{name}.json")
        return json.loads(text) if text else {}

    def seen(self) -> DataFrame:
        found = self._runs("seen")
        return self.spark.read.schema(SEEN).parquet(*found) if found else self.spark.createDataFrame([], SEEN)

    def pending(self) -> DataFrame:
        """References that failed in earlier runs, as the last run that got as far left them."""
        found = self._runs("pending")
        return self.spark.read.schema(PENDING).parquet(found[-1]) if found else self.spark.createDataFrame([], PENDING)

    def marks(self) -> dict[str, date]:
        """Day of each source's last run whose listing ended whole."""
        return {k: date.fromisoformat(v) for k, v in self._json("marcas").items()}

    def done(self) -> list[tuple]:
        """(source, prefix, year) of closed slices that were listed to their end."""
        return [(f, p, y) for f, each in self._json("fatias").items() for p, y in each]

    def keep(self, run: str, items: DataFrame, done: list[tuple], marks: dict[str, date]) -> None:
        """The marks are written last, so a run that breaks off before is listed again."""
        if self.blank:
            return
        none = self.spark.createDataFrame([], "fonte string, id_na_fonte string, hash_texto string")
        pending = state.next_pending(self.pending(), items.withColumn("extra", F.col("dados")), PENDING_KEEP)
        pending.write.mode("overwrite").parquet(f"{self.root}/pending/run={run}")
        state.next_seen(none, items).withColumn("rodada", F.lit(run)).write.mode("overwrite").parquet(f"{self.root}/seen/run={run}")
        by: dict[str, list] = {}
        for f, p, y in sorted(set(done)):
            by.setdefault(f, []).append([p, y])
        write_text(self.spark, f"{self.root}/fatias.json", json.dumps(by))
        write_text(self.spark, f"{self.root}/marcas.json", json.dumps({k: str(v) for k, v in sorted(marks.items())}))


@dataclass
class Listing:
    """What listing the wanted sources gave."""

    refs: DataFrame
    failed: dict[str, str] = field(default_factory=dict)
    unfinished: dict[str, str] = field(default_factory=dict)
    done: list[tuple] = field(default_factory=list)
    pages: list[DataFrame] = field(default_factory=list)


def window_starts(spark: SparkSession, wanted: list[dict], explicit: date | None, last: dict[str, date], cfg: C.Config, today: date) -> dict[str, date]:
    """First day of each source's window; a source's own margin goes before the configured one."""
    day = lambda d: F.lit(d).cast("date")
    rows = [(s["id"], last.get(s["id"]), int(s.get("margem_dias", cfg.margin_days))) for s in wanted]
    start = state.window_start(day(explicit), F.col("ultima"), F.col("margem"), day(cfg.since), day(today))
    got = spark.createDataFrame(rows, "fonte string, ultima date, margem int").select("fonte", start.alias("inicio"))
    return {r.fonte: r.inicio for r in got.collect()}  # one row per source


def planned(spark: SparkSession, source: dict, since: date, today: date, done: list[tuple]) -> tuple[list[dict], int, dict[str, tuple]]:
    """(slices to ask now, number left for later runs, closed ones by name). Only the archive's listing has a plan."""
    if source["tipo"] != "wayback":
        return listing_slices(source, since, today), 0, {}
    prefixes, whole = archive_prefixes(source)
    day = lambda d: F.lit(d).cast("date")
    plan = slices.plan(spark.createDataFrame([(source["id"], p) for p in prefixes], "fonte string, prefixo string"), day(since), day(today), whole)
    left = slices.remaining(plan, spark.createDataFrame(done, SLICE), NO_BUDGET).orderBy("prefixo", "ano").collect()  # prefixes times years
    now = left[: int(source.get("fatias_por_rodada") or NO_BUDGET)]
    asked = [archive_slice(source, r.prefixo, r.ano, r.inicio, r.fim) for r in now]
    return asked, len(left) - len(now), {a["fatia"]: (source["id"], r.prefixo, r.ano) for a, r in zip(asked, now) if r.fim}


def listed(spark: SparkSession, wanted: list[dict], since: dict[str, date], today: date, done: list[tuple], replay: str | None) -> Listing:
    """References of all wanted sources. A source whose listing breaks off keeps what came before."""
    reader.register(spark)
    out = Listing(spark.createDataFrame([], "fonte string, id_na_fonte string, url string, titulo string, publicado_em date, dados map<string,string>, ord long"), done=list(done))
    for s in wanted:
        if s["tipo"] == "lista":
            out.refs = out.refs.unionByName(payloads.curated(spark, s["arquivo"], s["id"]).select(*payloads.REFERENCE))
            continue
        asked, later, closed = planned(spark, s, since[s["id"]], today, done)
        if later:
            out.unfinished[s["id"]] = f"{later} fatias para as próximas rodadas"
        if not asked:
            continue
        r = spark.read.format("tidemark_listing").options(fonte=s["id"], canal=s["tipo"], fatias=json.dumps(asked), por_minuto=str(rate(s)))
        pages = (r.option("replay", replay) if replay else r).load().persist()  # asked once, parsed and checked for errors
        out.pages.append(pages)
        good = pages.filter("corpo is not null")
        if s["tipo"] == "topico":
            refs = payloads.topic_links(good)
        elif s["tipo"] == "wayback" and "excluir" in s:
            refs = payloads.wayback(good, s["excluir"] or "")
        elif s["tipo"] == "rss":
            refs = payloads.feed(good, F.lit(since[s["id"]]).cast("date"))
        else:
            refs = payloads.PARSERS[s["tipo"]](good)
        out.refs = out.refs.unionByName(refs.select(*payloads.REFERENCE))
        errors = {e.fatia: e.erro for e in pages.filter("erro is not null").select("fatia", "erro").collect()}  # at most one a slice
        if errors:
            out.failed[s["id"]] = next(iter(errors.values()))
        out.done += [k for name, k in closed.items() if name not in errors]
    return out


def run(spark: SparkSession, cfg: C.Config, lexicon: Lexicon, wanted: list[dict], explicit: date | None = None, remember: bool = True, replay: str | None = None) -> dict:
    """One run; returns its record, which is written last as rodada.json.

    Each source is listed from its own last whole run less its margin. What failed is pending and fetched again in every
    run, listed or not.
    """
    began, today = datetime.now(UTC), date.today()
    name = f"{began:%Y%m%dT%H%M%SZ}"
    memory = Memory(spark, cfg.root, not remember)
    last = memory.marks()
    since = window_starts(spark, wanted, explicit, last, cfg, today)
    listing = listed(spark, wanted, since, today, memory.done(), replay)
    ids = [s["id"] for s in wanted]
    due = memory.pending().filter(F.col("fonte").isin(*ids)).withColumnRenamed("extra", "dados").select(*payloads.REFERENCE)
    todo = state.to_fetch(listing.refs, due, memory.seen()).persist()
    fetched = todo.filter(~F.split_part("fonte", F.lit(":"), F.lit(1)).isin(*pipeline.METADATA_CHANNELS))
    items = pipeline.run_items(todo, fetch(fetched, {s["id"]: rate(s) for s in wanted}, robots=not replay, replay=replay), lexicon, name).persist()
    out = f"{cfg.root}/saidas/{name}-rodar"
    runs.write_records(runs.records(items.drop("texto", "destaques"), lexicon.id, lexicon.version), out)
    if cfg.keep_text:
        runs.write_corpus(items, cfg.root, name)
    publish(spark, cfg, items, name, replay)
    shown = items.withColumn("titulo", F.col("exibido"))
    lines = runs.report_rows(shown).orderBy("secao", "ord").select("secao", "linha")
    lines.write.mode("overwrite").partitionBy("secao").text(f"{out}/relatorio")
    marks = state.next_watermark(F.col("ultima"), F.col("falhou"), F.col("falta"), F.lit(today).cast("date"))
    rows = spark.createDataFrame([(i, last.get(i), i in listing.failed, i in listing.unfinished) for i in ids], "fonte string, ultima date, falhou boolean, falta boolean")
    moved = {r.fonte: r.marca for r in rows.select("fonte", marks.alias("marca")).collect() if r.marca}  # one row per source
    memory.keep(name, items, listing.done, last | moved)
    counts = {g: {} for g in ("situacao", "motivo")}
    for r in runs.counts(items).collect():  # one row per status and reason
        counts[r.grupo][r.valor] = r.n
    reads = bool(items.filter("nivel >= 2").take(1))
    starts = spark.createDataFrame([(s["id"], since[s["id"]], effective_start(s, since[s["id"]], today)) for s in wanted], "fonte string, pedido date, efetivo date")
    windows = starts.select("fonte", state.window_note(F.col("pedido"), F.col("efetivo")).alias("janela"))
    record = {
        "id": name, "modo": "rodar", "lexico": {"id": lexicon.id, "versao": lexicon.version}, "inicio": began.isoformat(timespec="seconds"), "fim": datetime.now(UTC).isoformat(timespec="seconds"),
        "desde": {r.fonte: r.janela for r in windows.collect()},
        "falhas": listing.failed, "incompletas": listing.unfinished, "itens": sum(counts["situacao"].values()), "contagens": counts, "pede_leitura": reads, "codigo": 2 if listing.failed else 3 if reads else 0,
    }
    write_text(spark, f"{out}/rodada.json", json.dumps(record, ensure_ascii=False, indent=1))
    for df in (items, todo, *listing.pages):
        df.unpersist()
    return record


def publish(spark: SparkSession, cfg: C.Config, items: DataFrame, run: str, replay: str | None = None) -> None:
    """Append a run's sightings and its new catalogue entries, with the archive's last capture where none is known."""
    strata = spark.createDataFrame([(s["id"], s.get("estrato") or "geral") for s in cfg.sources], "fonte string, estrato string")
    if cfg.sightings_level is not None:
        estimate.sightings(items, cfg.sightings_level).write.mode("overwrite").parquet(f"{cfg.root}/vistas/run={run}")
    if cfg.catalog_level is None:
        return
    at = f"{cfg.root}/catalogo"
    old = spark.read.option("basePath", at).parquet(at) if names_below(spark, at) else spark.createDataFrame([], ", ".join(f"{c} string" for c in catalog.COLUMNS))
    new = catalog.upsert(old.filter(F.col("run") < run) if "run" in old.columns else old, catalog.entries(items, strata, cfg.catalog_level))
    if cfg.resolve_archive:
        new = catalog.complete(new, latest_captures(new.filter("snapshot = ''"), replay=replay))
    new.select(*catalog.COLUMNS).write.mode("overwrite").parquet(f"{at}/run={run}")
