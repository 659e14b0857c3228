"""Command line: rodar, retriar, estimar, validar-lexico, validar-config, sondar.

Exit codes: 0 nothing to read, 2 an error or a failed source, 3 something to read.
"""

from __future__ import annotations

import argparse
import json
import sys
from datetime import UTC, date, datetime
from pathlib import Path

from tidemark import config as C
from tidemark.operators import lexicon as L

#: Index blocks of a prefix beyond which its listing is too wide for one query a year.
WIDE = 600


def _spark():
    from pyspark.sql import SparkSession

    from tidemark.session import ship

    return ship(SparkSession.builder.appName("tidemark").config("spark.sql.session.timeZone", "UTC").getOrCreate())


def chosen(cfg: C.Config, ids: list[str] | None) -> list[dict]:
    """The configured sources, or those asked for; an id that isn't configured is an error."""
    unknown = set(ids or ()) - {s["id"] for s in cfg.sources}
    if unknown:
        raise ValueError(f"no such source: {', '.join(sorted(unknown))}")
    return [s for s in cfg.sources if not ids or s["id"] in ids]


def run(args) -> int:
    from tidemark import collect

    cfg = C.load(args.config)
    record = collect.run(_spark(), cfg, L.load(cfg.lexicon), chosen(cfg, args.fonte), date.fromisoformat(args.desde) if args.desde else None, not args.sem_estado, args.replay)
    print(f"{record['id']}: {record['itens']} itens")
    return record["codigo"]


def regrade(args) -> int:
    """Grade the stored corpus, or Parquet files with the same columns, with today's lexicon."""
    from pyspark.sql import functions as F

    from tidemark.operators import runs, triage

    cfg, spark = C.load(args.config), _spark()
    lex = L.load(cfg.lexicon)
    docs = spark.read.parquet(args.corpus) if args.corpus else runs.read_corpus(spark, cfg.root)
    if args.fonte:
        docs = docs.filter(F.col("fonte").isin(*(s["id"] for s in chosen(cfg, [args.fonte]))))
    name = datetime.now(UTC).strftime("%Y%m%dT%H%M%SZ")
    graded = triage.graded(docs, lex).drop("texto", "destaques").withColumn("rodada", F.lit(name))
    runs.write_records(runs.records(graded, lex.id, lex.version), f"{cfg.root}/saidas/{name}-retriar")
    return 0


def estimate_(args) -> int:
    from pyspark.sql import functions as F

    from tidemark.operators import estimate, report

    cfg, spark = C.load(args.config), _spark()
    if cfg.sightings_level is None:
        raise ValueError("vistas: not configured")
    seen = spark.read.option("basePath", f"{cfg.root}/vistas").parquet(f"{cfg.root}/vistas")
    strata = spark.createDataFrame([(s["id"], s.get("estrato") or "geral") for s in cfg.sources], "fonte string, estrato string")
    obs = estimate.observed(seen, strata, args.nivel_minimo, F.lit(args.desde).cast("date") if args.desde else None).persist()
    aligned = bool(args.desde)
    text = report.coverage_report(estimate.coverage(obs, aligned), estimate.per_channel(obs), estimate.pairs(obs, aligned), estimate.curve(obs, seen))
    obs.unpersist()
    Path(args.saida).write_text(text, encoding="utf-8") if args.saida else print(text)
    return 0


def check_lexicon(args) -> int:
    lex = L.load(args.arquivo)
    print(f"{lex.id} {lex.version}: {len(lex.terms)} terms")
    return 0


def check_config(args) -> int:
    found = C.problems(json.loads(Path(args.arquivo).read_text(encoding="utf-8")))
    print("\n".join(found) or "ok")
    return 2 if found else 0


def probe(args) -> int:
    """Index blocks the archive has to read for each prefix; wide ones are better listed by section."""
    from tidemark.sources.client import Client, FetchError, urllib_transport
    from tidemark.sources.listing import CDX, archive_prefixes, rate
    from tidemark.sources.reader import replay_transport

    cfg = C.load(args.config)
    for s in chosen(cfg, args.fonte):
        if s["tipo"] != "wayback":
            continue
        client = Client(rate(s), False, replay_transport(args.replay) if args.replay else urllib_transport)
        for p in archive_prefixes(s)[0]:
            try:
                said = client.get(CDX, {"url": p, "matchType": "prefix" if s.get("prefixos") else "domain", "showNumPages": "true"}).body.decode().strip()
                print(s["id"], p, f"{said} blocks" + ("; too wide" if said.isdigit() and int(said) > WIDE else "") if said.isdigit() else "no answer")
            except FetchError as e:
                print(s["id"], p, f"error: {e}")
    return 0


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="tidemark", description=__doc__)
    verbs = p.add_subparsers(dest="verb", required=True)

    def verb(name: str, body, config: bool = True):
        v = verbs.add_parser(name)
        v.set_defaults(body=body)
        if config:
            v.add_argument("--config", required=True)
        else:
            v.add_argument("arquivo")
        return v

    v = verb("rodar", run)
    v.add_argument("--desde")
    v.add_argument("--sem-estado", action="store_true")
    v.add_argument("--fonte", action="append")
    v.add_argument("--replay", help="folder of recorded responses")
    v = verb("retriar", regrade)
    v.add_argument("--fonte")
    v.add_argument("--corpus", help="Parquet files instead of the stored corpus")
    v = verb("estimar", estimate_)
    v.add_argument("--nivel-minimo", type=int, default=2)
    v.add_argument("--desde")
    v.add_argument("--saida")
    verb("validar-lexico", check_lexicon, False)
    verb("validar-config", check_config, False)
    v = verb("sondar", probe)
    v.add_argument("--fonte", action="append")
    v.add_argument("--replay", help="folder of recorded responses")
    args = p.parse_args(argv)
    try:
        return args.body(args)
    except (OSError, ValueError) as e:
        print(f"error: {e}", file=sys.stderr)
        return 2


if __name__ == "__main__":
    sys.exit(main())
