"""Markdown of coverage figures; every input has a row per stratum, channel, pair or run, never per item."""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import DataFrame


def markdown(columns: list[str], rows: list[tuple]) -> list[str]:
    """A table as lines."""
    shown = lambda v: "" if v is None else str(v).replace("|", "\\|").replace("\n", " ").strip()
    return [f"| {' | '.join(r)} |" for r in (columns, ["---"] * len(columns), *([shown(v) for v in r] for r in rows))]


def _by_stratum(df: DataFrame | None, *order: str) -> dict[str, list]:
    out = defaultdict(list)
    for r in df.collect() if df is not None else ():  # bounded by strata times channels, pairs or runs
        out[r.estrato].append(r)
    return {k: sorted(v, key=lambda r: [r[c] for c in order]) for k, v in out.items()}


def coverage_report(coverage: DataFrame, channels: DataFrame, pairs: DataFrame, curve: DataFrame | None = None) -> str:
    """A section for each stratum: units by channel, the lower bound where there is one, overlaps, growth by run."""
    per, two, grown = _by_stratum(channels, "canal"), _by_stratum(pairs, "a", "b"), _by_stratum(curve, "rodada")
    out = ["# Quanto já foi visto"]
    for r in coverage.orderBy("estrato").collect():
        out += ["", f"## {r.estrato}: {r.observadas} unidades vistas", "", *markdown(["canal", "unidades", "exclusivas"], [(c.canal, c.unidades, c.exclusivas) for c in per.get(r.estrato, [])])]
        if r.chao is None:
            out += ["", "Sem limite inferior: menos de dois canais comparáveis."]
        else:
            out += ["", f"Limite inferior {r.chao:,.0f} com {r.canais} canais (uma vez: {r.f1}, duas vezes: {r.f2}); visto {r.cobertura or 0:.0%} dele."]
        rows = [(p.a, p.b, p.n1, p.n2, p.m, *((f"{p.chapman:,.0f}", f"{p.baixo:,.0f} a {p.alto:,.0f}") if p.comparavel else ("", "janelas diferentes"))) for p in two.get(r.estrato, [])]
        out += ["", *markdown(["canal", "outro", "n1", "n2", "m", "Chapman", "95 %"], rows)] if rows else []
        if r.estrato in grown:
            out += ["", *markdown(["rodada", "novas", "total"], [(g.rodada, g.novas, g.total) for g in grown[r.estrato]])]
    return "\n".join(out) + "\n"
