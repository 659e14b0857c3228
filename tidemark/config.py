"""Configuration of a collection: validation with all problems at once, and loading."""

from __future__ import annotations

import json
from dataclasses import dataclass
from datetime import date
from pathlib import Path

from tidemark.sources.listing import listing_slices, rate

# Strata a source may belong to, and channels with the settings they need.
STRATA = ("imprensa", "imprensa-historica", "academico", "juridico", "memoria", "geral")
CHANNELS = {"wayback": (), "topico": ("url",), "rss": ("url",), "gdelt": ("busca",), "openalex": ("busca",), "crossref": ("busca",), "ia": ("busca",), "wikipedia": ("titulos",), "lista": ("arquivo",)}


@dataclass(frozen=True)
class Config:
    lexicon: Path
    root: str  # where runs, state and tables lie: a folder that all executors share
    sources: tuple[dict, ...]
    since: date | None = None
    margin_days: int = 2
    keep_text: bool = True
    catalog_level: int | None = None
    sightings_level: int | None = None
    resolve_archive: bool = False


def _levels(data: dict) -> dict[str, int | None]:
    out = {}
    for key, default in (("catalogo", 3), ("vistas", 2)):
        block = data.get(key)
        out[key] = None if block is None else block.get("nivel_minimo", default)
    return out


def problems(data) -> list[str]:
    """Everything wrong with a configuration; empty when it is sound."""
    if not isinstance(data, dict):
        return ["the configuration must be an object"]
    found = [] if data.get("lexico") else ["lexico: missing"]
    sources = data.get("fontes") or []
    found += [] if sources else ["fontes: none configured"]
    ids = [s.get("id") for s in sources]
    found += [f"fontes: id {i!r} repeats" for i in sorted({i for i in ids if i and ids.count(i) > 1})]
    for n, s in enumerate(sources):
        where, kind = f"fontes[{s.get('id') or n}]", s.get("tipo")
        found += [f"{where}: no {k}" for k in ("id", "tipo", "estrato") if not s.get(k)]
        if s.get("estrato") and s["estrato"] not in STRATA:
            found.append(f"{where}: unknown stratum {s['estrato']!r}")
        if kind and kind not in CHANNELS:
            found.append(f"{where}: unknown channel {kind!r}")
        found += [f"{where}: no {k}" for k in CHANNELS.get(kind, ()) if not s.get(k)]
        if kind == "wayback" and not (s.get("prefixos") or s.get("dominio")):
            found.append(f"{where}: needs prefixos or dominio")
        if s.get("id") and ":" in s["id"] and kind and s["id"].split(":")[0] != kind:
            found.append(f"{where}: the prefix of the id must be the channel, as estimates group by it")
    levels = _levels(data)
    for key, level in levels.items():
        if level is not None and (isinstance(level, bool) or not isinstance(level, int) or not 0 <= level <= 3):
            found.append(f"{key}.nivel_minimo: a whole number from 0 to 3")
            levels[key] = None
    if (levels["vistas"] if levels["vistas"] is not None else 2) > (levels["catalogo"] if levels["catalogo"] is not None else 3):
        found.append("vistas.nivel_minimo is above catalogo.nivel_minimo")
    for n, s in enumerate(sources):
        if s.get("tipo") in CHANNELS and all(s.get(k) for k in CHANNELS[s["tipo"]]):
            try:  # a source is sound if its listing can be planned
                listing_slices(s, date(2020, 1, 1), date(2020, 1, 2))
                if rate(s) <= 0:
                    raise ValueError("limite_por_minuto: must be above 0")
            except (TypeError, ValueError, KeyError, IndexError) as e:
                found.append(f"fontes[{s.get('id') or n}]: {e}")
    if data.get("desde"):
        try:
            date.fromisoformat(data["desde"])
        except (TypeError, ValueError):
            found.append("desde: a date as YYYY-MM-DD")
    return found


def _location(base: Path, named: str) -> str:
    """An address as it is, a path as the file address it means from the configuration's folder."""
    return named.rstrip("/") if "://" in named else (base / named).resolve().as_uri()


def load(path: str | Path) -> Config:
    path = Path(path)
    data = json.loads(path.read_text(encoding="utf-8"))
    if found := problems(data):
        raise ValueError(f"{path}: " + "; ".join(found))
    levels = _levels(data)
    return Config(
        (path.parent / data["lexico"]).resolve(),
        _location(path.parent, data.get("diretorio", "dados")),
        tuple(data["fontes"]),
        date.fromisoformat(data["desde"]) if data.get("desde") else None,
        int(data.get("margem_dias", 2)),
        bool(data.get("guardar_texto", True)),
        levels["catalogo"],
        levels["vistas"],
        bool((data.get("arquivo") or {}).get("resolver", False)),
    )
