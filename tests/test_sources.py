import json
import time
from datetime import date, timedelta
from urllib.parse import urlencode

import pytest
from pyspark.sql import functions as F

from tidemark import cli, collect, config
from tidemark.operators import lexicon as L
from tidemark.operators import pipeline, runs
from tidemark.sources import client as C
from tidemark.sources import fetch, listing, reader
from tidemark.sources import payloads as P


def pages(spark, body, source="x:y", base="http://g.example/dossie/"):
    return spark.createDataFrame([(source, 0, base, body)], "fonte string, pagina int, base string, corpo string")


def refs(df):
    return {r.id_na_fonte: (r.url, r.titulo, str(r.publicado_em) if r.publicado_em else None, r.dados) for r in df.collect()}


CDX = [["timestamp", "original", "statuscode"], ["20160927090000", "http://g.example/materia-longa", "200"], [], ["20160101", "http://g.example/feed/", "200"], [], ["chave"]]


def test_wayback(spark):
    df = pages(spark, json.dumps(CDX))
    assert list(refs(P.wayback(df))) == ["http://g.example/materia-longa"] and set(refs(P.wayback(df, noise=""))) == {"http://g.example/materia-longa", "http://g.example/feed/"}
    assert df.select(P.resume_key(F.col("corpo")).alias("k")).first().k == "chave"
    assert refs(P.wayback(df))["http://g.example/materia-longa"][2] == "2016-09-27"


def test_feeds(spark):
    rss = "<rss><channel><item><title>A</title><link>http://g/a</link><guid isPermaLink='false'>g1</guid><pubDate>Sun, 02 Oct 2016 23:30:00 -0300</pubDate></item><item><title>B</title><link>http://g/b</link></item><item><title>C</title></item><item><title>D</title><link>http://g/d</link><pubDate>Fri, 02 Oct 1992 10:00:00 -0300</pubDate></item></channel></rss>"
    got = refs(P.feed(pages(spark, rss), F.lit("2000-01-01").cast("date")))
    assert set(got) == {"g1", "http://g/b"} and got["g1"][2] == "2016-10-02"
    atom = "<feed><entry><title>E</title><id>e1</id><link rel='enclosure' href='http://g/m.mp3'/><link rel='alternate' href='http://g/e'/><updated>2020-01-02T00:00:00Z</updated></entry><entry><id>e2</id></entry></feed>"
    assert refs(P.feed(pages(spark, atom))) == {"e1": ("http://g/e", "E", "2020-01-02", {})} or refs(P.feed(pages(spark, atom)))["e1"][:3] == ("http://g/e", "E", "2020-01-02")


def test_openalex_and_crossref(spark):
    body = {"results": [{"id": "W1", "doi": "https://doi.org/1", "display_name": "T", "publication_date": "2020-02-03", "type": "article", "abstract_inverted_index": {"b": [1], "a": [0]}, "primary_location": {"source": {"display_name": "V"}}}, {"id": "W2", "doi": None, "display_name": None, "primary_location": {"landing_page_url": "http://l"}}]}
    got = refs(P.openalex(pages(spark, json.dumps(body))))
    assert got["W1"][0] == "https://doi.org/1" and got["W1"][3]["resumo"] == "a b" and got["W2"][0] == "http://l"
    body = {"message": {"items": [{"DOI": "10.1/Ab", "title": ["X", "Y"], "abstract": "<jats:p>a  <i>b</i></jats:p>", "issued": {"date-parts": [[2019, 4]]}}, {"title": ["sem doi"], "issued": {"date-parts": [[None]]}}]}}
    got = refs(P.crossref(pages(spark, json.dumps(body))))
    assert list(got) == ["10.1/ab"] and got["10.1/ab"][:3] == ("https://doi.org/10.1/Ab", "X Y", "2019-04-01") and got["10.1/ab"][3]["resumo"] == "a b"


def test_other_channels(spark):
    got = refs(P.archive_items(pages(spark, json.dumps({"response": {"docs": [{"identifier": "i", "title": ["A", "B"], "date": "1992-10-02T00:00:00Z"}, {"title": "x"}]}}))))
    assert got["i"][:3] == ("https://archive.org/details/i", "A B", "1992-10-02")
    got = refs(P.gdelt(pages(spark, json.dumps({"articles": [{"url": "http://g/1", "title": "t", "seendate": "20240102T030000Z", "domain": "g"}, {"url": ""}]}))))
    assert got["http://g/1"][2] == "2024-01-02"
    links = [{"url": "http://www.g.example/a"}, {"url": "https://g.example/a/"}, {"url": "ftp://g/a"}, {"url": "https://web.archive.org/web/2001/http://h.example/b"}]
    got = refs(P.wikipedia(pages(spark, json.dumps({"query": {"pages": [{"title": "T", "extlinks": links}]}}))))
    assert set(got) == {"g.example/a", "h.example/b"} and got["h.example/b"][3]["snapshot"].startswith("https://web.archive.org")


def test_topic_links_and_csv(spark, tmp_path):
    m = "<a href='/2016/materia-um'>1</a><a href='materia-dois#c'>2</a><a href='http://www.g.example/2016/materia-um/'>r</a><a href='#x'>x</a><a href='mailto:a@b'>m</a><a href='http://outro.example/materia-tres'>o</a><a href='/tag/abcdefgh'>t</a><a href='/curto'>c</a>"
    assert {v[0] for v in refs(P.topic_links(pages(spark, m))).values()} == {"http://g.example/2016/materia-um", "http://g.example/dossie/materia-dois"}
    (tmp_path / "l.csv").write_text('url,titulo,publicado_em\nhttp://g.example/a,"A, ""b""",1992-10-02\n,x,\nhttp://g.example/c,,logo\n')
    got = refs(P.curated(spark, str(tmp_path / "l.csv"), "lista:x"))
    assert got["g.example/a"][1:3] == ('A, "b"', "1992-10-02") and got["g.example/c"][1:3] == (None, None) and len(got) == 2


def test_listing_reader_follows_pages_and_keeps_what_it_has(spark, tmp_path):
    def record(url, params, body):
        (tmp_path / reader.replay_name(url + "?" + urlencode(params))).write_bytes(json.dumps(body).encode())

    base = {"url": "p", "limit": "500"}
    record("http://cdx.example/", base, CDX)
    record("http://cdx.example/", base | {"resumeKey": "chave"}, CDX[:2])
    reader.register(spark)
    slices = [{"url": "http://cdx.example/", "params": base}, {"url": "http://missing.example/", "params": {}}]
    r = spark.read.format("tidemark_listing").options(fonte="wayback:g", canal="wayback", fatias=json.dumps(slices), por_minuto="100000", replay=str(tmp_path))
    rows = r.load().collect()
    assert [(x.pagina, x.erro is None) for x in rows] == [(0, True), (1, True), (0, False)] and "404" in rows[2].erro
    assert [b["startdatetime"] for b in reader.bands({"startdatetime": "20240101000000", "enddatetime": "20240102000000"})] == ["20240101000000", "20240101060000", "20240101120000", "20240101180000"]


def test_client_waits_retries_and_honours_robots():
    now, slept, calls = [0.0], [], []

    def send(url, headers, timeout):
        calls.append(url)
        if url.endswith("robots.txt"):
            return C.Response(403 if "closed" in url else 404, url, b"")
        return C.Response(503 if len(calls) < 4 else 200, url, b"ok")

    def sleep(s):
        slept.append(s)
        now[0] += s

    c = C.Client(60, True, send, clock=lambda: now[0], sleep=sleep)
    assert c.get("http://open.example/a").body == b"ok" and 2.0 in slept and 4.0 in slept
    with pytest.raises(C.RobotsBlocked):
        c.get("http://closed.example/a?token=s3")
    with pytest.raises(C.FetchError, match="<redigido>"):
        C.Client(6000, False, lambda *a: C.Response(500, "u", b""), clock=lambda: 0.0, sleep=lambda s: None).get("http://x/?api_key=abc")


def test_pipeline(spark):
    lex = L.parse({"id": "a", "versao": "1", "termos": [{"chave": "ilha", "formas": ["massacre da ilha"]}]})
    r = [("rss:a", "1", "http://g/1", "Massacre da ilha", None, None, 1), ("rss:a", "2", "http://g/2", "x", None, None, 2), ("rss:a", "3", "http://g/3", "x", None, None, 3), ("openalex:b", "4", "http://g/4", "T", None, {"titulo": "O massacre da ilha", "resumo": "r"}, 4), ("rss:a", "5", "http://g/5", "x", None, None, 5)]
    refs_ = spark.createDataFrame(r, "fonte string, id_na_fonte string, url string, titulo string, publicado_em date, dados map<string,string>, ord long")
    page = "<html><body><p>" + "palavra " * 80 + "</p></body></html>"
    got = [("http://g/1", 200, page.encode(), {"content-type": "text/html"}), ("http://g/2", 200, b"<p>curto</p>", {}), ("http://g/3", -1, None, None)]
    items = pipeline.run_items(refs_, spark.createDataFrame(got, "url string, status int, corpo binary, cabecalhos map<string,string>"), lex, "r")
    out = {x.id_na_fonte: (x.situacao, x.nivel) for x in items.collect()}
    assert out == {"1": ("triado", 3), "2": ("reprovado_sentinela", None), "3": ("bloqueado_robots", None), "4": ("triado", 3), "5": ("falha_captura", None)}


def test_config_and_cli(tmp_path, capsys):
    good = {"lexico": "l.json", "fontes": [{"id": "rss:a", "tipo": "rss", "url": "http://g/feed", "estrato": "imprensa"}], "catalogo": {}, "vistas": {}}
    assert config.problems(good) == []
    bad = {"fontes": [{"id": "rss:a", "tipo": "gdelt", "estrato": "lua"}, {"id": "rss:a"}], "desde": "ontem", "vistas": {"nivel_minimo": 3}, "catalogo": {"nivel_minimo": 2}}
    text = " ".join(config.problems(bad))
    assert all(p in text for p in ("lexico", "repeats", "unknown stratum", "prefix", "desde", "above"))
    (tmp_path / "c.json").write_text(json.dumps(good))
    (tmp_path / "l.json").write_text(json.dumps({"id": "a", "versao": "1", "termos": [{"chave": "x", "formas": ["y"]}]}))
    assert cli.main(["validar-config", str(tmp_path / "c.json")]) == 0 and cli.main(["validar-lexico", str(tmp_path / "l.json")]) == 0
    assert capsys.readouterr().out == "ok\na 1: 1 terms\n"
    assert cli.main(["rodar", "--config", str(tmp_path / "c.json"), "--fonte", "rss:b"]) == 2 and "rss:b" in capsys.readouterr().err
    unsound = {"lexico": "l.json", "fontes": [{"id": "topico:a", "tipo": "topico", "url": "http://g", "paginacao": "{x}", "estrato": "geral"}]}
    assert "topico:a" in " ".join(config.problems(unsound))
    assert cli.main(["validar-lexico", str(tmp_path / "none.json")]) == 2


def _recorded(folder):
    """put(url, body, params) records a response for the replay."""

    def put(url, body, params=None):
        address = url + ("?" + urlencode(params, doseq=True) if params else "")
        (folder / reader.replay_name(address)).write_bytes((body if isinstance(body, str) else json.dumps(body)).encode())

    return put


PAGE = "<html><body><h1>Massacre da Ilha Cinzenta {0}</h1><p>" + "o massacre da ilha cinzenta " * 40 + "{0}</p></body></html>"


@pytest.mark.parametrize(
    ("url", "pattern", "n", "page"),
    [
        ("http://g.example/topico", "page/{n}/", 2, "http://g.example/topico/page/2/"),
        ("http://g.example/topico/", "page/{n}/", 3, "http://g.example/topico/page/3/"),
        ("http://g.example/topico/", "?page={n}", 2, "http://g.example/topico?page=2"),
        ("http://g.example/t?a=1", "?page={n}", 2, "http://g.example/t?a=1&page=2"),
        ("http://g.example/topico", "page/{n}/", 1, "http://g.example/topico"),
    ],
)
def test_topic_pages(url, pattern, n, page):
    assert listing.topic_page(url, pattern, n) == page


def test_topic_stops_without_new_links_and_reads_archived_versions(spark, tmp_path):
    put = _recorded(tmp_path)
    s = {"id": "topico:g", "tipo": "topico", "url": "http://g.example/dossie", "max_paginas": 9, "arquivadas": True, "limite_por_minuto": 100000}
    links = lambda *names: "".join(f"<a href='/2016/{n}'>x</a>" for n in names)
    put("http://g.example/dossie", links("materia-um", "materia-dois"))
    put("http://g.example/dossie/page/2/", links("materia-dois", "materia-tres"))
    put("http://g.example/dossie/page/3/", links("materia-um") + "<a href='/dossie/page/4/'>mais</a>")
    put("http://g.example/dossie/page/4/", links("nunca-lida"))
    asked = listing.listing_slices(s, date(2015, 1, 1), date(2016, 1, 1))
    put(listing.CDX, [["timestamp", "original"], ["2015", "http://g.example/dossie"], ["2014", "http://g.example/gone"]], asked[0]["arquivo_params"])
    put("https://web.archive.org/web/2015id_/http://g.example/dossie", links("materia-antiga"))
    reader.register(spark)
    pages = spark.read.format("tidemark_listing").options(fonte=s["id"], canal="topico", fatias=json.dumps(asked), por_minuto="100000", replay=str(tmp_path)).load()
    assert {r.url.rsplit("/", 1)[1] for r in P.topic_links(pages).collect()} == {"materia-um", "materia-dois", "materia-tres", "materia-antiga"}
    assert pages.filter("erro is not null").isEmpty()


def test_runs_over_the_archive_go_slice_by_slice(spark, tmp_path, monkeypatch, capsys):
    """Three runs with one slice each and then the rest, the second one broken: nothing is skipped, nothing repeated."""
    monkeypatch.setattr(C, "urllib_transport", None)
    put, year = _recorded(tmp_path), date.today().year
    s = {"id": "wayback:g", "tipo": "wayback", "prefixos": ["g.example/a/"], "filtro": "(?i).*ilha.*", "fatias_por_rodada": 1, "estrato": "imprensa", "limite_por_minuto": 100000}
    (tmp_path / "c.json").write_text(json.dumps({"lexico": "l.json", "fontes": [s], "desde": f"{year - 2}-03-01", "catalogo": {}, "vistas": {}, "arquivo": {"resolver": True}}))
    (tmp_path / "l.json").write_text(json.dumps({"id": "a", "versao": "1", "termos": [{"chave": "ilha", "formas": ["massacre da ilha cinzenta"]}]}))
    for asked in listing.listing_slices(s, date(year - 2, 3, 1), date.today()):
        assert asked["params"]["filter"] == ["original:(?i).*ilha.*", "statuscode:200", "mimetype:text/html"]
        y = asked["fatia"].split("|")[1]
        put(asked["url"], [["timestamp", "original"], [f"{y}0401000000", f"http://g.example/a/materia-{y}"]], asked["params"])
        put(f"https://web.archive.org/web/{y}0401000000id_/http://g.example/a/materia-{y}", PAGE.format(y))

    def rodar():
        record = collect.run(spark, config.load(tmp_path / "c.json"), L.load(tmp_path / "l.json"), [s], replay=str(tmp_path))
        time.sleep(1.1)  # runs are named by the second
        return record

    one = rodar()
    assert one["itens"] == 1 and "wayback:g" in one["incompletas"] and one["codigo"] == 3 and one["contagens"]["motivo"] == {"aceito": 1}
    keep = collect.Memory.keep

    def broken(*a):
        raise RuntimeError("lost")

    monkeypatch.setattr(collect.Memory, "keep", broken)
    with pytest.raises(RuntimeError):
        rodar()
    monkeypatch.setattr(collect.Memory, "keep", keep)
    two, three, four = rodar(), rodar(), rodar()
    assert [r["itens"] for r in (two, three, four)] == [1, 1, 0] and not three["incompletas"]
    root = config.load(tmp_path / "c.json").root
    assert [x.hash_texto is not None for x in spark.read.parquet(f"{root}/catalogo").collect()] == [True] * 3
    assert spark.read.parquet(f"{root}/catalogo").filter("snapshot <> '' and capturado_em <> ''").count() == 3
    corpus = runs.read_corpus(spark, root)
    assert corpus.count() == 3 and corpus.filter("capturado_em is not null and size(destaques) = 1").count() == 3
    lines = spark.read.option("basePath", f"{root}/saidas/{two['id']}-rodar/relatorio").text(f"{root}/saidas/{two['id']}-rodar/relatorio").collect()
    assert [x.secao for x in lines] == ["aceitos"] and lines[0].value.startswith(f"* [Massacre da Ilha Cinzenta {year - 1}](https://web.archive.org")
    assert collect.Memory(spark, root).marks() == {"wayback:g": date.today()} and collect.Memory(spark, root, blank=True).done() == []
    assert cli.main(["retriar", "--config", str(tmp_path / "c.json")]) == 0 and cli.main(["estimar", "--config", str(tmp_path / "c.json")]) == 0
    assert "## imprensa: 3 unidades" in capsys.readouterr().out
    put(listing.CDX, "1700", {"url": "g.example/a/", "matchType": "prefix", "showNumPages": "true"})
    assert cli.main(["sondar", "--config", str(tmp_path / "c.json"), "--replay", str(tmp_path)]) == 0 and "1700 blocks; too wide" in capsys.readouterr().out


def test_latest_captures(spark, tmp_path):
    ask = {"url": "http://g.example/a", "matchType": "exact", "filter": "statuscode:200", "output": "json", "fl": "timestamp,original", "limit": "-1"}
    _recorded(tmp_path)(listing.CDX, [["timestamp", "original"], ["20200102030405", "http://g.example/a"]], ask)
    rows = spark.createDataFrame([("1", "http://g.example/a"), ("2", "http://g.example/none")], "id string, url string")
    assert [(r.id, r.carimbo) for r in fetch.latest_captures(rows, 100000, str(tmp_path)).collect()] == [("1", "20200102030405")]


def test_refusals_by_country():
    c = C.Client(6000, False, lambda *a: C.Response(403, "u", b"... not available in your country ..."), clock=lambda: 0.0, sleep=lambda s: None)
    with pytest.raises(C.GeoBlocked):
        c.get("http://g.example/a")


def test_run_retries_pending_and_lists_from_the_last_whole_run(spark, tmp_path):
    days = lambda n: str(date.today() - timedelta(days=n))
    feed = lambda *urls: "<rss><channel>" + "".join(f"<item><guid>{u}</guid><link>{u}</link><title>T {u[-1]}</title></item>" for u in urls) + "</channel></rss>"
    put = lambda url, body: (tmp_path / reader.replay_name(url)).write_bytes(body.encode())
    sources = [{"id": f"rss:{n}", "tipo": "rss", "url": f"http://{n}.example/feed", "estrato": "imprensa", "limite_por_minuto": 6000} for n in "ab"]
    sources[1]["margem_dias"] = 5
    (tmp_path / "c.json").write_text(json.dumps({"lexico": "l.json", "fontes": sources}))
    (tmp_path / "l.json").write_text(json.dumps({"id": "a", "versao": "1", "termos": [{"chave": "x", "formas": ["y"]}]}))
    state_dir, out = tmp_path / "dados" / "estado", tmp_path / "dados" / "saidas"

    def rodar(*more):
        before = set(out.glob("*"))
        cli.main(["rodar", "--config", str(tmp_path / "c.json"), "--replay", str(tmp_path), *more])
        (new,) = set(out.glob("*")) - before
        got = spark.read.schema("id_na_fonte string, situacao string, titulo string").json(str(new / "itens.jsonl")).collect()
        return json.loads((new / "rodada.json").read_text())["desde"], {r.id_na_fonte[-1]: (r.situacao, r.titulo) for r in got}

    put("http://a.example/feed", feed("http://a.example/1"))
    since, items = rodar()  # the page is missing, and so is the feed of b
    assert since == {"rss:a": days(7), "rss:b": days(7)} and items == {"1": ("falha_captura", "T 1")}
    assert json.loads((state_dir / "marcas.json").read_text()) == {"rss:a": days(0)}
    put("http://a.example/feed", feed())  # no longer listed
    put("http://b.example/feed", feed())
    (state_dir / "marcas.json").write_text(json.dumps({"rss:a": days(30), "rss:b": days(20)}))
    since, items = rodar("--fonte", "rss:b")
    assert since == {"rss:b": days(25)} and items == {}
    put("http://a.example/1", "<html><body><p>" + "palavra " * 80 + "</p></body></html>")
    since, items = rodar()
    assert since == {"rss:a": days(32), "rss:b": days(5)} and items == {"1": ("triado", "T 1")}
    since, items = rodar("--desde", "2024-01-01")
    assert set(since.values()) == {"2024-01-01"} and items == {} and collect.Memory(spark, config.load(tmp_path / "c.json").root).pending().isEmpty()


def test_streaming_ingest(spark, tmp_path):
    from tidemark.streaming import ingest as S

    schema = "fonte string, id_na_fonte string, url string, ord long"
    put = lambda n, rows: spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / "in" / n))
    put("a", [("f", "1", "u", 1), ("f", "1", "v", 0)])
    S.ingest(spark, str(tmp_path / "in"), str(tmp_path / "out"), schema)
    put("b", [("f", "1", "u", 5), ("f", "2", "w", 6)])
    S.ingest(spark, str(tmp_path / "in"), str(tmp_path / "out"), schema)
    got = spark.read.parquet(str(tmp_path / "out" / "refs")).collect()
    assert sorted((r.id_na_fonte, r.url) for r in got) == [("1", "v"), ("2", "w")]
