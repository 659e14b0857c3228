import hashlib
import os
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import catalog, estimate, slices, state
from tidemark.operators import incremental as I


def test_greedy_equals_scan(spark):
    rng = random.Random(5)
    rows = [(o, rng.choice([None, "", *"abcdefghijklmnopqrst"]), rng.choice([None, "", *map(str, range(15))])) for o in rng.sample(range(1000), 150)]
    kept, ids, hashes = [], set(), set()
    for o, i, h in sorted(rows):
        if (i and i in ids) or (h and h in hashes):
            continue
        kept.append(o)
        ids |= {i} if i else set()
        hashes |= {h} if h else set()
    df = spark.createDataFrame(rows, "ord int, id string, hash_texto string")
    assert sorted(r.ord for r in catalog.independent(df).collect()) == kept
    assert catalog.independent(df.limit(0)).count() == 0


def _obs(spark, sizes):
    rows = [("s", c, "r1", f"u{u}") for c, us in sizes.items() for u in us]
    return spark.createDataFrame(rows, "estrato string, canal string, rodada string, unidade string")


def test_published_figures(spark):
    obs = _obs(spark, {"crossref": range(34), "openalex": range(1, 98)})
    c = estimate.coverage(obs).first()
    assert (c.observadas, c.f1, c.f2, round(c.chao), f"{c.cobertura:.0%}") == (98, 65, 33, 162, "60%")
    p = estimate.pairs(obs).first()
    assert (p.n1, p.n2, p.m, round(p.chapman), round(p.baixo), round(p.alto)) == (34, 97, 33, 100, 98, 104)
    obs = _obs(spark, {"topico": range(26), "wayback": range(26, 89)})
    c, p = estimate.coverage(obs).first(), estimate.pairs(obs).first()
    assert (c.f2, round(c.chao), f"{c.cobertura:.0%}", p.m, round(p.chapman), round(p.baixo), round(p.alto)) == (0, 4005, "2%", 0, 1727, 89, 4059)


def test_short_window_only_when_aligned(spark):
    obs = _obs(spark, {"gdelt": range(3), "rss": range(5)})
    assert estimate.coverage(obs).first().chao is None and estimate.coverage(obs, aligned=True).first().chao is not None
    assert not estimate.pairs(obs).first().comparavel


def test_curve_has_every_run(spark):
    obs = spark.createDataFrame([("a", "x", "r2", "u1"), ("a", "x", "r4", "u1"), ("a", "y", "r4", "u2")], "estrato string, canal string, rodada string, unidade string")
    runs = spark.createDataFrame([("r1",), ("r2",), ("r3",), ("r4",), ("r5",)], "rodada string")
    got = [(r.rodada, r.novas, r.total) for r in estimate.curve(obs, runs).orderBy("rodada").collect()]
    assert got == [("r2", 1, 1), ("r3", 0, 1), ("r4", 1, 2), ("r5", 0, 2)]


def test_units_follow_last_row_and_undated_rows(spark):
    rows = [(1, "p", "rss:a", "r1", 3, "2020-01-01", "h1"), (2, "q", "rss:b", "r1", 3, None, "h1"), (3, "q", "rss:b", "r2", 1, "2020-01-01", "")]
    df = spark.createDataFrame(rows, "ord int, id string, fonte string, rodada string, nivel int, d string, hash_texto string").withColumn("publicado_em", F.to_date("d"))
    strata = spark.createDataFrame([("rss:a", "s")], "fonte string, estrato string")
    assert {(r.estrato, r.unidade) for r in estimate.observed(df, strata).collect()} == {("s", "h1"), ("geral", "q")}
    assert estimate.observed(df, strata, since=F.lit("2019-01-01").cast("date")).count() == 1


def test_first_wins_and_anti_join(spark):
    listed = spark.createDataFrame([("f", "a", "u1", 2), ("f", "a", "u0", 1), ("f", "b", "u2", 3)], "fonte string, id_na_fonte string, url string, ord int")
    pending = spark.createDataFrame([("f", "a", "old", 0), ("f", "c", "u3", 9)], "fonte string, id_na_fonte string, url string, ord int")
    seen = spark.createDataFrame([("f", "b")], "fonte string, id_na_fonte string")
    assert {(r.id_na_fonte, r.url) for r in state.to_fetch(listed, pending, seen).collect()} == {("a", "u0"), ("c", "u3")}


def test_pending_counts_up_and_drops_large_extras(spark):
    items = spark.createDataFrame([("f", "a", "u", {"t": "x" * 5000}, state.FAILED, "", 1), ("f", "b", "u", None, state.DONE, "h", 2), ("f", "c", "u", {"t": "x"}, state.BLOCKED, None, 3)], "fonte string, id_na_fonte string, url string, extra map<string,string>, situacao string, hash_texto string, ord int")
    old = spark.createDataFrame([("f", "a", "u", None, "falha_captura", 1), ("f", "b", "u", None, "falha_captura", 4), ("f", "d", "v", None, "falha_captura", 2)], "fonte string, id_na_fonte string, url string, extra map<string,string>, motivo string, tentativas int")
    got = {r.id_na_fonte: (r.tentativas, r.extra) for r in state.next_pending(old, items).collect()}
    assert got == {"a": (2, None), "d": (2, None)}
    seen = spark.createDataFrame([], "fonte string, id_na_fonte string, hash_texto string")
    assert {(r.id_na_fonte, r.hash_texto) for r in state.next_seen(seen, items).collect()} == {("b", "h"), ("c", "")}


def test_slices(spark):
    p = spark.createDataFrame([("f", "p")], "fonte string, prefixo string")
    plan = slices.plan(p, F.lit("1990-05-01").cast("date"), F.lit("1998-03-01").cast("date"))
    rows = plan.orderBy("ano").collect()
    assert [(str(r.inicio), str(r.fim)) for r in rows] == [("1996-01-01", "1996-12-31"), ("1997-01-01", "1997-12-31"), ("1998-01-01", "None")]
    done = spark.createDataFrame([("f", "p", 1996)], "fonte string, prefixo string, ano int")
    assert [r.ano for r in slices.remaining(plan, done, 1).collect()] == [1997]
    assert {r.ano for r in slices.completed(plan).collect()} == {1996, 1997}


@pytest.mark.parametrize(("url", "noise"), [("http://a/feed/", True), ("http://a/tag/x", True), ("http://a/b.pdf?x", True), ("http://a/materia-longa", False), ("http://a/?s=x", True)])
def test_noise(spark, url, noise):
    assert spark.range(1).select(slices.is_noise(F.lit(url)).alias("n")).first().n is noise


def _listing(spark, rows):
    return spark.createDataFrame(rows, "ord int, rodada string, id_na_fonte string, atualizado_em timestamp, hash_texto string")


def test_changed_records_against_loop(spark, tmp_path):
    import datetime as D

    rng = random.Random(2)
    t = lambda n: None if n == 0 else D.datetime(2024, 1, 1) + D.timedelta(hours=n)
    rows = [(o, f"r{rng.randint(1, 6)}", rng.choice(["a", "b", "c", None]), t(rng.randint(0, 5)), rng.choice(["x", "y", None])) for o in range(200)]
    saves = [(3, "r1", {"a": "x"}), (5, "r2", {"a": "y", "b": None}), (4, "r2", {"a": "z"}), (9, None, None)]
    listing, s = _listing(spark, rows), spark.createDataFrame(saves, "gravacao int, rodada string, vistos map<string,string>")
    known = {}
    for _, _, v in sorted(saves, key=lambda x: x[0]):
        known.update(v or {})
    expected = set()
    for run in ("r3", "r4", "r5", "r6"):
        mine = [r for r in rows if r[1] == run and r[2]]
        for i in {r[2] for r in mine}:
            h = max((r for r in mine if r[2] == i), key=lambda r: (r[3] is not None, r[3] or t(1), r[0]))[4]
            if i not in known or known[i] != h:
                expected.add((run, i))
            known[i] = h
    listing.write.parquet(f"{tmp_path}/whole")
    listing.limit(0).write.parquet(f"{tmp_path}/none")
    assert {(r.rodada, r.id_na_fonte) for r in I.ingest(spark, f"{tmp_path}/whole", s).collect()} == expected
    assert I.ingest(spark, f"{tmp_path}/none", s).count() == 0


@pytest.mark.parametrize("grow", ["rewritten", "new files"])
def test_later_calls_on_one_root_add_only_changes(spark, tmp_path, monkeypatch, grow):
    rng = random.Random(5)
    rows = [(o, f"r{rng.randint(1, 7)}", rng.choice("abcdef"), None, rng.choice(["x", "y", None])) for o in range(90)]
    saves = [(3, "r1", {"a": "x", "b": None}), (5, "r2", {"a": "y", "c": "x"})]
    rows += [(100 + k, r, "same", None, "x") for k, r in enumerate(("r3", "r5", "r6"))]
    save = lambda s: spark.createDataFrame(s, "gravacao int, rodada string, vistos map<string,string>")
    key = lambda df: sorted((r.rodada, r.id_na_fonte, r.hash_texto or "") for r in df.collect())
    root, held = f"file://{tmp_path}/kept", []

    def call(now, kept=root):
        """The listing as one file that is written anew, or as files of what is new in it."""
        if kept is None:
            _listing(spark, now).coalesce(1).write.parquet(f"{tmp_path}/alone")
            return key(I.ingest(spark, f"{tmp_path}/alone", save(saves)))
        fresh = now if grow == "rewritten" else [r for r in now if r not in held]
        if [r for r in now if r not in held]:
            _listing(spark, fresh).coalesce(1).write.mode("overwrite" if grow == "rewritten" else "append").parquet(f"{tmp_path}/listing")
            held.extend(r for r in now if r not in held)
        return key(I.ingest(spark, f"{tmp_path}/listing", save(saves), kept))

    upto = lambda n: [r for r in rows if r[1] <= n]
    whole = call(upto("r6"), None)
    assert call(upto("r4")) == [r for r in whole if r[0] <= "r4"]
    assert call(upto("r5")) == [r for r in whole if r[0] <= "r5"]
    assert call(upto("r6")) == whole
    # an unchanged listing isn't read at all
    real = I.compared
    monkeypatch.setattr(I, "compared", lambda *a: pytest.fail("listing read"))
    assert call(upto("r6")) == whole
    monkeypatch.setattr(I, "compared", real)
    # a run listed anew with one more record gives just that one
    more = upto("r6") + [(200, "r5", "late", None, "x")]
    assert call(more) == sorted([*whole, ("r5", "late", "x")])
    # a run saved meanwhile isn't due, and its versions come after those of earlier batches
    saves += [(9, "r7", {"same": "z", "a": "w"})]
    last = upto("r7") + [(200, "r5", "late", None, "x"), (300, "r8", "same", None, "z"), (301, "r8", "a", None, "x"), (302, "r8", "late", None, "x")]
    assert call(last) == sorted([*whole, ("r5", "late", "x"), ("r8", "a", "x")])


def test_manifest_survives_a_broken_run(spark, tmp_path):
    m = I.Manifest(spark, f"file://{tmp_path}/m")
    units = lambda *u: spark.createDataFrame([(x, 1, "c") for x in u], I.UNIT_SCHEMA)
    schema = "unit string"
    assert m.run(units("a", "b"), lambda u: u.select("unit")) and m.run(units("a", "b"), lambda u: u.select("unit")) is None

    def broken(u):
        u.select("unit").write.parquet(f"file://{tmp_path}/m/data/batch={m.batch_id(u)}")  # written, never committed
        raise RuntimeError

    with pytest.raises(RuntimeError):
        m.run(units("a", "b", "c"), broken)
    assert sorted(r.unit for r in m.read(schema).collect()) == ["a", "b"]
    m.run(units("a", "b", "c", "d"), lambda u: u.select("unit"))
    assert sorted(r.unit for r in m.read(schema).collect()) == ["a", "b", "c", "d"]
    changed = spark.createDataFrame([("a", 2, "other")], I.UNIT_SCHEMA)
    assert m.run(changed, lambda u: u.select("unit")) is not None


def test_files_are_listed_with_checksums(spark, tmp_path):
    (tmp_path / "x.bin").write_bytes(b"abc")
    r = I.list_files(spark, str(tmp_path)).first()
    assert (r["size"], len(r.checksum)) == (3, 64)
    r = I.list_files(spark, str(tmp_path), limit=2).first()
    assert r["size"] == 3 and r.checksum.startswith("20")  # a time


def test_a_large_file_is_listed_by_its_bytes(spark, tmp_path, monkeypatch):
    """One byte above CONTENT_LIMIT: a change that keeps size and time is seen, a new time alone isn't a change."""
    folder = tmp_path / "in here"
    folder.mkdir()
    big, small = folder / "big #1.bin", folder / "small.bin"
    small.write_bytes(b"abc")
    with big.open("wb") as f:
        f.truncate(I.CONTENT_LIMIT + 1)
    os.utime(big, (1.7e9, 1.7e9))
    m = I.Manifest(spark, f"file://{tmp_path}/m")
    m.run(I.list_files(spark, str(folder)), lambda u: u.select("unit"))
    with big.open("r+b") as f:
        f.seek(1 << 20)
        f.write(b"x")
    os.utime(big, (1.7e9, 1.7e9))
    assert [r["size"] for r in m.pending(I.list_files(spark, str(folder))).collect()] == [I.CONTENT_LIMIT + 1]
    m.run(I.list_files(spark, str(folder)), lambda u: u.select("unit"))
    os.utime(big, (1.8e9, 1.8e9))
    assert m.pending(I.list_files(spark, str(folder))).count() == 0
    # rows, tasks' streams and the driver's streams give the same checksums
    expected = {"big #1.bin": hashlib.sha256(big.read_bytes()).hexdigest(), "small.bin": hashlib.sha256(b"abc").hexdigest()}
    listed = lambda: {r["unit"].rsplit("/", 1)[1]: r.checksum for r in I.list_files(spark, str(folder)).collect()}
    assert listed() == expected
    monkeypatch.setattr(I, "CONTENT_LIMIT", 2)
    assert listed() == expected
    monkeypatch.setattr(I, "on_mount", lambda *a: False)
    assert listed() == expected
