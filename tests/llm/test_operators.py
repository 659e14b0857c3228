"""Small fixtures for every training-data operator: defined results for nulls, blanks, ties, repeats and empty tables,
and brute force, round trips or held-out rows for the rest."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import abuse, boilerplate, encode, garbled, history, language, minwise, mixing, neardup, residue, vptree

WORDS = [f"w{i}" for i in range(400)]
TOWNS = "ostra pedra serra barra campo lagoa porto vila".split()


def text(rng, n=120):
    return " ".join(rng.choices(WORDS, k=n))


def edited(rng, t, n):
    w = t.split()
    for _ in range(n):
        w[rng.randrange(len(w))] = rng.choice(WORDS)
    return " ".join(w)


def jac(a, b):
    sets = []
    for t in (a, b):
        w = re.findall(r"[^\W_]+", t.lower())
        if len(w) < 50:
            return -1.0
        sets.append(set(zip(w, w[1:], w[2:])))
    return len(sets[0] & sets[1]) / len(sets[0] | sets[1])


# -- problem 1 --


@pytest.mark.parametrize(
    ("t", "kind"),
    [
        ("Página não encontrada - Gazeta", "error"),
        ("Erro 502 | Gazeta", "error"),
        ("You need to enable JavaScript to run this app.", "script"),
        ("Massa massa magna mauris vitae. Pulvinar", "filler"),
        ("O promotor {{nome}} falou", "placeholder"),
        ("robots.txt não autoriza [object Object]", "placeholder"),
        ("Acesso negado: a corregedoria adiou por 19 dias os mapas da colônia", None),
        ("sentinela: marca 'página não encontrada' nos primeiros 300 caracteres", None),
        ("https://g.example/{{x}}", None),
        ("", None),
        (None, None),
        ("50% de 20% [ilegível] {", None),
    ],
)
def test_residue(t, kind):
    assert residue.assess(t, True)[1] == kind


def test_residue_long_text_that_quotes_and_table(spark):
    quoted = "A página dizia “página não encontrada”. " + "O tribunal ouviu a testemunha. " * 5000
    df = spark.createDataFrame([(1, quoted, "extra"), (2, "Sessão expirada", None), (2, "Sessão expirada", None), (3, None, None)], "ord long, t string, campo string")
    got = residue.residue(df, "t").collect()
    assert [(r.ord, r.campo, r.kind) for r in got] == [(2, "t", "error")] * 2 and residue.residue(df.limit(0), "t").count() == 0


# -- problem 2 --


CLEAN = ["A direção da colônia penal não localizou a sentença", "O júri popular publicou a indenização às famílias", "Le mémorial a présenté l'expertise", "“A câmara”, disse – não"]


def _garble(t):
    yield "utf8 as cp1252", t.encode().decode("cp1252", "ignore")
    yield "utf8 as latin-1", t.encode().decode("latin-1")
    yield "utf8 as cp437", t.encode().decode("cp437")
    yield "utf8 as cp1251", t.encode().decode("cp1251", "ignore")
    yield "latin as mac", t.encode("cp1252").decode("mac_roman")


def test_garbled_rows_are_found_and_restored(spark):
    rng = random.Random(1)
    rows = [(i, rng.choice(CLEAN) + f" {i}") for i in range(3000)]
    bad = {}
    for name, g in _garble(CLEAN[0]):
        bad[10_000 + len(bad)] = (name, g)
    bad[20_000] = ("lost", CLEAN[1].replace("ú", "�"))
    df = spark.createDataFrame(rows + [(k, v[1]) for k, v in bad.items()] + [(30_000, None), (30_001, "")], "ord long, t string")
    got = {r.ord: r.restored for r in garbled.detect(df, "t", garbled.fit(df, "t"), "titulo").collect()}
    assert set(got) == set(bad) and got[20_000] is None
    assert all(v == CLEAN[0] for k, v in got.items() if k != 20_000)
    empty = df.limit(0)
    assert garbled.detect(empty, "t", garbled.fit(empty, "t"), "titulo").count() == 0


# -- problems 3 and 4 --


def test_near_pairs_equal_brute_force():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**63, (20, 4)).astype(np.uint64)
    x = base[rng.integers(0, 20, 1500)]
    for _ in range(20):
        b = rng.integers(0, 256, len(x))
        x[np.arange(len(x)), b // 64] ^= np.uint64(1) << (b % 64).astype(np.uint64)
    a, b = vptree.near_pairs(x, 36)
    i, j = np.nonzero(np.triu(vptree.distances(x[:, None], x[None]) <= 36, 1))
    assert set(zip(np.minimum(a, b), np.maximum(a, b))) == set(zip(i, j)) and len(a) == len(i)
    side = (np.arange(len(x)) % 2).astype(np.int8)
    a, b = vptree.near_pairs(x, 36, side)
    assert {frozenset(p) for p in zip(a.tolist(), b.tolist())} == {frozenset(p) for p in zip(i.tolist(), j.tolist()) if p[0] % 2 != p[1] % 2}


def _documents():
    rng = random.Random(4)
    rows, n = [], 0
    for _ in range(40):
        t = text(rng)
        for k in (0, 2, 3, 4, 8, 20):
            rows.append((n, t if k == 0 else edited(rng, t, k)))
            n += 1
    rows += [(n + 7 + k, rows[6][1]) for k in range(9)]
    rows += [(n, rows[0][1]), (n + 1, rows[0][1]), (n + 2, "curto"), (n + 3, "curto"), (n + 4, None), (n + 5, ""), (n + 6, "outro curto")]
    return rows


def _pairs(rows):
    rows = [r for r in rows if r[1] is not None]
    return {(a, b) for i, (a, x) in enumerate(rows) for b, y in rows[i + 1 :] if jac(x, y) >= 0.7}


@pytest.mark.parametrize(("hot", "part"), [(8192, 512), (4, 2)])
def test_similar_pairs_against_brute_force(spark, monkeypatch, hot, part):
    monkeypatch.setattr(neardup, "HOT", hot)  # 4 forces shards to be split into parts
    monkeypatch.setattr(neardup, "PART", part)  # and copies to be expanded part against part
    monkeypatch.setattr(minwise, "HUB", 2)
    rows = _documents()
    df = spark.createDataFrame([(*r, 1) for r in rows], "ord long, texto string, rep int")
    got = [(r.a, r.b) for r in neardup.similar_pairs(df).collect()]
    assert len(got) == len(set(got)) and set(got) == _pairs(rows)
    assert neardup.similar_pairs(df.limit(0)).count() == 0


def test_groups_are_components(spark):
    rows = _documents()
    label = {o: o for o, t in rows if t is not None}
    equal = {(a, b) for a, x in rows for b, y in rows if a < b and x == y and x is not None}  # short ones too
    for _ in range(10):
        for a, b in _pairs(rows) | equal:
            label[a] = label[b] = min(label[a], label[b])
    got = {r.ord: r.group_id for r in neardup.groups(spark.createDataFrame(rows, "ord long, texto string")).collect()}
    assert got == label


def _lots(rng):
    old = [text(rng) for _ in range(4)]
    cat = [(f"id{i}", f"h{i}") for i in range(3)]
    docs = [(i, f"h{i}", t) for i, t in enumerate(old)]  # the last one isn't in the catalogue
    new = text(rng)
    page = "http://www.g.example/materia"
    rows = [
        (1, "n1", page, "x1", edited(rng, old[0], 3)),
        (2, "n2", "https://g.example/materia/?ref=z", "x2", None),  # same page as 1
        (3, "n3", None, "h1", None),  # hash in the catalogue
        (4, "seen", None, None, ""),
        (5, "n5", None, None, new),
        (6, "n6", None, "x6", edited(rng, new, 2)),  # like 5
        (7, "n7", None, "x6", None),  # hash of 6
        (8, "n8", None, "x8", edited(rng, old[3], 1)),  # like a text that wasn't accepted
        (9, "n9", "http://h.example/só", "x9", "curto"),
        (10, "n10", None, "", new),  # text of 5
    ]
    return rows, cat, docs


@pytest.mark.parametrize("lots", [lambda n: 1, lambda n: None if n > 8 else (n + 1) // 4])
def test_history(spark, lots):
    rows, cat, docs = _lots(random.Random(9))
    batch = spark.createDataFrame([(*r, lots(r[0]), "c") for r in rows], "cand_no long, id_na_fonte string, url string, hash_texto string, texto string, lote int, digest string")
    args = spark.createDataFrame(cat, "id string, hash_texto string"), spark.createDataFrame(docs, "ord long, hash_texto string, texto string"), spark.createDataFrame([({"seen": "q", "other": None},)], "vistos map<string,string>")
    assert {r.cand_no for r in history.known(batch, *args).collect()} == {1, 2, 3, 4, 6, 7, 10}
    if lots(2) == 1 and lots(9) == 1:
        assert history.known(batch.limit(0), *args).count() == 0
        assert {r.cand_no for r in history.known(batch, *(a.limit(0) for a in args)).collect()} == {2, 6, 7, 10}


def test_history_is_signed_once(spark, tmp_path, monkeypatch):
    rng = random.Random(19)
    rows, cat, docs = _lots(rng)
    schema = "cand_no long, id_na_fonte string, url string, hash_texto string, texto string, lote int"
    args = spark.createDataFrame(cat, "id string, hash_texto string"), spark.createDataFrame(docs, "ord long, hash_texto string, texto string"), spark.createDataFrame([], "vistos map<string,string>")
    signed = []
    real = minwise.sign
    monkeypatch.setattr(minwise, "sign", lambda df, keep, t: signed.append((keep[0], df.count())) or real(df, keep, t))
    root = f"file://{tmp_path}/index"
    first = spark.createDataFrame([(*r, 1) for r in rows], schema)
    a = {r.cand_no for r in history.known(first, *args, root=root).collect()}
    assert ("id", 3) in signed
    signed.clear()
    assert {r.cand_no for r in history.known(first, *args, root=root).collect()} == a  # the same batch again
    later = [(11, "m1", None, "y1", edited(rng, rows[5][4], 1), 2), (12, "m2", None, "y2", text(rng), 2)]
    assert {r.cand_no for r in history.known(spark.createDataFrame(later, schema), *args, root=root).collect()} == {11}
    assert all(k == "no" for k, _ in signed)  # no text of the history
    index = history.HistoryIndex(spark, root)
    assert {r.id for r in spark.table(index.table).filter("aceito and batch = 'lote-2'").select("id").distinct().collect()} == {"c12"}
    probe = index.probe(real(spark.createDataFrame([("q", docs[0][2])], "id string, t string"), ["id"], "t"))
    plan = probe._jdf.queryExecution().toString()
    assert "Bucketed: true" in plan and {r.other for r in probe.collect()} >= {"d0", "c1"}
    index.close()
    # only the partitions of the batch's own keys are read
    parted = history.HistoryIndex(spark, f"file://{tmp_path}/parted", parts=64)
    one = real(spark.createDataFrame([("q", docs[0][2])], "id string, t string"), ["id"], "t").withColumn("aceito", F.lit(True))
    parted.append(one, "b")
    plan = parted.probe(one)._jdf.queryExecution().toString()
    assert re.search(r"PartitionFilters: \[[^]]*part#\d+ IN", plan) and {r.other for r in parted.probe(one).collect()} == {"q"}
    parted.close()


def test_hot_keys_of_the_index_are_spread(spark, monkeypatch):
    monkeypatch.setattr(history, "HOT", 3)
    rng = random.Random(29)
    t = text(rng, 200)
    df = spark.createDataFrame([(f"d{i}", edited(rng, t, 1)) for i in range(20)], "id string, t string")
    index = history.HistoryIndex(spark)
    index.append(minwise.sign(df, ["id"], "t").withColumn("aceito", F.lit(True)), "b")
    got = index.probe(minwise.sign(spark.createDataFrame([("q", t)], "id string, t string"), ["id"], "t"))
    assert {r.other for r in got.collect()} == {f"d{i}" for i in range(20)}
    assert spark.table(index.table).groupBy("slot").count().agg(F.max("count")).first()[0] < 15
    index.close()


def test_minwise_recall():
    rng = random.Random(2)
    a = [text(rng, 300) for _ in range(60)]
    b = [edited(rng, t, 12) for t in a]
    _, ka, fa = minwise.signatures(a)
    _, kb, fb = minwise.signatures(b)
    near = [i for i in range(60) if jac(a[i], b[i]) >= 0.7]
    assert len(near) > 50 and all((ka[i] == kb[i]).any() for i in near)
    assert all(np.bitwise_count(fa.view(np.uint64)[i] ^ fb.view(np.uint64)[i]).sum() <= minwise.RADIUS for i in near)
    assert np.allclose(minwise.jaccard(a, b), [jac(x, y) for x, y in zip(a, b)])


# -- problem 6 --

SENTENCES = {
    "pt": ["o tribunal da cidade recusou o pedido das famílias ontem", "a comissão não encontrou os documentos da prisão", "os presos foram ouvidos pelo juiz durante a tarde"],
    "en": ["the court of the city rejected the request of the families", "the commission could not find the papers of the prison", "the prisoners were heard by the judge in the afternoon"],
    "es": ["el tribunal de la ciudad rechazó la solicitud de las familias", "la comisión no encontró los documentos de la cárcel", "los presos fueron escuchados por el juez durante la tarde"],
    "fr": ["le tribunal de la ville a rejeté la demande des familles", "la commission n'a pas trouvé les documents de la prison", "les prisonniers ont été entendus par le juge dans l'après-midi"],
}


def test_labels_and_mixed_texts(spark):
    names = {"pt": "pt-BR", "en": "English", "es": "SPA", "fr": "français"}
    rows, n = [], 0
    for _ in range(60):
        for k, v in SENTENCES.items():
            rows.append((n, names[k], " ".join(random.Random(n).sample(v, 2))))
            n += 1
    odd = [(1000, None, SENTENCES["pt"][0]), (1001, "it", SENTENCES["en"][1]), (1002, "pt", SENTENCES["pt"][0] + " / " + SENTENCES["fr"][1]), (1003, "pt", None), (1004, None, "https://g.example/a"), (1005, "und", "Página não encontrada"), (1006, "xx", "123 !"), (1007, "es", "")]
    items = spark.createDataFrame(rows + odd, "ord long, idioma string, titulo string")
    judged = spark.createDataFrame([(1, "fr", SENTENCES["es"][2])], "ord long, idioma string, trecho string")
    got = {(r.campo, r.ord, r.idioma) for r in language.found(items, judged).collect()}
    assert got == {("titulo", 1000, "pt"), ("titulo", 1001, "en"), ("titulo", 1002, "pt"), ("titulo", 1002, "fr"), ("trecho", 1, "es")}
    assert language.found(items.limit(0), judged.limit(0)).count() == 0


def test_unknown_languages_have_a_low_confidence():
    rows = [(k, " ".join(random.Random(f"{k}{i}").sample(v, 2))) for k, v in SENTENCES.items() for i in range(60)]
    model = language.Classifier.fit([t for _, t in rows], np.array([language.LANGUAGES.index(k) for k, _ in rows]))
    foreign = ["il tribunale della città ha respinto ieri la richiesta delle famiglie", "das Gericht der Stadt wies gestern den Antrag der Familien zurück", "de rechtbank van de stad wees gisteren het verzoek van de families af"]
    known = [v[1] + " " + v[2] for v in SENTENCES.values()]
    low, high = ([max(s, key=lambda x: x[2])[3] for s in model.stretches([language.prepare(t) for t in texts])] for texts in (foreign, known))
    assert max(low) < 0.2 and min(high) > 0.9, (low, high)


def test_short_stretches_come_out_too(spark):
    rows = [(n, k, " ".join(random.Random(n).sample(v, 2))) for n, (k, v) in enumerate([*SENTENCES.items()] * 60)]
    mixed = SENTENCES["pt"][0] + " " + SENTENCES["pt"][2] + " could not find the"
    items = spark.createDataFrame([*rows, (1000, "pt", mixed)], "ord long, idioma string, titulo string")
    judged = spark.createDataFrame([], "ord long, idioma string, trecho string")
    got = [(r.idioma, r.inicio, r.palavras, r.conta) for r in language.stretches(items, judged).filter("ord = 1000").orderBy("inicio").collect()]
    total = len(language.prepare(mixed).split())
    assert got == [("pt", 0, total - 4, True), ("en", total - 4, 4, False)]
    assert language.found(items, judged).count() == 0


# -- problem 7 --


def test_min_cut_equals_brute_force():
    rng = random.Random(6)
    for _ in range(150):
        n = rng.randint(1, 8)
        odds = [rng.choice([-2.0, -0.5, 0.25, 1.0, 2.5]) * rng.random() for _ in range(n)]
        edges = [(i, j, rng.random()) for i in range(n) for j in range(i + 1, n) if rng.random() < 0.4]

        def cost(side):
            return sum(-z if not s and z < 0 and False else (abs(z) if (z > 0) != s else 0) for z, s in zip(odds, side)) + sum(w for i, j, w in edges if side[i] != side[j])

        best = min(cost([bool(m >> i & 1) for i in range(n)]) for m in range(1 << n))
        assert abs(cost(boilerplate.min_cut(odds, edges)) - best) < 1e-9


def _page(rng, i):
    head = f"O tribunal {i} ouviu a testemunha {rng.randint(1, 99)}"
    body = [f"A comissão publicou o relatório {rng.randint(1, 999)} e o juiz {rng.choice(WORDS)} leu a decisão diante de todos." for _ in range(4)]
    menu, foot, more = "Início | Busca | Assine | Contato", f"© {rng.randint(1990, 2020)} Gazeta. Todos os direitos reservados.", "Compartilhe esta notícia"
    lines = [menu, head, *body[:2], more, *body[2:], foot]
    html = f"<html><body><ul class='x1'><li><a href='/a'>{menu}</a></li></ul><h1>{head}</h1>" + "".join(f"<p>{b}</p>" for b in body[:2]) + f"<div class='s'>{more}</div>" + "".join(f"<p>{b}</p>" for b in body[2:]) + f"<section class='e'><small>{foot}</small></section></body></html>"
    return "\n".join(lines), html.encode(), head, {0, 4, 7}


def test_furniture(spark):
    rng = random.Random(8)
    rows, truth = [], {}
    for i in range(200):
        t, h, head, bad = _page(rng, i)
        rows.append((i, "rss:a", head, t, h if i % 2 else None))
        truth[i] = bad
    rows += [(900, "openalex:a", "x", rows[1][3], None), (901, "rss:a", None, None, b"<p>x</p>"), (902, "rss:a", None, "", None), (903, "rss:a", None, "Página não encontrada", None)]
    df = spark.createDataFrame(rows, "ord long, fonte string, titulo string, texto string, bruto binary")
    got = {}
    for r in boilerplate.furniture(df).collect():
        got.setdefault(r.ord, set()).add(r.linha)
    assert got == truth
    body = {r.ord: (r.corpo, r.retiradas) for r in boilerplate.main_body(df).collect()}
    assert body[901] == (None, 0) and body[0][1] == 3 and body[900][0] == rows[1][3]
    assert boilerplate.furniture(df.limit(0)).count() == 0


def test_held_out_pages_in_other_markup_and_with_classes():
    """Pages the model wasn't fitted on: without a page, with classes on the body's elements, and with other tags."""
    rng = random.Random(18)
    train, held = [_page(rng, i) for i in range(150)], [_page(rng, i) for i in range(1000, 1100)]
    model = boilerplate.fit_pages([p[:3] for p in train])
    classed = lambda h: re.sub(rb"<(p|h1)>", rb'<\1 class="story">', h)
    other = lambda h: h.replace(b"<p>", b"<article>").replace(b"</p>", b"</article>").replace(b"ul class='x1'", b"nav").replace(b"</ul>", b"</nav>").replace(b"section", b"footer")
    for change in (lambda h: None, lambda h: h, classed, other):
        lines = wrong = 0
        for t, h, head, bad in held:
            numbers, cut, _ = boilerplate.label(t, change(h), head, "rss:a", model.odds)
            lines += len(numbers)
            wrong += len({n for n, c in zip(numbers, cut) if c} ^ bad)
        assert wrong <= 0.01 * lines
    same = boilerplate.fit_pages([(t, classed(h), head) for t, h, head, _ in train])
    assert np.array_equal(same.weights, model.weights)


def test_long_pages_enter_the_fit(spark):
    rng, rows = random.Random(9), []
    for i in range(8):
        parts = [_page(rng, i) for _ in range(60)]
        html = "".join(p[1].decode().removeprefix("<html><body>").removesuffix("</body></html>") for p in parts)
        rows.append((i, "rss:a", None, "\n".join(p[0] for p in parts), ("<html><body>" + html + " " * 90_000 + "</body></html>").encode()))
    assert all(len(r[3]) > 20_000 for r in rows)
    df = spark.createDataFrame(rows, "ord long, fonte string, titulo string, texto string, bruto binary")
    model, alone = boilerplate.train(df), "Início | Busca | Assine | Contato"
    assert model.odds(boilerplate.features([alone], None))[0] > 0 and np.any(model.weights)


def test_long_furniture_lines_are_told_by_their_words():
    rng = random.Random(3)
    para = lambda: "A comissão publicou o relatório e " + " ".join(rng.choices(WORDS, k=45)) + "."
    note = lambda: " ".join(rng.choices(WORDS, k=35)) + " usamos cookies para medir a audiência e guardamos dados com parceiros."

    def page(with_page):
        lines = [para() for _ in range(6)]
        at = rng.randrange(6)
        lines[at] = note()
        assert all(len(x) >= 200 for x in lines)
        html = "<body>" + "".join(f"<ul><li><a href='/x'>{x}</a></li></ul>" if i == at else f"<p>{x}</p>" for i, x in enumerate(lines)) + "</body>"
        return "\n".join(lines), html.encode() if with_page else None, None, at

    model = boilerplate.fit_pages([page(True)[:3] for _ in range(150)])
    for _ in range(40):
        text_, _, _, at = page(False)
        _, cut, _ = boilerplate.label(text_, None, None, "rss:a", model.odds)
        assert cut == [i == at for i in range(6)]


# -- problem 8 --


def test_ids_equal_the_library_and_round_trip(spark):
    enc = encode.encoder()
    rng = random.Random(5)
    alphabet = ["a", "ção", " ", "  ", "\n", "\t", " ", "😀", "don't", "1987", "<|endoftext|>", ".", "日本", "　"]
    texts = ["".join(rng.choices(alphabet, k=rng.randint(0, 30))) for _ in range(600)] + [text(rng, 20000), "x  ", "\0 a"]
    assert enc.batch(texts) == enc.raw(texts)
    assert all(enc.decode(i) == t for i, t in zip(enc.batch(texts), texts))
    ids, spans = enc.offsets("é😀 b")
    assert len(ids) == len(spans) and spans[-1][1] == 4
    df = spark.createDataFrame([(1, None, "z"), (2, "", None), (3, "a b", "z"), (3, "a b", "z")], "doc_id long, text string, ids string")
    got = [(r.doc_id, r.ids) for r in encode.encode(df).orderBy("doc_id").collect()]
    assert got == [(1, []), (2, []), (3, enc.batch(["a b"])[0]), (3, enc.batch(["a b"])[0])]
    assert [(r.inicio, r.fim) for r in encode.offsets(df).orderBy("doc_id").collect()][1:3] == [([], []), ([0, 1], [1, 3])]
    assert encode.round_trip(df).filter("not exact").count() == 0 and encode.encode(df.limit(0)).count() == 0


# -- problem 9 --


def test_mixture_reaches_shares_within_caps(spark):
    rng = random.Random(3)
    tokens = [(i, s, rng.randint(5, 60)) for i, s in enumerate(rng.choices(["a", "b", "c", None, "untargeted"], [50, 10, 40, 3, 5], k=3000))]
    df = spark.createDataFrame(tokens + [(9999, "a", 0)], "doc_id long, source string, n_tokens long")
    mix = spark.createDataFrame([("a", 0.2, 1), ("b", 0.5, 4), ("c", 0.3, 2), ("none", 0.1, 3), ("null", None, None)], "source string, peso double, max_vezes int")
    got = mixing.copies(df, mix)
    by = {r.source: r for r in mixing.shares(got, df, mix).collect()}
    for s, w in (("a", 0.2), ("b", 0.5), ("c", 0.3)):
        assert abs(by[s].share - w) < 0.005 and by[s].most_copies <= by[s].cap
    # a larger mixture is had by letting sources fall short
    total = sum(r.mixed_tokens for r in by.values())
    wide = {r.source: r for r in mixing.shares(mixing.copies(df, mix, 2.0 * total), df, mix).collect()}
    assert wide["b"].mixed_tokens == 4 * wide["b"].n_tokens and wide["a"].share > by["a"].share and all(r.most_copies <= max(r.cap, 0) for r in wide.values())
    assert by["b"].most_copies == 4 and by["none"].share == 0 and by["untargeted"].share == 0
    assert mixing.copies(df.limit(0), mix).count() == 0 and mixing.copies(df, mix.limit(0)).count() == 0


# -- problem 10 --


def test_nearest_equals_brute_force():
    rng = np.random.default_rng(4)
    rows = []
    for i in range(700):
        b = np.sort(rng.choice(60, 6, replace=False)).astype(np.int32)
        w = rng.random(6)
        rows.append((b, w / np.linalg.norm(w), int(i % 9 == 0), int(i % 9 != 0)))
    index = abuse.Index(np.ones(1 << abuse.BITS), rows)
    dense = np.zeros((index.n, 60))
    for i in range(index.n):
        dense[i, index.bucket[index.first[i] : index.first[i + 1]]] = index.weight[index.first[i] : index.first[i + 1]]
    for _ in range(60):
        b = np.sort(rng.choice(60, 5, replace=False)).astype(np.int32)
        w = rng.random(5)
        w /= np.linalg.norm(w)
        q = np.zeros(60)
        q[b] = w
        _, s = index.nearest(b, w)
        assert np.allclose(np.sort(dense @ q)[::-1][: len(s)], s, atol=1e-5)


def test_scores_equal_brute_force():
    rng = random.Random(14)
    vocabulary = [f"palavra{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(90)]
    bad = vocabulary[:12]
    say = lambda words, k: " ".join(rng.choices(words, k=k)) + "."
    texts = [" ".join([say(vocabulary, 5), say(bad + vocabulary[:25], 4) if i % 4 == 0 else say(vocabulary, 3), say(vocabulary, 1)]) for i in range(500)]
    labels = [int(i % 4 == 0) for i in range(300)]
    p = abuse.Passages(texts)
    n = np.bincount(p.bucket, minlength=1 << abuse.BITS)
    index, _ = abuse.fit(texts[:300], labels, abuse.idf_of([(-1, p.count), *((int(b), int(n[b])) for b in np.nonzero(n)[0])]))
    assert index.n_pos > 2 * abuse.BLOCK  # abusive examples in several blocks
    got, w = index.scores(p), p.weights(index.idf)
    dense = np.zeros((index.n, 1 << abuse.BITS), np.float32)
    dense[np.repeat(np.arange(index.n), index.size), index.bucket] = index.weight
    some = 0
    for j in range(p.count):
        q = np.zeros(1 << abuse.BITS, np.float32)
        at = slice(p.first[j], p.first[j] + p.size[j])
        q[p.bucket[at]] = w[at]
        c = dense @ q
        top = np.lexsort((np.arange(index.n), -c))[: abuse.K]
        top = top[c[top] > abuse.NEAR]
        vote = np.minimum(c[top], 1) ** abuse.POWER
        want = float((vote * index.pos[top] / (index.pos[top] + index.neg[top])).sum() / (vote.sum() + abuse.SILENT))
        some += want > 0
        assert abs(want - got[j]) < 2e-3, (want, got[j])  # equal cosines may be told apart by rounding
    assert some > 100


@pytest.mark.parametrize(("a", "b"), [("vaaagaaabuuundaaa", "vagabunda"), ("d3v4g4r", "devagar"), ("MORON", "moron"), ("Réu", "reu")])
def test_words_are_normalised(a, b):
    assert abuse.normal(a) == b


def test_scores(spark):
    rng = random.Random(7)
    plain = lambda: f"O tribunal de {rng.choice(TOWNS)} recusou o pedido {rng.randint(1, 99)}. A comissão ouviu {rng.choice(TOWNS)}."
    insult = lambda: rng.choice(["Você é um verme.", "Cala a boca, verme.", "Esse relator é um verme nojento!"])
    docs, labels = [], []
    for i in range(300):
        bad = i % 5 == 0
        docs.append((i, plain() + (" " + insult() if bad else ""), "s" if i % 2 else None))
        labels.append((i, int(bad), "a1"))
    docs += [(1000, plain() + " Você é um v e r m e. V0cê é um v.e.r.m.e.", "s"), (1001, "Um verme foi achado no pátio do tribunal de pedra ontem cedo", "s"), (1002, None, "s"), (1003, "", "s"), (1004, plain(), "s")]
    d = spark.createDataFrame(docs, "doc_id long, text string, source string")
    r = spark.createDataFrame(labels + [(0, 1, "a2"), (None, 1, "a"), (1, None, "a")], "doc_id long, abusivo int, anotador string")
    got = {x.doc_id: x for x in abuse.score(d, r).collect()}
    assert len(got) == 305 and got[1000].score >= abuse.FOUND and all(got[k].score < abuse.FOUND for k in (1001, 1002, 1003, 1004))
    assert all((got[i].score >= abuse.FOUND) == (i % 5 == 0) for i in range(300)) and got[1002].evidence is None and "verme" in got[0].evidence
    assert {x.source: x.n_docs for x in abuse.rates(abuse.score(d, r)).collect()} == {None: 150, "s": 155}
    assert all(x.score == 0 for x in abuse.score(d.limit(5), r.limit(0)).collect()) and abuse.score(d.limit(0), r).count() == 0


def test_one_word_passages_are_scored_and_site_names_are_not_examples(spark):
    rng = random.Random(8)
    plain = lambda: f"O tribunal de {rng.choice(TOWNS)} recusou o pedido {rng.randint(1, 99)}. A comissão ouviu {rng.choice(TOWNS)}."
    threat = lambda: rng.choice(["Morra.", "Morra, verme nojento.", "Esse relator é um verme nojento!"])
    docs = [(i, plain() + (" " + threat() if i % 5 == 0 else ""), "s") for i in range(200)]
    # by chance the labelled documents of one site are abusive; many more of it are not labelled
    docs += [(i, plain() + (" " + threat() if i < 303 else "") + " © 1989 Muralaberto.", "s") for i in range(300, 400)]
    docs += [(1000, plain() + " dranegozo79: Morra.", "s"), (1001, "MORRA!", "s"), (1002, "© 1989 Muralaberto.", "s"), (1003, "63", "s"), (1004, "Serra.", "s")]
    labels = [(i, int(i % 5 == 0), "a") for i in range(200)] + [(i, 1, "a") for i in range(300, 303)]
    d, r = spark.createDataFrame(docs, "doc_id long, text string, source string"), spark.createDataFrame(labels, "doc_id long, abusivo int, anotador string")
    got = {x.doc_id: x for x in abuse.score(d, r).collect()}
    assert {i for i, x in got.items() if x.score >= abuse.FOUND} == {i for i in range(200) if i % 5 == 0} | {300, 301, 302, 1000, 1001}
    assert got[1000].evidence == "Morra."


def test_every_query_is_registered_whole():
    from tidemark.llm.queries import QUERIES

    assert {n for n in QUERIES if n.endswith("_found")} == {f"p{i}_found" for i in (1, 2, 3, 4, 6, 7, 10)}
    assert list(QUERIES).index("p8_ids") < list(QUERIES).index("p8_round_trip") and list(QUERIES).index("p9_mix") < list(QUERIES).index("p9_shares")
    assert callable(F.lit)
