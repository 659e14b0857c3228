import random
import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.functions import text as X
from tidemark.functions import url as U
from tidemark.functions.fold import fold, fold_text, tables


def one(spark, c):
    return spark.range(1).select(c.alias("x")).first().x


@settings(max_examples=200, deadline=None)
@given(st.text())
def test_fold_keeps_length(t):
    assert len(fold_text(t)) == len(t)


def test_fold_column_equals_driver(spark):
    rng = random.Random(1)
    chars = [chr(c) for c in range(0x20, 0x3000) if not unicodedata.category(chr(c)).startswith("C")] + ["𝔍", "Ǆ", "ﬁ", "İ"]
    rows = ["".join(rng.choices(chars, k=40)) for _ in range(50)] + ["", "ÁÉÍ ção"]
    got = spark.createDataFrame([(r,) for r in rows], "t string").select("t", fold(F.col("t")).alias("f")).collect()
    assert all(r.f == fold_text(r.t) for r in got)
    assert len(tables()[0]) == len(tables()[1])
    assert one(spark, fold(F.lit(None).cast("string"))) is None


def test_tidy_matches_python(spark):
    rows = ["a  b\r\n\r\n\r\n\r\nc \t\n  d  ", "café", "", "  x \n\n\n\ny　 ", "linha\n \n \n fim"]
    got = spark.createDataFrame([(r,) for r in rows], "t string").select("t", X.tidy(F.col("t")).alias("x")).collect()
    assert {r.t: r.x for r in got} == {r: X.tidy_text(r) for r in rows}


@pytest.mark.parametrize(
    ("raw", "ctype", "text", "enc"),
    [
        ("ção".encode("cp1252"), "text/html; charset=ISO-8859-1", "ção", "cp1252"),
        ("﻿ção".encode(), None, "ção", "utf-8-sig"),
        ("ção".encode("utf-16") + b"x", None, "ção", "utf-16"),
        (b'<meta charset="utf-8">' + "é".encode(), None, '<meta charset="utf-8">é', "utf-8"),
        ("“é”".encode("cp1252"), None, "“é”", "cp1252"),
        ("é".encode(), "text/html; charset=nonsense", "é", "utf-8"),
    ],
)
def test_decode(raw, ctype, text, enc):
    assert X.decode_bytes(raw, ctype) == (text, enc)


def test_page(spark):
    m = "<html><head><title>T - J</title><meta property='og:description' content='D'><meta name=x content=1></head><body><nav>menu<p>x</nav><h1>A &amp; B</h1><p>um<br>dois</p><script>no</script><footer>fim</footer></body>"
    r = spark.createDataFrame([(m,), (None,), ("",)], "m string").select(X.page("m").alias("p")).collect()
    assert r[0].p.text == "A & B\n\num\ndois" and r[0].p.title == "T - J" and r[0].p.h1 == "A & B" and r[0].p.meta["og:description"] == "D"
    assert r[1].p.text is None and r[2].p.text == ""


def test_text_with_parts(spark):
    assert one(spark, X.with_parts(F.lit("abc"), F.lit("b"), F.lit("z"), F.lit(None), F.lit(""))) == "abc\n\nz"


@pytest.mark.parametrize(
    ("given_", "day"),
    [("Sun, 02 Oct 2016 23:30:00 -0300", "2016-10-02"), ("2 Oct 2016 01:00 GMT", "2016-10-02"), ("2016-10-02T23:30:00Z", "2016-10-02"), ("soon", None), (None, None)],
)
def test_feed_day(spark, given_, day):
    got = one(spark, X.feed_day(F.lit(given_).cast("string")))
    assert (str(got) if got else None) == day


def test_other_days(spark):
    parts = lambda *p: one(spark, X.parts_day(F.array(*(F.lit(x).cast("int") for x in p))))
    assert str(parts(1999, 5)) == "1999-05-01" and str(parts(1999, 0, 0)) == "1999-01-01" and parts(None) is None and parts(2001, 13, 1) is None
    assert one(spark, X.compact_day(F.lit("2016id_"))) is None and str(one(spark, X.compact_day(F.lit("20161002080000")))) == "2016-10-02"


def test_small_strings(spark):
    assert one(spark, X.redact(F.lit("u?API_KEY=abc&q=1&showResumeKey=z"))) == "u?API_KEY=<redigido>&q=1&showResumeKey=<redigido>"
    assert one(spark, X.safe_name(F.lit("wayback:a/b "))) == "wayback_a_b" and one(spark, X.safe_name(F.lit("::"))) == "_"
    assert one(spark, X.snippet(F.lit("x" * 200 + " alvo " + "y" * 200), F.lit(201), F.lit(205))).startswith("…x")
    assert one(spark, X.inverted_text(F.create_map(F.lit("b"), F.array(F.lit(1)), F.lit("a"), F.array(F.lit(0), F.lit(2)), F.lit("c"), F.array(F.lit(1))))) == "a c a"
    assert one(spark, X.item_title(F.lit("http://x"), F.lit("http://x"), F.lit("Manchete"))) == "Manchete"


@pytest.mark.parametrize(
    ("url", "normal"),
    [
        ("https://www.Gazeta.example/a/b/", "gazeta.example/a/b"),
        ("http://gazeta.example/a?utm_source=x&id=3", "gazeta.example/a?id=3"),
        ("https://arquivo.example/web/20021002080000id_/http://www.gazeta.example/a", "gazeta.example/a"),
        ("https://web.archive.org/web/2002/https://gazeta.example/a", "gazeta.example/a"),
        ("http://www1.gazeta.example:80/x.shtml#f", "www1.gazeta.example/x.shtml"),
        ("gazeta.example", "gazeta.example/"),
        ("http://g.example/?b=2&a=%20x~*&c=&ref=1", "g.example/?a=+x~%2A&b=2"),
        ("http://g.example/a?k=%zz&amp&AMP=1", "g.example/a?k=%25zz"),
        (None, None),
    ],
)
def test_url(spark, url, normal):
    assert one(spark, U.normalized(F.lit(url).cast("string"))) == normal


def test_identity_is_shared_by_spellings(spark):
    a, b = "https://www.g.example/2016/c.shtml?fbclid=q", "https://arquivo.example/web/20160927090000id_/http://g.example/2016/c.shtml"
    ids = {one(spark, U.identity(F.lit(u))) for u in (a, b)}
    assert len(ids) == 1 and len(ids.pop()) == 16
    assert one(spark, U.domain(F.lit(b))) == "g.example" and one(spark, U.registrable(F.lit("x.y.com.br"))) == "y.com.br"


def test_headings_of_all_pages(spark, tmp_path):
    from tidemark.plans import texts

    pages = {
        "Massacre na ilha": ("<h1>Massacre na ilha</h1>".encode(), None),
        "Réus & juíza": ("<h1>Réus &amp; ju&iacute;za</h1>".encode(), "text/html; charset=utf-8"),
        "Colônia “Penal”": ("<H1 class='x'>Colônia <b>“Penal”</b></H1>".encode("cp1252"), "text/html; charset=iso-8859-1"),
        "Ação": ("<meta charset='latin-1'><h1>\n Ação\n</h1>".encode("latin-1"), None),
        "Prisão": ("<h1>Prisão</h1>".encode("utf-16"), None),
        "Anúncio": ("<p>a &amp; b</p><h1>An\u00fancio</h1>".encode("utf-8-sig"), "text/html"),
    }
    rows = [(i, *v) for i, v in enumerate(pages.values())]
    rows += [(10, b"<p>sem</p>", None), (11, None, None), (12, b"<h1> &nbsp; </h1>", None), (13, b"<nav><h1>menu</h1></nav>", None), (14, b"", None)]
    data = [(o, b, {"content-type": c} if c else None) for o, b, c in rows]
    spark.createDataFrame(data, "ord int, bruto binary, cabecalhos map<string,string>").write.parquet(str(tmp_path / "documento.parquet"))
    got = {r.ord: r.h1 for r in texts.QUERIES["page_headings"](spark, str(tmp_path)).collect()}
    assert got == dict(enumerate(pages))
