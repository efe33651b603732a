from pyspark.sql import functions as F

from martloom.functions import text as T
from martloom.operators import pages as P

from conftest import rows

PAGE = """<html><head><title>Окна &amp; двери</title>
<meta name="description" content="Про окна"><META content='пластик, стекло' NAME='keywords'>
<script>var a = "<h1>нет</h1><p>нет";</script><style>p{}</style></head>
<body><header><h1>В шапке</h1><p>шапка</p></header>
<!-- <p>скрыто</p> -->
<h1>Глав<b>ный</b></h1><h2>Второй</h2><h3>Третий</h3>
<p>один<p>два</p><pre>код</pre><p>три</p><p>четыре</p><p>пять</p><p>шесть</p>
<ul><li>а1</li><li>а2</li></ul><footer>подвал</footer></body></html>"""


def pages(spark, *entries):
    return spark.createDataFrame(list(entries), "page_id bigint, url string, html string")


def test_segments(spark):
    found = rows(P.page_segments(pages(spark, (1, "a.ru", PAGE), (2, "b.ru", None))), "page_id")
    one, none = found
    assert one["title"] == "Окна & двери"
    assert one["meta_keywords"] == "пластик, стекло"
    assert one["meta_description"] == "Про окна"
    assert one["h1"] == "В шапке Главный"
    assert one["h2_h3"] == "Второй Третий"
    assert one["first_paragraphs"] == "один два три четыре пять"
    for word in ("один", "шесть", "код", "а1", "а2", "Главный"):
        assert word in one["main_content"].split(), word
    for word in ("нет", "скрыто", "подвал", "шапка", "двери"):
        assert word not in one["main_content"]
    assert one["content"].startswith("пластик, стекло Про окна Окна & двери")
    assert none["fetched"] is False and none["content"] == "" and none["title"] == ""


def test_missing_parts_and_whitespace(spark):
    html = "<p> a \t\n b c&nbsp;</p>"
    (one,) = rows(P.page_segments(pages(spark, (1, "x", html))))
    assert one["first_paragraphs"] == "a b c"
    assert one["title"] == one["h1"] == one["h2_h3"] == one["meta_keywords"] == ""
    assert one["content"] == "a b c a b c"


def test_urls(spark):
    cases = {
        "u@a.ru:80/x": "u@a.ru:80",
        "HTTP://x.ru": "HTTP:",
        "  http://b.ru?q ": "b.ru",
        "https://c.ru#f": "c.ru",
        "d.ru": "d.ru",
        "http://[::1": "http://[::1",
        "http://[::1]:8/": "[::1]:8",
    }
    frame = spark.createDataFrame([(u,) for u in cases], "url string")
    got = {r.url: r.domain for r in frame.select("url", T.url_domain(F.col("url")).alias("domain")).collect()}
    assert got == cases


def test_token_rules(spark):
    html = "<p>Дом дом-2 пере-дача XML ёж ёжик ok été под_чёрк</p>"
    segments = P.page_segments(pages(spark, (1, "x", html)))
    tokens = P.page_tokens(segments).where("segment = 'first_paragraphs'")
    got = [(r["pos"], r["token"]) for r in rows(tokens, "pos")]
    assert got == [(0, "дом"), (2, "пере-дача"), (3, "xml"), (5, "ёжик")]


def test_script_gate(spark):
    entries = [
        (1, "x", "<p>only latin</p>"),
        (2, "x", "<p>" + "a" * 999 + " я</p>"),
        (3, "x", "<p>" + "a" * 998 + " я</p>"),
        (4, "x", "<p>Ё ё</p>"),
        (5, "x", None),
    ]
    gated = P.page_segments(pages(spark, *entries)).select("page_id", P.page_gate(T.CYRILLIC).alias("g"))
    assert {r["page_id"]: r["g"] for r in rows(gated)} == {
        1: "wrong_script", 2: "wrong_script", 3: "ok", 4: "wrong_script", 5: "no_content",
    }


def test_layout_does_not_change_segments(spark):
    frame = pages(spark, *[(i, f"{i}.ru", PAGE) for i in range(20)])
    assert rows(P.page_segments(frame, by_page=True)) == rows(P.page_segments(frame))


def test_large_input_gets_more_partitions(spark):
    frame = pages(spark, *[(i, f"{i}.ru", PAGE) for i in range(20)])
    assert P._by_page(frame, 50 * 1024**3).rdd.getNumPartitions() == 50
    planned = P._by_page(frame, 100_000 * 1024**3)._jdf.queryExecution().analyzed().toString()
    assert ", 100000" in planned
    assert rows(P._by_page(frame, 50 * 1024**3)) == rows(frame)


def test_names_that_only_begin_like_a_tag(spark):
    html = "<title-x>t</title-x><header-bar>x</header-bar><p>kept words here</p><header>h</header><div>tail<i-con>le</i-con></div><pre>code</pre><h1-x>no</h1-x>"
    (got,) = rows(P.page_segments(pages(spark, (1, "u", html))))
    assert got["main_content"] == "t x kept words here tail le code no"
    assert got["first_paragraphs"] == "kept words here" and got["h1"] == "" and got["title"] == ""


def test_elements_without_an_end(spark):
    (got,) = rows(P.page_segments(pages(spark, (1, "u", "<h1>a<div>b</div>" + "<footer>c"))))
    assert got["h1"] == "abc" and got["main_content"] == "a b"


def test_pages_are_laid_out_in_more_partitions_as_they_grow(spark, monkeypatch, tmp_path):
    """A fixed number by stored size: partitions merged by their compressed size filled a task's memory."""
    from martloom.operators import joins as J

    pages(spark, *[(i, f"{i}.ru", PAGE) for i in range(200)]).coalesce(1).write.parquet(str(tmp_path / "p"))
    stored = spark.read.parquet(str(tmp_path / "p"))
    monkeypatch.setattr(P, "is_small", lambda *_: False)
    monkeypatch.setattr(J, "HELD_PER_PARTITION", J.held_bytes(stored) // 40)
    assert P.page_segments(stored, by_page=True).rdd.getNumPartitions() in (40, 41)
