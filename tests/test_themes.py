import math
import re

import pytest
from pyspark.sql import functions as F

from martloom.operators import themes as TH
from martloom.operators.pages import page_segments, page_tokens

from conftest import rows

MATCHES = (
    "page_id bigint, industry string, subindustry string, weighted_score double, "
    "match_count bigint, strong_keywords bigint, matched array<string>"
)
DICTIONARY = "industry string, subindustry string, keyword string, weight double"


def pages(spark, *entries):
    return spark.createDataFrame(list(entries), "page_id bigint, url string, html string")


def confidence(spark, *entries):
    frame = spark.createDataFrame([(1, *e, []) for e in entries], MATCHES)
    (row,) = rows(TH.theme_confidence(frame))
    return row


def test_score_golden(spark):
    html = "<title>окно</title><div>окно окно дом</div>"
    tokens = page_tokens(page_segments(pages(spark, (1, "x", html))))
    found = rows(TH.score_keywords(TH.lemmatise(tokens)), "rank")
    assert [(r["lemma"], r["score"], r["rank"]) for r in found] == [("окно", 4, 1), ("дом", 3, 2)]


def test_half_even_and_cap(spark):
    statistics = spark.createDataFrame(
        [(1, "a", 1, 5, 0), (2, "b", 1, 30, 0)], "page_id bigint, lemma string, n bigint, priority_sum bigint, first_seen bigint"
    )
    scored = {r["page_id"]: r for r in rows(TH.score_terms(statistics))}
    # one lemma: tf 1, idf ln(1.5), tfidf 1.2164
    assert scored[1]["score"] == round((3 * math.log(1.5) + 5) / 2)
    assert scored[2]["score"] == 10


def test_top_is_stable_by_first_place(spark):
    words = [a + b + c for a in "абвгд" for b in "аеиоу" for c in "клмнп"][:100]
    html = "<p>" + " ".join(words) + "</p>"
    tokens = page_tokens(page_segments(pages(spark, (1, "x", html))))
    found = rows(TH.score_keywords(TH.lemmatise(tokens)))
    assert len(found) == 70
    assert [r["lemma"] for r in sorted(found, key=lambda r: r["rank"])] == words[:70]


def test_lowest_weight_stays(spark):
    frame = spark.createDataFrame([("A", "x", "дом", 9.0), ("A", "x", "дом", 2.0), ("B", "x", "дом", 5.0)], DICTIONARY)
    assert [(r["industry"], r["weight"]) for r in rows(TH.load_theme_dictionary(frame))] == [("A", 2.0), ("B", 5.0)]


def test_lemma_lookup(spark):
    tokens = spark.createDataFrame([(1, "дома"), (1, "идти"), (1, "синяя"), (1, "новое")], "page_id bigint, token string")
    lemmas = spark.createDataFrame(
        [("Дома", "Дом", "NOUN"), ("идти", "идти", "VERB"), ("синяя", "синий", "ADJ")], "token string, lemma string, pos string"
    )
    assert [r["lemma"] for r in rows(TH.lemmatise(tokens, lemmas))] == ["дом", "синий"]


@pytest.mark.parametrize(
    "entries, expected",
    [
        ([("A", "x", 60.0, 3, 1), ("B", "y", 40.0, 5, 2)], 1.0),
        ([("A", "x", 52.0, 3, 1), ("B", "y", 48.0, 5, 2)], 0.74),
    ],
)
def test_confidence_golden(spark, entries, expected):
    assert confidence(spark, *entries)["confidence"] == pytest.approx(expected)


def test_confidence_nan_single_and_zero(spark):
    nan = confidence(spark, ("A", "x", 60.0, 3, 0), ("B", "y", 40.0, 5, 0))
    assert math.isnan(nan["confidence"]) and math.isnan(nan["kw"])
    single = confidence(spark, ("A", "x", 60.0, 3, 1))
    assert single["themes"] == 1 and single["confidence"] is None
    assert confidence(spark, ("A", "x", 0.0, 3, 1), ("B", "y", 0.0, 1, 1))["confidence"] is None


@pytest.mark.parametrize("count, k", [(1, 0.1), (2, 0.1), (3, 0.5), (4, 0.8), (5, 0.8), (6, 1.0)])
def test_count_factor(spark, count, k):
    assert confidence(spark, ("A", "x", 60.0, count, 1), ("B", "y", 40.0, 5, 2))["k"] == k


def test_tie_rules_differ(spark):
    entries = [(1, "A", "x", 50.0, 2, 1, ["m"]), (1, "B", "y", 50.0, 4, 1, ["n"])]
    frame = spark.createDataFrame(entries, MATCHES)
    (best,) = rows(TH.best_theme(frame))
    assert (best["theme"], best["subtheme"], best["matched_keywords"]) == ("A", "x", ["m"])
    assert rows(TH.theme_confidence(frame))[0]["k"] == 0.8  # of B/y


def _dictionary(spark):
    return spark.createDataFrame(
        [
            ("Стройка", "окна", "окно", 9.0), ("Стройка", "окна", "рама", 8.0),
            ("Стройка", "дома", "дом", 5.0), ("Еда", "хлеб", "булка", 3.0),
            ("Еда", "хлеб", "мука", 4.0), ("Еда", "чай", "чай", 2.0), ("Пусто", "ноль", "нуль", 0.0),
            ("Пусто", "нет", "нуль", 0.0),
        ],
        DICTIONARY,
    )


def _classified(spark, lemmas=None):
    entries = [
        (1, "http://ok.ru/a", "<title>окно рама</title><p>окно дом дом булка</p>"),
        (2, "fail.ru", None),
        (3, "http://latin.ru", "<p>only latin words</p>"),
        (4, "short.ru", "<p>я и мы</p>"),
        (5, "none.ru/x", "<p>слон кит</p>"),
        (6, "single.ru/x", "<p>чай слон</p>"),
        (7, "zero.ru/x", "<p>нуль слон</p>"),
        (8, "weak.ru", "<p>булка мука чай дом</p>"),
    ]
    done = TH.classify_pages(pages(spark, *entries), _dictionary(spark), lemmas)
    return {r["page_id"]: r for r in rows(done)}


def test_every_status(spark):
    got = _classified(spark)
    assert {k: r["status"] for k, r in got.items()} == {
        1: "ok", 2: "no_content", 3: "wrong_script", 4: "no_keywords", 5: "no_match",
        6: "single_match", 7: "zero_total", 8: "ok",
    }
    assert (got[1]["theme"], got[1]["subtheme"], got[1]["domain"]) == ("Стройка", "окна", "ok.ru")
    assert got[1]["matched_keywords"] == ["рама", "окно"]  # a title word outranks repeats below
    assert got[1]["top_keywords"][0] == "рама" and set(got[1]["top_keywords"]) == {"окно", "рама", "дом", "булка"}
    assert got[2]["domain"] == "fail.ru" and got[2]["matched_keywords"] == [] and got[2]["top_keywords"] is None
    assert got[3]["confidence"] == 0.0 and got[3]["matched_keywords"] == []
    assert got[4]["matched_keywords"] is None and got[4]["top_keywords"] == []
    for k in (5, 6, 7):
        assert got[k]["domain"].endswith("/x") and got[k]["theme"] is None
        assert got[k]["matched_keywords"] is None and got[k]["top_keywords"] is None
    assert math.isnan(got[8]["confidence"]) and got[8]["theme"] == "Еда"


def test_classify_agrees_with_the_single_steps(spark):
    html = "<title>окно рама</title><p>окно дом дом булка</p>"
    frame = pages(spark, (1, "ok.ru", html))
    keywords = TH.score_keywords(TH.lemmatise(page_tokens(page_segments(frame))))
    matches = TH.match_themes(keywords, _dictionary(spark))
    (conf,) = rows(TH.theme_confidence(matches))
    (best,) = rows(TH.best_theme(matches))
    one = _classified(spark)[1]
    assert one["confidence"] == pytest.approx(conf["confidence"])
    assert one["matched_keywords"] == best["matched_keywords"]
    shares = [r["weighted_score_percent"] for r in rows(matches)]
    assert sum(shares) == pytest.approx(1.0)
    twice = _dictionary(spark).union(_dictionary(spark).withColumn("weight", F.col("weight") + 1))
    assert rows(TH.match_themes(keywords, twice)) == rows(matches)
    explained = rows(TH.theme_explain(keywords, _dictionary(spark)))
    assert sum(r["match_weight"] for r in explained) == pytest.approx(sum(r["weighted_score"] for r in rows(matches)))


def test_classify_with_lemmas_drops_other_parts_of_speech(spark):
    lemmas = spark.createDataFrame(
        [("окно", "окно", "NOUN"), ("рама", "рама", "VERB"), ("дом", "дом", "NOUN"), ("булка", "булка", "NOUN")],
        "token string, lemma string, pos string",
    )
    got = _classified(spark, lemmas)
    assert got[1]["top_keywords"] and "рама" not in got[1]["top_keywords"]
    assert got[5]["status"] == "no_keywords" and len(got) == 8


def test_salted_and_plain_joins_agree(spark):
    from martloom.operators import joins as J

    big = spark.createDataFrame([(i, "hot" if i % 3 else f"k{i}") for i in range(300)], "page_id bigint, key string")
    lookup = spark.createDataFrame([("hot", 1), ("hot", 2), ("k3", 3)], "key string, v int")
    plain = {how: rows(big.join(lookup, ["key"], how)) for how in ("inner", "left", "left_anti")}
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
    try:
        for how, expected in plain.items():
            salted = J.lookup_join(big, lookup, ["key"], how, big["page_id"], limit=-1)
            assert "_salt" in salted._jdf.queryExecution().analyzed().toString()
            assert rows(salted) == expected
    finally:
        spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")


def test_generators_void_the_size_bound(spark):
    from pyspark.sql import functions as F

    from martloom.operators import joins as J

    frame = spark.range(10).select(F.explode(F.sequence(F.lit(1), F.lit(1000))).alias("n"))
    assert J.plan_bytes(frame) is None and not J.is_small(frame)
    assert J.is_small(spark.range(10))


@pytest.mark.parametrize("skew_join", ["true", "false"])
def test_large_dictionaries_take_another_way_to_the_same_result(spark, monkeypatch, skew_join):
    from martloom.operators import joins as J

    lemmas = spark.createDataFrame(
        [(w, w, "NOUN") for w in ("окно", "рама", "дом", "булка", "мука", "чай", "нуль", "слон")],
        "token string, lemma string, pos string",
    )
    plain = repr(_classified(spark, lemmas))
    monkeypatch.setattr(J, "is_small", lambda *_: False)
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", skew_join)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert repr(_classified(spark, lemmas)) == plain
    finally:
        spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")


def test_many_keywords_are_all_listed(spark):
    """More ranks than one word of bits, up to top; a rank beyond top is an error, not a loss."""
    words = [(1, f"w{i:03d}", 500 - i, i + 1) for i in range(200)]
    keywords = spark.createDataFrame(words, "page_id bigint, lemma string, score int, rank int")
    themes = spark.createDataFrame([("A", "a", w[1], 1.0) for w in words], "industry string, subindustry string, keyword string, weight double")
    (row,) = rows(TH.match_themes(keywords, themes, top=200))
    assert row["match_count"] == 200 and row["matched"] == [w[1] for w in words]
    with pytest.raises(Exception, match="ranks above top=70"):
        TH.match_themes(keywords, themes).collect()


def test_matches_of_a_large_dictionary_travel_packed(spark, monkeypatch):
    """Same rows as by a broadcast, and no shuffle of one row per match with the themes' names."""
    from martloom.operators import joins as J

    keywords = spark.createDataFrame(
        [(p, f"w{(p * k) % 7}x{k}", k, k) for p in range(20) for k in range(1, 9)] + [(99, "none", 1, 1), (None, "w0x7", 3, 1)],
        "page_id bigint, lemma string, score int, rank int",
    )
    entries = [(f"I{t % 3}", f"s{t}" if t else None, f"w{m}x{k}", float(m + k)) for t in range(5) for m in range(7) for k in range(1, 9) if (t + m + k) % 3]
    entries += [(None, "s1", "w0x1", 9.0), ("I0", "s1", None, 9.0), ("I0", "s9", "w0x7", None), ("I0", None, "w0x7", 1.0), ("I0", None, "w0x7", 0.5)]
    themes = spark.createDataFrame(entries, DICTIONARY)
    wanted = rows(TH.match_themes(keywords, themes))
    assert any(r["subindustry"] is None for r in wanted) and any(r["page_id"] is None for r in wanted)
    monkeypatch.setattr(J, "is_small", lambda *_: False)
    found = TH.match_themes(keywords, themes)
    assert rows(found) == wanted
    assert "hashpartitioning(page_id, industry" not in re.sub(r"#\d+L?", "", found._jdf.queryExecution().executedPlan().toString())
