import json

import pytest

from martloom.operators import labels as L
from martloom.operators.pages import page_segments

from conftest import rows


def themes(spark):
    return spark.createDataFrame(
        [("Еда", "чай"), ("Еда", "хлеб"), ("Дом", "окна"), ("Еда", "чай")], "industry string, subindustry string"
    )


def test_taxonomy(spark):
    got = rows(L.taxonomy(themes(spark)))
    assert got == [
        {"category": "Дом", "subcategories": ["окна"]}, {"category": "Еда", "subcategories": ["хлеб", "чай"]},
    ]
    (text,) = rows(L.taxonomy_text(L.taxonomy(themes(spark))))
    assert text["taxonomy"] == (
        '[{"Категория":"Дом","Подкатегория":["окна"]},{"Категория":"Еда","Подкатегория":["хлеб","чай"]}]'
    )


def test_a_long_list_is_whole(spark):
    pairs = spark.range(120_000).selectExpr("cast(id % 7 as string) AS industry", "cast(id as string) AS subindustry")
    (text,) = rows(L.taxonomy_text(L.taxonomy(pairs)))
    assert sum(len(entry[L.SUBCATEGORY]) for entry in json.loads(text["taxonomy"])) == 120_000


def test_prompt(spark):
    pages = spark.createDataFrame(
        [(1, "a.ru", "<title>Т {h1}</title><h1>Г</h1><p>абзац</p><div>" + "ж" * 900 + "</div>"), (2, "b.ru", None)],
        "page_id bigint, url string, html string",
    )
    (row,) = rows(L.build_prompts(page_segments(pages), L.taxonomy(themes(spark))))
    page = json.loads(row["prompt"].split("JSON: ")[1].split("\n")[0])
    assert row["domain"] == "a.ru" and page["title"] == "Т {h1}" and page["h1"] == "Г"
    body = page["body"]
    assert body.startswith("абзац ") and len(body) == len("абзац ") + 800
    assert '"Подкатегория":["хлеб","чай"]' in row["prompt"]
    (short,) = rows(L.build_prompts(page_segments(pages), L.taxonomy(themes(spark)), "{domain}: {title}!"))
    assert short["prompt"] == "a.ru: Т {h1}!"


@pytest.mark.parametrize(
    "response, expected",
    [
        ('{"категория": "Еда", "подкатегория": "чай"}', ("Еда", "чай", True, "ok")),
        ('Вот:\n{"категория": "Еда",\n "подкатегория": "чай"} ок', ("Еда", "чай", True, "recovered")),
        ('{"категория": "Еда", "подкатегория": "окна"}', ("Еда", "окна", False, "ok")),
        ('{"категория": "Еда"}', ("Еда", L.UNDEFINED, False, "incomplete")),
        ('{"категория": "Еда", ', (None, None, False, "no_json")),
        ('{"категория" "Еда"}', (None, None, False, "malformed")),
        ("не знаю", (None, None, False, "no_json")),
        (None, (None, None, False, "no_json")),
    ],
)
def test_answers(spark, response, expected):
    answers = spark.createDataFrame([("a.ru", response)], "domain string, response string")
    (row,) = rows(L.parse_labels(answers, L.taxonomy(themes(spark))))
    assert (row["theme"], row["subtheme"], row["in_taxonomy"], row["status"]) == expected


def test_violations(spark):
    answers = spark.createDataFrame(
        [("a", '{"категория": "Еда", "подкатегория": "окна"}'), ("b", '{"категория": "Еда", "подкатегория": "чай"}'), ("c", "нет")],
        "domain string, response string",
    )
    bad = L.label_violations(L.parse_labels(answers, L.taxonomy(themes(spark))))
    assert [r["domain"] for r in rows(bad)] == ["a"]
