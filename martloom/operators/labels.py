"""Category prompts for a language model and the reading of its answers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.operators.joins import lookup_join

# Field names of the category list and of the answer, and the default label.
CATEGORY = "Категория"
SUBCATEGORY = "Подкатегория"
ANSWER_CATEGORY = "категория"
ANSWER_SUBCATEGORY = "подкатегория"
UNDEFINED = "Не определено"
BODY_CHARS = 800

PROMPT = (
    "Сайт {domain}. Его страница в виде JSON: {page}\n"
    "Определи одну категорию и одну её подкатегорию строго по списку: {taxonomy}\n"
    "Других категорий не существует. Ответь одним объектом JSON и ничем кроме него:\n"
    '{"категория": "...", "подкатегория": "..."}'
)
PAGE_FIELDS = ("title", "h1", "meta_description", "meta_keywords", "body")
PROMPT_FIELDS = ("domain", "page", "taxonomy", *PAGE_FIELDS)


def read_taxonomy(dictionary: DataFrame) -> DataFrame:
    """Distinct ``industry, subindustry`` pairs in order."""
    return dictionary.select("industry", "subindustry").distinct().orderBy("industry", "subindustry")


def taxonomy(dictionary: DataFrame) -> DataFrame:
    """``category, subcategories`` (sorted array) of the category table."""
    pairs = dictionary.select("industry", "subindustry").distinct()
    return pairs.groupBy(F.col("industry").alias("category")).agg(
        F.sort_array(F.collect_list("subindustry")).alias("subcategories")
    )


def taxonomy_text(categories: DataFrame) -> DataFrame:
    """One row: the whole list as JSON text.

    The list is part of every prompt, so it is one value: its size is bounded by what a
    model reads, not by this function.
    """
    entries = F.array_sort(
        F.collect_list(F.struct(F.col("category").alias(CATEGORY), F.col("subcategories").alias(SUBCATEGORY)))
    )
    return categories.agg(F.to_json(entries).alias("taxonomy"))


def build_prompts(segments: DataFrame, categories: DataFrame, template: str = PROMPT) -> DataFrame:
    """``page_id, domain, prompt``: page text and category list put into the template.

    The category list is one value for all pages: a scalar subquery, not a join. Fields
    stand in the template as ``{name}``, for the names in ``PROMPT_FIELDS``; ``{page}`` is one
    JSON object of ``PAGE_FIELDS``.
    """
    body = F.concat_ws(" ", F.col("first_paragraphs"), F.substring("main_content", 1, BODY_CHARS))
    fields = [body.alias(name) if name == "body" else F.col(name) for name in PAGE_FIELDS]
    values = {
        "domain": F.col("url"),
        "body": body,
        "page": F.to_json(F.struct(*fields)),
        "taxonomy": taxonomy_text(categories).scalar(),
    }
    parts, rest = [], template
    while rest:
        found = [(rest.find("{" + name + "}"), name) for name in PROMPT_FIELDS]
        found = [hit for hit in found if hit[0] >= 0]
        if not found:
            parts.append(F.lit(rest))
            break
        at, name = min(found)
        parts += [F.lit(rest[:at]), values.get(name, F.col(name))]
        rest = rest[at + len(name) + 2 :]
    read = segments.where("fetched")
    return read.select("page_id", F.col("url").alias("domain"), F.concat(*parts).alias("prompt"))


def parse_labels(answers: DataFrame, categories: DataFrame) -> DataFrame:
    """``domain, theme, subtheme, in_taxonomy, status`` of every answer.

    Statuses: ``ok``; ``recovered`` (text around the object); ``incomplete`` (a field is
    missing and becomes the default label); ``malformed``; ``no_json``.
    """
    block = F.regexp_extract("response", r"(?s)\{.*\}", 0)
    schema = f"`{ANSWER_CATEGORY}` string, `{ANSWER_SUBCATEGORY}` string, _bad string"
    read = answers.withColumn("_block", block).withColumn(
        "_answer", F.from_json("_block", schema, {"columnNameOfCorruptRecord": "_bad"})
    )
    broken = (F.col("_block") == "") | F.col("_block").isNull() | F.col("_answer._bad").isNotNull()
    theme = F.col(f"_answer.`{ANSWER_CATEGORY}`")
    subtheme = F.col(f"_answer.`{ANSWER_SUBCATEGORY}`")
    status = (
        F.when((F.col("_block") == "") | F.col("_block").isNull(), "no_json")
        .when(broken, "malformed")
        .when(theme.isNull() | subtheme.isNull(), "incomplete")
        .when(F.trim("response") != F.col("_block"), "recovered")
        .otherwise("ok")
    )
    parsed = read.select(
        "domain",
        F.when(~broken, F.coalesce(theme, F.lit(UNDEFINED))).alias("theme"),
        F.when(~broken, F.coalesce(subtheme, F.lit(UNDEFINED))).alias("subtheme"),
        status.alias("status"),
    )
    known = categories.select(
        F.col("category").alias("theme"),
        F.explode("subcategories").alias("subtheme"),
        F.lit(True).alias("_known"),
    )
    joined = lookup_join(parsed, known, ["theme", "subtheme"], "left", F.col("domain"))
    return joined.select(
        "domain",
        "theme",
        "subtheme",
        F.coalesce("_known", F.lit(False)).alias("in_taxonomy"),
        "status",
    )


def label_violations(labels: DataFrame) -> DataFrame:
    """Readable answers that name a category or subcategory outside the list."""
    return labels.where("theme is not null and not in_taxonomy")
