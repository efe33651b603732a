"""Queries of the page, theme and label operators with their SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.functions import text as T
from martloom.operators import labels as L
from martloom.operators import pages as P
from martloom.operators import themes as TH
from martloom.plans import inputs as I
from martloom.sources import tables as S

# The test pages hold no Cyrillic.
SCRIPT = T.LATIN
NAMES = [name for name, _ in P.SEGMENTS]


# ---- SQL twins ---------------------------------------------------------------------------


def _quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _swap(text: str, pattern: str, by: str) -> str:
    return f"regexp_replace({text}, {_quote(pattern)}, {_quote(by)}, 'g')"


def _decode(text: str) -> str:
    for entity, char in T.ENTITIES:
        text = f"replace({text}, {_quote(entity)}, {_quote(char)})"
    return text


def _squeeze(text: str) -> str:
    return f"trim({_swap(text, T.SPACE, ' ')})"


def _visible(text: str) -> str:
    return _decode(_swap(text, T.TAG, ""))


def _meta(name: str) -> str:
    tag = f"regexp_extract(seen, {_quote(T.META.format(name=name))}, 0)"
    groups = [f"regexp_extract({tag}, {_quote(T.CONTENT_ATTR)}, {g})" for g in (1, 2, 3)]
    return _decode(" || ".join(groups))


def _elements(pattern: str) -> str:
    return _visible(f"array_to_string(regexp_extract_all(seen, {_quote(pattern)}, 1), ' ')")


def _segments_sql() -> str:
    pieces = f"regexp_split_to_array(body, {_quote(T.PARAGRAPH)})[2:6]"
    cut = f"[regexp_replace(x, {_quote(T.PARAGRAPH_END)}, '') for x in {pieces}]"
    main = _swap(_swap(_swap("body", T.TITLE, " "), T.INLINE_TAG, ""), T.TAG, " ")
    raw = {
        "meta_keywords": _meta("keywords"),
        "meta_description": _meta("description"),
        "title": _visible(f"regexp_extract(seen, {_quote(T.TITLE)}, 1)"),
        "h1": _elements(T.H1),
        "h2_h3": _elements(T.H2_H3),
        "first_paragraphs": _visible(f"array_to_string({cut}, ' ')"),
        "main_content": _decode(main),
    }
    body = _swap(_swap("seen", T.FOOTER, " "), T.HEADER, " ")
    columns = ", ".join(f"{_squeeze(sql)} AS {name}" for name, sql in raw.items())
    filled = ", ".join(f"nullif({name}, '')" for name in NAMES)
    return f"""
    seen AS (SELECT page_id, url, html IS NOT NULL AS fetched,
                    {_swap("coalesce(html, '')", T.HIDDEN, ' ')} AS seen FROM pages),
    body AS (SELECT *, {body} AS body FROM seen),
    bare AS (SELECT page_id, url, fetched, {columns} FROM body),
    segments AS (SELECT *, concat_ws(' ', {filled}) AS content FROM bare)"""


def _gate(script: str) -> str:
    return (
        f"CASE WHEN NOT fetched THEN 'no_content' "
        f"WHEN NOT regexp_matches(left(content, 1000), '{script}') THEN 'wrong_script' ELSE 'ok' END"
    )


def _tokens_sql() -> str:
    union = " UNION ALL ".join(
        f"SELECT page_id, '{name}' AS segment, {order} AS segment_ord, {priority} AS priority, "
        f"{name} AS text FROM segments WHERE {_gate(SCRIPT)} = 'ok' AND {name} <> ''"
        for order, (name, priority) in enumerate(P.SEGMENTS)
    )
    return f"""{_segments_sql()},
    texts AS ({union}),
    pieces AS (SELECT page_id, segment, segment_ord, priority, w, generate_subscripts(w, 1) - 1 AS pos
               FROM (SELECT *, regexp_split_to_array(text, '{T.TOKEN_BREAK}') AS w FROM texts) x),
    tokens AS (SELECT page_id, segment, segment_ord, priority, pos, lower(w[pos + 1]) AS token FROM pieces
               WHERE length(w[pos + 1]) > 2 AND regexp_matches(lower(w[pos + 1]), '{T.WORD}'))"""


def _scored_sql(lemmas: bool = False) -> str:
    if lemmas:
        source = f"""{I.ctes('lemmas')},
        lookup AS (SELECT lower(token) AS token, min(lower(lemma)) AS lemma FROM lemmas
                   WHERE pos IN ('NOUN', 'ADJ') GROUP BY 1),
        lemmatised AS (SELECT * FROM tokens JOIN lookup USING (token))"""
    else:
        source = "lemmatised AS (SELECT *, token AS lemma FROM tokens)"
    return f"""{_tokens_sql()},
    {source},
    stats AS (SELECT page_id, lemma, count(*) AS n, avg(priority) AS avg_priority,
                     min(segment_ord * 100000000 + pos) AS first_seen FROM lemmatised GROUP BY 1, 2),
    tfs AS (SELECT *, n / sum(n) OVER p AS tf, ln(max(n) OVER p / (n + 1) + 1) AS idf
            FROM stats WINDOW p AS (PARTITION BY page_id)),
    scored AS (SELECT *, tf * idf * 3 AS tfidf,
                      CAST(least(round_even((tf * idf * 3 + avg_priority) / 2, 0), 10) AS INTEGER) AS score FROM tfs),
    keywords AS (SELECT page_id, lemma, score,
                        row_number() OVER (PARTITION BY page_id ORDER BY score DESC, first_seen) AS rank
                 FROM scored QUALIFY rank <= 70)"""


def _matches_sql(lemmas: bool = False) -> str:
    return f"""{_scored_sql(lemmas)},
    {I.ctes('theme_dictionary')},
    explained AS (SELECT page_id, industry, subindustry, lemma, rank, score AS site_weight,
                         weight AS theme_weight, score * weight AS match_weight
                  FROM keywords JOIN theme_dictionary ON keyword = lemma),
    grouped AS (SELECT page_id, industry, subindustry, sum(match_weight) AS weighted_score,
                       count(*) AS match_count, count(*) FILTER (theme_weight >= 8) AS strong_keywords,
                       string_agg(lemma, ',' ORDER BY rank) AS matched
                FROM explained GROUP BY 1, 2, 3),
    matches AS (SELECT *, CASE WHEN sum(weighted_score) OVER (PARTITION BY page_id) <> 0
                 THEN weighted_score / sum(weighted_score) OVER (PARTITION BY page_id) END AS weighted_score_percent
                FROM grouped)"""


_BEST = """
    best AS (SELECT page_id, industry AS theme, subindustry AS subtheme, weighted_score, matched AS matched_keywords
             FROM matches WHERE weighted_score > 0
             QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY weighted_score DESC, industry, subindustry) = 1)"""

_CONFIDENCE = """
    placed AS (SELECT *, row_number() OVER (PARTITION BY page_id
                 ORDER BY weighted_score DESC, match_count DESC, strong_keywords DESC, industry, subindustry) AS place
               FROM matches),
    facts AS (SELECT page_id, count(*) AS themes, sum(weighted_score) AS total,
                     max(weighted_score_percent) FILTER (place = 1) AS share,
                     max(weighted_score_percent) FILTER (place = 2) AS second,
                     max(match_count) FILTER (place = 1) AS c1, max(strong_keywords) FILTER (place = 1) AS s1,
                     max(strong_keywords) AS smax FROM placed GROUP BY 1),
    factors AS (SELECT *, share - second AS lead,
                       CASE WHEN c1 < 3 THEN 0.1::DOUBLE WHEN c1 = 3 THEN 0.5::DOUBLE WHEN c1 <= 5 THEN 0.8::DOUBLE ELSE 1.0::DOUBLE END AS k,
                       CASE WHEN smax = 0 THEN 'nan'::DOUBLE ELSE s1 / smax END AS kw FROM facts),
    raw AS (SELECT *, k * 0.1::DOUBLE + kw * 0.3::DOUBLE + share * 0.5::DOUBLE + lead * 7.0::DOUBLE AS c FROM factors),
    confidence AS (SELECT *, CASE WHEN isnan(c) THEN c WHEN c > 1 THEN 1.0 ELSE c END AS confidence FROM raw)"""

_DOMAIN = "regexp_extract(CASE WHEN regexp_matches(trim(url), '^https?://') THEN trim(url) ELSE 'https://' || trim(url) END, '^https?://([^/?#]*)', 1)"


# ---- Spark queries -----------------------------------------------------------------------


def _segments(spark: SparkSession, d: str) -> DataFrame:
    return P.page_segments(I.pages(spark, d))


def _tokens(spark: SparkSession, d: str) -> DataFrame:
    return P.page_tokens(P.page_segments(I.pages(spark, d), by_page=True), SCRIPT)


def _keywords(spark: SparkSession, d: str) -> DataFrame:
    return TH.score_keywords(TH.lemmatise(_tokens(spark, d)))


def _matches(spark: SparkSession, d: str) -> DataFrame:
    return TH.match_themes(_keywords(spark, d), I.read(spark, d, "raw_dictionary"))


def theme_dictionary_load(spark, d):
    return TH.load_theme_dictionary(I.read(spark, d, "raw_dictionary"))


def theme_dictionary_scan(spark, d):
    return S.read_theme_dictionary(I.read(spark, d, "raw_dictionary"))


def taxonomy_scan(spark, d):
    return L.read_taxonomy(I.read(spark, d, "themes"))


def page_source(spark, d):
    return S.read_pages(spark, f"{d.rstrip('/')}/pages.parquet")


def page_url_domain(spark, d):
    url = F.col("url")
    return I.pages(spark, d).select(
        "page_id", T.normalise_url(url).alias("normal_url"), T.url_domain(url).alias("domain")
    )


def page_segments(spark, d):
    return _segments(spark, d).select("page_id", "url", *NAMES)


def page_content(spark, d):
    return _segments(spark, d).select("page_id", "content")


def script_gate(spark, d):
    return _segments(spark, d).select(
        "page_id", P.page_gate(T.CYRILLIC).alias("cyrillic"), P.page_gate(T.LATIN).alias("latin")
    )


def page_tokens(spark, d):
    return _tokens(spark, d)


def lemma_join(spark, d):
    lemmas = I.read(spark, d, "lemmas")
    return TH.lemmatise(_tokens(spark, d), lemmas).select(
        "page_id", "segment", "pos", "token", "lemma"
    )


def term_tfidf(spark, d):
    scored = TH.score_terms(TH.term_statistics(TH.lemmatise(_tokens(spark, d))))
    rounded = [F.round(name, 6).alias(name) for name in ("tf", "idf", "tfidf", "avg_priority")]
    return scored.select("page_id", "lemma", "n", *rounded, "score")


def keyword_top70(spark, d):
    return _keywords(spark, d)


def keyword_shown(spark, d):
    return TH.shown_keywords(_keywords(spark, d)).select(
        "page_id", F.array_join("top_keywords", ",").alias("top_keywords")
    )


def theme_explain(spark, d):
    return TH.theme_explain(_keywords(spark, d), I.read(spark, d, "raw_dictionary"))


def theme_matches(spark, d):
    return _matches(spark, d).select(
        "page_id", "industry", "subindustry", "weighted_score", "match_count", "strong_keywords",
        F.array_join("matched", ",").alias("matched"),
        F.round("weighted_score_percent", 6).alias("weighted_score_percent"),
    )


def theme_best(spark, d):
    return TH.best_theme(_matches(spark, d)).withColumn(
        "matched_keywords", F.array_join("matched_keywords", ",")
    )


def theme_confidence(spark, d):
    rounded = [F.round(name, 6).alias(name) for name in ("k", "kw", "share", "lead", "confidence")]
    return TH.theme_confidence(_matches(spark, d)).select("page_id", "themes", *rounded)


def _classified(spark, d, lemmas):
    done = TH.classify_pages(
        I.pages(spark, d), I.read(spark, d, "theme_dictionary"), lemmas, SCRIPT
    )
    return _flat(done)


def _flat(done):
    return done.select(
        "page_id", "url", "domain", "theme", "subtheme",
        F.round("confidence", 6).alias("confidence"),
        F.array_join("matched_keywords", ",").alias("matched_keywords"),
        F.array_join("top_keywords", ",").alias("top_keywords"),
        "status",
    )


def classify_pages(spark, d):
    return _classified(spark, d, None)


def classify_pages_lemmas(spark, d):
    return _classified(spark, d, I.read(spark, d, "lemmas"))


def classify_pages_cyrillic(spark, d):
    """The default script: the test pages are all turned away, each with its one row."""
    done = TH.classify_pages(I.pages(spark, d), I.read(spark, d, "raw_dictionary"))
    return done.select("page_id", "domain", "theme", "confidence", "status")


def page_segments_rich(spark, d):
    """Pages whose segments are known because they are built from them."""
    return P.page_segments(I.read(spark, d, "rich_pages"))


def classify_pages_rich(spark, d):
    """The default script, on pages of both scripts, without text and failed fetches."""
    return _flat(TH.classify_pages(I.read(spark, d, "rich_pages"), I.read(spark, d, "rich_dictionary")))


def taxonomy_list(spark, d):
    return L.taxonomy(I.read(spark, d, "themes")).withColumn(
        "subcategories", F.array_join("subcategories", ",")
    )


def label_prompts(spark, d):
    return L.build_prompts(_segments(spark, d), L.taxonomy(I.read(spark, d, "themes")))


def _labels(spark, d):
    return L.parse_labels(I.read(spark, d, "answers"), L.taxonomy(I.read(spark, d, "themes")))


def label_parse(spark, d):
    return _labels(spark, d)


def label_violations(spark, d):
    return L.label_violations(_labels(spark, d)).select("domain", "theme", "subtheme")


def results_union(spark, d):
    """Classifier and label results as one frame; absent columns are NULL."""
    pages = TH.classify_pages(I.pages(spark, d), I.read(spark, d, "raw_dictionary"), None, SCRIPT)
    return S.combine_results(
        pages.select("domain", "theme", "subtheme", F.round("confidence", 6).alias("confidence")),
        _labels(spark, d).select("domain", "theme", "subtheme", "in_taxonomy"),
    )


def _classified_sql(lemmas: bool) -> str:
    return f"""WITH {_matches_sql(lemmas)}, {_BEST}, {_CONFIDENCE},
    shown AS (SELECT page_id, count(*) AS n, string_agg(lemma, ',' ORDER BY rank) FILTER (rank <= 50) AS top_keywords
              FROM keywords GROUP BY 1),
    joined AS (SELECT s.page_id, s.url, {_gate(SCRIPT)} AS gate, n, top_keywords, themes, total, confidence,
                      theme, subtheme, matched_keywords
               FROM segments s LEFT JOIN shown USING (page_id) LEFT JOIN confidence USING (page_id)
               LEFT JOIN best USING (page_id)),
    stated AS (SELECT *, CASE WHEN gate <> 'ok' THEN gate WHEN n IS NULL THEN 'no_keywords'
                 WHEN themes IS NULL THEN 'no_match' WHEN total = 0 THEN 'zero_total'
                 WHEN themes = 1 THEN 'single_match' ELSE 'ok' END AS status FROM joined),
    classified AS (SELECT page_id, url,
        CASE WHEN status IN ('no_match', 'zero_total', 'single_match') THEN url ELSE {_DOMAIN} END AS domain,
        CASE WHEN status = 'ok' THEN theme END AS theme, CASE WHEN status = 'ok' THEN subtheme END AS subtheme,
        CASE WHEN status = 'ok' THEN round(confidence, 6) ELSE 0.0 END AS confidence,
        CASE WHEN status = 'ok' THEN coalesce(matched_keywords, '')
             WHEN status IN ('no_content', 'wrong_script') THEN '' END AS matched_keywords,
        CASE WHEN status = 'ok' THEN top_keywords WHEN status = 'no_keywords' THEN '' END AS top_keywords,
        status FROM stated)"""


def _rich_segments_sql() -> str:
    """Segments of the rich pages straight from the pieces that they are built of."""
    main = "concat_ws(' ', nullif(t3, ''), nullif(t4, ''), nullif(t5, ''), nullif(t6, ''))"
    parts = {
        "meta_keywords": "t0", "meta_description": "t1", "title": "t2", "h1": "t4", "h2_h3": "t5",
        "first_paragraphs": "t6", "main_content": main,
    }
    columns = ", ".join(f"CASE WHEN fetched THEN {sql} ELSE '' END AS {name}" for name, sql in parts.items())
    filled = ", ".join(f"nullif({name}, '')" for name in NAMES)
    return f"""{I.ctes('rich_pages')},
    cut AS (SELECT p.page_id, p.url, html IS NOT NULL AS fetched, t0, t1, t2, t3, t4, t5, t6
            FROM rich_pages p JOIN rich_parts USING (page_id)),
    bare AS (SELECT page_id, url, fetched, {columns} FROM cut),
    segments AS (SELECT *, concat_ws(' ', {filled}) AS content FROM bare)"""


def _rich_classified_sql() -> str:
    folded = "folded AS (SELECT industry, subindustry, keyword, min(weight) AS weight FROM rich_dictionary GROUP BY 1, 2, 3)"
    return (
        _classified_sql(False)
        .replace(_segments_sql(), _rich_segments_sql())
        .replace(_gate(SCRIPT), _gate(T.CYRILLIC))
        .replace(I.ctes("theme_dictionary"), f"{I.ctes('rich_dictionary')}, {folded}")
        .replace("JOIN theme_dictionary ON", "JOIN folded ON")
    )


def _prompt_sql() -> str:
    values = {
        "domain": "url",
        "page": """to_json({title: title, h1: h1, meta_description: meta_description, meta_keywords: meta_keywords,
            body: concat_ws(' ', first_paragraphs, left(main_content, 800))})::VARCHAR""",
        "taxonomy": "(SELECT taxonomy FROM listed)",
    }
    parts, text = [], L.PROMPT
    for name in ("domain", "page", "taxonomy"):
        head, text = text.split("{" + name + "}", 1)
        parts += [_quote(head), values.get(name, name)]
    return " || ".join([*parts, _quote(text)])


_TAXONOMY = f"""{I.ctes('themes')},
    categories AS (SELECT industry AS category, list_sort(list(DISTINCT subindustry)) AS subcategories
                   FROM themes GROUP BY 1),
    listed AS (SELECT to_json(list(struct_pack("{L.CATEGORY}" := category, "{L.SUBCATEGORY}" := subcategories)
                     ORDER BY category))::VARCHAR AS taxonomy FROM categories)"""

_LABELS = f"""{I.ctes('answers')}, {_TAXONOMY},
    blocks AS (SELECT domain, response, regexp_extract(response, '(?s)\\{{.*\\}}', 0) AS block FROM answers),
    fields AS (SELECT *, block <> '' AND json_valid(block) AS good,
                      CASE WHEN json_valid(block) THEN json_extract_string(block, '$."{L.ANSWER_CATEGORY}"') END AS a,
                      CASE WHEN json_valid(block) THEN json_extract_string(block, '$."{L.ANSWER_SUBCATEGORY}"') END AS b FROM blocks),
    read AS (SELECT domain, CASE WHEN good THEN coalesce(a, '{L.UNDEFINED}') END AS theme,
                    CASE WHEN good THEN coalesce(b, '{L.UNDEFINED}') END AS subtheme,
                    CASE WHEN block = '' THEN 'no_json' WHEN NOT good THEN 'malformed'
                         WHEN a IS NULL OR b IS NULL THEN 'incomplete'
                         WHEN trim(response) <> block THEN 'recovered' ELSE 'ok' END AS status FROM fields),
    pairs AS (SELECT DISTINCT industry, subindustry FROM themes),
    parsed_labels AS (SELECT domain, theme, subtheme, p.industry IS NOT NULL AS in_taxonomy, status
               FROM read LEFT JOIN pairs p ON p.industry = theme AND p.subindustry = subtheme)"""


def _select(chain: str, body: str) -> str:
    return f"WITH {chain} {body}"


QUERIES = {
    "theme_dictionary_load": (
        theme_dictionary_load,
        _select(I.ctes("raw_dictionary"), "SELECT industry, subindustry, keyword, min(weight) AS weight FROM raw_dictionary GROUP BY 1, 2, 3"),
    ),
    "theme_dictionary_scan": (
        theme_dictionary_scan,
        _select(I.ctes("raw_dictionary"), "SELECT industry, subindustry, keyword, weight FROM raw_dictionary ORDER BY 1, 2, 4 DESC, 3"),
    ),
    "taxonomy_scan": (
        taxonomy_scan,
        _select(I.ctes("themes"), "SELECT DISTINCT industry, subindustry FROM themes ORDER BY 1, 2"),
    ),
    "page_source": (page_source, "SELECT page_id, url, html FROM pages"),
    "page_url_domain": (
        page_url_domain,
        f"SELECT page_id, CASE WHEN regexp_matches(trim(url), '^https?://') THEN trim(url) ELSE 'https://' || trim(url) END AS normal_url, {_DOMAIN} AS domain FROM pages",
    ),
    "page_segments": (page_segments, _select(_segments_sql(), f"SELECT page_id, url, {', '.join(NAMES)} FROM segments")),
    "page_content": (page_content, _select(_segments_sql(), "SELECT page_id, content FROM segments")),
    "script_gate": (
        script_gate,
        _select(_segments_sql(), f"SELECT page_id, {_gate(T.CYRILLIC)} AS cyrillic, {_gate(T.LATIN)} AS latin FROM segments"),
    ),
    "page_tokens": (page_tokens, _select(_tokens_sql(), "SELECT * FROM tokens")),
    "lemma_join": (
        lemma_join,
        _select(_scored_sql(True), "SELECT page_id, segment, pos, token, lemma FROM lemmatised"),
    ),
    "term_tfidf": (
        term_tfidf,
        _select(_scored_sql(), "SELECT page_id, lemma, n, round(tf, 6) AS tf, round(idf, 6) AS idf, round(tfidf, 6) AS tfidf, round(avg_priority, 6) AS avg_priority, score FROM scored"),
    ),
    "keyword_top70": (keyword_top70, _select(_scored_sql(), "SELECT page_id, lemma, score, rank FROM keywords")),
    "keyword_shown": (
        keyword_shown,
        _select(_scored_sql(), "SELECT page_id, string_agg(lemma, ',' ORDER BY rank) AS top_keywords FROM keywords WHERE rank <= 50 GROUP BY 1"),
    ),
    "theme_explain": (theme_explain, _select(_matches_sql(), "SELECT * FROM explained")),
    "theme_matches": (
        theme_matches,
        _select(_matches_sql(), "SELECT page_id, industry, subindustry, weighted_score, match_count, strong_keywords, matched, round(weighted_score_percent, 6) AS weighted_score_percent FROM matches"),
    ),
    "theme_best": (theme_best, _select(f"{_matches_sql()}, {_BEST}", "SELECT * FROM best")),
    "theme_confidence": (
        theme_confidence,
        _select(f"{_matches_sql()}, {_CONFIDENCE}", "SELECT page_id, themes, round(k, 6) AS k, round(kw, 6) AS kw, round(share, 6) AS share, round(lead, 6) AS lead, round(confidence, 6) AS confidence FROM confidence"),
    ),
    "classify_pages": (classify_pages, f"{_classified_sql(False)} SELECT * FROM classified"),
    "classify_pages_lemmas": (classify_pages_lemmas, f"{_classified_sql(True)} SELECT * FROM classified"),
    "classify_pages_cyrillic": (
        classify_pages_cyrillic,
        _select(_segments_sql(), f"SELECT page_id, {_DOMAIN} AS domain, CAST(NULL AS VARCHAR) AS theme, 0.0::DOUBLE AS confidence, {_gate(T.CYRILLIC)} AS status FROM segments"),
    ),
    "page_segments_rich": (
        page_segments_rich,
        _select(_rich_segments_sql(), f"SELECT page_id, url, fetched, {', '.join(NAMES)}, content FROM segments"),
    ),
    "classify_pages_rich": (classify_pages_rich, f"{_rich_classified_sql()} SELECT * FROM classified"),
    "taxonomy_list": (
        taxonomy_list,
        _select(_TAXONOMY, "SELECT category, array_to_string(subcategories, ',') AS subcategories FROM categories"),
    ),
    "label_prompts": (
        label_prompts,
        _select(f"{_segments_sql()}, {_TAXONOMY}", f"SELECT page_id, url AS domain, {_prompt_sql()} AS prompt FROM segments WHERE fetched"),
    ),
    "label_parse": (label_parse, _select(_LABELS, "SELECT * FROM parsed_labels")),
    "label_violations": (
        label_violations,
        _select(_LABELS, "SELECT domain, theme, subtheme FROM parsed_labels WHERE theme IS NOT NULL AND NOT in_taxonomy"),
    ),
    "results_union": (
        results_union,
        f"""{_classified_sql(False)}, {_LABELS}
        SELECT domain, theme, subtheme, confidence, NULL::BOOLEAN AS in_taxonomy FROM classified
        UNION ALL SELECT domain, theme, subtheme, NULL, in_taxonomy FROM parsed_labels""",
    ),
}
