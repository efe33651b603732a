"""Keyword scoring, theme matching and confidence."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martloom.functions import text as T
from martloom.operators import joins
from martloom.operators.joins import by_page, held_bytes, lookup_join
from martloom.operators.pages import occurrence_aggregates, page_segments, page_token_stats
from martloom.session import stage

TOP_KEYWORDS = 70
SHOWN_KEYWORDS = 50
STRONG_WEIGHT = 8
# Weights of match count, strong share, score share and lead in confidence.
CONFIDENCE_WEIGHTS = (0.1, 0.3, 0.5, 7.0)


def load_theme_dictionary(dictionary: DataFrame) -> DataFrame:
    """One row per industry, subindustry and keyword; the lowest weight of a repeat stays."""
    return dictionary.groupBy("industry", "subindustry", "keyword").agg(
        F.min(F.col("weight").cast("double")).alias("weight")
    )


def lemma_lookup(lemmas: DataFrame, pos: Sequence[str] = ("NOUN", "ADJ")) -> DataFrame:
    """``token, lemma`` of the wanted parts of speech, one row per lower-case token."""
    return (
        lemmas.where(F.col("pos").isin(*pos))
        .groupBy(F.lower("token").alias("token"))
        .agg(F.min(F.lower("lemma")).alias("lemma"))
    )


def lemmatise(
    tokens: DataFrame, lemmas: DataFrame | None = None, pos: Sequence[str] = ("NOUN", "ADJ")
) -> DataFrame:
    """Add ``lemma``, keeping the tokens the lemma table knows in a wanted part of speech.

    The table stands in for a tagger; without one every token is its own lemma.
    """
    if lemmas is None:
        return tokens.withColumn("lemma", F.col("token"))
    return lookup_join(tokens, lemma_lookup(lemmas, pos), ["token"], "inner", F.col("page_id"))


def term_statistics(lemmatised: DataFrame) -> DataFrame:
    """``n, priority_sum, first_seen`` per page and lemma."""
    return lemmatised.groupBy("page_id", "lemma").agg(*occurrence_aggregates())


def score_terms(statistics: DataFrame) -> DataFrame:
    """Add ``tf, idf, tfidf, avg_priority, score``; rows with a NULL lemma do not count."""
    page = Window.partitionBy("page_id")
    n = F.when(F.col("lemma").isNotNull(), F.col("n"))
    counted = statistics.withColumns(
        {"total": F.sum(n).over(page), "max_n": F.max(n).over(page)}
    )
    return (
        counted.withColumn("tf", n / F.col("total"))
        .withColumn("idf", F.ln(F.col("max_n") / (n + 1) + 1))
        .withColumn("tfidf", F.col("tf") * F.col("idf") * 3)
        .withColumn("avg_priority", F.col("priority_sum") / n)
        .withColumn("score", _score())
    )


def _score() -> Column:
    rounded = F.bround((F.col("tfidf") + F.col("avg_priority")) / 2, 0)
    return F.when(rounded > 10, 10.0).otherwise(rounded).cast("int")


def rank_keywords(scored: DataFrame) -> DataFrame:
    """Add ``rank`` within the page: best score first, then first occurrence."""
    order = Window.partitionBy("page_id").orderBy(
        F.col("lemma").isNull(), F.col("score").desc(), F.col("first_seen")
    )
    return scored.withColumn("rank", F.row_number().over(order))


def score_keywords(lemmatised: DataFrame, top: int = TOP_KEYWORDS) -> DataFrame:
    """The ``top`` keywords of every page: ``page_id, lemma, score, rank``."""
    ranked = rank_keywords(score_terms(term_statistics(lemmatised)))
    return ranked.where(F.col("rank") <= top).select("page_id", "lemma", "score", "rank")


def shown_keywords(keywords: DataFrame, shown: int = SHOWN_KEYWORDS) -> DataFrame:
    """``page_id, top_keywords``: the first lemmas of every page in rank order."""
    first = keywords.where(F.col("rank") <= shown).groupBy("page_id")
    pairs = F.array_sort(F.collect_list(F.struct("rank", "lemma")))
    return first.agg(F.transform(pairs, lambda pair: pair["lemma"]).alias("top_keywords"))


def theme_explain(keywords: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Every keyword match with site weight, dictionary weight and their product.

    The dictionary may hold repeats; see ``load_theme_dictionary``.
    """
    themes = load_theme_dictionary(dictionary).withColumnRenamed("keyword", "lemma")
    matched = lookup_join(keywords, themes, ["lemma"], "inner", F.col("page_id"))
    return matched.select(
        "page_id",
        "industry",
        "subindustry",
        "lemma",
        "rank",
        F.col("score").alias("site_weight"),
        F.col("weight").alias("theme_weight"),
        (F.col("score") * F.col("weight")).alias("match_weight"),
    )


def _keyword_lists(keywords: DataFrame) -> DataFrame:
    """``page_id, keywords``: the ranked keywords of every page, as many as were kept."""
    ranked = F.array_sort(F.collect_list(F.struct("rank", "lemma", "score")))
    return keywords.groupBy("page_id").agg(ranked.alias("keywords"))


def _bit(rank: Column) -> tuple[Column, Column]:
    """Word and bit of a rank; 63 ranks to a word keep it positive."""
    place = rank - 1
    return F.floor(place / 63).cast("int"), F.pmod(place, F.lit(63)).cast("int")


def _subtheme_scores(
    pages: DataFrame, dictionary: DataFrame, top: int, facts: tuple[str, ...] = ()
) -> DataFrame:
    """Scores per page and subtheme, and one row per page that carries ``keywords`` and facts.

    Which keywords matched is kept as bits by rank, so that all aggregates have a fixed
    width and the many matches of common words go through a plain hash aggregation; ``top``
    bounds the ranks, a higher one is an error. Repeats of the dictionary are folded. The
    page row has a NULL industry; its facts are NULL on the other rows and can be grouping
    columns.
    """
    no_keyword = F.lit(None).cast("struct<rank:int,lemma:string,score:int>")
    listed = pages.withColumn("_k", F.explode(F.concat(F.array(no_keyword), F.col("keywords"))))
    carried = ("keywords", *facts)
    is_page = F.col("_k").isNull()
    beyond = F.raise_error(F.concat(F.lit(f"a keyword ranks above top={top}: "), F.col("_k.rank"))).cast("int")
    rank = F.when(F.col("_k.rank") > top, beyond).otherwise(F.col("_k.rank"))
    word, bit = _bit(rank)
    rows = listed.select(
        "page_id",
        *[F.when(is_page, F.col(name)).alias(name) for name in carried],
        F.col("_k.score").alias("score"),
        word.alias("_word"),
        bit.alias("_bit"),
        # page rows have no keyword: each its own key, or all would meet in one partition
        F.coalesce("_k.lemma", _own_key()).alias("_key"),
    )
    themes = load_theme_dictionary(dictionary).withColumnRenamed("keyword", "_key")
    if joins.is_small(themes):
        matched = lookup_join(rows, themes, ["_key"], "left", F.col("page_id"))
        theme, names = ["industry", "subindustry"], None
    else:
        matched, names = _packed_matches(rows, themes, held_bytes(pages))
        theme = ["_theme"]
    matched = matched.where(F.col(theme[0]).isNotNull() | F.col("keywords").isNotNull())
    one = F.lit(1).cast("bigint")
    bits = [
        F.bit_or(F.when(F.col("_word") == w, F.call_function("shiftleft", one, F.col("_bit"))).otherwise(F.lit(0).cast("bigint")))
        for w in range((top + 62) // 63)
    ]
    scores = matched.groupBy("page_id", *theme, *carried).agg(
        F.sum(F.col("score") * F.col("weight")).alias("weighted_score"),
        F.count(theme[0]).alias("match_count"),
        F.count(F.when(F.col("weight") >= STRONG_WEIGHT, True)).alias("strong_keywords"),
        *[column.alias(f"_bits_{w}") for w, column in enumerate(bits)],
    ).withColumn("matched_bits", F.array(*[f"_bits_{w}" for w in range(len(bits))])).drop(
        *[f"_bits_{w}" for w in range(len(bits))]
    )
    if names is None:
        return scores
    return lookup_join(scores, names, ["_theme"], "left", F.col("page_id")).drop("_theme")


def _packed_matches(rows: DataFrame, themes: DataFrame, held: int) -> tuple[DataFrame, DataFrame]:
    """Rows with ``_theme`` and ``weight`` of every match, laid out by page, and the themes' names.

    For a dictionary too large for a broadcast. A match is a number and a weight, and those of a
    keyword travel as two arrays: the names of a theme are not shuffled once for each match, and
    the matches unfold where their page is, so that they are folded without another shuffle.
    """
    themes = themes.where("industry is not null and _key is not null")
    pairs = themes.select("industry", "subindustry").distinct()
    # stored, so that a number stays the same in every branch and after a lost task
    names = stage(pairs.withColumn("_theme", F.monotonically_increasing_id()), "themes")
    numbers = names.withColumnRenamed("industry", "_industry").withColumnRenamed("subindustry", "_subindustry")
    same = (F.col("industry") == F.col("_industry")) & F.col("subindustry").eqNullSafe(F.col("_subindustry"))
    if joins.is_small(numbers):
        numbers = F.broadcast(numbers)
    listed = themes.join(numbers, same).groupBy("_key").agg(
        F.collect_list(F.struct("_theme", "weight")).alias("_listed")
    )
    packed = listed.select(
        "_key", F.col("_listed._theme").alias("_themes"), F.col("_listed.weight").alias("_weights")
    )
    met = by_page(lookup_join(rows, packed, ["_key"], "left", F.col("page_id"), limit=0).drop("_key"), held)
    kept = [name for name in met.columns if name not in ("_themes", "_weights")]
    unfolded = met.select(*kept, F.explode_outer(F.arrays_zip("_themes", "_weights")).alias("_match"))
    return unfolded.select(*kept, F.col("_match._themes").alias("_theme"), F.col("_match._weights").alias("weight")), names


def _own_key() -> Column:
    return F.concat(F.lit("\u0000"), F.col("page_id").cast("string"))


def _matched_lemmas(keywords: Column, bits: Column) -> Column:
    def hit(keyword: Column) -> Column:
        word, bit = _bit(keyword["rank"])
        return F.getbit(F.get(bits, word), bit) == 1

    return F.transform(F.filter(keywords, hit), lambda keyword: keyword["lemma"])


def match_themes(
    keywords: DataFrame, dictionary: DataFrame, top: int = TOP_KEYWORDS
) -> DataFrame:
    """Score, counts, share of the page's total and matched lemmas per page and subtheme.

    ``top`` is the number of keywords ``score_keywords`` kept per page; a keyword of a higher
    rank is an error, as it could not be listed. The dictionary may hold repeats.
    """
    scores = _subtheme_scores(_keyword_lists(keywords), dictionary, top)
    page = Window.partitionBy("page_id")
    spread = scores.withColumns(
        {"_total": F.sum("weighted_score").over(page), "_keywords": F.max("keywords").over(page)}
    ).where("industry is not null")
    return spread.select(
        "page_id", "industry", "subindustry", "weighted_score", "match_count", "strong_keywords",
        _matched_lemmas(F.col("_keywords"), F.col("matched_bits")).alias("matched"),
        F.try_divide("weighted_score", "_total").alias("weighted_score_percent"),
    )


def _best(matched: str) -> Column:
    """Smallest struct of a page = highest score, then first industry and subindustry."""
    candidate = F.struct(
        (-F.col("weighted_score")).alias("minus_score"), "industry", "subindustry", matched
    )
    return F.min(F.when(F.col("weighted_score") > 0, candidate))


def best_theme(matches: DataFrame) -> DataFrame:
    """Theme, subtheme and matched keywords of the highest positive score of every page."""
    best = matches.groupBy("page_id").agg(_best("matched").alias("best")).where("best is not null")
    return best.select(
        "page_id",
        F.col("best.industry").alias("theme"),
        F.col("best.subindustry").alias("subtheme"),
        (-F.col("best.minus_score")).alias("weighted_score"),
        F.col("best.matched").alias("matched_keywords"),
    )


def count_factor(matches: Column) -> Column:
    """Step function of the number of matched keywords."""
    return F.when(matches < 3, 0.1).when(matches == 3, 0.5).when(matches <= 5, 0.8).otherwise(1.0)


def _ranked_matches(matches: DataFrame) -> DataFrame:
    order = Window.partitionBy("page_id").orderBy(
        F.col("weighted_score").desc_nulls_last(),
        F.col("match_count").desc(),
        F.col("strong_keywords").desc(),
        F.col("industry"),
        F.col("subindustry"),
    )
    return matches.withColumn("place", F.row_number().over(order))


def _at_place(name: str, place: int) -> Column:
    return F.max(F.when(F.col("place") == place, F.col(name)))


def _confidence_aggregates() -> list[Column]:
    return [
        F.count("industry").alias("themes"),
        F.sum("weighted_score").alias("total"),
        _at_place("weighted_score", 1).alias("score_1"),
        _at_place("weighted_score", 2).alias("score_2"),
        _at_place("match_count", 1).alias("count_1"),
        _at_place("strong_keywords", 1).alias("strong_1"),
        F.max("strong_keywords").alias("strong_max"),
    ]


def _confidence_columns(pages: DataFrame) -> DataFrame:
    no_strong = F.col("strong_max") == 0
    kw = F.when(no_strong, F.lit(float("nan"))).otherwise(
        F.try_divide(F.col("strong_1"), F.col("strong_max"))
    )
    c_count, c_strong, c_share, c_lead = CONFIDENCE_WEIGHTS
    raw = (
        F.col("k") * c_count + F.col("kw") * c_strong + F.col("share") * c_share + F.col("lead") * c_lead
    )
    return (
        pages.withColumn("k", count_factor(F.col("count_1")))
        .withColumn("kw", kw)
        .withColumn("share", F.try_divide(F.col("score_1"), F.col("total")))
        .withColumn("lead", F.col("share") - F.try_divide(F.col("score_2"), F.col("total")))
        # NaN compares above every number here, so it is kept before the cap is applied
        .withColumn("confidence", F.when(F.isnan(raw), raw).when(raw > 1, 1.0).otherwise(raw))
    )


def theme_confidence(matches: DataFrame) -> DataFrame:
    """``themes, k, kw, share, lead, confidence`` of every page.

    The first row by score, match count and strong count gives the factors; ``lead`` and
    ``confidence`` are NULL for a page with one subtheme or a zero total, NaN where no
    matched word is strong.
    """
    pages = _ranked_matches(matches).groupBy("page_id").agg(*_confidence_aggregates())
    return _confidence_columns(pages).select(
        "page_id", "themes", "k", "kw", "share", "lead", "confidence"
    )


def classify_pages(
    pages: DataFrame,
    dictionary: DataFrame,
    lemmas: DataFrame | None = None,
    script: str = T.CYRILLIC,
    top: int = TOP_KEYWORDS,
    shown: int = SHOWN_KEYWORDS,
) -> DataFrame:
    """One row per page: domain, theme, subtheme, confidence, keywords and ``status``.

    The page text is read once and its segments are shuffled once, by page. If the
    dictionary is small enough to broadcast nothing else is shuffled: counting, ranking,
    matching and confidence all work within the page. Statuses: ``ok`` (confidence may be
    NaN), ``no_content``, ``wrong_script``, ``no_keywords`` and the three outcomes that
    give up with the raw URL as domain: ``no_match``, ``single_match``, ``zero_total``.
    """
    segments = page_segments(pages, by_page=True)
    terms = _page_terms(page_token_stats(segments, script), lemmas)
    scores = _subtheme_scores(_page_keywords(terms, top), dictionary, top, ("url", "gate"))
    return _decide(scores, shown)


def _page_terms(statistics: DataFrame, lemmas: DataFrame | None) -> DataFrame:
    if lemmas is None:
        return statistics.withColumnRenamed("token", "lemma")
    # page rows have no token: give each its own key, or all would meet in one partition
    keyed = statistics.withColumn("_key", F.coalesce("token", _own_key()))
    lookup = lemma_lookup(lemmas).withColumnRenamed("token", "_key")
    known = lookup_join(keyed, lookup, ["_key"], "left", F.col("page_id")).where(
        "lemma is not null or token is null"
    )
    return known.groupBy("page_id", "lemma", "url", "gate").agg(
        F.sum("n").alias("n"),
        F.sum("priority_sum").alias("priority_sum"),
        F.min("first_seen").alias("first_seen"),
    )


def _page_keywords(terms: DataFrame, top: int) -> DataFrame:
    """One row per page with its URL, gate and ranked keywords (at most ``top``)."""
    ranked = rank_keywords(score_terms(terms)).where(
        (F.col("rank") <= top) | F.col("lemma").isNull()
    )
    keyword = F.when(F.col("lemma").isNotNull(), F.struct("rank", "lemma", "score"))
    return ranked.groupBy("page_id").agg(
        F.max("url").alias("url"),
        F.max("gate").alias("gate"),
        F.array_sort(F.collect_list(keyword)).alias("keywords"),
    )


def _decide(scores: DataFrame, shown: int) -> DataFrame:
    facts = [F.max(name).alias(name) for name in ("url", "gate", "keywords")]
    pages = _ranked_matches(scores).groupBy("page_id").agg(
        *_confidence_aggregates(), _best("matched_bits").alias("best"), *facts
    )
    status = (
        F.when(F.col("gate") != "ok", F.col("gate"))
        .when(F.size("keywords") == 0, "no_keywords")
        .when(F.col("themes") == 0, "no_match")
        .when(F.col("total") == 0, "zero_total")
        .when(F.col("themes") == 1, "single_match")
        .otherwise("ok")
    )
    decided = _confidence_columns(pages).withColumn("status", status)
    ok = F.col("status") == "ok"
    raw_url = F.col("status").isin("no_match", "zero_total", "single_match")
    stopped = F.col("status").isin("no_content", "wrong_script")
    none = F.array().cast("array<string>")
    matched = _matched_lemmas(F.col("keywords"), F.col("best.matched_bits"))
    top_keywords = F.transform(F.slice("keywords", 1, shown), lambda keyword: keyword["lemma"])
    return decided.select(
        "page_id",
        "url",
        F.when(raw_url, F.col("url")).otherwise(T.url_domain(F.col("url"))).alias("domain"),
        F.when(ok, F.col("best.industry")).alias("theme"),
        F.when(ok, F.col("best.subindustry")).alias("subtheme"),
        F.when(ok, F.col("confidence")).otherwise(F.lit(0.0)).alias("confidence"),
        F.when(ok, F.coalesce(matched, none)).when(stopped, none).alias("matched_keywords"),
        F.when(~stopped & ~raw_url, top_keywords).alias("top_keywords"),
        "status",
    )
