"""Web pages to weighted text segments and tokens."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.functions import text as T
from martloom.operators.joins import by_page as _by_page
from martloom.operators.joins import held_bytes, is_small

# Segments of a page from the most to the least telling, with priorities.
SEGMENTS = (
    ("meta_keywords", 10),
    ("meta_description", 9),
    ("title", 9),
    ("h1", 8),
    ("h2_h3", 7),
    ("first_paragraphs", 6),
    ("main_content", 5),
)


def page_segments(pages: DataFrame, by_page: bool = False) -> DataFrame:
    """``page_id, url, fetched``, the seven segments and ``content`` of every page.

    Title and headings are read before header and footer blocks are cut, paragraphs and
    main content after. The main content holds each text of the page body once: nested
    elements do not repeat their text, so body words count less than where they do. A
    missing ``html`` (a failed fetch) leaves every segment empty.

    ``by_page`` lays the result out by ``page_id``. Everything up to the classification
    groups within the page, so this is the one shuffle of text it needs, and it moves the
    extracted segments instead of the HTML. Input too small to fill the cores is spread by
    ``page_id`` before the extraction instead.
    """
    small = is_small(pages)
    if small:
        cores = pages.sparkSession.sparkContext.defaultParallelism
        pages = pages.repartition(cores, "page_id")
    seen = pages.select(
        "page_id",
        "url",
        F.col("html").isNotNull().alias("fetched"),
        F.regexp_replace(F.coalesce("html", F.lit("")), T.HIDDEN, " ").alias("_seen"),
    )
    cut = seen.withColumn(
        "_body", F.regexp_replace(F.regexp_replace("_seen", T.FOOTER, " "), T.HEADER, " ")
    )
    raw = {
        "meta_keywords": T.meta_content(F.col("_seen"), "keywords"),
        "meta_description": T.meta_content(F.col("_seen"), "description"),
        "title": T.visible(F.regexp_extract("_seen", T.TITLE, 1)),
        "h1": T.element_texts(F.col("_seen"), T.H1),
        "h2_h3": T.element_texts(F.col("_seen"), T.H2_H3),
        "first_paragraphs": T.first_paragraphs(F.col("_body")),
        "main_content": T.block_text(F.regexp_replace("_body", T.TITLE, " ")),
    }
    clean = cut.select(
        "page_id", "url", "fetched", *[T.squeeze(raw[name]).alias(name) for name, _ in SEGMENTS]
    )
    filled = [F.nullif(F.col(name), F.lit("")) for name, _ in SEGMENTS]
    segments = clean.withColumn("content", F.concat_ws(" ", *filled))
    if not by_page or small:
        return segments
    held = held_bytes(pages)
    return _by_page(segments, held) if held else segments.repartition("page_id")


def page_gate(script: str) -> Column:
    """``ok``, or why a page of ``page_segments`` gives no tokens."""
    return (
        F.when(~F.col("fetched"), "no_content")
        .when(~T.has_script(F.col("content"), script), "wrong_script")
        .otherwise("ok")
    )


def page_tokens(segments: DataFrame, script: str = T.CYRILLIC) -> DataFrame:
    """``page_id, segment, segment_ord, priority, pos, token`` of the pages in the script.

    Tokens are lower-case words; ``pos`` is the place among all pieces of the segment.
    """
    pieces = _pieces(segments, script, keep_pages=False)
    return pieces.where(T.is_word(F.col("piece"))).select(
        "page_id", "segment", "segment_ord", "priority", "pos", F.lower("piece").alias("token")
    )


def page_token_stats(segments: DataFrame, script: str = T.CYRILLIC) -> DataFrame:
    """Occurrences per page and token, and one row per page with a NULL token.

    That row carries ``url`` and ``gate``, so pages without tokens stay in the stream and
    the page text need not be read a second time to bring them back. Both are NULL on all
    other rows and can be grouping columns, which keeps the aggregation a hash aggregation.
    """
    pieces = _pieces(segments, script, keep_pages=True)
    kept = pieces.where(T.is_word(F.col("piece")) | F.col("gate").isNotNull())
    tokens = kept.withColumn("token", F.lower("piece"))
    return tokens.groupBy("page_id", "token", "url", "gate").agg(*occurrence_aggregates())


def _pieces(segments: DataFrame, script: str, keep_pages: bool) -> DataFrame:
    """Pieces of all segments; with ``keep_pages`` also a row per page without a piece.

    Pages outside the gate get NULL texts instead of being filtered: a filter would be
    pushed below the extraction and run it twice.
    """
    gated = segments.withColumn("gate", page_gate(script))
    inside = F.col("gate") == "ok"
    nothing = F.lit(None).cast("string")
    rows = [
        _segment_row(name, order, priority, F.when(inside & (F.col(name) != ""), F.col(name)), nothing, nothing)
        for order, (name, priority) in enumerate(SEGMENTS)
    ]
    if keep_pages:
        rows.append(_segment_row("page", len(SEGMENTS), 0, nothing, F.col("url"), F.col("gate")))
    texts = gated.select("page_id", F.inline(F.array(*rows)))
    texts = texts.where("text is not null or gate is not null")
    return texts.select(
        "page_id", "segment", "segment_ord", "priority", "url", "gate",
        F.posexplode_outer(T.words(F.col("text"))).alias("pos", "piece"),
    )


def _segment_row(
    name: str, order: int, priority: int, text: Column, url: Column, gate: Column
) -> Column:
    return F.struct(
        F.lit(name).alias("segment"),
        F.lit(order).alias("segment_ord"),
        F.lit(priority).alias("priority"),
        text.alias("text"),
        url.alias("url"),
        gate.alias("gate"),
    )


def occurrence_aggregates() -> list[Column]:
    """Count, priority sum and first place (segment in the high, position in the low bits)."""
    place = F.shiftleft(F.col("segment_ord").cast("bigint"), 32) + F.col("pos")
    return [
        F.count(F.lit(1)).alias("n"),
        F.sum("priority").alias("priority_sum"),
        F.min(place).alias("first_seen"),
    ]
