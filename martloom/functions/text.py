"""Text, URL and HTML expressions.

All patterns avoid look-around, back-references and possessive quantifiers, so that
another engine's linear-time matcher reads them the same way.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Whitespace as str.split() of most languages sees it (Unicode included).
SPACE = r"[\t-\r\x1c-\x20\x85\p{Z}]+"
EDGE_SPACE = r"^[\t-\r\x1c-\x20\x85\p{Z}]+|[\t-\r\x1c-\x20\x85\p{Z}]+$"
# Comments and the two raw-text elements, never visible text.
HIDDEN = (
    r"(?is)<!--.*?-->"
    r"|<script(?:[\s/][^>]*)?>.*?(?:</script\s*>|\z)"
    r"|<style(?:[\s/][^>]*)?>.*?(?:</style\s*>|\z)"
)
# A tag's name ends at white space, a slash or the bracket: <header-bar> is no <header>. An
# element without an end tag reaches to the end of the page, which also keeps the match linear.
FOOTER = r"(?is)<footer(?:[\s/][^>]*)?>.*?(?:</footer\s*>|\z)"
HEADER = r"(?is)<header(?:[\s/][^>]*)?>.*?(?:</header\s*>|\z)"
TITLE = r"(?is)<title(?:[\s/][^>]*)?>(.*?)(?:</title\s*>|\z)"
H1 = r"(?is)<h1(?:[\s/][^>]*)?>(.*?)(?:</h1\s*>|\z)"
H2_H3 = r"(?is)<h[23](?:[\s/][^>]*)?>(.*?)(?:</h[23]\s*>|\z)"
PARAGRAPH = r"(?i)<p(?:[\s/][^>]*)?>"
PARAGRAPH_END = r"(?is)</p\s*>.*\z"
# Tags inside a word or sentence; they vanish, all others part words.
INLINE_TAG = r"(?i)</?(?:a|abbr|b|br|code|em|font|i|mark|s|small|strong|sub|sup|u|wbr)(?:[\s/][^>]*)?>"
TAG = r"<[^>]*>"
META = r"""(?is)<meta(?:\s[^>]*)?[\s"'/]name\s*=\s*["']?(?-i:{name})(?:["'\s/][^>]*)?>"""
CONTENT_ATTR = r"""(?is)[\s"'/]content\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
# The character references that are decoded, ampersand last.
ENTITIES = (
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&quot;", '"'),
    ("&#39;", "'"),
    ("&nbsp;", " "),
    ("&amp;", "&"),
)

TOKEN_BREAK = r"[^\p{L}\p{N}_\-]+"
WORD = r"^[а-яёa-z\-]+$"
CYRILLIC = r"[а-яА-Я]"
LATIN = r"[a-zA-Z]"


def squeeze(text: Column) -> Column:
    """Collapse runs of whitespace to one space and trim."""
    return F.trim(F.regexp_replace(text, SPACE, " "))


def decode_entities(text: Column) -> Column:
    for entity, char in ENTITIES:
        text = F.replace(text, F.lit(entity), F.lit(char))
    return text


def visible(fragment: Column) -> Column:
    """Text of an HTML fragment, tags dropped without a gap."""
    return decode_entities(F.regexp_replace(fragment, TAG, ""))


def block_text(fragment: Column) -> Column:
    """Text of an HTML fragment where block tags part words and inline tags do not."""
    without_inline = F.regexp_replace(fragment, INLINE_TAG, "")
    return decode_entities(F.regexp_replace(without_inline, TAG, " "))


def meta_content(html: Column, name: str) -> Column:
    """``content`` of the first meta tag of that name, '' if there is none."""
    tag = F.regexp_extract(html, META.format(name=name), 0)
    return decode_entities(
        F.concat(*[F.regexp_extract(tag, CONTENT_ATTR, group) for group in (1, 2, 3)])
    )


def element_texts(html: Column, pattern: str) -> Column:
    """Texts of all elements the pattern captures, joined by a space."""
    return visible(F.array_join(F.regexp_extract_all(html, F.lit(pattern), F.lit(1)), " "))


def first_paragraphs(html: Column, count: int = 5) -> Column:
    """Text of the first paragraphs; an unclosed one ends where the next begins."""
    pieces = F.slice(F.split(html, PARAGRAPH, -1), 2, count)
    cut = F.transform(pieces, lambda piece: F.regexp_replace(piece, PARAGRAPH_END, ""))
    return visible(F.array_join(cut, " "))


def normalise_url(url: Column) -> Column:
    """Trim and prefix ``https://`` unless a lower-case http(s) scheme is there."""
    trimmed = F.regexp_replace(url, EDGE_SPACE, "")
    return F.when(trimmed.rlike("^https?://"), trimmed).otherwise(F.concat(F.lit("https://"), trimmed))


def url_domain(url: Column) -> Column:
    """Authority of the normalised URL (user info and port kept), or the URL as it is
    where square brackets do not pair up."""
    authority = F.regexp_extract(normalise_url(url), r"^https?://([^/?#]*)", 1)
    paired = authority.contains("[") == authority.contains("]")
    return F.when(paired, authority).otherwise(url)


def words(text: Column) -> Column:
    """Array of the tokens of a text: runs of letters, digits, ``_`` and ``-``."""
    return F.split(text, TOKEN_BREAK, -1)


def is_word(token: Column) -> Column:
    """More than two characters, all Russian or English letters or hyphens."""
    return (F.length(token) > 2) & F.lower(token).rlike(WORD)


def has_script(content: Column, script: str) -> Column:
    """A character of the script within the first 1 000 characters."""
    return F.substring(content, 1, 1000).rlike(script)
