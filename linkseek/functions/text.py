"""Text expressions: titles, links, bodies, words, entities and masks."""

from __future__ import annotations

import string

from pyspark.sql import Column
from pyspark.sql import functions as F

# The patterns that define extraction.
TITLE = r"<title>(.+?)</title>"
LINK = r"\[\[(.+?)([\|#]|\]\])"
BODY = r"<text.*?>([\S\s]+?)</text>"
EMPTY_BODY = r"<text.*?/>"
WORD = r"[a-zA-Z]+"
NON_LETTER = r"[^A-Za-z]"

# The entities, in decoding order.
ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&"), ("&quot;", '"'), ("&apos;", "'"))


def decode_entities(text: Column) -> Column:
    """Replace the five entities one after the other, so `&amp;quot;` decodes twice."""
    for entity, char in ENTITIES:
        text = F.replace(text, F.lit(entity), F.lit(char))
    return text


def encode_entities(text: Column) -> Column:
    """Inverse of `decode_entities` for markup-free text: ampersands first."""
    for entity, char in sorted(ENTITIES, key=lambda pair: pair[1] != "&"):
        text = F.replace(text, F.lit(char), F.lit(entity))
    return text


def capitalize_ascii(text: Column) -> Column:
    """Upper-case the first character if it is an ASCII letter; leave the rest alone."""
    first = F.translate(F.substring(text, 1, 1), string.ascii_lowercase, string.ascii_uppercase)
    return F.concat(first, F.substr(text, F.lit(2)))


def normalize_name(text: Column) -> Column:
    return capitalize_ascii(decode_entities(text))


def required(text: Column, message: str) -> Column:
    """`text`, or an error if it is empty. Never null, so joins add no null filter that would
    be evaluated below the extraction and repeat it."""
    missing = F.raise_error(F.lit(message)).cast("string")
    return F.coalesce(F.when(text != "", text), missing, F.lit(""))


def raw_title(line: Column) -> Column:
    """Title as written; empty when the line has none (a match is never empty)."""
    return F.coalesce(F.regexp_extract(line, TITLE, 1), F.lit(""))


def raw_links(line: Column) -> Column:
    """Link targets as written, in order, repeats kept."""
    return F.regexp_extract_all(line, F.lit(LINK), F.lit(1))


def raw_body(line: Column) -> Column:
    """Body as written; empty when the line has none (a match is never empty)."""
    return F.coalesce(F.regexp_extract(line, BODY, 1), F.lit(""))


def has_empty_body(line: Column) -> Column:
    """Whether the line has the tag of an empty text; looked at only without a body."""
    return F.coalesce(F.rlike(line, F.lit(EMPTY_BODY)), F.lit(False))


def words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def pad(text: Column) -> Column:
    return F.concat(F.lit(" "), text, F.lit(" "))


def mask_non_letters(text: Column) -> Column:
    """Same length as the input, with a space for everything but ASCII letters."""
    return F.regexp_replace(text, NON_LETTER, " ")
