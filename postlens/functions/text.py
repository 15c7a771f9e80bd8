"""Scalar cleaning functions; built-in expressions, but for exact HTML parsing."""

from __future__ import annotations

import html
import json
import re
from html.entities import html5
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from postlens.functions.rules import CITY_COUNTRY, NO_PLACE_TEXT, PLACE_ALIASES, lookup, matches

def _reference(codes: Column) -> Column:
    """Characters of numeric references: code points, those of the C1 range as in windows-1252, U+FFFD for impossible ones."""
    c1 = [bytes([b]).decode("cp1252", "replace") if b not in (0x81, 0x8D, 0x8F, 0x90, 0x9D) else chr(b) for b in range(0x80, 0xA0)]
    char = F.decode(F.unhex(F.lpad(F.hex(codes), 8, "0")), "UTF-32")
    # control characters and code points without a character vanish
    nothing = codes.between(1, 8) | (codes == 11) | codes.between(14, 31) | (codes == 127) | codes.between(0xFDD0, 0xFDEF) | (codes.bitwiseAND(F.lit(0xFFFE)) == 0xFFFE)
    lost = (codes == 0) | codes.between(0xD800, 0xDFFF) | (codes > 0x10FFFF)
    return F.when(lost, F.lit("\ufffd")).when(codes.between(0x80, 0x9F), F.get(F.lit(c1), (codes - 0x80).cast("int"))).when(nothing, F.lit("")).otherwise(char)


def unescape(c: Column) -> Column:
    """Character references of HTML decoded, all named and numeric ones, once; the rules are those of html.unescape.

    Texts without an ampersand pass at once.  A reference of over 15 digits is left as it is.
    """
    names = F.from_json(F.lit(json.dumps({k[:-1]: v for k, v in html5.items() if k.endswith(";")})), "map<string,string>")
    loose = F.from_json(F.lit(json.dumps({k: v for k, v in html5.items() if not k.endswith(";")})), "map<string,string>")
    prefix = "^(" + "|".join(sorted((k for k in html5 if not k.endswith(";")), key=lambda k: (-len(k), k))) + ")"

    def decoded(piece: Column) -> Column:
        tenth, hexed = F.regexp_extract(piece, r"^#([0-9]{1,15})(?![0-9])", 1), F.regexp_extract(piece, r"^#[xX]([0-9a-fA-F]{1,12})(?![0-9a-fA-F])", 1)
        code = F.when(tenth != "", tenth.try_cast("bigint")).when(hexed != "", F.conv(hexed, 16, 10).try_cast("bigint"))
        named = F.try_element_at(names, F.regexp_extract(piece, r"^([A-Za-z][A-Za-z0-9]{1,40});", 1))
        begun = F.regexp_extract(piece, prefix, 1)
        return (
            F.when(code.isNotNull(), F.concat(_reference(code), F.regexp_replace(piece, r"^#(?:[xX][0-9a-fA-F]+|[0-9]+);?", "")))
            .when(named.isNotNull(), F.concat(named, F.regexp_replace(piece, r"^[A-Za-z0-9]+;", "")))
            .when(begun != "", F.concat(F.try_element_at(loose, begun), F.substr(piece, F.length(begun) + 1)))
            .otherwise(F.concat(F.lit("&"), piece))
        )

    pieces = F.transform(F.split(c, "&"), lambda p, i: F.when(i == 0, p).otherwise(decoded(p)))
    return F.when(c.contains("&"), F.array_join(pieces, "")).otherwise(c)


def normalize_space(c: Column) -> Column:
    """Entities decoded, white space of all kinds as single blanks, trimmed; null gives ``""``."""
    return F.trim(F.regexp_replace(unescape(F.coalesce(c.cast("string"), F.lit(""))), r"(?U)\s+", " "))


def html_text(c: Column) -> Column:
    """Text of an HTML string: comments and tags become blanks (built-in variant)."""
    return normalize_space(F.regexp_replace(F.coalesce(c, F.lit("")), r"(?s)<!--.*?-->|<[^>]*>", " "))


class _Chunks(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.chunks: list[str] = []

    def handle_data(self, data: str) -> None:
        self.chunks.append(data)


def parsed_text(value: str | None) -> str:
    """Every data chunk of an HTML string joined by blanks; the string itself if it has none.

    The parser is not closed: what follows an unfinished reference at the end stays out, as in the
    pipeline whose results these are.
    """
    if value is None:
        return ""
    parser = _Chunks()
    parser.feed(value)
    text = html.unescape(html.unescape(" ".join(parser.chunks) or value))
    return re.sub(r"\s+", " ", text).strip()


def html_text_exact(c: Column) -> Column:
    """``parsed_text`` as an Arrow-batched function."""
    return F.pandas_udf(_parse_series, "string")(c)


def _parse_series(s: pd.Series) -> pd.Series:
    return s.map(lambda v: parsed_text(v if isinstance(v, str) else None))


def flat_text(value: object) -> str:
    """All texts of a JSON value, nested ones too, as one text; strings are read as HTML."""
    if value is None or value == "":
        return ""
    if isinstance(value, str):
        return parsed_text(value)
    parts = value.values() if isinstance(value, dict) else value if isinstance(value, list) else None
    joined = str(value or "") if parts is None else " ".join(map(flat_text, parts))
    return re.sub(r"\s+", " ", html.unescape(joined)).strip()


def _flatten_series(s: pd.Series) -> pd.Series:
    return s.map(lambda v: flat_text(json.loads(v)) if isinstance(v, str) and v else "")


def flatten_text(c: Column) -> Column:
    """``flat_text`` of JSON texts, as an Arrow-batched function; null gives an empty text."""
    return F.pandas_udf(_flatten_series, "string")(c)


def stable_id(*parts: Column) -> Column:
    """First 16 hex digits of the SHA-1 of the normalised, lowered parts; null parts are left out."""
    return F.substring(F.sha1(F.concat_ws("|", *[F.when(p.isNotNull(), F.lower(normalize_space(p))) for p in parts])), 1, 16)


def first_present(*values: Column) -> Column:
    """The first value that is neither null nor empty (strings) nor zero (numbers given as text ``0``)."""
    return F.coalesce(*[F.nullif(v.cast("string"), F.lit("")) for v in values])


def split_places(c: Column) -> Column:
    """Places named in a string: split at commas, slashes, semicolons and the words or/and, then cleaned."""
    return clean_places(F.split(F.coalesce(c, F.lit("")), r",|/|;|\bor\b|\band\b"))


def clean_places(places: Column) -> Column:
    """Normalised, non-empty, mapped through the city and alias tables, distinct in order of first occurrence."""
    tidy = F.filter(F.transform(places, normalize_space), lambda x: x != "")
    return F.array_distinct(F.transform(tidy, lambda x: lookup(lookup(x, CITY_COUNTRY), PLACE_ALIASES)))


def clean_place(c: Column) -> Column:
    """A scalar location, emptied where it holds a page label instead of a place."""
    tidy = normalize_space(c)
    return F.when(matches(tidy, NO_PLACE_TEXT), F.lit("")).otherwise(tidy)


def primary_place(places: Column, default: Column) -> Column:
    return F.coalesce(F.get(places, F.lit(0)), default)


def excerpt(c: Column, length: int = 420) -> Column:
    return F.substring(c, 1, length)


def present(c: Column, kind: str = "string") -> Column:
    """Whether a value is there: not null, no blank string, no empty array; 0 and false are there."""
    if kind.startswith("array"):
        return F.coalesce(F.size(c) > 0, F.lit(False))
    if kind == "string":
        return F.coalesce(F.trim(c) != "", F.lit(False))
    return c.isNotNull()


def epoch_iso(c: Column) -> Column:
    """Whole seconds since 1970 as ISO text in UTC; any other text passes through, also counts beyond the years 1 to 9999."""
    count = F.when(c.rlike(r"^-?\d+$"), c.try_cast("bigint"))
    seconds = F.when(count.between(-62135596800, 253402300799), count)
    iso = F.concat(F.date_format(F.date_add(F.lit("1970-01-01").cast("date"), F.floor(seconds / 86400).cast("int")), "yyyy-MM-dd"), F.lit("T"), *_clock(F.pmod(seconds, F.lit(86400))))
    return F.when(seconds.isNotNull(), iso).otherwise(c)


def _clock(s: Column) -> list[Column]:
    two = lambda x: F.lpad(x.cast("int").cast("string"), 2, "0")
    return [two(F.floor(s / 3600)), F.lit(":"), two(F.floor(s / 60) % 60), F.lit(":"), two(s % 60)]


def doc_terms(text: Column, stop_words: list[str], stop_tokens: tuple[str, ...] = (), least: int = 4) -> Column:
    """Distinct terms of a text: tokens that begin with a letter, stripped of ``.-/``, long enough, no stop word."""
    raw = F.regexp_extract_all(F.lower(text), F.lit(r"[a-zA-Z][a-zA-Z0-9+/#.-]{2,}"), F.lit(0))
    tokens = F.transform(raw, lambda t: F.regexp_replace(t, r"^[./-]+|[./-]+$", ""))
    return F.array_distinct(F.filter(tokens, lambda t: (F.length(t) >= least) & ~t.isin(*stop_words, *stop_tokens)))


def chips(values: Column, k: int) -> Column:
    """First k values; one more, ``+N``, stands for the rest."""
    rest = F.size(values) - k
    return F.when(rest > 0, F.concat(F.slice(values, 1, k), F.array(F.concat(F.lit("+"), rest.cast("string"))))).otherwise(values)


def share(part: Column, total: Column, digits: int = 4) -> Column:
    """Rounded quotient; 0 where there is nothing to divide by."""
    return F.coalesce(F.round(F.try_divide(part, total), digits), F.lit(0.0))


def url_query(pairs: dict[str, Column]) -> Column:
    """``name=value`` pairs of a url, encoded, in the given order."""
    return F.concat_ws("&", *[F.concat(F.lit(f"{name}="), F.url_encode(value)) for name, value in pairs.items()])
