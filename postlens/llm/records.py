"""Duplicates hidden by formatting differences: collapse and count (problem 2).

Each row becomes a set of (field name, value) pairs.  Values are stripped of everything in
which copies may differ: character encoding (entities, percent signs, Unicode forms), letter
case, white and invisible space, punctuation.  Fields whose order carries nothing share a field
name: title and company form one pair of values, the parts of the location another bag, the
parameters of the url a third.  Every pair is hashed, and the hashes are *added*: the sum is a
multiset hash, the same for any order, so nothing is sorted.  Two independent 64-bit sums make
the fingerprint.  Rows meet by fingerprint, the first row of each fingerprint is found by a
map-side combined minimum of numbers, and each row's pairs are compared with the first row's pairs as
multisets before it counts as a copy; rows that fail (two records with one fingerprint) are
grouped by their pairs themselves.
"""

from __future__ import annotations

import html
import re
import unicodedata
from urllib.parse import unquote

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlens.session import written

_JUNK = re.compile(r"[^\w]|_")
_PARTS = re.compile(r"[,;/|•·\n]+")
#: What stands for a null; no normalised value holds this character.
NULL = "\u0000"


def plain(value: str | None) -> str:
    """Letters, digits and symbols that distinguish values; NULL for a null."""
    if value is None:
        return NULL
    text = value if value.isascii() and "&" not in value else unicodedata.normalize("NFKC", html.unescape(html.unescape(value)))
    text = text.casefold()
    if not text.isascii():
        text = unicodedata.normalize("NFC", text)
    return _JUNK.sub("", text)


def location_parts(value: str | None) -> list[str]:
    if value is None:
        return [NULL]
    return [p for p in map(plain, _PARTS.split(html.unescape(value))) if p]


def url_parts(value: str | None) -> list[str]:
    """Address first, then the parameters and the fragment; empty ones are none."""
    if value is None:
        return [NULL]
    text = unquote(html.unescape(value))
    head, _, fragment = text.partition("#")
    address, _, query = head.partition("?")
    pairs = []
    for item in re.split("[&;]", query):
        name, eq, val = item.partition("=")
        if key := plain(name) + ("=" + plain(val) if eq else ""):
            pairs.append(key)
    return ["@" + plain(address), *pairs, *(["#" + plain(fragment)] if plain(fragment) else [])]


def _bags(title: pd.Series, company: pd.Series, location: pd.Series, url: pd.Series) -> pd.DataFrame:
    none = lambda s: [v if isinstance(v, str) else None for v in s]
    who = [[plain(a), plain(b)] for a, b in zip(none(title), none(company), strict=True)]
    return pd.DataFrame({"who": who, "place": [location_parts(v) for v in none(location)], "link": [url_parts(v) for v in none(url)]})


def _multiset_hash(bags: dict[str, Column], seed: int) -> Column:
    """Sum of the pairs' hashes per field name, whatever their order, folded into 64 bits.

    The halves of each hash are summed apart, so that nothing overflows.
    """
    zero = F.lit(0).cast("bigint")
    total = zero
    for name, bag in bags.items():
        hashes = F.transform(bag, _pair_hash(seed, name))
        high = F.aggregate(F.transform(hashes, lambda h: F.shiftrightunsigned(h, 32)), zero, lambda acc, h: acc + h)
        low = F.aggregate(F.transform(hashes, lambda h: h.bitwiseAND(F.lit(0xFFFFFFFF))), zero, lambda acc, h: acc + h)
        total = F.xxhash64(total, high, low)
    return total


def _pair_hash(seed: int, name: str):
    return lambda x: F.xxhash64(F.lit(seed), F.lit(name), x)


def _same_bag(a: Column, b: Column) -> Column:
    """Equality of two small bags without sorting: every value is as frequent in either."""
    often = lambda bag, x: F.size(F.filter(bag, lambda y: y == x))
    return (F.size(a) == F.size(b)) & F.forall(a, lambda x: often(a, x) == often(b, x))


def fingerprints(rows: DataFrame, key: str, title: str, company: str, location: str, url: str) -> DataFrame:
    """``key``, the bags and the two sums of each row."""
    to_bags = F.pandas_udf(_bags, "struct<who:array<string>,place:array<string>,link:array<string>>")
    bags = rows.select(F.col(key), to_bags(title, company, location, url).alias("b")).select(key, "b.who", "b.place", "b.link")
    named = {n: F.col(n) for n in ("who", "place", "link")}
    return bags.withColumns({"f1": _multiset_hash(named, 1), "f2": _multiset_hash(named, 2)})


def copy_groups(rows: DataFrame, key: str = "row_id", title: str = "title", company: str = "company", location: str = "location", url: str = "url") -> DataFrame:
    """``key``, ``first_key``: each row that shares its fingerprint with others, with the smallest key of
    its group (its own for the first).  Rows with a fingerprint of their own are left out.

    Nulls equal only nulls; an empty or all-punctuation value is a value of its own, not a null.
    Repeated keys each stay a row.  The bags are made once and written to the shared folder.  A
    fingerprint that a third of all rows share costs one partial minimum per task; in the join its
    rows are split by the skew-join rule, and its side of first rows has one row.
    """
    prints = written(fingerprints(rows.withColumn("_key", F.col(key)), "_key", title, company, location, url))
    groups = prints.groupBy("f1", "f2").agg(F.count("*").alias("n"), F.min("_key").alias("first_key")).where("n > 1")
    # the bags of each group's first row; hashed joins, so that no record is sorted
    bags = [F.col(c).alias(f"_{c}") for c in ("who", "place", "link")]
    leads = prints.select(F.col("_key").alias("_lead"), F.col("f1").alias("_l1"), F.col("f2").alias("_l2"), *bags)
    first = groups.hint("shuffle_hash").join(leads, (F.col("first_key") == F.col("_lead")) & (F.col("f1") == F.col("_l1")) & (F.col("f2") == F.col("_l2")))
    first = first.select("_l1", "_l2", "first_key", "_who", "_place", "_link").dropDuplicates(["_l1", "_l2"])
    met = prints.join(first.hint("shuffle_hash"), (F.col("f1") == F.col("_l1")) & (F.col("f2") == F.col("_l2")))
    equal = _same_bag(F.col("who"), F.col("_who")) & _same_bag(F.col("place"), F.col("_place")) & _same_bag(F.col("link"), F.col("_link"))
    agreed = met.where(equal).select(F.col("_key").alias(key), "first_key")
    # two different records with one 128-bit fingerprint: hardly ever a row, but it must not be lost
    odd = met.where(~equal).select("_key", F.array_sort("who").alias("who"), F.array_sort("place").alias("place"), F.array_sort("link").alias("link"))
    firsts = odd.groupBy("who", "place", "link").agg(F.min("_key").alias("first_key"))
    return agreed.unionByName(odd.join(firsts, ["who", "place", "link"]).select(F.col("_key").alias(key), "first_key"))


def copy_pairs(rows: DataFrame, **columns: str) -> DataFrame:
    """``first_row_id``, ``copy_row_id``: one row for each copy but the first of its group."""
    key = columns.get("key", "row_id")
    groups = copy_groups(rows, **columns)
    return groups.where(F.col("first_key") != F.col(key)).select(F.col("first_key").alias("first_row_id"), F.col(key).alias("copy_row_id"))


def collapse(rows: DataFrame, **columns: str) -> DataFrame:
    """The first row of each group as it is, with ``n_copies`` (1: it has no copy; a column of that name is replaced)."""
    key = columns.get("key", "row_id")
    groups = copy_groups(rows, **columns).select(F.col(key).alias("_member"), F.col("first_key").alias("_first")).groupBy("_member", "_first").agg(F.count("*").alias("_times"))
    sizes = groups.groupBy("_first").agg(F.sum("_times").alias("_n_copies"))
    kept = [c for c in rows.columns if c != "n_copies"]
    once = rows.dropDuplicates([key])
    known = groups.select("_member", "_first").join(sizes, "_first")
    met = once.join(known, once[key] == known["_member"], "left").where(F.col("_first").isNull() | (F.col("_first") == once[key]))
    return met.select(*[once[c] for c in kept], F.coalesce("_n_copies", F.lit(1)).alias("n_copies"))
