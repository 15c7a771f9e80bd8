"""Facet counts, top-k, shares, term frequencies and summaries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postlens.functions import rules, text
from postlens.functions.text import share


def count_values(rows: DataFrame, column: str, multi: bool = False) -> DataFrame:
    """``label``, ``n``: rows per value, null and empty values left out; most frequent first, then by label.

    ``multi``: the column is an array, and a row counts once for each of its elements.
    """
    values = rows.select(F.explode_outer(column).alias("label") if multi else F.col(column).alias("label"))
    return ranked(values.select(F.col("label").cast("string").alias("label")).where("label IS NOT NULL AND label != ''").groupBy("label").agg(F.count("*").alias("n")))


def ranked(counts: DataFrame) -> DataFrame:
    return counts.orderBy(F.desc("n"), "label")


def facets(rows: DataFrame, single: Sequence[str] = (), multi: Sequence[str] = (), tagged: Mapping[str, tuple[Column, Mapping[str, str]]] | None = None) -> DataFrame:
    """``facet``, ``label``, ``n`` of many facets in one pass: every row becomes its (facet, label)
    pairs, and one shuffle counts them, combined on the map side."""
    pair = lambda f: lambda x: F.struct(F.lit(f).alias("facet"), x.cast("string").alias("label"))
    parts = [F.array(pair(c)(F.col(c))) for c in single]
    parts += [F.transform(F.coalesce(F.col(c), F.array().cast("array<string>")), pair(c)) for c in multi]
    # the word line of each tagged text is worked out once
    bodies: dict[str, str] = {}
    for name, (body, _) in (tagged or {}).items():
        bodies.setdefault(str(body), name)
    lined = rules.with_lines(rows, {f"_line_{name}": body for name, (body, _) in (tagged or {}).items() if name in bodies.values()})
    for name, (body, table) in (tagged or {}).items():
        first = bodies[str(body)]
        parts.append(F.transform(rules.tags(body, table, line=F.col(f"_line_{first}")), pair(name)))
    pairs = lined.select(F.explode_outer(F.concat(*parts)).alias("p")).select("p.facet", "p.label")
    return pairs.where("label IS NOT NULL AND label != ''").groupBy("facet", "label").agg(F.count("*").alias("n"))


def top_per_facet(counts: DataFrame, k: int) -> DataFrame:
    """The k most frequent labels of each facet with their rank; ties by label."""
    w = Window.partitionBy("facet").orderBy(F.desc("n"), "label")
    return counts.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def top_k(counts: DataFrame, k: int, exclude: Sequence[str] = (), total: int | None = None) -> DataFrame:
    """The k most frequent labels without the excluded ones, with their share of ``total`` (of all labels by default)."""
    sums = counts.agg(F.sum("n").alias("all"))  # one row
    kept = counts.where(~F.col("label").isin(*exclude)) if exclude else counts
    whole = F.lit(total) if total is not None else F.col("all")
    return kept.crossJoin(F.broadcast(sums)).select("label", "n", share(F.col("n"), whole).alias("share")).orderBy(F.desc("n"), "label").limit(k)


def rule_counts(rows: DataFrame, body: Column, table: Mapping[str, str]) -> DataFrame:
    """``label``, ``n``: rows in which each rule matches, worked out while scanning."""
    lined = rules.with_lines(rows.select(body.alias("_body")), {"_line": F.col("_body")})
    labels = lined.select(F.explode_outer(rules.tags(F.col("_body"), table, line=F.col("_line"))).alias("label")).where("label IS NOT NULL")
    return ranked(labels.groupBy("label").agg(F.count("*").alias("n")))


def term_frequencies(rows: DataFrame, body: Column, k: int = 30, stop_words: Sequence[str] = tuple(rules.STOP_WORDS), stop_tokens: Sequence[str] = rules.STOP_TOKENS) -> DataFrame:
    """``label``, ``n``: in how many rows each term occurs, the k most frequent; ties by term."""
    terms = text.doc_terms(body, list(stop_words), tuple(stop_tokens))
    return ranked(rows.select(F.explode_outer(terms).alias("label")).where("label IS NOT NULL").groupBy("label").agg(F.count("*").alias("n"))).limit(k)


def coverage(rows: DataFrame, snapshot: str, query: str = "query", location: str = "query_location", search_filter: str = "query_filter", description: str = "description", least: int = 80) -> DataFrame:
    """One row: rows, rows seen and new in the snapshot, described rows and their share, different searches.

    A search counts once; those without query or location do not count.
    """
    searched = (F.trim(F.coalesce(F.col(query), F.lit(""))) != "") & (F.trim(F.coalesce(F.col(location), F.lit(""))) != "")
    described = F.coalesce(F.length(text.normalize_space(F.col(description))) >= least, F.lit(False))
    one = rows.agg(
        F.count("*").alias("n_rows"),
        F.count_if(F.coalesce(F.col("last_seen_snapshot") == snapshot, F.lit(False))).alias("n_seen"),
        F.count_if(F.coalesce(F.col("first_seen_snapshot") == snapshot, F.lit(False))).alias("n_new"),
        F.count_if(described).alias("n_described"),
        F.count_distinct(F.when(searched, F.struct(F.col(query), F.col(location), F.coalesce(F.col(search_filter), F.lit(""))))).alias("n_searches"),
    )
    return one.withColumn("described_share", share(F.col("n_described"), F.col("n_rows")))


def overlap(first: DataFrame, second: DataFrame, k: int = 3) -> DataFrame:
    """Labels among the k most frequent of both counts, in the first one's order."""
    a, b = ranked(first).limit(k), ranked(second).limit(k)
    return a.join(b.select("label"), "label", "left_semi").orderBy(F.desc("n"), "label")


def source_counts(registry: DataFrame, rows: DataFrame, source: str = "source") -> DataFrame:
    """Rows per registered source, 0 for one that gave none, and null registry names left out."""
    n = rows.groupBy(source).agg(F.count("*").alias("n"))
    return registry.select(source).distinct().where(F.col(source).isNotNull()).join(n, source, "left").select(source, F.coalesce("n", F.lit(0)).alias("n"))
