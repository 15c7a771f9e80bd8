"""Queries of the llm operators (problems 2 to 9) and their SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlens.llm import canon, encode, incremental, language, mixing, neardup, records, survivor
from postlens.llm.ids import posting_number
from postlens.operators.timestamps import utc_ms
from postlens.plans.training import job_instants
from postlens.session import shared_folder, table

#: p3_found's notion of a near-duplicate (TESTDATA.md): word triples, Jaccard 0.7, 30 words.
P3 = {"n": 3, "similarity": 0.7, "min_words": 30}

P4_POLICIES = (
    survivor.Policy("description", rank=("score", "trust", "time"), score="n_words", norm="words_norm"),
    survivor.Policy("detail_fetched_at", rank=("time",), score="has_instant", norm="epoch_ms"),
)
P4_RECORD = (
    survivor.Policy("title", rank=("votes",)),
    survivor.Policy("company", rank=("votes",)),
    survivor.Policy("location", rank=("votes",)),
    *P4_POLICIES,
)


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    """Copies of linkedin_jobs rows that differ in writing only, each with the first of its group."""
    return records.copy_pairs(table(spark, d, "linkedin_jobs"))


def p2_collapsed(spark: SparkSession, d: str) -> DataFrame:
    """One row per record of linkedin_jobs with the number of its copies."""
    return records.collapse(table(spark, d, "linkedin_jobs").select("row_id", "title", "company", "location", "url"))


def _descriptions(spark: SparkSession, d: str) -> DataFrame:
    pools = [table(spark, d, t).select("row_id", "description") for t in ("linkedin_jobs", "company_career_jobs")]
    return pools[0].unionByName(pools[1])


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of rows of both pools whose descriptions are near-duplicates."""
    return neardup.similar_rows(_descriptions(spark, d), "row_id", "description", **P3)


def p3_classes(spark: SparkSession, d: str) -> DataFrame:
    """Class and number of links of each description, at five words and a similarity of 0.8."""
    return neardup.classes(_descriptions(spark, d), "row_id", "description", n=5, similarity=0.8)


def _postings(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    """Rows of linkedin_jobs with posting number, trust, instant and the measures of their fields; one scan, as
    the instants are worked out beside the other columns."""
    keep = ("row_id", "linkedin_job_id", "url", "worker_id", "description", "ingested_at", "detail_fetched_at", *columns)
    rows = job_instants(spark, d, keep)
    ranks = table(spark, d, "crawl_workers").groupBy(F.col("worker_id").alias("_worker")).agg(F.min("trust_rank").alias("trust_rank"))
    numbered = rows.withColumn("job_no", posting_number(F.col("linkedin_job_id"), F.col("url"))).where("job_no IS NOT NULL")
    words = survivor.distinct_words(F.col("description"))
    made = {"n_words": F.size(words), "words_norm": F.xxhash64(words), "has_instant": F.when(F.col("epoch_ms").isNotNull(), 1), "ingested_ms": utc_ms(rows, "ingested_at")}
    return numbered.withColumns(made).join(ranks, F.col("worker_id") == F.col("_worker"), "left")


def _p4(spark: SparkSession, d: str, make, policies: tuple, *columns: str) -> DataFrame:
    return make(_postings(spark, d, *columns), "job_no", "row_id", policies, "trust_rank", "epoch_ms", least_rows=2, latest_ms="ingested_ms")


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    """Row that gives description and detail_fetched_at of each posting with several rows."""
    return _p4(spark, d, survivor.winners, P4_POLICIES)


def p4_records(spark: SparkSession, d: str) -> DataFrame:
    """One surviving record per posting with several rows, each field from the best of its rows."""
    return _p4(spark, d, survivor.golden, P4_RECORD, "title", "company", "location")


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    """Listed place or title that each typed location and title of sap_jobs means; -1 for none."""
    jobs = table(spark, d, "sap_jobs").select("row_id", "location", "title")
    places = canon.map_places(jobs, "row_id", "location", table(spark, d, "ref_locations"))
    titles = canon.map_titles(jobs, "row_id", "title", table(spark, d, "ref_titles"))
    with_field = lambda df, f: df.select("row_id", F.lit(f).alias("field"), "ref_id")
    return with_field(places, "location").unionByName(with_field(titles, "title"))


def p5_unmatched(spark: SparkSession, d: str) -> DataFrame:
    """Typed values without an entry, and how often each occurs."""
    jobs = table(spark, d, "sap_jobs").select("row_id", "location", "title")
    missing = p5_found(spark, d).where("ref_id = -1")
    value = F.when(F.col("field") == "location", F.col("location")).otherwise(F.col("title"))
    return missing.join(jobs, "row_id").groupBy("field", value.alias("value")).agg(F.count("*").alias("n_rows"))


def _history(spark: SparkSession, d: str) -> DataFrame:
    return incremental.contents(table(spark, d, "linkedin_jobs"), "row_id", F.lit(incremental.HISTORY))


def _incoming(spark: SparkSession, d: str) -> DataFrame:
    return incremental.contents(table(spark, d, "linkedin_incoming"), "incoming_id", F.col("batch_no"))


def _known(spark: SparkSession, d: str) -> DataFrame:
    """Incoming rows that are known, by a chunk store that is filled from linkedin_jobs and takes batch after batch."""
    store = incremental.ChunkStore(spark, f"{shared_folder(spark).rstrip('/')}/chunks-{uuid.uuid4().hex}")
    return incremental.known_records(store, _history(spark, d), _incoming(spark, d))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    """Incoming rows whose posting linkedin_jobs or an earlier incoming row has."""
    return _known(spark, d).select(F.col("record").alias("incoming_id"))


def p6_reasons(spark: SparkSession, d: str) -> DataFrame:
    """Known incoming rows by batch and reason, and the rows that are new."""
    known = _known(spark, d)
    rows = table(spark, d, "linkedin_incoming").select("incoming_id", "batch_no")
    joined = rows.join(known, rows["incoming_id"] == known["record"], "left")
    return joined.groupBy("batch_no", F.coalesce("reason", F.lit("new")).alias("outcome")).agg(F.count("*").alias("n_rows"))


def p7_ids(spark: SparkSession, d: str) -> DataFrame:
    """Token ids of every document's text by byte_bpe_50k."""
    return encode.encode(table(spark, d, "documents"), "doc_id", "text")


def p7_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """Documents by whether their ids decode to the very text."""
    docs = table(spark, d, "documents").select("doc_id", "text")
    back = encode.decode(encode.encode(docs, "doc_id", "text"), "doc_id").withColumnRenamed("text", "back")
    same = F.coalesce(F.col("text"), F.lit("")) == F.col("back")
    return docs.join(back, "doc_id").groupBy(same.alias("same")).agg(F.count("*").alias("n_documents"))


def p8_mix(spark: SparkSession, d: str) -> DataFrame:
    """Documents of the mix with the number of their copies."""
    mixed = mixing.mix(table(spark, d, "documents"), table(spark, d, "mix_targets"))
    return mixed.where("copies > 0").select("doc_id", "source", "n_tokens", "copies")


def p8_shares(spark: SparkSession, d: str) -> DataFrame:
    """Target and real share of each source in the mix."""
    targets = table(spark, d, "mix_targets")
    return mixing.shares_of(mixing.mix(table(spark, d, "documents"), targets), targets)


def p8_soft(spark: SparkSession, d: str) -> DataFrame:
    """Shares of the domains in the mix with documents of unknown source, which count for the domains that the
    classifier sees in them."""
    return mixing.domain_shares(mixing.plan_mix(table(spark, d, "documents"), table(spark, d, "mix_targets"), use_unlabelled=True))


def _segments(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    return language.segments(docs, "doc_id", "text", language.train(docs, "doc_id", "text", "lang", "title"), "title")


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    """Stretches of one language in the documents whose label is missing, wrong or not enough."""
    return language.wrong_labels(_segments(spark, d), table(spark, d, "documents"), "doc_id", "lang")


def p9_documents(spark: SparkSession, d: str) -> DataFrame:
    """Language of each document with a confidence."""
    return language.document_languages(_segments(spark, d), "doc_id")


def p9_segments(spark: SparkSession, d: str) -> DataFrame:
    """Every stretch of one language in every document, with its place and confidence."""
    return _segments(spark, d).select("doc_id", F.explode("segments").alias("s")).select("doc_id", "s.*")


QUERIES = {
    "p2_found": p2_found,
    "p2_collapsed": p2_collapsed,
    "p3_found": p3_found,
    "p3_classes": p3_classes,
    "p4_found": p4_found,
    "p4_records": p4_records,
    "p5_found": p5_found,
    "p5_unmatched": p5_unmatched,
    "p6_found": p6_found,
    "p6_reasons": p6_reasons,
    "p7_ids": p7_ids,
    "p7_roundtrip": p7_roundtrip,
    "p8_mix": p8_mix,
    "p8_shares": p8_shares,
    "p8_soft": p8_soft,
    "p9_found": p9_found,
    "p9_documents": p9_documents,
    "p9_segments": p9_segments,
}

# --- SQL in DuckDB's dialect, written on its own ---------------------------------------------------

_PLAIN = "regexp_replace(lower(nfc_normalize({})), '[^\\p{{L}}\\p{{M}}\\p{{N}}]', '', 'g')"


def _plain(x: str) -> str:
    return _PLAIN.format(f"replace(replace({x}, '&amp;', '&'), '&#38;', '&')")


def _bag(x: str, pattern: str) -> str:
    parts = f"list_sort(list_filter(list_transform(string_split_regex({x}, '{pattern}'), lambda p: {_plain('p')}), lambda p: p != ''))"
    return f"CASE WHEN {x} IS NULL THEN NULL ELSE array_to_string({parts}, chr(1)) END"


_P2 = f"""WITH k AS (SELECT row_id, coalesce({_plain('title')}, chr(2)) AS t, coalesce({_plain('company')}, chr(2)) AS c, {_bag('location', '[,;/|]')} AS l,
 {_plain("regexp_replace(url, '[?#].*', '')")} AS u, {_bag("regexp_extract(url, '[?]([^#]*)', 1)", '&')} AS q FROM linkedin_jobs),
g AS (SELECT row_id, min(row_id) OVER (PARTITION BY least(t, c), greatest(t, c), l, u, q) AS f FROM k)
SELECT f AS first_row_id, row_id AS copy_row_id FROM g WHERE row_id != f"""

_P3 = """WITH d AS (SELECT row_id, description FROM linkedin_jobs UNION ALL SELECT row_id, description FROM company_career_jobs),
w AS (SELECT row_id, regexp_extract_all(lower(regexp_replace(description, '<[^>]*>', ' ', 'g')), '[\\p{L}\\p{N}]+') AS w FROM d WHERE description IS NOT NULL),
s AS (SELECT row_id, list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) AS g FROM w WHERE len(w) >= 30),
t AS (SELECT row_id, len(g) AS n, unnest(g) AS x FROM s),
o AS (SELECT a.row_id AS a, b.row_id AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS shared FROM t a JOIN t b ON a.x = b.x AND a.row_id < b.row_id GROUP BY 1, 2)
SELECT a AS row_id_a, b AS row_id_b FROM o WHERE shared >= 0.7 * (na + nb - shared) - 1e-9"""

_NUMBER = """CASE WHEN trim(coalesce(linkedin_job_id, ''), ' \t\n\r') = '' THEN coalesce(nullif(regexp_extract(url, '[?&]currentJobId=(\\d{10})', 1), ''), nullif(regexp_extract(url, '(?:/|-)(\\d{10})/*(?:[?#].*)?$', 1), ''))
 ELSE nullif(regexp_extract(regexp_replace(regexp_replace(trim(linkedin_job_id, ' \t\n\r'), '\\.0+$', ''), '[^0-9]', '', 'g'), '^0*([1-9]\\d{9})$', 1), '') END"""
_LAST = "nullif(regexp_extract(regexp_replace(regexp_replace(lower(trim(url, ' \t\n\r')), '[?#].*$', ''), '^[a-z]+://[^/]*', ''), '([^/]+)/*$', 1), '')"

_P6 = f"""WITH r AS (SELECT 0 AS batch, row_id AS id, {_NUMBER} AS num, {_LAST} AS part FROM linkedin_jobs UNION ALL SELECT batch_no, incoming_id, {_NUMBER}, {_LAST} FROM linkedin_incoming),
n AS (SELECT num, min((batch, id)) AS first FROM r WHERE num IS NOT NULL GROUP BY num),
c AS (SELECT part, string_split(part, '-') AS w, min((batch, id)) AS first FROM r WHERE num IS NULL AND part IS NOT NULL GROUP BY part),
k AS (SELECT part, w, first, unnest(list_concat([part], list_transform(range(1, len(w) + 1), lambda i: array_to_string(list_concat(w[1:i - 1], w[i + 1:]), '-')))) AS key FROM c),
p AS (SELECT DISTINCT a.part, a.w AS wa, b.w AS wb, b.first FROM k a JOIN k b ON a.key = b.key),
e AS (SELECT part, first FROM p WHERE len(wa) != len(wb) OR len(list_filter(range(1, len(wa) + 1), lambda i: wa[i] != wb[i])) = 0
 OR (len(list_filter(range(1, len(wa) + 1), lambda i: wa[i] != wb[i])) = 1 AND levenshtein(wa[list_filter(range(1, len(wa) + 1), lambda i: wa[i] != wb[i])[1]], wb[list_filter(range(1, len(wa) + 1), lambda i: wa[i] != wb[i])[1]]) <= 3)),
m AS (SELECT part, min(first) AS first FROM e GROUP BY part)
SELECT id AS incoming_id FROM r LEFT JOIN n ON r.num = n.num LEFT JOIN m ON r.num IS NULL AND r.part = m.part WHERE batch > 0 AND (n.first < (batch, id) OR m.first < (batch, id))"""

SQL: dict[str, str] = {"p2_found": _P2, "p3_found": _P3, "p6_found": _P6}
