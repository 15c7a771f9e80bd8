"""Mixing sources to target weights (problem 8).

Each document has a label (its source, or none) and a soft membership: the domain posteriors of a
classifier fitted on labelled rows.  It gets a rate, the expected number of its copies, between 0
and its source's cap.  The rates are fitted by projected gradient least squares: the expected tokens
of every domain, summed over the posteriors, shall match the domain's target, as far as that goes
with every labelled source giving just its share.  Each step goes down the gradient and is projected
back to the caps and the sources' totals.  A small ridge keeps rates near the even use of a
source where the posteriors say nothing.

Documents with the same label, the same likeliest domain and about the same confidence have the
same rate, so one distributed sum over all documents gives all that the steps need: one row per
profile, (sources + 1) x sources x LEVELS rows at most, however many documents there are.  Each row has
its documents' tokens by domain, summed over all their posteriors, so for given rates the expected
tokens of every domain are those of the documents themselves.  Targets
that a source can't reach at its cap are set to what it can give, and the rest is shared by the others
in proportion to their targets.  Rates become whole copies by carrying the rounding error from the
largest document to the smallest, so a source misses its tokens by about its smallest document.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlens.llm.encode import SLICE, VOCABULARY, Encoder
from postlens.llm.shingles import words
from postlens.session import cut

HASH_BITS = 14
#: Steps of confidence in the profiles.
LEVELS = 16
#: Sources that a list of targets may have.
MOST_SOURCES = 1000


class _Buckets(dict):
    """Buckets of words, kept while a worker lives; emptied when it grows too large."""

    def __missing__(self, word: str) -> int:
        if len(self) > 500_000:
            self.clear()
        made = self[word] = xxhash.xxh32_intdigest(word) >> (32 - HASH_BITS)
        return made


def features(text: str, buckets: _Buckets) -> np.ndarray:
    found = words(text)
    return np.fromiter((buckets[w] for w in found), dtype=np.int64, count=len(found))


def fit_domains(rows: DataFrame, key: str, text: str, source: str, domains: list[str], bound: int = 3000) -> np.ndarray:
    """Log weights (domains x buckets, prior in the last column) of a bag-of-words classifier.

    Fitted on at most ``bound`` labelled rows, chosen by the hash of their key; the fit stays on the driver.
    """
    labelled = rows.where(F.col(source).isin(*domains) & F.col(text).isNotNull())
    sample = labelled.select(source, text, F.xxhash64(key).alias("_h"), F.col(key).alias("_k")).orderBy("_h", "_k").limit(bound).select(source, text).collect()
    counts, prior, buckets = np.full((len(domains), 1 << HASH_BITS), 0.1), np.ones(len(domains)), _Buckets()
    for name, body in sample:
        k = domains.index(name)
        prior[k] += 1
        counts[k] += np.bincount(features(body, buckets), minlength=1 << HASH_BITS)
    weights = np.log(counts / counts.sum(axis=1, keepdims=True))
    return np.concatenate([weights, np.log(prior / prior.sum())[:, None]], axis=1).astype(np.float32)


def posteriors(texts: list[str | None], weights: np.ndarray, buckets: _Buckets) -> np.ndarray:
    """Domain probabilities of texts (texts x domains); the prior for a null or empty one."""
    lists = [words(t) if t else [] for t in texts]
    count = np.fromiter(map(len, lists), np.int64, len(lists))
    place = np.fromiter((buckets[w] for ws in lists for w in ws), np.int64, int(count.sum()))
    score, some = np.tile(weights[:, -1], (len(lists), 1)).astype(np.float64), count > 0
    if some.any():
        rows = np.ascontiguousarray(weights[:, :-1].T)[place]
        score[some] += np.add.reduceat(rows, (np.cumsum(count) - count)[some], axis=0) / np.sqrt(count[some])[:, None]
    p = np.exp(score - score.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True)


def measured(rows: DataFrame, key: str, text: str, source: str, weights: np.ndarray, vocabulary: str) -> DataFrame:
    """``key``, ``source``, ``n_tokens``, ``seen`` (number of the likeliest domain), ``sure`` (its posterior), ``member`` (the
    posteriors of all domains), in one pass over the texts."""
    shared = rows.sparkSession.sparkContext.broadcast(weights)  # domains x 16,385 numbers
    kinds = dict(rows.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, buckets = None, _Buckets()
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                encoder = encoder or Encoder(vocabulary)
                texts = part.column(2).to_pylist()
                sizes = encoder.count(texts)
                p = posteriors(texts, shared.value, buckets)
                best, sure = p.argmax(axis=1).astype(np.int32), p.max(axis=1)
                member = pa.ListArray.from_arrays(np.arange(len(p) + 1, dtype=np.int32) * p.shape[1], p.astype(np.float32).ravel())
                cols = [*part.columns[:2], pa.array(sizes, pa.int32()), pa.array(best), pa.array(sure), member]
                yield pa.RecordBatch.from_arrays(cols, ["key", "source", "n_tokens", "seen", "sure", "member"])

    made = rows.select(F.col(key).alias("key"), F.col(source).alias("source"), F.col(text).alias("text"))
    return made.mapInArrow(run, f"key {kinds[key]}, source string, n_tokens int, seen int, sure double, member array<float>")


def _posterior(k: int) -> Column:
    return F.get("member", F.lit(k)).cast("double")


def reachable(shares: np.ndarray, capacity: np.ndarray, total: float) -> np.ndarray:
    """Token targets that sum to ``total`` (or to all capacity): in proportion to the shares, none above its capacity."""
    target, open_ = np.zeros_like(capacity), shares > 0
    while open_.any():
        left = total - target[~open_].sum()
        wish = shares * max(left, 0) / shares[open_].sum()
        full = open_ & (wish >= capacity)
        if not full.any():
            target[open_] = wish[open_]
            break
        target[full] = capacity[full]
        open_ &= ~full
    return target


def shifted(rates: np.ndarray, sizes: np.ndarray, cap: float, goal: float) -> np.ndarray:
    """The nearest rates (weighted by size) between 0 and the cap that give ``goal`` tokens, or all that the cap allows."""
    if goal >= cap * sizes.sum():
        return np.full_like(rates, cap)
    low, high = -rates.max() - 1, cap - rates.min() + 1
    for _ in range(100):
        mid = (low + high) / 2
        if (np.clip(rates + mid, 0, cap) * sizes).sum() < goal:
            low = mid
        else:
            high = mid
    return np.clip(rates + high, 0, cap)


@dataclass(frozen=True)
class Fit:
    """Rates of the profiles, the tokens wanted and expected of each domain, and how the steps ended."""

    rates: np.ndarray
    wanted: np.ndarray
    expected: np.ndarray
    steps: int
    converged: bool


def fit_rates(label: np.ndarray, member: np.ndarray, sizes: np.ndarray, caps: np.ndarray, shares: np.ndarray, total: float, ridge: float = 0.1, most: int = 5000, close: float = 1e-7) -> Fit:
    """Projected gradient steps over profiles: label (-1 for none), membership, tokens; caps and shares by domain.

    What documents without a label give to a domain, by their posteriors, counts towards the
    domain's total; they are used once at most.  ``converged``: the last step moved no rate by ``close``.
    """
    capacity = np.array([caps[k] * sizes[label == k].sum() for k in range(len(caps))])
    loose = label < 0
    capacity_all = capacity + (sizes[loose, None] * member[loose]).sum(axis=0)
    goal, scale = reachable(shares, capacity_all, total), max(total, 1.0)
    cap = np.where(loose, 1.0, caps[np.maximum(label, 0)])

    def project(rates: np.ndarray) -> np.ndarray:
        out = np.clip(rates, 0, cap)
        given = (out[loose] * sizes[loose]) @ member[loose]
        for k in range(len(caps)):
            here = label == k
            if sizes[here].sum() > 0:
                out[here] = shifted(rates[here], sizes[here], float(caps[k]), max(goal[k] - given[k], 0.0))
        return out

    even = project(np.minimum(np.ones(len(sizes)), cap))
    rates, step, done, n = even, 1 / (1 + ridge), False, 0
    while n < most and not done:
        error = ((rates * sizes) @ member - goal) / scale
        new = project(rates - step * (member @ error + ridge * (rates - even)))
        done, rates, n = bool(np.abs(new - rates).max(initial=0.0) < close), new, n + 1
    if not done:
        warnings.warn(f"the rates still moved after {n} steps", stacklevel=2)
    return Fit(rates, goal, (rates * sizes) @ member, n, done)


def _copies(group: pd.DataFrame) -> pd.DataFrame:
    """Whole copies of one bucket's documents; the error is carried on in order of size, largest first."""
    order = group.sort_values(["n_tokens", "key"], ascending=[False, True])
    whole = np.floor(order["rate"].to_numpy() + 1e-9)
    rest, size, cap = order["rate"].to_numpy() - whole, order["n_tokens"].to_numpy(), order["cap"].to_numpy()
    owed, more = 0.0, np.zeros(len(order))
    for i in range(len(order)):
        owed += size[i] * rest[i]
        if owed >= size[i] / 2 and whole[i] < cap[i]:
            more[i] = 1
            owed -= size[i]
    return order.assign(copies=(whole + more).astype("int32"))


@dataclass(frozen=True)
class Mix:
    """Documents of a mix (``key``, source, ``n_tokens``, ``seen``, ``sure``, ``rate``, ``cap``, ``copies``, and ``member`` unless
    left out) and the fit behind it."""

    documents: DataFrame
    domains: list[str]
    shares: np.ndarray
    fit: Fit


def plan_mix(
    rows: DataFrame, targets: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", use_unlabelled: bool = False, vocabulary: str = VOCABULARY, per_bucket: int = 2000, members: bool = True
) -> Mix:
    """The mix with its fit.

    It is as large, in tokens, as all documents whose source has a target (or as large as the caps
    allow).  Documents of a source without a target never take part; those with a null source only
    with ``use_unlabelled``, at most once each.  Null and empty texts have no tokens and no copies.
    Of targets listed twice the first by share holds; a list of over MOST_SOURCES is an error.  An
    empty table gives an empty mix.  ``members``: whether the documents come with their posteriors.  Rounding: documents of one source fall into buckets of about
    ``per_bucket`` by hash, in each of which the error is carried from document to document.
    """
    listed = targets.where(F.col(source).isNotNull()).groupBy(source).agg(F.max("target_share").alias("target_share"), F.max_by("max_repeats", "target_share").alias("max_repeats"))
    chosen = sorted(listed.limit(MOST_SOURCES + 1).collect())
    if len(chosen) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources have a target")
    domains, shares, caps = [r[0] for r in chosen], np.array([float(r[1] or 0) for r in chosen]), np.array([float(r[2] or 0) for r in chosen])
    taking = F.col(source).isin(*domains) if domains else F.lit(False)
    part = rows.select(key, source, text).where((taking | F.col(source).isNull() if use_unlabelled else taking) if domains else F.lit(False))
    weights = fit_domains(rows, key, text, source, domains) if domains else np.zeros((1, (1 << HASH_BITS) + 1), np.float32)
    number = F.lit(-1)
    for k, d in enumerate(domains):
        number = F.when(F.col("source") == d, F.lit(k)).otherwise(number)
    level = F.least(F.lit(LEVELS - 1), F.floor(F.col("sure") * LEVELS)).cast("int")
    docs = cut(measured(part, key, text, source, weights, vocabulary).where("n_tokens > 0").withColumns({"label": number, "level": level}))
    profile = ["label", "seen", "level"]
    # at most (sources + 1) x sources x LEVELS rows
    by_domain = [F.sum(_posterior(k) * F.col("n_tokens")) for k in range(len(weights))]
    profiles = docs.groupBy(*profile).agg(F.sum("n_tokens").alias("n"), F.count("*").alias("docs"), F.array(*by_domain).alias("tokens")).orderBy(*profile).collect()
    label, sizes = np.array([r["label"] for r in profiles], int), np.array([float(r["n"]) for r in profiles])
    tokens = np.array([r["tokens"] for r in profiles], float).reshape(len(profiles), len(weights))
    member = tokens / tokens.sum(axis=1, keepdims=True)
    fit = fit_rates(label, member, sizes, caps, shares, float(sizes[label >= 0].sum())) if profiles else Fit(np.zeros(0), np.zeros(len(domains)), np.zeros(len(domains)), 0, True)
    cap_of = [float(caps[k]) if k >= 0 else 1.0 for k in label]
    rated = rows.sparkSession.createDataFrame([(r["label"], r["seen"], r["level"], float(x), c) for r, x, c in zip(profiles, fit.rates, cap_of, strict=True)], "label int, seen int, level int, rate double, cap double")
    n_buckets = max(1, -(-sum(r["docs"] for r in profiles) // per_bucket))
    placed = docs.join(F.broadcast(rated), profile).withColumn("bucket", F.pmod(F.xxhash64("key", F.lit("mix")), F.lit(n_buckets)))
    kind = dict(rows.dtypes)[key]
    columns = f"key {kind}, source string, n_tokens int, seen int, sure double, rate double, cap double" + ", member array<float>" * members
    names = [c.split()[0] for c in columns.split(", ")]
    grouped = placed.select(*names, "label", "bucket").groupBy("label", "bucket")
    made = grouped.applyInPandas(lambda g: _copies(g)[[*names, "copies"]], f"{columns}, copies int")
    out = made.select(F.col("key").alias(key), F.col("source").alias(source), "n_tokens", "seen", "sure", "rate", F.col("cap").cast("int").alias("cap"), "copies", *["member"] * members)
    return Mix(out, domains, shares, fit)


def mix(rows: DataFrame, targets: DataFrame, **options) -> DataFrame:
    """The documents of ``plan_mix``, without their posteriors."""
    return plan_mix(rows, targets, members=False, **options).documents


def shares_of(mixed: DataFrame, targets: DataFrame, source: str = "source") -> DataFrame:
    """Target and real share of each source in a mix, and what it gave."""
    given = mixed.groupBy(source).agg(F.sum(F.col("n_tokens") * F.col("copies")).alias("tokens"), F.sum("copies").alias("n_used"), F.count_if(F.col("copies") > 0).alias("n_documents"), F.max("copies").alias("most_repeats"))
    whole = given.agg(F.sum("tokens").alias("all"))
    joined = targets.select(source, "target_share", "max_repeats").join(given, source, "full_outer").join(F.broadcast(whole))  # one row
    return joined.select(source, "target_share", F.coalesce(F.try_divide(F.coalesce("tokens", F.lit(0)), F.col("all")), F.lit(0.0)).alias("real_share"), F.coalesce("tokens", F.lit(0)).alias("tokens"), F.coalesce("n_used", F.lit(0)).alias("n_used"), F.coalesce("n_documents", F.lit(0)).alias("n_documents"), "most_repeats", "max_repeats")


def domain_shares(mixed: Mix, source: str = "source") -> DataFrame:
    """Per domain: tokens of the mix by label (by posterior where there is none) and by posterior throughout, with
    their shares beside the target, and how the fit ended."""
    flow = F.col("n_tokens") * F.col("copies")
    aggs: list[Column] = [F.sum(flow).alias("all")]
    for k, d in enumerate(mixed.domains):
        p = _posterior(k)
        aggs += [F.sum(flow * F.when(F.col(source).isNotNull(), (F.col(source) == d).cast("double")).otherwise(p)).alias(f"a{k}"), F.sum(flow * p).alias(f"e{k}")]
    one = mixed.documents.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(d).alias("domain"), F.lit(float(mixed.shares[k])).alias("target_share"), F.col(f"a{k}").alias("tokens"), F.col(f"e{k}").alias("expected_tokens")) for k, d in enumerate(mixed.domains)])
    long = one.select("all", F.explode(rows).alias("r")).select("all", "r.*")
    share = lambda c: F.coalesce(F.try_divide(F.col(c), F.col("all")), F.lit(0.0))
    return long.select("domain", "target_share", share("tokens").alias("share"), share("expected_tokens").alias("expected_share"), "tokens", "expected_tokens", F.lit(mixed.fit.steps).alias("n_steps"), F.lit(mixed.fit.converged).alias("converged"))
