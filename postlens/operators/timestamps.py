"""Mixed timestamp notations, precisions and zones normalised to one instant in UTC.

Three steps; every row is read by built-in expressions (Python sees one row per source only):

1. ``with_fields`` reads a value with one of a few notation patterns into year, month,
   day, time, fraction and zone text.  A value that no pattern reads, or whose parts name
   no real moment, has no instant.
2. ``estimate_zones`` scores every candidate zone for the values *without* zone of each
   source: with a zone's whole offset history, the local times become instants, and an
   instant after the row's ingestion (or before the given lower bound) is a violation, and
   so is one that lies further back than the source's values *with* a zone do.  The history
   with the fewest violations wins.  One map-side combined aggregate of counts and quantile
   sketches; its result has one row per source.
3. ``to_instants`` converts: the zone written in the value, else the declared zone of the
   source, else the estimated one.

Daylight saving: an hour that occurs twice means the first one, a time in a skipped hour
counts with the offset before the change (both as java.time resolves local times).
"""

from __future__ import annotations

import zoneinfo
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Month names as they are written in the six languages of the feeds.
MONTHS = {
    1: "jan january januar jänner janvier enero ene janeiro januari",
    2: "feb february februar février fevrier févr febrero fevereiro fev februari",
    3: "mar march märz maerz mrz mars marzo março marco maart mrt",
    4: "apr april avril avr abril abr",
    5: "may mai mayo maio mei",
    6: "jun june juni juin junio junho",
    7: "jul july juli juillet juil julio julho",
    8: "aug august août aout agosto ago augustus",
    9: "sep sept september septembre septiembre setiembre setembro set",
    10: "oct october oktober okt octobre octubre outubro out",
    11: "nov november novembre noviembre novembro",
    12: "dec december dezember dez décembre decembre déc diciembre dic dezembro",
}

# Zone abbreviations and their offset from UTC in minutes.
ABBREVIATIONS = {
    "z": 0, "ut": 0, "utc": 0, "gmt": 0, "wet": 0,
    "bst": 60, "cet": 60, "west": 60, "met": 60, "mez": 60,
    "cest": 120, "mest": 120, "mesz": 120, "eet": 120, "sast": 120,
    "eest": 180, "msk": 180, "ist": 330,
    "sgt": 480, "awst": 480, "hkt": 480, "jst": 540, "kst": 540,
    "acst": 570, "acdt": 630, "aest": 600, "aedt": 660, "nzst": 720, "nzdt": 780,
    "nst": -210, "ndt": -150, "brt": -180, "art": -180, "ast": -240, "adt": -180,
    "est": -300, "edt": -240, "cst": -360, "cdt": -300, "mst": -420, "mdt": -360, "pst": -480, "pdt": -420,
}

#: Candidate zones of the estimator when the caller names none besides the declared ones.
CANDIDATE_ZONES = (
    "UTC", "Europe/London", "Europe/Berlin", "Europe/Helsinki", "Asia/Dubai", "Asia/Kolkata", "Asia/Singapore", "Asia/Tokyo",
    "Australia/Sydney", "America/Sao_Paulo", "America/New_York", "America/Chicago", "America/Denver", "America/Los_Angeles",
)

SEP = "\u0001"
_TIME = r"(\d{1,2}):(\d{2})(?::(\d{2})(?:[.,](\d{1,12}))?)?"
_ZONE = r"(z|[a-z]{2,5}(?:[+-]\d{1,2}(?::?\d{2})?)?|[+-]\d{1,2}(?::?\d{2})?(?:\[[a-z_/+-]+\])?|\[[a-z_/+-]+\]|[a-z]+/[a-z_]+(?:/[a-z_]+)?)"
_TAIL = rf"(?: ?(am|pm|a\.m\.|p\.m\.)(?![a-z]))?(?: ?{_ZONE})?"
_MONTH = r"([a-zà-ÿ]{3,10})\.?"
_WEEKDAY = r"(?:[a-zà-ÿ]{2,12}\.?,? )?"

#: (pattern, replacement to kind, year, month, day, hour, minute, second, fraction, half of the day, zone).
#: Kind i has a numeric month in place, w a month's name, n a numeric date whose order the source decides.
_FORMS = (
    (rf"^(\d{{4}})[-/.](\d{{1,2}})[-/.](\d{{1,2}})(?:(?:t| ){_TIME}{_TAIL})?$", "i {1} {2} {3} {4} {5} {6} {7} {8} {9}"),
    (r"^(\d{4})(\d{2})(\d{2})(?:t(\d{2})(\d{2})(\d{2})(z|[+-]\d{2}:?\d{2})?)?$", "i {1} {2} {3} {4} {5} {6} - - {7}"),
    (rf"^(\d{{1,2}})[./-](\d{{1,2}})[./-](\d{{4}}|\d{{2}})(?:,? {_TIME}{_TAIL})?$", "n {3} {1} {2} {4} {5} {6} {7} {8} {9}"),
    (
        rf"^{_WEEKDAY}(\d{{1,2}})(?:\.|er|st|nd|rd|th)? (?:de |of )?{_MONTH},?(?: de| del)? (\d{{4}})(?:,?(?: (?:à|às|as|um|at|om|a las))? {_TIME}(?: uhr| h)?{_TAIL})?$",
        "w {3} {2} {1} {4} {5} {6} {7} {8} {9}",
    ),
    (
        rf"^{_WEEKDAY}{_MONTH} (\d{{1,2}})(?:st|nd|rd|th)?,? (\d{{4}})(?:,?(?: at)? {_TIME}{_TAIL})?$",
        "w {3} {1} {2} {4} {5} {6} {7} {8} {9}",
    ),
)
_EPOCH = r"^\d{10}(?:\d{3}|\d{6}|\d{9})?(?:\.\d+)?$"


def _replacement(shape: str) -> str:
    kind, *parts = shape.split(" ")
    return SEP.join([kind, *("" if p == "-" else "$" + p.strip("{}") for p in parts)])


def _tidy(value: Column) -> Column:
    """White space of every kind as single blanks, without those at the ends."""
    return F.trim(F.regexp_replace(value, r"(?U)[\s   ​﻿]+", " "))


def _lookup(pairs: dict[str, int], key: Column) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in pairs.items() for x in pair]), key)


def with_fields(rows: DataFrame, value: str, date_order: str) -> DataFrame:
    """``rows`` with ``p``: the parts of a timestamp in any of the notations, null if none reads it.

    ``secs`` are the local time's seconds as if it were UTC, ``ms`` its milliseconds with finer
    digits cut off.  ``offset_min`` and ``region`` hold the zone written in the value (0 for a count
    of seconds, milliseconds, microseconds or nanoseconds since 1970); both null means wall clock of
    the source.  The stages are separate projections so that each part is worked out once.
    """
    part = lambda k: F.get(F.col("_f"), F.lit(k))
    split = F.lit(None).cast("array<string>")
    for pattern, shape in reversed(_FORMS):
        split = F.when(F.col("_low").rlike(pattern), F.split(F.regexp_replace("_low", pattern, _replacement(shape)), SEP)).otherwise(split)
    digits = F.regexp_extract("_low", r"^(\d+)", 1)
    split = F.when(
        F.col("_low").rlike(_EPOCH),
        F.array(F.lit("e"), F.substring(digits, 1, 10), F.concat(F.substring(digits, 11, 9), F.regexp_extract("_low", r"\.(\d+)$", 1))),
    ).otherwise(split)
    number = lambda k: part(k).try_cast("int")
    swapped = (F.col("_kind") == "n") & (F.upper(F.coalesce(F.col(date_order), F.lit("DMY"))) == "MDY")
    months = {name: n for n, names in MONTHS.items() for name in names.split()}
    signed = r"^(?:utc|gmt|ut)?([+-])(\d{1,2}):?(\d{2})?(?:\[.*\])?$"
    size = F.regexp_extract("_zone", signed, 2).try_cast("int") * 60 + F.coalesce(F.regexp_extract("_zone", signed, 3).try_cast("int"), F.lit(0))
    offset = F.when(F.col("_zone") == "", None).when(F.col("_zone").rlike(signed), F.when(F.regexp_extract("_zone", signed, 1) == "-", -size).otherwise(size))
    named = F.regexp_extract("_tidy", r"([A-Za-z]+(?:/[A-Za-z_+-]+)*)\]?$", 1)
    hours = (
        F.when(F.col("_half") == "", F.col("_h"))
        .when(~F.col("_h").between(1, 12), None)
        .otherwise(F.col("_h") % 12 + F.when(F.col("_half") == "p", 12).otherwise(0))
    )
    stages = [
        {"_tidy": _tidy(F.col(value))},
        {"_low": F.lower("_tidy")},
        {"_f": split},
        {
            "_kind": part(0),
            "_year": part(1),
            "_first": number(2),
            "_month": F.when(part(0) == "w", _lookup(months, part(2))),
            "_second": number(3),
            "_h": F.coalesce(number(4), F.lit(0)),
            "_mi": F.coalesce(number(5), F.lit(0)),
            "_s": F.coalesce(number(6), F.lit(0)),
            "_ms": F.rpad(F.substring(F.when(part(0) == "e", part(2)).otherwise(part(7)), 1, 3), 3, "0").try_cast("int"),
            "_half": F.substring(part(8), 1, 1),
            "_zone": F.coalesce(part(9), F.lit("")),
        },
        {
            "_y": F.col("_year").try_cast("int") + F.when(F.length("_year") == 2, 2000).otherwise(0),
            "_mo": F.when(F.col("_kind") == "w", F.col("_month")).when(swapped | (F.col("_kind") == "i"), F.col("_first")).otherwise(F.col("_second")),
            "_d": F.when(swapped | (F.col("_kind") != "n"), F.col("_second")).otherwise(F.col("_first")),
            "_hh": hours,
            "_off": F.coalesce(offset, F.when(F.col("_zone") != "", _lookup(ABBREVIATIONS, F.col("_zone")))).cast("int"),
        },
        {
            "_whole": F.when(F.col("_kind") == "e", F.col("_year").try_cast("bigint")).when(
                (F.col("_mi") < 60) & (F.col("_s") < 60) & (F.col("_hh") < 24),
                F.unix_seconds(F.try_make_timestamp(F.col("_y"), F.col("_mo"), F.col("_d"), F.col("_hh"), F.col("_mi"), F.col("_s"), timezone=F.lit("UTC"))),
            ),
            "_region": F.when(F.col("_off").isNull() & (F.col("_zone") != ""), F.when(F.lower(named).isin("utc", "gmt"), F.lit("UTC")).otherwise(named)),
        },
    ]
    out = rows
    for stage in stages:
        out = out.withColumns(stage)
    valid = F.col("_whole").isNotNull() & ((F.col("_zone") == "") | F.col("_off").isNotNull() | is_zone("_region"))
    made = F.struct(
        F.col("_whole").alias("secs"),
        F.coalesce(F.col("_ms"), F.lit(0)).alias("ms"),
        F.when(F.col("_kind") == "e", F.lit(0)).otherwise(F.col("_off")).alias("offset_min"),
        F.col("_region").alias("region"),
        *[F.col(f"_{n}").alias(n) for n in ("y", "mo", "d", "hh", "mi", "s")],
    )
    return out.select(*rows.columns, F.when(valid, made).alias("p"))


_NAMES: list[str] = []


def zone_names() -> list[str]:
    """Names of zones with an offset history."""
    if not _NAMES:
        _NAMES.extend(sorted(n for n in zoneinfo.available_timezones() if not n.startswith(("SystemV", "posix", "right")) and n not in ("Factory", "localtime")))
    return _NAMES


def local_ms(p: Column, zone: Column) -> Column:
    """Milliseconds since 1970 of local parts in a zone's offset history."""
    moment = F.try_make_timestamp(p["y"], p["mo"], p["d"], p["hh"], p["mi"], p["s"], timezone=zone)
    return F.unix_seconds(moment) * 1000 + F.coalesce(p["ms"], F.lit(0))


def is_zone(name: str) -> Column:
    """Whether a column holds the name of such a zone; as text, which is parsed at once."""
    return F.expr(f"{name} IN ({', '.join(repr(n) for n in zone_names())})")


def utc_ms(df: DataFrame, name: str) -> Column:
    """Milliseconds since 1970 of a timestamp column; one without zone holds UTC wall clock."""
    if dict(df.dtypes)[name] == "timestamp_ntz":
        return F.timestamp_diff("MILLISECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col(name))
    return F.unix_millis(F.col(name).cast("timestamp"))


#: Quantiles that are kept of a source's lags.
QUANTILES = [k / 200 for k in range(1, 200)]


def _edge(lags: list[float] | None) -> float:
    """Where the bulk of a source's lags ends: the best split of the quantiles into an even bulk and an even tail."""
    q = np.array(lags if lags is not None else [], float)
    q = q[q >= 0]
    if len(q) < 20:
        return float("inf")
    inside = np.arange(1, len(q) + 1) / len(q)
    tail = np.maximum(1 - inside, 1e-3)
    width = np.maximum(q, 1.0)
    rest = np.maximum(q[-1] * 1.1 - q, width * 1e-3)
    score = inside * np.log(inside / width) + tail * np.log(tail / rest)
    last = len(q) // 2 + int(score[len(q) // 2 :].argmax())
    return float(q[last] * (1 + 1 / (last + 1)))  # the bulk ends somewhere before the next quantile


def _best_zone(candidates: Sequence[str], tolerance_s: int):
    """Function for mapInPandas: aggregates of one source per row to its zone."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            rows = []
            for r in part.itertuples(index=False):
                edge, options = _edge(r.zoned), []
                for k, zone in enumerate(candidates):
                    lags = np.array(getattr(r, f"q{k}"), float)
                    late = float((lags > edge + tolerance_s).mean()) * r.n_zoneless
                    options.append((getattr(r, f"v{k}") + late, getattr(r, f"g{k}"), k, zone))
                best = min(options)
                rows.append((r.source, r.n_zoneless, best[3], best[0], edge if np.isfinite(edge) else None))
            yield pd.DataFrame(rows, columns=["source", "n_zoneless", "estimated_zone", "violations", "longest_lag_s"])

    return run


def estimate_zones(parsed: DataFrame, source: str, latest: Column, earliest: Column | None, candidates: Sequence[str], tolerance_s: int = 60) -> DataFrame:
    """``source``, ``n_zoneless``, ``estimated_zone``, ``violations``, ``longest_lag_s``: one row per source
    with the zone whose offset history fits its zoneless values best.

    ``parsed`` has a column ``p`` of with_fields; the bounds are milliseconds since 1970.  Violations:
    instants later than ``latest`` or, if given, earlier than ``earliest``, by more than the tolerance;
    and instants whose lag to ``latest`` is longer than the bulk of the lags of the source's values with
    a zone (estimated from quantiles; without enough such values there is no such bound).  Dates
    alone tell nothing and don't count.  Ties: smaller total lag, then the order of ``candidates``.
    Sources without zoneless values have no row.
    """
    p, tol = F.col("p"), F.lit(tolerance_s * 1000)
    # conditions inside the sums, not filters: the optimizer would push a filter below the parsing and parse twice
    timed = p.isNotNull() & latest.isNotNull() & (F.pmod(p["secs"], F.lit(86400)) != 0)
    counts = timed & p["offset_min"].isNull() & p["region"].isNull()
    zoned = F.when(timed & p["offset_min"].isNotNull(), (latest - (p["secs"] - p["offset_min"] * 60) * 1000) / 1000)
    aggs = [F.count(F.when(counts, 1)).alias("n_zoneless"), F.percentile_approx(zoned, QUANTILES, 2000).alias("zoned")]
    for k, zone in enumerate(candidates):
        lag = F.when(counts, latest - zone_ms(p, zone))
        wrong = lag < -tol
        if earliest is not None:
            wrong = wrong | F.coalesce(lag > latest - earliest + tol, F.lit(False))
        aggs += [F.count(F.when(wrong, 1)).alias(f"v{k}"), F.sum(F.least(F.abs(lag) / 1000, F.lit(30 * 86400.0))).alias(f"g{k}"), F.percentile_approx(lag / 1000, QUANTILES, 2000).alias(f"q{k}")]
    grouped = parsed.where(F.col(source).isNotNull()).groupBy(F.col(source).cast("string").alias("source")).agg(*aggs).where("n_zoneless > 0")
    return grouped.mapInPandas(_best_zone(tuple(candidates), tolerance_s), "source string, n_zoneless bigint, estimated_zone string, violations double, longest_lag_s double")


def zone_ms(p: Column, zone: str) -> Column:
    """Milliseconds since 1970 of local parts in a zone's offset history, but for the hours of a change."""
    return F.unix_seconds(F.to_utc_timestamp(F.timestamp_seconds(p["secs"]), zone)) * 1000 + F.coalesce(p["ms"], F.lit(0))


#: Sources up to this number are sent to every task; beyond it the optimizer chooses the join.
BROADCAST_SOURCES = 10_000


def zones_of(rows: DataFrame, value: str, source: str, registry: DataFrame, latest: str, earliest: str | None, candidates: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """``rows`` with ``p`` and the declared ``tz_name``, and the estimate of each source among the declared zones and ``candidates``."""
    reg = registry.select(F.col(source).alias("_src"), "tz_name", "date_order").dropDuplicates(["_src"])
    joined = rows.join(reg, rows[source].eqNullSafe(reg["_src"]), "left").drop("_src")
    parsed = with_fields(joined, value, "date_order")
    # at most as many as there are names of zones
    declared = sorted(r["tz_name"] for r in reg.where(is_zone("tz_name")).select("tz_name").distinct().collect())
    tried = [z for z in dict.fromkeys([*candidates, *declared]) if z in set(zone_names())]
    guess = estimate_zones(parsed, source, utc_ms(parsed, latest), utc_ms(parsed, earliest) if earliest else None, tried)
    found = guess.limit(BROADCAST_SOURCES + 1).collect()
    if len(found) <= BROADCAST_SOURCES:
        guess = F.broadcast(rows.sparkSession.createDataFrame(found, guess.schema))
    return parsed, guess


def to_instants(
    rows: DataFrame,
    value: str,
    source: str,
    registry: DataFrame,
    latest: str,
    earliest: str | None = None,
    candidates: Sequence[str] = CANDIDATE_ZONES,
    keep: Sequence[str] = ("row_id",),
) -> DataFrame:
    """``keep`` columns and ``epoch_ms`` of each row; null where the value names no instant.

    ``registry`` has one row per source with ``tz_name`` and ``date_order`` (both may be null).
    The declared zone of a source holds; a source that is missing there, or whose zone is no known
    name, gets the estimated zone; if there is none either, its zoneless values have no instant.
    Null, blank, impossible, incomplete and relative values have none.  Rows are never dropped;
    repeated rows each get their instant.  The rows themselves are not shuffled while there are at
    most BROADCAST_SOURCES sources, however many rows one of them has.
    """
    extra = [earliest] if earliest else []
    slim = rows.select(*dict.fromkeys([*keep, value, source, latest, *extra]))
    parsed, guess = zones_of(slim, value, source, registry, latest, earliest, candidates)
    out = parsed.join(guess.select(F.col("source").alias("_est"), "estimated_zone"), F.col(source).cast("string") == F.col("_est"), "left")
    zone = F.coalesce(F.when(is_zone("tz_name"), F.col("tz_name")), F.col("estimated_zone"))
    p = F.col("p")
    instant = (
        F.when(p.isNull(), None)
        .when(p["offset_min"].isNotNull(), (p["secs"] - p["offset_min"] * 60) * 1000 + p["ms"])
        .when(p["region"].isNotNull(), local_ms(p, p["region"]))
        .when(zone.isNotNull(), local_ms(p, zone))
    )
    return out.select(*keep, instant.cast("bigint").alias("epoch_ms"))


def zone_report(rows: DataFrame, value: str, source: str, registry: DataFrame, latest: str, earliest: str | None = None, candidates: Sequence[str] = CANDIDATE_ZONES) -> DataFrame:
    """Declared zone of each source and the estimate that ``to_instants`` would use without it."""
    slim = rows.select(*dict.fromkeys([value, source, latest, *([earliest] if earliest else [])]))
    _, found = zones_of(slim, value, source, registry, latest, earliest, candidates)
    reg = registry.select(F.col(source).cast("string").alias("_src"), F.col("tz_name").alias("declared_zone")).dropDuplicates(["_src"])
    return found.join(reg, found["source"] == reg["_src"], "left").select("source", "declared_zone", "estimated_zone", "n_zoneless", "violations", "longest_lag_s")
