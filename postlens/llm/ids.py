"""Posting numbers and the last parts of addresses, shared by problems 4 and 6."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The number in an address: a parameter that names the posting, else the end of the path.
_IN_PATH = r"(?i)^[^?#]*?(?:/|-)(\d{10})/*(?:[?#].*)?$"
_IN_QUERY = r"(?i)[?&](?:currentJobId|jobId|id)=(\d{10})(?:[&#].*)?$"


def _filled(c: Column) -> Column:
    return F.when(F.regexp_replace(c, r"(?U)[\s​﻿]+", "") != "", c)


def posting_number(job_id: Column, url: Column) -> Column:
    """The ten-digit number however it is written in the id; from the url if the id is null or blank.

    Accepted in an id: leading zeros, thousands separators, a trailing ``.0``, prefixes.  Null if
    neither has one.
    """
    given = _filled(job_id)
    digits = F.regexp_replace(F.regexp_replace(F.trim(given), r"(?U)\.0+\s*$", ""), r"[^0-9]", "")
    from_id = F.regexp_extract(digits, r"^0*([1-9]\d{9})$", 1)
    clean = F.regexp_replace(url, r"(?U)[\s​﻿]+", "")
    from_url = F.coalesce(F.nullif(F.regexp_extract(clean, _IN_QUERY, 1), F.lit("")), F.nullif(F.regexp_extract(clean, _IN_PATH, 1), F.lit("")))
    return F.when(given.isNull(), from_url).otherwise(F.nullif(from_id, F.lit("")))


def last_part(url: Column) -> Column:
    """Last part of the url's path in lower case, without parameters and fragment; null if there is none."""
    clean = F.lower(F.regexp_replace(url, r"(?U)[\s​﻿]+", ""))
    path = F.regexp_replace(F.regexp_replace(clean, r"[?#].*$", ""), r"^[a-z][a-z0-9+.-]*://[^/]*", "")
    return F.nullif(F.regexp_extract(path, r"([^/]+)/*$", 1), F.lit(""))
