"""Compiled rules against Python's re on texts made of the rules' own words, glued in every way."""

import random
import re

from pyspark.sql import functions as F

from postlens.functions import rules

TABLES = (rules.STRONG_TERMS, rules.MODULES, rules.SKILLS, rules.SOFT_SKILLS, rules.DEGREE_LEVELS, rules.DEGREE_FIELDS)
ORDERED = (rules.ROLE_RULES, rules.SENIORITY_RULES)


def texts() -> list[str]:
    rng = random.Random(11)
    pool = [*sorted(rules.VOCABULARY), "procurement", "warehouse", "hr", "order", "sales", "supply", "x", "ſap", "SAPİ", "7", "5", "years", "b.s.c", "ph.d.", "9+", "pay range $ 5"]
    glue = (" ", " ", " ", "-", "/", ", ", ". ", "_", "", "'s ", "­", "é", "  ")
    made = []
    for _ in range(1500):
        parts = [rng.choice((str.lower, str.upper, str.title, str))(rng.choice(pool)) + rng.choice(glue) for _ in range(rng.randint(1, 9))]
        made.append("".join(parts))
    return ["", "SAP", "S / 4 HANA", "s4hana s/4-hana", "SAP " + "x" * 69 + " logistics", "SAP " + "x" * 80 + " logistics", *made]


def test_compiled_rules_match_as_expressions_do(spark):
    given = texts()
    df = spark.createDataFrame([(i, t) for i, t in enumerate([*given, None])], "i int, t string")
    patterns = [*dict.fromkeys(p for table in TABLES for p in table.values()), *dict.fromkeys(p for table in ORDERED for _, _, p in table), rules.TITLE_CORE, rules.TITLE_DELIVERY, rules.TOOL_PHRASES, rules.PAY_PHRASE, rules.NO_PLACE_TEXT, r"\bunlisted\b|\bword \w+ here\b"]
    lined = rules.with_lines(df, {"line": F.col("t")})
    got = {r["i"]: r["m"] for r in lined.select("i", F.array(*[rules.matches(F.col("t"), p, F.col("line")) for p in patterns]).alias("m")).collect()}
    for i, t in enumerate(given):
        want = [re.search(p, t, re.IGNORECASE) is not None for p in patterns]
        assert got[i] == want, (t, [p for p, a, b in zip(patterns, got[i], want, strict=True) if a != b])
    assert not any(got[len(given)])


def test_tags_of_known_texts(spark):
    """Expected labels, written out."""
    cases = {
        "SAP FI/CO consultant, S/4HANA and ABAP": (["S/4HANA", "ABAP / Development", "FI / CO / FICO"], ["ABAP", "S/4HANA", "FICO"]),
        "SAP MM with Ariba; agile team": (["MM / Procurement"], ["SAP MM", "Ariba", "Agile / Scrum"]),
        "SAP knowledge in procurement is welcome": (["MM / Procurement"], []),
        "Data entry, fluent English": ([], ["English"]),
        "SuccessFactors / Success Factors": (["HCM / SuccessFactors"], ["SuccessFactors"]),
    }
    df = spark.createDataFrame(list(enumerate(cases)), "i int, t string")
    rows = df.select("i", rules.tags(F.col("t"), rules.MODULES).alias("m"), rules.tags(F.col("t"), rules.SKILLS).alias("s")).collect()
    assert {list(cases)[r["i"]]: (r["m"], r["s"]) for r in rows} == cases


def test_roles_and_levels_of_known_titles(spark):
    cases = {
        "Program Manager SAP": ("Project / Program", "Lead / Manager"), "SAP Solution Architect": ("Architecture", "Mid / Unspecified"), "Senior ABAP Developer": ("Technical / Development", "Senior"),
        "Junior SAP FI Consultant": ("Functional Consulting", "Junior"), "Internship SAP Security": ("Basis / Security", "Entry / Intern"), "Night guard": ("Other SAP-Related", "Mid / Unspecified"),
    }
    df = spark.createDataFrame(list(enumerate(cases)), "i int, t string")
    t = F.col("t")
    rows = df.select("i", rules.first_match(rules.ROLE_RULES, {"title": t, "text": t}, rules.OTHER_ROLE).alias("r"), rules.first_match(rules.SENIORITY_RULES, {"sample": t}, rules.NO_SENIORITY).alias("s")).collect()
    assert {list(cases)[x["i"]]: (x["r"], x["s"]) for x in rows} == cases
