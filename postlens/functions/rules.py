"""Ordered rule tables and their compilation to columns.

A taxonomy is an ordered mapping of label to pattern.  Rules are compiled on the driver into
literal searches and, where these don't decide, ``rlike`` expressions; no rule table is ever joined
with texts.  Matching ignores case in all of Unicode.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FLAGS = "(?iuU)"

# The taxonomies' labels and patterns, in the order of their precedence.
STRONG_TERMS = {
    "SAP": r"\bSAP\b",
    "S/4HANA": r"\bS\s*[/.-]?\s*4\s*HANA\b|\bS4HANA\b",
    "ABAP": r"\bABAP\b",
    "SuccessFactors": r"\bSuccess\s*Factors\b|\bSuccessFactors\b",
    "Ariba": r"\bAriba\b",
    "Concur": r"\bConcur\b",
    "Fiori": r"\bFiori\b",
    "UI5": r"\bSAPUI5\b|\bUI5\b",
    "BTP": r"\bBTP\b|\bBusiness Technology Platform\b",
    "HANA": r"\bHANA\b",
    "BW/4HANA": r"\bBW\s*[/.-]?\s*4\s*HANA\b|\bBW4HANA\b",
    "BusinessObjects": r"\bBusiness\s*Objects\b|\bBOBJ\b",
    "Hybris / Commerce Cloud": r"\bHybris\b|\bSAP CX\b|\bCommerce Cloud\b",
    "ByDesign": r"\bByDesign\b",
    "Business One": r"\bBusiness One\b",
    "SAP Analytics Cloud": r"\bSAP Analytics Cloud\b|\bSAC\b",
    "SAP Basis": r"\bSAP Basis\b|\bBasis Administrator\b",
    "IDoc": r"\bIDoc[s]?\b",
}
MODULES = {
    "S/4HANA": r"\bS\s*[/.-]?\s*4\s*HANA\b|\bS4HANA\b",
    "ABAP / Development": r"\bABAP\b|\bRAP\b|\bCAP\b|\bCDS\b",
    "BTP / Integration": r"\bBTP\b|\bBusiness Technology Platform\b|\bIntegration Suite\b|\bCPI\b|\bPI/PO\b|\bIDoc[s]?\b|\bOData\b",
    "Fiori / UI5": r"\bFiori\b|\bSAPUI5\b|\bUI5\b",
    "Basis / Security": r"\bSAP Basis\b|\bBasis Administrator\b|\bGRC\b|\bauthori[sz]ation\b|\brole administration\b|\bSAP Security\b|\bsecurity consultant\b",
    "HANA / Data": r"\bHANA\b|\bBW\s*[/.-]?\s*4\s*HANA\b|\bBW4HANA\b|\bSAP BW\b|\bSAP BI\b|\bDatasphere\b|\bSAP Analytics Cloud\b|\bBusinessObjects\b",
    "FI / CO / FICO": r"\bSAP\s*(FI|CO|FICO|FI/CO)\b|\bFICO\b|\bFI/CO\b|\bSAP.{0,60}Finance\b|\bSAP.{0,60}Controlling\b",
    "MM / Procurement": r"\bSAP\s*MM\b|\bSAP.{0,70}Materials Management\b|\bSAP.{0,70}Procurement\b|\bAriba\b",
    "SD / Sales": r"\bSAP\s*SD\b|\bSAP.{0,70}Sales and Distribution\b|\bSAP.{0,70}Order to Cash\b",
    "PP / QM / Manufacturing": r"\bSAP\s*PP\b|\bSAP\s*QM\b|\bSAP.{0,70}Production Planning\b|\bSAP.{0,70}Quality Management\b",
    "EWM / WM / Logistics": r"\bSAP\s*EWM\b|\bSAP\s*WM\b|\bSAP.{0,70}Warehouse\b|\bSAP.{0,70}Logistics\b",
    "TM / GTS / Supply Chain": r"\bSAP\s*TM\b|\bSAP\s*GTS\b|\bSAP\s*IBP\b|\bSAP.{0,70}Supply Chain\b|\bSAP.{0,70}Transportation\b",
    "HCM / SuccessFactors": r"\bSAP\s*HCM\b|\bSuccess\s*Factors\b|\bSuccessFactors\b|\bSAP.{0,70}HR\b",
    "CRM / CX / Commerce": r"\bSAP\s*CRM\b|\bSAP CX\b|\bHybris\b|\bCommerce Cloud\b",
    "PM / Asset Management": r"\bSAP\s*PM\b|\bSAP.{0,70}Plant Maintenance\b|\bSAP.{0,70}Asset Management\b",
    "MDG / Master Data": r"\bSAP\s*MDG\b|\bMaster Data Governance\b",
}
NO_MODULE = "Unspecified SAP"
SKILLS = {
    "ABAP": r"\bABAP\b",
    "S/4HANA": r"\bS\s*[/.-]?\s*4\s*HANA\b|\bS4HANA\b",
    "SAP HANA": r"\bHANA\b",
    "SAP BTP": r"\bBTP\b|\bBusiness Technology Platform\b",
    "SAP Fiori": r"\bFiori\b",
    "SAPUI5 / UI5": r"\bSAPUI5\b|\bUI5\b",
    "CPI / Integration Suite": r"\bCPI\b|\bIntegration Suite\b|\bCloud Platform Integration\b",
    "PI/PO": r"\bPI/PO\b|\bSAP PI\b|\bSAP PO\b",
    "OData": r"\bOData\b",
    "CDS Views": r"\bCDS\b",
    "RAP / CAP": r"\bRAP\b|\bCAP\b",
    "IDoc": r"\bIDoc[s]?\b",
    "FICO": r"\bFICO\b|\bFI/CO\b|\bSAP FI\b|\bSAP CO\b",
    "SAP MM": r"\bSAP MM\b",
    "SAP SD": r"\bSAP SD\b",
    "SAP PP": r"\bSAP PP\b",
    "SAP QM": r"\bSAP QM\b",
    "SAP EWM": r"\bSAP EWM\b",
    "SAP TM": r"\bSAP TM\b",
    "SAP GTS": r"\bSAP GTS\b",
    "SuccessFactors": r"\bSuccess\s*Factors\b|\bSuccessFactors\b",
    "Ariba": r"\bAriba\b",
    "Concur": r"\bConcur\b",
    "SAP BW / BI": r"\bSAP BW\b|\bSAP BI\b|\bBW/4HANA\b|\bBW4HANA\b",
    "SAP Analytics Cloud": r"\bSAP Analytics Cloud\b|\bSAC\b",
    "Datasphere": r"\bDatasphere\b",
    "GRC / Security": r"\bGRC\b|\bauthori[sz]ation\b|\bSAP Security\b|\brole administration\b",
    "MDG": r"\bSAP MDG\b|\bMaster Data Governance\b",
    "Agile / Scrum": r"\bAgile\b|\bScrum\b",
    "English": r"\bEnglish\b",
    "German": r"\bGerman\b|\bDeutsch\b",
}
SOFT_SKILLS = {
    "Communication": r"\bcommunication\b|\bcommunicate\b|\bkommunikation\b",
    "Stakeholder management": r"\bstakeholder\b|\bstakeholder management\b|\bmanagement stakeholders\b",
    "Collaboration": r"\bcollaboration\b|\bcross[- ]functional\b|\bteamwork\b|\bteam player\b|\bteamf[aä]higkeit\b|\bzusammenarbeit\b",
    "Leadership": r"\bleadership\b|\blead\b|\bmentor\b|\bcoaching\b|\bführung\b|\bteamleitung\b",
    "Problem solving": r"\bproblem[- ]solving\b|\bsolve problems\b|\btroubleshoot\b|\bproblem solving\b|\bprobleml[oö]sung\b",
    "Analytical thinking": r"\banalytical\b|\banalytics?\b|\banalytisch\b|\banalyse\b",
    "Project management": r"\bproject management\b|\bprojektmanagement\b|\bproject manager\b|\bprojektleiter\b",
    "Customer orientation": r"\bcustomer[- ]centric\b|\bcustomer orientation\b|\bkundenorientierung\b|\bcustomer facing\b|\bclient facing\b",
    "Consulting mindset": r"\bconsulting\b|\bconsultant\b|\bberatung\b|\bberater\b",
    "Ownership": r"\bownership\b|\baccountability\b|\beigenverantwortung\b|\bresponsibility\b",
    "Change management": r"\bchange management\b|\btransformation\b|\bchange\b|\bver[aä]nderungsmanagement\b",
    "Presentation": r"\bpresentation\b|\bpresent\b|\bpr[aä]sentation\b|\bworkshop\b",
    "Documentation": r"\bdocumentation\b|\bdokumentation\b|\bwrite documentation\b",
    "Training": r"\btraining\b|\btrain users\b|\buser training\b|\bschulung\b|\bworkshops\b",
}
DEGREE_LEVELS = {
    "Bachelor": r"\bbachelor\b|\bb\.s\.\b|\bbsc\b|\bundergraduate\b",
    "Master": r"\bmaster\b|\bm\.s\.\b|\bmsc\b|\bgraduate degree\b",
    "MBA": r"\bMBA\b|\bmaster of business administration\b",
    "PhD": r"\bph\.?d\.?\b|\bdoctorate\b|\bdoktor\b",
    "Vocational / apprenticeship": r"\bapprenticeship\b|\bausbildung\b|\bvocational\b|\bfachinformatiker\b",
}
DEGREE_FIELDS = {
    "Computer Science / Informatics": r"\bcomputer science\b|\binformatics\b|\binformatik\b|\binformation technology\b|\bIT\b",
    "Business / Economics": r"\bbusiness administration\b|\bbetriebswirtschaft\b|\beconomics\b|\bwirtschaft\b|\bBWL\b",
    "Information Systems": r"\binformation systems\b|\bbusiness informatics\b|\bwirtschaftsinformatik\b",
    "Engineering": r"\bengineering\b|\bengineer\b|\bingenieur\b|\bmaschinenbau\b|\belectrical engineering\b",
    "Finance / Accounting": r"\bfinance\b|\baccounting\b|\bcontrolling\b|\bfinanzen\b|\brechnungswesen\b",
    "Logistics / Supply Chain": r"\blogistics\b|\bsupply chain\b|\blogistik\b",
    "Mathematics / Statistics": r"\bmathematics\b|\bstatistics\b|\bmathematik\b|\bstatistik\b",
}
# Ordered first-match rules; a rule is (label, the input it looks at, pattern).
ROLE_RULES = (
    ("Project / Program", "title", r"\b(program|project|delivery|engagement)\s+manager\b|\bproduct owner\b|\bscrum master\b"),
    ("Architecture", "title", r"\barchitect\b|\bsolution architect\b|\benterprise architect\b"),
    ("Basis / Security", "text", r"\bsap basis\b|\bbasis administrator\b|\bsap security\b|\bauthori[sz]ation\b|\bgrc\b|\brole administration\b"),
    ("Technical / Development", "text", r"\babap\b|\bdeveloper\b|\bengineer\b|\bfiori\b|\bui5\b|\bintegration\b|\bbtp\b|\bcpi\b|\bpi/po\b"),
    ("Data / Analytics", "text", r"\bdata\b|\banalytics\b|\bbw\b|\bbi\b|\bhana\b|\bsac\b|\bdatasphere\b"),
    ("Functional Consulting", "text", r"\bconsultant\b|\bfunctional\b|\bbusiness analyst\b|\bprocess\b"),
    ("Support / Operations", "text", r"\bsupport\b|\boperations\b|\badministrator\b"),
)
OTHER_ROLE = "Other SAP-Related"
SENIORITY_RULES = (
    ("Entry / Intern", "sample", r"\bintern(ship)?\b|\btrainee\b|\bgraduate\b|\bentry[- ]level\b"),
    ("Junior", "sample", r"\bjunior\b|\bassociate\b"),
    ("Lead / Manager", "sample", r"\bprincipal\b|\bstaff\b|\blead\b|\bhead\b|\bdirector\b|\bmanager\b"),
    ("Senior", "sample", r"\bsenior\b|\bsr\.?\b|\bexpert\b|\b[5-9]\+?\s+years\b|\b10\+?\s+years\b"),
)
NO_SENIORITY = "Mid / Unspecified"
# Patterns of titles, mentions of the product as a tool, and pay.
TITLE_CORE = r"\bsap\b|\babap\b|\bs/4hana\b|\bs4hana\b|\bsuccessfactors\b|\bariba\b|\bfiori\b|\bui5\b|\bbtp\b|\bhana\b"
TITLE_DELIVERY = r"\bconsultant\b|\bdeveloper\b|\bengineer\b|\barchitect\b|\badministrator\b|\bspecialist\b|\banalyst\b|\bsupport\b|\bmanager\b|\blead\b"
TOOL_PHRASES = r"\bexperience with SAP\b|\bSAP experience\b|\bSAP knowledge\b|\bSAP system\b|\bSAP ERP\b"
PAY_PHRASE = r"\b(salary|compensation|pay range|base pay)\b.{0,80}[$€£]\s?\d"
# Named search filters as (seconds back, work model).
SEARCH_FILTERS = {
    "all": (None, None),
    "past_24h": (86400, None),
    "past_week": (604800, None),
    "past_month": (2592000, None),
    "onsite": (None, "onsite"),
    "remote": (None, "remote"),
    "hybrid": (None, "hybrid"),
    "past_week_remote": (604800, "remote"),
    "past_week_hybrid": (604800, "hybrid"),
}
# Page labels that stand where a place should.
NO_PLACE_TEXT = r"applicants|views|reposted|promoted"
# Words and tokens that are no terms of a description.
STOP_WORDS = [
    "about", "across", "also", "and", "are", "auf", "aus", "bei", "can", "companies", "company", "customers",
    "das", "der", "die", "ein", "eine", "for", "from", "für", "has", "have", "ich", "im",
    "in", "ist", "job", "join", "location", "looking", "mit", "not", "of", "on", "or", "our",
    "people", "role", "sap", "services", "sie", "that", "the", "their", "this", "und", "von", "we",
    "will", "with", "world", "description", "position", "seeking", "you", "your", "zum", "zur",
]
STOP_TOKENS = ("m/w/d", "w/m/d", "d/m/w", "full-time", "remote")
# Cities that stand for their country, and other names of places.
CITY_COUNTRY = {
    "Berlin": "Germany", "Bochum": "Germany", "Cologne": "Germany", "Dingolfing": "Germany", "Dresden": "Germany",
    "Düsseldorf": "Germany", "Essen": "Germany", "Gudow": "Germany", "Hamm": "Germany", "Heidelberg": "Germany",
    "Langen": "Germany", "Lübeck": "Germany", "Mannheim": "Germany", "Munich": "Germany", "Paderborn": "Germany",
    "Remscheid": "Germany", "Solingen": "Germany", "Stuttgart": "Germany", "Sömmerda": "Germany", "Waiblingen": "Germany",
    "Wangen im Allgäu": "Germany", "Wetzlar": "Germany",
}
PLACE_ALIASES = {
    "USA": "United States", "US": "United States", "U.S.": "United States", "U.S.A.": "United States", "United States of America": "United States",
    "United States Of America": "United States", "United States timezones": "United States", "UK": "United Kingdom", "U.K.": "United Kingdom",
    "American timezones": "Americas", "European timezones": "Europe", "LATAM": "Latin America", "EU": "Europe",
    "EMEA": "Europe / Middle East / Africa", "APAC": "Asia-Pacific", "Czech Republic": "Czechia",
}


# --- compilation --------------------------------------------------------------------------------

_TOKEN = re.compile(r"(\\[a-zA-Z]|\[[^\]]*\]|\\.|\.|[^\\])([?*+]|\{\d+(?:,\d*)?\})?")
#: Literal forms that a branch is written out to at most; one with more is searched for by parts of it.
MOST_FORMS = 64
#: Stands for what is not literal in a form.
_GAP = "\0"


def _split_top(pattern: str) -> list[str]:
    """Alternatives of a pattern, parted at bars outside of brackets and groups."""
    parts, depth, start, i = [], 0, 0, 0
    while i < len(pattern):
        c = pattern[i]
        if c == "\\":
            i += 1
        elif c == "[":
            i = pattern.index("]", i + 1)
        elif c in "()":
            depth += 1 if c == "(" else -1
        elif c == "|" and not depth:
            parts.append(pattern[start:i])
            start = i + 1
        i += 1
    return [*parts, pattern[start:]]


def _ungrouped(branch: str) -> list[str]:
    """The branch with each group of alternatives replaced by one of them in turn, an optional group also by nothing."""
    found = re.search(r"\((?:\?:)?([^()]*)\)([?*]?)", branch)
    if not found:
        return [branch]
    inner = [*_split_top(found[1]), *([""] if found[2] else [])]
    return [x for part in inner for x in _ungrouped(branch[: found.start()] + part + branch[found.end() :])]


def _choices(token: str, often: str) -> list[str]:
    """What a token can stand for: itself, each member of a small class, a blank for white space; _GAP for anything."""
    if token == r"\b":
        return [r"\b"]
    if token == r"\s":
        made = [" "]
    elif token[0] == "[":
        made = list(token[1:-1].replace("\\", "")) if len(token) <= 6 and not re.search(r"\w-\w", token) else [_GAP]
    elif token[0] == "\\":
        made = [token[1]] if not token[1].isalnum() else [_GAP]
    else:
        made = [_GAP] if token == "." else [token]
    if often in ("?", "*"):
        return ["", *made] if often == "?" or token == r"\s" else [_GAP]
    if often and (often[0] == "{" or token != r"\s"):
        return [_GAP]
    return made


def forms(branch: str) -> list[str]:
    """A branch written out: strings of literals, word edges and gaps of which every match is one."""
    out: list[str] = []
    for one in _ungrouped(branch):
        made = [""]
        for token, often in _TOKEN.findall(one):
            made = [m + c for m in made for c in _choices(token, often)]
            if len(made) > MOST_FORMS:
                made = [_GAP.join(re.split(r"\\s\*|\[[^\]]*\][?*+]?|.[?*+]|\.?\{[\d,]+\}|[.]", one)).replace("\\.", ".")]
                break
        out += made
    return list(dict.fromkeys(out))


def needed(form: str) -> tuple[list[str], list[str]]:
    """(words, strings): what the words of a text, and its word line, hold wherever the form matches."""
    words, strings = [], []
    for part in re.split(_GAP + "+", form):
        line = re.sub(r"\W+", " ", part.replace(r"\b", "").lower())
        begins, ends = part.startswith(r"\b") or line.startswith(" "), part.endswith(r"\b") or line.endswith(" ")
        pieces = line.split()
        for i, w in enumerate(pieces):
            whole = (i > 0 or begins) and (i < len(pieces) - 1 or ends)
            if whole:
                words.append(w)
            elif len(w) > 1:
                strings.append((" " if i > 0 or begins else "") + w + (" " if i < len(pieces) - 1 or ends else ""))
    return words, strings


def _single_word(form: str) -> str | None:
    """The word of a form that is nothing but one word."""
    found = re.fullmatch(r"\\b(\w+)\\b", form)
    return found[1].lower() if found else None


def _vocabulary() -> set[str]:
    """Whole words that the rule tables of this module look for."""
    patterns = [p for table in (STRONG_TERMS, MODULES, SKILLS, SOFT_SKILLS, DEGREE_LEVELS, DEGREE_FIELDS) for p in table.values()]
    patterns += [p for table in (ROLE_RULES, SENIORITY_RULES) for _, _, p in table] + [TITLE_CORE, TITLE_DELIVERY, TOOL_PHRASES, PAY_PHRASE]
    return {w for p in patterns for branch in _split_top(p) for form in forms(branch) for w in needed(form)[0]}


VOCABULARY = frozenset(_vocabulary())


def word_line(text: Column) -> Column:
    """``all``: a text's words in lower case with single blanks around each; ``known``: those of them in VOCABULARY.

    Rules are looked up in them.  Letters that match others when case is ignored, though they aren't
    their lower case, are exchanged.
    """
    folded = F.lower(F.translate(F.coalesce(text, F.lit("")), "ſİı", "sii"))
    line = F.concat(F.lit(" "), F.regexp_replace(folded, r"(?U)\W+", " "), F.lit(" "))
    known = F.array_intersect(F.split(line, " "), F.lit(sorted(VOCABULARY)))
    return F.struct(line.alias("all"), F.concat(F.lit(" "), F.array_join(known, " "), F.lit(" ")).alias("known"))


def with_lines(rows: DataFrame, lines: Mapping[str, Column]) -> DataFrame:
    """``rows`` with the word lines of texts, each worked out once per row.

    The optimizer would copy a line's expression into every condition that is pushed below it or
    merged with it; it leaves expressions alone that hold a random part (which is never used here).
    """
    return rows.withColumns({name: F.when(F.rand(0) >= 0, word_line(value)) for name, value in lines.items()})


def _joined(op, conditions: list[Column]) -> Column:
    """Conditions joined by an operator as a tree of little depth, which the code generator can take."""
    while len(conditions) > 1:
        pairs = [conditions[i : i + 2] for i in range(0, len(conditions), 2)]
        conditions = [reduce(op, p) for p in pairs]
    return conditions[0]


def matches(text: Column, pattern: str, line: Column | None = None) -> Column:
    """Whether the pattern occurs, case ignored; false for a null text.

    ``line`` is the text's word line; it pays to work it out once for all rules of a text.  An
    alternative that is one word in every form is looked up among the words.  Any other is searched
    for as an expression, but only where the line holds the words and strings that it needs; so
    most rules cost a few searches in a short string.
    """
    return _found(text, [pattern], word_line(text) if line is None else line)


def _holds(line: Column, sets: Sequence[tuple[tuple[str, ...], tuple[str, ...]]]) -> Column:
    """Whether the line holds all words and strings of any of the sets; those of known words only are one search."""
    plain = [words for words, strings in sets if not strings and all(w in VOCABULARY for w in words)]
    other = [(words, strings) for words, strings in sets if words not in plain or strings]
    has_word = lambda w: line["known" if w in VOCABULARY else "all"].contains(f" {w} ")
    tests = [_joined(and_, [*map(has_word, words), *(line["all"].contains(x) for x in strings)]) for words, strings in other]
    if plain:
        tests.append(line["known"].rlike("^(?:" + "|".join("".join(f"(?=.* {w} )" for w in words) for words in plain) + ")"))
    return _joined(or_, tests)


def _found(text: Column, patterns: Sequence[str], line: Column) -> Column:
    words: dict[str, list[str]] = {"known": [], "all": []}
    rest: list[str] = []
    sets: dict[tuple, None] = {}
    for branch in (b for p in patterns for b in _split_top(p)):
        made = forms(branch)
        single = [_single_word(f) for f in made]
        if all(single):
            for w in single:
                words["known" if w in VOCABULARY else "all"].append(w)
        else:
            rest.append(branch)
            sets.update(dict.fromkeys((tuple(dict.fromkeys(needs)), tuple(strings)) for needs, strings in map(needed, made)))
    tests = [line[name].rlike(f" (?:{'|'.join(dict.fromkeys(found))}) ") if len(found) > 1 else line[name].contains(f" {found[0]} ") for name, found in words.items() if found]
    if rest:
        found = text.rlike(FLAGS + "|".join(rest))
        tests.append(_holds(line, list(sets)) & found if all(a or b for a, b in sets) else found)
    return F.coalesce(_joined(or_, tests), F.lit(False))


def tags(text: Column, rules: Mapping[str, str], default: str | None = None, line: Column | None = None) -> Column:
    """Labels of all rules that match, in the rules' order; ``[default]`` if none does (empty without a default)."""
    line = word_line(text) if line is None else line
    found = F.array_compact(F.array(*[F.when(matches(text, p, line), F.lit(label)) for label, p in rules.items()]))
    return found if default is None else F.when(F.size(found) == 0, F.array(F.lit(default))).otherwise(found)


def any_match(text: Column, rules: Mapping[str, str], line: Column | None = None) -> Column:
    """Whether any rule matches; the rules after the first that does aren't tried."""
    line = word_line(text) if line is None else line
    return _found(text, list(rules.values()), line)


def first_match(rules: Sequence[tuple[str, str, str]], inputs: Mapping[str, Column], default: str, lines: Mapping[str, Column] | None = None) -> Column:
    """Label of the first rule whose input matches; the order of the rules is their meaning."""
    lines = {k: word_line(v) for k, v in inputs.items()} if lines is None else lines
    out = F.lit(default)
    for label, source, pattern in reversed(rules):
        out = F.when(matches(inputs[source], pattern, lines[source]), F.lit(label)).otherwise(out)
    return out


def lookup(value: Column, pairs: Mapping[str, str]) -> Column:
    """The value's entry in a small fixed table, or the value itself."""
    out = value
    for target in dict.fromkeys(pairs.values()):
        out = F.when(value.isin(*[k for k, v in pairs.items() if v == target]), F.lit(target)).otherwise(out)
    return out
