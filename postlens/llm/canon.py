"""Mapping of typed values to a reference list by a prefix-filter set-similarity join (problem 5).

Strings are compared as sets, of letter pairs and letters or, for abbreviations, of consonants.
Their elements are put in one global order, the rarest in the reference list first; two sets that
are similar enough share an element of their first, rare part, so only those prefixes are joined.
The length filter and the positional filter drop most candidates, the Jaccard similarity of the rest
is worked out exactly.

A location is cut into pieces at its separators, and pieces and neighbouring pieces are joined with
the names of places; a title is cut into words, the words are joined with the words of the listed
titles, and the title as a whole with their names.  Values that are cut into the same pieces or words
are decided once, from these matches only: each must stand an exact check (a misspelling of a
letter or two, or an abbreviation), then the fewest edits win, then the highest similarity.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache
from math import ceil

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Words that add a rank, work model, contract or the like and change no meaning.
TITLE_ADDITIONS = """senior sr junior jr principal lead expert mid level freelance freelancer intern trainee staff
 remote hybrid onsite homeoffice home office full part time fulltime parttime teilzeit vollzeit permanent contract temporary befristet unbefristet
 all genders gn urgent new hiring now dringend asap s4hana m w d f x i n and"""
PLACE_ADDITIONS = """remote hybrid onsite on site home office homeoffice greater area metropolitan metro region only hq headquarters near based in office
 fully possible partly wfh"""

_FOLD = str.maketrans({"ß": "ss", "æ": "ae", "ø": "o", "œ": "oe", "đ": "d", "ł": "l", "ı": "i"})
_INVISIBLE = re.compile("[­​-‏⁠﻿]")
_SEPARATOR = re.compile(r"[,;/|():\[\]•·]+|\s+[-–—]+\s+|\s+(?:and|or|und|oder|et|ou)\s+")
_MODULES = ((re.compile(r"\bfi\s*[/-]\s*co\b"), "fico"), (re.compile(r"\bbw\s*/?\s*4\s*hana\b"), "bw4hana"), (re.compile(r"\bs\s*/?\s*4\s*-?\s*hana\b"), "s4hana"))


def fold(text: str) -> str:
    """Lower case without accents, invisible characters and repeated blanks."""
    if text.isascii():
        return " ".join(text.replace("_", " ").lower().split())
    text = unicodedata.normalize("NFKD", _INVISIBLE.sub("", text).replace("_", " ")).casefold().translate(_FOLD)
    return " ".join("".join(c for c in text if not unicodedata.combining(c)).split())


def grams(text: str) -> list[str]:
    """Set of letter pairs (with the ends) and of numbered letters; blanks don't count."""
    s = text.replace(" ", "")
    padded = f"^{s}$"
    pairs, seen, out = {padded[i : i + 2] for i in range(len(padded) - 1)}, {}, []
    for c in s:
        seen[c] = seen.get(c, 0) + 1
        out.append(f"{c}{seen[c]}")
    return sorted(pairs) + out


def skeleton(text: str) -> list[str]:
    """Set of the first letter and the numbered consonants behind it: what an abbreviation keeps."""
    seen: dict[str, int] = {}
    out = [f"^{text[:1]}"]
    for c in text[1:]:
        if c not in "aeiouy":
            seen[c] = seen.get(c, 0) + 1
            out.append(f"{c}{seen[c]}")
    return out


def title_words(text: str) -> list[str]:
    """Words of a title without additions and numbers."""
    text = fold(text)
    for pattern, name in _MODULES:
        text = pattern.sub(name, text)
    found = re.findall(r"[^\W_]+", text)
    drop = set(TITLE_ADDITIONS.split())
    return [w for w in dict.fromkeys(found) if w not in drop and not w.isdigit()]


def place_pieces(text: str) -> list[str]:
    """Pieces of a location without additions; each is a run of letters and blanks."""
    drop, out = set(PLACE_ADDITIONS.split()), []
    for piece in _SEPARATOR.split(fold(text)):
        words = [w for w in re.findall(r"[^\W\d_]+", re.sub(r"\b(\w)\.(?=\w\.)", r"\1", piece or "")) if w]
        kept = [w for w in words if w not in drop] if words != ["in"] else words
        if kept:
            out.append(" ".join(kept))
    return out


def spans(pieces: list[str]) -> list[tuple[int, int, str]]:
    """(first, last + 1, text) of each piece, each pair and triple of neighbours."""
    return [(i, j, " ".join(pieces[i:j])) for i in range(len(pieces)) for j in range(i + 1, min(len(pieces), i + 3) + 1)]


def osa(a: str, b: str) -> int:
    """Edits between two strings: letters added, missing, changed, or neighbours exchanged."""
    before, row = None, list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            best = min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (x != y))
            if before is not None and j > 1 and x == b[j - 2] and a[i - 2] == y:
                best = min(best, before[j - 2] + 1)
            new.append(best)
        before, row = row, new
    return row[-1]


@lru_cache(200_000)
def place_distance(typed: str, name: str) -> int | None:
    """Edits if the typed piece can be a misspelling of the name, else null; codes must be exact."""
    a, b = typed.replace(" ", ""), name.replace(" ", "")
    if a == b:
        return 0
    most = 0 if len(b) <= 2 or len(a) < 3 else 1 if len(b) <= 7 else 2
    if abs(len(a) - len(b)) > most:
        return None
    d = osa(a, b)
    return d if d <= most else None


@lru_cache(200_000)
def word_distance(typed: str, word: str) -> int | None:
    """0 for the word or its abbreviation, the edits of a misspelling, else null.

    Two letters must be exact but for one added, three may have one changed or added, so that one
    module is never taken for another.
    """
    if typed == word:
        return 0
    if any(c.isdigit() for c in word) and len(word) < 5:
        return None
    if len(word) <= 3:
        inside = all(c in it for it in [iter(typed)] for c in word)
        if len(typed) == len(word) + 1 and inside:
            return 1
        return 1 if len(word) == 3 and (len(typed) == 3 or word == "sap" and len(typed) == 2) and osa(typed, word) == 1 else None
    most = 1 if len(word) <= 7 else 2
    if len(typed) >= 4 and abs(len(typed) - len(word)) <= most and (d := osa(typed, word)) <= most:
        return d
    letters = iter(word)
    if 3 <= len(typed) <= len(word) - 2 and typed[0] == word[0] and all(c in letters for c in typed):
        return 0
    return None


# --- the join -------------------------------------------------------------------------------


#: Reference strings up to this number are broadcast (about 20 MB); the optimizer decides beyond.
BROADCAST_STRINGS = 20_000


def similar_strings(left: DataFrame, right: DataFrame, similarity: float, elements: Callable[[str], list[str]] = grams, most: int = 1_000_000) -> DataFrame:
    """``left``, ``right``, ``jaccard`` of all pairs of the distinct strings in column ``s`` at or above the similarity.

    ``elements`` makes the sets.  The global order follows the right side, a reference list of at most
    ``most`` strings: its rarest elements first, elements that it lacks before all.  The order has one
    entry per different element, so it goes to every worker, and each left string is ordered and
    cut to its prefix where it is read; only prefix elements that the list has are joined.  A pair
    is taken at its first shared element, so that none comes twice.  Null and empty strings match
    nothing.
    """
    some = lambda side: side.where("s IS NOT NULL AND s != ''").select("s").distinct()
    names = [r["s"] for r in _listed(some(right), most)]
    often = Counter(g for n in names for g in elements(n))
    place = {g: k for k, g in enumerate(sorted(often, key=lambda g: (often[g], g)))}

    def ordered(s: str) -> tuple[list[int], int, int]:
        """Places of a string's elements in the global order, size of its set, and elements of its prefix that are in the list."""
        found = elements(s)
        known = sorted(place[g] for g in found if g in place)
        n = len(found)
        return known, n, max(0, n - ceil(n * similarity - 1e-9) + 1 - (n - len(known)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            strings = batch.column(0).to_pylist()
            made = [ordered(s) for s in strings]
            kept = [k for k, m in enumerate(made) if m[2]]
            columns = [pa.array([strings[k] for k in kept], pa.string()), *(pa.array([made[k][j] for k in kept], t) for j, t in enumerate((pa.list_(pa.int32()), pa.int32(), pa.int32())))]
            yield pa.RecordBatch.from_arrays(columns, ["s", "g", "n", "p"])

    schema = "s string, g array<int>, n int, p int"
    listed = left.sparkSession.createDataFrame([(s, *m) for s in names if (m := ordered(s))[2]], schema)
    prefix = lambda side: side.select("*", F.posexplode(F.slice("g", F.lit(1), F.col("p"))).alias("k", "element"))
    a, b = prefix(some(left).mapInArrow(run, schema)), prefix(listed)
    met = a.alias("a").join((F.broadcast(b) if len(names) <= BROADCAST_STRINGS else b).alias("b"), F.col("a.element") == F.col("b.element"))
    na, nb, ga, gb = F.col("a.n"), F.col("b.n"), F.col("a.g"), F.col("b.g")
    # what stands before the shared element: elements that the list lacks, and k others
    at_a, at_b = na - F.size(ga) + F.col("a.k"), nb - F.size(gb) + F.col("b.k")
    need = F.ceil((na + nb) * (similarity / (1 + similarity)) - 1e-9)
    likely = (nb >= na * similarity - 1e-9) & (na >= nb * similarity - 1e-9) & (1 + F.least(na - at_a - 1, nb - at_b - 1) + F.least(at_a, at_b) >= need)
    first = ~F.arrays_overlap(F.slice(ga, F.lit(1), F.col("a.k")), F.slice(gb, F.lit(1), F.col("b.k")))
    pairs = met.where(likely & first).select(F.col("a.s").alias("left"), F.col("b.s").alias("right"), (na + nb).alias("both"), F.size(F.array_intersect(ga, gb)).alias("shared"))
    return pairs.select("left", "right", (F.col("shared") / (F.col("both") - F.col("shared"))).alias("jaccard")).where(F.col("jaccard") >= similarity - 1e-9)


def _listed(rows: DataFrame, most: int) -> list:
    """All rows of a list, which must have ``most`` rows at most."""
    found = rows.limit(most + 1).collect()
    if len(found) > most:
        raise ValueError(f"the reference list has more than {most} entries")
    return found


# --- meaning --------------------------------------------------------------------------------


@dataclass(frozen=True)
class Entry:
    ref_id: int
    names: tuple[str, ...]
    kind: str = ""
    country: str = ""


def place_entries(rows: list) -> list[Entry]:
    """Entries of a list of places; a country's code is one of its names."""
    out = []
    for r in rows:
        names = [r["name"], *(r["alt_names"] or [])]
        out.append(Entry(r["ref_id"], tuple(dict.fromkeys(" ".join(place_pieces(n)) for n in names)), r["kind"] or "", r["country"] or ""))
        if r["kind"] == "country" and r["country_code"]:
            out[-1] = Entry(r["ref_id"], (*out[-1].names, fold(r["country_code"])), "country", r["country"] or r["name"])
    return out


def title_entries(rows: list) -> list[Entry]:
    return [Entry(r["ref_id"], tuple(dict.fromkeys(" ".join(title_words(n)) for n in [r["name"], *(r["alt_names"] or [])]))) for r in rows]


class Places:
    """Decides what a location's pieces mean; holds the entries by name."""

    def __init__(self, entries: Sequence[Entry]):
        self.by_name: dict[str, list[Entry]] = {}
        for e in entries:
            for n in e.names:
                self.by_name.setdefault(n, []).append(e)

    def names(self) -> list[str]:
        return sorted(self.by_name)

    def meant(self, pieces: list[str], similar: dict[str, list[tuple[str, float]]]) -> list[int]:
        """Entries that a location names: its cities, else its countries, else its regions; [-1] for none.

        ``similar`` gives the names similar to each span with their similarity.  Longer spans win, then
        fewer edits, then the higher similarity.  A city's name that several countries have is decided
        by a country named beside it; without one it means no entry.
        """
        options = []
        for i, j, text in spans(pieces):
            found = []
            for name, jaccard in similar.get(text, []):
                d = place_distance(text, name)
                if d is not None:
                    found.append((d, -jaccard, name))
            if found:
                found.sort()
                options.append((-(j - i), found[0][0], found[0][1], i, j, [n for d, _, n in found if d == found[0][0]]))
        # a span is no misspelling of a name that it holds in full beside other pieces
        exact = {o[3] for o in options if o[0] == -1 and o[1] == 0}
        options = [o for o in options if o[0] == -1 or o[1] == 0 or not exact & set(range(o[3], o[4]))]
        taken, matched = set(), []
        for _, d, _, i, j, names in sorted(options, key=lambda o: (o[0], o[1], o[2], o[3])):
            if not taken & set(range(i, j)):
                taken |= set(range(i, j))
                matched.append((i, d, names))
        hits = [(i, [e for n in names for e in self.by_name[n]], names) for i, _, names in sorted(matched)]
        countries = {e.country or e.names[0] for _, es, _ in hits for e in es if e.kind == "country"}
        cities: list[int] = []
        for _, es, names in hits:
            mine = [e for e in es if e.kind == "city"]
            if not mine or any(e.kind == "country" for e in es if e.names and names[0] in e.names):
                continue
            fitting = [e for e in mine if e.country in countries] or mine
            first = [e for e in fitting if names[0] in e.names] if len({e.ref_id for e in fitting}) > 1 else fitting
            fitting = first or fitting
            if len({e.ref_id for e in fitting}) == 1 and fitting[0].ref_id not in cities:
                cities.append(fitting[0].ref_id)
        if cities:
            return cities
        for kind in ("country", "region"):
            ids = list(dict.fromkeys(next(e.ref_id for e in es if e.kind == kind) for _, es, _ in hits if any(e.kind == kind for e in es)))
            if ids:
                return ids
        return [-1]


#: Marks a title as a whole, its words joined, among the strings of a title.
WHOLE = "="


class Titles:
    """Decides what a title's words mean; holds the names by word and by all their letters."""

    def __init__(self, entries: Sequence[Entry]):
        self.all = [(e.ref_id, n.split()) for e in entries for n in e.names]
        self.by_word: dict[str, list[int]] = {}
        self.by_letters: dict[str, list[int]] = {}
        for k, (_, words) in enumerate(self.all):
            self.by_letters.setdefault("".join(words), []).append(k)
            for w in set(words):
                self.by_word.setdefault(w, []).append(k)

    def words(self) -> list[str]:
        return sorted(self.by_word)

    def letters(self) -> list[str]:
        return sorted(self.by_letters)

    def meant(self, typed: list[str], similar: dict[str, list[tuple[str, float]]]) -> list[int]:
        """The entry with the same words as a title, additions aside; [-1] for none.

        Every word of the value must match a word of the entry's name and the other way round; a name
        with a word more or less may have the same letters but for one.  Only names that hold a
        match of every word, or that are similar as a whole, are looked at; of several entries the
        one with the fewest edits wins, then the highest similarity, then the smallest id.
        """
        options = [{n: (d, -j) for n, j in similar.get(w, []) if (d := word_distance(w, n)) is not None} for w in typed]
        best: tuple | None = None
        if typed and all(options):
            for k in set.intersection(*({k for n in o for k in self.by_word[n]} for o in options)):
                ref, words = self.all[k]
                cost = assign(options, words) if len(words) == len(typed) else None
                if cost is not None and (best is None or (*cost, ref) < best):
                    best = (*cost, ref)
        a = "".join(typed)
        for b, _ in similar.get(WHOLE + a, []):
            if min(len(a), len(b)) >= 8 and (d := osa(a, b)) <= 1:
                for ref, words in (self.all[k] for k in self.by_letters[b]):
                    if abs(len(words) - len(typed)) == 1 and (best is None or (d, 0.0, ref) < best):
                        best = (d, 0.0, ref)
        return [best[2]] if best and best[0] <= 2 else [-1]


def assign(options: list[dict[str, tuple[int, float]]], words: list[str]) -> tuple[int, float] | None:
    """Least (edits, minus similarity) of a one-to-one assignment of typed words to a name's words; null if there is none.

    The typed words are placed one by one; of all ways to use the same words of the name only the
    best is kept, so the work is bounded by the name's words.
    """
    ways = {0: (0, 0.0)}
    for o in options:
        after: dict[int, tuple[int, float]] = {}
        for used, (d, j) in ways.items():
            for k, w in enumerate(words):
                if w in o and not used >> k & 1:
                    cost, now = (d + o[w][0], j + o[w][1]), used | 1 << k
                    if now not in after or cost < after[now]:
                        after[now] = cost
        ways = after
    return min(ways.values()) if ways else None


#: Least similarity in the joins: of misspelt places and words (one edit in three letters), of
#: abbreviations by their consonants, of titles written with other gaps between their words.
PLACE_SIMILARITY, WORD_SIMILARITY, ABBREVIATION_SIMILARITY, TITLE_SIMILARITY = 0.4, 0.4, 1 / 3, 0.7
#: Between the pieces or words of a value.
_GAP = "\x1f"


def _cutter(cut_up: Callable[[str], list[str]]):
    """(value) to (value, core): the pieces that decide what the value means."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([_GAP.join(cut_up(v)) for v in batch.column(0).to_pylist()], pa.string())], ["value", "core"])

    return run


def _place_strings(core: str) -> list[str]:
    return [t for _, _, t in spans(core.split(_GAP))] if core else []


def _title_strings(core: str) -> list[str]:
    typed = core.split(_GAP) if core else []
    return [*typed, WHOLE + "".join(typed)] if typed else []


def _lister(strings: Callable[[str], list[str]]):
    """(core) to (core, s): the strings that are joined with the reference list, one empty one if there is none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(c, p) for c in batch.column(0).to_pylist() for p in (dict.fromkeys(strings(c)) or [""])]
            cols = list(zip(*rows, strict=True)) if rows else [(), ()]
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.string())], ["core", "s"])

    return run


def _decider(decide: Places | Titles):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cores, ids = [], []
            for core, similar in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                known: dict[str, list[tuple[str, float]]] = {}
                for x in similar or []:
                    known.setdefault(x["s"], []).append((x["right"], x["jaccard"]))
                for ref in decide.meant(core.split(_GAP) if core else [], known):
                    cores.append(core)
                    ids.append(ref)
            yield pa.RecordBatch.from_arrays([pa.array(cores, pa.string()), pa.array(ids, pa.int64())], ["core", "ref_id"])

    return run


def _blank(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)[\s​﻿]+", "") == ""


def _strings(reference: DataFrame, values: list[str]) -> DataFrame:
    return reference.sparkSession.createDataFrame([(v,) for v in values], "s string")


def map_places(rows: DataFrame, key: str, column: str, reference: DataFrame, most: int = 100_000) -> DataFrame:
    """``key``, ``ref_id``: one row per place that a non-blank value names, -1 if it names none.

    Null and blank values have no row; repeated rows each have theirs.  ``reference`` is a list
    (ref_id, name, country, country_code, kind, alt_names) of at most ``most`` entries, more are an
    error; it is read to the driver for the decision and joined as a table.
    """
    places = Places(place_entries(_listed(reference, most)))
    link = lambda s: similar_strings(s, _strings(reference, places.names()), PLACE_SIMILARITY)
    return _mapped(rows, key, column, place_pieces, _place_strings, link, places)


def map_titles(rows: DataFrame, key: str, column: str, reference: DataFrame, most: int = 100_000) -> DataFrame:
    """``key``, ``ref_id``: the listed title that a non-blank value means, -1 if none; as map_places."""
    titles = Titles(title_entries(_listed(reference, most)))
    words, letters = _strings(reference, titles.words()), _strings(reference, titles.letters())

    def link(strings: DataFrame) -> DataFrame:
        is_whole = F.col("s").startswith(WHOLE)
        typed, whole = strings.where(~is_whole), strings.where(is_whole).select(F.substring("s", len(WHOLE) + 1, 2**30).alias("s"))
        near = similar_strings(typed, words, WORD_SIMILARITY)
        short = similar_strings(typed, words, ABBREVIATION_SIMILARITY, skeleton)
        same = similar_strings(whole, letters, TITLE_SIMILARITY).select(F.concat(F.lit(WHOLE), "left").alias("left"), "right", "jaccard")
        return near.unionByName(short).groupBy("left", "right").agg(F.max("jaccard").alias("jaccard")).unionByName(same)

    return _mapped(rows, key, column, title_words, _title_strings, link, titles)


def _mapped(rows: DataFrame, key: str, column: str, cut_up: Callable[[str], list[str]], strings: Callable[[str], list[str]], link: Callable[[DataFrame], DataFrame], decide: Places | Titles) -> DataFrame:
    given = rows.select(F.col(key), F.col(column).alias("value")).where(F.col("value").isNotNull() & ~_blank(F.col("value")))
    cores = given.select("value").distinct().mapInArrow(_cutter(cut_up), "value string, core string")
    parts = cores.select("core").distinct().mapInArrow(_lister(strings), "core string, s string")
    # one exchange that all joins read
    links = link(parts.select("s").distinct())
    met = parts.join(links, parts["s"] == links["left"], "left")
    gathered = met.groupBy("core").agg(F.collect_list(F.when(F.col("right").isNotNull(), F.struct("s", "right", "jaccard"))).alias("similar"))
    meanings = gathered.mapInArrow(_decider(decide), "core string, ref_id bigint")
    return given.join(cores.join(meanings, "core").select("value", "ref_id"), "value").select(key, "ref_id")
