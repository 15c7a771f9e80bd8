"""Language of documents and of their stretches by error-correcting output codes (problem 9).

Each language has a codeword of 15 bits, any two of which differ in 8.  Every bit is predicted by
a binary classifier over hashed character n-grams of the words (with their ends): the log ratio of an
n-gram's frequency in the languages whose bit is one to that in the others.  What a word adds to
the 15 margins is worked out once and kept while a worker lives.  A sentence's margins for all bits are decoded by
the loss they give each codeword; the nearest codeword wins, the losses give a confidence, and
sentences whose two nearest codewords are about as near are flagged as ambiguous.

The classifiers are fitted on a bounded sample of rows with a label: on the labels as delivered,
then twice on the sentences for which the last fit agrees with the label, so wrong labels and
stretches in another language drop out.  Texts are cut into sentences; titles, headings,
names, codes and contact lines are none.  Sentences of one language in a row make a segment.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LANGUAGES = ("en", "de", "fr", "es", "pt", "nl")

# Notations of the languages' names besides a code with or without region.
NOTATIONS = {
    "en": "en eng english englisch anglais inglés ingles inglês engels inglese",
    "de": "de deu ger german deutsch allemand alemán aleman alemão alemao duits tedesco",
    "fr": "fr fra fre french français francais französisch franzosisch francés frances francês frans francese",
    "es": "es spa esp spanish español espanol castellano espagnol spanisch espanhol spaans spagnolo",
    "pt": "pt por portuguese português portugues portugiesisch portugais portugués portugees portoghese",
    "nl": "nl nld dut dutch nederlands niederländisch niederlandisch néerlandais neerlandais neerlandés neerlandes holandés holandes holandês flemish vlaams olandese",
}

#: Words that a worker keeps at most.
KEPT_WORDS = 300_000
BITS = 16  # of the buckets that n-grams are hashed to
_SIZES = (1, 2, 3, 4)
_MULT = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5], dtype=np.uint64)
_TAG = re.compile(r"<[^>\n]*>")
_INVISIBLE = re.compile("[­​-‏⁠﻿]")
_BREAK = re.compile(r"(?<=[.!?…])[\"'»”)]*\s+|(?<=:)\s+")
_CODE = re.compile(r"[_=@{}\[\]#~^|]|->|://|www\.")
_WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*")
_STOP = re.compile(r"[.!?…][\"'»”)\s]*$")


def language_of(label: Column) -> Column:
    """The language that a label names, in any usual notation; null if it names none of the known.

    A region or script behind the code or in brackets doesn't matter, nor a word before the name.
    """
    first = F.regexp_extract(F.lower(F.trim(label)), r"^([\p{L}]+)", 1)
    names = F.filter(F.split(F.lower(F.trim(label)), r"[^\p{L}]+"), lambda w: F.length(w) >= 5)
    out = F.lit(None).cast("string")
    for lang, spellings in NOTATIONS.items():
        known = spellings.split()
        out = F.when(first.isin(*known), F.lit(lang)).when(out.isNull() & F.arrays_overlap(names, F.array(*[F.lit(w) for w in known if len(w) >= 5])), F.lit(lang)).otherwise(out)
    return out


def codewords() -> np.ndarray:
    """Six rows of the 16 x 16 Sylvester matrix, chosen so that no column is constant, without the first column."""
    h = np.array([[1]])
    for _ in range(4):
        h = np.block([[h, h], [h, -h]])
    return h[[1, 2, 4, 8, 15, 7][: len(LANGUAGES)], 1:].astype(np.float32)


def sentences(text: str, title: str | None = None) -> list[tuple[int, int]]:
    """Places (start, end) of the sentences of a text, in order.

    A sentence ends with a stop, has at least three words of letters, and isn't the title, in
    title case throughout, or code.  One whose stop is lost or mistyped has six words or more,
    four of them in lower case, and no colon at its end as headings have.
    """
    found = []
    odd = _INVISIBLE.search(text) is not None
    norm_title = " ".join(_WORD.findall(title.casefold())) if title else None
    # tags keep their length as blanks so that places stay those of the text; block ends break lines
    bare = _TAG.sub(lambda m: " " * (len(m[0]) - 1) + ("\n" if re.match(r"</?(?:p|li|div|br|ul|ol|h\d|tr|td|table)\b", m[0], re.I) else " "), text)
    at = 0
    for line in re.split(r"(\n+)", bare):
        start = at
        at += len(line)
        if not line.strip():
            continue
        pos = 0
        for m in [*_BREAK.finditer(line), None]:
            end = m.start() if m else len(line)
            piece = _INVISIBLE.sub("", line[pos:end]) if odd else line[pos:end]
            words = _WORD.findall(piece)
            if _is_sentence(piece, words) and " ".join(words).casefold() != norm_title:
                found.append((start + pos, start + end))
            pos = m.end() if m else end
    return found


def _is_sentence(piece: str, words: list[str]) -> bool:
    if len(words) < 3 or sum(map(len, words)) < 10 or _CODE.search(piece):
        return False
    stopped = _STOP.search(piece) is not None
    wanted, small = 2 if stopped else 4, 0
    for w in words:
        if w[0].islower():
            small += 1
            if small == wanted:
                break
    if not stopped:
        return len(words) >= 6 and small >= wanted and not piece.rstrip().endswith(":")
    return small >= wanted or (len(words) >= 5 and sum(w.isupper() for w in words) >= 0.7 * len(words))


def words_of(text: str) -> list[str]:
    return _WORD.findall(_INVISIBLE.sub("", text).lower())


def buckets(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams of words with a blank at either end, and where each word's begin."""
    joined = "\n".join(f" {w} " for w in words) + "\n"
    codes = np.frombuffer(joined.encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)
    doc = np.cumsum(codes == 10) - (codes == 10)
    parts, owners = [], []
    for n in _SIZES:
        total = len(codes) - n + 1
        h = np.full(total, n, np.uint64)
        for k in range(n):
            h = (h ^ codes[k : k + total]) * _MULT[k]
            h ^= h >> np.uint64(31)
        inside = (doc[:total] == doc[n - 1 :]) & (codes[:total] != 10) & (codes[n - 1 :] != 10)
        parts.append((h[inside] >> np.uint64(64 - BITS)).astype(np.int64))
        owners.append(doc[:total][inside])
    owner, bucket = np.concatenate(owners), np.concatenate(parts)
    order = np.argsort(owner, kind="stable")
    return bucket[order], np.searchsorted(owner[order], np.arange(len(words)))


class Model:
    """Weights of the bits' classifiers (buckets x bits) and the scale of their margins."""

    def __init__(self, weights: np.ndarray, scale: float, code: np.ndarray):
        self.weights, self.scale, self.code = weights, scale, code
        self.forget()

    def forget(self) -> None:
        self.place: dict[str, int] = {}
        self.sums, self.sizes = np.zeros((0, self.code.shape[1]), np.float32), np.zeros(0, np.int64)

    def __getstate__(self) -> dict:
        return {"weights": self.weights, "scale": self.scale, "code": self.code}

    def __setstate__(self, state: dict) -> None:
        self.__init__(**state)

    def _learn(self, words: list[str]) -> None:
        """Sums of the words' weights, and how many n-grams they have."""
        at, b = len(self.place), None
        for i in range(0, len(words), 5000):
            part = words[i : i + 5000]
            b, start = buckets(part)
            self.sums = np.concatenate([self.sums, np.add.reduceat(self.weights[b], start, axis=0)])
            self.sizes = np.concatenate([self.sizes, np.diff(np.append(start, len(b)))])
        self.place.update((w, at + k) for k, w in enumerate(words))

    def margins(self, texts: list[str]) -> np.ndarray:
        lists = [words_of(t) for t in texts]
        if len(self.place) > KEPT_WORDS:
            self.forget()
        fresh = [w for w in dict.fromkeys(w for ws in lists for w in ws) if w not in self.place]
        if fresh:
            self._learn(fresh)
        count = np.fromiter(map(len, lists), np.int64, len(lists))
        place = np.fromiter((self.place[w] for ws in lists for w in ws), np.int64, int(count.sum()))
        start, some = np.cumsum(count) - count, count > 0
        m = np.zeros((len(lists), self.code.shape[1]), np.float32)
        if some.any():
            m[some] = np.add.reduceat(self.sums[place], start[some], axis=0) / np.sqrt(np.add.reduceat(self.sizes[place], start[some]))[:, None]
        return np.tanh(m * self.scale)

    def decode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Language numbers and confidences: the codeword with the least exponential loss."""
        if not texts:
            return np.empty(0, np.int64), np.empty(0)
        return self.nearest(self.margins(texts))

    def nearest(self, m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        loss = np.exp(-m[:, None, :] * self.code[None, :, :]).sum(axis=2)
        p = np.exp(-(loss - loss.min(axis=1, keepdims=True)))
        p /= p.sum(axis=1, keepdims=True)
        best = p.argmax(axis=1)
        return best, p[np.arange(len(m)), best]


def fit(texts: list[str], labels: np.ndarray) -> Model:
    """Fit the bits' classifiers on sentences with (noisy) language numbers, thrice."""
    code, n = codewords(), len(LANGUAGES)
    lists = [words_of(t) for t in texts]
    vocabulary = {w: k for k, w in enumerate(dict.fromkeys(w for ws in lists for w in ws))}
    b, start = buckets(list(vocabulary)) if vocabulary else (np.empty(0, np.int64), np.empty(0, np.int64))
    gram_word = np.repeat(np.arange(len(vocabulary)), np.diff(np.append(start, len(b))))
    place = np.fromiter((vocabulary[w] for ws in lists for w in ws), np.int64)
    owner = np.repeat(np.arange(len(texts)), [len(ws) for ws in lists])
    keep = np.ones(len(texts), bool)
    for _ in range(3):
        counts = np.zeros((n, 1 << BITS))
        for k in range(n):
            often = np.bincount(place[(keep & (labels == k))[owner]], minlength=len(vocabulary)) if len(place) else np.zeros(0)
            counts[k] = np.bincount(b, weights=often[gram_word].astype(float), minlength=1 << BITS)
        share = (counts + 0.05) / (counts.sum(axis=1, keepdims=True) + 0.05 * (1 << BITS))
        weights = np.stack([np.log(share[code[:, c] > 0].mean(axis=0)) - np.log(share[code[:, c] < 0].mean(axis=0)) for c in range(code.shape[1])], axis=1)
        model = Model(weights.astype(np.float32), 0.05, code)
        if texts:
            best, sure = model.decode(texts)
            keep = (best == labels) & (sure > 0.6)
    model.forget()
    return model


def train(rows: DataFrame, key: str, text: str, label: str, title: str | None = None, bound: int = 2500) -> Model:
    """Model fitted on at most ``bound`` labelled rows, chosen by the hash of their key.

    Only this bounded sample reaches the driver; every row is then classified.
    """
    cols = [language_of(F.col(label)).alias("y"), F.col(text).alias("text"), (F.col(title) if title else F.lit(None).cast("string")).alias("title")]
    chosen = rows.select(F.col(key), *cols).where("y IS NOT NULL AND text IS NOT NULL").withColumn("h", F.xxhash64(key)).orderBy("h", key).limit(bound)
    # a sentence that a label repeats counts once, so that copied texts don't outweigh others
    seen = dict.fromkeys((row["y"], row["text"][a:b]) for row in chosen.select("y", "text", "title").collect() for a, b in sentences(row["text"], row["title"]))
    return fit([t for _, t in seen], np.array([LANGUAGES.index(y) for y, _ in seen], np.int64))


#: Below this confidence a sentence is ambiguous and goes with the sentence before it (else behind it).
AMBIGUOUS = 0.5


def segments_of(text: str, title: str | None, model: Model) -> list[tuple[int, str, float, int, int, int, bool, int]]:
    """(seg_no, lang, confidence, start, end, n_sentences, all of them ambiguous, ambiguous ones) of one text."""
    return _segments([(text, title)], model)[0]


def _segments(docs: list[tuple[str | None, str | None]], model: Model) -> list[list[tuple]]:
    places = [sentences(t, title) if t else [] for t, title in docs]
    best, sure = model.decode([t[a:b] for (t, _), ps in zip(docs, places, strict=True) for a, b in ps])
    out, at = [], 0
    for ps in places:
        lang, conf = best[at : at + len(ps)].copy(), sure[at : at + len(ps)]
        at += len(ps)
        firm = np.flatnonzero(conf >= AMBIGUOUS)
        if len(firm):
            for i in np.flatnonzero(conf < AMBIGUOUS):
                before = firm[firm < i]
                lang[i] = lang[before[-1] if len(before) else firm[0]]
        runs, i = [], 0
        while i < len(ps):
            j = i
            while j + 1 < len(ps) and lang[j + 1] == lang[i]:
                j += 1
            c = float(conf[i : j + 1].mean())
            runs.append((len(runs) + 1, LANGUAGES[lang[i]], c, ps[i][0], ps[j][1], j - i + 1, bool((conf[i : j + 1] < AMBIGUOUS).all()), int((conf[i : j + 1] < AMBIGUOUS).sum())))
            i = j + 1
        out.append(runs)
    return out


SEGMENT = "seg_no bigint, lang string, confidence double, start int, end int, n_sentences int, ambiguous boolean, n_ambiguous int"


def segments(rows: DataFrame, key: str, text: str, model: Model, title: str | None = None) -> DataFrame:
    """``key`` and an array ``segments`` (SEGMENT) for each row; empty for a null text or one without sentences.

    Whole texts are read; places count characters.  Each row is classified where it is read, nothing
    is shuffled; the model (about 4 MB, its size fixed by BITS) is broadcast once.
    """
    shared = rows.sparkSession.sparkContext.broadcast(model)
    kind = dict(rows.dtypes)[key]
    types = pa.list_(pa.struct([("seg_no", pa.int64()), ("lang", pa.string()), ("confidence", pa.float64()), ("start", pa.int32()), ("end", pa.int32()), ("n_sentences", pa.int32()), ("ambiguous", pa.bool_()), ("n_ambiguous", pa.int32())]))
    names = [f.name for f in types.value_type]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                docs = list(zip(part.column(1).to_pylist(), part.column(2).to_pylist(), strict=True))
                made = [[dict(zip(names, s, strict=True)) for s in runs] for runs in _segments(docs, shared.value)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(made, types)], ["key", "segments"])

    titles = (F.col(title) if title else F.lit(None)).cast("string").alias("title")
    slim = rows.select(F.col(key).alias("key"), F.col(text).alias("text"), titles)
    return slim.mapInArrow(run, f"key {kind}, segments array<struct<{SEGMENT.replace(' ', ':').replace(',:', ',')}>>").withColumnRenamed("key", key)


def document_languages(found: DataFrame, key: str) -> DataFrame:
    """``key``, ``lang`` (of most sentences), ``confidence``, ``n_languages`` of each row, from its own segments; null, 0 and 0 without a sentence."""
    none, segments_ = F.lit(0.0), F.col("segments")
    total = F.aggregate(segments_, F.lit(0).cast("bigint"), lambda a, s: a + s["n_sentences"])

    def of(lang: str) -> Column:
        mine = F.filter(segments_, lambda s: s["lang"] == lang)
        n = F.aggregate(mine, F.lit(0).cast("bigint"), lambda a, s: a + s["n_sentences"])
        return F.struct(n.alias("n"), F.aggregate(mine, none, lambda a, s: a + s["confidence"] * s["n_sentences"]).alias("c"), F.lit(lang).alias("lang"))

    scored = found.select(key, total.alias("total"), F.filter(F.array(*map(of, LANGUAGES)), lambda x: x["n"] > 0).alias("per"))
    best = F.array_max("per")
    return scored.select(key, best["lang"].alias("lang"), F.coalesce(best["c"] / F.nullif("total", F.lit(0)), none).alias("confidence"), F.size("per").cast("bigint").alias("n_languages"))


def wrong_labels(found: DataFrame, labels: DataFrame, key: str, label: str) -> DataFrame:
    """``key``, ``seg_no``, ``lang``: all segments of the documents whose label names no language,
    another one than the language in which they begin, or that hold more than one language.

    ``found`` and ``labels`` have one row per key each (repeated keys meet all of their rows).
    """
    named = labels.select(F.col(key).alias("_k"), language_of(F.col(label)).alias("_named"))
    met = found.where(F.size("segments") > 0).join(named, found[key] == named["_k"])
    begins = F.get(F.col("segments"), F.lit(0))["lang"]
    case = met.where((F.size("segments") > 1) | F.col("_named").isNull() | (F.col("_named") != begins))
    return case.select(key, F.explode("segments").alias("s")).select(key, "s.seg_no", "s.lang")
