"""Encoding of texts with a public byte-level BPE vocabulary (problem 7).

Each partition runs an embedded DuckDB.  A text is split by the vocabulary's pattern; the words
that the worker has not met yet become token-position rows, and one recursive query joins them
with the merge table round by round: every word contracts its minimum-rank pair, from the left and
without overlap, until no pair of any word is in the table.  All places of that pair are
contracted in one round, which gives the same as one place at a time, because a merge creates only
pairs of higher rank; a word of n bytes so takes few rounds instead of n.  An ordered aggregation
turns the last rows of each word into its ids; texts look their words up.  Nothing is shuffled.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Where the vocabulary lies on every machine; a parameter of each function.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"

# Fixed value: the pattern of the vocabulary, which parts a text before the merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

_CONTRACT = """
WITH RECURSIVE state(word, pos, tok, round) AS (
    SELECT word, pos, tok, 0 FROM start
  UNION ALL
    (WITH pairs AS (
        SELECT word, pos, tok, round, row_number() OVER w AS i, lead(tok) OVER w AS next FROM state WINDOW w AS (PARTITION BY word ORDER BY pos)
     ), ranked AS (
        SELECT p.word, p.i, m.rank, m.made, min(m.rank) OVER (PARTITION BY p.word) AS least FROM pairs p JOIN merges m ON p.tok = m.a AND p.next = m.b
     ), places AS (
        SELECT word, i, made, i - row_number() OVER (PARTITION BY word ORDER BY i) AS island FROM ranked WHERE rank = least
     ), chosen AS (
        SELECT word, i, made FROM (SELECT *, row_number() OVER (PARTITION BY word, island ORDER BY i) AS k FROM places) WHERE k % 2 = 1
     )
     SELECT p.word, p.pos, coalesce(c.made, p.tok), p.round + 1
     FROM pairs p
     SEMI JOIN chosen any_place ON p.word = any_place.word
     LEFT JOIN chosen c ON p.word = c.word AND p.i = c.i
     LEFT JOIN chosen before ON p.word = before.word AND p.i = before.i + 1
     WHERE before.word IS NULL)
), last AS (SELECT word, max(round) AS round FROM state GROUP BY word)
SELECT s.word, list(s.tok ORDER BY s.pos) AS ids FROM state s JOIN last USING (word, round) GROUP BY s.word
"""


@lru_cache(maxsize=2)
def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in the vocabulary's file: printable ones for themselves, the rest from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = (b for b in range(256) if b not in set(own))
    return {b: chr(b) for b in own} | {b: chr(256 + k) for k, b in enumerate(others)}


class Encoder:
    """Words to ids through DuckDB, with what has been worked out kept while the worker lives."""

    def __init__(self, vocabulary: str = VOCABULARY, memory: str = "300MB", keep: int = 400_000):
        import duckdb
        import regex

        with open(vocabulary, encoding="utf-8") as f:
            model = json.load(f)["model"]
        ids, letters = model["vocab"], _byte_letters()
        self.start = [ids[letters[b]] for b in range(256)]
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        table = pa.table({"a": [ids[x] for x, _ in merges], "b": [ids[y] for _, y in merges], "rank": list(range(len(merges))), "made": [ids[x + y] for x, y in merges]})
        self.con = duckdb.connect(config={"threads": 1, "memory_limit": memory, "temp_directory": ""})
        self.con.register("merges_arrow", table)
        self.con.execute("CREATE TABLE merges AS SELECT a::INTEGER AS a, b::INTEGER AS b, rank::INTEGER AS rank, made::INTEGER AS made FROM merges_arrow")
        self.con.unregister("merges_arrow")
        self.split, self.keep, self.known = regex.compile(PATTERN).findall, keep, {}

    def _learn(self, words: list[str]) -> None:
        for at in range(0, len(words), 20_000):
            part = words[at : at + 20_000]
            coded = [w.encode() for w in part]
            sizes = [len(c) for c in coded]
            start = pa.table({
                "word": pa.array([k for k, n in enumerate(sizes) for _ in range(n)], pa.int32()),
                "pos": pa.array([i for n in sizes for i in range(n)], pa.int32()),
                "tok": pa.array([self.start[b] for c in coded for b in c], pa.int32()),
            })
            self.con.register("start", start)
            for word, ids in self.con.execute(_CONTRACT).fetchall():
                self.known[part[word]] = ids
            self.con.unregister("start")

    def _words(self, texts: list[str | None]) -> list[list[str]]:
        """The words of each text, whose ids are all known afterwards."""
        lists = [self.split(t) if t else [] for t in texts]
        if len(self.known) > self.keep:
            self.known.clear()
        fresh = {w for ws in lists for w in ws if w not in self.known}
        if fresh:
            self._learn(list(fresh))
        return lists

    def encode(self, texts: list[str | None]) -> list[list[int]]:
        """Ids of each text, without special tokens (their names in a text are ordinary text)."""
        ids = self._words(texts)
        return [list(chain.from_iterable(map(self.known.__getitem__, ws))) for ws in ids]

    def count(self, texts: list[str | None]) -> list[int]:
        """Number of ids of each text."""
        return [sum(map(len, map(self.known.__getitem__, ws))) for ws in self._words(texts)]


class Decoder:
    """Ids to texts: position rows join the vocabulary, an ordered aggregation joins the bytes."""

    def __init__(self, vocabulary: str = VOCABULARY, memory: str = "300MB"):
        import duckdb

        with open(vocabulary, encoding="utf-8") as f:
            ids = json.load(f)["model"]["vocab"]
        byte_of = {c: b for b, c in _byte_letters().items()}
        entries = [(i, bytes(byte_of[c] for c in t)) for t, i in ids.items() if all(c in byte_of for c in t)]
        self.con = duckdb.connect(config={"threads": 1, "memory_limit": memory, "temp_directory": ""})
        self.con.register("entries", pa.table({"id": pa.array([i for i, _ in entries], pa.int32()), "bytes": pa.array([b for _, b in entries], pa.binary())}))
        self.con.execute("CREATE TABLE vocabulary AS SELECT * FROM entries")

    def decode(self, lists: list[list[int]]) -> list[str]:
        rows = pa.table({
            "text": pa.array([k for k, x in enumerate(lists) for _ in x], pa.int32()),
            "pos": pa.array([i for x in lists for i in range(len(x))], pa.int32()),
            "id": pa.array([i for x in lists for i in x], pa.int32()),
        })
        self.con.register("given", rows)
        made = dict(self.con.execute("SELECT text, list(bytes ORDER BY pos) FROM given JOIN vocabulary USING (id) GROUP BY text").fetchall())
        self.con.unregister("given")
        return [b"".join(made.get(k, ())).decode("utf-8", "replace") for k in range(len(lists))]


#: Texts that go through the encoder together; bounds a worker's memory.
SLICE = 1000


def _mapper(vocabulary: str, finish, name: str = "made"):
    """Function for mapInArrow: the last column, a text, replaced by what ``finish`` makes of it with an encoder."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = None
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                encoder = encoder or Encoder(vocabulary)
                made = finish(encoder, part.column(part.num_columns - 1).to_pylist())
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], made], [*part.schema.names[:-1], name])

    return run


def encode(rows: DataFrame, key: str, text: str, vocabulary: str = VOCABULARY) -> DataFrame:
    """``key``, ``ids``: the token ids of each text; an empty list for a null or empty text.

    One row out for each row in, repeated keys too; whole texts, however long.
    """
    kind = dict(rows.dtypes)[key]
    mapper = _mapper(vocabulary, lambda encoder, texts: pa.array(encoder.encode(texts), pa.list_(pa.int32())))
    return rows.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(mapper, f"key {kind}, made array<int>").select(F.col("key").alias(key), F.col("made").alias("ids"))


def with_token_counts(rows: DataFrame, text: str, vocabulary: str = VOCABULARY) -> DataFrame:
    """``rows`` without the text, with ``n_tokens`` (a column of that name is replaced); 0 for a null or empty text."""
    others = [c for c in rows.columns if c not in (text, "n_tokens")]
    kinds = dict(rows.dtypes)
    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in others), "n_tokens int"])
    mapper = _mapper(vocabulary, lambda encoder, texts: pa.array(encoder.count(texts), pa.int32()), "n_tokens")
    return rows.select(*others, text).mapInArrow(mapper, schema)


def decode(encoded: DataFrame, key: str, ids: str = "ids", vocabulary: str = VOCABULARY) -> DataFrame:
    """``key``, ``text``: the text that the ids stand for; an empty list gives an empty text."""
    kind = dict(encoded.dtypes)[key]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = None
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                decoder = decoder or Decoder(vocabulary)
                texts = decoder.decode([x or [] for x in part.column(1).to_pylist()])
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.string())], ["key", "text"])

    return encoded.select(F.col(key).alias("key"), F.col(ids).alias("ids")).mapInArrow(run, f"key {kind}, text string").withColumnRenamed("key", key)
