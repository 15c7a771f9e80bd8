"""New batches against all history by a persistent table of content-defined chunks (problem 6).

A record's content is its posting number or, without one, the last part of its address.  A content
is cut where a rolling hash of its last bytes says so (words end at hyphens, and so do chunks), and
each chunk is hashed.  A folder keeps what has been accepted so far:

* ``contents``: each content once, with its first record and its chunk hashes;
* ``order``: how often each chunk occurred when the history was loaded.  It stays as it is, so that
  old and new contents rank their chunks alike; a chunk that it lacks counts as the rarest;
* ``index``: chunk to content, for each content's rarest chunks only.

A batch is checked by joining its own contents and chunks with these tables and then appended to
them.  No record of the history is read, cut or ranked again, and no history row is shuffled as long
as the batch is small enough to be broadcast (the optimizer sees its size, as it is written first).
The history's part of both tables lies in folders by hash; a batch reads only those that it needs.

Contents one word apart share every chunk but those of one word; so of each content only the rarest
chunks are joined whose bytes exceed its longest word, which loses no such pair.  The shared bytes
must cover either content but for a word, and an exact comparison of the words follows.  Contents of
one single word, of which a misspelling may leave no chunk, are met by segments as well: three edits
leave one of four segments as it was.  Equal contents are one entry, so a posting that holds a third
of all rows is met once.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postlens.llm.ids import last_part, posting_number
from postlens.session import written

#: Bounds of a chunk in bytes, and the bits of the rolling hash that are zero at a cut.
MIN_CHUNK, MAX_CHUNK, CUT_BITS = 3, 64, 2
#: Edits that a misspelt word may have; the batch numbers of the history and of rows without one.
MOST_EDITS, HISTORY, UNNUMBERED = 3, -(2**31), 2**31 - 1
_HYPHEN = ord("-")
_GEAR = [xxhash.xxh32_intdigest(bytes([b]), seed=7) for b in range(256)]
_CUT = (1 << CUT_BITS) - 1


def chunks(content: str) -> list[bytes]:
    """Content-defined chunks: a boundary where the low bits of the gear hash are zero, and after a hyphen.

    The low bits depend on the last CUT_BITS bytes only, so boundaries come back soon after an edit,
    with the next word at the latest: an edit of one word changes no chunk of the others.  Every
    content ends with a hyphen, so its last word is cut like the others.
    """
    data, out, start, h = (content + "-").encode(), [], 0, 0
    for i, byte in enumerate(data):
        h = ((h << 1) + _GEAR[byte]) & 0xFFFFFFFF
        size = i + 1 - start
        if byte == _HYPHEN or size >= MAX_CHUNK or (size >= MIN_CHUNK and not h & _CUT):
            out.append(data[start : i + 1])
            start, h = i + 1, 0
    return out


def _key(*parts: object) -> int:
    h = xxhash.xxh3_64_intdigest(b"\0".join(p if isinstance(p, bytes) else str(p).encode() for p in parts))
    return h - (1 << 64) if h >> 63 else h


def segments(n: int) -> list[tuple[int, int]]:
    """Places of the four segments of a word of n characters, as even as can be."""
    k = MOST_EDITS + 1
    edges = [n * i // k for i in range(k + 1)]
    return list(zip(edges, edges[1:], strict=False))


def stored_keys(word: str) -> list[int]:
    """Keys under which a single-word content is stored besides its chunks."""
    return [_key(b"segment", len(word), i, word[a:b]) for i, (a, b) in enumerate(segments(len(word)))]


def probe_keys(word: str) -> list[int]:
    """Keys under which every word within three edits of a single-word content is stored."""
    out = []
    for n in range(max(0, len(word) - MOST_EDITS), len(word) + MOST_EDITS + 1):
        for i, (a, b) in enumerate(segments(n)):
            out += [_key(b"segment", n, i, word[at : at + b - a]) for at in range(max(0, a - MOST_EDITS), min(len(word) - (b - a), a + MOST_EDITS) + 1)]
    return list(dict.fromkeys(out))


_BAG = pa.list_(pa.struct([("h", pa.int64()), ("n", pa.int32())]))
_KEYS = pa.list_(pa.int64())


def _cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(content, numbered, ...) with the chunk hashes and segment keys of contents that are compared by chunks."""
    for batch in batches:
        bags, stored, probes = [], [], []
        for content, numbered in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            single = not numbered and "-" not in content
            bags.append([] if numbered else [{"h": _key(b"chunk", c), "n": len(c)} for c in dict.fromkeys(chunks(content))])
            stored.append(stored_keys(content) if single else [])
            probes.append(probe_keys(content) if single else [])
        columns = [*batch.columns, pa.array(bags, _BAG), pa.array(stored, _KEYS), pa.array(probes, _KEYS)]
        yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "bag", "stored_keys", "probe_keys"])


def contents(rows: DataFrame, record: str, batch: Column, job_id: str = "linkedin_job_id", url: str = "url") -> DataFrame:
    """``record``, ``batch``, ``content``, ``numbered``; content is null where a row has neither number nor address.

    A null batch counts as the last one.
    """
    number = posting_number(F.col(job_id), F.col(url))
    return rows.select(
        F.col(record).cast("bigint").alias("record"),
        F.coalesce(batch.cast("int"), F.lit(UNNUMBERED)).alias("batch"),
        F.coalesce(F.concat(F.lit("#"), number), last_part(F.col(url))).alias("content"),
        number.isNotNull().alias("numbered"),
    )


def first_records(records: DataFrame) -> DataFrame:
    """``content``, ``numbered``, ``batch``, ``record``: each content of one batch with its earliest record."""
    found = records.where("content IS NOT NULL").groupBy("content", "numbered", "batch").agg(F.min("record").alias("record"))
    return found.select("content", "numbered", "batch", "record")


def one_word_apart(a: str, b: str) -> bool:
    """Whether two addresses differ by at most one word: added, missing, or misspelt by up to three characters."""
    x, y = a.split("-"), b.split("-")
    while x and y and x[0] == y[0]:
        x, y = x[1:], y[1:]
    while x and y and x[-1] == y[-1]:
        x, y = x[:-1], y[:-1]
    if len(x) + len(y) <= 1:
        return True
    return len(x) == len(y) == 1 and edits(x[0], y[0], MOST_EDITS) <= MOST_EDITS


def edits(a: str, b: str, most: int) -> int:
    """Levenshtein distance, or most + 1 if it is larger."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    row = list(range(len(b) + 1))
    for i, ca in enumerate(a, 1):
        prev, row[0] = row[0], i
        for j, cb in enumerate(b, 1):
            prev, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, prev + (ca != cb))
        if min(row) > most:
            return most + 1
    return row[-1]


def _one_word_apart(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([one_word_apart(x, y) for x, y in zip(a, b, strict=True)], dtype=bool)


def rare_chunks(made: DataFrame, order: DataFrame) -> DataFrame:
    """Index rows (``h``, ``probe``, ``stored``, ``content``, ``batch``, ``record``, ``need``, ``bag``) of
    contents with their bags: their rarest chunks until the bytes exceed the longest word, and the
    segment keys.  A content's chunks are few (its length is bounded by an address), so they are
    ordered in an array."""
    loose = made.where("NOT numbered")
    placed = loose.select("content", F.explode("bag").alias("c")).select("content", "c.h", "c.n")
    often = order.join(placed.select("h").distinct(), "h")
    ranked = placed.join(often, "h", "left").groupBy("content").agg(F.array_sort(F.collect_list(F.struct(F.coalesce("df", F.lit(0)).alias("df"), "h", "n"))).alias("ranked"), F.sum("n").alias("total"))
    longest = F.array_max(F.transform(F.split("content", "-"), lambda w: F.octet_length(w))) + 1
    measured = ranked.withColumn("need", F.when(F.col("content").contains("-"), F.col("total") - longest).otherwise(0).cast("bigint"))
    before = lambda i: F.aggregate(F.slice("ranked", 1, i - 1), F.lit(0), lambda s, y: s + y["n"])
    places = F.filter(F.sequence(F.lit(1), F.size("ranked")), lambda i: before(i) <= F.col("total") - F.col("need"))
    rare = measured.select("content", "need", F.transform(places, lambda i: F.get(F.col("ranked"), i - 1)["h"]).alias("rare"))
    key = lambda probe, stored: lambda h: F.struct(h.alias("h"), F.lit(probe).alias("probe"), F.lit(stored).alias("stored"))
    rows = loose.join(rare, "content").withColumn("k", F.explode(F.concat(F.transform("rare", key(True, True)), F.transform("stored_keys", key(False, True)), F.transform("probe_keys", key(True, False)))))
    return rows.select("k.h", "k.probe", "k.stored", "content", "batch", "record", "need", "bag")


def near_contents(new: DataFrame, index: DataFrame) -> DataFrame:
    """``content``, ``other``, ``other_first``: contents of ``new`` with each different content of
    ``index`` at most one word apart, and the order of its first record.  Both hold index rows."""
    met = new.where("probe").alias("l").join(index.where("stored").alias("r"), F.col("l.h") == F.col("r.h")).where("l.content != r.content")
    shared = F.aggregate(F.array_intersect(F.col("l.bag"), F.col("r.bag")), F.lit(0), lambda s, y: s + y["n"])
    first = F.struct(F.col("r.batch").alias("batch"), F.col("r.record").alias("record"))
    pairs = met.where(shared >= F.greatest("l.need", "r.need")).select(F.col("l.content").alias("content"), F.col("r.content").alias("other"), first.alias("other_first")).distinct()
    return pairs.where(F.pandas_udf(_one_word_apart, "boolean")("content", "other"))


_CONTENTS = "content string, numbered boolean, batch int, record bigint, bag array<struct<h:bigint,n:int>>, stored_keys array<bigint>, probe_keys array<bigint>"
_INDEX = "h bigint, probe boolean, stored boolean, content string, batch int, record bigint, need bigint, bag array<struct<h:bigint,n:int>>"


class ChunkStore:
    """The persistent tables under one path, in folders by batch (``part``) and, for the history, hash (``bucket``).

    ``rows_per_bucket`` bounds the history's rows in a bucket.  A batch that is run again writes its
    own folders anew and sees only earlier ones, so a restart changes nothing.
    """

    def __init__(self, spark: SparkSession, path: str, rows_per_bucket: int = 4_000_000):
        self.spark, self.path, self.rows_per_bucket = spark, path.rstrip("/"), rows_per_bucket
        self._n_buckets: int | None = None

    def _read(self, name: str, columns: str) -> DataFrame:
        return self.spark.read.schema(f"{columns}, part int, bucket int").parquet(f"{self.path}/{name}")

    def _buckets(self) -> int:
        if self._n_buckets is None:
            self._n_buckets = self.spark.read.schema("n_buckets int").parquet(f"{self.path}/size").first()["n_buckets"]
        return self._n_buckets

    def _earlier(self, name: str, columns: str, number: int, keys: DataFrame, key: Column) -> DataFrame:
        """Rows of the folders before a batch, of the history only the buckets in which ``keys`` fall (their list is as long as there are buckets at most)."""
        table, n = self._read(name, columns).where(F.col("part") < number), self._buckets()
        if n == 1:
            return table
        wanted = [r[0] for r in keys.select(F.pmod(key, F.lit(n)).cast("int").alias("b")).distinct().collect()]
        return table.where((F.col("part") != HISTORY) | F.col("bucket").isin(wanted))

    def load(self, history: DataFrame) -> None:
        """Start the tables with the records of the history (from ``contents``)."""
        made = first_records(history.withColumn("batch", F.lit(HISTORY))).mapInArrow(_cut_up, _CONTENTS)
        made.write.mode("overwrite").parquet(f"{self.path}/loaded")
        made = self.spark.read.schema(_CONTENTS).parquet(f"{self.path}/loaded")
        n = self._n_buckets = max(1, -(-made.count() // self.rows_per_bucket))
        self.spark.range(1).select(F.lit(n).cast("int").alias("n_buckets")).write.mode("overwrite").parquet(f"{self.path}/size")
        self._spread(made, "contents", F.xxhash64("content"), n)
        made.select(F.explode("bag.h").alias("h")).groupBy("h").agg(F.count("*").alias("df")).write.mode("overwrite").parquet(f"{self.path}/order")
        self._spread(rare_chunks(made, self._order()).where("stored"), "index", F.col("h"), n)

    def _spread(self, rows: DataFrame, name: str, key: Column, n: int) -> None:
        placed = rows.withColumn("bucket", F.pmod(key, F.lit(n)).cast("int"))
        if n > 1:
            placed = placed.repartition(F.col("bucket"))
        placed.write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/{name}/part={HISTORY}")

    def _order(self) -> DataFrame:
        return self.spark.read.schema("h bigint, df bigint").parquet(f"{self.path}/order")

    def append(self, number: int, batch: DataFrame) -> None:
        """Add the contents of a batch that the store doesn't have, with their index rows."""
        own = first_records(batch)
        met = self._earlier("contents", _CONTENTS, number, own, F.xxhash64("content")).select("content").join(own.select("content"), "content").distinct()
        here = f"part={number}/bucket=-1"
        own.join(met, "content", "left_anti").mapInArrow(_cut_up, _CONTENTS).write.mode("overwrite").parquet(f"{self.path}/contents/{here}")
        new = self.spark.read.schema(_CONTENTS).parquet(f"{self.path}/contents/{here}")
        rare_chunks(new, self._order()).write.mode("overwrite").parquet(f"{self.path}/index/{here}")

    def check(self, number: int, batch: DataFrame) -> DataFrame:
        """``record``, ``reason`` of the records of an appended batch that the store knew before them.

        Records of the batch itself count where they are earlier; so does a content that was itself
        near an older one, which is why every new content is appended, not the accepted ones only.
        """
        own = first_records(batch).select("content")
        new = self.spark.read.schema(_INDEX).parquet(f"{self.path}/index/part={number}/bucket=-1")
        older = self._earlier("index", _INDEX, number, new.where("probe"), F.col("h")).drop("part", "bucket")
        near = near_contents(new, older.unionByName(new)).groupBy("content").agg(F.min("other_first").alias("near_first"))
        added = self._read("contents", _CONTENTS).where((F.col("part") == number) & (F.col("bucket") == -1))
        stored = self._earlier("contents", _CONTENTS, number, own, F.xxhash64("content")).unionByName(added)
        firsts = stored.select("content", F.struct("batch", "record").alias("first")).join(own, "content")
        order = F.struct("batch", "record")
        out = batch.where("content IS NOT NULL").join(firsts, "content").join(near, "content", "left")
        reason = F.when(F.col("first") < order, F.lit("same content")).when(F.col("near_first") < order, F.lit("one word apart"))
        return out.select("record", reason.alias("reason")).where("reason IS NOT NULL")


def known_records(store: ChunkStore, history: DataFrame, incoming: DataFrame) -> DataFrame:
    """``record``, ``reason`` of incoming records whose posting is in history or an earlier incoming row.

    Both inputs come from ``contents``.  The store is loaded with the history; then batch after batch
    is appended and checked, in the order of their numbers (one small job each; their numbers are
    the loop's only data on the driver).  A record without content (neither number nor address) is
    never known.  Repeated records each have their row; without batches the result is empty.
    """
    store.load(history)
    incoming = written(incoming.select("record", "batch", "content", "numbered"))  # numbers and addresses are read once
    numbers = sorted(r[0] for r in incoming.select("batch").distinct().collect())
    for number in numbers:
        batch = incoming.where(F.col("batch") == number)
        store.append(number, batch)
        store.check(number, batch).write.mode("overwrite").parquet(f"{store.path}/known/part={number}")
    if not numbers:
        return incoming.select("record", F.lit("").alias("reason"))
    return store.spark.read.schema("record bigint, reason string").parquet(*[f"{store.path}/known/part={n}" for n in numbers])
