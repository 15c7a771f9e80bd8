"""Near-duplicate records with small edits: MinHash banding of n-gram sets (problem 3).

It stands in place of a prefix-tree join.  A tree in order of rarity finds every pair with a prefix
as long as the similarity leaves room for (a third of a set), but in texts made of the same phrases
each of those elements is shared by ever more sets: on the large check tables that prefix meets in
1.1 billion pairs of 171,000 texts, and ten times the texts meet a hundred times as often.  So
there are ``trees`` bands, each under a global order of its own (a permutation of the hashed grams,
the same for all texts), and the ``depth`` smallest grams of a set in that order are its key.  Two
large sets have the same key in a band with about the probability J**depth, and in any band with
1 - (1 - J**depth)**trees; texts that share little meet hardly ever.

1. paths: per text, the ``depth`` smallest grams under each order, hashed to one node key.
2. pairs: node keys are shuffled and sorted; texts below one node are candidates.  A node with over
   CROWD texts is no task's burden: its texts are dealt to the cells of a grid, every two of them
   to a common cell, and the cells are shuffled again.  Pairs that share a node by chance grow with
   the square of the texts, so each text takes a sketch along, two bits of its smallest gram under
   each order, and a pair whose sketches agree too seldom is dropped before it is ever written.
3. verification: both texts' exact n-gram sets are merged; a pair is dropped at once where the
   length bound shows that even full overlap of the rest can't reach the similarity.

Texts that are equal character by character have one key, travel once and are sketched once; a group of
copies that holds a third of all rows is a single text here.  Keys are 64-bit hashes of the texts.
Chance of missing a pair of just the wanted similarity, for the defaults 6 and 40: 0.7 % at
J = 0.70, 0.14 % at 0.73, 0.02 % at 0.76, 0.0005 % at 0.80, and falling.  That holds for large sets;
of u grams in either set, s in both, a band has the same key with C(s, 6) / C(u, 6): at J = 0.70
0.9 % are missed for u = 100, 1.3 % for 50, 1.6 % for 40.  Sketches agree under each order with the
chance J + (1 - J) / 4; least_agreement keeps what they lose below SKETCH_LOSS (0.01 %) at just the
wanted similarity, for sets of any size, and it falls fast above.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlens.llm.shingles import GRAM_BITS, MASK, ExactGrams, WordHash, batch_grams, mix, words
from postlens.session import cut

#: Sets smaller than this have short paths as well (so have their largest possible partners).
SMALL = 20
_COPIES = np.uint64(0x5851F42D4C957F2D)
#: Bits of a node's key; two nodes with one key only make more candidates.
NODE_BITS = 44
NODE_MASK = np.uint64((1 << NODE_BITS) - 1)
#: Texts of a node that one task pairs, and the sides of the grid for larger nodes.
CROWD, SIDES = 4096, 64
#: Grams of a set that are looked at for its smallest ones, on average.
NEAR = 20
#: Orders that give two bits each to a text's sketch: 32 fill a column of their own, 8 the bits below a node's key.
SKETCHED, IN_COLUMN = 40, 32
BELOW_NODE = 64 - NODE_BITS
#: Chance that sketches drop a pair of just the wanted similarity.
SKETCH_LOSS = 1e-4


def least_agreement(similarity: float, orders: int) -> int:
    """The most orders under which sketches can be asked to agree, for a loss below SKETCH_LOSS."""
    p, lost = similarity + (1 - similarity) / 4, 0.0
    for k in range(orders + 1):
        lost += comb(orders, k) * p**k * (1 - p) ** (orders - k)
        if lost > SKETCH_LOSS:
            return k
    return orders


def agreement(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Number of orders under which sketches (rows of two numbers) have the same two bits."""
    differ = x ^ y
    differ = (differ | (differ >> np.uint64(1))) & np.uint64(0x5555555555555555)
    return SKETCHED - np.bitwise_count(differ).sum(axis=-1, dtype=np.int64)


def _paths(n: int, min_words: int, trees: int, depth: int, similarity: float):
    """Function for mapInArrow: (t, text, number of copies), each text once, to (node and second part of the sketch, t, first part)."""
    orders = np.random.default_rng(20_240).integers(1 << 38, 1 << 39, trees, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def node_keys(keys: np.ndarray, sizes: np.ndarray, which: np.ndarray, deep: int, salt: int) -> tuple[np.ndarray, np.ndarray]:
        """One key per tree and chosen document, and the documents' sketches; sets smaller than the depth end at their last gram."""
        chosen = np.zeros(len(sizes), bool)
        chosen[which] = True
        keys, own = keys[np.repeat(chosen, sizes)], sizes[which]
        doc, gram, starts = keys & ~MASK, keys & MASK, np.cumsum(own) - own
        # the smallest few are mostly among the grams below a bound; a set with too few there takes part with all
        bound = np.repeat(np.minimum(MASK, (NEAR * 2.0**GRAM_BITS / own).astype(np.uint64)), own)
        out, sketch = np.empty((trees, len(which)), np.uint64), np.zeros((len(which), 2), np.uint64)
        for k, a in enumerate(orders):
            value = (gram * a) & MASK
            near = value <= bound
            count = np.add.reduceat(near, starts, dtype=np.int64)
            if (lacking := count < np.minimum(own, deep)).any():
                near |= np.repeat(lacking, own)
                count[lacking] = own[lacking]
            steps = np.minimum(np.arange(deep)[None, :], (count - 1)[:, None]) + (np.cumsum(count) - count)[:, None]
            level = np.sort(doc[near] | value[near])[steps] & MASK
            h = np.full(len(which), 1 + k + salt * 1000, np.uint64)
            for j in range(deep):
                h = mix(h * np.uint64(0x9E3779B97F4A7C15) + level[:, j])
                if j == 0 and k < SKETCHED:
                    sketch[:, k // IN_COLUMN] |= (h & np.uint64(3)) << np.uint64(k % IN_COLUMN * 2)
            out[k] = h
        return out, sketch

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHash()
        for batch in batches:
            t, count = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 2))
            texts = batch.column(1).to_pylist()
            for at in range(0, len(texts), 2000):
                lists = [words(x) for x in texts[at : at + 2000]]
                long = np.array([len(ws) >= min_words for ws in lists], dtype=bool)
                lists = [ws for ws, ok in zip(lists, long, strict=True) if ok]
                if not lists:
                    continue
                ids, often = t[at : at + 2000][long].view(np.uint64), count[at : at + 2000][long]
                keys, sizes = batch_grams(lists, n, hashes)
                some = np.flatnonzero(sizes > 0)
                small = np.flatnonzero((sizes > 0) & (sizes < SMALL / similarity))
                found = [(*node_keys(keys, sizes, some, depth, 0), some)]
                if len(small):
                    found.append((node_keys(keys, sizes, small, 2, 1)[0], found[0][1][np.searchsorted(some, small)], small))
                # a text with copies meets itself below a node of its own
                own = np.repeat(ids[often > 1], 2)
                node = np.concatenate([*(k.ravel() for k, _, _ in found), mix(own ^ _COPIES)]) << np.uint64(BELOW_NODE)
                text = np.concatenate([*(np.tile(ids[i], trees) for _, _, i in found), own])
                sketch = np.concatenate([*(np.tile(x, (trees, 1)) for _, x, _ in found), np.zeros((len(own), 2), np.uint64)])
                cols = (node | sketch[:, 1], text, sketch[:, 0])
                yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(x).view(np.int64)) for x in cols], ["node", "t", "s"])

    return run


_PAIR = ["cell", "a", "b", "s"]


def _rows(*columns: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(x, np.int64)) for x in columns], _PAIR[: len(columns)])


class _Pairs:
    """Pairs on their way out, each once as far as one task sees: cell 0, the smaller text, the larger.

    Texts come as rows: the text, then the two numbers of its sketch unless ``least``, the number of
    orders under which the sketches of a pair have to agree, is 0.
    """

    SIZE = 500_000

    def __init__(self, least: int = 0) -> None:
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.size, self.least = 0, least

    def add(self, x: np.ndarray, y: np.ndarray) -> Iterator[pa.RecordBatch]:
        if self.least and len(x):
            like = agreement(x[:, 1:].view(np.uint64), y[:, 1:].view(np.uint64)) >= self.least
            x, y = x[like], y[like]
        x, y = x[:, 0], y[:, 0]
        if len(x):
            self.parts.append((np.minimum(x, y), np.maximum(x, y)))
            self.size += len(x)
            if self.size >= self.SIZE:
                yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.parts:
            a, b = (np.concatenate(v) for v in zip(*self.parts, strict=True))
            order = np.lexsort((b, a))
            a, b = a[order], b[order]
            fresh = np.concatenate(([True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])))
            none = np.zeros(int(fresh.sum()), np.int64)
            yield _rows(none, a[fresh], b[fresh], *[none] * bool(self.least))
            self.parts, self.size = [], 0

    def among(self, members: np.ndarray, others: np.ndarray | None = None) -> Iterator[pa.RecordBatch]:
        """All pairs of members, or of members with others."""
        for i in range(0, len(members), 64):
            some = members[i : i + 64]
            if others is not None:
                yield from self.add(np.repeat(some, len(others), axis=0), np.tile(others, (len(some), 1)))
                continue
            x, y = np.triu_indices(len(some), 1)
            yield from self.add(some[x], some[y])
            rest = members[i + 64 :]
            yield from self.add(np.repeat(some, len(rest), axis=0), np.tile(rest, (len(some), 1)))

    def below(self, t: np.ndarray, starts: np.ndarray, width: np.ndarray) -> Iterator[pa.RecordBatch]:
        """All pairs of each run of t; runs of one width are taken together."""
        for w in np.unique(width[width > 1]):
            these = starts[width == w]
            if w > 64:
                for start in these:
                    yield from self.among(t[start : start + w])
                continue
            x, y = np.triu_indices(w, 1)
            yield from self.add(t[(these[:, None] + x).ravel()], t[(these[:, None] + y).ravel()])


def _dealt(node: int, members: np.ndarray) -> pa.RecordBatch:
    """Rows (cell, text, side) of a crowded node: each text goes to all cells of its row and column of the grid.
    A sketch goes along, its first part in a column more, its second above the side's two bits."""
    side = (mix(np.ascontiguousarray(members[:, 0]).view(np.uint64)) % np.uint64(SIDES)).astype(np.int64)
    rows, own = np.repeat(members, SIDES, axis=0), np.repeat(side, SIDES)
    other = np.tile(np.arange(SIDES), len(members))
    low, high = np.minimum(own, other), np.maximum(own, other)
    cell = mix(np.uint64(node & (2**64 - 1)) + (low * SIDES + high).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(2)
    where = np.where(low == high, 2, (own == high).astype(np.int64))
    if rows.shape[1] == 1:
        return _rows(cell.astype(np.int64) + 1, rows[:, 0], where)
    return _rows(cell.astype(np.int64) + 1, rows[:, 0], where | (rows[:, 2] << 2), rows[:, 1])


class _Tail:
    """The node that a batch ends in, whose texts may go on in the next one; a crowded one is dealt out as it comes."""

    def __init__(self, pairs: _Pairs) -> None:
        self.pairs = pairs
        self.start(None)

    def start(self, node: int | None) -> None:
        self.node, self.members, self.size, self.crowded = node, [], 0, False

    def add(self, t: np.ndarray) -> Iterator[pa.RecordBatch]:
        if not self.crowded:
            self.members.append(t)
            self.size += len(t)
            if self.size <= CROWD:
                return
            self.crowded, t, self.members = True, np.concatenate(self.members), []
        for at in range(0, len(t), CROWD):
            yield _dealt(self.node, t[at : at + CROWD])

    def close(self) -> Iterator[pa.RecordBatch]:
        if self.size > 1 and not self.crowded:
            yield from self.pairs.among(np.concatenate(self.members))


def _below_nodes(batches: Iterator[pa.RecordBatch], least: int = 0) -> Iterator[pa.RecordBatch]:
    """(cell, a, b) from (node, t) sorted by both: pairs of the texts of a node, with cell 0;
    (t, t) for a text with copies; for a crowded node its texts by cells of the grid, see _dealt.
    With ``least`` from _paths' rows, with a column more: only pairs whose sketches agree so often."""
    pairs, last = _Pairs(least), None
    tail = _Tail(pairs)
    for batch in batches:
        if not batch.num_rows:
            continue
        node, t = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(2))
        rows = t[:, None]
        if least:
            packed = node.view(np.uint64)
            node = (packed >> np.uint64(BELOW_NODE)).view(np.int64)
            below = (packed & np.uint64((1 << BELOW_NODE) - 1)).view(np.int64)
            rows = np.stack([t, batch.column(2).to_numpy(zero_copy_only=False), below], axis=1)
        again = np.concatenate(([last == (node[0], t[0])], (node[1:] == node[:-1]) & (t[1:] == t[:-1])))
        last = (node[-1], t[-1])
        copies = (mix(t.view(np.uint64) ^ _COPIES) & NODE_MASK).view(np.int64) == node
        same = rows[again & copies]
        yield from pairs.add(same, same)
        node, rows = node[~again], rows[~again]
        if not len(node):
            continue
        edges = np.flatnonzero(np.concatenate(([True], node[1:] != node[:-1], [True])))
        begin = int(node[0] == tail.node)
        if begin:
            yield from tail.add(rows[: edges[1]])
        if begin < len(edges) - 1:
            yield from tail.close()
            starts, width = edges[begin:-2], np.diff(edges)[begin:-1]
            for start, size in zip(starts[width > CROWD], width[width > CROWD], strict=True):
                tail.start(int(node[start]))
                yield from tail.add(rows[start : start + size])
            yield from pairs.below(rows, starts[width <= CROWD], width[width <= CROWD])
            tail.start(int(node[-1]))
            yield from tail.add(rows[edges[-2] :])
    yield from tail.close()
    yield from pairs.flush()


def _in_cells(batches: Iterator[pa.RecordBatch], least: int = 0) -> Iterator[pa.RecordBatch]:
    """(a, b): pairs as they come but for repetitions, and the pairs of each cell of a grid, from rows sorted by (cell, a, b);
    with ``least`` only those of a cell whose sketches agree so often."""
    kept, pairs, cell, low, high = _Pairs(), _Pairs(least), None, [], []

    def ends(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r in rows:
            yield pa.RecordBatch.from_arrays([r.column(1), r.column(2)], ["a", "b"])

    def one_each(rows: np.ndarray) -> np.ndarray:
        return rows[np.unique(rows[:, 0], return_index=True)[1]]

    def emptied() -> Iterator[pa.RecordBatch]:
        x, y = (one_each(np.concatenate(v)) if v else np.empty((0, 1), np.int64) for v in (low, high))
        if len(x):
            # side 0 meets side 1; a cell without side 1 is on the diagonal, where all meet all
            yield from pairs.among(x, y if diagonal is False else None)

    diagonal = False
    for batch in batches:
        c, a, b = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(3))
        yield from ends(kept.add(a[c == 0, None], b[c == 0, None]))
        rows = a[c > 0, None]
        if least:
            rows = np.stack([rows[:, 0], batch.column(3).to_numpy(zero_copy_only=False)[c > 0], b[c > 0] >> 2], axis=1)
        b, c = b[c > 0] & 3, c[c > 0]
        edges = np.flatnonzero(np.concatenate(([True], c[1:] != c[:-1], [True]))) if len(c) else np.zeros(1, int)
        for start, end in zip(edges[:-1], edges[1:], strict=True):
            if c[start] != cell:
                yield from ends(emptied())
                cell, low, high = c[start], [], []
            diagonal = bool(b[start] == 2)
            low.append(rows[start:end][b[start:end] != 1])
            high.append(rows[start:end][b[start:end] == 1])
    yield from ends(emptied())
    yield from ends(kept.flush())
    yield from ends(pairs.flush())


def _verify(n: int, similarity: float):
    """Function for mapInArrow: (a, b, text_a, text_b) to (a, b, jaccard) of the pairs similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        exact, kept = ExactGrams(n), {}

        def grams(key: int, text: str) -> np.ndarray:
            if key not in kept:
                kept[key] = exact.of(text)
            return kept[key]

        for batch in batches:
            if exact.full():
                exact, kept = ExactGrams(n), {}
            if len(kept) > 20_000:
                kept.clear()
            a, b, ta, tb = (batch.column(k).to_pylist() for k in range(4))
            rows = []
            for x, y, tx, ty in zip(a, b, ta, tb, strict=True):
                if x == y:
                    rows.append((x, y, 1.0))
                    continue
                gx, gy = grams(x, tx), grams(y, ty)
                small, large = sorted((len(gx), len(gy)))
                if not small or small < similarity * large:
                    continue
                shared = len(np.intersect1d(gx, gy, assume_unique=True))
                if shared >= similarity * (small + large - shared) - 1e-9:
                    rows.append((x, y, shared / (small + large - shared)))
            cols = list(zip(*rows, strict=True)) if rows else [(), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.float64())], ["a", "b", "jaccard"])

    return run


def text_key(text: Column) -> Column:
    return F.xxhash64(text)


def similar_texts(rows: DataFrame, text: str, n: int = 5, similarity: float = 0.8, min_words: int = 1, trees: int = 40, depth: int = 6) -> DataFrame:
    """``a``, ``b``, ``jaccard``: keys of different texts that are similar enough (a < b), and
    (a, a, 1.0) for each text that occurs more than once.

    Null texts and texts with fewer than ``min_words`` words take part in nothing; whole texts are
    used, however long.  Ties don't exist.  Every pair that comes out is similar enough, by its exact
    sets; a pair that is similar enough can be missed with the chances given above.
    """
    given = rows.where(F.col(text).isNotNull()).select(text_key(F.col(text)).alias("t"), F.col(text).alias("text"))
    # the condition keeps the count wherever the texts are read, so that they are shuffled once for all
    once = given.groupBy("t").agg(F.first("text").alias("text"), F.count("*").alias("n")).where("n > 0")
    sketched = min(trees, SKETCHED)
    least = least_agreement(similarity, sketched) + SKETCHED - sketched
    nodes = once.mapInArrow(_paths(n, min_words, trees, depth, similarity), "node bigint, t bigint, s bigint")
    by_node = nodes.repartition(F.shiftrightunsigned("node", BELOW_NODE)).sortWithinPartitions("node", "t")
    dealt = by_node.mapInArrow(lambda batches: _below_nodes(batches, least), "cell bigint, a bigint, b bigint, s bigint")
    # equal pairs, and the texts of a cell, come together; a pair that two cells give meets itself only after them
    together = F.when(F.col("cell") == 0, F.xxhash64("a", "b")).otherwise(F.col("cell"))
    by_cell = dealt.repartition(together).sortWithinPartitions("cell", "a", "b")
    met = by_cell.mapInArrow(lambda batches: _in_cells(batches, least), "a bigint, b bigint").distinct()
    # (t, t) takes the same way without a text, so that the candidates are worked out once
    other = F.col("a") != F.col("b")
    side = lambda name: once.select(F.col("t").alias(f"_{name}"), F.col("text").alias(f"text_{name}"))
    with_b = met.join(side("b"), other & (F.col("b") == F.col("_b")), "left")
    with_both = with_b.join(side("a"), other & (F.col("a") == F.col("_a")), "left")
    return with_both.select("a", "b", "text_a", "text_b").mapInArrow(_verify(n, similarity), "a bigint, b bigint, jaccard double")


def similar_rows(rows: DataFrame, key: str, text: str, **options) -> DataFrame:
    """``row_id_a``, ``row_id_b`` (the smaller first): every pair of rows whose texts are similar enough."""
    links = similar_texts(rows, text, **options)
    places = rows.where(F.col(text).isNotNull()).select(text_key(F.col(text)).alias("t"), F.col(key).alias("row"))
    left = links.join(places.select(F.col("t").alias("a"), F.col("row").alias("ra")), "a")
    both = left.join(places.select(F.col("t").alias("b"), F.col("row").alias("rb")), "b").where("a != b OR ra < rb")
    return both.select(F.least("ra", "rb").alias("row_id_a"), F.greatest("ra", "rb").alias("row_id_b"))


def components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 40) -> DataFrame:
    """``node``, ``root``: the smallest node of each node's connected component.

    Every round links each node to the smallest node seen around it and halves the way to the
    root; the rounds grow with the logarithm of a component's diameter.  Lineage is cut by a
    reliable checkpoint in each round; only one count per round reaches the driver.
    """
    both = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u != v")
    links = cut(both.unionByName(both.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct())
    for _ in range(max_rounds):
        # large star: larger neighbours of u are linked to the smallest node around u
        low = links.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = links.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        # small star: u and its smaller neighbours are linked to the smallest of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("x"), "m").where("x != m").select(F.col("x").alias("u"), F.col("m").alias("v"))
        new = cut(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        stars = new.groupBy("u").agg(F.count("*").alias("n")).where("n > 1").limit(1).count() == 0 and new.join(new.select(F.col("u").alias("v"), F.col("v").alias("w")), "v").limit(1).count() == 0
        if stars:
            roots = new.select(F.col("u").alias("node"), F.col("v").alias("root"))
            return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
        links = cut(new.unionByName(new.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct())
    raise RuntimeError("components did not settle")


def classes(rows: DataFrame, key: str, text: str, **options) -> DataFrame:
    """``row_id``, ``class_id``, ``n_links``: one row per row with a text; rows whose texts are linked,
    directly or through others, share a class; ``n_links`` counts the different texts linked to
    the row's text.  A text without links is a class of its own, named by its key."""
    links = cut(similar_texts(rows, text, **options).where("a != b"))
    roots = components(links)
    degree = links.select(F.col("a").alias("node")).unionByName(links.select(F.col("b").alias("node"))).groupBy("node").agg(F.count("*").alias("n_links"))
    known = roots.join(degree, "node")
    given = rows.where(F.col(text).isNotNull()).select(F.col(key).alias("row_id"), text_key(F.col(text)).alias("node"))
    return given.join(known, "node", "left").select("row_id", F.coalesce("root", "node").alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"))
