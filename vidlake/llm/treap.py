"""Ranked lexical search over a K2-treap of the term-document grid.

Rows of the grid are the terms that items ask for, columns the documents, and a cell
holds the impact of a term in a document, its weight included. A quadtree is kept level
by level: per node four bits that say which quadrants hold anything, the place of its
first child, and the largest impact below it. For an item, the paths of all its rows
descend jointly over ranges of documents: the sum of the maxima on the paths bounds the
score of each document of the range, and at single documents it is the score. The ranges
with the highest bounds are opened first, until no bound left can reach the k-th best
document.

A first pass over the texts counts terms and keeps what is in the vocabulary of the
items; the corpus figures come from its table. Each task of the second pass builds trees
over runs of its documents and searches all items in them, so nothing is shuffled but a
task's best documents per item. Items are handled in blocks of bounded size.

Odd cases. Null and empty texts have no terms; such documents count for nothing, and such
items find nothing. Every row of documents is a document of its own, with or without an
id; equal scores go by id, those without one last. Equal rows of items are one item;
different texts that share an id are ranked apart. Empty tables give an empty result;
other columns do not matter. Texts are read whole, long ones in pieces.
"""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from vidlake.llm.common import at_work, save, share, slices

# Characters of terms are digits, letters and all beyond ASCII; only
# A-Z are lower-cased.
_TERM_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
PIECE_BYTES = 1 << 22
# Bytes of items that are searched at once; more are searched in several blocks.
ITEM_BYTES = 16_000_000
# A tree has no more documents and about no more cells than this.
RANGE_DOCS = 1 << 15
RANGE_CELLS = 1 << 21
# Document ranges opened at once, at first and at most.
OPEN_FIRST, OPEN_MOST = 8, 4096

_POSTINGS = "doc_id long, n long, terms array<int>, times array<int>"
_FOUND = "item int, doc_id long, score long"
_BITS = np.array([bin(i).count("1") for i in range(16)], np.int32)


def terms(text: str) -> Iterator[list[bytes]]:
    """The terms of a text, in lists of bounded size."""
    data = text.encode("utf-8", "surrogatepass").translate(_TERM_BYTES)
    start = 0
    while len(data) - start > PIECE_BYTES:
        end = data.rfind(b" ", start + 1, start + PIECE_BYTES)
        end = data.find(b" ", start + PIECE_BYTES) if end < 0 else end
        if end < 0:
            break
        yield data[start:end].split()
        start = end
    yield data[start:].split()


def _postings(docs: DataFrame, vocabulary) -> DataFrame:
    """Number of terms of each document, and how often those of the vocabulary occur."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at_work(__name__)
        known = vocabulary.value
        for batch in slices(batches):
            n, ends, rows, times = [], [0], [], []
            for text in batch.column("text"):
                total, found = 0, Counter()
                for part in terms(text.as_py() or ""):
                    total += len(part)
                    found.update(map(known.get, part))
                found.pop(None, None)
                n.append(total)
                rows += found.keys()
                times += found.values()
                ends.append(len(rows))
            lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(x, pa.int32())) for x in (rows, times)]
            arrays = [batch.column("doc_id"), pa.array(n, pa.int64()), *lists]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "n", "terms", "times"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, _POSTINGS)


def _spread(values: np.ndarray) -> np.ndarray:
    """Bits of numbers below 2**32 moved to every other place."""
    values = values.astype(np.uint64)
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F),
                        (2, 0x3333333333333333), (1, 0x5555555555555555)):
        values = (values | values << np.uint64(shift)) & np.uint64(mask)
    return values


class K2Treap:
    """A quadtree over a sparse grid with the largest value below every node. Level 0
    are the cells; the root is the one node of the highest level."""

    def __init__(self, rows: np.ndarray, columns: np.ndarray, values: np.ndarray):
        side = int(max(rows.max(initial=0), columns.max(initial=0)))
        self.height = side.bit_length()
        code = (_spread(rows) << np.uint64(1) | _spread(columns)).astype(np.int64)
        order = np.argsort(code)
        code, most = code[order], values[order].astype(np.int64)
        # Each level ends with a node that has nothing, for paths that have ended.
        self.most = [np.append(most, 0)]
        self.mask: list[np.ndarray] = [np.zeros(0, np.uint8)]
        self.first: list[np.ndarray] = [np.zeros(0, np.int32)]
        for _ in range(self.height):
            parent = code >> 2
            starts = np.flatnonzero(np.append(True, parent[1:] != parent[:-1]))
            if not len(code):
                starts = starts[:0]
            bits = (1 << (code & 3)).astype(np.uint8)
            mask = np.add.reduceat(bits, starts) if len(starts) else bits
            most = np.maximum.reduceat(most, starts) if len(starts) else most
            code = parent[starts]
            self.mask.append(np.append(mask, 0).astype(np.uint8))
            self.first.append(np.append(starts, 0).astype(np.int32))
            self.most.append(np.append(most, 0))

    def children(self, level: int, nodes: np.ndarray, quadrants: np.ndarray) -> np.ndarray:
        """Places, one level down, of the nodes in the given quadrants."""
        mask = self.mask[level][nodes]
        below = self.first[level][nodes] + _BITS[mask & ((1 << quadrants) - 1)]
        return np.where(mask >> quadrants & 1, below, len(self.most[level - 1]) - 1)

    def search(self, rows: np.ndarray, times: np.ndarray, k: int, floor: int) -> list[tuple[int, int]]:
        """Score and column of the k best columns for some rows, of those that score at
        least ``floor``; equal scores by column."""
        best: list[tuple[int, int]] = []  # a heap of (score, -column), the worst first
        # By level: bounds, first columns and the places of all paths.
        waiting: list[tuple | None] = [None] * (self.height + 1)
        root = np.zeros((1, len(rows)), np.int32)
        waiting[self.height] = (self.most[self.height][root] @ times, np.zeros(1, np.int64), root)
        size = OPEN_FIRST
        while True:
            least, last = (best[0][0], -best[0][1]) if len(best) == k else (floor, None)
            there = [x for x in waiting if x is not None]
            if not there:
                break
            bounds = np.concatenate([x[0] for x in there])
            # Of the open ranges the size best: all above that bound, then by column.
            limit = np.partition(bounds, len(bounds) - size)[len(bounds) - size] if len(bounds) > size else 0
            size = min(2 * size, OPEN_MOST)
            opened = []
            for level, x in enumerate(waiting):
                if x is None:
                    continue
                bound, start, paths = x
                live = bound >= max(least, 1)
                if last is not None:
                    # Equal scores of later columns come after the k-th.
                    live &= (bound > least) | (start < last)
                go = live & (bound >= limit)
                if (ties := int(np.count_nonzero(go & (bound == limit)))) > size:
                    # Many ranges alike: those of the first columns first.
                    alike = np.flatnonzero(go & (bound == limit))
                    go[alike[np.argsort(start[alike], kind="stable")[size:]]] = False
                if go.any():
                    opened.append((level, bound[go], start[go], paths[go]))
                rest = live & ~go
                waiting[level] = (bound[rest], start[rest], paths[rest]) if rest.any() else None
            if not opened and all(x is None for x in waiting):
                break
            for level, bound, start, paths in opened:
                if level == 0:
                    order = np.lexsort((start, -bound))[: k]
                    for score, column in zip(bound[order].tolist(), start[order].tolist()):
                        if len(best) < k:
                            heapq.heappush(best, (score, -column))
                        elif (score, -column) > best[0]:
                            heapq.heapreplace(best, (score, -column))
                    continue
                row_bits = (rows >> (level - 1) & 1) << 1
                for side in (0, 1):
                    down = self.children(level, paths, row_bits | side)
                    bounds_down = self.most[level - 1][down] @ times
                    keep = bounds_down >= max(least, 1)
                    if keep.any():
                        new = (bounds_down[keep], (start | side << (level - 1))[keep], down[keep])
                        old = waiting[level - 1]
                        waiting[level - 1] = new if old is None else tuple(map(np.concatenate, zip(old, new)))
        return sorted(((score, -column) for score, column in best), key=lambda x: (-x[0], x[1]))


def _impacts(n: np.ndarray, docs: np.ndarray, rows: np.ndarray, times: np.ndarray, corpus: tuple) -> np.ndarray:
    """Weight times term impact, per cell of the grid, in whole numbers."""
    documents, total, weights, _ = corpus
    m = np.array([100 - 25 + 25 * int(x) * documents // total for x in n], np.int64)
    times = times.astype(np.int64)
    return weights[rows] * (1_000_000_000 * times // (1000 * times + 12 * m[docs]))


class _Items:
    """Items as rows of the grid and how often each asks for them."""

    def __init__(self, ids: list, asked: list[dict[int, int]]):
        self.ids = ids
        self.rows = [np.fromiter(x.keys(), np.int64, len(x)) for x in asked]
        self.times = [np.fromiter(x.values(), np.int64, len(x)) for x in asked]


def _search(postings: DataFrame, items, corpus, k: int) -> DataFrame:
    """The best documents of each task for each item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked: _Items = items.value
        #: Per item score, whether the document has no id, and its id; the best first.
        best: list[list[tuple[int, bool, int]]] = [[] for _ in asked.ids]

        def look(held: list[pa.RecordBatch]) -> None:
            table = pa.Table.from_batches(held).combine_chunks().sort_by([("doc_id", "ascending")])
            lengths = table.column("terms").combine_chunks().value_lengths().to_numpy()
            rows = table.column("terms").combine_chunks().flatten().to_numpy()
            rows = corpus.value[3][rows]
            times = table.column("times").combine_chunks().flatten().to_numpy()
            docs = np.repeat(np.arange(len(lengths)), lengths)
            values = _impacts(table.column("n").to_numpy(), docs, rows, times, corpus.value)
            some = values > 0
            tree = K2Treap(rows[some], docs[some], values[some])
            ids = table.column("doc_id").to_pylist()
            for i, mine in enumerate(best):
                if not len(asked.rows[i]):
                    continue
                floor = mine[-1][0] if len(mine) == k else 1
                found = tree.search(asked.rows[i], asked.times[i], k, floor)
                mine += [(score, ids[c] is None, ids[c] or 0) for score, c in found]
                mine.sort(key=lambda x: (-x[0], *x[1:]))
                del mine[k:]

        held, cells, docs = [], 0, 0
        for batch in slices(batches, "terms"):
            batch = batch.filter(pc.greater(pc.list_value_length(batch.column("terms")), 0))
            for start in range(0, batch.num_rows, RANGE_DOCS):
                part = batch.slice(start, RANGE_DOCS)
                inside = int(pc.sum(pc.list_value_length(part.column("terms"))).as_py() or 0)
                if held and (docs + part.num_rows > RANGE_DOCS or cells + inside > RANGE_CELLS):
                    look(held)
                    held, cells, docs = [], 0, 0
                held, cells, docs = [*held, part], cells + inside, docs + part.num_rows
        if held and docs:
            look(held)
        rows = [(i, None if none else doc, score) for i, mine in enumerate(best) for score, none, doc in mine]
        columns = list(zip(*rows)) or [[], [], []]
        kinds = (pa.int32(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["item", "doc_id", "score"])

    return postings.select("doc_id", "n", "terms", "times").mapInArrow(run, _FOUND)


def _block(docs: DataFrame, items: list[tuple[int | None, str | None]], k: int) -> DataFrame | None:
    """The search for some items, which are few enough to be sent to every task."""
    spark = docs.sparkSession
    asked: list[Counter] = []
    for _, text in items:
        asked.append(Counter())
        for part in terms(text or ""):
            asked[-1].update(part)
    vocabulary = {term: row for row, term in enumerate(sorted(set().union(*asked)))}
    if not vocabulary:
        return None
    postings = save(_postings(docs, share(spark, vocabulary)), "postings")
    size = postings.agg(F.count_if(F.col("n") > 0).alias("documents"), F.sum("n").alias("total")).first()
    if not size["documents"]:
        return None
    # No more rows than the vocabulary has.
    held = postings.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    weight = F.floor(1000 * F.ln((2.0 * size["documents"] + 2) / (2.0 * F.col("df") + 1)))
    weights = np.zeros(len(vocabulary), np.int64)
    for row in held.select("term", weight.alias("weight")).collect():
        weights[row["term"]] = row["weight"]
    # Terms of like weight are neighbours, so that the cells of a node have like values.
    place = np.empty(len(weights), np.int64)
    place[np.argsort(-weights, kind="stable")] = np.arange(len(weights))
    rows = [{int(place[vocabulary[t]]): times for t, times in x.items() if weights[vocabulary[t]]} for x in asked]
    corpus = (size["documents"], size["total"], np.sort(weights)[::-1].copy(), place)
    names = [item_id for item_id, _ in items]
    found = _search(postings, share(spark, _Items(names, rows)), share(spark, corpus), k)
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    best = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    # As many rows as the block has items.
    known = spark.createDataFrame(list(enumerate(names)), "item int, item_id long")
    return best.join(F.broadcast(known), "item").select("item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, k: int = 20, item_bytes: int = ITEM_BYTES) -> DataFrame:
    """item_id, rank, doc_id and score of the k best documents per item; see the module."""
    spark = docs.sparkSession
    wanted = items.select(F.col("item_id").cast("long").alias("item_id"), "text").distinct()
    size = wanted.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 16)).first()[0] or 0
    blocks = max(1, -(-size // item_bytes))
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    result = None
    for i in range(blocks):
        some = [tuple(row) for row in wanted.filter(block == i).collect()]
        found = _block(docs, some, k) if some else None
        if found is not None:
            result = found if result is None else result.unionByName(found)
    empty = "item_id long, rank int, doc_id long, score long"
    return spark.createDataFrame([], empty) if result is None else result
