"""Benchmark decontamination by spaced seeds.

Words are runs of letters and digits, lower-cased. A mask looks at some of SPAN
neighbouring words and ignores the others, so a passage with words exchanged
still shares hashes with its original wherever the exchanged words fall on
ignored places. Besides, every item is cut into so many blocks that, when a fifth of
it differs, one block differs in one word at most; masks of a block's length that
ignore each of its places in turn find that one, so no such item is missed.

1. Hashes of every mask at every place of the test items are a table. The distinct
   ones, sorted, are sent to every task, with how far their items reach to both sides;
   items are dealt in blocks so that these are no more than SEEDS_AT_ONCE, about.
2. Documents are read once per block. Places whose hash is among them (a bit map of
   hashes comes first, then the exact test) are kept, with the hashes of the words as
   far as the items of these hashes reach, as one row per cluster of hits.
3. Hits join the table of test hashes. Each (cluster, item, alignment) is verified
   word by word: the whole item is a leak if all but a fifth of its words are equal,
   else the best stretch, at +1 for an equal and -SUBSTITUTION for an exchanged word,
   if at least MIN_MATCHED words of it are. Words beyond the text's ends differ.

Cases: null and empty texts, and items of fewer than MIN_WORDS words, match
nothing. Rows that repeat give the same leak once; so do items alike in id and words.
Items are told apart by row: those without an id are found and returned under a null
id, and different items of one id each have their leak. Leaks of documents with a null
id are returned under a null id. Ties between stretches go to the longer
match, then the earlier place. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vidlake.llm.common import TEXT_HASH, as_long, free_name, hashes, map_texts, odd_multipliers, save, share, text_of
from vidlake.llm.toxicity import _FOLD

# Places a mask looks at.
MASKS = ("110101011", "111010011", "101100111", "110011101")
SPAN = 9
# Masks of a block, by its length: all words but one. Without the first or the last
# word it is the same shorter mask, which also fits at the ends of a text.
BLOCKS = {
    5: ("1111", "10111", "11011", "11101"),
    7: ("111111", "1011111", "1101111", "1110111", "1111011", "1111101"),
}
ALL_MASKS = (*MASKS, *BLOCKS[5], *BLOCKS[7])
MIN_WORDS = 5
MIN_MATCHED = 12
SUBSTITUTION = 2
# Distinct seeds of the items that one pass over the documents looks for, about; a task
# holds 16 bytes of each, and 8 to 16 of the bit map.
SEEDS_AT_ONCE = 2_000_000

_PLACE = odd_multipliers(SPAN, 21)


def _tokens(text: str) -> np.ndarray:
    return hashes(text.encode("utf-8", "surrogatepass").translate(_FOLD).split())


def seeds(tokens: np.ndarray, *masks: str) -> list[np.ndarray]:
    """For each mask the hash of the looked-at words at every place where it fits. Sums of
    hashes times odd numbers spread as well as the hashes do."""
    products = [tokens * by for by in _PLACE]
    found = []
    for mask in masks:
        n = max(0, len(tokens) - len(mask) + 1)
        total = np.full(n, int(mask, 2), np.uint64)
        for k, bit in enumerate(mask):
            if bit == "1":
                total += products[k][k : k + n]
        found.append(total)
    return found


def _needed(n_tokens: int) -> int:
    """Equal words that make a whole item a leak."""
    return -(-4 * n_tokens // 5)


def item_seeds(tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes an item is looked for by, and their places: the spaced masks everywhere,
    and those of its blocks. m blocks hold 2 m - 1 exchanged words at least before each
    of them has two."""
    n = len(tokens)
    if n < MIN_WORDS:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    found = [(hashed, 0) for hashed in seeds(tokens, *MASKS)]
    blocks = (n - _needed(n) + 2) // 2
    length = max(b for b in BLOCKS if b <= n // blocks)
    for first in range(0, blocks * (n // blocks), n // blocks):
        found += [(hashed, first) for hashed in seeds(tokens[first : first + length], *BLOCKS[length])]
    return (
        np.concatenate([hashed for hashed, _ in found]),
        np.concatenate([np.arange(len(hashed)) + first for hashed, first in found]),
    )


def _items(benchmark: DataFrame) -> DataFrame:
    """item_id, tokens, n_tokens, and the seeds with their places."""

    def cut(batch: pa.RecordBatch) -> dict:
        out: dict[str, list] = {"item_id": [], "tokens": [], "n_tokens": [], "hash": [], "at": []}
        for item, text in zip(batch.column("item_id").to_pylist(), batch.column("text").to_pylist()):
            tokens = _tokens(text_of(text))
            hashed, at = item_seeds(tokens)
            if len(hashed):
                out["item_id"].append(item)
                out["tokens"].append(tokens.tobytes())
                out["n_tokens"].append(len(tokens))
                out["hash"].append(as_long(hashed))
                out["at"].append(at)
        types = {"item_id": pa.int64(), "tokens": pa.binary(), "n_tokens": pa.int64()}
        lists = pa.list_(pa.int64())
        return {k: pa.array(v, types.get(k, lists)) for k, v in out.items()}

    return map_texts(
        benchmark.select("item_id", "text"),
        cut,
        "item_id long, tokens binary, n_tokens long, hash array<long>, at array<long>",
    )


class _Seeds:
    """Sorted hashes, how far the items of each reach to both sides, and a bit map."""

    def __init__(self, rows: pa.Table):
        rows = rows.sort_by("hash")
        self.hash = rows.column("hash").to_numpy()
        self.before = rows.column("before").to_numpy().astype(np.int32)
        self.after = rows.column("after").to_numpy().astype(np.int32)
        self.bits = max(16, (64 * len(self.hash)).bit_length())
        flags = np.zeros(1 << (self.bits - 3), np.uint8)
        low = self.hash & ((1 << self.bits) - 1)
        np.bitwise_or.at(flags, low >> 3, (1 << (low & 7)).astype(np.uint8))
        self.flags = flags

    def find(self, hashed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of some hashes are there, and where."""
        hashed = as_long(hashed)
        low = hashed & ((1 << self.bits) - 1)
        at = np.flatnonzero(self.flags[low >> 3] >> (low & 7).astype(np.uint8) & 1)
        place = np.minimum(np.searchsorted(self.hash, hashed[at]), len(self.hash) - 1)
        same = self.hash[place] == hashed[at]
        return at[same], place[same]


def _clusters(docs: DataFrame, known: _Seeds) -> DataFrame:
    """doc_id, first word, hashes of the words, and hits (place, hash)."""
    shared = share(docs.sparkSession, known)

    def find(batch: pa.RecordBatch) -> dict:
        wanted = shared.value
        out: dict[str, list] = {"doc_id": [], TEXT_HASH: [], "first": [], "tokens": [], "at": [], "hash": []}
        rows = zip(*(batch.column(c).to_pylist() for c in ("doc_id", TEXT_HASH, "text")))
        for doc, text_hash, text in rows:
            tokens = _tokens(text_of(text))
            hashed = seeds(tokens, *ALL_MASKS)
            sizes = np.array([len(h) for h in hashed])
            found, place = wanted.find(np.concatenate(hashed))
            if not len(found):
                continue
            # Places within the mask's own row of hashes.
            at = found - np.repeat(np.cumsum(sizes) - sizes, sizes)[found]
            start = np.maximum(at - wanted.before[place], 0)
            end = np.minimum(at + wanted.after[place], len(tokens))
            order = np.argsort(start, kind="stable")
            at, start, end, place = at[order], start[order], end[order], place[order]
            so_far = np.maximum.accumulate(end)
            for own in np.split(np.arange(len(at)), np.flatnonzero(start[1:] > so_far[:-1]) + 1):
                first, last = int(start[own[0]]), int(so_far[own[-1]])
                out["doc_id"].append(doc)
                out[TEXT_HASH].append(text_hash)
                out["first"].append(first)
                out["tokens"].append(tokens[first:last].tobytes())
                out["at"].append(at[own])
                out["hash"].append(wanted.hash[place[own]])
        longs, lists = pa.int64(), pa.list_(pa.int64())
        types = {"doc_id": longs, TEXT_HASH: longs, "first": longs, "tokens": pa.binary(), "at": lists, "hash": lists}
        return {k: pa.array(v, types[k]) for k, v in out.items()}

    return map_texts(
        docs.select("doc_id", F.xxhash64("text").alias(TEXT_HASH), "text"),
        find,
        f"doc_id long, {TEXT_HASH} long, first long, tokens binary, at array<long>, hash array<long>",
    )


def best_stretch(equal: np.ndarray) -> tuple[int, int, int]:
    """Start, end and equal words of the stretch with the highest score, the longest
    and then the first of several."""
    total = np.r_[0, np.cumsum(np.where(equal, 1, -SUBSTITUTION))]
    gain = total - np.minimum.accumulate(total)
    ends = np.flatnonzero(gain == gain.max())
    starts = np.array([total[: end + 1].argmin() for end in ends])
    at = int((ends - starts).argmax())
    start, end = int(starts[at]), int(ends[at])
    return start, end, int(equal[start:end].sum())


def leaked(equal: np.ndarray, n_item: int) -> tuple[int, int, int] | None:
    """Start, end and equal words of the leak of an aligned item, or None."""
    n_equal = int(equal.sum())
    if n_equal >= _needed(n_item):
        places = np.flatnonzero(equal)
        return int(places[0]), int(places[-1]) + 1, n_equal
    if n_equal < MIN_MATCHED:
        return None
    found = best_stretch(equal)
    return found if found[2] >= MIN_MATCHED else None


_RESULT = (
    "doc_id long, item long, first_word long, last_word long, n_equal int, n_item_words int, " + f"{TEXT_HASH} long"
)


def leaks(docs: DataFrame, benchmark: DataFrame, seeds_at_once: int = SEEDS_AT_ONCE) -> DataFrame:
    """doc_id, item_id, first_word, last_word (of the document, counted from 0),
    n_equal, n_item_words of every leak: a row for each document and item."""
    spark = docs.sparkSession
    items = _items(benchmark).dropDuplicates(["item_id", "tokens"])
    items = save(items.withColumn("item", F.monotonically_increasing_id()), "items")
    size = items.agg(F.count("*").alias("items"), F.sum(F.size("hash")).alias("seeds")).first()
    blocks = -(-(size["seeds"] or 0) // seeds_at_once)
    found = None
    for number in range(blocks):
        # Items are of a size, but for few, so blocks are alike.
        block = items.filter(F.pmod(F.xxhash64("item"), F.lit(blocks)) == number)
        some = _leaks_of(docs, block)
        found = some if found is None else found.unionByName(some)
    if found is None:
        found = spark.createDataFrame([], _RESULT)
    best = F.max(F.struct("n_equal", (-F.col("first_word")).alias("m"), "last_word", "n_item_words")).alias("best")
    ids = items.select("item", "item_id")
    return found.groupBy("doc_id", TEXT_HASH, "item").agg(best).join(ids, "item").select(
        "doc_id",
        "item_id",
        (-F.col("best.m")).alias("first_word"),
        "best.last_word",
        "best.n_equal",
        "best.n_item_words",
        TEXT_HASH,
    )


def _leaks_of(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Leaks of some items, by the number of the item."""
    table = items.select("item", "n_tokens", F.explode(F.arrays_zip("hash", "at")).alias("s"))
    table = table.select("item", "n_tokens", F.col("s.hash").alias("hash"), F.col("s.at").alias("item_at"))
    reach = table.groupBy("hash").agg(
        F.max("item_at").alias("before"), F.max(F.col("n_tokens") - F.col("item_at")).alias("after")
    )
    rows = reach.toArrow()
    if not rows.num_rows:
        return docs.sparkSession.createDataFrame([], _RESULT)
    clusters = _clusters(docs, _Seeds(rows))
    clusters = save(clusters.withColumn("cluster", F.monotonically_increasing_id()), "clusters")

    hits = clusters.select("cluster", F.explode(F.arrays_zip("hash", "at")).alias("s"))
    hits = hits.select("cluster", F.col("s.hash").alias("hash"), F.col("s.at").alias("at"))
    aligned = (
        hits.join(table, "hash").select("cluster", "item", (F.col("at") - F.col("item_at")).alias("shift")).distinct()
    )
    both = aligned.join(clusters.select("cluster", "doc_id", TEXT_HASH, "first", "tokens"), "cluster").join(
        items.select("item", F.col("tokens").alias("item_tokens")), "item"
    )

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "item", "first_word", "last_word", "n_equal", "n_item_words", TEXT_HASH]
        types = [pa.int64()] * 4 + [pa.int32()] * 2 + [pa.int64()]
        for batch in batches:
            out: list[list] = [[] for _ in names]
            for row in batch.to_pylist():
                item = np.frombuffer(row["item_tokens"], np.uint64)
                tokens = np.frombuffer(row["tokens"], np.uint64)
                skip = row["shift"] - row["first"]
                low, high = max(0, -skip), min(len(item), len(tokens) - skip)
                if high <= low:
                    continue
                found = leaked(item[low:high] == tokens[low + skip : high + skip], len(item))
                if found:
                    start, end, n_equal = found
                    first = row["shift"] + low + start
                    values = row["doc_id"], row["item"], first, first + end - start - 1, n_equal, len(item)
                    for column, value in zip(out, (*values, row[TEXT_HASH])):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], names)

    return both.mapInArrow(verify, _RESULT)


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold no test item, with all their columns."""
    found = leaks(docs, benchmark).select(F.col("doc_id").alias("leaked_id"), TEXT_HASH).distinct()
    mark = free_name(docs, TEXT_HASH)
    marked = docs.withColumn(mark, F.xxhash64("text"))
    same = marked["doc_id"].eqNullSafe(found["leaked_id"]) & (marked[mark] == found[TEXT_HASH])
    return marked.join(found, same, "left_anti").drop(mark)
