"""MinHash near-duplicates: HyperMinHash registers, banded, then verified.

A document's set is its distinct 5-word shingles (fewer words: the whole
sequence as one; no words: empty). Shingles are compared by 64-bit hash.

1. Texts with the same words are one node from here on, so exact copies cost one
   row whatever their number.
2. A node gets REGISTERS registers. A shingle falls into one bucket, and the
   bucket keeps the smallest hash as a count of leading zeros (6 bits) and a
   mantissa (10 bits). Buckets no shingle fell into keep the smallest of a hash
   of their own over all shingles, marked by the top bit of another mixing, so
   that two sets agree in a register with probability J at any size.
3. BAND_ROWS registers in a row are a band. With 32 bands of 4, two sets at the
   threshold of 0.75 meet in at least one band but for 5 in a million pairs.
4. Every band value with two nodes or more elects hubs. Nodes are compared to the
   hubs: Jaccard from the registers, corrected for registers that agree by
   chance, drops hopeless pairs (more than five deviations below the threshold),
   and the full sets decide the rest. Links so found join nodes into classes, and
   a large group of copies becomes one class without its pairs being listed.
5. What is left are bands whose nodes are of several classes. Their nodes are
   dealt to tasks with their shingles, CHUNK at a time against CHUNK, and each task
   compares all its pairs of different classes in memory, so pairs that are not
   links are never listed.

Links within a class that were not needed to form it stay unlisted; classes are
the same as if all pairs had been compared.

Cases: null text is empty; empty documents link with nothing and are their own
class. Rows that repeat each get a row. A null id takes part in linking but cannot
name a class unless all ids of the class are null. Other columns are not looked
at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vidlake.llm.common import TEXT_HASH, as_long, files_for, free_name, hashes, map_texts, mix, odd_multipliers, save, sorted_groups, text_of, words

WORDS = 5
# 100 * intersection >= THRESHOLD * union.
THRESHOLD = 75
REGISTERS = 128
BAND_ROWS = 4
MANTISSA_BITS = 10
# Nodes of a band that a task compares with as many others, and shingles of theirs.
CHUNK = 1_000
CHUNK_SHINGLES = 1_000_000
# Registers of two sets at the threshold agree in 0.75 +- 0.038 of cases.
HOPELESS = 0.75 - 5.2 * 0.0383

_ORDER = odd_multipliers(WORDS, 10)
_SALTS = odd_multipliers(REGISTERS, 11)
_BANDS = odd_multipliers(REGISTERS // BAND_ROWS, 12)


def shingles(tokens: list[bytes]) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the 5-word shingles."""
    if not tokens:
        return np.empty(0, np.uint64)
    single = hashes(tokens)
    width = min(WORDS, len(single))
    n = len(single) - width + 1
    total = np.full(n, width, np.uint64)
    for k in range(width):
        total += single[k : k + n] * _ORDER[k]
    return np.unique(mix(total))


def registers(shingled: np.ndarray) -> np.ndarray:
    """HyperMinHash registers of a set that is not empty."""
    hashed = mix(shingled ^ _SALTS[0])
    bucket = (hashed & np.uint64(REGISTERS - 1)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    bucket = bucket[order]
    starts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
    least = np.zeros(REGISTERS, np.uint64)
    least[bucket[starts]] = np.minimum.reduceat(hashed[order], starts)
    empty = np.ones(REGISTERS, bool)
    empty[bucket[starts]] = False
    empty = np.flatnonzero(empty)
    # Few buckets of a large set are empty, and a small set is short: in pieces
    # of about a million values.
    step = max(1, 1_000_000 // len(shingled))
    for at in range(0, len(empty), step):
        own = empty[at : at + step]
        least[own] = mix(shingled[None, :] ^ _SALTS[own][:, None]).min(axis=1)
    # The bucket number is in the lowest bits, so the highest are free.
    zeros = np.zeros(REGISTERS, np.uint64)
    rest = least.copy()
    for width in (32, 16, 8, 4, 2, 1):
        small = rest < np.uint64(1) << np.uint64(64 - width)
        zeros[small] += np.uint64(width)
        rest[small] <<= np.uint64(width)
    zeros = np.minimum(zeros, 63)
    mantissa = (rest << np.uint64(1)) >> np.uint64(64 - MANTISSA_BITS)
    return (zeros << np.uint64(MANTISSA_BITS) | mantissa).astype(np.uint16)


def band_values(regs: np.ndarray) -> np.ndarray:
    """One 64-bit value per band, different between bands."""
    return as_long(mix(regs.view(np.uint64) * _BANDS + _BANDS[::-1]))


def estimate(left: np.ndarray, right: np.ndarray, n_left: np.ndarray, n_right: np.ndarray) -> np.ndarray:
    """Jaccard of pairs of register rows, less what agrees by chance."""
    agree = (left == right).mean(axis=1)
    scale = 0.5 ** np.arange(1, 65)

    def falls(n):  # probability that a register has so many leading zeros
        above = np.exp(-np.maximum(n, 1)[:, None] / REGISTERS * scale)
        return above - np.exp(-np.maximum(n, 1)[:, None] / REGISTERS * scale * 2)

    chance = (falls(n_left) * falls(n_right)).sum(axis=1) / 2**MANTISSA_BITS
    return (agree - chance) / (1 - chance)


def _signed(docs: DataFrame) -> DataFrame:
    """doc_id, key (of the word sequence), n_shingles, regs of every row."""

    def sign(batch: pa.RecordBatch) -> dict:
        keys, sizes, regs = [], [], []
        for text in batch.column("text").to_pylist():
            tokens = words(text_of(text))
            found = shingles(tokens)
            keys.append(xxhash.xxh3_128_digest(b" ".join(tokens)))
            sizes.append(len(found))
            regs.append(registers(found).tobytes() if len(found) else None)
        return {
            "doc_id": batch.column("doc_id"),
            TEXT_HASH: batch.column(TEXT_HASH),
            "key": keys,
            "n_shingles": pa.array(sizes, pa.int64()),
            "regs": pa.array(regs, pa.binary()),
        }

    return map_texts(
        docs.select("doc_id", F.xxhash64("text").alias(TEXT_HASH), "text"),
        sign,
        f"doc_id long, {TEXT_HASH} long, key binary, n_shingles long, regs binary",
    )


def _banded(nodes: DataFrame) -> DataFrame:
    """band, node: a row per node and band."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bands = [band_values(np.frombuffer(r, np.uint16)) for r in batch.column("regs").to_pylist()]
            per = REGISTERS // BAND_ROWS
            yield pa.RecordBatch.from_pydict(
                {
                    "band": np.concatenate(bands) if bands else np.empty(0, np.int64),
                    "node": np.repeat(batch.column("node").to_numpy(), per),
                }
            )

    return nodes.select("node", "regs").mapInArrow(run, "band long, node long")


def _similar_size(left: Column, right: Column) -> Column:
    return F.least(left, right) * 100 >= F.greatest(left, right) * THRESHOLD


def _estimated(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs (a, b) that their registers do not rule out."""
    side = nodes.select("node", "regs", "n_shingles")
    both = pairs.join(side.toDF("a", "regs_a", "n_a"), "a").join(side.toDF("b", "regs_b", "n_b"), "b")
    both = both.filter(_similar_size(F.col("n_a"), F.col("n_b")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            left, right = (
                np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(-1, REGISTERS)
                for c in ("regs_a", "regs_b")
            )
            sizes = [batch.column(c).to_numpy() for c in ("n_a", "n_b")]
            keep = pa.array(estimate(left, right, *sizes) >= HOPELESS)
            yield batch.select(["a", "b"]).filter(keep)

    return both.mapInArrow(run, "a long, b long")


def _sets(asked: DataFrame, nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """node and sorted shingles of the asked nodes, whose texts are read again."""
    named = nodes.join(asked, "node").select("who", "node", "key")
    rows = docs.select("doc_id", F.xxhash64("text").alias(TEXT_HASH), "text")
    # The hash keeps rows without an id from meeting each other.
    same = F.col("doc_id").eqNullSafe(F.col("who.doc_id")) & (F.col(TEXT_HASH) == F.col(f"who.{TEXT_HASH}"))
    texts = rows.join(named, same)

    def cut(batch: pa.RecordBatch) -> dict:
        out: dict[str, list] = {"node": [], "set": []}
        rows = zip(*(batch.column(c).to_pylist() for c in ("node", "key", "text")))
        for node, key, text in rows:
            tokens = words(text_of(text))
            # Another text of the same hash, under the same id, is not meant.
            if xxhash.xxh3_128_digest(b" ".join(tokens)) == key:
                out["node"].append(node)
                out["set"].append(shingles(tokens).tobytes())
        return {"node": pa.array(out["node"], pa.int64()), "set": pa.array(out["set"], pa.binary())}

    found = map_texts(texts.select("node", "key", "text"), cut, "node long, set binary")
    return found.dropDuplicates(["node"])


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs whose full sets reach the threshold."""
    both = pairs.join(sets.toDF("a", "set_a"), "a").join(sets.toDF("b", "set_b"), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("set_a"), batch.column("set_b")):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                at = np.minimum(np.searchsorted(y, x), len(y) - 1)
                inter = int((y[at] == x).sum())
                keep.append(100 * inter >= THRESHOLD * (len(x) + len(y) - inter))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.mapInArrow(run, "a long, b long")


def _close_pairs(members: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (a, b) of one band (band, node, root, n_shingles) and different classes that
    share enough shingles, as far as half of each hash tells."""
    several = (
        members.groupBy("band")
        .agg(
            F.greatest(F.count("*") / CHUNK, F.sum("n_shingles") / CHUNK_SHINGLES).alias("size"),
            F.min("root").alias("low"),
            F.max("root").alias("high"),
        )
        .filter("low != high")
        .select("band", F.ceil("size").cast("int").alias("chunks"))
    )
    mine = F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int")
    dealt = (
        members.join(several, "band")
        .withColumn("mine", mine)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        .select("node", "root", "band", "mine", F.least("mine", "other").alias("lo"), F.greatest("mine", "other").alias("hi"))
        .join(sets, "node")
        .repartition("band", "lo", "hi")
        .sortWithinPartitions("band", "lo", "hi")
    )

    def compare(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        node, root, mine = (rows.column(c).to_numpy() for c in ("node", "root", "mine"))
        sets_ = [(np.frombuffer(v.as_buffer(), np.uint64) >> np.uint64(32)).astype(np.uint32) for v in rows.column("set")]
        size = np.array([len(s) for s in sets_])
        order = np.argsort(flat := np.concatenate(sets_), kind="stable")
        owner, flat = np.repeat(np.arange(len(sets_)), size)[order], flat[order]
        both = int(rows.column("lo")[0].as_py()) != int(rows.column("hi")[0].as_py())
        out: tuple[list, list] = [], []
        for i, own in enumerate(sets_):
            start, end = np.searchsorted(flat, own), np.searchsorted(flat, own, "right")
            length = end - start
            at = np.repeat(start - np.r_[0, np.cumsum(length)[:-1]], length) + np.arange(length.sum())
            inter = np.minimum(np.bincount(owner[at], minlength=len(sets_)), np.minimum(size, size[i])) + 1
            near = (100 * inter >= THRESHOLD * (size + size[i] - inter)) & (root != root[i]) & (node > node[i])
            if both:  # pairs within one chunk meet elsewhere
                near &= mine != mine[i]
            found = node[near]
            out[0].append(np.full(len(found), node[i]))
            out[1].append(found)
        return np.concatenate(out[0]), np.concatenate(out[1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches, ["band", "lo", "hi"]):
            a, b = compare(group)
            if len(a):
                yield pa.RecordBatch.from_pydict({"a": a, "b": b})

    return dealt.mapInArrow(run, "a long, b long").distinct()


def components(links: DataFrame, files: int | None = None) -> DataFrame:
    """node, root: the smallest node that links (a, b) lead to, for nodes that
    have a link. Alternates pulling larger and smaller neighbours to the
    smallest one until every node points to a root; each step is a table, and a
    hub's many neighbours are split by the join."""
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u != v").distinct()
    edges = save(edges, "edges", files)
    while not _stars(edges):
        # Larger neighbours of every node go to its smallest neighbour.
        both = edges.select("u", "v").union(edges.select(F.col("v"), F.col("u")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.distinct()
        # Then smaller neighbours, and the node itself.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = save(small.union(least.select("u", F.col("m").alias("v"))).distinct(), "edges", files)
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )


def _stars(edges: DataFrame) -> bool:
    """Whether every node points to one other, and none that is pointed to points."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("from"), F.lit(0).alias("to"))
    ends = ends.union(edges.select("v", F.lit(0), F.lit(1)))
    ends = ends.groupBy("node").agg(F.sum("from").alias("from"), F.max("to").alias("to"))
    return ends.filter("from > 1 or from = 1 and to = 1").isEmpty()


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept, a hash of the text and the class (null for
    texts without a word) of every row."""
    signed = save(_signed(docs), "signed")
    nodes = signed.filter("n_shingles > 0").groupBy("key").agg(
        F.min("doc_id").alias("doc_id"),
        F.min(F.struct("doc_id", TEXT_HASH)).alias("who"),
        F.first("n_shingles").alias("n_shingles"),
        F.first("regs").alias("regs"),
    )
    n = signed.count()
    nodes = save(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes", files_for(n, 100_000))
    banded = _banded(nodes)
    shared = banded.groupBy("band").agg(F.count("*").alias("n")).filter("n > 1").select("band")
    met = save(banded.join(shared, "band"), "met", files_for(n, 50_000))

    sets = save(_sets(met.select("node").distinct(), nodes, docs), "sets", files_for(n, 20_000))
    narrow = files_for(n, 1_000_000)
    # Any node may be hub; another one for each band.
    hubs = met.groupBy("band").agg(F.min(F.struct(F.xxhash64("node", "band"), "node"))["node"].alias("hub"))
    asked = met.join(hubs, "band").filter("node != hub")
    asked = asked.select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct()
    links = save(_verified(_estimated(asked, nodes), sets), "links", files_for(n, 50_000))
    weight = (F.octet_length("set") / 8).cast("long").alias("n_shingles")
    roots = sets.select("node", weight).join(components(links, narrow), "node", "left")
    roots = save(roots.withColumn("root", F.coalesce("root", "node")), "roots", narrow)

    # Links found now join classes.
    close = _estimated(_close_pairs(met.join(roots, "node"), sets), nodes)
    roots = roots.select("node", "root")
    found = _verified(close, sets).join(roots.toDF("a", "root_a"), "a").join(roots.toDF("b", "root_b"), "b")
    joined = components(found.select(F.col("root_a").alias("a"), F.col("root_b").alias("b")), narrow)
    roots = roots.join(joined.toDF("root", "low"), "root", "left").select("node", F.coalesce("low", "root").alias("root"))

    named = nodes.select("node", "key", F.col("doc_id").alias("low_id")).join(roots, "node", "left")
    named = named.withColumn("root", F.coalesce("root", "node"))
    least = named.groupBy("root").agg(F.min("low_id").alias("component_id"))
    classes = named.join(least, "root").select("key", "component_id", F.col("root").alias("class_node"))
    return (
        signed.select("doc_id", TEXT_HASH, "key", "n_shingles")
        .join(classes, "key", "left")
        .select(
            "doc_id",
            TEXT_HASH,
            "n_shingles",
            F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
            F.when(F.col("n_shingles") > 0, F.col("class_node")).alias("class_node"),
        )
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )


def without_copies(docs: DataFrame) -> DataFrame:
    """One document of each class, the one of the smallest id (and of several of that id,
    the smallest text hash; without an id only if none has one), with all its columns.
    Texts without a word stay, those alike under one id once."""
    single = F.col("class_node").isNull()
    kept = near_duplicates(docs).groupBy("class_node", F.when(single, F.col("doc_id")), F.when(single, F.col(TEXT_HASH))).agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", TEXT_HASH)).alias("least")
    )
    kept = kept.select(F.col("least.doc_id").alias("kept_id"), F.col(f"least.{TEXT_HASH}").alias(TEXT_HASH))
    mark = free_name(docs, TEXT_HASH)
    marked = docs.withColumn(mark, F.xxhash64("text"))
    same = marked["doc_id"].eqNullSafe(kept["kept_id"]) & marked[mark].eqNullSafe(kept[TEXT_HASH])
    return marked.join(kept, same, "left_semi").dropDuplicates(["doc_id", mark]).drop(mark)
