"""Packing by deficit round-robin: every window holds its sources in proportion.

Each source is a queue of documents, one after the other. In every round a source is
credited its share of WINDOW tokens and serves what the credit covers; the document at
which it ends is cut there, and goes on in the next round. No segment is made shorter
than LEAST tokens by that: a source may serve up to so many less, or more on credit of
the next round. So over any number of rounds a source is at most LEAST tokens off its
credit, and the error never adds up. The rounds, one after the other, are one stream
of tokens, cut into sequences. A window's edges are off those of its round by at most
LEAST tokens for each source, so a source's tokens in a full window are off its share by
2 * LEAST and that, at the very most; by far less on average.

A queue that has not run dry has been credited `round * quantum` in all, so where a queue
is cut, and the round of a segment, are known from its place in its queue alone:
`ceil((end - LEAST + 1) / quantum)`. That makes the whole schedule two running sums, over
the queues and over the stream, taken in partitions with the partitions' sums carried
over; credit is carried across partitions the same way. Hot sources are spread over all
partitions. Token ids are made once and move once, to their places.

By default the shares are the corpus's own, so all queues end together. Given
shares may end a queue early; later windows share what is left.

Cases: null and empty text is the end token alone. A null source is a queue of its
own. Rows that repeat are packed each. Null ids are packed too. Other columns are
not looked at. Only the last sequence is padded.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vidlake.llm.common import map_texts, save, text_of
from vidlake.llm.tokens import word_ids

SEQUENCE = 4096
WINDOW = 16 * SEQUENCE
# Shortest segment that a cut at the end of the credit leaves.
LEAST = 64
END_ID = 2
PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, source string"
)


def _encoded(docs: DataFrame, path: str, end_id: int) -> DataFrame:
    """row, doc_id, source, ids (two bytes each if that is enough), n."""

    def encode(batch: pa.RecordBatch) -> dict:
        encoder = word_ids(path)
        ids = [np.append(encoder.ids(text_of(t)), np.uint32(end_id)) for t in batch.column("text").to_pylist()]
        kind = np.uint16 if encoder.tokenizer.get_vocab_size() <= 1 << 16 else np.uint32
        return {
            "doc_id": batch.column("doc_id"),
            "source": batch.column("source"),
            "ids": [i.astype(kind).tobytes() for i in ids],
            "n": pa.array([len(i) for i in ids], pa.int64()),
        }

    made = map_texts(docs.select("doc_id", "source", "text"), encode, "doc_id long, source string, ids binary, n long")
    return made.withColumn("row", F.monotonically_increasing_id())


def _scheduled(tokens: DataFrame, shares: Mapping[str, float] | None, window: int, least: int) -> DataFrame:
    """row, start, length, at: where in the stream each segment goes."""
    # Source null and source "" stay apart.
    queue = F.coalesce(F.concat(F.lit("s"), "source"), F.lit("-"))
    narrow = tokens.select("row", "n", queue.alias("queue"), F.shiftright("row", 33).alias("part"))
    parts = narrow.groupBy("queue", "part").agg(F.sum("n").alias("n"))
    parts = parts.select(
        "queue",
        "part",
        (F.sum("n").over(Window.partitionBy("queue").orderBy("part")) - F.col("n")).alias("before"),
        F.sum("n").over(Window.partitionBy("queue")).alias("queue_n"),
    )
    if shares is None:
        total = tokens.agg(F.sum("n")).first()[0] or 1
        quantum = F.col("queue_n") * F.lit(window / total)
    else:
        given = {f"s{k}": float(v) for k, v in shares.items() if v > 0}
        rest = min(given.values(), default=1.0) / 1000
        pairs = [F.lit(x) for k, v in given.items() for x in (k, v * window)]
        share = F.element_at(F.create_map(*pairs), F.col("queue")) if pairs else F.lit(None).cast("double")
        quantum = F.coalesce(share, F.lit(rest * window))
    running = F.sum("n").over(Window.partitionBy("queue", "part").orderBy("row")) - F.col("n")
    placed = (
        narrow.withColumn("inside", running)
        .join(parts.withColumn("quantum", quantum), ["queue", "part"])
        .select("row", "queue", "n", "quantum", (F.col("before") + F.col("inside")).alias("begin"))
    )
    # Sources with little credit are cut where several rounds' credit ends.
    unit = F.col("quantum") * F.ceil(F.lit(least) / F.col("quantum"))
    placed = placed.withColumn("unit", unit)
    low = (F.floor(F.col("begin") / F.col("unit")) + 1).cast("long")
    high = (F.ceil((F.col("begin") + F.col("n")) / F.col("unit")) - 1).cast("long")
    ends = F.transform(
        F.when(low <= high, F.sequence(low, high)).otherwise(F.array().cast("array<bigint>")),
        lambda k: F.floor(k * F.col("unit")).cast("long") - F.col("begin"),
    )
    cuts = F.filter(ends, lambda c: (c >= least) & (F.col("n") - c >= least))
    starts, stops = F.concat(F.array(F.lit(0).cast("long")), cuts), F.concat(cuts, F.array("n"))
    cut = placed.withColumn("segment", F.explode(F.arrays_zip(starts.alias("start"), stops.alias("stop"))))
    end = F.col("begin") + F.col("segment.stop")
    cut = cut.select(
        "row",
        F.col("segment.start").alias("start"),
        (F.col("segment.stop") - F.col("segment.start")).alias("length"),
        "queue",
        (F.col("begin") + F.col("segment.start")).alias("begin"),
        F.greatest(F.lit(1), F.ceil((end - least + 1) / F.col("quantum"))).cast("long").alias("round"),
    )
    order = ["round", "queue", "begin"]
    sorted_ = cut.repartitionByRange(*order).withColumn("slice", F.spark_partition_id())
    sorted_ = save(sorted_, "schedule")
    # One row per slice, and there are as many slices as shuffle partitions.
    slices = sorted_.groupBy("slice").agg(F.sum("length").alias("n"))
    bases = slices.select("slice", (F.sum("n").over(Window.orderBy("slice")) - F.col("n")).alias("base"))
    within = F.sum("length").over(Window.partitionBy("slice").orderBy(*order)) - F.col("length")
    return (
        sorted_.withColumn("within", within)
        .join(F.broadcast(bases), "slice")
        .select("row", "start", "length", (F.col("base") + F.col("within")).alias("at"))
    )


def pack(
    docs: DataFrame,
    path: str,
    *,
    end_id: int = END_ID,
    sequence: int = SEQUENCE,
    window: int = WINDOW,
    shares: Mapping[str, float] | None = None,
    least: int = LEAST,
    with_ids: bool = False,
) -> DataFrame:
    """A row per piece: doc_id, start (in the document), length, ids_crc32, doc_tokens,
    sequence_id, offset (in the sequence), source, and on request the ids as
    little-endian 32-bit numbers. Sequences are the pieces of one sequence_id by
    offset; each is gapless from 0, and all but the last are full."""
    tokens = save(_encoded(docs, path, end_id), "tokens")
    plan = (
        _scheduled(tokens.drop("ids"), shares, window, least)
        .groupBy("row")
        .agg(F.collect_list(F.struct("start", "length", "at")).alias("plan"))
    )
    schema = PIECES + (", ids binary" if with_ids else "")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 2000):
                part = batch.slice(first, 2000)
                out: list[list] = [[] for _ in range(8 + with_ids)]
                rows = zip(
                    *(part.column(c).to_pylist() for c in ("doc_id", "source", "n", "ids", "plan"))
                )
                for doc, source, n, ids, segments in rows:
                    ids = np.frombuffer(ids, np.uint16 if len(ids) == 2 * n else np.uint32).astype("<u4")
                    for segment in segments:
                        start, left, at = segment["start"], segment["length"], segment["at"]
                        while left:
                            offset = at % sequence
                            length = min(left, sequence - offset)
                            own = ids[start : start + length].tobytes()
                            values = doc, start, length, zlib.crc32(own), n, at // sequence, offset, source, own
                            for column, value in zip(out, values):
                                column.append(value)
                            start, left, at = start + length, left - length, at + length
                types = [pa.int64()] * 7 + [pa.string(), pa.binary()]
                names = [f.split()[0] for f in schema.split(", ")]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], names)

    # The plan grows with the documents, so it is never broadcast.
    return tokens.join(plan.hint("merge"), "row").mapInArrow(cut, schema)


def mixture(pieces: DataFrame, *, window: int = WINDOW, sequence: int = SEQUENCE) -> DataFrame:
    """window, source, tokens, share: what each window holds of each source."""
    at = F.floor(F.col("sequence_id") * sequence / window).alias("window")
    held = pieces.groupBy(at, "source").agg(F.sum("length").alias("tokens"))
    return held.withColumn("share", F.col("tokens") / F.sum("tokens").over(Window.partitionBy("window")))
