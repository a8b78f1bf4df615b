"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and
skip-grams.

Words are runs of letters and digits, lower-cased. A text's features are the
presence of each word, pair of neighbours, and pair with one word between,
hashed into 2**BITS places. FTRL-proximal gives every coordinate a rate of its
own and leaves all but the telling ones at exactly zero, so the model is a
short list of (feature, weight) that can be broadcast.

Training: at most `max_rows` labelled rows, those whose hashed id is smallest.
FTRL takes rows one after the other, so this bounded sample is one task's work
(features are made in many). Everything else covers all rows.

Cases: null and empty texts have no feature and get the bias alone. A null id
counts as the empty text when folds are dealt. Rows that repeat are scored
each. Labels that repeat count once, toxic if any row says so; labels without
text and null labels are left out. Without training rows every score is 0. Other
columns are never looked at.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vidlake.llm.common import at_work, fifth, hashes, map_texts, mix, odd_multipliers, share, slices, text_of

BITS = 22
MAX_ROWS = 20_000
EPOCHS = 3
ALPHA, BETA, L1, L2 = 2.0, 1.0, 8.0, 0.1

# Letters and digits stay, A-Z lower-cased; other ASCII splits words.
_FOLD = bytes(
    c if c > 127 or chr(c).isalnum() and not 65 <= c <= 90 else c + 32 if 65 <= c <= 90 else 32
    for c in range(256)
)
_BIAS = 0
_PAIR, _SKIP = odd_multipliers(2, 7)


def features(text: str) -> np.ndarray:
    """Places of a text's features, with repeats."""
    single = hashes(text.encode("utf-8", "surrogatepass").translate(_FOLD).split())
    pairs = mix(single[:-1] * _PAIR + single[1:])
    skips = mix(single[:-2] * _SKIP + single[2:])
    places = np.concatenate([single, pairs, skips]) >> np.uint64(64 - BITS)
    places = places.astype(np.int64)
    return places[places != _BIAS]


def ftrl(samples: list[np.ndarray], labels: np.ndarray, epochs: int = EPOCHS) -> tuple[np.ndarray, np.ndarray]:
    """Features with a weight and their weights, after some passes over rows of present
    features, each named once. Numbers are kept for the features that occur."""
    occurs = np.zeros(1 << BITS, bool)
    occurs[_BIAS] = True
    for row in samples:
        occurs[row] = True
    known = np.flatnonzero(occurs)
    # The bias is the first of them.
    place = np.cumsum(occurs, dtype=np.int32) - 1
    z, n = np.zeros(len(known)), np.zeros(len(known))

    def weight(at):
        zs = z[at]
        shrunk = np.sign(zs) * np.maximum(np.abs(zs) - L1 * (at != _BIAS), 0)
        return -shrunk / ((BETA + np.sqrt(n[at])) / ALPHA + L2)

    order = np.random.default_rng(1)
    for _ in range(epochs):
        for row in order.permutation(len(samples)):
            at = np.append(place[samples[row]], np.int32(_BIAS))
            w = weight(at)
            g = _sigmoid(w.sum()) - labels[row]
            rate = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
            z[at] += g - rate * w
            n[at] += g * g
    weights = weight(np.arange(len(known)))
    return known[weights != 0], weights[weights != 0]


def _sigmoid(x: float) -> float:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def train(docs: DataFrame, labels: DataFrame, *, max_rows: int = MAX_ROWS) -> DataFrame:
    """Weights (feature int, weight double) learned from labelled rows outside
    the held-out fifth; at most 2**BITS of them, in practice hundreds."""
    known = (
        labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
        .filter(fifth("doc_id") != 0)
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("toxic"))
    )
    # max_rows rows of two numbers bound what is broadcast.
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")

    def places(batch: pa.RecordBatch) -> dict:
        texts = batch.column("text").to_pylist()
        return {
            "doc_id": batch.column("doc_id"),
            "toxic": batch.column("toxic"),
            "places": [np.unique(features(text_of(t))).astype(np.int32).tobytes() for t in texts],
        }

    ready = map_texts(rows, places, "doc_id long, toxic int, places binary")

    def fit(table: pa.Table) -> pa.Table:
        at_work(__name__)
        # The order alone, as the table is large.
        order = pc.sort_indices(table, [("doc_id", "ascending"), ("places", "ascending")]).to_numpy()
        places = [np.frombuffer(p.as_buffer(), np.int32) for p in table["places"]]
        feature, weight = ftrl([places[i] for i in order], table["toxic"].to_numpy().astype(float)[order])
        return pa.table({"feature": pa.array(feature, pa.int32()), "weight": weight})

    return ready.groupBy().applyInArrow(fit, "feature int, weight double")


def _judge(at: np.ndarray, value: np.ndarray) -> Callable[[str], float]:
    """The score of a text under a list of weights."""
    dense = np.zeros(1 << BITS, np.float32)
    dense[at] = value
    bias = float(dense[_BIAS])

    def judge(text: str) -> float:
        places = features(text)
        places = np.unique(places[dense[places] != 0])
        return float(_sigmoid(bias + dense[places].sum(dtype=float)))

    return judge


def score(docs: DataFrame, weights: DataFrame) -> DataFrame:
    """doc_id and score of every row. The weights are broadcast; train() bounds
    their number."""
    model = weights.collect()
    at = np.array([w.feature for w in model], np.int64)
    value = np.array([w.weight for w in model], float)
    shared = share(docs.sparkSession, (at, value))
    trained = bool(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at_work(__name__)
        judge = _judge(*shared.value)
        for batch in slices(batches):
            scores = [judge(text_of(t)) if trained else 0.0 for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_pydict(
                {"doc_id": batch.column("doc_id"), "score": pa.array(scores, pa.float64())}
            )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double")


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    scored = score(docs, train(docs, labels))
    return scored.select(
        "doc_id",
        (fifth("doc_id") == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def without_toxic(docs: DataFrame, weights: DataFrame) -> DataFrame:
    """The documents that score below 0.5, with all their columns."""
    model = weights.collect()
    at = np.array([w.feature for w in model], np.int64)
    value = np.array([w.weight for w in model], float)
    shared = share(docs.sparkSession, (at, value))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at_work(__name__)
        judge = _judge(*shared.value)
        for batch in slices(batches):
            keep = [judge(text_of(t)) < 0.5 for t in batch.column("text").to_pylist()]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema) if model else docs
