"""LM scoring: a hidden Markov model over word classes, trained by Baum-Welch.

A text is its words (A-Z lower-cased) and one end. Every frequent word is a class of
its own; the others share classes by their last letters. The model says how states
follow each other and which classes a state emits; a word's probability within its
class is its smoothed share of the class's tokens in the training texts, where the
same allowance is made for unknown words as in the unigram base. So

    P(text) = sum over state paths of the product of P(state | state before)
              P(class | state) P(word | class)

which the scaled forward recursion computes exactly, whatever the length.

1. Texts are read once. Blocks of about BLOCK_BYTES of text become sequences of
   places in the block's own list of words, with the training counts of each.
2. The lists are summed to counts of the whole corpus, and each block's words are
   joined with those. A word is one row per block, so frequent words do not skew.
3. Baum-Welch: tasks add up expected transitions and emissions of all training
   texts, each as a whole (one of more than BATCH_TOKENS tokens in pieces, which hand
   on where they stand); the sums, STATES * classes numbers whatever the corpus, give
   the next model. States start from a few rounds on a bounded sample
   of SEED_TEXTS training texts.

Words are told apart by 64-bit hash.

Cases: null and empty texts are the end alone. Rows that repeat each get a row, and
count each in training. A null id counts as the empty text when folds are dealt. Words of equal
frequency are taken by hash. Without training texts, base and score take every
word as unknown. Other columns are not looked at.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vidlake.llm.common import as_long, fifth, save, slices, text_of

STATES = 8
ROUNDS = 3
FREQUENT = 4096
SUFFIXES = 512
SEED_TEXTS, SEED_ROUNDS = 1500, 12
BLOCK_BYTES = 16_000_000
# Tokens by which a state's emissions lean on those of the corpus.
LEAN = 50.0
# Tokens that are gone through at once.
BATCH_TOKENS = 500_000
_END = 0  # the hash of the end


def _suffix(word: bytes) -> int:
    return zlib.crc32(word[-3:]) % SUFFIXES


def _planes(places: np.ndarray) -> bytes:
    """32-bit places, all lowest bytes first: the higher ones, mostly alike, then
    compress to little."""
    return places.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _places(planes: pa.Scalar) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(planes.as_buffer(), np.uint8).reshape(4, -1).T).view("<u4").ravel()


def _blocks(docs: DataFrame) -> DataFrame:
    """Rows of two kinds: a document with the places of its tokens, and a block's list
    of words (hash, suffix class, training count)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, int] = {}
        rows: list[tuple] = []
        counts: list[np.ndarray] = []
        size = 0
        block = None

        def emptied() -> pa.RecordBatch:
            words = list(known)
            total = np.zeros(len(words) + 1, np.int64)
            for found in counts:
                total += np.bincount(found, minlength=len(total))
            hashed = np.fromiter((xxhash.xxh3_64_intdigest(w) or 1 for w in words), np.uint64, len(words))
            suffix = np.fromiter(map(_suffix, words), np.int64, len(words))
            listed = (
                np.append(np.uint64(_END), hashed).astype(np.uint64).tobytes(),
                np.append(SUFFIXES, suffix).astype(np.uint16).tobytes(),
                total.astype(np.int64).tobytes(),
            )
            docs_, helds, places = zip(*rows)
            n = len(rows)
            return pa.RecordBatch.from_pydict(
                {
                    "block": pa.array([block] * (n + 1), pa.int64()),
                    "doc_id": pa.array([*docs_, None], pa.int64()),
                    "held_out": pa.array([*helds, None], pa.bool_()),
                    "places": pa.array([*places, None], pa.binary()),
                    "words": pa.array([None] * n + [listed[0]], pa.binary()),
                    "suffixes": pa.array([None] * n + [listed[1]], pa.binary()),
                    "counts": pa.array([None] * n + [listed[2]], pa.binary()),
                }
            )

        for batch in slices(batches):
            columns = (batch.column(c).to_pylist() for c in ("row", "doc_id", "held_out", "text"))
            for row, doc, held, text in zip(*columns):
                if block is None:
                    block = row
                tokens = text_of(text).encode("utf-8", "surrogatepass").lower().split()
                found = np.fromiter(
                    (known.setdefault(w, len(known) + 1) for w in tokens), np.uint32, len(tokens)
                )
                found = np.append(found, np.uint32(0))
                rows.append((doc, held, _planes(found)))
                if not held:
                    counts.append(found)
                size += len(text_of(text))
                if size >= BLOCK_BYTES:
                    yield emptied()
                    known.clear()
                    rows.clear()
                    counts.clear()
                    size, block = 0, None
        if rows:
            yield emptied()

    ready = docs.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", (fifth("doc_id") == 1).alias("held_out"), "text"
    )
    return ready.mapInArrow(
        run,
        "block long, doc_id long, held_out boolean, places binary, words binary, suffixes binary, counts binary",
    )


def _listed(blocks: DataFrame) -> DataFrame:
    """block, word, tag, n: a row per word of a block; the tag holds its place in the
    block's list and, in the last 16 bits, its suffix class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("block", "words", "suffixes", "counts"))
            for block, words, suffixes, counts in zip(*columns):
                words = np.frombuffer(words, np.int64)
                suffix = np.frombuffer(suffixes, np.uint16).astype(np.int64)
                yield pa.RecordBatch.from_pydict(
                    {
                        "block": np.full(len(words), block),
                        "word": words,
                        "tag": np.arange(len(words), dtype=np.int64) << 16 | suffix,
                        "n": np.frombuffer(counts, np.int64),
                    }
                )

    lists = blocks.filter("words is not null").select("block", "words", "suffixes", "counts")
    return lists.mapInArrow(run, "block long, word long, tag long, n long")


class Model:
    """Start, transition and emission probabilities."""

    def __init__(self, start: np.ndarray, step: np.ndarray, emit: np.ndarray):
        self.start, self.step, self.emit = start, step, emit

    @classmethod
    def first(cls, share: np.ndarray, seed: int = 3) -> Model:
        dice = np.random.default_rng(seed)
        step = np.full((STATES, STATES), 0.05 / max(1, STATES - 1))
        np.fill_diagonal(step, 0.95)
        emit = share * dice.gamma(2.0, 0.5, (STATES, len(share)))
        return cls(np.full(STATES, 1 / STATES), step, emit / emit.sum(axis=1, keepdims=True))

    @classmethod
    def of_counts(cls, counts: np.ndarray, share: np.ndarray) -> Model:
        start = counts[:STATES] + 0.1
        step = counts[STATES : STATES * (STATES + 1)].reshape(STATES, STATES) + 0.1
        emit = counts[STATES * (STATES + 1) :].reshape(STATES, -1) + LEAN * share
        return cls(start / start.sum(), step / step.sum(axis=1, keepdims=True), emit / emit.sum(axis=1, keepdims=True))


def _aligned(sequences: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sequences, the longest first, as one array step by step: all first tokens, all
    second tokens of those that have one, and so on. Also how many have each step, and
    the order of the sequences."""
    length = np.array([len(s) for s in sequences])
    order = np.argsort(-length, kind="stable")
    steps = np.arange(length[order[0]])
    width = len(length) - np.searchsorted(np.sort(length), steps, "right")
    begin = np.r_[0, np.cumsum(width)]
    out = np.empty(begin[-1], np.int64)
    for rank, at in enumerate(order):
        out[begin[: length[at]] + rank] = sequences[at]
    return out, width, order


def log10_likelihood(model: Model, sequences: list[np.ndarray]) -> np.ndarray:
    """Scaled forward recursion over whole sequences, side by side."""
    flat, width, order = _aligned(sequences)
    emit = np.ascontiguousarray(model.emit.T)
    total = np.zeros(len(sequences))
    at = 0
    alpha = None
    for n in width:
        seen = emit[flat[at : at + n]]
        alpha = (model.start if alpha is None else alpha[:n] @ model.step) * seen
        scale = alpha.sum(axis=1)
        alpha /= scale[:, None]
        total[:n] += np.log10(scale)
        at += n
    out = np.empty(len(sequences))
    out[order] = total
    return out


def expected(model: Model, sequences: list[np.ndarray]) -> np.ndarray:
    """Expected starts, transitions and emissions of sequences, in one row."""
    flat, width, _ = _aligned(sequences)
    emit = np.ascontiguousarray(model.emit.T)
    seen = emit[flat]
    alpha = np.empty_like(seen)
    scale = np.empty(len(flat))
    begin = np.r_[0, np.cumsum(width)]
    last = None
    for n, at in zip(width, begin):
        a = (model.start if last is None else last[:n] @ model.step) * seen[at : at + n]
        s = a.sum(axis=1)
        a /= s[:, None]
        alpha[at : at + n], scale[at : at + n] = a, s
        last = a
    step = np.zeros((STATES, STATES))
    beta = np.ones((int(width[-1]), STATES))
    gamma = np.empty_like(alpha)
    for t in range(len(width) - 1, -1, -1):
        n, at = int(width[t]), begin[t]
        if len(beta) < n:
            beta = np.vstack([beta, np.ones((n - len(beta), STATES))])
        gamma[at : at + n] = alpha[at : at + n] * beta
        if t:
            back = seen[at : at + n] * beta / scale[at : at + n, None]
            before = begin[t - 1]
            step += alpha[before : before + n].T @ back
            beta = back @ model.step.T
    emitted = np.array([np.bincount(flat, gamma[:, k], len(emit)) for k in range(STATES)])
    return np.concatenate([gamma[: width[0]].sum(axis=0), (step * model.step).ravel(), emitted.ravel()])


def _expected_long(model: Model, sequence: np.ndarray) -> np.ndarray:
    """The same of one sequence, piece by piece: the forward recursion keeps what enters
    each piece, and the backward one makes it again from there."""
    emit = np.ascontiguousarray(model.emit.T)
    pieces = [sequence[at : at + BATCH_TOKENS] for at in range(0, len(sequence), BATCH_TOKENS)]

    def forward(piece: np.ndarray, last: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        alpha, scale = emit[piece], np.empty(len(piece))
        for t in range(len(piece)):
            alpha[t] *= model.start if last is None else last @ model.step
            scale[t] = alpha[t].sum()
            alpha[t] /= scale[t]
            last = alpha[t]
        return alpha, scale

    entering: list[np.ndarray | None] = [None]
    for piece in pieces[:-1]:
        entering.append(forward(piece, entering[-1])[0][-1].copy())
    step = np.zeros((STATES, STATES))
    emitted = np.zeros((STATES, len(emit)))
    beta = np.ones(STATES)
    start = np.zeros(STATES)
    for piece, last in zip(reversed(pieces), reversed(entering)):
        alpha, scale = forward(piece, last)
        gamma = np.empty_like(alpha)
        for t in range(len(piece) - 1, -1, -1):
            gamma[t] = alpha[t] * beta
            before = alpha[t - 1] if t else last
            if before is not None:
                back = emit[piece[t]] * beta / scale[t]
                step += np.outer(before, back)
                beta = model.step @ back
        emitted += [np.bincount(piece, gamma[:, k], len(emit)) for k in range(STATES)]
        start = gamma[0]
    return np.concatenate([start, (step * model.step).ravel(), emitted.ravel()])


def _counted(model: Model, sequences: list[np.ndarray]) -> Iterator[np.ndarray]:
    """Expected counts of whole sequences, by batches of bounded size."""
    held, size = [], 0
    for s in sequences:
        if len(s) > BATCH_TOKENS:
            yield _expected_long(model, s)
            continue
        held.append(s)
        size += len(s)
        if size >= BATCH_TOKENS:
            yield expected(model, held)
            held, size = [], 0
    if held:
        yield expected(model, held)


def _sequences(column) -> list[np.ndarray]:
    return [np.frombuffer(v.as_buffer(), np.uint16) for v in column]


def _seeded(texts: DataFrame, share: np.ndarray) -> Model:
    """A model from a bounded sample, which full rounds start from."""

    def fit(table: pa.Table) -> pa.Table:
        table = table.sort_by([("doc_id", "ascending"), ("classes", "ascending")])
        model = Model.first(share)
        # Texts of like length go through the recursion side by side.
        sequences = sorted(_sequences(table["classes"]), key=len)
        for _ in range(SEED_ROUNDS):
            model = Model.of_counts(sum(_counted(model, sequences)), share)
        row = np.concatenate([model.start, model.step.ravel(), model.emit.ravel()])
        return pa.table({"model": pa.array([row.tobytes()], pa.binary())})

    sample = texts.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SEED_TEXTS)
    made = sample.groupBy().applyInArrow(fit, "model binary").collect()
    if not made:
        return Model.first(share)
    row = np.frombuffer(made[0]["model"])
    return Model(row[:STATES], row[STATES : STATES * (STATES + 1)].reshape(STATES, STATES), row[STATES * (STATES + 1) :].reshape(STATES, -1))


def baum_welch(texts: DataFrame, share: np.ndarray, *, rounds: int = ROUNDS) -> Model:
    """Model from all training texts (doc_id, classes)."""
    model = _seeded(texts, share)
    size = STATES + STATES * STATES + STATES * len(share)
    for _ in range(rounds):
        shared = texts.sparkSession.sparkContext.broadcast(model)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            total = np.zeros(size)
            for batch in batches:
                for found in _counted(shared.value, _sequences(batch.column("classes"))):
                    total += found
            used = np.flatnonzero(total)
            for start in range(0, len(used), 50_000):
                at = used[start : start + 50_000]
                yield pa.RecordBatch.from_pydict({"at": at, "value": total[at]})

        summed = texts.select("classes").mapInArrow(run, "at long, value double").groupBy("at").agg(F.sum("value").alias("value"))
        rows = summed.toPandas()  # `size` rows at most
        counts = np.zeros(size)
        counts[rows["at"].to_numpy(np.int64)] = rows["value"].to_numpy(float)
        model = Model.of_counts(counts, share)
    return model


def score(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row."""
    spark = docs.sparkSession
    blocks = save(_blocks(docs), "blocks")
    listed = _listed(blocks)
    suffix = F.col("tag").bitwiseAND(F.lit(0xFFFF))
    known = listed.filter("n > 0").groupBy("word").agg(F.max(suffix).cast("int").alias("suffix"), F.sum("n").alias("n"))
    counts = save(known, "counts")
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    n_all, v_all = int(total["n"]), int(total["v"])
    # FREQUENT rows.
    top = counts.filter(F.col("word") != _END).orderBy(F.desc("n"), "word").limit(FREQUENT).select("word").collect()
    own = {row["word"]: at for at, row in enumerate(top)}
    own[_END] = FREQUENT + SUFFIXES
    n_classes = FREQUENT + SUFFIXES + 1
    # The end's suffix class is SUFFIXES, behind those of words.
    frequent = F.broadcast(spark.createDataFrame([(w, a) for w, a in own.items()], "word long, own int"))
    classed = counts.join(frequent, "word", "left").select(
        "n", F.coalesce("own", F.lit(FREQUENT) + F.col("suffix")).alias("class")
    )
    held = np.zeros((2, n_classes))
    for row in classed.groupBy("class").agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect():
        held[:, row["class"]] = row["n"], row["v"]
    share = (held[0] + 0.5) / (n_all + 0.5 * n_classes)
    # A class of one word has no room for unknown ones.
    single = np.r_[np.ones(FREQUENT, bool), np.zeros(SUFFIXES, bool), True]
    within = held[0] + 0.5 * (held[1] + 1)
    base = n_all + 0.5 * (v_all + 1)
    facts = spark.sparkContext.broadcast((single, within))

    asked = (
        listed.select("block", "word", "tag")
        .join(counts.select("word", F.col("n").alias("c")), "word", "left")
        .join(frequent, "word", "left")
    )
    # The place and the class of a word, in one number.
    placed = F.shiftleft(F.shiftright("tag", 16), 16).bitwiseOR(
        F.coalesce(F.col("own").cast("long"), F.lit(FREQUENT) + suffix)
    )
    asked = asked.select("block", placed.alias("tag"), "c")

    def classify(key, texts: pa.Table, words: pa.Table) -> pa.Table:
        single, within = facts.value
        words = words.sort_by("tag")
        c = words["c"].fill_null(0).to_numpy().astype(float)
        class_ = words["tag"].to_numpy() & 0xFFFF
        base_log = np.log10((c + 0.5) / base)
        class_log = np.where(single[class_], 0.0, np.log10((c + 0.5) / within[class_]))
        out: dict[str, list] = {k: [] for k in ("n_tokens", "n_known", "base_score", "within", "classes")}
        for value in texts["places"]:
            places = _places(value)
            sums = len(places), int((c[places] > 0).sum()), float(base_log[places].sum()), float(class_log[places].sum())
            for column, x in zip(out.values(), (*sums, class_[places].astype(np.uint16).tobytes())):
                column.append(x)
        types = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.binary()]
        arrays = {k: pa.array(v, t) for (k, v), t in zip(out.items(), types)}
        return pa.table({"doc_id": texts["doc_id"], "held_out": texts["held_out"], **arrays})

    texts = blocks.filter("places is not null").select("block", "doc_id", "held_out", "places")
    ready = texts.groupBy("block").cogroup(asked.groupBy("block")).applyInArrow(
        classify,
        "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, within double, classes binary",
    )
    # Texts of like length go through the recursion side by side.
    ready = save(ready.sortWithinPartitions("n_tokens"), "classes")
    model = baum_welch(ready.filter("not held_out").select("doc_id", "classes"), share)
    shared = spark.sparkContext.broadcast(model)

    def forward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens = np.cumsum(batch.column("n_tokens").to_numpy())
            cuts = [0]
            for at, seen in enumerate(tokens, 1):
                if seen - (tokens[cuts[-1] - 1] if cuts[-1] else 0) >= BATCH_TOKENS or at == len(tokens):
                    cuts.append(at)
            for start, end in zip(cuts, cuts[1:]):
                part = batch.slice(start, end - start)
                found = log10_likelihood(shared.value, _sequences(part.column("classes")))
                found += part.column("within").to_numpy()
                kept = part.select(["doc_id", "held_out", "n_tokens", "n_known", "base_score"])
                yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(found)], [*kept.schema.names, "score"])

    scored = ready.mapInArrow(
        forward, "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"
    )
    return scored.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(n_all).cast("long").alias("train_tokens"), "base_score", "score"
    )
