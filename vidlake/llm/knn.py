"""Exact top-k search by inner product over a pivot-distance index.

Components become integers, floor(256 * x). One more component makes all rows as long
as the longest one and is 0 for queries, so that a larger inner product is a smaller
distance. Every row is keyed by its nearest pivot and the distance to it, and the rows
of a pivot, sorted by distance, are cut into annuli. For a query at distance d from the
pivot, no row of the annulus [lo, hi] is nearer than max(d - hi, lo - d), which bounds
its score. Round by round a query visits its best annuli, takes the k-th best score as
its floor, and goes on until no annulus left can reach that.

Pivots come from a bounded sample (SAMPLE rows, by hash of the id); every row is in the
index, and the result is exact whatever the pivots are.

Odd cases. Vectors that are null or hold a null or non-finite component (also once
multiplied), and rows without an id, take no part. Shorter vectors count as filled up with
zeros; an empty one has score 0 with all. Rows that share an id are one thing: a pair of
ids has the best score of its rows, and no id is a candidate for itself. An empty table
gives an empty result; other columns do not matter. Scores beyond 64 bits are an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from vidlake.llm.common import save, share, slices

SCALE = 256
SAMPLE = 4096
PIVOTS = 64
LLOYD_ROUNDS = 8
# Rows of an annulus; more where there would be more annuli than the directory may
# have, which is what is broadcast (28 bytes each).
ANNULUS_ROWS = 1024
MAX_ANNULI = 1 << 20
# Annuli that a query visits per round; the last round visits what is left.
ROUNDS = (3, 16, None)
QUERIES_PER_SLICE = 512

_VECTORS = "vec_id long, vec binary, n int, norm2 double, size int"
_INDEX = "annulus long, pivot int, lo double, hi double, n long, ids binary, vecs binary, dim int"
_ASKED = "annulus long, ids binary, vecs binary, floors binary, asked int"
_FOUND = "query_id long, vec_id long, score long"


def _pack(values: np.ndarray) -> bytes:
    """Integers held as doubles, in two bytes each where they fit."""
    small = not values.size or np.abs(values).max() < 1 << 15
    return values.astype("<i2" if small else "<f8").tobytes()


def _unpack(data: bytes, rows: int, dim: int) -> np.ndarray:
    kind = "<f8" if len(data) == 8 * rows * dim and dim and rows else "<i2"
    return np.frombuffer(data, kind).reshape(rows, dim).astype(np.float64)


def _quantise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "embedding"):
        out: dict[str, list] = {"vec_id": [], "vec": [], "n": [], "norm2": [], "size": []}
        vectors = batch.column("embedding")
        flat = vectors.flatten()
        values = flat.to_numpy(zero_copy_only=False).astype(np.float64)
        broken = flat.is_null().to_numpy(zero_copy_only=False)
        with np.errstate(over="ignore", invalid="ignore"):
            values = np.floor(SCALE * values)
            bad = np.concatenate([[0], np.cumsum(~np.isfinite(values) | broken)])
            lengths = vectors.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(lengths)
        valid = vectors.is_valid().to_numpy(zero_copy_only=False)
        for vec_id, end, n, there in zip(batch.column("vec_id").to_pylist(), ends, lengths, valid):
            if vec_id is None or not there or bad[end] != bad[end - n]:
                continue
            vector = values[end - n : end]
            out["vec_id"].append(vec_id)
            out["vec"].append(_pack(vector))
            out["n"].append(n)
            out["norm2"].append(float(vector @ vector))
            out["size"].append(len(out["vec"][-1]))
        yield pa.RecordBatch.from_pydict(out, _arrow(_VECTORS))


def _arrow(schema: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "binary": pa.binary()}
    return pa.schema([(name, kinds[kind]) for name, kind in (part.split() for part in schema.split(", "))])


def _matrix(batch: pa.RecordBatch, dim: int) -> np.ndarray:
    """The vectors of some rows, filled up with zeros."""
    out = np.zeros((batch.num_rows, dim))
    for i, (data, n) in enumerate(zip(batch.column("vec").to_pylist(), batch.column("n").to_pylist())):
        out[i, :n] = _unpack(data, 1, n)[0]
    return out


def _distances(rows: np.ndarray, extra: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Of rows with one more component to the pivots."""
    squares = (rows * rows).sum(1) + extra * extra
    cross = rows @ pivots[:, :-1].T + extra[:, None] * pivots[:, -1]
    return np.sqrt(np.maximum(squares[:, None] + (pivots * pivots).sum(1) - 2 * cross, 0))


def choose_pivots(sample: np.ndarray, wanted: int) -> np.ndarray:
    """Centres of the sample: the farthest row from those chosen before, again and
    again, then rounds of averaging."""
    chosen = [0]
    gap = ((sample - sample[0]) ** 2).sum(1)
    while len(chosen) < min(wanted, len(sample)) and gap.max() > 0:
        chosen.append(int(gap.argmax()))
        gap = np.minimum(gap, ((sample - sample[chosen[-1]]) ** 2).sum(1))
    centres = sample[chosen].copy()
    zero = np.zeros(len(sample))
    for _ in range(LLOYD_ROUNDS):
        nearest = _distances(sample, zero, np.c_[centres, np.zeros(len(centres))]).argmin(1)
        for i in np.unique(nearest):
            centres[i] = sample[nearest == i].mean(0)
    return centres


def _keyed(vectors: DataFrame, pivots, dim: int, longest: float) -> DataFrame:
    """Nearest pivot and distance of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "vec"):
            norms = batch.column("norm2").to_numpy()
            far = _distances(_matrix(batch, dim), np.sqrt(np.maximum(longest - norms, 0)), pivots.value)
            pivot = far.argmin(1).astype(np.int32)
            near = far[np.arange(len(far)), pivot]
            arrays = [pa.array(pivot), pa.array(near), *(batch.column(c) for c in ("vec_id", "vec", "n"))]
            yield pa.RecordBatch.from_arrays(arrays, ["pivot", "distance", "vec_id", "vec", "n"])

    return vectors.mapInArrow(run, "pivot int, distance double, vec_id long, vec binary, n int")


def _annuli(keyed: DataFrame, dim: int, rows: int) -> DataFrame:
    """Runs of sorted rows of one pivot, a row each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        held: list[tuple] = []
        pivot = None

        def close() -> pa.RecordBatch:
            nonlocal number, held
            vecs = np.concatenate([h[2] for h in held])
            far = np.concatenate([h[1] for h in held])
            ids = np.concatenate([h[0] for h in held]).astype("<i8")
            row = [number, int(pivot), float(far[0]), float(far[-1]), len(ids), ids.tobytes(), _pack(vecs), dim]
            number, held = number + 1, []
            return pa.RecordBatch.from_pylist([dict(zip(_arrow(_INDEX).names, row))], _arrow(_INDEX))

        count = 0
        for batch in slices(batches, "vec"):
            keys = batch.column("pivot").to_numpy()
            far, ids, vecs = batch.column("distance").to_numpy(), batch.column("vec_id").to_numpy(), _matrix(batch, dim)
            start = 0
            while start < len(keys):
                if held and (keys[start] != pivot or count >= rows):
                    yield close()
                if not held:
                    pivot, count = keys[start], 0
                same = int(np.searchsorted(keys[start:], pivot, "right"))
                end = start + min(same, rows - count)
                held.append((ids[start:end], far[start:end], vecs[start:end]))
                count, start = count + end - start, end
        if held:
            yield close()

    return keyed.mapInArrow(run, _INDEX)


class _Directory:
    """Annuli by pivot, sorted by distance, and the score bound of each for a query."""

    def __init__(self, table: pa.Table, pivots: np.ndarray, longest: float):
        table = table.sort_by([("pivot", "ascending"), ("lo", "ascending")])
        self.annulus = table.column("annulus").to_numpy()
        self.pivot = table.column("pivot").to_numpy()
        self.lo, self.hi = table.column("lo").to_numpy(), table.column("hi").to_numpy()
        self.pivots, self.longest = pivots, longest

    def bounds(self, rows: np.ndarray) -> np.ndarray:
        """Queries by annuli: no row in there scores more. The margin covers what
        doubles round, scores being integers."""
        far = _distances(rows, np.zeros(len(rows)), self.pivots)[:, self.pivot]
        gap = np.maximum(np.maximum(far - self.hi, self.lo - far), 0)
        total = ((rows * rows).sum(1) + self.longest)[:, None]
        return (total - gap * gap) / 2 + 1e-6 * total + 0.5


def _ask(queries: DataFrame, directory, dim: int, seen: int, visits: int | None) -> DataFrame:
    """Per annulus the queries that visit it in this round, by slices of queries: those
    that come at places from ``seen`` on in a query's order of bounds, while the bound
    reaches the query's floor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = directory.value
        for whole in slices(batches, "vec"):
            for start in range(0, whole.num_rows, QUERIES_PER_SLICE):
                batch = whole.slice(start, QUERIES_PER_SLICE)
                rows = _matrix(batch, dim)
                ids = batch.column("vec_id").to_numpy().astype("<i8")
                floors = batch.column("floor").to_numpy().astype("<f8")
                visitors: dict[int, list[int]] = {}
                # One query after the other: the directory may be long.
                for i in range(len(rows)):
                    bound = known.bounds(rows[i : i + 1])[0]
                    order = np.argsort(-bound, kind="stable")[seen : None if visits is None else seen + visits]
                    for place in order[bound[order] >= floors[i]].tolist():
                        visitors.setdefault(place, []).append(i)
                out: list[tuple] = []
                for place, who in visitors.items():
                    vecs = _pack(rows[who])
                    out.append((int(known.annulus[place]), ids[who].tobytes(), vecs, floors[who].tobytes(), len(who)))
                    if len(out) * len(vecs) > 8_000_000:
                        yield pa.RecordBatch.from_pylist([dict(zip(_arrow(_ASKED).names, r)) for r in out], _arrow(_ASKED))
                        out = []
                yield pa.RecordBatch.from_pylist([dict(zip(_arrow(_ASKED).names, r)) for r in out], _arrow(_ASKED))

    return queries.mapInArrow(run, _ASKED)


def exact_products(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Integer inner products of integers held as doubles."""
    largest = np.abs(queries).max(initial=0) * np.abs(rows).max(initial=0) * max(1, rows.shape[1])
    if largest < 1 << 53:
        return (queries @ rows.T).astype(np.int64)
    as_int = np.vectorize(int, otypes=[object])
    return np.array(as_int(queries) @ as_int(rows).T, dtype=np.int64)


def best_of(scores: np.ndarray, ids: np.ndarray, own: int, k: int) -> list[tuple[int, int]]:
    """The k best distinct ids but one's own, equal scores by id."""
    if len(scores) > 8 * k:
        # What is below the k-th of so many rows can only matter if ids repeat.
        least = np.partition(scores, len(scores) - 4 * k)[len(scores) - 4 * k]
        near = np.flatnonzero(scores >= least)
        found = _first(scores[near], ids[near], own, k)
        if len(found) == k:
            return found
    return _first(scores, ids, own, k)


def _first(scores: np.ndarray, ids: np.ndarray, own: int, k: int) -> list[tuple[int, int]]:
    found: dict[int, int] = {}
    for i in np.lexsort((ids, -scores)):
        if ids[i] != own and int(ids[i]) not in found:
            found[int(ids[i])] = int(scores[i])
            if len(found) == k:
                break
    return list(found.items())


def _visit(index: DataFrame, asked: DataFrame, dim: int, k: int) -> DataFrame:
    """The k best rows of each visited annulus for each visitor, down to its floor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                one = {name: batch.column(name)[row].as_py() for name in batch.schema.names}
                ids = np.frombuffer(one["ids"], "<i8")
                rows = _unpack(one["vecs"], one["n"], dim)
                own = np.frombuffer(one["asked_ids"], "<i8")
                floors = np.frombuffer(one["floors"], "<f8")
                scores = exact_products(_unpack(one["asked_vecs"], one["asked"], dim), rows)
                out: list[tuple[int, int, int]] = []
                for i in range(len(own)):
                    found = best_of(scores[i], ids, own[i], k)
                    out += [(int(own[i]), vec_id, s) for vec_id, s in found if s >= floors[i]]
                columns = list(zip(*out)) or [[], [], []]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], _arrow(_FOUND).names)

    visitors = asked.withColumnsRenamed({"ids": "asked_ids", "vecs": "asked_vecs"})
    return index.join(visitors, "annulus").select(
        "n", "ids", "vecs", "asked", "asked_ids", "asked_vecs", "floors"
    ).mapInArrow(run, _FOUND)


def _top(found: DataFrame, k: int) -> DataFrame:
    """The k best per query of all that was found."""
    pairs = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = pairs.withColumn("rank", F.row_number().over(order))
    return ranked.filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def nearest(vectors: DataFrame, every: int = 50, k: int = 5, pivots: int = PIVOTS) -> DataFrame:
    """query_id, rank, vec_id and score of the k best rows for each row whose id is
    divisible by ``every``; see the module."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    table = save(rows.mapInArrow(_quantise, _VECTORS), "vectors")
    size = table.agg(F.count(F.lit(1)).alias("rows"), F.max("n").alias("dim"), F.max("norm2").alias("norm2")).first()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    if not size["rows"]:
        return empty
    dim, longest = size["dim"], size["norm2"]

    drawn = table.orderBy(F.xxhash64("vec_id", "vec"), "vec_id").limit(SAMPLE)
    sample = drawn.toArrow().combine_chunks().to_batches()[0]
    extra = np.sqrt(np.maximum(longest - sample.column("norm2").to_numpy(), 0))
    centres = choose_pivots(np.c_[_matrix(sample, dim), extra], pivots)
    shared = share(spark, centres)

    per_annulus = max(ANNULUS_ROWS, -(-size["rows"] // MAX_ANNULI))
    # Equal vectors are told apart by id, so that they can be split over tasks.
    keyed = _keyed(table, shared, dim, longest).repartitionByRange("pivot", "distance", "vec_id")
    keyed = keyed.sortWithinPartitions("pivot", "distance", "vec_id")
    index = save(_annuli(keyed, dim, per_annulus), "index")
    listed = index.select("annulus", "pivot", "lo", "hi").toArrow()
    directory = share(spark, _Directory(listed, centres, longest))

    queries = table.filter(F.col("vec_id") % every == 0).select("vec_id", "vec", "n")
    found, seen = None, 0
    for visits in ROUNDS:
        if found is None:
            asking = queries.withColumn("floor", F.lit(float("-inf")))
        else:
            # The k-th best so far, if there are as many.
            floors = found.filter(F.col("rank") == k).select(
                F.col("query_id").alias("vec_id"), F.col("score").cast("double").alias("floor")
            )
            asking = queries.join(floors, "vec_id", "left").fillna(float("-inf"), ["floor"])
        more = _visit(index, _ask(asking, directory, dim, seen, visits), dim, k)
        before = more if found is None else more.unionByName(found.drop("rank"))
        found = save(_top(before, k), f"found{seen}")
        seen += visits or 0
        if seen >= listed.num_rows:
            break
    return found
