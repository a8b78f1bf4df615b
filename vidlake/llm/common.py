"""What several operators share: words, hashes, batches and scratch tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vidlake.session import scratch_dir

# Bytes a worker keeps per generation of a word cache, and the longest word kept.
CACHE_BYTES = 37_500_000
CACHE_WORD_BYTES = 64
# A word, its result and their place in a dict; words are short, as longer ones are not
# kept, and so are results.
ENTRY_BYTES = 250
# Texts are handled in slices of about so many bytes.
SLICE_BYTES = 8_000_000
# Column that tells rows of one id apart by their text.
TEXT_HASH = "_vidlake_text_hash"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def files_for(rows: int, per_file: int) -> int:
    """Files for so many rows at most, so that small tables are not many files."""
    return max(12, -(-rows // per_file))


#: What a batch that goes to Python holds at most while a table is written: tasks work
#: on slices of about SLICE_BYTES, and larger batches are memory on both sides.
_BATCHES = {
    "spark.sql.execution.arrow.maxBytesPerBatch": str(SLICE_BYTES),
    "spark.sql.execution.arrow.maxRecordsPerBatch": "4000",
}


def save(df: DataFrame, name: str, files: int | None = None) -> DataFrame:
    """Write a table to the folder all executors share and read it back, which
    cuts the lineage: a lost executor costs no more than its own tasks. Spark's
    partitions are put together to the given number of files, if there are more."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{name}"
    if files is not None:
        df = df.coalesce(files)
    before = {key: spark.conf.get(key, None) for key in _BATCHES}
    try:
        for key, value in _BATCHES.items():
            spark.conf.set(key, value)
        df.write.option("compression", "zstd").parquet(path)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    return spark.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, name: str) -> str:
    """The name, or one like it that the table does not have."""
    taken = {column.lower() for column in df.columns}
    while name in taken:
        name += "_"
    return name


def fifth(doc_id: str | Column) -> Column:
    """crc32 of the id's text, modulo 5; a null id counts as empty text."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(column.cast("string"), F.lit(""))) % 5


#: The caches of this worker, and the operator that filled them.
_CACHES: list[WordCache] = []
_FILLED_BY: list[str] = []
#: Values sent to every task by this driver, and not yet taken back.
_SHARED: list[Broadcast] = []


class WordCache(dict):
    """Results of a function of a word (or, with longest 0, a number), computed
    once per worker. A full cache becomes the old one, which words used again are
    taken from, and the one before it is forgotten; so there are two of them at most,
    of some ``room`` bytes each, at ENTRY_BYTES for an entry."""

    def __init__(self, function: Callable, room: int = CACHE_BYTES, longest: int = CACHE_WORD_BYTES):
        super().__init__()
        self.function = function
        self.entries = room // ENTRY_BYTES
        self.longest = longest
        self.old: dict = {}
        _CACHES.append(self)

    def __missing__(self, word):
        value = self.old.get(word)
        if value is None:
            value = self.function(word)
            if self.longest and len(word) > self.longest:
                return value
        if len(self) >= self.entries:
            self.old = dict(self)
            self.clear()
        self[word] = value
        return value

    def forget(self) -> None:
        self.clear()
        self.old = {}


def at_work(operator: str) -> None:
    """Called as a task begins: what another operator has kept in this worker goes, and
    so does memory that batches have left."""
    pa.default_memory_pool().release_unused()
    if _FILLED_BY != [operator]:
        for kept in _CACHES:
            kept.forget()
        _FILLED_BY[:] = [operator]


def share(spark: SparkSession, value: object) -> Broadcast:
    """Send a value of bounded size to every task; see released()."""
    _SHARED.append(spark.sparkContext.broadcast(value))
    return _SHARED[-1]


@contextmanager
def released() -> Iterator[None]:
    """Take back what was sent to the tasks in here. Only for results that have been
    written by the end, as nothing else could be computed again."""
    before = len(_SHARED)
    try:
        yield
    finally:
        for value in _SHARED[before:]:
            value.destroy()
        del _SHARED[before:]


_hashes = WordCache(xxhash.xxh3_64_intdigest)


def words(text: str) -> list[bytes]:
    """Words between ASCII white space, with A-Z lower-cased, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").lower().split()


def hashes(tokens: list[bytes]) -> np.ndarray:
    """64-bit hash of each token."""
    return np.fromiter(map(_hashes.__getitem__, tokens), np.uint64, len(tokens))


def mix(values: np.ndarray) -> np.ndarray:
    """Finish 64-bit values so that every bit depends on every bit."""
    values = values ^ (values >> np.uint64(33))
    values = values * np.uint64(0xFF51AFD7ED558CCD)
    values = values ^ (values >> np.uint64(33))
    values = values * np.uint64(0xC4CEB9FE1A85EC53)
    return values ^ (values >> np.uint64(33))


def odd_multipliers(n: int, seed: int) -> np.ndarray:
    """n fixed odd 64-bit numbers."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed << 20)) | np.uint64(1)


def as_long(values: np.ndarray) -> np.ndarray:
    """Unsigned 64-bit values as Spark's signed ones."""
    return values.view(np.int64)


def text_of(value: str | None) -> str:
    return "" if value is None else value


def slices(batches: Iterable[pa.RecordBatch], column: str = "text") -> Iterator[pa.RecordBatch]:
    """Cut batches so that none holds much more than SLICE_BYTES of text, whole
    rows each."""
    for batch in batches:
        if not batch.num_rows:
            continue
        per_row = max(1, batch.column(column).nbytes // batch.num_rows)
        rows = max(1, SLICE_BYTES // per_row)
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def map_texts(
    docs: DataFrame, function: Callable[[pa.RecordBatch], dict[str, list]], schema: str
) -> DataFrame:
    """One call per slice of rows; it returns the columns of the schema."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at_work(function.__module__)
        for batch in slices(batches):
            columns = function(batch)
            yield pa.RecordBatch.from_pydict(columns)
        pa.default_memory_pool().release_unused()

    return docs.mapInArrow(run, schema)


def sorted_groups(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of equal keys from batches sorted by them."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(batch.num_rows - 1, bool)
        for c in columns:
            change |= c[1:] != c[:-1]
        edges = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
        for start, end in zip(edges, edges[1:]):
            key = tuple(c[start] for c in columns)
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(start, end - start))
            last = key
    if held:
        yield pa.Table.from_batches(held)
