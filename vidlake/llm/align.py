"""Alignment of two tokenizers over the same text, byte by byte.

A text, with a blank before it, is encoded by a byte-level BPE (A) and by a piece BPE
with byte fallback (B). A's character offsets and the spans of B's proto say where tokens
end; where a character is shared by several tokens, which the offsets cannot tell apart,
and for byte-fallback tokens, whose spans are empty but for the last, the ends come from
the decoded bytes. Every token is then held against the bytes it should stand for. Offsets
where tokens of both end cut the text into groups, and tokens whose bytes overlap are
linked.

Neither tokenizer joins what a blank after a word separates, or a line break, or a mark
after a letter (for B this is read off its vocabulary), so texts are cut there and workers
keep the alignment of words they have seen. How often each pair of ids is linked is counted over the corpus, after adding up
within tasks. The most frequent pairs, no more than SHARED_PAIRS, are sent to every task;
documents look those up at once, and meet the counts of the rare ones in a join.

Odd cases. Null and empty texts, and those that a tokenizer does not give back byte by
byte (as with U+2581, which B takes for a blank), have no tokens: zeros and an empty
digest, and they add nothing to the counts. Every row is a document of its own, with or
without an id, repeated or not. An empty table gives an empty result; other columns do
not matter. Very long words are not kept, and never cut.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterable, Iterator
from functools import cache, partial
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from vidlake.llm.common import at_work, save, share, slices
from vidlake.llm.tokens import byte_letters

# Pairs that are sent to every task, 17 bytes each.
SHARED_PAIRS = 1_000_000
# Links that are added up at once within a task.
LINKS_AT_ONCE = 1 << 21
# Characters of text, and new words, that are handled at once.
TEXT_AT_ONCE = 1 << 20
LEARNT_AT_ONCE = 20_000
# Words a worker keeps per generation, and the longest one kept.
CACHE_UNITS = 400_000
CACHE_LENGTH = 48
# Letters and marks between which B has no pieces; units to put before others.
_LETTER = "[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]"
_MARKS = ".,;:!?)"
_BEFORE = (" a", " a\n")
# Marks the first link of each token of A; ids need fewer bits.
BEGINS = 1 << 31

_ALIGNED = (
    "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "pairs array<long>, times array<int>"
)
_RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"


class Aligner:
    """Both tokenizers, and the alignment of texts."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        back = {c: b for b, c in byte_letters().items()}
        vocabulary = self.a.get_vocab(with_added_tokens=False)
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.a_bytes[i] = bytes(back[c] for c in token)
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        size = self.b.get_piece_size()
        pieces = [self.b.id_to_piece(i) for i in range(size)]
        self.is_byte = np.array([self.b.is_byte(i) for i in range(size)])
        self.b_bytes = [
            bytes([int(p[3:5], 16)]) if byte else p.replace("\u2581", " ").encode()
            for p, byte in zip(pieces, self.is_byte)
        ]
        self.a_sizes = np.array([len(x) for x in self.a_bytes])
        self.b_sizes = np.array([len(x) for x in self.b_bytes])
        # Where to cut: before a blank after a word, around a single line break, and
        # before a mark after a letter. None where B has pieces across such a place;
        # A's pattern separates all of them.
        cuts = []
        if not any(re.search("[^\u2581]\u2581", p) for p in pieces):
            cuts.append(r"(?<=\S)(?= )")
            if not any("\n" in p for p in pieces):
                cuts.append(r"(?<=\S)(?=\n)|(?<=\S\n)(?=\S)")
            marks = "".join(m for m in _MARKS if not any(re.search(_LETTER + re.escape(m), p) for p in pieces))
            if marks:
                cuts.append(f"(?<={_LETTER})(?=[{re.escape(marks)}])")
        self.cut = re.compile("|".join(cuts)) if cuts else None
        #: Ids with the mark after them: in a side, between sides, between groups, none.
        ids = range(max(len(self.a_bytes), size))
        self.texts = [f"{i}{mark}" for i in ids for mark in (",", "|", ";", "")]
        #: Unit to its groups as text and its links; None if it is not given back.
        self.units: dict[str, tuple[str, bytes] | None] = {}
        self.old: dict[str, tuple[str, bytes] | None] = {}

    def _a_tokens(self, text: str, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """A's ids and where they end in the bytes."""
        found = self.a.encode(text, add_special_tokens=False)
        ids = np.array(found.ids, np.int64)
        spans = np.fromiter(chain.from_iterable(found.offsets), np.int64, 2 * len(ids))
        starts, ends = spans[::2], spans[1::2]
        places = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
        # The next token has bytes of the same character.
        shared = np.append(starts[1:] < ends[:-1], False)
        return ids, _refined(places[ends], shared, self.a_sizes[ids])

    def _b_tokens(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """The same of B, whose spans count bytes, without the blank it puts first."""
        pieces = self.b.encode(text[1:], return_type="proto").pieces
        ids = np.fromiter((p.id for p in pieces), np.int64, len(pieces))
        coarse = np.fromiter((p.end for p in pieces), np.int64, len(pieces)) + 1
        return ids, _refined(coarse, self.is_byte[ids], self.b_sizes[ids])

    def learn(self, wanted: list[str]) -> list[tuple[str, bytes] | None]:
        """Groups and links of units of which all but the last end in a character that
        is not white space, or in one line break. They are encoded in one text, each
        that is no word after a blank after what it may come after."""
        if not wanted:
            return []
        units, mine = [], []
        for unit in wanted:
            if unit[0] != " " or unit.isspace():
                units.append(_BEFORE[0] if unit[0] in _MARKS or unit[0].isspace() else _BEFORE[1])
            mine.append(len(units))
            units.append(unit)
        text = "".join(units)
        whole = text.encode("utf-8", "surrogatepass")
        a, a_ends = self._a_tokens(text, np.frombuffer(whole, np.uint8))
        b, b_ends = self._b_tokens(text)
        for ids, ends, known, sizes in (
            (a, a_ends, self.a_bytes, self.a_sizes),
            (b, b_ends, self.b_bytes, self.b_sizes),
        ):
            given = b"".join(map(known.__getitem__, ids.tolist()))
            if given != whole or not np.array_equal(np.cumsum(sizes[ids]), ends):
                # Some unit is not given back: halves tell which.
                half = len(wanted) // 2
                return [None] if not half else self.learn(wanted[:half]) + self.learn(wanted[half:])
        sizes = map(len, units) if len(whole) == len(text) else (len(u.encode("utf-8", "surrogatepass")) for u in units)
        last = np.cumsum(np.fromiter(sizes, np.int64, len(units)))
        # Between neighbouring ends one token of A and one of B overlap.
        every = np.union1d(a_ends, b_ends)
        a_place, b_place = np.searchsorted(a_ends, every), np.searchsorted(b_ends, every)
        begins = np.append(True, a_place[1:] != a_place[:-1])
        links = (b[b_place] << 32 | a[a_place] | begins * BEGINS).astype("<i8").tobytes()
        link_ends = (8 * np.searchsorted(every, last, "right")).tolist()
        # Tokens of a group: A's, then B's, each with the mark that follows it.
        common = np.intersect1d(a_ends, b_ends, assume_unique=True)
        groups = [np.searchsorted(common, ends) for ends in (a_ends, b_ends)]
        group = np.concatenate(groups)
        marks = [np.append(g[1:] != g[:-1], True) for g in groups]
        marks[0] = marks[0] * 1
        marks[1] = marks[1] * 2 + np.isin(b_ends, last, assume_unique=True)
        of_b = np.repeat([0, 1], [len(a), len(b)])
        order = np.lexsort((of_b, group))
        code = (np.concatenate([a, b]) << 2 | np.concatenate(marks))[order]
        tokens = list(map(self.texts.__getitem__, code.tolist()))
        token_ends = (np.searchsorted(a_ends, last, "right") + np.searchsorted(b_ends, last, "right")).tolist()
        out, token, link = [], 0, 0
        for token_end, link_end in zip(token_ends, link_ends):
            out.append(("".join(tokens[token:token_end]), links[link:link_end]))
            token, link = token_end, link_end
        return [out[place] for place in mine]

    def _look_up(self, wanted: set[str]) -> dict[str, tuple[str, bytes] | None]:
        """What is known of some units, after learning the others."""
        if len(self.units) >= CACHE_UNITS:
            self.old, self.units = self.units, {}
        new = wanted - self.units.keys()
        kept = new & self.old.keys()
        self.units.update((u, self.old[u]) for u in kept)
        long = {}
        for part in _parts(new - kept):
            for unit, found in zip(part, self.learn(part)):
                (self.units if len(unit) <= CACHE_LENGTH else long)[unit] = found
        return self.units | long if long else self.units

    def align(self, texts: Iterable[str | None]) -> list[Alignment]:
        """The alignment of each text."""
        out: list[Alignment] = []
        held: list[tuple[Alignment, list[str]]] = []
        size = 0

        def fold() -> None:
            known = self._look_up(set().union(*(units for _, units in held)))
            for to, units in held:
                to.add([known[u] for u in units])
            held.clear()

        for text in texts:
            out.append(Alignment())
            for units in self._pieces(" " + text) if text else ():
                held.append((out[-1], units))
                size += sum(map(len, units))
                if size >= TEXT_AT_ONCE:
                    fold()
                    size = 0
        fold()
        return out

    def _pieces(self, text: str) -> Iterator[list[str]]:
        """The units of a text, in lists of bounded size."""
        start = 0
        while self.cut and (cut := self.cut.search(text, start + TEXT_AT_ONCE)):
            yield self.cut.split(text[start : cut.start()])
            start = cut.start()
        yield self.cut.split(text[start:]) if self.cut else [text]


def _parts(units: Iterable[str]) -> Iterator[list[str]]:
    """Units to be learnt together; one that ends with white space is the last of its
    part."""
    part: list[str] = []
    for unit in units:
        part.append(unit)
        if len(part) == LEARNT_AT_ONCE or unit[-1].isspace():
            yield part
            part = []
    if part:
        yield part


def _refined(coarse: np.ndarray, unsure: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Ends of tokens: those that offsets tell, and from them on decoded bytes."""
    told = np.where(unsure, -1, np.arange(len(coarse)))
    from_ = np.maximum.accumulate(told)
    length = np.cumsum(sizes)
    known = from_ >= 0
    ends = length.copy()
    ends[known] = coarse[from_[known]] + length[known] - length[from_[known]]
    return ends


class Alignment:
    """What is known of one text while its units are added."""

    def __init__(self):
        self.n_a = self.n_links = self.n_groups = 0
        self.whole = True
        self.digest = None
        self.pairs: tuple[np.ndarray, np.ndarray] | None = None

    def add(self, found: list[tuple[str, bytes] | None]) -> None:
        self.whole = self.whole and None not in found
        if not self.whole:
            return
        texts, links = zip(*found)
        groups = ";".join(texts)
        values = np.frombuffer(b"".join(links), "<i8")
        if self.digest is None:
            self.digest = hashlib.sha256()
        else:
            self.digest.update(b";")
        self.digest.update(groups.encode())
        self.n_groups += groups.count(";") + 1
        self.n_links += len(values)
        self.n_a += int(np.count_nonzero(values & BEGINS))
        pairs, times = np.unique(values & ~np.int64(BEGINS), return_counts=True)
        if self.pairs is not None:
            pairs, place = np.unique(np.concatenate([self.pairs[0], pairs]), return_inverse=True)
            times = np.bincount(place, np.concatenate([self.pairs[1], times])).astype(np.int64)
        self.pairs = pairs, times

    def row(self) -> tuple[int, int, int, int, str]:
        if not self.whole or self.digest is None:
            return 0, 0, 0, 0, ""
        # A group of a and b tokens has a + b - 1 links.
        n_b = self.n_links + self.n_groups - self.n_a
        return self.n_a, n_b, self.n_groups, self.n_links, self.digest.hexdigest()

    def counted(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.whole or self.pairs is None:
            return np.zeros(0, np.int64), np.zeros(0, np.int32)
        return self.pairs[0], self.pairs[1].astype(np.int32)


@cache
def aligner(path_a: str, path_b: str) -> Aligner:
    return Aligner(path_a, path_b)


def _aligned(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    names = [part.split()[0] for part in _ALIGNED.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at_work(__name__)
        tool = aligner(path_a, path_b)
        for batch in slices(batches):
            found = tool.align(text.as_py() for text in batch.column("text"))
            *numbers, digests = zip(*(x.row() for x in found))
            arrays = [batch.column("row"), batch.column("doc_id")]
            arrays += [pa.array(c, pa.int64()) for c in numbers] + [pa.array(digests, pa.string())]
            pairs, times = zip(*(x.counted() for x in found))
            offsets = pa.array(np.cumsum([0, *map(len, pairs)]), pa.int32())
            arrays += [pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(x))) for x in (pairs, times)]
            yield pa.RecordBatch.from_arrays(arrays, names)

    row = F.monotonically_increasing_id().alias("row")
    texts = docs.select(row, F.col("doc_id").cast("long").alias("doc_id"), "text")
    return texts.mapInArrow(run, _ALIGNED)


def _added(pairs: np.ndarray, links: np.ndarray) -> pa.RecordBatch:
    values, place = np.unique(pairs, return_inverse=True)
    sums = np.zeros(len(values), np.int64)
    np.add.at(sums, place, links)
    return pa.RecordBatch.from_arrays([pa.array(values), pa.array(sums)], ["pair", "links"])


def _counts(aligned: DataFrame) -> DataFrame:
    """Links of every pair of ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append((batch.column("pairs").flatten().to_numpy(), batch.column("times").flatten().to_numpy()))
            size += len(held[-1][0])
            if size >= LINKS_AT_ONCE:
                yield _added(*map(np.concatenate, zip(*held)))
                held, size = [], 0
        if size:
            yield _added(*map(np.concatenate, zip(*held)))

    partial_sums = aligned.select("pairs", "times").mapInArrow(run, "pair long, links long")
    return partial_sums.groupBy("pair").agg(F.sum("links").alias("links"))


def _shared(counts: DataFrame, most: int) -> tuple[int, int]:
    """From how many links on there are no more pairs than ``most``, and how many pairs
    have fewer."""
    level = F.floor(F.log2("links")).cast("int").alias("level")
    sizes = sorted(map(tuple, counts.groupBy(level).agg(F.count(F.lit(1))).collect()), reverse=True)
    held, least = 0, 62
    for power, pairs in sizes:
        if held + pairs > most:
            break
        held, least = held + pairs, power
    return 1 << least, sum(pairs for _, pairs in sizes) - held


class _Known:
    """Counts of pairs, sorted by pair."""

    def __init__(self, table: pa.Table):
        table = table.sort_by("pair")
        self.pair, self.links = table.column("pair").to_numpy(), table.column("links").to_numpy()
        self.best = table.column("best").to_numpy()

    def places(self, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where pairs are, and whether they are there."""
        place = np.searchsorted(self.pair, pairs)
        place[place == len(self.pair)] = 0
        return place, self.pair[place] == pairs if len(self.pair) else np.zeros(len(pairs), bool)


def _flat(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row number in the batch, pair and times."""
    lengths = batch.column("pairs").value_lengths().to_numpy()
    flat = (batch.column(c).flatten().to_numpy() for c in ("pairs", "times"))
    return (np.repeat(np.arange(len(lengths)), lengths), *flat)


def _summed(known, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents with the sums over the pairs sent to every task."""
    for batch in slices(batches, "pairs"):
        row, pairs, times = _flat(batch)
        place, there = known.value.places(pairs)
        row, place, times = row[there], place[there], times[there].astype(np.int64)
        sums = np.zeros((2, batch.num_rows), np.int64)
        np.add.at(sums[0], row, times * known.value.best[place])
        np.add.at(sums[1], row, times * known.value.links[place])
        rest = batch.drop_columns(["pairs", "times"])
        yield rest.append_column("n_best", pa.array(sums[0])).append_column("count_sum", pa.array(sums[1]))


def _left(known, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The other pairs of the documents."""
    for batch in slices(batches, "pairs"):
        row, pairs, times = _flat(batch)
        rare = ~known.value.places(pairs)[1]
        rows = batch.column("row").to_numpy()[row[rare]]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (rows, pairs[rare], times[rare])], ["row", "pair", "times"])


def align(docs: DataFrame, path_a: str, path_b: str, shared_pairs: int = SHARED_PAIRS) -> DataFrame:
    """One row per document: doc_id, tokens, groups, links, links whose pair is the most
    frequent one of its B id, the sum of the counts of its links' pairs, and the digest of
    its groups; see the module."""
    spark = docs.sparkSession
    aligned = save(_aligned(docs, path_a, path_b), "aligned")
    counts = save(_counts(aligned), "counts")
    piece = F.shiftright("pair", 32)
    # As many rows as B has ids.
    highest = counts.groupBy(piece.alias("piece")).agg(F.max("links").alias("highest"))
    judged = counts.join(F.broadcast(highest), piece == F.col("piece")).select(
        "pair", "links", (F.col("links") == F.col("highest")).alias("best")
    )
    least, rare = _shared(counts, shared_pairs)
    known = share(spark, _Known(judged.filter(F.col("links") >= least).toArrow()))
    sums = aligned.mapInArrow(partial(_summed, known), f"row long, {_RESULT}, n_best long, count_sum long")
    if rare:
        left = aligned.select("row", "pairs", "times").mapInArrow(partial(_left, known), "row long, pair long, times int")
        met = left.join(judged.filter(F.col("links") < least).hint("merge"), "pair").groupBy("row")
        met = met.agg(
            F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"),
            F.sum(F.col("times") * F.col("links")).alias("more_sum"),
        )
        sums = sums.join(met, "row", "left").withColumns(
            {
                "n_best": F.col("n_best") + F.coalesce("more_best", F.lit(0)),
                "count_sum": F.col("count_sum") + F.coalesce("more_sum", F.lit(0)),
            }
        )
    return sums.select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"
    )
