"""Quality rules by distribution divergence.

Each language has two references, learned from all documents of that language, every
document counting the same: how its characters fall into classes, and how its words
fall on the TOP_WORDS most frequent words of the language, in classes by rank (1, 2-3,
4-7, ...), and all others. A document is far from its language if the Jensen-Shannon
distance of one of its histograms (square root of the divergence, base 2, so from 0 to
1) is beyond a limit. A short text's histogram strays by chance, so the limits are wider
the fewer words there are, and texts of fewer than MIN_WORDS words are not judged by
distance at all. The limit for words lies WORD_REACH of the way from the distance that
chance alone gives a text of that length to the language's distance from a text that
has none of its frequent words, so it can be passed at every length.

Before that, the base rules: too few words, or too many words in repeated windows.

Cases: null text has no words and fails; so does empty text. A null or unknown
language is a language of its own. Rows that repeat each get a row, null ids too.
Words that are equally frequent are taken in order of their bytes. Other columns are
not looked at.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vidlake.llm.common import hashes, mix, odd_multipliers, save, slices, text_of

TOP_WORDS = 1023
# Pieces that the words of a language are ranked in at first.
SALTS = 256
# Languages whose references are sent to every task at once, some 20 kB each.
LANGUAGES_AT_ONCE = 1000
MIN_WORDS = 50
# 100 * repeated words > MAX_REPEATED * words fails.
MAX_REPEATED = 50
WINDOW = 3
# Limit of the distance of characters, and how much wider it is for one word.
CHAR_LIMIT, CHAR_SLACK = 0.22, 0.6
WORD_REACH = 0.4

_SYMBOLS = b"#*$%&|<>"
_CLASSES = ["space", "line", "small", "capital", "digit", "stop", "quote", "symbol", "mark", "control", "lead", "tail"]
_OTHER = b" "  # stands for all other words; no word holds a blank


def _class_of(byte: int) -> int:
    char = chr(byte)
    name = (
        "tail" if 128 <= byte < 192
        else "lead" if byte >= 192
        else "space" if char in " \t"
        else "line" if char in "\n\r"
        else "small" if char.islower()
        else "capital" if char.isupper()
        else "digit" if char.isdigit()
        else "stop" if char in ".,;:!?"
        else "quote" if char in "'\"()-"
        else "symbol" if byte in _SYMBOLS
        else "mark" if char.isprintable()
        else "control"
    )
    return _CLASSES.index(name)


_TABLE = bytes(map(_class_of, range(256)))
_TAIL = _CLASSES.index("tail")
_MULTIPLY = odd_multipliers(WINDOW, 9)


def char_histogram(data: bytes) -> np.ndarray:
    """Characters per class; all but the first byte of a character are left out."""
    found = np.bincount(np.frombuffer(data.translate(_TABLE), np.uint8), minlength=len(_CLASSES)).astype(float)
    found[_TAIL] = 0
    return found


def distance(one: np.ndarray, other: np.ndarray) -> float:
    """Jensen-Shannon distance of two histograms that are not empty."""
    p, q = one / one.sum(), other / other.sum()
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        parts = np.where(p > 0, p * np.log2(p / m), 0) + np.where(q > 0, q * np.log2(q / m), 0)
    return float(np.sqrt(max(0.0, parts.sum() / 2)))


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a window of WINDOW words found twice or more."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    single = hashes(words)
    total = np.zeros(n, np.uint64)
    for k in range(WINDOW):
        total += single[k : k + n] * _MULTIPLY[k]
    _, place, count = np.unique(mix(total), return_inverse=True, return_counts=True)
    twice = count[place] > 1
    covered = np.zeros(len(words), bool)
    for k in range(WINDOW):
        covered[k : k + n] |= twice
    return int(covered.sum())


def repeated_lines(data: bytes) -> int:
    """Lines with a word that equal an earlier one."""
    lines = [line for line in data.split(b"\n") if line.strip()]
    return len(lines) - len(set(lines))


def _bytes(text: str | None) -> bytes:
    return text_of(text).encode("utf-8", "surrogatepass")


def _frequent(docs: DataFrame, top: int) -> DataFrame:
    """lang, word, rank of the most frequent words, lower-cased, of each language."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str | None, Counter] = {}

        def emptied():
            for lang, counter in found.items():
                words = list(counter)
                for start in range(0, len(words), 50_000):
                    part = words[start : start + 50_000]
                    yield pa.RecordBatch.from_pydict(
                        {
                            "lang": pa.array([lang] * len(part), pa.string()),
                            "word": pa.array(part, pa.binary()),
                            "n": pa.array([counter[w] for w in part], pa.int64()),
                        }
                    )
            found.clear()

        for batch in slices(batches):
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                found.setdefault(lang, Counter()).update(_bytes(text).lower().split())
            if sum(map(len, found.values())) > 300_000:
                yield from emptied()
        yield from emptied()

    counted = docs.select("lang", "text").mapInArrow(count, "lang string, word binary, n long")
    counted = counted.groupBy("lang", "word").agg(F.sum("n").alias("n"))
    # First within pieces of a language, as all its words are too many for one task.
    salted = counted.withColumn("salt", F.pmod(F.xxhash64("word"), F.lit(SALTS)))
    order = F.desc("n"), "word"
    piece = F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))
    best = salted.withColumn("place", piece).filter(F.col("place") <= top)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order))
    return best.withColumn("rank", rank).filter(F.col("rank") <= top).select("lang", "word", "rank")


def references(docs: DataFrame, *, top: int = TOP_WORDS) -> DataFrame:
    """lang, words, chars, shares: the references of every language. One row per
    language, so its size is that of the list of languages; see quality()."""
    frequent = save(_frequent(docs, top), "frequent")
    listed = frequent.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("rank", "word")))["word"].alias("words"))
    known = {row["lang"]: [bytes(w) for w in row["words"]] for row in listed.collect()}
    shared = docs.sparkSession.sparkContext.broadcast(known)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = _places(shared.value)
        sums: dict[str | None, list] = {}
        for batch in slices(batches):
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                data = _bytes(text)
                words = data.lower().split()
                if len(words) >= MIN_WORDS:
                    chars, shares = char_histogram(data), _word_histogram(words, place[lang], top.bit_length())
                    total = sums.setdefault(lang, [np.zeros(len(chars)), np.zeros(len(shares))])
                    total[0] += chars / chars.sum()
                    total[1] += shares / shares.sum()
        rows = [
            (lang, kind, at, value)
            for lang, totals in sums.items()
            for kind, total in enumerate(totals)
            for at, value in enumerate(total)
        ]
        if rows:
            langs, kinds, places, values = zip(*rows)
            yield pa.RecordBatch.from_pydict(
                {"lang": pa.array(langs, pa.string()), "kind": pa.array(kinds, pa.int32()), "at": pa.array(places, pa.int32()), "value": values}
            )

    summed = docs.select("lang", "text").mapInArrow(add, "lang string, kind int, at int, value double")
    summed = summed.groupBy("lang", "kind", "at").agg(F.sum("value").alias("value"))
    lists = summed.groupBy("lang", "kind").agg(F.sort_array(F.collect_list(F.struct("at", "value")))["value"].alias("values"))
    by_kind = lists.groupBy("lang").agg(
        F.max(F.when(F.col("kind") == 0, F.col("values"))).alias("chars"),
        F.max(F.when(F.col("kind") == 1, F.col("values"))).alias("shares"),
    )
    same = by_kind["lang"].eqNullSafe(listed["lang"])
    return listed.join(by_kind, same).select(listed["lang"], "words", "chars", "shares")


def _places(known: dict) -> dict:
    """Classes of the frequent words of every language; 0 is left for others."""
    return {lang: {word: at.bit_length() for at, word in enumerate(words, 1)} for lang, words in known.items()}


def _word_histogram(words: list[bytes], place: dict[bytes, int], classes: int) -> np.ndarray:
    at = [place.get(w, 0) for w in words]
    return np.bincount(np.array(at, np.int64), minlength=classes + 1).astype(float)


def word_limit(shares: np.ndarray, n: int) -> float:
    """Limit of the word distance of a text of n words from a reference."""
    chance = np.sqrt((len(shares) - 1) / (8 * np.log(2) * n))
    none = np.zeros(len(shares))
    none[0] = 1
    return float(chance + WORD_REACH * (distance(none, shares) - chance))


def judge(docs: DataFrame, known: DataFrame) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    char_distance, word_distance, kept of every row."""
    by_lang = {
        row["lang"]: ([bytes(w) for w in row["words"]], np.array(row["chars"]), np.array(row["shares"]))
        for row in known.collect()
    }
    shared = docs.sparkSession.sparkContext.broadcast(by_lang)
    numbers = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = _places({lang: words for lang, (words, _, _) in shared.value.items()})
        for batch in slices(batches):
            out: dict[str, list] = {k: [] for k in [*numbers, "base_failed", "char_distance", "word_distance", "kept"]}
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                data = _bytes(text)
                words = data.split()
                n, repeat = len(words), repeated_words(words)
                failed = n < MIN_WORDS or 100 * repeat > MAX_REPEATED * n
                chars, shares, far = None, None, False
                if n >= MIN_WORDS and lang in place:
                    _, char_share, word_share = shared.value[lang]
                    chars = distance(char_histogram(data), char_share)
                    shares = distance(_word_histogram(data.lower().split(), place[lang], len(word_share) - 1), word_share)
                    far = chars > CHAR_LIMIT + CHAR_SLACK / np.sqrt(n) or shares > word_limit(word_share, n)
                # A character's later bytes are 0x80 to 0xBF.
                joined = b"".join(words)
                later = len(joined) - len(joined.decode("utf-8", "surrogatepass")) if not joined.isascii() else 0
                values = (
                    n, len(joined) - later, len(data) - len(data.translate(None, _SYMBOLS)), repeated_lines(data), repeat,
                    failed, chars, shares, not failed and not far,
                )
                for column, value in zip(out.values(), values):
                    column.append(value)
            types = [pa.int64()] * 5 + [pa.bool_(), pa.float64(), pa.float64(), pa.bool_()]
            arrays = [pa.array([bool(v) if t == pa.bool_() else v for v in c], t) for c, t in zip(out.values(), types)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *arrays], ["doc_id", *out])

    schema = ", ".join(["doc_id long", *(f"{k} long" for k in numbers), "base_failed boolean"])
    return docs.select("doc_id", "lang", "text").mapInArrow(
        run, f"{schema}, char_distance double, word_distance double, kept boolean"
    )


def quality(docs: DataFrame, *, languages_at_once: int = LANGUAGES_AT_ONCE) -> DataFrame:
    """References from the documents, and the verdict on each of them. A column of
    languages with more values than that is gone through in blocks of values."""
    languages = docs.select("lang").distinct().count()
    blocks = max(1, -(-languages // languages_at_once))
    judged = None
    for number in range(blocks):
        some = docs if blocks == 1 else docs.filter(F.pmod(F.xxhash64("lang"), F.lit(blocks)) == number)
        part = judge(some, references(some))
        judged = part if judged is None else judged.unionByName(part)
    return judged
