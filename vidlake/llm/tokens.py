"""Exact token ids and exact token counts of every prefix, from the public
tokenizers' own files, at the cost of one look-up per word.

Both tokenizers split a text at white space before they merge, so a word's tokens
do not depend on its neighbours. Workers keep the words they have seen.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
from array import array
from functools import cache

import numpy as np
import regex

from vidlake.llm.common import WordCache

# Unicode's white space, as the tokenizers' patterns mean it.
_WHITE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
CACHE_UNITS = 200_000
# Bytes of words and of smaller parts that a worker keeps, twice; see WordCache.
WORD_BYTES = 160_000_000
PART_BYTES = 60_000_000
# Lengths of beginnings that are kept.
_SHARED = (8, 6, 4)
# Marks that end a word, none of which begins a piece of its own with what follows.
_MARKS = b".,;:!?%&*#$|)(-+=/"
# Up to here all versions of Unicode agree on letters and case; words with later
# characters are split by the library itself.
_SETTLED = re.compile("[^\x00-\u052f]")


@cache
def _library(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@cache
def byte_letters() -> dict[int, str]:
    """The character that stands for each byte in byte-level vocabularies:
    printable ones for themselves, the others for those from 256 on, in order."""
    plain = [b for b in range(256) if chr(b).isprintable() and b != 32 and b != 173]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class WordIds:
    """Ids of whole texts by a tokenizer with word ends, which drops white space:
    pieces of a word are looked up, new ones go through the library's model."""

    def __init__(self, path: str):
        self.tokenizer = _library(path)
        self.letters = byte_letters()
        self.words = WordCache(self._word, WORD_BYTES)
        self.pieces = WordCache(self._piece, PART_BYTES)
        ends = "'s|'t|'re|'ve|'m|'ll|'d"
        self.ascii = re.compile(rf"{ends}|[a-z]+|[0-9]|[^a-z0-9{_WHITE}]+")
        self.full = regex.compile(rf"{ends}|\p{{L}}+|\p{{N}}|[^{_WHITE}\p{{L}}\p{{N}}]+")

    def _piece(self, piece: bytes | str) -> bytes:
        """Ids of a piece; as bytes it is letters or marks only."""
        if isinstance(piece, bytes):
            text = piece.decode()
        else:
            text = piece.encode("utf-8", "surrogatepass").decode("latin-1").translate(self.letters)
        return array("I", [t.id for t in self.tokenizer.model.tokenize(text)]).tobytes()

    def _word(self, word: bytes) -> bytes:
        if word.isascii():
            low = word.lower()
            if low.isalpha():
                return self.pieces[low]
            core = low.rstrip(_MARKS)
            if core.isalpha():
                return self.pieces[core] + self.pieces[low[len(core) :]]
            if b"<|" not in low:
                return b"".join(map(self.pieces.__getitem__, self.ascii.findall(low.decode())))
        text = word.decode("utf-8", "surrogatepass")
        if _SETTLED.search(text) or b"<|" in word:
            return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        found = self.full.findall(unicodedata.normalize("NFC", text).replace("Σ", "σ").lower())
        return b"".join(map(self.pieces.__getitem__, found))

    def ids(self, text: str) -> np.ndarray:
        units = text.encode("utf-8", "surrogatepass").split()
        return np.frombuffer(b"".join(map(self.words.__getitem__, units)), "<u4")


@cache
def word_ids(path: str) -> WordIds:
    return WordIds(path)


class PrefixCounts:
    """Token count of every prefix of a text under byte-level BPE.

    The merged tokens of a prefix end in one token; without it they are the merged
    tokens of a shorter prefix. So the last token of each prefix is the one suffix
    in the vocabulary that stays apart from the last token of what precedes it,
    and count[i] = count[i - length of the last token] + 1. This runs over the
    bytes of each piece the tokenizer's pattern makes; what is kept per character
    is the step from one prefix to the next, which always fits a signed byte, as
    no token is longer than 128 bytes.
    """

    def __init__(self, path: str):
        self.tokenizer = _library(path)
        with open(path, encoding="utf-8") as file:
            model = json.load(file)
        back = {c: b for b, c in byte_letters().items()}
        self.id = {bytes(back[c] for c in t): i for t, i in model["model"]["vocab"].items()}
        #: (left id, right id) in one number, to the turn at which they merge.
        self.turn: dict[int, int] = {}
        #: id to turn, left id, right id of the merge that makes it.
        self.made: dict[int, tuple[int, int, int]] = {}
        for turn, pair in enumerate(model["model"]["merges"]):
            left, right = (bytes(back[c] for c in t) for t in (pair if isinstance(pair, list) else pair.split(" ")))
            ids = self.id[left], self.id[right]
            self.turn.setdefault(ids[0] << 32 | ids[1], turn)
            self.made.setdefault(self.id[left + right], (turn, *ids))
        self.special = [t["content"] for t in model["added_tokens"]]
        #: Ids of the tokens, and -1 for what tokens only end in.
        self.ending = {t[i:]: -1 for t in self.id for i in range(len(t))} | self.id
        self.begun: dict[bytes, tuple[list[int], list[int]]] = {}
        self.apart = WordCache(self._apart, PART_BYTES, 0)
        self.whole = WordCache(self._whole, PART_BYTES, 0)
        self.units = WordCache(self._unit, WORD_BYTES)
        self.pieces = WordCache(self._piece, PART_BYTES)
        self.split = re.compile(rf"[{_WHITE}]*[^{_WHITE}]+|[{_WHITE}]+")
        self.white = re.compile(rf"[{_WHITE}]*")
        ends = "'s|'t|'re|'ve|'m|'ll|'d"
        self.ascii = re.compile(rf"{ends}| ?[A-Za-z]+| ?[0-9]+| ?[^{_WHITE}0-9A-Za-z]+")
        self.full = regex.compile(rf"{ends}| ?\p{{L}}+| ?\p{{N}}+| ?[^{_WHITE}\p{{L}}\p{{N}}]+")
        self.ends = set(ends.split("|"))
        self.breaks = re.compile("|".join(map(re.escape, self.special)))

    def _apart(self, pair: int) -> bool:
        """Whether two tokens stay as they are side by side. Their inner merges are
        taken back, latest first; if the edges that then touch would merge before
        the merge that was taken back, the tokens would not have come about."""
        left, right = pair >> 32, pair & 0xFFFFFFFF
        limit = 1 << 40
        never = (-1, 0, 0)
        while True:
            if self.turn.get(left << 32 | right, limit) < limit:
                return False
            one, two = self.made.get(left, never), self.made.get(right, never)
            if one[0] < 0 and two[0] < 0:
                return True
            # Of merges at the same turn, the one further left comes first.
            if one[0] > two[0]:
                limit, left = one[0], one[2]
            else:
                limit, right = two[0] + 1, two[1]

    def _whole(self, token: int) -> bool:
        """Whether a token's own merges give it, rather than others."""
        made = self.made.get(token)
        if made is None:
            return True
        return self.whole[made[1]] and self.whole[made[2]] and self._joined(*made)

    def _joined(self, turn: int, left: int, right: int) -> bool:
        """Whether nothing merges across two tokens before the given turn."""
        never = (-1, 0, 0)
        while True:
            one, two = self.made.get(left, never), self.made.get(right, never)
            if one[0] < 0 and two[0] < 0:
                return True
            if one[0] > two[0]:
                limit, left = one[0], one[2]
            else:
                limit, right = two[0] + 1, two[1]
            if self.turn.get(left << 32 | right, limit) < limit:
                return False

    def _piece(self, piece: str) -> bytes:
        """Steps over the characters of a piece."""
        data = piece.encode("utf-8", "surrogatepass")
        ending, apart, size = self.ending, self.apart, len(data)
        # Pieces that begin alike share what was found for their beginnings.
        for known in _SHARED:
            if size > known and (found := self.begun.get(data[:known])):
                counts, last = found[0][:], found[1][:]
                break
        else:
            counts, last, known = [0], [0], 0
        for end in range(known + 1, size + 1):
            for start in range(end - 1, -1, -1):
                token = ending.get(data[start:end])
                if token is None:
                    break
                if token >= 0 and (apart[last[start] << 32 | token] if start else self.whole[token]):
                    counts.append(counts[start] + 1)
                    last.append(token)
                    break
            if end in _SHARED and end < size:
                if len(self.begun) >= CACHE_UNITS:
                    self.begun.clear()
                self.begun[data[:end]] = counts[:], last[:]
        if len(data) != len(piece):
            counts = [c for i, c in enumerate(counts) if i == len(data) or data[i] & 0xC0 != 0x80]
        return _steps(counts)

    def _total(self, steps: bytes) -> int:
        return int(np.frombuffer(steps, np.int8).sum(dtype=np.int64))

    def _word(self, word: str) -> bytes:
        """Steps of a word with at most one blank before it."""
        if _SETTLED.search(word):
            found = [word[a:b] for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(word)]
        else:
            found = (self.ascii if word.isascii() else self.full).findall(word)
        if len(found) == 1:
            return self.pieces[found[0]]
        out = []
        for piece in found:
            steps = self.pieces[piece]
            if piece in self.ends:
                # Until it is whole, it is a quote and letters.
                steps = _steps([0, *range(1, len(piece)), self._total(steps)])
            out.append(steps)
        return b"".join(out)

    def _unit(self, unit: str) -> bytes:
        """Steps of white space and the word after it."""
        if unit[0] == " " and "!" <= unit[1:2] <= "~":
            return self._word(unit)
        end = self.white.match(unit).end()
        if end == 0 or end == 1 and unit[0] == " " and len(unit) > 1:
            return self._word(unit)
        counts = np.cumsum(np.frombuffer(self.pieces[unit[:end]], np.int8), dtype=np.int64)
        if end < len(unit):
            # All but the last of the white space is one piece, and the last one is
            # another, which a word takes in if it is a blank.
            before = int(counts[end - 2]) if end > 1 else 0
            if unit[end - 1] == " ":
                steps = self._word(unit[end - 1 :])
                after = np.cumsum(np.frombuffer(steps, np.int8), dtype=np.int64)[1:]
            else:
                before += self._total(self.pieces[unit[end - 1]])
                after = np.cumsum(np.frombuffer(self._word(unit[end:]), np.int8), dtype=np.int64)
            counts = np.concatenate([counts, before + after])
        return _steps([0, *counts.tolist()])

    def _plain(self, text: str) -> bytes:
        return b"".join(map(self.units.__getitem__, self.split.findall(text)))

    def steps(self, text: str) -> np.ndarray:
        """Change of the token count with each character (code point)."""
        out, start = [], 0
        for special in self.breaks.finditer(text) if "<|" in text else ():
            # Until it is whole, a special token is ordinary text.
            before = text[start : special.start()]
            steps = np.frombuffer(self._plain(before + special[0]), np.int8)
            counts = np.cumsum(steps, dtype=np.int64)
            counts[-1] = self._total(self._plain(before)) + 1
            out.append(_steps([0, *counts.tolist()]))
            start = special.end()
        out.append(self._plain(text[start:]))
        return np.frombuffer(b"".join(out), np.int8)


def _steps(counts: list[int]) -> bytes:
    return bytes([(after - before) & 255 for before, after in zip(counts, counts[1:])])


@cache
def prefix_counts(path: str) -> PrefixCounts:
    return PrefixCounts(path)
