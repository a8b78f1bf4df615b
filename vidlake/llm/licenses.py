"""License scans: tags and notices by Aho-Corasick, expressions by shunting-yard.

One automaton over the words of a text finds notice phrases (words are runs of
letters, digits and non-ASCII characters, A-Z lower-cased, so punctuation between
them does not matter) and the words of identifier tags. Behind a tag such as
`SPDX-License-Identifier:` stands an expression of license ids joined by `AND`, `OR`
and `WITH`, with brackets; a shunting-yard parser turns it into postfix order, which
is evaluated: `OR` needs one side to be acceptable, `AND` both, and `WITH` adds an
exception to the license before it. Any id is a license: those of IDS get the labels
that phrases use, others their own name in small letters, and count as not permissive.

A text's labels are those of its phrases and the ids of its valid expressions, and
its score says how sure the scan is: a tag with a valid expression 1, the base
phrases 0.9, other notices 0.8, names of licenses only 0.5, tags whose expression
does not parse 0.3, nothing 0.

Cases: null and empty texts have no word and no label. Rows that repeat each get a
row, null ids too. Overlapping phrases all count. Other columns are not looked at.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from vidlake.llm.common import slices, text_of

# The phrases and labels that are counted.
BASE = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
# Notices that name a license in other words, and how sure they are.
NOTICES = {
    "permission is hereby granted free of charge to any person obtaining a copy": ("mit", 0.8),
    "licensed under the apache license": ("apache-2", 0.8),
    "gnu general public license version 2": ("gpl-2", 0.8),
    "gnu general public license version 3": ("gpl-3", 0.8),
    "gnu general public license": ("gpl", 0.8),
    "gnu lesser general public license": ("lgpl", 0.8),
    "gnu affero general public license": ("agpl", 0.8),
    "mozilla public license": ("mpl", 0.8),
    "redistribution and use in source and binary forms": ("bsd", 0.8),
    "creative commons attribution": ("cc-by", 0.8),
    "cc by sa": ("cc-by-sa", 0.8),
    "cc by nd": ("cc-by-nd", 0.8),
    "cc0 1 0": ("cc0", 0.8),
    "released into the public domain": ("public-domain", 0.8),
    "all rights reserved": ("all-rights-reserved", 0.8),
    "mit license": ("mit", 0.5),
    "apache license": ("apache-2", 0.5),
    "bsd license": ("bsd", 0.5),
    "isc license": ("isc", 0.5),
}
# The words of tags an expression stands behind.
TAGS = ("spdx license identifier", "license expression")
# Ids without their version and its suffix, to the labels that phrases use.
IDS = {
    "mit": "mit",
    "apache-2.0": "apache-2",
    "gpl-2.0": "gpl-2",
    "gpl-3.0": "gpl-3",
    "lgpl-2.1": "lgpl",
    "lgpl-3.0": "lgpl",
    "agpl-3.0": "agpl",
    "mpl-2.0": "mpl",
    "bsd-2-clause": "bsd",
    "bsd-3-clause": "bsd",
    "isc": "isc",
    "cc0-1.0": "cc0",
    "unlicense": "public-domain",
    "cc-by-4.0": "cc-by",
    "cc-by-sa-4.0": "cc-by-sa",
    "cc-by-nc-4.0": "cc-by-nc",
    "cc-by-nd-4.0": "cc-by-nd",
}
# What may be trained on without further terms; others need a look.
PERMISSIVE = frozenset({"mit", "apache-2", "bsd", "isc", "cc0", "public-domain", "cc-by", "mpl"})
BASE_SCORE, TAG_SCORE, BROKEN_SCORE = 0.9, 1.0, 0.3

# Separators become blanks, A-Z small letters.
_FOLD = bytes(c if c > 127 or 48 <= c <= 57 or 97 <= c <= 122 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))
_TOKEN = re.compile(r"\(|\)|(?:DocumentRef-[A-Za-z0-9.-]+:)?[A-Za-z0-9][A-Za-z0-9.+-]*")
_ID = re.compile(r"(?:documentref-[a-z0-9.-]+:)?[a-z0-9](?:[a-z0-9.-]*[a-z0-9])?")
# Values that say that no license is named.
_NO_LICENSE = frozenset({"none", "noassertion"})
_STRENGTH = {"or": 1, "and": 2, "with": 3}
_TAG = re.compile(r"(?:spdx-license-identifier|license-expression)\s*:[ \t]*([^\n\r*<>\"']*)", re.IGNORECASE)


class NotAnExpression(ValueError):
    """Text behind a tag that is no license expression."""


def postfix(text: str) -> list[str]:
    """An expression's ids and operators in postfix order (shunting-yard). Words after
    a complete expression end it; a mere word before other words is no id, unless known."""
    out: list[str] = []
    held: list[str] = []
    operand_next = True
    for token in _TOKEN.findall(text):
        low = token.lower()
        if operand_next:
            if low in _STRENGTH or token == ")":
                raise NotAnExpression(text)
            if token == "(":
                held.append(token)
            else:
                out.append(low)
                operand_next = False
        elif low in _STRENGTH:
            while held and held[-1] != "(" and _STRENGTH[held[-1]] >= _STRENGTH[low]:
                out.append(held.pop())
            held.append(low)
            operand_next = True
        elif token == ")":
            while held and held[-1] != "(":
                out.append(held.pop())
            if not held:
                raise NotAnExpression(text)
            held.pop()
        elif "(" in held or token == "(":
            raise NotAnExpression(text)
        elif len(out) == 1 and out[0].isalpha() and out[0] not in IDS:
            raise NotAnExpression(text)
        else:
            break
    if operand_next or "(" in held:
        raise NotAnExpression(text)
    return out + held[::-1]


def _license(name: str) -> str:
    """Label of an id: the one that phrases use, or its own name without a suffix."""
    plain = re.sub(r"(-only|-or-later|\+)$", "", name.rstrip("."))
    if plain in _NO_LICENSE or not _ID.fullmatch(plain):
        raise NotAnExpression(name)
    return IDS.get(plain, plain)


def evaluated(order: list[str]) -> tuple[set[str], bool]:
    """Labels of an expression in postfix order, and whether it allows use under
    permissive terms."""
    stack: list[tuple[set[str], bool] | str] = []
    for token in order:
        if token not in _STRENGTH:
            stack.append(token)
            continue
        right, left = stack.pop(), stack.pop()
        if token == "with":
            # An exception only adds permissions.
            if not isinstance(right, str):
                raise NotAnExpression(token)
            stack.append(_value(left))
            continue
        (labels_l, free_l), (labels_r, free_r) = _value(left), _value(right)
        stack.append((labels_l | labels_r, free_l or free_r if token == "or" else free_l and free_r))
    return _value(stack[0])


def _value(item) -> tuple[set[str], bool]:
    if not isinstance(item, str):
        return item
    label = _license(item)
    return {label}, label in PERMISSIVE


@cache
def _automaton() -> ahocorasick.Automaton:
    """Phrases with a blank on either side, so that whole words match."""
    found = ahocorasick.Automaton()
    rows: dict[str, list] = {}
    for phrase, label in BASE.items():
        rows.setdefault(phrase, []).append(("base", label, BASE_SCORE))
    for phrase, (label, score) in NOTICES.items():
        rows.setdefault(phrase, []).append(("notice", label, score))
    for phrase in TAGS:
        rows.setdefault(phrase, []).append(("tag", "", BROKEN_SCORE))
    for phrase, kinds in rows.items():
        found.add_word(f" {phrase} ", (len(phrase) + 2, kinds))
    found.make_automaton()
    return found


def scan(text: str) -> tuple[int, int, int | None, int | None, set[str], set[str], float, bool | None]:
    """n_words, n_base, first and last word, base labels, labels, score, and whether the
    tags allow permissive use (None without a tag that parses)."""
    words = text.encode("utf-8", "surrogatepass").translate(_FOLD).split()
    line = f" {b' '.join(words).decode('utf-8', 'surrogatepass')} "
    places, base, labels, score, tagged, free = [], set(), set(), 0.0, False, None
    for end, (length, kinds) in _automaton().iter(line):
        start = end + 1 - length
        for kind, label, sure in kinds:
            if kind == "base":
                places.append(start)
                base.add(label)
            if kind == "tag":
                tagged = True
            else:
                labels.add(label)
            score = max(score, sure)
    if tagged:
        for match in _TAG.finditer(text):
            try:
                found, allowed = evaluated(postfix(match[1]))
            except NotAnExpression:
                continue
            labels |= found
            score = TAG_SCORE
            free = allowed if free is None else free and allowed
    first = last = None
    if places:
        first, last = (line.count(" ", 0, place) for place in (min(places), max(places)))
    return len(words), len(places), first, last, base, labels, score, free


def licenses(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score,
    permissive of every row."""
    names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "permissive"]
    types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.bool_()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = [scan(text_of(t)) for t in batch.column("text").to_pylist()]
            columns = [list(c) for c in zip(*rows)]
            for at in (4, 5):
                columns[at] = [",".join(sorted(found)) for found in columns[at]]
            arrays = [pa.array(c, t) for c, t in zip(columns, types)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *arrays], ["doc_id", *names])

    return docs.select("doc_id", "text").mapInArrow(
        run,
        "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
        "score double, permissive boolean",
    )
