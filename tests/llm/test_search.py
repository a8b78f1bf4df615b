"""Ranked search, top-k search and alignment against brute force and on odd rows."""

from __future__ import annotations

import hashlib
import itertools
import math
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from vidlake.llm import align, knn, treap
from vidlake.llm.tokens import byte_letters

BYTE_BPE = str(public_tokenizers.path("byte_bpe_50k.json"))
PIECE_BPE = str(public_tokenizers.path("piece_bpe_32k.model"))
WORDS = [a + b for a in "ba ko ti re su".split() for b in "na lo mi pe".split()]


def prose(dice, n):
    return " ".join(dice.choices(WORDS, [1 / k for k in range(1, len(WORDS) + 1)], k=n))


# Ranked search


def terms_of(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lowered)


def brute_search(docs, items, k):
    counts = [(i, terms_of(t)) for i, t in docs]
    n_docs = sum(1 for _, t in counts if t)
    total = sum(len(t) for _, t in counts)
    df = Counter(term for _, t in counts for term in set(t))
    out = Counter()
    for item, text in set(items):
        asked = Counter(terms_of(text))
        scored = []
        for doc, found in counts:
            tf = Counter(found)
            score = 0
            for term, times in asked.items():
                if tf[term]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[term] + 1)))
                    m = 100 - 25 + 25 * len(found) * n_docs // total
                    score += times * w * (1_000_000_000 * tf[term] // (1000 * tf[term] + 12 * m))
            if score > 0:
                scored.append((-score, doc is None, doc or 0))
        for rank, (score, none, doc) in enumerate(sorted(scored)[:k], 1):
            out[item, rank, None if none else doc, -score] += 1
    return out



@pytest.mark.parametrize("spread", [1, 7])
def test_ranked_search_matches_brute_force(spark, docs, monkeypatch, spread):
    monkeypatch.setattr(treap, "OPEN_FIRST", 2)
    dice = random.Random(spread)
    rows = [(i, prose(dice, dice.choice([1, 5, 30, 200]))) for i in range(300)]
    # Many copies, equal scores, odd rows.
    rows += [(1000 + i, rows[5][1]) for i in range(60)] + [(None, rows[5][1]), (7, rows[7][1]), (7, rows[7][1])]
    rows += [(2000, None), (2001, ""), (2002, " .,\n"), (2003, "É日本 Bana,KOLO été"), (2004, "bana " * 60_000)]
    items = [(prose(dice, dice.choice([1, 3, 12])), i) for i in range(25)]
    items += [(rows[5][1], 50), (rows[5][1], 50), ("Kolo", 50), ("kolo été É", None), (None, 60), ("", 61), ("unheard of", 62)]
    frame = spark.createDataFrame([(t, i, 0.5) for t, i in items], "text string, item_id long, score double")
    found = treap.search(docs(rows).repartition(spread), frame)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    got = Counter(tuple(r) for r in found.collect())
    assert got == brute_search(rows, [(i, t) for t, i in items], 20)


def test_items_in_blocks_rank_alike(spark, docs):
    dice = random.Random(2)
    rows = [(i, prose(dice, 40)) for i in range(100)]
    frame = spark.createDataFrame([(prose(dice, 6), i) for i in range(20)], "text string, item_id long")
    whole = sorted(map(tuple, treap.search(docs(rows), frame).collect()))
    assert whole == sorted(map(tuple, treap.search(docs(rows), frame, item_bytes=100).collect())) and len(whole) == 400


def test_search_of_nothing(spark, docs):
    none = spark.createDataFrame([], "text string, item_id long")
    one = spark.createDataFrame([("bana", 1)], "text string, item_id long")
    assert treap.search(docs([(1, "bana")]), none).count() == 0
    assert treap.search(docs([]), one).count() == 0
    assert treap.search(docs([(1, None), (2, " ")]), one).count() == 0


def test_long_texts_are_read_in_pieces(monkeypatch):
    text = "Bana, KOLO;été 日本 " * 50 + "x" * 300 + " bana"
    whole = [t for part in treap.terms(text) for t in part]
    monkeypatch.setattr(treap, "PIECE_BYTES", 64)
    parts = list(treap.terms(text))
    assert len(parts) > 5 and [t for part in parts for t in part] == whole == [t.encode() for t in terms_of(text)]


def test_tree_holds_maxima_and_cells():
    dice = np.random.default_rng(3)
    for side in (1, 2, 37, 300):
        cells = {(int(r), int(c)): int(v) for r, c, v in zip(*(dice.integers(0, side, 400) for _ in range(2)), dice.integers(1, 10**10, 400))}
        rows, columns = (np.array(x, np.int64) for x in zip(*cells))
        tree = treap.K2Treap(rows, columns, np.array(list(cells.values())))
        assert tree.most[-1][0] == max(cells.values())
        asked = np.unique(dice.integers(0, side, 5))
        times = dice.integers(1, 4, len(asked))
        score = Counter()
        for (r, c), v in cells.items():
            for a, t in zip(asked, times):
                if a == r:
                    score[c] += int(t) * v
        wanted = sorted(((s, c) for c, s in score.items()), key=lambda x: (-x[0], x[1]))
        assert tree.search(asked, times, 6, 1) == wanted[:6]
        floor = wanted[2][0] if len(wanted) > 2 else 1
        assert tree.search(asked, times, 6, floor) == [x for x in wanted[:6] if x[0] >= floor]


# Top-k search


def brute_nearest(rows, every, k):
    vectors = []
    for vec_id, x in rows:
        if vec_id is None or x is None or any(v is None or not math.isfinite(v) for v in x):
            continue
        vectors.append((vec_id, [math.floor(256 * v) for v in x]))
    best = {}
    for q, x in vectors:
        if q % every == 0:
            for i, y in vectors:
                if i != q:
                    score = sum(a * b for a, b in zip(x, y))
                    best.setdefault(q, {})
                    best[q][i] = max(best[q].get(i, score), score)
    return {
        (q, rank, i, s)
        for q, found in best.items()
        for rank, (i, s) in enumerate(sorted(found.items(), key=lambda x: (-x[1], x[0]))[:k], 1)
    }


def embeddings(spark, rows, kind="float"):
    full = [(1, [9.0], i, x) for i, x in rows]
    return spark.createDataFrame(full, f"vec long, ids array<double>, vec_id long, embedding array<{kind}>")


@pytest.mark.parametrize("kind", ["float", "double"])
def test_nearest_matches_brute_force(spark, monkeypatch, kind):
    monkeypatch.setattr(knn, "ANNULUS_ROWS", 16)
    monkeypatch.setattr(knn, "ROUNDS", (1, 2, None))
    dice = np.random.default_rng(4)
    centres = dice.normal(size=(6, 8))
    rows = [(i, (centres[i % 6] + 0.3 * dice.normal(size=8)).astype(np.float32).tolist()) for i in range(600)]
    # One vector many times, lengths of all sizes, repeated rows and ids.
    rows += [(1000 + i, rows[3][1]) for i in range(150)] + [(700 + i, [float(np.float32(x * 10 ** (i % 5))) for x in rows[i][1]]) for i in range(50)]
    rows += [rows[10], rows[10], (20, rows[30][1]), (1500, [0.0] * 8), (1501, [1.0, 2.0]), (1550, []), (1551, [0.5] * 11)]
    rows += [(None, [1.0] * 8), (1600, None), (1601, [None] + [1.0] * 7), (1602, [float("nan")] * 8), (1650, [float("inf")] * 8)]
    found = knn.nearest(embeddings(spark, rows, kind), pivots=9)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    assert {tuple(r) for r in found.collect()} == brute_nearest(rows, 50, 5)


def test_large_components_are_exact(spark):
    dice = random.Random(5)
    rows = [(i, [dice.uniform(-9e5, 9e5) for _ in range(6)]) for i in range(120)]
    assert {tuple(r) for r in knn.nearest(embeddings(spark, rows, "double")).collect()} == brute_nearest(rows, 50, 5)


def test_few_or_no_vectors(spark):
    assert knn.nearest(embeddings(spark, [])).count() == 0
    assert knn.nearest(embeddings(spark, [(0, None), (None, [1.0])])).count() == 0
    assert knn.nearest(embeddings(spark, [(0, [1.0])])).count() == 0
    assert [tuple(r) for r in knn.nearest(embeddings(spark, [(0, [1.0]), (1, [-2.0])])).collect()] == [(0, 1, 1, -(256 * 512))]
    assert knn.nearest(embeddings(spark, [(1, [1.0]), (2, [1.0])])).count() == 0


def test_pruning_skips_annuli(spark, monkeypatch):
    """In well separated groups a query is asked of few annuli."""
    monkeypatch.setattr(knn, "ANNULUS_ROWS", 32)
    dice = np.random.default_rng(6)
    centres = np.eye(16) * 3
    rows = [(i, (centres[i % 16] + 0.01 * dice.normal(size=16)).tolist()) for i in range(3200)]
    asked = []
    ask = knn._ask
    monkeypatch.setattr(knn, "_ask", lambda *a: asked.append(ask(*a)) or asked[-1])
    index = []
    annuli = knn._annuli
    monkeypatch.setattr(knn, "_annuli", lambda *a: index.append(annuli(*a)) or index[-1])
    assert {tuple(r) for r in knn.nearest(embeddings(spark, rows, "double"), pivots=16).collect()} == brute_nearest(rows, 50, 5)
    visits = sum(r.asked for a in asked for r in a.select("asked").collect())
    assert visits < 0.4 * 64 * index[0].count()


# Alignment


def brute_alignment(texts):
    a_tool, b_tool = Tokenizer.from_file(BYTE_BPE), sentencepiece.SentencePieceProcessor(model_file=PIECE_BPE)
    a_tool.encode_special_tokens = True
    back = {c: b for b, c in byte_letters().items()}
    found, counts = [], Counter()
    for text in texts:
        found.append(None)
        if not text:
            continue
        a_ids, b_ids = a_tool.encode(" " + text, add_special_tokens=False).ids, b_tool.encode(text)
        a = [bytes(back[c] for c in a_tool.id_to_token(i)) for i in a_ids]
        pieces = [b_tool.id_to_piece(i) for i in b_ids]
        b = [bytes([int(p[3:5], 16)]) if b_tool.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(b_ids, pieces)]
        if not b"".join(a) == b"".join(b) == (" " + text).encode():
            continue
        ends = [list(itertools.accumulate(map(len, x))) for x in (a, b)]
        pairs = [
            (i, j) for i, i_end, x in zip(a_ids, ends[0], a) for j, j_end, y in zip(b_ids, ends[1], b)
            if i_end - len(x) < j_end and j_end - len(y) < i_end
        ]
        groups, start = [], 0
        for cut in sorted(set(ends[0]) & set(ends[1])):
            own = [[i for i, e in zip(ids, end) if start < e <= cut] for ids, end in zip((a_ids, b_ids), ends)]
            groups.append("|".join(",".join(map(str, x)) for x in own))
            start = cut
        counts.update(pairs)
        found[-1] = len(a), len(b), len(groups), pairs, hashlib.sha256(";".join(groups).encode()).hexdigest()
    highest = {}
    for (_, j), n in counts.items():
        highest[j] = max(n, highest.get(j, 0))
    out = []
    for x in found:
        if x is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, n_groups, pairs, digest = x
        best = sum(counts[p] == highest[p[1]] for p in pairs)
        out.append((n_a, n_b, n_groups, len(pairs), best, sum(counts[p] for p in pairs), digest))
    return out


PARTS = ["a", " ", "  ", "\n", "\n\n", "\t", "foo", "Bär", "é", "日本", "𝔘", ".", ",", "'s", "'ll", "<|endoftext|>", "<s>", "<0x0A>",
         "123", "٣", "²", ".)", "　", "\x85", "\xa0", "é", "\x1c", "\r\n", "!", "x.", "ﬁ", "İ", "ß", "​", "﻿", "\x00",
         "(", "a\n", "\n.", "of the", " then"]


@pytest.mark.parametrize("shared_pairs", [1_000_000, 64, 0])
def test_alignment_matches_brute_force(docs, shared_pairs):
    dice = random.Random(7)
    texts = [None, "", " ", "\n", "  a", "a  ", "a \n", "a.\n\nb", "a▁b", "▁", "word " * 3000, "日本語" * 400, "x" * 5000]
    texts += ["".join(dice.choice(PARTS) for _ in range(dice.randrange(1, 30))) for _ in range(150)] + ["of the"] * 40
    rows = [(dice.choice([None, i, 5]), t) for i, t in enumerate(texts)]
    got = align.align(docs(rows).repartition(3), BYTE_BPE, PIECE_BPE, shared_pairs)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    wanted = Counter((i, *x) for (i, _), x in zip(rows, brute_alignment(texts)))
    assert Counter(tuple(r) for r in got.collect()) == wanted


def test_texts_in_pieces_align_alike(monkeypatch):
    dice = random.Random(8)
    texts = ["".join(dice.choice(PARTS) for _ in range(dice.randrange(1, 200))) for _ in range(200)]
    wanted = [(*x[:4], x[6]) for x in brute_alignment(texts)]
    for size, learnt in ((1, 3), (40, 1), (1 << 20, 20_000)):
        monkeypatch.setattr(align, "TEXT_AT_ONCE", size)
        monkeypatch.setattr(align, "LEARNT_AT_ONCE", learnt)
        found = align.Aligner(BYTE_BPE, PIECE_BPE).align(texts)
        assert [x.row() for x in found] == wanted
        assert all(int(x.counted()[1].sum()) == x.row()[3] for x in found)


def test_alignment_of_nothing(docs):
    assert align.align(docs([]), BYTE_BPE, PIECE_BPE).count() == 0
    assert [tuple(r) for r in align.align(docs([(1, None)]), BYTE_BPE, PIECE_BPE).collect()] == [(1, 0, 0, 0, 0, 0, 0, "")]
