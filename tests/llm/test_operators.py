"""Operators against brute force and on odd rows."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from vidlake.llm import (
    decontam,
    hmm,
    htmltext,
    licenses,
    neardup,
    packing,
    pii,
    quality,
    token_counts,
    tokens,
    toxicity,
)

WORD_BPE = str(public_tokenizers.path("word_bpe_49k.json"))
BYTE_BPE = str(public_tokenizers.path("byte_bpe_50k.json"))
VOCABULARY = [a + b + c for a in "ba ko ti re su".split() for b in "na lo mi".split() for c in ["", "s", "ta"]]
ODD = [
    (None, "a text without id"), (900, None), (901, ""), (902, " \n\t "), (903, "same words here"), (903, "same words here"),
    (904, "w" * 70_000), (905, "é ß 日本   　 'll <|endoftext|> x"),
]


def prose(dice, n):
    return " ".join(dice.choices(VOCABULARY, k=n))


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


# Near-duplicates


def brute_classes(rows):
    sets = []
    for _, text in rows:
        words = (text or "").encode().lower().split()
        sets.append({tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set())
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    members = defaultdict(list)
    for i in range(len(rows)):
        members[find(i)].append(i)
    least = {r: min((rows[i][0] for i in m if rows[i][0] is not None), default=None) for r, m in members.items()}
    return [(rows[i][0], len(sets[i]), least[find(i)] if sets[i] else rows[i][0]) for i in range(len(rows))]


def mutated(dice, text, n):
    words = text.split()
    for _ in range(n):
        words[dice.randrange(len(words))] = "z" + str(dice.random())
    return " ".join(words)


def test_near_duplicates_match_brute_force(docs):
    dice = random.Random(4)
    rows = list(ODD)
    for i in range(12):
        base = prose(dice, dice.choice([3, 8, 40, 120, 300]))
        rows += [(100 * i + k, mutated(dice, base, dice.choice([0, 0, 1, 2, 6]) if k else 0)) for k in range(8)]
    # A chain: each is close to the one before, the ends are not.
    text = prose(dice, 150)
    for k in range(25):
        rows.append((5000 - k, text))
        text = mutated(dice, text, 2)
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in neardup.near_duplicates(docs(rows)).collect()), key=repr)
    assert got == sorted(brute_classes(rows), key=repr)


def test_near_duplicates_in_chunks(docs, monkeypatch):
    """One band of many nodes, dealt in chunks."""
    monkeypatch.setattr(neardup, "CHUNK", 4)
    dice = random.Random(5)
    rows, text = [], prose(dice, 200)
    for k in range(40):
        rows.append((k, text))
        text = mutated(dice, text, 3)
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in neardup.near_duplicates(docs(rows)).collect())
    assert got == sorted(brute_classes(rows))


def test_estimate_follows_jaccard():
    dice = np.random.default_rng(1)
    for n, share in ((30, 0.5), (3000, 0.75), (3000, 0.1)):
        common = dice.integers(0, 2**63, int(n * share), dtype=np.uint64)
        own = [dice.integers(0, 2**63, n - len(common), dtype=np.uint64) for _ in range(2)]
        a, b = (np.unique(np.concatenate([common, o])) for o in own)
        j = len(common) / (2 * n - len(common))
        found = neardup.estimate(
            neardup.registers(a)[None], neardup.registers(b)[None], np.array([len(a)]), np.array([len(b)])
        )
        assert abs(found[0] - j) < 0.2


def test_one_document_of_each_class_stays(docs):
    rows = [(3, "one two three four five six"), (1, "One two  three four five six"), (1, "One two  three four five six"),
            (7, "other"), (8, None), (9, "")]
    kept = neardup.without_copies(docs(rows))
    assert kept.columns == docs(rows).columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 7, 8, 9]


def test_own_columns_of_any_name_stay(docs):
    text = prose(random.Random(21), 60)
    frame = docs([(1, text), (2, text), (3, "other")]).selectExpr("*", f"doc_id + 1 AS {neardup.TEXT_HASH}")
    kept = neardup.without_copies(frame)
    assert kept.columns == frame.columns
    assert sorted((r.doc_id, r[neardup.TEXT_HASH]) for r in kept.collect()) == [(1, 2), (3, 4)]


def test_one_document_of_each_class_stays_without_ids(docs):
    text = prose(random.Random(6), 80)
    near = mutated(random.Random(6), text, 1)
    other = prose(random.Random(60), 80)
    rows = [(None, text), (None, text.upper()), (None, near), (None, other), (4, other), (5, text + " a"), (5, text + " b"),
            (6, "x y z"), (6, "p q r"), (None, None), (None, ""), (None, "")]
    kept = [(r.doc_id, (r.text or "").split()[:1]) for r in neardup.without_copies(docs(rows)).collect()]
    first = [text.split()[0]], [other.split()[0]]
    wanted = [(5, first[0]), (4, first[1]), (6, ["x"]), (6, ["p"]), (None, []), (None, [])]
    assert sorted(map(repr, kept)) == sorted(map(repr, wanted))
    rows = [(None, text), (None, text.upper()), (None, near)]
    assert neardup.without_copies(docs(rows)).count() == 1


# Decontamination


def bench(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def test_leaks_survive_substitutions(spark, docs):
    dice = random.Random(7)
    items = [(k, prose(dice, n)) for k, n in enumerate((40, 30, 20, 7, 3))] + [(90, None), (91, "")]
    far = ["q" + w for w in VOCABULARY]
    filler = lambda n: " ".join(dice.choices(far, k=n))
    rows = [(10 + k, f"{filler(30)} {items[k][1].upper()}, {filler(9)}") for k in range(4)]
    words = items[0][1].split()
    for place in (5, 17, 29):
        words[place] = "exchanged"
    rows += [(20, f"{filler(5)} {' '.join(words)} {filler(5)}"), (21, filler(200)), (22, " ".join(items[1][1].split()[:8]))]
    rows += [(23, f"{items[1][1]} {filler(20)} {items[2][1]}"), *ODD]
    found = decontam.leaks(docs(rows), bench(spark, items)).collect()
    assert {(r.doc_id, r.item_id) for r in found} == {(10, 0), (11, 1), (12, 2), (13, 3), (20, 0), (23, 1), (23, 2)}
    first = next(r for r in found if r.doc_id == 10)
    assert (first.first_word, first.last_word, first.n_equal) == (30, 69, 40)
    assert next(r for r in found if r.doc_id == 20).n_equal == 37
    kept = decontam.without_leaks(docs(rows), bench(spark, items))
    assert kept.columns == docs(rows).columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id and r.doc_id < 100) == [21, 22]


def test_substituted_short_items_match_brute_force(spark, docs):
    dice = random.Random(8)
    items = [(k, prose(dice, 5 + k % 20)) for k in range(40)]
    far = ["q" + w for w in VOCABULARY]
    rows = []
    for k, text in items:
        for _ in range(6):
            words = text.split()
            n = len(words)
            # Up to one more than may differ; the first and the last place, too.
            for place in dice.sample(range(n), dice.randint(0, n // 5 + 1)) if dice.random() < 0.7 else [dice.choice([0, n - 1])]:
                words[place] = "exchanged"
            around = [" ".join(dice.choices(far, k=dice.choice([0, 3, 20]))) for _ in range(2)]
            rows.append((len(rows), f"{around[0]} {' '.join(words)} {around[1]}"))
    whole, stretch = set(), set()
    for i, text in rows:
        words = text.split()
        for k, item in items:
            own = item.split()
            for shift in range(1 - len(own), len(words)):
                equal = np.array([0 <= shift + j < len(words) and words[shift + j] == w for j, w in enumerate(own)])
                if 5 * equal.sum() >= 4 * len(own):
                    whole.add((i, k))
                if decontam.best_stretch(equal)[2] >= 12:
                    stretch.add((i, k))
    found = {(r.doc_id, r.item_id) for r in decontam.leaks(docs(rows), bench(spark, items)).collect()}
    assert len(whole) > 150 and whole <= found <= whole | stretch


def test_items_without_or_with_the_same_id(spark, docs):
    dice = random.Random(14)
    one, two, three = (prose(dice, n) for n in (25, 30, 9))
    rows = [(1, f"x {one} y"), (2, two), (3, f"{three} z"), (None, one), (4, "nothing of it")]
    items = [(None, one), (7, two), (7, three), (7, two)]
    found = [(r.doc_id, r.item_id, r.n_equal) for r in decontam.leaks(docs(rows), bench(spark, items)).collect()]
    assert sorted(found, key=repr) == sorted([(1, None, 25), (None, None, 25), (2, 7, 30), (3, 7, 9)], key=repr)
    kept = decontam.without_leaks(docs(rows).selectExpr("*", f"doc_id + 1 AS {decontam.TEXT_HASH}"), bench(spark, items)).collect()
    assert [(r.doc_id, r[decontam.TEXT_HASH]) for r in kept] == [(4, 5)]


def test_items_in_blocks_and_of_all_lengths(spark, docs, monkeypatch):
    """Many passes over few seeds find what one pass finds; a long item widens no
    other item's clusters."""
    dice = random.Random(15)
    items = [(k, prose(dice, dice.choice([5, 9, 20, 60]))) for k in range(30)] + [(99, prose(dice, 3000))]
    rows = [(k, f"{prose(dice, 40)} {items[k % 31][1]} {prose(dice, 300)}") for k in range(60)]
    key = lambda r: (r.doc_id, r.item_id, r.first_word, r.last_word, r.n_equal)
    whole = sorted(map(key, decontam.leaks(docs(rows), bench(spark, items)).collect()))
    parts = sorted(map(key, decontam.leaks(docs(rows), bench(spark, items), seeds_at_once=500).collect()))
    assert whole == parts and {(k, items[k % 31][0]) for k in range(60)} <= {r[:2] for r in whole}
    saved = []
    monkeypatch.setattr(decontam, "save", lambda df, name: (saved.append(df.collect()), df.sparkSession.createDataFrame(saved[-1], df.schema))[1])
    decontam.leaks(docs([(1, f"{prose(random.Random(3), 500)} {items[0][1]}")]), bench(spark, items))
    assert max(len(r.tokens) // 8 for r in saved[1]) < 3000


def test_best_stretch_takes_the_longer_of_equals():
    assert decontam.best_stretch(np.array([1, 1, 1, 0, 1, 1, 0], bool)) == (0, 6, 5)
    assert decontam.best_stretch(np.array([1, 0, 1], bool)) == (0, 1, 1)


def test_no_items_no_leaks(spark, docs):
    assert decontam.leaks(docs(ODD), bench(spark, [])).count() == 0
    assert decontam.leaks(docs([]), bench(spark, [(1, "a b c d e f g")])).count() == 0


# Tokens


def test_ids_and_prefix_counts_are_the_librarys():
    library, other = Tokenizer.from_file(WORD_BPE), Tokenizer.from_file(BYTE_BPE)
    ids, counts = tokens.word_ids(WORD_BPE), tokens.prefix_counts(BYTE_BPE)
    dice = random.Random(3)
    letters = "abcdetho  nrs'.,\n\t1é  ß日ΣÀ́<|&%　 'srev\x1c\x00՘"
    for k in range(400):
        text = "".join(dice.choice(letters) for _ in range(dice.randint(0, 25)))
        if k % 17 == 0:
            text += "<|endoftext|>" + text[:5]
        assert ids.ids(text).tolist() == library.encode(text, add_special_tokens=False).ids
        steps = np.cumsum(counts.steps(text), dtype=np.int64)
        for end in range(1, len(text) + 1):
            assert steps[end - 1] == len(other.encode(text[:end], add_special_tokens=False).ids), repr(text[:end])


def test_token_counts(spark, docs):
    library = Tokenizer.from_file(BYTE_BPE)
    rows = [*ODD, (1, "the quick brown fox " * 300)]
    got = token_counts.counts(docs(rows), BYTE_BPE).collect()
    wanted = []
    for i, t in rows:
        n = len(library.encode(t or "", add_special_tokens=False).ids)
        wanted.append((i, len((t or "").encode()), n, n > 1024))
    assert sorted(map(tuple, got), key=repr) == sorted(wanted, key=repr)
    stored = token_counts.prefix_tokens(docs([(1, "the quick brown fox")]), BYTE_BPE)
    from pyspark.sql import functions as F

    row = stored.select(
        token_counts.tokens_in(F.col("steps"), F.lit(9)).alias("n"),
        token_counts.fitting(F.col("steps"), F.lit(2)).alias("chars"),
    ).first()
    assert (row.n, row.chars) == (2, 9)


@pytest.mark.parametrize("shares", [None, {"a": 0.5, "b": 0.5}])
def test_packing_keeps_every_token(spark, shares):
    dice = random.Random(9)
    library = Tokenizer.from_file(WORD_BPE)
    rows = [(i, prose(dice, dice.choice([0, 5, 60, 700])), dice.choice(["a", "a", "a", "b", None])) for i in range(200)]
    rows += [(900, None, "a"), (901, "", None), (None, "no id", "b"), (7, rows[7][1], rows[7][2])]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    pieces = packing.pack(frame, WORD_BPE, sequence=64, window=1024, shares=shares, with_ids=True).collect()
    held = defaultdict(list)
    for p in pieces:
        held[p.sequence_id].append(p)
        assert zlib.crc32(p.ids) == p.ids_crc32 and len(p.ids) == 4 * p.length
    for at, group in held.items():
        filled = 0
        for p in sorted(group, key=lambda p: p.offset):
            assert p.offset == filled
            filled += p.length
        assert filled == 64 or at == max(held)
    total = Counter()
    for i, t, s in rows:
        total[i] += len(library.encode(t or "", add_special_tokens=False).ids) + 1
    packed = Counter()
    for p in pieces:
        packed[p.doc_id] += p.length
    assert packed == total
    one = sorted((p for p in pieces if p.doc_id == 3), key=lambda p: p.start)
    ids = library.encode(rows[3][1], add_special_tokens=False).ids + [2]
    assert b"".join(p.ids for p in one) == np.array(ids, "<u4").tobytes()
    # Windows keep the shares, but for a segment per source.
    mix = packing.mixture(spark.createDataFrame(pieces), window=1024, sequence=64).collect()
    share = {s: sum(p.length for p in pieces if p.source == s) / sum(p.length for p in pieces) for s in ("a", "b")}
    for row in mix:
        if row.window < 4 and row.source in share:
            wanted = share[row.source] if shares is None else 0.5
            assert abs(row.share - wanted) < 0.25


def plain_round_robin(queues, quanta, least):
    """Queues of document lengths; (queue, document, start, length) in the order served.
    Credit is added round by round, and a document cut where it ends."""
    left = {q: [[d, 0, n] for d, n in docs] for q, docs in queues.items()}
    credit, spent, owed, out, turn = dict.fromkeys(queues, 0.0), dict.fromkeys(queues, 0), {}, [], 0
    for q, quantum in quanta.items():
        owed[q] = quantum * -(-least // quantum)
    while any(left.values()):
        turn += 1
        for q in sorted(queues):
            while left[q]:
                document, start, n = left[q][0]
                begin, stop, at = spent[q], n - start, None
                for k in range(int(begin / owed[q]) + 1, int((begin + stop) / owed[q]) + 2):
                    # The next end of credit within the document that leaves both parts long enough.
                    place = math.floor(k * owed[q]) - begin
                    if place + start >= least and stop - place >= least and 0 < place < stop:
                        at = place
                        break
                length = stop if at is None else at
                if begin + length > turn * quanta[q] + least - 1:
                    break
                out.append((q, document, start, length))
                spent[q] += length
                left[q][0][1] += length
                if left[q][0][1] == n:
                    left[q].pop(0)
    return out


def test_schedule_is_deficit_round_robin(spark):
    dice = random.Random(16)
    rows = [(i, prose(dice, dice.choice([0, 5, 60, 700])), dice.choice("aaaabbc") if i else "rare") for i in range(300)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string").coalesce(1)
    shares = {"a": 0.5, "b": 0.3, "c": 0.19, "rare": 0.01}
    pieces = packing.pack(frame, WORD_BPE, sequence=64, window=1024, shares=shares, least=16).collect()
    queues = defaultdict(list)
    for i, _, source in rows:
        queues[f"s{source}"].append((i, next(p.doc_tokens for p in pieces if p.doc_id == i)))
    wanted = plain_round_robin(queues, {f"s{s}": v * 1024 for s, v in shares.items()}, 16)
    at = 0
    order = {}
    for queue, document, start, length in wanted:
        order.update(((document, start + k), at + k) for k in range(length))
        at += length
    got = {(p.doc_id, p.start + k): p.sequence_id * 64 + p.offset + k for p in pieces for k in range(p.length)}
    assert got == order


def test_windows_hold_the_proportions(spark):
    """Production sizes, on all documents of the middle table."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    pieces = packing.pack(docs, WORD_BPE)
    held = packing.mixture(pieces).collect()
    last = max(r.window for r in held)
    total = Counter()
    for row in held:
        total[row.source] += row.tokens
    share = {s: n / sum(total.values()) for s, n in total.items()}
    by_window = defaultdict(dict)
    for row in held:
        by_window[row.window][row.source] = row.share
    off = [abs(by_window[w].get(s, 0) - share[s]) for w in range(last) for s in share]
    assert last > 50 and max(off) < packing.LEAST * (2 + len(share)) / packing.WINDOW
    assert max(off) < 0.01 and sum(off) / len(off) < 0.002


def test_packing_nothing(spark, docs):
    assert packing.pack(docs([]), WORD_BPE).count() == 0


# Toxicity


def test_ftrl_matches_plain_python():
    dice = random.Random(19)
    samples = [np.array(sorted(dice.sample(range(1, 40), dice.randint(0, 12))), np.int32) for _ in range(60)]
    labels = np.array([float(3 in s or dice.random() < 0.1) for s in samples])
    z, n = defaultdict(float), defaultdict(float)

    def weight(i):
        shrink = 0.0 if i == 0 else toxicity.L1
        if abs(z[i]) <= shrink:
            return 0.0
        return -(z[i] - math.copysign(shrink, z[i])) / ((toxicity.BETA + math.sqrt(n[i])) / toxicity.ALPHA + toxicity.L2)

    order = np.random.default_rng(1)
    for _ in range(40):
        for row in order.permutation(len(samples)):
            own = {i: weight(i) for i in [0, *samples[row].tolist()]}
            error = 1 / (1 + math.exp(-sum(own.values()))) - labels[row]
            for i, w in own.items():
                rate = (math.sqrt(n[i] + error * error) - math.sqrt(n[i])) / toxicity.ALPHA
                z[i] += error - rate * w
                n[i] += error * error
    wanted = {i: weight(i) for i in list(n) if weight(i)}
    found = dict(zip(*(x.tolist() for x in toxicity.ftrl(samples, labels, epochs=40))))
    assert found.keys() == wanted.keys() and 3 in found
    assert all(abs(found[i] - wanted[i]) < 1e-9 for i in wanted)


def test_toxicity_learns_and_spares(spark, docs):
    dice = random.Random(11)
    rows, marks = [], []
    for i in range(600):
        toxic = i % 4 == 0
        words = prose(dice, 30).split()
        for _ in range(3 if toxic else 0):
            words[dice.randrange(30)] = dice.choice(["idiotic,", "Scummy"])
        rows.append((i, " ".join(words)))
        marks.append((i, 1, int(toxic)))
    frame = docs([*rows, *ODD])
    labels = spark.createDataFrame([*marks, (None, 1, 1), (3, None, None), (99_999, 0, 1)], "doc_id long, quality int, toxic int")
    got = toxicity.toxicity(frame, labels).collect()
    assert len(got) == len(rows) + len(ODD)
    seen = {r.doc_id: r for r in got}
    assert all(seen[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i in range(600))
    wrong = sum(seen[i].predicted != m for i, _, m in marks if seen[i].held_out)
    assert wrong <= 3 and 0 <= seen[901].score < 0.5 and seen[901].score == seen[900].score
    kept = toxicity.without_toxic(frame, toxicity.train(frame, labels))
    assert kept.columns == frame.columns and 440 <= kept.count() <= 470
    none = labels.filter("doc_id < 0")
    assert {r.score for r in toxicity.toxicity(frame, none).collect()} == {0.0}
    assert toxicity.without_toxic(frame, toxicity.train(frame, none)).count() == len(rows) + len(ODD)


# Language model


def test_base_scores_and_exact_likelihood(docs):
    dice = random.Random(13)
    rows = [(i, prose(dice, dice.choice([0, 4, 50, 400]))) for i in range(60)] + ODD
    got = hmm.score(docs(rows)).collect()
    split = lambda t: (t or "").encode().lower().split() + [None]
    held = lambda i: zlib.crc32(b"" if i is None else str(i).encode()) % 5 == 1
    c = Counter(w for i, t in rows if not held(i) for w in split(t))
    n, v = sum(c.values()), len(c)
    wanted = Counter()
    for i, t in rows:
        base = sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in split(t))
        wanted[(i, held(i), len(split(t)), sum(c[w] > 0 for w in split(t)), n, round(base, 6))] += 1
    assert Counter((*tuple(r)[:5], round(r.base_score, 6)) for r in got) == wanted
    assert sum(r.score for r in got) > sum(r.base_score for r in got)


def test_forward_is_the_sum_over_paths():
    share = np.full(5, 0.2)
    model = hmm.Model.first(share)
    text = np.array([0, 3, 2, 4], np.uint16)
    total = 0.0
    for path in np.ndindex(*(hmm.STATES,) * 4):
        p = model.start[path[0]] * model.emit[path[0], text[0]]
        for k in range(1, 4):
            p *= model.step[path[k - 1], path[k]] * model.emit[path[k], text[k]]
        total += p
    found = hmm.log10_likelihood(model, [text[:2], text, text[:1]])
    assert abs(found[1] - math.log10(total)) < 1e-9
    counts = hmm.expected(model, [text, text[:2]])
    assert abs(counts[: hmm.STATES].sum() - 2) < 1e-9 and abs(counts[hmm.STATES * (hmm.STATES + 1) :].sum() - 6) < 1e-9


@pytest.mark.parametrize("at_once", [2, 5, 100])
def test_expected_counts_are_sums_over_paths(monkeypatch, at_once):
    """One step of training on texts longer than any piece."""
    monkeypatch.setattr(hmm, "STATES", 3)
    monkeypatch.setattr(hmm, "BATCH_TOKENS", at_once)
    share = np.array([0.4, 0.3, 0.2, 0.1])
    model = hmm.Model.first(share, seed=5)
    texts = [np.array(t, np.uint16) for t in ([0, 3, 2, 1, 1, 0, 2], [3], [2, 2, 0, 1], [1, 0])]
    start, step, emit = np.zeros(3), np.zeros((3, 3)), np.zeros((3, 4))
    for text in texts:
        weights = {}
        for path in np.ndindex(*(3,) * len(text)):
            p = model.start[path[0]] * model.emit[path[0], text[0]]
            for k in range(1, len(text)):
                p *= model.step[path[k - 1], path[k]] * model.emit[path[k], text[k]]
            weights[path] = p
        total = sum(weights.values())
        for path, p in weights.items():
            start[path[0]] += p / total
            for k, state in enumerate(path):
                emit[state, text[k]] += p / total
                if k:
                    step[path[k - 1], state] += p / total
    wanted = np.concatenate([start, step.ravel(), emit.ravel()])
    found = sum(hmm._counted(model, texts))
    assert np.abs(found - wanted).max() < 1e-9
    better = hmm.Model.of_counts(found, share)
    plain = hmm.Model.of_counts(wanted, share)
    assert np.abs(better.step - plain.step).max() < 1e-9 and np.abs(better.emit - plain.emit).max() < 1e-9


def test_long_text_does_not_underflow():
    model = hmm.Model.first(np.full(7, 1 / 7))
    found = hmm.log10_likelihood(model, [np.arange(50_000, dtype=np.uint16) % 7])
    assert np.isfinite(found[0]) and found[0] < -1000


def test_no_documents(docs):
    assert hmm.score(docs([])).count() == 0
    assert neardup.near_duplicates(docs([])).count() == 0
    assert quality.quality(docs([])).count() == 0
    assert licenses.licenses(docs([])).count() == 0
    assert pii.report(docs([])).count() == 0
    assert token_counts.counts(docs([]), BYTE_BPE).count() == 0


# Licenses


def test_expressions():
    assert licenses.postfix("MIT OR Apache-2.0 AND GPL-2.0") == ["mit", "apache-2.0", "gpl-2.0", "and", "or"]
    assert licenses.postfix("(MIT OR ISC) AND GPL-2.0 WITH x") == ["mit", "isc", "or", "gpl-2.0", "x", "with", "and"]
    assert licenses.evaluated(licenses.postfix("MIT OR GPL-3.0-only")) == ({"mit", "gpl-3"}, True)
    assert licenses.evaluated(licenses.postfix("MIT AND GPL-3.0+")) == ({"mit", "gpl-3"}, False)
    for broken in ("", "AND", "MIT OR", "(MIT", "MIT)", "()", "MIT (ISC)"):
        with pytest.raises(licenses.NotAnExpression):
            licenses.postfix(broken)


def test_unknown_ids_keep_the_known_ones():
    def tagged(expression):
        return licenses.scan(f"// SPDX-License-Identifier: {expression}\ncode")[5:]

    assert tagged("MIT OR EPL-2.0") == ({"mit", "epl-2.0"}, 1.0, True)
    assert tagged("(GPL-2.0 OR Linux-OpenIB)") == ({"gpl-2", "linux-openib"}, 1.0, False)
    assert tagged("MIT AND BSL-1.0") == ({"mit", "bsl-1.0"}, 1.0, False)
    assert tagged("LGPL-2.0-or-later WITH x OR Zlib") == ({"lgpl-2.0", "zlib"}, 1.0, False)
    assert tagged("DocumentRef-a:LicenseRef-b OR ISC") == ({"documentref-a:licenseref-b", "isc"}, 1.0, True)
    for name in ("Zlib", "0BSD", "MPL-1.1", "CC-BY-3.0"):
        assert tagged(name) == ({name.lower()}, 1.0, False)
    for broken in ("MIT OR", "NOASSERTION", "see the file", "EPL+2 OR MIT", ""):
        assert tagged(broken) == (set(), 0.3, None)


def test_license_places_match_brute_force(docs):
    dice = random.Random(17)
    bits = ["under", "the", "mit", "license", "apache", "version", "2", "cc", "by", "nc", "é", "x-"]
    rows = [(i, dice.choice([" ", ", ", "\n"]).join(dice.choices(bits, k=60))) for i in range(40)]
    rows += [(50, "licensed Under the MIT-License. cc by nc"), (51, "SPDX-License-Identifier: MIT OR GPL-2.0"), *ODD]
    got = {(r.doc_id, r.n_words): r for r in licenses.licenses(docs(rows)).collect()}
    for i, text in rows:
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        places, labels = [], set()
        for phrase, label in licenses.BASE.items():
            own = phrase.split()
            at = [k for k in range(len(words)) if words[k : k + len(own)] == own]
            places += at
            labels |= {label} if at else set()
        row = got[(i, len(words))]
        assert (row.n_base, row.first_word, row.last_word) == (len(places), min(places, default=None), max(places, default=None))
        assert row.base_labels == ",".join(sorted(labels)) and labels <= set(row.labels.split(","))
        assert 0 <= row.score <= 1
    tagged = next(r for k, r in got.items() if k[0] == 51)
    assert (tagged.labels, tagged.score, tagged.permissive) == ("gpl-2,mit", 1.0, True)


# Quality


def test_quality_base_matches_brute_force(docs):
    dice = random.Random(19)
    share = [1 / k for k in range(1, len(VOCABULARY) + 1)]
    natural = lambda n: " ".join(dice.choices(VOCABULARY, share, k=n))
    rows = [(i, natural(dice.choice([5, 49, 50, 200])).replace(" su", "\nsu")) for i in range(200)]
    rows += [(i + 400, "again and again " * 40 + prose(dice, 60)) for i in range(3)]
    rows += [(i + 500, " ".join(w.upper() + "%%%" for w in prose(dice, 120).split())) for i in range(2)]
    rows += [(300, "a b c\na b c\n \n \nd"), *ODD]
    got = {(r.doc_id, r.n_words): r for r in quality.quality(docs(rows)).collect()}
    for i, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        grams = Counter(tuple(words[k : k + 3]) for k in range(len(words) - 2))
        covered = {k + d for k in range(len(words) - 2) if grams[tuple(words[k : k + 3])] > 1 for d in range(3)}
        lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        r = got[(i, len(words))]
        wanted = sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)
        assert (r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == wanted
        assert r.base_failed == (len(words) < 50 or 100 * len(covered) > 50 * len(words))
        assert not (r.base_failed and r.kept)
    assert not any(r.kept for (i, _), r in got.items() if i and 500 <= i < 600)
    assert all(r.kept for (i, n), r in got.items() if i is not None and i < 200 and n >= 50 and not r.base_failed)


def test_quality_rejects_other_languages_and_letters(spark):
    """Texts under another language, and random letters, are far; own ones are kept."""
    dice = random.Random(20)
    letters = "abcdefghijklmnopqrstuvwxyz"
    share = [1 / k for k in range(1, 3001)]
    # The same letters in all languages, so that only words tell them apart.
    own = {lang: ["".join(dice.choices(letters, k=dice.randint(2, 8))) for _ in share] for lang in ("a", "b")}
    rows = []
    for lang, words in own.items():
        for k in range(300):
            n = dice.choice([50, 60, 100, 400, 1000])
            rows.append((len(rows), " ".join(dice.choices(words, share, k=n)), lang, "own"))
    for k in range(30):
        n = (50, 100, 400)[k % 3]
        rows.append((len(rows), " ".join(dice.choices(own["b"], share, k=n)), "a", "other"))
        text = " ".join("".join(dice.choices(letters, k=dice.randint(2, 8))) for _ in range(n))
        rows.append((len(rows), text, "b", "letters"))
    got = by_id(quality.quality(spark.createDataFrame([r[:3] for r in rows], "doc_id long, text string, lang string")))
    for i, _, _, kind in rows:
        assert not got[i].base_failed
        assert got[i].kept == (kind == "own"), (kind, got[i])


def test_frequent_words_and_blocks_of_languages(spark, monkeypatch):
    """The words that lead in their pieces are the ones that lead; languages apart give
    what they give together."""
    dice = random.Random(20)
    rows = [(i, prose(dice, dice.choice([0, 20, 90, 200])), dice.choice(["en", "de", None, ""])) for i in range(120)]
    rows += [(500, None, "fr"), (501, "word " * 80, "xx")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    wanted = set()
    for lang in {lang for _, _, lang in rows}:
        counts = Counter(w for _, t, own in rows if own == lang for w in (t or "").lower().encode().split())
        wanted |= {(lang, w, rank) for rank, (w, _) in enumerate(sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:7], 1)}
    assert {(r.lang, bytes(r.word), r.rank) for r in quality._frequent(frame, 7).collect()} == wanted
    whole, apart = (sorted(map(tuple, quality.quality(frame, languages_at_once=n).collect()), key=repr) for n in (1000, 1))
    assert whole == apart and len(whole) == len(rows)
    assert quality.quality(frame.limit(0)).count() == 0


def test_distance():
    assert quality.distance(np.array([1.0, 0]), np.array([0, 2.0])) == 1
    assert quality.distance(np.array([1.0, 3]), np.array([2.0, 6])) == 0


# Personal data


def test_pseudonyms_keep_format_and_link(docs):
    texts = [
        "mail bosbt.42@mail8.example.com and +1 (988) 555-2485, 42.144.35.254.",
        "again bosbt.42@mail8.example.com or 4041894974608795 4041 8949 7460 8795",
        "on 2024-02-29, 31.12.1999 and 12/25/2020, GB82 WEST 1234 5698 7654 32",
        "not valid: 999.1.1.1 2023-02-30 4041894974608796 GB83 WEST 1234 5698 7654 32",
        "nothing here", None, "", "y" * 100_000,
    ]
    rows = by_id(pii.report(docs(list(enumerate(texts)))))
    one, two, three = rows[0].text, rows[1].text, rows[2].text
    for value in ("bosbt.42", "988", "42.144.35.254", "4041", "2024-02-29", "31.12.1999", "12/25/2020", "WEST"):
        assert value not in one + two + three
    mail = re.search(r"\S+@mail8\.example\.com", one)[0]
    assert mail in two and re.fullmatch(r"[a-z]{5}\.\d\d@.*", mail)
    assert re.search(r"\+1 \([2-9]\d\d\) [2-9]\d\d-\d{4}, (\d{1,3}\.){3}\d{1,3}\.$", one)
    cards = re.findall(r"\d{16}|\d{4} \d{4} \d{4} \d{4}", two)
    assert len({c.replace(" ", "") for c in cards}) == 1 and luhn(cards[0])
    assert re.search(r"on \d{4}-\d\d-\d\d, \d\d\.\d\d\.\d{4} and \d\d/\d\d/\d{4}, GB\d\d [A-Z]{4} \d{4} \d{4} \d{4} \d\d", three)
    for i in (3, 4, 5, 6, 7):
        assert rows[i].text == texts[i] and rows[i].n_values == 0
    assert [rows[i].n_values for i in range(3)] == [3, 3, 4]
    other = by_id(pii.report(docs(list(enumerate(texts))), key="other"))
    assert other[0].text != one
    assert pii.pseudonymise(docs([(1, "x")])).columns == docs([(1, "x")]).columns


def test_phones_of_any_area_code_are_replaced(spark, docs):
    from pyspark.sql import functions as F

    texts = ["call +1 (017) 555-7713 or +1 (132) 055-1352", "+1 132-555-1352, +1.017.155.7713 and +10175557713", "(017) 555-7713",
             "1 (988) 555-2485 and 988-555-2485"]
    rows = by_id(pii.report(docs(list(enumerate(texts)))))
    shape = lambda t: re.sub("[01]", "0", re.sub("[2-9]", "2", t))
    for i, n in enumerate((2, 3, 1, 2)):
        assert rows[i].n_values == n and re.sub(r"\d", "0", rows[i].text) == re.sub(r"\d", "0", texts[i])
    assert shape(rows[0].text)[9] == "0" and "+1 (" in rows[0].text
    assert "0175557713" in texts[1] and not re.search("017.?.?555|132.?.?[05]55", " ".join(r.text for r in rows.values()))
    numbers = spark.range(3000).select(F.format_string("+1 (%03d) 555-01%02d", F.col("id") % 1000, F.floor(F.col("id") / 1000)).alias("v"))
    moved = numbers.select("v", pii.pseudonym(F.col("v"), "k").alias("w"))
    assert moved.select("w").distinct().count() == 3000
    assert moved.filter("v = w or (substr(v, 5, 1) < '2') != (substr(w, 5, 1) < '2')").count() == 0
    sf = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    form = r"\+1 \(\d{3}\) \d{3}-\d{4}"
    old, new = (d.select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(form), F.lit(0))).alias("v")) for d in (sf, pii.report(sf)))
    assert old.count() == new.count() > 0 and old.intersect(new).count() == 0


def test_values_beside_numbers_are_replaced(docs):
    card = "4111111111111111"
    spaced = "4111 1111 1111 1111"
    wanted = {
        f"{card} 12/25": r"(\d{16}) 12/25",
        f"{spaced} 123": r"(\d{4} \d{4} \d{4} \d{4}) 123",
        "4111-1111-1111-1111 08/27": r"(\d{4}-\d{4}-\d{4}-\d{4}) 08/27",
        f"order 12 {spaced} 12/25": r"order 12 (\d{4} \d{4} \d{4} \d{4}) 12/25",
        f"no 2024 {card}": r"no 2024 (\d{16})",
        "3782 822463 10005 1234": r"(\d{4} \d{6} \d{5}) 1234",
        f"XX12 {spaced} x": r"XX12 (\d{4} \d{4} \d{4} \d{4}) x",
        "BE68 5390 0754 7034 BIC GKCCBEBB": r"(BE\d\d \d{4} \d{4} \d{4}) BIC GKCCBEBB",
        "BE68539007547034 GKCCBEBB": r"(BE\d{14}) GKCCBEBB",
        "ES91 2100 0418 4502 0005 1332 EUR": r"(ES\d\d \d{4} \d{4} \d{4} \d{4} \d{4}) EUR",
        "+49 30 12345678 20241231": r"(\+49 \d\d \d{8}) 20241231",
    }
    rows = by_id(pii.report(docs(list(enumerate([*wanted, f"{card} 12/25/2020 {spaced} 123 {spaced} 08 BE68 5390 0754 7034 EUR"])))))
    for i, (text, shape) in enumerate(wanted.items()):
        found = re.fullmatch(shape, rows[i].text)
        assert found and found[1] not in text and rows[i].n_values == 1, (text, rows[i].text)
        if text[0] not in "+BE":
            assert luhn(re.sub("[ -]", "", found[1]))
    last = rows[len(wanted)]
    found = re.fullmatch(r"(\d{16}) (\d\d/\d\d/\d{4}) (\d{4}(?: \d{4}){3}) 123 (\d{4}(?: \d{4}){3}) 08 (BE.*) EUR", last.text)
    assert found and last.n_values == 5 and found[2] != "12/25/2020"
    assert found[1] == found[3].replace(" ", "") == found[4].replace(" ", "") == re.search(r"\d{16}", rows[0].text)[0]


def test_phones_of_any_country_are_replaced_and_linked(docs):
    texts = ["+33 1 42 68 53 00", "+353 1 234 5678", "+61 2 9374 4000", "+44 (0)20 7946 0958", "0049 30 12345678", "020 7946 0958",
             "(020) 7946 0958 or 01 42 68 53 00, 030 12345678.", "+35312345678", "+44 20 7946 0958", "+49 30 12345678", "00 353 1 234 5678",
             "id 0012345678 of 01-02-2023 and 0.2 0123 4"]
    rows = by_id(pii.report(docs(list(enumerate(texts))), key="k"))
    digits = lambda t: re.sub(r"\D", "", t)
    for i, text in enumerate(texts[:10]):
        assert re.sub(r"\d", "0", rows[i].text) == re.sub(r"\d", "0", text), text
        assert rows[i].n_values == (3 if i == 6 else 1) and digits(rows[i].text)[4:] not in digits(text), (text, rows[i].text)
    for head, i in (("+33 ", 0), ("+353 ", 1), ("+61 ", 2), ("+44 (0)", 3), ("0049 ", 4), ("0", 5)):
        assert rows[i].text.startswith(head)
    assert digits(rows[1].text) == digits(rows[7].text)
    assert digits(rows[3].text.replace("(0)", "")) == digits(rows[8].text)
    assert digits(rows[4].text)[2:] == digits(rows[9].text)
    assert digits(rows[5].text) == digits(rows[6].text)[:11]
    assert rows[11].text == texts[11].replace("01-02-2023", "01-02-2023")


def test_keys_addresses_and_either_case(docs):
    texts = ["ghp_" + "aB3" * 12, "sk_live_" + "4eC39HqLyjWD" * 2, "eyJhbGciOiJIUzI1NiJ9.eyJzdWIiOiIxMjM0NTY3ODkwIn0.dozjgNryP4J3jVmNHl0w5N",
             "the password is hunter2hunter2", "the password is required", "Bob.X@x.org and bob.x@x.org", "2001:db8:85a3::8a2e:370:7334 at 12:30:45",
             "fe80:0:0:0:202:b3ff:fe1e:8329", "a std::vector, aa:bb:cc:dd:ee:ff"]
    rows = by_id(pii.report(docs(list(enumerate(texts))), key="k"))
    for i, n in enumerate((1, 1, 1, 1, 0, 2, 1, 1, 0)):
        assert rows[i].n_values == n and len(rows[i].text) == len(texts[i]), rows[i].text
    assert [rows[i].text[:h] for i, h in ((0, 4), (1, 8), (2, 3), (3, 16))] == ["ghp_", "sk_live_", "eyJ", "the password is "]
    one, two = rows[5].text.split(" and ")
    assert one.lower() == two and one[0].isupper() and one != "Bob.X@x.org"
    assert re.fullmatch(r"([0-9a-f]{4}:[0-9a-f]{3}:[0-9a-f]{4}::[0-9a-f]{4}:[0-9a-f]{3}:[0-9a-f]{4}) at 12:30:45", rows[6].text)
    assert not {"2001", "8a2e"} & set(rows[6].text.split(":"))


def brute_feistel(value, key):
    """The network over plain Python text."""
    kinds = ((48, 57, 10), (97, 122, 26), (65, 90, 26), (192, 199, 8), (240, 241, 2), (208, 223, 16))
    middle = len(value) // 2
    halves = [value[:middle], value[middle:]]
    for turn in range(pii.ROUNDS):
        mine, other = halves[1 - turn % 2], halves[turn % 2]
        stream = "".join(
            hashlib.sha256(f"{key}|{turn}/{b}/{len(mine)}|{other}".encode()).hexdigest()
            for b in range(max(0, int((len(mine) - 1) / 16)) + 1)
        )
        moved = ""
        for k, c in enumerate(mine):
            first, n = next((first, n) for first, last, n in kinds if first <= ord(c) <= last)
            moved += chr(first + (ord(c) - first + int(stream[4 * k : 4 * k + 4], 16)) % n)
        halves[1 - turn % 2] = moved
    return "".join(halves)


def test_feistel_matches_plain_python(spark):
    from pyspark.sql import functions as F

    dice = random.Random(12)
    values = ["".join(dice.choices("0123456789abcXYZ", k=dice.randint(1, 45))) for _ in range(200)]
    frame = spark.createDataFrame([(v,) for v in values], "v string").select("v", pii.permuted(F.col("v"), "k").alias("w"))
    for row in frame.collect():
        assert row.w == brute_feistel(row.v, "k")


def test_check_digits_match_plain_python(spark):
    from pyspark.sql import functions as F

    dice = random.Random(13)
    ibans = ["".join(dice.choices("ABCXYZ", k=2)) + "".join(dice.choices("0123456789", k=2)) + "".join(dice.choices("0123456789ABZ", k=18)) for _ in range(100)]
    numbers = ["".join(dice.choices("0123456789", k=dice.randint(2, 19))) for _ in range(100)]
    frame = spark.createDataFrame(list(zip(ibans, numbers)), "i string, n string")
    for row in frame.select("i", "n", pii.mod97(F.col("i")).alias("r"), pii.luhn(F.col("n")).alias("s")).collect():
        assert row.r == int("".join(str(int(c, 36)) for c in row.i[4:] + row.i[:4])) % 97
        assert (row.s % 10 == 0) == luhn(row.n)


def test_a_session_without_a_key_has_its_own(spark, docs):
    key = pii.session_key(spark)
    assert len(key) == 64 and pii.session_key(spark) == key
    spark.conf.set(pii.KEY_SETTING, "mine")
    assert pii.session_key(spark) == "mine"
    spark.conf.unset(pii.KEY_SETTING)


def luhn(number):
    digits = [int(d) for d in number.replace(" ", "")][::-1]
    return sum(d if k % 2 == 0 else d * 2 - 9 * (d > 4) for k, d in enumerate(digits)) % 10 == 0


def test_dates_and_numbers_are_permuted(spark):
    """Different values stay different, and valid."""
    from pyspark.sql import functions as F

    days = spark.range(3000).select(F.date_add(F.lit("1990-01-01").cast("date"), F.col("id").cast("int")).cast("string").alias("v"))
    moved = days.select(pii.pseudonym(F.col("v"), "k").alias("w"))
    assert moved.filter(F.try_to_timestamp("w").isNotNull()).distinct().count() == 3000
    numbers = spark.range(1000).select(F.format_string("%03d", F.col("id")).alias("v"))
    assert numbers.select(pii.permuted(F.col("v"), "k").alias("w")).distinct().count() == 1000


def test_pii_runs_without_python(docs, plan):
    assert "Python" not in plan(pii.report(docs([(1, "a@b.example")]))) and "Arrow" not in plan(pii.report(docs([(1, "x")])))


# HTML


def page(article, k=0):
    return (
        f'<html><body><nav><ul><li><a href="/">Home {k}</a></li><li><a href="/b">News</a></li></ul></nav>'
        f'<div class="ad">Buy now {k}.</div><article>{article}</article><footer>&copy; site {k}. All.</footer></body></html>'
    )


def test_main_text(spark):
    dice = random.Random(23)
    wanted, rows = {}, []
    for k in range(60):
        blocks = [f"{prose(dice, dice.randint(5, 60))}." for _ in range(dice.randint(2, 6))]
        inner = f"<h1>{blocks[0]}</h1>" + "".join(f"<p>{b.replace(' ', chr(10), 1)} &amp; more" for b in blocks[1:])
        wanted[k] = "\n".join([blocks[0], *(f"{b} & more" for b in blocks[1:])])
        rows.append((k, f"u{k}", page(inner, k), 1))
    rows += [(100, None, None, 1), (101, "u", "", 1), (None, "u", "<p>", 1), (102, "u", "plain text, no tags", 1)]
    rows += [(103, "u", "<" * 5000 + "a" * 5000, 1), (104, "u", "<div>" * 3000 + "deep", 1)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    got = htmltext.main_text(frame).collect()
    assert len(got) == len(rows)
    seen = {r.page_id: r.text for r in got}
    assert sum(seen[k] == t for k, t in wanted.items()) >= 58
    assert seen[100] == seen[101] == "" and all(r.n_chars == len(r.text) for r in got)
    none = htmltext.main_text(frame.filter("page_id = 102"))
    assert none.count() == 1


A = "The first long paragraph of the article tells about rivers, mountains and towns, and it goes on for a while."
B = "A second paragraph, also long enough, has more to say about the weather, the harvest and the people there."
MENU = "<nav><ul><li><a href='/'>Home</a></li><li><a href='/b'>About</a></li></ul></nav>"
HEAD = "<html><head><title>t</title></head><body>"
UNUSUAL = {
    # No end of the head, no body.
    f"<html><head><title>t</title><article><h1>Head</h1><p>{A}</p><p>{B}</p></article></html>": f"Head\n{A}\n{B}",
    # A form around the page.
    f"{HEAD}<form action='x'>{MENU}<article><h1>Head</h1><p>{A}</p><p>{B}</p></article><label>Mail</label><input>"
    "<footer>&copy; site. All rights.</footer></form></body></html>": f"Head\n{A}\n{B}",
    f"{HEAD}{MENU}<article><h1>Head</h1><p>{A}</p><pre>x = compute(1, 2)\n  y = x + 1</pre><p>{B}</p></article>"
    "<footer>&copy; site.</footer></body></html>": f"Head\n{A}\nx = compute(1, 2) y = x + 1\n{B}",
    # The article's own header.
    f"{HEAD}<header><a href='/'>Site</a></header>{MENU}<article><header><h1>Head line</h1><p>By someone</p></header><p>{A}</p>"
    f"<p>{B}</p></article><footer>&copy; site.</footer></body></html>": f"Head line\nBy someone\n{A}\n{B}",
    f"{HEAD}<article><h1>Head</h1><p>{A}</p><p>{B}</p></article><form><p>Subscribe to our letter</p><input><button>Go</button>"
    "</form></body></html>": f"Head\n{A}\n{B}",
    "": "",
}


def test_unusual_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    trees = htmltext.train(pages)
    asked = spark.createDataFrame([(i, None, h) for i, h in enumerate(UNUSUAL)], "page_id long, url string, html string")
    found = {r.page_id: r.text for r in htmltext.extract(asked, trees).collect()}
    assert [found[i] for i in range(len(UNUSUAL))] == list(UNUSUAL.values())
    # Every page that marks its article gives just that.
    inside = {r.page_id: "\n".join(text for at, text, _ in page.runs if own[at]) for r in pages.collect()
              for page, own in [htmltext._labelled(r.html)]}
    assert {r.page_id: r.text for r in htmltext.extract(pages, trees).collect()} == inside
    nothing = pages.limit(0)
    assert htmltext.main_text(nothing).count() == 0


def test_chosen_nodes_are_the_best_set():
    """Against all sets of nodes that hold their parents and the root."""
    dice = random.Random(17)
    for _ in range(60):
        page = htmltext.Page()
        n = dice.randint(1, 10)
        page.parents = [-1] + [dice.randrange(k) for k in range(1, n)]
        # In document order, as parsed.
        order = []
        stack = [0]
        while stack:
            at = stack.pop()
            order.append(at)
            stack += [c for c in range(n - 1, 0, -1) if page.parents[c] == at]
        new = {old: k for k, old in enumerate(order)}
        page.parents = [-1 if page.parents[old] < 0 else new[page.parents[old]] for old in order]
        page.ends = [0] * n
        for at in range(n - 1, -1, -1):
            page.ends[at] = max([at + 1] + [page.ends[c] for c in range(at + 1, n) if page.parents[c] == at])
        page.tags = [f"t{k}" for k in range(n)]  # no siblings of one tag
        odds = np.array([dice.uniform(-2, 2) for _ in range(n)])
        gain = odds.copy()
        gain[0] = max(gain[0], 0)
        best = max(
            (
                sum(gain[k] for k in range(n) if kept >> k & 1)
                for kept in range(1, 1 << n)
                if kept & 1 and all(not kept >> k & 1 or kept >> page.parents[k] & 1 for k in range(1, n))
            )
        )
        keep = htmltext.chosen(page, odds)
        assert all(not keep[k] or keep[page.parents[k]] for k in range(1, n))
        assert abs(gain[keep].sum() - max(best, 0)) < 1e-9


def test_one_tree_is_the_best_split():
    """The first split of a tree against all splits of all columns."""
    dice = np.random.default_rng(18)
    rows = dice.integers(0, 6, (200, 4)).astype(np.float32)
    labels = ((rows[:, 2] > 3) ^ (dice.random(200) < 0.1)).astype(float)
    trees = htmltext.boost(rows, labels)
    g, h = labels - labels.mean(), np.full(200, labels.mean() * (1 - labels.mean()))
    score = lambda at: g[at].sum() ** 2 / (h[at].sum() + 1)
    gains = {(c, v): score(rows[:, c] <= v) + score(rows[:, c] > v) for c in range(4) for v in range(5)}
    column, value = max(gains, key=gains.get)
    assert trees.feature[0, 0] == column and trees.edges[column][trees.bin[0, 0]] == value + 0.5
    assert ((trees.score(rows) > 0) == (labels > 0)).mean() > 0.85


def test_markup_is_read_as_far_as_it_goes():
    found = htmltext.parse(
        "<title>T</title><p>a  b\n c<br>d<p><b>e<p>f</div><script>x<p>y</script><!-- z --><ul><li>g<li>h</ul>i &lt;j&gt; 1 < 2"
    )
    assert [text for _, text, _ in found.runs] == ["a b c d", "e", "f", "g", "h", "i <j> 1 < 2"]


def test_decoding_is_consistent():
    source = page("<h1>x</h1><p>y</p><div class='c'><p>z</p></div>")
    found = htmltext.parse(source)
    dice = np.random.default_rng(2)
    for _ in range(50):
        keep = htmltext.chosen(found, dice.normal(size=len(found.tags)))
        assert all(keep[found.parents[k]] for k in range(1, len(keep)) if keep[k])
