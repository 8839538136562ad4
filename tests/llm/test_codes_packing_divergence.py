"""Vector codes, packing and source divergence against brute force, on small rows with every odd case."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest

from gridtally.llm import divergence, packing, vector_codes

DOCS = "doc_id long, text string, lang string, source string, n string, docs string, term string, length int, part int"


def document(i, text, lang="en", source="s"):
    return (i, text, lang, source, "clash", "clash", "clash", 7, 3)


# --- vector codes -------------------------------------------------------------------


def brute_codes(vectors: list[tuple], entries: int, rounds: int) -> tuple[list, list]:
    """Codes and errors by full scans with Python numbers, for rows in order of their keys."""
    whole = [[math.floor(Fraction(x) * 1024) for x in v] for _, v in vectors]
    width = len(whole[0]) // 4
    parts = [[w[p * width : (p + 1) * width] for w in whole] for p in range(4)]
    codes, errors, books = [], [0] * len(whole), []
    for part in parts:
        book = [list(x) for x in part[:entries]]
        for turn in range(rounds + 1):
            found = [min((sum((a - b) ** 2 for a, b in zip(x, e)), n) for n, e in enumerate(book)) for x in part]
            if turn < rounds:
                for n in range(len(book)):
                    mine = [x for x, (_, m) in zip(part, found) if m == n]
                    if mine:
                        book[n] = [sum(c) // len(mine) for c in zip(*mine)]
        codes.append([n for _, n in found])
        errors = [e + d for e, (d, _) in zip(errors, found)]
        books += book
    return list(zip(*codes)), errors, books


def decoded(rows):
    return {r.vec_id: (None if r.codes is None else tuple(np.frombuffer(r.codes, "<i4").tolist()), r.error) for r in rows}


@pytest.mark.parametrize("size", [1.0, 1e5, 1e7])
def test_codes_by_brute_force(spark, size):
    chooser = np.random.default_rng(3)
    # Few different values, so that ties and moves of single entries are common.
    vectors = [(i, (np.round(chooser.normal(size=8), 1) * size).tolist()) for i in range(120)]
    odd = [(200, None), (201, [math.nan] + [0.0] * 7), (202, [1.0, None] + [0.0] * 6), (203, [math.inf] + [0.0] * 7)]
    frame = spark.createDataFrame(vectors + odd, "vec_id long, embedding array<double>").repartition(5)
    want_codes, want_errors, want_books = brute_codes(vectors, 16, 4)
    coded = vector_codes.compress(frame, entries=16)
    assert decoded(coded.rows.collect()) == {
        i: (c, min(e, 2**63 - 1)) for (i, _), c, e in zip(vectors, want_codes, want_errors)
    }
    assert coded.books[8].reshape(-1, 2).tolist() == want_books


def test_only_moved_entries_are_compared():
    chooser = np.random.default_rng(5)
    entries = chooser.integers(-5, 6, (32, 4))
    x = chooser.integers(-6, 7, (400, 4))
    entry, distance = vector_codes.assign(x, entries, None, None, np.ones(32, bool))
    moved = np.zeros(32, bool)
    moved[[0, 7, 8, 31]] = True
    later = entries + moved[:, None] * chooser.integers(-2, 3, (32, 4))
    want = vector_codes.squares(x, later)
    now, far = vector_codes.assign(x, later, entry, distance, moved)
    assert (now == want.argmin(axis=1)).all() and (far == want.min(axis=1)).all()
    # With nothing moved no distance is computed anew: stored ones are kept as they are.
    assert (vector_codes.assign(x, later, entry, distance + 7, np.zeros(32, bool))[1] == distance + 7).all()


def test_codes_of_odd_vectors(spark):
    rows = [
        (1, [0.5] * 8, 1), (1, [0.25] * 8, None), (2, [0.5] * 8, None), (None, [1.0] * 8, 1), (3, [0.1] * 6, 2), (4, [], 2),
        (5, [1.0, 2.0, 3.0, 4.0], 3), (6, [1e300] * 8, 3), (7, [4e15] * 8, 4), (8, [-4e15] * 8, 4), (9, [-0.0001] * 8, 5),
    ]
    schema = "vec_id long, embedding array<double>, label int"
    got = vector_codes.op12_vector_codes(spark.createDataFrame(rows, schema)).collect()
    assert len(got) == len(rows)
    codes = sorted((r.vec_id or 0, r.code or "", r.error) for r in got)
    # Entries follow the keys, then the parts' bytes: 0.25 comes before 0.5, and the null key last.
    assert codes[:3] == [(0, "06060606", 0), (1, "00000000", 0), (1, "01010101", 0)]
    assert [r.code for r in got if r.vec_id in (3, 4, 6)] == [None] * 3
    assert {r.label_error for r in got} == {0, None}  # label 2 has no vector that can be coded
    assert vector_codes.op12_vector_codes(spark.createDataFrame([], schema)).count() == 0


def test_totals_of_many_keys(spark):
    rows = [(k if k < 40 else None, v) for k in range(41) for v in range(k % 7 + 1)]
    want = defaultdict(int)
    for k, v in rows:
        want[k] += v
    frame = spark.createDataFrame(rows, "label int, error long")
    got = vector_codes._with_totals(frame, "label", "error", "all", heavy_keys=5).collect()
    assert len(got) == len(rows) and all(r["all"] == want[r.label] for r in got)


# --- packing ------------------------------------------------------------------------


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(packing.vocabulary_path())


ODD_TEXTS = [
    None, "", " ", "\n\t \r\n", "One  two\tthree\r\nfour", "don't 'S they'll", "café café ́x  nbsp em\u0085nel",
    "\x1c\x1d\x1e\x1f \x0b\x0c \x00 z", "你好世界 " * 40, "\U0001f600‍\U0001f9d1 ẹ́", "ΌΣΟΣ ΣΑΣ Σ", "İstanbul ǅ ﬁ",
    "<|endoftext|> a<|startoftext|>b < |x|>", "12345 6.7-8", "각 ཱི", "a b c﻿d​e", "x" * 3000,
]


def test_ids_are_those_of_the_whole_text(tokenizer):
    encode = packing.Encoder(open(packing.vocabulary_path(), encoding="utf-8").read())
    for text in ODD_TEXTS[1:]:
        want = tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encode(text), "<u4").tolist() == want, repr(text)


def test_portions_join_to_the_text(monkeypatch, tokenizer):
    monkeypatch.setattr(packing, "SLICE", 50)
    text = " ".join(f"word{i % 9} isn't\n" for i in range(100)) + "y" * 200
    encode = packing.Encoder(open(packing.vocabulary_path(), encoding="utf-8").read())
    monkeypatch.setattr(packing, "KEPT", 20)
    assert len(list(packing._portions(text))) > 20
    assert np.frombuffer(encode(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def greedy(lengths: list[int], limit: int) -> int:
    """How many sequences best fit opens, longest first, piece by piece."""
    room: list[int] = []
    for length in sorted(lengths, reverse=True):
        fits = [(r, n) for n, r in enumerate(room) if r >= length]
        if fits:
            room[min(fits)[1]] -= length
        else:
            room.append(limit - length)
    return len(room)


@pytest.mark.parametrize("seed", range(30))
def test_plan_is_best_fit(seed):
    chooser = random.Random(seed)
    limit = chooser.choice([10, 37, 100])
    lengths = [min(limit, 1 + int(chooser.expovariate(4 / limit))) for _ in range(chooser.choice([1, 50, 400]))]
    lengths += [chooser.randint(1, limit)] * chooser.choice([0, 300])
    counts = Counter(lengths)
    used, places = Counter(), defaultdict(list)
    seats = defaultdict(set)
    for step in packing.plan(counts, limit):
        nexts = [s.first for s in packing.plan(counts, limit) if s.length == step.length and s.first > step.first]
        for rank in range(step.first, min(nexts, default=counts[step.length])):
            turn, place = divmod(rank - step.first, step.each)
            seats[step.length].add(rank)
            used[step.sequence + turn] += step.length
            places[step.sequence + turn].append((step.offset + place * step.length, step.length))
    assert all(seats[n] == set(range(c)) for n, c in counts.items())
    for spans in places.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= limit
    assert len(places) == greedy(lengths, limit)


def test_packing_round_trip(spark, tokenizer):
    chooser = random.Random(2)
    texts = ODD_TEXTS + ["tam resol " * chooser.randint(1, 60) for _ in range(200)] + ["lan dor vek " * 900] * 3
    rows = [document(i if i else None, t) for i, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, DOCS).repartition(5)
    seated = packing.pack(frame, limit=128, with_ids=True).collect()
    whole = {i: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1] for i, t in enumerate(texts)}
    by_doc, by_sequence = defaultdict(dict), defaultdict(list)
    for r in seated:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert len(ids) == r.length and zlib.crc32(r.ids) == r.ids_crc32
        by_doc[r.doc_id or 0][r.piece] = (r.start, ids)
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for i, ids in whole.items():
        pieces = [by_doc[i][n] for n in range(len(by_doc[i]))]
        assert [x for _, part in pieces for x in part] == ids
        assert [s for s, _ in pieces] == list(range(0, len(ids), 128))
    for spans in by_sequence.values():
        spans.sort()
        assert [o for o, _ in spans] == [sum(n for _, n in spans[:k]) for k in range(len(spans))]
        assert sum(n for _, n in spans) <= 128
    assert len(by_sequence) == greedy([len(p) for d in by_doc.values() for _, p in d.values()], 128)


def test_sequences_hold_their_pieces(spark):
    frame = spark.createDataFrame([document(i, "tam resol vek " * (i % 5)) for i in range(40)], DOCS)
    seated = packing.pack(frame, limit=32, with_ids=True)
    whole = {(r.sequence_id): r for r in packing.sequences(seated).collect()}
    for r in seated.collect():
        ids = np.frombuffer(whole[r.sequence_id].ids, "<u4")[r.offset : r.offset + r.length]
        assert ids.tobytes() == bytes(r.ids) and r.doc_id in whole[r.sequence_id].doc_ids


# --- source divergence --------------------------------------------------------------


def brute_divergence(docs: list[tuple], least: int, top: int) -> list[tuple]:
    groups, by_lang, having = defaultdict(Counter), defaultdict(Counter), defaultdict(Counter)
    for _, text, lang, source, *_ in docs:
        lang, source = lang or "", source or ""
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lowered)
        groups[lang, source].update(terms)
        by_lang[lang].update(terms)
        having[lang].update(set(terms))
    out = []
    for (lang, source), counts in groups.items():
        kept = sorted(t for t, n in having[lang].items() if n >= least)

        def p(c, kept=kept):
            total = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 2) // (total + 2 * len(kept)) for t in kept}

        mine, whole = p(counts), p(by_lang[lang])
        f = lambda a, b: (a - b) ** 2 // (a + b)
        pair = [(s, sum(f(mine[t], q) for t, q in p(c).items())) for (g, s), c in groups.items() if g == lang and s != source]
        term = [(t, f(mine[t], whole[t])) for t in kept if counts[t] and mine[t] > whole[t]]
        for part, items, most in (("pair", pair, None), ("term", term, top)):
            ranked = sorted(items, key=lambda x: (-x[1], x[0].encode()))[:most]
            out += [(lang, source, part, item, value, n) for n, (item, value) in enumerate(ranked, 1)]
    return sorted(out)


def corpus(seed: int, sources: int) -> list[tuple]:
    chooser = random.Random(seed)
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(300)] + ["Ünï", "ünï", "ÄB", "\U0001f600", "don't", "ABC", "abc"]
    rows = []
    for i in range(260):
        # A hot source, and words of very different frequency.
        source = "hot" if i % 3 == 0 else f"s{i % sources}"
        text = " ".join(words[int(len(words) * chooser.random() ** 3)] for _ in range(chooser.randint(0, 80)))
        rows.append(document(i, text, chooser.choice(["en", "fr"]), source))
    rows += [document(1, "only one here", "xx", "alone"), document(2, "!!! 123", "en", "empty"), document(3, None, None, None)]
    rows += [document(4, "", "yy", "a"), document(5, "once", "yy", "b"), document(5, "once", "yy", "b")]
    return rows + [document(9, "twice Twice " + "x" * 5000, None, "s")] * 12


@pytest.mark.parametrize(("sources", "block", "bits"), [(5, 32, 512), (9, 4, 64)])
def test_divergence_by_brute_force(spark, monkeypatch, sources, block, bits):
    monkeypatch.setattr(divergence, "SOURCES", block)
    monkeypatch.setattr(divergence, "BITS", bits)
    monkeypatch.setattr(divergence, "HELD", 500)
    monkeypatch.setattr(divergence, "PORTION", 64)
    rows = corpus(sources, sources)
    got = divergence.audit(spark.createDataFrame(rows, DOCS).repartition(4), least_docs=5, top=7).collect()
    assert sorted(tuple(r) for r in got) == brute_divergence(rows, 5, 7)


def test_divergence_without_kept_terms(spark):
    rows = [document(1, "a b", "en", "x"), document(2, "c", "en", "y"), document(3, None, "en", "z")]
    got = divergence.op11_source_divergence(spark.createDataFrame(rows, DOCS)).collect()
    assert sorted(tuple(r) for r in got) == brute_divergence(rows, 10, 10)
    assert divergence.op11_source_divergence(spark.createDataFrame([], DOCS)).count() == 0


def test_shares_of_huge_counts(spark):
    frame = spark.createDataFrame([(n, d) for n in (0, 8_999_999_999, 9_000_000_000, 10**15) for d in (10**15 + 6, 0)], "n long, d long")
    for r in frame.select("n", "d", divergence.share("n", "d").alias("p")).collect():
        assert r.p == (1 + 10**9 * (r.n + 2) // r.d if r.d else None)


def test_joint_cells():
    chooser = np.random.default_rng(1)
    a, b = (chooser.integers(0, 2, (n, 128)).astype(bool) for n in (9, 14))
    words = [np.packbits(x, axis=1, bitorder="little").view(np.uint64) for x in (a, b)]
    assert (divergence.joint(*words) == a.astype(int) @ b.T.astype(int)).all()
