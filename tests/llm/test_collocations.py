"""Collocations against counting every phrase in plain Python."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from chainlytics.llm import collocations as C

SCHEMA = "doc_id bigint, lang string, text string"


def brute(rows, longest=3, least=10, share=50, top=2000):
    f, n = Counter(), Counter()
    for _, lang, text in rows:
        lang = "und" if lang is None else lang
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n-\r]", lower):
            ws = tuple(re.findall("[^ \t]+", piece))
            n[lang] += len(ws)
            for m in range(1, longest + 1):
                for i in range(len(ws) - m + 1):
                    f[lang, ws[i : i + m]] += 1
    candidates = {key: a for key, a in f.items() if len(key[1]) > 1 and a >= least}
    out = {}
    for (lang, ws), a in candidates.items():
        m = len(ws)
        if any(l == lang and len(w) > m and any(w[s : s + m] == ws for s in range(len(w) - m + 1)) and 100 * b >= share * a for (l, w), b in candidates.items()):
            continue
        cuts = [(1_000_000 * a * a // (f[lang, ws[:k]] * f[lang, ws[k:]]), k) for k in range(1, m)]
        score, k = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(ws).encode(), f[lang, ws[:k]], f[lang, ws[k:]]))
    return {
        (lang, rank, phrase.decode(), -a, l, r, n[lang], -score)
        for lang, own in out.items()
        for rank, (score, a, phrase, l, r) in enumerate(sorted(own)[:top], 1)
    }


def found(spark, rows, **more):
    return {tuple(r) for r in C.collocations(spark.createDataFrame(rows, SCHEMA), **more).collect()}


def corpus(seed, size=150):
    rng = random.Random(seed)
    vocabulary = ["The", "new", "york", "ÉTÉ", "été", "a", "of", "x y", "Straße", "the"] + [f"w{i}" for i in range(12)]
    rows = []
    for i in range(size):
        ws = [rng.choice(vocabulary) for _ in range(rng.randint(0, 40))]
        text = "".join(w + rng.choice([" ", " ", " ", "  \t", ". ", ",", "\n", "\r\n", "!?", "\x0b"]) for w in ws)
        rows.append((i, rng.choice(["en", "en", "fr", None]), text + " new york city hall" * rng.randint(0, 2)))
    return rows + [(None, "en", None), (7, "en", ""), (7, "en", " \t.,"), (3, "de", "only one"), (3, "fr", "hot pair " * 300), (4, "fr", "hot pair " * 300)]


@pytest.mark.parametrize("budget, window", [(C.BUDGET, C.WINDOW), (200, 1_000), (20, 300)])
def test_as_brute_force_at_every_budget(spark, budget, window):
    """With small budgets words and pairs are extended, and groups hold parts of their trees."""
    rows = corpus(budget)
    assert found(spark, rows, budget=budget, window=window) == brute(rows)


def test_longer_phrases_and_a_short_list(spark):
    rows = corpus(5, 60)
    assert found(spark, rows, longest=4, least=4, share=70, top=25, budget=300) == brute(rows, 4, 4, 70, 25)
    assert found(spark, rows, longest=2, least=3, top=7) == brute(rows, 2, 3, 50, 7)


def test_ties_go_by_the_bytes_of_the_phrase(spark):
    rows = [(i, "en", ". ".join(f"{w} {w}2" for w in ("é", "z", "a", "\U0001f600", "～"))) for i in range(12)]
    got = found(spark, rows, top=4)
    assert got == brute(rows, top=4) and [r[2] for r in sorted(got)] == ["a a2", "z z2", "é é2", "～ ～2"]


def test_no_rows_and_clashing_columns(spark):
    assert found(spark, []) == set() and found(spark, [(1, "en", None)]) == set()
    rows = [(i, "en", "one two three") for i in range(10)]
    wide = spark.createDataFrame([(*r, 1, "x", 2, 3) for r in rows], SCHEMA + ", n int, word string, path int, score int")
    assert {tuple(r) for r in C.collocations(wide).collect()} == brute(rows)


def test_a_long_text_is_cut_only_between_pieces():
    data = b"one two three. " * 400 + b"x" * 3_000 + b" y"
    cut = [text for _, text in C._pieces("en", [data], 500)]
    assert b"".join(cut) == data and len(cut) > 3 and all(c.rstrip().endswith(b".") for c in cut[:-1])


def test_slots_are_packed_evenly():
    rng = np.random.default_rng(3)
    weights = {int(s): int(w) for s, w in zip(rng.permutation(1024)[:900], rng.integers(1, 1000, 900))}
    groups = C.packed(weights, 10, 20_000)
    loads = Counter()
    for slot, w in weights.items():
        loads[groups[slot]] += w
    assert len(loads) == -(-sum(weights.values()) // 20_000) and max(loads.values()) <= 20_000 + 1000
