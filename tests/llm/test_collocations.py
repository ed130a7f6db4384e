"""Collocations against counting all phrases one by one."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from tremor.llm import collocations as col

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, least, top):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = lang if lang is not None else "und"
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            f.update((lang, *w[i : i + k]) for k in range(1, 6) for i in range(len(w) - k + 1))
    chosen = [p for p in f if len(p) > 2 and f[p] >= least]
    covered = {(q[0], *q[1 + i : 1 + i + k]) for q in chosen for k in range(2, len(q) - 1) for i in range(len(q) - k) if 100 * f[q] >= 100 * f[(q[0], *q[1 + i : 1 + i + k])]}
    out = []
    for p in chosen:
        lang, w, a = p[0], p[1:], f[p]
        score, _, left, right = min((1000 * a * n[lang] // (f[(lang, *w[:k])] * f[(lang, *w[k:])]), k, f[(lang, *w[:k])], f[(lang, *w[k:])]) for k in range(1, len(w)))
        if p not in covered:
            out.append((lang, -score, -a, " ".join(w).encode(), left, right))
    result = []
    for lang in {o[0] for o in out}:
        best = sorted(o for o in out if o[0] == lang)[:top]
        result += [(lang, r, p.decode(), -a, left, right, n[lang], -score) for r, (_, score, a, p, left, right) in enumerate(best, 1)]
    return sorted(result)


def corpus():
    rng = random.Random(3)
    words = ["the", "The", "of", "a", "é", "漢字", "x\x1cy", "\x85", "new", "york", "city", "very", "rare"]
    weights = [9, 3, 7, 6, 3, 2, 1, 1, 3, 3, 2, 2, 1]
    rows = []
    for i in range(400):
        t = "".join(rng.choice([" ", "  ", "\t", ", ", ".", "\n", "\r\n", " "] + [" "] * 6) + rng.choices(words, weights)[0] for _ in range(rng.randint(0, 40)))
        rows.append((rng.choice(["en", "en", "fr", None, "und"]), t))
    rows += [("en", None), (None, ""), ("en", " \t "), ("en", "of the new york city " * 400), ("de", "a a a a a a a a"), ("en", ". , ;")] + [("fr", "all of a kind")] * 30
    return rows


@pytest.mark.parametrize(("most_words", "range_size", "top"), [(1000, 1 << 18, 2000), (1000, 64, 15), (0, 64, 2000)])
def test_phrases_equal_plain_counts(spark, monkeypatch, most_words, range_size, top):
    monkeypatch.setattr(col, "RANGE", range_size)
    rows = corpus()
    df = spark.createDataFrame([(a, b, 1, 2, "k", "p") for a, b in rows], "lang string, text string, n long, a int, key string, phrase string").repartition(4)
    got = sorted(tuple(r) for r in col.collocations(df, least=12, top=top, most_words=most_words).collect())
    assert got == plain(rows, 12, top) and len(got) > 20


def test_tables_without_phrases(spark):
    df = spark.createDataFrame([("en", "a b c"), (None, None)], "lang string, text string")
    assert col.collocations(df).count() == 0
    assert col.collocations(df.limit(0), least=1).count() == 0
    assert [tuple(r) for r in col.collocations(df, least=1).select("lang", "phrase", "a", "score").collect()] == [("en", "a b c", 1, 3000)]


def test_stretches_give_each_window_once():
    rng = np.random.default_rng(1)
    numbers = rng.integers(0, 5, (500, 1)).astype(np.uint32)
    whole = col._windows(numbers, 5)
    parts = [col._stretch(numbers, at, 7, 5) for at in range(0, 500, 7)]
    assert (np.concatenate(parts) == whole).all()
    keys = rng.integers(0, 1 << 32, (1000, 3)).astype(np.uint32)
    assert (keys[col.radix_order(keys)] == keys[np.lexsort(keys.T[::-1])]).all()
    assert len(col._windows(numbers[:1], 5)) == 0
