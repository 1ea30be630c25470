"""Spelling variants against comparing all words with all."""
import random
import re
import zlib
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.llm import spelling as S

A_Z = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def plain_words(rows):
    seen = Counter()
    for d, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = run.translate(A_Z)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            word = run[:h % len(run)] + run[h % len(run) + 1:] if h % 31 == 0 else run
            if len(word) >= 7:
                seen[word] += 1
    return {w: n for w, n in seen.items() if n >= 2}


def plain(words):
    forms, out = {}, {}
    for w, n in words.items():
        near = sorted([(-m, x) for x, m in words.items() if one_edit(w, x)])
        has = bool(near) and -near[0][0] >= 10 * n
        forms[w] = near[0][1] if has else None
        out[w] = (forms[w], n, len(near), -near[0][0] if has else None)
    def root(w):
        while forms[w]:
            w = forms[w]
        return w
    return sorted([(w, f, root(w), n, k, m) for w, (f, n, k, m) in out.items()], key=repr)


def as_rows(df):
    return sorted([(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()], key=repr)


WORDS = ["running", "strange", "stranger", "thousand", "mornings", "éléphant", "naïveté", "abcabcabc", "aaaaaaaa", "ÿÿÿÿÿÿÿ"]


def noisy(rng, w):
    k = rng.randrange(len(w) + 1)
    return rng.choice([w, w, w[:k] + w[k + 1:], w[:k] + rng.choice("abé") + w[k + 1:], w[:k] + rng.choice("abé") + w[k:]])


def test_documents_equal_brute_force(spark, docs_of):
    rng = random.Random(5)
    rows = [(i if i % 9 else None, " ".join(rng.choice([str.upper, str.title, str])(noisy(rng, rng.choice(WORDS)))
                                            for _ in range(rng.randrange(60)))) for i in range(150)]
    rows += [(1000, None), (1001, ""), (1002, "1234 5678"), (1003, "word-" * 3), (1003, "thousand,thousand;thousänd")]
    got = as_rows(S.document_variants(docs_of(rows)))
    assert got == plain(plain_words(rows))
    assert any(r[1] for r in got)
    more = docs_of(rows).withColumns({c: F.lit(1) for c in ("word", "n", "run", "h", "id", "root")})
    assert as_rows(S.document_variants(more)) == got


def test_chains_lead_to_the_last_form(spark):
    words = {"aaaaaaa": 2, "aaaaaab": 20, "aaaaabb": 200, "aaaabbb": 2000, "aaabbbb": 20000, "zzzzzzz": 2,
             "qqqqqqq": 3, "qqqqqqqa": 30, "qqqqqqqb": 30}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    got = as_rows(S.variants(df))
    assert got == plain(words)
    assert ("aaaaaaa", "aaaaaab", "aaabbbb", 2, 1, 20) in got and ("qqqqqqq", "qqqqqqqa", "qqqqqqqa", 3, 2, 30) in got


def test_many_words_of_one_half_are_cut_into_blocks(spark, monkeypatch):
    """A tile of many blocks and very long words give what comparing all gives."""
    rng = random.Random(8)
    words = {"commons" + "".join(rng.choice("xyz") for _ in range(rng.randrange(5, 8))): rng.randrange(2, 500) for _ in range(700)}
    long = "".join(rng.choice("abcdef") for _ in range(30_000))
    words |= {long: 3, long[:-1]: 40, long[1:]: 2, "q" + long: 9, long[:15_000] + "z" + long[15_001:]: 5}
    monkeypatch.setattr(S, "BLOCK", 64)
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    assert max(r.j for r in S._tiles(df, 7).select("j").collect()) > 2
    assert as_rows(S.variants(df)) == plain(words)


def test_empty_table(docs_of):
    assert S.document_variants(docs_of([])).collect() == []
    assert S.document_variants(docs_of([(1, "short words only"), (2, None)])).collect() == []


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text("abé", min_size=3, max_size=5), min_size=1, max_size=8, unique=True), st.integers(3, 4), st.booleans())
def test_matrices_find_single_edits(words, shorter, prefix_tile):
    """In a tile of one half: exactly the pairs that differ by one edit."""
    words = [w for w in words if len(w) in (shorter, shorter + 1)]
    if not words:
        return
    got = S.near_pairs(words, words, shorter, prefix_tile)
    for i, a in enumerate(words):
        for j, b in enumerate(words):
            fits = shorter in (len(a), len(b)) and one_edit(a, b)
            lead = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
            assert got[i, j] == np.bool_(fits and (prefix_tile or lead < shorter // 2)), (a, b)
