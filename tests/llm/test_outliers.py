"""Quality rules: base statistics by brute force, the estimate by numpy."""
import collections
import random
import re

import numpy as np
from pyspark.sql import functions as F

from tessera.llm import outliers as O


def brute(t):
    t = t or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    c = collections.Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    inside = {j for i in range(len(w) - 2) if c[tuple(w[i:i + 3])] > 1 for j in (i, i + 1, i + 2)}
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(inside))


def clean(rng, n=120):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8))) for _ in range(n))


def test_base_statistics_equal_brute_force(docs_of):
    rng = random.Random(1)
    texts = [None, "", " \t", "a", "a a a a", "a b c a b c", "a b c d a b c", "x\n\nx\n x\n\t\nx", "# $ %\n&&|<>*", "é 日本 b c",
             "a b " * 500, "a b c d e f g " * 3000, clean(rng, 20_000)]
    texts += [" ".join(rng.choice("abcd") for _ in range(rng.randint(1, 60))) for _ in range(60)]
    docs = docs_of(list(enumerate(texts))).withColumn("n_words", F.lit("clash")).withColumn("_p", F.lit(1))
    got = {r.doc_id: tuple(r[c] for c in O.STATS) for r in O.base_statistics(docs).collect()}
    assert got == {i: brute(t) for i, t in enumerate(texts)}


def test_junk_is_rejected_and_clean_text_kept(docs_of):
    rng = random.Random(2)
    rows = [(i, clean(rng, rng.randint(60, 400)), "en", "a") for i in range(200)]
    rows += [(1000 + i, " ".join(w + "$$$" for w in clean(rng).split()), "en", "a") for i in range(20)]
    rows += [(2000 + i, clean(rng), None, None) for i in range(40)] + [(3000, "too short", "en", "a"), (3001, None, "en", "a")]
    rows += [(4000, clean(rng), "fr", "lonely"), (None, clean(rng), "en", "a"), (7, rows[7][1], "en", "a")]
    got = collections.defaultdict(list)
    for r in O.document_verdicts(docs_of(rows)).collect():
        got[r.doc_id].append(r)
    assert all(got[i][0].kept for i in [*range(200), *range(2000, 2040), 4000, None])
    assert len(got[7]) == 2 and not any(got[1000 + i][0].kept for i in range(20))
    assert all(got[i][0].base_failed and not got[i][0].kept for i in (3000, 3001))


def test_distances_equal_numpy(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 5)) * [1, 2, 0.5, 1, 3] + [0, 5, 1, 2, 3]
    x[:60] += 25                                            # contamination
    df = spark.createDataFrame([("en", "s", *map(float, r)) for r in x], ["lang", "source", *[f"x{i}" for i in range(5)]])
    fit = O.estimate(df, 5)
    f = fit.collect()[0]
    d = np.mean(x[60:], axis=0)
    assert np.allclose([f[f"c{i}"] for i in range(5)], d, atol=0.35)
    low = np.zeros((5, 5))
    for i in range(5):
        for j in range(i + 1):
            low[i, j] = f[f"l{i}_{j}"]
    got = sorted(r.d2 for r in O._distances(df, fit, 5).collect())
    diff = x - [f[f"c{i}"] for i in range(5)]
    want = sorted(np.einsum("ij,jk,ik->i", diff, np.linalg.inv(low @ low.T), diff))
    assert np.allclose(got, want) and sum(v > O.CHI2_FAR for v in got) == 60


def test_empty_table(docs_of):
    assert O.document_verdicts(docs_of([])).count() == 0


def test_repeats_and_copied_lines_that_the_group_does_not_have_are_rejected(docs_of):
    rng = random.Random(4)
    rows = [(i, clean(rng, rng.randint(60, 400)), "en", "a") for i in range(200)]
    passage = clean(rng, 27)
    repeats = " ".join([clean(rng, 33), passage, clean(rng, 33), passage])          # 45 % of 120 words, below the base rule
    lines = "\n".join([w + "\n" + x for w, x in zip(clean(rng, 60).split(), ["ab"] * 15 + clean(rng, 45).split())])
    junk = "$$ ".join(clean(rng).split())
    rows += [(1000, repeats, "en", "a"), (1001, lines, "en", "a"), (1002, junk, "en", "rare"), (1003, clean(rng), "en", "rare"),
             (1004, junk, "xx", "rarer"), (1005, clean(rng), "xx", "rarer")]
    got = {r.doc_id: r for r in O.document_verdicts(docs_of(rows)).collect()}
    assert not any(got[i].base_failed for i in range(1000, 1006))
    assert [got[i].kept for i in range(1000, 1006)] == [False, False, False, True, False, True]
    assert all(got[i].kept for i in range(200))


def test_other_columns_pass_through_whatever_their_names(docs_of):
    rng = random.Random(6)
    rows = [(i, clean(rng), "en", "a") for i in range(60)]
    names = ["x0", "m", "c0", "l1_0", "_y0", "wide", "level", "_row", "_lang"]
    docs = docs_of(rows).selectExpr("*", *[f"concat('{c}', doc_id) AS {c}" for c in names], "7 AS kept")
    got = O.judged(docs).collect()
    assert len(got) == 60 and all(r[c] == f"{c}{r.doc_id}" for r in got for c in names)
    assert {r.doc_id: (r.kept, r.d2) for r in got} == {r.doc_id: (r.kept, r.d2) for r in O.document_verdicts(docs_of(rows)).collect()}
