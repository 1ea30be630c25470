"""HyperMinHash near-duplicates against brute force."""
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import hyperminhash as H
from tessera.llm.ngram_join import LOWER_AZ, Rule

RULE = Rule(width=5, num=85, den=100)


def brute(rows, rule=RULE):
    """(doc_id, n_shingles, component_id) by comparing all rows."""
    sets = []
    for _, t in rows:
        w = (t or "").encode().translate(LOWER_AZ).split()
        sets.append({tuple(w[k:k + rule.width]) for k in range(len(w) - rule.width + 1)} if len(w) >= rule.width
                    else {tuple(w)} if w else set())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and rule.den * both >= rule.num * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted([(d, len(s), least.get(find(i)) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets))], key=repr)


def found(df, rule=RULE):
    return sorted([(r.doc_id, r.n_shingles, r.component_id) for r in H.kept_documents(df, rule).collect()], key=repr)


def edited(rng, base, edits):
    w = list(base)
    for _ in range(edits):
        w[rng.randrange(len(w))] = f"x{rng.randrange(10 ** 6)}"
    return w


@pytest.mark.parametrize("rule", [RULE, Rule(3, 70, 100)])
def test_components_equal_brute_force(docs_of, rule):
    rng = random.Random(11)
    words = [f"w{i}" for i in range(400)]
    texts = []
    # families without their base text, edited up to and past the threshold
    for size in (6, 8, 12, 30, 90, 260, 700):
        base = [rng.choice(words) for _ in range(size)]
        texts += [edited(rng, base, rng.randint(0, max(1, size // 30))) for _ in range(25)]
        texts += [base[:len(base) - rng.randint(0, max(1, size // 8))] for _ in range(8)]
    # chains: each text drops a little of the one before
    base = [rng.choice(words) for _ in range(300)]
    texts += [base[k * 12:k * 12 + 150] for k in range(12)]
    # documents that a common passage fills in part, and a patchwork of passages
    passages = [[rng.choice(words) for _ in range(60)] for _ in range(4)]
    for share in (1, 5, 40, 150):
        texts += [passages[0] + [rng.choice(words) for _ in range(share)] for _ in range(20)]
    texts += [[w for p in rng.sample(passages, 3) for w in p] for _ in range(30)]
    rows = [(i, " ".join(w)) for i, w in enumerate(texts)]
    rng.shuffle(rows)
    assert found(docs_of(rows), rule) == brute(rows, rule)


def test_nulls_repeats_ties_long_text_and_clashing_columns(docs_of):
    rng = random.Random(3)
    long = " ".join(f"v{rng.randrange(10 ** 6)}" for _ in range(60_000))
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, "Only Two"), (5, "only  two"), (5, "only  two"), (6, "only twO s"),
            (None, "only two"), (None, None), (None, "no other text has these words"), (None, "no other text has these words"),
            (7, long), (8, long + " end"), (9, "a b c d e f g"), (9, "h i j k l m n"), (10, "H i j k l m n")]
    df = docs_of(rows)
    assert found(df) == brute(rows)
    clash = df.withColumns({c: F.lit(1) for c in ("row", "k", "n", "sid", "label", "band", "tokens", "component_id", "kept")})
    assert found(clash) == brute(rows)
    assert H.kept_documents(docs_of([])).collect() == []
    assert found(docs_of([(1, None), (2, "")])) == [(1, 0, 1), (2, 0, 2)]
    kept = {(r.doc_id, r.kept) for r in H.kept_documents(df).collect() if r.doc_id in (1, 4, 5, 8)}
    assert kept == {(1, True), (4, True), (5, False), (8, False)}


def test_registers_hold_zeros_and_mantissa():
    rng = np.random.RandomState(1)
    tokens = np.unique(rng.randint(0, 1 << 63, 500, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1))
    edge = np.array([0, 1, (1 << 57) - 1, 1 << 57, (1 << 64) - 1, (3 << 57) | 7], dtype=np.uint64)
    for s in (tokens, edge, tokens[:1]):
        plain = [0] * H.BUCKETS
        for b in range(H.BUCKETS):
            rest = [int(t) & ((1 << 57) - 1) for t in s if int(t) >> 57 == b]
            if rest:
                bits = format(min(rest) << 7, "064b")
                zeros = min(len(bits) - len(bits.lstrip("0")), H._ZEROS)
                plain[b] = (zeros + 1) << 10 | int((bits[zeros + 1:] + "0" * 64)[:10], 2)
        got = H.registers(s).tolist()
        assert [x for x in got] == plain


@pytest.mark.parametrize("n", [40, 300, 3000])
def test_estimate_follows_jaccard_and_corrects_collisions(n):
    rng = np.random.RandomState(n)

    def draw(k):
        return rng.randint(0, 1 << 62, k, dtype=np.int64).astype(np.uint64) * np.uint64(4)

    errors, chance, expected = [], [], []
    for _ in range(60):
        both, a, b = draw(n), draw(n // 10), draw(n // 10)
        x, y = (np.unique(np.concatenate([both, z])) for z in (a, b))
        rx, ry = H.registers(x)[None], H.registers(y)[None]
        est, _ = H.estimates(rx, ry, np.array([len(x)]), np.array([len(y)]))
        errors.append(est[0] - n / (n + 2 * (n // 10)))
        u, v = draw(n), draw(n)
        chance.append(int(((H.registers(u) == H.registers(v)) & (H.registers(u) != 0)).sum()))
        expected.append(H.chance_collisions(np.array([n]), np.array([n]))[0])
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.08
    assert abs(np.mean(chance) - np.mean(expected)) < 0.15


def test_halvings_of_the_hash_range(spark):
    """Tasks and plans agree on the range in which a set is looked up."""
    sizes = sorted({m + d for k in range(12) for m in [H.KEPT << k] for d in (-1, 0, 1)} | {1, 2, 3})
    df = spark.createDataFrame([(n,) for n in sizes], "n long")
    assert [r.h for r in df.select("n", H._halvings_of(F.col("n")).alias("h")).orderBy("n").collect()] == [H._halvings(n) for n in sizes]


def test_large_family_meets_its_hub_only(docs_of):
    """Pairs that are held against each other grow with a family, not with its square."""
    counts = []
    for m in (100, 200, 400):
        rng = random.Random(m)
        base = [f"w{rng.randrange(10 ** 6)}" for _ in range(300)]
        df = docs_of([(i, " ".join(edited(rng, base, 3))) for i in range(m)])
        sets = H.land(H.sketched(df, RULE).filter("k IS NOT NULL").groupBy("k").agg(
            F.min("row").alias("row"), F.first("n").alias("n"), F.first("bands", True).alias("bands"))
            .withColumn("sid", F.monotonically_increasing_id()), "sets")
        labels = sets.select("sid", F.col("sid").alias("label"))
        counts.append(H._hub_pairs(H._shared_bands(sets), labels, RULE).count())
    assert counts[1] < 3 * counts[0] and counts[2] < 3 * counts[1], counts
