"""N-gram Jaccard join against brute force."""
import random

import numpy as np
import pytest

from tessera.llm import ngram_join as J


def brute(rows, rule):
    sets = {}
    for i, t in rows:
        w = (t or "").encode().translate(J.LOWER_AZ).split()
        sets[i] = ({tuple(w[k:k + rule.width]) for k in range(len(w) - rule.width + 1)} if len(w) >= rule.width
                   else {tuple(w)} if w else set())
    least = {i: i for i in sets}
    changed = True
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b]
             and rule.den * len(sets[a] & sets[b]) >= rule.num * len(sets[a] | sets[b])]
    while changed:
        changed = False
        for a, b in links:
            low = min(least[a], least[b])
            changed |= least[a] != low or least[b] != low
            least[a] = least[b] = low
    return {i: (len(sets[i]), least[i]) for i in sets}


def family(rng, base, n, edits):
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rng.randint(0, edits)):
            w[rng.randrange(len(w))] = f"x{rng.randrange(999)}"
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("rule", [J.Rule(3, 90, 100), J.Rule(5, 80, 100), J.Rule(2, 50, 100)])
def test_components_equal_brute_force(docs_of, rule):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(300)]
    texts = []
    for size in (8, 30, 120, 400):
        base = [rng.choice(words) for _ in range(size)]
        texts += family(rng, base, 25, max(1, size // 12))
    passage = " ".join(rng.choice(words) for _ in range(60))
    texts += [" ".join(rng.choice(words) for _ in range(90)) + " " + passage for _ in range(40)]
    texts += [passage] * 30 + [passage + " end"] * 3 + ["", " \t\n", None, "One", "one", "ONE two", "one two", "É", "é"]
    texts.append(" ".join(rng.choice(words) for _ in range(20_000)))
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in J.join_components(docs_of(rows), rule).collect()}
    assert got == brute(rows, rule)


def test_null_ids_repeated_rows_and_empty_table(docs_of):
    rule = J.Rule(3, 90, 100)
    out = J.join_components(docs_of([(None, "a b c d"), (7, "a b c d"), (7, "a b c d"), (None, "q r s"), (None, None)]), rule)
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in out.collect()), key=repr)
    assert got == sorted([(None, 2, 7), (7, 2, 7), (7, 2, 7), (None, 1, None), (None, 0, None)], key=repr)
    assert J.join_components(docs_of([]), rule).count() == 0


def test_bound_never_exceeds_what_a_link_allows():
    for rule in (J.Rule(3, 90, 100), J.Rule(5, 80, 100)):
        for n in range(1, 400):
            miss = rule.may_miss(n)
            o = n - miss                       # fewest tokens shared with an equally large set
            assert (rule.num + rule.den) * o >= 2 * rule.num * n > (rule.num + rule.den) * (o - 1)
            assert rule.matrix_share(n) >= rule.query_share(n)


def test_parities_never_exceed_the_difference():
    rng = np.random.RandomState(3)
    for n in (1, 5, 80, 3000):
        a = J.shingles(" ".join(str(x) for x in rng.randint(0, 10**6, n)), 3, {})
        b = np.unique(np.concatenate([a[rng.rand(len(a)) > 0.1], J._mixed(rng.randint(0, 2**62, n // 10).astype(np.uint64))]))
        differ = np.bitwise_count((J.parities(a) ^ J.parities(b)).view(np.uint64)).sum()
        assert differ <= len(np.setxor1d(a, b)) and J.parities(a).shape == (J.PARITIES // 64,)
        assert (J.parities(a) == J.parities(a.copy())).all()


def test_pairs_grow_in_proportion_to_a_family(docs_of, monkeypatch):
    rng = random.Random(8)
    base = [f"w{rng.randrange(500)}" for _ in range(400)]
    texts = [" ".join(base)] + family(rng, base, 400, 12)
    rows, land = {}, J.land

    def counted(df, name):
        out = land(df, name)
        rows[name] = rows.get(name, 0) + (out.count() if name in ("hub-pairs", "opened", "pairs") else 0)
        return out

    monkeypatch.setattr(J, "land", counted)
    for m in (100, 400):
        rows.clear()
        J.join_components(docs_of(list(enumerate(texts[:m]))), J.Rule(3, 90, 100)).count()
        assert rows["hub-pairs"] + rows["opened"] + rows["pairs"] <= 8 * m, (m, rows)
