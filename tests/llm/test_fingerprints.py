"""Order MinHash fingerprints against a plain Python version."""
import hashlib
import random

from pyspark.sql import functions as F

from tessera.llm import fingerprints as O


def expected(rows):
    """n_chars and edited digest by the stated order (distinct ids)."""
    order = sorted(((i, t or "") for i, t in rows), key=lambda r: -r[0])
    out = {}
    for k, (i, t) in enumerate(order):
        after = order[(k + 1) % len(order)][1]
        m = len(t) // 3
        out[i] = (len(t), hashlib.sha256((t[:len(t) - m] + after[:m]).encode()).hexdigest())
    return out


def test_edited_texts_and_order(docs_of):
    rng = random.Random(5)
    rows = [(rng.randrange(-10**12, 10**12), " ".join(rng.choice(["a", "bé", "日本", "\U0001F600x"]) for _ in range(rng.randint(0, 80))))
            for _ in range(300)]
    rows = list(dict(rows).items()) + [(10**13, None), (10**13 + 1, ""), (10**13 + 2, "one"), (10**13 + 3, "w " * 60_000)]
    got = {r.doc_id: (r.n_chars, r.edited_sha256) for r in O.document_fingerprints(docs_of(rows)).collect()}
    assert got == expected(rows)


def test_likeness(docs_of):
    rng = random.Random(6)
    words = ["".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(2000)]
    rows = [(i, " ".join(rng.choice(words) for _ in range(600))) for i in range(20)]
    rows += [(100, rows[0][1]), (101, rows[0][1])]
    got = {r.doc_id: r for r in O.document_fingerprints(docs_of(rows)).collect()}
    assert got[100].fingerprint == got[101].fingerprint == got[0].fingerprint and got[101].near_next == 1.0
    assert all(0.05 < got[i].near_edited < 0.7 and got[i].near_next < 0.05 for i in range(1, 20))


def test_order_and_repetitions_matter(docs_of):
    a = [f"word{i:03d}" for i in range(400)]
    moved = a[200:] + a[:200]
    rows = [(1, " ".join(a)), (2, " ".join(moved)), (3, "ab cd ef " * 30), (4, "ab cd ef " * 300)]
    docs = O.signed(docs_of(rows).withColumn("sig0", F.lit(1)), "text", "sig")
    sig = {r.doc_id: set(r.sig) for r in docs.collect()}
    same_set = len(sig[1] & sig[2]) / O.BINS
    assert 0.2 < same_set < 0.85                 # the same k-mers, half of the pairs in another order
    assert sig[3] != sig[4]                      # numbered occurrences


def test_nulls_ties_repeats_and_empty(docs_of):
    rows = [(None, None), (None, "x"), (3, "b"), (3, "a"), (3, "a"), (2, None)]
    docs = docs_of(rows).withColumn("sig", F.lit(1)).withColumn("n", F.lit("x"))
    got = O.document_fingerprints(docs).collect()
    assert sorted(((r.doc_id, r.n_chars) for r in got), key=repr) == sorted([(None, 0), (None, 1), (3, 1), (3, 1), (3, 1), (2, 0)], key=repr)
    # a row for each document: rows that agree in id and text give equal rows
    assert len({tuple(r) for r in got}) == 5
    assert O.document_fingerprints(docs_of([])).count() == 0
    one = O.document_fingerprints(docs_of([(1, "abc def ghi")])).collect()[0]
    assert one.near_next == 1.0


def test_one_inserted_character_in_unspaced_text(docs_of):
    rng = random.Random(8)
    texts = ["".join(chr(rng.randrange(lo, hi)) for _ in range(3000)) for lo, hi in ((0x4E00, 0x9FA0), (97, 123), (0x20000, 0x20100))]
    rows = [(3 * i + j, t) for i, x in enumerate(texts) for j, t in enumerate((x, x[0] + x, x[:1500] + "q" + x[1500:]))]
    sig = {r.doc_id: set(r.sig) for r in O.signed(docs_of(rows), "text", "sig").collect()}
    assert all(len(sig[3 * i] & sig[3 * i + j]) >= 0.8 * O.BINS for i in range(3) for j in (1, 2))
    assert all(len(sig[0] & sig[k]) == 0 for k in (3, 6))
