"""Merkle manifest against a plain recursive version."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from tessera.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"
A_Z = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(s):
    return hashlib.sha256(s if isinstance(s, bytes) else s.encode()).hexdigest()


def leaf(row, text):
    out = b""
    for v in (row[0], row[1], row[2], row[3], text):
        b = b"" if v is None else str(v).encode()
        out += b"-" if v is None else str(len(b)).encode() + b":" + b
    return sha(out)


def tree(hashes, fanout):
    """Root, and per leaf the (left, right) siblings of each level."""
    proofs = [[] for _ in hashes]
    nodes = [(h, [k]) for k, h in enumerate(hashes)]
    while len(nodes) > 1:
        runs = [nodes[a:a + fanout] for a in range(0, len(nodes), fanout)]
        for run in runs:
            for j, (_, below) in enumerate(run):
                for k in below:
                    proofs[k].append(("".join(x[0] for x in run[:j]), "".join(x[0] for x in run[j + 1:])))
        nodes = [(sha("".join(x[0] for x in run)), [k for x in run for k in x[1]]) for run in runs]
    return nodes[0][0], proofs


def plain(rows, fanout=16):
    groups = {}
    for r in rows:
        t = r[4]
        own = leaf(r, t)
        tampered = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0
        claimed = leaf(r, t.translate(A_Z) if t is not None else None) if tampered else own
        groups.setdefault(r[1], []).append((r[0] is not None, r[0] or 0, own, claimed, r[0]))
    subs, told = [], []
    for s in sorted(groups, key=lambda s: (s is not None, (s or "").encode())):
        rows = sorted(groups[s])
        top, proofs = tree([x[2] for x in rows], fanout)
        subs.append(top)
        told.append((rows, proofs))
    root, upper = tree(subs, fanout) if subs else (None, [])
    out = []
    for (rows, proofs), sub, up in zip(told, subs, upper):
        for (_, _, own, claimed, doc_id), proof in zip(rows, proofs):
            folded = claimed
            for left, right in proof + up:
                folded = sha(left + folded + right)
            out.append((doc_id, own, sub, root, sha("".join(a + b for a, b in proof + up)), folded, folded == root))
    return sorted(out, key=repr)


def found(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    return sorted([tuple(r) for r in merkle.document_proofs(df).collect()], key=repr)


def test_equals_plain_version_with_a_hot_source(spark):
    rng = random.Random(7)
    rows = [(i, "hot" if i % 3 else rng.choice(["a", "b", "é", None]), rng.choice(["en", None]), i % 7 or None,
             rng.choice(["Text %d" % i, "same", "", None])) for i in range(700)]
    rows.append((701, "alone", "en", 1, "X" * 200_000))
    got = found(spark, rows)
    assert got == plain(rows)
    assert any(not r[-1] for r in got) and any(r[-1] for r in got)


def test_many_sources_make_a_deep_crown(spark):
    rows = [(i, f"s{i % 40:02d}", "en", 1, f"T{i}") for i in range(90)]
    assert found(spark, rows) == plain(rows)


def test_nulls_ties_repeats_empty_and_clashing_columns(spark):
    rows = [(None, None, None, None, None), (5, "a", "en", 3, "B"), (5, "a", "en", 3, "B"), (5, "a", "en", 3, "C"),
            (None, "a", "en", 1, "x"), (None, "a", "en", 1, "y")]
    assert found(spark, rows) == plain(rows)
    assert found(spark, rows[:1]) == plain(rows[:1])
    empty = spark.createDataFrame([], SCHEMA)
    assert merkle.document_proofs(empty).collect() == []
    more = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(1) for c in ("g", "i", "h", "_seg", "claimed", "pre", "root")})
    assert sorted([tuple(r) for r in merkle.document_proofs(more).collect()], key=repr) == plain(rows)


def test_binary_tree_uses_xor(spark):
    nodes = spark.createDataFrame([(0, i, 11, hashlib.sha256(b"%d" % i).digest()) for i in range(11)], "g long, i long, n long, h binary")
    forest = merkle.grow(nodes, 2)
    top, proofs = tree([sha(b"%d" % i) for i in range(11)], 2)
    assert merkle.tops(forest).select(F.hex("h")).first()[0].lower() == top
    above = merkle.tops(forest).select("g", F.expr("array()").cast("array<struct<pre:binary,post:binary>>").alias("path"))
    got = {r.i: [(p.pre.hex(), p.post.hex()) for p in r.path] for r in merkle.paths(forest, above, 2).collect()}
    assert got == dict(enumerate(proofs))
    with pytest.raises(ValueError):
        merkle.grow(nodes, 1)
