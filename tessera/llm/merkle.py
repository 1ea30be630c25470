"""Merkle manifest of a dataset: leaves, subroots by group, one root, proofs.

Rows are leaves of a tree per group (the source); the groups' subroots are
leaves of one more tree.  ``fanout`` consecutive nodes become their hash, until
one node remains.  Every level is one self-join of its nodes on computed
sibling indices: index XOR 1 for a binary tree, otherwise the run of the index,
whose slots are the sibling offsets.  The rows of slot zero then emit the
parents.  A node meets at most ``fanout`` rows, whatever the groups' sizes, and
a group that holds a third of all rows is spread like any other.

Only nodes (a digest and three numbers) are shuffled for that join, and they
are what is written: proofs come from the same join again, which is already
partitioned by run when the parents' paths are joined to it.

Leaves get their places from one range-partitioned sort by (group, id, leaf)
that is written with the rows' places; no window or task holds a group.

Hash: SHA-256 of the concatenated inputs, digests written as lowercase hex.
Digests are kept as 32 bytes and turned into hex where they are hashed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tessera.llm.common import land
from tessera.operators.corpus import place_rows

FANOUT = 16
#: Proof of a node: per level the digests before and after its own place.
_PATH = "array<struct<pre:binary,post:binary>>"


def _hex(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def hashed(*parts: Column) -> Column:
    """SHA-256 (32 bytes) of the parts' concatenated bytes."""
    return F.unhex(F.sha2(F.concat(*[p.cast("binary") for p in parts]), 256))


def leaf_of(*columns: Column) -> Column:
    """Digest of a row: each value as ``-`` if NULL, else byte count, ``:``, UTF-8 text."""
    def field(c: Column) -> Column:
        s = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))
    return hashed(*[field(c) for c in columns])


def _indices(leaves: DataFrame, order: list[str]) -> DataFrame:
    """``leaves`` plus ``g`` (the same for all rows of a group, ascending by
    group), ``i`` (place in the group, from 0) and ``n`` (the group's rows).

    The sorted rows are written with their places.  Counts per writing task and
    group are one small row each: their prefix sums run inside a task's groups
    and, over the tasks' totals, on one row per task.
    """
    placed = place_rows(leaves, order)
    group = order[0]
    runs = placed.groupBy("_seg", group).agg(F.min("_at").alias("_first"), F.count("*").alias("_rows"))
    runs = land(runs, "merkle-runs")           # read three times below
    totals = runs.groupBy("_seg").agg(F.sum("_rows").alias("_rows"), F.min("_first").alias("_first"))
    before = Window.orderBy("_seg").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("_seg", F.col("_first").alias("_seg_first"),
                           F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    begins = runs.join(totals, "_seg").withColumn("_begin", F.col("_before") + F.col("_first") - F.col("_seg_first"))
    groups = begins.groupBy(F.col(group).alias("_group")).agg(F.min("_begin").alias("g"), F.sum("_rows").alias("n"))
    # keyed by task and group: the rows of a hot group are in many tasks
    begins = land(begins.join(groups, F.col(group).eqNullSafe(F.col("_group")))
                  .select(F.col("_seg").alias("_s"), F.col(group).alias("_g"), "g", "n", "_begin", "_first"), "merkle-begins")
    return (placed.join(begins, (F.col("_seg") == F.col("_s")) & F.col(group).eqNullSafe(F.col("_g")))
            .withColumn("i", F.col("_begin") - F.col("g") + F.col("_at") - F.col("_first"))
            .drop("_s", "_g", "_begin", "_first", "_seg", "_at"))


def _with_siblings(nodes: DataFrame, fanout: int, carry: list[str] = []) -> DataFrame:
    """(g, run, i, n, h, carry) plus the siblings' digests: ``pre`` and ``post``."""
    none = F.lit("").cast("binary")
    nodes = nodes.filter("n > 1").withColumn("run", F.floor(F.col("i") / fanout).cast("long"))
    own, keep = nodes.select("g", "run", "i", "n", "h", *carry), ["g", "run", "i", "n", "h", *carry]
    others = nodes.select("g", "run", F.col("i").alias("at"), F.col("h").alias("x"))
    if fanout == 2:
        met = own.withColumn("at", F.col("i").bitwiseXOR(F.lit(1))).join(others.drop("run"), ["g", "at"], "left")
        return met.select(*keep, F.coalesce(F.when(F.col("at") < F.col("i"), F.col("x")), none).alias("pre"),
                          F.coalesce(F.when(F.col("at") > F.col("i"), F.col("x")), none).alias("post"))
    # a node meets itself, too, so a run of one keeps its node
    met = own.join(others, ["g", "run"]).groupBy(*keep).agg(F.array_sort(F.collect_list(F.struct("at", "x"))).alias("met"))

    def side(chosen) -> Column:
        return F.aggregate(F.filter("met", chosen), none, lambda a, m: F.concat(a, m["x"]))

    return met.select(*keep, side(lambda m: m["at"] < F.col("i")).alias("pre"),
                      side(lambda m: m["at"] > F.col("i")).alias("post"))


def grow(nodes: DataFrame, fanout: int = FANOUT) -> list[DataFrame]:
    """Levels (g, i, n, h) of the forest over (g, i, n, h, ...), leaves first.

    ``i`` is 0 to ``n`` - 1 in each group ``g``.  A node with ``n`` = 1 is its
    group's top and in no further level.  Each level is written once, so a lost
    executor costs one level.
    """
    if fanout < 2:
        raise ValueError("fanout must be at least 2")
    largest = nodes.agg(F.max("n")).first()[0] or 0
    levels = [nodes]
    while largest > 1:
        first = _with_siblings(levels[-1], fanout).filter(F.col("i") % fanout == 0)
        levels.append(land(first.select("g", F.col("run").alias("i"), F.ceil(F.col("n") / fanout).cast("long").alias("n"),
                                        hashed(_hex("h"), _hex("post")).alias("h")), "merkle-level"))
        largest = -(-largest // fanout)
    return levels


def tops(levels: list[DataFrame]) -> DataFrame:
    """(g, h): the node that remains of each group."""
    found = [level.filter("n = 1").select("g", "h") for level in levels]
    for more in found[1:]:
        found[0] = found[0].unionByName(more)
    return found[0]


def paths(levels: list[DataFrame], above: DataFrame, fanout: int = FANOUT, carry: list[str] = []) -> DataFrame:
    """(g, i, h, carry, top columns, path) of the leaves.

    ``above`` has, for each group ``g``, the ``path`` from its top onwards and
    columns that all its leaves get.  From the top down, a node's path is its
    own place followed by its parent's path; levels above the leaves, a
    ``fanout``-th of them, are written.
    """
    told = [c for c in above.columns if c not in ("g", "path")]
    parents = None
    for k in range(len(levels) - 1, -1, -1):
        kept = carry if k == 0 else []
        rows = levels[k].filter("n = 1").join(above, "g").select("g", "i", "h", *kept, *told, "path")
        if parents is not None:
            up = parents.select("g", F.col("i").alias("run"), *told, F.col("path").alias("far"))
            own = F.array(F.struct("pre", "post")).cast(_PATH)
            rows = rows.unionByName(
                _with_siblings(levels[k], fanout, kept).join(up, ["g", "run"])
                .select("g", "i", "h", *kept, *told, F.concat(own, "far").alias("path")))
        parents = rows if k == 0 else land(rows, "merkle-paths")
    return parents


def _folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(path, leaf, lambda a, x: hashed(_hex(x["pre"]), _hex(a), _hex(x["post"])))


def proven(leaves: DataFrame, group: str, order: list[str], leaf: str = "leaf", claimed: str = "claimed",
           fanout: int = FANOUT) -> DataFrame:
    """``leaves`` plus, as hex text, subroot, root, proof_sha256 and folded_root,
    and verified.

    ``leaf`` (32 bytes) is what the tree holds and ``claimed`` what is proven
    against it.  Groups ascend with NULL first, their rows by ``order`` and then
    by the leaf, so rows that agree in both are interchangeable.  One row in,
    one row out; no rows, no result rows.
    """
    indexed = land(_indices(leaves, [group, *order, leaf, claimed]).withColumn("h", F.col(leaf)), "merkle-leaves")
    forest = grow(indexed, fanout)
    # the tree over the subroots: one group, in the groups' order
    subroots = land(_indices(tops(forest).select(F.lit(0).alias("all"), F.col("g").alias("sub"), "h"), ["all", "sub"])
                    .select("g", "i", "n", "h", "sub"), "merkle-subroots")
    crown = grow(subroots, fanout)
    root = tops(crown).select("g", F.col("h").alias("_root"), F.array().cast(_PATH).alias("path"))
    above = land(paths(crown, root, fanout, ["sub"]).select(
        F.col("sub").alias("g"), F.col("h").alias("_subroot"), "_root", "path"), "merkle-crown")
    path = F.col("path")
    proof = F.aggregate(path, F.lit("").cast("binary"), lambda a, x: F.concat(a, x["pre"], x["post"]))
    return (paths(forest, above, fanout, leaves.columns).withColumns({
        "subroot": _hex("_subroot"), "root": _hex("_root"),
        "proof_sha256": F.sha2(_hex(proof).cast("binary"), 256),
        "folded_root": _hex(_folded(F.col(claimed), path))})
        .withColumn("verified", F.col("folded_root") == F.col("root"))
        .drop("g", "i", "h", "path", "_subroot", "_root"))


def document_proofs(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root and verified of every document.

    The claimed leaf is that of the row itself, but where 5 divides the unsigned
    crc32 of the decimal id the text is tampered with (its A-Z lower-cased).
    NULLs have their own mark in a leaf; a NULL source is a group of its own
    that comes first, a NULL id comes first in its group and is never tampered
    with.  Repeated rows are leaves of their own.  Other columns are not read.
    """
    text = F.col("text").cast("string")
    small = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    rest = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    leaf = leaf_of(*rest, text)
    rows = docs.select("doc_id", "source", leaf.alias("leaf"),
                       F.when(tampered, leaf_of(*rest, small)).otherwise(leaf).alias("claimed"))
    return proven(rows, "source", ["doc_id"]).select(
        "doc_id", _hex("leaf").alias("leaf"), "subroot", "root", "proof_sha256", "folded_root", "verified")
