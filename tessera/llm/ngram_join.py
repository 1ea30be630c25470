"""N-gram Jaccard join over a token-group matrix.

Documents are sets of word n-grams (64-bit hashes).  Equal sets are one set
from the start.  The join then runs in the steps of a token-group matrix:

1. *Groups.*  Sets that share a signature (their two smallest tokens under one
   of six hash orders) are compared with the hub of that signature, the set
   with the smallest part of tokens that no other set holds: the middle of a
   family.  Sets that links with hubs connect are a group; they are one in the
   result already and are never compared with each other.
2. *Matrix.*  The union of a group's tokens is kept as rows (token, group).
   Only tokens below a share of the hash range are kept; the share shrinks with
   the set's size, so that a set of n tokens is represented by a few more than
   the tokens it may miss.  Tokens found in one group only are dropped.
3. *Bound.*  A link between sets of a <= b tokens needs an overlap of
   ``num (a + b) / (num + den)``, so the smaller set may miss at most
   ``a - 2 num a / (num + den)`` of its tokens in any group that holds a partner.
   A set that has more tokens in no other group is done.  For the others the
   overlap with every group is counted over their rarer tokens; a group that
   misses more of these than the set may miss cannot hold a partner.  Sets that
   consist of common tokens (passages that many documents share) are told apart
   by the rarest tokens of their whole sets instead, both sets of a pair by theirs.
4. *Open.*  Only members of groups that reach the bound are looked at, and only
   those of a fitting size whose parities allow a link (below) are compared, by
   the whole sets.

A set's *parities* are ``PARITIES`` bits: whether it holds an odd number of the
tokens that fall to a bit.  Two sets that differ in d tokens differ in at most d
of these bits, so the bound drops pairs and never a link.

A set with more kept tokens than it may miss loses no link.  A larger one relies
on holding a kept token that it shares: for 57 kept tokens the chance that none
is shared is e-24 at a similarity of 0.9 and e-30 at 0.8.  Equality of sets rests
on 64-bit hashes (some two dozen accidental ones among 30 billion sets).
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tessera.llm.common import LOWER_AZ, land, prepare_python
from tessera.llm.graph import components

CACHE = 100_000              # word hashes remembered in a task
COMMON = 32                  # groups; more frequent tokens are not looked up in the matrix
PARITIES = 512               # bits
_STEP = 0x9E3779B97F4A7C15
_ORDERS = tuple(np.uint64(x) for x in (1, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB,
                                       0x8EBC6AF09C88C6E3, 0x589965CC75374CC3))
_TOP = float(1 << 64)


@dataclass(frozen=True)
class Rule:
    """Shingle width and the least Jaccard similarity ``num / den``."""

    width: int = 5
    num: int = 80
    den: int = 100

    def may_miss(self, n):
        """Tokens that the smaller of two linked sets can lack in the other."""
        return n - -(-2 * self.num * n // (self.num + self.den))

    def query_share(self, n: int) -> float:
        """Part of the hash range in which a set of n tokens is looked up."""
        return min(1.0, (1.5 * (self.den - self.num) / (self.num + self.den)) + 16.0 / n)

    def matrix_share(self, n: int) -> float:
        """Part in which it is stored: that of its smallest possible partner."""
        return self.query_share(max(1, -(-self.num * n // self.den)))


def _mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingles(text: str | None, width: int, cache: dict[bytes, int]) -> np.ndarray:
    """Sorted distinct hashes of the word n-grams of a whole text.

    A-Z count as a-z; words are runs of anything but the six white-space
    characters.  Fewer words than ``width`` are one n-gram; no words, none.
    """
    words = (text or "").encode("utf-8", "surrogatepass").translate(LOWER_AZ).split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    if len(cache) > CACHE:
        cache.clear()
    known, h = cache.get, xxhash.xxh3_64_intdigest
    hashes = []
    for w in words:
        v = known(w)
        if v is None:
            v = cache[w] = h(w)
        hashes.append(v)
    a = np.array(hashes, dtype=np.uint64)
    span = min(width, len(a))
    total = np.zeros(len(a) - span + 1, dtype=np.uint64)
    factor = 1
    for i in range(span):
        factor = factor * _STEP % (1 << 64)
        total += a[i:len(a) - span + 1 + i] * np.uint64(factor)
    if len(a) < width:
        total += np.uint64(len(a))
    return np.unique(_mixed(total))


def _signatures(tokens: np.ndarray) -> list[int]:
    out = []
    for i, order in enumerate(_ORDERS):
        t = tokens[:2] if i == 0 else np.partition(_mixed(tokens * order), min(1, len(tokens) - 1))[:2]
        out.append(xxhash.xxh3_64_intdigest(t.tobytes(), seed=i))
    return out


def parities(tokens: np.ndarray) -> np.ndarray:
    """``PARITIES`` bits as longs: 1 where an odd number of tokens falls to the bit."""
    odd = np.bincount((tokens & np.uint64(PARITIES - 1)).astype(np.int64), minlength=PARITIES) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _key(tokens: np.ndarray) -> int:
    """Hash of a whole set; even, as the lowest bit carries a flag later."""
    return _signed([xxhash.xxh3_64_intdigest(tokens.tobytes()) & ~1])[0]


def _signed(values) -> list[int]:
    return np.array(values, dtype=np.uint64).view(np.int64).tolist()


def _numbered(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    """row (the id; for a NULL id a hash of the text), text_hash, doc_id, text."""
    return docs.select(F.coalesce(F.col(doc_id).cast("long"), F.xxhash64(F.col(text))).alias("row"),
                       F.xxhash64(F.col(text)).alias("text_hash"),
                       F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))


def sketched(docs: DataFrame, rule: Rule, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Per document: row, text_hash, doc_id, n (set size), k (hash of the set; NULL if
    empty), nq (tokens to look up), low (tokens to store), sig, par (parities).

    ``low``, ``sig`` and ``par`` come with the first document of a set in a task only,
    so copies add nothing to what follows.
    """
    prepare_python(docs.sparkSession)

    def run(batches):
        cache: dict[bytes, int] = {}
        seen: set[int] = set()
        for b in batches:
            n, k, nq, low, sig, par = [], [], [], [], [], []
            for t in b.column(3):
                s = shingles(t.as_py(), rule.width, cache)
                n.append(len(s))
                if not len(s):
                    k.append(None), nq.append(0), low.append([]), sig.append([]), par.append(None)
                    continue
                key = _key(s)
                k.append(key)
                if key in seen:
                    nq.append(0), low.append([]), sig.append([]), par.append(None)
                    continue
                seen.add(key)
                stored, asked = (len(s) if share >= 1 else int(np.searchsorted(s, np.uint64(int(share * _TOP))))
                                 for share in (rule.matrix_share(len(s)), rule.query_share(len(s))))
                nq.append(asked)
                low.append(s[:stored].view(np.int64))
                sig.append(_signed(_signatures(s)))
                par.append(parities(s))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), b.column(2), pa.array(n, pa.int64()), pa.array(k, pa.int64()), pa.array(nq, pa.int32()),
                 pa.array(low, pa.list_(pa.int64())), pa.array(sig, pa.list_(pa.int64())),
                 pa.array(par, pa.list_(pa.int64()))],
                names=["row", "text_hash", "doc_id", "n", "k", "nq", "low", "sig", "par"])

    return _numbered(docs, text, doc_id).mapInArrow(
        run, "row long, text_hash long, doc_id long, n long, k long, nq int, low array<long>, sig array<long>, par array<long>")


def _whole_sets(docs: DataFrame, wanted: DataFrame, rule: Rule, text: str, doc_id: str) -> DataFrame:
    """(k, tokens) of the sets in ``wanted`` (row, k, picked), written.

    Spark's runtime Bloom filter over the wanted rows (a few MB at most) keeps
    most other texts from being shuffled; the join decides.  Rows of one id
    meet in one task, which keeps each set once.
    """
    spark = docs.sparkSession
    texts = _numbered(docs, text, doc_id).join(wanted.filter("picked = true").hint("merge"), "row").select("k", "text")

    def run(batches):
        cache: dict[bytes, int] = {}
        seen: set[int] = set()
        for b in batches:
            keys, sets = [], []
            for k, t in zip(b.column(0).to_pylist(), b.column(1)):
                if k in seen:
                    continue
                s = shingles(t.as_py(), rule.width, cache)
                if len(s) and _key(s) == k:      # else another text with this id
                    seen.add(k)
                    keys.append(k)
                    sets.append(s.view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(sets, pa.list_(pa.int64()))],
                                             names=["k", "tokens"])

    filters = "spark.sql.optimizer.runtime.bloomFilter"
    least, most = f"{filters}.applicationSideScanSizeThreshold", f"{filters}.creationSideThreshold"
    before = {key: spark.conf.get(key) for key in (least, most)}
    try:
        spark.conf.set(least, "1")
        spark.conf.set(most, "1g")
        return land(texts.mapInArrow(run, "k long, tokens array<long>"), "whole-sets")
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def _linked(pairs: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    """The pairs (a, b) whose whole sets reach the threshold."""
    left = sets.select(F.col("k").alias("a"), F.col("tokens").alias("_a"))
    right = sets.select(F.col("k").alias("b"), F.col("tokens").alias("_b"))
    both = F.size(F.array_intersect("_a", "_b"))
    return (pairs.join(left, "a").join(right, "b")
            .withColumn("_n", both)
            .filter(F.col("_n") * (rule.den + rule.num) >= rule.num * (F.size("_a") + F.size("_b")))
            .select("a", "b"))


def _even(flagged: Column) -> Column:
    return flagged.bitwiseAND(F.lit(-2))


def _fits(a: Column, b: Column, rule: Rule) -> Column:
    """Sizes that a link allows."""
    return F.greatest(a, b) * rule.num <= F.least(a, b) * rule.den


def differ_within(n: Column, par: Column, m: Column, other: Column, rule: Rule) -> Column:
    """Whether the parities of sets of n and m tokens allow a link: linked sets
    differ in at most (den - num) / (num + den) of both sets' tokens."""
    apart = sum((F.bit_count(par[i].bitwiseXOR(other[i])) for i in range(PARITIES // 64)), F.lit(0))
    return apart * (rule.num + rule.den) <= (n + m) * (rule.den - rule.num)


def _may_link(n: Column, par: Column, m: Column, other: Column, rule: Rule) -> Column:
    """Whether sizes and parities allow a link."""
    return _fits(n, m, rule) & differ_within(n, par, m, other, rule)


def _may_miss(n: Column, rule: Rule) -> Column:
    """Tokens that the smaller of two linked sets can lack in the other."""
    return (n - F.ceil(F.lit(2 * rule.num) * n / F.lit(float(rule.num + rule.den)) - F.lit(1e-9))).cast("int")


def _may_exceed(n: Column, rule: Rule) -> Column:
    """Tokens that the larger of two linked sets can have besides the other's."""
    return (n - F.ceil(F.lit(rule.num) * n / F.lit(float(rule.den)) - F.lit(1e-9))).cast("int")


def _hub_pairs(firsts: DataFrame, sizes: DataFrame, rule: Rule) -> DataFrame:
    """(a, b): sets with the hubs of their signatures, as far as they may link."""
    signed = firsts.select("k", F.posexplode("sig").alias("order", "s")).distinct()
    ranked = signed.join(sizes.select("k", (F.col("met") / F.greatest("nq", F.lit(1))).alias("met")), "k")
    hubs = ranked.groupBy("order", "s").agg(F.max(F.struct("met", "k")).alias("h"), F.count("*").alias("c"))
    pairs = (signed.join(hubs.filter("c > 1").select("order", "s", F.col("h.k").alias("b")), ["order", "s"])
             .select(F.col("k").alias("a"), "b").filter("a <> b").distinct())
    a, b = (sizes.select(F.col("k").alias(c), F.col("n").alias(f"n{c}"), F.col("par").alias(f"p{c}")) for c in ("a", "b"))
    return (pairs.join(a, "a").join(b, "b")
            .filter(_may_link(F.col("na"), F.col("pa"), F.col("nb"), F.col("pb"), rule)).select("a", "b"))


def _by_whole_sets(sharing: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    """Pairs (a, b) to compare for the sets of ``sharing`` (k, g, n, par) that are
    marked as ``unclear``: a has one of its rarest tokens, as many as it may miss and
    one more, in common with the rarest of b.

    In one order of all tokens the first token of a link's overlap is among
    these of both sets, so no link is lost.  Tokens of one group only are misses
    of either set from the start.
    """
    cells = land(sets.join(sharing.select("k", "g"), "k").select("k", "g", F.explode("tokens").alias("token")), "whole-cells")
    often = (cells.groupBy("token").agg(F.min("g").alias("x"), F.max("g").alias("y"), F.count("*").alias("sets"))
             .filter("x <> y").select("token", "sets"))
    known = cells.select("k", "token").join(often, "token")
    ranked = (known.withColumn("turn", F.row_number().over(Window.partitionBy("k").orderBy("sets", "token")))
              .withColumn("seen", F.count("*").over(Window.partitionBy("k")))
              .join(sharing, "k").withColumn("lone", F.col("n") - F.col("seen")))
    n, turn, lone = F.col("n"), F.col("turn"), F.col("lone")
    ranked = ranked.select("k", "g", "n", "par", "token", (F.col("unclear") & (turn <= _may_miss(n, rule) - lone + 1)).alias("asks"),
                           (turn <= _may_exceed(n, rule) - lone + 1).alias("holds")).filter("asks OR holds")
    ranked = land(ranked, "whole-ranked")
    asked, held = (ranked.filter(which).select("token", *[F.col(c).alias(c + end) for c in ("k", "g", "n", "par")])
                   for which, end in (("asks", "a"), ("holds", "b")))
    return (asked.join(held, (asked.token == held.token) & (F.col("ga") != F.col("gb")) & (F.col("na") <= F.col("nb"))
                       & _may_link(F.col("na"), F.col("para"), F.col("nb"), F.col("parb"), rule))
            .select(F.col("ka").alias("a"), F.col("kb").alias("b")).distinct())


def links(docs: DataFrame, sketches: DataFrame, rule: Rule, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(a, b): links between different sets (by k) that connect all linked sets.

    Sets that links with hubs connect are not compared again; all other pairs
    come from opening the groups that reach the bound.
    """
    firsts = sketches.filter(F.size("sig") > 0)

    # tokens of at least two sets
    cells = firsts.select(F.posexplode("low").alias("at", "token"), "k", "nq").select(
        "token", F.col("k").bitwiseOR((F.col("at") < F.col("nq")).cast("long")).alias("f"))
    shared = (cells.groupBy("token").agg(F.min(_even(F.col("f"))).alias("x"), F.max(_even(F.col("f"))).alias("y"))
              .filter("x <> y").select("token"))
    hits = land(cells.join(shared, "token").distinct(), "hits")
    asks = F.col("f") != _even(F.col("f"))
    met = hits.filter(asks).groupBy(_even(F.col("f")).alias("k")).agg(F.count("*").alias("met"))
    sizes = sketches.filter("k IS NOT NULL").groupBy("k").agg(
        F.min("row").alias("row"), F.first("n").alias("n"), F.max("nq").alias("nq"), F.first("par", True).alias("par"))
    sizes = land(sizes.join(met, "k", "left").fillna(0, ["met"]), "set-sizes")

    # groups: what links with hubs connect
    hub_pairs = land(_hub_pairs(firsts, sizes, rule), "hub-pairs")
    near_hub = land(_linked(hub_pairs, _sets_of(docs, hub_pairs, sizes, rule, text, doc_id), rule), "hub-links")
    grouped = components(near_hub).select(F.col("node").alias("k"), F.col("component").alias("g"))
    sizes = land(sizes.join(grouped, "k", "left").withColumn("g", F.coalesce("g", "k")), "set-groups")

    # the sets with few enough tokens in no other group
    need = F.greatest(F.lit(1), F.col("nq") - _may_miss(F.col("n"), rule))
    hits = hits.join(sizes.filter(F.col("met") >= need).select("k", F.lit(True).alias("may_ask")),
                     _even(F.col("f")) == F.col("k"), "left").select("token", "f", F.coalesce("may_ask", F.lit(False)).alias("may_ask"))
    held = hits.join(sizes.select(F.col("k"), "g"), _even(F.col("f")) == F.col("k")).select("token", "f", "g", "may_ask")
    between = (held.groupBy("token").agg(F.min("g").alias("x"), F.max("g").alias("y"), F.max("may_ask").alias("any"))
               .filter("x <> y AND any").select("token"))
    held = land(held.join(between, "token").select("token", _even(F.col("f")).alias("k"), "g", (asks & F.col("may_ask")).alias("asks")),
                "held")
    asked = held.filter("asks").select("token", "k")
    asking = land(asked.groupBy("k").agg(F.count("*").alias("found")).join(sizes, "k")
                  .withColumn("need", need).filter("found >= need").select("k", "g", "n", "par", "found", "need"), "asking")
    asked = land(asked.join(asking, "k").select("token", "k", "g", "n", "found", "need"), "asked")

    # the matrix for the tokens that are asked
    used = asked.select("token").distinct()
    matrix = land(held.join(used, "token").join(sizes.select("k", "n"), "k").groupBy("token", "g")
                  .agg(F.min("n").alias("least"), F.max("n").alias("most")), "matrix")
    groups_of = matrix.groupBy("token").agg(F.count("*").alias("groups"))

    # per set: all tokens up to COMMON groups; a group must have all of them but
    # those that it may miss.  Where that bound says nothing, as most tokens of
    # a set are common ones, the set is decided by its whole set below
    counted = asked.join(groups_of, "token").withColumn("rare", (F.col("groups") <= COMMON).cast("int"))
    per_set = land(counted.groupBy("k").agg(F.first("found").alias("found"), F.first("need").alias("need"),
                                            F.sum("rare").alias("rares"))
                   .select("k", (F.col("need") - (F.col("found") - F.col("rares"))).alias("least_hits")), "per-set")
    lookups = counted.filter("rare = 1").join(per_set.filter("least_hits > 0"), "k")
    room = (F.col("most") >= F.col("n")) & (F.col("least") * rule.num <= F.col("n") * rule.den)
    reached = (lookups.withColumnRenamed("g", "own").join(matrix, "token").filter((F.col("g") != F.col("own")) & room)
               .groupBy("k", "g").agg(F.count("*").alias("hits"), F.first("least_hits").alias("least_hits"))
               .filter("hits >= least_hits").select("k", "g").join(asking.select("k", "n", "par"), "k"))
    members = sizes.select("g", F.col("k").alias("b"), F.col("n").alias("nb"), F.col("par").alias("pb"))
    opened = land(reached.join(members, "g")
                  .filter((F.col("n") <= F.col("nb")) & _may_link(F.col("n"), F.col("par"), F.col("nb"), F.col("pb"), rule))
                  .select(F.col("k").alias("a"), "b").distinct(), "opened")

    # sets of common tokens, and all that share enough tokens with one of them.  A partner
    # shares at least as many as a set of its size (or down to the threshold's
    # part of it) needs: sizes in steps of the threshold
    unclear = per_set.filter("least_hits <= 0").select("k")
    theirs = asked.join(unclear, "k", "left_semi").select("token").distinct()
    steps = F.floor(F.log(F.col("n").cast("double")) / F.lit(max(1e-9, math.log(rule.den / rule.num)))).cast("int")
    fewest = (asking.join(unclear, "k").select("need", F.explode(F.sequence(steps, steps + 2)).alias("step"))
              .groupBy("step").agg(F.min("need").alias("fewest")))
    partners = (held.join(theirs, "token").groupBy("k").agg(F.count("*").alias("c"))
                .join(sizes, "k").withColumn("step", steps).join(fewest, "step").filter("c >= fewest"))
    sharing = land(partners.select("k").unionByName(unclear).distinct().join(sizes.select("k", "g", "n", "par"), "k")
                   .join(unclear.withColumn("unclear", F.lit(True)), "k", "left").fillna(False, ["unclear"]), "sharing")

    # whole sets of all that are compared
    sets = _sets_of(docs, opened.unionByName(sharing.select(F.col("k").alias("a"), F.col("k").alias("b"))),
                    sizes, rule, text, doc_id)
    pairs = land(opened.unionByName(_by_whole_sets(sharing, sets, rule)).distinct(), "pairs")
    return near_hub.unionByName(_linked(pairs, sets, rule))


def _sets_of(docs: DataFrame, pairs: DataFrame, sizes: DataFrame, rule: Rule, text: str, doc_id: str) -> DataFrame:
    """(k, tokens) of all sets in the pairs (a, b)."""
    wanted = land(pairs.select(F.explode(F.array("a", "b")).alias("k")).distinct()
                  .join(sizes, "k").select("row", "k", F.lit(True).alias("picked")), "wanted")
    return _whole_sets(docs, wanted, rule, text, doc_id)


def join_components(docs: DataFrame, rule: Rule, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """row, text_hash, doc_id, n_shingles, component, component_id for every
    document; ``component`` tells components apart where ids repeat.

    Two documents link when their sets' Jaccard similarity reaches the rule;
    component_id is the smallest doc_id that can be reached.  Documents without
    words (or NULL) have 0 shingles, link with nothing and keep their own id.
    Repeated rows are rows of the same component; a NULL id counts in no
    minimum and is the component only where no other id is there.
    """
    sketches = land(sketched(docs, rule, text, doc_id), "sketches")
    nodes = components(links(docs, sketches, rule, text, doc_id))
    ids = sketches.filter("k IS NOT NULL").groupBy("k").agg(F.min("doc_id").alias("least"))
    ids = ids.join(nodes, ids.k == nodes.node, "left").select("k", "least", F.coalesce("component", "k").alias("c"))
    ids = land(ids, "set-ids")
    whole = ids.groupBy("c").agg(F.min("least").alias("component_id"))
    named = ids.join(whole, "c").select("k", "component_id", F.col("c").alias("component"))
    return (sketches.select("row", "text_hash", "doc_id", F.col("n").alias("n_shingles"), "k").join(named, "k", "left")
            .select("row", "text_hash", "doc_id", "n_shingles", "component",
                    F.when(F.col("k").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")))
