"""Near-duplicate components by HyperMinHash sketches.

A document's set is its word shingles.  The sketch deals the shingles' hashes
into ``BUCKETS`` buckets and keeps, of each bucket's smallest value, the count
of leading zeros and the ``MANTISSA`` bits after the leading one: 16 bits a
bucket, whatever the size of the text.

1. *Bands.*  ``ROWS`` neighbouring registers are one 64-bit band key (registers
   of empty buckets are borrowed from another bucket in a fixed random order,
   so small sets have full bands, too).  Sets that share a band key meet the
   hub of that key, a member with most shared bands, never each other; what is in
   another component than a hub meets further ones for a few turns.
2. *Estimate.*  The share of equal registers, less the collisions that
   registers of that many values have by chance, estimates the Jaccard
   similarity; pairs more than ``SIGMAS`` standard errors below the rule are done.
3. *Verification.*  The others are compared by their whole sets.
4. *Rest.*  Band keys whose members are in one component by now are done.  The
   other members keep the smallest hashes of their whole sets (all of a small
   set).  A set can only link with another component if that component's sets
   hold all its tokens but those that a link may miss; one that fails this is
   done.  Of the few that are left, two sets of different components meet on the
   rarest such tokens of both: in one order of all tokens, rarest first, linked
   sets share a token among the first that either may miss, and one more.  They
   are a pair only if what no other component holds of either leaves room for a
   link, and if the parities of their whole sets differ in no more bits than
   linked sets can differ in tokens (an exact bound, see the n-gram join); pairs go
   through steps 2 and 3.

Equal sets are one set from the start (128-bit hashes: an accidental equality
among 30 billion sets has a chance of e-18).  Two sets exactly at the threshold
of 0.85 share no band with a chance of (1 - 0.85^4)^32 = 5e-11, and fall below
the estimate's bound with one of about 3e-7; sets that are closer, less.  Sets of
more than ``KEPT`` tokens meet in step 4 by half of the hash range, larger ones by
a quarter, and so on; there a link is lost if the sample holds six standard
errors more misses than its share (below 1e-7 for a pair at the threshold that
steps 1 to 3 have not connected).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tessera.llm.common import land, prepare_python
from tessera.llm.graph import components
from tessera.llm.ngram_join import Rule, differ_within, parities, shingles

INDEX = 7
BUCKETS = 1 << INDEX
MANTISSA = 10
ROWS = 4                     # registers of a band: 4 x 16 bits
BANDS = BUCKETS // ROWS
SIGMAS = 5.0
TURNS = 2                    # hubs drawn per band; they spare step 4 pairs, results do not depend on them
KEPT = 256                   # tokens; larger sets are sampled in step 4
_ZEROS = 53                  # leading zeros are told apart up to here
_BORROW = np.array([np.random.RandomState(j).permutation(BUCKETS) for j in range(BUCKETS)])
_BAND_SEED = np.arange(BANDS, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)


def registers(tokens: np.ndarray) -> np.ndarray:
    """16-bit registers of a sorted array of 64-bit hashes; 0 for an empty bucket."""
    out = np.zeros(BUCKETS, dtype=np.uint16)
    at, first = np.unique(tokens >> np.uint64(64 - INDEX), return_index=True)
    rest = tokens[first] << np.uint64(INDEX)
    # the top 53 bits are exact as a double, so its exponent is their length
    length = np.frexp((rest >> np.uint64(11)).astype(np.float64))[1]
    zeros = (_ZEROS - length).astype(np.uint64)
    after = np.where(zeros >= 63, np.uint64(0), rest << (zeros + np.uint64(1)))
    out[at.astype(np.int64)] = ((zeros + np.uint64(1)) << np.uint64(MANTISSA)) | (after >> np.uint64(64 - MANTISSA))
    return out


def band_keys(regs: np.ndarray) -> np.ndarray:
    """A signed 64-bit key for each band; empty buckets borrow a register."""
    full = regs != 0
    if not full.all():
        empty = np.flatnonzero(~full)
        lender = _BORROW[empty, full[_BORROW[empty]].argmax(axis=1)]
        regs = regs.copy()
        regs[empty] = regs[lender]
    v = np.ascontiguousarray(regs).view(np.uint64) ^ _BAND_SEED
    v = (v ^ (v >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return ((v ^ (v >> np.uint64(29))) + _BAND_SEED).view(np.int64)


def chance_collisions(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Registers that two disjoint sets of n and m elements have in common by chance."""
    low = 2.0 ** -(INDEX + np.arange(1, 64, dtype=np.float64))    # smallest value with so many zeros

    def within(k):
        k = np.asarray(k, dtype=np.float64)[:, None]
        return np.exp(k * np.log1p(-low)) - np.exp(k * np.log1p(-2 * low))

    return BUCKETS * 2.0 ** -MANTISSA * (within(n) * within(m)).sum(axis=1)


def estimates(ra: np.ndarray, rb: np.ndarray, n: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Jaccard estimates of register rows, and the buckets that they rest on."""
    used = ((ra != 0) | (rb != 0)).sum(axis=1)
    same = ((ra == rb) & (ra != 0)).sum(axis=1)
    return np.clip((same - chance_collisions(n, m)) / np.maximum(used, 1), 0.0, 1.0), used


def _key(tokens: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(tokens.tobytes())


def _rows(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    """row (the id; for a NULL id a hash of the text), doc_id, text."""
    return docs.select(F.coalesce(F.col(doc_id).cast("long"), F.xxhash64(F.col(text))).alias("row"),
                       F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))


def sketched(docs: DataFrame, rule: Rule, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Per document: row, doc_id, n (set size), k (hash of the set; NULL if empty),
    regs (its registers), bands and par (parities); the last three with a set's first document
    in a task only, so copies add nothing to what follows."""
    prepare_python(docs.sparkSession)

    def run(batches):
        words: dict[bytes, int] = {}
        seen: set[bytes] = set()
        for b in batches:
            n, k, regs, bands, par = [], [], [], [], []
            for t in b.column(2):
                s = shingles(t.as_py(), rule.width, words)
                key = _key(s) if len(s) else None
                n.append(len(s)), k.append(key)
                if key is None or key in seen:
                    regs.append(None), bands.append(None), par.append(None)
                    continue
                seen.add(key)
                r = registers(s)
                regs.append(r.tobytes()), bands.append(band_keys(r)), par.append(parities(s))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(n, pa.int64()), pa.array(k, pa.binary()),
                 pa.array(regs, pa.binary()), pa.array(bands, pa.list_(pa.int64())), pa.array(par, pa.list_(pa.int64()))],
                names=["row", "doc_id", "n", "k", "regs", "bands", "par"])

    return _rows(docs, text, doc_id).mapInArrow(
        run, "row long, doc_id long, n long, k binary, regs binary, bands array<long>, par array<long>")


def _likely(pairs: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    """The pairs (a, b) whose estimate does not rule a link out."""
    least = rule.num / rule.den

    def side(name: str) -> DataFrame:
        return sets.select(F.col("sid").alias(name), F.col("n").alias(f"n{name}"), F.col("regs").alias(f"r{name}"))

    def run(batches):
        for b in batches:
            n, m = (b.column(c).to_numpy(zero_copy_only=False) for c in (2, 3))
            ra, rb = (np.frombuffer(b"".join(b.column(c).to_pylist()), dtype=np.uint16).reshape(-1, BUCKETS) for c in (4, 5))
            found, used = estimates(ra, rb, n, m)
            keep = found >= least - SIGMAS * np.sqrt(least * (1 - least) / np.maximum(used, 1))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], names=["a", "b"]).filter(pa.array(keep))

    return (pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "na", "nb", "ra", "rb")
            .mapInArrow(run, "a long, b long"))


def _fits(n: Column, m: Column, rule: Rule) -> Column:
    """Set sizes that a link allows."""
    return F.least(n, m) * rule.den >= F.greatest(n, m) * rule.num


def _whole(docs: DataFrame, wanted: DataFrame, rule: Rule, text: str, doc_id: str, kept=None) -> DataFrame:
    """``wanted`` (row, k, other columns) plus the tokens of its sets, read from the texts.

    Spark broadcasts ``wanted`` while it is small; beyond that, its runtime
    filter keeps most other texts from being shuffled.  ``kept`` gives
    the halvings of the hash range, by set size, beyond which tokens are left out.
    """
    others = [c for c in wanted.columns if c not in ("row", "k")]
    texts = _rows(docs, text, doc_id).select("row", "text").join(wanted, "row").select("k", "text", *others)

    def run(batches):
        words: dict[bytes, int] = {}
        for b in batches:
            right, sets, last, s = [], [], None, None
            for k, t in zip(b.column(0).to_pylist(), b.column(1)):
                t = t.as_py()
                if t != last:               # rows of one text often follow each other
                    last, s = t, shingles(t, rule.width, words)
                same = bool(len(s)) and _key(s) == k       # else another text with this id
                right.append(same)
                if same:
                    halvings = kept(len(s)) if kept else 0
                    sets.append((s[:np.searchsorted(s, np.uint64(1 << (64 - halvings)))] if halvings else s).view(np.int64))
            rest = b.select(list(range(2, b.num_columns))).filter(pa.array(right, pa.bool_()))
            yield pa.RecordBatch.from_arrays([*rest.columns, pa.array(sets, pa.list_(pa.int64()))],
                                             names=[*others, "tokens"])

    types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in wanted.schema.fields if f.name in others)
    return texts.mapInArrow(run, f"{types}, tokens array<long>")


def _confirmed(docs: DataFrame, pairs: DataFrame, sets: DataFrame, rule: Rule, text: str, doc_id: str) -> DataFrame:
    """The pairs (a, b) that link by their whole sets.

    The tokens of a travel to those of b once; a hub that many sets are held
    against is a skewed join key, which Spark splits.
    """
    of = sets.select("sid", "row", "k")
    asking = pairs.join(of.withColumnRenamed("sid", "a"), "a").select("row", "k", "a", "b")
    hubs = pairs.select(F.col("b").alias("sid")).distinct().join(of, "sid").select("row", "k", F.col("sid").alias("b"))
    left = _whole(docs, asking, rule, text, doc_id).withColumnRenamed("tokens", "ta")
    right = _whole(docs, hubs, rule, text, doc_id).groupBy("b").agg(F.any_value("tokens").alias("tb"))

    def run(batches):
        for b in batches:
            a, h = b.column(2), b.column(3)
            keep = []
            for x, y in zip(a, h):
                x, y = x.values.to_numpy(), y.values.to_numpy()
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(rule.den * both >= rule.num * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return (left.join(right, "b").select("a", "b", "ta", "tb").mapInArrow(run, "a long, b long").distinct())


def _shared_bands(sets: DataFrame) -> DataFrame:
    """(band, sid, n) of the bands of several sets."""
    cells = sets.select(F.explode("bands").alias("band"), "sid", "n")
    several = cells.groupBy("band").agg(F.count("*").alias("c")).filter("c > 1").select("band")
    return land(cells.join(several, "band"), "hmh-bands")


def _hub_pairs(shared: DataFrame, labels: DataFrame, rule: Rule, turn: int = 0) -> DataFrame:
    """(a, b): sets with those hubs of their bands that are in other components.

    The hub of a band is its member with most shared bands, the middle of a
    family; which of equal ones it is changes with the turn.
    """
    rank = shared.groupBy("sid").agg(F.count("*").alias("bands"))
    hubs = (shared.join(rank, "sid").groupBy("band")
            .agg(F.max(F.struct("bands", F.xxhash64("sid", F.lit(turn)).alias("draw"), "n", "sid")).alias("h"))
            .select("band", F.col("h.sid").alias("hub"), F.col("h.n").alias("m"))
            .join(labels.select(F.col("sid").alias("hub"), F.col("label").alias("theirs")), "hub"))
    return (shared.join(labels, "sid").join(hubs, "band")
            .filter((F.col("label") != F.col("theirs")) & _fits(F.col("n"), F.col("m"), rule))
            .select(F.col("sid").alias("a"), F.col("hub").alias("b")).distinct())


def _halvings(n: int) -> int:
    """How often the hash range is halved for a set of n tokens."""
    k = 0
    while n > KEPT << k:
        k += 1
    return k


def _halvings_of(n: Column) -> Column:
    return F.aggregate(F.sequence(F.lit(0), F.lit(40)), F.lit(0),
                       lambda a, k: a + (n > F.lit(float(KEPT)) * F.pow(F.lit(2.0), k)).cast("int"))


def _between_components(docs: DataFrame, shared: DataFrame, labels: DataFrame, sets: DataFrame, rule: Rule,
                        text: str, doc_id: str) -> DataFrame:
    """(a, b): pairs of different components that may still link (step 4)."""
    marked = shared.join(labels, "sid")
    open_ = marked.groupBy("band").agg(F.min("label").alias("x"), F.max("label").alias("y")).filter("x <> y").select("band")
    rest = land(marked.join(open_, "band").select("sid", "label").distinct(), "hmh-open")
    if rest.isEmpty():
        return rest.select(F.col("sid").alias("a"), F.col("sid").alias("b")).limit(0)

    wanted = rest.join(sets.select("sid", "row", "k", "n"), "sid").select("row", "k", "sid", "label", "n")
    cells = land(_whole(docs, wanted, rule, text, doc_id, _halvings)
                 .select("sid", "label", "n", F.explode("tokens").alias("token")).distinct(), "hmh-tokens")
    # tokens that sets of several components hold
    met = (cells.groupBy("token").agg(F.min("label").alias("x"), F.max("label").alias("y"), F.count("*").alias("sets"))
           .filter("x <> y").select("token", "sets"))
    known = land(cells.join(met, "token", "left").withColumn("own", _halvings_of(F.col("n"))), "hmh-met")

    # a pair meets in the range of its larger set: a set also looks there if that is smaller than its own
    n, own, cut = F.col("n"), F.col("own"), F.col("cut")
    ranges = F.array_distinct(F.array(own, _halvings_of(F.floor(n * rule.den / F.lit(float(rule.num)) + F.lit(1e-9)))))
    within = (cut == 0) | (F.expr("shiftrightunsigned(token, 64 - cut)") == 0)
    cut_cells = known.select("*", F.explode(ranges).alias("cut")).filter(within)
    total, found = F.count("*").over(Window.partitionBy("sid", "cut")), F.count("sets").over(Window.partitionBy("sid", "cut"))

    def spare(most: Column, part: float) -> Column:
        """Tokens of other components that a set may miss besides its lone ones."""
        share = F.col("t") * part
        return F.when(cut == 0, most).otherwise(F.least(most, F.ceil(share + 6 * F.sqrt(share) + 3))) - (F.col("t") - F.col("f"))

    # as the smaller of a pair, and as the larger, which has at least num / den of itself in common
    smaller = spare(n - F.ceil(F.lit(2 * rule.num) * n / F.lit(float(rule.num + rule.den)) - F.lit(1e-9)), (rule.den - rule.num) / (rule.num + rule.den))
    larger = spare(n - F.ceil(F.lit(rule.num) * n / F.lit(float(rule.den)) - F.lit(1e-9)), (rule.den - rule.num) / rule.den)
    # at most so many tokens of a set can be in sets of other components
    alone = (F.col("t") - F.col("f")) / F.col("t") - F.when(cut > 0, 6 * F.sqrt(F.col("t") - F.col("f")) / F.col("t")).otherwise(F.lit(0.0))
    room = n - F.floor(F.greatest(F.lit(0.0), n * alone) + F.lit(1e-9))
    turn = F.row_number().over(Window.partitionBy("sid", "cut").orderBy(F.col("sets").asc_nulls_last(), "token"))
    ranked = land(cut_cells.withColumns({"t": total, "f": found, "turn": turn}).filter("sets IS NOT NULL")
                  .withColumns({"ask": F.col("turn") <= smaller + 1, "hold": (cut == own) & (F.col("turn") <= larger + 1), "room": room})
                  .filter("ask OR hold").join(rest.select("sid").join(sets.select("sid", "par"), "sid"), "sid")
                  .select("sid", "label", "n", "par", "cut", "token", "ask", "hold", "room"), "hmh-ranked")

    def side(which: str, name: str) -> DataFrame:
        return ranked.filter(which).select("cut", "token", F.struct("n", "sid").alias(name),
                                           F.col("label").alias(f"l{name}"), F.col("room").alias(f"r{name}"),
                                           F.col("par").alias(f"p{name}"))

    na, nb = F.col("a.n"), F.col("b.n")
    may = ((F.least("ra", "rb") * (rule.num + rule.den) >= (na + nb) * rule.num) & (nb * rule.num <= na * rule.den)
           & differ_within(na, F.col("pa"), nb, F.col("pb"), rule))
    asks, holds = side("ask", "a"), side("hold", "b")
    return land(asks.join(holds, (asks.cut == holds.cut) & (asks.token == holds.token) & (F.col("la") != F.col("lb"))
                          & (F.col("a") < F.col("b")) & may)
                .select(F.col("a.sid").alias("a"), F.col("b.sid").alias("b")).distinct(), "hmh-rest")


def near_components(docs: DataFrame, rule: Rule, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, n_shingles, component and component_id of every document.

    Documents link when the Jaccard similarity of their sets reaches the rule;
    ``component_id`` is the smallest doc_id that links reach, ``component`` tells
    components apart where ids repeat.  Documents without words (or NULL) have
    0 shingles, link with nothing and keep their own id.  Repeated rows are rows
    of one component; a NULL id is in no minimum.  Other columns are not read.
    """
    sketches = land(sketched(docs, rule, text, doc_id), "hmh-sketches")
    sets = land(sketches.filter("k IS NOT NULL").groupBy("k").agg(
        F.min("row").alias("row"), F.first("n").alias("n"), F.first("regs", True).alias("regs"),
        F.first("bands", True).alias("bands"), F.first("par", True).alias("par"), F.min("doc_id").alias("least"))
        .withColumn("sid", F.monotonically_increasing_id()), "hmh-sets")

    shared = _shared_bands(sets)
    labels = sets.select("sid", F.col("sid").alias("label"))

    def merged(pairs: DataFrame) -> DataFrame | None:
        """``labels`` after steps 2 and 3 on the pairs; None if none links."""
        likely = land(_likely(pairs, sets, rule), "hmh-likely")
        if likely.isEmpty():
            return None
        linked = land(_confirmed(docs, likely, sets, rule, text, doc_id), "hmh-linked")
        if linked.isEmpty():
            return None
        ends = [labels.select(F.col("sid").alias(c), F.col("label").alias(f"l{c}")) for c in ("a", "b")]
        more = components(linked.join(ends[0], "a").join(ends[1], "b").select(F.col("la").alias("a"), F.col("lb").alias("b")))
        return land(labels.join(more.select(F.col("node").alias("label"), "component"), "label", "left")
                    .select("sid", F.coalesce("component", "label").alias("label")), "hmh-labels")

    for turn in range(TURNS):
        further = merged(_hub_pairs(shared, labels, rule, turn))
        if further is None:
            break
        labels = further
    further = merged(_between_components(docs, shared, labels, sets, rule, text, doc_id))
    labels = labels if further is None else further

    named = land(sets.select("k", "sid", "least").join(labels, "sid"), "hmh-named")
    whole = named.groupBy("label").agg(F.min("least").alias("component_id"))
    told = named.join(whole, "label").select("k", F.col("label").alias("component"), "component_id")
    return (sketches.select("doc_id", F.col("n").alias("n_shingles"), "k").join(told, "k", "left")
            .select("doc_id", "n_shingles", "component",
                    F.when(F.col("k").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")))


def kept_documents(docs: DataFrame, rule: Rule = Rule(width=5, num=85, den=100)) -> DataFrame:
    """doc_id, n_shingles, component_id and kept (the document names its component)."""
    found = near_components(docs, rule).drop("component")
    return found.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))
