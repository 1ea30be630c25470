"""Document fingerprints by order MinHash.

A text is read as words with the white space after them; a word of more than
PIECE code points is read as all its overlapping runs of PIECE, one from each
code point, so that an insertion changes only the runs around it.  A k-mer is K
runs in a row.  A k-mer's occurrences are numbered, so the
second "a b c" is not the first.  The numbered k-mers are dealt to BINS bins by
hash; each bin keeps its PICK smallest, puts them back into text order and
hashes the tuple.  The signature is the list of tuples: two texts agree in a
bin only if they share its smallest k-mers in the same order, which makes the
share of equal tuples sensitive to edit distance, moved passages included.

Everything is DataFrame functions: a k-mer is packed as (bin, hash, place) into
one long, so that one sort of longs yields the bins, the smallest and the
repetitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tessera.llm.common import land

PIECE = 8
K = 3
BINS = 32
PICK = 2
#: Layout of the packed long: 5 bits of bin and 32 of hash, then the place.
#: Places beyond 2^26 runs (at least as many code points) count as the last one.
PLACE_BITS = 26
KEY_BITS = 37
RANGES = 128                 # ranges of ids whose documents are put in order together


def _packed(h: Column, place: Column) -> Column:
    key = F.shiftrightunsigned(h, 64 - KEY_BITS)
    return F.shiftleft(key, PLACE_BITS).bitwiseOR(F.least(place.cast("long"), F.lit((1 << PLACE_BITS) - 1)))


def _key(packed: Column) -> Column:
    return F.shiftright(packed, PLACE_BITS)


def _bin(packed: Column) -> Column:
    return F.shiftright(packed, PLACE_BITS + KEY_BITS - (BINS - 1).bit_length())


def signed(docs: DataFrame, text: str, out: str) -> DataFrame:
    """``docs`` plus ``out``: array of longs, one per bin with k-mers: the bin's
    number above 32 bits of the tuple's hash.

    NULL and empty texts have no k-mers and an empty signature; a text of fewer
    than K runs is one k-mer.
    """
    # the run is looked at ahead; inside a long word a single code point is passed
    run = rf"(?=(\S{{{PIECE}}}(?=\S)|\S{{1,{PIECE}}}\s*|\s+))(?:\S(?=\S{{{PIECE}}})|\S+\s*|\s+)"
    pieces = F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(run), F.lit(1))
    rows = docs.withColumn("_omh_h", F.transform(pieces, lambda p: F.xxhash64(p)))
    n = F.size("_omh_h")
    many = F.transform(F.slice("_omh_h", F.lit(1), F.greatest(n - (K - 1), F.lit(0))),
                       lambda h, i: _packed(F.xxhash64(h, F.get("_omh_h", i + 1), F.get("_omh_h", i + 2)), i))
    few = F.array(_packed(F.xxhash64(F.lit(K), F.get("_omh_h", F.lit(0)), F.coalesce(F.get("_omh_h", F.lit(1)), F.lit(0))),
                          F.lit(0)))
    rows = rows.withColumn("_omh_k", F.when(n == 0, F.array().cast("array<long>")).when(n < K, few).otherwise(many)).drop("_omh_h")
    # without NULL elements the sort of longs is a primitive one
    rows = rows.withColumn("_omh_k", F.sort_array("_omh_k"))
    again = F.exists(F.transform("_omh_k", lambda x, i: (i > 0) & (_key(x) == _key(F.get("_omh_k", i - 1)))), lambda x: x)
    powers = F.array(*[F.lit(1 << b) for b in range(PLACE_BITS, -1, -1)])

    def numbered(x: Column, i: Column) -> Column:
        # equal keys are neighbours: the number of an occurrence is the largest
        # distance to an equal key before it, found by powers of two
        before = F.aggregate(powers, F.lit(0), lambda c, s: F.when(
            (i - c - s >= 0) & (_key(F.get("_omh_k", i - c - s)) == _key(x)), c + s).otherwise(c))
        first = (i == 0) | (_key(F.get("_omh_k", i - 1)) != _key(x))
        place = x.bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
        return F.when(first, x).otherwise(_packed(F.xxhash64(_key(x), before), place))

    rows = rows.withColumn("_omh_k", F.when(again, F.sort_array(F.transform("_omh_k", numbered))).otherwise(F.col("_omh_k")))
    # the PICK smallest of each bin stay; then neighbours make up the tuples
    rows = rows.withColumn("_omh_k", F.filter("_omh_k", lambda x, i: (i < PICK) | (_bin(F.get("_omh_k", i - PICK)) != _bin(x))))

    def tuple_of(x: Column, i: Column) -> Column:
        after = F.get("_omh_k", i + 1)
        mask = F.lit((1 << PLACE_BITS) - 1)
        pair = F.when(x.bitwiseAND(mask) <= after.bitwiseAND(mask), F.xxhash64(_key(x), _key(after))).otherwise(
            F.xxhash64(_key(after), _key(x)))
        starts = (i == 0) | (_bin(F.get("_omh_k", i - 1)) != _bin(x))
        whole = F.when(_bin(after) == _bin(x), pair).otherwise(F.xxhash64(_key(x)))
        return F.when(starts, F.shiftleft(_bin(x), 32).bitwiseOR(F.shiftrightunsigned(whole, 32)))

    return rows.withColumn(out, F.filter(F.transform("_omh_k", tuple_of), lambda t: t.isNotNull())).drop("_omh_k")


def likeness(a: Column, b: Column) -> Column:
    """Equal tuples of two signatures over the bins that either fills; 1 if none."""
    both = F.size(F.array_intersect(a, b))
    bins = F.size(F.array_union(F.transform(a, lambda t: F.shiftright(t, 32)), F.transform(b, lambda t: F.shiftright(t, 32))))
    return F.when(bins == 0, F.lit(1.0)).otherwise(both / bins.cast("double"))


def text_of(signature: Column) -> Column:
    """A signature as a string: bin and tuple hash in hex, in order of the bins."""
    return F.array_join(F.transform(signature, lambda t: F.lower(F.hex(t))), " ")


KEY = ["k", "z", "h"]         # id (0 for NULL), whether it is NULL, hash of the text


def followers(ids: DataFrame) -> DataFrame:
    """``ids`` (KEY and others) plus next_k, next_z, next_h: the next document by
    descending id, NULL last, then h; after the last the first.

    Rows of one range of ids are put in order together; ranges are linked by
    their first rows (RANGES rows).
    """
    down = [F.col("z"), F.col("k").desc(), F.col("h")]
    here = Window.partitionBy("range").orderBy(*down)
    placed = land(ids.repartitionByRange(RANGES, *down).withColumn("range", F.spark_partition_id()), "id-ranges")
    led = placed.withColumn("next", F.lead(F.struct(*KEY)).over(here)).withColumn("_n", F.row_number().over(here))
    chain = Window.orderBy("range")
    firsts = placed.groupBy("range").agg(F.min(F.struct(F.col("z"), (-F.col("k")).alias("m"), F.col("h"))).alias("f"))
    first = F.struct((-F.col("f.m")).alias("k"), F.col("f.z").alias("z"), F.col("f.h").alias("h"))
    linked = firsts.select("range", F.coalesce(
        F.lead(first).over(chain),
        F.first(first).over(chain.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("onward"))
    return (led.join(F.broadcast(linked), "range")
            .withColumn("next", F.coalesce("next", "onward"))
            .select(*ids.columns, *[F.col(f"next.{c}").alias(f"next_{c}") for c in KEY]))


def document_fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited and near_next for every document.

    The edited text has the last third of the code points replaced by the first
    as many (or all) of the next document's.  Documents are ordered by
    descending id, NULL last, then by a hash of the text; rows that agree in id
    and text have one place in it, so they share the next document and give equal
    rows, as many as there are.  A NULL text counts as empty.

    Ids alone are put in order.  Texts move once to meet their place, and the
    part that replaces another document's end moves on to that document.
    """
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    base = base.select(F.coalesce("doc_id", F.lit(0)).alias("k"), F.col("doc_id").isNull().alias("z"),
                       F.xxhash64("text").alias("h"), "text", F.char_length("text").alias("n"))
    ids = base.groupBy(*KEY).agg(F.first("n").alias("n"), F.count("*").alias("copies"))
    order = land(followers(land(ids, "ids")), "id-order")
    one = Window.partitionBy(*KEY).orderBy(F.lit(1))
    # both uses below read the same columns, so they share one exchange
    whole = (signed(base.drop("n"), "text", "sig").withColumn("_n", F.row_number().over(one)).filter("_n = 1").drop("_n"))
    wanted = order.select(*[F.col(c).alias(f"for_{c}") for c in KEY], F.floor(F.col("n") / 3).cast("int").alias("want"), "copies",
                          *[F.col(f"next_{c}").alias(c) for c in KEY])
    heads = (wanted.join(whole.select(*KEY, "text", F.col("sig").alias("next_sig")), KEY)
             .select(*[F.col(f"for_{c}").alias(c) for c in KEY], F.substring("text", F.lit(1), F.col("want")).alias("head"),
                     "next_sig", "copies"))
    n = F.char_length("text")
    both = whole.join(heads, KEY).withColumn("n", n).withColumn(
        "edited", F.concat(F.substring("text", F.lit(1), n - F.floor(n / 3).cast("int")), F.col("head")))
    both = signed(both.select("k", "z", "n", "sig", "next_sig", "edited", "copies"), "edited", "edited_sig")
    results = both.select(
        F.when(~F.col("z"), F.col("k")).alias("doc_id"), F.col("n").cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        text_of(F.col("sig")).alias("fingerprint"), text_of(F.col("edited_sig")).alias("edited_fingerprint"),
        likeness(F.col("sig"), F.col("edited_sig")).alias("near_edited"),
        likeness(F.col("sig"), F.col("next_sig")).alias("near_next"), "copies")
    turn = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))
    return results.withColumn("copies", turn).drop("copies")
