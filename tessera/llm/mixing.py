"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Each source has a token budget.  A source whose budget is ``e`` and a bit times
its size contributes ``e`` complete epochs; the rest is a weighted sample
without replacement: every document draws an exponential key ``-ln(u) / weight``
and documents are taken in key order until their sizes fill the rest.

The order is not established by sorting a source in one task.  Keys map to
``BINS`` bins of the unit interval (``1 - u ** (1 / weight)``, which rises with
the key and, for weights of at least 1, never puts more than ``max weight``
times the average into one bin).  Sizes are summed per (source, bin) with
map-side combining, the prefix over bins finds the one bin of each source in
which the budget ends, and only that bin's documents are sorted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tessera.llm.common import WORD, land

BINS = 1 << 16
MAX_EPOCHS = 3
WEIGHTS = (5, 2, 1)
SEED = "mix-1"
MAX_QUALITY = 4.0


def word_count(text: str | Column) -> Column:
    """Words of a text; 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def text_quality(text: str | Column, size: str | Column) -> Column:
    """A sampling weight from 1 to 4: runs of three or more letters per word."""
    runs = F.coalesce(F.regexp_count(text, F.lit("[A-Za-z]{3,}")), F.lit(0)).cast("double")
    return F.lit(1.0) + 3.0 * F.least(F.lit(1.0), runs / F.greatest(F.col(size) if isinstance(size, str) else size,
                                                                      F.lit(1)).cast("double"))


def exponential_place(doc_id: Column, text: Column, weight: Column) -> Column:
    """``1 - u ** (1 / weight)``: orders documents as ``-ln(u) / weight`` does.

    ``u`` comes from an MD5 of seed, id and text, so it is the same in every
    run and every engine; weights are clipped to [1, MAX_QUALITY].
    """
    digest = F.md5(F.concat_ws("|", F.lit(SEED), F.coalesce(doc_id.cast("string"), F.lit("")),
                               F.md5(F.coalesce(text, F.lit("")).cast("binary"))).cast("binary"))
    whole = F.conv(F.substring(digest, 1, 12), 16, 10).cast("double")
    u = (whole + 1.0) / float((1 << 48) + 1)
    w = F.least(F.greatest(F.coalesce(weight, F.lit(1.0)), F.lit(1.0)), F.lit(MAX_QUALITY))
    return 1.0 - F.exp(F.log(u) / w)


def source_targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source, source_size) plus ``target``: one row per source.

    Sources by code point, NULL last, take ``weights`` in turn and share the
    total of all sizes; a target stops at ``max_epochs`` times its source's
    size and the excess is shared again by weight.  Sorted by the share of
    weight at which they stop, the stopped sources are a prefix, so the final
    share follows from running sums.  These windows see one row per source.
    """
    named = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(named) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn + 1).cast("int"))
    rows = sizes.withColumn("_w", weight).withColumn("_cap", F.col("source_size") * float(max_epochs))
    stop = Window.orderBy((F.col("_cap") / F.col("_w")), F.col("source").asc_nulls_last())
    before = stop.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(F.lit(1))
    rows = (rows
            .withColumn("_total", F.sum("source_size").over(whole).cast("double"))
            .withColumn("_rest", F.col("_total") - F.coalesce(F.sum("_cap").over(before), F.lit(0.0)))
            .withColumn("_free", F.sum("_w").over(whole) - F.coalesce(F.sum("_w").over(before), F.lit(0.0)))
            .withColumn("_level", F.col("_rest") / F.col("_free"))
            .withColumn("_stops", F.col("_cap") <= F.col("_level") * F.col("_w")))
    level = F.min(F.when(~F.col("_stops"), F.struct(F.col("_cap") / F.col("_w"), F.col("_level")))).over(whole)
    rows = rows.withColumn("_share", level.getField("_level"))
    target = F.when(F.col("_stops") | F.col("_share").isNull(), F.col("_cap")).otherwise(F.col("_share") * F.col("_w"))
    return rows.select("source", "source_size", target.alias("target"))


def mix(rows: DataFrame, weights: Sequence[float] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Decide how often each document is taken.

    ``rows`` has doc_id, source, size (long) and place (exponential_place).
    Adds source_size, target, copies (int) and taken (long: copies x size).
    The document in which a budget ends is taken if that brings the source
    nearer to its target.  Documents of size 0 fill nothing: they get the
    complete epochs, and the extra copy if they come before the end.  Equal
    rows (same id and text) share a place and are interchangeable.  A NULL
    source is a source of its own; without rows there is no result.
    """
    binned = rows.withColumn("_bin", F.least(F.floor(F.col("place") * BINS), F.lit(BINS - 1)).cast("int"))
    per_bin = land(binned.groupBy("source", "_bin").agg(F.sum("size").alias("_s")), "mix-bins")
    totals = per_bin.groupBy("source").agg(F.sum("_s").alias("source_size"))
    targets = source_targets(totals, weights, max_epochs)
    targets = targets.withColumn(
        "_epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
        .cast("int")).withColumn("_rest", F.col("target") - F.col("_epochs") * F.col("source_size"))
    up_to = Window.partitionBy("source").orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    ends = (per_bin.withColumn("_before", F.coalesce(F.sum("_s").over(up_to), F.lit(0)))
            .alias("b").join(targets.alias("t"), F.col("b.source").eqNullSafe(F.col("t.source")))
            .filter((F.col("_rest") > 0) & (F.col("_before") <= F.col("_rest")) & (F.col("_before") + F.col("_s") > F.col("_rest")))
            .select(F.col("t.source").alias("source"), F.col("_bin").alias("_end"), "_before"))
    plan = (targets.alias("t").join(ends.alias("e"), F.col("t.source").eqNullSafe(F.col("e.source")), "left")
            .select(F.col("t.source").alias("_source"), "source_size", "target", "_epochs", "_rest", "_end", "_before"))
    plan = land(plan, "mix-plan")
    planned = binned.join(plan, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    inside = F.col("_bin") == F.col("_end")
    clear = planned.filter(F.col("_end").isNull() | ~inside).withColumn(
        "_extra", F.coalesce((F.col("_bin") < F.col("_end")).cast("int"), F.lit(0)))
    order = Window.partitionBy("source").orderBy("place", "doc_id", "size")
    prefix = F.col("_before") + F.coalesce(
        F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    edge = (planned.filter(inside).withColumn("_at", prefix)
            .withColumn("_extra", (F.col("_at") + F.col("size") / 2.0 <= F.col("_rest")).cast("int")).drop("_at"))
    # past the document in which the budget ends, the start lies beyond the rest
    both = clear.unionByName(edge)
    return (both.withColumn("copies", F.col("_epochs") + F.col("_extra"))
            .withColumn("taken", F.col("copies") * F.col("size"))
            .drop("_bin", "_end", "_before", "_rest", "_epochs", "_extra", "place"))


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, source, size and place of every document, written once: the
    texts are read in one pass and not again for the second look."""
    sized = docs.select("doc_id", "source", "text", word_count("text").alias("size"))
    return land(sized.select(
        "doc_id", "source", "size",
        exponential_place(F.col("doc_id"), F.col("text"), text_quality("text", "size")).alias("place")), "mix-docs")


def mixed_documents(docs: DataFrame) -> DataFrame:
    """doc_id, source, size, source_size, target, copies and taken for all documents."""
    return mix(measured(docs))


def mixed_corpus(docs: DataFrame) -> DataFrame:
    """The mixed documents themselves: each row once per copy, none for 0.

    Texts stay where they were read; only documents of the bins in which a
    budget ends are moved.
    """
    sized = docs.select("doc_id", "source", F.col("text").alias("_text"), F.struct("*").alias("_row"),
                        word_count("text").alias("size"))
    rows = sized.select("doc_id", "source", "_row", "size",
                        exponential_place(F.col("doc_id"), F.col("_text"), text_quality("_text", "size")).alias("place"))
    return (mix(rows).filter("copies > 0")
            .select("_row", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("_copy")).select("_row.*"))
