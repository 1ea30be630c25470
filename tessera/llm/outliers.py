"""Quality rules: robust multivariate outliers per language and source.

Base statistics of a text are counted in its row.  They become a vector of
transformed statistics; for each (language, source) a minimum-covariance-
determinant estimate gives centre and scatter, and texts whose squared
Mahalanobis distance passes a bound are rejected.

The estimate follows FastMCD with a fixed start: distances from the group's
mean by its variances, then concentration steps that refit centre and scatter
on the ``part`` of the group that lies nearest, then two reweighting steps.  A
step is one aggregation (sums of the vector and its products, combined on the
map side), so a group may hold any share of the rows.  The limit of a step comes
from a histogram of distances (``LEVELS`` levels), which is exact in its counts
and the same in every run.  Matrices are factored by column expressions;
everything is DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tessera.llm.common import WORD, land

STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
GROUP = ("lang", "source")
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
PART = 0.75              # of a group, on which the scatter is smallest
STEPS = 3
LEVELS = 40              # histogram levels for each doubling of the distance
#: Variances that a dimension has at least: statistics that hardly vary in a
#: group (no symbols, no copied lines) would make any other value an outlier.
#: Dimensions that vary more keep their own variance.
FLOOR = (0.05, 0.004, 0.10, 0.10, 0.25)
#: Chi-squared quantiles of five degrees of freedom: 0.975 for reweighting, and
#: 1 - 1e-10 as the bound of rejection, as tails are heavier in texts.
CHI2_NEAR, CHI2_FAR = 12.833, 55.6
#: Makes the scatter of the nearest three quarters that of the whole (normal).
CONSISTENCY = 1.0 / 0.543
MIN_GROUP = 30           # rows; smaller groups take their language's estimate, or that of all rows


def base_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` plus n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words.

    All 0 for NULL.  A three-word window counts as repeated if its three words
    occur again as a window anywhere in the text; n_repeat_words is the number
    of words inside such windows.  Columns of these names are replaced.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    words = F.regexp_extract_all(t, F.lit(WORD), F.lit(0))
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(WORD))
    keep = [c for c in docs.columns if c not in STATS]
    base = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("_row"), F.transform(words, lambda w: F.xxhash64(w)).alias("_h"),
                       F.char_length(F.regexp_replace(t, r"[\x20\x09-\x0D]+", "")).cast("long").alias("word_chars"),
                       F.regexp_count(t, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
                       lines.alias("_l"))
    n = F.size("_h")
    windows = F.when(n < 3, F.array().cast("array<long>")).otherwise(F.transform(
        F.slice("_h", F.lit(1), F.greatest(n - 2, F.lit(0))),
        lambda h, i: F.xxhash64(h, F.get("_h", i + 1), F.get("_h", i + 2))))
    base = base.select(*[c for c in base.columns if c != "_l"], windows.alias("_w"), n.cast("long").alias("n_words"),
                       (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"))
    again = F.size("_w") > F.size(F.array_distinct("_w"))
    # sorted windows with their places: equal ones are neighbours
    placed = F.when(again, F.sort_array(F.transform("_w", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
    base = base.select(*[c for c in base.columns if c not in ("_h", "_w")], placed.alias("_p"))
    twice = F.filter("_p", lambda x, i: F.coalesce(F.get("_p", i - 1)["h"] == x["h"], F.lit(False))
                     | F.coalesce(F.get("_p", i + 1)["h"] == x["h"], F.lit(False)))
    starts = F.sort_array(F.transform(twice, lambda x: x["i"]))
    base = base.select(*[c for c in base.columns if c != "_p"], starts.alias("_s"))
    covered = F.aggregate(F.transform("_s", lambda s, i: F.least(
        F.lit(3), F.coalesce(F.get("_s", i + 1) - s, F.lit(3)))), F.lit(0).cast("long"), lambda a, x: a + x)
    return base.select("_row.*", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                       F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"))


def base_failed() -> Column:
    """Too short, or mostly repeated."""
    return (F.col("n_words") < MIN_WORDS) | (F.lit(100) * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def transformed() -> list[Column]:
    """The five statistics on scales on which groups are roughly normal."""
    n = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    return [F.log(n),
            F.log((F.col("word_chars") + 1.0) / n),
            F.log1p(100.0 * F.col("n_symbols") / n),
            F.log1p(100.0 * F.col("n_dup_lines") / n),
            F.log1p(100.0 * F.col("n_repeat_words") / n)]


def _sums(x: list[Column]) -> list[Column]:
    d = len(x)
    return ([F.count("*").alias("m")] + [F.sum(x[i]).alias(f"s{i}") for i in range(d)]
            + [F.sum(x[i] * x[j]).alias(f"s{i}_{j}") for i in range(d) for j in range(i + 1)])


def _fitted(sums: DataFrame, d: int, scale: float, diagonal: bool, by: tuple[str, ...] = GROUP) -> DataFrame:
    """Centre c0.. and the Cholesky factor l0_0.. of the scatter, per group."""
    out = sums.select("*", *[(F.col(f"s{i}") / F.col("m")).alias(f"c{i}") for i in range(d)])

    def scatter(i: int, j: int) -> Column:
        v = (F.col(f"s{i}_{j}") / F.col("m") - F.col(f"c{i}") * F.col(f"c{j}")) * scale
        if i == j:
            return F.greatest(v, F.lit(FLOOR[i]))
        return F.lit(0.0) if diagonal else v

    for i in range(d):
        for j in range(i + 1):
            v = scatter(i, j)
            for k in range(j):
                v = v - F.col(f"l{i}_{k}") * F.col(f"l{j}_{k}")
            out = out.withColumn(f"l{i}_{j}", F.sqrt(F.greatest(v, F.lit(FLOOR[i] / 10))) if i == j else v / F.col(f"l{j}_{j}"))
    return out.select(*by, "m", *[f"c{i}" for i in range(d)],
                      *[f"l{i}_{j}" for i in range(d) for j in range(i + 1)])


def _joined(left: DataFrame, right: DataFrame, by: tuple[str, ...], how: str) -> DataFrame:
    """Equal in ``by``, NULL being a value."""
    r = right.withColumnsRenamed({c: f"_{c}" for c in by})
    on = F.lit(True)
    for c in by:
        on = on & left[c].eqNullSafe(F.col(f"_{c}"))
    return left.join(r, on, how).drop(*[f"_{c}" for c in by])


def _distances(vectors: DataFrame, fit: DataFrame, d: int, by: tuple[str, ...] = GROUP) -> DataFrame:
    """``vectors`` plus d2, the squared Mahalanobis distance from its group's centre."""
    out = _joined(vectors, fit, by, "left")
    for i in range(d):
        v = F.col(f"x{i}") - F.col(f"c{i}")
        for k in range(i):
            v = v - F.col(f"l{i}_{k}") * F.col(f"_y{k}")
        out = out.withColumn(f"_y{i}", v / F.col(f"l{i}_{i}"))
    square = sum((F.col(f"_y{i}") * F.col(f"_y{i}") for i in range(1, d)), F.col("_y0") * F.col("_y0"))
    return out.select(*vectors.columns, F.col("m"), square.alias("d2"))


def _level(d2: Column) -> Column:
    return F.floor(F.log2(d2 + 1e-6) * LEVELS).cast("int")


def estimate(vectors: DataFrame, d: int, by: tuple[str, ...] = GROUP) -> DataFrame:
    """Reweighted minimum-covariance-determinant fit per group of ``by``.

    ``vectors``: ``by`` (NULL is a group of its own), x0.. (doubles).
    """
    x = [F.col(f"x{i}") for i in range(d)]
    group = list(by)
    fit = land(_fitted(vectors.groupBy(*group).agg(*_sums(x)), d, 1.0, diagonal=True, by=by), "mcd-fit")
    below = Window.partitionBy(*group).orderBy("level").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*group)
    for step in range(STEPS + 2):
        far = _distances(vectors, fit, d, by).withColumn("level", _level(F.col("d2"))).drop("m")
        if step < STEPS:
            counts = far.groupBy(*group, "level").agg(F.count("*").alias("c"))
            limit = (counts.withColumn("_b", F.coalesce(F.sum("c").over(below), F.lit(0)))
                     .withColumn("_t", F.sum("c").over(whole))
                     .filter(F.col("_b") < F.col("_t") * PART)
                     .groupBy(*group).agg(F.max("level").alias("_limit")))
            near = _joined(far, limit, by, "inner").filter(F.col("level") <= F.col("_limit"))
            scale = 1.0 if step < STEPS - 1 else CONSISTENCY
        else:
            # the second has the moderate tail of the group in its scatter
            near, scale = far.filter(F.col("d2") <= (CHI2_NEAR if step == STEPS else CHI2_FAR)), 1.0
        fit = land(_fitted(near.groupBy(*group).agg(*_sums(x)), d, scale, diagonal=False, by=by), "mcd-fit")
    return fit


def judged(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` plus the base statistics, base_failed, d2 and kept.

    Texts that fail the base rules take no part in the estimate.  A group of
    fewer than MIN_GROUP texts is held against its language, and if that has too
    few, against all texts; a table of fewer rejects nothing.  ``docs``
    needs lang and source; its other columns pass through, those named like a
    result are replaced.
    """
    stats = land(base_statistics(docs, text).drop(text).withColumn("base_failed", base_failed()), "base-stats")
    return verdicts(stats)


def _with_fallbacks(groups: DataFrame, vectors: DataFrame, d: int) -> DataFrame:
    """A fit for each of ``groups`` (lang, source): its own, its language's or
    that of all rows, whichever is the first on MIN_GROUP rows."""
    kinds = F.explode(F.array(F.lit(0), F.lit(1), F.lit(2)))
    wider = vectors.select("*", kinds.alias("wide")).withColumns({
        "lang": F.when(F.col("wide") < 2, F.col("lang")), "source": F.when(F.col("wide") < 1, F.col("source"))})
    fit = estimate(wider, d, ("wide", *GROUP))
    asked = groups.select(*GROUP, kinds.alias("wide")).select(
        F.struct(*GROUP).alias("_for"), "wide", F.when(F.col("wide") < 2, F.col("lang")).alias("lang"),
        F.when(F.col("wide") < 1, F.col("source")).alias("source"))
    parts = [c for c in fit.columns if c not in ("wide", *GROUP)]
    first = _joined(asked, fit, ("wide", *GROUP), "inner").filter((F.col("m") >= MIN_GROUP) | (F.col("wide") == 0))
    # too small a fit of its own stays only where no wider one is large enough
    order = F.when(F.col("m") >= MIN_GROUP, F.col("wide")).otherwise(3).alias("order")
    return (first.groupBy("_for").agg(F.min(F.struct(order, *parts)).alias("_f"))
            .select("_for.*", *[F.col(f"_f.{c}").alias(c) for c in parts]))


def verdicts(stats: DataFrame) -> DataFrame:
    """kept and d2 for rows that have the base statistics and base_failed."""
    x = transformed()
    vectors = stats.filter(~F.col("base_failed")).select("lang", "source", *[v.alias(f"x{i}") for i, v in enumerate(x)])
    fit = land(_with_fallbacks(stats.select("lang", "source").distinct(), vectors, len(x)), "fits")
    # the rows travel as one value, so no column of theirs meets a name of the estimate
    row = F.struct(*[F.col(f"`{c}`") for c in stats.columns if c.lower() not in ("kept", "d2")])
    placed = stats.select(row.alias("_row"), "lang", "source", "base_failed", *[v.alias(f"x{i}") for i, v in enumerate(x)])
    out = _distances(placed, fit, len(x))
    far = F.coalesce((F.col("m") >= MIN_GROUP) & (F.col("d2") > CHI2_FAR), F.lit(False))
    return out.select("_row.*", "d2", (~F.col("base_failed") & ~far).alias("kept"))


def document_verdicts(docs: DataFrame) -> DataFrame:
    """doc_id, the base statistics, base_failed, d2 and kept for all documents."""
    return judged(docs.select("doc_id", "lang", "source", "text")).select("doc_id", *STATS, "base_failed", "d2", "kept")
