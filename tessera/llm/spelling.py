"""Spelling variants: words that differ by one code point, by dense tiles.

Words of a tile are rows of padded code-point matrices, one aligned left and
one right.  Two blocks of a tile are compared all at once: the length of the
common prefix is the first column in which the left matrices differ, that of
the common suffix likewise from the right, and a pair is a single insertion,
deletion or replacement exactly if both together reach the longer length minus one.

Which blocks meet: one edit leaves the first or the last half of the shorter
word as it is.  Words are dealt into tiles by (shorter length, half), so a tile
holds words of that length and of one more; a pair of equal prefix halves is
left to the prefix tile, so each pair is found once.  A tile is cut into blocks of
at most about ``BLOCK`` words by a hash of the word, and each pair of blocks is
one row of at most two blocks: no task holds a tile, however many words share a
half.  What leaves a block pair is one row per word that has neighbours there, not
one per pair.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import land, prepare_python

# Letters A-Z, a-z and the Latin-1 letters' code points.
RUN = "[A-Za-zÀ-ÿ]"
LEAST_LENGTH = 7
LEAST_COUNT = 2
FORM_FACTOR = 10
BLOCK = 1024                 # words; fewer where words are long
_CELLS = 1 << 22             # code points compared at a time


def _lower(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def document_words(docs: DataFrame, text: str = "text", doc_id: str = "doc_id",
                   least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n): words of all texts and how often they occur.

    A word is a maximal run of letters, A-Z lower-cased; where 31 divides the
    unsigned crc32 of ``<doc_id>:<run>``, without its code point at (crc32 mod
    length).  NULL texts have no runs, a NULL id is written as nothing.
    """
    # a run that is too short stays so, hence only long ones are taken out
    found = F.regexp_extract_all(_lower(F.col(text).cast("string")), F.lit(RUN + f"{{{least_length},}}"), F.lit(0))
    run, h = F.col("run"), F.col("h")
    at = (h % F.char_length(run)).cast("int")
    word = F.when(h % 31 == 0, F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.char_length(run)))).otherwise(run)
    return (docs.select(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("id"), F.explode(found).alias("run"))
            .withColumn("h", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")))
            .select(word.alias("word")).filter(F.char_length("word") >= least_length)
            .groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= least_count))


def _matrix(words: list[str], width: int, pad: int, right: bool = False) -> np.ndarray:
    """Code points of the words, one row each, padded to ``width``."""
    rows = "".join(w.rjust(width, "\0") if right else w.ljust(width, "\0") for w in words)
    out = np.frombuffer(rows.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).reshape(len(words), width)
    return np.where(out == 0, np.uint32(pad), out)


def _agreeing(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Leading columns in which each row of x equals each row of y.

    The last column never agrees: one side has a pad there that the other has not.
    """
    return (x[:, None, :] != y[None, :, :]).argmax(axis=2)


def near_pairs(a: list[str], b: list[str], shorter: int, prefix_tile: bool) -> np.ndarray:
    """Boolean (len(a), len(b)): pairs of this tile that differ by one edit.

    ``shorter`` is the length of the shorter word; words of one more code point
    only pair with words of that length.
    """
    width = shorter + 2
    la, lb = (np.array([len(w) for w in x]) for x in (a, b))
    left, right = (_matrix(b, width, 0x110000), _matrix(b, width, 0x110000, True)[:, ::-1])
    out = np.zeros((len(a), len(b)), dtype=bool)
    step = max(1, _CELLS // max(1, len(b) * width))
    for k in range(0, len(a), step):
        part = a[k:k + step]
        prefix = _agreeing(_matrix(part, width, 0x110001), left)
        suffix = _agreeing(_matrix(part, width, 0x110001, True)[:, ::-1], right)
        longer = np.maximum(la[k:k + step, None], lb[None, :])
        fits = (la[k:k + step, None] == shorter) | (lb[None, :] == shorter)
        near = fits & (prefix + suffix >= longer - 1) & (prefix < longer)
        if not prefix_tile:                 # these have met in their prefix tile
            near &= prefix < shorter // 2
        out[k:k + step] = near
    return out


def _tiles(words: DataFrame, least_length: int) -> DataFrame:
    """(shorter, prefix, i, j, members): a row for each pair of blocks of a tile."""
    size = F.char_length("word")
    lengths = F.filter(F.array(size, size - 1), lambda s: s >= least_length)
    half = F.floor(F.col("shorter") / 2).cast("int")
    cells = (words.select("word", "n", F.explode(lengths).alias("shorter"))
             .select("word", "n", "shorter", F.explode(F.array(F.lit(True), F.lit(False))).alias("prefix"))
             .withColumn("part", F.when(F.col("prefix"), F.substring(F.col("word"), F.lit(1), half))
                         .otherwise(F.substring(F.col("word"), F.char_length("word") - (F.col("shorter") - half) + 1,
                                                F.col("shorter") - half))))
    key = ["shorter", "prefix", "part"]
    block = F.least(F.lit(BLOCK), F.greatest(F.lit(16), F.floor(F.lit(1 << 18) / F.col("shorter"))))
    sizes = (cells.groupBy(*key).agg(F.count("*").alias("m"), F.max((F.char_length("word") == F.col("shorter")).cast("int")).alias("short"))
             .filter("m > 1 AND short = 1").withColumn("blocks", F.ceil(F.col("m") / block).cast("int")).select(*key, "blocks"))
    placed = cells.join(sizes, key).withColumn("x", F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int"))
    met = placed.select(*key, "word", "n", "x", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("y"))
    return (met.groupBy(*key, F.least("x", "y").alias("i"), F.greatest("x", "y").alias("j"))
            .agg(F.collect_list(F.struct("word", "n", "x")).alias("members"))
            .select("shorter", "prefix", "i", "j", "members"))


def neighbours(words: DataFrame, least_length: int = LEAST_LENGTH) -> DataFrame:
    """(word, n_near, best): of each word with near words their number and the
    most frequent one (n, word), ties to the smallest in code-point order."""
    prepare_python(words.sparkSession)

    def run(batches):
        for batch in batches:
            out: list[tuple] = []
            for shorter, prefix, i, j, members in zip(*(batch.column(c).to_pylist() for c in range(4)), batch.column(4)):
                m = members.values
                rows = sorted(zip(m.field("n").to_pylist(), m.field("word").to_pylist(), m.field("x").to_pylist()),
                              key=lambda r: (-r[0], r[1]))          # the best comes first
                blocks = [[r for r in rows if r[2] == k] for k in ((i,) if i == j else (i, j))]
                if not all(blocks):
                    continue
                pairs = near_pairs([r[1] for r in blocks[0]], [r[1] for r in blocks[-1]], shorter, prefix)
                for near, own, other in ((pairs, blocks[0], blocks[-1]),) + (((pairs.T, blocks[1], blocks[0]),) if i != j else ()):
                    number, best = near.sum(axis=1), near.argmax(axis=1)
                    out += [(own[k][1], int(number[k]), other[best[k]][0], other[best[k]][1]) for k in np.flatnonzero(number)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[c] for r in out], t) for c, t in enumerate((pa.string(), pa.int64(), pa.int64(), pa.string()))],
                names=["word", "n_near", "best_n", "best"])

    met = _tiles(words, least_length).mapInArrow(run, "word string, n_near long, best_n long, best string")
    return met.groupBy("word").agg(F.sum("n_near").alias("n_near"),
                                   F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("word"))).alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) from (word, form): the last form that forms lead to.

    Each round replaces a form by that form's own, so chains halve; they end
    as each form is ``FORM_FACTOR`` times as frequent as its word.
    """
    told = land(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        further = told.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = land(told.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"),
                                                              F.col("next").isNotNull().alias("moved")), "spelling-roots")
        told = step.select("word", "root")
        if step.filter("moved").isEmpty():
            return told


def variants(words: DataFrame, factor: int = FORM_FACTOR, least_length: int = LEAST_LENGTH) -> DataFrame:
    """word, form, root, n, n_near and form_n of (word, n), each word once.

    A word's form is its near word of largest n if that is at least ``factor``
    times its own, else NULL; a word without form is its own root.
    """
    near = neighbours(words, least_length)
    best = -F.col("best.less")
    has = F.coalesce(best >= factor * F.col("n"), F.lit(False))
    told = land(words.join(near, "word", "left").select(
        "word", F.when(has, F.col("best.word")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(has, best).alias("form_n")), "spelling-forms")
    ends = roots(told.filter("form IS NOT NULL"))
    return (told.join(ends, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))


def document_variants(docs: DataFrame) -> DataFrame:
    """``variants`` of all words of all documents.

    NULL and empty texts and texts without words add none, repeated rows count
    again, very long runs are words like others, no documents give no rows.
    Columns other than doc_id and text are not read.
    """
    return variants(land(document_words(docs), "spelling-words"))
