"""Language ID by language-bitmask n-gram filters.

One Bloom filter per language, stored bit-sliced: slot ``j`` holds a bit mask
over the languages, so ANDing the slots of an n-gram's ``k`` hashes returns
every language that contains it in one step.  A document's n-grams are looked
up, the bits are counted per language, each count is corrected for that
filter's false-positive rate, and the largest corrected share decides.

N-grams are letter trigrams of the lower-cased text, each centred on a letter,
with everything that is no letter read as a space.

The filters are learned from at most about ``docs_per_lang`` documents of each
language (drawn by a hash of the id); a trigram enters a language's filter when
at least ``min_share`` of these documents hold it, ``grams_per_lang`` at most.
The broadcast model is thus bounded by languages x ``grams_per_lang``.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from tessera.llm.common import held_out, learnable, prepare_python, unit_hash

UNKNOWN = "und"
DOCS_PER_LANG = 3000
GRAMS_PER_LANG = 20_000
MIN_SHARE = 0.02
HASHES = 4
SLOTS_PER_GRAM = 16
SEGMENT = 1 << 18          # code points looked at together
_MULT = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Code point -> lower-case letter, or 0 where it is no letter."""
    out = np.zeros(sys.maxunicode + 1, dtype=np.uint32)
    for i in range(sys.maxunicode + 1):
        c = chr(i)
        if c.isalpha():
            low = c.lower()
            out[i] = ord(low) if len(low) == 1 else i
    return out


def _segments(texts: list[str | None]):
    """(rows, letters) runs of about SEGMENT code points; long texts are cut
    into overlapping pieces so that every trigram centre is seen once."""
    rows: list[int] = []
    parts: list[np.ndarray] = []
    size = 0
    blank = np.zeros(1, dtype=np.uint32)
    for i, t in enumerate(texts):
        if not t:
            continue
        a = _letters()[np.frombuffer(t.encode("utf-32-le", "surrogatepass"), dtype="<u4")]
        for at in range(0, len(a), SEGMENT):
            left = a[at - 1:at] if at else blank
            right = a[at + SEGMENT:at + SEGMENT + 1]
            parts.append(np.concatenate([left, a[at:at + SEGMENT], right if len(right) else blank]))
            rows.append(i)
            size += len(parts[-1])
            if size >= SEGMENT:
                yield rows, parts
                rows, parts, size = [], [], 0
    if rows:
        yield rows, parts


def _grams(texts: list[str | None]):
    """(row of each trigram, trigram hash) arrays, a bounded run at a time."""
    for rows, parts in _segments(texts):
        sizes = np.array([len(p) for p in parts])
        a = np.concatenate(parts)
        centre = a[1:-1] != 0
        ends = np.cumsum(sizes)
        for e in ends[:-1]:            # first and last place of a piece are no centres
            centre[e - 2:e] = False
        at = np.flatnonzero(centre)
        if not len(at):
            continue
        wide = a.astype(np.uint64)
        h = wide[at] * _MULT[0] + wide[at + 1] * _MULT[1] + wide[at + 2] * _MULT[2]
        h ^= h >> np.uint64(31)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(29)
        owner = np.asarray(rows)[np.searchsorted(ends, at + 1, side="right")]
        yield owner, h


def _slots(h: np.ndarray, slots: int) -> list[np.ndarray]:
    """The k places of each hash: double hashing over a power of two."""
    low, high = h & np.uint64(0xFFFFFFFF), (h >> np.uint64(32)) | np.uint64(1)
    return [((low + np.uint64(i) * high) & np.uint64(slots - 1)).astype(np.int64) for i in range(HASHES)]


@dataclass
class LanguageFilters:
    """Bit-sliced filters: ``masks[slot, word]``, 64 languages to a word."""

    langs: list[str]
    masks: np.ndarray
    false_rate: np.ndarray
    first_choice: int

    def counts(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Per text: n-grams found per language, n-grams looked up."""
        found = np.zeros((len(texts), max(1, len(self.langs))))
        total = np.zeros(len(texts))
        for owner, h in _grams(texts):
            total += np.bincount(owner, minlength=len(texts))
            places = _slots(h, len(self.masks))
            for word in range(self.masks.shape[1]):
                column = self.masks[:, word]
                bits = column[places[0]]
                for p in places[1:]:
                    bits &= column[p]
                for k in range(word * 64, min(len(self.langs), word * 64 + 64)):
                    hit = owner[(bits >> np.uint64(k - word * 64)) & np.uint64(1) != 0]
                    found[:, k] += np.bincount(hit, minlength=len(texts))
        return found, total

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Per text: language, score (its part of all corrected shares),
        coverage (its corrected share of the text's n-grams)."""
        found, total = self.counts(texts)
        share = found / np.maximum(total, 1)[:, None]
        if self.langs:
            share = np.clip((share - self.false_rate) / (1 - self.false_rate), 0, 1)
        best = np.where(share.max(axis=1) > 0, share.argmax(axis=1), self.first_choice)
        rows = np.arange(len(texts))
        coverage = np.where(total > 0, share[rows, best], 0.0)
        score = np.where(coverage > 0, coverage / np.maximum(share.sum(axis=1), 1e-12), 0.0)
        names = [self.langs[b] if n and self.langs else UNKNOWN for b, n in zip(best, total)]
        return names, score, coverage


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id",
        may_learn: Column | None = None, docs_per_lang: int = DOCS_PER_LANG,
        grams_per_lang: int = GRAMS_PER_LANG, min_share: float = MIN_SHARE) -> LanguageFilters:
    """Learn one filter per language from rows with text and language."""
    spark = docs.sparkSession
    prepare_python(spark)
    use = docs.select(F.col(doc_id).alias("i"), F.col(text).alias("t"), F.col(lang).cast("string").alias("l"),
                      (F.lit(True) if may_learn is None else may_learn).alias("ok"))
    use = use.filter("ok AND t IS NOT NULL AND l IS NOT NULL")
    sizes = {r["l"]: r["n"] for r in use.groupBy("l").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return LanguageFilters([], np.zeros((1, 1), dtype=np.uint64), np.zeros(1), 0)
    langs = sorted(sizes)
    part = F.element_at(F.create_map(*[F.lit(x) for k in langs for x in (k, docs_per_lang / sizes[k])]), F.col("l"))
    drawn = use.filter(unit_hash(F.col("i"), F.lit(17)) < part).select("l", "t")

    def grams(batches):
        for b in batches:
            names, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
            for name in sorted(set(names)):
                own = [t for n, t in zip(names, texts) if n == name]
                pairs = []
                for owner, h in _grams(own):
                    pairs.append(np.unique(np.stack([owner.astype(np.uint64), h], 1), axis=0))
                if not pairs:
                    continue
                pairs = np.unique(np.concatenate(pairs), axis=0)
                g, n = np.unique(pairs[:, 1], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(g)), pa.array(g.view(np.int64)), pa.array(n.astype(np.int64))],
                    names=["l", "g", "n"])

    top = Window.partitionBy("l").orderBy(F.desc("n"), "g")
    need = F.element_at(F.create_map(*[F.lit(x) for k in langs for x in
                                       (k, max(1.0, min_share * min(sizes[k], docs_per_lang)))]), F.col("l"))
    kept = (drawn.mapInArrow(grams, "l string, g long, n long")
            .groupBy("l", "g").agg(F.sum("n").alias("n"))
            .filter(F.col("n") >= need)
            .withColumn("r", F.row_number().over(top))
            .filter(F.col("r") <= grams_per_lang)
            .groupBy("l").agg(F.collect_list("g").alias("g")).collect())
    by_lang = {r["l"]: np.array(r["g"], dtype=np.int64).view(np.uint64) for r in kept}
    largest = max([1, *map(len, by_lang.values())])
    slots = 1 << (SLOTS_PER_GRAM * largest - 1).bit_length()
    masks = np.zeros((slots, -(-len(langs) // 64)), dtype=np.uint64)
    for k, name in enumerate(langs):
        for p in _slots(by_lang.get(name, np.zeros(0, dtype=np.uint64)), slots):
            np.bitwise_or.at(masks[:, k // 64], p, np.uint64(1 << (k % 64)))
    fill = np.array([np.mean((masks[:, k // 64] >> np.uint64(k % 64)) & np.uint64(1)) for k in range(len(langs))])
    first = max(range(len(langs)), key=lambda k: (sizes[langs[k]], -k))
    return LanguageFilters(langs, masks, fill ** HASHES, first)


def identify(docs: DataFrame, model: LanguageFilters, text: str = "text",
             names: tuple[str, str, str] = ("lang_pred", "score", "coverage")) -> DataFrame:
    """``docs`` plus predicted language, score and coverage.

    NULL texts and texts without a letter are ``und`` with score 0.  Text with
    letters but no known trigram takes the most frequent learned language with
    score 0; ``und`` if nothing was learned.  Columns of ``docs`` with the same
    names as the three results are replaced.
    """
    spark = docs.sparkSession
    prepare_python(spark)
    keep = [c for c in docs.columns if c not in names]
    at = keep.index(text)
    shared = spark.sparkContext.broadcast(model)
    schema = T.StructType([docs.schema[c] for c in keep] + [
        T.StructField(names[0], T.StringType()), T.StructField(names[1], T.DoubleType()),
        T.StructField(names[2], T.DoubleType())])

    def score(batches):
        for b in batches:
            lang, s, cover = shared.value.predict(b.column(at).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(lang, pa.string()), pa.array(s, pa.float64()), pa.array(cover, pa.float64())],
                names=[*b.schema.names, *names])

    return docs.select(*[F.col(f"`{c}`") for c in keep]).mapInArrow(score, schema)


def language_ids(docs: DataFrame) -> DataFrame:
    """Predictions for every document of a documents table."""
    model = fit(docs, may_learn=learnable("doc_id"))
    out = identify(docs.select("doc_id", held_out("doc_id").alias("held_out"), "text"), model)
    return out.drop("text")
