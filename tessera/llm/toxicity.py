"""Toxicity: subword-bag embeddings averaged into a linear softmax.

A word is the mean of the embeddings of its hashed character n-grams (3 to 6
code points of ``<word>``, and the word itself), so an unseen misspelling still
shares most vectors with the word it came from.  A document is the sequence of
its words as they stand; those of a window are averaged and a two-class softmax
reads the average.  A document's score is that of its most toxic window, so a
long text does not dilute one passage.  The
embeddings and the softmax are trained jointly in numpy.

Learning uses at most ``max_toxic`` toxic and ``max_clean`` other labelled
documents (chosen by a hash of the id; the bound is what makes it safe to train
on the driver).  Scoring reads every whole text on the executors: as the model
is linear after averaging, each distinct word of a task is reduced to one number
once, all new words of some texts together.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import held_out, learnable, prepare_python

MAX_TOXIC = 1500
MAX_CLEAN = 2500
TOXIC_FROM = 0.7
BUCKETS = 1 << 16
DIM = 12
GRAM_SIZES = (3, 4, 5, 6)
WINDOW = 2                  # adjacent words averaged
EDGES = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"     # marks taken off both ends of a word
STEPS, WARM, DECAY = 100, 20, 1e-5
MAX_WORD = 64               # longer words: n-grams of their overlapping pieces
CACHE = 200_000             # words remembered in a task
TOGETHER = 256              # texts scored together
WORDS = 4_000               # words whose n-grams are hashed at once


def _pieces(raw: str) -> list[str]:
    """A lower-cased token without the marks at its ends; a very long one in pieces."""
    w = raw.strip(EDGES)
    if len(w) <= MAX_WORD:
        return [w] if w else []
    return [w[i:i + MAX_WORD] for i in range(0, len(w), MAX_WORD - 4)]


def words_of(text: str | None) -> list[str]:
    """Lower-cased words in order, repeated ones too; very long words as pieces."""
    return [w for raw in (text or "").lower().split() for w in _pieces(raw)]


def _hashes(text: bytes, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """xxh3_64 of pieces of 3 bytes or more of a text: up to 8 bytes by its formulas
    for short inputs, all pieces at once; longer ones by the library."""
    padded = np.frombuffer(text + bytes(8), dtype=np.uint8).astype(np.uint64)
    four = padded[:-3] | padded[1:-2] << 8 | padded[2:-1] << 16 | padded[3:] << 24      # little-endian, at each byte
    out = np.zeros(len(starts), np.uint64)
    at = np.flatnonzero(sizes == 3)
    i = starts[at]
    h = (padded[i] << 16 | padded[i + 1] << 24 | padded[i + 2] | np.uint64(3 << 8)) ^ np.uint64(0x396CFEB8 ^ 0xBE4BA423)
    h = (h ^ h >> 33) * np.uint64(0xC2B2AE3D27D4EB4F)
    h = (h ^ h >> 29) * np.uint64(0x165667B19E3779F9)
    out[at] = h ^ h >> 32
    at = np.flatnonzero((sizes > 3) & (sizes <= 8))
    i, n = starts[at], sizes[at]
    h = (four[i + n - 4] | four[i] << 32) ^ np.uint64(0x1CAD21F72C81017C ^ 0xDB979083E96DD4DE)
    h = (h ^ (h << 49 | h >> 15) ^ (h << 24 | h >> 40)) * np.uint64(0x9FB21C651E98DF25)
    h = (h ^ ((h >> 35) + n.astype(np.uint64))) * np.uint64(0x9FB21C651E98DF25)
    out[at] = h ^ h >> 28
    for at in np.flatnonzero(sizes > 8).tolist():
        out[at] = xxhash.xxh3_64_intdigest(text[starts[at]:starts[at] + sizes[at]])
    return out


def _subwords(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    text = [f"<{w}>".encode("utf-8", "surrogatepass") for w in words]
    joined = b"".join(text)
    letters = np.flatnonzero((np.frombuffer(joined, dtype=np.uint8) & 0xC0) != 0x80)    # first bytes of code points
    bounds = np.append(letters, len(joined))
    ends = np.cumsum([len(t) for t in text])
    first = np.searchsorted(letters, ends - [len(t) for t in text])
    size = np.diff(np.append(first, len(letters)))                                       # code points of each word
    counts = [np.maximum(size - n + 1, 0) for n in GRAM_SIZES]
    sizes = 1 + sum(counts)
    out = np.zeros(sizes.sum(), np.uint64)
    to = np.cumsum(sizes) - sizes
    out[to] = [xxhash.xxh3_64_intdigest(t) for t in text]
    to += 1
    for n, count in zip(GRAM_SIZES, counts):
        turn = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        i = np.repeat(first, count) + turn
        out[np.repeat(to, count) + turn] = _hashes(joined, bounds[i], bounds[i + n] - bounds[i])
        to += count
    return (out % np.uint64(BUCKETS)).astype(np.int32), sizes


def subwords(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Bucket numbers of the words' character n-grams and of the words themselves, one
    word's after the other's, and how many each word has."""
    parts = [_subwords(words[i:i + WORDS]) for i in range(0, len(words), WORDS)]
    return (np.concatenate([np.zeros(0, np.int32), *[p[0] for p in parts]]),
            np.concatenate([np.zeros(0, np.int64), *[p[1] for p in parts]]))


def _window_means(logits: np.ndarray) -> np.ndarray:
    """Mean of every window of WINDOW words (one window if there are fewer)."""
    if len(logits) <= WINDOW:
        return logits.mean(keepdims=True)
    c = np.concatenate([[0.0], np.cumsum(logits)])
    return (c[WINDOW:] - c[:-WINDOW]) / WINDOW


@dataclass
class ToxicityModel:
    """``embedding`` (buckets x DIM), ``weight`` (DIM): toxic minus other."""

    embedding: np.ndarray
    weight: np.ndarray
    bias: float
    trained: bool = True
    _bucket: np.ndarray | None = field(default=None, repr=False)
    _words: dict[str, float] = field(default_factory=dict, repr=False)
    _several: dict[str, list[float]] = field(default_factory=dict, repr=False)

    def __getstate__(self):
        return self.__dict__ | {"_bucket": None, "_words": {}, "_several": {}}

    def _learn(self, raws: list[str]) -> None:
        """Remember the logit of each token; NaN for one that is no word or several."""
        if self._bucket is None:
            self._bucket = (self.embedding @ self.weight).astype(np.float64)
        pieces = [_pieces(raw) for raw in raws]
        words = list(dict.fromkeys(w for p in pieces for w in p))
        flat, sizes = subwords(words)
        values, starts = self._bucket[flat], np.cumsum(sizes) - sizes
        logits = np.zeros(len(words))
        for n in np.unique(sizes):                 # words of one size are the rows of a matrix
            at = np.flatnonzero(sizes == n)
            logits[at] = values[starts[at][:, None] + np.arange(n)].mean(axis=1)
        known = dict(zip(words, logits.tolist()))
        for raw, p in zip(raws, pieces):
            if len(p) == 1:
                self._words[raw] = known[p[0]]
            else:
                self._words[raw] = np.nan
                self._several[raw] = [known[w] for w in p]

    def scores(self, texts: list[str | None]) -> list[float]:
        """Probability of label 1 for the most toxic window of each whole text."""
        if not self.trained:
            return [0.0] * len(texts)
        out = []
        for first in range(0, len(texts), TOGETHER):
            tokens = [(t or "").lower().split() for t in texts[first:first + TOGETHER]]
            if len(self._words) >= CACHE:
                self._words.clear()
                self._several.clear()
            new = set().union(*tokens).difference(self._words)
            if new:
                self._learn(list(new))
            for raws in tokens:
                logits = np.array([*map(self._words.__getitem__, raws)])
                if np.isnan(logits).any():
                    logits = np.array([v for raw in raws for v in self._several.get(raw, (self._words[raw],))])
                z = self.bias + (_window_means(logits).max() if len(logits) else 0.0)
                out.append(float(1 / (1 + np.exp(-np.clip(z, -40, 40)))))
        return out

    def score(self, text: str | None) -> float:
        return self.scores([text])[0]


def _untrained() -> ToxicityModel:
    return ToxicityModel(np.zeros((BUCKETS, DIM), np.float32), np.zeros(DIM, np.float32), 0.0, trained=False)


def train(texts: list[str], labels: list[int], steps: int = STEPS, rate: float = 0.05,
          warm: int = WARM, decay: float = DECAY, seed: int = 5) -> ToxicityModel:
    """Full-batch Adam on embeddings, softmax weight and bias together.

    The first ``warm`` steps average whole documents; after that each document
    counts by its currently most toxic window, so other words of a toxic
    document are not blamed.  Both classes weigh the same.
    """
    vocab: dict[str, int] = {}
    docs = [np.array([vocab.setdefault(x, len(vocab)) for x in words_of(t)], dtype=np.int32) for t in texts]
    y = np.array([v for v, d in zip(labels, docs) if len(d)], dtype=float)
    docs = [d for d in docs if len(d)]
    if len(set(y)) < 2:
        return _untrained()
    rng = np.random.default_rng(seed)
    w = rng.normal(0, 0.5, DIM)
    flat, n_grams = subwords(list(vocab))
    used = np.flatnonzero(np.bincount(flat, minlength=BUCKETS))
    place_of = np.zeros(BUCKETS, np.int32)
    place_of[used] = np.arange(len(used), dtype=np.int32)
    flat = place_of[flat]
    e = rng.normal(0, 0.1, (len(used), DIM))
    gram_at = np.cumsum(n_grams) - n_grams
    parts = [slice(i, i + WORDS) for i in range(0, len(vocab), WORDS)]
    grams_of = [slice(gram_at[p][0], gram_at[p][-1] + n_grams[p][-1]) for p in parts]
    sizes = np.array([len(d) for d in docs])
    tokens = np.concatenate(docs)
    doc_at = np.cumsum(sizes) - sizes
    spans = np.minimum(sizes, WINDOW)
    n_windows = sizes - spans + 1
    window_doc = np.repeat(np.arange(len(docs), dtype=np.int32), n_windows)
    window_at = (np.arange(n_windows.sum()) + np.repeat(doc_at - (np.cumsum(n_windows) - n_windows), n_windows)).astype(np.int32)
    window_first = np.cumsum(n_windows) - n_windows
    window_span = spans.astype(np.int32)[window_doc]
    n_words = len(vocab)
    del texts, docs, vocab
    share = np.where(y == 1, 0.5 / (y == 1).sum(), 0.5 / (y == 0).sum())
    b = np.zeros(1)
    state = [[np.zeros_like(v), np.zeros_like(v)] for v in (e, w, b)]
    for step in range(1, steps + 1):
        bucket = e @ w
        word = np.concatenate([np.add.reduceat(bucket[flat[at]], gram_at[p] - at.start) for p, at in zip(parts, grams_of)]) / n_grams
        c = np.concatenate([[0.0], np.cumsum(word[tokens])])
        if step <= warm:
            starts, lengths = doc_at, sizes
        else:
            mean = (c[window_at + window_span] - c[window_at]) / window_span
            best = np.flatnonzero(mean == np.maximum.reduceat(mean, window_first)[window_doc])
            order = best[np.unique(window_doc[best], return_index=True)[1]]       # the first of each document
            starts, lengths = window_at[order], spans
        z = (c[starts + lengths] - c[starts]) / lengths + b[0]
        g = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - y) * share
        first = np.cumsum(lengths) - lengths
        place = np.repeat(starts - first, lengths) + np.arange(lengths.sum())
        per_word = np.bincount(tokens[place], weights=np.repeat(g / lengths, lengths), minlength=n_words)
        per_bucket = np.zeros(len(used))
        for p, at in zip(parts, grams_of):         # in the order of the words, so sums are those of one pass
            np.add.at(per_bucket, flat[at], np.repeat(per_word[p] / n_grams[p], n_grams[p]))
        grads = (per_bucket[:, None] * w + decay * e, e.T @ per_bucket + decay * w, np.array([g.sum()]))
        for (m1, m2), grad, v in zip(state, grads, (e, w, b)):
            m1 += 0.1 * (grad - m1)
            m2 += 0.001 * (grad * grad - m2)
            v -= rate * (m1 / (1 - 0.9 ** step)) / (np.sqrt(m2 / (1 - 0.999 ** step)) + 1e-8)
    out = np.zeros((BUCKETS, DIM))
    out[used] = e                                       # unseen buckets say nothing
    return ToxicityModel(out.astype(np.float32), w.astype(np.float32), float(b[0]))


def labelled_sample(docs: DataFrame, labels: DataFrame, may_learn: Column | None = None, text: str = "text",
                    doc_id: str = "doc_id", label: str = "toxic", max_toxic: int = MAX_TOXIC,
                    max_clean: int = MAX_CLEAN) -> tuple[list[str], list[int]]:
    """Texts and labels to learn from, ``max_toxic`` + ``max_clean`` at most.

    The ids are chosen from the labels alone (a few thousand, so broadcasting
    them has a fixed bound); an id labelled twice counts as toxic if any label
    says so.
    """
    by_id = (labels.filter(F.col(label).isNotNull() & F.col(doc_id).isNotNull())
             .groupBy(F.col(doc_id).alias("i")).agg(F.max(F.col(label).cast("int")).alias("y")))
    if may_learn is not None:
        by_id = by_id.filter(may_learn)
    order = F.xxhash64("i", F.lit(29))
    ids = (by_id.filter("y = 1").orderBy(order, "i").limit(max_toxic)
           .unionByName(by_id.filter("y = 0").orderBy(order, "i").limit(max_clean)))
    rows = (docs.select(F.col(doc_id).alias("i"), F.col(text).alias("t")).filter("t IS NOT NULL")
            .join(F.broadcast(ids), "i")
            .groupBy("i").agg(F.max("y").alias("y"), F.max("t").alias("t"))
            .orderBy(F.xxhash64("i", F.lit(31)), "i").collect())
    return [r["t"] for r in rows], [r["y"] for r in rows]


def score(docs: DataFrame, model: ToxicityModel, text: str = "text",
          names: tuple[str, str] = ("score", "predicted"), toxic_from: float = TOXIC_FROM) -> DataFrame:
    """``docs`` plus a toxicity score and a 0/1 prediction for each whole text.

    NULL and empty texts get the score of no evidence (the bias alone), or 0 if
    there were not labels of both classes to learn from.  Columns of ``docs``
    with the names of the results are replaced.
    """
    spark = docs.sparkSession
    prepare_python(spark)
    keep = [c for c in docs.columns if c not in names]
    at = keep.index(text)
    shared = spark.sparkContext.broadcast(model)
    schema = T.StructType([docs.schema[c] for c in keep] + [
        T.StructField(names[0], T.DoubleType()), T.StructField(names[1], T.IntegerType())])

    def run(batches):
        for b in batches:
            s = shared.value.scores(b.column(at).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(s, pa.float64()), pa.array([int(x >= toxic_from) for x in s], pa.int32())],
                names=[*b.schema.names, *names])

    return docs.select(*[F.col(f"`{c}`") for c in keep]).mapInArrow(run, schema)


def fit(docs: DataFrame, labels: DataFrame, **bounds) -> ToxicityModel:
    """Train on the bounded sample of learnable labelled documents."""
    texts, y = labelled_sample(docs, labels, learnable(F.col("i")), **bounds)
    return train(texts, y)


def toxicity_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Scores for every document of a documents table."""
    model = fit(docs, labels)
    return score(docs.select("doc_id", held_out("doc_id").alias("held_out"), "text"), model).drop("text")
