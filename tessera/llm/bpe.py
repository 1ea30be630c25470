"""Byte-level BPE encoding and decoding with higher-order functions.

A text is cut into pieces by the tokenizer's pattern.  A piece is an array of
token ids, at first those of its bytes; a fold merges the adjacent pair of lowest
rank until none is left.  Ranks are looked up in a literal map from pairs of ids
to the id of the merged token: two flat arrays, a perfect hash of all pairs of
tokens that make a token.  A fold's state is one array of longs, each the rank of
the pair that begins there, its place and the id, so the smallest long is the
next pair to merge.

Distinct pieces are counted over the whole corpus and the most frequent ones,
``DICTIONARY`` at most, are folded once.  This dictionary goes to the tasks as one
Arrow buffer, in no plan: there an Arrow function cuts the texts and looks pieces
up, and returns each piece that the dictionary lacks as its bytes, to be folded
where it occurs.  No piece depends on that bound.  Decoding concatenates the tokens'
bytes.

The rank file (base64 token, rank) is read on the driver; its size is that of
the tokenizer, not of the data.
"""

from __future__ import annotations

import base64
import json
import random
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from tessera.llm.common import free_names, land, prepare_python

DICTIONARY = 1 << 18
LONG = 256                   # bytes; longer pieces merge all pairs of a rank at once
ID_BITS = 20                 # of a token id; a fold's long has 20 for a rank, 22 for a place, 20 for an id
NO_RANK = (1 << ID_BITS) - 1
# White space as Unicode has it, written out because the regular
# expressions of the JVM mean six characters by \s.
SPACE = r"\t-\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"


def jvm_pattern(pattern: str) -> str:
    """The tokenizer's pattern with \\s and \\S as explicit classes."""
    return (pattern.replace(r"[^\s", f"[^{SPACE}").replace(r"\S", f"[^{SPACE}]").replace(r"\s", f"[{SPACE}]"))


def python_pattern(pattern: str) -> str:
    """The JVM's pattern for Python, which writes code points with four digits."""
    return regex.sub(r"\\x\{([0-9A-F]+)\}", lambda m: f"\\u{int(m[1], 16):04x}", pattern)


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a tiktoken rank file."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def _json(values: list[int | None], item: T.DataType) -> Column:
    """A literal array."""
    return F.from_json(F.lit(json.dumps(values, separators=(",", ":"))), T.ArrayType(item))


def _let(value: Column, body) -> Column:
    """``body`` with ``value`` evaluated once and not copied."""
    return F.aggregate(F.array().cast("array<int>"), value, lambda v, _: v, body)


class PairRanks:
    """Literal map from two ids to the id of the token that both make.

    A pair's hash names a bucket and a cell; the bucket's shift, found when the
    table is made, takes all its pairs to cells of their own.  A cell is one long:
    both ids and the value.
    """

    def __init__(self, ranks: dict[bytes, int]):
        if max(ranks.values(), default=0) >= NO_RANK:
            raise ValueError(f"ranks from {NO_RANK} on are not supported")
        pairs = [(ranks[k[:i]], ranks[k[i:]], v) for k, v in ranks.items() for i in range(1, len(k))
                 if k[:i] in ranks and k[i:] in ranks]
        left, right, value = np.array(pairs, dtype=np.int64).reshape(-1, 3).T
        packed = (left << 2 * ID_BITS) | (right << ID_BITS) | value
        bits = max(4, (2 * len(pairs)).bit_length())
        self.cells, self.buckets = 1 << bits, 1 << (bits - 2)
        rng = random.Random(8)
        while True:
            self.factors = tuple(rng.randrange(1 << 39, 1 << 40) | 1 for _ in range(2))
            h = left * self.factors[0] + right * self.factors[1]
            bucket, cell = (h >> 24) & (self.buckets - 1), (h >> 40) & (self.cells - 1)
            if len(np.unique(bucket * self.cells + cell)) == len(pairs):
                break
        taken, shifts = [-1] * self.cells, [0] * self.buckets
        order = np.argsort(bucket, kind="stable")
        starts = np.flatnonzero(np.diff(bucket[order], prepend=-1))
        for members in sorted(np.split(order, starts[1:]) if len(order) else [], key=len, reverse=True):
            own, shift = cell[members].tolist(), 0
            while any(taken[c ^ shift] >= 0 for c in own):
                shift = rng.randrange(self.cells)
            shifts[int(bucket[members[0]])] = shift
            for c, v in zip(own, packed[members].tolist()):
                taken[c ^ shift] = v
        self.table = _json(taken, T.LongType())
        self.shifts = _json(shifts, T.IntegerType())

    def among(self, body) -> Column:
        """``body`` with the function that gives the rank of two ids, NULL if they make no token."""
        def rank(table: Column, shifts: Column):
            def found(a: Column, b: Column) -> Column:
                return _let(a * F.lit(self.factors[0]) + b * F.lit(self.factors[1]), lambda h: _let(
                    F.get(table, F.shiftright(h, 40).bitwiseAND(F.lit(self.cells - 1)).cast("int").bitwiseXOR(
                        F.get(shifts, F.shiftright(h, 24).bitwiseAND(F.lit(self.buckets - 1)).cast("int")))),
                    lambda c: F.when(F.shiftright(c, ID_BITS) == F.shiftleft(a, ID_BITS).bitwiseOR(b),
                                     c.bitwiseAND(F.lit(NO_RANK)))))
            return found
        return _let(self.table, lambda table: _let(self.shifts, lambda shifts: body(rank(table, shifts))))


def _merge_first(rank, state: Column) -> Column:
    """Merges the first pair of lowest rank; ranks of its neighbours anew."""
    low = F.lit((1 << 42) - 1)

    def ranked(r: Column, rest: Column) -> Column:
        return F.shiftleft(F.coalesce(r, F.lit(NO_RANK)).cast("long"), 42).bitwiseOR(rest)

    def at(first: Column) -> Column:
        merged = F.shiftright(first, 42)
        kept = F.filter(state, lambda x, i: ~F.get(state, i - 1).eqNullSafe(first))
        return F.when(first >= F.lit(NO_RANK << 42), state).otherwise(_let(kept, lambda p: F.transform(p, lambda x, i: (
            F.when(x == first, ranked(rank(merged, F.get(p, i + 1).bitwiseAND(F.lit(NO_RANK))),
                                      first.bitwiseAND(F.lit(((1 << 42) - 1) ^ NO_RANK)).bitwiseOR(merged)))
            .when(F.get(p, i + 1) == first, ranked(rank(x.bitwiseAND(F.lit(NO_RANK)), merged), x.bitwiseAND(low)))
            .otherwise(x)))))

    return _let(F.array_min(state), at)


def _merge_all(rank, state: Column) -> Column:
    """Merges every pair of lowest rank, in a run of overlapping pairs every other."""
    p = state["p"]

    def joined(starts: Column, merged: Column) -> Column:
        last = F.element_at(starts, -1)
        head = F.flatten(F.transform(starts, lambda s, j: _let(
            F.when(j == 0, F.lit(1)).otherwise(F.try_element_at(starts, F.greatest(j, F.lit(1))) + 2),
            lambda begin: F.concat(F.slice(p, begin, s - begin), F.array(merged)))))
        return F.struct(F.concat(head, F.slice(p, last + 2, F.size(p))).alias("p"), F.lit(False).alias("done"))

    def steps(m: Column, r: Column) -> Column:
        places = F.filter(F.sequence(F.lit(1), F.size(r) - 1), lambda i: F.element_at(r, i) == m)

        def chosen(q: Column) -> Column:
            # how many places directly before this one form a run with it, by
            # powers of two: q[j - c] = i - c holds for all c of the run only
            powers = F.array(*[F.lit(1 << k) for k in range(26, -1, -1)])
            return F.filter(q, lambda i, j: F.aggregate(
                powers, F.lit(0),
                lambda c, s: F.when((j - c - s >= 0) & (F.get(q, j - c - s) == i - c - s), c + s).otherwise(c)) % 2 == 0)

        return _let(places, lambda q: _let(chosen(q), lambda starts: joined(starts, m)))

    return F.when(state["done"], state).otherwise(
        _let(F.transform(p, lambda x, i: rank(x, F.get(p, i + 1))), lambda r: _let(F.array_min(r), lambda m: F.when(
            m.isNull(), F.struct(p.alias("p"), F.lit(True).alias("done"))).otherwise(steps(m, r)))))


def _tokens(rank, byte_ranks: Column, c: Column) -> Column:
    """Ids of one piece that is no token itself, from the ids of its bytes."""
    def folded(c: Column) -> Column:
        turns = F.sequence(F.lit(1), F.size(c))
        pair = rank if byte_ranks is None else lambda x, y: F.get(byte_ranks, F.shiftleft(x, 8).bitwiseOR(y))
        state = F.transform(c, lambda x, i: F.shiftleft(F.coalesce(pair(x, F.get(c, i + 1)), F.lit(NO_RANK)).cast("long"), 42)
                            .bitwiseOR(F.shiftleft(i, ID_BITS).bitwiseOR(x).cast("long")))
        short = F.aggregate(turns, state, lambda s, _: _merge_first(rank, s),
                            lambda s: F.transform(s, lambda x: x.bitwiseAND(F.lit(NO_RANK)).cast("int")))
        long = F.aggregate(turns, F.struct(c.cast("array<long>").alias("p"), F.lit(False).alias("done")),
                           lambda s, _: _merge_all(rank, s), lambda s: s["p"].cast("array<int>"))
        return F.when(F.size(c) <= LONG, short).otherwise(long)

    return _let(c, folded)


@lru_cache(maxsize=2)
def _known(pieces: bytes) -> dict[str, bytes]:
    """Ids, as the bytes of 32-bit integers, by piece; kept by a Python worker."""
    known = {}
    for batch in pa.ipc.open_stream(pieces):
        ids, ends = batch.column(1).flatten().to_numpy().tobytes(), batch.column(1).offsets.to_numpy()
        known.update((k, ids[4 * a:4 * b]) for k, a, b in zip(batch.column(0).to_pylist(), (ends - ends[0]).tolist(),
                                                            (ends[1:] - ends[0]).tolist()))
    return known


def _cut(texts: pa.Array, pattern: str, pieces: bytes, byte_ids: list[bytes]) -> pa.Array:
    """Per text its ids up to a piece that is not known, the ids of that piece's
    bytes (marked as open), the ids up to the next, and so on."""
    known, found = _known(pieces).get, regex.compile(pattern).findall
    chunks, is_open, rows = [], [], [0]
    for text in texts.cast(pa.binary()).to_pylist():
        cut = found(text.decode("utf-8", "replace")) if text else []
        ids, at = [*map(known, cut), None], 0
        while at < len(cut):
            end = ids.index(None, at)
            if end > at:
                chunks.append(b"".join(ids[at:end]))
                is_open.append(False)
            if end < len(cut):
                chunks.append(b"".join([byte_ids[b] for b in cut[end].encode()]))
                is_open.append(True)
            at = end + 1
        rows.append(len(chunks))
    ends = np.cumsum([0, *map(len, chunks)]) // 4
    ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(chunks), dtype=np.int32)))
    parts = pa.StructArray.from_arrays([ids, pa.array(is_open, pa.bool_())], names=["ids", "open"])
    return pa.ListArray.from_arrays(pa.array(rows, pa.int32()), parts)


class ByteBpe:
    """A tokenizer given by its ranks and its pattern; no special tokens."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.pattern = jvm_pattern(pattern)
        self._hex = [""] * (max(ranks.values(), default=-1) + 1)
        for k, v in ranks.items():
            self._hex[v] = k.hex()
        self._pairs = PairRanks(ranks)
        self._bytes = [ranks[bytes([b])] for b in range(256)]
        self._byte_ranks = self._ranks_of_bytes(ranks)
        self._whole = {}             # tokens that can be pieces
        for k, v in ranks.items():
            try:
                self._whole[k.decode("utf-8")] = v
            except UnicodeDecodeError:
                pass
        self._pieces = self._packed(pa.table({"piece": pa.array([], pa.string()), "ids": pa.array([], pa.list_(pa.int32()))}))

    def _ranks_of_bytes(self, ranks: dict[bytes, int]) -> Column | None:
        """Ranks of two bytes at 256 a + b for the ids a and b; None if their ids are not the first 256."""
        if max(self._bytes) > 255:
            return None
        values: list[int | None] = [None] * (1 << 16)
        for i, a in enumerate(self._bytes):
            for j, b in enumerate(self._bytes):
                values[a << 8 | b] = ranks.get(bytes([i, j]))
        return _json(values, T.IntegerType())

    def _packed(self, folded: pa.Table) -> bytes:
        """Tokens and folded pieces as one buffer; a piece that is a token is that token."""
        whole = pa.table({"piece": pa.array(self._whole.keys(), pa.string()),
                          "ids": pa.array([[v] for v in self._whole.values()], pa.list_(pa.int32()))})
        out = pa.BufferOutputStream()
        with pa.ipc.new_stream(out, whole.schema) as stream:
            stream.write_table(folded.select(["piece", "ids"]).cast(whole.schema))
            stream.write_table(whole)
        return out.getvalue().to_pybytes()

    def pieces(self, text: str | Column) -> Column:
        """The pattern's matches in a text; none for NULL."""
        c = F.col(text) if isinstance(text, str) else text
        return F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(self.pattern), F.lit(0))

    def learn_dictionary(self, docs: DataFrame, text: str = "text", most: int = DICTIONARY) -> ByteBpe:
        """Fold the most frequent distinct pieces of ``docs`` once.

        Pieces are counted over all documents; those at or above the least
        count that leaves at most ``most`` of them are folded.
        """
        counts = land(docs.select(F.explode(self.pieces(text)).alias("piece"))
                      .groupBy("piece").agg(F.count("*").alias("n")).filter("n > 1"), "pieces")
        levels = counts.groupBy(F.least("n", F.lit(1 << 14)).alias("n")).agg(F.count("*").alias("c"))
        down = levels.withColumn("c", F.sum("c").over(Window.orderBy(F.desc("n"))))
        least = down.filter(F.col("c") <= most).agg(F.min("n")).collect()[0][0]
        if least is None:
            return self
        folded = land(counts.filter(F.col("n") >= least).select("piece", self._folded(F.col("piece")).alias("ids")), "folded")
        self._pieces = self._packed(folded.toArrow())
        return self

    def _fold(self, body) -> Column:
        """``body`` with the function from the ids of a piece's bytes to its tokens."""
        if self._byte_ranks is None:
            return self._pairs.among(lambda rank: body(lambda c: _tokens(rank, None, c)))
        return self._pairs.among(lambda rank: _let(self._byte_ranks, lambda two: body(lambda c: _tokens(rank, two, c))))

    def _folded(self, piece: Column) -> Column:
        chars = F.split(F.decode(F.encode(piece, "UTF-8"), "ISO-8859-1"), "")
        byte_ids = _json(self._bytes, T.IntegerType())
        return self._fold(lambda tokens: _let(byte_ids, lambda b: tokens(F.transform(chars, lambda x: F.get(b, F.ascii(x))))))

    def cut(self, text: str | Column) -> Column:
        """A text's ids and, between them, the bytes of pieces that are still to be folded (none for NULL)."""
        pattern, pieces = python_pattern(self.pattern), self._pieces
        byte_ids = [np.int32(b).tobytes() for b in self._bytes]

        def parts(texts: pa.Array) -> pa.Array:
            return _cut(texts, pattern, pieces, byte_ids)

        return F.arrow_udf(parts, "array<struct<ids: array<int>, open: boolean>>")(text)

    def joined(self, parts: str | Column) -> Column:
        """Token ids of a text that ``cut`` has cut."""
        c = F.col(parts) if isinstance(parts, str) else parts
        return self._fold(lambda tokens: F.flatten(F.transform(
            c, lambda s: F.when(s["open"], tokens(s["ids"])).otherwise(s["ids"]))))

    def decode(self, ids: str | Column) -> Column:
        """The bytes of the tokens, one after the other."""
        c = F.col(ids) if isinstance(ids, str) else ids
        table = F.from_json(F.lit(json.dumps(self._hex)), T.ArrayType(T.StringType()))
        return F.unhex(F.array_join(_let(table, lambda h: F.transform(c, lambda i: h[i])), ""))


def encoded(docs: DataFrame, tokenizer: ByteBpe, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` plus the token ids of each whole text (a column of that name is replaced)."""
    prepare_python(docs.sparkSession)
    parts, = free_names(docs.withColumn(ids, F.lit(0)), "parts")
    return docs.withColumn(parts, tokenizer.cut(text)).withColumn(ids, tokenizer.joined(parts)).drop(parts)


def digests(docs: DataFrame, tokenizer: ByteBpe) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 for every document.

    NULL and empty texts have no tokens and the digests of empty strings;
    repeated rows give repeated results.
    """
    tokenizer.learn_dictionary(docs)
    rows = encoded(docs.select("doc_id", "text"), tokenizer).select("doc_id", "ids")
    return rows.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(tokenizer.decode("ids"), 256).alias("decoded_sha256"))
