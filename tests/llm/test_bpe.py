"""Byte-level BPE against the tiktoken library."""
import hashlib
import random

import pytest

tiktoken = pytest.importorskip("tiktoken")
P = pytest.importorskip("public_tokenizers")

from tessera.llm import bpe, catalog  # noqa: E402


def texts():
    rng = random.Random(3)
    return [None, "", " ", "a", "  a  b ", "it's we're I'll x'd", "aaaa" * 50, "aaa" * 300, "ab" * 700, "日本語のテキスト" * 120,
            " x y　\u0085z", "\n\n x\n  y", "¼²٣٤ १२", "é" * 301, "!!!??—…" * 90,
            "\U0001F600\U0001F601 hi\U0001F600" * 30, "".join(chr(rng.randint(0x4E00, 0x9FFF)) for _ in range(600)),
            "".join(rng.choice("abcdefgh") for _ in range(1500)), "\x1f\x1c\x0b\x0c a", "a​b", "don’t", "word " * 30_000]


@pytest.mark.parametrize("dictionary", [True, False])
def test_ids_and_bytes_equal_the_library(spark, dictionary):
    ranks = bpe.read_ranks(P.path(catalog.RANK_FILE))
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    df = spark.createDataFrame(list(enumerate(texts())), "doc_id long, text string")
    t = bpe.ByteBpe(ranks, P.PATTERN)
    if dictionary:
        got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.digests(df, t).collect()}
        for i, x in enumerate(texts()):
            ids = library.encode_ordinary(x or "")
            assert got[i] == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                              hashlib.sha256((x or "").encode()).hexdigest()), i
    else:
        short = df.filter("length(text) < 100 OR text IS NULL").selectExpr("*", "'clash' AS ids")
        for r in bpe.encoded(short, t).collect():
            assert list(r.ids) == library.encode_ordinary(r.text or "")


@pytest.mark.parametrize("shift", [0, 1000])
def test_any_vocabulary_and_pieces_outside_the_dictionary(spark, shift):
    rng = random.Random(5)
    tokens = [bytes([b]) for b in range(256)]
    while len(tokens) < 700:                 # merges in no order of length, with overlaps
        new = rng.choice(tokens[97:103] + tokens[256:]) + rng.choice(tokens[97:103])
        tokens += [new] if new not in tokens and len(new) < 9 else []
    ranks = {t: i + shift for i, t in enumerate(tokens)}
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rows = [(i % 40, " ".join("".join(rng.choice("abcdef") for _ in range(rng.choice([1, 5, 9, 300]))) for _ in range(9)) + " often") for i in range(60)]
    t = bpe.ByteBpe(ranks, P.PATTERN)
    df = spark.createDataFrame(rows, "parts long, text string")
    for most in (0, 3, 1 << 18):
        for r in bpe.encoded(df, t.learn_dictionary(df, most=most), ids="Parts2").collect():
            assert list(r.Parts2) == library.encode_ordinary(r.text) and r.parts < 40


def test_the_plan_does_not_hold_the_dictionary(spark):
    words = ["zq" + "".join(chr(97 + k // 26 ** j % 26) for j in range(4)) for k in range(40_000)]
    df = spark.createDataFrame([(i, " ".join(words)) for i in range(2)], "doc_id long, text string")
    node, held = bpe.encoded(df, catalog.tokenizer().learn_dictionary(df))._jdf.queryExecution().analyzed(), ""
    while node is not None:
        held += node.expressions().mkString()
        node = None if node.children().isEmpty() else node.children().head()
    assert "from_json" in held and words[-1] not in held


def test_empty_table(spark):
    assert bpe.digests(spark.createDataFrame([], "doc_id long, text string"), catalog.tokenizer()).count() == 0
