"""Delta-maintained rollups."""
import pytest

from tessera.llm import token_counts as C
from tessera.session import fresh_dir


def totals(r):
    return {(x.source, x.lang, x.tokenizer): (x.docs, x.tokens) for x in r.totals().collect()}


def test_inserts_revisions_deletes_and_replays(spark):
    def batch(*rows):
        return spark.createDataFrame(list(rows), C.CHANGES)
    r = C.TokenRollup(spark, fresh_dir(spark, "rollup-test"))
    assert totals(r) == {}
    first = batch((1, "t", "insert", "a", "en", 10), (2, "t", "insert", "a", "en", 5), (3, "t", None, None, None, None),
                  (None, "t", "insert", "a", "en", 99), (4, None, "insert", "a", "en", 99), (1, "t", "insert", "a", "en", 10))
    assert r.commit(0, first)
    assert totals(r) == {("a", "en", "t"): (2, 15), (None, None, "t"): (1, 0)}
    assert not r.commit(0, first) and totals(r)[("a", "en", "t")] == (2, 15)
    assert r.commit(1, batch((1, "t", "revise", "b", "en", 7), (2, "t", "delete", "x", "y", 123), (9, "t", "delete", "a", "en", 1),
                             (8, "u", "revise", "a", "de", 4)))
    assert totals(r) == {("b", "en", "t"): (1, 7), ("a", "de", "u"): (1, 4), (None, None, "t"): (1, 0)}
    assert r.commit(2, batch((2, "t", "insert", "a", "en", 6)))       # back again
    assert totals(r)[("a", "en", "t")] == (1, 6)
    assert r.commit(3, batch()) and totals(r)[("a", "en", "t")] == (1, 6)
    again = C.TokenRollup(spark, r.folder)                           # state is the folder alone
    assert again.batches() == [0, 1, 2, 3] and totals(again) == totals(r)


def test_late_batches_are_refused(spark):
    r = C.TokenRollup(spark, fresh_dir(spark, "rollup-test"))
    assert r.commit(5, spark.createDataFrame([(1, "t", "insert", "a", "en", 10)], C.CHANGES))
    with pytest.raises(ValueError, match="batch 3 comes after batch 5"):
        r.commit(3, spark.createDataFrame([(1, "t", "insert", "a", "en", 7)], C.CHANGES))
    assert not r.commit(5, spark.createDataFrame([], C.CHANGES))      # a replay is no late batch
    assert totals(r) == {("a", "en", "t"): (1, 10)}


def test_batch_cut_off_before_its_deltas_is_written_again(spark):
    r = C.TokenRollup(spark, fresh_dir(spark, "rollup-test"))
    change = spark.createDataFrame([(1, "t", "insert", "a", "en", 10)], C.CHANGES)
    change.selectExpr("doc_id", "tokenizer", "source", "lang", "n_tokens", "true AS there").write.parquet(r._path("images", 0))
    assert totals(r) == {} and r.commit(0, change)
    assert totals(r) == {("a", "en", "t"): (1, 10)}


def test_documents_with_nulls_and_empty_table(docs_of):
    rows = [(1, "w " * 30, "en", "a"), (2, "short", "en", "a"), (3, None, None, None), (4, "q1 " * 25, None, "a")]
    got = {(x.source, x.lang, x.tokenizer): (x.docs, x.tokens) for x in C.document_token_counts(docs_of(rows)).collect()}
    assert got == {("a", "en", "words-1"): (2, 31), ("a", "en", "runs-2"): (2, 31), ("a", None, "words-1"): (1, 25),
                   ("a", None, "runs-2"): (1, 25), (None, None, "words-1"): (1, 0), (None, None, "runs-2"): (1, 0)}
    assert C.document_token_counts(docs_of([])).count() == 0


def test_every_row_counts_also_without_id_and_where_ids_repeat(docs_of):
    rows = [(None, "w " * 30, "en", "a"), (None, "w " * 30, "en", "a"), (None, "v " * 40, "en", "a"), (5, "w " * 30, "en", "a"),
            (5, "w " * 30, "en", "a"), (5, "w " * 30, "de", "b"), (5, "u " * 50, "en", "a")]
    got = {(x.source, x.lang, x.tokenizer): (x.docs, x.tokens) for x in C.document_token_counts(docs_of(rows)).collect()}
    assert got == {(s, l, t): v for t in ("words-1", "runs-2") for (s, l), v in {("a", "en"): (6, 210), ("b", "de"): (1, 30)}.items()}
