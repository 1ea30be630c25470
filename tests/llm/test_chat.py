"""Chat formatting: round trips, loss masks, role order."""
import hashlib

from tessera.llm import catalog, chat

SCHEMA = "conv_id long, turn long, role string, text string"
ODD = ["", None, "\\", "\\\\</s>", "</s>", "<s>", "[INST]", "\\[INST]", "[/INST]</s>\n<s>[INST] x", "ends with \\", "[TURN:41] ",
       " lead", "trail ", "\n", "é日本", "[REPLY", "]", "a [/REPLY]</s>\n"]


def convs(spark):
    rows = []
    for c, text in enumerate(ODD):
        rows += [(c, 0, "system", text), (c, 1, "user", text), (c, 2, "assistant", text), (c, 3, "we]ird [x", text), (c, 4, None, text)]
    return spark.createDataFrame(rows, SCHEMA)


def test_round_trip_of_every_text(spark):
    got = {r.conv_id: [tuple(t) for t in r.turns] for r in chat.read_back(chat.formatted(convs(spark))).collect()}
    for c, text in enumerate(ODD):
        t = text or ""
        assert got[c] == [("system", t, False), ("user", t, False), ("assistant", t, True), ("we]ird [x", t, False), ("", t, False)]


def test_digests_of_the_probe(spark):
    p = catalog.PROBE
    d = chat.digests(spark.createDataFrame([(-1, 0, "user", p), (-1, 1, "assistant", p)], SCHEMA)).collect()[0]
    assert (d.n_turns, d.loss_chars, d.valid) == (2, len(p), True)
    assert d.turns_sha256 == hashlib.sha256(f"user\n{p}\nassistant\n{p}\n".encode()).hexdigest()
    assert d.loss_sha256 == hashlib.sha256(p.encode()).hexdigest()


def test_machine_accepts_orders(spark):
    orders = {"user,assistant": True, "system,user,assistant": True, "user,assistant,user,assistant": True, "user": False,
              "assistant,user": False, "system,system,user,assistant": False, "user,user,assistant": False, "tool": False}
    rows = [(i, t, role, "x") for i, o in enumerate(orders) for t, role in enumerate(o.split(","))]
    got = {r.conv_id: r.valid for r in chat.formatted(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert [got[i] for i in range(len(orders))] == list(orders.values())


def test_segments_join_to_the_formatted_text(spark):
    c = convs(spark)
    whole = {r.conv_id: r.formatted for r in chat.formatted(c).collect()}
    parts = {}
    for s in sorted(chat.segments(c).collect(), key=lambda s: (s.conv_id, s.position, s.part)):
        parts[s.conv_id] = parts.get(s.conv_id, "") + s.text
        assert s.loss == (s.role == "assistant" and s.part == 1)
    assert parts == whole


def test_ties_repeats_nulls_extra_columns_and_empty(spark):
    rows = [(1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "user", "a"), (None, None, None, None), (1, None, "system", "s")]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' AS formatted", "1 AS valid", "2 AS position")
    got = {r.conv_id: [(t.role, t.text) for t in r.turns] for r in chat.read_back(chat.formatted(df)).collect()}
    assert got == {1: [("system", "s"), ("user", "a"), ("user", "a"), ("user", "b")], None: [("", "")]}
    assert chat.segments(df).count() == 15
    assert chat.digests(spark.createDataFrame([], SCHEMA)).count() == 0
