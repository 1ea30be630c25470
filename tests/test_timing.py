"""R10: per-query wall clock and per-stage times from the event log."""

import glob
import subprocess
import sys
import textwrap

from tests.conftest import ROOT


def test_stage_timings_from_event_log(tmp_path):
    # event logging is a start-up setting: run in a session of its own
    log = tmp_path / "events"
    log.mkdir()
    code = textwrap.dedent(f"""
        import sys
        sys.path.insert(0, {ROOT!r})
        from tessera.session import local_session
        from tessera.plans.timing import time_queries, query_stage_summary
        from tessera.operators import text as TX
        spark = local_session(4, extra={{"spark.eventLog.enabled": "true",
                                        "spark.eventLog.dir": {str(log)!r},
                                        "spark.eventLog.rolling.enabled": "false",
                                        "spark.eventLog.compress": "false"}})
        df = spark.createDataFrame([(1, "a b c a"), (2, "b c")], "doc_id bigint, content string")
        q = {{"wc": lambda s, sf: TX.word_count_top(df, "content"),
              "df": lambda s, sf: TX.doc_frequency(df)}}
        t = time_queries(spark, q, "")
        assert set(t) == {{"wc", "df"}} and all(v["sec"] > 0 for v in t.values())
        spark.stop()
    """)
    subprocess.run([sys.executable, "-c", code], check=True, timeout=300)
    import os
    files = [f for f in glob.glob(str(log / "*")) if not os.path.isdir(f)]
    assert files
    from tessera.session import local_session
    from tessera.plans.timing import query_stage_summary
    spark = local_session(4)
    rows = {r.query: r for r in query_stage_summary(spark, files[0]).collect()}
    assert {"wc", "df"} <= set(rows)
    assert rows["df"].stages >= 2 and rows["wc"].tasks >= 1
    assert rows["df"].max_task_ms is not None
