"""Registered queries over the supplied test tables, with DuckDB oracles.

Each entry maps a name to ``(run, oracle_sql)``: ``run(spark, sf_dir)``
returns a DataFrame computed with the library, ``oracle_sql`` is an
independent ANSI-SQL formulation over the raw tables (``None`` where no
engine-neutral formulation exists).  Column names and types agree between
the two.  Every query reads whole tables; limits appear only in top-k
reports, where they are the feature.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.text import STOPWORDS
from tessera.operators import corpus as C
from tessera.operators import files as FL
from tessera.operators import index as IX
from tessera.operators import text as TX
from tessera.operators import trips as TR
from tessera.plans import ingest as IG
from tessera.plans import materialize as M
from tessera.session import fresh_dir
from tessera.sources import tables as DT
from tessera.sources import testdata as TD
from tessera.sources.text import read_lines, read_lines_positioned, read_tsv_corpus
from tessera.sources.trips import read_trips_era, read_trips_partitioned

Run = Callable[[SparkSession, str], DataFrame]

# ------------------------------------------------------------ parameters
TOP_WORDS = 10
TOP_DOCS = 20
TOP_HITS = 10
TOP_TRIPS = 10
SEARCH_WORD = "the"
SEARCH_ALL = ("the", "of", "and")
TITLE_WORD = "widget"
TITLE_ALL = ("red", "widget")
FILTER_WORD = "tion"
FILTER_WORDS = ("der", "que", "tion")
INDEX_BLOCK = 1000
YEARS = TD.TEST_YEARS
ERA_B_FROM = TD.TEST_ERA_B_FROM
PART_YEAR, PART_MONTHS = TD.TEST_PARTITION_YEAR, TD.TEST_PARTITION_MONTHS
REPEATS, COPIES = 2, 3

# ------------------------------------------------------------ SQL pieces
_STOP_SQL = ", ".join(f"'{w}'" for w in STOPWORDS)


def _sql_list(xs) -> str:
    return ", ".join(f"'{x}'" for x in xs)


def _tok(table: str, text: str, keep: str = "") -> str:
    k = f"{keep}, " if keep else ""
    return (f"SELECT {k}unnest(regexp_split_to_array(lower({text}), '[^a-z]+')) AS word "
            f"FROM {table}")


# lineitem -> raw trip values (mirrors sources.testdata.trips_from_lineitem)
_RAW = """
raw AS (
  SELECT
    l_suppkey AS vendorid,
    p_us AS tpep_pickup_datetime,
    p_us + (CAST(l_quantity AS BIGINT) * 60 + 30) * 1000000 AS tpep_dropoff_datetime,
    CASE WHEN l_linenumber = 6 THEN NULL ELSE l_orderkey % 4 + 1 END AS passenger_count,
    (l_quantity - 1) * 0.25 AS trip_distance,
    l_partkey % 5 + 1 AS ratecodeid,
    CASE WHEN l_linestatus = 'F' THEN 'N' ELSE 'Y' END AS store_and_fwd_flag,
    l_partkey % 265 + 1 AS pulocationid,
    l_suppkey % 265 + 1 AS dolocationid,
    CAST(CASE WHEN l_linenumber = 7 AND l_orderkey % 2 = 0 THEN NULL
              WHEN l_linenumber = 7 THEN 0 ELSE l_linenumber END AS BIGINT) AS payment_type,
    fare AS fare_amount,
    CAST(l_linenumber % 3 AS DOUBLE) * 0.5 AS extra,
    CAST(0.5 AS DOUBLE) AS mta_tax,
    tip AS tip_amount,
    tolls AS tolls_amount,
    CAST(1.0 AS DOUBLE) AS improvement_surcharge,
    CASE WHEN l_returnflag = 'R' THEN -fare
         ELSE fare + CAST(l_linenumber % 3 AS DOUBLE) * 0.5 + CAST(0.5 AS DOUBLE) + tip + tolls
              + CAST(1.0 AS DOUBLE) + congestion END AS total_amount,
    congestion AS congestion_surcharge,
    CAST(year(l_shipdate) AS INTEGER) AS file_year,
    CAST(month(l_shipdate) AS INTEGER) AS file_month
  FROM (
    SELECT *,
      CASE WHEN l_orderkey % 1009 = 0 THEN NULL
           ELSE epoch_us(l_shipdate) + ((l_orderkey * 131 + l_linenumber * 3607) % 86400) * 1000000
                + (l_partkey * 7919) % 1000000 END AS p_us,
      floor(l_extendedprice / 50) / 4 AS fare,
      round(l_discount * 100) / 4 AS tip,
      CASE WHEN l_partkey % 10 = 0 THEN CAST(6.25 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS tolls,
      CASE WHEN l_suppkey % 2 = 0 THEN CAST(2.5 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS congestion
    FROM lineitem) li
)"""

_ERA_TYPES = {
    "a": {"vendorid": "BIGINT", "passenger_count": "DOUBLE", "ratecodeid": "DOUBLE",
          "pulocationid": "BIGINT", "dolocationid": "BIGINT"},
    "b": {"vendorid": "INTEGER", "passenger_count": "BIGINT", "ratecodeid": "BIGINT",
          "pulocationid": "INTEGER", "dolocationid": "INTEGER"},
}
_TRIP_COLS = ["vendorid", "tpep_pickup_datetime", "tpep_dropoff_datetime",
              "passenger_count", "trip_distance", "ratecodeid", "store_and_fwd_flag",
              "pulocationid", "dolocationid", "payment_type", "fare_amount", "extra",
              "mta_tax", "tip_amount", "tolls_amount", "improvement_surcharge",
              "total_amount", "congestion_surcharge"]
_UNIFIED_TYPES = {"vendorid": "BIGINT", "passenger_count": "DOUBLE", "ratecodeid": "DOUBLE",
                  "pulocationid": "BIGINT", "dolocationid": "BIGINT"}


def _era_pred(era: str) -> str:
    y, m = ERA_B_FROM
    a = f"(file_year < {y} OR (file_year = {y} AND file_month < {m}))"
    return a if era == "a" else f"NOT {a}"


def _typed(types: dict, stamps: str) -> str:
    cols = []
    for c in _TRIP_COLS:
        if c in ("tpep_pickup_datetime", "tpep_dropoff_datetime"):
            cols.append(stamps.format(c=c))
        elif c in types:
            cols.append(f"CAST({c} AS {types[c]}) AS {c}")
        else:
            cols.append(c)
    return ",\n    ".join(cols)


_RAW_ERA = "WITH " + _RAW + "\nSELECT\n    {cols}\nFROM raw WHERE {pred}"
_UNIFIED = _typed(_UNIFIED_TYPES, "make_timestamp(({c} // 1000000) * 1000000) AS {c}")

_TRIPS_ALL = ("WITH " + _RAW + f""",
unified AS (
  SELECT {_UNIFIED}, file_year, file_month FROM raw
),
trips_all AS (
  SELECT * EXCLUDE (file_year, file_month),
    CAST(year(tpep_pickup_datetime) AS INTEGER) AS anio,
    CAST(month(tpep_pickup_datetime) AS INTEGER) AS mes,
    file_year, file_month
  FROM unified
),
trips AS (
  SELECT * EXCLUDE (file_year, file_month) FROM trips_all
  WHERE tpep_pickup_datetime IS NOT NULL
    AND year(tpep_pickup_datetime) BETWEEN {YEARS[0]} AND {YEARS[1]}
)
""")


def _trips_sql(body: str) -> str:
    return _TRIPS_ALL + body


# ------------------------------------------------------------ helpers

def _docs(spark, sf):
    return TD.documents_corpus(spark, sf)


def _lines(spark, sf):
    return TD.documents_lines(spark, sf)


def _titles(spark, sf):
    return TD.part_titles(spark, sf)


def _trips(spark, sf):
    return read_trips_partitioned(spark, M.trips_table(spark, sf))


def _raw(spark, sf, era):
    return read_trips_era(spark, M.era_path(spark, sf, era), era)


def _numbered_titles(spark, sf):
    part = TD.table(spark, sf, "part").select("p_partkey", F.col("p_name").alias("title"))
    return C.number_corpus(part, order=["p_partkey"])


def _replicated_titles(spark, sf):
    numbered, n = _numbered_titles(spark, sf)
    return C.replicate_corpus(numbered, n, REPEATS, COPIES)


def _lineitem_months(spark, sf):
    li = TD.table(spark, sf, "lineitem")
    return (li.select(F.year("l_shipdate").alias("year"), F.month("l_shipdate").alias("month"))
            .distinct()
            .select(FL.trip_file_name(F.lit("yellow"), "year", "month").alias("file_name"),
                    "year", "month"))


def _expected_months(spark, sf):
    li = TD.table(spark, sf, "lineitem")
    bounds = li.agg(F.min(F.year("l_shipdate")).alias("lo"), F.max(F.year("l_shipdate")).alias("hi"))
    return FL.expand_months(FL.years_between(bounds, "lo", "hi"))


def _ingest_fresh(spark, sf):
    out = fresh_dir(spark, "trips_rebuild")
    IG.ingest_trips(spark, M.era_path(spark, sf, "a"), M.era_path(spark, sf, "b"), out,
                    years=YEARS)
    return read_trips_partitioned(spark, out)


def _routed_fresh(spark, sf):
    out = fresh_dir(spark, "trips_routed")
    IG.ingest_routed(spark, M.trip_landing(spark, sf), out, years=YEARS, era_b_from=ERA_B_FROM)
    return read_trips_partitioned(spark, out)


def _append_fresh(spark, sf):
    out = fresh_dir(spark, "trips_append")
    IG.append_era(spark, M.era_path(spark, sf, "a"), "a", out, years=YEARS)
    IG.append_era(spark, M.era_path(spark, sf, "b"), "b", out, years=YEARS)
    return read_trips_partitioned(spark, out)


def _append_through_name(spark, sf):
    """One era defined as a table, the other inserted through its name."""
    out, name = fresh_dir(spark, "trips_named"), f"trips_{uuid.uuid4().hex[:12]}"
    IG.append_era(spark, M.era_path(spark, sf, "a"), "a", out, years=YEARS)
    DT.define_trips_partitioned_table(spark, name, out)
    IG.append_era_to_table(spark, M.era_path(spark, sf, "b"), "b", name, years=YEARS)
    return spark.sql(f"SELECT * FROM {name}")


def _rebuild_through_name(spark, sf):
    """A table of one era, rebuilt from both beside it and switched."""
    out, name = fresh_dir(spark, "trips_versions"), f"trips_{uuid.uuid4().hex[:12]}"
    IG.rebuild_table(spark, M.era_path(spark, sf, "a"), None, name, out, years=YEARS)
    IG.rebuild_table(spark, M.era_path(spark, sf, "a"), M.era_path(spark, sf, "b"), name, out, years=YEARS)
    return spark.sql(f"SELECT * FROM {name}")


def _era_tables(spark, sf):
    """Era tables defined in one session object, queried by name in another."""
    names = {era: f"era_{era}_{uuid.uuid4().hex[:12]}" for era in ("a", "b")}
    for era, name in names.items():
        DT.define_trips_era_table(spark, name, M.era_path(spark, sf, era), era)
    other = spark.newSession()
    return other.sql(" UNION ALL ".join(
        f"SELECT '{era}' AS era, count(*) AS viajes, count(tpep_pickup_datetime) AS con_hora FROM {name}"
        for era, name in names.items()))


def _stream_fresh(spark, sf):
    from tessera.streaming.ingest import run_trip_ingest
    out = fresh_dir(spark, "trips_stream")
    dirs = {"a": M.era_path(spark, sf, "a"), "b": M.era_path(spark, sf, "b")}
    # bounded micro-batches: the check covers exactly-once over many batches
    run_trip_ingest(spark, dirs, out, out + "-checkpoint", years=YEARS,
                    max_files_per_trigger=16)
    return read_trips_partitioned(spark, out)


def _tokens_filtered(spark, sf, pred):
    return TX.tokenize(_docs(spark, sf), "content", keep=["doc_id"]).where(pred)


# ------------------------------------------------------------ the catalog

def _catalog() -> dict[str, tuple[Run, str | None]]:
    q: dict[str, tuple[Run, str | None]] = {}

    # -- scans / sources
    q["scan_text_lines"] = (
        lambda s, sf: read_lines(s, M.text_lines(s, sf)),
        "SELECT unnest(string_split(text, chr(10))) AS line FROM documents")
    q["scan_tsv_corpus"] = (
        lambda s, sf: read_tsv_corpus(s, M.tsv_corpus(s, sf)),
        "SELECT CAST(p_partkey AS VARCHAR) AS doc_id, p_name AS content FROM part")
    q["scan_trips_era_a"] = (
        lambda s, sf: _raw(s, sf, "a"),
        _RAW_ERA.format(cols=_typed(_ERA_TYPES["a"], "{c}"), pred=_era_pred("a")))
    q["scan_trips_era_b"] = (
        lambda s, sf: _raw(s, sf, "b"),
        _RAW_ERA.format(cols=_typed(_ERA_TYPES["b"], "{c}"), pred=_era_pred("b")))
    q["scan_trips_part"] = (_trips, _trips_sql("SELECT * FROM trips"))

    # -- sinks
    q["trips_partitioned_write"] = (_ingest_fresh, _trips_sql("SELECT * FROM trips"))
    q["trips_routed_write"] = (_routed_fresh, _trips_sql("SELECT * FROM trips"))
    q["trips_era_append"] = (_append_fresh, _trips_sql("SELECT * FROM trips"))
    q["trips_table_append"] = (_append_through_name, _trips_sql("SELECT * FROM trips"))
    q["trips_table_rebuild"] = (_rebuild_through_name, _trips_sql("SELECT * FROM trips"))
    q["era_tables_sql"] = (
        _era_tables, _trips_sql(f"SELECT CASE WHEN {_era_pred('a')} THEN 'a' ELSE 'b' END AS era, count(*) AS viajes, "
                                "sum(CASE WHEN tpep_pickup_datetime IS NULL THEN 0 ELSE 1 END)::BIGINT AS con_hora "
                                "FROM trips_all GROUP BY 1"))
    q["trips_era_append_stream"] = (_stream_fresh, _trips_sql("SELECT * FROM trips"))
    q["show_partitions"] = (
        lambda s, sf: IG.show_partitions(s, M.trips_table(s, sf)),
        _trips_sql("SELECT DISTINCT anio, mes, printf('anio=%d/mes=%d', anio, mes) AS partition "
                   "FROM trips ORDER BY anio, mes"))

    # -- projections, casts, filters
    q["filter_positive"] = (
        lambda s, sf: _trips(s, sf).where(
            TR.positive("trip_distance") & TR.positive("total_amount")),
        _trips_sql("SELECT * FROM trips WHERE trip_distance > 0 AND total_amount > 0"))
    q["filter_year_between"] = (
        lambda s, sf: TR.unify([_raw(s, sf, "a"), _raw(s, sf, "b")], *YEARS),
        _trips_sql("SELECT * FROM trips"))
    q["filter_partition"] = (
        lambda s, sf: TR.in_partitions(_trips(s, sf), PART_YEAR, PART_MONTHS),
        _trips_sql(f"SELECT * FROM trips WHERE anio = {PART_YEAR} "
                   f"AND mes IN ({', '.join(map(str, PART_MONTHS))})"))
    q["cast_era_b"] = (
        lambda s, sf: TR.unify_era(_raw(s, sf, "b")),
        _trips_sql(f"SELECT * EXCLUDE (file_year, file_month) FROM trips_all "
                   f"WHERE {_era_pred('b')}"))
    q["trip_projection"] = (
        lambda s, sf: TR.unify_era(_raw(s, sf, "a")).unionByName(TR.unify_era(_raw(s, sf, "b"))),
        _trips_sql("SELECT * EXCLUDE (file_year, file_month) FROM trips_all"))
    q["payment_label"] = (
        lambda s, sf: _trips(s, sf).select(
            "payment_type", TR.payment_label("payment_type").alias("metodo_pago")).distinct(),
        _trips_sql("""SELECT DISTINCT payment_type,
  CASE payment_type WHEN 1 THEN 'Tarjeta de crédito' WHEN 2 THEN 'Efectivo'
    WHEN 3 THEN 'Sin cargo' WHEN 4 THEN 'Disputa' WHEN 5 THEN 'Desconocido'
    WHEN 6 THEN 'Viaje anulado' ELSE 'Otro' END AS metodo_pago
FROM trips"""))
    q["filter_word_length"] = (
        lambda s, sf: _tokens_filtered(s, sf, F.length("word") > 1),
        f"SELECT * FROM ({_tok('documents', 'text', 'doc_id')}) WHERE length(word) > 1")
    q["filter_stopwords"] = (
        lambda s, sf: _tokens_filtered(
            s, sf, (F.length("word") > 1) & ~F.col("word").isin(*STOPWORDS)),
        f"SELECT * FROM ({_tok('documents', 'text', 'doc_id')}) "
        f"WHERE length(word) > 1 AND word NOT IN ({_STOP_SQL})")
    q["filter_word_eq"] = (
        lambda s, sf: _tokens_filtered(s, sf, F.col("word") == FILTER_WORD),
        f"SELECT * FROM ({_tok('documents', 'text', 'doc_id')}) WHERE word = '{FILTER_WORD}'")
    q["filter_word_in"] = (
        lambda s, sf: _tokens_filtered(s, sf, F.col("word").isin(*FILTER_WORDS)),
        f"SELECT * FROM ({_tok('documents', 'text', 'doc_id')}) "
        f"WHERE word IN ({_sql_list(FILTER_WORDS)})")

    # -- generator
    q["tokenize"] = (
        lambda s, sf: TX.tokenize(_docs(s, sf), "content", keep=["doc_id"]),
        _tok("documents", "text", "doc_id"))

    # -- text aggregations
    q["word_count_top"] = (
        lambda s, sf: TX.word_count_top(_lines(s, sf), "line", TOP_WORDS),
        f"SELECT word, count(*) AS total FROM ({_tok('documents', 'text')}) "
        f"WHERE length(word) > 1 GROUP BY word ORDER BY total DESC, word LIMIT {TOP_WORDS}")
    q["vocabulary_size"] = (
        lambda s, sf: TX.vocabulary_size(_lines(s, sf), "line"),
        f"SELECT count(DISTINCT word) AS palabras_unicas FROM ({_tok('documents', 'text')}) "
        "WHERE length(word) > 1")
    q["doc_frequency"] = (
        lambda s, sf: TX.doc_frequency(_docs(s, sf), TOP_DOCS),
        f"SELECT word, count(DISTINCT doc_id) AS doc_count "
        f"FROM ({_tok('documents', 'text', 'doc_id')}) "
        f"WHERE length(word) > 1 AND word NOT IN ({_STOP_SQL}) "
        f"GROUP BY word ORDER BY doc_count DESC, word LIMIT {TOP_DOCS}")
    q["doc_frequency_all"] = (
        lambda s, sf: TX.doc_frequency(_docs(s, sf), TOP_DOCS, stopwords=None),
        f"SELECT word, count(DISTINCT doc_id) AS doc_count "
        f"FROM ({_tok('documents', 'text', 'doc_id')}) "
        f"WHERE length(word) > 1 GROUP BY word ORDER BY doc_count DESC, word LIMIT {TOP_DOCS}")
    q["inverted_index"] = (
        lambda s, sf: TX.inverted_index(_docs(s, sf), TOP_DOCS, block_size=INDEX_BLOCK),
        f"""WITH w AS (
  SELECT DISTINCT doc_id, word FROM ({_tok('documents', 'text', 'doc_id')})
  WHERE length(word) > 1 AND word NOT IN ({_STOP_SQL})),
top AS (
  SELECT word, count(DISTINCT doc_id) AS doc_count FROM w
  GROUP BY word ORDER BY doc_count DESC, word LIMIT {TOP_DOCS}),
b AS (
  SELECT w.word, top.doc_count, list_sort(list(DISTINCT w.doc_id)) AS ids,
         ('0x' || substr(md5(CAST(w.doc_id AS VARCHAR)), 1, 8))::BIGINT
           % CAST(greatest(1, ceil(top.doc_count / {INDEX_BLOCK})) AS BIGINT) AS bucket
  FROM w JOIN top ON w.word = top.word GROUP BY w.word, top.doc_count, bucket),
s AS (SELECT *, unnest(range(0, CAST(ceil(len(ids) / {INDEX_BLOCK}) AS BIGINT))) AS part FROM b)
SELECT word, doc_count, bucket * 1048576 + part AS block,
       array_to_string(ids[part * {INDEX_BLOCK} + 1:(part + 1) * {INDEX_BLOCK}], ',') AS doc_list
FROM s""")
    q["inverted_index_postings"] = (
        lambda s, sf: TX.postings(_docs(s, sf)),
        f"SELECT word, doc_id, count(*) AS tf FROM ({_tok('documents', 'text', 'doc_id')}) "
        f"WHERE length(word) > 1 AND word NOT IN ({_STOP_SQL}) GROUP BY word, doc_id")

    def _search_sql(table, id_col, text_col, terms):
        where = (f"word = '{terms[0]}'" if len(terms) == 1
                 else f"word IN ({_sql_list(terms)})")
        having = "" if len(terms) == 1 else f" HAVING count(DISTINCT word) = {len(terms)}"
        return (f"SELECT {id_col} AS doc_id, {text_col} AS titulo, count(*) AS score "
                f"FROM ({_tok(table, text_col, id_col + ', ' + text_col)}) "
                f"WHERE {where} GROUP BY {id_col}, {text_col}{having} "
                f"ORDER BY score DESC, doc_id, titulo LIMIT {TOP_HITS}")

    q["search_word"] = (
        lambda s, sf: TX.search_word(_docs(s, sf), SEARCH_WORD, TOP_HITS),
        _search_sql("documents", "doc_id", "text", [SEARCH_WORD]))
    q["search_all_words"] = (
        lambda s, sf: TX.search_all_words(_docs(s, sf), SEARCH_ALL, TOP_HITS),
        _search_sql("documents", "doc_id", "text", list(SEARCH_ALL)))
    q["search_word_titles"] = (
        lambda s, sf: TX.search_word(_titles(s, sf), TITLE_WORD, TOP_HITS),
        _search_sql("part", "p_partkey", "p_name", [TITLE_WORD]))
    q["search_all_words_titles"] = (
        lambda s, sf: TX.search_all_words(_titles(s, sf), TITLE_ALL, TOP_HITS),
        _search_sql("part", "p_partkey", "p_name", list(TITLE_ALL)))

    # the stored index: written to a fresh table, read back through its name
    def _indexed(s, sf, corpus, terms):
        name = f"postings_{uuid.uuid4().hex[:12]}"
        IX.write_index(corpus(s, sf), name, fresh_dir(s, "index"), buckets=16, shards=4)
        return IX.search_with_texts(s, name, corpus(s, sf), terms, TOP_HITS)

    q["index_search_all_words"] = (
        lambda s, sf: _indexed(s, sf, _docs, SEARCH_ALL),
        _search_sql("documents", "doc_id", "text", list(SEARCH_ALL)))
    q["index_search_titles"] = (
        lambda s, sf: _indexed(s, sf, _titles, TITLE_ALL),
        _search_sql("part", "p_partkey", "p_name", list(TITLE_ALL)))

    # -- trip aggregations and top-k
    q["trip_total"] = (lambda s, sf: TR.trip_total(_trips(s, sf)),
                       _trips_sql("SELECT count(*) AS total_viajes FROM trips"))
    q["distance_stats"] = (
        lambda s, sf: TR.distance_stats(_trips(s, sf)),
        _trips_sql("SELECT round(avg(trip_distance), 3) AS distancia_promedio, "
                   "round(max(trip_distance), 2) AS distancia_maxima "
                   "FROM trips WHERE trip_distance > 0"))
    q["distance_avg"] = (
        lambda s, sf: TR.distance_avg(_trips(s, sf)),
        _trips_sql("SELECT round(avg(trip_distance), 3) AS distancia_promedio "
                   "FROM trips WHERE trip_distance > 0"))
    q["trips_by_hour"] = (
        lambda s, sf: TR.trips_by_hour(_trips(s, sf)),
        _trips_sql("SELECT CAST(hour(tpep_pickup_datetime) AS INTEGER) AS hora, "
                   "count(*) AS viajes FROM trips GROUP BY hora "
                   "ORDER BY viajes DESC, hora NULLS LAST"))
    q["payment_methods"] = (
        lambda s, sf: TR.payment_methods(_trips(s, sf)),
        _trips_sql("""SELECT payment_type,
  CASE payment_type WHEN 1 THEN 'Tarjeta de crédito' WHEN 2 THEN 'Efectivo'
    WHEN 3 THEN 'Sin cargo' WHEN 4 THEN 'Disputa' WHEN 5 THEN 'Desconocido'
    WHEN 6 THEN 'Viaje anulado' ELSE 'Otro' END AS metodo_pago,
  count(*) AS viajes, round(avg(total_amount), 2) AS ticket_promedio
FROM trips GROUP BY payment_type ORDER BY viajes DESC, payment_type NULLS LAST"""))
    q["payment_counts"] = (
        lambda s, sf: TR.payment_counts(_trips(s, sf)),
        _trips_sql("SELECT payment_type, count(*) AS viajes FROM trips "
                   "GROUP BY payment_type ORDER BY viajes DESC, payment_type NULLS LAST"))
    q["top_trips"] = (
        lambda s, sf: TR.top_trips(_trips(s, sf), TOP_TRIPS),
        _trips_sql("SELECT tpep_pickup_datetime, trip_distance, payment_type, total_amount "
                   "FROM trips WHERE total_amount > 0 ORDER BY total_amount DESC, "
                   "tpep_pickup_datetime NULLS LAST, trip_distance NULLS LAST, "
                   f"payment_type NULLS LAST LIMIT {TOP_TRIPS}"))
    q["top_trips_narrow"] = (
        lambda s, sf: TR.top_trips_narrow(_trips(s, sf), TOP_TRIPS),
        _trips_sql("SELECT tpep_pickup_datetime, trip_distance, total_amount "
                   "FROM trips WHERE total_amount > 0 ORDER BY total_amount DESC, "
                   "tpep_pickup_datetime NULLS LAST, trip_distance NULLS LAST "
                   f"LIMIT {TOP_TRIPS}"))
    months_sql = ", ".join(map(str, PART_MONTHS))
    q["monthly_revenue"] = (
        lambda s, sf: TR.monthly_revenue(_trips(s, sf), PART_YEAR, PART_MONTHS),
        _trips_sql("SELECT anio, mes, count(*) AS viajes, "
                   "round(avg(fare_amount), 2) AS tarifa_promedio, "
                   "round(sum(total_amount), 2) AS recaudacion FROM trips "
                   f"WHERE anio = {PART_YEAR} AND mes IN ({months_sql}) "
                   "GROUP BY anio, mes ORDER BY anio, mes"))
    q["monthly_counts"] = (
        lambda s, sf: TR.monthly_counts(_trips(s, sf), PART_YEAR, PART_MONTHS),
        _trips_sql("SELECT anio, mes, count(*) AS viajes FROM trips "
                   f"WHERE anio = {PART_YEAR} AND mes IN ({months_sql}) "
                   "GROUP BY anio, mes ORDER BY anio, mes"))
    q["partition_count"] = (
        lambda s, sf: TR.partition_count(_trips(s, sf), PART_YEAR, PART_MONTHS[0]),
        _trips_sql(f"SELECT count(*) AS viajes FROM trips "
                   f"WHERE anio = {PART_YEAR} AND mes = {PART_MONTHS[0]}"))

    # -- corpus preparation
    numbered_sql = """WITH t AS (
  SELECT p_partkey, regexp_replace(p_name, '^\\s+|\\s+$', '', 'g') AS title FROM part),
c AS (SELECT * FROM t WHERE title <> ''),
n AS (SELECT title, row_number() OVER (ORDER BY p_partkey) AS n FROM c),
tot AS (SELECT count(*) AS cnt FROM c)
"""
    q["number_corpus"] = (
        lambda s, sf: _numbered_titles(s, sf)[0],
        numbered_sql + "SELECT 'doc_' || lpad(CAST(n AS VARCHAR), CAST(length(CAST(cnt AS VARCHAR)) AS INTEGER), '0')"
        " || '.txt' AS doc_id, title AS content, n FROM n, tot")
    q["number_corpus_file_order"] = (
        lambda s, sf: C.number_corpus_file_order(read_lines_positioned(s, M.title_lines(s, sf)))[0],
        numbered_sql + "SELECT 'doc_' || lpad(CAST(n AS VARCHAR), CAST(length(CAST(cnt AS VARCHAR)) AS INTEGER), '0')"
        " || '.txt' AS doc_id, title AS content, n FROM n, tot")
    def _build_titles(s, sf, what="corpus"):
        from tessera.plans.build import build_title_corpus
        titles = M.title_lines(s, sf)
        single = C.title_bytes(read_lines(s, titles).withColumnRenamed("line", "title"))
        res = build_title_corpus(s, titles, fresh_dir(s, "title_corpus"),
                                 target_bytes=6 * single, part_bytes=2 * single)
        return read_tsv_corpus(s, res[what])
    q["doc_map_sink"] = (
        lambda s, sf: _build_titles(s, sf, "doc_map"),
        numbered_sql + "SELECT 'doc_' || lpad(CAST(r.r * cnt + n AS VARCHAR), "
        "CAST(length(CAST(cnt * 2 AS VARCHAR)) AS INTEGER), '0') || '.txt' AS doc_id, "
        "title AS content FROM n, tot, range(0, 2) r(r)")
    q["build_title_corpus"] = (
        _build_titles,
        numbered_sql + "SELECT 'doc_' || lpad(CAST(r.r * cnt + n AS VARCHAR), "
        "CAST(length(CAST(cnt * 2 AS VARCHAR)) AS INTEGER), '0') || '.txt' AS doc_id, "
        "title AS content FROM n, tot, range(0, 2) r(r), range(1, 4) k(k)")
    q["doc_map"] = (
        lambda s, sf: C.doc_map(_numbered_titles(s, sf)[0]),
        numbered_sql + "SELECT 'doc_' || lpad(CAST(n AS VARCHAR), CAST(length(CAST(cnt AS VARCHAR)) AS INTEGER), '0')"
        " || '.txt' AS doc_id, title FROM n, tot")
    q["replicate_corpus"] = (
        _replicated_titles,
        numbered_sql + "SELECT 'doc_' || lpad(CAST(r.r * cnt + n AS VARCHAR), "
        f"CAST(length(CAST(cnt * {REPEATS} AS VARCHAR)) AS INTEGER), '0') || '.txt' AS doc_id, "
        "title AS content, CAST(k.k AS INTEGER) AS copy "
        f"FROM n, tot, range(0, {REPEATS}) r(r), range(1, {COPIES + 1}) k(k)")
    replicated_sql = numbered_sql + f""", rep AS (
  SELECT 'doc_' || lpad(CAST(r.r * cnt + n AS VARCHAR),
                        CAST(length(CAST(cnt * {REPEATS} AS VARCHAR)) AS INTEGER), '0')
         || '.txt' AS doc_id, title AS content
  FROM n, tot, range(0, {REPEATS}) r(r), range(1, {COPIES + 1}) k(k))
"""
    q["search_word_replicated"] = (
        lambda s, sf: TX.search_word(
            _replicated_titles(s, sf).drop("copy"),
            TITLE_WORD, TOP_HITS),
        replicated_sql + "SELECT doc_id, content AS titulo, count(*) AS score FROM ("
        + _tok("rep", "content", "doc_id, content") + f") WHERE word = '{TITLE_WORD}' "
        f"GROUP BY doc_id, content ORDER BY score DESC, doc_id, titulo LIMIT {TOP_HITS}")
    q["doc_frequency_replicated"] = (
        lambda s, sf: TX.doc_frequency(
            _replicated_titles(s, sf).drop("copy"), TOP_DOCS),
        replicated_sql + "SELECT word, count(DISTINCT doc_id) AS doc_count FROM ("
        + _tok("rep", "content", "doc_id") + f") WHERE length(word) > 1 AND word NOT IN "
        f"({_STOP_SQL}) GROUP BY word ORDER BY doc_count DESC, word LIMIT {TOP_DOCS}")
    q["corpus_stats"] = (
        lambda s, sf: C.corpus_stats(_docs(s, sf), "content"),
        "SELECT count(*) AS n_docs, CAST(sum(len(string_split(text, chr(10)))) AS BIGINT) AS n_lines, "
        "CAST(sum(strlen(text) + 1) AS BIGINT) AS n_bytes, "
        "CAST(sum(strlen(text) + 1) AS DOUBLE) / 1048576.0 AS mb FROM documents")

    # -- file bookkeeping
    months_cte = """WITH m AS (
  SELECT DISTINCT CAST(year(l_shipdate) AS INTEGER) AS year,
                  CAST(month(l_shipdate) AS INTEGER) AS month FROM lineitem),
f AS (SELECT printf('yellow_tripdata_%04d-%02d.parquet', year, month) AS file_name,
             year, month FROM m)
"""
    y, mth = ERA_B_FROM
    q["classify_era"] = (
        lambda s, sf: FL.classify_era(_lineitem_months(s, sf), "file_name", ERA_B_FROM).select(
            "file_name", "trip_type", "year", "month", "era"),
        months_cte + "SELECT file_name, 'yellow' AS trip_type, year, month, "
        f"CASE WHEN year < {y} OR (year = {y} AND month < {mth}) THEN 'a' ELSE 'b' END AS era "
        "FROM f")
    expected_cte = """WITH b AS (
  SELECT min(year(l_shipdate)) AS lo, max(year(l_shipdate)) AS hi FROM lineitem),
e AS (
  SELECT printf('yellow_tripdata_%04d-%02d.parquet', y.y, m.m) AS file_name,
         CAST(y.y AS INTEGER) AS year, CAST(m.m AS INTEGER) AS month
  FROM b, range(b.lo, b.hi + 1) y(y), range(1, 13) m(m))
"""
    q["expand_months"] = (_expected_months, expected_cte + "SELECT * FROM e")
    q["missing_files"] = (
        lambda s, sf: FL.missing_files(_expected_months(s, sf), _lineitem_months(s, sf)),
        expected_cte + """, f AS (
  SELECT DISTINCT printf('yellow_tripdata_%04d-%02d.parquet',
                         year(l_shipdate), month(l_shipdate)) AS file_name FROM lineitem)
SELECT * FROM e WHERE file_name NOT IN (SELECT file_name FROM f)""")
    q["source_inventory"] = (
        lambda s, sf: FL.source_inventory(
            s, {"a": M.era_path(s, sf, "a"), "b": M.era_path(s, sf, "b")}).select("era", "n_months"),
        months_cte + f"SELECT CASE WHEN year < {y} OR (year = {y} AND month < {mth}) THEN 'a' ELSE 'b' END AS era, "
        "count(*) AS n_months FROM f GROUP BY 1")
    # a named, partitioned table defined over its folder, and SQL over the name
    def _defined_table(s, sf):
        name = f"trips_defined_{abs(hash(sf)) % 10**8}"
        DT.define_trips_partitioned_table(s, name, M.trips_table(s, sf))
        return s.sql(f"SELECT anio, mes, count(*) AS viajes, min(tpep_pickup_datetime) AS first_pickup "
                     f"FROM {name} WHERE mes <= 6 GROUP BY anio, mes")
    q["defined_table_sql"] = (
        _defined_table,
        _trips_sql("SELECT anio, mes, count(*) AS viajes, min(tpep_pickup_datetime) AS first_pickup "
                   "FROM trips WHERE mes <= 6 GROUP BY anio, mes"))
    return q


CATALOG = _catalog()


def queries() -> dict[str, Run]:
    return {k: v[0] for k, v in CATALOG.items()}


def oracle_sql() -> dict[str, str]:
    return {k: v[1] for k, v in CATALOG.items() if v[1] is not None}
