"""Named tables over a location: drop-and-recreate definitions.

Each function replaces any previous definition of the name, like
``DROP TABLE IF EXISTS`` + ``CREATE EXTERNAL TABLE ... LOCATION``; no data is
read or moved.  The definitions are catalog objects, not temporary views: a
later session over the same catalog finds them.  The names work in
``spark.sql`` -- including ``LATERAL VIEW EXPLODE(...)`` queries and, for the
partitioned trip table, ``SHOW PARTITIONS`` and ``INSERT INTO``.

A session without a persistent catalog (no Hive metastore) keeps them as long
as the application runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera import schemas
from tessera.sources.text import HIVE_NULL


def quoted(name: str) -> str:
    """A possibly qualified name with its parts quoted."""
    return ".".join("`" + part.replace("`", "``") + "`" for part in name.split("."))


def _string(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _drop(spark: SparkSession, name: str) -> None:
    """Remove what the name stands for: a table, a view or a temporary view that hides them."""
    if "." not in name:
        spark.catalog.dropTempView(name)
    if spark.catalog.tableExists(name):
        kind = "VIEW" if spark.catalog.getTable(name).tableType == "VIEW" else "TABLE"
        spark.sql(f"DROP {kind} IF EXISTS {quoted(name)}")


def _ddl(schema) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def _create(spark: SparkSession, name: str, columns: str, source: str, location: str, partitioned: str = "") -> None:
    _drop(spark, name)
    spark.sql(f"CREATE TABLE {quoted(name)} ({columns}) USING {source} {partitioned} LOCATION {_string(location)}")


def define_lines_table(spark: SparkSession, name: str, location: str) -> DataFrame:
    """``name(line STRING)`` over every text file in ``location``."""
    _create(spark, name, "line STRING", "text", location)
    return spark.table(name)


def define_corpus_table(spark: SparkSession, name: str, location: str,
                        map_null_marker: bool = False) -> DataFrame:
    """``name(doc_id STRING, content STRING)`` over tab-separated files.

    A view that splits the lines of the table ``name__lines``: Spark's CSV
    source would turn empty fields into NULL and skip blank lines.
    """
    lines = f"{name}__lines"
    _drop(spark, name)
    define_lines_table(spark, lines, location)

    def field(i: int) -> str:
        value = f"get(split(line, '\\t', -1), {i})"
        return f"nullif({value}, {_string(HIVE_NULL)})" if map_null_marker else value

    spark.sql(f"CREATE VIEW {quoted(name)} AS SELECT {field(0)} AS doc_id, {field(1)} AS content FROM {quoted(lines)}")
    return spark.table(name)


def define_trips_era_table(spark: SparkSession, name: str, location: str, era: str) -> DataFrame:
    """``name`` with one era's exact declared types over its Parquet folder.

    Folders per file below ``location`` are read like files; their names are no columns.
    """
    _drop(spark, name)
    spark.sql(f"CREATE TABLE {quoted(name)} ({_ddl(schemas.ERAS[era.lower()])}) USING parquet "
              f"OPTIONS (recursiveFileLookup 'true') LOCATION {_string(location)}")
    return spark.table(name)


def define_trips_partitioned_table(spark: SparkSession, name: str, location: str) -> DataFrame:
    """Catalog table over a (anio, mes)-partitioned Parquet folder.

    The partitions found in the folder are registered in the catalog, so
    ``SHOW PARTITIONS name`` lists them and filters on anio/mes prune.
    """
    _create(spark, name, _ddl(schemas.PARTITIONED), "parquet", location, "PARTITIONED BY (anio, mes)")
    return recover_partitions(spark, name)


def recover_partitions(spark: SparkSession, name: str) -> DataFrame:
    """Register the folder's partitions that the catalog does not know yet.

    For months that were written past the table, straight into its folder.
    """
    spark.sql(f"ALTER TABLE {quoted(name)} RECOVER PARTITIONS")
    spark.sql(f"REFRESH TABLE {quoted(name)}")
    return spark.table(name)


def swap_table(spark: SparkSession, name: str, new: str) -> DataFrame:
    """Let ``name`` stand for the external table ``new``; the old definition goes.

    Both steps only rename catalog entries.  If the second fails, the first is
    taken back.  The old table's files stay where they are.
    """
    old = f"{name}__old"
    _drop(spark, old)
    there = spark.catalog.tableExists(name)
    if there:
        spark.sql(f"ALTER TABLE {quoted(name)} RENAME TO {quoted(old)}")
    try:
        spark.sql(f"ALTER TABLE {quoted(new)} RENAME TO {quoted(name)}")
    except Exception:
        if there:
            spark.sql(f"ALTER TABLE {quoted(old)} RENAME TO {quoted(name)}")
        raise
    _drop(spark, old)
    spark.sql(f"REFRESH TABLE {quoted(name)}")
    return spark.table(name)
