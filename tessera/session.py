"""Session settings and the shared work folder.

Only the settings that change *results* are forced here (UTC session zone).
Everything that is cluster sizing (shuffle partitions, memory) belongs to the
deployment; ``local_session`` is the test/bench convenience.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job in the library relies on for correct results.
SEMANTIC_CONF = {
    # from_unixtime / hour() etc. follow the session zone; pin it (S9).
    "spark.sql.session.timeZone": "UTC",
    # source files name columns VendorID, PULocationID, ...; the declared
    # schemas use lower case and rely on case-insensitive resolution (S11)
    "spark.sql.caseSensitive": "false",
}

# Runtime re-planning; the sizes are for local runs (local_session).
ADAPTIVE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # 64 MB per reducer, the per-reducer input the reference asks Hive for.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the result-relevant settings (and AQE) to a running session.

    Sizing (advisory partition size, shuffle partitions) is left to the
    deployment: a 100 TB shuffle wants far larger reducer inputs than a test.
    """
    for k, v in SEMANTIC_CONF.items():
        spark.conf.set(k, v)
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    return spark


def _driver_memory(cap_gb: int = 8) -> str:
    """At most ``cap_gb`` and at most 60 % of this machine's memory."""
    try:
        total = os.sysconf("SC_PAGE_SIZE") * os.sysconf("SC_PHYS_PAGES")
        gb = max(1, min(cap_gb, int(total * 0.6) >> 30))
    except (ValueError, OSError, AttributeError):
        gb = 2
    return f"{gb}g"


def local_session(cpus: int | None = None, app: str = "tessera",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """A local-mode session for tests and the benchmark (UI off)."""
    cpus = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    parts = shuffle_partitions or cpus
    b = (SparkSession.builder.master(f"local[{cpus}]").appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", str(parts))
         .config("spark.driver.memory", os.environ.get("TESSERA_DRIVER_MEMORY", _driver_memory()))
         .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    # small splits: a few row groups of a test table still occupy all cores
    sizing = {"spark.sql.files.maxPartitionBytes": os.environ.get("TESSERA_SPLIT", "2m"),
              "spark.sql.files.openCostInBytes": "256k"}
    conf = {**SEMANTIC_CONF, **ADAPTIVE_CONF, **sizing, **(extra or {})}
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    for k, v in conf.items():          # also when the session already existed
        try:
            spark.conf.set(k, v)
        except Exception:  # noqa: BLE001 - static confs of a running session
            pass
    return spark


def cluster_conf(input_bytes: int, target_partition_bytes: int = 256 << 20,
                 max_split_bytes: int = 256 << 20) -> dict[str, str]:
    """Shuffle and scan sizing for an input of ``input_bytes``.

    AQE can merge small shuffle partitions and split skewed join partitions,
    but it cannot split an aggregation partition that is too large, so the
    initial partition count must be high enough for the largest shuffle
    (about the input size for the text jobs): ``input / target`` partitions,
    which AQE then coalesces toward ``target`` bytes each.  Scan splits of
    ``max_split_bytes`` keep each task's input bounded.  For 100 TB this
    gives ~400k initial partitions of 256 MB.
    """
    n = max(200, -(-int(input_bytes) // int(target_partition_bytes)))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(n),
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(int(target_partition_bytes)),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.files.maxPartitionBytes": str(int(max_split_bytes)),
    }


_OWN_ROOT: dict[str, str] = {}


def work_root(spark: SparkSession) -> str:
    """The shared folder for written intermediate tables.

    Taken from ``spark.checkpoint.dir`` (the folder the cluster shares with
    every executor).  Only a local-mode session without that setting gets a
    fresh folder of its own; a cluster session without it is an error,
    because a machine-local folder is not visible to other executors.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if d:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(d)      # named in the session but not yet applied
        return d.rstrip("/")
    if sc.applicationId in _OWN_ROOT:
        return _OWN_ROOT[sc.applicationId]
    d = sc.getCheckpointDir()
    if d:
        return d.rstrip("/")
    master = sc.master or ""
    if not master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set: name a folder shared by all "
            "executors (e.g. on the cluster file system)")
    # local session without the setting (tests): a folder of its own
    d = tempfile.mkdtemp(prefix="tessera-work-")
    sc.setCheckpointDir(d)
    _OWN_ROOT[sc.applicationId] = d
    try:
        spark.conf.set("spark.checkpoint.dir", d)
    except Exception:  # noqa: BLE001 - core confs may be read-only at runtime
        pass
    return d


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A new, unused path below the work root (one per write)."""
    return f"{work_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"
