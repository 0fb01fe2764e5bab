"""Session construction and the shared work folder.

Cluster jobs must never write to a machine-local temporary folder.  Every
file an operator writes (stage tables, lake versions, checkpoints, landed
source files) goes below the folder the cluster names in
``spark.checkpoint.dir``.  Only when that setting is absent (local tests) do
we create one ourselves.
"""

from __future__ import annotations

import contextlib
import tempfile
import threading
import uuid

from pyspark.sql import SparkSession

_DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str | None = None, app_name: str = "veracorp",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(_DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder, creating one only when unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
    elif sc.master.startswith("local") and not sc.master.startswith("local-cluster"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="veracorp-ckpt-"))
    else:
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    return sc.getCheckpointDir()


def shared_dir(spark: SparkSession, name: str, unique: bool = True) -> str:
    """A fresh folder below the shared checkpoint folder (visible to all executors)."""
    base = ensure_checkpoint_dir(spark)
    leaf = f"{name}-{uuid.uuid4().hex[:12]}" if unique else name
    path = base.rstrip("/") + "/veracorp/" + leaf
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(folder)
    return path


# Part of the key of reusable stage tables; raise it when what they hold changes.
STAGE_VERSION = 2


def source_key(spark: SparkSession, sf: str, tables=("documents", "labels")) -> str:
    """Digest of the tables' files (name, length, time of change): stage tables keyed by it
    are never reused for other data, also if that stands under the same path."""
    import hashlib
    jvm = spark.sparkContext._jvm
    found = []
    for t in tables:
        folder = jvm.org.apache.hadoop.fs.Path(f"{sf.rstrip('/')}/{t}.parquet")
        files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listFiles(folder, True)
        while files.hasNext():
            f = files.next()
            found.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return hashlib.md5(repr((STAGE_VERSION, sorted(found))).encode()).hexdigest()[:16]


def cut_lineage(df):
    """Materialise a DataFrame in the shared checkpoint folder (reliable checkpoint)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


_LEAN = {"lock": threading.Lock(), "inside": 0, "before": None}


@contextlib.contextmanager
def lean(spark: SparkSession):
    """Shuffle files of the writes within go as soon as a write has ended.  Threads may be within side by side."""
    with _LEAN["lock"]:
        if not _LEAN["inside"]:
            _LEAN["before"] = spark.conf.get(_CLEANUP, None)
            spark.conf.set(_CLEANUP, "true")
        _LEAN["inside"] += 1
    try:
        yield
    finally:
        with _LEAN["lock"]:
            _LEAN["inside"] -= 1
            if not _LEAN["inside"]:
                spark.conf.set(_CLEANUP, _LEAN["before"]) if _LEAN["before"] is not None else spark.conf.unset(_CLEANUP)


def write_lean(df, path: str) -> None:
    """Write ``df`` as Parquet (what stands there is replaced); the shuffle files of the write go with it."""
    with lean(df.sparkSession):
        df.write.mode("overwrite").parquet(path)


def staged(df, root: str | None = None):
    """``df`` as a Parquet table of its own below ``root`` (else the shared folder): columns in code and compressed, a
    fraction of the rows that ``cut_lineage`` writes.  ``drop_folder`` of ``root`` removes it."""
    path = shared_dir(df.sparkSession, "staged") if root is None else f"{root}/{uuid.uuid4().hex[:12]}"
    write_lean(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder of stage tables that nobody reads any more."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


# Size bound for broadcasting a side whose size is measured at run time.
BROADCAST_BYTES = 128 << 20


def measured_bytes(df) -> tuple[int, int]:
    """(rows, bytes) of a materialised table, in one aggregate: numbers at their width, strings, binaries, arrays and
    maps at what they hold."""
    from pyspark.sql import functions as F
    size, fixed = F.lit(0), 0
    for field in df.schema:
        kind = field.dataType.typeName()
        if kind in ("string", "binary"):
            size = size + F.coalesce(F.octet_length(F.col(field.name)), F.lit(0))
        elif kind in ("array", "map", "struct"):
            size = size + F.octet_length(F.to_json(F.struct(F.col(field.name))))
        else:
            fixed += 8
    rows, held = df.agg(F.count(F.lit(1)), F.sum(size.cast("long"))).first()
    return rows, (held or 0) + rows * (fixed + 32)


def broadcast_if_small(df, max_bytes: int = BROADCAST_BYTES, materialize: bool = True):
    """Broadcast ``df`` when its measured size is small; otherwise leave the join to AQE
    (runtime broadcast or skew-partition splitting).  Used for vocabulary-sized
    tables joined to token occurrences, where a hot token would otherwise pile
    its occurrences into one reducer.  ``materialize`` checkpoints the table
    first so the measuring and the join do not compute it twice."""
    from pyspark.sql import functions as F
    if materialize:
        df = cut_lineage(df)
    return F.broadcast(df) if measured_bytes(df)[1] <= max_bytes else df


def cluster_conf(input_bytes: int, cores: int, target_partition_bytes: int = 256 << 20) -> dict:
    """Shuffle sizing for a cluster run: start with enough partitions for
    ~256 MiB each (AQE coalesces small ones and splits skewed ones)."""
    parts = max(cores * 2, min(200_000, -(-input_bytes // target_partition_bytes)))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(target_partition_bytes * 4),
    }
