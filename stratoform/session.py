"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import contextlib
import os
import uuid

from pyspark.sql import DataFrame, SparkSession

_CLEANED_AT_END: set[str] = set()
_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(app_name: str = "stratoform", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the plans are written for.

    Everything here can be overridden by ``conf``; no plan depends on a value
    for correctness except the UTC time zone used by audit timestamps.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        # Split a hot join key even where that costs one more exchange.
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        # Lets a selective dimension prune the fact before the shuffle.
        "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
        "spark.sql.parquet.filterPushdown": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """Folder for this application's intermediate tables, reachable from every executor.

    The cluster names its parent in ``spark.checkpoint.dir``; without that it
    is below the session's warehouse. It is removed when the driver ends.
    """
    configured = spark.conf.get("spark.checkpoint.dir", "")
    parent = configured.rstrip("/") or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_stages"
    app_id = spark.sparkContext.applicationId
    root = f"{parent}/stratoform/{app_id}"
    if app_id not in _CLEANED_AT_END:
        _CLEANED_AT_END.add(app_id)
        atexit.register(_remove_at_end, spark, root)
    return root


def _hadoop(spark: SparkSession, path: str) -> tuple:
    """File system and path object of a path, wherever it is."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), hadoop


def is_there(spark: SparkSession, path: str) -> bool:
    files, hadoop = _hadoop(spark, path)
    return files.exists(hadoop)


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder of intermediate data; an absent one is left alone."""
    files, hadoop = _hadoop(spark, path)
    files.delete(hadoop, True)


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names of the files in a folder, in order; none if it is absent."""
    files, hadoop = _hadoop(spark, path)
    if not files.exists(hadoop):
        return []
    return sorted(status.getPath().getName() for status in files.listStatus(hadoop) if status.isFile())


def read_small(spark: SparkSession, path: str) -> str:
    """A small text file, read by the driver."""
    files, hadoop = _hadoop(spark, path)
    opened = files.open(hadoop)
    try:
        return bytes(opened.readAllBytes()).decode()
    finally:
        opened.close()


def put_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Writes a small file whole under a name that nobody has taken; False if somebody has.

    The text is written under another name first, so no reader sees half of it.
    Distributed file systems refuse to rename onto an existing file; a local
    one would replace it, so there the name is taken by a hard link.
    """
    files, hadoop = _hadoop(spark, path)
    files.mkdirs(hadoop.getParent())
    _, draft = _hadoop(spark, f"{path}.{uuid.uuid4().hex}.draft")
    out = files.create(draft, False)
    out.write(text.encode())
    out.close()
    local = files.resolvePath(draft).toUri()
    try:
        if local.getScheme() != "file":
            return not files.exists(hadoop) and files.rename(draft, hadoop)
        os.link(local.getPath(), local.getPath().rsplit("/", 1)[0] + "/" + hadoop.getName())
        return True
    except FileExistsError:
        return False
    finally:
        files.delete(draft, False)


def _remove_at_end(spark: SparkSession, root: str) -> None:
    with contextlib.suppress(Exception):  # the session may have ended before
        remove(spark, root)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the scratch folder; never reused, so never overwritten."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


#: For tables that are kept, or large and read few times: smaller files for some more time.
SMALL = "zstd"


def stage(df: DataFrame, name: str, path: str | None = None, codec: str | None = None) -> DataFrame:
    """Write ``df`` to the scratch folder, or to ``path``, and read it back.

    Cuts the lineage at files that outlive any executor, and lets later reads
    prune columns, which a checkpointed RDD does not. Once it is written, the
    shuffle files that led to it are of no more use, so they go at once and
    not only when the driver collects its garbage.
    """
    spark = df.sparkSession
    path = path or scratch_path(spark, name)
    before = spark.conf.get(_DROP_SHUFFLES)
    spark.conf.set(_DROP_SHUFFLES, "true")
    try:
        df.write.parquet(path, compression=codec)
    finally:
        spark.conf.set(_DROP_SHUFFLES, before)
    return spark.read.schema(df.schema).parquet(path)
