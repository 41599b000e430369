"""Session settings and the shared scratch folder.

Entry points build their plans inside :func:`settings`, so results don't depend
on the caller's time zone or ANSI mode, and the caller's session stays as it
was.  The join policy of :data:`SESSION_CONF` holds for sessions made by
:func:`build_session`; in others the caller's thresholds hold.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Runtime SQL settings this package relies on.
#  * UTC: hour/day/month/quarter buckets and labels must not move with the
#    machine's zone.
#  * Decimal division keeps 20 decimals (functions.numeric relies on it).
#  * No broadcast from *static* size guesses (a compressed parquet footprint is
#    not a bound on the in-memory hash table).  Broadcasts happen only
#    (a) behind an explicit row/byte check (operators.joins.join_dimension), or
#    (b) when AQE has *measured* a materialised shuffle stage below the
#    adaptive threshold; otherwise the join stays a shuffle join.
#  * AQE coalescing and skew-join splitting: a hot key (one ticker or one hour
#    holding a third of the rows) is split across tasks instead of landing in one.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.decimalOperations.allowPrecisionLoss": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
}


#: What results depend on; Spark takes it over when a plan is built.
RESULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.decimalOperations.allowPrecisionLoss": "true",
    "spark.sql.ansi.enabled": "true",
}


@contextmanager
def settings(spark: SparkSession) -> Iterator[SparkSession]:
    """:data:`RESULT_CONF` while plans are built; the caller's values come back."""
    before = {k: spark.conf.get(k, None) for k in RESULT_CONF}
    for k, v in RESULT_CONF.items():
        if before[k] != v:
            spark.conf.set(k, v)
    try:
        yield spark
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            elif v != RESULT_CONF[k]:
                spark.conf.set(k, v)


def build_session(
    master: str | None = None,
    app_name: str = "tickfold",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or fetch) a session with this package's defaults.

    On a cluster pass ``master=None`` and let spark-submit decide; executor
    memory, shuffle partitions and the checkpoint folder belong to the cluster
    configuration.  ``extra`` carries connector settings (``spark.jars``,
    ``spark.jars.packages`` ...), see ``sources.jdbc.connector_conf``.
    """
    builder = SparkSession.builder.appName(app_name).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in {**SESSION_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Read from the session.  Only a local-mode session without the setting gets
    a fresh folder of its own (tests, the bench); a cluster session without it
    is an error, because a machine-local folder is not visible to executors.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: no SparkContext on the client
        sc = None
    if sc is None:
        root = spark.conf.get("spark.checkpoint.dir", None)
        if not root:
            raise RuntimeError("spark.checkpoint.dir is not set on this session")
        return root.rstrip("/")
    root = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if root:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(root)
        return root.rstrip("/")
    if not (sc.master == "local" or sc.master.startswith("local[")):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a shared folder (HDFS, S3, ...)")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="tickfold-ckpt-"))
    return sc.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path under the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/tickfold/{name}-{uuid.uuid4().hex[:12]}"


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme so local tests can look at a written folder."""
    if path.startswith("file:"):
        path = path[len("file:"):]
        while path.startswith("//"):
            path = path[1:]
    return os.path.abspath(path)
