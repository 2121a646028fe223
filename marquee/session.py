"""Session settings and the shared checkpoint folder.

On a cluster the caller owns the session; nothing here overrides a setting the
cluster already made. ``local_session`` is for tests and the bench only.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the questions are planned for. All are Spark defaults in 4.x except
# where noted; they are listed so a cluster profile can pin them.
SCALE_CONF = {
    # Runtime re-planning: coalesce small shuffle partitions, split skewed
    # sort-merge join partitions, turn a join into a broadcast join only when the
    # measured side is below the adaptive threshold.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A question that joins credits to two title-keyed tables runs both joins
    # in one stage; AQE may split a hot title's partition there only if it is
    # allowed to add a shuffle between the joins. That shuffle is paid only when
    # a partition is found skewed -- far cheaper than one task doing a third of
    # the work.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Shuffle partitions are sized by AQE from this target, so a 100 TB run and
    # a 100 MB run use the same code.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * 1024 * 1024),
    "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
    # Broadcast only below a checked size: the static planner compares its
    # file-size estimate (compressed Parquet can grow several-fold in memory,
    # so keep Spark's conservative 10 MB), AQE the measured shuffle output.
    "spark.sql.autoBroadcastJoinThreshold": str(10 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(10 * 1024 * 1024),
}


def local_session(
    master: str = "local[8]",
    shuffle_partitions: int = 8,
    app: str = "marquee",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """A local session for tests and the bench (UI off, UTC)."""
    b = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
        # no stack trace for each column expression: a third of the time to build a question
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for k, v in {**SCALE_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def apply_scale_conf(spark: SparkSession) -> list[str]:
    """Set what SCALE_CONF has and the session's owner left unset; returns the
    keys that were set."""
    own = spark.conf.getAll
    missing = [k for k in SCALE_CONF if k not in own]
    for k in missing:
        spark.conf.set(k, SCALE_CONF[k])
    return missing


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names for checkpoints.

    Read from the session (``spark.checkpoint.dir`` or the context's checkpoint
    dir), which the cluster's owner must make a folder all executors share; a
    ``file:`` path may be a shared mount, so it is taken as named. Only when
    neither is set in local mode -- tests, the bench -- a fresh folder under the
    system temp dir is created and registered. On a cluster (``local-cluster``
    is one) a machine-local folder would not survive the loss of an executor
    (nor be seen by the others), so an unset dir is an error there.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if conf:
        sc.setCheckpointDir(conf)
        return sc.getCheckpointDir() or conf
    if sc.master != "local" and not sc.master.startswith("local["):
        raise RuntimeError(
            "spark.checkpoint.dir is not set: name a shared folder (HDFS, S3, ...) "
            "for the tables this library writes between jobs"
        )
    local = tempfile.mkdtemp(prefix="marquee-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path inside the shared checkpoint folder for a written table."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"
