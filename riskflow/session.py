"""Spark session defaults and the shared checkpoint folder.

Every operator in this package is a pure ``DataFrame -> DataFrame`` function; nothing here keeps a
global session. These helpers only build a session with the settings the operators assume (UTC,
AQE with skew-join splitting) and resolve the cluster's checkpoint folder.
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

# Settings the operators rely on. AQE re-plans joins from runtime sizes (so broadcasts are size
# checked at runtime), coalesces small shuffle partitions and splits skewed join partitions.
DEFAULT_CONF: dict[str, str] = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
}


def get_spark(
    master: str | None = None,
    app: str = "riskflow",
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the package defaults.

    On a cluster, leave ``master`` unset and size ``shuffle_partitions`` to the data: about
    total shuffle bytes / 128 MB. Locally it defaults to the core count.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions is not None:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A cluster sets this to shared storage; it is only filled in here when unset (tests, local
    runs), with a fresh folder so runs never share state.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - remote session: only the SQL conf is visible
        sc = None
    if not configured and sc is not None:
        configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if sc is None or not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="riskflow-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    if sc is not None:
        sc.setCheckpointDir(configured)
    return configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for staged tables and stream checkpoints."""
    return os.path.join(checkpoint_dir(spark), name)


def cluster_conf(input_bytes: int, total_cores: int, target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings sized to the data, for a cluster run (pass as ``get_spark(conf=...)``).

    Shuffle partitions start at about input / target size (at least 2 waves of the cores) and AQE
    coalesces them at runtime toward the same advisory size, so tasks stay in memory and spill
    rarely; file splits match; a partition is treated as skewed when it is 4× the median and above
    1 GiB, and split. Example: 100 TB on 1,000 executors × 8 cores → ~400,000 initial partitions,
    coalesced to the actual shuffle volume.
    """
    partitions = max(2 * total_cores, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(1 << 30),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
    }


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``riskflow`` importable on the executors' Python workers (streaming state processors
    and the external scorer run there). Zips the installed package once per application and adds
    it like ``--py-files``: the driver serves the archive to every executor, so no executor reads
    a driver-local path. A no-op when already shipped."""
    import shutil

    key = spark.sparkContext.applicationId if _has_context(spark) else id(spark)
    if key in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    out_dir = tempfile.mkdtemp(prefix="riskflow-pkg-")
    archive = shutil.make_archive(
        os.path.join(out_dir, "riskflow"), "zip", root_dir=os.path.dirname(pkg_dir), base_dir="riskflow"
    )
    if _has_context(spark):
        spark.sparkContext.addPyFile(archive)
    else:  # remote session
        spark.addArtifacts(archive, pyfile=True)
    _SHIPPED.add(key)


def _has_context(spark: SparkSession) -> bool:
    try:
        spark.sparkContext
        return True
    except Exception:  # noqa: BLE001 - remote session
        return False
