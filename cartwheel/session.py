"""Session construction and shared-folder resolution.

Everything in the library is a plain ``DataFrame -> DataFrame`` function, so
any existing ``SparkSession`` works. ``build_session`` is only a convenience
for tests, benchmarks and scripts: it pins UTC (all timestamps in the data
model are wall-clock UTC), keeps AQE and its skew-join splitting on, and
selects the RocksDB state store so stream-join state can spill to disk.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # small local inputs: keep all cores busy after AQE coalescing (at cluster
    # scale partitions are far above this floor anyway)
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "256k",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[*]", app: str = "cartwheel",
                  shuffle_partitions: int = 8, conf: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    settings = dict(DEFAULT_CONF)
    settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for k, v in settings.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """The cluster-wide folder for checkpoints and intermediate tables.

    Read from ``spark.checkpoint.dir`` (session conf, then context conf, then
    the context's checkpoint dir). Only when none is set and the master is
    local -- tests -- a fresh temporary folder is created and registered, so
    later calls reuse it; on a cluster a machine-local folder would lose
    rows, so an unset folder is an error there.
    """
    candidates = []
    try:
        candidates.append(spark.conf.get("spark.checkpoint.dir", None))
    except Exception:  # pragma: no cover - conf may be unavailable
        pass
    sc = spark.sparkContext
    candidates.append(sc.getConf().get("spark.checkpoint.dir", None))
    try:
        candidates.append(sc.getCheckpointDir())
    except Exception:  # pragma: no cover
        pass
    for c in candidates:
        if c:
            return c.rstrip("/")
    if not sc.master.split("[")[0] == "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    local = tempfile.mkdtemp(prefix="cartwheel-ckpt-")
    sc.setCheckpointDir(local)
    try:
        spark.conf.set("spark.checkpoint.dir", local)
    except Exception:  # pragma: no cover - static conf on some deployments
        pass
    return sc.getCheckpointDir() or local


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A fresh, unique sub-folder of the shared root for one run."""
    return f"{shared_root(spark)}/{purpose}-{uuid.uuid4().hex[:12]}"
