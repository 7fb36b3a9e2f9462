"""Session-level helpers shared by every operator."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def session(app: str = "quire", cpus: str = "*", **conf: str) -> SparkSession:
    """A local session with the settings the tests and the bench use."""
    b = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    base = {
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
        "spark.driver.host": "127.0.0.1",
        "spark.python.sql.dataFrameDebugging.enabled": "false",
    }
    for k, v in (base | conf).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_SHIPPED: set[str] = set()
_OWN: dict[str, str] = {}


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers of the session's application, once."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    _SHIPPED.add(sc.applicationId)
    package = os.path.dirname(os.path.abspath(__file__))
    folder = tempfile.mkdtemp(prefix="quire-ship-")
    target = os.path.join(folder, "quire.zip")
    with zipfile.ZipFile(target, "w") as z:
        for root, _, names in os.walk(package):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(root, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(package)))
    sc.addPyFile(target)


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor sees: that of spark.checkpoint.dir.

    Only a local session, as in tests, may go without the setting and gets a folder of its own; on a cluster a
    machine-local folder would lose what other machines wrote, so the setting is required there.
    """
    sc = spark.sparkContext
    given = sc.getConf().get("spark.checkpoint.dir", "")
    if given:
        return given
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if sc.applicationId not in _OWN:
        _OWN[sc.applicationId] = tempfile.mkdtemp(prefix="quire-ckpt-")
    return _OWN[sc.applicationId]


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Checkpoint into the shared folder, unless the session has a checkpoint folder already."""
    sc = spark.sparkContext
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        sc.setCheckpointDir(shared_folder(spark))


def spread(df: DataFrame) -> DataFrame:
    """`df` over at least as many partitions as there are cores.

    Only an input of fewer splits than cores, that is a small one, is shuffled; a large one stays as it is read.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def wide(df: DataFrame, *columns: str) -> DataFrame:
    """`df` by `columns` over all shuffle partitions, however few bytes it has: for rows that are small but costly."""
    spark = df.sparkSession
    return df.repartition(max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))), *columns)


def cut(df: DataFrame) -> DataFrame:
    """Materialise `df` in the shared checkpoint folder, so that a lost executor loses nothing."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


#: Tables are broadcast up to this many bytes, as estimated from their rows' own lengths.
BROADCAST_BYTES = 64 << 20


def small_enough(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether all rows of a materialised table together stay within `max_bytes`.

    Strings and arrays are measured as text, other columns at 16 bytes, and every row at 32 bytes more.
    """
    wide = [c for c, t in df.dtypes if t == "string" or t == "binary"]
    nested = [c for c, t in df.dtypes if t.startswith(("array", "map", "struct"))]
    size = F.lit(32 + 16 * len(df.columns))
    for c in wide:
        size = size + F.coalesce(F.octet_length(c), F.lit(0))
    for c in nested:
        size = size + F.coalesce(F.length(F.to_json(F.struct(c))), F.lit(0))
    return df.agg(F.coalesce(F.sum(size.cast("bigint")), F.lit(0))).first()[0] <= max_bytes


def bounded_join(big: DataFrame, small: DataFrame, on, how: str = "inner", max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Join with a broadcast only when `small` has at most `max_bytes` bytes.

    `small` is written to the checkpoint folder and measured first, so the size is known rather than
    guessed; beyond the bound the join is an ordinary shuffle join, whose hot keys AQE splits.
    """
    small = cut(small)
    if small_enough(small, max_bytes):
        small = F.broadcast(small)
    return big.join(small, on, how)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One parquet table of a data folder."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
