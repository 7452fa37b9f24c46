"""Session defaults and the shared folder for checkpoints."""

from __future__ import annotations

import io
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

#: UTC everywhere, exact decimal products, runtime re-planning. Set on a session that this package builds; a session given by a
#: cluster keeps its own sizes (shuffle partitions, memory), only the first three are semantic and are applied by ``prepare``.
SEMANTIC = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.decimalOperations.allowPrecisionLoss": "false",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
}
TUNING = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",  # texts and documents are dear to make and small to move: use all cores
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this package to the Python workers, once per application, so that they need no path of their own. The archive lies in the shared folder of
    ``spark.checkpoint.dir``; where none is set, in a temporary one of the driver, from which the driver itself serves it."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root, packed = Path(__file__).resolve().parent, io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as archive:
        for path in sorted(root.rglob("*.py")):
            archive.write(path, path.relative_to(root.parent))
    folder = context.getConf().get("spark.checkpoint.dir") or tempfile.mkdtemp(prefix="quillstone-")
    target = context._jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/quillstone-{context.applicationId}/quillstone.zip")
    files = target.getFileSystem(context._jsc.hadoopConfiguration())
    out = files.create(target, True)
    out.write(packed.getvalue())
    out.close()
    context.addPyFile(files.makeQualified(target).toString())
    _shipped.add(context.applicationId)


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the settings that results depend on and give the workers this package; idempotent."""
    for key, value in SEMANTIC.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    ship(spark)
    return spark


def build(cores: int = 8, shuffle_partitions: int = 8, memory: str = "8g", app: str = "quillstone") -> SparkSession:
    """A local session for tests and benches."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app).config("spark.driver.memory", memory)
    for key, value in (SEMANTIC | TUNING | {"spark.sql.shuffle.partitions": str(shuffle_partitions)}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return prepare(spark)


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, which a cluster shares between executors. On one machine, as in tests, a temporary one where none is set; on
    a cluster its absence is an error, because a folder of one machine would lose what the others need."""
    context = spark.sparkContext
    current = context._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    folder = context.getConf().get("spark.checkpoint.dir")
    if not folder:
        if not context.master.startswith("local[") and context.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="quillstone-checkpoint-")
    context.setCheckpointDir(folder)
    return context._jsc.sc().getCheckpointDir().get()


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder of this run for written tables, inside the shared one."""
    return f"{shared_folder(spark).rstrip('/')}/quillstone-{name}-{uuid.uuid4().hex}"
