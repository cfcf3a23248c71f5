"""Session helpers: building a session, reading tables, shipping code and cutting lineage."""

from __future__ import annotations

import io
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_shipped: set[str] = set()


def build(master: str = "local[*]", partitions: int = 8, **conf: str) -> SparkSession:
    """A session with the settings the library is tested with; spark-submit's own settings win on a cluster."""
    b = SparkSession.builder.master(master).appName("corvane")
    settings = {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    } | conf
    for k, v in settings.items():
        b = b.config(k, v)
    return b.getOrCreate()


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Make this package importable in Python workers, once for each application."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    _shipped.add(app)
    root = Path(__file__).parent
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent).as_posix())
    at = Path(tempfile.mkdtemp(prefix="corvane-")) / "corvane.zip"
    at.write_bytes(out.getvalue())
    spark.sparkContext.addPyFile(str(at))


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share. A local one is made only on a local master, as in tests; elsewhere ValueError if none is set."""
    sc = spark.sparkContext
    at = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not at and not sc.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    if not at:
        at = "file://" + tempfile.mkdtemp(prefix="corvane-shared-")
        sc.setCheckpointDir(at)
        at = sc.getCheckpointDir()
    return at.rstrip("/")


def table(df: DataFrame, tag: str) -> DataFrame:
    """Write df to the shared folder and read it again: cuts the lineage, and a lost executor costs no recomputation."""
    at = f"{shared_dir(df.sparkSession)}/corvane/{tag}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(at)
    return df.sparkSession.read.schema(df.schema).parquet(at)

