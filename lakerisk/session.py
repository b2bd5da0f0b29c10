"""Session settings and the shared scratch folder."""

import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(master: str = "local[*]", **conf: str) -> SparkSession:
    """Session for local runs and tests; on a cluster use the one you are given."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.adaptive.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **conf,
    }
    builder = SparkSession.builder.master(master).appName("lakerisk")
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, name: str) -> str:
    """Fresh path under the folder that ``spark.checkpoint.dir`` names.

    Every executor must see it, so a machine-local folder is used only when
    the session itself is local and names none.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="lakerisk-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/lakerisk-{uuid.uuid4().hex}/{name}"
