"""Session settings the library relies on, and the shared working folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

_local_dirs: dict[str, str] = {}

# Event micros are UTC, so dates are only right under a UTC session. HotSpot does not
# compile methods over 8000 bytes; beyond that size Spark should not fuse a stage.
_RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def get_session(app: str = "usertide", master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC time, ANSI arithmetic and adaptive execution."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        **_RUNTIME,
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Set what the operators rely on in a session made elsewhere."""
    for key, value in _RUNTIME.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """A fresh folder for written intermediate tables.

    It lies under ``spark.checkpoint.dir``, which every executor can reach. Only a
    local session, as in tests, may do without that setting; its folder goes when the program ends.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        app = spark.sparkContext.applicationId
        if app not in _local_dirs:
            _local_dirs[app] = tempfile.mkdtemp(prefix="usertide-")
            atexit.register(shutil.rmtree, _local_dirs[app], ignore_errors=True)
        base = _local_dirs[app]
    return f"{base.rstrip('/')}/usertide-{uuid.uuid4().hex}"
