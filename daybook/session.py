"""Sessions and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(app: str = "daybook", **conf: str) -> SparkSession:
    """Session with the one setting that results depend on, the time zone. Everything else comes
    from the submitter, or from ``conf``."""
    builder = SparkSession.builder.appName(app).config("spark.sql.session.timeZone", "UTC")
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_folder(spark: SparkSession, label: str) -> str:
    """A new, unused folder below the session's ``spark.checkpoint.dir``.

    That setting names storage every executor sees. Only a local session, as in tests, may
    leave it unset and gets a folder of this machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="daybook-")
    return f"{base.rstrip('/')}/daybook-{label}-{uuid.uuid4().hex}"
