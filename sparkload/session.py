"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from contextlib import contextmanager
from functools import cache

from pyspark.sql import SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"


def build_session(app: str, master: str | None = None, **settings) -> SparkSession:
    """A session with what the library relies on: UTC, adaptive execution, no web page."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.ui.enabled": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
    }
    for key, value in {**defaults, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_PACKAGE = os.path.dirname(os.path.abspath(__file__))
_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send the package to the Python workers, once a session, unless they have it on their path.

    Spark's own distribution of Python files does it, so executors need no installation.
    """
    parent, context = os.path.dirname(_PACKAGE), spark.sparkContext
    on_path = [os.path.abspath(p) for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    if parent in on_path or context.applicationId in _SHIPPED:
        return
    _SHIPPED.add(context.applicationId)
    archive = os.path.join(tempfile.mkdtemp(prefix="sparkload-"), "sparkload.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(_PACKAGE):
            for name in names:
                if name.endswith(".py"):
                    out.write(os.path.join(folder, name), os.path.relpath(os.path.join(folder, name), parent))
    context.addPyFile(archive)


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder below the shared folder that the cluster names for checkpoints.

    Only a local session, where every task runs on this machine, falls back to a
    temporary folder of the machine.
    """
    ship_package(spark)  # what is stored may come from Python workers
    root = spark.conf.get(CHECKPOINT_SETTING, None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_SETTING} to a folder that all executors share")
        root = _local_scratch()
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"


@cache
def _local_scratch() -> str:
    return tempfile.mkdtemp(prefix="sparkload-")


@contextmanager
def session_conf(spark: SparkSession, **settings):
    """Set SQL settings for a block (dots in names written as ``__``) and put them back."""
    names = {k.replace("__", "."): v for k, v in settings.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    for key, value in names.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)
