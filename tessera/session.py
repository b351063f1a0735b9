"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def get_session(master: str | None = None, app: str | None = None,
                shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session that sets what the caller passes and nothing else.

    Master, partition counts and all other settings come from spark-submit or
    spark-defaults.conf; a plain local script gets Spark's own default, ``local[*]``.
    """
    conf = dict(extra or {})
    if app:
        conf["spark.app.name"] = app
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if master:
        conf["spark.master"] = master
    return SparkSession.builder.config(map=conf).getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder named by the session.

    A cluster names a shared folder in ``spark.checkpoint.dir``; we read it and never
    override it. Only a local master without one gets a folder of its own; on any other
    master executors would each write to their own disk, so a missing folder is an error. A
    session without a SparkContext (Spark Connect) checkpoints on the server, so the folder
    must be configured there.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect exposes no SparkContext
        conf_dir = spark.conf.get("spark.checkpoint.dir", None)
        if not conf_dir:
            raise RuntimeError("set spark.checkpoint.dir to a shared folder for this session")
        return conf_dir
    current = sc.getCheckpointDir()
    if current:
        return current
    folder = sc.getConf().get("spark.checkpoint.dir", None)
    if not folder:
        if sc.master.split("[")[0] != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="tessera-ckpt-")
    sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


def remove_folder(spark: SparkSession, folder: str) -> None:
    """Delete a folder of the shared storage, with the file system that its path names."""
    sc = spark.sparkContext
    path = sc._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def checkpoint_scope(spark: SparkSession) -> Iterator[str]:
    """Own the checkpoints made inside: they go to a folder that is removed at the end.

    Write results before the scope ends; a DataFrame whose lineage was cut inside it can't be
    read later. The folder lies under the session's own checkpoint folder.
    """
    sc = spark.sparkContext
    outer = ensure_checkpoint_dir(spark).rstrip("/")
    sc.setCheckpointDir(f"{outer}/scope-{uuid.uuid4().hex}")
    inner = sc.getCheckpointDir()
    try:
        yield inner
    finally:
        sc._jsc.sc().setCheckpointDir(outer.rsplit("/", 1)[0])  # Spark makes a folder of its own below
        remove_folder(spark, inner.rsplit("/", 1)[0])
