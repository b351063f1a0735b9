"""The session sets only what is passed, and checkpoints have an owner."""

import os
import subprocess
import sys
import textwrap

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def submitted(script, *settings):
    """Run a script under spark-submit's settings; its printed lines."""
    env = os.environ | {"PYTHONPATH": ROOT, "PYSPARK_SUBMIT_ARGS": " ".join([*settings, "--conf spark.ui.enabled=false", "pyspark-shell"])}
    run = subprocess.run([sys.executable, "-c", textwrap.dedent(script)], env=env, cwd=ROOT, capture_output=True, text=True, timeout=300)
    assert run.returncode == 0, run.stderr[-2000:]
    return run.stdout.strip().splitlines()


def test_submitted_settings_are_kept():
    out = submitted("""
        from tessera import get_session
        s = get_session(app="x")
        print(s.sparkContext.master, s.conf.get("spark.sql.shuffle.partitions"), s.sparkContext.getConf().get("spark.driver.memory"))
    """, "--master local[2]", "--conf spark.sql.shuffle.partitions=777", "--driver-memory 600m")
    assert out[-1] == "local[2] 777 600m"


def test_a_cluster_without_a_shared_folder_is_an_error():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    class Session:
        sparkContext = Context()

    from tessera.session import ensure_checkpoint_dir
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())


def test_checkpoints_of_a_scope_are_removed_and_the_result_stays(spark, tmp):
    from tessera import checkpoint_scope, ensure_checkpoint_dir
    outer = ensure_checkpoint_dir(spark)
    with checkpoint_scope(spark) as folder:
        local = folder.removeprefix("file:")
        df = spark.range(100).checkpoint()
        assert os.listdir(local)
        df.write.parquet(f"{tmp}/out")
    assert not os.path.exists(local)
    assert spark.read.parquet(f"{tmp}/out").count() == 100
    assert os.path.dirname(spark.sparkContext.getCheckpointDir()) == os.path.dirname(outer)
    assert spark.range(5).checkpoint().count() == 5
