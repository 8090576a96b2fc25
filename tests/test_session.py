"""Session and scratch safety: no forced master, no machine-local scratch on a cluster."""

import os
import subprocess
import sys
import time
from pathlib import Path
from types import SimpleNamespace

import pytest

from flowml import session

ROOT = Path(__file__).resolve().parents[1]


def test_submit_master_is_kept():
    env = os.environ | {"PYSPARK_SUBMIT_ARGS": "--master local[2] pyspark-shell",
                        "PYTHONPATH": str(ROOT)}
    code = "from flowml.session import get_session; print('M', get_session().sparkContext.master)"
    out = subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True,
                         timeout=120)
    assert "M local[2]" in out.stdout, out.stderr[-800:]


def _fake(master):
    return SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: d),
                           sparkContext=SimpleNamespace(master=master,
                                                        getCheckpointDir=lambda: None))


@pytest.mark.parametrize("master", ["spark://host:7077", "yarn", "k8s://x", "local-cluster[2,1,1024]"])
def test_no_temporary_scratch_off_a_single_machine(master):
    with pytest.raises(RuntimeError, match="checkpoint"):
        session.checkpoint_root(_fake(master))


def test_materialise_and_drop(spark):
    df = session.materialise(spark.range(5), "t")
    path = df.inputFiles()[0].removeprefix("file://")
    assert df.count() == 5 and os.path.exists(path)
    session.drop_scratch(spark, df)
    assert not os.path.exists(path)


def test_materialise_leaves_no_shuffle_files(spark):
    def shuffles():
        root = Path(spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()[0])
        return {p.name for p in root.rglob("shuffle_*")}

    before = shuffles()
    df = session.materialise(spark.range(1000).selectExpr("id % 7 k").groupBy("k").count(), "t")
    deadline = time.time() + 10
    while shuffles() - before and time.time() < deadline:
        time.sleep(0.2)
    assert not shuffles() - before and df.count() == 7
    # The setting is as before.
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
