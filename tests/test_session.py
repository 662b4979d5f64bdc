from __future__ import annotations

import os
import subprocess
import sys
from pathlib import Path
from types import SimpleNamespace

import pytest

from fareloom.session import shared_dir

WITHOUT_SETTING = """
from pyspark.sql import SparkSession
from fareloom.operators import dense_key
from fareloom.session import shared_dir
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
assert shared_dir(spark) == shared_dir(spark)
assert sorted(r.k for r in dense_key(spark.range(5), ["id"], "k").collect()) == [1, 2, 3, 4, 5]
print("numbered")
"""


def test_the_session_names_the_shared_folder(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_a_local_session_without_the_setting(tmp_path):
    env = {**os.environ, "SPARK_CONF_DIR": str(tmp_path), "PYTHONPATH": str(Path(__file__).resolve().parents[1])}
    done = subprocess.run([sys.executable, "-c", WITHOUT_SETTING], env=env, capture_output=True, text=True, timeout=120)
    assert "numbered" in done.stdout, done.stderr[-2000:]


def test_a_cluster_without_the_setting_is_an_error():
    context = SimpleNamespace(master="yarn", getCheckpointDir=lambda: None)
    session = SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: default), sparkContext=context)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(session)
