import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from donorlake.session import ENGINE_CONFS, apply_defaults, checkpoint_root

    import tempfile

    b = (SparkSession.builder.master("local[*]").appName("donorlake-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="shared-"))
         .config("spark.donorlake.scanPartitions", "4")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false"))
    for k, v in ENGINE_CONFS.items():
        b = b.config(k, v)
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    apply_defaults(s)
    checkpoint_root(s)  # sets a local folder only when the session has none
    yield s


@pytest.fixture()
def tmp_dir(tmp_path):
    return str(tmp_path)
