"""Python workers find the package wherever the driver was started."""

import os
import subprocess
import sys
import tempfile

SCRIPT = """
import sys
sys.path.insert(0, {home!r})
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
from tidelog import configure
configure(spark)
spark.sparkContext.environment["PYTHONPATH"] = ""  # as on a cluster: only what was sent is there
from tidelog.functions.vectors import cosine
df = spark.createDataFrame([([1.0, 0.0],), ([0.0, 2.0],)], "v array<float>")
print(sorted(r.s for r in df.select(cosine(F.col("v"), [0.0, 1.0]).alias("s")).collect()))
"""


def test_workers_get_the_package():
    home = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run(
        [sys.executable, "-c", SCRIPT.format(home=home)], cwd=tempfile.mkdtemp(prefix="run-", dir="/tmp"), env=env,
        capture_output=True, text=True, timeout=120,
    )
    assert "[0.0, 1.0]" in done.stdout, done.stderr[-2000:]
