"""A session without any setting: landed tables go to a folder of the application."""

import os
import subprocess
import sys
from pathlib import Path

SCRIPT = """
from pyspark.sql import functions as F
from stepmill import append_csv, extract_csv, order, profile
from stepmill.session import local_session, shared_folder

spark = local_session("bare", 2)
assert spark.conf.get("spark.checkpoint.dir", None) is None
df = spark.range(50).withColumn("k", F.array(49 - F.col("id")))
rows = order.with_row_index(["k"], "n")(df).orderBy("n").collect()
assert [r["id"] for r in rows] == list(range(49, -1, -1))
codes = profile.category_codes("t", "code")(df.withColumn("t", (F.col("id") % 3).cast("string")))
assert codes.groupBy("code").count().count() == 3
append_csv(df.select("id"), shared_folder(spark) + "/out", batch=1)
assert extract_csv(spark, shared_folder(spark) + "/out").count() == 50
assert shared_folder(spark) == shared_folder(spark)
print("fine")
"""


def test_without_any_spark_setting(tmp_path):
    (tmp_path / "conf").mkdir()
    env = {**os.environ, "SPARK_CONF_DIR": str(tmp_path / "conf"), "PYTHONPATH": str(Path(__file__).resolve().parents[1])}
    run = subprocess.run([sys.executable, "-c", SCRIPT], env=env, cwd=tmp_path, capture_output=True, text=True, timeout=300)
    assert run.stdout.strip().endswith("fine"), run.stderr[-2000:]
