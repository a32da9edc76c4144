"""The queries run where only the driver knows the library: tasks must get by value all they call."""

import os
import subprocess
import sys
from pathlib import Path

REPO = Path(__file__).resolve().parents[2]

SCRIPT = """
import sys
sys.path.insert(0, sys.argv[1])
from pyspark.sql import SparkSession
import __spark_entry__

settings = {
    "spark.master": "local[8]", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
    "spark.sql.shuffle.partitions": "4", "spark.sql.warehouse.dir": "warehouse", "spark.checkpoint.dir": "shared",
}
spark = SparkSession.builder.config(map=settings).getOrCreate()

def known(batches):
    import importlib.util
    for batch in batches:
        assert importlib.util.find_spec("smeltery") is None, "the tasks find the library"
        yield batch

spark.range(1).mapInArrow(known, "id long").count()
for name, query in __spark_entry__.queries().items():
    if name == "pipeline" or name.startswith("op"):
        print(name, len(query(spark, "/root/testdata/sf0.001").toArrow()) > 0, flush=True)
"""


def test_queries_run_without_the_library_on_executors(tmp_path):
    clean = {k: v for k, v in os.environ.items() if k != "PYTHONPATH" and not k.startswith(("SPARK_", "PYSPARK_GATEWAY"))}
    run = [sys.executable, "-c", SCRIPT, str(REPO)]
    done = subprocess.run(run, cwd=tmp_path, env=clean, capture_output=True, text=True, timeout=900, check=False)
    assert done.returncode == 0, done.stderr[-3000:]
    said = [line for line in done.stdout.splitlines() if line.endswith((" True", " False"))]
    assert len(said) >= 12 and all(line.endswith(" True") for line in said), said
