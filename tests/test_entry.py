import subprocess
import sys
from pathlib import Path

HERE = Path(__file__).resolve().parent.parent

SCRIPT = f"""
import sys
sys.path.insert(0, {str(HERE)!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
import __spark_entry__ as entry
rows = entry.queries()["user_scorer"](spark, entry.SMOKE_DIR).collect()
print("rows", len(rows))
"""


def test_workers_find_the_package_from_another_folder(tmp_path):
    """A session that is started elsewhere, without the package on its path."""
    done = subprocess.run([sys.executable, "-c", SCRIPT], cwd=tmp_path, env={"PATH": "/usr/bin:/bin", "HOME": str(tmp_path)} | java(), capture_output=True, text=True, timeout=300)
    assert "rows" in done.stdout, done.stderr[-2000:]


def java() -> dict[str, str]:
    import os

    return {k: v for k, v in os.environ.items() if k in ("JAVA_HOME", "PATH", "SPARK_HOME", "SPARK_LOCAL_IP")}
