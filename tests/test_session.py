import os
import subprocess
import sys

CODE = """
import sys
from gantry.plans.catalog import QUERIES
from gantry.session import local_session

spark = local_session(2, 2, "2g", **{"spark.checkpoint.dir": "file://" + sys.argv[1]})
print(len(QUERIES["monthly_cache"](spark, "/root/testdata/sf0.001").collect()), "rows")
assert len(QUERIES["history_snapshot"](spark, "/root/testdata/sf0.001").collect()) > 0
import os
print(sorted(os.listdir(sys.argv[1])))
"""


def test_nothing_is_left_in_the_shared_folder(tmp_path):
    """Tables of an application lie in a folder of its own and go when it ends."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = subprocess.run([sys.executable, "-c", CODE, str(tmp_path)], capture_output=True, text=True, timeout=300, env=os.environ | {"PYTHONPATH": root})
    assert out.returncode == 0, out.stderr[-2000:]
    assert "rows" in out.stdout and "gantry-" in out.stdout
    assert [f for f in os.listdir(tmp_path) if "gantry" in f] == []  # besides it lies a folder of Spark's own, for checkpoints
