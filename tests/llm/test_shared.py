import os
import subprocess
import sys

CODE = """
import os, sys
from gantry.llm.queries import QUERIES
from gantry.session import local_session

spark = local_session(2, 2, "2g", **{"spark.checkpoint.dir": "file://" + sys.argv[1]})
print(QUERIES["op11_centroids"](spark, "/root/testdata/sf0.001").count(), "rows", sorted(os.listdir(sys.argv[1])))
"""


def test_nothing_is_left_in_the_shared_folder(tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    out = subprocess.run([sys.executable, "-c", CODE, str(tmp_path)], capture_output=True, text=True, timeout=300, env=os.environ | {"PYTHONPATH": f"{root}:{os.environ.get('PYTHONPATH', '')}"})
    assert out.returncode == 0, out.stderr[-2000:]
    assert "500 rows" in out.stdout and "gantry-" in out.stdout
    assert [f for f in os.listdir(tmp_path) if "gantry" in f] == []
