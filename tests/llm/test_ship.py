"""Python operators from a folder that the workers do not know."""

import os
import subprocess
import sys

CODE = """
import sys
sys.path.insert(0, {root!r})
from cabmeter.session import build_session, drop_scratch
spark = build_session("local[2]", 2, "ship")
import __spark_entry__ as e
q = e.queries()
print("ROWS", q["op10_token_counts"](spark, {sf!r}).count(), q["op4_decontaminate"](spark, {sf!r}).count() > 0)
drop_scratch(spark)
"""


def test_operators_run_where_workers_cannot_import_the_package(tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", CODE.format(root=root, sf="/root/testdata/sf0.001")], cwd=tmp_path,
                         env=env, capture_output=True, text=True, timeout=300)
    assert "ROWS 200 True" in out.stdout, out.stderr[-2000:]
