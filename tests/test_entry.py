"""The driver's contract: the entry module imports without a session, and each SQL belongs to a query."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_imports_without_a_session():
    code = "import __spark_entry__ as e; assert set(e.oracle_sql()) <= set(e.queries()); print(len(e.queries()))"
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0 and int(done.stdout.split()[-1]) > 100, done.stderr[-500:]


def test_flagship(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
