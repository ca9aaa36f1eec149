"""What is registered when a part of the copy can't be imported."""

import subprocess
import sys
from pathlib import Path

ROOT = str(Path(__file__).resolve().parents[1])
COUNT = """
import sys
sys.path.insert(0, {root!r})
sys.modules[{blocked!r}] = None
import __spark_entry__ as driver
print(len(driver.queries()), len(driver.star_queries()), set(driver.oracle_sql()) >= set(driver.ORACLE))
"""


def test_queries_without_a_dependency_of_the_text_operators():
    for blocked in ("ahocorasick", "numpy", "crosstally.llm"):
        code = COUNT.format(root=ROOT, blocked=blocked)
        done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=120)
        assert done.returncode == 0, done.stderr
        all_queries, reports, whole = done.stdout.split()
        assert all_queries == reports and int(reports) >= 21 and whole == "True"
