import re

import __spark_entry__ as driver
from crosstally.llm.queries import QUERIES, SQL


def test_each_operator_is_registered_once():
    numbers = sorted(int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES)
    assert numbers == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(driver.queries())
    assert set(SQL) <= set(QUERIES) and set(SQL) <= set(driver.oracle_sql())
