"""Run queries over one table set and print counts and times: ``python tests/llm/run_small.py 0.01 op6_...``."""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from __spark_entry__ import queries  # noqa: E402
from fieldloom.session import local_session  # noqa: E402

if __name__ == "__main__":
    root = sys.argv[1] if "/" in sys.argv[1] else f"/root/testdata/sf{sys.argv[1]}"
    spark = local_session(8, "small")
    for name in sys.argv[2:]:
        start = time.time()
        rows = queries()[name](spark, root).toPandas()
        print(name, len(rows), f"{time.time() - start:.1f} s")
        print(rows.head(5).to_string(max_colwidth=70))
