"""Command line: compare all or some queries with their oracles at one scale."""

import sys
import time

sys.path.insert(0, __file__.rsplit("/", 2)[0])

from __spark_entry__ import oracle_sql, queries  # noqa: E402
from fieldloom.session import local_session  # noqa: E402
from tests.oracle import connect, differences  # noqa: E402


def main() -> int:
    root = f"/root/testdata/sf{sys.argv[1]}"
    wanted = sys.argv[2:]
    spark, con = local_session(8), connect(root)
    qs, os_ = queries(), oracle_sql()
    bad = 0
    for key, q in qs.items():
        if wanted and key not in wanted:
            continue
        t = time.time()
        try:
            if key in os_:
                diff = differences(q(spark, root), con, os_[key])
                state = "ok" if not diff else "DIFF " + "; ".join(diff)
            else:
                state = f"no oracle, {q(spark, root).count()} rows"
            bad += state.startswith("DIFF")
        except Exception as e:  # noqa: BLE001
            bad += 1
            state = "ERROR " + str(e)[:700]
        print(f"{key:28s} {time.time() - t:6.2f}s {state}", flush=True)
    for key in os_:
        if key not in qs:
            print("oracle without query:", key)
    return bad


if __name__ == "__main__":
    sys.exit(main())
