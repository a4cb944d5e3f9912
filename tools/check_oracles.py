"""Dev tool: run every registered query and its DuckDB oracle, print a
match table.  Usage: python tools/check_oracles.py SF_DIR [name ...]"""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from rebuy.plans.oracle import SQL  # noqa: E402
from rebuy.plans.queries import REGISTRY  # noqa: E402
from rebuy.session import local_session  # noqa: E402
from tests.oracle_harness import compare, duck  # noqa: E402


def main():
    sf = sys.argv[1]
    names = sys.argv[2:] or sorted(REGISTRY)
    spark = local_session(8)
    con = duck(sf)
    bad = 0
    for n in names:
        t0 = time.time()
        try:
            df = REGISTRY[n](spark, sf)
            if n in SQL:
                ok, msg = compare(df, SQL[n], con)
            else:
                ok, msg = True, f"{df.count()} rows (no oracle)"
        except Exception as e:  # noqa: BLE001
            ok, msg = False, f"ERROR {type(e).__name__}: {str(e)[:400]}"
        bad += not ok
        print(f"{'OK ' if ok else 'BAD'} {n:28s} {time.time() - t0:6.1f}s  {msg}", flush=True)
    print(f"{len(names) - bad}/{len(names)} match")


if __name__ == "__main__":
    main()
