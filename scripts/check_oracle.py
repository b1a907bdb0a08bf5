"""Run registered queries on Spark and their SQL twins on DuckDB; compare.

Usage: python scripts/check_oracle.py [sf_dir] [name ...]
Row count, column names and the multiset of rows must agree exactly.
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from strata.plans.registry import ORACLE_SQL, QUERIES, load_all  # noqa: E402
from strata.testing import compare, duck  # noqa: E402


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    load_all()
    from strata.session import local_session
    spark = local_session("oracle-check", 8)
    con = duck(sf_dir)
    bad = 0
    for name in (names or list(QUERIES)):
        t0 = time.time()
        try:
            sdf = QUERIES[name](spark, sf_dir).toPandas()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: spark error {type(e).__name__}: {str(e)[:400]}")
            bad += 1
            continue
        ts = time.time() - t0
        if name not in ORACLE_SQL:
            print(f"ROWS {name}: {len(sdf)} rows (no oracle) {ts:.1f}s")
            continue
        try:
            odf = con.execute(ORACLE_SQL[name]).df()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: duckdb error {str(e)[:400]}")
            bad += 1
            continue
        reason = compare(sdf, odf)
        if reason:
            print(f"FAIL {name}: {reason}")
            bad += 1
        else:
            print(f"OK   {name}: {len(sdf)} rows {ts:.1f}s")
    print(f"{bad} failing")
    sys.exit(1 if bad else 0)


if __name__ == "__main__":
    main()
