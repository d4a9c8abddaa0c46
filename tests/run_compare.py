"""Run every registered query against its oracle: python tests/run_compare.py [sf_dir] [names...]"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import __spark_entry__ as E  # noqa: E402
from compare import compare, duck  # noqa: E402

from skyfold.session import local_session  # noqa: E402


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark = local_session(8)
    con = duck(sf_dir)
    qs, sql = E.queries(), E.oracle_sql()
    ok = True
    for name, fn in qs.items():
        if names and name not in names:
            continue
        t = time.time()
        try:
            df = fn(spark, sf_dir)
            if name in sql:
                r = compare(df, con, sql[name])
            else:
                r = {"rows_spark": df.count(), "oracle": None}
        except Exception as e:  # noqa: BLE001
            r = {"error": repr(e)[:1500]}
        r["sec"] = round(time.time() - t, 2)
        good = r.get("hash_match", "oracle" in r and "error" not in r)
        ok &= bool(good)
        print(("OK  " if good else "FAIL"), name, json.dumps(r, default=str)[:3000], flush=True)
    print("ALL OK" if ok else "SOME FAILED")


if __name__ == "__main__":
    main()
