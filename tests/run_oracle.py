"""Run registered queries against their oracle SQL: python tests/run_oracle.py [sf_dir] [name ...]"""
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import oracle_util as U  # noqa: E402
from creditlens.plans import registry  # noqa: E402
from creditlens.session import get_spark  # noqa: E402


def main(argv):
    sf = argv[0] if argv and argv[0].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in argv if not a.startswith("/")]
    registry.load_all()
    spark = get_spark("local[8]", 8)
    names = names or sorted(registry.QUERIES)
    bad = 0
    for n in names:
        t0 = time.time()
        sql = registry.ORACLE.get(n)
        try:
            if sql is None:
                rows = registry.QUERIES[n](spark, sf).count()
                ok, msg = True, f"no oracle ({rows} rows)"
            else:
                ok, msg, rows = U.check(spark, registry.QUERIES[n], sql(), sf, digits=17)
                if not ok:
                    ok2, msg2, _ = U.check(spark, registry.QUERIES[n], sql(), sf, digits=10)
                    msg = ("[tolerant ok] " if ok2 else "") + msg
        except Exception as e:  # noqa: BLE001
            ok, msg, rows = False, f"ERROR {type(e).__name__}: {str(e)[:1500]}", -1
        bad += not ok
        print(f"{'PASS' if ok else 'FAIL'} {n:32s} rows={rows:<7} {time.time()-t0:6.1f}s {msg[:1500]}", flush=True)
    print(f"{len(names) - bad}/{len(names)} passed")


if __name__ == "__main__":
    main(sys.argv[1:])
