"""Compare queries with their SQL twins: ``python check.py [--sf DIR] [name ...]``."""

import sys
import time

sys.path.insert(0, "tests")
from compare import diff, duck

from quaymart.plans import registry
from quaymart.session import build_session

if __name__ == "__main__":
    args = sys.argv[1:]
    folder = "/root/testdata/sf0.01"
    if "--sf" in args:
        at = args.index("--sf")
        folder = args[at + 1]
        del args[at:at + 2]
    registry.load_all()
    families = [a for a in args if a in registry.FAMILIES]
    names = [n for n in args if n not in families]
    names += [n for n, f in registry.QUERIES.items() if f.__module__.split(".")[-1] in families]
    spark = build_session("check", 8)
    con = duck(folder)
    bad = 0
    for name in names or list(registry.QUERIES):
        start = time.perf_counter()
        try:
            df = registry.QUERIES[name](spark, folder)
            sql = registry.SQL_TWINS.get(name)
            if sql is None:
                n = len(df.collect())
                problems = [] if n else ["no rows"]
                note = f"rows-only {n}"
            else:
                problems = diff(df, con, sql)
                note = ""
        except Exception as exc:  # report every query, then fail at the end
            lines = str(exc).splitlines()
            causes = [x[:300] for x in lines if "Caused by" in x or "Serialization" in x
                      or x.strip().startswith("- ")]
            problems, note = [f"{type(exc).__name__}: {str(exc)[:600]}", *causes[:30]], ""
        bad += bool(problems)
        print(f"{'FAIL' if problems else 'ok  '} {name} {time.perf_counter() - start:.2f}s {note}",
              flush=True)
        for p in problems:
            print("     ", p, flush=True)
    print(f"{bad} failing")
    spark.stop()
    sys.exit(bool(bad))
