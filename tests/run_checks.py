"""Run chosen queries against their SQL checks: ``python tests/run_checks.py [sf_dir] [key ...]``."""

import sys
import time
import traceback

sys.path[:0] = [__file__.rsplit("/", 2)[0], __file__.rsplit("/", 1)[0]]

from importlib import import_module  # noqa: E402

from millrace import session  # noqa: E402
from millrace.plans.base import Cases  # noqa: E402
from oracle import compare, connect  # noqa: E402


def main(sf_dir: str, wanted: list[str]) -> int:
    cases = Cases()
    for module in [w for w in wanted if w.startswith("@")]:
        cases.update(import_module(f"millrace.plans.{module[1:]}").CASES)
    if not cases:
        from millrace.plans import all_cases

        cases.update(all_cases())
    keys = [w for w in wanted if not w.startswith("@")] or list(cases)
    spark = session.build(
        "checks", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false", spark__ui__showConsoleProgress="false",
        spark__driver__memory="8g", spark__sql__warehouse__dir="/tmp/millrace-warehouse",
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for key in keys:
        began = time.time()
        try:
            if cases[key].sql:
                problem = compare(spark, con, cases[key], sf_dir)
            else:
                rows = cases[key].run(spark, sf_dir).collect()
                problem = None if rows else "no rows"
        except Exception:
            problem = traceback.format_exc()[-1500:]
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {key} {time.time() - began:.2f}s {problem or ''}", flush=True)
    print(f"{len(keys) - bad} of {len(keys)} agree")
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
