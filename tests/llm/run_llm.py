"""Run the registered queries of the subpackage against their SQL: ``run_llm.py sf_dir [key ...]``."""

import sys
import time

sys.path[:0] = [__file__.rsplit("/", 3)[0], __file__.rsplit("/", 2)[0]]

from oracle import compare, connect  # noqa: E402

from millrace import session  # noqa: E402
from millrace.llm.queries import CASES  # noqa: E402


def main(sf_dir: str, keys: list[str]) -> None:
    spark = session.build(
        "llm", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false", spark__driver__memory="8g",
        spark__ui__showConsoleProgress="false", spark__sql__warehouse__dir="/tmp/millrace-warehouse",
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    for key in keys or CASES:
        began = time.time()
        case = CASES[key]
        if case.sql:
            print(key, compare(spark, con, case, sf_dir) or "agrees", round(time.time() - began, 1), flush=True)
        else:
            found = case.run(spark, sf_dir).toPandas()
            print(key, len(found), "rows", round(time.time() - began, 1), flush=True)
            print(found.head(3).to_string(), flush=True)


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
