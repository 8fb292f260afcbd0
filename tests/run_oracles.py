"""Run queries against their SQL: ``python -m tests.run_oracles [--sf 0.01] [name ...]``."""

from __future__ import annotations

import argparse
import time

from headway.session import local_session
from tests.oracle import compare, connect


def main() -> None:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="0.01")
    parser.add_argument("--dir", help="folder of the tables, instead of a scale factor")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    import __spark_entry__ as entry

    sf_dir = args.dir or f"/root/testdata/sf{args.sf}"
    spark = local_session("oracles", "8")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    failed = []
    for name in args.names or queries:
        start = time.time()
        try:
            df = queries[name](spark, sf_dir)
            if name in oracles:
                problems, kind = compare(df, con, oracles[name]), "sql"
            else:
                kind, problems = f"{df.count()} rows", []
        except Exception as error:  # report and go on
            problems, kind = [f"{type(error).__name__}: {str(error)[:1500]}"], "error"
        if problems:
            failed.append(name)
        print(f"{'FAIL' if problems else 'ok  '} {name} [{kind}] {time.time() - start:.2f}s", flush=True)
        for problem in problems:
            print("     ", problem, flush=True)
    print(f"{len(failed)} failed: {failed}" if failed else "all agree")


if __name__ == "__main__":
    main()
