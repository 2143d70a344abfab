"""Run registered queries against DuckDB: ``python tests/run_oracle.py <data dir> [name ...]``."""

import sys
import tempfile
import time
import traceback
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import __spark_entry__ as contract  # noqa: E402
from stratalake.session import build_session  # noqa: E402
from tests.oracle import connect, differences  # noqa: E402


def main(directory: str, names: list[str]) -> int:
    spark = build_session("oracle", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="run-")})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(directory)
    queries, sql = contract.queries(), contract.oracle_sql()
    bad = 0
    for name in names or queries:
        start = time.time()
        try:
            df = queries[name](spark, directory)
            found = differences(df, con, sql[name]) if name in sql else ["no SQL"]
            rows = "" if found else f"{con.execute(f'SELECT count(*) FROM ({sql[name]})').fetchall()[0][0]} rows"
        except Exception:
            found, rows = [traceback.format_exc()[-1500:]], ""
        bad += bool(found)
        print(f"{'BAD ' if found else 'ok  '} {name:28s} {time.time() - start:6.1f}s {rows}", *found, sep="\n     " if found else " ")
    print(f"{bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(bool(main(sys.argv[1], sys.argv[2:])))
