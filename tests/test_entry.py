import os
import subprocess
import sys

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as contract  # noqa: E402
from check import TABLES, rows_of  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_contract_is_consistent(spark):
    queries, oracles = contract.queries(), contract.oracle_sql()
    assert set(oracles) <= set(queries) and len(queries) > 100
    assert contract.entry(spark).count() > 0


def test_some_queries_match_their_sql(spark):
    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    for name in ("bar_return_zscore", "triple_barrier", "temperature_calibration", "exact_quantiles", "day_islands"):
        df = contract.queries()[name](spark, SF)
        cur = con.execute(contract.oracle_sql()[name])
        got = rows_of(df.columns, df.collect())
        want = rows_of([d[0] for d in cur.description], cur.fetchall())
        assert got == want, name


def test_entry_imports_without_the_optional_subpackage():
    """Whether its modules or only a library of theirs is missing, all other queries stay."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    for hidden in ("tsforge.llm", "tsforge.llm.queries", "public_tokenizers", "ahocorasick"):
        code = f"import sys; sys.modules[{hidden!r}] = None; import __spark_entry__ as e; print(len(e.queries()), sorted(q for q in e.queries() if q == 'pipeline' or q.startswith('op1_')))"
        done = subprocess.run([sys.executable, "-B", "-c", code], cwd=root, capture_output=True, text=True, check=True)
        count, left = done.stdout.split(" ", 1)
        assert int(count) > 100 and left.strip() == "[]", hidden
