"""The subpackage's registered queries against their DuckDB oracles, and the entry's guard."""

import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

from test_oracles import SF_SMALL, TABLES, bag

import __spark_entry__ as entry
from landfall.llm.oracles import ORACLE_SQL
from landfall.llm.queries import QUERIES

REPO = Path(__file__).resolve().parents[2]


@pytest.mark.parametrize("key", sorted(ORACLE_SQL))
def test_query_matches_oracle(spark, key):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    df = QUERIES[key](spark, SF_SMALL)
    res = con.execute(ORACLE_SQL[key])
    names = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(names)
    assert bag(df.collect(), df.columns) == bag(res.fetchall(), names)


def test_one_query_for_each_operator():
    names = list(entry.queries())
    assert [sum(n.startswith(f"op{i}_") for n in names) for i in range(1, 14)] == [1] * 13
    assert "pipeline" in names


def test_library_does_not_import_llm():
    for f in (REPO / "landfall").rglob("*.py"):
        if "llm" not in f.relative_to(REPO).parts:
            assert "landfall.llm" not in f.read_text(), f


def test_entry_without_the_subpackage():
    code = (
        "import sys\n"
        "class Gone:\n"
        "    def find_spec(self, name, path=None, target=None):\n"
        "        if name.startswith('landfall.llm') or name == 'corpus_pipeline': raise ModuleNotFoundError(name)\n"
        "sys.meta_path.insert(0, Gone())\n"
        "import importlib.util\n"
        "importlib.util.find_spec = lambda name, package=None: None\n"
        "import __spark_entry__ as e\n"
        "assert not [k for k in e.queries() if k.startswith('op') and k[2].isdigit() or k == 'pipeline']\n"
        "assert 'pipeline_report' in e.queries()\n"
    )
    subprocess.run([sys.executable, "-c", code], cwd=REPO, check=True)
