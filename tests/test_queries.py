"""Every registered query against its SQL twin in DuckDB."""

import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry_module  # noqa: E402
from newslake.catalog import QUERIES, SQL, corpora  # noqa: E402
from tools.check_queries import TABLES, compare  # noqa: E402


@pytest.fixture(scope="module")
def con(sf):
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf}/{name}.parquet')")
    return connection


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(name, spark, sf, con):
    if name == "backlog_newest":
        assert "LIMIT 30" in SQL[name]
    ok, note = compare(name, spark, sf, con)
    assert ok or note.endswith("equal: 0 rows"), note


def test_contract(spark):
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())
    flagship = entry_module.entry(spark)
    assert flagship.columns == ["lang", "term", "tf", "df", "score"]
    assert flagship.count() > 0


@pytest.mark.parametrize("missing", ["ahocorasick", "newslake.llm", "corpus_pipeline"])
def test_other_queries_stay_without_the_operators(missing):
    import subprocess

    code = (
        f"import sys; sys.modules[{missing!r}] = None; import __spark_entry__ as e; names = set(e.queries()); "
        "assert 'dedup_url' in names and 'pipeline' not in names and not any(n.startswith('op1') for n in names)"
    )
    root = Path(__file__).resolve().parents[1]
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True, timeout=120)


def test_sketches_are_stored_in_few_files(spark, sf, tmp_path, monkeypatch):
    """Not in a folder for every hundred documents."""
    monkeypatch.setattr(corpora, "work_dir", lambda spark, name: str(tmp_path / name))
    assert QUERIES["vocab_sketches"](spark, sf).count() > 0
    assert not [p for p in (tmp_path / "sketches").iterdir() if p.is_dir()]
