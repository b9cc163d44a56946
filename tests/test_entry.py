import os
import shutil
import subprocess
import sys

import pytest

import __spark_entry__ as entry
from millrace.plans import catalog as core

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def test_every_query_has_sql():
    assert set(core.QUERIES) - set(core.ORACLES) == set()
    assert set(core.QUERIES) <= set(entry.queries()) and set(core.ORACLES) <= set(entry.oracle_sql())


@pytest.mark.skipif(not os.path.isdir(SF), reason="needs the generated tables")
@pytest.mark.parametrize("name", ["first_rule", "lines_with_source", "framed_roundtrip", "segment_sentences", "lang_identify", "tokenize_native", "tokenize_exact", "segment_exact", "segment_compat", "pos_tag", "pipeline_a", "tagged_files", "rule_files", "action_file_tokens", "segment_files", "word_list_files", "stream_windows", "sql_functions", "lang_unknown"])
def test_query_equals_its_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got = core.QUERIES[name](spark, SF)
    cols = sorted(got.columns)
    want = con.sql(f"SELECT {', '.join(cols)} FROM ({core.ORACLES[name]})").fetchall()
    assert sorted(map(repr, want)) == sorted(repr(tuple(r)) for r in got.select(*cols).collect())


def test_the_rest_stands_without_the_training_data_operators(tmp_path):
    """In a copy of the tree without both llm folders the entry imports and has the engine's queries, and only those."""
    root = os.path.dirname(os.path.abspath(entry.__file__))
    shutil.copytree(root, tmp_path / "repo", ignore=lambda folder, names: [n for n in names if n in ("llm", ".git", "__pycache__", ".pytest_cache")])
    code = "import __spark_entry__ as e; from millrace.plans import catalog as c; assert set(e.queries()) == set(c.QUERIES) == set(e.oracle_sql()); import bench, millrace.cli, millrace.streaming.flows"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "repo", check=True, env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"})
