"""The registered SQL against the queries, on a small table with nulls, repeats, short texts and planted passages."""

import duckdb
import pytest

from millrace.llm import catalog


def _tables(spark, folder) -> str:
    passage = " ".join(f"Shared{k}" for k in range(60))
    item = "How many legs has the spider in the old house?"
    texts = [passage, "one " + passage + " end", None, "", "  a\u00a0b\tC ", passage, f"{item} {item} x", item.upper(), "tiny item", "word " * 80]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{folder}/documents.parquet")
    items = [(1, item), (20, "TINY item"), (3, None), (4, "..."), (5, item)]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    html = ["<p>" + "x" * 200, None, "", "short", "<p>" + "x" * 200, "\u00e4" * 60, "short"]
    pages = [(k, f"http://a.org/{k}", h) for k, h in enumerate(html)]
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(f"{folder}/pages.parquet")
    return str(folder)


@pytest.mark.parametrize("name", ["op5_substrings", "op9_warc", "op10_decontamination"])
def test_sql(spark, tmp_path, name):
    folder = _tables(spark, tmp_path)
    with duckdb.connect() as db:
        for table in ("documents", "benchmark", "pages"):
            db.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet/*.parquet')")
        relation = db.sql(catalog.ORACLES[name])
        order = sorted(relation.columns)
        want = relation.project(", ".join(order)).fetchall()
    got = [tuple(r) for r in catalog.QUERIES[name](spark, folder).select(*order).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
