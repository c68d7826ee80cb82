"""Driver contract: entry runs, every query has a name-matched oracle or is
declared rows-only, and a sample of queries matches DuckDB at sf0.001."""

import __spark_entry__ as entry

from tools.oracle_check import compare

from .conftest import SF001

ROWS_ONLY: set[str] = set()


def test_entry_smoke(spark):
    df = entry.entry(spark)
    row = df.first()
    assert df.columns == ["total", "cleaned", "date_extracted", "skipped_errors", "skipped_no_text"]
    assert row["total"] == row["cleaned"] + row["skipped_errors"] + row["skipped_no_text"]


def test_every_query_has_oracle():
    qs, sqls = entry.queries(), entry.oracle_sql()
    own = {k for k in qs if not k.startswith("op") and k != "pipeline"}
    assert own - set(sqls) == ROWS_ONLY
    assert set(sqls) <= set(qs)


def test_sample_against_duckdb(spark):
    names = ["clean_articles", "incremental_build", "build_stats", "link_update",
             "upsert_articles", "extract_articles", "keywords", "embed_chunks"]
    assert compare(spark, SF001, names) == []
