"""The pipeline on small tables: every stage keeps the columns and does what its operator says; all queries against DuckDB."""

from __future__ import annotations

import duckdb
import pandas.api.types as types
import pytest

import corpus_pipeline
from tableferry.llm import queries

TABLES = "documents embeddings pages benchmark labels conversations".split()
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_its_sql(spark, duck, name):
    one, two = queries.QUERIES[name](spark, SF).toPandas(), duck.execute(queries.ORACLES[name]).df()
    assert sorted(one.columns) == sorted(two.columns) and len(one) == len(two)

    def plain(x):
        x = x.assign(**{c: x[c].astype(float) for c in x.columns if types.is_numeric_dtype(x[c]) and not types.is_bool_dtype(x[c])})
        return sorted(tuple(str(v) for v in r) for r in x[sorted(x.columns)].itertuples(index=False))

    assert plain(one) == plain(two)


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLES)))
def test_query_without_sql_returns_every_row(spark, duck, name):
    table = "pages" if name.startswith("op8") else "documents"
    assert queries.QUERIES[name](spark, SF).count() == duck.execute(f"SELECT count(*) FROM {table}").fetchone()[0]


def test_stages_on_odd_rows(spark, tmp_path):
    clean = [(i, " ".join(f"w{(i * 7919 + j * 104729) % 5003}" for j in range(60)), "en", f"src{i % 4}", None, "d", "r", "s") for i in range(40)]
    bench = " ".join(f"b{j}" for j in range(30))
    odd = [(100, None, None, None, None, None, None, None), (101, "", "en", "s", 0, None, None, None), (102, clean[0][1], "en", "src0", 1, None, None, None), (103, "x " + bench, "en", "src1", 1, None, None, None), (104, "1 2 3", "en", "src1", 1, None, None, None)]
    rows = [*clean, *odd, clean[3]]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, domain string, row string, digest string").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, bench)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    columns, ids = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, str(tmp_path)).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        ids[name] = sorted(r["doc_id"] for r in docs.collect())
        assert docs.columns == columns + ["shard", "slot"] * (name == "sharding")
    assert ids["language_id"] == sorted([*range(40), 102, 103, 3])
    assert ids["near_duplicates"] == [*range(40), 103] and ids["decontamination"] == list(range(40))
    assert set(ids["source_mix"]) <= set(range(40)) and 0.6 * 40 <= len(ids["source_mix"]) and ids["sharding"] == ids["source_mix"]
    assert {r["domain"] for r in docs.collect()} == {"d"}


def test_stages_on_empty_tables(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
