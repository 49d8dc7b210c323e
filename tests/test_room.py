"""What staged tables and facts take on disk."""

from pathlib import Path

import golden
import pyarrow.parquet as pq
from conftest import rows

from stockweek.operators.quarantine import SIDE_BY_SIDE, split_unknown_keys
from stockweek.plans.raw_load import load_raw
from stockweek.sinks.files import write_fact
from stockweek.sources.csv import read_csv
from stockweek.testbed import queries


def test_dumps_are_compressed_in_files_of_few_lines(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(queries, "DUMP_LINES", 3)
    sales = golden.sales(spark).coalesce(1)
    queries._write_dump(sales, f"{tmp_path}/dump")
    files = list(Path(f"{tmp_path}/dump").glob("part-*"))
    assert len(files) == 3 and all(f.suffix == ".lz4" for f in files)
    assert rows(read_csv(spark, "sales", f"{tmp_path}/dump")) == rows(sales)


def test_a_fact_is_written_compressed(spark, tmp_path):
    fact = spark.sql("SELECT 2022 AS YR_NUM, 2 AS WK_NUM, 1 AS STORE_KEY, 1 AS PROD_KEY, 1.5D AS WK_SALES_QTY")
    write_fact(fact, f"{tmp_path}/fact", "yr_num")
    (file,) = Path(f"{tmp_path}/fact").glob("YR_NUM=2022/*.parquet")
    column = pq.ParquetFile(file).metadata.row_group(0).column(0)
    assert column.compression == "ZSTD"
    assert [r["WK_SALES_QTY"] for r in spark.read.parquet(f"{tmp_path}/fact").collect()] == [1.5]


def codecs(folder):
    files = list(Path(folder).rglob("*.parquet"))
    return {pq.ParquetFile(f).metadata.row_group(0).column(0).compression for f in files}


def test_rows_set_apart_are_written_compressed(spark, tmp_path):
    before = {name: spark.conf.get(name) for name in SIDE_BY_SIDE}
    sales = golden.sales(spark)
    split = split_unknown_keys(sales, "sales", f"{tmp_path}/split")
    assert codecs(f"{tmp_path}/split") == {"ZSTD"}
    assert rows(split.kept.unionAll(split.rejected.drop("REASON"))) == rows(sales)
    assert {name: spark.conf.get(name) for name in SIDE_BY_SIDE} == before


def test_raw_tables_are_written_compressed(spark, tmp_path):
    golden.sales(spark).write.options(header="true").csv(f"{tmp_path}/staged")
    loaded = load_raw(spark, {"sales": f"{tmp_path}/staged"}, "raw_room", f"{tmp_path}/db")
    spark.catalog.setCurrentDatabase("default")
    assert codecs(f"{tmp_path}/db") == {"ZSTD"}
    assert loaded["sales"].count() == golden.sales(spark).count()


def test_staged_dumps_go_once_they_are_loaded(spark, tmp_path):
    import test_updates

    base, made = f"{tmp_path}/raw", test_updates.tables(spark)
    queries.tables._stored[f"{tmp_path}", "item"] = f"{tmp_path}/item"
    try:
        for name, df in made.items():
            df.write.parquet(f"{tmp_path}/item/{name}")
        loaded = queries._load_raw(spark, f"{tmp_path}", base)
        assert not Path(f"{base}/staged").exists()
        assert {name: df.count() for name, df in loaded.items()} == {name: df.count() for name, df in made.items()}
    finally:
        del queries.tables._stored[f"{tmp_path}", "item"]
