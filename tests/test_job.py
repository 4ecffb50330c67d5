"""The submitted job, from raw CSV folders to gold."""

from dataclasses import replace

import pytest
from fixture import FULL, logs, raw_logs, rows
from pyspark.sql import functions as F

import job
from daybook.sinks.files import append_logs, read_silver
from daybook.sinks.gold import read_quarantine
from daybook.sources.bronze import read_logs
from daybook.sources.gold import read_gold


def test_job_end_to_end(spark, tmp_path, capsys):
    bronze, silver, gold = (str(tmp_path / layer) for layer in ("bronze", "silver", "gold"))
    append_logs(logs(spark), bronze)
    layers = ["--bronze-base", bronze, "--silver-base", silver, "--gold-base", gold]
    layers += ["--gold-format", "csv", "--silver-format", "csv"]
    job.main([*layers, "--write-silver"])
    assert rows(read_gold(spark, f"{gold}/daily_gmv", "csv")) == FULL
    assert read_silver(spark, silver, "csv").purchase.count() == 6
    window = ["--start-date", "2023-02-14", "--end-date", "2023-02-28"]
    job.main([*layers, *window, "--previous-silver", silver])
    assert rows(read_gold(spark, f"{gold}/daily_gmv", "csv")) == FULL
    assert capsys.readouterr().out.count("written: window") == 2


def test_ingest_then_run(spark, tmp_path):
    names = ("bronze", "typed", "silver", "gold", "rejected", "figures")
    bronze, typed, silver, gold, rejected, figures = (str(tmp_path / n) for n in names)
    raw = raw_logs(spark)
    broken = F.when(F.col("purchase_id") == "70", "ten").otherwise(F.col("item_quantity"))
    append_logs(replace(raw, product_item=raw.product_item.withColumn("item_quantity", broken)), bronze)
    job.main(
        ["--bronze-base", bronze, "--typed-base", typed, "--gold-base", gold, "--silver-base", silver,
         "--write-silver", "--quarantine-base", rejected, "--metrics-path", figures]
    )
    assert rows(read_gold(spark, f"{gold}/daily_gmv")) == FULL
    assert read_logs(spark, typed, "parquet").product_item.count() == 7
    (row,) = spark.read.parquet(f"{rejected}/bronze/rows").collect()
    assert (row.table_name, row.bad_columns) == ("product_item", "item_quantity")
    assert '"purchase_id":"70"' in row.cells
    assert read_quarantine(spark, f"{rejected}/daily_gmv").isEmpty()
    assert spark.read.parquet(figures).filter("metric = 'gold_rows' AND value = '3'").count() == 1


def test_defaults():
    p = job.parameters(["--bronze-base", "b", "--gold-base", "g"])
    assert (p.days_back, p.start_date, p.mode, p.write_silver) == (30, None, "state_complete", False)
    assert (p.bronze_format, p.silver_format, p.gold_format) == ("csv", "parquet", "parquet")


@pytest.mark.parametrize("arguments", [[], ["--bronze-base", "b", "--gold-base", "g", "--write-silver"]])
def test_folders_have_to_be_named(arguments, capsys):
    with pytest.raises(SystemExit):
        job.parameters(arguments)
    assert "usage" in capsys.readouterr().err
