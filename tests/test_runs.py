import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from wattmill import cli
from wattmill.plans import retention, rules, runs
from wattmill.plans.registry import dataset


def test_command_line(spark, tmp_path, capsys):
    root = str(tmp_path / "lake" / "data")
    main = lambda *a: cli.main(["--root", root, *a], spark)
    assert main("init") == 0
    body = tmp_path / "p.json"
    body.write_text(json.dumps({"data": [{"settlementDate": "2024-06-01", "settlementPeriod": i, "systemSellPrice": 1.0, "systemBuyPrice": 3.0, "netImbalanceVolume": -2.0} for i in (1, 2)]}))
    assert main("ingest", "elexon", "system_prices", str(body), "--day", "2024-06-01") == 0
    assert main("pipeline", "elexon", "system_prices", "--start", "2024-06-01") == 0
    gold = spark.read.parquet(f"{root}/gold/system_marginal_price")
    assert {(r.spread, r.abs_imbalance) for r in gold.collect()} == {(2.0, 2.0)}
    assert main("status") == 0 and "success" in capsys.readouterr().out
    assert main("export-csv", "silver_system_prices", str(tmp_path / "out"), "--limit", "1") == 0
    assert spark.read.csv(str(tmp_path / "out"), header=True).count() == 1
    assert main("quality") in (0, 1)
    assert main("prune", "--before", "2024-07-01") == 0
    assert "2024/06/01" in capsys.readouterr().out
    assert len(retention.prune(root, date(2024, 7, 1), ("bronze",), True)) == 1 and retention.prune(root, date(2024, 7, 1)) == []
    assert retention.prune(root, date(2024, 6, 1), ("silver",)) == []
    assert retention.reset(root, ("gold",), apply=True) and retention.reset(root, ("gold",)) == []
    with pytest.raises(ValueError):
        retention.guarded(root, "/tmp")


def test_validation_counts_and_keeps(spark):
    rows = spark.createDataFrame([("2024-06-01", 1, 5.0, "II"), ("2024-06-01", 51, 20000.0, "ZZ"), (None, None, None, None)], "d string, settlement_period int, system_sell_price double, run_type string")
    rows = rows.withColumns({"timestamp_utc": F.col("d").cast("timestamp"), "system_buy_price": F.lit(0.0)})
    got = rules.validate(rows, dataset("elexon", "system_prices")).first()
    assert (got.n_rows, got.settlement_period_in_range, got.system_sell_price_in_range, got.run_type_known, got.timestamp_utc_present) == (3, 1, 1, 1, 1)


def test_status_and_columns(spark):
    assert runs.status(5, False, False, 0, 0) == "success" and runs.status(5, False, False, 0, 1) == "completed_with_warnings"
    assert runs.status(0, True, False, 0, 0) == runs.status(0, False, False, 3, 0) == "failed"
    df = spark.createDataFrame([(1,)], "a int")
    assert runs.normalise_published_at(df, ["published_at", "a"]).dtypes[0] == ("published_at", "timestamp")
    with pytest.raises(ValueError):
        runs.normalise_published_at(df, ["b"])
