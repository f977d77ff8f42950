import pytest

from plumbline.sources import reference as ref


def tree(root):
    for path, text in {
        "EOD/Dhan/NSE/EQUITY/abc.csv": "date,close\n", "EOD/Kite/BSE/ETF/XYZ.csv": "x", "EOD/Dhan/NSE/EQUITY/EMPTY.csv": "", "EOD/Other/NSE/EQUITY/NOPE.csv": "x",
        "EOD/Dhan/LSE/EQUITY/NOPE.csv": "x", "INTRADAY/Upstox/NSE/INDEX/NIFTY 50.csv": "x", "NOTES/Dhan/NSE/EQUITY/NOPE.csv": "x", "EOD/Dhan/NSE/EQUITY/readme.txt": "x",
    }.items():
        p = root / path
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_text(text)


def test_discovery(spark, tmp_path):
    tree(tmp_path)
    symbols = lambda mode: [r.symbol for r in ref.discover(spark, str(tmp_path), mode).collect()]
    assert symbols("Both") == ["ABC", "NIFTY 50", "XYZ"] and symbols("EOD") == ["ABC", "XYZ"] and symbols("Intraday") == ["NIFTY 50"]
    why = {r.path.rpartition("/")[2]: r.reason for r in ref.files(spark, str(tmp_path)).collect() if "NOPE" not in r.path}
    assert "EMPTY.csv" not in why and why["abc.csv"] is None
    asked = spark.createDataFrame([("EOD", "DHAN", "NSE", "EQUITY", s) for s in ("ABC", "EMPTY", "GONE")], "timeframe string, source string, exchange string, product_class string, symbol string")
    assert sorted((r.symbol, r.reason) for r in ref.missing(spark, str(tmp_path), asked).collect()) == [("EMPTY", "no file, or an empty one"), ("GONE", "no file, or an empty one")]


def test_instruments(spark, tmp_path):
    (tmp_path / "i.csv").write_text(
        " Symbol ,display_name,instrument_type,listing_date,PAID UP VALUE,lot_size,ISIN,price_band_pct,tick_size,file_prefix_bse,file_prefix_nse,nse_symbol,bse_symbol,product_classes\n"
        "ABC, Abc Ltd ,Equity,06-Nov-95,10,25.0,IN01,10,0.01,B1,N1,ABC,,\"EQUITY, FUTURES\"\n"
        "XYZ,,Etf,not a date,,x,,,,,,,,ETF\n"
    )
    a, b = ref.instruments(spark, str(tmp_path / "i.csv")).orderBy("symbol").collect()
    assert (a.display_name, a.type, a.exchanges, a.product_classes, a.lot_size, a.tick_size, a.price_band_pct, a.paid_up_value) == ("Abc Ltd", "equity", ["NSE"], ["EQUITY", "FUTURES"], 25, 0.01, 10.0, "10")
    assert (b.display_name, b.type, b.exchanges, b.product_classes, b.lot_size, b.tick_size, b.price_band_pct, str(b.listing_date), b.isin) == ("XYZ", "etf", ["NSE", "BSE"], ["ETF"], 1, 0.05, 20.0, "2000-01-01", "")


def test_universe(spark, tmp_path):
    (tmp_path / "u.csv").write_text("Company, SYMBOL ,industry\nOne, abc ,Steel\nTwo,,Oil\nThree,xyz,\n")
    assert [(r.symbol, r.industry) for r in ref.universe(spark, str(tmp_path / "u.csv")).orderBy("place").collect()] == [("ABC", "Steel"), ("XYZ", None)]
    (tmp_path / "v.csv").write_text("a,b\n1,2\n")
    with pytest.raises(ValueError):
        ref.universe(spark, str(tmp_path / "v.csv"))


def test_results_and_audits_round_trip(spark, tmp_path):
    rows = spark.createDataFrame([("ABC", "EOD-001", "Fail", 5.0, 0.0, "x"), ("ABC", "EOD-002", "Pass", 5.0, 5.0, "y")], "symbol string, test_id string, status string, weight double, weighted_score double, extra string")
    ref.write_results(rows, str(tmp_path / "r"))
    got = ref.read_results(spark, str(tmp_path / "r")).orderBy("test_id").collect()
    assert len(got[0]) == 16 and [(r.test_id, r.status, r.weight, r.weighted_score, r.success_score) for r in got] == [("EOD-001", "Fail", 5.0, 0.0, 0.0), ("EOD-002", "Pass", 5.0, 5.0, 0.0)]
    audit = spark.createDataFrame([("RECT-EOD-001", "changed", "close", None, 1.5, 0.95), ("RECT-EOD-002", "inserted", "close", None, 1.5, 0.85)], "rule_id string, action string, field string, old_value double, new_value double, confidence double")
    ref.write_audit(audit, str(tmp_path / "a"))
    assert spark.read.json(str(tmp_path / "a/json")).count() == 2 and spark.read.option("header", True).csv(str(tmp_path / "a/csv")).count() == 2
    assert {(r.action, r.changes, r.confidence) for r in spark.read.json(str(tmp_path / "a/summary")).collect()} == {("changed", 1, 0.95), ("inserted", 1, 0.85)}
