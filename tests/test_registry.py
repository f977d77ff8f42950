"""The check registry: selections by id, layer, mode, gate and product."""

import pytest

from plumbline import catalogue
from plumbline.plans import dialect, registry


def test_registry_has_every_check_once():
    assert len(registry.REGISTRY) >= 230 and all(i == c.check_id for i, c in registry.REGISTRY.items())
    assert {c.mode for c in registry.REGISTRY.values()} == {"EOD", "Intraday", "Both"}


def test_filters_meet():
    both = registry.chosen(layer="eod", gate="Hard")
    assert both and all(c.layer == "EOD" and c.gate == "Hard" for c in both)
    assert [c.check_id for c in registry.chosen(ids=["INT-001", "EOD-001"])] == ["EOD-001", "INT-001"]
    modes = {m: {c.check_id for c in registry.chosen(mode=m)} for m in ("EOD", "Intraday", "Both")}
    assert modes["EOD"] | modes["Intraday"] == modes["Both"] == set(registry.REGISTRY)
    assert "INT-001" not in modes["EOD"] and "EOD-001" not in modes["Intraday"]
    for bad in ({"ids": ["NO-1"]}, {"mode": "eod"}, {"gate": "hard"}):
        with pytest.raises(ValueError):
            registry.chosen(**bad)


def test_families_without_a_chosen_check_are_not_planned(spark, sf):
    text = dialect.render(registry.plan(registry.chosen(ids=["EOD-001", "EOD-024"])), "spark")
    assert "checks_eod" in text and "{events}" not in text and "INT-" not in text
    assert registry.run(spark, sf, layer="nothing").collect() == []


def test_a_selection_equals_the_whole_run(spark, sf):
    ids = ["EOD-001", "EOD-024", "INT-003", "SRC-E002", "GOV-002", "LT-003"]
    whole = {tuple(r) for r in catalogue.QUERIES["check_results"](spark, sf).select("symbol", "exchange", "source", "check_id", "status", "value").collect() if r.check_id in ids}
    some = registry.run(spark, sf, ids=ids)
    assert {tuple(r) for r in some.select("symbol", "exchange", "source", "check_id", "status", "value").collect()} == whole and some.count() == len(whole)
    funds = registry.run(spark, sf, products=["ETF"], ids=["EOD-001"]).select("symbol").distinct().collect()
    assert [r.symbol for r in funds] == ["S2"]
