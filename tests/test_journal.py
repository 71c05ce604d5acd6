"""Runs that go on where they stopped, and after a change."""

import pytest

import strata.plans.pipeline as pipeline
from conftest import GOLDEN_CONFIG, rows
from strata.config import Config
from strata.plans.pipeline import Layers, run_pipeline

CFG = Config.from_dict(GOLDEN_CONFIG)


class Killed(RuntimeError):
    pass


def _written(monkeypatch):
    """Tables written from here on, by layer and name."""
    seen = []
    real = pipeline.write_observed

    def observed(df, path, **k):
        seen.append("/".join(path.split("/")[-2:]))
        return real(df, path, **k)

    monkeypatch.setattr(pipeline, "write_observed", observed)
    return seen


def _audit(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_a_run_killed_after_silver_goes_on_at_gold(spark, raw_dir, tmp_path, monkeypatch):
    full = _audit(run_pipeline(spark, raw_dir, Layers.under(str(tmp_path / "full")), CFG))
    layers = Layers.under(str(tmp_path / "lake"))
    with monkeypatch.context() as m:
        m.setattr(pipeline, "gold_step", lambda *a, **k: (_ for _ in ()).throw(Killed()))
        with pytest.raises(Killed):
            run_pipeline(spark, raw_dir, layers, CFG)
    seen = _written(monkeypatch)
    assert _audit(run_pipeline(spark, raw_dir, layers, CFG, resume=True)) == full
    assert seen and not [s for s in seen if s.startswith("silver/")]
    seen.clear()
    assert _audit(run_pipeline(spark, raw_dir, layers, CFG, resume=True)) == full
    assert seen == []  # nothing changed, nothing is made
    assert _audit(run_pipeline(spark, raw_dir, layers, CFG)) == full and len(seen) == 2 + 2 + 7


def test_a_unit_killed_half_way_is_made_again(spark, raw_dir, tmp_path, monkeypatch):
    layers = Layers.under(str(tmp_path / "lake"))
    full = _audit(run_pipeline(spark, raw_dir, layers, CFG))
    real = pipeline.write_observed
    with monkeypatch.context() as m:

        def half(df, path, **k):
            out = real(df, path, **k)
            if path.endswith("silver/orders"):
                raise Killed()
            return out

        m.setattr(pipeline, "write_observed", half)
        with pytest.raises(Killed):
            run_pipeline(spark, raw_dir, layers, CFG)
    seen = _written(monkeypatch)
    assert _audit(run_pipeline(spark, raw_dir, layers, CFG, resume=True)) == full
    assert "silver/orders" in seen and "silver/website_sessions" not in seen


def test_a_changed_table_is_the_only_one_made_again(spark, raw_dir, tmp_path, monkeypatch):
    layers = Layers.under(str(tmp_path / "lake"))
    run_pipeline(spark, raw_dir, layers, CFG)
    path = f"{raw_dir}/orders.csv"
    text = open(path).read() + "6,2012-03-21 10:00:00,3,99.5\n"
    open(path, "w").write(text)
    seen = _written(monkeypatch)
    resumed = _audit(run_pipeline(spark, raw_dir, layers, CFG, resume=True))
    assert [s for s in seen if s.startswith("silver/")] == ["silver/orders"]
    assert len([s for s in seen if s.startswith(("gold/", "report/"))]) == 9
    fresh = Layers.under(str(tmp_path / "fresh"))
    assert resumed == _audit(run_pipeline(spark, raw_dir, fresh, CFG))
    for name in ("gold/gold_monthly_trend", "gold/gold_channel_performance", "report/trend_series", "silver/orders"):
        layer, table = name.split("/")
        a, b = (sorted(rows(spark.read.parquet(f"{getattr(x, layer)}/{table}")), key=str) for x in (layers, fresh))
        assert a == b
    # a setting is an input too
    seen.clear()
    other = Config.from_dict({**GOLDEN_CONFIG, "defaults": {"drop_duplicates": False}})
    run_pipeline(spark, raw_dir, layers, other, resume=True)
    assert {"silver/orders", "silver/website_sessions"} <= set(seen)


def test_a_table_that_is_gone_is_made_again(spark, raw_dir, tmp_path, monkeypatch):
    import os

    layers = Layers.under(str(tmp_path / "lake"))
    full = _audit(run_pipeline(spark, raw_dir, layers, CFG))
    os.rename(f"{layers.gold}/gold_monthly_trend", f"{tmp_path}/elsewhere")
    seen = _written(monkeypatch)
    assert _audit(run_pipeline(spark, raw_dir, layers, CFG, resume=True)) == full
    assert seen == ["gold/gold_monthly_trend"]
