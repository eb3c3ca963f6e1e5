"""Composite reports build their parts once."""

from kontora.plans import monitoring


def test_health_and_alerts_are_built_once(bank, monkeypatch):
    calls = {"feature_store_health": 0, "data_quality_alerts": 0, "feature_drift_monitor": 0}
    for name in calls:
        real = getattr(monitoring, name)

        def counting(*a, _name=name, _real=real, **k):
            calls[_name] += 1
            return _real(*a, **k)

        monkeypatch.setattr(monitoring, name, counting)
    row = monitoring.monitor_system_health(bank).collect()
    assert len(row) == 1 and calls == {"feature_store_health": 1, "data_quality_alerts": 1, "feature_drift_monitor": 1}
    score = monitoring.system_health_score(bank).collect()[0]
    assert row[0].health_score == score.overall_health_score
