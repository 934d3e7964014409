import pytest

from panelcast.spec import PanelSpec, Span, interval_suffix


def test_spans():
    assert Span.parse("1h").seconds == 3600
    assert Span.parse("2 weeks").seconds == 14 * 86400
    assert Span.parse("3 months").months == 3
    assert Span.parse("1y").months == 12
    assert interval_suffix("3 months") == "3_months"
    with pytest.raises(ValueError):
        Span.parse("soon")
    with pytest.raises(ValueError):
        Span.parse("3 fortnights")


def test_month_lengths():
    assert Span.parse("1 month").day_lengths == (28, 29, 30, 31)
    assert Span.parse("3 months").day_lengths == (89, 90, 91, 92)
    assert Span.parse("12 months").day_lengths == (365, 366)


def test_panel_spec():
    spec = PanelSpec("v", "t", ["a", "b"], step="15 minutes")
    assert spec.keys == ("a", "b") and spec.step_seconds == 900
    assert spec.block_seconds % 900 == 0
    with pytest.raises(ValueError):
        PanelSpec("v", "t", ("a",), step="1 month")
    with pytest.raises(ValueError):
        PanelSpec("v", "t", ())
