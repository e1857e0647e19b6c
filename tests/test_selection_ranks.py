from firmlens.operators import selection
from firmlens.plans import QUERIES


def test_selected_columns_are_ranked(spark, sf_dir, monkeypatch):
    """Every kept column has its place by the size of its correlation."""
    monkeypatch.setitem(selection.CORR_THRESHOLDS, "regression", 0.01)
    rows = QUERIES["select_by_corr"].run(spark, sf_dir).collect()
    assert len(rows) > 1 and [r["rank"] for r in rows] == list(range(1, len(rows) + 1))
