"""Queries that do the job over the whole table."""

from firmlens.operators import tuning
from firmlens.operators.splitting import split
from firmlens.plans import QUERIES
from firmlens.plans.views import companies, model_table


def test_one_cut_looks_at_every_company(spark, sf_dir):
    """The exact cut over all companies, by hand."""
    rows = companies(spark, sf_dir).where("valuation is not null and total_funding is not null")
    rows = sorted((float(r.total_funding), float(r.valuation)) for r in rows.select("total_funding", "valuation").collect())
    ys, best = [y for _, y in rows], None
    left, total = 0.0, sum(ys)
    for i in range(1, len(rows)):
        left += ys[i - 1]
        if rows[i - 1][0] < rows[i][0]:
            gain = left**2 / i + (total - left) ** 2 / (len(rows) - i)
            if best is None or gain > best[0]:
                best = gain, round(left / i, 4), round((total - left) / (len(rows) - i), 4)
    found = QUERIES["tree_one_cut_all"].run(spark, sf_dir).first()
    assert abs(found.low - best[1]) < 1e-3 and abs(found.high - best[2]) < 1e-3


def test_companies_with_missing_features_are_predicted(spark, sf_dir):
    """Every company, or every test company, has a prediction; those of complete companies stay."""
    every = {r.company_id for r in model_table(spark, sf_dir).select("company_id").collect()}
    tested = {r.company_id for r in split(model_table(spark, sf_dir).select("company_id"), "company_id", 0.2)[1].collect()}
    for name, whole in (("naive_bayes_classes", every), ("knn_regression", tested), ("knn_classification", tested)):
        before, after = ({r.company_id: r.prediction for r in QUERIES[n].run(spark, sf_dir).collect()} for n in (name, f"{name}_all"))
        assert set(after) == whole and len(before) < len(after)
        assert all(v is not None for v in after.values())
        assert before == {k: after[k] for k in before}
        print(name, len(before), len(after))


def test_forest_search_draws_from_the_whole_space(spark, sf_dir, monkeypatch):
    asked = []

    def spied(train, build, space, budget, task, **how):
        asked.append((space, budget))
        return train, None

    monkeypatch.setattr(tuning, "random_search", spied)
    QUERIES["random_search_forest"].run(spark, sf_dir)
    assert asked == [tuning.SPACES["forest_class"]] and asked[0][0]["n"] == ("int", 1, 1999, 1)
