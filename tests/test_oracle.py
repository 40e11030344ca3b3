"""Every query that SQL can express, against DuckDB on the same files."""

from functools import partial

import pytest
from compare import connect, differences

from claimrisk.oracles import ORACLES
from claimrisk.plans import ml
from claimrisk.queries import QUERIES


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


@pytest.fixture(autouse=True)
def few_rounds(monkeypatch):
    """What SQL says of models holds after any number of rounds; the queries themselves fit 300."""
    monkeypatch.setattr(ml, "LEARNERS", {name: partial(fit, rounds=30) for name, fit in ml.LEARNERS.items()})


def test_only_model_queries_lack_sql():
    assert set(QUERIES) - set(ORACLES) == {
        "ml_scores", "ml_importance", "ml_shap", "ml_shap_importance", "ml_rationale", "ml_evaluate",
        "newton_scores", "newton_importance", "newton_shap",
        "model_serving_provider_risk", "model_serve_provider", "model_serve_cohort", "model_serve_summary",
        "model_state_risk"}
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_sql(name, spark, sf_dir, duck):
    assert differences(QUERIES[name](spark, sf_dir), duck, ORACLES[name]) == ""
