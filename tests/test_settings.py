import pytest

from conftest import SF001
from txnlab.operators import model as M
from txnlab.plans.inputs import model_input, part
from txnlab.session import materialize

SETTINGS = [{"regParam": r, "elasticNetParam": e, "maxIter": i, "tol": 1e-6}
            for r in (0.01, 0.1) for e in (0.0, 0.5) for i in (2, 200, 500)]


@pytest.fixture(scope="module")
def sets(spark):
    mi = materialize(model_input(spark, SF001), "settings-input")
    return M.weighted(part(mi, "train")), part(mi, "validation")


def one(train, val, p):
    lr = M.lr_stage(reg=p["regParam"], max_iter=p["maxIter"], elastic=p["elasticNetParam"], tol=p["tol"])
    return M.fit_and_evaluate(train, val, M.feature_stages() + [lr]).first()


def test_all_settings_at_once_are_as_one_by_one(sets):
    got = M.fit_and_evaluate_all(*sets, SETTINGS)
    for p, row in zip(SETTINGS, got):
        assert row == pytest.approx(tuple(one(*sets, p)), abs=2e-6), p


def test_settings_that_differ_in_unused_steps_share_a_fit(sets, monkeypatch):
    fitted, real = [], M.lr_stage
    monkeypatch.setattr(M, "lr_stage", lambda **kw: fitted.append(kw["max_iter"]) or real(**kw))
    M.fit_and_evaluate_all(*sets, SETTINGS)
    # the fits of 2 steps don't end by their tolerance, those of 200 do
    assert sorted(fitted) == [2] * 4 + [200] * 4


def test_no_validation_rows(sets):
    train, val = sets
    assert M.fit_and_evaluate_all(train, val.limit(0), SETTINGS[:2]) == [tuple(one(train, val.limit(0), SETTINGS[0]))] * 2
