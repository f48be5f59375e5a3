import pytest

from meterlake.operators.outliers import (
    flag_outliers,
    flag_outside_band,
    score_against,
    service_profile,
)

LAYOUT = "service string, cost_usd double, cost_usd_increment double"


@pytest.fixture
def costs(spark):
    def build(**services):
        rows = [(s, x, x) for s, xs in services.items() for x in xs]
        return spark.createDataFrame(rows, LAYOUT)

    return build


def flags(df):
    return {r.cost_usd: r for r in df.collect()}


@pytest.mark.parametrize("exact", [True, False])
def test_outlier_and_negative_are_flagged(costs, exact):
    out = flags(flag_outliers(costs(compute=[1.0] * 100 + [1000.0, -5.0]), exact=exact))
    assert out[1000.0].cost_anomaly_flag and out[-5.0].cost_anomaly_flag
    assert not out[1.0].cost_anomaly_flag
    # every deviation but two is zero, so the robust score has nothing to go by
    assert out[1000.0].score_mad is None and out[1000.0].flag_mad is False
    assert out[1000.0].flag_zscore and out[1000.0].flag_ptiles


def test_hand_computed_scores(costs):
    values = [10.0, 12.0, 14.0, 16.0, 100.0]
    profile = service_profile(costs(db=values)).first()
    assert profile.mean_cost == pytest.approx(30.4)
    assert profile.std_cost == pytest.approx(38.971785, abs=1e-6)
    assert (profile.p01, profile.p50, profile.p99, profile.mad) == (10, 14, 100, 2)
    out = flags(flag_outliers(costs(db=values)))
    assert out[100.0].score_zscore == pytest.approx(69.6 / 38.971785, abs=1e-6)
    assert out[100.0].score_mad == pytest.approx(0.6745 * 86 / 2)
    assert out[100.0].score_ptiles == 0.0
    assert out[100.0].flag_mad and not out[100.0].cost_anomaly_flag  # one vote only


def test_negative_limit_is_strict_and_adjustable(costs):
    df = costs(db=[-0.01, -0.011, 5.0, 6.0, 7.0])
    out = flags(flag_outliers(df))
    assert not out[-0.01].flag_negative and out[-0.01].score_negative is None
    assert out[-0.011].flag_negative and out[-0.011].score_negative == 0.011
    assert not flags(flag_outliers(df, negative_below=-1.0))[-0.011].flag_negative


def test_services_without_spread(costs):
    out = flag_outliers(costs(one=[3.0], flat=[2.0] * 5)).collect()
    assert all(r.score_zscore is None and r.score_mad is None for r in out)
    assert not any(r.cost_anomaly_flag for r in out)


def test_null_cost_and_null_service(spark):
    rows = [("db", None, None), (None, 9.0, 9.0), (None, -1.0, -1.0), ("db", 1.0, 1.0)]
    out = flag_outliers(spark.createDataFrame(rows, LAYOUT)).collect()
    assert len(out) == 4
    verdicts = {(r.service, r.cost_usd): r.cost_anomaly_flag for r in out}
    assert verdicts == {
        ("db", None): False, (None, 9.0): False, (None, -1.0): True, ("db", 1.0): False,
    }


def test_services_are_profiled_apart(costs):
    df = costs(cheap=[1.0 + i / 100 for i in range(200)] + [50.0], dear=[50.0] * 200)
    out = flag_outliers(df).where("cost_anomaly_flag").collect()
    assert [(r.service, r.cost_usd) for r in out] == [("cheap", 50.0)]


def test_narrowing_gives_the_same_verdicts(costs):
    df = costs(
        a=[float(i * i % 977) for i in range(3000)], b=[0.0] * 2000 + [900.0, -3.0]
    )
    direct, narrowed = flag_outliers(df), flag_outliers(df, small_rows=10)
    assert direct.exceptAll(narrowed).isEmpty()


def test_stored_profile_scores_new_rows(costs):
    profile = service_profile(costs(db=[float(i % 10) for i in range(100)]))
    out = flags(score_against(costs(db=[4.0, 500.0]), profile))
    assert out[500.0].cost_anomaly_flag and not out[4.0].cost_anomaly_flag


def test_union_variant(spark, costs):
    out = flags(flag_outside_band(costs(db=[float(i) for i in range(1, 201)] + [-2.0])))
    assert out[-2.0].cost_anomaly_flag and out[200.0].cost_anomaly_flag
    assert not out[100.0].cost_anomaly_flag
    unknown = spark.createDataFrame([("db", None, None)], LAYOUT)
    assert flag_outside_band(unknown).first().cost_anomaly_flag is None
