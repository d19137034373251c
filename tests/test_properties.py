"""Property checks: brute force agreement, scale invariance, order invariance."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from cohortlens import from_long
from tests.test_scale_paths import _brute_force

CODES = st.sampled_from(["1", "2", "4", "5", "NA"])


@st.composite
def cohort_data(draw):
    n_samples = draw(st.integers(4, 12))
    samples = [(f"s{i}", draw(CODES)) for i in range(n_samples)]
    n_cells = draw(st.integers(1, 40))
    cells = [(f"s{draw(st.integers(0, n_samples - 1))}", f"f{draw(st.integers(0, 5))}",
              float(draw(st.integers(-5, 9)))) for _ in range(n_cells)]
    fc = sorted({(f"f{draw(st.integers(0, 5))}", f"c{draw(st.integers(0, 3))}")
                 for _ in range(draw(st.integers(1, 10)))})
    return samples, cells, fc


def _t(spark, samples, cells, fc, partitions=2):
    a = from_long(
        spark.createDataFrame(samples, "sample_id string, code string").repartition(partitions),
        spark.createDataFrame(cells, "sample_id string, feature_id string, value double")
        .repartition(partitions),
        spark.createDataFrame(fc, "feature_id string, cluster string"))
    return {r["cluster"]: r["t"] for r in a.t_scores.collect()}


@settings(max_examples=12, deadline=None, derandomize=True, suppress_health_check=list(HealthCheck))
@given(data=cohort_data())
def test_matches_brute_force(spark, data):
    samples, cells, fc = data
    got = _t(spark, samples, cells, fc)
    expect = _brute_force(samples, cells, fc)
    assert set(got) == set(expect)
    for c, t in expect.items():
        if t is None:
            assert got[c] is None
        else:
            assert got[c] == pytest.approx(t, rel=1e-9, abs=1e-9)


@settings(max_examples=6, deadline=None, derandomize=True, suppress_health_check=list(HealthCheck))
@given(data=cohort_data(), scale=st.sampled_from([0.5, 3.0, 1000.0]))
def test_t_is_scale_invariant_and_order_free(spark, data, scale):
    samples, cells, fc = data
    base = _t(spark, samples, cells, fc, partitions=1)
    scaled = _t(spark, samples, [(s, f, v * scale) for s, f, v in cells], fc, partitions=3)
    shuffled = _t(spark, list(reversed(samples)), list(reversed(cells)), fc, partitions=5)
    assert set(base) == set(scaled) == set(shuffled)
    for c, t in base.items():
        for other in (scaled[c], shuffled[c]):
            if t is None:
                assert other is None
            else:
                assert other == pytest.approx(t, rel=1e-9, abs=1e-9)
