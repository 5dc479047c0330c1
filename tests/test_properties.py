"""Property tests: the chunked look-ahead equals the per-vehicle window on random series."""
import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from voltaic.operators.features import ml_features
from voltaic.operators.windows import window_pivot
from voltaic.sources.files import load_folder
from voltaic.sources.readings import READING_SCHEMA

T0 = dt.datetime(2024, 5, 1)

series = st.lists(
    st.tuples(st.sampled_from(["A", "B", "C"]),
              st.integers(min_value=0, max_value=400),          # window index
              st.sampled_from([300.0, 310.0, 330.0, 350.5, 371.0, 400.0, 499.0, 250.0]),
              st.sampled_from([0.0, 20.0, 55.5, 80.0])),
    min_size=0, max_size=120)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=series, lookahead=st.integers(min_value=1, max_value=7),
       chunk=st.sampled_from(["10 seconds", "30 seconds", "5 minutes", "1 hour"]))
def test_chunked_lookahead_matches_plain(spark, data, lookahead, chunk):
    rows = []
    for v, k, volt, soc in data:
        t = T0 + dt.timedelta(seconds=10 * k)
        rows += [(v, t, 1200, volt), (v, t, 900, soc)]
    win = window_pivot(spark.createDataFrame(rows, READING_SCHEMA), with_end=False)
    plain = ml_features(win, lookahead=lookahead, chunk=None).collect()
    chunked = ml_features(win, lookahead=lookahead, chunk=chunk).collect()
    key = lambda r: (r.vehicle_id, r.time)
    assert sorted(plain, key=key) == sorted(chunked, key=key)


def test_load_missing_folder_is_empty(spark, tmp_path):
    df = load_folder(spark, str(tmp_path / "nothing-here"))
    assert df.count() == 0


values = st.lists(st.one_of(st.none(), st.sampled_from([0.0, 0.0, 0.0, 1.5, -2.0]), st.floats(-50, 50, allow_nan=False)),
                  min_size=1, max_size=400)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(vals=values, fracs=st.lists(st.floats(0.0, 1.0), min_size=1, max_size=4))
def test_exact_ranks_match_a_sort(spark, vals, fracs):
    """select_ranks / exact_quantiles against a brute-force sort, with NULLs, a
    hot value and brackets small enough to force the narrowing rounds."""
    from voltaic.operators.ranks import disc_rank, exact_quantiles, select_ranks

    df = spark.createDataFrame([(v, i) for i, v in enumerate(vals)], "x double, i long")
    ordered = sorted((v, i) for i, v in enumerate(vals) if v is not None)
    n = len(ordered)
    ks = sorted({max(0, min(n + 1, int(f * n))) for f in fracs} | {1, n})
    got = select_ranks(df, [(("x", "i"), k) for k in ks], accuracy=20, max_bracket=16)
    assert got == [ordered[k - 1] if 0 < k <= n else None for k in ks]
    q = exact_quantiles(df, ["x"], [round(f, 2) for f in fracs], accuracy=20, max_bracket=16)
    xs = [v for v, _ in ordered]
    for f in fracs:
        p = round(f, 2)
        assert q[("x", p)] == (xs[disc_rank(p, n) - 1] if n else None)
