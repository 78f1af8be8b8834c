"""Property tests against brute force in exact Fraction arithmetic."""
import datetime as dt
import math
from collections import defaultdict
from fractions import Fraction

from hypothesis import HealthCheck, given, settings, strategies as st

from helpers import T0
from tidemark.operators.anomaly import rolling_baseline
from tidemark.operators.windows import window_metrics
from tidemark.schemas import TRADES

SETTINGS = settings(max_examples=12, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


def half_up(x: Fraction, places: int) -> float:
    scale = 10 ** places
    return math.floor(x * scale + Fraction(1, 2)) / scale


trade = st.tuples(st.sampled_from(["A", "B", "HOT"]),
                  st.integers(min_value=1, max_value=500_00),      # price in cents
                  st.integers(min_value=0, max_value=99),          # volume
                  st.integers(min_value=0, max_value=600))         # seconds after T0


@SETTINGS
@given(st.lists(trade, min_size=1, max_size=40))
def test_window_metrics_match_exact_brute_force(spark, rows):
    data = [(s, c / 100, v, T0 + dt.timedelta(seconds=t), "X0", str(i)) for i, (s, c, v, t) in enumerate(rows)]
    got = {(r.symbol, r.window_start): r for r in
           window_metrics(spark.createDataFrame(data, TRADES), "1 minute", "30 seconds").collect()}
    groups = defaultdict(list)
    for s, c, v, t in rows:
        base = (t // 30) * 30
        for k in range(2):
            groups[(s, T0 + dt.timedelta(seconds=base - 30 * k))].append((Fraction(c, 100), v))
    assert set(got) == set(groups)
    for key, g in groups.items():
        r = got[key]
        vol = sum(v for _, v in g)
        assert r.volume == vol and r.trade_count == len(g)
        # double sums: at an exact tie the last place may go either way
        if vol == 0:
            assert r.vwap is None
        else:
            assert abs(r.vwap - float(sum(p * v for p, v in g) / vol)) <= 5.01e-7
        hi, lo = max(p for p, _ in g), min(p for p, _ in g)
        mean = sum(p for p, _ in g) / len(g)
        assert abs(r.rsi - (50.0 if hi == lo else float((mean - lo) / (hi - lo) * 100))) <= 5.01e-3
        assert (r.high, r.low) == (float(hi), float(lo))
        var = sum((p - mean) ** 2 for p, _ in g) / len(g)
        assert abs(r.volatility - round(math.sqrt(var), 8)) <= 1.5e-8


metric = st.tuples(st.sampled_from(["A", "HOT"]),
                   st.integers(min_value=1, max_value=3000),            # window index (30 s steps)
                   st.one_of(st.none(), st.integers(min_value=1, max_value=10**7)),   # vwap in 1e-6
                   st.integers(min_value=0, max_value=10**6),           # volume
                   st.integers(min_value=0, max_value=10**8))           # volatility in 1e-8


@SETTINGS
@given(st.lists(metric, min_size=1, max_size=60, unique_by=lambda m: (m[0], m[1])),
       st.sampled_from([None, "10 minutes", "1 hour"]), st.sampled_from([None, "15 minutes"]))
def test_rolling_baseline_matches_brute_force(spark, rows, chunk, reset):
    data = [(s, T0 + dt.timedelta(seconds=30 * w - 30), T0 + dt.timedelta(seconds=30 * w),
             None if vw is None else vw / 1e6, v, t / 1e8) for (s, w, vw, v, t) in rows]
    m = spark.createDataFrame(data, "symbol string, window_start timestamp, window_end timestamp, "
                                    "vwap double, volume bigint, volatility double")
    got = {(r.symbol, r.window_end): r for r in rolling_baseline(m, chunk=chunk, reset_after=reset).collect()}
    by_sym = defaultdict(list)
    for s, w, vw, v, t in rows:
        by_sym[s].append((w, vw, v, t))
    for s, seq in by_sym.items():
        seq.sort()
        start = 0
        for i, (w, vw, v, t) in enumerate(seq):
            if reset and i > 0 and (w - seq[i - 1][0]) * 30 > 15 * 60:
                start = i
            hist = seq[max(start, i - 20):i]
            r = got[(s, T0 + dt.timedelta(seconds=30 * w))]
            assert r.hist_n == len(hist)
            prices = [Fraction(x[1], 10**6) for x in hist if x[1] is not None]
            assert r.price_n == len(prices)
            if prices:
                mean = sum(prices) / len(prices)
                std = math.sqrt(sum((p - mean) ** 2 for p in prices) / len(prices))
                assert abs(r.price_mean - float(mean)) <= 1e-12 * max(1.0, float(mean))
                assert abs(r.price_std - std) <= 1e-9 * max(1.0, std)
            else:
                assert r.price_mean is None and r.price_std is None
            if hist:
                assert abs(r.volume_mean - sum(x[2] for x in hist) / len(hist)) <= 1e-6
                vm = Fraction(sum(x[3] for x in hist), 10**8) / len(hist)
                assert abs(r.volatility_mean - float(vm)) <= 1e-13 * max(1.0, float(vm))
            else:
                assert r.volume_mean is None


alert = st.tuples(st.sampled_from(["A", "B"]), st.sampled_from(["PRICE_ANOMALY", "VOLUME_SPIKE"]),
                  st.integers(min_value=0, max_value=3600),   # window_start seconds
                  st.integers(min_value=0, max_value=99))     # z tag


@SETTINGS
@given(st.lists(alert, min_size=1, max_size=40))
def test_dedup_first_wins_matches_brute_force(spark, rows):
    from tidemark.operators.dedup import dedup_alerts
    from tidemark.schemas import ALERTS
    data = [(s, t, "INFO", float(z), 3.0, 1.0, 1.0, "m", T0 + dt.timedelta(seconds=w),
             T0 + dt.timedelta(seconds=w + 60), T0 + dt.timedelta(seconds=w + 60)) for s, t, w, z in rows]
    got = sorted((r.symbol, r.alert_type, r.window_start, r.z_score)
                 for r in dedup_alerts(spark.createDataFrame(data, ALERTS)).collect())
    epoch = dt.datetime(1970, 1, 1)
    best = {}
    for s, t, w, z in rows:
        ws = T0 + dt.timedelta(seconds=w)
        key = (s, t, int((ws - epoch).total_seconds() * 1000) // 300000)
        cand = (ws, float(z))
        if key not in best or cand < best[key]:
            best[key] = cand
    want = sorted((k[0], k[1], v[0], v[1]) for k, v in best.items())
    assert got == want


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["A", "B", "C"]), st.integers(min_value=1, max_value=500)),
                min_size=1, max_size=80, unique=True), st.integers(min_value=1, max_value=7))
def test_metric_history_last_n_matches_brute_force(spark, rows, n):
    from tidemark.operators.views import metric_history
    data = [(s, T0 + dt.timedelta(seconds=30 * w), float(w)) for s, w in rows]
    m = spark.createDataFrame(data, "symbol string, window_end timestamp, vwap double")
    got = sorted((r.symbol, r.vwap, r.rank) for r in metric_history(m, n=n).collect())
    want = []
    for s in {s for s, _ in rows}:
        ws = sorted((w for x, w in rows if x == s), reverse=True)[:n]
        want += [(s, float(w), i + 1) for i, w in enumerate(ws)]
    assert got == sorted(want)


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["A", "B", "C", "D"]), st.integers(min_value=1, max_value=200),
                          st.integers(min_value=1, max_value=500), st.integers(min_value=0, max_value=50)),
                min_size=1, max_size=40, unique_by=lambda r: (r[0], r[1])),
       st.integers(min_value=1, max_value=5))
def test_top_movers_match_brute_force(spark, rows, n):
    from tidemark.plans.serving import top_movers
    data = [(s, T0 + dt.timedelta(seconds=30 * w), float(lo + d), float(lo)) for s, w, lo, d in rows]
    m = spark.createDataFrame(data, "symbol string, window_end timestamp, high double, low double")
    got = [(r.symbol, r.price_change_pct) for r in top_movers(m, n=n).collect()]
    latest = {}
    for s, w, lo, d in rows:
        if s not in latest or w > latest[s][0]:
            latest[s] = (w, lo, d)
    scores = [(s, half_up(Fraction(d) / Fraction(lo) * 100, 4)) for s, (w, lo, d) in latest.items()]
    want = sorted(scores, key=lambda x: (-x[1], [-ord(c) for c in x[0]]))[:n]
    assert [s for s, _ in got] == [s for s, _ in want]
    for (_, a), (_, b) in zip(got, want):
        assert abs(a - b) <= 1e-4 + 1e-12
