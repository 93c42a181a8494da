import statistics

import pytest

from chainlytics.operators.sigma import sigma_histogram
from conftest import rows


def histogram(spark, values):
    totals = spark.createDataFrame([(v,) for v in values], "total long")
    return rows(sigma_histogram(totals, "total", "n"), "as is")


def test_one_bucket_has_no_deviation(spark):
    assert histogram(spark, [42]) == [("-1σ [0.00 - 42.00]", 1)]


def test_equal_buckets_fall_to_the_lowest_step(spark):
    # without deviation all steps shrink to [m, m], and the lowest one wins
    assert histogram(spark, [7, 7, 7]) == [("-3σ [0.00 - 7.00]", 3)]


def test_no_buckets(spark):
    assert histogram(spark, []) == []


def test_bounds_belong_to_the_lower_band(spark):
    # mean 10, sample deviation 10: 0 is m-d, 10 is m, 20 is m+d
    assert histogram(spark, [0, 10, 20]) == [
        ("-2σ [0.00 - 0.00]", 1),
        ("-1σ [0.00 - 10.00]", 1),
        ("+1σ [10.00 - 20.00]", 1),
    ]


def test_far_totals_and_order(spark):
    values = [100] * 60 + [101] * 60 + [0, 400]
    found = histogram(spark, values)
    assert found[0] == ("< 4σ", 1)
    assert found[-1] == ("> 4σ", 1)
    assert sum(n for _, n in found) == len(values)


def test_missing_totals_match_nothing_and_come_last(spark):
    found = histogram(spark, [5, 6, 7, None])
    assert found[-1] == (None, 1)


def test_negative_totals_match_nothing_where_the_floor_is_zero(spark):
    found = dict(histogram(spark, [-5, 5, 5, 5]))
    # mean 2.5, deviation 5: -5 lies between m-2d and m-d, but steps below the mean start at 0
    assert found[None] == 1


@pytest.mark.parametrize("seed", range(4))
def test_against_a_plain_loop(spark, seed):
    import random

    random.seed(seed)
    values = [int(random.gauss(1000, 150)) for _ in range(200)] + [random.choice([0, 3000])]
    m, d = statistics.mean(values), statistics.stdev(values)

    def name(v):
        if v < m - 3 * d:
            return "< 4σ"
        for k in range(-3, 3):
            low = max(0, m + k * d) if k < 0 else m + k * d
            if low <= v <= m + (k + 1) * d:
                return f"{k if k < 0 else k + 1:+d}σ"
        return "> 4σ"

    want = {}
    for v in values:
        want[name(v)] = want.get(name(v), 0) + 1
    got = {label.split(" [")[0]: n for label, n in histogram(spark, values)}
    assert got == want
