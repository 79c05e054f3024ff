from __future__ import annotations

import math

import numpy as np
import pytest

from gaugeloom.operators import clean


def quartile(values, numerator):
    ordered = np.sort(values)
    place = numerator / 4 * len(ordered)
    low, high = max(0, math.floor(place)), min(len(ordered) - 1, math.ceil(place))
    return (ordered[low] + ordered[high]) / 2


def kept(values, limit=62_100):
    q25, q75 = quartile(values, 1), quartile(values, 3)
    reach = 1.5 * (q75 - q25)
    return [v for v in values if q25 - reach <= v <= q75 + reach and v <= limit]


def test_known_outlier(spark, series):
    rows = clean.remove_outliers(series([1, 2, 3, 4, 5, 6, 7, 8, 9, 1000]))
    assert [r.value for r in rows.orderBy("seq").collect()] == list(range(1, 10))


@pytest.mark.parametrize("slices", [None, 7])
def test_hot_series_among_small_ones(spark, series, slices):
    """One series holds most rows and is cut into several slices."""
    rng = np.random.default_rng(3)
    values = {
        "hot": np.round(rng.lognormal(3, 1, 5000), 2),
        "same": np.full(700, 4.0),
        "limit": rng.uniform(62_000, 62_200, 40),
        "one": np.array([5.0]),
        "two": np.array([5.0, -7.0]),
        "three": np.array([1.0, 2.0, 30.0]),
    }
    rows = None
    for name, data in values.items():
        part = series(data, sn=name)
        rows = part if rows is None else rows.unionByName(part)
    quantiles = {
        r.sn: (r.n, r.q25, r.q50, r.q75)
        for r in clean.legacy_quantiles(rows, slices=slices).collect()
    }
    assert quantiles == {
        name: (len(data), *(quartile(data, m) for m in (1, 2, 3)))
        for name, data in values.items()
    }
    left = {}
    for row in clean.remove_outliers(rows, slices=slices).orderBy("seq").collect():
        left.setdefault(row.sn, []).append(row.value)
    assert left == {name: kept(data) for name, data in values.items() if kept(data)}
    dropped = {
        r.sn: r.n_dropped for r in clean.outlier_bounds(rows, slices=slices).collect()
    }
    assert dropped == {name: len(data) - len(kept(data)) for name, data in values.items()}


def test_missing_values_vanish(spark, series):
    rows = series([1.0, None, float("nan"), 2.0])
    assert sorted(r.value for r in clean.remove_outliers(rows).collect()) == [1.0, 2.0]
