"""Thinned curves against the full curve."""

import numpy as np
import pytest

from monthglass.operators import curves as cv

rng = np.random.default_rng(31)


def full(y, p):
    out = []
    for t in sorted(set(p), reverse=True):
        hit = p >= t
        out.append((t, int(y[hit].sum()), int((1 - y[hit]).sum())))
    return out


def corners(points):
    """Points (t, tp, fp) that no straight line between two others, or the origin and one, passes or touches from above."""
    all_points = [(None, 0, 0), *points]
    keep = []
    for i, (t, tp, fp) in enumerate(all_points):
        if i == 0:
            continue
        under = any(
            (b[2] - a[2]) * (tp - a[1]) - (b[1] - a[1]) * (fp - a[2]) <= 0
            for a in all_points[:i]
            for b in all_points[i + 1 :]
        )
        if not under:
            keep.append(t)
    return keep


def sample(kind, n):
    p = np.round(rng.random(n), {"ties": 1, "some": 2}.get(kind, 12))
    if kind == "perfect":
        return (p > 0.6).astype(int), p
    if kind == "reversed":
        return (p < 0.4).astype(int), p
    return (rng.random(n) < 0.1 + 0.7 * p**2).astype(int), p


@pytest.mark.parametrize("cuts", [[], [0.5], [k / 40 for k in range(1, 40)], None])
def test_hull_and_area(spark, cuts):
    kinds = {k: sample(k, n) for k, n in (("ties", 300), ("some", 500), ("fine", 160), ("perfect", 120), ("reversed", 120), ("big", 4000))}
    rows = [(k, int(a), float(b)) for k, (y, p) in kinds.items() for a, b in zip(y, p)]
    rows += [("one", 1, 0.5), ("one", 1, 0.7), ("ties", 1, None), (None, 1, 0.5), ("nan", 0, float("nan"))]
    df = spark.createDataFrame(rows, "k string, y int, p double").repartition(4)
    points = cv.curve_points(df, "y", "p", ["k"], splits=cuts)
    got = {}
    for r in points.collect():
        got.setdefault(r.k, []).append(r)
    assert set(got) == {*kinds, "one"}
    area = {r.k: r.area for r in cv.curve_area(points, ["k"]).collect()}
    for k, (y, p) in kinds.items():
        whole = full(y, p)
        kept = sorted(got[k], key=lambda r: -r.threshold)
        assert set((r.threshold, r.tp, r.fp) for r in kept) <= set(whole) and kept[-1].tpr == kept[-1].fpr == 1
        if k != "big":
            assert [r.threshold for r in kept if r.corner] == corners(whole)
        assert len(kept) <= 205
        x = np.array([0, *[fp for *_, fp in whole]]) / max(1, (1 - y).sum())
        z = np.array([0, *[tp for _, tp, _ in whole]]) / max(1, y.sum())
        assert area[k] == pytest.approx(np.trapezoid(z, x), abs=1.5e-3)
        assert all(r.precision == pytest.approx(r.tp / (r.tp + r.fp)) for r in kept)
    assert [(r.fpr, r.corner) for r in got["one"]] == [(0.0, False), (0.0, True)] or len(got["one"]) == 2


def test_without_groups_and_rows(spark):
    y, p = sample("some", 200)
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, p)], "y int, p double")
    got = cv.curve_points(df, "y", "p").collect()
    assert [r.threshold for r in sorted(got, key=lambda r: -r.threshold) if r.corner] == corners(full(y, p))
    assert cv.curve_points(df.limit(0), "y", "p").count() == 0
