import numpy as np
import pytest

from wickwork.operators.vif import METHODS, vif


def frame(spark, x):
    x = np.asarray(x, float)
    return spark.createDataFrame([tuple(map(float, r)) for r in x], ", ".join(f"x{i} double" for i in range(x.shape[1])))


def found(df, *a, **k):
    return {r["feature"]: r["VIF"] for r in vif(df, *a, **k).collect()}


def by_regression(x):
    out = []
    for i in range(x.shape[1]):
        a = np.column_stack([np.delete(x, i, 1), np.ones(len(x))])
        left = x[:, i] - a @ np.linalg.lstsq(a, x[:, i], rcond=None)[0]
        out.append(((x[:, i] - x[:, i].mean()) ** 2).sum() / (left**2).sum())
    return out


@pytest.fixture()
def normal():
    return np.random.default_rng(42).normal(size=(100, 5)) @ np.random.default_rng(1).normal(size=(5, 5))


@pytest.mark.parametrize("method", METHODS)
def test_against_regression(spark, normal, method):
    got = found(frame(spark, normal), method)
    assert list(got) == [f"x{i}" for i in range(5)]
    assert list(got.values()) == pytest.approx(by_regression(normal), rel=1e-6)


def test_singular(spark):
    pair = np.column_stack([[1, 2, 3, 4, 5]] * 2)
    assert all(v == np.inf for v in found(frame(spark, pair)).values())
    assert all(v == np.inf for v in found(frame(spark, pair), "parallel").values())
    assert all(1 <= v < np.inf for v in found(frame(spark, pair), "streaming").values())


def test_constant(spark):
    r = np.random.default_rng(3)
    x = np.column_stack([np.full(50, 0.1), r.normal(size=50), r.normal(size=50)])
    df = frame(spark, x)
    assert all(v == np.inf for v in found(df).values())
    p = found(df, "parallel")
    assert p["x0"] == np.inf and p["x1"] < 2 and p["x2"] < 2
    assert found(df, "streaming")["x0"] == 1.0


def test_near_singular_and_threshold(spark):
    r = np.random.default_rng(4)
    a, b = r.normal(size=80), r.normal(size=80)
    df = frame(spark, np.column_stack([a, b, a + b + 1e-4 * r.normal(size=80)]))
    assert max(found(df).values()) > 100
    close = frame(spark, np.column_stack([a, a + 0.1 * b, r.normal(size=80)]))
    assert set(found(close, threshold=10)) == {"x0", "x1"}


def test_missing_values(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, None), (3.0, 1.0), (4.0, 5.0), (float("nan"), 1.0)], "a double, b double")
    assert len(found(df)) == 2
    with pytest.raises(ValueError, match="missing"):
        vif(df, drop_na=False)


def test_errors(spark):
    df = spark.createDataFrame([(1.0, 2.0, "x"), (2.0, 3.0, "y"), (4.0, 1.0, "z")], "a double, b double, c string")
    with pytest.warns(UserWarning, match="c"):
        assert len(found(df)) == 2
    with pytest.raises(ValueError, match="features"):
        vif(df.select("a"))
    with pytest.raises(ValueError, match="rows"):
        vif(df.select("a", "b").limit(1))
    with pytest.raises(ValueError, match="method"):
        vif(df, "nope")


def test_jobs_and_chunks_change_nothing(spark, normal):
    df = frame(spark, normal)
    one = found(df, "parallel")
    assert found(df, "parallel", n_jobs=2, chunk_size=7) == pytest.approx(one) and found(df, "streaming", chunk_size=1) == pytest.approx(found(df, "streaming"))
    for bad in ({"n_jobs": 0}, {"chunk_size": 0}):
        with pytest.raises(ValueError, match="chunk_size"):
            vif(df, **bad)
