import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tesselon.operators import training


def plain(x, y, t, batch):
    """The same training in plain NumPy, with both classes' logits."""
    x = np.concatenate([x, np.ones((len(x), 1))], 1)
    w = np.array([len(y) / (2 * (y == c).sum()) for c in (0, 1)])[y]
    head, m, v, n = np.zeros((2, x.shape[1])), 0, 0, 0
    for epoch in range(t.epochs):
        rate = t.rate * (1 + math.cos(math.pi * epoch / t.epochs)) / 2
        for i in range(t.batches):
            at = np.flatnonzero(batch % t.batches == i)
            z = np.exp(x[at] @ head.T)
            p = z / z.sum(1, keepdims=True)
            g = (w[at, None] * (p - np.eye(2)[y[at]])).T @ x[at] / w[at].sum()
            n += 1
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
            head = head - rate * t.decay * head - rate * (m / (1 - 0.9**n)) / (np.sqrt(v / (1 - 0.999**n)) + t.eps)
    return head


@pytest.fixture(scope="module")
def data(spark):
    r = np.random.default_rng(5)
    y = (r.random(300) < 0.3).astype(int)
    x = r.normal(size=(300, 4)) + y[:, None] * np.array([1.5, -1, 0, 0])
    rows = [(i, x[i].tolist(), int(y[i])) for i in range(300)]
    return x, y, spark.createDataFrame([*rows, (300, None, 1), (301, [9.0] * 4, None), (302, [9.0] * 4, 7)], "id long, f array<double>, y int").repartition(5)


def test_steps_are_those_of_plain_numpy(data):
    x, y, rows = data
    for t in (training.Training(epochs=4, rate=0.1, decay=0.05), training.Training(epochs=3, rate=0.1, batches=3)):
        head, history = training.fit_head(rows, "f", "y", t=t, batch="id")
        assert np.allclose(head, plain(x, y, t, np.arange(300)), atol=1e-10)
        assert [h["epoch"] for h in history] == list(range(1, t.epochs + 1)) and history[-1]["lr"] == pytest.approx(0, abs=1e-15)
        assert history[-1]["train_loss"] < math.log(2)


def test_validation_stops_early_and_keeps_the_best(data):
    x, y, rows = data
    t = training.Training(epochs=12, rate=0.2, patience=2)
    head, history = training.fit_head(rows, "f", "y", rows, t)
    best = max(h["auc"] for h in history if h["best"])
    assert best > 0.85 and len(history) < 12 and not any(h["best"] for h in history[-2:])
    scored = training.predict(rows, "f", head, ["id"])
    assert scored.count() == 303 and scored.where("id = 300").first()["prob"] is None
    assert scored.where("id < 300").where(F.col("prob").between(0, 1)).count() == 300


def test_nothing_to_learn_from(spark, data):
    with pytest.raises(ValueError):
        training.fit_head(data[2].where("y = 7"), "f", "y")
    with pytest.raises(ValueError):
        training.fit_head(data[2], "f", "y", t=training.Training(batches=2))
    one = spark.createDataFrame([(1, [1.0], 1)], "id long, f array<double>, y int")
    _, history = training.fit_head(one, "f", "y", one, training.Training(epochs=5, patience=3))
    assert [h["auc"] for h in history] == [None] * 3  # one class has no AUC, so nothing gains
