"""Training a classifier's last layer on stored features: AdamW, a cosine schedule, weighted cross entropy, early stop.

A step is one pass over the rows of its batch: each partition returns the sum of its gradients, a row of 2 d + 2 numbers,
and these are summed by position, so the driver sees the layer's size whatever the number of rows. Networks under the
layer are a plug-in's; the features are theirs.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.shipping import map_pandas
from . import metrics


@dataclass(frozen=True)
class Training:
    """The defaults of the training that is matched."""

    epochs: int = 10
    rate: float = 3e-4
    decay: float = 1e-4
    betas: tuple[float, float] = (0.9, 0.999)
    eps: float = 1e-8
    batches: int = 1
    min_gain: float = 1e-4
    patience: int = 3


def rate_at(t: Training, epoch: int) -> float:
    """The learning rate after so many epochs."""
    return t.rate * (1 + math.cos(math.pi * epoch / t.epochs)) / 2


class AdamW:
    """Moments of the gradient with bias correction, and decay apart from them."""

    def __init__(self, t: Training, shape):
        self.t, self.m, self.v, self.n = t, np.zeros(shape), np.zeros(shape), 0

    def step(self, weights, gradient, rate: float):
        self.n += 1
        a, b = self.t.betas
        self.m, self.v = a * self.m + (1 - a) * gradient, b * self.v + (1 - b) * gradient**2
        return weights * (1 - rate * self.t.decay) - rate * (self.m / (1 - a**self.n)) / (np.sqrt(self.v / (1 - b**self.n)) + self.t.eps)


def _logits(vectors, head):
    x = np.stack([np.asarray(v, np.float64) for v in vectors])
    return np.concatenate([x, np.ones((len(x), 1))], 1), np.concatenate([x, np.ones((len(x), 1))], 1) @ head.T


def _pass(rows: DataFrame, feature: str, label: str, head, weights: dict):
    """(gradient of the weighted loss, loss) over rows; rows without a feature or a label of 0 or 1 don't count."""
    size = head.size

    def run(frames):
        import pandas as pd

        total, seen = np.zeros(size + 2), False
        for frame in frames:
            if not len(frame):
                continue
            x, z = _logits(frame[feature], head)
            y = frame[label].to_numpy().astype(int)
            top = z.max(1, keepdims=True)
            log_p = z - top - np.log(np.exp(z - top).sum(1, keepdims=True))
            w = np.array([weights[0], weights[1]])[y]
            off = np.exp(log_p) - np.eye(2)[y]
            total += np.concatenate([((w[:, None] * off).T @ x).ravel(), [-(w * log_p[np.arange(len(y)), y]).sum(), w.sum()]])
            seen = True
        if seen:
            yield pd.DataFrame({"g": [total.tolist()]})

    parts = map_pandas(_usable(rows, feature, label), run, "g array<double>")
    got = parts.select(F.posexplode("g").alias("pos", "v")).groupBy("pos").agg(F.sum("v").alias("v")).collect()  # the layer's size
    total = np.zeros(size + 2)
    for r in got:
        total[r["pos"]] = r["v"]
    n = max(total[-1], 1e-300)
    return total[:size].reshape(head.shape) / n, float(total[-2] / n)


def _usable(rows: DataFrame, feature: str, label: str) -> DataFrame:
    return rows.where(F.col(feature).isNotNull() & F.col(label).isin(0, 1)).select(F.col(feature).cast("array<double>").alias(feature), F.col(label).cast("int").alias(label))


def predict(rows: DataFrame, feature: str, head, keep: list[str], out: str = "prob") -> DataFrame:
    """The columns `keep` and the probability of class 1; a row without a feature has none."""
    from pyspark.sql import types as T

    def run(frames):
        for frame in frames:
            given = frame[feature].notna().to_numpy()
            p = np.full(len(frame), np.nan)
            if given.any():
                z = _logits(frame[feature][given], head)[1]
                p[given] = 1 / (1 + np.exp(z[:, 0] - z[:, 1]))
            frame = frame[keep].copy()
            frame[out] = p
            yield frame

    schema = T.StructType([*(rows.schema[c] for c in keep), T.StructField(out, T.DoubleType())])
    return map_pandas(rows.select(*dict.fromkeys([*keep, feature])), run, schema)


def fit_head(train: DataFrame, feature: str, label: str, valid: DataFrame | None = None, t: Training = Training(), batch: str | None = None):
    """(head of shape 2 x (d + 1), history) of a linear layer, from zeros; the bias comes last.

    train and valid should be written tables, as each step reads one. With `batches` over 1, step i of an epoch takes the
    rows whose `batch` column is i modulo `batches`. Without usable rows, ValueError. The history has a dict for each epoch
    (epoch, train_loss, lr; with valid also val_loss, auc, best); with valid the head of the best AUC is returned, and
    training ends after `patience` epochs without a gain.
    """
    good = _usable(train, feature, label)
    counts = {r[label]: r["n"] for r in good.groupBy(label).agg(F.count("*").alias("n")).collect()}
    if not counts:
        raise ValueError("no labelled rows with features")
    if t.batches > 1 and not batch:
        raise ValueError("batches need a column that deals rows to them")
    n = sum(counts.values())
    weights = {c: n / (2 * max(counts.get(c, 0), 1)) for c in (0, 1)}
    dim = good.agg(F.max(F.size(feature))).first()[0]
    head = np.zeros((2, dim + 1))
    best, top, bad, history = head, None, 0, []
    adam = AdamW(t, head.shape)
    for epoch in range(1, t.epochs + 1):
        losses = []
        for i in range(t.batches):
            part = train if t.batches == 1 else train.where(F.pmod(F.col(batch), F.lit(t.batches)) == i)
            gradient, loss = _pass(part, feature, label, head, weights)
            head = adam.step(head, gradient, rate_at(t, epoch - 1))
            losses.append(loss)
        row = {"epoch": epoch, "train_loss": sum(losses) / len(losses), "lr": rate_at(t, epoch)}
        if valid is not None:
            scored = predict(valid.where(F.col(label).isin(0, 1)), feature, head, [label])
            auc = metrics.roc_auc(scored, label, "prob").first()[0]
            auc = None if auc is None or math.isnan(auc) else float(auc)
            gained = auc is not None and (top is None or auc > top + t.min_gain)
            best, top, bad = (head, auc, 0) if gained else (best, top, bad + 1)
            row |= {"val_loss": _pass(valid, feature, label, head, weights)[1], "auc": auc, "best": gained}
        history.append(row)
        if valid is not None and bad >= t.patience:
            break
    return (best if valid is not None and top is not None else head), history
