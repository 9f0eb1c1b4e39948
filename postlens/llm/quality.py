"""A quality classifier learnt from trusted positives and unlabelled text.

Texts marked good are the positives; all texts, whatever their mark, are the
unlabelled ones, a mixture of good and bad. With the share of good texts ``p``
(the class prior) and a loss, the risk over good and bad texts is

    p * E+[loss(f)] + max(0, E?[loss(-f)] - p * E+[loss(-f)])

where the second part, the risk of the bad texts, can't be negative; where an
estimate of it is, the step goes the other way, which stops overfitting. This is
the non-negative unbiased risk. The prior is estimated from the marked rows of
the training folds, as is the constant added to ``f`` that makes a score of one
half the border that tells the marked rows apart best.

``f`` is a linear function of a few dozen measures of the whole text (shares of
character classes, lengths, repeats, punctuation inside and between words) and
of their squares. It is fitted on at most ``SAMPLE`` positives and as many
unlabelled texts, taken by the hash of their id; every text is scored.

Defined results: null texts are scored as empty ones; an empty text has a score
like any other; repeated rows are scored each; without any positive or any
unlabelled text the score is the prior, or one half if there is no mark at all.
Labels, language, source and id are never inputs of a score.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import pandas_udf

from postlens.llm.common import map_columns

SAMPLE = 6000  # positives, unlabelled and marked texts that the model is fitted on, at most of each
STEPS = 600
FOLDS = 3
HELD_OUT = 1

UPPER, LOWER, DIGIT, SPACE, POINT, SIGN, OTHER = range(7)
CLASSES = np.full(256, OTHER, "u1")
for code in range(128):
    char = chr(code)
    CLASSES[code] = (
        UPPER if char.isupper() else LOWER if char.islower() else DIGIT if char.isdigit()
        else SPACE if char.isspace() else POINT if char in ".,;:'\"-?()" else SIGN
    )
SIGN_CODES = [ord(c) for c in "!#$%&*+/<=>@[\\]^_`{|}~"]
SENTENCE = re.compile(r"[.!?](?:\s|$)")


def measures(text: str | None) -> np.ndarray:
    """The numbers a text is judged by."""
    text = text or ""
    data = np.frombuffer(text.encode("utf-8", "replace"), "u1")
    n = max(1, len(data))
    counts = np.bincount(data, minlength=256)
    kinds = np.bincount(CLASSES, counts, 7) / n
    words = text.split()
    w = max(1, len(words))
    sizes = np.fromiter(map(len, words), "i8", len(words)) if words else np.zeros(1, "i8")
    lines = text.split("\n")
    long_lines = [x for x in lines if len(x) > 20]
    trigrams = set(zip(words, words[1:], words[2:]))
    lead = counts[SIGN_CODES]
    sentences = len(SENTENCE.findall(text))
    upper = sum(1 for x in words if len(x) > 1 and x.isupper())
    plain = sum(map(str.isalpha, words))
    return np.array(
        [
            *kinds,
            np.log1p(n),
            np.log1p(w),
            sizes.mean(),
            sizes.std(),
            np.log1p(sizes.max()),
            np.log1p(len(lines)),
            np.log1p(n / len(lines)),
            upper / w,
            plain / w,
            len(set(words)) / w,
            (len(trigrams) + 1) / max(1, w - 1),
            1 - len(set(long_lines)) / max(1, len(long_lines)),
            sentences / w,
            (kinds[POINT] + kinds[SIGN]) * n / w,
            lead.max() / w,
            (lead > 0).sum() / np.log2(2 + w),
            counts[ord("!")] / w,
            counts[ord("|")] / w,
            counts[ord(",")] / w,
            counts[ord(".")] / w,
            float(bool(text) and text.rstrip()[-1:] in ".!?"),
        ]
    )


N_MEASURES = len(measures(""))


@dataclass(frozen=True)
class Model:
    """``score = sigmoid(weights . expanded measures + offset)``; a few hundred numbers."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    offset: float

    def expand(self, rows: np.ndarray) -> np.ndarray:
        z = np.clip((rows - self.mean) / self.scale, -4, 4)
        return np.hstack([z, z * z - 1])

    def scores(self, rows: np.ndarray) -> np.ndarray:
        f = self.expand(rows) @ self.weights + self.offset
        return 1 / (1 + np.exp(-np.clip(f, -35, 35)))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float, marked: tuple[np.ndarray, np.ndarray] | None = None) -> Model:
    """Minimise the non-negative unbiased risk by gradient steps over all rows."""
    everything = np.vstack([positive, unlabelled])
    model = Model(everything.mean(0), everything.std(0) + 1e-6, np.zeros(2 * everything.shape[1]), 0.0)
    p, u = model.expand(positive), model.expand(unlabelled)
    p, u = (np.hstack([x, np.ones((len(x), 1))]) for x in (p, u))
    w = np.zeros(p.shape[1])
    w[-1] = np.log(prior / (1 - prior))
    first, second = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, STEPS + 1):
        fp, fu = p @ w, u @ w
        # Logistic loss: loss(f) = log(1 + exp(-f)).
        bad_risk = np.logaddexp(0, fu).mean() - prior * np.logaddexp(0, fp).mean()
        good = -prior * (sigmoid(-fp) @ p) / len(p)
        bad = (sigmoid(fu) @ u) / len(u) - prior * (sigmoid(fp) @ p) / len(p)
        grad = (good + bad if bad_risk >= 0 else -bad) + 1e-4 * np.append(w[:-1], 0)
        first, second = 0.9 * first + 0.1 * grad, 0.999 * second + 0.001 * grad * grad
        w = w - 0.03 * first / (1 - 0.9**step) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    model = Model(model.mean, model.scale, w[:-1], float(w[-1]))
    return model if marked is None else Model(model.mean, model.scale, model.weights, model.offset + border(model, *marked))


def border(model: Model, rows: np.ndarray, good: np.ndarray) -> float:
    """What to add to ``f`` so that its sign tells good from bad with the fewest errors on marked rows."""
    if good.all() or not good.any():
        return 0.0
    f = model.expand(rows) @ model.weights + model.offset
    order = np.argsort(f, kind="stable")
    f, good = f[order], good[order]
    errors = np.concatenate([[0], np.cumsum(good)]) + np.concatenate([np.cumsum(~good[::-1])[::-1], [0]])
    edges = np.concatenate([[f[0] - 1], (f[1:] + f[:-1]) / 2, [f[-1] + 1]])
    best = np.flatnonzero(errors == errors.min())
    return -float(edges[best[np.argmin(np.abs(edges[best]))]])


def fold(id_col: Column) -> Column:
    return F.crc32(id_col.cast("string")) % FOLDS


def sample_measures(docs: DataFrame, keys: DataFrame, id_col: str, text_col: str, *more: str) -> tuple[np.ndarray, list]:
    """Measures of the texts of at most ``SAMPLE`` rows of ``keys``, by the hash of the id."""
    taken = keys.orderBy(F.xxhash64(id_col), id_col).limit(SAMPLE)  # its rows are numbers only: a bounded broadcast
    texts = docs.select(id_col, text_col).join(F.broadcast(taken), id_col).select(text_col, *more)

    def start():
        return lambda texts, *marks: ([measures(t) for t in texts], *marks)

    kinds = "".join(f", {c} int" for c in more)
    rows = map_columns(texts, start, f"m array<double>{kinds}").limit(2 * SAMPLE).collect()
    return np.array([r["m"] for r in rows]).reshape(-1, N_MEASURES), [tuple(r[1:]) for r in rows]


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Model:
    """A model from the rows of the training folds of ``docs`` and ``labels``."""
    learning = F.col(id_col).isNotNull() & (fold(F.col(id_col)) != HELD_OUT)
    marks = labels.where(learning & F.col(label_col).isNotNull()).select(id_col, F.col(label_col).cast("int").alias("_good")).distinct()
    share = marks.agg(F.avg("_good")).first()[0]
    prior = 0.5 if share is None else float(np.clip(share, 0.01, 0.99))
    positive, _ = sample_measures(docs, marks.where("_good = 1").select(id_col), id_col, text_col)
    unlabelled, _ = sample_measures(docs, docs.where(learning).select(id_col).distinct(), id_col, text_col)
    marked, good = sample_measures(docs, marks, id_col, text_col, "_good")
    if not len(positive) or not len(unlabelled):
        return Model(np.zeros(N_MEASURES), np.ones(N_MEASURES), np.zeros(2 * N_MEASURES), float(np.log(prior / (1 - prior))))
    return fit(positive, unlabelled, prior, (marked, np.array([g[0] == 1 for g in good])) if len(marked) else None)


def score(texts: Column, model: Model) -> Column:
    """The score of each text: 0 to 1, higher for better."""

    @pandas_udf("double")
    def scored(batch):
        import pandas as pd

        if not len(batch):
            return pd.Series([], dtype="float64")
        return pd.Series(model.scores(np.array([measures(t) for t in batch])), index=batch.index)

    return scored(texts)


def keep_good(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text scores one half or more."""
    return docs.where(score(F.col(f"`{text_col}`"), model) >= 0.5)
