"""Quality by regularised quadratic discriminant analysis of transformed document statistics.

Each class has a Gaussian over the transformed counts of a text. Its covariance is shrunk
towards the pooled covariance and towards a multiple of the identity, then factored once
(Cholesky); the score is a logistic function of the difference of the two log densities. Their
Mahalanobis terms are squared lengths after the inverse of the factor, which a worker works out
once and applies to a batch of rows at a time.

The training rows are never collected: sums and products per class are aggregated in Spark, so
the driver sees one row of d(d+3)/2 + 1 numbers per class.

Defined results: a null text counts as empty and gets a score like any other. Labels other than
0 and 1 and null labels are not learned from; a document with several labels counts once for
each. Without labels of both classes every score is the share of label 1 among them (0.5 with
none). Repeated rows get equal scores, texts of any length are counted whole; an empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablehaul.llm.common import durable, fold, map_arrow, quoted
from tablehaul.llm.text_stats import with_stats


def _log_share(of: str, by: str) -> Column:
    return F.log(F.col(of) / F.greatest(F.col(by), F.lit(1)) + 0.01)


def features() -> list[Column]:
    """Transformed statistics: logarithms, so that skewed shares come nearer to a Gaussian."""
    return [
        F.log1p("n_words"),
        F.log(F.col("word_chars") / F.greatest(F.col("n_words"), F.lit(1)) + 1),
        _log_share("n_symbols", "n_words"),
        _log_share("n_dup_lines", "n_lines"),
        _log_share("n_repeat_words", "n_words"),
        _log_share("n_adjacent", "n_words"),
        _log_share("n_distinct", "n_words"),
        _log_share("n_upper", "word_chars"),
        _log_share("n_exclaim", "n_words"),
        _log_share("n_marks", "n_words"),
        _log_share("n_digits", "word_chars"),
        _log_share("n_lines", "n_words"),
    ]


@dataclass(frozen=True)
class Model:
    """Prior log odds, and per class its mean and Cholesky factor."""

    bias: float
    means: tuple[np.ndarray, ...] = ()
    factors: tuple[np.ndarray, ...] = ()

    @cached_property
    def inverses(self) -> list[tuple[np.ndarray, float]]:
        """Per class the inverse of its factor, and the log of the factor's determinant."""
        return [(np.linalg.inv(f), float(np.log(np.diag(f)).sum())) for f in self.factors]

    def scores(self, x: np.ndarray) -> np.ndarray:
        odds = np.full(len(x), self.bias)
        for sign, mean, (inverse, log_det) in zip((-1, 1), self.means, self.inverses, strict=False):
            z = (x - mean) @ inverse.T
            odds += sign * (-0.5 * (z * z).sum(1) - log_det)
        return 1 / (1 + np.exp(-np.clip(odds, -700, 700)))


def fit(sums: dict[int, tuple[float, np.ndarray, np.ndarray]], pooled: float, ridge: float) -> Model:
    """A model from each class's count, sum and sum of products.

    Covariances move by ``pooled`` towards that of all classes, and by ``ridge`` towards a
    multiple of the identity with the same trace.
    """
    n = {k: sums[k][0] if k in sums else 0.0 for k in (0, 1)}
    share = (n[1] + 0.5) / (n[0] + n[1] + 1)
    bias = float(np.log(share / (1 - share)))
    if not n[0] or not n[1]:
        return Model(bias if n[0] + n[1] else 0.0)
    means = [sums[k][1] / n[k] for k in (0, 1)]
    scatter = [sums[k][2] - n[k] * np.outer(means[k], means[k]) for k in (0, 1)]
    common = sum(scatter) / (n[0] + n[1])
    factors = []
    for k in (0, 1):
        c = (1 - pooled) * scatter[k] / n[k] + pooled * common
        even = max(np.trace(c) / len(c), 1e-6) * np.eye(len(c))
        factors.append(np.linalg.cholesky((1 - ridge) * c + ridge * even))
    return Model(bias, tuple(means), tuple(factors))


def class_sums(labelled: DataFrame, d: int) -> dict[int, tuple[float, np.ndarray, np.ndarray]]:
    """Per label: count, sums and sums of products of the feature columns x0, x1, …"""
    x = [F.col(f"x{i}") for i in range(d)]
    pairs = [(i, j) for i in range(d) for j in range(i + 1)]
    out = {}
    for r in (
        labelled.groupBy("label")
        .agg(F.count("*"), *[F.sum(c) for c in x], *[F.sum(x[i] * x[j]) for i, j in pairs])
        .collect()
    ):
        products = np.zeros((d, d))
        for (i, j), v in zip(pairs, r[2 + d :], strict=True):
            products[i, j] = products[j, i] = v
        out[r[0]] = (float(r[1]), np.array(r[2 : 2 + d], float), products)
    return out


def quality_scores(
    df: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    folds: int = 5,
    held_out: int = 0,
    least: float = 0.3,
    pooled: float = 0.1,
    ridge: float = 0.02,
) -> DataFrame:
    """Per row: id, held_out, score and predicted.

    Only labels of ids outside the fold ``held_out`` (crc32 of the id modulo ``folds``) are
    learned from; null ids have no label.
    """
    made = features()
    d = len(made)
    stats = with_stats(df, id_col, text_col).select(
        "id", *[c.cast("double").alias(f"x{i}") for i, c in enumerate(made)]
    )
    stats = durable(stats, "quality-features")
    known = labels.select(
        F.col(quoted(id_col)).alias("id"), F.col(quoted(label_col)).cast("int").alias("label")
    ).where(F.col("label").isin(0, 1) & (fold(F.col("id"), folds) != held_out))
    model = fit(class_sums(stats.join(known, "id"), d), pooled, ridge)

    def score(parts):
        import pyarrow as pa

        for part in parts:
            x = np.column_stack([part.column(f"x{i}").to_numpy() for i in range(d)])
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), pa.array(model.scores(x))], ["id", "score"]
            )

    out = map_arrow(stats, score, f"id {stats.schema['id'].dataType.simpleString()}, score double")
    return out.select(
        "id",
        F.coalesce(fold(F.col("id"), folds) == held_out, F.lit(False)).alias("held_out"),
        "score",
        F.when(F.col("score") >= least, 1).otherwise(0).alias("predicted"),
    )
