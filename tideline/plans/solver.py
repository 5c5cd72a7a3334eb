"""Newton steps for L2-penalised logistic regressions over compressed rows, many problems at once.

A design row is (part, x, pos, neg): the slot numbers of its levels, the intercept's number last, and its rows by label.
Each step is one job: loss, gradient and Hessian of every problem are sums over (slot, slot) pairs of the rows. Only
these sums reach the driver, ``slots ** 2 / 2`` for each part, where the small systems are solved.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.plans.scoring import sigmoid

STEP = 1e-9      # the longest step that still counts as one
HALVINGS = 40


def score_sql(tables: Mapping[int, Sequence[float]]) -> str:
    """z of a design row, as one SQL text: the sum of its slots' coefficients, by part."""
    width = max(tables) + 1
    arrays = ", ".join("array(" + ", ".join(f"{float(v)!r}D" for v in tables.get(k, [0.0])) + ")" for k in range(width))
    return f"aggregate(x, 0D, (a, i) -> a + element_at(element_at(array({arrays}), part + 1), i + 1))"


def sums(design: DataFrame, betas: Mapping[float, Mapping[int, np.ndarray]]):
    """Per part and pair i <= j: for each C the Hessian entry, the gradient (i = j) and the loss (both the intercept)."""
    cs = list(betas)
    rows = design
    for n, c in enumerate(cs):
        rows = rows.withColumn(f"z{n}", F.expr(score_sql(betas[c])))
    w = F.col("pos") + F.col("neg")
    held = []
    for n, _ in enumerate(cs):
        z = F.col(f"z{n}")
        p = sigmoid(z)
        held += [(w * p * (1 - p)).alias(f"h{n}"), (w * p - F.col("pos")).alias(f"g{n}"),
                 (w * (F.greatest(z, F.lit(0.0)) + F.log1p(F.exp(-F.abs(z)))) - F.col("pos") * z).alias(f"l{n}")]
    pairs = "explode(flatten(transform(x, (i, p) -> transform(slice(x, p + 1, size(x) - p), j -> struct(i, j))))) as ij"
    long = rows.select("part", F.element_at("x", -1).alias("top"), *held, F.expr(pairs)).select("*", "ij.i", "ij.j")
    same, last = F.col("i") == F.col("j"), F.col("i") == F.col("top")
    return long.groupBy("part", "i", "j").agg(
        *[F.sum(f"h{n}").alias(f"h{n}") for n in range(len(cs))], *[F.sum(F.when(same, F.col(f"g{n}"))).alias(f"g{n}") for n in range(len(cs))],
        *[F.sum(F.when(same & last, F.col(f"l{n}"))).alias(f"l{n}") for n in range(len(cs))]).toPandas()


def newton(design: DataFrame, sizes: Mapping[int, int], cs: Sequence[float], max_iter: int) -> dict[tuple[int, float], np.ndarray]:
    """(part, C) -> coefficients, the intercept last, of  1/2 |w|^2 + C * sum of losses  with a free intercept.

    A part with one class only has no finite intercept: its coefficients are zero and the intercept is infinite.
    """
    totals = {r["part"]: (r["pos"], r["neg"]) for r in design.groupBy("part").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")).collect()}
    if any(sum(totals.get(k, (0, 0))) == 0 for k in sizes):
        raise ValueError("no training rows")
    done, state = {}, {}
    for k, n in sizes.items():
        for c in cs:
            beta = np.zeros(n + 1)
            pos, neg = totals[k]
            if pos == 0 or neg == 0:
                beta[n] = -np.inf if pos == 0 else np.inf
                done[k, c] = beta
            else:
                beta[n] = np.log(pos / neg)
                state[k, c] = {"at": beta, "from": beta, "step": None, "loss": np.inf, "halved": 0}
    for _ in range(max_iter):
        if not state:
            break
        open_cs = [c for c in cs if any(key[1] == c for key in state)]
        got = sums(design.where(F.col("part").isin(*sorted({k for k, _ in state}))),
                   {c: {k: state[k, c]["at"] if (k, c) in state else np.zeros(n + 1) for k, n in sizes.items()} for c in open_cs})
        by_part = {k: rows for k, rows in got.groupby("part")}
        for k, c in list(state):
            s, n, rows, at = state[k, c], open_cs.index(c), by_part[k], state[k, c]["at"]
            size = sizes[k]
            loss = 0.5 * float(at[:size] @ at[:size]) + c * float(rows[f"l{n}"].sum())
            if loss > s["loss"] + 1e-12 * abs(s["loss"]) and s["halved"] < HALVINGS:  # too far: half the step
                s["step"], s["halved"] = s["step"] / 2, s["halved"] + 1
                s["at"] = s["from"] + s["step"]
                continue
            hessian, gradient = np.zeros((size + 1, size + 1)), np.zeros(size + 1)
            i, j = rows["i"].to_numpy(), rows["j"].to_numpy()
            hessian[i, j] = hessian[j, i] = c * rows[f"h{n}"].to_numpy()
            gradient[i[i == j]] = c * rows[f"g{n}"].to_numpy()[i == j]
            hessian[np.arange(size), np.arange(size)] += 1.0
            gradient[:size] += at[:size]
            step = -np.linalg.solve(hessian, gradient)
            if np.abs(step).max() < STEP:
                done[k, c] = at + step
                del state[k, c]
            else:
                state[k, c] = {"at": at + step, "from": at, "step": step, "loss": loss, "halved": 0}
    if state:
        raise RuntimeError(f"no convergence after {max_iter} steps: {sorted(state)}")
    return done


def first_order(design: DataFrame, size: int, c: float, max_iter: int, tol: float) -> np.ndarray:
    """The same problem for more slots than a driver can hold squared: L-BFGS of Spark ML on sparse vectors.

    Spark minimises the mean loss, hence the penalty 1/(C*n); the vectors are made of slot numbers in the JVM.
    """
    label = F.explode(F.array(F.struct(F.lit(1.0).alias("y"), F.col("pos").alias("w")), F.struct(F.lit(0.0).alias("y"), F.col("neg").alias("w"))))
    known = F.filter("x", lambda i: i < size).cast("array<string>")
    rows = design.select(known.alias("names"), label.alias("l")).select("names", "l.y", F.col("l.w").cast("double").alias("w")).where("w > 0")
    vectors = CountVectorizerModel.from_vocabulary([str(i) for i in range(size)], "names", "v")
    n = rows.agg(F.sum("w")).first()[0]
    if not n:
        raise ValueError("no training rows")
    model = LogisticRegression(
        featuresCol="v", labelCol="y", weightCol="w", regParam=1.0 / (c * n), elasticNetParam=0.0, standardization=False, fitIntercept=True,
        maxIter=max_iter, tol=tol, family="binomial").fit(vectors.transform(rows))
    return np.append(model.coefficients.toArray(), model.intercept)

