"""Incremental logistic regression on long-form features (ML-05..07, AGG-08, AGG-10).

SGD and L-BFGS run as DataFrame iterations over features, weights and gradients that were
dealt into common buckets once (``operators/dealt.py``): a step moves neither features nor
weights. Every generation of weights is a written table, which cuts the lineage; only
scalars (counts, losses, dot products) reach the driver.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from skein.config import drop_bucketed, store
from skein.operators.dealt import Dealt, back_parts, deal, drawn, example_errors, gradient_parts, margins, scaled, sigmoid
from skein.operators.features import EX


#: Tables that one iteration reads twice.
HELD = StorageLevel.MEMORY_AND_DISK


def active_examples(features: DataFrame) -> DataFrame:
    """PRJ-08: examples with at least one stored feature (zeros count as stored, Q21)."""
    return features.groupBy(*EX, "mult").agg(F.count(F.lit(1)).alias("n_features"))


EXK = ["user", "item", "y"]  # example key with an integer label: hash-partitionable as is


def gradient(features: DataFrame, weights: DataFrame) -> DataFrame:
    """AGG-10: ``g_f = Σ_ex mult · (σ(w·x) − y) · x_f`` per feature.

    ``features``: ``(user, item, label, mult, feat, value)``. The plain form for one use; training
    goes through ``operators/dealt.py``. Products are summed into a margin per example, the
    error per example meets the features again by example, and gradients are summed
    per feature — partial aggregation first, so a hot feature combines map-side.
    """
    if "y" not in features.columns:
        features = features.withColumn("y", F.col("label").cast("int"))
    margins = (
        features.join(weights.select("feat", "weight"), "feat", "left")
        .groupBy(*EXK, "label", "mult")
        .agg(F.sum(F.col("value") * F.coalesce(F.col("weight"), F.lit(0.0))).alias("margin"))
        .select(*EXK, (F.col("mult") * (sigmoid(F.col("margin")) - F.col("label"))).alias("err"))
    )
    return (
        features.select(*EXK, "feat", "value")
        .join(margins, EXK)
        .groupBy("feat")
        .agg(F.sum(F.col("err") * F.col("value")).alias("grad"))
    )


def sgd(features: DataFrame, weights: DataFrame, iterations: int, step: float, fraction: float = 1.0,
        convergence_tol: float = 0.001, seed: int = 42, dealt: Dealt | None = None) -> DataFrame:
    """ML-05: warm-start SGD, ``w ← w − step/√t · g/n`` (no regularisation).

    ``features``: a stored table, dealt into buckets once (``dealt``: that has been done).
    Stops early when ``‖Δw‖ < tol · max(‖w‖, 1)`` from the second iteration on (tol 0 disables
    it). ``weights``: ``(kind, k1, k2, feat, weight)``.

    An iteration is one pass over the features within their buckets (``operators/dealt.py``):
    neither features nor weights are shuffled, only the partial gradients of features that
    several buckets share. Each generation of weights is a stored table.
    """
    d = dealt or deal(features, weights)
    spark, w, table = d.spark, d.weights, None
    n = d.examples.agg(F.sum("mult")).first()[0] or 0
    for t in range(1, iterations + 1):
        copies = None if fraction >= 1.0 else drawn(fraction, seed + t)
        count = n if copies is None else d.examples.agg(F.sum(copies)).first()[0] or 0
        if count == 0:
            continue
        moved = F.col("w") - F.lit(step / math.sqrt(t)) * F.coalesce("grad", F.lit(0.0)) / F.lit(float(count))
        if d.placed:
            new, new_table = d.moved(w, example_errors(d, w, copies), moved)
        else:
            parts = gradient_parts(d, w, copies).persist(HELD)
            new, new_table = d.keep(w.select("b", "fid", "shared", "lead", "w").join(d.total(w, parts).hint("shuffle_hash"), ["b", "fid"], "left").select("b", "fid", "shared", "lead", moved.alias("w"), F.col("w").alias("old")), "weights")
            parts.unpersist()
        done = False
        if convergence_tol > 0 and t > 1:
            r = new.where("lead").agg(F.sqrt(F.sum((F.col("w") - F.col("old")) ** 2)).alias("diff"), F.sqrt(F.sum(F.col("w") ** 2)).alias("norm")).first()
            done = r["diff"] < convergence_tol * max(r["norm"], 1.0)
        if table:
            drop_bucketed(spark, table)
        w, table = new, new_table
        if done:
            break
    if d.placed and not table:
        table = d.keep(w, "weights")[1]
        w = spark.table(table)
    out = d.stored(w)
    if table and not d.placed:
        drop_bucketed(spark, table)
    if dealt is None:
        d.close()
    return out


def routing(features: DataFrame, iterations: int, step: float, fraction: float) -> DataFrame:
    """ML-07 decision as one row: no examples -> base; LBFGS chosen and no positive -> base."""
    s = active_examples(features).agg(F.coalesce(F.sum("mult"), F.lit(0)).cast("bigint").alias("n_examples"),
                                      F.coalesce(F.max(F.col("label") > 0), F.lit(False)).alias("has_positive"))
    lbfgs = iterations < 0 or step < 0 or fraction < 0
    route = (
        F.when(F.col("n_examples") == 0, F.lit("base"))
        .when(F.lit(lbfgs) & ~F.col("has_positive"), F.lit("base"))
        .otherwise(F.lit("lbfgs" if lbfgs else "sgd"))
    )
    return s.select("n_examples", "has_positive", route.alias("route"))


def _loss(margin: Column) -> Column:
    """An example's loss log(1 + e^m) − y·m, computed stably, for each of its copies."""
    return F.col("mult") * (F.log1p(F.exp(-F.abs(margin))) + F.greatest(margin, F.lit(0.0)) - F.col("label") * margin)


@dataclass
class Fit:
    """What a fit ends with. ``reason``: why it stopped; only a converged one met a tolerance."""

    weights: DataFrame
    converged: bool
    reason: str
    iterations: int = 0
    loss: float | None = None
    start_loss: float | None = None


def _two_loop(gram: list[list[float]], at: dict[str, int], hist: list[int], eps: float) -> tuple[list[float], list[int]]:
    """Coefficients of the search direction's opposite over (g, s..., y...), and the slots
    whose curvature ``y·s`` was usable."""
    size = len(gram)

    def dot(u, v):
        return sum(u[a] * gram[a][b] * v[b] for a in range(size) for b in range(size) if u[a] and v[b])

    def unit(name):
        e = [0.0] * size
        e[at[name]] = 1.0
        return e

    ys = {i: gram[at[f"y{i}"]][at[f"s{i}"]] for i in hist}
    used = [i for i in hist if ys[i] > eps * gram[at[f"y{i}"]][at[f"y{i}"]]]
    q, alphas = unit("g"), {}
    for i in reversed(used):
        alphas[i] = dot(unit(f"s{i}"), q) / ys[i]
        q[at[f"y{i}"]] -= alphas[i]
    gamma = ys[used[-1]] / gram[at[f"y{used[-1]}"]][at[f"y{used[-1]}"]] if used else 1.0
    r = [gamma * v for v in q]
    for i in used:
        r[at[f"s{i}"]] += alphas[i] - dot(unit(f"y{i}"), r) / ys[i]
    return r, used


def _products(new: list[str], cols: list[str]) -> dict[tuple[str, str], Column]:
    """The dot products of ``cols`` that involve a new vector: of one's coefficients and the other's margins."""
    return {(a, b): F.sum(F.col(f"a_{a}") * F.col(f"x_{b}")).alias(f"{a}__{b}") for i, a in enumerate(cols) for b in cols[i:] if a in new or b in new}


def lbfgs(features: DataFrame, weights: DataFrame, iterations: int = 100, memory: int = 10, tolerance: float = 1e-6,
          c1: float = 1e-4, max_halvings: int = 30, dealt: Dealt | None = None, gradient_tolerance: float = 0.0, max_doublings: int = 20) -> Fit:
    """ML-06: warm-start L-BFGS on the mean logistic loss, fully distributed.

    Features are scaled to a mean square of 1 (D below), as MLlib's trainer scales them by their deviation:
    most belong to one user and to very few examples, and unscaled their curvatures differ by
    orders of magnitude, which costs many times the iterations. The optimum is the same.

    A gradient is ``Xᵀe / n`` of the examples' errors e, and each step and correction pair (s, y) a sum
    of such ones. So a vector v is kept by example, not by feature: as its coefficients a
    (``v = (XD)ᵀa``) and its margins ``x = XD·v``, two columns of one table of the examples. The two-loop
    recursion runs on the Gram matrix of the gradient and the ``memory`` latest pairs ("vector-free"
    L-BFGS, Chen et al. 2014): ``u·v = a_u·x_v`` sums over examples, and an iteration observes only the
    products with the three new vectors, while it writes them. The direction and its margins are column
    expressions.

    The line search has no pass over the features: margins are linear in the step, so the
    table gives the loss at all step sizes ..., 4, 2, 1, 1/2, 1/4, ... in one aggregate, and of those that
    meet Armijo's condition the one of least loss is taken. An iteration reads the features twice, for the gradient and
    for its margins, without an exchange of them; the weights are made once, at the end.
    Only scalars reach the driver.

    It runs until the loss changes by less than ``tolerance`` of what it was at first (the
    usual rule of such trainers), or the gradient vanishes or its norm (of the features as they are, unscaled) falls to
    ``gradient_tolerance`` of what it was at first (converged), or until the iterations or the line search end (not converged;
    ``reason`` says which). Pairs without positive curvature are left out. Without a
    positive label the starting weights come back unchanged, as the routing prescribes.
    """
    if features.where(F.col("label") > 0).isEmpty():
        return Fit(store(weights.select("kind", "k1", "k2", "feat", "weight"), "weights")[0], False, "no positive label")
    d = dealt or deal(features, weights)
    spark = d.spark
    n = float(d.examples.agg(F.sum("mult")).first()[0])
    steps = [0.5 ** k for k in range(-max_doublings, max_halvings)]
    weights, weights_name = scaled(d)
    both = lambda v, a, x: [a.alias(f"a_{v}"), x.alias(f"x_{v}")]
    err = lambda margin: F.col("mult") * (sigmoid(margin) - F.col("label")) / n

    def advance(table: DataFrame, new: list[str], cols: list[str], columns: list[Column]) -> tuple[DataFrame, str]:
        """The next table, from one with the new margins ``m`` and the gradient's coefficients
        ``e``; the dot products of its new vectors are observed while it is written."""
        parts = back_parts(d, table.select("b", "ex", F.col("e").alias("err"))).persist(HELD)
        back = margins(d, d.total(weights, parts, "scale"), u=F.lit(n) * F.col("scale") * F.col("grad"), plain=F.col("grad")).select("b", "ex", "u", "plain")
        seen = Observation()
        after = table.join(back.hint("shuffle_hash"), ["b", "ex"]).select("b", "ex", "label", "mult", "m", "a_w", *columns, "plain")
        norm = F.sum(F.col("a_g") * F.col("plain")).alias("norm")
        stored = d.keep(after.observe(seen, norm, *_products(new, cols).values()).drop("plain"), "lbfgs")
        parts.unpersist()
        gram["norm"] = seen.get["norm"] or 0.0
        for a, b in _products(new, cols):
            gram[a, b] = gram[b, a] = seen.get[f"{a}__{b}"] or 0.0
        return stored

    gram: dict[tuple[str, str] | str, float] = {}   # and the square of the unscaled gradient's norm
    hist: list[int] = []                 # slot numbers, oldest first
    g_start = 0.0
    gradient_now = both("g", F.col("e"), F.col("u"))
    m = margins(d, d.weights, m=F.col("w")).persist(HELD)
    f = f_start = m.agg(F.sum(_loss(F.col("m")))).first()[0] / n
    table, table_name = advance(m.select("b", "ex", "label", "mult", "m", F.lit(0.0).alias("a_w"), err(F.col("m")).alias("e")), ["g"], ["g"], gradient_now)
    m.unpersist()
    out = Fit(None, False, "iterations", iterations, f)
    for it in range(iterations):
        cols = ["g"] + [f"s{i}" for i in hist] + [f"y{i}" for i in hist]
        matrix = [[gram[a, b] for b in cols] for a in cols]
        g_start = gram["norm"] if it == 0 else g_start
        if gram["norm"] <= max(1e-30, gradient_tolerance ** 2 * g_start if it else 0.0) or matrix[0][0] <= 0:
            out = Fit(None, True, "gradient", it, f)
            break
        r, used = _two_loop(matrix, {c: k for k, c in enumerate(cols)}, hist, 1e-12)
        slope = -sum(matrix[0][k] * r[k] for k in range(len(cols)))  # g·d with d = −r
        if slope >= 0:  # not a descent direction: restart from steepest descent
            r, slope, used = [1.0] + [0.0] * (len(cols) - 1), -matrix[0][0], []
        hist = used
        a_d, x_d = (sum((F.lit(-c) * F.col(f"{kind}_{cols[k]}") for k, c in enumerate(r) if c), F.lit(0.0)) for kind in "ax")
        first = 1.0 if hist else min(1.0, 1.0 / math.sqrt(matrix[0][0]))
        tried = table.select("label", "mult", "m", x_d.alias("md")).withColumn("t", F.explode(F.array(*[F.lit(first * t) for t in steps])))
        losses = dict(tried.groupBy("t").agg(F.sum(_loss(F.col("m") + F.col("t") * F.col("md")))).collect())
        found = min(((losses[t] / n, -t) for t in losses if losses[t] / n <= f + c1 * t * slope), default=None)
        if found is None:
            out = Fit(None, False, "line search", it, f)
            break
        f_new, t = found[0], -found[1]
        slot = hist.pop(0) if len(hist) == memory else next(i for i in range(memory) if i not in hist)
        hist.append(slot)
        moved = table.select(
            "*", (F.lit(t) * a_d).alias("a_step"), (F.lit(t) * x_d).alias("x_step"), (F.col("m") + F.lit(t) * x_d).alias("m_new")).select(
            *[c for c in table.columns if c not in ("m", "a_w")], "a_step", "x_step", F.col("m_new").alias("m"), (F.col("a_w") + F.col("a_step")).alias("a_w"), err(F.col("m_new")).alias("e"))
        fresh = {f"s{slot}": both(f"s{slot}", F.col("a_step"), F.col("x_step")),
                 f"y{slot}": both(f"y{slot}", F.col("e") - F.col("a_g"), F.col("u") - F.col("x_g"))}
        cols = ["g"] + [f"s{i}" for i in hist] + [f"y{i}" for i in hist]
        new_table, new_name = advance(moved, ["g", *fresh], cols, gradient_now + [c for v in cols[1:] for c in fresh.get(v, [F.col(f"a_{v}"), F.col(f"x_{v}")])])
        drop_bucketed(spark, table_name)
        table, table_name = new_table, new_name
        change, f = abs(f - f_new), f_new
        if change <= tolerance * max(f_start, 1e-12):
            out = Fit(None, True, "loss", it + 1, f)
            break
        out = Fit(None, False, "iterations", it + 1, f)
    parts = back_parts(d, table.select("b", "ex", F.col("a_w").alias("err"))).persist(HELD)
    final = d.total(weights, parts, "lead", "w", "scale")
    out.weights = store(d.named(final.select("fid", "lead", (F.col("w") + F.lit(n) * F.col("scale") * F.col("grad")).alias("w"))), "weights")[0]
    parts.unpersist()
    out.start_loss = f_start
    drop_bucketed(spark, table_name)
    drop_bucketed(spark, weights_name)
    if dealt is None:
        d.close()
    return out


@dataclass
class Step:
    """What a training step did: the weights, the route taken, and how the fit ended (L-BFGS)."""

    weights: DataFrame
    route: str
    fit: Fit | None = None


def train_step(features: DataFrame, base: DataFrame, iterations: int, step: float, fraction: float,
               registry: DataFrame | None = None, batch_dir: str | None = None, dealt: Dealt | None = None) -> Step:
    """ML-07: one batch's training by its route, and how it ended: a fit that did not converge
    says so (``fit.converged``, ``fit.reason``).

    The base weights come back when there is nothing to train. With a ``batch_dir`` the
    weights, numbered by ``registry``, are saved there as sparse lines.
    """
    from skein.sinks.store import save_sparse_weights

    out = Step(base, routing(features, iterations, step, fraction).first()["route"])
    if out.route == "lbfgs":
        out.fit = lbfgs(features, base, dealt=dealt)
        out.weights = out.fit.weights
    elif out.route == "sgd":
        out.weights = sgd(features, base, iterations, step, fraction, dealt=dealt)
    if batch_dir is not None:
        save_sparse_weights(registry.join(out.weights.select("feat", "weight"), "feat"), f"{batch_dir}/sparse_weights")
    return out
