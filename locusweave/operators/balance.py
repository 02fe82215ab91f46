"""Balancing of symmetric contact matrices: biases that make the scaled row sums equal.

The method is that of Knight and Ruiz: Newton steps on x * (A x) = 1, each solved by a few conjugate gradient steps that
are kept inside a cone. What decides about a step are a few sums over a matrix's rows, so the same decisions (`Course`)
drive two forms: in one task for matrices that are small together, and over Spark for matrices of any size, such as one
of all chromosomes. There the contacts stay where they are written; each product A u is a join of the contacts with u and
a sum by row, and only sums over rows, one line a matrix, come to the driver.
"""

from __future__ import annotations

import math
import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from locusweave.operators.ranks import order_statistic
from locusweave.plans.scratch import saved
from locusweave.plans.size import broadcast_if_small

cloudpickle.register_pickle_by_value(sys.modules[__name__])
#: The cone, and how much of the residual the next solution may leave at most.
LEAST, MOST, LEAVE, FACTOR = 0.1, 3.0, 0.1, 0.9
#: Contacts of a matrix up to which it is balanced in one task.
ONE_TASK = 2_000_000
#: Bytes of a vector that goes to all tasks.
VECTOR_BYTES = 256 << 20


class Course:
    """Where a matrix is: `begin` and `turn` take the residual after a Newton step, `walk` the sums of a gradient step.

    After each, `do` says what to do next: "inner" (another gradient step, with p = z + beta * p), "outer" (a Newton
    step, with y = y + step * p) or "done".
    """

    def __init__(self, tol: float, outer: int, inner: int):
        self.tol, self.outer, self.inner = tol, outer, inner
        self.eta, self.rho, self.steps, self.k = LEAVE, None, 0, 0
        self.do, self.beta, self.step, self.move = "outer", 0.0, 0.0, False

    def turn(self, rho: float, preconditioned: float) -> None:
        """rho: squared residual; preconditioned: the same over v."""
        if self.rho is not None:
            before, was = self.eta, self.rho
            self.eta = FACTOR * rho / was if was else LEAVE
            if FACTOR * before**2 > 0.1:
                self.eta = max(self.eta, FACTOR * before**2)
            self.eta = max(min(self.eta, LEAVE), 0.5 * self.tol / math.sqrt(rho) if rho > 0 else 0.0)
        self.rho, self.k = rho, 0
        self.limit = max(self.eta**2 * rho, self.tol**2)
        if not rho > self.tol**2 or self.steps >= self.outer:
            self.do = "done"
            return
        self.steps += 1
        self.zr, self.beta = preconditioned, 0.0
        self.do, self.k = "inner", 1

    def alpha(self, pw: float) -> float:
        return self.zr / pw if pw else 0.0

    def walk(self, alpha: float, least: float, most: float, down: float, up: float, zr: float) -> None:
        """least, most: of y + alpha p; down, up: shares of the step at which the cone is left; zr: the next residual's."""
        if least <= LEAST or most >= MOST:
            share = down if least <= LEAST else up
            self.step, self.move, self.do = alpha * (share if math.isfinite(share) else 1.0), False, "outer"
            return
        self.step, self.move = alpha, True
        self.beta, self.zr = (zr / self.zr if self.zr else 0.0), zr
        self.k += 1
        self.do = "inner" if zr > self.limit and self.k <= self.inner else "outer"


def balance_vector(a: np.ndarray, b: np.ndarray, v: np.ndarray, n: int, keep: np.ndarray, tol: float, outer: int, inner: int) -> tuple[np.ndarray, np.ndarray]:
    """x and x * (A x) for a matrix given as contacts, in numpy; rows outside keep have 0."""

    def times(x):
        return np.bincount(a, v * x[b], n) + np.bincount(b, v * x[a], n)

    x, course = np.where(keep, 1.0, 0.0), Course(tol, outer, inner)
    w = x * times(x)
    while course.do != "done":
        r = np.where(keep, 1 - w, 0.0)
        safe = np.where(w > 0, w, 1.0)
        course.turn(float((r * r).sum()), float((r * r / safe).sum()))
        y, p = np.where(keep, 1.0, 0.0), r / safe
        while course.do == "inner":
            q = x * times(x * p) + w * p
            alpha = course.alpha(float((p * q).sum()))
            new, step = y + alpha * p, alpha * p
            left, right = keep & (step < 0), keep & (new > MOST)
            less = r - alpha * q
            course.walk(
                alpha, float(new[keep].min(initial=1.0)), float(new[keep].max(initial=1.0)), float(((LEAST - y[left]) / step[left]).min(initial=math.inf)),
                float(((MOST - y[right]) / step[right]).min(initial=math.inf)), float((less * less / safe).sum()),
            )
            y = y + course.step * p
            if course.move:
                r, p = less, less / safe + course.beta * p
        if course.do != "done":
            x = x * y
            w = x * times(x)
    return x, w


def _in_one_task(pdf: pd.DataFrame, sparsest: float, tol: float, outer: int, inner: int) -> pd.DataFrame:
    nodes, where = np.unique(np.concatenate([pdf["i"].to_numpy(), pdf["j"].to_numpy()]), return_inverse=True)
    a, b, v, n = where[: len(pdf)], where[len(pdf) :], pdf["n"].to_numpy(float), len(nodes)
    sums = np.bincount(a, v, n) + np.bincount(b, v, n)
    keep = sums > (np.sort(sums)[min(int(sparsest * n), n - 1)] if sparsest > 0 and n else -1.0)
    use = keep[a] & keep[b]
    x, w = balance_vector(a[use], b[use], v[use], n, keep, tol, outer, inner)
    return pd.DataFrame({"m": pdf["m"].iloc[0] if len(pdf) else None, "i": nodes, "x": np.where(keep, x, 0.0), "scaled": w})


def _over_spark(contacts: DataFrame, sparsest: float, tol: float, outer: int, inner: int) -> DataFrame:
    """contacts(m, i, j, n) -> m, i, x, scaled; every product is one join and one sum over the contacts."""
    both = contacts.select("m", "i", "j", F.col("n").cast("double").alias("n"))
    both = both.unionByName(both.select("m", F.col("j").alias("i"), F.col("i").alias("j"), "n"))
    sums = saved(both.groupBy("m", "i").agg(F.sum("n").alias("s")), "balance-sums")
    if sparsest > 0:
        place = F.least(F.floor(F.lit(sparsest) * F.count(F.lit(1))), F.count(F.lit(1)) - 1)
        places = saved(sums.groupBy("m").agg(place.alias("at")), "balance-places")
        cuts = broadcast_if_small(saved(order_statistic(sums, "m", F.col("s"), places), "balance-cuts"))
        nodes = sums.join(cuts, "m").select("m", "i", (F.col("s") > F.col("value")).alias("keep"))
    else:
        nodes = sums.select("m", "i", F.lit(True).alias("keep"))
    nodes = saved(nodes, "balance-nodes")
    kept = nodes.where("keep").select("m", "i")
    for side in ("i", "j"):
        mine = kept.select("m", F.col("i").alias(side))
        both = both.join(broadcast_if_small(mine, VECTOR_BYTES), ["m", side], "left_semi")
    both = saved(both, "balance-contacts")
    names = [r[0] for r in kept.select("m").distinct().collect()]  # one number a matrix
    courses = {m: Course(tol, outer, inner) for m in names}
    one = F.lit(1.0)
    state = kept.select("m", "i", one.alias("x"), one.alias("v"), one.alias("y"), F.lit(0.0).alias("r"), F.lit(0.0).alias("p"))
    ended = None
    while courses:
        doing = F.create_map(*[F.lit(k) for m, c in courses.items() for k in (m, c.do)])[F.col("m")] == "inner"
        state = state.withColumn("inner", doing)
        u = F.when(F.col("inner"), F.col("x") * F.col("p")).otherwise(F.col("x"))
        vector = state.select("m", F.col("i").alias("j"), u.alias("u"))
        product = both.join(broadcast_if_small(vector, VECTOR_BYTES), ["m", "j"]).groupBy("m", "i").agg(F.sum(F.col("n") * F.col("u")).alias("q"))
        state = saved(state.join(product, ["m", "i"], "left").na.fill(0.0, ["q"]), "balance-state")
        w = F.when(F.col("inner"), F.col("x") * F.col("q") + F.col("v") * F.col("p")).otherwise(F.col("x") * F.col("q"))
        state = state.withColumn("w", w)
        safe = lambda c: F.when(c > 0, c).otherwise(1.0)
        new_r = 1 - F.col("w")
        first = state.groupBy("m").agg(F.sum(F.col("p") * F.col("w")).alias("pw"), F.sum(new_r * new_r).alias("rho"), F.sum(new_r * new_r / safe(F.col("w"))).alias("z"))
        told = {r["m"]: r for r in first.collect()}
        was = {m: c.do for m, c in courses.items()}
        alphas = {m: c.alpha(told[m]["pw"]) for m, c in courses.items() if c.do == "inner"}
        by = lambda values: F.create_map(*[F.lit(k) for m, v in values.items() for k in (m, v)])[F.col("m")] if values else F.lit(None)
        if alphas:
            a = by(alphas)
            new, step, less = F.col("y") + a * F.col("p"), a * F.col("p"), F.col("r") - a * F.col("w")
            second = state.where("inner").groupBy("m").agg(
                F.min(new).alias("least"), F.max(new).alias("most"), F.min(F.when(step < 0, (LEAST - F.col("y")) / step)).alias("down"),
                F.min(F.when(new > MOST, (MOST - F.col("y")) / step)).alias("up"), F.sum(less * less / safe(F.col("v"))).alias("z"),
            )
            for r in second.collect():
                inf = math.inf
                courses[r["m"]].walk(alphas[r["m"]], r["least"], r["most"], inf if r["down"] is None else r["down"], inf if r["up"] is None else r["up"], r["z"])
        for m, c in courses.items():
            if was[m] == "outer":
                c.turn(told[m]["rho"], told[m]["z"])
        state = _next(state, courses, was, alphas, by)
        done = [m for m, c in courses.items() if c.do == "done"]
        if done:
            part = state.where(F.col("m").isin(done)).select("m", "i", "x", F.col("v").alias("scaled"))
            ended = part if ended is None else ended.unionByName(part)
            state = state.where(~F.col("m").isin(done))
            courses = {m: c for m, c in courses.items() if c.do != "done"}
    zero = nodes.where("not keep").select("m", "i", F.lit(0.0).alias("x"), F.lit(0.0).alias("scaled"))
    return zero if ended is None else ended.unionByName(zero)


def _next(state: DataFrame, courses: dict, was: dict, alphas: dict, by) -> DataFrame:
    """The rows' numbers for the next product, by what each matrix does next."""
    safe = lambda c: F.when(c > 0, c).otherwise(1.0)
    turned = by({m: was[m] == "outer" for m in courses})
    moved, leaves = by({m: c.move and was[m] == "inner" for m, c in courses.items()}), by({m: was[m] == "inner" and c.do == "outer" for m, c in courses.items()})
    step, beta, alpha = by({m: c.step for m, c in courses.items()}), by({m: c.beta for m, c in courses.items()}), by({m: alphas.get(m, 0.0) for m in courses})
    v: Column = F.when(turned, F.col("w")).otherwise(F.col("v"))
    y = F.when(turned, 1.0).otherwise(F.col("y") + step * F.col("p"))
    r = F.when(turned, 1 - F.col("w")).when(moved, F.col("r") - alpha * F.col("w")).otherwise(F.col("r"))
    p = F.when(turned, r / safe(v)).when(moved, r / safe(v) + beta * F.col("p")).otherwise(F.col("p"))
    x = F.when(leaves, F.col("x") * y).otherwise(F.col("x"))
    return state.select("m", "i", x.alias("x"), v.alias("v"), y.alias("y"), r.alias("r"), p.alias("p"))


def matrix_balance(contacts: DataFrame, sparsest: float = 0.05, tol: float = 1e-6, outer: int = 30, inner: int = 10, one_task: int = ONE_TASK) -> DataFrame:
    """Bias of each row of the symmetric matrices (chrom, i, j, n) that makes scaled row sums equal.

    Rows with sums up to the `sparsest` order statistic are taken out (bias -1); the diagonal counts twice, as in M + M'.
    Gives chrom, i, bias, the scaled row sum, and `odd`: the mean or the median of the matrix's biases, those of -1
    among them, lies outside 0.5 to 2. A matrix with up to `one_task` contacts is balanced in one task, all others
    over Spark.
    """
    rows = contacts.select(F.col("chrom").alias("m"), "i", "j", "n")
    sizes = saved(rows.groupBy("m").agg(F.count(F.lit(1)).alias("k")), "balance-sizes")
    large = [r[0] for r in sizes.where(F.col("k") > one_task).select("m").collect()]  # one name a matrix

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        return _in_one_task(pdf, sparsest, tol, outer, inner)

    found = rows.where(~F.col("m").isin(large)).groupBy("m").applyInPandas(run, "m string, i long, x double, scaled double")
    if large:
        # Numbers of the rows may be of any type that joins; here they are longs.
        found = found.unionByName(_over_spark(rows.where(F.col("m").isin(large)), sparsest, tol, outer, inner))
    return _biases(saved(found, "balance-vectors")).withColumnRenamed("m", "chrom")


def genome_balance(contacts: DataFrame, sparsest: float = 0.05, tol: float = 1e-6, outer: int = 30, inner: int = 10) -> DataFrame:
    """One matrix of all chromosomes: contacts(chr1, mid1, chr2, mid2, n) -> chrom, mid, bias, scaled, odd; always over Spark."""
    ends = contacts.select(F.col("chr1").alias("chrom"), F.col("mid1").alias("mid")).union(contacts.select("chr2", "mid2")).distinct()
    numbered = saved(ends.withColumn("i", F.monotonically_increasing_id()), "balance-ends")
    one, two = (numbered.select(F.col("chrom").alias(f"chr{k}"), F.col("mid").alias(f"mid{k}"), F.col("i").alias(c)) for k, c in ((1, "i"), (2, "j")))
    rows = contacts.join(broadcast_if_small(one), ["chr1", "mid1"]).join(broadcast_if_small(two), ["chr2", "mid2"])
    rows = saved(rows.select(F.lit("genome").alias("m"), "i", "j", "n"), "balance-genome")
    found = _biases(saved(_over_spark(rows, sparsest, tol, outer, inner), "balance-vectors"))
    return found.join(numbered, "i").select("chrom", "mid", "bias", "scaled", "odd")


def _biases(found: DataFrame) -> DataFrame:
    """1 / x over its mean, -1 for rows that are out, and whether mean or median are odd."""
    means = found.where("x > 0").groupBy("m").agg(F.avg(1 / F.col("x")).alias("mean"))
    out = found.join(broadcast_if_small(means), "m", "left")
    out = out.select("m", "i", F.when(F.col("x") > 0, 1 / F.col("x") / F.col("mean")).otherwise(-1.0).alias("bias"), "scaled")
    odd = lambda c: (c < 0.5) | (c > 2)
    # The median is that of a digest of the biases: it only warns.
    told = out.groupBy("m").agg((odd(F.avg("bias")) | odd(F.percentile_approx("bias", 0.5, F.lit(10_000)))).alias("odd"))
    return out.join(broadcast_if_small(told), "m")
