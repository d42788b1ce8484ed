"""Many small logistic fits at once: stratified folds, grouped Newton steps, elimination by sign stability.

A fold's fit, a set of columns and a penalty make one model. All models of a round are fitted together: each Newton step
is one pass over the rows, which sums every model's gradient and curvature, so rows are never copied per fold and a
step costs one scan however many models there are. The driver sees sums of models, never rows.
"""

from __future__ import annotations

import statistics
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairn.operators.windows import numbered, running_sum
from cairn.sources.scratch import cut_lineage

#: A fit has settled when no coefficient moves by more than this.
SETTLED = 1e-10
MOST_STEPS = 60


def stratified_folds(df: DataFrame, key: Column, label: str, folds: int, repeats: int = 1, seed: str = "0") -> DataFrame:
    """M2: ``df`` with ``folds``, an array of each row's fold (0 to folds - 1) in every repeat.

    In a repeat the rows of a label are dealt out in turn, in the order of MD5 over (seed, repeat, key): each fold gets the
    same number of them, give or take one, on every engine. The order is global and cut into ranges. Keys are distinct
    and not null.
    """
    keyed = cut_lineage(df.withColumn("__key", key))
    runs = keyed.select("__key", F.col(label).alias("__y"), F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))).alias("__repeat"))
    hashed = F.md5(F.concat_ws(":", F.lit(seed), F.col("__repeat").cast("string"), F.col("__key").cast("string")))
    placed = numbered(runs, ["__repeat", "__y", "__hash", F.col("__key").cast("string")], {"__hash": hashed})
    first = placed.groupBy(F.col("__repeat").alias("__r"), F.col("__y").alias("__label")).agg(F.min("__below").alias("__first"))
    # one row per repeat and label
    dealt = placed.join(F.broadcast(first), (F.col("__repeat") == F.col("__r")) & F.col("__y").eqNullSafe(F.col("__label"))).select("__key", "__repeat", ((F.col("__below") - F.col("__first")) % folds).cast("int").alias("__fold"))
    # a repeat's fold is a column of its own until it is joined: no list travels
    each = dealt.groupBy("__key").agg(*(F.max(F.when(F.col("__repeat") == r, F.col("__fold"))).alias(f"__f{r}") for r in range(repeats)))
    arrays = each.select("__key", F.array(*(f"__f{r}" for r in range(repeats))).alias("folds"))
    return keyed.join(arrays, "__key").drop("__key")


@dataclass
class Model:
    """A fit of ``columns`` with penalty 1 / c on all rows but those of one fold of one repeat; fold -1 leaves none out."""

    columns: tuple[str, ...]
    c: float
    repeat: int = 0
    fold: int = -1
    beta: np.ndarray = field(default=None, repr=False)
    mean: np.ndarray = field(default=None, repr=False)
    scale: np.ndarray = field(default=None, repr=False)

    def coefficients(self) -> dict[str, float]:
        return dict(zip(self.columns, self.beta[1:].tolist(), strict=True))


class Rows:
    """The columns of some rows as arrays: x, y (0 or 1) and folds."""

    def __init__(self, frame: pd.DataFrame, names: list[str]):
        self.x = frame[names].to_numpy(np.float64)
        self.y = frame["y"].to_numpy(np.float64)
        self.folds = np.array(frame["folds"].tolist(), np.int64).reshape(len(frame), -1)
        self.at = {c: k for k, c in enumerate(names)}

    def mask(self, model: Model, test: bool = False) -> np.ndarray:
        if model.fold < 0:
            return np.ones(len(self.y), bool)
        return (self.folds[:, model.repeat] == model.fold) == test

    def design(self, model: Model, rows: np.ndarray) -> np.ndarray:
        x = (self.x[np.ix_(rows, [self.at[c] for c in model.columns])] - model.mean) / model.scale
        return np.hstack([np.ones((len(x), 1)), x])


def probability(design: np.ndarray, beta: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(design @ beta, -700, 700)))


def _summed(rows: DataFrame, names: list[str], width: dict[int, int], of) -> dict[int, np.ndarray]:
    """The sums over all rows of the vectors that ``of(Rows)`` gives by number; each has a fixed width."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals: dict[int, np.ndarray] = {}
        for frame in frames:
            for k, v in of(Rows(frame, names)):
                totals[k] = totals.get(k, 0) + v
        yield pd.DataFrame([(k, v.tolist()) for k, v in totals.items()], columns=["model", "sums"])

    parts = rows.select(*names, "y", "folds").mapInPandas(run, "model int, sums array<double>")
    each = parts.select("model", F.posexplode("sums").alias("at", "v")).groupBy("model", "at").agg(F.sum("v").alias("v"))
    out = {k: np.zeros(n) for k, n in width.items()}
    for r in each.collect():
        out[r.model][r.at] = r.v
    return out


def standardise(rows: DataFrame, names: list[str], models: list[Model]) -> None:
    """Give each model the means and deviations (of a whole population, as M1 has them) of the rows it is fitted on."""
    repeats = {m.repeat for m in models if m.fold >= 0}
    folds = 1 + max((m.fold for m in models), default=-1)
    middle = _summed(rows, names, {0: len(names) + 1}, lambda r: [(0, np.r_[len(r.y), r.x.sum(axis=0)])])[0]
    center = middle[1:] / max(middle[0], 1)
    cells = {(-1, -1): 0} | {(r, f): 1 + i for i, (r, f) in enumerate((r, f) for r in sorted(repeats) for f in range(folds))}

    def of(part: Rows):
        x = part.x - center
        for (repeat, fold), k in cells.items():
            mine = x if fold < 0 else x[part.folds[:, repeat] == fold]
            yield k, np.r_[len(mine), mine.sum(axis=0), (mine * mine).sum(axis=0)]

    sums = _summed(rows, names, dict.fromkeys(cells.values(), 1 + 2 * len(names)), of)
    for m in models:
        n, *rest = sums[0] - (sums[cells[m.repeat, m.fold]] if m.fold >= 0 else 0)
        first, second = np.array(rest[: len(names)]) / max(n, 1), np.array(rest[len(names) :]) / max(n, 1)
        deviation = np.sqrt(np.maximum(second - first * first, 0))
        deviation[deviation < 1e-12 * np.maximum(1, np.abs(center))] = 1.0
        at = [names.index(c) for c in m.columns]
        m.mean, m.scale = (center + first)[at], deviation[at]


def fit(rows: DataFrame, names: list[str], models: list[Model]) -> list[Model]:
    """M1: fit all models by Newton's steps, each step one pass over ``rows(names…, y, folds)``.

    Minimises half the squared coefficients (not the intercept's) plus c times the log loss, over standardised columns. A
    step that doesn't lower a model's loss is halved. Columns without nulls; label 0 or 1.
    """
    standardise(rows, names, models)
    for m in models:
        m.beta = np.zeros(len(m.columns) + 1)
    steps, losses, open_ = [np.zeros_like(m.beta) for m in models], [np.inf] * len(models), set(range(len(models)))
    for _ in range(MOST_STEPS):
        if not open_:
            break
        now = [(k, models[k]) for k in sorted(open_)]

        def of(part: Rows, now=now):
            for k, m in now:
                mask = part.mask(m)
                if mask.any():
                    design, y = part.design(m, mask), part.y[mask]
                    z = design @ m.beta
                    p = probability(design, m.beta)
                    loss = np.sum(np.logaddexp(0, z) - y * z)
                    yield k, np.r_[loss, design.T @ (p - y), (design.T @ (design * (p * (1 - p))[:, None])).ravel()]

        width = {k: 1 + len(m.beta) + len(m.beta) ** 2 for k, m in now}
        sums = _summed(rows, names, width, of)
        for k, m in now:
            n = len(m.beta)
            penalty = np.r_[0.0, np.ones(n - 1)]
            loss = m.c * sums[k][0] + 0.5 * np.sum(penalty * m.beta**2)
            if loss > losses[k] + 1e-12 * abs(loss):
                steps[k] = steps[k] / 2
                m.beta = m.beta - steps[k]
                if np.abs(steps[k]).max() <= SETTLED:
                    open_.discard(k)
                continue
            losses[k] = loss
            gradient = m.c * sums[k][1 : n + 1] + penalty * m.beta
            curvature = m.c * sums[k][n + 1 :].reshape(n, n) + np.diag(penalty)
            steps[k] = -np.linalg.lstsq(curvature, gradient, rcond=None)[0]
            m.beta = m.beta + steps[k]
            if np.abs(steps[k]).max() <= SETTLED:
                open_.discard(k)
    return models


def held_out(rows: DataFrame, names: list[str], models: list[Model], key: str) -> DataFrame:
    """(key, model, y, p): what each model says of the rows of the fold it left out."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            part = Rows(frame, names)
            for k, m in enumerate(models):
                mask = part.mask(m, test=True)
                if mask.any():
                    yield pd.DataFrame({key: frame[key][mask], "model": k, "y": part.y[mask].astype(int), "p": probability(part.design(m, mask), m.beta)})

    return rows.select(key, *names, "y", "folds").mapInPandas(run, f"{key} {rows.schema[key].dataType.simpleString()}, model int, y int, p double")


def fold_aucs(scored: DataFrame) -> DataFrame:
    """(model, auc): the rank-sum form with half credit for ties, for all models in one global order of (model, p); null without both labels."""
    counts = scored.groupBy("model", "p").agg(F.sum("y").alias("pos"), F.count("*").alias("n"))
    ranked = cut_lineage(running_sum(counts, [F.col("model"), F.col("p")], F.col("n") - F.col("pos")))
    each = ranked.groupBy("model").agg(F.min("__below").alias("first"), F.sum("pos").alias("pos"), F.sum(F.col("n") - F.col("pos")).alias("neg"), F.sum(F.col("pos") * (F.col("__below") + (F.col("n") - F.col("pos")) * 0.5)).alias("won"))
    return each.select("model", ((F.col("won") - F.col("first") * F.col("pos")) / F.nullif(F.col("pos") * F.col("neg"), F.lit(0))).alias("auc"))


def sign_stable(coefficients: list[float]) -> bool:
    return bool(coefficients) and (min(coefficients) > 0 or max(coefficients) < 0)


def instability(coefficients: list[float]) -> float:
    """How far the smaller side reaches of the larger one: 0 for one sign, 1 for an even split or nothing but zeros."""
    if not coefficients or sign_stable(coefficients):
        return 0.0
    ends = sorted((abs(min(coefficients)), abs(max(coefficients))))
    return ends[0] / ends[1] if ends[1] else 1.0


def to_drop(coefficients: dict[str, list[float]]) -> str | None:
    """The least stable column; of equally unstable ones that with the smaller middle coefficient, then by name."""
    shaky = [c for c, values in coefficients.items() if not sign_stable(values)]
    return min(shaky, key=lambda c: (-instability(coefficients[c]), abs(statistics.median(coefficients[c])), c), default=None)


@dataclass
class Round:
    """One step of an elimination: the columns, what their folds said, and the column dropped next."""

    c: float
    columns: tuple[str, ...]
    coefficients: dict[str, list[float]]
    auc: float
    stable: bool
    dropped: str | None
    models: list[Model] = field(repr=False, default_factory=list)


@dataclass
class Selection:
    """All rounds; the chosen one; by how much the best unstable round beats it; whether that is an alarm."""

    rounds: list[Round]
    chosen: Round | None
    cost: float | None
    alarm: bool


def select(rows: DataFrame, pool: list[str], key: str, *, grid: tuple[float, ...], folds: int, repeats: int, least: int = 1, always: tuple[str, ...] = (), alarm_at: float = 0.02) -> Selection:
    """M3: for each penalty drop the least sign-stable column until all keep their sign on every fold, or ``least`` are left.

    ``rows`` has the columns, y, key and folds (``stratified_folds``). The penalties of the grid go on side by side:
    a round fits the folds of all that are still eliminating at once. Columns in ``always`` are fitted and never dropped or
    judged. Chosen is the stable round with the highest median AUC over folds, then more columns, then the smaller c.
    The alarm is raised without a stable round, or if the best of all rounds has a median AUC higher by over ``alarm_at``.
    """
    names = [*always, *pool]
    left, found = {c: tuple(pool) for c in grid}, []
    while left:
        models = [Model((*always, *columns), c, r, f) for c, columns in left.items() for r in range(repeats) for f in range(folds)]
        fit(rows, names, models)
        aucs = {r.model: r.auc for r in fold_aucs(held_out(rows, names, models, key)).collect()}
        for c, columns in list(left.items()):
            mine = [(k, m) for k, m in enumerate(models) if m.c == c]
            coefficients = {n: [m.coefficients()[n] for _, m in mine] for n in columns}
            known = [aucs[k] for k, _ in mine if aucs.get(k) is not None]
            drop = to_drop(coefficients)
            last = drop is None or len(columns) <= least
            found.append(Round(c, columns, coefficients, statistics.median(known) if known else float("nan"), all(map(sign_stable, coefficients.values())), None if last else drop, [m for _, m in mine]))
            if last:
                del left[c]
            else:
                left[c] = tuple(n for n in columns if n != drop)
    stable = [r for r in found if r.stable]
    chosen = min(stable, key=lambda r: (-r.auc, -len(r.columns), r.c), default=None)
    cost = max(r.auc for r in found) - chosen.auc if chosen else None
    return Selection(found, chosen, cost, chosen is None or cost > alarm_at)


def out_of_fold(rows: DataFrame, names: list[str], key: str, *, c: float, folds: int, repeats: int, others: tuple[str, ...] = ()) -> DataFrame:
    """M2: (key, others, y, p): the mean over repeats of what the models that left a row out say of it; ``others`` are columns kept beside the key."""
    models = fit(rows, names, [Model(tuple(names), c, r, f) for r in range(repeats) for f in range(folds)])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # all repeats of a row are at hand with it, so nothing is gathered by key
        for frame in frames:
            part = Rows(frame, names)
            total = np.zeros(len(frame))
            for m in models:
                mask = part.mask(m, test=True)
                if mask.any():
                    total[mask] += probability(part.design(m, mask), m.beta)
            yield pd.DataFrame({**{k: frame[k] for k in kept}, "y": part.y.astype(int), "p": total / repeats})

    kept = [key, *others]
    shape = ", ".join(f"{k} {rows.schema[k].dataType.simpleString()}" for k in kept)
    return rows.select(*kept, *(n for n in names if n not in kept), "y", "folds").mapInPandas(run, f"{shape}, y int, p double")
