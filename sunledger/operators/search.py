"""Sequential parameter search: Parzen densities over good and bad trials, in a stored study.

The trials so far are split by their value into a good tenth and the rest. For every
parameter a mixture of normal densities over the good trials and one over the others are
laid out; of some points drawn from the good ones the next trial is the one that is likeliest
good and least likely bad. The first trials are drawn at random.

A trial is one row of a table in the shared folder, written when it ends. A study that was
stopped goes on from its table, and draws what it would have drawn: the random numbers of a
trial follow from the seed and the trial's number.
"""

from __future__ import annotations

import json
import math
import random
import time
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession

from sunledger.operators import boosting
from sunledger.operators.boosting import BoostParams

#: Trials drawn at random before the densities are used, and points compared for each trial.
STARTUP = 10
POINTS = 24
#: Share of trials that count as good, and the most of them.
GOOD_SHARE = 0.1
GOOD_MOST = 25


@dataclass(frozen=True)
class Dimension:
    """A range of a parameter, searched on its logarithm or in whole numbers if so marked."""

    name: str
    low: float
    high: float
    log: bool = False
    whole: bool = False

    @property
    def span(self) -> tuple[float, float]:
        if self.log:
            return math.log(self.low), math.log(self.high)
        return (self.low - 0.5, self.high + 0.5) if self.whole else (self.low, self.high)

    def inner(self, value: float) -> float:
        return math.log(value) if self.log else float(value)

    def outer(self, x: float) -> float | int:
        value = math.exp(x) if self.log else x
        if self.whole:
            return int(min(max(round(value), self.low), self.high))
        return min(max(value, self.low), self.high)


# The search space of the tuned models.
SPACE = (
    Dimension("learning_rate", 0.01, 0.3, log=True),
    Dimension("max_depth", 6, 12, whole=True),
    Dimension("reg_lambda", 1e-3, 10.0, log=True),
    Dimension("subsample", 0.5, 1.0),
    Dimension("colsample", 0.5, 1.0),
)


class Parzen:
    """A mixture of normal densities, cut off at the ends of a range.

    One lies on each observation, as wide as the gap to its farther neighbour, and one wide
    density spans the range, so that no part of it is ruled out.
    """

    def __init__(self, observed: Sequence[float], low: float, high: float):
        self.low, self.high = low, high
        whole = high - low
        points = sorted([*observed, (low + high) / 2])
        middle = points.index((low + high) / 2)
        narrowest = whole / min(100, 1 + len(points))
        self.parts = []
        for i, x in enumerate(points):
            before = x - (points[i - 1] if i else low)
            after = (points[i + 1] if i + 1 < len(points) else high) - x
            width = whole if i == middle else min(max(before, after, narrowest), whole)
            inside = self._below((high - x) / width) - self._below((low - x) / width)
            self.parts.append((x, width, inside))

    @staticmethod
    def _below(z: float) -> float:
        return 0.5 * (1 + math.erf(z / math.sqrt(2)))

    def draw(self, rng: random.Random) -> float:
        x, width, _ = rng.choice(self.parts)
        for _ in range(100):
            drawn = rng.gauss(x, width)
            if self.low <= drawn <= self.high:
                return drawn
        return x

    def log_density(self, at: float) -> float:
        total = sum(math.exp(-0.5 * ((at - x) / width) ** 2) / (width * inside) for x, width, inside in self.parts)
        return math.log(max(total, 1e-300) / len(self.parts))


Point = dict[str, float]


def random_point(space: Sequence[Dimension], rng: random.Random) -> Point:
    return {d.name: d.outer(rng.uniform(*d.span)) for d in space}


def suggest(done: Sequence[tuple[Point, float]], space: Sequence[Dimension], rng: random.Random) -> Point:
    """The next point to try, from the points tried and their values; less is better."""
    known = [(p, v) for p, v in done if math.isfinite(v)]
    if len(known) < STARTUP:
        return random_point(space, rng)
    ranked = sorted(known, key=lambda trial: trial[1])
    split = min(math.ceil(GOOD_SHARE * len(ranked)), GOOD_MOST)
    good, rest = ranked[:split], ranked[split:]
    point = {}
    for d in space:
        likely = Parzen([d.inner(p[d.name]) for p, _ in good], *d.span)
        unlikely = Parzen([d.inner(p[d.name]) for p, _ in rest], *d.span)
        drawn = [likely.draw(rng) for _ in range(POINTS)]
        point[d.name] = d.outer(max(drawn, key=lambda x: likely.log_density(x) - unlikely.log_density(x)))
    return point


TRIAL_SCHEMA = "trial int, params string, value double, seconds double, folds string"


class Study:
    """Trials over boosting parameters, kept in a table under ``path``."""

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        base: BoostParams = BoostParams(),
        space: Sequence[Dimension] = SPACE,
        seed: int = 42,
    ):
        self.spark, self.path, self.base, self.space, self.seed = spark, path, base, tuple(space), seed
        # An empty first write makes the table readable before its first trial.
        spark.createDataFrame([], TRIAL_SCHEMA).write.mode("append").parquet(path)

    def table(self) -> DataFrame:
        return self.spark.read.schema(TRIAL_SCHEMA).parquet(self.path)

    def trials(self) -> list[tuple[int, BoostParams, float]]:
        """Trials that ended, in order: a row each, of which there are few."""
        rows = self.table().orderBy("trial").collect()
        return [(r["trial"], BoostParams.from_json(r["params"]), r["value"]) for r in rows]

    def best(self) -> BoostParams:
        done = [t for t in self.trials() if math.isfinite(t[2])]
        if not done:
            raise ValueError("no trial has ended")
        return min(done, key=lambda t: (t[2], t[0]))[1]

    def ask(self, done: Sequence[tuple[int, BoostParams, float]], trial: int) -> BoostParams:
        rng = random.Random(f"{self.seed}|{trial}")
        points = [({d.name: getattr(p, d.name) for d in self.space}, v) for _, p, v in done]
        return replace(self.base, **suggest(points, self.space, rng))

    def tell(self, trial: int, params: BoostParams, value: float, seconds: float, folds: list) -> None:
        row = [(trial, params.to_json(), value, seconds, json.dumps(folds))]
        self.spark.createDataFrame(row, TRIAL_SCHEMA).coalesce(1).write.mode("append").parquet(self.path)

    def search(
        self,
        objective: Callable[[list[BoostParams]], list[tuple[float, list]]],
        trials: int,
        seconds: float | None = None,
        at_once: int = 1,
    ) -> BoostParams:
        """Run trials until ``trials`` are in the table or ``seconds`` have passed.

        ``at_once`` trials are asked for together and evaluated side by side.
        """
        began = time.monotonic()
        done = self.trials()
        while len(done) < trials and (seconds is None or not done or time.monotonic() - began < seconds):
            first = max((t for t, _, _ in done), default=-1) + 1
            asked = [self.ask(done, first + i) for i in range(min(at_once, trials - len(done)))]
            started = time.monotonic()
            results = objective(asked)
            spent = (time.monotonic() - started) / len(asked)
            for i, (params, (value, folds)) in enumerate(zip(asked, results, strict=True)):
                self.tell(first + i, params, value, spent, folds)
                done.append((first + i, params, value))
        return self.best()

    def run(
        self,
        matrix: DataFrame,
        features: Sequence[str],
        category: str | None,
        keys: Sequence[str],
        fold_ids: Iterable[int] = range(10),
        trials: int = 50,
        seconds: float | None = 21_600,
        at_once: int = 1,
    ) -> BoostParams:
        """Search for the least mean fold RMSE; the rows are binned once for all trials."""
        data = boosting.prepare(matrix, features, category, keys, self.base.max_bins)
        folds = list(fold_ids)

        def objective(candidates: list[BoostParams]) -> list[tuple[float, list]]:
            results = boosting.cross_validate(data, candidates, folds)
            return [(sum(f["rmse"] for f in own) / len(own), own) for own in results]

        return self.search(objective, trials, seconds, at_once)

    def fold_table(self) -> DataFrame:
        """(trial, params, fold, rows, rmse, mse, rounds): a row per trial and fold."""
        kind = "array<struct<fold: int, rows: long, mse: double, rmse: double, rounds: int>>"
        return self.table().selectExpr("trial", "params", f"inline(from_json(folds, '{kind}'))").select(
            "trial", "params", "fold", "rows", "rmse", "mse", "rounds"
        )
