"""File-to-file jobs: the documented run order over one workspace folder.

CSV and JSON at the edges, Parquet between the jobs. Every job reads what the
jobs before it stored, so any of them can be run again on its own.
"""

from __future__ import annotations

import functools
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sunledger import schemas
from sunledger.operators import search
from sunledger.operators.boosting import TUNED, BoostParams, FoldModels
from sunledger.operators.features import site_dimension
from sunledger.operators.grid import date_list
from sunledger.plans import feature_table, insolation, irradiance, questions, training, weather
from sunledger.plans import power as power_plan
from sunledger.plans.feedback import pseudo_label
from sunledger.plans.sun import sun_table
from sunledger.session import table_scope
from sunledger.sources import files, payloads, sinks

KEYS = ("LocationCode", "DateTime")


def _frees_its_tables(job):
    """A job whose results are stored under the root keeps nothing in the shared folder."""

    @functools.wraps(job)
    def scoped(self, *args, **kwargs):
        with table_scope(self.spark):
            return job(self, *args, **kwargs)

    return scoped


@dataclass
class Workspace:
    """Jobs that share ``root``; pass a folder that all executors can reach."""

    spark: SparkSession
    root: str

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def _store(self, df: DataFrame, name: str) -> DataFrame:
        sinks.write_table(df, self.path(name))
        return self.table(name)

    # --- inputs to series --------------------------------------------------

    @_frees_its_tables
    def prepare_power(self, main_glob: str, extra_glob: str | None = None) -> DataFrame:
        """Site files to one row per site and minute; repeated minutes are reported."""
        main = files.read_site_files(self.spark, main_glob, ordered=True)
        extra = files.read_site_files(self.spark, extra_glob, ordered=True) if extra_glob else None
        # The text is parsed once; the next two steps read the combined table. Of copies
        # the first in the files stays.
        firsts = power_plan.combine_power(main, extra, tie=[files.FILE_ORDER])
        combined = self._store(firsts.drop(files.FILE_ORDER), "power_combined")
        sinks.write_table(power_plan.minute_duplicates(combined), self.path("power_duplicates"))
        sinks.write_by_site(power_plan.dedup_minutes(combined), self.path("power"))
        return self.table("power")

    @_frees_its_tables
    def prepare_weather(self, csv_path: str) -> DataFrame:
        """Repaired weather rows with their place in the file: of rows at one time the
        last in the file is the one that matches."""
        raw = files.read_weather(self.spark, csv_path, ordered=True)
        return self._store(weather.repair_weather(raw, ["time", files.FILE_ORDER]), "weather")

    @_frees_its_tables
    def prepare_irradiance(self, payload_path: str) -> DataFrame:
        """Payload files to the 1-minute series; incomplete intervals and unusable
        files are kept as rejects."""
        raw = files.read_payloads(self.spark, payload_path, schemas.IRRADIANCE_PAYLOAD)
        complete, incomplete = payloads.flatten_irradiance(raw)
        sinks.write_table(incomplete, self.path("irradiance_rejects"))
        sinks.write_table(payloads.unreadable_irradiance(raw), self.path("irradiance_unreadable"))
        quarters = self._store(complete, "irradiance_15min")
        tens = self._store(irradiance.irradiance_ten_minutes(quarters), "irradiance_10min")
        return self._store(irradiance.irradiance_minutes(tens), "irradiance_1min")

    @_frees_its_tables
    def prepare_insolation(
        self, csv_path: str, start: str = insolation.START, end: str = insolation.END
    ) -> DataFrame:
        """Station export to the 1-minute series; of repeated hours the first in the file stays.

        Lines that are malformed, have no usable time, or lie outside the dates or the
        daytime are kept as rejects, and what became of all lines is counted.
        """
        lines = files.read_station_lines(self.spark, csv_path, ordered=True)
        judged = insolation.judge_station_hours(lines, start, end)
        sinks.write_table(judged.where("reason IS NOT NULL").drop(files.FILE_ORDER), self.path("insolation_rejects"))
        sinks.write_table(insolation.line_accounting(judged), self.path("insolation_lines"))
        kept = insolation.filter_station_hours(lines.drop("text"), order=[files.FILE_ORDER], start=start, end=end)
        hours = self._store(kept, "insolation_hourly")
        tens = self._store(insolation.insolation_ten_minutes(hours), "insolation_10min")
        return self._store(insolation.insolation_minutes(tens), "insolation_1min")

    @_frees_its_tables
    def prepare_sun(self, start: str = "2024-01-01", end: str = "2024-10-31", **place) -> DataFrame:
        return self._store(sun_table(date_list(self.spark, start, end, "day"), **place), "sun")

    @_frees_its_tables
    def prepare_questions(self, csv_path: str) -> DataFrame:
        """Slot questions to minute rows; serials that do not parse are kept as rejects."""
        asked = files.read_questions(self.spark, csv_path)
        sinks.write_table(questions.split_serials(asked)[1], self.path("question_rejects"))
        return self._store(questions.expand_questions(asked).drop("serial"), "question_minutes")

    # --- features, models, answers -----------------------------------------

    def _shared(self) -> feature_table.SharedSeries:
        return feature_table.SharedSeries(
            weather=self.table("weather"),
            sun=self.table("sun"),
            insolation_minutes=self.table("insolation_1min"),
            irradiance_minutes=self.table("irradiance_1min"),
            sites=site_dimension(self.spark),
        )

    @_frees_its_tables
    def build_training(self, valid_from: Mapping[int, str] | None = None) -> DataFrame:
        rows = self.table("power")
        cutoffs = feature_table.VALID_FROM if valid_from is None else valid_from
        built, rejected = feature_table.build_features(
            rows,
            self._shared(),
            weather_sequence=files.FILE_ORDER,
            valid_from=cutoffs,
            one_per_minute=True,
            stored=True,
        )
        sinks.write_rejects(rejected, self.path("training_rejects"))
        return self._store(built, "training_features")

    @_frees_its_tables
    def build_serving(self) -> DataFrame:
        # Equal questions give equal rows, so one of each is enough.
        rows = self.table("question_minutes").dropDuplicates(list(KEYS))
        order = ["DateTime", "LocationCode"]
        built, rejected = feature_table.build_features(
            rows, self._shared(), order, weather_sequence=files.FILE_ORDER, series=(), stored=True
        )
        sinks.write_rejects(rejected, self.path("serving_rejects"))
        return self._store(built, "serving_features")

    @_frees_its_tables
    def train(
        self,
        variant: str = "full",
        params: BoostParams | None = None,
        trials: int = 0,
        folds: int = 10,
        source: str = "training_features",
        seconds: float | None = None,
        null_policy: str = "drop",
    ) -> training.TrainingRun:
        """Fit a variant and store its run; with ``trials`` search the parameters first.

        The search keeps its trials in a table and goes on from them if it is started again;
        after ``seconds`` it starts no further trials.
        """
        matrix, names = training.prepare_matrix(self.table(source), variant, null_policy, folds, balanced=True)
        params = params or TUNED[variant]
        if trials:
            study = search.Study(self.spark, self.path(f"runs/{variant}/trials"), params)
            params = study.run(matrix, names, training.SITE, KEYS, range(folds), trials, seconds)
        run = training.train(matrix, names, params, range(folds))
        training.save_run(run, self.path(f"runs/{variant}"))
        return training.load_run(self.spark, self.path(f"runs/{variant}"))

    @_frees_its_tables
    def replay(
        self,
        variant: str = "full",
        mode: str = "retrain",
        source: str = "training_features",
        null_policy: str = "drop",
    ):
        run = training.replay(self.table(source), variant, self.path(f"runs/{variant}"), mode, null_policy)
        training.save_run(run, self.path(f"replays/{variant}"))
        return training.load_run(self.spark, self.path(f"replays/{variant}"))

    @_frees_its_tables
    def score(self, variant: str = "full", replayed: bool = False) -> DataFrame:
        kind = "replays" if replayed else "runs"
        models = FoldModels.load(self.path(f"{kind}/{variant}/models"))
        return training.save_scores(self.table("serving_features"), models, self.path(f"{kind}/{variant}/scores"))

    def answer(self, csv_path: str, variant: str = "full", replayed: bool = False) -> DataFrame:
        """The question file with its answers, as CSV."""
        kind = "replays" if replayed else "runs"
        predictions = self.table(f"{kind}/{variant}/scores/predictions")
        asked = files.read_questions(self.spark, csv_path)
        answered = questions.answer_questions(asked, predictions).select(
            F.col("serial").alias(schemas.SERIAL), F.col("answer_text").alias(schemas.ANSWER)
        )
        sinks.write_csv(answered, self.path(f"{kind}/{variant}/answers"))
        return answered

    @_frees_its_tables
    def add_pseudo_labels(self, variant: str = "full") -> DataFrame:
        """Training rows for the ``pseudo`` variant: measured ones and scored serving ones."""
        scores = self.path(f"runs/{variant}/scores")
        serving = self.spark.read.parquet(f"{scores}/scored_features").drop("Hour", "Minute", "Month")
        predictions = self.spark.read.parquet(f"{scores}/predictions")
        labelled = pseudo_label(self.table("training_features"), serving, predictions)
        return self._store(labelled, "pseudo_features")
