"""The models in build order, and the store they are written to.

Every model is a plain function of DataFrames. Storing one as Parquet before the next
layer reads it gives Spark exact sizes, so it broadcasts a dimension only when that is
small, and it cuts the lineage at a table that survives a lost executor.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import nullcontext
from dataclasses import dataclass, field
from datetime import date
from threading import Lock

from pyspark.sql import DataFrame, SparkSession

from vigil.operators.calendar import SPINE_END, SPINE_START
from vigil.operators.lookup import RepeatedKey, guarded_rows
from vigil.plans import dimensions as dim, facts, gold, silver, summaries
from vigil.session import STORED, freed_shuffles, sized_shuffles, small_methods, stored_bytes
from vigil.sources.files import create_file, exists, remove_folder, subfolders

Table = Callable[[str], DataFrame]
_VERSION = r"v[0-9]{8}-[0-9a-f]{8}"
KEPT_VERSIONS = 2  # of each model


@dataclass(frozen=True)
class Settings:
    as_of: date = field(default_factory=date.today)
    spine_start: date = SPINE_START
    spine_end: date = SPINE_END
    spine_bounds: DataFrame | None = None  # first_day and last_day, in place of the two above


# (layer, name, builder). A builder reads landing tables and earlier models by name.
MODELS: list[tuple[str, str, Callable[[Table, SparkSession, Settings], DataFrame]]] = [
    ("silver", "slv_adam_cases", lambda t, s, c: silver.cases(t("adam_cases_raw"))),
    ("silver", "slv_adam_travellers", lambda t, s, c: silver.travellers(t("adam_travellers_raw"))),
    ("silver", "slv_lims_results", lambda t, s, c: silver.lab_results(t("lims_raw"))),
    ("silver", "slv_uhai_cases", lambda t, s, c: silver.border_cases(t("uhai_raw"))),
    ("silver", "slv_test_time",
     lambda t, s, c: silver.traveller_timestamp_profile(t("adam_travellers_raw"))),
    ("marts", "dim_date", lambda t, s, c: dim.dim_date(s, c.spine_start, c.spine_end, bounds=c.spine_bounds)),
    ("marts", "dim_epiweek", lambda t, s, c: dim.dim_epiweek(t("dim_date"), c.as_of)),
    ("marts", "dim_facilitylist", lambda t, s, c: dim.dim_facilitylist(t("facility_seed"))),
    ("marts", "dim_laboratory", lambda t, s, c: dim.dim_laboratory(t("slv_lims_results"))),
    ("marts", "dim_labtest", lambda t, s, c: dim.dim_labtest(t("slv_lims_results"))),
    ("marts", "dim_location",
     lambda t, s, c: dim.dim_location(t("slv_adam_travellers"), t("slv_uhai_cases"))),
    ("marts", "dim_point_of_entry",
     lambda t, s, c: dim.dim_point_of_entry(t("slv_adam_travellers"))),
    ("marts", "fct_case_investigation",
     lambda t, s, c: facts.case_investigations(t("slv_adam_cases"), t("dim_date"))),
    ("marts", "fct_contact_registration",
     lambda t, s, c: facts.contact_registrations(t("slv_adam_cases"), t("dim_date"))),
    ("marts", "fct_treatment_outcome",
     lambda t, s, c: facts.treatment_outcomes(t("slv_adam_cases"), t("dim_date"))),
    ("marts", "fct_screening",
     lambda t, s, c: facts.screenings(
         t("slv_adam_travellers"), t("dim_date"), t("dim_point_of_entry"))),
    ("marts", "fct_lab_result",
     lambda t, s, c: facts.lab_results(
         t("slv_lims_results"), t("dim_date"), t("dim_facilitylist"), t("dim_laboratory"),
         t("dim_labtest"))),
    ("gold", "report_case_investigation",
     lambda t, s, c: gold.case_investigation(
         t("fct_case_investigation"), t("dim_date"), t("dim_epiweek"))),
    ("gold", "report_contact_registration",
     lambda t, s, c: gold.contact_registration(t("fct_contact_registration"))),
    ("gold", "report_treatment_outcome",
     lambda t, s, c: gold.treatment_outcome(t("fct_treatment_outcome"))),
    ("gold", "report_screening",
     lambda t, s, c: gold.screening(
         t("fct_screening"), t("dim_date"), t("dim_epiweek"), t("dim_point_of_entry"))),
    ("gold", "report_lab_result",
     lambda t, s, c: gold.lab_result(
         t("fct_lab_result"), t("dim_date"), t("dim_epiweek"), t("dim_facilitylist"),
         t("dim_laboratory"))),
    ("gold", "report_case_trend",
     lambda t, s, c: summaries.case_trend(
         t("report_case_investigation"), t("report_contact_registration"),
         t("report_treatment_outcome"))),
    ("gold", "report_case_distribution",
     lambda t, s, c: summaries.case_distribution(
         t("report_case_investigation"), t("report_contact_registration"),
         t("report_treatment_outcome"))),
    ("gold", "report_screening_summary",
     lambda t, s, c: summaries.screening_summary(
         t("report_screening"), t("slv_uhai_cases"), t("dim_facilitylist"))),
    ("gold", "report_laboratory_summary",
     lambda t, s, c: summaries.laboratory_summary(t("report_lab_result"), t("dim_facilitylist"))),
    ("gold", "report_geographic_summary",
     lambda t, s, c: summaries.geographic_summary(
         t("report_case_investigation"), t("report_contact_registration"),
         t("report_treatment_outcome"), t("report_screening"), t("report_lab_result"),
         t("dim_facilitylist"), t("slv_uhai_cases"))),
]
LANDING_TABLES = ("adam_cases_raw", "adam_travellers_raw", "lims_raw", "uhai_raw")
_BY_NAME = {name: (layer, build) for layer, name, build in MODELS}


class Warehouse:
    """Landing tables plus the models stored under one root.

    Every build writes to a version folder of its own, with a folder per layer. A model is
    read from the newest version that finished writing it, which Spark's `_SUCCESS` file
    tells; so a build that fails leaves the tables before it, and readers see no gap. The
    version before the newest stays for readers that are under way. One build at a time.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        landing: Callable[[str], DataFrame],
        settings: Settings | None = None,
    ):
        self.spark, self.root, self.landing = spark, root.rstrip("/"), landing
        self.settings = settings or Settings()
        self._fresh: set[str] = set()
        self._locks = {name: Lock() for name in _BY_NAME}
        self._version: str | None = None
        self._version_lock = Lock()

    def _versions(self) -> list[str]:
        return [v for v in subfolders(self.spark, self.root) if re.fullmatch(_VERSION, v)]

    def _finished(self, name: str, versions: list[str]) -> Iterator[str]:
        """Folders of the model that were written to the end, newest first."""
        for version in reversed(versions):
            folder = f"{self.root}/{version}/{_BY_NAME[name][0]}/{name}"
            if exists(self.spark, f"{folder}/_SUCCESS"):
                yield folder

    def path(self, name: str) -> str | None:
        """Where the model is stored now; None if it is not."""
        return next(self._finished(name, self._versions()), None)

    def plan(self, name: str) -> DataFrame:
        """The model's query over upstream tables as stored, or over their queries where they
        are not. Nothing is written."""
        return _BY_NAME[name][1](self.table, self.spark, self.settings)

    def prepared(self, name: str) -> DataFrame:
        """The model's query, after writing the upstream tables that are not stored."""
        return _BY_NAME[name][1](self._filled, self.spark, self.settings)

    def table(self, name: str) -> DataFrame:
        """A landing table, or a model as it is stored; its query if it is not."""
        if name not in _BY_NAME:
            return self.landing(name)
        stored = self.path(name)
        return self.spark.read.parquet(stored) if stored else self.plan(name)

    def _filled(self, name: str) -> DataFrame:
        if name in _BY_NAME:
            with self._locks[name]:
                if not self.path(name):
                    # Silver models compute all their columns.
                    small = small_methods(self.spark) if _BY_NAME[name][0] == "silver" else nullcontext()
                    with small, freed_shuffles(self.spark):
                        self._write(name, self._filled)
        return self.table(name)

    def _refreshed(self, name: str) -> DataFrame:
        if name in _BY_NAME:
            with self._locks[name]:
                if name not in self._fresh:
                    self._write(name, self._refreshed)
                    self._fresh.add(name)
        return self.table(name)

    def _write(self, name: str, upstream: Table) -> None:
        layer, build = _BY_NAME[name]
        with guarded_rows() as guard:
            rows = build(upstream, self.spark, self.settings)
        path = f"{self.root}/{self._current()}/{layer}/{name}"
        # The table counts as written once its lookups are known to have kept its rows.
        rows.write.options(**STORED).option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(path)
        try:
            guard.check()
        except RepeatedKey as problem:
            raise RepeatedKey(f"{name}, {problem}") from None
        create_file(self.spark, f"{path}/_SUCCESS")
        for old in list(self._finished(name, self._versions()))[KEPT_VERSIONS:]:
            remove_folder(self.spark, old)

    def _current(self) -> str:
        """The version being written: the next number, and a name that no other writer has."""
        with self._version_lock:
            if self._version is None:
                last = max((int(v[1:9]) for v in self._versions()), default=0)
                self._version = f"v{last + 1:08d}-{uuid.uuid4().hex[:8]}"
            return self._version

    def build(self, names: list[str] | None = None, workers: int = 4) -> None:
        """Full refresh of the wanted models, upstream first.

        Models that do not wait for each other are written at the same time, so that small
        ones fill the gaps large ones leave on the cluster.
        """
        self._fresh.clear()
        self._version = None
        largest = max(stored_bytes(self.landing(name)) for name in LANDING_TABLES)
        wanted = [name for _, name, _ in MODELS if names is None or name in names]
        with sized_shuffles(self.spark, largest), freed_shuffles(self.spark), ThreadPoolExecutor(workers) as pool:
            list(pool.map(self._refreshed, wanted))
