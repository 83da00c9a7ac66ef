"""A whole run that can be taken up again: every result is a stored table, and a manifest says which are done.

A run lives in a folder named after its input and spec, so a rerun on the same rows finds what is finished
and reads it, and a run on other rows or with another spec starts anew. A table counts as finished once
Spark has committed it; a group of tables once its manifest record stands.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywork.functions.columns import col
from tallywork.operators import clean, multisets, quality
from tallywork.plans.analysis import REPORT_KEYS, analyze, report
from tallywork.sources import sinks
from tallywork.sources.delimited import require_columns, require_numeric
from tallywork.sources.scratch import shuffles_dropped
from tallywork.spec import AnalysisSpec

_MANIFEST = "stage string, kind string, path string, tables array<string>"


def input_fingerprint(raw: DataFrame, spec: AnalysisSpec) -> str:
    """A name for rows and spec: two order-free sums over row hashes, their count, the schema and every field of the spec."""
    names = [col(c) for c in raw.columns]
    sums = [F.sum(F.xxhash64(F.lit(salt), *names).cast("decimal(38,0)")) for salt in (1, 2)]
    facts = raw.agg(F.count(F.lit(1)), *sums).first()
    words = "|".join([*map(str, facts), raw.schema.simpleString(), repr(spec)])
    return hashlib.sha256(words.encode()).hexdigest()[:24]


@dataclass
class Manifest:
    """Finished tables and files of one run below ``folder``."""

    spark: SparkSession
    folder: str

    def _exists(self, path: str) -> bool:
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return hadoop.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(hadoop)

    def done(self, stage: str) -> bool:
        return self._exists(f"{self.folder}/manifest/{stage}/_SUCCESS")

    def _record(self, stage: str, kind: str, path: str, tables: list[str]) -> None:
        row = self.spark.createDataFrame([(stage, kind, path, tables)], _MANIFEST)
        row.coalesce(1).write.mode("overwrite").json(f"{self.folder}/manifest/{stage}")

    def table(self, stage: str, build: Callable[[], DataFrame]) -> DataFrame:
        """The stored table of a stage; ``build`` is called only where it is not finished."""
        path = f"{self.folder}/tables/{stage}"
        if not self._exists(f"{path}/_SUCCESS"):
            built = build()
            with shuffles_dropped(self.spark):
                built.write.mode("overwrite").option("compression", "zstd").parquet(path)
        if not self.done(stage):
            self._record(stage, "table", path, [stage])
        return self.spark.read.parquet(path)

    def file(self, stage: str, write: Callable[[str], str]) -> str:
        """A file of the run, written only where it is not finished."""
        path = f"{self.folder}/files/{stage}"
        if not self.done(stage):
            write(path)
            self._record(stage, "file", path, [])
        return path

    def group(self, stage: str, build: Callable[[], dict[str, DataFrame]]) -> dict[str, DataFrame]:
        """Tables that are built together. A rerun builds the group again if it was not finished, but stores only what is missing."""
        if not self.done(stage):
            found = build()
            for name, table in found.items():
                self.table(name, lambda table=table: table)
            self._record(stage, "group", f"{self.folder}/tables", sorted(found))
        names = self.spark.read.schema(_MANIFEST).json(f"{self.folder}/manifest/{stage}").first()["tables"]
        return {name: self.spark.read.parquet(f"{self.folder}/tables/{name}") for name in names}

    def contents(self) -> DataFrame:
        """``stage, kind, path, tables`` of what is finished."""
        return self.spark.read.schema(_MANIFEST).json(f"{self.folder}/manifest/*")


def run_analysis(
    raw: DataFrame,
    spec: AnalysisSpec,
    out: str,
    other: DataFrame | None = None,
    models: bool = True,
    charts: bool = True,
    stored_raw: bool = False,
) -> tuple[dict[str, DataFrame], Manifest]:
    """All results of :func:`analyze`, stored, with the end products of a run: (tables by name, manifest).

    ``raw`` must have the spec's columns and numbers where the spec says so. Beside the tables there are the cleaned rows as
    compressed delimited text, the tidy report, with ``other`` (a second load of the same data) the reconciliation by facts and
    by hash ranges, and with ``models`` the chosen model's description as JSON. Run again after a failure, finished
    tables and files are read, not made. ``stored_raw`` tells whether ``raw`` is a scan, so that only rows that occur
    more than once are moved to clean it.
    """
    require_columns(raw, list(dict.fromkeys([*spec.key, *spec.numeric, *spec.categorical, spec.target])))
    require_numeric(raw, list(spec.numeric))
    manifest = Manifest(raw.sparkSession, f"{out.rstrip('/')}/{input_fingerprint(raw, spec)}")
    cleaner = clean.clean_scan if stored_raw else clean.clean
    cleaned = manifest.table("cleaned", lambda: cleaner(raw, spec.target, spec.numeric))
    manifest.file("cleaned_csv", lambda path: sinks.write_csv(cleaned, path, mode="overwrite", packed=True))
    tables = {"cleaned": cleaned}
    if other is not None:
        tables["reconciliation"] = manifest.table("reconciliation", lambda: quality.reconcile(raw, other, spec.key_missing, spec.target))
        tables["reconciled_ranges"] = manifest.table("reconciled_ranges", lambda: multisets.compare_ranges(raw, other, raw.columns))
    tables |= manifest.group("results", lambda: analyze(raw, spec, models=False, charts_too=False, cleaned=cleaned, all_read=True).results)
    if charts:
        tables |= manifest.group("charts", lambda: _only("chart_", analyze(raw, spec, models=False, cleaned=cleaned).results))
    if models:
        tables |= manifest.group("models", lambda: _others(tables, analyze(raw, spec, charts_too=False, cleaned=cleaned).results))
        manifest.file("model_metadata_json", lambda path: sinks.write_json(tables["model_metadata"], path, mode="overwrite"))
    sections = [name for name in REPORT_KEYS if name in tables]
    tables["report"] = manifest.table("report", lambda: report(tables, sections))
    return tables, manifest


def _only(prefix: str, results: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {name: table for name, table in results.items() if name.startswith(prefix)}


def _others(known: dict[str, DataFrame], results: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {name: table for name, table in results.items() if name not in known}
