"""A report's result: statistics, table dictionary and display projection."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldtally.functions.semantics import INFINITY
from fieldtally.plans.layouts import AVERAGE, COUNT, LAYOUTS, SHARE

MISSING_MARK = "---"

MANIFEST_SCHEMA = "number long, version string, report string"

DICTIONARY_SCHEMA = T.StructType(
    [
        T.StructField("report", T.StringType(), False),
        T.StructField("title", T.StringType(), True),
        T.StructField("position", T.IntegerType(), False),
        T.StructField("statistic", T.StringType(), False),
        T.StructField("label", T.StringType(), False),
        T.StructField("spanner", T.StringType(), True),
        T.StructField("kind", T.StringType(), False),
        T.StructField("footnote", T.StringType(), True),
    ]
)


def format_cell(value: Column, kind: str) -> Column:
    """Text of one cell: counts as they are, shares in percent, one decimal."""
    if kind == COUNT:
        # Whole numbers without separators, also where answers are stored as doubles.
        text = F.translate(F.format_number(value, 0), ",", "")
    elif kind == SHARE:
        text = F.format_number(value * 100, 1)
    elif kind == AVERAGE:
        text = F.format_number(value, 1)
    else:
        raise ValueError(f"unknown cell kind {kind!r}")
    if kind != COUNT:
        text = (
            F.when(value == INFINITY, F.lit("Inf"))
            .when(value == -INFINITY, F.lit("-Inf"))
            .otherwise(text)
        )
    return F.coalesce(text, F.lit(MISSING_MARK))


@dataclass(frozen=True)
class ReportColumn:
    name: str
    label: str
    kind: str
    spanner: str | None = None
    footnote: str | None = None


@dataclass(frozen=True)
class MonitoringTable:
    """``stats`` holds the numbers; everything else is derived on demand."""

    report: str
    title: str | None
    group_var: str
    stats: DataFrame
    columns: tuple[ReportColumn, ...]

    def dictionary(self) -> DataFrame:
        """Labels, spanners, kinds and footnotes: one row per column."""
        rows = [
            (self.report, self.title, i, c.name, c.label, c.spanner, c.kind, c.footnote)
            for i, c in enumerate(self.columns, start=1)
        ]
        return self.stats.sparkSession.createDataFrame(rows, DICTIONARY_SCHEMA)

    def display(self) -> DataFrame:
        """Formatted cells in group order, the NULL group last."""
        cells = [format_cell(F.col(c.name), c.kind).alias(c.name) for c in self.columns]
        return self.stats.orderBy(F.col(self.group_var).asc_nulls_last()).select(
            F.coalesce(F.col(self.group_var).cast("string"), F.lit(MISSING_MARK)).alias(
                self.group_var
            ),
            *cells,
        )

    def labelled_cells(self) -> DataFrame:
        """One row per cell: group, statistic, number, formatted text and labels."""
        cells = F.array(
            *(
                F.struct(
                    F.lit(c.name).alias("statistic"),
                    F.lit(c.label).alias("label"),
                    F.lit(c.spanner).cast("string").alias("spanner"),
                    F.lit(c.kind).alias("kind"),
                    F.col(c.name).cast("double").alias("value"),
                    format_cell(F.col(c.name), c.kind).alias("text"),
                )
                for c in self.columns
            )
        )
        return self.stats.select(self.group_var, F.inline(cells))

    def write(self, path: str, mode: str = "error") -> str:
        """Store numbers and dictionary as one version of a report; returns its folder.

        The first version lies in ``path`` itself, later ones below ``path/versions``.
        Only when both parts are written, one line is appended to ``path/manifest``,
        which ``read_report`` follows, so readers see the whole new report or the former
        one. A write that fails leaves files that nothing refers to. ``mode`` is "error",
        which refuses a path that holds a report, or "overwrite".
        """
        if mode not in ("error", "overwrite"):
            raise ValueError(f"unknown mode {mode!r}, expected 'error' or 'overwrite'")
        spark = self.stats.sparkSession
        former = _newest(spark, path)
        if former is not None and mode == "error":
            raise FileExistsError(f"{path}: a report already exists")
        fresh = former is None and not _exists(spark, f"{path}/dictionary")
        version = "." if fresh else f"versions/{uuid.uuid4().hex}"
        folder = path if fresh else f"{path}/{version}"
        self.dictionary().coalesce(1).write.parquet(f"{folder}/dictionary")
        self.stats.write.parquet(f"{folder}/stats")
        number = 0 if former is None else former["number"] + 1
        entry = spark.createDataFrame([(number, version, self.report)], MANIFEST_SCHEMA)
        entry.coalesce(1).write.mode("append").json(f"{path}/manifest")
        return folder


def _exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.text(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def _newest(spark: SparkSession, path: str) -> Row | None:
    """The manifest's last line; of equal numbers, written at the same time, one wins."""
    if not _exists(spark, f"{path}/manifest"):
        return None
    manifest = spark.read.schema(MANIFEST_SCHEMA).json(f"{path}/manifest")
    return manifest.orderBy(F.desc("number"), F.desc("version")).first()


def read_report(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Numbers and dictionary of the newest complete report below ``path``."""
    entry = _newest(spark, path)
    if entry is None:
        raise FileNotFoundError(f"no report in {path}")
    folder = path if entry["version"] == "." else f"{path}/{entry['version']}"
    return spark.read.parquet(f"{folder}/stats"), spark.read.parquet(f"{folder}/dictionary")


def monitoring_table(
    report: str,
    group_var: str,
    stats: DataFrame,
    options: Sequence[tuple[str, str]] = (),
    title: str | None = None,
    fill: Mapping[str, str] | None = None,
) -> MonitoringTable:
    """Bind statistics to their layout.

    ``options`` lists (column, heading) of the answer-option columns; ``fill``
    completes labels the caller chooses.  A layout's title names the group.
    """
    layout = LAYOUTS[report]
    spanner_of = {c: s for s, names in layout.spanners.items() for c in names}

    def notes(name: str) -> str | None:
        own = layout.footnotes.get(name)
        shared = layout.footnotes.get(spanner_of.get(name, ""))
        return " ".join(n for n in (own, shared) if n) or None

    columns = [
        ReportColumn(
            name=name,
            label=label.format(**(fill or {})),
            kind=kind,
            spanner=spanner_of.get(name),
            footnote=notes(name),
        )
        for name, (label, kind) in layout.columns.items()
        if name in stats.columns
    ]
    columns += [
        ReportColumn(name=name, label=text, kind=SHARE, spanner=layout.options)
        for name, text in options
    ]
    heading = layout.title.format(group=group_var) if layout.title else title
    return MonitoringTable(report, heading, group_var, stats, tuple(columns))
