"""Central run settings (paths, window, series dimension, thresholds).

Nothing else in the package holds table names, paths or calendar literals:
every operator takes them as parameters, and ``Settings`` is the one place a
run declares them.
"""

from __future__ import annotations

import dataclasses
import re
from dataclasses import dataclass


# A period in a file name: one or two years, each with or without a month.
_PERIOD = r"(19|20)[0-9]{2}([_-]?(0[1-9]|1[0-2]))?"


def file_pattern(name: str) -> str:
    """``name.json``, or ``name``, a delimiter and a period (years or months), ``.json``.

    Another number is another index: ``ipca-15.json`` is not a part of ``ipca``.
    """
    return rf"(^|/){re.escape(name)}([_-]{_PERIOD}([_-]{_PERIOD})?)?\.json$"


@dataclass(frozen=True)
class SeriesSpec:
    """One published series and the landing files that carry it.

    ``file_pattern`` is a Java regular expression matched (``rlike``) against
    the full path of the landing file. The default takes the exact name or the
    name, a delimiter and a period: ``selic.json`` and the backfill files
    ``selic_2015_2019.json`` and ``selic-202401.json`` are one series,
    ``selic_meta.json``, ``selic-432.json``, ``ipca15.json`` and
    ``ipca-15.json`` are none.
    """

    series_id: int
    name: str
    granularity: str
    unit: str
    file_pattern: str
    domain: tuple[float, float]


# The two published series, their ids, names, granularity
# labels, units, landing file names and plausible value domains (in percent).
#   policy rate: id 11,  name "selic", granularity "diaria", unit "% a.d.",
#                file "selic.json", domain [0, 1]
#   inflation:   id 433, name "ipca",  granularity "mensal", unit "% a.m.",
#                file "ipca.json",  domain [-5, 10]
POLICY_SERIES = SeriesSpec(
    series_id=11,
    name="selic",
    granularity="diaria",
    unit="% a.d.",
    file_pattern=file_pattern("selic"),
    domain=(0.0, 1.0),
)
INFLATION_SERIES = SeriesSpec(
    series_id=433,
    name="ipca",
    granularity="mensal",
    unit="% a.m.",
    file_pattern=file_pattern("ipca"),
    domain=(-5.0, 10.0),
)
DEFAULT_SERIES: tuple[SeriesSpec, ...] = (POLICY_SERIES, INFLATION_SERIES)

# Raw payload format and the stored value type.
RAW_DATE_FORMAT = "dd/MM/yyyy"
VALUE_TYPE = "decimal(18,8)"


def months_between_inclusive(first_month: str, last_month: str) -> int:
    """Number of calendar months in ``[first_month, last_month]`` (``yyyy-MM``)."""
    y0, m0 = (int(p) for p in first_month.split("-"))
    y1, m1 = (int(p) for p in last_month.split("-"))
    return (y1 - y0) * 12 + (m1 - m0) + 1


@dataclass(frozen=True)
class Settings:
    """Everything a run needs: where data lives and what "correct" means."""

    root: str  # folder that holds landing/, tables/ and checkpoints/
    series: tuple[SeriesSpec, ...] = DEFAULT_SERIES
    policy_series: str = POLICY_SERIES.name
    inflation_series: str = INFLATION_SERIES.name
    # Calendar window the extraction covers; the completeness checks use it.
    first_month: str = "2020-01"
    last_month: str = "2024-12"
    # Landing reader.
    file_glob: str = "*.json"
    multi_line: bool = True
    # Bounds each micro-batch of the availableNow drain (None: all pending files).
    max_files_per_trigger: int | None = None
    # A file this much older than the newest one seen would be skipped for ever;
    # the default never skips, as late corrections and backfills keep old times.
    max_file_age: str = "36500d"
    # Folder to which the stream moves files that it has read (None: they stay in
    # the landing folder, which each run then lists whole). Outside of landing/.
    archive: str | None = None
    raw_date_format: str = RAW_DATE_FORMAT
    value_type: str = VALUE_TYPE
    # Gold.
    rolling_months: int = 12
    rolling_gate: str = "rows"  # "rows" (reference rule) or "factors"
    rolling_frame: str = "rows"  # "rows" or "months" (calendar RANGE frame)
    gold_strategy: str = "onepass"  # "onepass" or "join"
    # Silver: "incremental" streams only new Bronze files through foreachBatch;
    # "batch" re-conforms all of Bronze each run (published behaviour).
    silver_mode: str = "incremental"
    # Silver folders: one per year of the observation and bucket of the series.
    # More buckets make smaller rewrites; one is enough for few series.
    silver_buckets: int = 1
    # "incremental": Gold recomputes the months that a merge touched and those
    # whose window holds them, from Silver's month totals; "rebuild": all of it
    # from Silver each run (published behaviour).
    gold_mode: str = "incremental"
    # "after_commit": checks run on the stored table (published order);
    # "before_commit": rows are stored only once the checks on the table they
    # would make hold. The rules look at a whole run, so this needs
    # silver_mode="batch": a micro-batch alone is never complete.
    gate_mode: str = "after_commit"
    # Catalog schema to name the tables in ("<database>.silver"); None: paths only.
    database: str | None = None
    # Quality thresholds.
    min_policy_days_per_month: int = 15
    fisher_tolerance: float = 1e-6  # in fraction units, not percentage points

    def __post_init__(self):
        if self.silver_mode not in ("incremental", "batch"):
            raise ValueError(f"silver_mode must be 'incremental' or 'batch', not {self.silver_mode!r}")
        if self.gold_mode not in ("incremental", "rebuild"):
            raise ValueError(f"gold_mode must be 'incremental' or 'rebuild', not {self.gold_mode!r}")
        if self.silver_buckets < 1:
            raise ValueError("silver_buckets must be at least 1")
        if self.gate_mode not in ("after_commit", "before_commit"):
            raise ValueError(f"gate_mode must be 'after_commit' or 'before_commit', not {self.gate_mode!r}")
        if self.gate_mode == "before_commit" and self.silver_mode != "batch":
            raise ValueError("gate_mode='before_commit' needs silver_mode='batch'")

    # -- derived locations -------------------------------------------------
    @property
    def landing(self) -> str:
        return f"{self.root.rstrip('/')}/landing"

    @property
    def checkpoints(self) -> str:
        # Kept apart from the landing area so a checkpoint is never read as input.
        return f"{self.root.rstrip('/')}/checkpoints"

    @property
    def bronze_path(self) -> str:
        return f"{self.root.rstrip('/')}/tables/bronze"

    @property
    def resent_path(self) -> str:
        # Rows of files that changed under their old name, read by batch.
        return f"{self.bronze_path}_resent"

    @property
    def ledger_path(self) -> str:
        return f"{self.bronze_path}_files"

    @property
    def silver_path(self) -> str:
        return f"{self.root.rstrip('/')}/tables/silver"

    @property
    def gold_path(self) -> str:
        return f"{self.root.rstrip('/')}/tables/gold"

    @property
    def bronze_checkpoint(self) -> str:
        return f"{self.checkpoints}/bronze"

    @property
    def expected_months(self) -> int:
        return months_between_inclusive(self.first_month, self.last_month)

    @property
    def first_date(self) -> str:
        return f"{self.first_month}-01"

    @property
    def last_date(self) -> str:
        """Last calendar day of ``last_month`` as ``yyyy-MM-dd``."""
        import calendar

        y, m = (int(p) for p in self.last_month.split("-"))
        return f"{y:04d}-{m:02d}-{calendar.monthrange(y, m)[1]:02d}"

    def series_by_name(self, name: str) -> SeriesSpec:
        for s in self.series:
            if s.name == name:
                return s
        raise KeyError(name)

    def with_(self, **changes) -> "Settings":
        return dataclasses.replace(self, **changes)
