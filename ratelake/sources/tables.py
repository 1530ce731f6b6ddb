"""Stored layer tables: plain Parquet folders, optionally named in the catalog.

An upsert reads and rewrites only the folders it changes (dynamic partition
overwrite). Folders are named by expressions of the key, so a key's old row is
always in a folder that the source's rows name. A write that dies half-way is
repaired by running it again, because the upsert is idempotent; one run writes
at a time. A table may keep a *state*: a small summary with the same folders,
rewritten for the folders that a merge changes (before the rows, so that a run
that died between the two writes it again).

A versioned table is replaced as a whole: each version has a folder of its own
and a pointer names the current one, so readers see the old version until the
new one is complete. Each write adds a row to an audit folder beside the table,
which nothing but reports and the incremental steps read. Where the catalog
holds a table that supports row-level operations,
``operators.upsert.merge_into`` does the merge there.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratelake.operators.upsert import CHANGE, VALUES_CHANGED, assert_unique_keys, change_counts, merge_changes
from ratelake.schemas import AUDIT, COLUMN_TEXTS
from ratelake.session import path_exists, put_text, read_text, remove_path, written_once

Accept = Callable[[DataFrame], bool]


def sql_text(text: str) -> str:
    """A string literal of Spark SQL."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


class StoredTable:
    """``layout``: folder name -> SQL expression of key columns. ``summary``:
    rows of whole folders -> their state rows, which keep the layout's columns."""

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: T.StructType,
        layout: Mapping[str, str] | None = None,
        name: str | None = None,
        text: str | None = None,
        versioned: bool = False,
        summary: Callable[[DataFrame], DataFrame] | None = None,
        summary_schema: str | None = None,
    ):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.layout, self.name, self.text = dict(layout or {}), name, text
        self.versioned, self.summary, self.summary_schema = versioned, summary, summary_schema
        self.audit_path, self.state_path = f"{self.path}_audit", f"{self.path}_state"
        if versioned and layout:
            raise ValueError("a versioned table is replaced as a whole: it has no folders of its own")

    # -- reading
    def location(self) -> str | None:
        """The folder that holds the rows; None while there is no table."""
        if self.versioned:
            current = read_text(self.spark, f"{self.path}/_current")
            return f"{self.path}/{current.strip()}" if current else None
        return self.path if path_exists(self.spark, self.path) else None

    def exists(self) -> bool:
        return self.location() is not None

    def read(self) -> DataFrame:
        return self._stored().select(*self.schema.names)

    def _stored(self) -> DataFrame:
        """Rows with the layout's columns, by which folders can be left out."""
        at = self.location()
        if at is None:
            return self._placed(self.spark.createDataFrame([], self.schema))
        schema = T.StructType([*self.schema.fields, *[T.StructField(c, T.IntegerType()) for c in self.layout]])
        return self.spark.read.schema(schema).parquet(at)

    def _placed(self, rows: DataFrame) -> DataFrame:
        return rows.select("*", *[F.expr(e).cast("int").alias(c) for c, e in self.layout.items()])

    def state(self) -> DataFrame | None:
        """The summary of the stored rows; None if the table keeps none yet."""
        if not self.summary or not path_exists(self.spark, self.state_path):
            return None
        return self.spark.read.schema(self.summary_schema).parquet(self.state_path)

    def recount(self) -> None:
        """Write the whole state anew from the stored rows."""
        rows = self._stored()
        self.summary(rows).write.mode("overwrite").partitionBy(*self.layout).parquet(self.state_path)

    def count(self) -> int:
        return self.read().count()  # from the file footers

    def audit(self) -> DataFrame:
        """written_at, operation, metrics of every write."""
        if not path_exists(self.spark, self.audit_path):
            return self.spark.createDataFrame([], AUDIT)
        return self.spark.read.schema(AUDIT).parquet(self.audit_path)

    def history(self) -> DataFrame:
        """The audit rows numbered from 0 (a few rows per run: one small sort)."""
        number = F.row_number().over(Window.orderBy("written_at")) - 1
        return self.audit().select(number.cast("bigint").alias("version"), "*")

    # -- writing
    def _publish(self, new_folders: Sequence[Mapping[str, int]] = ()) -> None:
        """Make the catalog's table, if one is named, show the current folder, columns and partitions."""
        if not self.name:
            return
        at, spark = sql_text(self.location()), self.spark
        fields = [*self.schema.fields, *[T.StructField(c, T.IntegerType()) for c in self.layout]]
        known = spark.catalog.tableExists(self.name)
        if known:
            have = [(f.name, f.dataType) for f in spark.table(self.name).schema]
            if have != [(f.name, f.dataType) for f in fields]:
                spark.sql(f"DROP TABLE {self.name}")  # external: the rows stay
                known = False
        if not known:
            cols = ", ".join(
                f"`{f.name}` {f.dataType.simpleString()}"
                + (f" COMMENT {sql_text(COLUMN_TEXTS[f.name])}" if f.name in COLUMN_TEXTS else "")
                for f in fields
            )
            parts = f"PARTITIONED BY ({', '.join(self.layout)})" if self.layout else ""
            spark.sql(f"CREATE TABLE {self.name} ({cols}) USING parquet {parts} LOCATION {at}")
            if self.text:
                spark.sql(f"COMMENT ON TABLE {self.name} IS {sql_text(self.text)}")
            if self.layout:
                spark.sql(f"MSCK REPAIR TABLE {self.name}")  # once: later folders are added one by one
        elif self.versioned:
            spark.sql(f"ALTER TABLE {self.name} SET LOCATION {at}")
        elif new_folders:
            specs = " ".join("PARTITION (" + ", ".join(f"{c} = {v}" for c, v in f.items()) + ")" for f in new_folders)
            spark.sql(f"ALTER TABLE {self.name} ADD IF NOT EXISTS {specs}")
        spark.sql(f"REFRESH TABLE {self.name}")

    def _record(self, operation: str, metrics: Mapping[str, object]) -> None:
        now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        row = [(now, operation, {k: str(v) for k, v in metrics.items()})]
        self.spark.createDataFrame(row, AUDIT).coalesce(1).write.mode("append").parquet(self.audit_path)

    def _write(self, rows: DataFrame) -> list[dict]:
        """Replace the folders that ``rows`` name; these folders, if the catalog has to know them."""
        rows = self._placed(rows.select(*self.schema.names))
        by = list(self.layout)
        if not by:
            rows.write.mode("overwrite").parquet(self.path)
            return []
        if self.summary:
            state = self.summary(rows).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            state.partitionBy(*by).parquet(self.state_path)
        # few files a folder; AQE splits a folder that holds much of the rows
        w = rows.hint("rebalance", *by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        w.partitionBy(*by).parquet(self.path)
        return [r.asDict() for r in rows.select(*by).distinct().collect()] if self.name else []

    def overwrite(
        self, df: DataFrame, operation: str = "REBUILD", accept: Accept | None = None, extra: Mapping[str, object] | None = None
    ) -> dict:
        """Replace the whole table; ``accept`` sees the new rows first and may refuse them.

        A versioned table is written to a fresh folder; the pointer, and then
        the catalog, go over to it once it is complete. The version before it
        is kept for readers that are still at it, older ones go.
        """
        if accept:
            with written_once(df, "rebuild") as staged:
                if not accept(staged):
                    return {"committed": False, "rows_total": self.count()}
                return self.overwrite(staged, operation, None, extra)
        rows = df.select(*self.schema.names)
        if not self.versioned:
            rows.write.mode("overwrite").parquet(self.path)
        else:
            before, new = read_text(self.spark, f"{self.path}/_current"), f"v-{uuid.uuid4().hex}"
            rows.write.parquet(f"{self.path}/{new}")
            put_text(self.spark, f"{self.path}/_current", new)
            remove_path(self.spark, self.path, keep=("_current", new, (before or "").strip()))
        metrics = {"rows_total": self.count()}
        self._record(operation, {**metrics, **(extra or {})})
        self._publish()
        return {"committed": True, **metrics}

    def merge(
        self,
        source: DataFrame,
        keys: Sequence[str],
        newer_by: str,
        *,
        compare: Sequence[str] = (),
        check_unique: bool = True,
        accept: Accept | None = None,
        extra: Mapping[str, object] | None = None,
    ) -> dict:
        """Upsert a stored ``source``; returns the counters.

        Only partitions the source names are read for the join, and only those
        with an inserted or updated row are written: a merge that changes
        nothing writes no data file. ``accept`` sees the table as it would be
        and may refuse. A source holding a key twice is an error, as in MERGE.
        """
        if check_unique:
            assert_unique_keys(source, keys)
        if not self.exists():
            return self._first(source, accept, extra or {})
        by = list(self.layout)
        stored = self._stored()
        before = self.count()
        # the folders are a bounded list: they prune the scan
        target = stored.join(self._placed(source).select(*by).distinct(), by, "left_semi") if by else stored
        merged = merge_changes(target.select(*self.schema.names), source, keys, newer_by, compare=compare)
        with written_once(merged, "merged") as merged:
            return self._commit(merged, stored, before, accept, extra or {})

    def _commit(self, merged: DataFrame, stored: DataFrame, before: int, accept: Accept | None, extra: Mapping[str, object]) -> dict:
        """Store the written rows of a merge and record it."""
        by = list(self.layout)
        counts = change_counts(merged.select(*[c for c in (CHANGE, VALUES_CHANGED) if c in merged.columns])).first().asDict()
        counts["rows_total"] = before + counts["rows_inserted"]
        counts["rows_untouched"] = counts["rows_total"] - counts["rows_inserted"] - counts["rows_updated"] - counts["rows_matched_noop"]
        any_change = counts["rows_inserted"] + counts["rows_updated"] > 0
        rewrite, rest = merged, stored.limit(0)
        if by and any_change:
            placed = self._placed(merged)
            changed = placed.where(F.col(CHANGE).isin("inserted", "updated")).select(*by).distinct()
            rewrite, rest = placed.join(changed, by, "left_semi"), stored.join(changed, by, "left_anti")
        if accept and not accept(rest.select(*self.schema.names).unionByName(rewrite.select(*self.schema.names))):
            return {**counts, "committed": False, "rows_total": before}
        folders = self._write(rewrite) if any_change else []
        touched = merged.where(F.col(CHANGE).isin("inserted", "updated")) if any_change else None
        self._record("MERGE", {**counts, **self._span(touched), **extra})
        self._publish(folders)
        return {**counts, "committed": True}

    def _span(self, touched: DataFrame | None) -> dict:
        """First and last period of the rows that a merge changed, for tables that have periods."""
        if touched is None or "year_month" not in self.schema.names:
            return {}
        first, last = touched.agg(F.min("year_month"), F.max("year_month")).first()
        return {"first_period": first, "last_period": last}

    def _first(self, source: DataFrame, accept: Accept | None, extra: Mapping[str, object]) -> dict:
        """The first merge: every row is new, nothing has to be joined."""
        n = source.count()
        counts = dict.fromkeys(("rows_updated", "rows_matched_noop", "rows_untouched", "rows_deleted", "rows_changed"), 0)
        counts |= {"rows_inserted": n, "rows_total": n}
        if accept and not accept(source.select(*self.schema.names)):
            return {**counts, "committed": False, "rows_total": 0}
        folders = self._write(source)
        self._record("MERGE", {**counts, **self._span(source if n else None), **extra})
        self._publish(folders)
        return {**counts, "committed": True}
