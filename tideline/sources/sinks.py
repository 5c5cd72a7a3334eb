"""Writers for folders and catalog tables: replace, append, append once, swap partitions, CSV, report."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.functions.dates import at
from tideline.operators.sets import if_empty
from tideline.session import materialise
from tideline.sources.versions import Folder, Journal, Replacement, current


def conform(df: DataFrame, schema: T.StructType, stamp: dict[str, datetime] | None = None) -> DataFrame:
    """Named columns in schema order; unlisted ones become NULL or the given time stamp."""
    cols = []
    for f in schema.fields:
        if f.name in df.columns:
            cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
        elif stamp and f.name in stamp:
            cols.append(at(stamp[f.name]).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(*cols)


def _catalog(path: str) -> str | None:
    """Name of a catalog table, for targets given as ``table:db.name``."""
    return path.removeprefix("table:") if path.startswith("table:") else None


def _insert(df: DataFrame, name: str, overwrite: bool) -> None:
    """Into a catalog table of any provider, columns by name; overwriting swaps the partitions that ``df`` holds."""
    df.select(*df.sparkSession.table(name).columns).write.option("partitionOverwriteMode", "dynamic").insertInto(name, overwrite=overwrite)


def replace(df: DataFrame, path: str, partition_by: Sequence[str] = (), reads_target: bool = False) -> None:
    """Create or replace a table.

    A folder gets a new version that goes live by one commit (see ``versions``): a writer that dies leaves the old rows
    in place, and one that was overtaken fails. A catalog table is replaced as a whole; when the frame reads its own
    target, the rows are first written to the shared folder.
    """
    if name := _catalog(path):
        out = materialise(df) if reads_target else df
        out.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*partition_by).saveAsTable(name)
        return
    version = Replacement(df.sparkSession, path)
    df.write.partitionBy(*partition_by).parquet(version.path)
    version.commit()


def append(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    if name := _catalog(path):
        if df.sparkSession.catalog.tableExists(name):
            _insert(df, name, overwrite=False)
        else:
            df.write.partitionBy(*partition_by).saveAsTable(name)
        return
    df.write.mode("append").partitionBy(*partition_by).parquet(current(df.sparkSession, path))


def append_once(df: DataFrame, path: str, run: str, partition_by: Sequence[str] = ()) -> bool:
    """Append the rows of a run to a folder exactly once; False when the run is logged already.

    Rows are written aside, the run is marked ready, its files move into the table, the run is marked done. A run that
    died before it was ready is written anew, one that died later goes on moving, a finished one does nothing. A run
    without rows leaves no mark.
    """
    spark = df.sparkSession
    if _catalog(path):
        raise ValueError("append_once needs a folder; a catalog table has transactions of its own or uses append")
    table, steps = Folder(spark, path), Journal(spark, f"{path}/_runs", run)
    if steps.done("done"):
        return False
    aside = f"_runs/{run}/data"
    if not steps.done("ready"):
        df.write.mode("overwrite").partitionBy(*partition_by).parquet(table.at(aside))
        if spark.read.schema(df.schema).parquet(table.at(aside)).isEmpty():
            return False
        steps.mark("ready")
    live = current(spark, path)
    for file in table.files(aside):
        folder, _, name = file.rpartition("/")
        table.move(f"{aside}/{file}", "/".join(x for x in (live, folder, f"{run}-{name}") if x))
    steps.mark("done")
    table.delete(aside)
    return True


def replace_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Delete-by-key then insert in one step: only partitions present in ``df`` are swapped."""
    if name := _catalog(path):
        if df.sparkSession.catalog.tableExists(name):
            _insert(df, name, overwrite=True)
        else:
            df.write.partitionBy(*partition_by).saveAsTable(name)
        return
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(*partition_by).parquet(current(df.sparkSession, path)))


def write_csv(df: DataFrame, path: str) -> None:
    """Small export (weights): one file with a header."""
    df.coalesce(1).write.mode("overwrite").csv(path, header=True)


def write_report(df: DataFrame, path: str) -> None:
    """One-row run report as JSON."""
    df.coalesce(1).write.mode("append").json(path)


def seed_if_empty(table: DataFrame, seed: DataFrame) -> DataFrame:
    """The table, or the seed when the table holds nothing."""
    return table.unionByName(if_empty(seed, table))


def add_missing(table: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Rows of ``new`` whose key is not there yet, ready to append."""
    return new.join(table.select(key), key, "left_anti").select(*new.columns)


def upsert(table: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Table after deleting the keys of ``new`` and inserting ``new``."""
    kept = table.join(new.select(key).distinct(), key, "left_anti").select(*table.columns)
    return kept.unionByName(new, allowMissingColumns=True)
