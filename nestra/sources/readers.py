"""Sources: Parquet directories, Arrow IPC files and catalogues of tables."""

from __future__ import annotations

import os
from collections.abc import Iterable, Mapping

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nestra import schema

SCHEMAS = {
    "particles": schema.PARTICLES, "calo_hits": schema.CALO_HITS, "tracks": schema.TRACKS, "tracker_hits": schema.TRACKER_HITS, "calibration": schema.CALIBRATION, "pdg_names": schema.PDG_NAMES,
}


def read_table(spark: SparkSession, path: str, name: str | None = None) -> DataFrame:
    """A Parquet file or directory; with ``name`` under that table's schema, so that no file is opened to infer it."""
    reader = spark.read
    return (reader.schema(SCHEMAS[name]) if name else reader).parquet(path)


def read_catalogue(spark: SparkSession, root: str, names: Iterable[str] = ("particles", "tracker_hits", "calo_hits", "tracks"), n_events: int | None = None) -> dict[str, DataFrame]:
    """The tables ``<root>/<name>.parquet``; with ``n_events`` only the rows of the smallest event_ids of each table."""
    out = {}
    for name in names:
        df = read_table(spark, f"{root}/{name}.parquet")
        if n_events is not None:
            ids = df.select("event_id").distinct().orderBy("event_id").limit(n_events)
            df = df.join(ids, "event_id", "left_semi")
        out[name] = df
    return out


def _record_batches(path: str):
    with pa.memory_map(path) as source:
        try:
            with pa.ipc.open_stream(source) as reader:
                yield from reader
                return
        except pa.ArrowInvalid:
            source.seek(0)
        with pa.ipc.open_file(source) as reader:
            for k in range(reader.num_record_batches):
                yield reader.get_batch(k)


def _arrow_schema(path: str) -> pa.Schema:
    with pa.memory_map(path) as source:
        try:
            return pa.ipc.open_stream(source).schema
        except pa.ArrowInvalid:
            source.seek(0)
            return pa.ipc.open_file(source).schema


def read_arrow_files(spark: SparkSession, paths: Iterable[str]) -> DataFrame | None:
    """Arrow IPC files (stream or file format) as one frame; missing files are passed over, None if there is no file.

    Executors read the files, one task per file, so the paths must be on storage they share.
    """
    there = [p for p in paths if os.path.exists(p)]
    if not there:
        return None
    kind = spark.createDataFrame(_arrow_schema(there[0]).empty_table()).schema
    files = spark.createDataFrame([(p,) for p in there], "path string").repartition(len(there), "path")

    def load(batches):
        for b in batches:
            for path in b.column(0).to_pylist():
                yield from _record_batches(path)

    return files.mapInArrow(load, kind)


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Columns picked and renamed by a map (branch -> column); branches that are missing are an error."""
    schema.require_columns(df, *names)
    return df.select(*[F.col(a).alias(b) for a, b in names.items()])


def read_root(spark: SparkSession, path: str, tree: str, branches: Mapping[str, str], first: int = 0, last: int | None = None, entries_each: int = 10_000) -> DataFrame:
    """A ROOT tree as a jagged table, where the optional reader library is installed; an ImportError otherwise.

    The driver only asks for the number of entries and the types (one entry is read); executors read ranges of ``entries_each``, so the path must be on storage they share.
    """
    try:
        import uproot
    except ImportError as e:
        raise ImportError("reading ROOT files needs the package uproot; convert them to Parquet instead") from e

    def rows(start: int, stop: int) -> pa.Table:
        with uproot.open(path) as f:
            arrays = f[tree].arrays(list(branches), entry_start=start, entry_stop=stop, library="np")
        return pa.table({new: pa.array([v.tolist() if hasattr(v, "tolist") else v for v in arrays[old]]) for old, new in branches.items()})

    with uproot.open(path) as f:
        end = min(f[tree].num_entries if last is None else last, f[tree].num_entries)
    one = rows(first, min(first + 1, end))
    starts = range(first, end, entries_each)
    if not len(starts):
        return spark.createDataFrame(one)
    tasks = spark.createDataFrame([(s, min(s + entries_each, end)) for s in starts], "start bigint, stop bigint").repartition(len(starts))

    def load(batches):
        for b in batches:
            for start, stop in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                yield from rows(start, stop).cast(one.schema).to_batches()

    return tasks.mapInArrow(load, spark.createDataFrame(one).schema)


def in_memory(spark: SparkSession, columns: Mapping[str, list], ddl: str) -> DataFrame:
    """A small frame from columns."""
    return spark.createDataFrame(list(zip(*columns.values(), strict=True)), ddl)
