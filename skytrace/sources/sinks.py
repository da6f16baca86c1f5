"""Writers: CSV, Parquet by partition, and the dense tensor file."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame

from skytrace.plans.boundary import remove


def write_csv(df: DataFrame, path: str, single: bool = False) -> None:
    """CSV with a header in each file; ``single`` is for small summaries only."""
    (df.coalesce(1) if single else df).write.mode("overwrite").option("header", True).csv(path)


def write_parquet(df: DataFrame, path: str, *partition_by: str) -> None:
    """Parquet by partition; replaces all that was there, so nothing of an earlier run stays."""
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_partitions(df: DataFrame, path: str, by: str, values: tuple[str, ...]) -> None:
    """Replaces the partitions of ``values``, also those for which ``df`` has no rows; all others stay."""
    for v in values:
        remove(df.sparkSession, f"{path}/{by}={v}")
    df.where(df[by].isin(list(values))).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)


def export_tensor(windows: DataFrame, path: str, n: int, length: int, width: int) -> None:
    """Writes ``steps`` in ``sequence_id`` order as a float64 ``.npy`` of shape (n, length, width) on the driver.

    Tasks pack runs of sequences into bytes; the driver holds one partition of
    them at a time and writes each run in one go.
    """
    import numpy as np
    import pyarrow as pa

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = np.asarray(batch.column(0))
            values = np.asarray(batch.column(1).flatten().flatten(), float).reshape(len(ids), -1)
            cuts = [0, *(np.flatnonzero(np.diff(ids) != 1) + 1).tolist(), len(ids)]
            runs = [(int(ids[a]), values[a:b].astype("<f8").tobytes()) for a, b in zip(cuts, cuts[1:]) if a < b]
            yield pa.record_batch([pa.array([i for i, _ in runs], pa.int64()), pa.array([x for _, x in runs], pa.binary())], names=["first", "data"])

    out = np.lib.format.open_memmap(path, mode="w+", dtype=np.float64, shape=(n, length, width))
    ordered = windows.select("sequence_id", "steps").repartitionByRange("sequence_id").sortWithinPartitions("sequence_id")
    for row in ordered.mapInArrow(packed, "first long, data binary").toLocalIterator():
        part = np.frombuffer(row["data"], "<f8").reshape(-1, length, width)
        out[row["first"] : row["first"] + len(part)] = part
    out.flush()
