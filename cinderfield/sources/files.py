"""Single files by name, written from the tasks that hold them."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_files(files: DataFrame, root: str) -> int:
    """Write rows ``name, data`` as files below ``root``; how many there are.

    ``root`` is a path or URI that pyarrow opens (file, HDFS, object stores). A task
    that runs again writes the same names anew, so lost executors leave nothing twice.
    """
    if root.startswith("file:/") and not root.startswith("file://"):
        root = "file://" + root.removeprefix("file:")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = fs.FileSystem.from_uri(root)
        for batch in batches:
            names = batch.column(0).to_pylist()
            for folder in {name.rpartition("/")[0] for name in names}:
                system.create_dir(f"{base}/{folder}", recursive=True)
            for name, data in zip(names, batch.column(1).to_pylist(), strict=True):
                with system.open_output_stream(f"{base}/{name}", compression=None) as out:
                    out.write(data or b"")
            yield pa.RecordBatch.from_arrays([pa.array([len(names)], pa.int64())], names=["n"])

    rows = files.select("name", F.col("data").cast("binary").alias("data"))
    return rows.mapInArrow(write, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
