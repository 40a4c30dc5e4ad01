"""Image catalogue: labels from annotations, union of sources, seeded order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinderfield.functions.scalars import hash_text
from cinderfield.functions.text import any_box_label, class_line_label, file_stem


def label_annotated(shards: DataFrame, annotations: str = "annotations") -> DataFrame:
    """Rows of annotated shards plus ``label``: any annotation text means 1."""
    return shards.withColumn("label", any_box_label(F.col(annotations)))


def label_by_file(images: DataFrame, label_files: DataFrame) -> DataFrame:
    """Images with the label of the text file of the same stem; no file gives 0.

    ``images`` needs ``path`` (or ``stem``), ``label_files`` one row per ``stem``
    with ``content``. Label texts shrink to one flag before the join.
    """
    if "stem" not in images.columns:
        images = images.withColumn("stem", file_stem(F.col("path")))
    flags = label_files.select("stem", class_line_label(F.col("content")).alias("_flag"))
    joined = images.join(flags, "stem", "left")
    return joined.withColumn("label", F.coalesce("_flag", F.lit(0))).drop("_flag")


def catalogue(*sources: DataFrame) -> DataFrame:
    """Union of catalogues; a column one source lacks is null there."""
    out = sources[0]
    for other in sources[1:]:
        out = out.unionByName(other, allowMissingColumns=True)
    return out


def ordered_catalogue(samples: DataFrame, split: str, key: str = "path", seed: int = 42) -> DataFrame:
    """Training samples in seeded random order, other splits in path order."""
    if split == "train":
        return samples.orderBy(hash_text(F.col(key), seed), F.col(key))
    return samples.orderBy(key)
