"""Changed files with their text."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _opener(base: str):
    """mapInPandas: ``path`` -> ``path, content``, each task opening only the paths it was dealt."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        system, root = fs.FileSystem.from_uri(base)
        for batch in batches:
            texts = []
            for path in batch["path"]:
                try:
                    with system.open_input_stream(f"{root.rstrip('/')}/{path}") as stream:
                        texts.append(stream.read().decode("utf-8", errors="replace"))
                except (FileNotFoundError, IsADirectoryError, OSError):
                    texts.append(None)
            yield pd.DataFrame({"path": batch["path"], "content": texts})

    return run


def read_changed_files(spark: SparkSession, root: str, changes: DataFrame) -> DataFrame:
    """``path, deleted, content`` of a change list ``path, deleted``.

    Paths are relative to ``root`` (a local folder or a URI that pyarrow opens). The change list
    itself is dealt to the tasks, and each opens only its own paths: nothing lists the tree, and
    the files read are the listed ones that are not deleted. Deleted and missing files have no
    text; a path listed several times is one row, deleted if any entry says so. Text is UTF-8,
    malformed bytes replaced.
    """
    base = root if "://" in root else "file://" + root
    listed = changes.groupBy("path").agg(F.max("deleted").alias("deleted"))
    wanted = listed.where(~F.coalesce("deleted", F.lit(False)) & F.col("path").isNotNull()).select("path")
    # one task a few hundred paths, whatever the files' sizes
    dealt = wanted.repartitionByRange(max(1, spark.sparkContext.defaultParallelism), "path")
    read = dealt.mapInPandas(_opener(base), "path string, content string")
    return listed.join(read, "path", "left")
