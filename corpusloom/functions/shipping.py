"""Makes this package importable for Python workers, wherever the driver found it."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


#: Bytes of an Arrow batch of whole texts. By rows alone (10,000) a batch of long ones takes hundreds of MB, several times over, in each Python worker.
BATCH_BYTES = 2 << 20


def ship_for_texts(spark: SparkSession) -> None:
    """:func:`ship`, and whole texts go to Python in batches of so many bytes, however many rows a table has and however long they are."""
    ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def ship(spark: SparkSession) -> None:
    context = spark.sparkContext
    if getattr(context, "_corpusloom_shipped", False):
        return
    root = Path(__file__).resolve().parent.parent
    target = Path(tempfile.mkdtemp(prefix="corpusloom-")) / f"{root.name}.zip"
    with zipfile.ZipFile(target, "w") as out:
        for f in sorted(root.rglob("*.py")):
            out.write(f, f.relative_to(root.parent))
    context.addPyFile(str(target))
    context._corpusloom_shipped = True
