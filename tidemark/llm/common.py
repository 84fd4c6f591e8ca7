"""Helpers shared by the corpus operators."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import delete_path, materialise, scratch_path  # noqa: F401
from tidemark.sources.tables import table

#: The characters that ``[\x20\x09-\x0D]`` names.
SPACES = " \t\n\x0b\x0c\r"
SPACE_CLASS = r"[\x20\x09-\x0D]"
WORD_CLASS = r"[^\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def text_of(column: str = "text") -> Column:
    """The text of a row; a null counts as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def own_names(df: DataFrame, *names: str) -> list[str]:
    """Names for helper columns that no column of ``df`` has (in any case)."""
    taken, mark = {c.lower() for c in df.columns}, "_"
    while any((mark + n).lower() in taken for n in names):
        mark += "_"
    return [mark + n for n in names]


def partitions_for(spark: SparkSession, total_bytes: int, per_partition: int) -> int:
    """Number of hash buckets so that one holds about ``per_partition`` bytes;
    at least the session's shuffle partitions, so that every core has work."""
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(least, -(-int(total_bytes or 0) // per_partition), 1)



def ship_package(spark: SparkSession) -> None:
    """Give the workers this package, once per application, so that an operator
    also runs where it is not installed on them."""
    sc = spark.sparkContext
    if getattr(sc, "_tidemark_shipped", False):
        return
    root = Path(__file__).resolve().parents[1]
    target = Path(tempfile.mkdtemp(prefix="tidemark-package-")) / "tidemark_package.zip"
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as archive:
        for path in sorted(root.rglob("*.py")):
            archive.write(path, path.relative_to(root.parent))
    sc.addPyFile(str(target))
    sc._tidemark_shipped = True
