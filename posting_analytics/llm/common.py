"""Helpers shared by the operators: shared folder, hashing draws, written tables."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, set as the checkpoint folder.

    The cluster names a shared folder there.  Only a local session without the
    setting (a bare test session) gets a folder of its own.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the cluster shares")
        named = tempfile.mkdtemp(prefix="llm-shared-")
    sc.setCheckpointDir(named)
    return sc.getCheckpointDir() or named


def cut(df: DataFrame) -> DataFrame:
    """Checkpoint in the shared folder: later steps survive a lost executor."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def written(df: DataFrame, name: str) -> DataFrame:
    """Write as Parquet in the shared folder and read it back."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def n_buckets(spark: SparkSession, most: int = 1 << 16) -> int:
    """Buckets for routed keys: the power of two at or above the session's
    shuffle partitions, which its owner sizes to the data."""
    wanted = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    return min(most, 1 << max(0, (max(1, wanted) - 1).bit_length()))


def uniform(*cols: Column | str) -> Column:
    """A draw in (0, 1) that only the values of ``cols`` decide."""
    return (F.shiftrightunsigned(F.xxhash64(*cols), 11).cast("double") + F.lit(0.5)) / F.lit(
        float(1 << 53))


def ship_code(spark: SparkSession) -> None:
    """Give this package to the workers, as ``--py-files`` would; once per application."""
    sc = spark.sparkContext
    if getattr(sc, "_llm_code_shipped", False):
        return
    root = Path(__file__).resolve().parent.parent
    path = Path(tempfile.mkdtemp(prefix="llm-code-")) / f"{root.name}.zip"
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    sc.addPyFile(str(path))
    sc._llm_code_shipped = True


def unused(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until no column of ``df`` is called so (case aside)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def carried(df: DataFrame, *columns: Column | str) -> DataFrame:
    """``columns`` beside the whole row as one struct ``_row``: whatever the others are
    called, names made on the way cannot clash.  ``select("_row.*")`` gives the rows back."""
    whole = F.struct(*[F.col(f"`{c.replace('`', '``')}`") for c in df.columns])
    return df.select(*columns, whole.alias("_row"))


def numbered(df: DataFrame) -> DataFrame:
    """The same rows with columns called by their places: ``mapInArrow`` takes no name with a dot."""
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))])
