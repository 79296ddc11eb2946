"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space as Python's ``str.isspace`` sees it, written for Java and RE2 patterns alike.
SPACE = r"\x09-\x0d\x1c-\x20\x85\p{Z}"

#: The same signs one by one, for trimming.
SPACES = "".join(chr(n) for n in range(0x3001) if chr(n).isspace())


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The columns of one table of a data folder; only these reach the scan."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def stripped(c: Column | str) -> Column:
    """The text without leading and trailing white space of any kind."""
    return F.btrim(F.col(c) if isinstance(c, str) else c, F.lit(SPACES))


def is_blank(c: Column | str) -> Column:
    """NULL, empty, or white space only (the ideographic space included)."""
    c = F.col(c) if isinstance(c, str) else c
    return c.isNull() | ~c.rlike(rf"[^{SPACE}]")


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage through the shared folder the cluster names.

    ``spark.checkpoint.dir`` is read from the session; a folder of our own is
    set only where none is configured and the session is local, as in tests. A
    cluster is refused, as its machines would not see each other's blocks.
    """
    spark = df.sparkSession
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="rosterforge-ckpt-"))
    return df.checkpoint(eager=True)


def private(df: DataFrame, *names: str) -> list[str]:
    """Column names for internal use that clash with none of ``df``'s."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out
