"""Tables written between the steps of a job, under a folder that the whole cluster sees."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


#: Folders made in local mode, by application: the setting itself can't be changed in a session.
_own: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors see, from spark.checkpoint.dir. In local mode, as in tests, where driver and executors
    are one process, one is made if none is named; on a cluster that is an error."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        folder = _own.get(spark.sparkContext.applicationId) or _own.setdefault(spark.sparkContext.applicationId, tempfile.mkdtemp(prefix="lingspan-"))
    return folder.rstrip("/")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet under the shared folder and read it back: lineage is cut, lost executors lose nothing."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Rows of an Arrow batch where a row holds a whole text; a session's smaller setting stays.
ARROW_ROWS = 1_000
_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def few_rows_a_batch(spark: SparkSession) -> None:
    """Cuts the session's Arrow batches to ARROW_ROWS."""
    if not 0 < int(spark.conf.get(_ROWS)) <= ARROW_ROWS:
        spark.conf.set(_ROWS, str(ARROW_ROWS))


def free_names(taken: list[str], *wanted: str) -> list[str]:
    """Names for columns that a step adds for itself: the wanted ones, with underscores before those that are taken."""
    known = {c.lower() for c in taken} | set(wanted)
    return [name if name not in {c.lower() for c in taken} else next(x for i in range(1, len(known) + 2) if (x := "_" * i + name) not in known) for name in wanted]
