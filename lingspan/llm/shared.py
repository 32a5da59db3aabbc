"""Small helpers the training-data operators share."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


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


_written: ContextVar[list[str] | None] = ContextVar("written", default=None)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet under the shared folder and read it back: lineage is cut, lost executors lose nothing."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    if (mine := _written.get()) is not None:
        mine.append(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """Deletes at its end the tables that materialize has written inside, so that they take no room while later steps run. It
    gives a function like materialize for what is to outlive it; nothing else made inside may be used after it."""
    outer, mine = _written.get(), []
    token = _written.set(mine)

    def keep(df: DataFrame, name: str) -> DataFrame:
        inner = _written.set(outer)
        try:
            return materialize(df, name)
        finally:
            _written.reset(inner)

    try:
        yield keep
    finally:
        _written.reset(token)
        for path in mine:
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def free_names(taken: list[str], *wanted: str) -> list[str]:
    """The wanted column names, with as many underscores before them as keep them apart from the taken ones."""
    taken, out = {c.lower() for c in taken}, []
    for name in wanted:
        while name in taken:
            name = f"_{name}"
        out.append(name)
    return out


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def held_out(doc_id: Column | str) -> Column:
    """The fixed test fold: crc32 of the decimal doc_id, modulo 5, is 0."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id.cast("string")) % 5 == 0, F.lit(False))


def utf8(text: str | None) -> bytes:
    return b"" if text is None else text.encode("utf-8", "surrogatepass")


#: UTF-8 bytes of text that a Python worker turns into objects at a time; a longer text is a chunk of its own.
CHUNK_BYTES = 3_000_000
#: Rows of an Arrow batch, since a row holds a whole text; a session's smaller setting stays.
ARROW_ROWS = 1_000
_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def few_rows_a_batch(spark: SparkSession) -> None:
    """Cuts the session's Arrow batches to ARROW_ROWS."""
    if not 0 < int(spark.conf.get(_ROWS)) <= ARROW_ROWS:
        spark.conf.set(_ROWS, str(ARROW_ROWS))


def map_texts(docs: DataFrame, columns: list[str], text: str, fields: list[T.StructField], make: Callable[[], Callable[[list], list[list]]]) -> DataFrame:
    """The given columns of docs, then `fields`. make() runs once a task and gives a function from a list of texts to
    the lists of values of the fields. Batches are cut to ARROW_ROWS, a setting of the session, and to CHUNK_BYTES,
    which bounds a worker's memory."""
    few_rows_a_batch(docs.sparkSession)
    (read,) = free_names([*columns, *(f.name for f in fields)], "text")
    kept = docs.select(*columns, docs[text].alias(read))
    n = len(columns)
    schema = T.StructType([*kept.schema.fields[:n], *fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        values_of = make()
        types = [to_arrow_type(f.dataType) for f in fields]
        for batch in batches:
            sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(n)), 0).to_numpy(zero_copy_only=False))
            at = 0
            while at < batch.num_rows:
                upto = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + CHUNK_BYTES, side="right")))
                part = batch.slice(at, upto - at)
                made = values_of(part.column(n).to_pylist())
                yield pa.RecordBatch.from_arrays([*part.columns[:n], *(pa.array(v, t, from_pandas=True) for v, t in zip(made, types))], names=schema.names)
                at = upto

    return kept.mapInArrow(run, schema)
