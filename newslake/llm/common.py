"""Small helpers that the operators of this package share."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from newslake.session import work_dir


def place_of(df: DataFrame, name: str) -> int:
    """The place of a column: a name in the right case wins, then the first one."""
    names = df.columns
    same = [i for i, n in enumerate(names) if n == name] or [i for i, n in enumerate(names) if n.lower() == name.lower()]
    if not same:
        raise ValueError(f"no column {name!r} among {names}")
    return same[0]


def by_place(df: DataFrame) -> DataFrame:
    """The same columns, named ``c0, c1, ...``: names that clash do no harm."""
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))])


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, renamed: ``pick(df, id="doc_id")``.

    Columns are found by place, so others whose names clash, even twins that differ
    in case only, do no harm.
    """
    places = {new: place_of(df, old) for new, old in columns.items()}
    return by_place(df).select(*[F.col(f"c{i}").alias(new) for new, i in places.items()])


def rows_of_ids(df: DataFrame, id_col: str, ids: DataFrame) -> DataFrame:
    """The whole rows whose id is in the one column of ``ids``; nulls equal each other."""
    wanted = ids.toDF("wanted")
    apart = by_place(df)
    same = apart[f"c{place_of(df, id_col)}"].eqNullSafe(wanted["wanted"])
    return apart.join(wanted, same, "left_semi").toDF(*df.columns)


def map_batches(
    df: DataFrame,
    function: Callable[[pa.RecordBatch], Iterable[pa.RecordBatch]],
    schema: str | StructType,
    done: Callable[[], None] | None = None,
) -> DataFrame:
    """Run a function over Arrow batches, one after the other, and ``done`` at the end of a task.

    A Python worker lives on: what a task leaves there takes memory from the next stages.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            for batch in batches:
                yield from function(batch)
        finally:
            if done is not None:
                done()
            pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, schema)


def write(df: DataFrame, name: str) -> str:
    """Write a table to a new folder below the shared one; its path."""
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back.

    This cuts the lineage: a lost executor costs no more than the step that reads it.
    Names that clash do no harm.
    """
    places = by_place(df)
    return df.sparkSession.read.schema(places.schema).parquet(write(places, name)).toDF(*df.columns)


@contextmanager
def small_batches(spark: SparkSession, rows: int = 512) -> Iterator[None]:
    """What runs in here sends Python at most so many rows at once, as whole texts are long."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    given = spark.conf.get(name)
    # Zero and below stand for no limit.
    spark.conf.set(name, str(rows if int(given) <= 0 else min(rows, int(given))))
    try:
        yield
    finally:
        spark.conf.set(name, given)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder made by ``write`` that nothing reads any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")
