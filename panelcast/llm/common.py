"""Shared helpers: word splitting, Arrow row mapping, shared scratch tables."""

from __future__ import annotations

import re
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed value: word separators of every operator here, U+0020 and U+0009-U+000D.
#: ``bytes.split()`` without arguments splits on exactly these bytes.
JAVA_SPACES = "[ \\t-\\r]+"

LOWER_AZ = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
SLICE = 256


def words_of(text: str | None) -> list[bytes]:
    """UTF-8 words of a text; none for NULL. Lone surrogates cannot occur in Arrow strings."""
    return text.encode().split() if text else []


def words_column(text: Column) -> Column:
    """Array of words, JVM side."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), JAVA_SPACES), lambda w: w != "")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluates ``value`` once and binds it as a lambda variable of ``body``.

    Without it the optimizer may inline an array expression into a lambda and
    evaluate it again for every element."""
    return F.transform(F.array(value), body)[0]


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: the session's checkpoint directory.

    One is made only for a purely local master without the setting (tests);
    on a cluster the missing setting is an error."""
    sc = spark.sparkContext
    found = sc.getConf().get("spark.checkpoint.dir")
    if found:
        return found.rstrip("/")
    own = sc._jsc.sc().getCheckpointDir()
    if own.isDefined():
        return own.get().rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="llm-checkpoint-"))
    return sc._jsc.sc().getCheckpointDir().get().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, deleted when the application ends."""
    path = f"{shared_dir(spark)}/llm-{name}-{uuid.uuid4().hex}"
    jvm = spark._jvm
    hadoop = jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    return path


def written(df: DataFrame, name: str, *partition_by: str) -> DataFrame:
    """Writes a table into the shared folder and reads it back: cuts the
    lineage, and a lost executor costs no recomputation."""
    path = scratch_path(df.sparkSession, name)
    writer = df.write.option("compression", "zstd")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def map_arrow(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``mapInArrow`` with this subpackage at hand on every executor."""
    ship(df.sparkSession)
    return df.mapInArrow(fn, schema)


def ship(spark: SparkSession) -> None:
    """Sends the package to the executors once per application, as ``--py-files`` would."""
    sc = spark.sparkContext
    if getattr(sc, "_llm_shipped", False):
        return
    here = Path(__file__).parent
    target = Path(tempfile.mkdtemp(prefix="llm-ship-")) / f"{here.parent.name}.zip"
    with zipfile.ZipFile(target, "w") as z:
        for f in sorted(here.parent.rglob("*.py")):
            z.write(f, f.relative_to(here.parent.parent))
    sc.addPyFile(str(target))
    sc._llm_shipped = True


def map_slices(df: DataFrame, make: Callable[[], Callable[[dict[str, list]], dict[str, list] | None]],
               schema: str) -> DataFrame:
    """``mapInArrow`` over slices of at most SLICE rows as column lists.

    ``make`` runs once per task and returns the function of a slice, which
    gives the output columns (or None)."""
    from pyspark.sql.pandas.types import to_arrow_schema

    target = to_arrow_schema(_struct(df.sparkSession, schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = make()
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                out = fn({n: part.column(i).to_pylist() for i, n in enumerate(part.schema.names)})
                if out is not None:
                    yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in target], schema=target)

    return map_arrow(df, run, schema)


def _struct(spark: SparkSession, schema: str):
    from pyspark.sql.types import StructType

    return StructType.fromDDL(schema)


def doc_crc(doc_id: Column) -> Column:
    """crc32 of a document id as text, unsigned."""
    return F.crc32(doc_id.cast("string").cast("binary"))
