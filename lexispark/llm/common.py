"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import fresh_path

#: Words are runs of [0-9a-z] and of bytes from 0x80 on, after A-Z became a-z.
WORD_BYTES = bytes(b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words(text: str | None) -> list[bytes]:
    """The words of ``text`` as UTF-8: A-Z lower-cased, other characters kept."""
    return text.encode("utf-8", "surrogatepass").lower().translate(WORD_BYTES).split() if text else []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """``df`` written once to the shared folder and read back: it cuts the
    lineage, and a lost executor costs a re-read, not a re-run."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_bytes(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def without(df: DataFrame, names: list[str]) -> DataFrame:
    """``df`` without input columns whose names (in any case) an operator
    uses for its own results."""
    own = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in own])


def chunks(batch: pa.RecordBatch, text_at: int, most_chars: int) -> Iterator[pa.RecordBatch]:
    """Slices of ``batch`` of about ``most_chars`` characters (a longer
    text stands alone): bounds the memory of what follows."""
    start = held = 0
    for i, n in enumerate(pc.fill_null(pc.utf8_length(batch.column(text_at)), 0).to_pylist()):
        if held and held + n > most_chars:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n
    if start < batch.num_rows:
        yield batch.slice(start)


def add_columns(
    df: DataFrame,
    text: str,
    fields: list[T.StructField],
    fn: Callable[[list[str | None]], tuple[list[pa.Array], pa.Array | None]],
    most_chars: int = 2_000_000,
) -> DataFrame:
    """``df`` with the columns ``fields`` that ``fn`` makes of a slice's
    texts, less the rows that its mask (if any) leaves out. Input columns
    whose names clash with ``fields`` go."""
    base = without(df, [f.name for f in fields if f.name != text])
    schema = T.StructType([*base.schema.fields, *fields])
    at = base.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, at, most_chars):
                arrays, mask = fn(part.column(at).to_pylist())
                out = pa.RecordBatch.from_arrays([*part.columns, *arrays], names=[*part.schema.names, *[f.name for f in fields]])
                yield out if mask is None else out.filter(mask)

    return base.mapInArrow(run, schema)
