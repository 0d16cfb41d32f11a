"""Reading tables and cutting lineage, shared by the corpus operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adfuse.sources.storage import checkpoint_root, scratch_path

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def pick(df: DataFrame, *columns: tuple[str, str]) -> DataFrame:
    """Only the named columns, cast to the types an operator works with.

    Every operator starts here, so columns that it does not know, whatever
    they are called, cannot clash with the ones it adds.
    """
    return df.select(*[df[name].cast(kind).alias(name) for name, kind in columns])


def fold_case(text: Column) -> Column:
    """Lower-case A-Z and nothing else (null counts as empty)."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, UPPER.lower())


def table_at(df: DataFrame, path: str) -> DataFrame:
    """The rows of ``df`` as they were written to ``path``."""
    return df.sparkSession.read.schema(df.schema).parquet(path)


def frozen(df: DataFrame, label: str, made: list[str] | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage, so a lost executor costs a re-read and not a
    recomputation, and several consumers see the same rows.  ``made`` collects
    the paths, for a caller that can remove them.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    if made is not None:
        made.append(path)
    return table_at(df, path)


def checkpointed(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the session's shared folder (narrow tables)."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def with_texts(batch, new: dict[int, str]):
    """An Arrow batch with the texts of some rows replaced; an integer ``n_chars`` follows them."""
    import pyarrow as pa

    if not new:
        return batch
    columns, names = list(batch.columns), batch.schema.names
    for name, value in (("text", lambda t: t), ("n_chars", len)):
        k = names.index(name) if name in names else -1
        if k >= 0 and (name == "text" or pa.types.is_integer(columns[k].type)):
            old = columns[k].to_pylist()
            columns[k] = pa.array([value(new[r]) if r in new else v for r, v in enumerate(old)], columns[k].type)
    return pa.RecordBatch.from_arrays(columns, schema=batch.schema)
