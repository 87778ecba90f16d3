"""Writing tagged logs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def keep_columns(df: DataFrame, keep: Sequence[str] | None) -> DataFrame:
    """The named columns in that order; unknown names are left out."""
    return df if keep is None else df.select(*[F.col(f"`{c}`") for c in keep if c in df.columns])


def list_text(c: Column) -> Column:
    """A list of strings as Python writes it."""
    quote = lambda x: F.when(x.contains("'") & ~x.contains('"'), F.concat(F.lit('"'), x, F.lit('"'))).otherwise(F.concat(F.lit("'"), F.replace(x, F.lit("'"), F.lit("\\'")), F.lit("'")))
    return F.concat(F.lit("["), F.array_join(F.transform(F.coalesce(c, F.array().cast("array<string>")), quote), ", "), F.lit("]"))


def write_csv(df: DataFrame, path: str, keep: Sequence[str] | None = None, single_file: bool = False, append: bool = False) -> None:
    """A folder of CSV parts with a header; lists as text. ``single_file`` puts all rows through one task; ``append`` adds to what is there."""
    df = keep_columns(df, keep)
    out = df.select(*[(list_text(F.col(f"`{c}`")) if kind.startswith("array") else F.col(f"`{c}`")).alias(c) for c, kind in df.dtypes])
    (out.coalesce(1) if single_file else out).write.mode("append" if append else "overwrite").csv(path, header=True, quote='"', escape='"', emptyValue="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)


def write_parquet(df: DataFrame, path: str, keep: Sequence[str] | None = None) -> None:
    keep_columns(df, keep).write.mode("overwrite").parquet(path)
