"""Helpers for operators made of built-in expressions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: [\x20\x09-\x0D]
BLANKS = " \t\n\x0b\x0c\r"
BLANK_RUN = r"[\x20\x09-\x0D]+"


class Columns:
    """An input's columns under numbers, so that none of their names can clash with one in use inside an operator.

    One rule for all operators: an output column takes the place of an input
    column of its name, in any case of letters; all other columns stay.
    """

    def __init__(self, df: DataFrame) -> None:
        self.names = df.columns
        self.kinds = [f.dataType.simpleString() for f in df.schema.fields]
        self.frame = df.toDF(*[f"in{i}" for i in range(len(self.names))])

    def at(self, name: str) -> int:
        low = [n.casefold() for n in self.names]
        if name not in self.names and name.casefold() not in low:
            raise ValueError(f"the input has no column {name}")
        return self.names.index(name) if name in self.names else low.index(name.casefold())

    def __getitem__(self, name: str) -> Column:
        return F.col(f"in{self.at(name)}")

    def kind(self, name: str) -> str:
        return self.kinds[self.at(name)]

    def kept(self, made) -> list[int]:
        """Numbers of the columns that no output is named like."""
        taken = {m.casefold() for m in made}
        return [i for i, n in enumerate(self.names) if n.casefold() not in taken]

    def back(self, frame: DataFrame, made: dict[str, Column]) -> DataFrame:
        """``frame`` with the input's columns under their names, then ``made``."""
        kept = self.kept(made)
        out = frame.select(*[F.col(f"in{i}") for i in kept], *[c.alias(f"out{j}") for j, c in enumerate(made.values())])
        return out.toDF(*[self.names[i] for i in kept], *made)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), lambda x: body(x)), 1)


def words(text: Column) -> Column:
    """The runs of characters other than blanks."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, BLANK_RUN))
