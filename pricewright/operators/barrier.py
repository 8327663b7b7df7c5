"""Columns that the optimizer must not copy."""

from pyspark.sql import Column, DataFrame, functions as F


def with_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that are computed once per row, whatever reads them later.

    A filter over a projection is pushed below it with the expression copied
    in, and so are the null checks of joins and aggregates: a costly
    expression would run two or three times. It cannot be pushed through a
    generator, and one that yields a single row stays inside the stage's code.
    """
    row = F.struct(*[column.alias(name) for name, column in columns.items()])
    return df.select(*[c for c in df.columns if c not in columns], F.inline(F.array(row)))
