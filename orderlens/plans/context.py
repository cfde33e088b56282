"""Shared inputs of the registered queries: raw, cleaned known / unknown / history."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import clean as cl
from ..sources import adapter
from ..sources.scan import NA_VALUES, apply_sentinels


class Inputs:
    """Each table is made when a query first asks for it; only the cleaned ones need the medians' job.

    ``materialize`` writes the joined rows once (Parquet in the shared checkpoint folder) for queries
    that make several passes: the medians, every fitted table, scaling parameters and the final plan
    read only the columns they need of it; cleaning is a narrow projection on top.  The lineage is
    cut (a lost executor does not replay the raw joins).
    """

    def __init__(self, spark: SparkSession, sf_dir: str, na_values=NA_VALUES, materialize: bool = False):
        self.na_values, self.materialize = na_values, materialize
        self.raw: DataFrame = adapter.order_items(spark, sf_dir)

    @cached_property
    def sentinel(self) -> DataFrame:
        """Raw rows, sentinels -> null."""
        rows = apply_sentinels(self.raw, self.na_values)
        if self.materialize:
            from ..session import materialize as write_table
            rows = write_table(rows, "order-items")
        return rows

    @cached_property
    def params(self):
        return cl.history_params(self.sentinel)

    def cleaned(self, rows: DataFrame) -> DataFrame:
        """Rows of ``sentinel``, whatever columns they were joined with, cleaned."""
        return cl.clean_with(rows, self.params)

    @cached_property
    def history(self) -> DataFrame:
        """Both files cleaned, in one pass."""
        return cl.clean_history(self.sentinel, self.na_values, self.params)

    @cached_property
    def known(self) -> DataFrame:
        return self.history.filter(F.col("return").isNotNull())

    @cached_property
    def unknown(self) -> DataFrame:
        return self.history.filter(F.col("return").isNull())


def inputs(spark: SparkSession, sf_dir: str, na_values=NA_VALUES, materialize: bool = False) -> Inputs:
    return Inputs(spark, sf_dir, na_values, materialize)
