"""Shared query inputs: the main panel and the short events panel."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.operators import features as feat
from tessera.operators import panel as pnl
from tessera.sources import tables
from tessera.tables import reliable


def orders_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main panel: daily order value per order priority, gap-filled, clamped."""
    return pnl.build_panel(tables.orders_observations(spark, sf_dir), drop_from_name=tables.ORDER_RANK)


def written_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main panel as a written table, for queries that read it more than once: the orders are read once."""
    return reliable(pnl.build_panel(tables.orders_observations(spark, sf_dir), materialise_daily=True,
                                    drop_from_name=tables.ORDER_RANK))


def events_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Short panel: daily event value per event type."""
    return pnl.build_panel(tables.events_observations(spark, sf_dir))


def orders_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feat.add_features(orders_panel(spark, sf_dir))


def orders_processed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feat.processed_panel(orders_panel(spark, sf_dir))
