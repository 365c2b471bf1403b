"""Names under which SQL finds the layers.

Open-source Spark has no CREATE CATALOG, so a schema name carries its
environment: ``gridtide_dev_bronze.`245_wind_power_generation_raw_table` ``, with the
layout's prefix. Bronze, silver and stored dimensions are external tables; the
changing tables are views in the same schemas, valid in every session of the catalog,
over the folders of the version that was newest when they were published; each run
publishes them anew before it deletes old versions.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from ..config import Layout
from .sliced import SlicedTable

LAYERS = ("bronze", "silver", "gold", "landing_admin")


def schema_name(layout: Layout, layer: str) -> str:
    return f"{layout.prefix}_{layout.environment}_{layer}"


def create_schemas(spark: SparkSession, layout: Layout) -> None:
    for layer in LAYERS:
        name = schema_name(layout, layer)
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{name}` LOCATION '{layout.at(layer)}'")


def publish_table(
    spark: SparkSession,
    layout: Layout,
    layer: str,
    table: str,
    path: str,
    schema: T.StructType,
    comment: str,
) -> str:
    """An external table over a layer folder, with its comment and its quality."""
    name = f"`{schema_name(layout, layer)}`.`{table}`"
    if not spark.catalog.tableExists(name):
        spark.catalog.createTable(name, path=path, source="parquet", schema=schema, description=comment)
        spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('quality' = '{layer}')")
    spark.catalog.refreshTable(name)
    return name


def publish_views(
    spark: SparkSession, layout: Layout, tables: Iterable[tuple[str, str, SlicedTable]]
) -> None:
    """Views ``<schema>.<table>`` of the newest version of changing tables. A
    table no dataset feeds has no version yet and shows no rows."""
    for layer, name, table in tables:
        columns = ", ".join(f"`{c}`" for c in table.schema.fieldNames())
        folders = table.folders(spark)
        parts = [f"SELECT {columns} FROM parquet.`{folder}`" for folder in folders]
        nothing = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`" for f in table.schema.fields)
        body = " UNION ALL ".join(parts) or f"SELECT {nothing} WHERE false"
        spark.sql(f"CREATE OR REPLACE VIEW `{schema_name(layout, layer)}`.`{name}` AS {body}")
