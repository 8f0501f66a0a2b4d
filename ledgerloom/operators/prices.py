"""Prices over time: every price, the latest one, and the changes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions import r2
from ledgerloom.operators.ordered_lag import with_previous
from ledgerloom.operators.providers import with_provider_id

PRODUCT = ["detalle", "unidad_medida", "codigo_cabys", "impuesto_tarifa"]
# The line number is text here too: "10" comes before "2". The price comes last to
# make the order total among lines that agree in all the rest.
TIMELINE = ["fecha_emision", "numero_consecutivo", "numero_linea", "precio_unitario"]

PRICE_COLUMNS = [
    "proveedor",
    "emisor_nombre",
    "emisor_identificacion",
    "receptor_nombre",
    "receptor_identificacion",
    "fecha_emision",
    "fecha",
    "mes",
    "numero_consecutivo",
    "numero_linea",
    "codigo_cabys",
    "detalle",
    "unidad_medida",
    "precio_unitario",
    "impuesto_tarifa",
    "impuesto_monto",
    "cantidad",
    "subtotal",
    "monto_total_linea",
    "descuento_estimado",
    "source_file",
]


def price_history(invoice_lines: DataFrame) -> DataFrame:
    priced = F.col("detalle").isNotNull() & F.col("precio_unitario").isNotNull()
    return invoice_lines.filter(priced).select(*PRICE_COLUMNS)


def latest_per(history: DataFrame, group: list[str]) -> DataFrame:
    """The newest line of each group.

    Spark ranks and cuts within each task before the shuffle (``WindowGroupLimit``),
    so a group sends at most one row per task however many lines it has.
    """
    newest_first = Window.partitionBy(*group).orderBy(*[F.col(c).desc_nulls_last() for c in TIMELINE])
    return (
        history.withColumn("_rank", F.row_number().over(newest_first)).filter(F.col("_rank") == 1).drop("_rank")
    )


def provider_prices(history: DataFrame) -> DataFrame:
    """Every price with the id of its provider, and what the latest price of a product is found by."""
    return with_provider_id(history).select("provider_id", *PRODUCT, *TIMELINE)


def latest_price_list(history: DataFrame) -> DataFrame:
    return latest_per(history, ["proveedor", *PRODUCT]).select(
        "proveedor",
        "detalle",
        "precio_unitario",
        "impuesto_tarifa",
        F.col("fecha_emision").alias("ultima_fecha_emision"),
        F.col("numero_consecutivo").alias("ultimo_numero_consecutivo"),
    )


def price_changes(history: DataFrame, tasks: int | None = None) -> DataFrame:
    """Each line whose price differs from the line before it, per provider and product.

    Copies of a line can only repeat a price, so it does not matter how many there are.
    Lines are put in order in stretches that cut through products; ``tasks`` sets their number.
    """
    group = ["proveedor", *PRODUCT]
    points = history.select(*group, *TIMELINE)
    carried = {"precio_unitario": "precio_anterior", "fecha_emision": "fecha_anterior"}
    sequenced = with_previous(points, group, TIMELINE, carried, tasks)
    now, before = F.col("precio_unitario"), F.col("precio_anterior")
    percent = F.when(before != 0, (now - before) / before * 100)
    return sequenced.filter(before.isNotNull() & (now != before)).select(
        "proveedor",
        "detalle",
        "impuesto_tarifa",
        "fecha_anterior",
        "fecha_emision",
        "precio_anterior",
        now.alias("precio_nuevo"),
        r2(now - before).alias("cambio_precio"),
        r2(percent).alias("cambio_porcentaje"),
        "numero_consecutivo",
    )
