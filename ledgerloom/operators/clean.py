"""Raw text lines to typed lines, for invoices and for credit notes."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions import blank_to_null, provider_name, to_cents, to_double, to_timestamp
from ledgerloom.operators.columns import missing_columns, with_optional_columns
from ledgerloom.operators.dedupe import dedupe_lines
from ledgerloom.schemas import (
    CLEAN_CREDIT_NOTE_LINE,
    CREDIT_NOTE_COLUMNS,
    DEFAULT_CURRENCY,
    DEFAULT_RATE,
)

# Amounts of a clean invoice line that get a converted twin with suffix "_crc".
CONVERTED = [
    "precio_unitario",
    "monto_total",
    "subtotal",
    "base_imponible",
    "impuesto_neto",
    "monto_total_linea",
    "impuesto_monto",
    "descuento_estimado",
]


def _key(name: str) -> Column:
    return F.trim(F.col(name).cast("string"))


def _text(name: str) -> Column:
    return F.col(name).cast("string")


def _amount(name: str) -> Column:
    return to_double(_text(name))


def _currency() -> Column:
    return F.coalesce(blank_to_null(F.upper(_key("CodigoMoneda"))), F.lit(DEFAULT_CURRENCY))


def _rate() -> Column:
    """Exchange rate, unrounded; unreadable, absent or zero counts as one."""
    return F.coalesce(F.nullif(_amount("TipoCambio"), F.lit(0.0)), F.lit(1.0))


def _discount() -> Column:
    """Gross less net, never below zero and never null."""
    zero = F.lit(0.0)
    gross, net = F.coalesce(_amount("MontoTotal"), zero), F.coalesce(_amount("SubTotal"), zero)
    return to_cents(F.greatest(gross - net, zero))


def _as_of(moment: datetime | str | None) -> Column:
    return F.localtimestamp() if moment is None else F.lit(str(moment)).cast("timestamp_ntz")


def clean_invoice_lines(
    raw: DataFrame, as_of: datetime | str | None = None, dedupe: bool = False
) -> DataFrame:
    """One typed row per invoice line dated no later than ``as_of`` (default: now).

    A line whose date cannot be read is dropped with the future ones. Amounts are
    rounded, then converted with the unrounded rate, then rounded again.
    Repeated lines stay unless ``dedupe`` is set.
    """
    raw = with_optional_columns(raw, {"CodigoMoneda": DEFAULT_CURRENCY, "TipoCambio": DEFAULT_RATE})
    if dedupe:
        raw = dedupe_lines(raw)
    issued = F.col("fecha_emision")
    dated = raw.withColumn("fecha_emision", to_timestamp(_text("FechaEmision"))).filter(issued <= _as_of(as_of))
    typed = dated.select(
        F.col("SourceFile").alias("source_file"),
        _key("NumeroConsecutivo").alias("numero_consecutivo"),
        issued,
        issued.cast("date").alias("fecha"),
        F.trunc(issued.cast("date"), "month").alias("mes"),
        F.col("Emisor_Nombre").alias("emisor_nombre"),
        provider_name(F.col("Emisor_NombreComercial"), F.col("Emisor_Nombre")).alias("proveedor"),
        _text("Emisor_Identificacion").alias("emisor_identificacion"),
        F.col("Receptor_Nombre").alias("receptor_nombre"),
        _text("Receptor_Identificacion").alias("receptor_identificacion"),
        _currency().alias("codigo_moneda"),
        _rate().alias("tipo_cambio"),
        _key("NumeroLinea").alias("numero_linea"),
        F.col("CodigoCABYS").alias("codigo_cabys"),
        to_cents(_amount("Cantidad")).alias("cantidad"),
        F.col("UnidadMedida").alias("unidad_medida"),
        F.col("TipoTransaccion").alias("tipo_transaccion"),
        F.col("Detalle").alias("detalle"),
        to_cents(_amount("PrecioUnitario")).alias("precio_unitario"),
        to_cents(_amount("MontoTotal")).alias("monto_total"),
        to_cents(_amount("SubTotal")).alias("subtotal"),
        to_cents(_amount("BaseImponible")).alias("base_imponible"),
        to_cents(_amount("ImpuestoNeto")).alias("impuesto_neto"),
        to_cents(_amount("MontoTotalLinea")).alias("monto_total_linea"),
        F.col("Impuesto_Codigo").alias("impuesto_codigo"),
        F.col("Impuesto_CodigoTarifaIVA").alias("impuesto_codigo_tarifa_iva"),
        to_cents(_amount("Impuesto_Tarifa")).alias("impuesto_tarifa"),
        to_cents(_amount("Impuesto_Monto")).alias("impuesto_monto"),
        _discount().alias("descuento_estimado"),
    )
    return typed.withColumns({f"{c}_crc": to_cents(F.col(c) * F.col("tipo_cambio")) for c in CONVERTED})


def clean_credit_note_lines(raw: DataFrame) -> DataFrame:
    """One typed row per credit-note line, whatever its date.

    Unlike invoice lines, the line total is converted before it is rounded.
    """
    issued = F.col("fecha_emision")
    return raw.withColumn("fecha_emision", to_timestamp(_text("FechaEmision"))).select(
        F.col("SourceFile").alias("source_file"),
        _key("NumeroConsecutivo").alias("numero_consecutivo"),
        issued,
        issued.cast("date").alias("fecha"),
        F.col("Emisor_Nombre").alias("emisor_nombre"),
        provider_name(F.col("Emisor_NombreComercial"), F.col("Emisor_Nombre")).alias("proveedor"),
        _text("Emisor_Identificacion").alias("emisor_identificacion"),
        F.col("Receptor_Nombre").alias("receptor_nombre"),
        _text("Receptor_Identificacion").alias("receptor_identificacion"),
        _currency().alias("codigo_moneda"),
        _rate().alias("tipo_cambio"),
        F.col("Referencia_Numero").alias("referencia_numero"),
        to_timestamp(_text("Referencia_FechaEmision")).alias("referencia_fecha_emision"),
        F.col("Referencia_Codigo").alias("referencia_codigo"),
        F.col("Referencia_Razon").alias("referencia_razon"),
        _key("NumeroLinea").alias("numero_linea"),
        F.col("CodigoCABYS").alias("codigo_cabys"),
        F.col("Detalle").alias("detalle"),
        F.col("UnidadMedida").alias("unidad_medida"),
        to_cents(_amount("Cantidad")).alias("cantidad"),
        to_cents(_amount("PrecioUnitario")).alias("precio_unitario"),
        to_cents(_amount("SubTotal")).alias("subtotal"),
        to_cents(_amount("ImpuestoNeto")).alias("impuesto_neto"),
        to_cents(_amount("MontoTotalLinea")).alias("monto_total_linea"),
        to_cents(_amount("Impuesto_Tarifa")).alias("impuesto_tarifa"),
        to_cents(_amount("Impuesto_Monto")).alias("impuesto_monto"),
        to_cents(_amount("MontoTotalLinea") * _rate()).alias("monto_total_linea_crc"),
    )


def empty_credit_note_lines(spark: SparkSession) -> DataFrame:
    """The typed layout with no rows, for a client without credit notes."""
    return spark.createDataFrame([], CLEAN_CREDIT_NOTE_LINE)


def pick_credit_note_source(candidates: Iterable[DataFrame | None]) -> DataFrame | None:
    """The first candidate that has every column credit-note cleaning reads."""
    for candidate in candidates:
        if candidate is not None and not missing_columns(candidate, CREDIT_NOTE_COLUMNS):
            return candidate
    return None


def credit_note_lines(spark: SparkSession, candidates: Iterable[DataFrame | None]) -> DataFrame:
    source = pick_credit_note_source(candidates)
    return empty_credit_note_lines(spark) if source is None else clean_credit_note_lines(source)
