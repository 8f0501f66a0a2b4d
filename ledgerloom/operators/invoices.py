"""Document-level tables for payment review."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import quoted, r2, to_cents, to_double
from ledgerloom.operators.columns import require_columns
from ledgerloom.operators.providers import total
from ledgerloom.schemas import REVIEW_HEADINGS

# The tax rates with a column of their own in the summary.
SUMMARY_RATES = [13, 1]


def facturas_individuales(invoice_lines: DataFrame) -> DataFrame:
    """One row per document number, whoever issued it."""
    return invoice_lines.groupBy(F.col("numero_consecutivo").alias("NumeroConsecutivo")).agg(
        F.min("fecha_emision").alias("FechaEmision"),
        F.min("proveedor").alias("Emisor_NombreComercial"),
        total("monto_total_linea_crc").alias("SUBTOTAL"),
    )


def _at_rate(amount: str, rate: int) -> Column:
    counted = F.when(F.col("impuesto_tarifa") == rate, F.coalesce(F.col(amount), F.lit(0.0)))
    return to_cents(F.sum(counted.otherwise(F.lit(0.0)))).alias(f"{amount} {rate}")


def invoice_summary(invoice_lines: DataFrame) -> DataFrame:
    """Payment review: one row per date, provider, document and receiver.

    ``SUBTOTAL`` is the tax total and ``TOTAL`` equals ``FINAL``; the headings are
    part of the data model and keep those values.
    """
    by_rate = {
        "SUBTOTAL": "subtotal_crc",
        "DESCUENTO": "descuento_estimado_crc",
        "IVA": "impuesto_monto_crc",
    }
    sums = invoice_lines.groupBy("fecha", "proveedor", "numero_consecutivo", "receptor_nombre").agg(
        *[_at_rate(amount, rate) for amount in by_rate.values() for rate in SUMMARY_RATES],
        total("descuento_estimado_crc").alias("discount"),
        total("impuesto_monto_crc").alias("tax"),
        total("monto_total_linea_crc").alias("payable"),
    )

    def rated(heading: str) -> list[Column]:
        return [F.col(quoted(f"{by_rate[heading]} {rate}")).alias(f"{heading} {rate}%") for rate in SUMMARY_RATES]

    nothing_yet = F.lit(None).cast("string")
    return sums.select(
        F.col("fecha").alias("FECHA FACTURA"),
        nothing_yet.alias("FECHA PAGO"),
        F.col("proveedor").alias("PROVEEDOR"),
        F.col("numero_consecutivo").alias("FACTURA"),
        nothing_yet.alias("NOTA DE CREDITO"),
        F.col("receptor_nombre").alias("RUBRO"),
        *rated("SUBTOTAL"),
        *rated("DESCUENTO"),
        F.col("discount").alias("DESCUENTO TOTAL"),
        *rated("IVA"),
        F.col("tax").alias("SUBTOTAL"),
        F.col("payable").alias("TOTAL"),
        F.col("payable").alias("FINAL"),
    )


def credit_note_review(raw_credit_notes: DataFrame) -> DataFrame:
    """Five review columns per credit-note line, the amount as cents."""
    require_columns(raw_credit_notes, REVIEW_HEADINGS, "Credit-note table")
    amount = REVIEW_HEADINGS["MontoTotalLinea"]
    renamed = raw_credit_notes.select(*[F.col(c).alias(heading) for c, heading in REVIEW_HEADINGS.items()])
    return renamed.withColumn(amount, r2(to_double(F.col(quoted(amount)).cast("string"))))
