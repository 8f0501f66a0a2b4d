"""Supplier dimension and what hangs off it: documents, products, credit notes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import blank_to_null, provider_id, to_cents
from ledgerloom.operators.columns import has_column


def with_provider_id(lines: DataFrame) -> DataFrame:
    if has_column(lines, "provider_id"):
        return lines
    return lines.withColumn("provider_id", provider_id(F.col("emisor_identificacion"), F.col("proveedor")))


def total(amount: str) -> Column:
    """Sum of a cents column, nulls as zero, back to cents."""
    return to_cents(F.sum(F.coalesce(F.col(amount), F.lit(0.0))))


def of_known_providers(lines: DataFrame) -> DataFrame:
    """The lines that name their provider by a tax identification or a name."""
    known = F.coalesce(blank_to_null(F.col("emisor_identificacion")), blank_to_null(F.col("proveedor"))).isNotNull()
    return lines.filter(known)


#: What tells of a provider.
PERSON = ["provider_identification", "provider_name", "legal_name"]


def named_providers(lines: DataFrame) -> DataFrame:
    """Lines of known providers with the provider's id and what tells of it (``PERSON``)."""
    identification = blank_to_null(F.col("emisor_identificacion"))
    names = dict(zip(PERSON, [identification, F.col("proveedor"), F.col("emisor_nombre")], strict=True))
    return with_provider_id(of_known_providers(lines)).withColumns(names)


def _seen(lines: DataFrame, is_invoice: bool) -> DataFrame:
    """Documents and dates of each provider, for every way in which lines tell of it."""
    number = "numero_consecutivo"
    sets = named_providers(lines).groupingSets([["provider_id", number], ["provider_id", *PERSON]], "provider_id", number, *PERSON)
    parts = sets.agg(
        F.grouping(number).alias("is_person"), F.min("fecha_emision").alias("first_seen_at"), F.max("fecha_emision").alias("last_seen_at")
    )
    documents = F.count(F.when(F.col("is_person") == 0, F.col(number)))
    counts = {"invoice_count": is_invoice, "credit_note_count": not is_invoice}
    return parts.groupBy("provider_id", *PERSON).agg(
        F.min("first_seen_at").alias("first_seen_at"),
        F.max("last_seen_at").alias("last_seen_at"),
        *[(documents if counted else F.sum(F.lit(0))).cast("long").alias(c) for c, counted in counts.items()],
    )


def providers(
    invoice_lines: DataFrame, credit_note_lines: DataFrame, previous: DataFrame | None = None
) -> DataFrame:
    """One row per known provider, with the credit terms kept from ``previous``.

    Grouping sets make documents and names distinct first, in one aggregate, and count afterwards: a dominant
    provider is spread over its documents. Names are keys there: the least of many texts would have to be
    sorted for, so it is taken of few rows.
    """
    seen = _seen(invoice_lines, True).unionByName(_seen(credit_note_lines, False))
    base = seen.groupBy("provider_id").agg(
        *[F.min(c).alias(c) for c in PERSON],
        F.min("first_seen_at").alias("first_seen_at"),
        F.max("last_seen_at").alias("last_seen_at"),
        F.sum("invoice_count").alias("invoice_count"),
        F.sum("credit_note_count").alias("credit_note_count"),
    )
    return with_credit_terms(base, previous).select(
        "provider_id",
        "provider_identification",
        "provider_name",
        "legal_name",
        "credit",
        "first_seen_at",
        "last_seen_at",
        "invoice_count",
        "credit_note_count",
    )


def with_credit_terms(base: DataFrame, previous: DataFrame | None) -> DataFrame:
    """Left join of the credit terms set by hand in the previous provider table."""
    if previous is None or not has_column(previous, "credit"):
        return base.withColumn("credit", F.lit(None).cast("string"))
    terms = previous.filter(F.col("credit").isNotNull()).select("provider_id", F.col("credit").cast("string"))
    return base.join(terms, "provider_id", "left")


def provider_invoices(invoice_lines: DataFrame) -> DataFrame:
    return (
        with_provider_id(invoice_lines)
        .groupBy("provider_id", "numero_consecutivo")
        .agg(
            F.min("fecha_emision").alias("fecha_emision"),
            F.min("proveedor").alias("proveedor"),
            F.min("receptor_nombre").alias("receptor_nombre"),
            F.min("codigo_moneda").alias("codigo_moneda"),
            F.min("tipo_cambio").alias("tipo_cambio"),
            total("monto_total_linea_crc").alias("invoice_total_crc"),
            F.count("*").alias("line_count"),
        )
    )


def provider_products(invoice_lines: DataFrame) -> DataFrame:
    return (
        with_provider_id(invoice_lines.filter(F.col("detalle").isNotNull()))
        .groupBy("provider_id", "detalle", "codigo_cabys", "unidad_medida", "impuesto_tarifa")
        .agg(
            F.min("proveedor").alias("proveedor"),
            F.min("fecha_emision").alias("first_seen_at"),
            F.max("fecha_emision").alias("last_seen_at"),
            F.count("*").alias("purchase_line_count"),
            total("cantidad").alias("total_quantity"),
            total("monto_total_linea_crc").alias("total_spend_crc"),
        )
        .select(
            "provider_id",
            "proveedor",
            "detalle",
            "codigo_cabys",
            "unidad_medida",
            "impuesto_tarifa",
            "first_seen_at",
            "last_seen_at",
            "purchase_line_count",
            "total_quantity",
            "total_spend_crc",
        )
    )


def provider_credit_notes(credit_note_lines: DataFrame) -> DataFrame:
    return (
        with_provider_id(credit_note_lines)
        .groupBy("provider_id", "numero_consecutivo")
        .agg(
            F.min("fecha_emision").alias("fecha_emision"),
            F.min("proveedor").alias("proveedor"),
            F.min("receptor_nombre").alias("receptor_nombre"),
            F.min("referencia_numero").alias("referencia_numero"),
            F.min("referencia_fecha_emision").alias("referencia_fecha_emision"),
            F.min("referencia_codigo").alias("referencia_codigo"),
            F.min("referencia_razon").alias("referencia_razon"),
            total("monto_total_linea_crc").alias("credit_note_total_crc"),
            F.count("*").alias("line_count"),
        )
    )
