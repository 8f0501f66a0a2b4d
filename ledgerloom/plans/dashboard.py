"""The questions a dashboard asks of the derived tables."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions import r2
from ledgerloom.operators.columns import with_optional_columns
from ledgerloom.operators.prices import PRODUCT, latest_per
from ledgerloom.operators.providers import PERSON, named_providers, total, with_credit_terms, with_provider_id

# Fixed value: bars in a top chart.
TOP = 12


def read_query(spark: SparkSession, sql: str, params: dict[str, Any] | None = None, **tables: DataFrame) -> DataFrame:
    """SQL with named parameters (``:name``) over given tables (``{name}``)."""
    return spark.sql(sql, args=params or {}, **tables)


def _cents(amount: str) -> Column:
    """A sum of cents is a number of cents: rounding removes what the order of adding left."""
    return r2(F.sum(amount))


def invoice_monthly(invoice_lines: DataFrame) -> DataFrame:
    month = F.trunc(F.col("fecha_emision").cast("date"), "month").cast("timestamp_ntz")
    return (
        invoice_lines.filter(F.col("fecha_emision").isNotNull())
        .groupBy(month.alias("month"))
        .agg(
            F.count_distinct("numero_consecutivo").alias("invoices"),
            _cents("monto_total_linea_crc").alias("total_amount"),
            _cents("impuesto_monto_crc").alias("tax_amount"),
            _cents("cantidad").alias("units"),
        )
        .orderBy("month")
    )


def provider_totals(
    providers: DataFrame, invoices: DataFrame, products: DataFrame, credit_notes: DataFrame
) -> DataFrame:
    """Each provider with its document, product and credit-note totals, in no order.

    Every side is reduced to one row per provider before the joins.
    """
    invoice_totals = invoices.groupBy("provider_id").agg(
        F.count("*").alias("pending_invoices"), _cents("invoice_total_crc").alias("pending_amount_crc")
    )
    product_totals = products.groupBy("provider_id").agg(F.count("*").alias("product_count"))
    credit_note_totals = credit_notes.groupBy("provider_id").agg(
        F.count("*").alias("credit_note_count"), _cents("credit_note_total_crc").alias("credit_note_amount_crc")
    )
    known = with_optional_columns(providers, {"credit": None}).drop("invoice_count", "credit_note_count")
    joined = (
        known.join(invoice_totals, "provider_id", "left")
        .join(product_totals, "provider_id", "left")
        .join(credit_note_totals, "provider_id", "left")
    )

    def number(column: str) -> Column:
        return F.coalesce(F.col(column), F.lit(0)).alias(column)

    return joined.select(
        "provider_id",
        "provider_name",
        "legal_name",
        "provider_identification",
        "credit",
        number("pending_invoices"),
        number("pending_amount_crc"),
        number("product_count"),
        number("credit_note_count"),
        number("credit_note_amount_crc"),
        "first_seen_at",
        "last_seen_at",
    )


def provider_totals_of_lines(
    invoice_lines: DataFrame, credit_note_lines: DataFrame, previous: DataFrame | None = None
) -> DataFrame:
    """The same as ``provider_totals``, straight from the clean lines: one scan of either table and no join.

    Grouping sets turn each line into a document's, a product's and a provider's in one aggregate; a second one adds
    them up by provider. Names are keys of the third kind: the least of many texts would have to be
    sorted for, so only few rows come to that. ``previous`` brings the credit terms, as in ``providers``.
    """
    product = ["detalle", "codigo_cabys", "unidad_medida", "impuesto_tarifa"]
    document = ["provider_id", "numero_consecutivo"]

    def told(lines: DataFrame, kind: Column, *sets: list[str]) -> DataFrame:
        keys = list(dict.fromkeys(c for s in sets for c in s))
        totals = [F.min("fecha_emision").alias("first_seen_at"), F.max("fecha_emision").alias("last_seen_at"), total("monto_total_linea_crc").alias("amount")]
        marks = [F.grouping(c).alias(f"no {c}") for c in ("numero_consecutivo", "provider_name")]
        kind = F.when(F.col("no numero_consecutivo") == 0, kind).when(F.col("no provider_name") == 0, "person").otherwise("product")
        grouped = named_providers(lines).groupingSets(list(sets), *keys).agg(*marks, *totals).withColumn("kind", kind)
        parts = grouped.filter((F.col("kind") != "product") | F.col("detalle").isNotNull()) if "detalle" in keys else grouped
        return parts.select("provider_id", *PERSON, "first_seen_at", "last_seen_at", "amount", "kind")

    persons = ["provider_id", *PERSON]
    seen = told(invoice_lines, F.lit("invoice"), document, ["provider_id", *product], persons).union(
        told(credit_note_lines, F.lit("note"), document, persons)
    )

    # Without the least of a text, so that no rows are sorted before they are few.
    few = seen.groupBy("provider_id", *PERSON, "kind").agg(
        F.count("*").alias("rows"),
        F.sum("amount").alias("amount"),
        F.min("first_seen_at").alias("first_seen_at"),
        F.max("last_seen_at").alias("last_seen_at"),
    )

    def count(kind: str, name: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("rows"))), F.lit(0)).alias(name)

    def amount(kind: str, name: str) -> Column:
        return F.coalesce(r2(F.sum(F.when(F.col("kind") == kind, F.col("amount")))), F.lit(0)).alias(name)

    base = few.groupBy("provider_id").agg(
        F.min("provider_name").alias("provider_name"),
        F.min("legal_name").alias("legal_name"),
        F.min("provider_identification").alias("provider_identification"),
        count("invoice", "pending_invoices"),
        amount("invoice", "pending_amount_crc"),
        count("product", "product_count"),
        count("note", "credit_note_count"),
        amount("note", "credit_note_amount_crc"),
        F.min("first_seen_at").alias("first_seen_at"),
        F.max("last_seen_at").alias("last_seen_at"),
    )
    columns = ["provider_id", "provider_name", "legal_name", "provider_identification", "credit"]
    counts = ["pending_invoices", "pending_amount_crc", "product_count", "credit_note_count", "credit_note_amount_crc"]
    return with_credit_terms(base, previous).select(*columns, *counts, "first_seen_at", "last_seen_at")


def _by_amount() -> list[Column]:
    return [F.desc_nulls_last("pending_amount_crc"), F.asc_nulls_last("provider_name"), F.asc("provider_id")]


def provider_overview(totals: DataFrame) -> DataFrame:
    return totals.orderBy(*_by_amount())


def overview_kpis(totals: DataFrame) -> DataFrame:
    return totals.agg(
        F.count("*").alias("providers"),
        F.sum("pending_invoices").alias("pending_invoices"),
        F.sum("product_count").alias("products_tracked"),
        _cents("pending_amount_crc").alias("pending_amount"),
    )


def top_by_amount(totals: DataFrame, n: int = TOP) -> DataFrame:
    return totals.orderBy(*_by_amount()).limit(n).select("provider_id", "provider_name", "pending_amount_crc")


def top_by_products(totals: DataFrame, n: int = TOP) -> DataFrame:
    order = [F.desc_nulls_last("product_count"), *_by_amount()]
    return totals.orderBy(*order).limit(n).select("provider_id", "provider_name", "product_count")


def provider_labels(totals: DataFrame) -> DataFrame:
    label = F.concat(
        F.coalesce("provider_name", F.lit("Unknown provider")),
        F.lit(" | "),
        F.coalesce("provider_id", F.lit("no-id")),
    )
    return totals.select("provider_id", label.alias("provider_label"))


def provider_product_prices(
    products: DataFrame, history: DataFrame, provider: str | Column | None = None
) -> DataFrame:
    """Each product of a provider (of every provider if none is named) with its latest price.

    Null and "" count as one unit or code here, as do null and -1 as tax rate. Where both tables are stored by
    provider (``provider_id`` among their columns), one provider is read from a part of their files.
    """
    lines = with_provider_id(history)
    if provider is not None:
        wanted = F.col("provider_id") == provider
        products, lines = products.filter(wanted), lines.filter(wanted)
    latest = latest_per(lines, ["provider_id", *PRODUCT]).alias("latest")
    products = products.alias("products")

    def same(column: str, filler: Any = None) -> Column:
        left, right = F.col(f"products.{column}"), F.col(f"latest.{column}")
        if filler is None:
            return left == right
        return F.coalesce(left, F.lit(filler)) == F.coalesce(right, F.lit(filler))

    matched = [
        same("provider_id"),
        same("detalle"),
        same("codigo_cabys", ""),
        same("unidad_medida", ""),
        same("impuesto_tarifa", -1.0),
    ]
    return (
        products.join(latest, matched, "left")
        .select(
            "products.provider_id",
            F.col("products.detalle").alias("product"),
            "products.codigo_cabys",
            "products.unidad_medida",
            "products.impuesto_tarifa",
            F.col("latest.precio_unitario").alias("latest_price"),
            F.col("latest.fecha_emision").alias("latest_invoice_date"),
            F.col("latest.numero_consecutivo").alias("latest_invoice"),
            "products.purchase_line_count",
            "products.total_quantity",
            "products.total_spend_crc",
        )
        .orderBy(F.desc_nulls_last("total_spend_crc"), F.asc_nulls_last("product"))
    )
