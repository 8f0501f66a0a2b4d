"""Fixed layouts: raw lines, derived tables, run log and audit log."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# The raw line layout, one text column per document or line field.
RAW_COLUMNS = [
    # document
    "SourceFile",
    "TipoDocumento",
    "Clave",
    "NumeroConsecutivo",
    "FechaEmision",
    # issuer and receiver
    "Emisor_Nombre",
    "Emisor_NombreComercial",
    "Emisor_Identificacion",
    "Receptor_Nombre",
    "Receptor_Identificacion",
    # currency
    "CodigoMoneda",
    "TipoCambio",
    # reference to another document
    "Referencia_TipoDoc",
    "Referencia_Numero",
    "Referencia_FechaEmision",
    "Referencia_Codigo",
    "Referencia_Razon",
    # line
    "NumeroLinea",
    "CodigoCABYS",
    "Cantidad",
    "UnidadMedida",
    "TipoTransaccion",
    "Detalle",
    "PrecioUnitario",
    "MontoTotal",
    "SubTotal",
    "BaseImponible",
    "ImpuestoAsumidoEmisorFabrica",
    "ImpuestoNeto",
    "MontoTotalLinea",
    # first tax of the line
    "Impuesto_Codigo",
    "Impuesto_CodigoTarifaIVA",
    "Impuesto_Tarifa",
    "Impuesto_Monto",
]

# The columns that a prepared file must bring.
PREPARED_COLUMNS = [
    "SourceFile",
    "NumeroConsecutivo",
    "FechaEmision",
    "Emisor_Nombre",
    "Emisor_NombreComercial",
    "Emisor_Identificacion",
    "Receptor_Nombre",
    "Receptor_Identificacion",
    "NumeroLinea",
    "CodigoCABYS",
    "Cantidad",
    "UnidadMedida",
    "TipoTransaccion",
    "Detalle",
    "PrecioUnitario",
    "MontoTotal",
    "SubTotal",
    "BaseImponible",
    "ImpuestoNeto",
    "MontoTotalLinea",
    "Impuesto_Codigo",
    "Impuesto_CodigoTarifaIVA",
    "Impuesto_Tarifa",
    "Impuesto_Monto",
]

# The columns that a credit-note source must bring.
CREDIT_NOTE_COLUMNS = [
    "SourceFile",
    "NumeroConsecutivo",
    "FechaEmision",
    "Emisor_Nombre",
    "Emisor_NombreComercial",
    "Emisor_Identificacion",
    "Receptor_Nombre",
    "Receptor_Identificacion",
    "CodigoMoneda",
    "TipoCambio",
    "Referencia_Numero",
    "Referencia_FechaEmision",
    "Referencia_Codigo",
    "Referencia_Razon",
    "NumeroLinea",
    "CodigoCABYS",
    "Cantidad",
    "UnidadMedida",
    "Detalle",
    "PrecioUnitario",
    "SubTotal",
    "ImpuestoNeto",
    "MontoTotalLinea",
    "Impuesto_Tarifa",
    "Impuesto_Monto",
]

# Root element of a document and the type recorded for it.
DOCUMENT_TYPES = {
    "FacturaElectronica": "FACTURA",
    "NotaCreditoElectronica": "NOTA_CREDITO",
}

# Currency and rate of a document that names none.
DEFAULT_CURRENCY = "CRC"
DEFAULT_RATE = "1"

# Raw column and its heading in the credit-note review table.
REVIEW_HEADINGS = {
    "FechaEmision": "FECHA NOTA DE CREDITO",
    "Emisor_Nombre": "PROVEEDOR",
    "Referencia_Numero": "FACTURA ASOCIADA",
    "Receptor_Nombre": "RUBRO",
    "MontoTotalLinea": "FINAL",
}

# The ten derived tables, in the order their counts are reported.
DERIVED_TABLES = [
    "providers",
    "provider_invoices",
    "provider_products",
    "provider_credit_notes",
    "clean_invoice_lines",
    "facturas_individuales",
    "invoice_summary",
    "price_history",
    "latest_price_list",
    "price_changes",
]

# Tables whose cells may not be edited.
READ_ONLY_TABLES = {
    "pipeline_runs",
    "source_data_history",
    "credit_note_lines_history",
    "manual_edits_history",
}

# Columns added in front of every history row.
META_COLUMNS = ["run_id", "loaded_at"]
# ---------------------------------------------------------------------------


def _struct(**types: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, data_type) for name, data_type in types.items()])


_TEXT, _REAL, _TIME, _COUNT = T.StringType(), T.DoubleType(), T.TimestampNTZType(), T.IntegerType()

RAW_LINE = T.StructType([T.StructField(name, _TEXT) for name in RAW_COLUMNS])

CLEAN_CREDIT_NOTE_LINE = _struct(
    source_file=_TEXT,
    numero_consecutivo=_TEXT,
    fecha_emision=_TIME,
    fecha=T.DateType(),
    emisor_nombre=_TEXT,
    proveedor=_TEXT,
    emisor_identificacion=_TEXT,
    receptor_nombre=_TEXT,
    receptor_identificacion=_TEXT,
    codigo_moneda=_TEXT,
    tipo_cambio=_REAL,
    referencia_numero=_TEXT,
    referencia_fecha_emision=_TIME,
    referencia_codigo=_TEXT,
    referencia_razon=_TEXT,
    numero_linea=_TEXT,
    codigo_cabys=_TEXT,
    detalle=_TEXT,
    unidad_medida=_TEXT,
    cantidad=_REAL,
    precio_unitario=_REAL,
    subtotal=_REAL,
    impuesto_neto=_REAL,
    monto_total_linea=_REAL,
    impuesto_tarifa=_REAL,
    impuesto_monto=_REAL,
    monto_total_linea_crc=_REAL,
)

PIPELINE_RUN = _struct(
    run_id=_TEXT,
    client_id=_TEXT,
    run_type=_TEXT,
    status=_TEXT,
    started_at=_TIME,
    finished_at=_TIME,
    started_by=_TEXT,
    selected_run=T.BooleanType(),
    invoice_rows_uploaded=_COUNT,
    invoice_duplicates_removed=_COUNT,
    invoice_rows_loaded=_COUNT,
    credit_note_rows_uploaded=_COUNT,
    credit_note_duplicates_removed=_COUNT,
    credit_note_rows_loaded=_COUNT,
    derived_table_counts_json=_TEXT,
    error_message=_TEXT,
)

MANUAL_EDIT = _struct(
    edit_id=_TEXT,
    run_id=_TEXT,
    table_name=_TEXT,
    row_id=_TEXT,
    column_name=_TEXT,
    old_value=_TEXT,
    new_value=_TEXT,
    edited_by=_TEXT,
    edited_at=_TIME,
)
