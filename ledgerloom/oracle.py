"""DuckDB statements that give the same rows as the registered queries.

Used to check results only; nothing here is read by the Spark code.
"""

from __future__ import annotations

from ledgerloom.plans.queries import AS_OF
from ledgerloom.schemas import PREPARED_COLUMNS, RAW_COLUMNS


def _money(x: str) -> str:
    return f"cast(cast(round({x}, 2) as decimal(18, 2)) as varchar)"


def _moment(ts: str) -> str:
    return f"strftime({ts}, '%Y-%m-%dT%H:%M:%S') || '-06:00'"


def _list(columns: list[str]) -> str:
    return ", ".join(columns)


_JOINED = """
joined as (
  select *, l_extendedprice * (1 - l_discount) as net, c_nationkey % 3 as third,
         case when l_tax >= 0.05 then 13 when l_tax >= 0.01 then 1 end as rate
  from lineitem
  join orders on l_orderkey = o_orderkey
  join supplier on l_suppkey = s_suppkey
  join customer on o_custkey = c_custkey
  join part on l_partkey = p_partkey),
taxed as (select *, net * coalesce(rate, 0) / 100 as tax from joined)"""

_NUMBER = "lpad(cast(l_orderkey as varchar), 20, '0')"


def _raw(name: str, number: str, issued: str, kind: str, reference: list[str], condition: str) -> str:
    values = {
        "SourceFile": "'batch_' || lower(l_returnflag) || '.xml'",
        "TipoDocumento": f"'{kind}'",
        "Clave": f"'506' || {_NUMBER}",
        "NumeroConsecutivo": number,
        "FechaEmision": _moment(issued),
        "Emisor_Nombre": "s_name",
        "Emisor_NombreComercial": "case when s_suppkey % 7 = 0 then '' else 'TC ' || s_name end",
        "Emisor_Identificacion": "case when s_suppkey % 5 = 0 then '' else cast(s_suppkey as varchar) end",
        "Receptor_Nombre": "c_name",
        "Receptor_Identificacion": "cast(c_custkey as varchar)",
        "CodigoMoneda": "case third when 0 then 'USD' when 1 then '' else 'CRC' end",
        "TipoCambio": "case third when 0 then '512.5' when 1 then '0' else '1' end",
        **dict(zip([c for c in RAW_COLUMNS if c.startswith("Referencia_")], reference, strict=True)),
        "NumeroLinea": "cast(l_linenumber as varchar)",
        "CodigoCABYS": "split_part(p_name, ' ', 1)",
        "Cantidad": _money("l_quantity"),
        "UnidadMedida": "split_part(p_name, ' ', 2)",
        "TipoTransaccion": "'01'",
        "Detalle": "p_name",
        "PrecioUnitario": _money("l_extendedprice / l_quantity"),
        "MontoTotal": _money("l_extendedprice"),
        "SubTotal": _money("net"),
        "BaseImponible": _money("net"),
        "ImpuestoAsumidoEmisorFabrica": "'0'",
        "ImpuestoNeto": _money("tax"),
        "MontoTotalLinea": _money("net + tax"),
        "Impuesto_Codigo": "case when rate is null then '' else '01' end",
        "Impuesto_CodigoTarifaIVA": "case rate when 13 then '08' when 1 then '02' else '' end",
        "Impuesto_Tarifa": "coalesce(cast(rate as varchar), '')",
        "Impuesto_Monto": f"case when rate is null then '' else {_money('tax')} end",
    }
    columns = ",\n    ".join(f"{values[c]} as {c}" for c in RAW_COLUMNS)
    return f"{name} as (select\n    {columns}\n  from taxed where {condition})"


_RAW = _raw("raw", _NUMBER, "o_orderdate", "FACTURA", ["''"] * 5, "true")
_RAW_NOTES = _raw(
    "raw_notes",
    "'NC' || lpad(cast(l_orderkey as varchar), 18, '0')",
    "l_shipdate",
    "NOTA_CREDITO",
    ["'01'", _NUMBER, _moment("o_orderdate"), "'03'", "'Devuelto: ' || l_linestatus"],
    "l_returnflag = 'R'",
)

_SLUG = "lower(regexp_replace(proveedor, '[^A-Za-z0-9]+', '_', 'g'))"
_PROVIDER_ID = f"case when emisor_identificacion > '' then emisor_identificacion else {_SLUG} end"


def _number(column: str) -> str:
    return f"try_cast({column} as double)"


def _typed(optional: bool = True) -> str:
    """Columns that invoice and credit-note lines share, named as in the typed tables."""
    currency = "case trim(CodigoMoneda) when '' then 'CRC' else upper(trim(CodigoMoneda)) end"
    rate = f"case when {_number('TipoCambio')} <> 0 then {_number('TipoCambio')} else 1 end"
    return f"""
    SourceFile as source_file, trim(NumeroConsecutivo) as numero_consecutivo,
    try_cast(FechaEmision as timestamp) as fecha_emision, try_cast(FechaEmision as timestamp)::date as fecha,
    Emisor_Nombre as emisor_nombre,
    case when Emisor_NombreComercial = '' then Emisor_Nombre else Emisor_NombreComercial end as proveedor,
    Emisor_Identificacion as emisor_identificacion, Receptor_Nombre as receptor_nombre,
    Receptor_Identificacion as receptor_identificacion,
    {currency if optional else "'CRC'"} as codigo_moneda, {rate if optional else "1.0::double"} as tipo_cambio,
    trim(NumeroLinea) as numero_linea, CodigoCABYS as codigo_cabys, UnidadMedida as unidad_medida,
    Detalle as detalle, round({_number('Cantidad')}, 2) as cantidad,
    round({_number('PrecioUnitario')}, 2) as precio_unitario, round({_number('SubTotal')}, 2) as subtotal,
    round({_number('ImpuestoNeto')}, 2) as impuesto_neto,
    round({_number('MontoTotalLinea')}, 2) as monto_total_linea,
    round({_number('Impuesto_Tarifa')}, 2) as impuesto_tarifa,
    round({_number('Impuesto_Monto')}, 2) as impuesto_monto"""


def _lines(optional: bool = True) -> str:
    converted = [
        "precio_unitario",
        "monto_total",
        "subtotal",
        "base_imponible",
        "impuesto_neto",
        "monto_total_linea",
        "impuesto_monto",
        "descuento_estimado",
    ]
    return f"""
typed as (select {_typed(optional)},
    try_cast(FechaEmision[1:7] || '-01' as date) as mes, TipoTransaccion as tipo_transaccion,
    round({_number('MontoTotal')}, 2) as monto_total, round({_number('BaseImponible')}, 2) as base_imponible,
    Impuesto_Codigo as impuesto_codigo, Impuesto_CodigoTarifaIVA as impuesto_codigo_tarifa_iva,
    round(greatest(ifnull({_number('MontoTotal')}, 0) - ifnull({_number('SubTotal')}, 0), 0), 2) as descuento_estimado
  from raw),
lines as (
  select *, {", ".join(f"round({c} * tipo_cambio, 2) as {c}_crc" for c in converted)}
  from typed where fecha_emision <= timestamp '{AS_OF}')"""


_NOTES = f"""
notes as (select {_typed()},
    Referencia_Numero as referencia_numero, try_cast(Referencia_FechaEmision as timestamp) as referencia_fecha_emision,
    Referencia_Codigo as referencia_codigo, Referencia_Razon as referencia_razon,
    round({_number('MontoTotalLinea')} * case when {_number('TipoCambio')} <> 0 then {_number('TipoCambio')} else 1 end,
          2) as monto_total_linea_crc
  from raw_notes)"""

_PROVIDERS = f"""
known_documents as (
  select {_PROVIDER_ID} as provider_id, numero_consecutivo as invoice, null as note, * from lines
  where emisor_identificacion > '' or proveedor > ''
  union all by name
  select {_PROVIDER_ID} as provider_id, null as invoice, numero_consecutivo as note, * from notes
  where emisor_identificacion > '' or proveedor > ''),
providers as (
  select provider_id, min(nullif(emisor_identificacion, '')) as provider_identification,
         min(proveedor) as provider_name, min(emisor_nombre) as legal_name, cast(null as varchar) as credit,
         min(fecha_emision) as first_seen_at, max(fecha_emision) as last_seen_at,
         count(distinct invoice) as invoice_count, count(distinct note) as credit_note_count
  from known_documents group by provider_id)"""

_INVOICES = f"""
provider_invoices as (
  select {_PROVIDER_ID} as provider_id, numero_consecutivo, min(fecha_emision) as fecha_emision,
         min(proveedor) as proveedor, min(receptor_nombre) as receptor_nombre,
         min(codigo_moneda) as codigo_moneda, min(tipo_cambio) as tipo_cambio,
         round(sum(ifnull(monto_total_linea_crc, 0)), 2) as invoice_total_crc, count(*) as line_count
  from lines group by all)"""

_PRODUCTS = f"""
provider_products as (
  select {_PROVIDER_ID} as provider_id, min(proveedor) as proveedor, detalle, codigo_cabys, unidad_medida,
         impuesto_tarifa, min(fecha_emision) as first_seen_at, max(fecha_emision) as last_seen_at,
         count(*) as purchase_line_count, round(sum(ifnull(cantidad, 0)), 2) as total_quantity,
         round(sum(ifnull(monto_total_linea_crc, 0)), 2) as total_spend_crc
  from lines where detalle is not null group by all)"""

_PROVIDER_NOTES = f"""
provider_credit_notes as (
  select {_PROVIDER_ID} as provider_id, numero_consecutivo, min(fecha_emision) as fecha_emision,
         min(proveedor) as proveedor, min(receptor_nombre) as receptor_nombre,
         min(referencia_numero) as referencia_numero, min(referencia_fecha_emision) as referencia_fecha_emision,
         min(referencia_codigo) as referencia_codigo, min(referencia_razon) as referencia_razon,
         round(sum(ifnull(monto_total_linea_crc, 0)), 2) as credit_note_total_crc, count(*) as line_count
  from notes group by all)"""

_FACTURAS = """
facturas as (
  select numero_consecutivo as "NumeroConsecutivo", min(fecha_emision) as "FechaEmision",
         min(proveedor) as "Emisor_NombreComercial", round(sum(ifnull(monto_total_linea_crc, 0)), 2) as "SUBTOTAL"
  from lines group by numero_consecutivo)"""


def _rated(amount: str, rate: int) -> str:
    return f"round(sum(if(impuesto_tarifa = {rate}, ifnull({amount}, 0), 0)), 2)"


_SUMMARY = f"""
summary as (
  select fecha as "FECHA FACTURA", cast(null as varchar) as "FECHA PAGO", proveedor as "PROVEEDOR",
         numero_consecutivo as "FACTURA", cast(null as varchar) as "NOTA DE CREDITO", receptor_nombre as "RUBRO",
         {_rated("subtotal_crc", 13)} as "SUBTOTAL 13%", {_rated("subtotal_crc", 1)} as "SUBTOTAL 1%",
         {_rated("descuento_estimado_crc", 13)} as "DESCUENTO 13%",
         {_rated("descuento_estimado_crc", 1)} as "DESCUENTO 1%",
         round(sum(ifnull(descuento_estimado_crc, 0)), 2) as "DESCUENTO TOTAL",
         {_rated("impuesto_monto_crc", 13)} as "IVA 13%", {_rated("impuesto_monto_crc", 1)} as "IVA 1%",
         round(sum(ifnull(impuesto_monto_crc, 0)), 2) as "SUBTOTAL",
         round(sum(ifnull(monto_total_linea_crc, 0)), 2) as "TOTAL",
         round(sum(ifnull(monto_total_linea_crc, 0)), 2) as "FINAL"
  from lines group by fecha, proveedor, numero_consecutivo, receptor_nombre)"""

_HISTORY = """
price_history as (
  select proveedor, emisor_nombre, emisor_identificacion, receptor_nombre, receptor_identificacion, fecha_emision,
         fecha, mes, numero_consecutivo, numero_linea, codigo_cabys, detalle, unidad_medida, precio_unitario,
         impuesto_tarifa, impuesto_monto, cantidad, subtotal, monto_total_linea, descuento_estimado, source_file
  from lines where detalle is not null and precio_unitario is not null)"""


def _newest(group: str) -> str:
    return f"""row_number() over (
    partition by {group}, detalle, unidad_medida, codigo_cabys, impuesto_tarifa
    order by fecha_emision desc nulls last, numero_consecutivo desc nulls last, numero_linea desc nulls last,
             precio_unitario desc nulls last) = 1"""


_SEQUENCED = """
sequenced as (
  select *, lag(precio_unitario) over timeline as precio_anterior, lag(fecha_emision) over timeline as fecha_anterior
  from price_history
  window timeline as (
    partition by proveedor, detalle, unidad_medida, codigo_cabys, impuesto_tarifa
    order by fecha_emision nulls last, numero_consecutivo nulls last, numero_linea nulls last, precio_unitario))"""

_CHANGES = _SEQUENCED + """
select proveedor, detalle, impuesto_tarifa, fecha_anterior, fecha_emision, precio_anterior,
       precio_unitario as precio_nuevo, round(precio_unitario - precio_anterior, 2) as cambio_precio,
       round((precio_unitario - precio_anterior) / nullif(precio_anterior, 0) * 100, 2) as cambio_porcentaje,
       numero_consecutivo
from sequenced where precio_unitario <> precio_anterior"""

_TOTALS = """
totals as (
  select provider_id, provider_name, legal_name, provider_identification, credit,
         ifnull(pending_invoices, 0) as pending_invoices, ifnull(pending_amount_crc, 0) as pending_amount_crc,
         ifnull(product_count, 0) as product_count, ifnull(note_count, 0) as credit_note_count,
         ifnull(credit_note_amount_crc, 0) as credit_note_amount_crc, first_seen_at, last_seen_at
  from providers
  left join (select provider_id, count(*) as pending_invoices, round(sum(invoice_total_crc), 2) as pending_amount_crc
             from provider_invoices group by all) using (provider_id)
  left join (select provider_id, count(*) as product_count from provider_products group by all) using (provider_id)
  left join (select provider_id, count(*) as note_count, round(sum(credit_note_total_crc), 2) as credit_note_amount_crc
             from provider_credit_notes group by all) using (provider_id))"""

_BY_AMOUNT = "pending_amount_crc desc nulls last, provider_name nulls last, provider_id"

_BLANK_KEYS = f"""
keyed as (select * replace (
    if(NumeroLinea = '7', ' ', NumeroConsecutivo) as NumeroConsecutivo,
    case when NumeroLinea in ('6', '7') then '' when NumeroLinea = '5' then ' 5 ' else NumeroLinea end as NumeroLinea)
  from raw),
marked as (select *, trim(NumeroConsecutivo) as k1, trim(NumeroLinea) as k2 from keyed)"""


def _first_of_pair(order: list[str], table: str = "marked") -> str:
    terms = ", ".join(f"{c} nulls last" for c in order)
    return f"""from {table}
  qualify (k1 = '' and k2 = '') or row_number() over (partition by k1, k2 order by {terms}) = 1"""


# One document per line; lines 6 are cut short, lines 7 have another root.
_DOCUMENTS = """
documents_of_lines as (select * from raw union all select * from raw_notes),
parsed as (select * from documents_of_lines where NumeroLinea not in ('6', '7'))"""
_FILE = "TipoDocumento || '_' || NumeroConsecutivo || '_' || NumeroLinea || '.xml'"


def _flattened(condition: str) -> str:
    first = RAW_COLUMNS.index("NumeroLinea")
    head, tail = RAW_COLUMNS[1:first], RAW_COLUMNS[first:]
    spare = _list([("'0'" if c == "NumeroLinea" else "''") + f" as {c}" for c in tail])
    return f"""
select {_FILE} as SourceFile, {_list(head + tail)} from parsed where {condition}
union all
select {_FILE} as SourceFile, {_list(head)}, {spare} from parsed
where {condition} and cast(NumeroLinea as int) % 2 = 1"""


# One document per order and kind; where its lines differ, the smallest value counts.
_HEAD = [c for c in RAW_COLUMNS[1 : RAW_COLUMNS.index("NumeroLinea")] if c not in ("TipoDocumento", "NumeroConsecutivo")]


def _of_order(name: str, raw: str) -> str:
    """The lines of a raw table under the name ``name``, as documents of whole orders give them."""
    heads = _list([f"min({c}) over whole as {c}" for c in _HEAD])
    return f"""
{name} as (
  select * replace (TipoDocumento || '_' || NumeroConsecutivo || '.xml' as SourceFile, {heads})
  from {raw} window whole as (partition by TipoDocumento, NumeroConsecutivo))"""


_ORDER_FILES = [
    _JOINED,
    _RAW.replace("raw as (", "line_raw as (", 1),
    _RAW_NOTES.replace("raw_notes as (", "line_raw_notes as (", 1),
    _of_order("raw", "line_raw"),
    _of_order("raw_notes", "line_raw_notes"),
]


_EVENTS = """
log as (
  select event_id, ts as moment, 'run_' || user_id as run_id, props, cast(regexp_extract(props, '[0-9]+') as int) as k,
         case event_type when 'signup' then 'running' when 'purchase' then 'success'
                         when 'error' then 'failed' when 'click' then 'selected' end as event
  from events where event_type in ('signup', 'purchase', 'error', 'click'))"""


def _runs(log: str = "log") -> str:
    ended = "filter (where event in ('success', 'failed'))"
    return f"""
last_event as (
  select run_id, min(moment) filter (where event = 'running') as started_at, arg_max(event, moment) {ended} as outcome,
         max(moment) {ended} as finished_at, max(moment) filter (where event in ('success', 'selected')) as chosen_at,
         arg_max(k, moment) {ended} as k, arg_max(props, moment) {ended} as props
  from {log} group by run_id),
runs as (
  select run_id, if(started_at is null, null, 'client') as client_id,
         if(started_at is null, null, 'full_pipeline') as run_type, ifnull(outcome, 'running') as status,
         started_at, finished_at, if(started_at is null, null, 'system') as started_by,
         ifnull(chosen_at = (select max(chosen_at) from last_event), false) and outcome = 'success' as selected_run,
         if(outcome = 'success', k * 1000, null) as invoice_rows_loaded,
         if(outcome = 'success' and k > 50, k, null) as credit_note_rows_loaded,
         if(outcome = 'failed', 'failed with ' || props, null) as error_message
  from last_event)"""


_EDITS = """
terms as (
  select cast(user_id as varchar) as provider_id,
         cast(cast(floor(arg_max(value, (ts, event_id))) as bigint) as varchar) || ' days' as credit
  from events group by user_id),
edited as (
  select p.provider_id, t.credit,
         if(length(p.provider_id) % 3 = 1, upper(p.legal_name), p.legal_name) as legal_name,
         if(length(p.provider_id) % 3 = 2, null, p.provider_name) as provider_name
  from providers p left join terms t using (provider_id))"""

_CELLS = " union all ".join(
    f"""select provider_id as row_id, '{c}' as column_name, ifnull(p.{c}, '') as old_value, ifnull(e.{c}, '') as new_value
from providers p join edited e using (provider_id) where p.{c} is distinct from e.{c}"""
    for c in ("credit", "legal_name", "provider_name")
)

_FIRST_RUN, _LAST_RUN = (f"'run_' || (select {f}(o_orderstatus) from orders)" for f in ("min", "max"))
_RUN_LINES = f"""
run_lines as (
  select 'run_' || o_orderstatus as run_id, r.*
  from raw r join orders on r.Clave = '506' || lpad(cast(o_orderkey as varchar), 20, '0'))"""


def statements() -> dict[str, str]:
    invoice = [_JOINED, _RAW, _lines()]
    note = [_JOINED, _RAW_NOTES, _NOTES]
    both = [*invoice, _RAW_NOTES, _NOTES, _PROVIDERS]
    everything = [*both, _INVOICES, _PRODUCTS, _PROVIDER_NOTES, _TOTALS]
    documents = [_JOINED, _RAW, _RAW_NOTES, _DOCUMENTS]
    history = [*invoice, _HISTORY]
    run_log = [_EVENTS, _runs()]

    def sql(parts: list[str], final: str) -> str:
        return "with " + ",".join(parts) + "\n" + final

    changes = "with " + ",".join([*history, _CHANGES])
    product_prices = f"""
select p.provider_id, p.detalle as product, p.codigo_cabys, p.unidad_medida, p.impuesto_tarifa,
       l.precio_unitario as latest_price, l.fecha_emision as latest_invoice_date,
       l.numero_consecutivo as latest_invoice, p.purchase_line_count, p.total_quantity, p.total_spend_crc
from provider_products p left join latest l
  on l.provider_id = p.provider_id and l.detalle = p.detalle
 and ifnull(l.codigo_cabys, '') = ifnull(p.codigo_cabys, '')
 and ifnull(l.unidad_medida, '') = ifnull(p.unidad_medida, '')
 and ifnull(l.impuesto_tarifa, -1) = ifnull(p.impuesto_tarifa, -1)"""
    latest = f"""
identified as (select {_PROVIDER_ID} as provider_id, * from price_history),
latest as (select * from identified qualify {_newest("provider_id")})"""
    facturas = [*invoice, _FACTURAS]
    counted = ["clean_invoice_lines", "providers", "provider_invoices", "provider_products", "provider_credit_notes"]
    sources = {"clean_invoice_lines": "lines"}
    return {
        "scan_parquet": "select * from lineitem",
        "scan_csv": "select * from orders",
        "csv_batch_union": sql(
            [_JOINED, _RAW],
            """
select * replace (if(SourceFile = 'batch_r.xml', 'part.csv', SourceFile) as SourceFile,
       if(SourceFile = 'batch_r.xml', Receptor_Nombre, '') as Receptor_Nombre,
       if(SourceFile = 'batch_r.xml', '', FechaEmision) as FechaEmision)
from raw""",
        ),
        "prepared_source_load": sql([_JOINED, _RAW], f"select {_list(PREPARED_COLUMNS)} from raw"),
        "xml_flatten": sql(documents, _flattened("true")),
        "xml_files": sql(_ORDER_FILES, "select * from raw union all select * from raw_notes"),
        "load_without_run": sql(_ORDER_FILES, "select * from raw union all select * from raw_notes"),
        "table_list": " union all ".join(
            f"""select '{name}' as "table", count(*) as "rows" from {source}"""
            for name, source in {
                "the_supplier": "supplier",
                "the_part": "part",
                "the_orders": "orders",
                "credit_notes": "lineitem where l_returnflag = 'R'",
            }.items()
        ),
        "failed_run": """select 'c' as client_id, 'failed' as status, false as selected_run,
       'The XML files hold no line of any invoice' as error_message, count(distinct l_orderkey) as documents
from lineitem where l_returnflag = 'R'""",
        "pipeline_run": sql(
            [*_ORDER_FILES, _lines(), _NOTES, _PROVIDERS, _INVOICES, _PRODUCTS, _PROVIDER_NOTES, _FACTURAS, _SUMMARY, _HISTORY, _SEQUENCED],
            " union all ".join(
                f"select '{table}' as \"table\", count(*) as \"rows\" from ({source})"
                for table, source in {
                    "invoice_rows_loaded": "select 1 from raw",
                    "credit_note_rows_loaded": "select 1 from raw_notes",
                    "providers": "select 1 from providers",
                    "provider_invoices": "select 1 from provider_invoices",
                    "provider_products": "select 1 from provider_products",
                    "provider_credit_notes": "select 1 from provider_credit_notes",
                    "clean_invoice_lines": "select 1 from lines",
                    "facturas_individuales": "select 1 from facturas",
                    "invoice_summary": "select 1 from summary",
                    "price_history": "select 1 from price_history",
                    "latest_price_list": f"select 1 from price_history qualify {_newest('proveedor')}",
                    "price_changes": "select 1 from sequenced where precio_anterior <> precio_unitario",
                }.items()
            ),
        ),
        "xml_invoices": sql(documents, _flattened("TipoDocumento = 'FACTURA'")),
        "xml_credit_notes": sql(documents, _flattened("TipoDocumento = 'NOTA_CREDITO'")),
        "xml_route": sql(
            documents,
            f"""select {_FILE} as source_file, if(NumeroLinea in ('6', '7'), null, TipoDocumento) as TipoDocumento
from documents_of_lines""",
        ),
        "xml_rejects": sql(
            documents,
            f"""select {_FILE} as source_file, if(NumeroLinea = '7', 'other document', 'malformed') as reason
from documents_of_lines where NumeroLinea in ('6', '7')""",
        ),
        "param_sql": sql(
            invoice,
            """select proveedor, codigo_moneda, count(*) as line_count, min(precio_unitario) as lowest_price
from lines where impuesto_tarifa = 13 and monto_total_linea_crc >= 100000 group by all""",
        ),
        "clean_invoice_lines": sql(invoice, "select * from lines"),
        "clean_credit_note_lines": sql(note, "select * from notes"),
        "optional_columns": sql(
            [_JOINED, _RAW, _lines(optional=False)],
            "select * from lines",
        ),
        "empty_credit_notes": sql(
            [*invoice, _RAW_NOTES, _NOTES.replace("from raw_notes)", "from raw_notes where false)"), _PROVIDERS],
            "select * from providers",
        ),
        "credit_notes": sql(
            [_JOINED, _RAW_NOTES],
            f"""select FechaEmision as "FECHA NOTA DE CREDITO", Emisor_Nombre as "PROVEEDOR",
       Referencia_Numero as "FACTURA ASOCIADA", Receptor_Nombre as "RUBRO",
       round({_number("MontoTotalLinea")}, 2) as "FINAL" from raw_notes""",
        ),
        "provider_id": sql(
            invoice,
            f"""select {_PROVIDER_ID} as provider_id, emisor_identificacion, proveedor, count(*) as line_count
from lines group by all""",
        ),
        "dedupe_lines": sql(
            [_JOINED, _RAW, _BLANK_KEYS], f"select {_list(RAW_COLUMNS)} {_first_of_pair(_file_first())}"
        ),
        "dedupe_keep_first": sql(
            [
                _JOINED,
                _RAW,
                _BLANK_KEYS,
                f"""
placed as (select *, if(SourceFile = 'batch_r.xml', 0, 1) as load_rank, 'cents_' || right(PrecioUnitario, 2) || '.csv' as load_file from marked),
loaded as (
  select *, row_number() over (partition by load_rank, load_file order by {_list([f"{c} desc" for c in RAW_COLUMNS])}) - 1 as load_row
  from placed)""",
            ],
            "select * exclude (k1, k2) replace (k1 as NumeroConsecutivo, k2 as NumeroLinea) "
            + _first_of_pair(["load_rank", "load_file", "load_row"], "loaded"),
        ),
        "dedupe_documents": sql(
            [
                *_ORDER_FILES,
                f"""
loaded as (
  select *, if(TipoDocumento = 'FACTURA', 1, 0) as load_rank, SourceFile as load_file, NumeroConsecutivo as k1, NumeroLinea as k2,
         row_number() over (partition by SourceFile order by {_list([f"{c} desc" for c in RAW_COLUMNS[RAW_COLUMNS.index("NumeroLinea") :]])}) - 1 as load_row
  from (select * from raw union all select * from raw_notes))""",
            ],
            "select * exclude (k1, k2) " + _first_of_pair(["load_rank", "load_file", "load_row"], "loaded"),
        ),
        "load_metrics": sql(
            [_JOINED, _RAW, _BLANK_KEYS],
            f"""select (select count(*) from marked) as rows_uploaded,
       (select count(*) from marked) - (select count(*) from (select 1 {_first_of_pair(["k1"])})) as duplicates_removed,
       (select count(*) from (select 1 {_first_of_pair(["k1"])})) as rows_loaded""",
        ),
        "providers": sql(both, "select * from providers"),
        "provider_invoices": sql([*invoice, _INVOICES], "select * from provider_invoices"),
        "provider_products": sql([*invoice, _PRODUCTS], "select * from provider_products"),
        "provider_credit_notes": sql([*note, _PROVIDER_NOTES], "select * from provider_credit_notes"),
        "facturas_individuales": sql(facturas, "select * from facturas"),
        "invoice_summary": sql([*invoice, _SUMMARY], "select * from summary"),
        "price_history": sql(history, "select * from price_history"),
        "latest_price_list": sql(
            history,
            f"""select proveedor, detalle, precio_unitario, impuesto_tarifa, fecha_emision as ultima_fecha_emision,
       numero_consecutivo as ultimo_numero_consecutivo from price_history qualify {_newest("proveedor")}""",
        ),
        "price_changes": changes,
        "price_changes_by_runs": changes,
        "invoice_monthly": sql(
            invoice,
            """select cast(mes as timestamp) as month, count(distinct numero_consecutivo) as invoices,
       round(sum(monto_total_linea_crc), 2) as total_amount, round(sum(impuesto_monto_crc), 2) as tax_amount,
       round(sum(cantidad), 2) as units
from lines where fecha_emision is not null group by mes order by mes""",
        ),
        "provider_overview": sql(everything, f"select * from totals order by {_BY_AMOUNT}"),
        "overview_kpis": sql(
            everything,
            """select count(*) as providers, cast(sum(pending_invoices) as bigint) as pending_invoices,
       cast(sum(product_count) as bigint) as products_tracked, round(sum(pending_amount_crc), 2) as pending_amount
from totals""",
        ),
        "top_providers_amount": sql(
            everything,
            f"select provider_id, provider_name, pending_amount_crc from totals order by {_BY_AMOUNT} limit 12",
        ),
        "top_providers_products": sql(
            everything,
            f"""select provider_id, provider_name, product_count from totals
order by product_count desc, {_BY_AMOUNT} limit 12""",
        ),
        "provider_labels": sql(
            everything,
            """select provider_id, ifnull(provider_name, 'Unknown provider') || ' | ' || ifnull(provider_id, 'no-id')
       as provider_label from totals""",
        ),
        "provider_product_prices": sql([*history, _PRODUCTS, latest], product_prices),
        "provider_product_prices_of_one": sql(
            [*history, _PRODUCTS, latest],
            product_prices + "\nwhere p.provider_id = (select min(provider_id) from provider_products)",
        ),
        "preview_filter": sql(
            facturas,
            """select * from facturas where "Emisor_NombreComercial" ilike '%supplier#%_7%'
order by "NumeroConsecutivo", "Emisor_NombreComercial", "SUBTOTAL" limit 500""",
        ),
        "contains_number": sql(facturas, """select * from facturas where cast("SUBTOTAL" as varchar) ilike '%77%'"""),
        "contains_by_signature": sql(facturas, """select * from facturas where "Emisor_NombreComercial" ilike '%Supplier#0%00_7%'"""),
        "table_counts": sql(
            [*everything, _FACTURAS],
            " union all ".join(
                f"""select '{t}' as "table", count(*) as "rows" from {sources.get(t, t)}""" for t in counted
            )
            + """ union all select 'facturas_individuales' as "table", count(*) as "rows" from facturas""",
        ),
        "table_inspect": sql(
            [
                *facturas,
                """
first_rows as (
  select cast(row_number() over (order by "NumeroConsecutivo") - 1 as int) as sample, *
  from (select * from facturas order by "NumeroConsecutivo" limit 5))""",
            ],
            " union all ".join(
                f"""select sample, cast({i} as int) as position, '{c}' as column_name, '{t}' as data_type,
       cast("{c}" as varchar) as value from first_rows"""
                for i, (c, t) in enumerate(
                    [
                        ("NumeroConsecutivo", "string"),
                        ("FechaEmision", "timestamp_ntz"),
                        ("Emisor_NombreComercial", "string"),
                        ("SUBTOTAL", "double"),
                    ]
                )
            ),
        ),
        "write_replace": sql(
            facturas,
            """select "NumeroConsecutivo", "FechaEmision", "Emisor_NombreComercial",
       cast(floor("SUBTOTAL") as bigint) as "SUBTOTAL" from facturas""",
        ),
        "history_append": sql(
            [_JOINED, _RAW, _RUN_LINES],
            """select run_id, count(*) as "rows", count(distinct NumeroConsecutivo) as documents,
       min(NumeroConsecutivo) as first_document from run_lines group by run_id""",
        ),
        "history_evolve": sql(
            [_JOINED, _RAW, _RUN_LINES],
            f"""select * replace (if(run_id = {_FIRST_RUN}, null, Receptor_Nombre) as Receptor_Nombre,
       if(run_id = {_LAST_RUN}, '', Detalle) as Detalle) from run_lines""",
        ),
        "current_run": sql(
            [_JOINED, _RAW, _RUN_LINES],
            """select * exclude (run_id) from run_lines
where run_id = 'run_' || (select list_sort(list(distinct o_orderstatus))[2] from orders)""",
        ),
        "export_table": sql([*invoice, _SUMMARY], "select cast(columns(*) as varchar) from summary"),
        "run_log": sql(
            run_log,
            """select run_id, client_id, run_type, status, started_at, finished_at, started_by, selected_run,
       invoice_rows_loaded, credit_note_rows_loaded, error_message from runs order by started_at desc nulls last, run_id""",
        ),
        "select_run": sql(
            [
                *run_log,
                """
longer as (
  select moment, run_id, event, k, props from log
  union all
  select timestamp '2100-01-01', (select run_id from runs where status = 'success'
                                  order by started_at nulls last, run_id limit 1), 'selected', null, null)""",
                _runs("longer").replace("last_event", "last_longer").replace("runs as", "longer_runs as"),
            ],
            "select run_id, status, selected_run from longer_runs",
        ),
        "selected_run": sql(
            run_log,
            """select run_id from runs where status = 'success'
order by selected_run desc, started_at desc nulls last, run_id limit 1""",
        ),
        "run_labels": sql(
            run_log,
            """select run_id, replace(strftime(started_at, '%Y-%m-%d %H:%M:%S.%f'), '.000000', '') || ' | invoices: '
       || format('{:,}', ifnull(invoice_rows_loaded, 0)) || ' | credit notes: '
       || format('{:,}', ifnull(credit_note_rows_loaded, 0)) as run_label
from runs where status = 'success'""",
        ),
        "run_status_counts": sql(run_log, "select status, count(*) as runs from runs group by status"),
        "edit_diff": sql([*both, _EDITS], _CELLS),
        "edit_apply": sql(
            [*both, _EDITS],
            """select p.* replace (e.credit as credit, e.legal_name as legal_name, e.provider_name as provider_name)
from providers p join edited e using (provider_id)""",
        ),
        "edit_audit": sql(
            [*both, _EDITS],
            f"""select 'run_F' as run_id, 'providers' as table_name, row_id, column_name, old_value, new_value,
       'reviewer' as edited_by from ({_CELLS})""",
        ),
        "providers_credit_carry": sql(
            [*both, _EDITS],
            "select p.* replace (e.credit as credit) from providers p join edited e using (provider_id)",
        ),
    }


def _file_first() -> list[str]:
    return ["SourceFile", *[c for c in RAW_COLUMNS if c != "SourceFile"]]
