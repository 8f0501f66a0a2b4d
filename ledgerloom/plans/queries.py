"""Every operator as a query over the star-schema tables.

Each takes a session and the folder of the tables and reads the tables whole.
Queries about files and stored tables write what they read to a new folder under
the shared one.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property, wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions import as_text, quoted
from ledgerloom.operators import clean, dedupe, edits, export, invoices, prices, providers
from ledgerloom.operators import preview as look
from ledgerloom.operators.checkpoints import scratch_folder, shuffles_freed
from ledgerloom.plans import dashboard
from ledgerloom.plans.workspace import Workspace
from ledgerloom.schemas import PREPARED_COLUMNS, RAW_COLUMNS
from ledgerloom.session import keep_compiled
from ledgerloom.sources import csv_batches, runs, signatures, star_schema, xml_documents
from ledgerloom.sources.datasets import read_dataset
from ledgerloom.sources.history import LineHistory
from ledgerloom.sources.intake import LOAD_ORDER
from ledgerloom.sources.tables import TableStore

Query = Callable[[SparkSession, str], DataFrame]

# Inside the range of order dates, so that later lines are dropped.
AS_OF = "2000-12-31 00:00:00"

_registry: dict[str, Query] = {}


def query(function: Query) -> Query:
    @wraps(function)
    def compiled(spark: SparkSession, folder: str) -> DataFrame:
        keep_compiled(spark)
        return function(spark, folder)

    _registry[function.__name__] = compiled
    return compiled


def registry() -> dict[str, Query]:
    return dict(_registry)


class Tables:
    """The derived tables of one folder, each built lazily from the raw lines."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    @cached_property
    def order_lines(self) -> DataFrame:
        return star_schema.order_lines(self.spark, self.folder)

    @cached_property
    def raw(self) -> DataFrame:
        return star_schema.raw_invoice_lines(self.order_lines)

    @cached_property
    def raw_notes(self) -> DataFrame:
        return star_schema.raw_credit_note_lines(self.order_lines)

    @cached_property
    def notes_of_orders(self) -> DataFrame:
        """Raw credit-note lines with the number of their order."""
        return star_schema.raw_credit_note_lines(self.order_lines, star_schema.ORDER)

    @cached_property
    def lines(self) -> DataFrame:
        return clean.clean_invoice_lines(self.raw, AS_OF)

    @cached_property
    def notes(self) -> DataFrame:
        return clean.clean_credit_note_lines(self.raw_notes)

    @cached_property
    def providers(self) -> DataFrame:
        return providers.providers(self.lines, self.notes)

    @cached_property
    def history(self) -> DataFrame:
        return prices.price_history(self.lines)

    @cached_property
    def totals(self) -> DataFrame:
        return dashboard.provider_totals_of_lines(self.lines, self.notes)

    @cached_property
    def run_events(self) -> DataFrame:
        """The run log: a stored snapshot of the older half of its events, and the events after it."""
        events = star_schema.run_events(self.spark, self.folder)
        middle = events.agg(F.min("at") + (F.max("at") - F.min("at")) / 2).first()[0]
        store = self.store("runs")
        older = F.col("at") < F.lit(middle)
        store.publish(runs.SNAPSHOT, runs.folded(events.filter(older)))
        return store.read(runs.SNAPSHOT).unionByName(events.filter(~older))

    @cached_property
    def runs(self) -> DataFrame:
        return runs.run_states(self.run_events)

    def store(self, purpose: str) -> TableStore:
        return TableStore(self.spark, scratch_folder(self.spark, purpose))

    @cached_property
    def statuses(self) -> list[str]:
        """Order statuses, which play the runs of the line history."""
        found = star_schema.table(self.spark, self.folder, "orders").select("o_orderstatus").distinct()
        return sorted(row[0] for row in found.collect())

    @property
    def documents(self) -> DataFrame:
        """XML documents of all invoice and credit-note lines as one table, spelled as they are read: they are many times the tables they are made of."""
        return star_schema.line_documents(self.raw).union(star_schema.line_documents(self.raw_notes))

    def landed_files(self, ascending: bool = True) -> tuple[str, str]:
        """Folders of archives of .xml files: one invoice per order, one credit note per order with returned lines."""
        folder = scratch_folder(self.spark, "xml-files")
        invoices_of_orders = star_schema.raw_invoice_lines(self.order_lines, star_schema.ORDER)
        for name, lines in (("invoices", invoices_of_orders), ("notes", self.notes_of_orders)):
            star_schema.land_archives(star_schema.order_documents(lines, ascending), f"{folder}/{name}")
        return f"{folder}/invoices", f"{folder}/notes"

    def edited_providers(self, original: DataFrame) -> DataFrame:
        """What a reviewer might do: set terms, capitalise, blank out a name."""
        terms = star_schema.credit_terms(self.spark, self.folder)
        number = F.length("provider_id") % 3
        return (
            original.drop("credit")
            .join(terms, "provider_id", "left")
            .select(
                "provider_id",
                "credit",
                F.when(number == 1, F.upper("legal_name")).otherwise(F.col("legal_name")).alias("legal_name"),
                F.when(number == 2, F.lit(None)).otherwise(F.col("provider_name")).alias("provider_name"),
            )
        )


class StoredTables(Tables):
    """The same tables over clean lines and notes that are written once and read back."""

    @cached_property
    def stock(self) -> TableStore:
        return self.store("stock")

    def kept(self, name: str, frame: DataFrame) -> DataFrame:
        self.stock.publish(name, frame)
        return self.stock.read(name)

    @cached_property
    def lines(self) -> DataFrame:
        return self.kept("clean_invoice_lines", clean.clean_invoice_lines(self.raw, AS_OF))

    @cached_property
    def notes(self) -> DataFrame:
        return self.kept("clean_credit_note_lines", clean.clean_credit_note_lines(self.raw_notes))

    @cached_property
    def line_points(self) -> DataFrame:
        """What products and their prices are made of, as it comes."""
        lines = providers.with_provider_id(Tables.lines.func(self))
        columns = ["provider_id", "proveedor", *prices.PRODUCT, *prices.TIMELINE, "cantidad", "monto_total_linea_crc"]
        return self.kept("line_points", lines.select(*columns))

    @cached_property
    def provider_lines(self) -> DataFrame:
        """The same, stored by provider. Finding the ranges reads the rows once more."""
        self.stock.publish("provider_lines", self.line_points, cluster_by=["provider_id"])
        return self.stock.read("provider_lines")

    @cached_property
    def price_points(self) -> DataFrame:
        """What price changes are made of, of the price history."""
        history = prices.price_history(Tables.lines.func(self))
        return self.kept("price_points", history.select("proveedor", *prices.PRODUCT, *prices.TIMELINE))


class ProviderTables(StoredTables):
    """Tables over what providers are made of, of clean lines and notes."""

    columns = ["emisor_identificacion", "proveedor", "emisor_nombre", "numero_consecutivo", "fecha_emision"]
    line_columns = note_columns = columns

    @cached_property
    def lines(self) -> DataFrame:
        return self.kept("lines_of_providers", Tables.lines.func(self).select(*self.line_columns))

    @cached_property
    def notes(self) -> DataFrame:
        return self.kept("notes_of_providers", Tables.notes.func(self).select(*self.note_columns))


class DerivedTables(ProviderTables):
    """Tables over what providers, their documents and products are made of, of all clean lines and notes."""

    total = [*ProviderTables.columns, "receptor_nombre", "monto_total_linea_crc"]
    line_columns = [*total, "codigo_moneda", "tipo_cambio", "detalle", "codigo_cabys", "unidad_medida", "impuesto_tarifa", "cantidad"]
    note_columns = [*total, "referencia_numero", "referencia_fecha_emision", "referencia_codigo", "referencia_razon"]


# -- sources -----------------------------------------------------------------


@query
def scan_parquet(spark: SparkSession, folder: str) -> DataFrame:
    return read_dataset(spark, f"{folder}/lineitem.parquet")


@query
def scan_csv(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_folder(spark, "orders-csv")
    star_schema.table(spark, folder, "orders").write.csv(path, header=True)
    found = read_dataset(spark, path, "csv")
    return found.withColumns(
        {
            "o_orderkey": F.col("o_orderkey").cast("bigint"),
            "o_custkey": F.col("o_custkey").cast("bigint"),
            "o_orderdate": F.col("o_orderdate").cast("timestamp_ntz"),
        }
    )


@query
def csv_batch_union(spark: SparkSession, folder: str) -> DataFrame:
    """Two layouts: returned lines without file name and date, last column first, the others without receiver."""
    path = scratch_folder(spark, "csv-batch")
    raw = Tables(spark, folder).raw
    returned = F.col("SourceFile") == "batch_r.xml"
    layouts = {
        "a": raw.filter(returned).select(*[c for c in reversed(RAW_COLUMNS) if c not in ("SourceFile", "FechaEmision")]),
        "b": raw.filter(~returned).drop("Receptor_Nombre"),
    }
    with shuffles_freed(spark):
        for name, frame in layouts.items():
            frame.write.csv(f"{path}/{name}", header=True, compression="gzip")
    united = csv_batches.read_csv_batch(spark, [f"{path}/{name}" for name in layouts], packed=True)
    # Spark names its part files at random.
    return united.withColumn("SourceFile", F.regexp_replace("SourceFile", "^part-.*[.]csv$", "part.csv"))


@query
def prepared_source_load(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_folder(spark, "prepared-csv")
    with shuffles_freed(spark):
        Tables(spark, folder).raw.select(*PREPARED_COLUMNS).write.csv(path, header=True, compression="gzip")
    return csv_batches.read_prepared_lines(spark, [path], packed=True)


@query
def xml_flatten(spark: SparkSession, folder: str) -> DataFrame:
    return xml_documents.flatten_documents(Tables(spark, folder).documents)


@query
def xml_files(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of .xml files with all lines of an order in one document."""
    landed = Tables(spark, folder).landed_files()
    return xml_documents.flatten_documents(xml_documents.read_documents(spark, landed))


@query
def load_without_run(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of .xml files, straight into tables."""
    landed = Tables(spark, folder).landed_files()
    workspace = Workspace(spark, scratch_folder(spark, "workspace"))
    workspace.load_invoice_xmls([landed[0]])
    workspace.load_credit_note_xmls([landed[1]])
    return workspace.table("source_data").unionByName(workspace.table("credit_note_lines"))


@query
def table_list(spark: SparkSession, folder: str) -> DataFrame:
    """Names of the tables of a workspace, with their rows."""
    workspace = Workspace(spark, scratch_folder(spark, "workspace"))
    for name in ("supplier", "part", "orders"):
        workspace.load_dataset(f"{folder}/{name}.parquet", f"the_{name}")
    workspace.store.publish("credit_notes", invoices.credit_note_review(Tables(spark, folder).raw_notes))
    return look.table_counts({name: workspace.table(name) for name in workspace.table_names()})


@query
def failed_run(spark: SparkSession, folder: str) -> DataFrame:
    """The run log after a run over credit notes where invoices are asked for, and the lines that stayed."""
    landed = f"{scratch_folder(spark, 'xml-files')}/notes"
    documents = star_schema.land_archives(star_schema.order_documents(Tables(spark, folder).notes_of_orders), landed)
    workspace = Workspace(spark, scratch_folder(spark, "workspace"))
    try:
        workspace.run_full_pipeline([landed], [landed], client_id="c", username="u", as_of=AS_OF)
    except ValueError:
        log = workspace.table("pipeline_runs").withColumn("documents", F.lit(documents).cast("long"))
        return log.select("client_id", "status", "selected_run", "error_message", "documents")
    raise AssertionError("a run without invoices must fail")


@query
def pipeline_run(spark: SparkSession, folder: str) -> DataFrame:
    """Row counts that the run log holds after a run from .xml files to derived tables."""
    invoices_folder, notes_folder = Tables(spark, folder).landed_files()
    workspace = Workspace(spark, scratch_folder(spark, "workspace"))
    run = workspace.run_full_pipeline([invoices_folder], [notes_folder], client_id="c", username="u", as_of=AS_OF)
    logged = workspace.runs.runs().filter((F.col("run_id") == run.run_id) & (F.col("status") == runs.SUCCESS))
    loaded = [F.struct(F.lit(c).alias("table"), F.col(c).cast("long").alias("rows")) for c in ("invoice_rows_loaded", "credit_note_rows_loaded")]
    derived = F.map_entries(F.from_json("derived_table_counts_json", "map<string, bigint>"))
    derived = F.transform(derived, lambda x: F.struct(x["key"].alias("table"), x["value"].alias("rows")))
    return logged.select(F.inline(F.concat(F.array(*loaded), derived)))


@query
def xml_invoices(spark: SparkSession, folder: str) -> DataFrame:
    return xml_documents.invoice_lines(Tables(spark, folder).documents)


@query
def xml_credit_notes(spark: SparkSession, folder: str) -> DataFrame:
    return xml_documents.credit_note_lines(Tables(spark, folder).documents)


@query
def xml_route(spark: SparkSession, folder: str) -> DataFrame:
    routed = xml_documents.routed_documents(Tables(spark, folder).documents)
    return routed.select("source_file", "TipoDocumento")


@query
def xml_rejects(spark: SparkSession, folder: str) -> DataFrame:
    return xml_documents.rejected_documents(Tables(spark, folder).documents)


@query
def param_sql(spark: SparkSession, folder: str) -> DataFrame:
    return dashboard.read_query(
        spark,
        """
        SELECT proveedor, codigo_moneda, count(*) AS line_count, min(precio_unitario) AS lowest_price
        FROM {lines}
        WHERE impuesto_tarifa = :rate AND monto_total_linea_crc >= :at_least
        GROUP BY proveedor, codigo_moneda
        """,
        {"rate": 13, "at_least": 100000},
        lines=Tables(spark, folder).lines,
    )


# -- typed lines and projections ---------------------------------------------


@query
def clean_invoice_lines(spark: SparkSession, folder: str) -> DataFrame:
    return Tables(spark, folder).lines


@query
def clean_credit_note_lines(spark: SparkSession, folder: str) -> DataFrame:
    return Tables(spark, folder).notes


@query
def optional_columns(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of a table without currency and rate."""
    raw = Tables(spark, folder).raw.drop("CodigoMoneda", "TipoCambio")
    return clean.clean_invoice_lines(raw, AS_OF)


@query
def empty_credit_notes(spark: SparkSession, folder: str) -> DataFrame:
    """Providers of a client whose credit-note tables lack the needed columns."""
    tables = Tables(spark, folder)
    review = invoices.credit_note_review(tables.raw_notes)
    return providers.providers(tables.lines, clean.credit_note_lines(spark, [None, review]))


@query
def credit_notes(spark: SparkSession, folder: str) -> DataFrame:
    return invoices.credit_note_review(Tables(spark, folder).raw_notes)


@query
def provider_id(spark: SparkSession, folder: str) -> DataFrame:
    named = providers.with_provider_id(Tables(spark, folder).lines)
    return named.groupBy("provider_id", "emisor_identificacion", "proveedor").agg(F.count("*").alias("line_count"))


# -- duplicates --------------------------------------------------------------


@query
def dedupe_lines(spark: SparkSession, folder: str) -> DataFrame:
    return dedupe.dedupe_lines(star_schema.with_blank_keys(Tables(spark, folder).raw))


def _loaded(frame: DataFrame) -> DataFrame:
    """Lines with their place in the order of loading, less the folders that are new in every run."""
    file = F.regexp_replace(F.element_at(F.split("load_path", "/"), -1), "[.]zst$", "")
    return frame.select(*RAW_COLUMNS, "load_rank", file.alias("load_file"), "load_row")


@query
def dedupe_keep_first(spark: SparkSession, folder: str) -> DataFrame:
    """Lines loaded from CSV files: returned ones first, by file name, in files that run from large to small lines."""
    landed = scratch_folder(spark, "load-order")
    star_schema.land_csv(Tables(spark, folder).order_lines, landed)
    given = [f"{landed}/returned", f"{landed}/others"]
    lines = csv_batches.read_prepared_lines(spark, given, load_order=True, packed=True)
    return _loaded(dedupe.dedupe_keep_first(lines, LOAD_ORDER))


@query
def dedupe_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Lines loaded from XML files, credit notes first, in documents that run from large to small lines."""
    invoices_folder, notes_folder = Tables(spark, folder).landed_files(ascending=False)
    documents = xml_documents.read_documents(spark, [notes_folder, invoices_folder])
    return _loaded(dedupe.dedupe_keep_first(xml_documents.flatten_documents(documents, load_order=True), LOAD_ORDER))


@query
def load_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return dedupe.duplicate_count(star_schema.with_blank_keys(Tables(spark, folder).raw))


# -- derived tables ----------------------------------------------------------


@query
def provider_invoices(spark: SparkSession, folder: str) -> DataFrame:
    return providers.provider_invoices(Tables(spark, folder).lines)


@query
def provider_products(spark: SparkSession, folder: str) -> DataFrame:
    return providers.provider_products(Tables(spark, folder).lines)


@query
def provider_credit_notes(spark: SparkSession, folder: str) -> DataFrame:
    return providers.provider_credit_notes(Tables(spark, folder).notes)


@query
def facturas_individuales(spark: SparkSession, folder: str) -> DataFrame:
    return invoices.facturas_individuales(Tables(spark, folder).lines)


@query
def invoice_summary(spark: SparkSession, folder: str) -> DataFrame:
    return invoices.invoice_summary(Tables(spark, folder).lines)


@query
def price_history(spark: SparkSession, folder: str) -> DataFrame:
    return Tables(spark, folder).history


@query
def latest_price_list(spark: SparkSession, folder: str) -> DataFrame:
    return prices.latest_price_list(Tables(spark, folder).history)


@query
def price_changes(spark: SparkSession, folder: str) -> DataFrame:
    return prices.price_changes(StoredTables(spark, folder).price_points)


@query
def price_changes_by_runs(spark: SparkSession, folder: str) -> DataFrame:
    """The same table from three times as many stretches of lines as the session has partitions."""
    tasks = 3 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    return prices.price_changes(StoredTables(spark, folder).price_points, tasks)


# -- dashboard ---------------------------------------------------------------


@query
def invoice_monthly(spark: SparkSession, folder: str) -> DataFrame:
    return dashboard.invoice_monthly(Tables(spark, folder).lines)


@query
def provider_overview(spark: SparkSession, folder: str) -> DataFrame:
    return dashboard.provider_overview(Tables(spark, folder).totals)


@query
def overview_kpis(spark: SparkSession, folder: str) -> DataFrame:
    return dashboard.overview_kpis(Tables(spark, folder).totals)


@query
def top_providers_amount(spark: SparkSession, folder: str) -> DataFrame:
    return dashboard.top_by_amount(Tables(spark, folder).totals)


@query
def top_providers_products(spark: SparkSession, folder: str) -> DataFrame:
    return dashboard.top_by_products(Tables(spark, folder).totals)


@query
def provider_labels(spark: SparkSession, folder: str) -> DataFrame:
    return dashboard.provider_labels(Tables(spark, folder).providers)


def _product_prices(lines: DataFrame, provider: str | None = None) -> DataFrame:
    history = lines.filter(F.col("detalle").isNotNull() & F.col("precio_unitario").isNotNull())
    return dashboard.provider_product_prices(providers.provider_products(lines), prices.provider_prices(history), provider)


@query
def provider_product_prices(spark: SparkSession, folder: str) -> DataFrame:
    """For every provider, so that the order of the stored lines does not matter."""
    return _product_prices(StoredTables(spark, folder).line_points)


@query
def provider_product_prices_of_one(spark: SparkSession, folder: str) -> DataFrame:
    """For the provider with the smallest id, found in the data."""
    lines = StoredTables(spark, folder).provider_lines
    # The value is named in the plan, so that it reaches the scan's filter.
    return _product_prices(lines, lines.agg(F.min("provider_id")).first()[0])


@query
def preview_filter(spark: SparkSession, folder: str) -> DataFrame:
    order = ["NumeroConsecutivo", "Emisor_NombreComercial", "SUBTOTAL"]
    rows = invoices.facturas_individuales(Tables(spark, folder).lines)
    return look.preview(rows, order, "emisor_nombrecomercial", "supplier#%_7", limit=500)


@query
def contains_number(spark: SparkSession, folder: str) -> DataFrame:
    """All documents whose total, as text, contains some digits."""
    return look.contains(invoices.facturas_individuales(Tables(spark, folder).lines), "SUBTOTAL", "77")


@query
def contains_by_signature(spark: SparkSession, folder: str) -> DataFrame:
    """Documents of the providers whose name contains some digits, from the files whose trigrams allow it."""
    tables = StoredTables(spark, folder)
    tables.stock.publish("facturas", invoices.facturas_individuales(Tables(spark, folder).lines), cluster_by=["Emisor_NombreComercial"])
    signatures.sign(tables.stock, "facturas", "Emisor_NombreComercial")
    return signatures.search(tables.stock, "facturas", "Emisor_NombreComercial", "Supplier#0%00_7")


@query
def table_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Row counts as they come with the writes."""
    tables = DerivedTables(spark, folder)
    lines, notes = tables.lines, tables.notes
    built = {
        "providers": tables.providers,
        "provider_invoices": providers.provider_invoices(lines),
        "provider_products": providers.provider_products(lines),
        "provider_credit_notes": providers.provider_credit_notes(notes),
        "facturas_individuales": invoices.facturas_individuales(lines),
    }
    counts = {name: tables.stock.publish(name, frame) for name, frame in built.items()}
    return look.table_counts({"clean_invoice_lines": lines, "no_such_table": None}).unionByName(
        spark.createDataFrame(list(counts.items()), "table string, rows long")
    )


@query
def table_inspect(spark: SparkSession, folder: str) -> DataFrame:
    return look.inspect(invoices.facturas_individuales(Tables(spark, folder).lines), ["NumeroConsecutivo"])


# -- tables and history --------------------------------------------------------


@query
def write_replace(spark: SparkSession, folder: str) -> DataFrame:
    """A table rebuilt from its own previous version."""
    tables = Tables(spark, folder)
    store = tables.store("replace")
    store.publish("facturas", invoices.facturas_individuales(tables.lines))
    store.publish("facturas", store.read("facturas").withColumn("SUBTOTAL", F.floor("SUBTOTAL")))
    return store.read("facturas")


def _line_history(tables: Tables) -> LineHistory:
    """One run per order status; the first has no receiver, the last no product."""
    history = LineHistory(tables.store("history"), "source_data_history")
    lines = star_schema.raw_invoice_lines(tables.order_lines, "o_orderstatus")
    run = F.concat(F.lit("run_"), F.col("o_orderstatus"))
    absent = {tables.statuses[0]: "Receptor_Nombre", tables.statuses[-1]: "Detalle"}
    columns = {f"run_{s}": [c for c in RAW_COLUMNS if c != absent.get(s)] for s in tables.statuses}
    history.append_runs(lines.withColumn("run", run).drop("o_orderstatus"), "run", columns)
    return history


@query
def history_append(spark: SparkSession, folder: str) -> DataFrame:
    rows = _line_history(Tables(spark, folder)).read()
    return rows.groupBy("run_id").agg(
        F.count("*").alias("rows"),
        F.count_distinct("NumeroConsecutivo").alias("documents"),
        F.min("NumeroConsecutivo").alias("first_document"),
    )


@query
def history_evolve(spark: SparkSession, folder: str) -> DataFrame:
    """A column new in the second run is null in the first; one missing in the third is ""."""
    return _line_history(Tables(spark, folder)).read().drop("loaded_at")


@query
def current_run(spark: SparkSession, folder: str) -> DataFrame:
    """The run of the second status."""
    tables = Tables(spark, folder)
    return _line_history(tables).read_run(f"run_{tables.statuses[:2][-1]}")


@query
def export_table(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_folder(spark, "export")
    summary = invoices.invoice_summary(Tables(spark, folder).lines)
    export.export_csv(summary, path, ["FECHA FACTURA", "PROVEEDOR", "FACTURA"], compression="gzip")
    return spark.read.csv(path, header=True, escape='"')


# -- runs --------------------------------------------------------------------


@query
def run_log(spark: SparkSession, folder: str) -> DataFrame:
    return runs.newest_first(Tables(spark, folder).runs)


@query
def select_run(spark: SparkSession, folder: str) -> DataFrame:
    """Every user's run once more, after one more selection of the oldest successful run."""
    tables = Tables(spark, folder)
    events = tables.run_events
    successes = tables.runs.filter(F.col("status") == runs.SUCCESS)
    oldest = successes.orderBy(F.asc_nulls_last("started_at"), "run_id").limit(1).select("run_id")
    moment = F.lit("2100-01-01 00:00:00").cast("timestamp_ntz")
    chosen = oldest.withColumns({"event": F.lit(runs.SELECTED), "at": moment})
    log = events.unionByName(chosen, allowMissingColumns=True)
    return runs.run_states(log).select("run_id", "status", "selected_run")


@query
def selected_run(spark: SparkSession, folder: str) -> DataFrame:
    return runs.selected_run(Tables(spark, folder).runs)


@query
def run_labels(spark: SparkSession, folder: str) -> DataFrame:
    return runs.run_labels(Tables(spark, folder).runs)


@query
def run_status_counts(spark: SparkSession, folder: str) -> DataFrame:
    return runs.status_counts(Tables(spark, folder).runs)


# -- edits -------------------------------------------------------------------


def _provider_changes(tables: Tables) -> tuple[DataFrame, DataFrame]:
    """The stored provider table and what a reviewer changed in it."""
    store = tables.store("providers")
    store.publish("providers", tables.providers)
    original = store.read("providers")
    return original, edits.changed_rows(original, tables.edited_providers(original), ["provider_id"])


@query
def edit_diff(spark: SparkSession, folder: str) -> DataFrame:
    _, changes = _provider_changes(Tables(spark, folder))
    return edits.cell_edits(changes, ["provider_id"])


@query
def edit_apply(spark: SparkSession, folder: str) -> DataFrame:
    original, changes = _provider_changes(Tables(spark, folder))
    return edits.apply_changes(original, changes, ["provider_id"])


@query
def edit_audit(spark: SparkSession, folder: str) -> DataFrame:
    _, changes = _provider_changes(Tables(spark, folder))
    rows = edits.audit_rows(edits.cell_edits(changes, ["provider_id"]), "providers", "reviewer", "run_F")
    return rows.drop("edit_id", "edited_at")


@query
def providers_credit_carry(spark: SparkSession, folder: str) -> DataFrame:
    """Providers rebuilt from the lines, with the terms set in the edited table."""
    tables = ProviderTables(spark, folder)
    original, changes = _provider_changes(tables)
    edited = edits.apply_changes(original, changes, ["provider_id"])
    return providers.providers(tables.lines, tables.notes, edited)


def _providers(spark: SparkSession, folder: str) -> DataFrame:
    return Tables(spark, folder).providers


_providers.__name__ = "providers"
query(_providers)
