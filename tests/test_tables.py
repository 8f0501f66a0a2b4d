"""Hand-worked results for the small purchase, and edge rows."""

import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerloom.operators import clean, dedupe, edits, invoices, prices, providers
from ledgerloom.operators import preview as look
from ledgerloom.operators.ordered_lag import ranged, with_previous
from ledgerloom.plans import dashboard
from ledgerloom.sources.tables import TableStore
from ledgerloom.schemas import CLEAN_CREDIT_NOTE_LINE
from tests.samples import AS_OF, FIRST, INVOICE_ROWS, NOTE, NOTE_ROWS, SECOND, raw_frame, raw_row


def dicts(df):
    return [r.asDict() for r in df.collect()]


@pytest.fixture(scope="module")
def lines(spark):
    return clean.clean_invoice_lines(raw_frame(spark, INVOICE_ROWS), AS_OF).cache()


@pytest.fixture(scope="module")
def notes(spark):
    return clean.clean_credit_note_lines(raw_frame(spark, NOTE_ROWS)).cache()


def cleaned(spark, *rows, **options):
    return dicts(clean.clean_invoice_lines(raw_frame(spark, rows), AS_OF, **options))


def test_clean_shapes(lines, notes):
    assert (lines.count(), len(lines.columns)) == (3, 37)
    assert (notes.count(), [(f.name, f.dataType) for f in notes.schema]) == (
        1,
        [(f.name, f.dataType) for f in CLEAN_CREDIT_NOTE_LINE],
    )


def test_future_and_unreadable_dates_go(spark):
    rows = [raw_row(FechaEmision=d) for d in ("2026-02-28T23:00:00-06:00", "2026-03-02", "mañana", "")]
    assert [r["fecha"] for r in cleaned(spark, *rows)] == [dt.date(2026, 2, 28)]
    assert [r["mes"] for r in cleaned(spark, *rows)] == [dt.date(2026, 2, 1)]


def test_credit_notes_keep_unreadable_dates(spark):
    frame = clean.clean_credit_note_lines(raw_frame(spark, [raw_row(FechaEmision="mañana")]))
    assert frame.first().fecha is None


@pytest.mark.parametrize(
    ("currency", "rate", "expected"),
    [
        (" usd ", "512.5", ("USD", 512.5, 513.0)),
        ("", "0", ("CRC", 1.0, 1.0)),
        ("EUR", "", ("EUR", 1.0, 1.0)),
        ("EUR", "0.3333", ("EUR", 0.3333, 0.33)),
    ],
)
def test_rates(spark, currency, rate, expected):
    row = cleaned(
        spark, raw_row(FechaEmision="2026-01-01", CodigoMoneda=currency, TipoCambio=rate, SubTotal="1.001")
    )[0]
    assert (row["codigo_moneda"], row["tipo_cambio"]) == expected[:2]
    # Rounded to 1.0 first, converted afterwards.
    assert row["subtotal_crc"] == pytest.approx(round(1.0 * expected[1], 2))


def test_credit_note_total_is_converted_before_rounding(spark):
    frame = clean.clean_credit_note_lines(raw_frame(spark, [raw_row(TipoCambio="512.5", MontoTotalLinea="1.004")]))
    row = frame.first()
    assert (row.monto_total_linea, row.monto_total_linea_crc) == (1.0, 514.55)


def test_discount_is_never_negative_nor_null(spark):
    rows = [raw_row(FechaEmision="2026-01-01", MontoTotal=a, SubTotal=b) for a, b in [("5", "7"), ("", ""), ("9", "")]]
    assert [r["descuento_estimado"] for r in cleaned(spark, *rows)] == [0.0, 0.0, 9.0]


def test_provider_name_falls_back_untrimmed(spark):
    rows = [raw_row(FechaEmision="2026-01-01", Emisor_NombreComercial=n) for n in ("", " x ")]
    assert [r["proveedor"] for r in cleaned(spark, *rows)] == ["Huerta Verde S.A.", " x "]


def test_missing_currency_columns(spark):
    raw = raw_frame(spark, INVOICE_ROWS).drop("CodigoMoneda", "TipoCambio")
    row = clean.clean_invoice_lines(raw, AS_OF).first()
    assert (row.codigo_moneda, row.tipo_cambio) == ("CRC", 1.0)


def test_credit_note_source_is_the_first_complete_one(spark):
    full = raw_frame(spark, NOTE_ROWS)
    review = invoices.credit_note_review(full)
    assert clean.pick_credit_note_source([None, review, full]) is full
    empty = clean.credit_note_lines(spark, [None, review])
    assert empty.schema == CLEAN_CREDIT_NOTE_LINE and empty.isEmpty()


def test_providers(lines, notes):
    (row,) = dicts(providers.providers(lines, notes))
    assert row == {
        "provider_id": "3101000001",
        "provider_identification": "3101000001",
        "provider_name": "Huerta Verde",
        "legal_name": "Huerta Verde S.A.",
        "credit": None,
        "first_seen_at": dt.datetime(2026, 1, 15, 10),
        "last_seen_at": dt.datetime(2026, 2, 5, 12),
        "invoice_count": 2,
        "credit_note_count": 1,
    }


def test_unknown_providers_are_left_out_of_the_dimension_only(spark):
    raw = raw_frame(
        spark,
        [raw_row(FechaEmision="2026-01-01", Emisor_Identificacion="", Emisor_NombreComercial="", Emisor_Nombre="")],
    )
    lines = clean.clean_invoice_lines(raw, AS_OF)
    assert providers.providers(lines, clean.empty_credit_note_lines(spark)).isEmpty()
    assert [r["provider_id"] for r in dicts(providers.provider_invoices(lines))] == [""]


def test_credit_terms_survive_a_rebuild(spark, lines, notes):
    previous = providers.providers(lines, notes).withColumn("credit", F.lit("30 days"))
    assert providers.providers(lines, notes, previous).first().credit == "30 days"
    assert providers.providers(lines, notes, previous.drop("credit")).first().credit is None


def test_provider_tables(lines, notes):
    totals = {r["numero_consecutivo"]: r for r in dicts(providers.provider_invoices(lines))}
    assert {k: (r["invoice_total_crc"], r["line_count"]) for k, r in totals.items()} == {
        FIRST: (29720.0, 2),
        SECOND: (11752.0, 1),
    }
    products = {r["detalle"]: r for r in dicts(providers.provider_products(lines))}
    assert {
        k: (r["purchase_line_count"], r["total_quantity"], r["total_spend_crc"]) for k, r in products.items()
    } == {"Tomate": (2, 18.0, 25312.0), "Queso": (1, 5.0, 16160.0)}
    (note,) = dicts(providers.provider_credit_notes(notes))
    assert (note["numero_consecutivo"], note["credit_note_total_crc"], note["referencia_numero"]) == (
        NOTE,
        1356.0,
        FIRST,
    )


def test_invoice_tables(lines):
    assert {r["NumeroConsecutivo"]: r["SUBTOTAL"] for r in dicts(invoices.facturas_individuales(lines))} == {
        FIRST: 29720.0,
        SECOND: 11752.0,
    }
    summary = {r["FACTURA"]: r for r in dicts(invoices.invoice_summary(lines))}
    amounts = ["SUBTOTAL 13%", "SUBTOTAL 1%", "IVA 13%", "IVA 1%", "SUBTOTAL", "TOTAL", "FINAL", "DESCUENTO TOTAL"]
    assert [summary[FIRST][a] for a in amounts] == [12000, 16000, 1560, 160, 1720, 29720, 29720, 0]
    assert [summary[SECOND][a] for a in amounts] == [10400, 0, 1352, 0, 1352, 11752, 11752, 0]
    assert summary[FIRST]["FECHA PAGO"] is None and len(summary[FIRST]) == 16


def test_one_number_of_two_providers(spark):
    rows = [{**INVOICE_ROWS[0], "Emisor_Identificacion": i, "Emisor_NombreComercial": n} for i, n in ("1a", "2b")]
    lines = clean.clean_invoice_lines(raw_frame(spark, rows), AS_OF)
    counts = [
        f(lines).count()
        for f in (invoices.facturas_individuales, providers.provider_invoices, invoices.invoice_summary)
    ]
    assert counts == [1, 2, 2]


def test_price_tables(lines):
    history = prices.price_history(lines)
    assert (history.count(), len(history.columns)) == (3, 21)
    latest = {r["detalle"]: r for r in dicts(prices.latest_price_list(history))}
    assert {k: (r["precio_unitario"], r["ultimo_numero_consecutivo"]) for k, r in latest.items()} == {
        "Tomate": (1300.0, SECOND),
        "Queso": (3200.0, FIRST),
    }
    (change,) = dicts(prices.price_changes(history))
    assert (change["precio_anterior"], change["precio_nuevo"], change["cambio_precio"]) == (1200.0, 1300.0, 100.0)
    assert (change["cambio_porcentaje"], change["fecha_anterior"]) == (8.33, dt.datetime(2026, 1, 15, 10))


def test_price_change_from_zero_has_no_percentage(spark):
    rows = [{**INVOICE_ROWS[0], "PrecioUnitario": "0"}, INVOICE_ROWS[2]]
    history = prices.price_history(clean.clean_invoice_lines(raw_frame(spark, rows), AS_OF))
    assert [r["cambio_porcentaje"] for r in dicts(prices.price_changes(history))] == [None]


def test_copies_of_a_line_change_no_price(spark):
    rows = [INVOICE_ROWS[0], *[INVOICE_ROWS[2]] * 5]
    history = prices.price_history(clean.clean_invoice_lines(raw_frame(spark, rows), AS_OF))
    assert prices.price_changes(history).count() == 1


def test_line_numbers_order_as_text(spark):
    rows = [{**INVOICE_ROWS[0], "NumeroLinea": n, "PrecioUnitario": p} for n, p in (("2", "5"), ("10", "7"))]
    history = prices.price_history(clean.clean_invoice_lines(raw_frame(spark, rows), AS_OF))
    (change,) = dicts(prices.price_changes(history))
    assert (change["precio_anterior"], change["precio_nuevo"]) == (7.0, 5.0)


@pytest.mark.parametrize("tasks", [None, 1, 7, 100])
def test_previous_row_across_stretches(spark, tasks):
    rows = [("hot" if i % 3 else f"k{i % 7}", i // 4, i, float(i * 7 % 11)) for i in range(400)]
    frame = spark.createDataFrame(rows, "k string, t int, n int, v double")
    frame = frame.union(spark.createDataFrame([("hot", None, None, 1.0), (None, 3, 1, 2.0), (None, 40, 1, 3.0)], frame.schema))
    cut = with_previous(frame, ["k"], ["t", "n"], {"v": "before", "t": "when"}, tasks)
    window = Window.partitionBy("k").orderBy(F.asc_nulls_last("t"), F.asc_nulls_last("n"))
    plain = frame.withColumns({"before": F.lag("v").over(window), "when": F.lag("t").over(window)})
    assert sorted(map(tuple, plain.collect()), key=repr) == sorted(map(tuple, cut.collect()), key=repr)


def test_previous_row_keeps_copies(spark):
    frame = spark.createDataFrame([("a", 1, 5.0)] * 4, "k string, t int, v double")
    for tasks in (None, 4):
        found = with_previous(frame, ["k"], ["t"], {"v": "before"}, tasks)
        assert sorted(repr(r.before) for r in found.collect()) == ["5.0", "5.0", "5.0", "None"]
    assert with_previous(frame.limit(0), ["k"], ["t"], {"v": "before"}).count() == 0


def test_previous_row_of_odd_groups(spark):
    odd = [None, float("nan"), 0.0, -0.0, 1.5]
    rows = [(odd[i % 5], i // 5, float(i)) for i in range(60)]
    frame = spark.createDataFrame(rows, "k double, t int, v double").repartition(4)
    window = Window.partitionBy("k").orderBy(F.asc_nulls_last("t"), "v")
    plain = frame.withColumn("before", F.lag("v").over(window)).select("t", "v", "before")
    found = with_previous(frame, ["k"], ["t", "v"], {"v": "before"}, 9).select("t", "v", "before")
    assert sorted(map(repr, plain.collect())) == sorted(map(repr, found.collect()))


def test_a_hot_group_is_dealt_over_all_tasks(spark):
    """A third of all rows is one product on one day, and half of those are one line repeated."""
    hot = spark.range(6000).select(F.lit("hot").alias("k"), F.lit(1).alias("t"), F.greatest(F.col("id") - 3000, F.lit(0)).alias("n"))
    rest = spark.range(12000).select(F.concat(F.lit("p"), F.col("id") % 400).alias("k"), (F.col("id") % 7).cast("int").alias("t"), F.col("id").alias("n"))
    rows = hot.union(rest).repartition(12)
    dealt = ranged(rows, ["k", "t", "n"], 12)
    sizes = dealt.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n"), F.sum((F.col("k") == "hot").cast("int")).alias("hot")).collect()
    assert len(sizes) == 12 and max(r.n for r in sizes) < 2 * 18000 / 12 and sum(r.hot > 0 for r in sizes) >= 4


def test_monthly(lines):
    found = [tuple(r) for r in dashboard.invoice_monthly(lines).collect()]
    assert found == [
        (dt.datetime(2026, 1, 1), 1, 29720.0, 1720.0, 15.0),
        (dt.datetime(2026, 2, 1), 1, 11752.0, 1352.0, 8.0),
    ]


def test_overview(lines, notes):
    totals = dashboard.provider_totals(
        providers.providers(lines, notes).drop("credit"),
        providers.provider_invoices(lines),
        providers.provider_products(lines),
        providers.provider_credit_notes(notes),
    )
    (row,) = dicts(dashboard.provider_overview(totals))
    assert (row["pending_invoices"], row["pending_amount_crc"], row["product_count"]) == (2, 41472.0, 2)
    assert (row["credit_note_count"], row["credit_note_amount_crc"], row["credit"]) == (1, 1356.0, None)
    assert tuple(dashboard.overview_kpis(totals).first()) == (1, 2, 2, 41472.0)
    assert dashboard.provider_labels(totals).first().provider_label == "Huerta Verde | 3101000001"


def odd_line_rows(n=400):
    """Lines of known and unknown providers, with and without products, amounts and documents in common."""
    for i in range(n):
        yield {
            **INVOICE_ROWS[i % 3],
            "Emisor_Identificacion": ["", "31", "32", None, " ", "33"][i % 6],
            "Emisor_NombreComercial": ["", "Tc A", None, "Ünd-b"][i % 4],
            "Emisor_Nombre": ["", "Tc A", None][i % 3] if i % 5 else "L",
            "NumeroConsecutivo": [f"n{i % 37}", "", None][0 if i % 11 else i % 3],
            "Detalle": [f"p{i % 9}", None, ""][0 if i % 7 else i % 3],
            "CodigoCABYS": [None, "c"][i % 2],
            "Impuesto_Tarifa": ["13", "", "NaN", "0"][i % 4],
            "MontoTotalLinea": ["10.05", "x", "", f"{i}.33", "-2"][i % 5],
            "TipoCambio": ["1", "512.5", "0"][i % 3],
        }


def test_totals_of_lines_are_the_totals_of_tables(spark):
    lines = clean.clean_invoice_lines(raw_frame(spark, list(odd_line_rows())), AS_OF)
    notes = clean.clean_credit_note_lines(raw_frame(spark, [{**r, "Emisor_Identificacion": r["Emisor_Identificacion"] or "39"} for r in odd_line_rows(90)]))
    known = providers.providers(lines, notes)
    previous = known.withColumn("credit", F.when(F.length("provider_id") > 2, F.lit("30 days")))
    expected = dashboard.provider_totals(
        providers.providers(lines, notes, previous),
        providers.provider_invoices(lines),
        providers.provider_products(lines),
        providers.provider_credit_notes(notes),
    )
    found = dashboard.provider_totals_of_lines(lines, notes, previous)
    assert found.columns == expected.columns and found.count() > 5
    assert sorted(map(repr, found.collect())) == sorted(map(repr, expected.collect()))
    none = lines.limit(0), notes.limit(0)
    assert dashboard.provider_totals_of_lines(*none).collect() == []
    assert dashboard.provider_totals_of_lines(lines, notes.limit(0)).filter("credit_note_amount_crc <> 0").isEmpty()


def test_overview_scans_each_table_once(spark, tmp_path):
    lines = clean.clean_invoice_lines(raw_frame(spark, INVOICE_ROWS), AS_OF)
    notes = clean.clean_credit_note_lines(raw_frame(spark, NOTE_ROWS))
    for name, frame in (("lines", lines), ("notes", notes)):
        frame.write.parquet(str(tmp_path / name))
    stored = [spark.read.parquet(str(tmp_path / n)) for n in ("lines", "notes")]
    overview = dashboard.provider_overview(dashboard.provider_totals_of_lines(*stored))
    overview.collect()
    plan = overview._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    assert final.count("FileScan parquet") == 2 and "Join" not in final


def scanned_rows(frame):
    """Rows that the scans of an executed frame gave out."""
    frame.collect()
    todo, total = [frame._jdf.queryExecution().executedPlan()], 0
    while todo:
        node = todo.pop()
        if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif node.getClass().getSimpleName().endswith("QueryStageExec"):
            todo.append(node.plan())
        elif "Scan" in node.nodeName():
            total += node.metrics().apply("numOutputRows").value()
        children = node.children()
        todo += [children.apply(k) for k in range(children.size())]
    return total


def test_one_provider_is_read_from_a_part_of_the_files(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "s"))
    # A third of the lines are one provider's.
    rows = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, F.lit("p-hot")).otherwise(F.concat(F.lit("p"), F.format_string("%04d", F.col("id") % 200))).alias("provider_id"),
        F.concat(F.lit("d"), F.col("id") % 5).alias("detalle"), F.lit("c").alias("codigo_cabys"), F.lit("u").alias("unidad_medida"), F.lit(13.0).alias("impuesto_tarifa"),
        F.lit(dt.datetime(2026, 1, 1)).cast("timestamp_ntz").alias("fecha_emision"), F.col("id").cast("string").alias("numero_consecutivo"), F.lit("1").alias("numero_linea"),
        F.col("id").cast("double").alias("precio_unitario"), F.lit("P").alias("proveedor"), F.lit(1.0).alias("cantidad"), F.lit(2.0).alias("monto_total_linea_crc"),
    )
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    # Small tables must not be put together again into a single file.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        store.publish("plain", rows)
        store.publish("ordered", rows, cluster_by=["provider_id"])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    found, scans = [], []
    for name in ("plain", "ordered"):
        lines = store.read(name)
        priced = dashboard.provider_product_prices(providers.provider_products(lines), prices.provider_prices(lines), "p0100")
        scans.append(scanned_rows(priced))
        found.append(sorted(map(repr, priced.collect())))
    assert found[0] == found[1] and len(found[0]) > 0
    assert scans[0] >= 2 * 30_000 and scans[1] < 0.3 * scans[0]
    hot = [f for f in (tmp_path / "s" / "ordered").rglob("*.parquet")]
    assert len(hot) >= 12


def test_product_prices_treat_null_and_empty_unit_alike(spark):
    rows = [{**INVOICE_ROWS[0], "UnidadMedida": u} for u in (None, "")]
    lines = clean.clean_invoice_lines(raw_frame(spark, rows), AS_OF)
    args = (providers.provider_products(lines), prices.price_history(lines))
    found = dicts(dashboard.provider_product_prices(*args, "3101000001"))
    assert [r["latest_price"] for r in found] == [1200.0] * 4
    assert dashboard.provider_product_prices(*args, "nobody").isEmpty()


def test_totals_agree(lines):
    sums = [
        providers.provider_invoices(lines).agg(F.sum("invoice_total_crc")).first()[0],
        invoices.facturas_individuales(lines).agg(F.sum("SUBTOTAL")).first()[0],
        invoices.invoice_summary(lines).agg(F.sum("TOTAL")).first()[0],
    ]
    assert sums == [41472.0] * 3


# -- duplicates ----------------------------------------------------------------


def keyed(spark, pairs):
    rows = [raw_row(NumeroConsecutivo=n, NumeroLinea=l, SourceFile=f) for n, l, f in pairs]
    return raw_frame(spark, rows)


def test_dedupe_keeps_first_file_and_rows_without_keys(spark):
    pairs = [("1", "1", "b"), (" 1", "1 ", "a"), ("1", "2", "b"), ("1", "", "a"), ("", "", "a"), (" ", None, "a")]
    kept = dedupe.dedupe_lines(keyed(spark, pairs))
    assert sorted((r.NumeroConsecutivo, r.NumeroLinea or "", r.SourceFile) for r in kept.collect()) == [
        ("", "", "a"),
        (" ", "", "a"),
        (" 1", "1 ", "a"),
        ("1", "", "a"),
        ("1", "2", "b"),
    ]
    assert dedupe.dedupe_lines(kept).count() == kept.count()


def test_keep_first_strips_all_white_space_and_counts(spark):
    frame = keyed(spark, [("1\t", "1", "b"), ("1", "1\n", "a"), ("\t", " ", "a"), ("", "", "b")])
    numbered = frame.withColumn("n", F.monotonically_increasing_id())
    kept = dedupe.dedupe_keep_first(numbered, ["n"])
    assert sorted((r.NumeroConsecutivo, r.NumeroLinea, r.SourceFile) for r in kept.collect()) == [
        ("", "", "a"),
        ("", "", "b"),
        ("1", "1", "b"),
    ]
    assert tuple(dedupe.duplicate_count(frame).first()) == (4, 1, 3)


def test_repeated_lines_stay_unless_asked(spark):
    assert len(cleaned(spark, *INVOICE_ROWS, *INVOICE_ROWS)) == 6
    assert len(cleaned(spark, *INVOICE_ROWS, *INVOICE_ROWS, dedupe=True)) == 3


def test_dedupe_limits_each_task_before_the_shuffle(spark):
    plan = dedupe.dedupe_lines(raw_frame(spark, INVOICE_ROWS))._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Exchange") < plan.rindex("WindowGroupLimit")


# -- looking and editing ---------------------------------------------------------


@pytest.mark.parametrize(
    ("text", "expected"),
    [("b", ["aBc", "b%"]), ("%", ["aBc", "b%", "c\\d", "x_y", None][:4]), ("\\", ["c\\d"]), ("X_", ["x_y"])],
)
def test_contains(spark, text, expected):
    frame = spark.createDataFrame([(v,) for v in ("aBc", "b%", "c\\d", "x_y", None)], "v string")
    assert sorted(r.v for r in look.contains(frame, "V", text).collect()) == sorted(expected)


def test_contains_reads_plain_numbers(spark):
    frame = spark.createDataFrame([(12345678.0,), (1.5,)], "v double")
    assert [r.v for r in look.contains(frame, "v", "5678.0").collect()] == [12345678.0]


def test_preview_limits(spark, lines):
    assert look.preview(lines, ["numero_consecutivo"], limit=10).count() == 3
    with pytest.raises(ValueError):
        look.preview(lines, ["numero_consecutivo"], limit=501)


def test_counts_and_inspect(lines):
    assert [tuple(r) for r in look.table_counts({"a": lines, "b": None}).collect()] == [("a", 3)]
    cells = look.inspect(lines.select("numero_linea", "cantidad"), ["numero_linea"]).collect()
    assert {(c.column_name, c.data_type) for c in cells} == {("numero_linea", "string"), ("cantidad", "double")}


def test_edits(spark):
    schema = "k string, a string, b double"
    original = spark.createDataFrame([("1", "x", 1.0), ("2", None, 2.0), ("3", "z", None)], schema)
    edited = spark.createDataFrame([("1", None, 1.0), ("2", None, 12345678.0), ("9", "new", 0.0)], schema)
    changes = edits.changed_rows(original, edited, ["k"])
    found = sorted(tuple(r) for r in edits.cell_edits(changes, ["k"]).collect())
    assert found == [("1", "a", "x", ""), ("2", "b", "2.0", "12345678.0")]
    table = original.withColumn("b", F.col("b") + 1).withColumn("other", F.lit("kept"))
    after = sorted(map(tuple, edits.apply_changes(table, changes, ["k"]).collect()))
    assert after == [("1", None, 2.0, "kept"), ("2", None, 12345678.0, "kept"), ("3", "z", None, "kept")]
    assert edits.changed_rows(original, original, ["k"]).isEmpty()
    with pytest.raises(ValueError):
        edits.refuse_read_only("pipeline_runs")
