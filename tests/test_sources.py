"""Files, stored tables, histories, the run log and whole pipeline runs."""

import re
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators.columns import has_column, missing_columns
from ledgerloom.operators.export import export_csv
from ledgerloom.plans.dashboard import read_query
from ledgerloom.plans.workspace import Workspace
from ledgerloom.schemas import DERIVED_TABLES, PIPELINE_RUN, PREPARED_COLUMNS, RAW_COLUMNS
from ledgerloom.operators import preview as look
from ledgerloom.sources import csv_batches, intake, runs, signatures, sweep, xml_documents
from ledgerloom.sources.datasets import read_dataset
from ledgerloom.sources.history import LineHistory
from ledgerloom.sources.tables import TableStore, utc_now
from ledgerloom.streaming.incremental import start_incremental_load
from tests.samples import AS_OF, FIRST, INVOICE_ROWS, NOTE_ROWS, SECOND, raw_frame, raw_row, xml_of


def text_of(folder, **files):
    """Write files, named with "__" for the dot, and return their paths."""
    paths = []
    for name, content in files.items():
        path = folder / name.replace("__", ".")
        path.write_bytes(content if isinstance(content, bytes) else content.encode())
        paths.append(str(path))
    return paths


# -- CSV and Parquet -----------------------------------------------------------


def test_datasets(spark, tmp_path):
    (path,) = text_of(tmp_path, a__csv="n,d,t\n1,2026-01-15,x\n2,,y\n")
    frame = read_dataset(spark, path)
    assert dict(frame.dtypes) == {"n": "int", "d": "date", "t": "string"} and frame.count() == 2
    frame.write.parquet(str(tmp_path / "b.pq"))
    assert read_dataset(spark, str(tmp_path / "b.pq")).count() == 2
    with pytest.raises(ValueError):
        read_dataset(spark, str(tmp_path / "c.txt"))


def test_csv_batch_unites_layouts_by_name(spark, tmp_path):
    paths = text_of(
        tmp_path,
        one__csv='a,b\n1,"x\ny"\n2,""\nNA,NULL\n',
        two__csv='b,SourceFile,"c d"\n"say ""hi""",own.csv,007\n',
        three__csv="a,b\n9, z \n",
    )
    found = {tuple(r) for r in csv_batches.read_csv_batch(spark, paths).select("SourceFile", "a", "b", "c d").collect()}
    assert found == {
        ("one.csv", "1", "x\ny", ""),
        ("one.csv", "2", "", ""),
        ("one.csv", "NA", "NULL", ""),
        ("own.csv", "", 'say "hi"', "007"),
        ("three.csv", "9", " z ", ""),
    }


def test_fifty_layouts_are_one_scan(spark, tmp_path):
    texts = {f"f{k:02d}__csv": f"c{k},all,c{k + 1}\n" + "".join(f"{n},{k}-{n},x\n" for n in range(3)) for k in range(50)}
    frame = csv_batches.read_csv_batch(spark, text_of(tmp_path, **texts), load_order=True)
    assert frame._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    rows = frame.collect()
    assert len(rows) == 150 and len(frame.columns) == 1 + 51 + 1 + 4
    for r in rows:
        k, n = map(int, r["all"].split("-"))
        assert (r.SourceFile, r[f"c{k}"], r[f"c{k + 1}"], r.load_rank, r.load_row) == (f"f{k:02d}.csv", str(n), "x", k, n)
        assert sum(bool(r[f"c{j}"]) for j in range(51)) == 2


def test_big_csv_files_are_split_by_lines(spark, tmp_path, monkeypatch):
    lines = [f"{k},{'é' * (k % 7)},\"a,{k}\"\n" for k in range(500)]
    (path,) = text_of(tmp_path, big__csv="n,t,q\n" + "".join(lines))
    import os

    size = os.path.getsize(path)
    for step in (1, 10, 64, 1000, size - 1, size, size + 1):
        found = [r for start in range(0, size, step) for r in csv_batches._part(path, start, min(start + step, size))]
        assert found == [[str(k), "é" * (k % 7), f"a,{k}"] for k in range(500)]
    whole, split = (csv_batches.read_csv_batch(spark, [path], multi_line=m) for m in (True, False))
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, split.collect())) and whole.count() == 500


def test_ragged_records(spark, tmp_path):
    paths = text_of(tmp_path, a__csv="a,b\n1\n\n2,3,4\n5,6\n", empty__csv="", head__csv="b,c\n")
    frame = csv_batches.read_csv_batch(spark, paths)
    assert sorted(map(tuple, frame.select("a", "b", "c").collect())) == [("1", "", ""), ("2", "3", ""), ("5", "6", "")]


def test_files_are_listed_in_tasks(spark, tmp_path):
    for name in ("in/a.csv", "in/deep/er/b.CSV", "in/_not/c.csv", "in/.d.csv", "in/e.txt", "in2/f1.csv", "in2/f2.csv", "in2/x/f1.csv"):
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text("a\n1\n")
    given = [str(tmp_path / "in2/f1.csv"), str(tmp_path / "in"), f"{tmp_path}/in?/*2.csv", f"{tmp_path}/in2/x*"]
    found = [(r.load_rank, r.load_path.split(str(tmp_path))[1]) for r in intake.listed(spark, given, (".csv",), "CSV file").collect()]
    assert sorted(found) == [(0, "/in2/f1.csv"), (1, "/in/a.csv"), (1, "/in/deep/er/b.CSV"), (2, "/in2/f2.csv"), (3, "/in2/x/f1.csv")]
    with pytest.raises(Exception, match="nowhere"):
        intake.listed(spark, [str(tmp_path / "nowhere")], (".csv",), "CSV file").count()


def test_csv_byte_order_mark(spark, tmp_path):
    paths = text_of(tmp_path, a__CSV=b"\xef\xbb\xbfa,b\n1,2\n")
    frame = csv_batches.read_csv_batch(spark, paths)
    assert [tuple(r) for r in frame.select("a", "b").collect()] == [("1", "2")]


def test_csv_batch_refuses(spark, tmp_path):
    for paths in ([], ["lines.xlsx"]):
        with pytest.raises(ValueError):
            csv_batches.read_csv_batch(spark, paths)
    paths = text_of(tmp_path, a__csv="NumeroConsecutivo,NumeroLinea\n1,1\n")
    with pytest.raises(ValueError, match="FechaEmision"):
        csv_batches.read_prepared_lines(spark, paths)


def test_prepared_lines(spark, tmp_path):
    header = ",".join(c for c in PREPARED_COLUMNS if c != "SourceFile")
    values = ",".join(INVOICE_ROWS[0][c] for c in PREPARED_COLUMNS if c != "SourceFile")
    paths = text_of(tmp_path, lines__csv=f"{header}\n{values}\n")
    row = csv_batches.read_prepared_lines(spark, paths).first()
    assert (row.SourceFile, row.NumeroConsecutivo, row.Impuesto_Codigo) == ("lines.csv", FIRST, "01")


def test_export_is_sorted_and_plain(spark, tmp_path):
    frame = spark.createDataFrame([("b", 12345678.0, None), ("a", 1.5, ""), (None, None, "x")], "k string, v double, t string")
    export_csv(frame, str(tmp_path / "out"), ["k"])
    parts = sorted((tmp_path / "out").glob("part-*.csv"))
    lines = [line for p in parts for line in p.read_text().splitlines() if line != "k,v,t"]
    assert lines == ['a,1.5,""', "b,12345678.0,", ",,x"]


def test_columns_ignore_case(spark):
    frame = spark.createDataFrame([(1,)], "CodigoMoneda int")
    assert has_column(frame, "codigomoneda") and missing_columns(frame, ["CODIGOMONEDA", "x"]) == ["x"]


def test_sql_with_parameters(spark):
    frame = spark.range(5)
    assert read_query(spark, "select id from {t} where id >= :low", {"low": 3}, t=frame).count() == 2


# -- XML -------------------------------------------------------------------------


def documents(spark, *texts):
    return spark.createDataFrame([(f"d{i}.xml", t) for i, t in enumerate(texts)], "source_file string, xml string")


def flat(spark, *texts):
    return [r.asDict() for r in xml_documents.flatten_documents(documents(spark, *texts)).collect()]


@pytest.mark.parametrize("namespace", ["", ' xmlns="https://example.test/v4"'])
def test_xml_lines(spark, namespace):
    found = sorted(flat(spark, xml_of(INVOICE_ROWS[:2], namespace=namespace)), key=lambda r: r["NumeroLinea"])
    expected = [{**r, "SourceFile": "d0.xml"} for r in INVOICE_ROWS[:2]]
    assert found == expected and list(found[0]) == RAW_COLUMNS


def test_xml_prefix_mark_and_declaration(spark):
    text = re.sub("<(/?)([A-Z])", r"<\1f:\2", xml_of(INVOICE_ROWS[:1], namespace=""))
    text = "\ufeff" + text.replace("<f:FacturaElectronica>", '<f:FacturaElectronica xmlns:f="u">')
    assert [r["NumeroConsecutivo"] for r in flat(spark, text)] == [FIRST]


def test_xml_first_element_wins(spark):
    text = """<FacturaElectronica><Clave>1</Clave><Clave>2</Clave>
      <Emisor><Nombre>  a  b </Nombre></Emisor><Emisor><Nombre>late</Nombre><NombreComercial>tc</NombreComercial></Emisor>
      <DetalleServicio><LineaDetalle><NumeroLinea>01</NumeroLinea><Detalle><![CDATA[x < y & z]]></Detalle>
        <Impuesto><Codigo>01</Codigo></Impuesto><Impuesto><Codigo>02</Codigo><Tarifa>4</Tarifa></Impuesto></LineaDetalle>
        <LineaDetalle><NumeroLinea/></LineaDetalle></DetalleServicio>
      <InformacionReferencia><Numero>r1</Numero></InformacionReferencia>
      <InformacionReferencia><Numero>r2</Numero><Codigo>c2</Codigo></InformacionReferencia></FacturaElectronica>"""
    first, second = sorted(flat(spark, text), key=lambda r: r["NumeroLinea"], reverse=True)
    assert (first["Clave"], first["Emisor_Nombre"], first["Emisor_NombreComercial"]) == ("1", "  a  b ", "tc")
    assert (first["NumeroLinea"], first["Detalle"]) == ("01", "x < y & z")
    assert (first["Impuesto_Codigo"], first["Impuesto_Tarifa"]) == ("01", "")
    assert (first["Referencia_Numero"], first["Referencia_Codigo"]) == ("r1", "")
    assert (second["NumeroLinea"], second["Impuesto_Codigo"]) == ("", "")


def test_xml_missing_and_empty_currency(spark):
    line = "<DetalleServicio><LineaDetalle/></DetalleServicio>"
    money = "<ResumenFactura><CodigoTipoMoneda><CodigoMoneda/><TipoCambio></TipoCambio></CodigoTipoMoneda></ResumenFactura>"
    found = flat(
        spark,
        f"<FacturaElectronica>{line}</FacturaElectronica>",
        f"<FacturaElectronica>{line}{money}</FacturaElectronica>",
    )
    by_file = {r["SourceFile"]: (r["CodigoMoneda"], r["TipoCambio"]) for r in found}
    assert by_file == {"d0.xml": ("CRC", "1"), "d1.xml": ("", "")}


def test_xml_routing_and_rejects(spark):
    good, note = xml_of(INVOICE_ROWS[:1]), xml_of(NOTE_ROWS, root="NotaCreditoElectronica")
    texts = documents(spark, good, note, good[:-5], "<MensajeHacienda/>", "no xml", "<FacturaElectronica/>", None)
    reasons = {r.source_file: r.reason for r in xml_documents.rejected_documents(texts).collect()}
    assert reasons == {
        "d2.xml": "malformed",
        "d3.xml": "other document",
        "d4.xml": "malformed",
        "d6.xml": "unreadable",
    }
    assert xml_documents.invoice_lines(texts).count() == 1
    (line,) = xml_documents.credit_note_lines(texts).collect()
    assert (line.TipoDocumento, line.Referencia_Numero) == ("NOTA_CREDITO", FIRST)


def test_xml_files_and_encodings(spark, tmp_path):
    accented = xml_of([raw_row(NumeroConsecutivo="1", Emisor_Nombre="Café")])
    latin = accented.replace("UTF-8", "ISO-8859-1").encode("latin-1")
    wide = accented.replace('encoding="UTF-8"', 'encoding="UTF-16"').encode("utf-16")
    broken = accented.encode("latin-1")
    paths = text_of(tmp_path, a__xml=accented, b__xml=latin, c__xml=wide, d__xml=broken, e__XML=accented)
    found = {r.SourceFile: r.Emisor_Nombre for r in xml_documents.read_invoice_xmls(spark, paths).collect()}
    assert found == dict.fromkeys(["a.xml", "b.xml", "c.xml", "e.XML"], "Café")
    rejected = xml_documents.rejected_documents(xml_documents.read_documents(spark, paths)).collect()
    assert [tuple(r) for r in rejected] == [("d.xml", "malformed")]


@pytest.mark.parametrize("held", [2, 4096])
@pytest.mark.parametrize("kind", ["bytes", "str"])
def test_long_documents_are_read_in_chunks(monkeypatch, held, kind):
    """Lines before, between and after other elements, in any number of details, cut anywhere by chunks."""
    line = "<LineaDetalle><NumeroLinea>{}</NumeroLinea><Detalle>dé {}</Detalle><Impuesto><Tarifa>{}</Tarifa></Impuesto></LineaDetalle>"
    detail = "<DetalleServicio><Otro/>" + "".join(line.format(k, k, k) for k in range(40)) + "</DetalleServicio>"
    text = f"<FacturaElectronica xmlns='u'><Clave>7</Clave>{detail}<LineaDetalle/>{detail}<Emisor><Nombre>n</Nombre></Emisor></FacturaElectronica>"
    read = lambda t: list((d := xml_documents._Document(t if kind == "str" else t.encode())).rows("f", t if kind == "str" else t.encode())) or d.reason
    expected = read(text)
    assert len(expected) == 80 and expected[-1][2:6] == ("7", "", "", "n")
    monkeypatch.setattr(xml_documents, "HELD", held)
    for chunk in (1, 7, 100, 3000):
        monkeypatch.setattr(xml_documents, "CHUNK", chunk)
        assert read(text) == expected
        assert read(text[:-1]) == read(text + "x") == read(text.replace("<Clave>", "<x>")) == "malformed"
        assert read("<Other>" + detail + "</Other>") == "other document" and read("") == "malformed"


def test_a_long_document_needs_little_memory():
    import tracemalloc

    line = "<LineaDetalle>" + "".join(f"<{c}>{c}</{c}>" for c in xml_documents.LINE_ELEMENTS) + "</LineaDetalle>"
    text = b"<FacturaElectronica><DetalleServicio>" + line.encode() * 30_000 + b"</DetalleServicio></FacturaElectronica>"
    tracemalloc.start()
    document = xml_documents._Document(memoryview(text))
    n = sum(1 for _ in document.rows("f", memoryview(text)))
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert n == 30_000 and len(text) > 15e6 and peak < 12e6


LINE = "<DetalleServicio><LineaDetalle><Detalle>own</Detalle></LineaDetalle></DetalleServicio>"


@pytest.mark.parametrize(
    "odd",
    [
        f"<FacturaElectronica>{LINE}</FacturaElectronica>garbage",
        f"<FacturaElectronica>{LINE}</FacturaElectronica><FacturaElectronica/>",
        f"<FacturaElectronica>{LINE}<ds:Sig/></FacturaElectronica>",
        f"<FacturaElectronica>{LINE}</FacturaElectronic>",
        "",
    ],
)
def test_xml_not_well_formed(spark, odd):
    assert flat(spark, odd) == []
    assert [r.reason for r in xml_documents.rejected_documents(documents(spark, odd)).collect()] == ["malformed"]


@pytest.mark.parametrize(
    "text, detail",
    [
        ("\n" * 100_000 + "<FacturaElectronica>{}</FacturaElectronica>", "own"),
        ("<!-- c -->" * 20_000 + "<FacturaElectronica>{}</FacturaElectronica><!-- end --><?p?>\n", "own"),
        ('<!DOCTYPE FacturaElectronica [<!ENTITY foo "b]ar">]><FacturaElectronica>{}</FacturaElectronica>', "own"),
        ('<!DOCTYPE f [<!ENTITY foo "bar">]><FacturaElectronica>{}</FacturaElectronica>'.replace("{}", LINE.replace("own", "&foo;")), "bar"),
        ("<FacturaElectronica>" + LINE.replace("own", "a<i>c</i>d") + "</FacturaElectronica>", "a"),
        (
            '<FacturaElectronica xmlns:o="other">'
            + LINE.replace("<Detalle>", "<o:Detalle>foreign</o:Detalle><Detalle>")
            + "</FacturaElectronica>",
            "own",
        ),
        ('<r:FacturaElectronica xmlns:r="u">{}</r:FacturaElectronica>', None),
    ],
)
def test_xml_odd_documents(spark, text, detail):
    found = [r["Detalle"] for r in flat(spark, text.replace("{}", LINE))]
    assert found == ([detail] if detail else [])


@pytest.mark.parametrize("encoding", ["windows-1252", "ISO-8859-15"])
def test_xml_more_encodings(spark, tmp_path, encoding):
    padding = " " * 500  # the declaration may be as long as it likes
    text = f'<?xml version="1.0" {padding}encoding="{encoding}"?><FacturaElectronica>{LINE.replace("own", "10 €")}</FacturaElectronica>'
    (path,) = text_of(tmp_path, a__xml=text.encode(encoding))
    assert [r.Detalle for r in xml_documents.read_invoice_xmls(spark, [path]).collect()] == ["10 €"]


def test_xml_inputs_are_checked(spark, tmp_path):
    (note,) = text_of(tmp_path, n__xml=xml_of(NOTE_ROWS, root="NotaCreditoElectronica"))
    for paths in ([], ["a.csv"], [note]):
        with pytest.raises(ValueError):
            xml_documents.read_invoice_xmls(spark, paths)
    assert xml_documents.read_credit_note_xmls(spark, []).isEmpty()


# -- stored tables -----------------------------------------------------------------


def test_store_replaces_from_its_own_contents(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "s"))
    assert store.names() == [] and not store.exists("t") and store.find("t") is None
    assert store.publish("t", spark.range(4)) == 4
    assert store.publish("t", store.read("t").filter("id > 0")) == 3
    assert store.read("t").count() == 3 and store.has_column("t", "ID") and store.names() == ["t"]
    with pytest.raises(ValueError):
        store.publish("t", spark.range(1), replace=False)
    store.drop("t")
    assert not store.exists("t")
    with pytest.raises(ValueError):
        store.read("t")


def test_half_written_version_is_invisible(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "s"))
    store.publish("t", spark.range(2))
    spark.range(9).write.parquet(f"{store.path('t')}/version=99999999T000000000000-x")
    next((tmp_path / "s" / "t" / "version=99999999T000000000000-x").glob("_SUCCESS")).unlink()
    assert store.read("t").count() == 2


def test_history_columns_grow(spark, tmp_path):
    history = LineHistory(TableStore(spark, str(tmp_path / "s")), "lines_history")
    with pytest.raises(ValueError):
        history.read()
    history.append(spark.createDataFrame([("1", None)], "a string, b string"), "r1")
    history.append(spark.createDataFrame([("2", "z")], "A string, c string"), "r2")
    found = {tuple(r) for r in history.read().drop("loaded_at").collect()}
    assert history.read().columns == ["run_id", "loaded_at", "a", "b", "c"]
    assert found == {("r1", "1", "", None), ("r2", "2", "", "z")}
    assert [tuple(r) for r in history.read_run("r2").collect()] == [("2", "", "z")]
    assert history.read_run("nothing").isEmpty() and history.read_run("nothing").columns == ["a", "b", "c"]
    history.append(spark.createDataFrame([("3",)], "a string"), "r2", replace_run=True)
    assert [tuple(r) for r in history.read_run("r2").collect()] == [("3", "", "")]


def test_runs_in_one_write_are_those_of_one_after_the_other(spark, tmp_path):
    rows = [(r, f"{r}{k}", None if k else "b", "c", "d") for r in ("r1", "r2", "r3", "other") for k in range(2)]
    frame = spark.createDataFrame(rows, "run string, a string, b string, C string, d string")
    columns = {"r1": ["a", "b"], "r2": ["a", "C"], "r3": ["b", "C", "d"]}
    found = []
    for name in ("together", "apart"):
        history = LineHistory(TableStore(spark, str(tmp_path / name)), "lines_history")
        history.append(spark.createDataFrame([("0", "x", "y")], "b string, c string, e string"), "r0")
        if name == "together":
            history.append_runs(frame, "run", columns)
        else:
            for run, brought in columns.items():
                history.append(frame.filter(F.col("run") == run).select(*brought), run)
        found.append((history.read().columns, sorted(map(repr, history.read().drop("loaded_at").collect()))))
        assert sorted(r.a or "" for r in history.read_run("r3").collect()) == ["", ""]
    assert found[0] == found[1] and len(found[0][1]) == 7


def test_load_time_is_utc_in_any_session_zone(spark, tmp_path):
    history = LineHistory(TableStore(spark, str(tmp_path / "s")), "lines_history")
    spark.conf.set("spark.sql.session.timeZone", "America/Costa_Rica")
    try:
        history.append(spark.createDataFrame([("1",)], "a string"), "r1")
        (row,) = history.read().collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert abs(utc_now() - row.loaded_at) < timedelta(minutes=5)


# -- runs and the whole pipeline -----------------------------------------------------


def test_run_log(spark, tmp_path):
    log = runs.RunLog(TableStore(spark, str(tmp_path / "s")))
    assert log.selected() is None and log.runs().schema.names == PIPELINE_RUN.names
    first, second, third = (log.create("client", "me") for _ in range(3))
    log.succeed(first, {"invoice_rows_loaded": 12345}, {"b": 1, "a": 2})
    log.succeed(second, {}, {})
    log.fail(third, "boom")
    states = {r.run_id: r for r in log.runs().collect()}
    assert [states[i].status for i in (first, second, third)] == ["success", "success", "failed"]
    assert [states[i].selected_run for i in (first, second, third)] == [False, True, False]
    assert states[first].derived_table_counts_json == '{"a": 2, "b": 1}' and states[third].error_message == "boom"
    assert log.selected() == second
    log.select(first)
    assert log.selected() == first
    with pytest.raises(ValueError):
        log.select(third)
    labels = {r.run_id: r.run_label for r in runs.run_labels(log.runs()).collect()}
    assert set(labels) == {first, second} and labels[first].endswith("| invoices: 12,345 | credit notes: 0")
    assert {tuple(r) for r in runs.status_counts(log.runs()).collect()} == {("success", 2), ("failed", 1)}
    assert [r.run_id for r in runs.newest_first(log.runs()).collect()] == [third, second, first]


def test_pipeline_from_files_to_edits(spark, tmp_path):
    workspace = Workspace(spark, str(tmp_path / "client"))
    with pytest.raises(ValueError):
        workspace.run_full_pipeline([], client_id="c", username="u")
    with pytest.raises(ValueError):
        workspace.build_derived_tables()
    paths = text_of(
        tmp_path,
        a__xml=xml_of(INVOICE_ROWS[:2]),
        b__xml=xml_of(INVOICE_ROWS[2:]),
        n__xml=xml_of(NOTE_ROWS, root="NotaCreditoElectronica"),
    )
    result = workspace.run_full_pipeline(paths, paths, client_id="c", username="u", as_of=AS_OF)
    counts = [1, 2, 2, 1, 3, 2, 2, 3, 2, 1]
    assert dict(result.derived_table_counts) == dict(zip(DERIVED_TABLES, counts, strict=True))
    assert (result.invoice_rows_loaded, result.credit_note_rows_loaded) == (3, 1)
    assert workspace.runs.selected() == result.run_id
    review = workspace.table("credit_notes").first()
    assert (review["FACTURA ASOCIADA"], review["FINAL"]) == (FIRST, 1356.0)

    # An edit of the providers outlives the next build; one of staging lives until a refresh.
    table = workspace.table("providers")
    edited = table.withColumn("credit", F.lit("30 days"))
    assert workspace.save_table_edits("providers", table, edited, ["provider_id"], edited_by="me") == 1
    assert workspace.save_table_edits("providers", table, table, ["provider_id"], edited_by="me") == 0
    lines = workspace.table("source_data")
    key = ["NumeroConsecutivo", "NumeroLinea"]
    cheaper = lines.withColumn("PrecioUnitario", F.when(F.col("NumeroConsecutivo") == SECOND, "1").otherwise(F.col("PrecioUnitario")))
    assert workspace.save_table_edits("source_data", lines, cheaper, key, edited_by="me") == 1
    workspace.build_derived_tables(as_of=AS_OF)
    assert workspace.table("providers").first().credit == "30 days"
    assert workspace.table("price_changes").first().precio_nuevo == 1.0
    audit = workspace.table("manual_edits_history").select("run_id", "table_name", "row_id", "column_name", "old_value", "new_value")
    assert {tuple(r) for r in audit.collect()} == {
        (result.run_id, "providers", "3101000001", "credit", "", "30 days"),
        (result.run_id, "source_data", f"{SECOND}|1", "PrecioUnitario", "1300", "1"),
    }
    with pytest.raises(ValueError):
        workspace.save_table_edits("pipeline_runs", table, edited, ["provider_id"], edited_by="me")

    # A second run without credit notes, a failed one, then back to the first.
    second = workspace.run_full_pipeline(paths[:1], client_id="c", username="u", as_of=AS_OF)
    assert second.derived_table_counts["provider_credit_notes"] == 0
    assert workspace.table("source_data").count() == 2
    with pytest.raises(ValueError):
        workspace.run_full_pipeline([paths[2]], client_id="c", username="u")
    assert workspace.runs.selected() == second.run_id
    assert workspace.table("pipeline_runs").first().status == "failed"
    workspace.select_run(result.run_id)
    assert workspace.table("source_data").count() == 3
    assert workspace.build_derived_tables(as_of=AS_OF)["price_changes"] == 1
    assert workspace.table("price_changes").first().precio_nuevo == 1300.0
    assert workspace.table("source_data_history").count() == 5


def test_loading_without_a_run(spark, tmp_path):
    workspace = Workspace(spark, str(tmp_path / "client"))
    assert workspace.table_names() == []
    invoice, note, plain = text_of(
        tmp_path,
        a__xml=xml_of(INVOICE_ROWS[:2]),
        n__xml=xml_of(NOTE_ROWS, root="NotaCreditoElectronica"),
        p__csv="a,b\n1,2\n",
    )
    assert workspace.load_dataset(plain, "plain") == 1
    assert workspace.load_invoice_xmls([invoice]).rows_stored == 2
    assert workspace.load_credit_note_xmls([note]).rows_read == 1
    assert workspace.table_names() == ["credit_note_lines", "credit_notes", "plain", "source_data"]
    counts = workspace.build_derived_tables(as_of=AS_OF)
    assert (counts["clean_invoice_lines"], counts["provider_credit_notes"]) == (2, 1)
    with pytest.raises(ValueError):
        workspace.load_credit_note_xmls([invoice])
    with pytest.raises(ValueError):
        workspace.load_dataset(plain, "plain", replace=False)
    header = ",".join(PREPARED_COLUMNS)
    values = ",".join(INVOICE_ROWS[2][c] for c in PREPARED_COLUMNS)
    (prepared,) = text_of(tmp_path, q__csv=f"{header}\n{values}\n{values}\n")
    assert workspace.load_source_data_files([prepared]).rows_stored == 2
    assert workspace.load_invoice_csvs([prepared, plain]).rows_stored == 3
    # Lines without keys or dates are loaded, but no clean line comes of them.
    assert workspace.build_derived_tables(as_of=AS_OF)["clean_invoice_lines"] == 2


def test_incremental_load(spark, tmp_path):
    workspace = Workspace(spark, str(tmp_path / "client"))
    folder = tmp_path / "inbox"
    folder.mkdir()

    def load():
        query = start_incremental_load(workspace, str(folder), str(tmp_path / "progress"))
        query.awaitTermination(120)
        assert query.exception() is None

    text_of(folder, a__xml=xml_of(INVOICE_ROWS[:2]), n__xml=xml_of(NOTE_ROWS, root="NotaCreditoElectronica"))
    load()
    text_of(folder, b__xml=xml_of(INVOICE_ROWS[2:]))
    load()
    load()
    found = workspace.table("source_data_history").groupBy("run_id").count().collect()
    assert sorted(r["count"] for r in found) == [1, 2]
    assert workspace.table("credit_note_lines_history").count() == 1
    # Another stream with the same name adds runs and takes none away.
    other = tmp_path / "other"
    other.mkdir()
    text_of(other, c__xml=xml_of(INVOICE_ROWS[:1]))
    start_incremental_load(workspace, str(other), str(tmp_path / "more")).awaitTermination(120)
    assert workspace.table("source_data_history").count() == 4
    runs_logged = workspace.table("pipeline_runs").collect()
    assert {r.status for r in runs_logged} == {"success"} and sum(r.invoice_rows_loaded for r in runs_logged) == 4


def test_csv_names_and_headers(spark, tmp_path):
    folder = tmp_path / "odd names"
    folder.mkdir()
    (folder / "a[1] +2.csv").write_text("x,y\n1,2\n")
    (folder / "b.csv").write_text("x,x,X\n3,4,5\n")
    found = csv_batches.read_csv_batch(spark, [str(folder)]).orderBy("SourceFile")
    assert found.columns == ["SourceFile", "x", "y", "x.1", "X.2"] or set(found.columns) == {"SourceFile", "x", "y", "x.1", "X.2"}
    assert [r.SourceFile for r in found.collect()] == ["a[1] +2.csv", "b.csv"]
    assert [r["x.1"] for r in found.collect()] == ["", "4"]


def test_edits_need_a_key(spark, tmp_path):
    workspace = Workspace(spark, str(tmp_path / "client"))
    rows = spark.createDataFrame([("a", 1)] * 3 + [("b", 1)], "k string, v int")
    workspace.store.publish("source_data", rows)
    with pytest.raises(ValueError):
        workspace.save_table_edits("source_data", rows, rows.withColumn("v", F.lit(2)), ["k"], edited_by="me")
    assert workspace.table("source_data").count() == 4


# -- snapshots, sweeping, audits ---------------------------------------------------


def test_folded_events_stand_for_all(spark, tmp_path):
    log = runs.RunLog(TableStore(spark, str(tmp_path / "s")))
    ids = [log.create("client", f"u{k}") for k in range(4)]
    log.succeed(ids[0], {"invoice_rows_loaded": 1}, {})
    log.fail(ids[1], "boom")
    log.succeed(ids[2], {}, {"a": 1})
    log.select(ids[0])
    log.select(ids[2])
    log.select(ids[0])
    before = sorted(map(repr, log.runs().collect()))
    files = set(log._files())
    log.fold()
    assert set(log._files()) == files and log._snapshot()[1] == files
    assert sorted(map(repr, log.runs().collect())) == before and log.selected() == ids[0]
    # Later events count, and a fold deletes what the fold before it took in.
    log.succeed(ids[3], {}, {})
    assert log.selected() == ids[3]
    log.fold()
    assert len(log._files()) == 1 and log.selected() == ids[3]
    # A fold that dies before its snapshot is current changes nothing.
    log.fail(ids[1], "again")
    log.store.stage(runs.SNAPSHOT, log.events())
    assert {r.run_id: r.error_message for r in log.runs().collect()}[ids[1]] == "again"


def test_reading_cost_does_not_grow_with_past_events(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(runs.RunLog, "KEEP", 3)
    log = runs.RunLog(TableStore(spark, str(tmp_path / "s")))
    run = log.create("client", "u")
    log.succeed(run, {}, {})
    seen = []
    for _ in range(14):
        log.select(run)
        seen.append(len(log._files()))
    assert max(seen) <= 7 and log.selected() == run
    assert log._snapshot()[0].count() <= 3


def test_sweep_keeps_what_is_reached(spark, tmp_path):
    folder = tmp_path / "client"
    workspace = Workspace(spark, str(folder))
    paths = text_of(tmp_path, a__xml=xml_of(INVOICE_ROWS))
    first = workspace.run_full_pipeline(paths, client_id="c", username="u", as_of=AS_OF).run_id
    second = workspace.run_full_pipeline(paths, client_id="c", username="u", as_of=AS_OF).run_id
    failed, running = workspace.runs.create("c", "u"), workspace.runs.create("c", "u")
    for run in (failed, running):
        workspace.load_run("source_data", raw_frame(spark, INVOICE_ROWS[:1]), run)
    workspace.runs.fail(failed, "boom")
    workspace.store.stage("providers", spark.range(3))
    expected = {t: sorted(map(repr, workspace.table(t).collect())) for t in DERIVED_TABLES}
    history = lambda: {r.run_id for r in workspace.table("source_data_history").select("run_id").distinct().collect()}

    assert workspace.sweep(timedelta(hours=1)) == sweep.Swept(0, 0, 0, 0) and history() == {first, second, failed, running}
    gone = workspace.sweep(timedelta(seconds=-5))
    # One old version of each derived table and of the prices by provider.
    assert (gone.versions, gone.staged, gone.runs) == (len(DERIVED_TABLES) + 2, 1, 1) and gone.scratch > 0
    assert history() == {first, second, running}
    assert {t: sorted(map(repr, workspace.table(t).collect())) for t in DERIVED_TABLES} == expected
    again = workspace.sweep(timedelta(seconds=-5))
    assert (again.versions, again.staged, again.runs) == (0, 0, 0)


def test_edits_and_their_audit_become_visible_together(spark, tmp_path, monkeypatch):
    workspace = Workspace(spark, str(tmp_path / "client"))
    rows = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    workspace.store.publish("source_data", rows)
    edited = rows.withColumn("v", F.col("v") + F.when(F.col("k") == "b", 5).otherwise(0))

    def die(*_):
        raise OSError("crash")

    with monkeypatch.context() as broken:
        broken.setattr(TableStore, "switch", die)
        with pytest.raises(OSError):
            workspace.save_table_edits("source_data", rows, edited, ["k"], edited_by="me")
    assert workspace.table("manual_edits_history").isEmpty() and workspace.table("source_data").filter("v = 7").isEmpty()
    assert workspace.save_table_edits("source_data", rows, edited, ["k"], edited_by="me") == 1
    audit = lambda: [(r.row_id, r.old_value, r.new_value) for r in workspace.table("manual_edits_history").collect()]
    assert audit() == [("b", "2", "7")] and workspace.table("source_data").filter("v = 7").count() == 1
    # They stay, once each, when the edited version goes.
    workspace.store.publish("source_data", rows)
    workspace.sweep(timedelta(seconds=-5))
    assert audit() == [("b", "2", "7")] and workspace.store.attached() == []


def test_signatures_skip_files_and_no_rows(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "with space + plus"))
    names = [f"Name {k:03d} ÉTÉ" for k in range(60)] + ["ab", "", None, "a%b_c", "tail\\x", "ΟΔΟΣ", "12345678.0"]
    rows = spark.createDataFrame([(k, n, float(k) * 1e7) for k, n in enumerate(names)], "k int, Name string, v double")
    store.publish("t", rows.repartitionByRange(8, "k"))
    before = {t: sorted(r.k for r in signatures.search(store, "t", "name", t).collect()) for t in ("03", "")}
    signatures.sign(store, "t", "name")
    signatures.sign(store, "t", "v")
    total = len(store.read("t").inputFiles())
    skipped = 0
    for text in ("Name 017", "name 0_7", "017", "03", "", "%", "nothing like it", "a%b", "été", "ÉTÉ", "ΔΟΣ", "l\\x", "x%y%zzz", "5 é%", "E 05"):
        found = signatures.search(store, "t", "name", text)
        assert sorted(r.k for r in found.collect()) == sorted(r.k for r in look.contains(store.read("t"), "name", text).collect()), text
        files = signatures.candidate_files(store, "t", "name", text)
        skipped += 0 if files is None else total - len(files)
    assert total == 8 and skipped > 40
    assert len(signatures.candidate_files(store, "t", "name", "Name 017")) == 1
    found = signatures.search(store, "t", "v", "30000000.0").collect()
    assert sorted(r.k for r in found) == [3, 13, 23, 33, 43, 53, 63] and len(signatures.candidate_files(store, "t", "v", "630000000.0")) == 1
    assert before["03"] == sorted(r.k for r in signatures.search(store, "t", "name", "03").collect())
    # A later version has no signatures, and is searched whole.
    store.publish("t", rows.withColumn("Name", F.lit("Name 017")))
    assert signatures.candidate_files(store, "t", "name", "Name 017") is None and signatures.search(store, "t", "name", "Name 017").count() == len(names)
