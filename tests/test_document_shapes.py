"""Documents of one shape are read by position, and routed without a tree."""

import pytest

from ledgerloom.sources import xml_documents
from ledgerloom.sources.xml_documents import _Document

LINE = "<LineaDetalle><Detalle>{}</Detalle><Impuesto><Codigo>{}</Codigo></Impuesto><Impuesto><Codigo>99</Codigo></Impuesto></LineaDetalle>"
TEXT = "<FacturaElectronica><Clave>{0}</Clave><Emisor><Nombre/></Emisor><DetalleServicio>{1}</DetalleServicio></FacturaElectronica>"


def test_second_document_of_a_shape_is_read_by_position(monkeypatch):
    monkeypatch.setattr(xml_documents, "_shapes", {})
    first, second = (TEXT.format(k, LINE.format(f"d{k}", k) + LINE.format("", f"t{k}")) for k in "ab")
    rows = [list(_Document(d).rows("f", d)) for d in (first, second)]
    assert len(xml_documents._shapes) == 1
    monkeypatch.setattr(xml_documents, "ELEMENTS", 0)
    assert rows == [list(_Document(d).rows("f", d)) for d in (first, second)]
    assert [r[2] for r in rows[1]] == ["b", "b"] and "db" in rows[1][0] and "tb" in rows[1][1]


def test_children_tell_shapes_apart(monkeypatch):
    """The same tags in the same order, once inside the line and once behind it."""
    monkeypatch.setattr(xml_documents, "_shapes", {})
    inside = TEXT.format("k", "<LineaDetalle><Detalle>in</Detalle></LineaDetalle>")
    behind = TEXT.format("k", "<LineaDetalle/><Detalle>out</Detalle>")
    found = [[r for r in _Document(d).rows("f", d)] for d in (inside, behind, inside, behind)]
    assert found[0] == found[2] and found[1] == found[3] and "in" in found[0][0] and "out" not in found[1][0]


def test_routing_builds_no_tree(monkeypatch):
    text = TEXT.format("k", LINE.format("d", "01"))
    monkeypatch.setattr(xml_documents.ElementTree, "XMLParser", None)
    assert _Document(text, with_lines=False).kind == "FACTURA"


@pytest.mark.parametrize(
    "text",
    [
        TEXT.format("k", ""),
        TEXT.format("&nbsp;", ""),
        '<!DOCTYPE FacturaElectronica SYSTEM "x.dtd">' + TEXT.format("&nbsp;", ""),
        '<!DOCTYPE FacturaElectronica [<!ENTITY a "b">]>' + TEXT.format("&a;", ""),
        TEXT.format("k", "<p:x/>"),
        TEXT.format("k", "") + "<more/>",
        '<?xml version="1.0" encoding="no-such"?>' + TEXT.format("k", ""),
        "",
        "<x/>",
    ],
)
@pytest.mark.parametrize("encoding", ["utf-8", "utf-16"])
def test_routing_agrees_with_reading(text, encoding):
    content = text.encode(encoding)
    routed, read = _Document(content, with_lines=False), _Document(content)
    assert (routed.kind, routed.reason) == (read.kind, read.reason)


ODD = [
    TEXT.format("a &amp; &lt;b&gt; &quot;c&quot; &apos;d&apos; &amp;lt;", LINE.format("", " \t\n")),
    TEXT.format("&#65;", ""),
    TEXT.format("&nbsp;", ""),
    TEXT.format("a > b", ""),
    TEXT.format("a ]]> b", ""),
    TEXT.format("a\rb\r\nc", ""),
    TEXT.format("a\x01b", ""),
    TEXT.format("a￾b", ""),
    TEXT.format("ñ\U0001f600\x85", LINE.format("ó", "ú")),
    TEXT.format("<![CDATA[<Clave>]]>", ""),
    TEXT.format("a<!-- <x> -->b", ""),
    TEXT.format("a<?x <y>?>b", ""),
    TEXT.format("k", LINE.format("d<b>e</b>f", "t")) + "\n",
    TEXT.format("k", "") + "more",
    "text" + TEXT.format("k", ""),
    "﻿" + TEXT.format("k", ""),
    "\n" + TEXT.format("k", ""),
    '<?xml version="1.0" encoding="UTF-8"?>\n' + TEXT.format("é", ""),
    ' <?xml version="1.0" encoding="UTF-8"?>' + TEXT.format("é", ""),
    '<?xml version="1.0" encoding="ISO-8859-1"?>' + TEXT.format("é", ""),
    TEXT.format("k", "").replace("<Clave>", "<Clave a='>'>"),
    TEXT.format("k", "").replace("<Clave>", """<Clave a="'" b='>'>"""),
    TEXT.format("k", "").replace("<Clave>", '<Clave a="&quot;"   b = "2">'),
    TEXT.format("k", "").replace("</Clave>", "</Clave\n>"),
    TEXT.format("k", "").replace("<FacturaElectronica>", '<x:FacturaElectronica xmlns:x="u" xmlns="u">').replace("</Factura", "</x:Factura"),
    TEXT.format("k", "").replace("FacturaElectronica", "MensajeHacienda"),
    "<a>x>b>y</a>",
    "<<a>>",
    "&<a/>",
]


@pytest.mark.parametrize("encoding", ["utf-8", "latin-1", "utf-16", None])
@pytest.mark.parametrize("text", ODD)
def test_tags_tell_what_the_parser_tells(monkeypatch, text, encoding):
    for name, known in (("_skeletons", {}), ("_roots", {}), ("_shapes", {})):
        monkeypatch.setattr(xml_documents, name, known)
    content = text.encode(encoding, "replace") if encoding else text

    def told():
        read, routed = _Document(content), _Document(content, with_lines=False)
        return read.kind, read.reason, list(read.rows("f", content)), routed.kind, routed.reason

    found = [told(), told()]
    monkeypatch.setattr(xml_documents, "_parts", lambda content: ("", []))
    assert found == [told(), told()]


def test_texts_that_may_not_stand_there_are_found(monkeypatch):
    """Documents with the tags of one that is known, and something else between them."""
    monkeypatch.setattr(xml_documents, "_skeletons", {})
    good = TEXT.format("k", LINE.format("d", "t"))
    assert _Document(good).kind == "FACTURA"
    for bad in (good + "x", "x" + good, good.replace(">k<", ">&k;<"), good.replace(">k<", ">]]><"), good.replace(">k<", ">\x02<")):
        assert _Document(bad).reason == "malformed" and _Document(bad.encode()).reason == "malformed"


def test_second_document_with_the_same_tags_needs_no_parser(monkeypatch):
    monkeypatch.setattr(xml_documents, "_skeletons", {})
    monkeypatch.setattr(xml_documents, "_roots", {})
    first, second = (TEXT.format(k, LINE.format(f"{k} &amp; {k}", k)) for k in "xy")
    assert _Document(first).kind == _Document(first, with_lines=False).kind == "FACTURA"
    monkeypatch.setattr(xml_documents.ElementTree, "XMLParser", None)
    monkeypatch.setattr(xml_documents.expat, "ParserCreate", None)
    row = next(_Document(second).rows("f", second))
    assert row[0] == "f" and "y & y" in row and _Document(second, with_lines=False).kind == "FACTURA"
