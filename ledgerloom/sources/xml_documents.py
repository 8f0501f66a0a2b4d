"""Electronic documents in XML: one document per row in, one line per row out.

The standard parser reads each document, in Arrow batches: what is well formed, which
encodings, entities and namespaces count, is its business. Spark's ``from_xml`` reads
only part of a document's rules: it knows no namespaces, mixes the text around inner
elements, and takes what follows the root for granted.

A document is fed to the parser in chunks, and elements are taken from the tree as soon as they are
complete, so what is held of a long one is a chunk and some thousands of lines. Whether it is well
formed, and what stands behind the lines, is known at its end only; a document with more lines than are held is
read a second time for them.

Whether a document is well formed, and what its values are, follows from its tags alone once the parser has read
one with the very same tags, if all else are texts of plain characters and the five entities. Such documents are parted
at their tags and read by place.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from functools import lru_cache
from operator import itemgetter
from xml.etree import ElementTree
from xml.parsers import expat

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.schemas import DEFAULT_CURRENCY, DEFAULT_RATE, DOCUMENT_TYPES, RAW_COLUMNS
from ledgerloom.sources.intake import ARCHIVES, LOAD_ORDER, LOAD_TYPES, is_archive, landed, listed, unpacked

# Raw column and its element, from the document root.
DOCUMENT_PATHS = {
    "Clave": "Clave",
    "NumeroConsecutivo": "NumeroConsecutivo",
    "FechaEmision": "FechaEmision",
    "Emisor_Nombre": "Emisor/Nombre",
    "Emisor_NombreComercial": "Emisor/NombreComercial",
    "Emisor_Identificacion": "Emisor/Identificacion/Numero",
    "Receptor_Nombre": "Receptor/Nombre",
    "Receptor_Identificacion": "Receptor/Identificacion/Numero",
    "CodigoMoneda": "ResumenFactura/CodigoTipoMoneda/CodigoMoneda",
    "TipoCambio": "ResumenFactura/CodigoTipoMoneda/TipoCambio",
}
# Raw column and its element, from the first InformacionReferencia.
REFERENCE_PATHS = {
    "Referencia_TipoDoc": "TipoDocIR",
    "Referencia_Numero": "Numero",
    "Referencia_FechaEmision": "FechaEmisionIR",
    "Referencia_Codigo": "Codigo",
    "Referencia_Razon": "Razon",
}
# Elements of a LineaDetalle, named like their raw columns.
LINE_ELEMENTS = RAW_COLUMNS[RAW_COLUMNS.index("NumeroLinea") : RAW_COLUMNS.index("Impuesto_Codigo")]
# Raw column and its element, from the first Impuesto of a line.
TAX_PATHS = {
    "Impuesto_Codigo": "Codigo",
    "Impuesto_CodigoTarifaIVA": "CodigoTarifaIVA",
    "Impuesto_Tarifa": "Tarifa",
    "Impuesto_Monto": "Monto",
}
_DEFAULTS = {"CodigoMoneda": DEFAULT_CURRENCY, "TipoCambio": DEFAULT_RATE}
_DETAIL, _LINE, _REFERENCE, _TAX = "DetalleServicio", "LineaDetalle", "InformacionReferencia", "Impuesto"
_HEAD = [*DOCUMENT_PATHS, *REFERENCE_PATHS]
_OF_LINE = [*LINE_ELEMENTS, *TAX_PATHS]

#: Bytes fed to the parser at a time, lines of a document that are held until its end, and lines of a batch.
CHUNK, HELD, BATCH = 1 << 16, 4096, 4096


def read_documents(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Whole XML files as (``source_file``, ``content``), with their place in the order of loading.

    Files are found and opened by tasks and landed once, many to a container. Tar archives of XML files
    are read as they are.
    """
    files = listed(spark, paths, (".xml", *ARCHIVES), "XML file")
    archives, loose = files.filter(is_archive("load_path")), files.filter(~is_archive("load_path"))
    if archives.isEmpty():
        return landed(loose)
    members = unpacked(archives, ".xml")
    return members if loose.isEmpty() else landed(loose).unionByName(members)


def file_documents(files: DataFrame) -> DataFrame:
    """Rows of Spark's binary file source as (``source_file``, ``content``)."""
    return files.select(F.element_at(F.split("path", "/"), -1).alias("source_file"), "content")


class _Layout:
    """The tags to look for, in one namespace: steps from the root to a column, and those of a line."""

    def __init__(self, namespace: str):
        self.head: dict[str, tuple] = {}
        for column, path in DOCUMENT_PATHS.items():
            *above, last = path.split("/")
            steps = self.head
            for step in above:
                steps = steps.setdefault(namespace + step, (None, {}))[1]
            steps.setdefault(namespace + last, (column, {}))
        self.detail, self.line, self.reference, self.tax = (namespace + t for t in (_DETAIL, _LINE, _REFERENCE, _TAX))
        self.references = {namespace + t: c for c, t in REFERENCE_PATHS.items()}
        self.fields = {namespace + t: k for k, t in enumerate(LINE_ELEMENTS)}
        self.taxes = {namespace + t: len(LINE_ELEMENTS) + k for k, t in enumerate(TAX_PATHS.values())}

    def values(self, line: ElementTree.Element) -> tuple[str, ...]:
        """Texts of the first of each element of a line, and of those of its first tax."""
        found: list[str | None] = [None] * len(_OF_LINE)
        at_of, taxed = self.fields.get, False
        for child in line:
            tag = child.tag
            at = at_of(tag)
            if at is not None:
                if found[at] is None:
                    found[at] = child.text or ""
            elif not taxed and tag == self.tax:
                taxed = True
                for part in child:
                    at = self.taxes.get(part.tag)
                    if at is not None and found[at] is None:
                        found[at] = part.text or ""
        return tuple([x or "" for x in found])


@lru_cache(maxsize=256)
def _layout(namespace: str) -> _Layout:
    return _Layout(namespace)


def _first_texts(node: ElementTree.Element, steps: dict[str, tuple], found: dict[str, str]) -> None:
    """The text of the first element at the end of each path below the node."""
    for child in node:
        column, below = steps.get(child.tag, (None, None))
        if column is not None:
            found.setdefault(column, child.text or "")
        if below:
            _first_texts(child, below, found)


def _namespace(root: ElementTree.Element) -> str:
    namespace, brace, _ = root.tag.rpartition("}")
    return namespace + brace


def _elements(content: bytes | memoryview | str) -> Iterator[tuple[str, ElementTree.Element]]:
    """The root, then its children as they are complete, those that hold lines as one line after the other."""
    size = len(content)
    if size <= CHUNK:
        parser = ElementTree.XMLParser()
        parser.feed(content)
        root = parser.close()
        yield "root", root
    else:
        pulled, root = ElementTree.XMLPullParser(["start"]), None
        for start in range(0, size, CHUNK):
            pulled.feed(content[start : start + CHUNK])
            for _, element in pulled.read_events():
                if root is None:
                    root = element
                    yield "root", root
            if root is not None and len(root):
                yield from _complete(root, len(root) - 1)
                rest = root[0]
                if rest.tag == _namespace(root) + _DETAIL and len(rest) > 1:
                    yield from (("line", line) for line in rest[:-1] if line.tag == _namespace(root) + _LINE)
                    del rest[:-1]
        pulled.close()
        for _, element in pulled.read_events():
            if root is None:
                root = element
                yield "root", root
    yield from _complete(root, len(root))


def _complete(root: ElementTree.Element, n: int) -> Iterator[tuple[str, ElementTree.Element]]:
    """The first n children of the root, which are taken away."""
    namespace = _namespace(root)
    for child in root[:n]:
        if child.tag == namespace + _DETAIL:
            yield from (("line", line) for line in child if line.tag == namespace + _LINE)
        else:
            yield "child", child
    del root[:n]


def _root_tag(content: bytes | memoryview | str) -> str:
    """The tag of the root of a well-formed document. No tree is built, unless there is a document type: what that
    may bring, only the tree's parser knows all about.
    """
    tags: list[str] = []
    typed: list[bool] = []
    parser = expat.ParserCreate(namespace_separator="}")

    def first(tag: str, attributes: dict) -> None:
        tags.append(tag)
        parser.StartElementHandler = None

    parser.StartElementHandler = first
    parser.StartDoctypeDeclHandler = lambda *_: typed.append(True)
    parser.Parse(content, True)
    return ElementTree.fromstring(content).tag if typed else tags[0]


#: Shapes of documents that a process remembers, and elements of a document that may have one.
SHAPES, ELEMENTS = 4096, 512
_shapes: dict[tuple, tuple[str | None, list[itemgetter]]] = {}
_CONSTANTS = ["", *_DEFAULTS.values(), *DOCUMENT_TYPES.values()]


def _places(root: ElementTree.Element) -> tuple[str | None, list[list[int]]]:
    """The kind of a document, and for each of its lines the places of its values among the texts of all elements
    and the constants.

    Found by reading the document with its place in the text of every element.
    """
    n = 0
    for n, element in enumerate(root.iter(), 1):
        element.text = str(n - 1)
    document = _Document(None)
    document.walk(root)
    constant = {c: n + k for k, c in enumerate(_CONSTANTS)}
    found = document.found | (document.reference or {})
    if document.kind is None:
        return None, []
    head = [constant[document.kind], *(int(found[c]) if c in found else constant[_DEFAULTS.get(c, "")] for c in _HEAD)]
    return document.kind, [[*head, *(int(x) if x else constant[""] for x in line)] for line in document.lines]


# All bytes but the signs around tags and what is no character of XML or, as a carriage return, not read as it is.
_PLAIN = bytes(set(range(256)) - {*b"<>", *range(9), *range(11, 32)})
_TAG = re.compile(r"""/?[^\s"'=/!?]+(?:\s+[^\s"'=/]+\s*=\s*(?:"[^"&]*"|'[^'&]*'))*\s*/?""")
_DECLARATION = re.compile(r"""\?xml version=["']1[.]0["'](?: encoding=["'](?i:utf-8)["'])?(?: standalone=["'](?:yes|no)["'])?\s*\?""")
_UNKNOWN_ENTITY = re.compile("&(?!(?:amp|lt|gt|quot|apos);)")
_ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&amp;", "&"))
#: What is known of documents by their tags: (kind, places), or None where the parser has to read every one; tags of
#: roots; and how many more letters of tags a process remembers.
_skeletons: dict[str, tuple[str | None, list[itemgetter]] | None] = {}
_roots: dict[str, str] = {}
_room = [1 << 24]


def _parts(content: bytes | memoryview | str) -> tuple[str, list[str]]:
    """The tags of a short document, and all of it as text, tag, text, tag, ... text; nothing if it holds anything else."""
    try:
        raw = content.encode() if isinstance(content, str) else bytes(content)
        text = raw.decode()
    except UnicodeError:
        return "", []
    signs = raw.translate(None, _PLAIN)
    n = len(signs) // 2
    if not 0 < n <= 2 * ELEMENTS or signs != b"<>" * n or "\ufffe" in text or "\uffff" in text:
        return "", []
    parts = text.replace(">", "<").split("<")
    tags = "<".join(parts[1::2])
    if "&" in text:
        if _UNKNOWN_ENTITY.search(text):
            return "", []
        for entity, sign in _ENTITIES:
            parts = [part.replace(entity, sign) for part in parts]
    # What stands around the root and the declaration.
    first = 3 if parts[1].startswith("?") else 1
    if parts[-1].strip(" \t\n") or parts[first - 1].strip(" \t\n") or first > 1 and parts[0]:
        return "", []
    return tags, parts


def _plain_tags(tags: list[str]) -> int | None:
    """The number of the first element's tag; None where tags and texts do not tell all: comments, instructions, document types, other encodings."""
    first = 1 if _DECLARATION.fullmatch(tags[0]) else 0
    return first if len(tags) > first and all(map(_TAG.fullmatch, tags[first:])) else None


def _by_tags(tags: list[str], root: ElementTree.Element) -> tuple[str | None, list[itemgetter]] | None:
    """The kind of a document that the parser found to be well formed, and the places of the values of its lines among its parts and the constants.

    None where its tags do not tell them.
    """
    first = _plain_tags(tags)
    if first is None:
        return None
    constants = 2 * len(tags) + 1
    nothing = constants + _CONSTANTS.index("")
    opened = [k for k, tag in enumerate(tags) if k >= first and not tag.startswith("/")]
    place = [nothing if tags[k].endswith("/") else 2 * k + 2 for k in opened]
    kind, lines = _places(root)
    n = len(opened)
    return kind, [itemgetter(*(place[x] if x < n else constants + x - n for x in line)) for line in lines]


class _Document:
    """What one reading tells of a document: its kind or the reason why it has none, its fields, how
    many lines it has, and the first of them."""

    def __init__(self, content: bytes | memoryview | str | None, with_lines: bool = True):
        self.kind = self.reason = self.reference = None
        self.found: dict[str, str] = {}
        self.lines: list[tuple[str, ...]] = []
        self.whole: list[tuple[str, ...]] | None = None
        self.n = 0
        if content is None:
            self.reason = "unreadable"
            return
        layout = None
        try:
            if len(content) <= CHUNK:
                self._short(content, with_lines)
                self.reason = None if self.kind else "other document"
                return
            for what, element in _elements(content):
                if what == "root":
                    self.kind = DOCUMENT_TYPES.get(element.tag.rpartition("}")[2])
                    layout = _layout(_namespace(element)) if self.kind and with_lines else None
                elif layout is None:
                    continue
                elif what == "line":
                    self.n += 1
                    if self.n <= HELD:
                        self.lines.append(layout.values(element))
                else:
                    self._field(layout, element)
        except (ElementTree.ParseError, expat.ExpatError):
            self.kind, self.reason = None, "malformed"
        except (LookupError, ValueError):  # an encoding that nobody knows
            self.kind, self.reason = None, "unreadable"
        else:
            if self.kind is None:
                self.reason = "other document"

    def _short(self, content: bytes | memoryview | str, with_lines: bool) -> None:
        """A document that fits into a chunk: its tree is walked at once, or by what is known of one with the same elements."""
        tags, parts = _parts(content)
        if not with_lines:
            root_tag = _roots.get(tags)
            if root_tag is None:
                root_tag = _root_tag(content)
                if tags and len(tags) <= _room[0] and _plain_tags(tags.split("<")) is not None:
                    _room[0] -= len(tags)
                    _roots[tags] = root_tag
            self.kind = DOCUMENT_TYPES.get(root_tag.rpartition("}")[2])
            return
        by_tags = _skeletons.get(tags)
        if by_tags is not None:
            self.kind, places = by_tags
            parts += _CONSTANTS
            self.whole = [place(parts) for place in places]
            self.n = len(places)
            return
        parser = ElementTree.XMLParser()
        parser.feed(content)
        root = parser.close()
        elements = list(root.iter())
        if len(elements) > ELEMENTS:
            self.walk(root)
            return
        if tags and tags not in _skeletons and len(tags) <= _room[0]:
            _room[0] -= len(tags)
            texts = [e.text for e in elements]
            _skeletons[tags] = _by_tags(tags.split("<"), root)
            for element, text in zip(elements, texts, strict=True):
                element.text = text
        # In this order, tags and numbers of children are all there is to a tree.
        shape = tuple([x for e in elements for x in (e.tag, len(e))])
        known = _shapes.get(shape)
        if known is None:
            if len(_shapes) >= SHAPES:
                self.walk(root)
                return
            texts = [e.text or "" for e in elements]
            kind, lines = _places(root)
            known = _shapes[shape] = kind, [itemgetter(*line) for line in lines]
        else:
            texts = [e.text or "" for e in elements]
        self.kind, places = known
        texts += _CONSTANTS
        self.whole = [place(texts) for place in places]
        self.n = len(places)

    def walk(self, root: ElementTree.Element) -> None:
        self.kind = DOCUMENT_TYPES.get(root.tag.rpartition("}")[2])
        if self.kind is None:
            return
        layout = _layout(_namespace(root))
        for child in root:
            if child.tag == layout.detail:
                self.lines += [layout.values(line) for line in child if line.tag == layout.line]
            else:
                self._field(layout, child)
        self.n = len(self.lines)

    def _field(self, layout: _Layout, element: ElementTree.Element) -> None:
        column, below = layout.head.get(element.tag, (None, None))
        if column is not None:
            self.found.setdefault(column, element.text or "")
        if below:
            _first_texts(element, below, self.found)
        if element.tag == layout.reference and self.reference is None:
            self.reference = {}
            _first_texts(element, {t: (c, {}) for t, c in layout.references.items()}, self.reference)

    def rows(self, source_file: str, content: bytes | memoryview | str | None) -> Iterator[tuple[str, ...]]:
        """Raw lines, in the order of RAW_COLUMNS; of malformed and other documents none."""
        if self.kind is None:
            return
        if self.whole is not None:
            yield from ((source_file, *values) for values in self.whole)
            return
        found = self.found | (self.reference or {})
        head = (source_file, self.kind, *(found.get(c, _DEFAULTS.get(c, "")) for c in _HEAD))
        if self.n <= len(self.lines):
            yield from (head + line for line in self.lines)
            return
        self.lines = []
        layout = None
        for what, element in _elements(content):
            if what == "root":
                layout = _layout(_namespace(element))
            elif what == "line":
                yield head + layout.values(element)


def _contents(batches: Iterator[pa.RecordBatch], body: str, *columns: str) -> Iterator[tuple]:
    """Each document's content and the given columns; bytes are not copied."""
    for batch in batches:
        more = [batch.column(c).to_pylist() for c in columns]
        for content, *rest in zip(batch.column(body), *more, strict=True):
            if content.is_valid and pa.types.is_binary(content.type):
                yield memoryview(content.as_buffer()), *rest
            else:
                yield content.as_py(), *rest


def _body(documents: DataFrame) -> str:
    """A document's text is in ``content`` (bytes) or ``xml``."""
    return "content" if "content" in documents.columns else "xml"


def _texts(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def _described(documents: DataFrame) -> DataFrame:
    """(``source_file``, ``TipoDocumento``, ``reason``) of every document."""
    body, names = _body(documents), ["source_file", "TipoDocumento", "reason"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*rows)], names)

        rows: list[tuple] = []
        for content, name in _contents(batches, body, "source_file"):
            document = _Document(content, with_lines=False)
            rows.append((name, document.kind, document.reason))
            if len(rows) >= BATCH:
                yield batch(rows)
                rows = []
        if rows:
            yield batch(rows)

    return documents.select("source_file", body).mapInArrow(read, _texts(names))


def routed_documents(documents: DataFrame) -> DataFrame:
    """(``source_file``, ``TipoDocumento``) by the root element; null for those that give no lines."""
    return _described(documents).drop("reason")


def flatten_documents(documents: DataFrame, load_order: bool = False, kind: str | None = None) -> DataFrame:
    """One raw row per line; unknown roots and malformed documents give none.

    ``load_order`` adds each line's place in the order of loading (``LOAD_ORDER``), for documents that were
    read from files. ``kind`` keeps the lines of one type of document.
    """
    body = _body(documents)
    place = LOAD_ORDER[:2] if load_order else []
    schema = _texts(RAW_COLUMNS)
    if load_order:
        schema = T.StructType([*schema.fields, *T.StructType.fromDDL(LOAD_TYPES).fields])
    kinds = [pa.string()] * len(RAW_COLUMNS) + ([pa.int32(), pa.string(), pa.int64(), pa.int64()] if load_order else [])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], schema.names)

        rows: list[tuple] = []
        for content, name, *where in _contents(batches, body, "source_file", *place):
            document = _Document(content)
            if document.kind is None or kind is not None and document.kind != kind:
                continue
            for number, row in enumerate(document.rows(name, content)):
                rows.append((*row, *where, 0, number) if where else row)
                if len(rows) >= BATCH:
                    yield batch(rows)
                    rows = []
        if rows:
            yield batch(rows)

    return documents.select("source_file", body, *place).mapInArrow(read, schema)


def rejected_documents(documents: DataFrame) -> DataFrame:
    """Documents that give no rows, with the reason: unreadable, malformed or other document."""
    return _described(documents).filter(F.col("reason").isNotNull()).drop("TipoDocumento")


def invoice_lines(documents: DataFrame, load_order: bool = False) -> DataFrame:
    return flatten_documents(documents, load_order, DOCUMENT_TYPES["FacturaElectronica"])


def credit_note_lines(documents: DataFrame, load_order: bool = False) -> DataFrame:
    return flatten_documents(documents, load_order, DOCUMENT_TYPES["NotaCreditoElectronica"])


def read_invoice_xmls(spark: SparkSession, paths: Sequence[str], load_order: bool = False) -> DataFrame:
    """Invoice lines of many files; an error if they hold none."""
    lines = invoice_lines(read_documents(spark, paths), load_order)
    if lines.isEmpty():
        raise ValueError("The XML files hold no line of any invoice")
    return lines


def read_credit_note_xmls(spark: SparkSession, paths: Sequence[str], load_order: bool = False) -> DataFrame:
    """Credit-note lines of many files; none is fine."""
    if not paths:
        return spark.createDataFrame([], _texts(RAW_COLUMNS))
    return credit_note_lines(read_documents(spark, paths), load_order)
