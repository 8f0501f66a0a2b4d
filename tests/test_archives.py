"""Archives of XML files: read member by member, and what the queries land their documents in."""

import io
import os
import tarfile

import pytest

from ledgerloom.plans import queries
from ledgerloom.plans.queries import Tables
from ledgerloom.sources import intake, star_schema, xml_documents

SMALLEST = "/root/testdata/sf0.001"
NOTHING = "<FacturaElectronica><Clave>{}</Clave><DetalleServicio><LineaDetalle/></DetalleServicio></FacturaElectronica>"


@pytest.mark.parametrize("ending, mode", [("tar", "w"), ("tar.gz", "w:gz"), ("tgz", "w:gz")])
def test_archives_are_read_beside_files(spark, tmp_path, ending, mode):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "c.xml").write_text(NOTHING.format("c"))
    with tarfile.open(tmp_path / "in" / f"more.{ending}", mode) as archive:
        for name in ("a.xml", "deep/b.XML", "_passed.xml", "notes.txt"):
            content = NOTHING.format(name).encode()
            member = tarfile.TarInfo(name)
            member.size = len(content)
            archive.addfile(member, io.BytesIO(content))
    lines = xml_documents.flatten_documents(xml_documents.read_documents(spark, [str(tmp_path / "in")]), load_order=True)
    found = {(r.SourceFile, r.Clave, r.load_path.rsplit("/in/", 1)[-1]) for r in lines.collect()}
    assert found == {("c.xml", "c", "c.xml"), ("a.xml", "a.xml", f"more.{ending}/a.xml"), ("b.XML", "deep/b.XML", f"more.{ending}/deep/b.XML")}


def test_documents_of_orders_take_few_files(spark):
    tables = Tables(spark, SMALLEST)
    folder = tables.landed_files()[0].removeprefix("file:")
    files = [f for f in os.listdir(folder) if not f.startswith((".", "_"))]
    orders = tables.raw.select("NumeroConsecutivo").distinct().count()
    assert orders > 1000 and len(files) < orders / 50


def test_full_archives_are_followed_by_others(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(star_schema, "ARCHIVED", 3)
    documents = spark.range(10).coalesce(1).selectExpr("concat('d', id, '.xml') as source_file", "concat('<a>', id, '</a>') as xml")
    assert star_schema.land_archives(documents, str(tmp_path / "landed")) == 10
    archives = [f for f in os.listdir(tmp_path / "landed") if f.endswith(".tar.zst")]
    read = xml_documents.read_documents(spark, [str(tmp_path / "landed")]).collect()
    assert len(archives) == 4 and {(r.source_file, bytes(r.content)) for r in read} == {(f"d{k}.xml", f"<a>{k}</a>".encode()) for k in range(10)}


def test_texts_of_documents_are_escaped(spark):
    raw = Tables(spark, SMALLEST).raw.limit(1).selectExpr("* except (Detalle, NumeroLinea)", "'a<b> & \"c\"' as Detalle", "'1' as NumeroLinea")
    for documents in (star_schema.line_documents(raw), star_schema.order_documents(raw)):
        assert xml_documents.flatten_documents(documents).first().Detalle == 'a<b> & "c"'


def archive_of(members, **how) -> bytes:
    out = io.BytesIO()
    with tarfile.open(fileobj=out, mode="w", **how) as archive:
        for name, content, kind in members:
            member = tarfile.TarInfo(name)
            member.type, member.size = kind, len(content)
            archive.addfile(member, io.BytesIO(content))
    return out.getvalue()


MIXED = [("a.xml", b"1", tarfile.REGTYPE), ("d", b"", tarfile.DIRTYPE), ("b" * 100, b"2" * 512, tarfile.REGTYPE), ("ñ" * 40, b"", tarfile.REGTYPE), ("c/" * 60 + "c", b"3" * 700, tarfile.REGTYPE), ("old", b"5", tarfile.AREGTYPE), ("e", b"4", tarfile.REGTYPE)]


def by_tarfile(content):
    with tarfile.open(fileobj=io.BytesIO(content), mode="r|") as archive:
        return [(m.name, m.size, archive.extractfile(m).read()) for m in archive if m.isfile()]


def told(reading):
    try:
        return reading()
    except tarfile.ReadError:
        return "error"


@pytest.mark.parametrize("how", [{"format": f} for f in (tarfile.USTAR_FORMAT, tarfile.GNU_FORMAT, tarfile.PAX_FORMAT)] + [{"pax_headers": {"comment": "x"}}])
def test_members_are_those_of_the_standard_reader(how):
    packed = archive_of(MIXED, **how)
    for content in (packed, packed[: 512 * 3], packed[: 512 * 2 + 100], packed[:512] + b"1" + bytes(511) + b"?" * 512 + packed[1024:], packed + b"x"):
        assert told(lambda: [(n, size, read()) for n, size, read in intake.members(io.BytesIO(content))]) == told(lambda: by_tarfile(content))
    passed = [n for n, _, _ in intake.members(io.BytesIO(packed))]
    assert passed == [n for n, _, k in MIXED if k != tarfile.DIRTYPE]


def test_plain_members_take_no_standard_reader(monkeypatch):
    packed = archive_of([("a.xml", b"1", tarfile.REGTYPE), ("b.xml", b"2" * 600, tarfile.REGTYPE)])
    monkeypatch.setattr(intake.tarfile, "open", None)
    assert [(n, read()) for n, _, read in intake.members(io.BytesIO(packed))] == [("a.xml", b"1"), ("b.xml", b"2" * 600)]
    with pytest.raises(tarfile.ReadError):
        list(intake.members(io.BytesIO(packed[: 512 * 4])))


def test_landed_members_are_those_of_tarfile():
    for name, content, _ in MIXED:
        assert archive_of([(name, content, tarfile.REGTYPE)]).startswith(star_schema._member(name, content))


def test_documents_of_lines_are_not_landed(spark, tmp_path, monkeypatch):
    """The documents are many times the tables that they are made of."""
    monkeypatch.setattr(queries, "scratch_folder", lambda spark, purpose: str(tmp_path / purpose))
    documents = Tables(spark, SMALLEST).documents
    lines = Tables(spark, SMALLEST).order_lines
    assert documents.count() == lines.count() + lines.filter("l_returnflag = 'R'").count() and not os.listdir(tmp_path)
