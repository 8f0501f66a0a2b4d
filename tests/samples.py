"""A small purchase: three invoice lines and one credit-note line of one provider."""

from __future__ import annotations

from ledgerloom.schemas import RAW_COLUMNS, RAW_LINE

_BASE = {
    **dict.fromkeys(RAW_COLUMNS, ""),
    "SourceFile": "a.xml",
    "TipoDocumento": "FACTURA",
    "Emisor_Nombre": "Huerta Verde S.A.",
    "Emisor_NombreComercial": "Huerta Verde",
    "Emisor_Identificacion": "3101000001",
    "Receptor_Nombre": "Fonda Central",
    "Receptor_Identificacion": "3102000002",
    "CodigoMoneda": "CRC",
    "TipoCambio": "1",
    "UnidadMedida": "kg",
    "Impuesto_Codigo": "01",
}


def raw_row(**values) -> dict:
    return {**_BASE, **values}


def _priced(number, moment, line, product, quantity, price, net, rate, tax, total, **more) -> dict:
    return raw_row(
        NumeroConsecutivo=number,
        FechaEmision=moment,
        NumeroLinea=str(line),
        CodigoCABYS=product[:3],
        Detalle=product,
        Cantidad=str(quantity),
        PrecioUnitario=str(price),
        MontoTotal=str(net),
        SubTotal=str(net),
        BaseImponible=str(net),
        ImpuestoNeto=str(tax),
        MontoTotalLinea=str(total),
        Impuesto_Tarifa=str(rate),
        Impuesto_Monto=str(tax),
        **more,
    )


FIRST, SECOND, NOTE = "00100001010000000123", "00100001010000000124", "00100001030000000001"

INVOICE_ROWS = [
    _priced(FIRST, "2026-01-15T10:00:00", 1, "Tomate", 10, 1200, 12000, 13, 1560, 13560),
    _priced(FIRST, "2026-01-15T10:00:00", 2, "Queso", 5, 3200, 16000, 1, 160, 16160),
    _priced(SECOND, "2026-02-03T09:30:00", 1, "Tomate", 8, 1300, 10400, 13, 1352, 11752),
]
NOTE_ROWS = [
    _priced(
        NOTE,
        "2026-02-05T12:00:00",
        1,
        "Tomate",
        1,
        1200,
        1200,
        13,
        156,
        1356,
        **{"TipoDocumento": "NOTA_CREDITO", "Referencia_Numero": FIRST, "Referencia_Codigo": "03"},
    )
]
AS_OF = "2026-03-01 00:00:00"


def raw_frame(spark, rows):
    return spark.createDataFrame([tuple(r[c] for c in RAW_COLUMNS) for r in rows], RAW_LINE)


def xml_of(rows, root="FacturaElectronica", namespace=' xmlns="https://example.test/v4"') -> str:
    """One document holding the given lines; empty fields become empty elements."""
    head = rows[0]

    def tags(**values):
        return "".join(f"<{k}>{v}</{k}>" for k, v in values.items())

    lines = "".join(
        "<LineaDetalle>"
        + tags(**{c: r[c] for c in RAW_COLUMNS[RAW_COLUMNS.index("NumeroLinea") : RAW_COLUMNS.index("Impuesto_Codigo")]})
        + "<Impuesto>"
        + tags(
            Codigo=r["Impuesto_Codigo"],
            CodigoTarifaIVA=r["Impuesto_CodigoTarifaIVA"],
            Tarifa=r["Impuesto_Tarifa"],
            Monto=r["Impuesto_Monto"],
        )
        + "</Impuesto></LineaDetalle>"
        for r in rows
    )
    reference = (
        f"<InformacionReferencia>{tags(Numero=head['Referencia_Numero'], Codigo=head['Referencia_Codigo'])}"
        "</InformacionReferencia>"
        if head["Referencia_Numero"]
        else ""
    )
    currency = tags(CodigoMoneda=head["CodigoMoneda"], TipoCambio=head["TipoCambio"])
    return (
        f'<?xml version="1.0" encoding="UTF-8"?>\n<!-- issued -->\n<{root}{namespace}>'
        + tags(Clave=head["Clave"], NumeroConsecutivo=head["NumeroConsecutivo"], FechaEmision=head["FechaEmision"])
        + f"<Emisor>{tags(Nombre=head['Emisor_Nombre'])}"
        + f"<Identificacion>{tags(Tipo='02', Numero=head['Emisor_Identificacion'])}</Identificacion>"
        + f"{tags(NombreComercial=head['Emisor_NombreComercial'])}</Emisor>"
        + f"<Receptor>{tags(Nombre=head['Receptor_Nombre'])}"
        + f"<Identificacion>{tags(Numero=head['Receptor_Identificacion'])}</Identificacion></Receptor>"
        + f"<DetalleServicio>{lines}</DetalleServicio>"
        + f"<ResumenFactura><CodigoTipoMoneda>{currency}</CodigoTipoMoneda></ResumenFactura>"
        + f"{reference}</{root}>"
    )
