"""Blocks of lines give the records of the standard reader."""

import csv
import io

import pyarrow as pa
import pytest

from ledgerloom.sources import csv_batches, star_schema

PLAIN = "a,b,c\n" + "".join(f"{k},x {k},\n" for k in range(50))
TEXTS = {
    "plain": PLAIN,
    "crlf": PLAIN.replace("\n", "\r\n"),
    "no line break at the end": PLAIN[:-1],
    "quotes late": PLAIN + '1,"p\nq",2\n3,4,5\n',
    "quotes in the middle of a value": PLAIN + 'x,y"z,w\n1,2,3\n',
    "quoted header": '"a","b\nb",c\n' + PLAIN[6:],
    "carriage returns": PLAIN.replace("\n", "\r"),
    "unequal": PLAIN + "1\n1,2,3,4\n" + PLAIN[6:],
    "blank lines": PLAIN.replace("7,x 7,\n", "\n\n7,x 7,\n") + "\n",
    "blank first line": "\n" + PLAIN,
    "mark inside": PLAIN + "﻿1,2,3\n",
    "mark first": "﻿" + PLAIN,
    "zero byte": PLAIN + "\x00,2,3\n",
    "one column": "a\n1\n\n2\n",
    "header alone": "a,b\n",
    "nulls spelled": "a,b\nNULL,null\nNaN,\n",
    "long line": "a,b\n1," + "y" * 900 + "\n2,z\n",
    "odd separators": "a,b\n1,x y\x85z\x0bw\n2,\x1c\n",
}


@pytest.mark.parametrize("size", [16, 64, 1 << 20])
@pytest.mark.parametrize("content", [*[t.encode() for t in TEXTS.values()], PLAIN.encode() + b"\xff\xc3,1,2\n3,4,5\n"], ids=[*TEXTS, "no text"])
def test_records(tmp_path, monkeypatch, content, size):
    monkeypatch.setattr(csv_batches, "BLOCK_BYTES", size)
    (tmp_path / "f.csv").write_bytes(content)
    width = len(next(csv.reader(io.StringIO(content.decode("utf-8-sig", "replace"), newline="")))) or 1
    text = io.TextIOWrapper(io.BytesIO(content), encoding="utf-8-sig", errors="replace", newline="")
    expected = [(r + [""] * width)[:width] for r in list(csv.reader(text))[1:] if r]
    found = [row for b in csv_batches._blocks(f"file:{tmp_path}/f.csv") for c in csv_batches._columns(b, width) for row in zip(*(x.to_pylist() for x in c))]
    assert [list(r) for r in found] == expected


def test_plain_lines_take_no_reader(tmp_path, monkeypatch):
    (tmp_path / "f.csv").write_text(PLAIN)
    monkeypatch.setattr(csv_batches.csv, "reader", None)
    assert sum(b.num_rows for b in csv_batches._blocks(f"file:{tmp_path}/f.csv")) == 50


def test_landed_records():
    odd = ["", None, "a,b", 'q"', "x\ny", " 1 "]
    for values in ([*odd], ["", None, "a b", " 1 "]):
        batch = pa.record_batch({"x": values, "y": ["z"] * len(values)})
        read = list(csv.reader(io.StringIO(bytes(star_schema.csv_records(batch)).decode(), newline="")))
        assert read == [[v or "", "z"] for v in values]
