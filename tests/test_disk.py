"""What queries leave on the disk, and compressed CSV files."""

import gzip
import os

import pyarrow as pa
import pytest

from ledgerloom.operators.checkpoints import shuffles_freed
from ledgerloom.plans import queries
from ledgerloom.sources import csv_batches
from ledgerloom.sources.intake import LOAD_ORDER
from ledgerloom.sources.tables import TableStore

SMALLEST = "/root/testdata/sf0.001"
TEXT = "a,b\n" + "".join(f"{k},x {k}\n" for k in range(40)) + '"p\nq",y\n1\n'


def packed(path, text: str) -> None:
    if str(path).endswith(".gz"):
        path.write_bytes(gzip.compress(text.encode()))
    else:
        with pa.CompressedOutputStream(str(path), "zstd") as out:
            out.write(text.encode())


@pytest.mark.parametrize("size", [16, 2 << 20])
@pytest.mark.parametrize("ending", csv_batches.PACKED)
def test_compressed_files_give_the_same_records(tmp_path, monkeypatch, ending, size):
    monkeypatch.setattr(csv_batches, "BLOCK_BYTES", size)

    def records(path):
        return [row for b in csv_batches._blocks(f"file:{path}") for c in csv_batches._columns(b, 2) for row in zip(*(x.to_pylist() for x in c))]

    (tmp_path / "f.csv").write_text(TEXT)
    packed(tmp_path / f"g.csv{ending}", TEXT)
    assert records(tmp_path / f"g.csv{ending}") == records(tmp_path / "f.csv") != []


@pytest.mark.parametrize("multi_line", [True, False])
def test_compressed_files_are_read_beside_others(spark, tmp_path, monkeypatch, multi_line):
    monkeypatch.setattr(csv_batches, "TASK_BYTES", 64)
    plain = TEXT.replace('"p\nq"', "p")
    (tmp_path / "f.csv").write_text(plain)
    for ending in csv_batches.PACKED:
        packed(tmp_path / f"g{ending[1]}.csv{ending}", plain)
    read = csv_batches.read_csv_batch(spark, [str(tmp_path)], multi_line, load_order=True, packed=True)
    found = {}
    for row in read.orderBy(*LOAD_ORDER).collect():
        found.setdefault(row.SourceFile, []).append((row.a, row.b))
    assert sorted(found) == ["f.csv", "gg.csv", "gz.csv"] and found["f.csv"] == found["gg.csv"] == found["gz.csv"] and len(found["f.csv"]) == 42
    assert {r.SourceFile for r in csv_batches.read_csv_batch(spark, [str(tmp_path)], multi_line).collect()} == {"f.csv"}


@pytest.mark.parametrize("name", ["csv_batch_union", "prepared_source_load", "dedupe_keep_first", "export_table"])
def test_landed_lines_are_compressed(spark, tmp_path, monkeypatch, name):
    monkeypatch.setattr(queries, "scratch_folder", lambda spark, purpose: str(tmp_path / purpose))
    queries.registry()[name](spark, SMALLEST)
    found = [f"{d}/{f}" for d, _, files in os.walk(tmp_path) for f in files if ".csv" in f and not f.startswith(".")]
    assert found and all(f.endswith((".csv.gz", ".csv.zst")) for f in found)


def kept_shuffles(spark) -> int:
    return spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker().shuffleStatuses().size()


def test_writes_leave_no_shuffle(spark, tmp_path):
    frame = spark.range(1000).repartition(7, "id")
    store = TableStore(spark, str(tmp_path / "store"))
    kept = kept_shuffles(spark)
    assert store.publish("t", frame) == 1000 and kept_shuffles(spark) <= kept
    assert store.read("t").count() == frame.count() == 1000
    with shuffles_freed(spark):
        assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "true"
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_raw_lines_of_files_are_made_behind_the_shuffle(spark, tmp_path, monkeypatch):
    """Raw lines are many times as long as the order lines that they are made of."""
    lines, plans = queries.Tables(spark, SMALLEST).order_lines, []
    kind, original = type(lines), type(lines).mapInArrow

    def kept(self, *more, **named):
        plans.append(self._jdf.queryExecution().optimizedPlan().toString())
        return original(self, *more, **named)

    monkeypatch.setattr(kind, "mapInArrow", kept)
    queries.star_schema.land_csv(lines, str(tmp_path / "landed"))
    assert "RepartitionByExpression" in plans[0] and "Receptor_Nombre" not in plans[0][plans[0].index("RepartitionByExpression") :]
