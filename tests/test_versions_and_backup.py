"""Versioned tables, action logs, saved states, backups."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from conftest import as_set
from lakewarden.operators import backup as b, versions as vs
from lakewarden.session import fresh_dir
from lakewarden.operators.rules import Field
from lakewarden.sources.versioned import VersionedTable
from lakewarden.streaming import ingest

ACTIONS = "version int, path string, action string, size long"


def test_snapshot_by_version(rows):
    log = rows([(1, "A", "add", 10), (2, "B", "add", 20), (2, "A", "remove", None)], ACTIONS)
    assert as_set(vs.snapshot_files(log, 1).select("path")) == {("A",)}
    assert as_set(vs.snapshot_files(log, 2).select("path", "size")) == {("B", 20)}


def test_added_again_after_remove(rows):
    log = rows([(1, "A", "add", 1), (2, "A", "remove", None), (3, "A", "add", 3)], ACTIONS)
    assert as_set(vs.snapshot_files(log, 3).select("path", "size")) == {("A", 3)}


def test_empty_log(rows):
    assert vs.latest_version(rows([], ACTIONS)).first().version == -1


@pytest.mark.parametrize("state, errors", [
    (["protocol", "metaData", ("p", 1)], 0), (["metaData", ("p", 1)], 1), (["protocol", ("p", 1)], 1),
    (["protocol", "metaData", ("", 1)], 1), (["protocol", "metaData", ("p", -1)], 1), (["protocol", "protocol", "metaData"], 1),
])
def test_structure(rows, state, errors):
    data = [(1, x, None, None) if isinstance(x, str) else (1, "add", *x) for x in state]
    found = vs.structure_issues(rows(data, "version int, action string, path string, size long"))
    assert found.where("severity = 'error'").count() == errors


def test_state_differences(rows):
    snap = rows([("a", 1, 5), ("b", 2, 5), ("c", 3, 5)], "path string, size long, modified long")
    state = rows([("a", 1, 6), ("b", 9, 5), ("x", 1, 5)], "path string, size long, modified long")
    got = as_set(vs.state_against_snapshot(state, snap).select("path", "severity"))
    assert got == {("a", "warning"), ("b", "error"), ("c", "error"), ("x", "error")}


def test_versioned_table(spark, rows):
    table = VersionedTable.create(spark, fresh_dir(spark, "test-table"))
    assert table.latest() == -1
    assert table.commit(spark.range(10)) == 0
    assert table.commit(spark.range(10, 15)) == 1
    assert table.commit(spark.range(3), replace=True) == 2
    assert [table.read(v).count() for v in (0, 1, 2)] == [10, 15, 3]
    # A commit that is run again changes nothing.
    assert table.commit(spark.range(99), version=1) == 1
    assert table.latest() == 2 and table.read().count() == 3
    # A column added later is NULL in the files before.
    table.commit(spark.range(1).withColumn("extra", F.lit("x")))
    assert as_set(table.read().groupBy("extra").count()) == {(None, 3), ("x", 1)}
    with pytest.raises(ValueError):
        VersionedTable.create(spark, fresh_dir(spark, "test-none")).read()


def test_versions_before_a_type_change_still_read(spark):
    table = VersionedTable.create(spark, fresh_dir(spark, "test-types"))
    table.commit(spark.range(3))
    table.commit(spark.range(3, 5))
    table.commit(spark.createDataFrame([("7",), ("x",)], "id string"))
    assert dict(table.read(1).dtypes) == {"id": "bigint"} and table.read(1).count() == 5
    assert as_set(table.read(0)) == {(0,), (1,), (2,)}
    assert as_set(table.read()) == {(str(i),) for i in range(5)} | {("7",), ("x",)}


def test_only_the_folders_of_a_version_are_listed(spark):
    table = VersionedTable.create(spark, fresh_dir(spark, "test-folders"))
    for start in (0, 10, 20):
        table.commit(spark.range(start, start + 10), replace=start == 10)
    for at, folders in ((0, {0}), (1, {1}), (2, {1, 2})):
        listed = {int(f.rsplit("version=", 1)[1].split("/")[0]) for f in table.read(at).inputFiles()}
        assert listed == folders


def test_one_odd_file_name_is_one_gap(rows):
    names = [0, 1, 4, 9_999_999_999]
    m = rows([("b", f"_delta_log/{v:020d}.json", "log", 1, "c") for v in names] + [("b", "x.parquet", "data", 1, "c")],
             "backup_id string, path string, type string, size long, checksum string")
    found = b.completeness_issues(m).where("issue = 'version_gap'")
    assert as_set(found.select("file")) == {("version 2 to 3",), ("version 5 to 9999999998",)}


def test_retention_keeps_newest(rows):
    files = rows([("t", i) for i in range(6)], "k string, v int")
    assert as_set(vs.beyond_newest(files, ["k"], ["v"], 2).select("v")) == {(0,), (1,), (2,), (3,)}


def test_manifest_and_restore(spark):
    root = fresh_dir(spark, "test-backup")
    made, path = b.export_snapshot(spark.range(100), f"{root}/b", "crm", "t", "2024-01-01T00:00:00.000Z")
    assert len(made) == 16
    b.file_manifest(spark, path).write.parquet(f"{root}/m")
    recorded = spark.read.parquet(f"{root}/m")
    assert b.restore(spark, path, recorded, f"{root}/t1").count() == 100
    damaged = recorded.withColumn("checksum", F.lit("0"))
    with pytest.raises(ValueError):
        b.restore(spark, path, damaged, f"{root}/t2")


def plain_tree(data, block, fanout):
    """Root of the tree over a file's blocks, by loops."""
    nodes = [hashlib.sha256(data[i : i + block]).hexdigest() for i in range(0, max(1, len(data)), block)]
    while len(nodes) > 1:
        nodes = [hashlib.sha256("".join(nodes[i : i + fanout]).encode()).hexdigest() for i in range(0, len(nodes), fanout)]
    return nodes[0]


def test_files_of_several_blocks(spark, tmp_path):
    draw = random.Random(4)
    sizes = {"one": 100, "two": 101, "three": 300, "log/many": 5000, "checkpoint x=1": 901}
    data = {name: draw.randbytes(size) for name, size in sizes.items()}
    (tmp_path / "log").mkdir()
    for name, content in data.items():
        (tmp_path / name).write_bytes(content)

    (tmp_path / "empty").touch()  # Spark lists no empty files

    def blocks():
        return b.relative_to(b.block_manifest(spark, str(tmp_path), block_bytes=100), str(tmp_path))

    found = {r.path: (r.size, r.checksum, r.type) for r in b.relative_to(
        b.file_manifest(spark, str(tmp_path), block_bytes=100, fanout=3), str(tmp_path)).collect()}
    kinds = {"log/many": "log", "checkpoint x=1": "checkpoint"}
    assert found == {n: (len(x), plain_tree(x, 100, 3), kinds.get(n, "data")) for n, x in data.items()}
    assert found["one"][1] == hashlib.sha256(data["one"]).hexdigest()

    recorded = spark.createDataFrame(blocks().collect(), blocks().schema)
    assert as_set(recorded.groupBy("path").count()) == {(n, max(1, -(-s // 100))) for n, s in sizes.items()}
    assert b.changed_blocks(recorded, blocks()).count() == 0
    changed = bytearray(data["three"])
    changed[150] ^= 1
    (tmp_path / "three").write_bytes(changed)
    (tmp_path / "two").write_bytes(data["two"][:100])
    (tmp_path / "one").write_bytes(data["one"] + b"x")
    assert as_set(b.changed_blocks(recorded, blocks())) == {
        ("three", 1, 100, "block_changed"), ("two", 1, 100, "block_missing"), ("one", 1, 100, "block_added")}


def test_blocks_are_dealt_to_tasks_and_read_in_pieces(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(b, "TASK_BLOCKS", 2)
    monkeypatch.setattr(b, "PIECE_BYTES", 7)
    (tmp_path / "big").write_bytes(bytes(range(256)) * 10)
    found = b.block_manifest(spark, str(tmp_path), block_bytes=256)
    assert found.rdd.getNumPartitions() >= 5
    assert {r.checksum for r in found.collect()} == {hashlib.sha256(bytes(range(256))).hexdigest()}


def test_list_checksum_ignores_order(rows):
    one = rows([("a", 1, "x"), ("b", 2, "y")], "path string, size long, checksum string")
    two = rows([("b", 2, "y"), ("a", 1, "x")], "path string, size long, checksum string")
    other = rows([("b", 2, "y"), ("a", 1, "z")], "path string, size long, checksum string")
    sums = [b.manifest_totals(x).first().list_checksum for x in (one, two, other)]
    assert sums[0] == sums[1] != sums[2]


def test_preview_takes_at_least_a_second(rows):
    m = rows([("b", "p", 5), ("c", "p", 50 * 1024 * 1024)], "backup_id string, path string, size long")
    assert as_set(b.restore_preview(m).select("backup_id", "estimated_seconds")) == {("b", 1), ("c", 5)}


def test_stream_rejects_a_bad_batch_and_takes_it_up_again(spark):
    root = fresh_dir(spark, "test-strict")
    table = VersionedTable.create(spark, f"{root}/table")
    data = spark.createDataFrame([(1,), (None,)], "n int")
    data.coalesce(1).write.parquet(f"{root}/in")
    stream = ingest.read_stream(spark, f"{root}/in", data)
    fields = [Field("n", "integer", False)]
    with pytest.raises(Exception, match="has errors"):
        ingest.ingest(stream, table, fields, f"{root}/cp", strict=True)
    assert table.latest() == -1
    ingest.ingest(stream, table, fields, f"{root}/cp", strict=True, prepare=lambda df: df.where("n is not null"))
    assert table.latest() == 0 and table.read().count() == 1
