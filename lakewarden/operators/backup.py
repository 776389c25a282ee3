"""Backups as datasets: manifests, checks, restore, listing and retention.

A manifest has one row per file: (backup_id, path, type, size, checksum). Files are
hashed in blocks; the checksum of a longer file is the root of a tree over them.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from lakewarden.functions.columns import ntz
from lakewarden.session import settled

# Supported layout, assumed restore rate, names inside a backup.
FORMAT_VERSIONS = (1,)
RESTORE_BYTES_PER_SECOND = 10 * 1024 * 1024
FIRST_VERSION_FILE = "00000000000000000000.json"
LOG_FOLDER = "_delta_log"

BLOCK_BYTES = 128 * 1024 * 1024  # of a file that one hash covers
PIECE_BYTES = 1 << 20            # of a block in memory at a time
TASK_BLOCKS = 8                  # of long files, for each task
FANOUT = 1024                    # hashes under one node of a file's tree


def backup_id(source: str, table: str, created: str) -> str:
    return hashlib.sha256(f"{source}_{table}_{created}".encode()).hexdigest()[:16]


def block_manifest(spark: SparkSession, root: str, log_folder: str = "log", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(path, size, type, blocks, block, start, checksum) of every block of every file under a root.

    Files of one block are hashed where Spark reads them. Of longer ones only
    the length is listed; their blocks are dealt to tasks, and each is read by
    its byte range, a piece at a time. So a file may be of any size, and no task
    holds more than a block. Spark lists no empty files, so they have no row.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    name = F.element_at(F.split("path", "/"), -1)
    kind = (
        F.when(name.contains("checkpoint"), "checkpoint")
        .when(F.col("path").contains(f"/{log_folder}/"), "log").otherwise("data")).alias("type")
    zero = F.lit(0).cast("long")
    short = files.where(F.col("length") <= block_bytes).select(
        "path", F.col("length").alias("size"), kind, F.lit(1).cast("long").alias("blocks"), zero.alias("block"), zero.alias("start"), F.sha2("content", 256).alias("checksum"))
    long = files.where(F.col("length") > block_bytes).select(
        "path", F.col("length").alias("size"), kind, F.ceil(F.col("length") / F.lit(block_bytes)).alias("blocks"))
    blocks = long.agg(F.coalesce(F.sum("blocks"), F.lit(0))).first()[0]
    if not blocks:
        return short
    ranges = long.select("*", F.explode(F.sequence(zero, F.col("blocks") - 1)).alias("block"))
    dealt = ranges.repartition(-(-blocks // TASK_BLOCKS), "path", "block").withColumn("start", F.col("block") * block_bytes)
    hashed = dealt.mapInArrow(
        lambda batches: _hash_ranges(batches, block_bytes), "path string, size long, type string, blocks long, block long, start long, checksum string")
    return short.unionByName(hashed)


def _hash_ranges(batches: Iterator[pa.RecordBatch], block_bytes: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sums = []
        for path, start in zip(batch.column("path").to_pylist(), batch.column("start").to_pylist()):
            digest, left = hashlib.sha256(), block_bytes
            with _opened(path) as file:
                file.seek(start)
                while left and (piece := file.read(min(left, PIECE_BYTES))):
                    digest.update(piece)
                    left -= len(piece)
            sums.append(digest.hexdigest())
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sums, pa.string())], [*batch.schema.names, "checksum"])


def _opened(path: str):
    if path.startswith("file:"):
        return open("/" + path.removeprefix("file:").lstrip("/"), "rb")
    system, name = fs.FileSystem.from_uri(path)
    return system.open_input_file(name)


def file_checksums(blocks: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """(path, size, checksum, type) of files from their written blocks.

    A file of one block has the block's hash, the SHA-256 of its bytes. Above
    that stands a tree: each node hashes the joined hashes of up to ``fanout``
    nodes below it, so no row grows with the file.
    """
    most = blocks.agg(F.coalesce(F.max("blocks"), F.lit(0))).first()[0]
    file = ["path", "size", "type"]
    while most > 1:
        made = blocks.groupBy(*file, "blocks", F.floor(F.col("block") / fanout).alias("node")).agg(
            F.array_sort(F.collect_list(F.struct("block", "checksum")))["checksum"].alias("sums"))
        node = F.when(F.col("blocks") == 1, F.col("sums")[0]).otherwise(F.sha2(F.array_join("sums", ""), 256))
        blocks = made.select(
            *file, F.ceil(F.col("blocks") / fanout).alias("blocks"), F.col("node").alias("block"), node.alias("checksum"))
        most = -(-most // fanout)
    return blocks.select("path", "size", "checksum", "type")


def file_manifest(
    spark: SparkSession, root: str, log_folder: str = "log", block_bytes: int = BLOCK_BYTES, fanout: int = FANOUT,
) -> DataFrame:
    """Path, size, checksum and type of every file under a root; hashing runs in the tasks, block by block."""
    return file_checksums(settled(block_manifest(spark, root, log_folder, block_bytes), "blocks"), fanout)


def relative_to(manifest: DataFrame, root: str) -> DataFrame:
    """Paths from the root on, so that two folders can be compared."""
    bare = re.sub(r"^[A-Za-z0-9+.-]+:/+", "/", root).rstrip("/") + "/"
    return manifest.withColumn("path", F.substr("path", F.instr("path", bare) + F.lit(len(bare))))


def changed_blocks(recorded: DataFrame, stored: DataFrame) -> DataFrame:
    """(path, block, start, issue) of blocks that are missing, added or changed: what has to be copied again."""
    now = stored.select("path", "block", F.col("start").alias("__start"), F.col("checksum").alias("__checksum"))
    issue = F.when(F.col("__checksum").isNull(), "block_missing").when(F.col("checksum").isNull(), "block_added").when(
        F.col("checksum") != F.col("__checksum"), "block_changed")
    return recorded.join(now, ["path", "block"], "full").select(
        "path", "block", F.coalesce("start", "__start").alias("start"), issue.alias("issue")).where(F.col("issue").isNotNull())


def manifest_totals(manifest: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Files, size and one checksum over the list.

    The list checksum adds up per-file hashes, so no task ever holds the list
    and the order of files does not matter.
    """
    entry = F.sha2(F.concat_ws("|", "path", F.col("size").cast("string"), "checksum"), 256)
    part = F.conv(F.substring(entry, 1, 15), 16, 10).cast("decimal(38,0)")
    return manifest.groupBy(*by).agg(
        F.count("*").alias("total_files"), F.sum("size").alias("total_size"),
        F.sha2(F.concat_ws("|", F.count("*").cast("string"), F.sum(part).cast("string")), 256).alias("list_checksum"))


def _issue(severity: str, name: str, cond: Column) -> Column:
    return F.when(cond, F.struct(F.lit(severity).alias("severity"), F.lit(name).alias("issue")))


def integrity_issues(manifest: DataFrame, stored: DataFrame, mode: str = "checksum") -> DataFrame:
    """Files that are missing or, unless mode is "none", differ in checksum or size."""
    there = stored.select("backup_id", "path", F.col("size").alias("__size"),
                          F.col("checksum").alias("__checksum"), F.lit(True).alias("__there"))
    gone = F.col("__there").isNull()
    issues = [_issue("error", "file_missing", gone)]
    if mode in ("checksum", "full"):
        issues += [_issue("error", "checksum_mismatch", ~gone & (F.col("checksum") != F.col("__checksum"))),
                   _issue("error", "size_mismatch", ~gone & (F.col("size") != F.col("__size")))]
    return manifest.join(there, ["backup_id", "path"], "left").select(
        "backup_id", F.col("path").alias("file"), F.inline(F.array(*issues))).where(F.col("severity").isNotNull())


def completeness_issues(manifest: DataFrame) -> DataFrame:
    """Backups without log, first version or data, and gaps in their log versions."""
    is_log = F.col("type") == "log"
    version = F.when(is_log, F.regexp_extract("path", r"(\d{20})\.json$", 1).try_cast("long"))
    facts = manifest.withColumn("__version", version).groupBy("backup_id").agg(
        F.count_if(is_log).alias("logs"), F.count_if(F.col("type") == "data").alias("data"),
        F.count_if(is_log & F.col("path").contains(FIRST_VERSION_FILE)).alias("first"))
    required = facts.select("backup_id", F.lit("").alias("file"), F.inline(F.array(
        _issue("error", "missing_log_files", F.col("logs") == 0),
        _issue("error", "missing_protocol", F.col("first") == 0),
        _issue("error", "missing_metadata", F.col("first") == 0),
        _issue("warning", "no_data_files", F.col("data") == 0)))).where(F.col("severity").isNotNull())
    have = manifest.select("backup_id", version.alias("__version")).where(F.col("__version").isNotNull()).distinct()
    return required.unionByName(version_gaps(have).select(
        "backup_id", F.concat(F.lit("version "), F.when(F.col("from") == F.col("to"), F.col("to").cast("string")).otherwise(
            F.concat_ws(" to ", F.col("from").cast("string"), F.col("to").cast("string")))).alias("file"),
        F.lit("warning").alias("severity"), F.lit("version_gap").alias("issue")))


def version_gaps(have: DataFrame) -> DataFrame:
    """(backup_id, from, to) of each stretch of versions below the newest that a backup lacks.

    Versions without the next or the one before border a gap; only these few are put in order.
    """
    v = F.col("__version")
    border = have.withColumn("__one", F.lit(1))

    def lacking(step: int, side: int) -> DataFrame:
        near = border.select("backup_id", (v - step).alias("__version"))
        return have.join(near, ["backup_id", "__version"], "left_anti").select(
            "backup_id", (v + step).alias("__at"), F.lit(side).alias("__side"))

    before = have.select("backup_id").distinct().select("backup_id", F.lit(-1).cast("long").alias("__version"))
    zero = before.join(have.where(v == 0).select("backup_id"), "backup_id", "left_anti").select(
        "backup_id", F.lit(0).cast("long").alias("__at"), F.lit(0).alias("__side"))
    ends = lacking(-1, 1).where(F.col("__at") >= 0)
    edges = lacking(1, 0).unionByName(ends).unionByName(zero)
    order = Window.partitionBy("backup_id").orderBy("__at", "__side")
    return edges.withColumn("from", F.lag("__at").over(order)).where(F.col("__side") == 1).select(
        "backup_id", "from", F.col("__at").alias("to"))


def restorability_issues(manifest: DataFrame, stored: DataFrame, mode: str = "checksum") -> DataFrame:
    """All that speaks against a restore: integrity, completeness, format and a missing log folder."""
    facts = manifest.groupBy("backup_id").agg(
        F.max("format_version").alias("v"), F.count_if(F.col("path").contains(LOG_FOLDER)).alias("logs"))
    more = facts.select("backup_id", F.lit("").alias("file"), F.inline(F.array(
        _issue("error", "unsupported_format", ~F.col("v").isin(*FORMAT_VERSIONS)),
        _issue("error", "missing_delta_log", F.col("logs") == 0)))).where(F.col("severity").isNotNull())
    return integrity_issues(manifest, stored, mode).unionByName(completeness_issues(manifest)).unionByName(more)


def restorability(manifest: DataFrame, stored: DataFrame, mode: str = "checksum") -> DataFrame:
    """Per backup: errors, warnings and whether it can be restored."""
    found = restorability_issues(manifest, stored, mode).groupBy("backup_id").agg(
        F.count_if(F.col("severity") == "error").alias("errors"),
        F.count_if(F.col("severity") == "warning").alias("warnings"))
    return manifest.select("backup_id").distinct().join(found, "backup_id", "left").fillna(
        0, ["errors", "warnings"]).withColumn("valid", F.col("errors") == 0)


def content_hash(df: DataFrame) -> DataFrame:
    """Row count and an order-independent hash of the rows; one row."""
    cols = sorted(df.columns)
    return df.agg(F.count("*").alias("rows"),
                  F.coalesce(F.sum(F.xxhash64(*cols).cast("decimal(38,0)")), F.lit(0)).alias("hash"))


def export_snapshot(df: DataFrame, root: str, source: str, table: str, created: str) -> tuple[str, str]:
    """Write the rows of a version under a dated prefix; returns backup id and path."""
    made = backup_id(source, table, created)
    path = f"{root.rstrip('/')}/{source}/{table}/{created.replace(':', '-').replace(' ', 'T')}/data"
    df.write.mode("overwrite").option("compression", "snappy").parquet(path)
    return made, path


def restore(spark: SparkSession, path: str, recorded: DataFrame, target: str, recorded_content: DataFrame | None = None) -> DataFrame:
    """Copy a backup to its target after its files pass the checks, and check the copy.

    ``recorded`` is the manifest taken at backup time, of the same path.
    """
    now = file_manifest(spark, path).withColumn("backup_id", F.lit("b"))
    bad = integrity_issues(recorded.withColumn("backup_id", F.lit("b")), now, "full")
    if not bad.isEmpty():
        raise ValueError("backup is not valid, nothing was restored")
    rows = spark.read.parquet(path)
    rows.write.mode("errorifexists").parquet(target)
    copy = spark.read.parquet(target)
    wanted = recorded_content if recorded_content is not None else content_hash(rows)
    if wanted.exceptAll(content_hash(copy)).count():
        raise ValueError("restored rows differ from the backup")
    return copy


def restore_preview(manifest: DataFrame) -> DataFrame:
    """Per backup: files, size and seconds at the assumed rate, at least one."""
    size = F.coalesce(F.sum("size"), F.lit(0))
    return manifest.groupBy("backup_id").agg(
        F.count("*").alias("files"), size.alias("total_size"),
        F.greatest(F.lit(1), F.floor(size / RESTORE_BYTES_PER_SECOND)).cast("long").alias("estimated_seconds"))


def write_headers(headers: DataFrame, root: str) -> None:
    """Backup headers as JSON, one folder per source and table."""
    headers.write.mode("append").partitionBy("source", "table").json(root)


def list_backups(
    spark: SparkSession, root: str, schema: str, source: str | None = None, table: str | None = None,
    wanted_id: str | None = None,
) -> DataFrame:
    """Headers under a root; source and table prune folders, the id is looked up in them."""
    out = spark.read.schema(f"{schema}, source string, table string").json(root)
    for col, value in (("source", source), ("table", table), ("backup_id", wanted_id)):
        if value is not None:
            out = out.where(F.col(col) == value)
    return out


def older_than(df: DataFrame, ts: str, as_of, days: int) -> DataFrame:
    """Rows created before as_of - days."""
    return df.where(F.col(ts) < ntz(as_of) - F.make_dt_interval(F.lit(days)))
