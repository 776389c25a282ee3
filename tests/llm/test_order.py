"""The pipeline over several files against the same steps by hand, order included."""

import collections

from pyspark.sql import functions as F

import corpus_pipeline
from conftest import SF
from lakewarden.llm import mixing


def test_run_gives_the_order_of_the_mixture(spark, tmp_path, monkeypatch):
    given = spark.read.parquet(f"{SF}/documents.parquet")
    for n in range(4):  # files of very different length, the longest last
        part = given.where(F.pmod("doc_id", F.lit(15)).between(2**n - 1, 2 ** (n + 1) - 2)).coalesce(1)
        part.write.mode("append").parquet(f"{tmp_path}/documents.parquet")
    (tmp_path / "labels.parquet").symlink_to(f"{SF}/labels.parquet")
    monkeypatch.setattr(mixing, "PIECE", 40)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # the mixing stage in several files, as of a large table
    try:
        got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    docs = given
    for _, stage in corpus_pipeline.STAGES[:3]:
        docs = spark.createDataFrame(stage(spark, docs, SF).collect(), given.schema)
    own = collections.defaultdict(list)
    for r in docs.withColumn("h", F.xxhash64(F.lit(0), "doc_id", "text")).collect():
        own["\x00null" if r.source is None else r.source].append((r.h % 2**64 >> 1, r.h, r.doc_id))
    pieces = max(-(-len(v) // mixing.PIECE) for v in own.values())
    ranked = {s: [d for *_, d in sorted((int(p / 2**63 * pieces), h, d) for p, h, d in v)] for s, v in own.items()}
    plan = mixing.phases({s: -(-len(v) // mixing.BLOCK) for s, v in ranked.items()}, {s: len(v) ** mixing.SHARE for s, v in ranked.items()}, mixing.RESOLUTION)
    want = []
    for s, _, first, last, start, length, slots, places in plan:
        for block in range(first, last + 1):
            full, at = divmod(block - first, slots)
            slot = start + full * length + places[at]
            want += [(slot, i, d) for i, d in enumerate(ranked[s][block * mixing.BLOCK : (block + 1) * mixing.BLOCK])]
    assert len(want) > 100
    assert [(r.slot, r.offset, r.doc_id) for r in sorted(got, key=lambda r: (r.slot, r.offset))] == sorted(want)
    assert all(r.intact for r in got)
