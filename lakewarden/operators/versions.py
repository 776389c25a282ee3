"""Analytics over action logs and materialised table states."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from lakewarden.functions.windows import newest_per_key, null_safe_join

MIB = 1024 * 1024


def latest_version(actions: DataFrame) -> DataFrame:
    """Highest version as one row, -1 when there is none."""
    return actions.agg(F.coalesce(F.max("version"), F.lit(-1)).alias("version"))


def snapshot_files(actions: DataFrame, version: int) -> DataFrame:
    """Files active at a version: the last action of a path decides.

    One hash aggregate over a number made of version and kind, so per path only
    the newest action is kept before the shuffle and nothing is sorted. In one
    version a remove comes before an add.
    """
    order = F.col("version").cast("long") * 2 + F.when(F.col("action") == "add", 1).otherwise(0)
    last = actions.where(F.col("version") <= version).groupBy("path").agg(
        F.max(order).alias("__o"), F.max_by(F.col("size").cast("long"), order).alias("size"))
    return last.where(F.col("__o") % 2 == 1).select("path", F.floor(F.col("__o") / 2).cast("int").alias("added_in"), "size")


def data_volume(actions: DataFrame, after: int, to: int) -> DataFrame:
    """Whole MiB added in versions (after, to]."""
    total = F.coalesce(F.sum("size"), F.lit(0))
    return actions.where((F.col("action") == "add") & (F.col("version") > after) & (F.col("version") <= to)).agg(
        F.count("*").alias("files"), total.alias("bytes"), F.floor(total / MIB).alias("mib"))


def structure_issues(states: DataFrame, by: str = "version") -> DataFrame:
    """Structural faults of saved states: (version, type, description, severity, times)."""

    def of(kind: str) -> Column:
        return F.count_if(F.col("action") == kind)

    counts = states.groupBy(by).agg(
        of("protocol").alias("protocols"), of("metaData").alias("metadatas"), of("remove").alias("removes"),
        F.count_if((F.col("action") == "add") & (F.coalesce("path", F.lit("")) == "")).alias("no_path"),
        F.count_if((F.col("action") == "add") & (F.col("size") < 0)).alias("negative"),
    )

    def fault(holds: Column, text: str, severity: str = "error", times: Column | None = None) -> Column:
        return F.when(holds, F.struct(
            F.lit("structure").alias("type"), F.lit(text).alias("description"), F.lit(severity).alias("severity"),
            (F.lit(1) if times is None else times).cast("long").alias("times")))

    many, some = F.col("protocols") - 1, F.col("metadatas") - 1
    grouped = counts.select(by, F.inline(F.array_compact(F.array(
        fault(many > 0, "Multiple protocol actions found", times=many),
        fault(some > 0, "Multiple metadata actions found", times=some),
        fault(F.col("protocols") == 0, "No protocol action found"),
        fault(F.col("metadatas") == 0, "No metadata action found"),
    ))))
    # Faults of single actions stay row level, so a state of millions of files is no large array.
    add = F.col("action") == "add"
    row = F.array(
        fault(add & (F.coalesce("path", F.lit("")) == ""), "Add action missing path"),
        fault(add & (F.col("size") < 0), "Add action has negative size"),
        fault(F.col("action") == "remove", "Remove action found in checkpoint", "warning"),
    )
    return grouped.unionByName(states.select(by, F.inline(row)).where(F.col("severity").isNotNull()))


def state_against_snapshot(state: DataFrame, snapshot: DataFrame) -> DataFrame:
    """Differences of a saved state to the replayed one; ``modified`` is compared when both have it."""
    both_modified = "modified" in state.columns and "modified" in snapshot.columns
    s = state.select("path", F.col("size").alias("got_size"), F.lit(1).alias("got"),
                     *([F.col("modified").alias("got_modified")] if both_modified else []))
    x = snapshot.select("path", F.col("size").alias("want_size"), F.lit(1).alias("want"),
                        *([F.col("modified").alias("want_modified")] if both_modified else []))

    def issue(cond: Column, kind: str, text: str, severity: str) -> Column:
        return F.when(cond, F.struct(F.lit(kind).alias("type"), F.lit(text).alias("description"),
                                     F.lit(severity).alias("severity")))

    here = F.col("got").isNotNull() & F.col("want").isNotNull()
    issues = [
        issue(F.col("got").isNull(), "completeness", "Expected file missing from checkpoint", "error"),
        issue(F.col("want").isNull(), "consistency", "Unexpected file in checkpoint", "error"),
        issue(here & (F.col("got_size") != F.col("want_size")), "consistency", "File size mismatch", "error"),
    ]
    if both_modified:
        issues.append(issue(here & ~F.col("got_modified").eqNullSafe(F.col("want_modified")),
                            "consistency", "File modification time mismatch", "warning"))
    return s.join(x, "path", "full_outer").select("path", F.inline(F.array(*issues))).where(
        F.col("severity").isNotNull())


def dangling_files(active: DataFrame, stored: DataFrame) -> DataFrame:
    """Active files that storage does not hold; both sides by full path."""
    return active.join(stored.select("path").distinct(), "path", "left_anti").select(
        "path", F.lit("integrity").alias("type"), F.lit("error").alias("severity"))


def newest_valid_state(states: DataFrame, at_most: int) -> DataFrame:
    """Highest version up to ``at_most`` without a structural error, -1 when none."""
    within = states.where(F.col("version") <= at_most)
    bad = structure_issues(within).where(F.col("severity") == "error").select("version").distinct()
    good = within.select("version").distinct().join(bad, "version", "left_anti")
    return latest_version(good)


def beyond_newest(files: DataFrame, keys: Sequence[str], order: Sequence[str], keep: int) -> DataFrame:
    """Rows that fall outside the newest ``keep`` per key; ``order`` tells rows of a key apart.

    Only the oldest row to be kept matters: it is found by salted top-n, one
    row per key, and everything before it is returned. No key is ranked whole.
    """
    newest = newest_per_key(files, keys, [F.col(c).desc() for c in order], keep, spread_by=order)
    cut = newest.groupBy(*keys).agg(F.count("*").alias("__n"), F.min(F.struct(*order)).alias("__cut"))
    full = cut.where(F.col("__n") == keep).drop("__n")
    return null_safe_join(files, full, keys, "inner").where(F.struct(*order) < F.col("__cut")).drop("__cut")
