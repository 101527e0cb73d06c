"""Physical-plan shape: the properties that matter at scale."""

import os
import re

import pytest

from pyspark.sql import functions as F

from vigil.operators.exposure import exposure_check
from vigil.operators.layout import infer_layout
from vigil.operators.parse import parse_detected
from vigil.operators.protect import TEST_KEYS
from vigil.plans.parse_protect import protected_detected
from vigil.sinks.shards import layout_for_write, write_protected
from vigil.sources import fixtures
from vigil.sources.shards import read_protected
from vigil.sources.text_files import read_lines

from tests.conftest import SF_SMALL


def _plan(spark, df, mode="formatted"):
    m = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString(mode)
    return df._jdf.queryExecution().explainString(m)


def test_layout_limits_before_shuffle(spark):
    plan = _plan(spark, infer_layout(fixtures.raw_lines(spark, SF_SMALL)))
    tree = plan.split("\n\n")[0]
    # bottom-up: the partial group limit sits below (before) the exchange on source
    lines = tree.splitlines()
    partial = max(i for i, ln in enumerate(lines) if "WindowGroupLimit" in ln)
    exch = [i for i, ln in enumerate(lines) if "Exchange" in ln and i < partial]
    assert exch, tree
    assert "Partial" in plan and "row_number()" in plan


def test_text_scan_prunes_columns(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/in")
    with open(f"{tmp_dir}/in/a.txt", "w") as f:
        f.write("a@x.test:p\nb@x.test:q\n")
    lines = read_lines(spark, f"{tmp_dir}/in")
    plan = _plan(spark, parse_detected(lines, infer_layout(lines)))
    assert "ReadSchema: struct<value:string>" in plan


def test_accepted_lines_are_cut_once(spark):
    recs = protected_detected(fixtures.raw_lines(spark, SF_SMALL), TEST_KEYS)
    optimised = _plan(spark, recs, "extended").split("== Optimized Logical Plan ==")[1].split("== Physical Plan ==")[0]
    # the filter on the reject reason does not repeat the cutting of the line below the parse
    assert optimised.count("translate(") == 1


def test_stored_lines_are_numbered_once(spark):
    stored, derived = fixtures.stored_lines(spark, SF_SMALL), fixtures.raw_lines(spark, SF_SMALL)
    assert "Window" in _plan(spark, derived) and "Window" not in _plan(spark, stored)
    assert stored.columns == derived.columns
    assert stored.exceptAll(derived).isEmpty() and derived.exceptAll(stored).isEmpty()


def test_line_building_is_small_enough_to_be_compiled(spark):
    # the JVM interprets methods of more than 8,000 bytes
    plan = _plan(spark, fixtures.stored_lines(spark, SF_SMALL), "codegen")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", plan)]
    assert sizes and max(sizes) < 8000


def test_stored_lookup_pushes_filters(spark, tmp_dir):
    recs = protected_detected(fixtures.raw_lines(spark, SF_SMALL), TEST_KEYS)
    write_protected(recs, f"{tmp_dir}/shards")
    q = read_protected(spark, f"{tmp_dir}/shards").where((F.col("p2") == "ab") & (F.col("p4") == "abcd")).select("id_digest")
    plan = _plan(spark, q)
    assert "PartitionFilters: [isnotnull(p2" in plan and "(p2#" in plan
    assert "PushedFilters: [IsNotNull(p4), EqualTo(p4,abcd)]" in plan
    assert "ReadSchema: struct<id_digest:string,p4:string>" in plan or "ReadSchema: struct<id_digest:string>" in plan


def test_writer_rebalances_by_shard(spark):
    recs = protected_detected(fixtures.raw_lines(spark, SF_SMALL), TEST_KEYS)
    plan = _plan(spark, layout_for_write(recs), "extended")
    assert "RebalancePartitions [p2" in plan


def test_exposure_preaggregates_and_checks_size(spark):
    recs = protected_detected(fixtures.raw_lines(spark, SF_SMALL), TEST_KEYS)
    wl = recs.select("id_digest").distinct()
    small = _plan(spark, exposure_check(recs, wl))
    assert "BroadcastHashJoin" in small
    big = _plan(spark, exposure_check(recs, wl, max_broadcast_bytes=0), "extended")
    phys = big.split("== Physical Plan ==")[1]
    # shuffle path: per-(digest, source, scheme) partial aggregate feeds the exchange
    assert "partial_count" in phys
    assert "BroadcastHashJoin LeftSemi" not in phys


def test_codegen_stays_on(spark):
    recs = protected_detected(fixtures.raw_lines(spark, SF_SMALL), TEST_KEYS)
    plan = _plan(spark, recs, "codegen")
    assert "Found " in plan and "WholeStageCodegen subtrees" in plan


def _shuffle_records(spark, df):
    """Sum of records written by every shuffle exchange of an executed plan."""
    df.write.format("noop").mode("overwrite").save()
    plan = df._jdf.queryExecution().executedPlan()
    final = plan.finalPhysicalPlan() if plan.nodeName() == "AdaptiveSparkPlan" else plan
    total = 0
    nodes = [final]
    while nodes:
        node = nodes.pop()
        name = node.nodeName()
        if name in ("ShuffleQueryStage", "TableCacheQueryStage"):
            node = node.plan()
            name = node.nodeName()
        if name == "Exchange":
            metrics = node.metrics()
            if metrics.contains("shuffleRecordsWritten"):
                total += metrics.apply("shuffleRecordsWritten").value()
        children = node.children()
        for i in range(children.size()):
            nodes.append(children.apply(i))
    return total


def test_hot_file_shuffles_at_most_two_rows_per_task(spark):
    hot = spark.range(0, 54000).select(F.lit("hot").alias("source"), F.lit(0).cast("bigint").alias("block"),
                                       F.col("id").alias("seq"),
                                       F.concat(F.lit("u"), F.col("id").cast("string"), F.lit("@x.test:p")).alias("line"))
    cold = spark.range(0, 6000).select((F.col("id") % 10).cast("string").alias("source"),
                                       F.lit(0).cast("bigint").alias("block"), F.col("id").alias("seq"),
                                       F.lit("a@x.test;p").alias("line"))
    from vigil.operators.sizing import materialise

    lines = materialise(hot.unionByName(cold).repartition(8))  # 8 map tasks, no exchange of its own
    layout = infer_layout(lines)
    written = _shuffle_records(spark, layout)
    # at most 2 rows per file per map task (8 tasks, 11 files), not 60,000 lines
    assert 0 < written <= 2 * 11 * 8
    row = {r["source"]: r["status"] for r in layout.collect()}
    assert row["hot"] == "ok" and len(row) == 11


def test_hot_identifier_preaggregated_before_shuffle(spark):
    from vigil.operators.sizing import materialise

    hot_id = "ab" + "0" * 62
    recs = materialise(
        spark.range(0, 40000).select(
            F.when(F.col("id") < 36000, F.lit(hot_id))
            .otherwise(F.sha2(F.col("id").cast("string"), 256)).alias("id_digest"),
            F.sha2(F.concat(F.lit("s"), F.col("id").cast("string")), 256).alias("secret_digest"),
            F.lit(False).alias("is_hash"), F.lit("plaintext").alias("hash_type"),
            F.lit("/s/a.txt").alias("source"),
        ).withColumn("p2", F.substring("id_digest", 1, 2)).withColumn("p4", F.substring("id_digest", 1, 4))
        .repartition(8)
    )
    wl = spark.createDataFrame([(hot_id,)], "id_digest string")
    res = exposure_check(recs, wl, max_broadcast_bytes=0)  # force the shuffle path
    written = _shuffle_records(spark, res)
    # two exchanges of the pre-aggregated rows: 4,000 cold ids plus at most one
    # partial row per map task for the hot id; without map-side combine the
    # hot id alone would ship 36,000 rows
    assert written <= 2 * (4000 + 8) + 50
    row = res.head()
    assert row["n_records"] == 36000 and row["exposed"]


def test_no_line_is_shuffled_at_any_bound(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/in")
    for name, text in (("a", "a@x.test:p\nb@x.test:q\n"), ("b", "p;c@x.test\nq;d@x.test\n"), ("c", "one\n")):
        with open(f"{tmp_dir}/in/{name}.txt", "w") as f:
            f.write(text)
    lines = read_lines(spark, f"{tmp_dir}/in")
    layout = infer_layout(lines)
    rows = {}
    for bound in (1 << 26, 30, 0):
        parsed = parse_detected(lines, layout, max_broadcast_bytes=bound)
        tree = _plan(spark, parsed).split("\n\n")[0]
        assert "SortMergeJoin" not in tree and "ShuffledHashJoin" not in tree
        assert all("Broadcast" in ln for ln in tree.splitlines() if "Exchange" in ln), tree
        rows[bound] = sorted(map(str, parsed.collect()))
    assert rows[0] == rows[30] == rows[1 << 26]


def test_lines_without_a_layout_are_counted(spark):
    lines = spark.createDataFrame(
        [("a", 0, 1, "x@x.test:p"), ("a", 0, 2, "y@x.test:p"), ("late", 0, 1, "z@x.test:p"), ("late", 0, 2, " ")],
        "source string, block long, seq long, line string",
    )
    parsed = parse_detected(lines, infer_layout(lines.where("source = 'a'")), keep_blank=True)
    assert sorted((r["source"], r["scope"], r["reason"]) for r in parsed.collect() if r["source"] == "late") == [
        ("late", "file", "blank"), ("late", "file", "no_layout")
    ]


def test_dedupe_plans_without_sorting(spark):
    from vigil.operators.dedupe import dedupe, first_occurrence
    from vigil.operators.merge import merge_roots

    recs = protected_detected(fixtures.raw_lines(spark, SF_SMALL), TEST_KEYS, keep=["block", "seq"])
    flat = spark.createDataFrame([], recs.schema)
    for out in (dedupe(flat), first_occurrence(flat), first_occurrence(flat, ["seq"]), merge_roots([flat, flat])):
        plan = _plan(spark, out)
        assert "HashAggregate" in plan and "SortAggregate" not in plan and "\n+- Sort" not in plan


def test_stored_range_pushes_shard_keys(spark, tmp_dir):
    from vigil.operators.exposure import exposure_check, prefix_range

    recs = protected_detected(fixtures.raw_lines(spark, SF_SMALL), TEST_KEYS)
    write_protected(recs, f"{tmp_dir}/shards")
    stored = read_protected(spark, f"{tmp_dir}/shards")
    ids = [r[0] for r in stored.select("id_digest").distinct().limit(3).collect()]
    wl = spark.createDataFrame([(i, i[:4]) for i in ids], "id_digest string, prefix string")
    from vigil.operators.exposure import _scoped, measured_digests

    req, _, dirs = measured_digests(wl.selectExpr("prefix AS p4", "substr(prefix, 1, 2) AS p2").distinct(), 1 << 20)
    plan = _plan(spark, _scoped(stored, req, "p4", dirs))
    assert "PushedFilters: [In(p4" in plan or "EqualTo(p4" in plan
    assert prefix_range(stored, wl, k=2).count() >= 3
    plan = _plan(spark, exposure_check(stored, wl.select("id_digest")))
    assert "In(id_digest" in plan or "EqualTo(id_digest" in plan
    with pytest.raises(ValueError):
        prefix_range(stored, wl, k=1)


def test_hot_duplicate_key_collapses_before_shuffle(spark):
    from vigil.operators.dedupe import dedupe
    from vigil.operators.sizing import materialise

    hot = F.col("id") < 36000
    recs = materialise(
        spark.range(0, 40000).select(
            F.when(hot, F.lit("ab" + "0" * 62)).otherwise(F.sha2(F.col("id").cast("string"), 256)).alias("id_digest"),
            F.when(hot, F.lit("cd" + "0" * 62)).otherwise(F.lit("ef" + "0" * 62)).alias("secret_digest"),
            F.lit(False).alias("is_hash"), F.lit("plaintext").alias("hash_type"),
            F.lit("/s/a.txt").alias("source"),
        ).withColumn("p2", F.substring("id_digest", 1, 2)).withColumn("p4", F.substring("id_digest", 1, 4))
        .repartition(8)
    )
    out = dedupe(recs)
    written = _shuffle_records(spark, out)
    # 4,000 distinct cold keys plus at most one partial row per map task for the hot key
    assert written <= 4000 + 8
    assert out.count() == 4001
