"""Dedupe, insert-if-absent, merge, exposure and audits on protected records."""

from pyspark.sql import functions as F

from vigil.operators import audit, exposure
from vigil.operators.dedupe import dedupe, first_occurrence, insert_if_absent
from vigil.operators.merge import merge_roots, union_roots
from vigil.operators.numbering import number_within
from vigil.operators.protect import RECORD_KEY, TEST_KEYS
from vigil.plans.parse_protect import protected_detected
from vigil.sources import fixtures

from tests.conftest import SF_SMALL


def _recs(spark):
    return protected_detected(fixtures.raw_lines(spark, SF_SMALL), TEST_KEYS, keep=["seq"])


def _rows(df, cols=RECORD_KEY):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_dedupe_idempotent(spark):
    recs = _recs(spark).drop("seq")
    once = dedupe(recs)
    assert _rows(dedupe(once)) == _rows(once)
    assert once.count() == recs.select(*RECORD_KEY).distinct().count()


def test_first_occurrence_keeps_earliest(spark):
    recs = _recs(spark)
    first = first_occurrence(recs, order=["seq"])
    expect = recs.groupBy(*RECORD_KEY).agg(F.min("seq").alias("seq"), F.count(F.lit(1)).alias("copies"))
    assert _rows(first, RECORD_KEY + ["seq", "copies"]) == _rows(expect, RECORD_KEY + ["seq", "copies"])


def test_insert_into_a_target_with_a_hot_key(spark):
    """What the probe finds is made distinct: repeats in the target do not grow it."""
    recs = _recs(spark).drop("seq")
    hot = recs.limit(1)
    target = hot.crossJoin(spark.range(5000)).drop("id").unionByName(recs.sample(fraction=0.3, seed=5))
    new = insert_if_absent(recs, target)
    assert _rows(union_roots([new, target]).dropDuplicates(RECORD_KEY)) == _rows(dedupe(recs))
    plan = new._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))
    assert "LeftSemi" in plan and "LeftAnti" in plan and "HashAggregate(keys=[id_digest" in plan
    # keys with nulls match too
    odd = recs.withColumn("source", F.lit(None).cast("string"))
    assert insert_if_absent(odd, odd).count() == 0
    assert insert_if_absent(odd, odd, max_broadcast_bytes=0).count() == 0


def test_insert_if_absent(spark):
    recs = _recs(spark).drop("seq")
    target = recs.sample(fraction=0.5, seed=3)
    new = insert_if_absent(recs, target)
    assert new.join(target, RECORD_KEY, "inner").count() == 0
    assert new.select(*RECORD_KEY).distinct().count() == new.count()
    assert _rows(union_roots([new, target]).dropDuplicates(RECORD_KEY)) == _rows(dedupe(recs))
    # replaying the same batch against the grown target inserts nothing
    assert insert_if_absent(recs, union_roots([new, target])).count() == 0
    # bulk path (no broadcast) gives the same rows
    assert _rows(insert_if_absent(recs, target, max_broadcast_bytes=0)) == _rows(new)


def test_merge_order_independent(spark):
    recs = _recs(spark)
    a, b = recs.where(F.col("seq") % 3 != 0).drop("seq"), recs.where(F.col("seq") % 3 != 1).drop("seq")
    cols = RECORD_KEY + ["copies"]
    assert _rows(merge_roots([a, b]), cols) == _rows(merge_roots([b, a]), cols)
    assert merge_roots([a, b]).agg(F.sum("copies")).head()[0] == a.count() + b.count()


def test_p4_prefixes_digest(spark):
    recs = _recs(spark)
    assert recs.where(~F.col("id_digest").startswith(F.col("p4")) | (F.substring("p4", 1, 2) != F.col("p2"))).count() == 0


def test_constraint_audit_detects(spark):
    recs = _recs(spark).drop("seq")
    broken = recs.limit(5).withColumn("p2", F.lit("zz")).withColumn("id_digest", F.lit("nothex"))
    row = audit.constraint_audit(union_roots([recs, recs, broken])).head()
    assert row["n_dup_keys"] > 0 and row["n_bad_id_digest"] >= 1 and row["n_bad_shard"] >= 1
    clean = audit.constraint_audit(recs).head()
    assert clean["n_bad_id_digest"] == 0 and clean["n_bad_shard"] == 0 and clean["n_null_rows"] == 0


def test_exposure_and_prefix(spark):
    recs = _recs(spark).drop("seq")
    some = recs.select("id_digest").distinct().limit(3)
    unknown = spark.createDataFrame([("f" * 64,)], "id_digest string")
    res = {r["id_digest"]: r for r in exposure.exposure_check(recs, some.unionByName(unknown)).collect()}
    assert not res["f" * 64]["exposed"] and res["f" * 64]["n_records"] == 0
    assert sum(r["exposed"] for r in res.values()) == 3
    pr = exposure.prefix_range(recs, some.select(F.substring("id_digest", 1, 4).alias("prefix")), k=10**6)
    assert pr.where(~F.col("suppressed")).count() == 0


def test_run_grades_boundaries(spark):
    m = spark.createDataFrame(
        [("a", 1000000, 0, 60000 * 20), ("b", 1000000, 0, 60000 * 30), ("c", 1000000, 0, 60000 * 35),
         ("d", 1000000, 0, 60000 * 42), ("e", 1000000, 0, 60000 * 46), ("f", 0, 0, 5)],
        "source string, loaded long, rejected long, elapsed_ms long")
    got = {r["source"]: (r["min_per_million"], r["grade"], r["alert"]) for r in audit.run_grades(m).collect()}
    assert got == {"a": (20.0, "good", False), "b": (30.0, "good", False), "c": (35.0, "acceptable", False),
                   "d": (42.0, "poor", False), "e": (46.0, "poor", True), "f": (0.0, "good", False)}


def test_number_within_matches_row_number(spark):
    from pyspark.sql import Window

    df = spark.range(0, 5000).select((F.col("id") % 7).alias("g"), ((F.col("id") * 7919) % 100003).alias("k"))
    got = number_within(df, ["g"], "k", out="n", ranges=6)
    ref = df.withColumn("n", F.row_number().over(Window.partitionBy("g").orderBy("k")))
    assert _rows(got, ["g", "k", "n"]) == _rows(ref, ["g", "k", "n"])


def test_surrogate_ids_dense(spark):
    from vigil.operators.numbering import surrogate_ids

    df = spark.range(0, 3000).select(((F.col("id") * 7919) % 100003).alias("k"))
    got = sorted((r["k"], r["id"]) for r in surrogate_ids(df, "k").collect())
    assert [i for _, i in got] == list(range(1, 3001))
    assert [k for k, _ in got] == sorted(k for k, _ in got)


import hashlib as _hashlib
import hmac as _hmac

from hypothesis import given, settings
from hypothesis import strategies as st

from tests.test_functions import _scheme
from vigil.functions.text import normalise_identifier


_fc_line = st.one_of(
    st.text(alphabet="aB+@.:- \"x", max_size=16),
    st.builds(lambda u, p: f"{u}:{p}", st.sampled_from(["Bob+x@Ex.test", " --a@b.c ", "@x", "u"]),
              st.sampled_from(["pw", "", ":", "a" * 32, "$1$s$abc", " {SHA}ab= "])),
)


@settings(max_examples=25, deadline=None)
@given(st.lists(_fc_line, min_size=1, max_size=25))
def test_first_colon_records(spark, lines):
    """Accepted lines are those with a character before their first colon and an
    ``@`` there; digests are stdlib HMACs of the normalised identifier and of
    everything after that colon."""
    from vigil.operators.parse import parse_first_colon
    from vigil.operators.protect import protect

    df = spark.createDataFrame([("s", 0, i, ln) for i, ln in enumerate(lines)],
                               "source string, block bigint, seq bigint, line string")
    got = {r["seq"]: (r["id_digest"], r["secret_digest"], r["hash_type"])
           for r in protect(parse_first_colon(df), TEST_KEYS, keep=["seq"]).collect()}
    cut = {i: ln.partition(":") for i, ln in enumerate(lines)}
    assert set(got) == {i for i, (ident, colon, _) in cut.items() if colon and "@" in ident}

    def digest(key, text):
        return _hmac.new(key.material, text.encode(), _hashlib.sha256).hexdigest()

    idents = spark.createDataFrame([(i, c[0]) for i, c in cut.items()], "i bigint, v string")
    normal = dict(idents.select("i", normalise_identifier(F.col("v"))).collect())
    for i, found in got.items():
        secret = cut[i][2]
        assert found == (digest(TEST_KEYS.identifier, normal[i]), digest(TEST_KEYS.secret, secret), _scheme(secret))


def test_record_key_is_not_an_ambiguous_string(spark):
    """password "a:b" from source "c" and password "a" from source "b:c" would
    share the joined key "h:a:b:c"; as a column triple they stay distinct."""
    from vigil.operators.parse import parse_first_colon
    from vigil.operators.protect import protect

    lines = spark.createDataFrame(
        [("c", 0, 0, "u@x.test:a:b"), ("b:c", 0, 0, "u@x.test:a"), ("c", 0, 1, "u@x.test:a:b")],
        "source string, block bigint, seq bigint, line string")
    recs = protect(parse_first_colon(lines), TEST_KEYS)
    assert recs.count() == 3 and dedupe(recs).count() == 2
