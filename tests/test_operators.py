from datetime import date
from itertools import product

import pytest
from pyspark.sql import functions as F

from martlane.functions.masks import mask_name
from martlane.operators import checks, policies
from martlane.operators.aggregates import any_match, pivot_sums, top_k, value_counts
from martlane.operators.flatten import flatten, object_size
from martlane.operators.joins import Side, hot_keys, star_join
from martlane.operators.latest import latest_per_key
from martlane.operators.unions import align_union
from martlane.sources.schemas import TableChecks


def test_latest_puts_missing_times_first_and_breaks_ties_by_id(spark, rows):
    df = spark.createDataFrame(
        [
            ("a", 1, "2026-01-01", 10.0),
            ("a", 2, "2026-01-03", 20.0),
            ("a", 3, "2026-01-03", 30.0),
            ("b", 4, "2026-01-09", 40.0),
            ("b", 5, None, None),
            (None, 6, "2026-01-01", 60.0),
        ],
        "k string, id int, t string, v double",
    ).withColumn("t", F.col("t").cast("timestamp_ntz"))
    out = latest_per_key(df, ["k"], "t", {"id": "id", "v": "last_v"}, ["id"], "n")
    assert rows(out) == [(None, 6, 60.0, 1), ("a", 3, 30.0, 3), ("b", 5, None, 2)]


def test_latest_needs_one_shuffle_with_partial_results(spark):
    df = spark.range(100).selectExpr("id % 3 AS k", "id AS t")
    plan = latest_per_key(df, ["k"], "t", {"t": "t"})._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "partial_max" in plan


def _skewed(spark):
    """Keys 1 and 2 are heavy in different tables; 3 misses a side; NULL has no partner."""
    base = [(k, f"b{k}") for k in (1, 2, 3, 4)] + [(None, "loose")]
    left = [(1, f"l{i}") for i in range(40)] + [(2, "l2"), (4, "l4"), (None, "lost")]
    right = [(2, f"r{i}") for i in range(50)] + [(1, "r1"), (1, "r1b"), (3, "r3")]
    return (
        spark.createDataFrame(base, "k int, b string"),
        spark.createDataFrame(left, "k int, l string"),
        spark.createDataFrame(right, "k int, r string"),
    )


@pytest.mark.parametrize("hot_rows,share", [(1, 4), (2, 50), (10**6, 10)])
@pytest.mark.parametrize("keep", list(product([True, False], repeat=2)))
def test_star_join_equals_plain_joins(spark, rows, hot_rows, share, keep):
    base, left, right = _skewed(spark)
    sides = [Side(left, ["l"], keep[0]), Side(right, ["r"], keep[1])]
    out = star_join(base, "k", sides, ["b"], hot_rows=hot_rows, share=share)
    plain = base.join(left, "k", "left" if keep[0] else "inner")
    plain = plain.join(right, "k", "left" if keep[1] else "inner")
    assert rows(out, "k", "b", "l", "r") == rows(plain, "k", "b", "l", "r")


@pytest.mark.parametrize("hot_rows", [1, 2])
def test_counted_frames_never_change_the_result(spark, rows, hot_rows):
    """They may name keys that the joined table lacks, or lack keys that it has."""
    base = spark.createDataFrame([(0, "a"), (1, "b"), (2, "c"), (None, "d")], "k int, b string")
    side = spark.createDataFrame([(1, "x"), (1, "y"), (3, "z")], "k int, l string")
    plain = rows(base.join(side, "k", "left"), "k", "b", "l")
    for keys in ([0] * 9, [0, 0, 1, 2, 2], [3] * 4, [1] * 7, []):
        counted = spark.createDataFrame([(k,) for k in keys], "k int")
        out = star_join(base, "k", [Side(side, ["l"], counted=counted)], ["b"], hot_rows=hot_rows, share=4)
        assert rows(out, "k", "b", "l") == plain


@pytest.mark.parametrize("hot_rows", [1, 10**6])
def test_star_join_cuts_a_hot_base(spark, rows, hot_rows):
    base, left, right = _skewed(spark)
    many = left.unionByName(left.withColumn("l", F.concat("l", F.lit("x"))))
    out = star_join(many, "k", [Side(base, unique=True)], ["l"], counted=left, hot_rows=hot_rows, share=4)
    assert rows(out, "k", "l", "b") == rows(many.join(base, "k", "left"), "k", "l", "b")


def test_star_join_refuses_when_there_is_nothing_to_balance(spark):
    base, left, _ = _skewed(spark)
    with pytest.raises(ValueError):
        star_join(base, "k", [Side(left, unique=True)], ["b"])


def test_hot_keys_name_the_heaviest_table_and_pieces(spark, rows):
    base, left, right = _skewed(spark)
    hot = hot_keys({1: left, 2: right}, "k", hot_rows=1, share=4)
    assert rows(hot) == [(1, 1, 4), (2, 2, 4)]
    assert hot_keys({1: left, 2: right}, "k").count() == 0


def test_hot_key_is_spread_over_pieces(spark):
    """No task of the join may hold a large part of the hot key's rows."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        base = spark.range(8).selectExpr("CAST(id AS INT) AS k")
        facts = spark.range(8000).selectExpr("IF(id < 4000, 0, CAST(id % 8 AS INT)) AS k", "id")
        out = star_join(base, "k", [Side(facts, ["id"])], ["k"], hot_rows=100, share=40)
        per_task = out.groupBy(F.spark_partition_id().alias("p")).count().collect()
        plain = base.join(facts, "k", "left").groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(r["count"] for r in per_task) == 8000
    assert max(r["count"] for r in plain) >= 4500
    assert max(r["count"] for r in per_task) < 4000


def test_pivot_and_any(spark, rows):
    df = spark.createDataFrame([(1, "A", 5), (1, "B", 2), (1, "A", None), (2, "C", 1)], "k int, t string, v int")
    out = df.groupBy("k").agg(*pivot_sums("t", "v", {"A": "a", "B": "b"}), any_match(F.col("t") == "B"))
    assert rows(out) == [(1, 5, 2, 1), (2, 0, 0, 0)]


def test_value_counts_leave_out_null(spark):
    df = spark.createDataFrame([("x",), ("y",), ("x",), (None,)], "c string")
    assert [tuple(r) for r in value_counts(df, "c").collect()] == [("x", 2), ("y", 1)]


def test_top_k_does_not_sort_everything(spark):
    df = top_k(spark.range(100), [F.desc("id")], 3)
    assert [r.id for r in df.collect()] == [99, 98, 97]
    assert "TakeOrderedAndProject" in df._jdf.queryExecution().executedPlan().toString()


def test_align_union_keeps_rows_and_types(spark, rows):
    a = spark.createDataFrame([(1, 2.5, "x")], "i int, d double, s string")
    out = align_union(a, a.select("s", "i"), columns=["s", "d", "i"])
    assert rows(out) == [("x", None, 1), ("x", 2.5, 1)]
    assert [f.dataType.simpleString() for f in out.schema] == ["string", "double", "int"]


PAYLOADS = [
    '{"items":[{"a":{"b":[7,8]},"n":null,"o":{"x":1,"y":2}},{"a":{}}]}',
    '{"items":[]}',
    '{"items":5}',
    "{}",
    "3",
    '"text"',
]


def test_flatten_drops_what_is_no_array(spark, rows):
    raw = spark.createDataFrame([(p,) for p in PAYLOADS], "v string").select(F.parse_json("v").alias("RAW"))
    fields = {"first": ("$.a.b[0]", "int"), "n": ("$.n", "string")}
    out = flatten(raw, "$.items", fields, extra={"keys": object_size("item", "$.o")})
    assert rows(out) == [(None, None, None), (7, None, 2)]


def test_flatten_strict_and_lenient(spark):
    raw = spark.sql("""SELECT parse_json('{"items":[{"a":"no number"}]}') AS RAW""")
    fields = {"a": ("$.a", "int")}
    assert flatten(raw, "$.items", fields, strict=False).first()["a"] is None
    with pytest.raises(Exception, match="INVALID_VARIANT_CAST|cannot be cast"):
        flatten(raw, "$.items", fields).collect()


FLAGS = "id int, flag boolean, class string, owner string"
FLAG_ROWS = [
    (1, True, "FINMA_RESTRICTED", "A"),
    (2, False, "PUBLIC", "B"),
    (3, None, None, None),
]


@pytest.mark.parametrize(
    "rule,column,role,seen",
    [
        (policies.rows_pii, "flag", "VISITOR", [2]),
        (policies.rows_pii, "flag", "ACCOUNTADMIN", [1, 2, 3]),
        (policies.rows_financial, "class", "VISITOR", [2]),
        (policies.rows_financial, "class", "DP_TRANSACTIONS_READER", [1, 2, 3]),
        (policies.rows_customs, "flag", "VISITOR", [2]),
        (policies.rows_customs, "flag", "DP_SHIPMENTS_OWNER", [1, 2, 3]),
        (policies.rows_merchant, "owner", "B", [2]),
        (policies.rows_merchant, "owner", "DP_MERCHANTS_OWNER", [1, 2, 3]),
        (policies.rows_merchant, "owner", "VISITOR", []),
    ],
)
def test_row_filters(spark, rule, column, role, seen):
    df = spark.createDataFrame(FLAG_ROWS, FLAGS)
    assert sorted(r.id for r in df.filter(rule(column, role)).collect()) == seen


def test_apply_policies_filters_on_true_values(spark, rows):
    df = spark.createDataFrame(FLAG_ROWS, FLAGS)
    out = policies.apply_policies(df, "B", {"owner": mask_name}, {"owner": policies.rows_merchant})
    assert rows(out) == [(2, False, "PUBLIC", "***")]
    assert out.columns == df.columns


def test_tags(spark):
    df = spark.createDataFrame([(date(2026, 1, 1),), (date(2025, 1, 1),)], "d date")
    tagged = policies.tag_column(df, "d", PII_LEVEL="LOW", RETENTION_DAYS="30")
    assert policies.column_tags(tagged, "d") == {"PII_LEVEL": "LOW", "RETENTION_DAYS": "30"}
    assert policies.within_retention(tagged, "d", date(2026, 1, 20)).count() == 1
    assert policies.within_retention(df, "d", date(2026, 1, 20)).count() == 2
    with pytest.raises(ValueError):
        policies.tag_column(df, "d", PII_LEVEL="EXTREME")
    with pytest.raises(ValueError):
        policies.tag_column(df, "d", COLOUR="RED")


def test_checks_and_report(spark, rows):
    child = spark.createDataFrame(
        [(1, "p", "A"), (1, "q", "B"), (2, "q", None), (None, None, "C"), (3, "p", "A")],
        "id int, parent string, kind string",
    )
    parent = spark.createDataFrame([("p",), ("p",)], "parent string")
    assert checks.not_null(child, "id").count() == 1
    assert rows(checks.unique(child, "id")) == [(1, 2)]
    assert checks.accepted_values(child, "kind", ["A", "B"]).count() == 1
    assert checks.relationships(child, "parent", parent, "parent").count() == 2
    assert rows(checks.orphan_counts(child, "parent", parent, "parent")) == [("q", 2)]
    spec = TableChecks(
        key=("id",), required=("parent",), accepted={"kind": ("A", "B")}, refs={"parent": ("up", "parent")}
    )
    report = checks.run_checks(child, "t", spec, {"up": parent}.get)
    assert rows(report, "check_name", "column_name", "failures") == [
        ("accepted_values", "kind", 1),
        ("not_null", "id", 1),
        ("not_null", "parent", 1),
        ("relationships", "parent", 2),
        ("unique", "id", 1),
    ]
