from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from billweave.functions.keys import export_name, parse_export_name
from billweave.functions.names import RESERVED_WORDS, normalize_name, normalize_names
from billweave.functions.periods import check_period, in_range, is_valid_period, manifest_period, period_end, period_start
from billweave.functions.types import checked_cast, spark_type, table_type_name
from billweave.operators.columns import column_defs, new_columns, schema_summary, table_schema, unified_schema, unique_names

FIXTURE = [
    ("identity", "LineItemId", "String", "identity_line_item_id", "VARCHAR"),
    ("bill", "BillingPeriodStartDate", "DateTime", "bill_billing_period_start_date", "TIMESTAMP"),
    ("lineItem", "UnblendedCost", "BigDecimal", "line_item_unblended_cost", "DECIMAL(18,2)"),
    ("identity", "TimeInterval", "Interval", "identity_time_interval", "VARCHAR"),
    ("product", "ECU", "OptionalString", "product_ecu", "VARCHAR"),
    ("resourceTags", "user:Environment", "BigDecimal", "resource_tags_user_environment", "VARCHAR"),
    ("resourceTags", "user:environment", "String", "resource_tags_user_environment_1", "VARCHAR"),
    ("resourceTags", "aws:autoscaling:groupName", "String", "resource_tags_aws_autoscaling_group_name", "VARCHAR"),
    ("lineItem", "IPv4Address", "Mystery", "line_item_ipv4_address", "VARCHAR"),
    ("", "", "String", "unknown_column", "VARCHAR"),
    ("", "group", "String", "group_col", "VARCHAR"),
    ("", "2factor", "String", "col_2factor", "VARCHAR"),
]
COLUMNS = "array<struct<category: string, name: string, type: string>>"


def manifests(spark, *deliveries):
    """``(period, execution, [(category, name, type), ...])`` as manifests."""
    return spark.createDataFrame(list(deliveries), f"billing_period string, execution_id string, columns {COLUMNS}")


@pytest.mark.parametrize(
    ("original", "expected"),
    [
        ("aws:autoscaling:groupName", "aws_autoscaling_group_name"),
        ("user:kubernetes.io/created-for/pv/name", "user_kubernetes_io_created_for_pv_name"),
        ("LineItemId", "line_item_id"),
        ("group", "group_col"),
        ("__a  b__", "a_b"),
        ("9", "col_9"),
        ("::", "unknown_column"),
        ("End", "end_col"),
    ],
)
def test_normalize_examples(spark, original, expected):
    assert spark.range(1).select(normalize_name(F.lit(original))).first()[0] == expected


def test_reserved_words_are_distinct_and_all_suffixed(spark):
    assert len(RESERVED_WORDS) == len(set(RESERVED_WORDS)) == 68
    frame = spark.createDataFrame([(w,) for w in RESERVED_WORDS], "w string")
    assert frame.where(normalize_name(F.col("w")) != F.concat("w", F.lit("_col"))).count() == 0


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(max_size=12).filter(lambda t: "\x00" not in t and t.isprintable()), min_size=1, max_size=25))
def test_array_form_equals_scalar_form(spark, texts):
    frame = spark.createDataFrame([(texts,)], "a array<string>")
    array = frame.select(normalize_names(F.col("a"))).first()[0]
    scalar = frame.select(F.posexplode("a").alias("i", "t")).select("i", normalize_name(F.col("t"))).collect()
    assert array == [r[1] for r in sorted(scalar)]
    assert all(n and n[0] not in "_0123456789" and n not in RESERVED_WORDS for n in array)


def test_fixture_columns(spark):
    given_columns = [row[:3] for row in FIXTURE]
    defs = column_defs(manifests(spark, ("2024-01", "e", given_columns))).orderBy("pos").collect()
    assert [(d.category, d.original_name.split("/", 1)[1], d.source_type, d.normalized_name, d.table_type) for d in defs] == FIXTURE


@pytest.mark.parametrize(
    ("bases", "expected"),
    [
        (["a", "a", "a", "b"], ["a", "a_1", "a_2", "b"]),
        (["x_a", "x_a", "x_a_1"], ["x_a", "x_a_1", "x_a_1_1"]),
        (["x_a_1", "x_a", "x_a"], ["x_a_1", "x_a", "x_a_2"]),
        (["a_1", "a_2", "a", "a", "a"], ["a_1", "a_2", "a", "a_3", "a_4"]),
        ([], []),
    ],
)
def test_suffixes(spark, bases, expected):
    frame = spark.createDataFrame([(bases,)], "b array<string>")
    assert frame.select(unique_names(F.col("b"))).first()[0] == expected


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.sampled_from(["a", "a_1", "a_2", "a_1_1", "b"]), max_size=9))
def test_suffixed_names_are_unique(spark, bases):
    frame = spark.createDataFrame([(bases,)], "b array<string>")
    names = frame.select(unique_names(F.col("b"))).first()[0]
    assert len(set(names)) == len(bases)
    assert all(name.startswith(base) for name, base in zip(names, bases))


def test_cost_scale_and_text_categories(spark):
    frame = manifests(spark, ("2024-01", "e", [("lineItem", "Cost", "BigDecimal"), ("costCategory", "Rate", "BigDecimal")]))
    defs = column_defs(frame, cost_scale=9, text_categories=["costCategory"]).orderBy("pos").collect()
    assert [d.table_type for d in defs] == ["DECIMAL(18,9)", "VARCHAR"]


def test_types_round_trip():
    for name in ("VARCHAR", "TIMESTAMP", "DECIMAL(18,2)"):
        assert table_type_name(spark_type(name)) == name


def test_checked_cast_raises_without_ansi(spark):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        frame = spark.createDataFrame([("1.005",), (None,)], "v string")
        cast = checked_cast(F.col("v"), T.DecimalType(18, 2))
        assert [str(r[0]) for r in frame.select(cast).collect()] == ["1.01", "None"]
        with pytest.raises(Exception, match="not a decimal"):
            spark.createDataFrame([("x",)], "v string").select(cast).collect()
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_unified_schema_takes_newest_then_first(spark):
    frame = manifests(
        spark,
        ("2024-01", "e1", [("a", "X", "String"), ("a", "Old", "String")]),
        ("2024-02", "e2", [("a", "New", "DateTime"), ("a", "X", "BigDecimal")]),
    )
    found = {r.normalized_name: (r.table_type, r.rank_period, r.rank_pos) for r in unified_schema(column_defs(frame)).collect()}
    assert found == {
        "a_x": ("DECIMAL(18,2)", "2024-02", 1),
        "a_new": ("TIMESTAMP", "2024-02", 0),
        "a_old": ("VARCHAR", "2024-01", 1),
    }


def test_new_columns_and_summary(spark):
    old = column_defs(manifests(spark, ("2024-01", "e", [("a", "X", "String")])))
    new = column_defs(manifests(spark, ("2024-02", "f", [("a", "X", "String"), ("b", "Y", "DateTime")])))
    assert [r.normalized_name for r in new_columns(new, old).collect()] == ["b_y"]
    assert [tuple(r) for r in schema_summary(new).collect()] == [
        ("category", "a", 1), ("category", "b", 1), ("total", "", 2), ("type", "TIMESTAMP", 1), ("type", "VARCHAR", 1),
    ]


def test_table_schema_carries_originals(spark):
    defs = column_defs(manifests(spark, ("2024-01", "e", [("a", "X", "String")]))).collect()
    schema = table_schema(defs)
    assert schema.names == ["execution_id", "a_x"]
    assert schema["a_x"].metadata["original_name"] == "a/X"


@pytest.mark.parametrize(
    ("start", "expected"),
    [
        ("20250901T000000.000Z", "2025-09"),
        ("2025-09-01", "2025-09"),
        ("2025-09-01T00:00:00Z", "2025-09"),
        ("", "unknown"),
        (None, "unknown"),
    ],
)
def test_manifest_period(spark, start, expected):
    assert spark.range(1).select(manifest_period(F.lit(start).cast("string"))).first()[0] == expected


def test_periods(spark):
    check_period("2024-12")
    for bad in ("2024-13", "2024-1", "2024-01-01", "x"):
        with pytest.raises(ValueError):
            check_period(bad)
    frame = spark.createDataFrame([("2024-12",), ("2024-00",), ("unknown",)], "p string")
    assert [r[0] for r in frame.select(is_valid_period(F.col("p"))).collect()] == [True, False, False]
    bounds = frame.where("p = '2024-12'").select(period_start(F.col("p")).cast("string"), period_end(F.col("p")).cast("string")).first()
    assert tuple(bounds) == ("2024-12-01 00:00:00", "2025-01-01 00:00:00")
    months = spark.createDataFrame([(f"2024-{m:02}",) for m in range(1, 7)], "p string")
    assert months.where(in_range(F.col("p"), "2024-02", "2024-04")).count() == 3
    assert months.where(in_range(F.col("p"), end="2024-02")).count() == 2
    assert months.where(in_range(F.col("p"))).count() == 6


def test_export_names(spark):
    p, e = F.lit("2024-01"), F.lit("run_7")
    row = spark.range(1).select(export_name(p), export_name(p, execution=e), export_name(p, "azure")).first()
    assert list(row) == ["2024-01_aws_billing.parquet", "2024-01_run_7_aws_billing.parquet", "2024-01_azure_billing.parquet"]
    frame = spark.createDataFrame([(n,) for n in [*row, "other.parquet"]], "n string")
    parsed = [r[0] and tuple(r[0]) for r in frame.select(parse_export_name(F.col("n"))).collect()]
    assert parsed == [("2024-01", None), ("2024-01", "run_7"), None, None]
