from __future__ import annotations

import pytest

from billweave.operators.completeness import delivery_completeness, extract_stats
from billweave.sources.listing import available_periods, flat_exports, list_files, staged_parts
from billweave.sources.manifests import manifest_columns, manifest_files, manifest_pattern, manifest_summary, scan_manifests
from cloud_store import Cloud, rows


def scan(cloud):
    return scan_manifests(cloud.spark, cloud.folder("store"), cloud.prefix, cloud.export, cloud.version)


@pytest.mark.parametrize("version", ["v1", "v2"])
def test_scan_keeps_the_layout_only(spark, tmp_path, version):
    cloud = Cloud(spark, tmp_path, version=version)
    cloud.manifest("2024-01", "run-1", ["a.csv.gz"])
    cloud.manifest("2024-02", "run-2", ["a.csv.gz", "b.csv.gz"])
    # Look-alikes: too deep, another export below the prefix, a dot that is any character.
    cloud.manifest("2024-03", "x", folder="archive/20240301-20240401")
    cloud.manifest("2024-03", "x", folder="20240301-2024040/deeper")
    Cloud(spark, tmp_path, export="dailyXusage", version=version).manifest("2024-03", "x")
    nested = Cloud(spark, tmp_path, prefix=f"bills/main/daily.usage/old/bills/main", version=version)
    nested.manifest("2024-03", "x")
    good, rejects = scan(cloud)
    assert rows(good, "billing_period", "execution_id", "version") == [
        ("2024-01", "run-1", version), ("2024-02", "run-2", version)
    ]
    assert rejects.count() == 0
    summary = manifest_summary(good).collect()
    assert [(r.billing_period, r.file_count) for r in summary] == [("2024-02", 2), ("2024-01", 1)]


def test_id_field_depends_on_version(spark, tmp_path):
    for version, name in (("v1", "assembly"), ("v2", "execution")):
        cloud = Cloud(spark, tmp_path / version, version=version)
        cloud.manifest("2024-01", "", assemblyId="assembly", executionId="execution")
        assert scan(cloud)[0].first().execution_id == name


def test_unknown_version():
    with pytest.raises(ValueError, match="v3"):
        manifest_pattern("/s", "p", "e", "v3")


def test_bad_manifests_become_rejects(cloud):
    cloud.manifest("2024-01", "ok")
    cloud.manifest("2024-02", "x", text='{"executionId": "cut')
    cloud.manifest("2024-03", "x", billingPeriod=None)
    cloud.manifest("2024-04", "x", executionId=None)
    cloud.manifest("2024-05", "x", reportKeys="not a list")
    cloud.manifest("2024-06", "x", billingPeriod={"start": "2024-13-01"})
    good, rejects = scan(cloud)
    assert rows(good, "execution_id") == [("ok",)]
    reasons = {p.split("BILLING_PERIOD=")[1][:7]: r for p, r in rows(rejects, "manifest_path", "reason")}
    assert reasons == {
        "2024-02": "bad JSON", "2024-03": "no billing month", "2024-04": "no delivery id", "2024-05": "bad JSON",
        "2024-06": "no billing month",
    }


def test_missing_fields_get_defaults(cloud):
    cloud.manifest("2024-01", "e", reportKeys=None, columns=None, compression=None, billingPeriod={"start": "2024-01-01"})
    good, _ = scan(cloud)
    row = good.first()
    assert (row.billing_period, row.files, row.columns, row.compression) == ("2024-01", [], [], "GZIP")
    assert rows(manifest_files(good), "file_key") == [(None,)]
    assert manifest_columns(good).count() == 0


def test_empty_store(cloud):
    good, rejects = scan(cloud)
    assert good.count() == rejects.count() == 0


def test_columns_keep_their_order(cloud):
    cloud.manifest("2024-01", "e", columns=[("b", "Z", "String"), ("a", "Y", "DateTime")])
    found = manifest_columns(scan(cloud)[0]).orderBy("pos").collect()
    assert [(r.pos, r.original_name, r.source_type) for r in found] == [(0, "b/Z", "String"), (1, "a/Y", "DateTime")]


def test_staged_listing_and_completeness(spark, cloud):
    cloud.part("2024-01", "e1", "a.csv", "x\n")
    cloud.part("2024-01", "e1", "b.csv.gz", "x\n")
    cloud.part("2024-01", "e1", "notes.txt", "x\n")
    cloud.part("2024-02", "e2", "a.csv", "x\n")
    cloud.manifest("2024-01", "e1", ["a.csv", "b.csv.gz"])
    cloud.manifest("2024-02", "e2", ["a.csv", "missing.csv"])
    cloud.manifest("2024-03", "e3", [])
    parts = staged_parts(spark, cloud.folder("staging"))
    assert rows(parts, "billing_period", "execution_id", "file_name") == [
        ("2024-01", "e1", "a.csv"), ("2024-01", "e1", "b.csv.gz"), ("2024-02", "e2", "a.csv")
    ]
    done = delivery_completeness(manifest_files(scan(cloud)[0]), parts)
    assert rows(done, "execution_id", "expected_files", "present_files", "complete") == [
        ("e1", 2, 2, True), ("e2", 2, 1, False), ("e3", 0, 0, False)
    ]
    assert tuple(extract_stats(done).first()) == (3, 3, 2)


def test_escaped_folder_names_are_read_back(spark, cloud):
    frame = spark.createDataFrame([("2024-01", "2024-01-02T03:04+00 x", "v")], "p string, e string, v string")
    frame.write.partitionBy("p", "e").csv(cloud.folder("staging"))
    assert rows(staged_parts(spark, cloud.folder("staging")), "execution_id") == [("2024-01-02T03:04+00 x",)]


def test_flat_exports(spark, tmp_path):
    for name in ("2024-01_aws_billing.parquet", "2024-02_e_1_aws_billing.parquet", "2024-03_azure_billing.parquet", "x.parquet"):
        (tmp_path / name).write_text("x")
    files = flat_exports(list_files(spark, str(tmp_path), "*.parquet"))
    assert rows(files, "billing_period") == [("2024-01",), ("2024-02",)]
    assert [r[0] for r in available_periods(files).collect()] == ["2024-02", "2024-01"]
