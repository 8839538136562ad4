"""Reading, repairing and writing reports; factor files and builders; streaming."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from gridtally import columns as C
from gridtally.factors import build as B
from gridtally.factors import tables as T
from gridtally.operators.quality import gpu_model, lookup_gaps
from gridtally.plans.pipelines import Plan
from gridtally.session import scratch_path
from gridtally.sources import usage as U
from gridtally.streaming.arrivals import enrich_arrivals
from gridtally.workload import rows as W


def test_azure_csv_is_repaired(spark, tmp_path):
    iso = tmp_path / "iso.csv"
    iso.write_text(
        "Date,ChargeType,Quantity,CostInBillingCurrency,Tags\n"
        '2026-06-29,Usage,24,1.5,"""team"": ""a"""\n'
        "2026-06-30,Usage,n/a,x,\n"
    )
    first, second = U.read_usage(spark, str(iso), C.AZURE).orderBy("Date").collect()
    assert str(first["Date"]) == "2026-06-29" and first["Quantity"] == 24.0
    assert json.loads(first["Tags"]) == {"team": "a"}
    assert second["Quantity"] is None and second["CostInBillingCurrency"] is None and second["Tags"] is None
    us = tmp_path / "us.csv"
    us.write_text("Date,Quantity\n06/29/2026,1\n6/9/2026,2\nsoon,3\n")
    got = [str(r["Date"]) for r in U.read_usage(spark, str(us), C.AZURE).orderBy("Quantity").collect()]
    assert got == ["2026-06-29", "2026-06-09", "None"]


def test_written_periods_are_folders(spark, tmp_path):
    path = str(tmp_path / "out")
    U.write_usage(spark.createDataFrame([("2025-01", 1), ("2025-02", 2)], "BILLING_PERIOD string, n int"), path)
    U.write_usage(spark.createDataFrame([("2025-03", 3), ("2025-04", 4)], "BILLING_PERIOD string, n int"), path)
    assert sorted((r["BILLING_PERIOD"], r["n"]) for r in U.read_enriched(spark, path).collect()) == [("2025-03", 3), ("2025-04", 4)]
    assert [r["BILLING_PERIOD"] for r in U.read_enriched(spark, f"{path}/BILLING_PERIOD=*3/").collect()] == ["2025-03"]
    one = next((tmp_path / "out" / "BILLING_PERIOD=2025-04").glob("*.parquet"))
    assert U.read_enriched(spark, str(one)).first()["BILLING_PERIOD"] == "2025-04"
    plan = U.read_enriched(spark, path).where("BILLING_PERIOD = '2025-03'")
    assert "PartitionFilters: [isnotnull(BILLING_PERIOD" in plan._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("write", [U.write_usage, U.replace_periods])
def test_rows_are_dealt_by_period_before_they_are_written(spark, tmp_path, write):
    """Or each task would sort all periods of its input, and write a file for each of them."""
    path = str(tmp_path / "t")
    periods = F.when(F.col("id") % 5 > 0, F.concat(F.lit("2025-0"), (F.col("id") % 5).cast("string")))
    lines = spark.range(0, 1000, 1, 7).select(F.col("id").alias("n"), periods.alias("BILLING_PERIOD"))
    write(lines, path)
    folders = [f for f in (tmp_path / "t").iterdir() if f.is_dir()]
    assert [len(list(f.glob("*.parquet"))) for f in folders] == [1] * 5
    back = U.read_enriched(spark, path).select("n", "BILLING_PERIOD").collect()
    assert sorted(map(tuple, back)) == sorted(map(tuple, lines.collect()))


def shuffle_files(spark) -> set[str]:
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {f for f in (files.apply(n).getName() for n in range(files.size())) if f.startswith("shuffle_")}


@pytest.mark.parametrize("open_periods", [128, 2])
@pytest.mark.parametrize("write", [U.write_usage, U.replace_periods])
def test_large_frames_are_written_without_a_shuffle(spark, tmp_path, monkeypatch, write, open_periods):
    """Or every row would lie on disk twice, once as wide as in memory; also with more periods than open files."""
    for name, value in {"DEALT_BELOW": 4000, "LEAST_SOURCE": 2000, "MOST_SOURCE": 3000, "OPEN_PERIODS": open_periods}.items():
        monkeypatch.setattr(U, name, value)
    path = str(tmp_path / "t")
    periods = F.when(F.col("id") % 5 > 0, F.concat(F.lit("2025-0"), (F.col("id") % 5).cast("string")))
    lines = spark.range(0, 1000, 1, 7).select(F.col("id").alias("n"), periods.alias("BILLING_PERIOD"))
    assert U.source_bytes(lines) == 8000
    before = shuffle_files(spark)
    write(lines, path)
    assert not shuffle_files(spark) - before
    folders = [f for f in (tmp_path / "t").iterdir() if f.is_dir()]
    assert [len(list(f.glob("*.parquet"))) for f in folders] == [4] * 5
    assert spark.conf.get(U.OPEN_WRITERS) == "0"
    back = U.read_enriched(spark, path).select("n", "BILLING_PERIOD").collect()
    assert sorted(map(tuple, back)) == sorted(map(tuple, lines.collect()))


def test_sources_of_unknown_size_are_dealt(spark):
    rows = spark.createDataFrame(spark.sparkContext.parallelize([("2025-01", 1)], 2), "BILLING_PERIOD string, n int")
    assert U.source_bytes(rows) is None and U.source_bytes(rows.join(spark.range(9))) is None


def test_anonymize(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], "line_item_usage_account_id int, region int, Quantity int, mine int")
    assert U.anonymize(df, C.AWS).columns == ["region"]
    assert U.anonymize(df, C.AZURE, ["mine"]).columns == ["region", "Quantity", "mine"]
    with pytest.raises(ValueError, match="no column"):
        U.anonymize(df.select("mine"), C.AWS)


def test_conform(spark):
    df = spark.createDataFrame([("2025-01-02T00:00:00Z", 1.0)], "ChargePeriodStart string, billedcost double")
    row = U.conform(df).first()
    assert row["BILLING_PERIOD"] == "2025-01" and row["BilledCost"] == 1.0 and row["ListCost"] is None


def test_factor_csv(spark, tmp_path):
    path = tmp_path / "f.csv"
    path.write_text("# note\n\nprovider,region,gCO2\naws, us-east-1 ,1.5\naws,us-east-1,2.5\naws,x\n gcp,y,3,\n")
    got = {(r["provider"], r["region"]): r["intensity"] for r in T.load_factor_csv(spark, str(path), "water").withColumnRenamed("wcf", "intensity").collect()}
    assert got == {("aws", "us-east-1"): 2.5, ("gcp", "y"): 3.0}
    with pytest.raises(Exception, match="bad factor line"):
        T.load_factor_csv(spark, str(path), "intensity").collect()
    eff = tmp_path / "e.csv"
    eff.write_text("# h\nEurope,eu-.+,1.11,0.04\nX,ap-1,,0.12\nY,me-.+,1.3,\nZ,none,,\n")
    rows = {r["region"]: (r["pue"], r["wue"]) for r in T.load_factor_csv(spark, str(eff), "efficiency").collect()}
    assert rows == {"eu-.+": (1.11, 0.04), "ap-1": (None, 0.12), "me-.+": (1.3, None)}


def test_factor_json(spark, tmp_path):
    disks = tmp_path / "d.json"
    disks.write_text(json.dumps({"MANAGED_DISKS": {"E2": {"capacity_gb": 8, "storage_type": "SSD"}}}))
    assert T.load_disks_json(spark, str(disks)).first().asDict() == {"sku": "E2", "gb": 8, "media": "SSD"}
    gpus = tmp_path / "g.json"
    gpus.write_text(json.dumps({"GPU_INSTANCES_TYPES": {"g": {"quantity": 2, "type": "T"}}, "GPU_INFO": {"T": {"min": 8, "max": 71.5}}}, indent=1))
    assert tuple(T.load_gpu_json(spark, str(gpus)).first()) == ("g", "T", 2, 8.0, 71.5)
    rules = tmp_path / "r.json"
    rules.write_text(json.dumps({"SSD_USAGE_TYPES": ["a"], "SSD_SERVICES": ["b"], "HDD_USAGE_TYPES": ["c", "d"]}))
    assert T.load_storage_rules_json(spark, str(rules)).count() == 4


def test_the_last_line_of_the_last_path_wins(spark, tmp_path):
    (tmp_path / "a.csv").write_text("aws,r,1\n")
    (tmp_path / "b.csv").write_text("# longer\naws,r,2\n" + "".join(f"aws,q{n},1\n" for n in range(500)) + "aws,r,3\n")

    def value(*names: str) -> float:
        paths = [str(tmp_path / name) for name in names]
        return T.load_factor_csv(spark, paths, "intensity").where("region = 'r'").first()["intensity"]

    assert value("a.csv", "b.csv") == 3.0 and value("b.csv", "a.csv") == 1.0
    assert T.load_factor_csv(spark, str(tmp_path), "intensity").where("region = 'r'").first()["intensity"] == 3.0
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "600b")
    try:
        assert value("a.csv", "b.csv") == 3.0 and value("b.csv") == 3.0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_factor_joins_agree_on_both_sides_of_the_bound(spark, monkeypatch):
    regions = spark.createDataFrame(
        [("aws", f"r{n}", ["United States", "France", None][n % 3], ["Ohio", "Texas", None][n % 3], None) for n in range(60)],
        "provider string, region string, country string, state string, latitude string",
    )
    grids = spark.createDataFrame([("RFCW", 2.0), ("ERCT", 3.0)], "key string, value double")
    nations = spark.createDataFrame([("France", 5.0)], "key string, value double")

    def rows() -> list[tuple]:
        return [tuple(r) for r in B.factor_wcf(regions, grids, nations).collect()]

    small = rows()
    checked = T.Dim.checked
    monkeypatch.setattr(T.Dim, "checked", staticmethod(lambda frame: checked(frame, limit=0)))
    assert small == rows() and len(small) == 40


def test_large_tables_are_not_broadcast(spark):
    big = T.Dim.checked(spark.range(50).selectExpr("cast(id as string) k", "id v"), limit=10)
    assert not big.small and T.Dim.checked(spark.range(10).selectExpr("id"), limit=10).small
    facts = spark.range(100).selectExpr("id", "if(id < 60, cast(id as string), null) key", "map('a', id) m")
    got = T.lookup(facts, big, F.col("key"), "k", "_")
    assert got.count() == 100 and got.where("_v IS NULL").count() == 50
    keys = facts.where("key IS NULL").select(T.spread_nulls(facts, F.col("key")))
    assert keys.distinct().count() == 40


def test_scratch_is_shared_where_the_cluster_names_a_folder(spark, tmp_path):
    named = spark.conf.get("spark.checkpoint.dir", None)
    path = scratch_path(spark, "x")
    assert path != scratch_path(spark, "x") and (not named or path.startswith(named))


def test_gaps(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("b", 4.0), (None, 8.0)], "k string, cost double")
    known = T.Dim(spark.createDataFrame([("b",)], "name string"), True)
    rows = lookup_gaps(df, F.col("k"), F.col("cost"), known, "name").collect()
    assert [tuple(r) for r in rows] == [("a", 2, 3.0)]


def test_published_region_fixes(spark):
    fields = "provider string, region string, name string, country string, latitude string, longitude string, metro_area string"
    regions = spark.createDataFrame(
        [("aws", "ap-east-2", "Auckland", "New Zealand", "1", "1", None), ("aws", "us-west-1", "A", "US", "1", "1", None),
         ("aws", "us-west-2", "B", "US", "2", "2", None), ("azure", "eastus", "East", "US", "3", "3", "Richmond")], fields)
    unresolved = spark.createDataFrame([("aws", "Asia Pacific (Taipei)", "Taiwan", "5", "5", None)], fields.replace("region string, ", ""))
    got = {(r["provider"], r["region"]): r for r in B.apply_region_fixes(regions, unresolved, B.region_fixes(spark)).collect()}
    assert got["aws", "ap-southeast-6"]["name"] == "Auckland" and got["aws", "ap-east-2"]["name"] == "Asia Pacific (Taipei)"
    assert got["aws", "us-west-1"]["name"] == "B" and got["aws", "us-west-2"]["name"] == "A"
    assert got["azure", "eastus"]["metro_area"] == "Ashburn" and got["azure", "eastus"]["latitude"] == "39.043757" and len(got) == 5


def test_names(spark):
    df = spark.createDataFrame([("Île-de-France ",), ("Kanagawa Prefecture",), ("São  Paulo",), ("Tesla V100",)], "n string")
    got = [r[0] for r in df.select(B.place_name(B.without_admin_ending(F.col("n")))).collect()]
    assert got[:3] == ["ile-de-france", "kanagawa", "sao paulo"]
    models = spark.createDataFrame([("NVIDIA_TESLA_V100",), ("Tesla V100",), ("AMD_RADEON_PRO_V520",), (None,)], "n string")
    assert [r[0] for r in models.select(gpu_model(F.col("n"))).collect()] == ["v100", "v100", "v520", ""]


def test_arrivals_match_the_batch(spark, sf_dir, tmp_path):
    lines = W.aws_native(spark, sf_dir)
    source = str(tmp_path / "in")
    lines.write.parquet(source)
    factors = W.sample_factors(spark, C.AWS)
    target = str(tmp_path / "out")
    stream = enrich_arrivals(
        spark, source, spark.read.parquet(source).schema, target, str(tmp_path / "cp"), C.AWS, C.NATIVE, factors
    )
    stream.awaitTermination(120)
    batch = Plan.default(C.AWS).apply(spark.read.parquet(source), factors)
    both = [df.agg(F.count(F.lit(1)), F.count(C.OPERATIONAL), F.round(F.sum(C.OPERATIONAL), 3)).first() for df in (spark.read.parquet(target), batch)]
    assert tuple(both[0]) == tuple(both[1])
