"""Contracts of plans, factor files in JSON, and tables whose periods are replaced."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from gridtally import columns as C
from gridtally.factors.json_tables import factor_rows, keyed, leaves, listed, read_documents
from gridtally.operators.base import Operator, bound
from gridtally.plans.lineage import breaches, contracts, lineage
from gridtally.plans.pipelines import Plan
from gridtally.sources import usage as U


def step(name, needs, adds):
    return Operator(name, bound(extra=needs), adds, lambda df, run: df), {}


PLANS = {
    "sound": Plan(C.AWS, C.NATIVE, (step("one", ("a",), ("b",)), step("two", ("a", "b"), ("b", "c")), step("three", ("b", "c"), ()))),
    "late": Plan(C.AWS, C.NATIVE, (step("two", ("b",), ("c",)), step("one", ("a",), ("b",)))),
    "empty": Plan(C.AWS, C.NATIVE, ()),
}


def test_lineage_is_the_last_step_before(spark):
    got = {tuple(r) for r in lineage(spark, PLANS).select("plan", "step", "needed", "added_by").collect()}
    assert got == {
        ("sound", "one", "a", None), ("sound", "two", "a", None), ("sound", "two", "b", "one"), ("sound", "three", "b", "two"),
        ("sound", "three", "c", "two"), ("late", "two", "b", None), ("late", "one", "a", None),
    }


def test_contracts_of_reports(spark):
    rows = [(1, "sound", ["a"]), (2, "sound", []), (3, "late", ["a", "b", "x"]), (4, "late", ["a"]), (5, "none", ["a"]), (6, "sound", None)]
    reports = spark.createDataFrame(rows, "id int, plan string, columns array<string>")
    missing = {(r.id, r.step, r.needed) for r in breaches(reports, PLANS).collect()}
    assert missing == {(2, "one", "a"), (2, "two", "a"), (4, "two", "b"), (5, None, None), (6, "one", "a"), (6, "two", "a")}
    from_input = contracts(reports, PLANS).where("provider = '(input)'").groupBy("id").count().collect()
    assert {tuple(r) for r in from_input} == {(1, 2), (3, 2), (4, 1)}


def test_contracts_agree_with_the_check_of_a_plan(spark):
    plan = Plan.default(C.AWS)
    needed = [c for op, _ in plan.steps for c in op.needs(plan.provider, plan.layout)]
    for lacking in sorted(set(needed)):
        held = [c for c in dict.fromkeys(needed) if c != lacking]
        frame = spark.createDataFrame([], ", ".join(f"`{c}` string" for c in held))
        reports = spark.createDataFrame([("p", held)], "plan string, columns array<string>")
        found = {r.needed for r in breaches(reports, {"p": plan}).collect()}
        try:
            plan.check(frame)
        except ValueError as error:
            assert found == {lacking} and lacking in str(error)
        else:
            assert not found


NESTED = {"a": [1, {"b": "x", "c": [[True]]}, []], "k.1/2": {}, "n": None, "t": 2.5}


def documents(spark, *payloads):
    return spark.createDataFrame([(str(n), p) for n, p in enumerate(payloads)], "file string, payload string")


def test_leaves_of_any_depth(spark):
    got = leaves(documents(spark, json.dumps(NESTED), "{", None, "7", json.dumps({"d": {"e": {"f": 1}}})), depth=5).collect()
    assert {(r.file, r.path, r.value, r.problem) for r in got} == {
        ("0", "a/0", "1", None), ("0", "a/1/b", "x", None), ("0", "a/1/c/0/0", "true", None),
        ("0", "n", None, None), ("0", "t", "2.5", None), ("1", None, None, "no JSON"), ("2", None, None, "no text"),
        ("3", "", "7", None), ("4", "d/e/f", "1", None),
    }


def test_too_deep_is_told(spark):
    got = leaves(documents(spark, json.dumps({"a": {"b": {"c": {"d": 1}}}, "e": {"f": 2}})), depth=2).collect()
    assert {(r.path, r.value, r.problem) for r in got} == {("a/b", None, "too deep"), ("e/f", "2", None)}


def test_keyed_and_listed_tables(spark):
    docs = documents(
        spark,
        json.dumps({"MANAGED_DISKS": {"P 1.a": {"capacity_gb": 4, "storage_type": "SSD"}, "P2": {"capacity_gb": "four"}, "P3": 5}}),
        json.dumps({"SSD_SERVICES": ["one", None, "two"], "OTHER": {}}),
        json.dumps({"MANAGED_DISKS": []}),
        "[",
    )
    disks = keyed(docs, "MANAGED_DISKS", {"capacity_gb": "int", "storage_type": "string"}).collect()
    assert {tuple(r) for r in disks if r.key} == {
        ("0", "P 1.a", 4, "SSD", None), ("0", "P2", None, None, "bad value: capacity_gb"), ("0", "P3", None, None, None),
    }
    assert [(r.place, r.token) for r in listed(docs, "SSD_SERVICES").orderBy("place").collect()] == [(0, "one"), (1, None), (2, "two")]
    problems = factor_rows(docs).where("problem IS NOT NULL AND layout IS NULL").select("file", "problem").collect()
    assert {tuple(r) for r in problems} == {("3", "no JSON")}


def test_documents_are_whole_files(spark, tmp_path):
    (tmp_path / "disks.json").write_text('{\n "MANAGED_DISKS": {\n  "P1": {"capacity_gb": 4, "storage_type": "SSD"}}}')
    rows = factor_rows(read_documents(spark, str(tmp_path))).collect()
    assert {(r.key, r.field, r.value) for r in rows} == {("P1", "capacity_gb", "4"), ("P1", "storage_type", "SSD")}
    assert all(r.file.endswith("disks.json") for r in rows)


MOUNT = "fs.viewfs.mounttable.bills.link./table"


def test_periods_are_replaced_through_a_mount(spark, tmp_path):
    """A path of another scheme, with the mount given as an option of reader and writer."""
    store = {MOUNT: f"file://{tmp_path}/store"}
    path = "viewfs://bills/table"
    (tmp_path / "store").mkdir()
    first = spark.createDataFrame([("2025-01", 1), ("2025-01", 2), ("2025-02", 3)], "BILLING_PERIOD string, n int")
    U.replace_periods(first, path, **store)
    U.replace_periods(spark.createDataFrame([("2025-01", 9), ("2025-03", 4)], "BILLING_PERIOD string, n int"), path, **store)
    back = spark.read.options(**store).parquet(path)
    assert sorted((r.BILLING_PERIOD, r.n) for r in back.collect()) == [("2025-01", 9), ("2025-02", 3), ("2025-03", 4)]


def test_a_failed_write_leaves_the_old_rows(spark, tmp_path):
    path = str(tmp_path / "out")
    old = spark.createDataFrame([("2025-01", 1), ("2025-02", 2)], "BILLING_PERIOD string, n int")
    U.replace_periods(old, path)
    broken = old.withColumn("n", F.when(F.col("n") == 2, F.raise_error(F.lit("lost")).cast("int")).otherwise(F.lit(7)))
    with pytest.raises(Exception, match="lost"):
        U.replace_periods(broken.repartition(2), path)
    assert sorted((r.BILLING_PERIOD, r.n) for r in U.read_enriched(spark, path).collect()) == [("2025-01", 1), ("2025-02", 2)]
    with pytest.raises(ValueError, match="BILLING_PERIOD"):
        U.replace_periods(old.drop("BILLING_PERIOD"), path)
