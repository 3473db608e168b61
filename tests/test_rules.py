"""The rule compiler: semantics per kind, few passes, bounded samples; layers with retention."""

import json
import re

import pytest
from pyspark.sql import functions as F

from sparkbook.operators import quality as Q
from sparkbook.operators import rules as R
from sparkbook.operators.layers import Layer, LayerFailed, run_pipeline
from sparkbook.plans import q_rules

from .conftest import SMOKE

ROWS = [(1, "a", 5, "X"), (2, "b", None, "Y"), (2, " ", 7, "Y"), (None, None, -1, "Z"), (4, "c", 9, None)]


@pytest.fixture(scope="module")
def tables(spark):
    child = spark.createDataFrame(ROWS, "id int, s string, n int, ref string")
    parent = spark.createDataFrame([("X", 1), ("Y", 2), ("Y", 3), (None, 4)], "code string, k long")
    return {"child": child, "parent": parent, "none": child.limit(0)}


def counts(tables, rules, table="child"):
    return {r["rule"]: r["violations"] for r in R.report(tables, {table: rules}).collect()}


def test_row_rules_and_nulls(tables):
    got = counts(tables, [
        R.required("id"), R.required("id", where="n > 0", name="id where n"), R.filled("s"), R.accepted("s", ["a", "b"]), R.within("n", 0, 8), R.within("n", high=8, name="only high"),
        R.matches("s", "[ab]"), R.matches("s", "a|c", name="alternatives"), R.holds("n > 0"), R.holds(F.col("n") > 0, where="id is not null", name="column condition")])
    assert got == {"id required": 1, "id where n": 0, "s filled": 1, "s accepted": 2, "n within": 2, "only high": 1, "s format": 2, "alternatives": 2, "holds n > 0": 2, "column condition": 1}


def test_key_and_reference_rules(tables):
    got = counts(tables, [
        R.unique("id"), R.unique(["id", "ref"]), R.unique("id", where="n is not null", name="id with n"), R.known({"ref": "code"}, "parent"),
        R.known({"ref": "code"}, "parent", where="n > 0", name="ref with n"), R.known({"id": "k"}, "parent", name="int meets long"), R.known({"id": "k", "ref": "code"}, "parent"),
        R.known({"n": "k", "ref": "code"}, "parent")])
    assert got == {"id unique": 1, "id, ref unique": 1, "id with n": 0, "ref in parent": 1, "ref with n": 0, "int meets long": 0, "id, ref in parent": 0, "n, ref in parent": 3}


def test_floor_names_and_empty_tables(tables):
    rules = [R.at_least(6), R.at_least(5, name="five"), R.named("[a-z]"), R.named("[a-z]+", name="letters"), R.required("id"), R.unique("id"), R.known({"ref": "code"}, "parent")]
    assert counts(tables, rules) == {"at least 6 rows": 1, "five": 0, "column names": 2, "letters": 0, "id required": 1, "id unique": 1, "ref in parent": 1}
    assert counts(tables, rules, "none") == {"at least 6 rows": 1, "five": 1, "column names": 2, "letters": 0, "id required": 0, "id unique": 0, "ref in parent": 0}


def test_status_thresholds_and_samples(tables):
    rules = [R.within("n", high=0, name="warned", severity="warn"), R.within("n", high=0, name="tolerated", error_if=4), R.within("n", high=0, name="failed", error_if=3),
             R.within("n", high=0, name="quiet", warn_if=4, error_if=4), R.unique("id")]
    got = {r["rule"]: r for r in R.report(tables, {"child": rules}).collect()}
    assert {k: r["status"] for k, r in got.items()} == {"warned": "warn", "tolerated": "warn", "failed": "fail", "quiet": "pass", "id unique": "fail"}
    shown = [json.loads(x) for x in got["failed"]["sample"]]
    assert len(shown) == 2 and {x["id"] for x in shown} == {1, 4} and shown[0] == {"id": 1, "s": "a", "n": 5, "ref": "X"}
    assert [json.loads(x) for x in got["id unique"]["sample"]] == [{"id": 2, "n_records": 2}]


def test_mistakes_are_errors(tables):
    with pytest.raises(ValueError, match="repeat"):
        R.report(tables, {"child": [R.required("id"), R.required("id")]})
    with pytest.raises(ValueError, match="no rules"):
        R.report(tables, {"child": []})
    with pytest.raises(KeyError):
        R.report(tables, {"child": [R.known("ref", "missing")]})


def test_a_hundred_rules_read_the_table_once_per_grouping(spark):
    own = [r for r, _ in q_rules.line_rules()]
    assert len(own) == 100
    keys = {r.columns for r in own if isinstance(r, R.KeyRule)}
    references = {(r.columns, r.parent) for r in own if isinstance(r, R.ReferenceRule)}
    plan = q_rules.rule_report(spark, SMOKE)._jdf.queryExecution().optimizedPlan().toString()
    reads = len(re.findall(r"Relation \[[^\]]*l_\w+", plan))
    assert reads == 1 + len(keys) + len(references) == 9
    # parts and line numbers meet the suppliers in one join
    assert len(re.findall(r"Join LeftOuter, \(k0", plan)) == len({(r.parent, r.parent_columns) for own in q_rules.TABLES.values() for r, _ in own if isinstance(r, R.ReferenceRule)})


def test_checks_are_one_report(spark, tables):
    checks = [Q.Check("a", Q.not_null(tables["child"], "id")), Q.Check("b", Q.unique(tables["child"], "id"), severity="warn"), Q.Check("c", tables["none"])]
    got = {r.check: (r.violations, r.status, len(r.sample)) for r in Q.run_checks(checks).collect()}
    assert got == {"a": (1, "fail", 1), "b": (1, "warn", 1), "c": (0, "pass", 0)}


def test_layers_run_rules_and_drop_what_nothing_reads(spark):
    def one(name, rows):
        return lambda t: {name: spark.createDataFrame(rows, "id int")}

    layers = [
        Layer("raw", one("a", [(1,), (2,)]), rules={"a": [R.unique("id"), R.known("id", "src")]}),
        Layer("mid", lambda t: {"b": t["a"].withColumn("x", F.lit(1)), "c": t["a"]}, reads=["a", "src"]),
        Layer("end", lambda t: {"d": t["b"]}, lambda t: [Q.Check("d set", Q.not_null(t["d"], "id"))], reads=["b"]),
    ]
    src = spark.createDataFrame([(1,), (2,)], "id int")
    tables, report = run_pipeline(layers, {"src": src}, keep=["d"])
    assert set(tables) == {"src", "d"} and tables["d"].count() == 2 and src.count() == 2
    assert sorted((r.layer, r.table, r.check, r.status) for r in report.collect()) == [("end", "", "d set", "pass"), ("raw", "a", "id in src", "pass"), ("raw", "a", "id unique", "pass")]
    every, _ = run_pipeline(layers, {"src": src})
    assert set(every) == {"src", "a", "b", "c", "d"} and every["a"].count() == 2


def test_a_dropped_table_is_gone_from_the_shared_folder(spark):
    made = {}

    def build(t):
        made["files"] = t["a"].inputFiles()
        return {"b": t["a"]}

    run_pipeline([Layer("one", lambda t: {"a": spark.range(3).toDF("id")}), Layer("two", build, reads=["a"])], {}, keep=["b"])
    with pytest.raises(Exception):  # noqa: B017
        spark.read.parquet(*made["files"]).count()


def test_failing_rules_stop_the_run(spark):
    bad = Layer("one", lambda t: {"a": spark.createDataFrame([(1,), (1,)], "id int")}, rules={"a": [R.unique("id")]})
    with pytest.raises(LayerFailed) as failed:
        run_pipeline([bad, Layer("two", lambda t: {"b": t["a"]})], {})
    assert failed.value.report.filter("status = 'fail'").count() == 1


def test_the_whole_book_in_layers(spark):
    """31 tables, all checked, none left behind but the one kept; a planted fault stops the run before the facts."""
    from sparkbook.plans import q_layers as L

    tables, report = run_pipeline(L.book_layers(spark, SMOKE), {}, keep=["fct_trades"])
    assert set(tables) == {"fct_trades"} and tables["fct_trades"].count() > 0
    assert report.select("table").distinct().count() == 32 and sum(len(x) for x in L.LAYERS.values()) == 31
    assert report.filter("status = 'fail'").count() == 0 and report.filter("status = 'warn'").count() > 3
    layers = L.book_layers(spark, SMOKE)
    staging = layers[1]
    faulty = Layer(staging.name, lambda t: (x := staging.build(t)) | {"stg_countries": x["stg_countries"].filter("country_id <> 3")}, staging.checks, staging.rules, staging.reads)
    with pytest.raises(LayerFailed) as failed:
        run_pipeline([layers[0], faulty, *layers[2:]], {}, keep=[])
    bad = {(r.table, r.check): r.violations for r in failed.value.report.filter("status = 'fail'").collect()}
    assert failed.value.layer == "staging" and ("stg_clients", "country_id in stg_countries") in bad and ("stg_countries", "at least 25 rows") in bad


def test_a_row_is_written_as_json_once_for_all_its_rules(tables):
    """Each kind of rule, and a check, writes its rows as JSON in one place of the plan."""
    many = [R.within("n", high=k, name=f"up to {k}") for k in range(20)]
    for own, times in ((many, 1), ([R.unique("id")], 1), ([R.known({"ref": "code"}, "parent")], 1)):
        plan = R.report(tables, {"child": own})._jdf.queryExecution().optimizedPlan().toString()
        assert len(re.findall(r"to_?json|structstojson", plan, re.I)) == times
    plan = Q.run_checks([Q.Check("any", tables["child"])])._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"to_?json|structstojson", plan, re.I)) == 1
