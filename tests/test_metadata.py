import datetime
import random
import re

import pytest

from martloom.operators import metadata as M

from conftest import rows

AS_OF = datetime.date(2024, 3, 11)
TODAY = datetime.datetime(2024, 3, 11, 5)
BEFORE = datetime.datetime(2024, 3, 10, 23, 59)
CATALOG = (
    "project string, dataset string, `table` string, description string, "
    "modified timestamp_ntz, labels map<string,string>"
)


def catalog(spark, *names, modified=TODAY):
    return spark.createDataFrame([("p", "d", name, "old", modified, {"a": "1"}) for name in names], CATALOG)


def targets(spark, *names, dataset="d"):
    return spark.createDataFrame([("p", dataset, name) for name in names], "project string, dataset string, `table` string")


def resolve(spark, names, tables, **kw):
    found = rows(M.resolve_targets(targets(spark, *names), catalog(spark, *tables, **kw), AS_OF))
    return {r["table"]: (r["resolved_table"], r["status"]) for r in found}


def test_latest_dated_table(spark):
    tables = ["m_20240301", "m_20240310", "m__20240101", "mx_20240311"]
    assert resolve(spark, ["m_"], tables) == {"m_": ("m__20240101", "refresh")}


@pytest.mark.parametrize(
    "name, hit",
    [
        ("m_", True), ("m__", True), ("m_20240301", True), ("m__20240301", True), ("m___", False),
        ("m___20240301", False), ("m_2024030", False), ("m_202403011", False), ("xm_20240301", False),
        ("m_2024030a", False), ("m20240301", False),
    ],
)
def test_dated_names(spark, name, hit):
    got = resolve(spark, ["m_"], [name])["m_"]
    assert got == ((name, "refresh") if hit else (None, "no_dated_table"))


def test_statuses(spark):
    got = resolve(spark, ["a", "b", "", "c_"], ["a", "a_20240301"])
    assert got == {
        "a": ("a", "refresh"), "b": (None, "missing"), "": (None, "bad_target"), "c_": (None, "no_dated_table"),
    }
    assert resolve(spark, ["a"], ["a"], modified=BEFORE)["a"][1] == "skip_not_today"
    other = M.resolve_targets(targets(spark, "a", dataset="x"), catalog(spark, "a"), AS_OF)
    assert rows(other)[0]["status"] == "dataset_unlisted"
    assert rows(M.resolution_errors(other)) == [{"name": "p.x", "status": "dataset_unlisted"}]


def test_resolving_again_changes_nothing(spark):
    tables = ["m_20240301", "m_20240310", "n"]
    first = M.resolve_targets(targets(spark, "m_", "n"), catalog(spark, *tables), AS_OF)
    again = M.resolve_targets(
        first.selectExpr("project", "dataset", "resolved_table AS `table`"), catalog(spark, *tables), AS_OF
    )
    assert {r["resolved_table"] for r in rows(again)} == {r["resolved_table"] for r in rows(first)}


SHEET = "project string, dataset string, table_name string, field string, field_description string, tag_id string"


def sheet(spark):
    return spark.createDataFrame(
        [
            ("p", "d", "m_", "a", "new a", "t1"), ("p", "d", "m_", "a", "new a", "t1"),
            ("p", "d", "m_", "b", "", "t2"), ("p", "d", "m_", "c", None, None),
            (None, "d", "m_", "d", "lost", "t4"),
        ],
        SHEET,
    )


def columns(spark, table="m_20240310"):
    return spark.createDataFrame(
        [("p", "d", table, f, "STRING", "NULLABLE", f"old {f}", ["was"]) for f in "abcd"],
        "project string, dataset string, `table` string, field string, field_type string, mode string, "
        "description string, policy_tags array<string>",
    )


def resolved(spark, table="m_20240310"):
    return M.resolve_targets(targets(spark, "m_"), catalog(spark, table), AS_OF)


def texts(frame):
    return {r["field"]: r["description"] for r in rows(frame)}


def test_column_text_rules(spark):
    docs = M.field_docs(sheet(spark))
    keep = {f: f"old {f}" for f in "abcd"}
    assert texts(M.plan_column_metadata(resolved(spark), columns(spark), docs)) == keep
    assert texts(M.plan_column_metadata(resolved(spark), columns(spark), docs, True)) == {**keep, "a": "new a"}


def test_policy_rules(spark):
    docs = M.field_docs(sheet(spark))
    plain = rows(M.plan_column_policy(resolved(spark), columns(spark), docs))
    assert all(r["policy_tags"] == ["was"] and r["description"].startswith("old") for r in plain)
    both = rows(M.plan_column_policy(resolved(spark), columns(spark), docs, True, True))
    assert {r["field"]: (r["description"], r["policy_tags"]) for r in both} == {
        "a": ("new a", ["t1"]), "b": ("", ["t2"]), "c": (None, []), "d": ("old d", ["was"]),
    }


def test_double_underscore_finds_no_documents(spark):
    name = "m__20240310"
    plan = M.plan_column_metadata(resolved(spark, name), columns(spark, name), M.field_docs(sheet(spark)), True)
    assert rows(plan) == []


OPTIONS = "project string, dataset string, `table` string, `option` string, option_name string, option_value string"


def table_plan(spark, *options):
    frame = spark.createDataFrame([("p", "d", "m_", *o) for o in options], OPTIONS)
    (row,) = rows(M.plan_table_metadata(resolved(spark), catalog(spark, "m_20240310"), M.table_docs(frame)))
    return row


def test_table_text_and_labels(spark):
    row = table_plan(spark, ("description", None, "new"), ("label", "x", "1"), ("label", "x", "2"), ("label", "y", "3"))
    assert (row["description"], row["labels"], row["status"]) == ("new", {"x": "2", "y": "3"}, "ok")
    row = table_plan(spark, ("description", None, ""))
    assert row["description"] == "old" and row["labels"] == {"a": "1"} and not row["labels_changed"]
    assert table_plan(spark, ("description", None, None))["description"] is None
    row = table_plan(spark, ("label", "x", "1"))
    assert row["status"] == "no_description" and row["description"] == "old" and row["labels"] == {"a": "1"}


def test_ddl_quotes_text(spark):
    frame = spark.createDataFrame([("p", "d", "m_", "description", None, "it's a \\ test")], OPTIONS)
    plan = M.plan_table_metadata(resolved(spark), catalog(spark, "m_20240310"), M.table_docs(frame))
    (row,) = rows(M.metadata_ddl(tables=plan))
    assert row["statement"] == "COMMENT ON TABLE `d`.`m_20240310` IS 'it\\'s a \\\\ test'"


def test_input_order_does_not_matter(spark):
    docs = sheet(spark).unionByName(
        spark.createDataFrame([("p", "d", "m_", "a", "another", "t0")], SHEET)
    )
    one = rows(M.field_docs(docs))
    assert one == rows(M.field_docs(docs.orderBy("field_description")))
    assert one == rows(M.field_docs(docs.repartition(3)))


def test_dated_match_agrees_with_the_pattern(spark):
    pieces = random.Random(5)
    names = {"".join(pieces.choice(["m", "_", "__", "20240301", "7", "x"]) for _ in range(pieces.randint(1, 5))) for _ in range(600)}
    wanted = sorted(name for name in names if name.endswith("_"))
    expected = {}
    for target in wanted:
        pattern = re.compile(re.escape(target) + r"_?(\d{8})?$")
        hits = sorted(name for name in names if pattern.match(name))
        expected[target] = hits[-1] if hits else None
    got = resolve(spark, wanted, sorted(names))
    assert {target: got[target][0] for target in wanted} == expected and len(wanted) > 50
