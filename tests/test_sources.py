import datetime
import json

from pyspark.sql import functions as F

from martloom.operators import metadata as M
from martloom.operators import recache as R
from martloom.operators import viewgate as V
from martloom.sources import catalog as C
from martloom.sources import columnar_json as J
from martloom.sources import files as FI
from martloom.sources import tables as S

from conftest import rows

DAY = datetime.date


def frame(spark):
    return spark.createDataFrame(
        [("a", DAY(2024, 1, 1 + i), float(i), i + 0.5) for i in range(5)] + [("b", DAY(2024, 1, 1), None, 2.0)],
        "series_id string, ds date, y double, yhat double",
    )


def test_columnar_json_body(spark):
    facts = spark.createDataFrame([("a", 0.5, ["dow"])], "series_id string, error_rate double, regressors array<string>")
    bodies = {r["series_id"]: json.loads(r["body"]) for r in rows(J.to_columnar_json(frame(spark), ("ds", "y", "yhat"), facts=facts))}
    assert list(bodies["a"]["y"]) == ["0", "1", "2", "3", "4"]
    assert bodies["a"]["ds"]["1"] == 1704153600000 and bodies["a"]["error_rate"] == 0.5
    assert bodies["a"]["regressors_in_model"] == ["dow"]
    assert bodies["b"]["y"] == {"0": None} and bodies["b"]["error_rate"] is None


def test_columnar_json_years_join_to_the_whole(spark):
    long = frame(spark).union(frame(spark).selectExpr("series_id", "add_months(ds, 12) AS ds", "y", "yhat"))
    parts = J.to_columnar_json(long, ("ds", "y", "yhat"), by_year=True)
    years = {(r["series_id"], r["part"]) for r in rows(parts)}
    assert {("a", 2024), ("a", 2025)} <= years
    back = rows(J.read_columnar_json(parts, ("ds", "y", "yhat")), "series_id", "idx")
    whole = rows(J.read_columnar_json(J.to_columnar_json(long, ("ds", "y", "yhat")), ("ds", "y", "yhat")), "series_id", "idx")
    assert back == whole and len(back) == 12


def test_request_body_takes_text_and_milliseconds(spark):
    bodies = spark.createDataFrame(
        [("a", '{"y":{"1":2.5,"0":"1"},"ds":{"0":1704067200000,"1":"2024-01-02"},"error_rate":3}')], "series_id string, body string"
    )
    got = [(r["idx"], r["ds"].isoformat(), r["y"]) for r in rows(J.read_request_frame(bodies))]
    assert got == [(0, "2024-01-01T00:00:00", 1.0), (1, "2024-01-02T00:00:00", 2.5)]


def test_numbering_holds_for_repeated_days(spark):
    doubled = frame(spark).unionByName(frame(spark))
    numbered = J.number_rows(doubled, "series_id", "ds", ["y", "yhat"])
    assert sorted(r["idx"] for r in rows(numbered.where("series_id = 'a'"))) == list(range(10))


def test_query_and_error_frame(spark):
    assert rows(S.query(spark, "SELECT :x AS x", {"x": 3})) == [{"x": 3}]
    assert rows(S.read_sql_or_error(spark, "SELECT nope FROM nowhere")) == [{"error": "sql is worng"}]


def test_script_runs_in_order_and_stops(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS scripts")
    text = "CREATE TABLE scripts.one AS SELECT 1 AS x;\n\nINSERT INTO scripts.one SELECT :v;\n"
    assert S.run_sql_script(spark, text, env="dev", args={"v": 7}) == 0
    assert not spark.catalog.tableExists("scripts.one")
    assert S.run_sql_script(spark, text, args={"v": 7}) == 2
    assert sorted(r.x for r in spark.table("scripts.one").collect()) == [1, 7]
    try:
        S.run_sql_script(spark, "SELECT * FROM scripts.missing;\nDROP TABLE scripts.one")
        raise AssertionError("the script went on")
    except Exception as error:
        assert "scripts" in str(error) or "missing" in str(error)
    assert spark.catalog.tableExists("scripts.one")


def test_snapshot_may_read_its_own_table(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS snaps")
    name = S.table_name("snaps", "t")
    S.write_snapshot(spark, spark.range(3).toDF("n"), "snaps", "t")
    S.write_snapshot(spark, spark.table(name).select((F.col("n") + 10).alias("n")), "snaps", "t")
    assert sorted(r.n for r in spark.table(name).collect()) == [10, 11, 12]
    assert [t.name for t in spark.catalog.listTables("snaps") if not t.isTemporary] == ["t"]


def test_sheet(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS sheets")
    (tmp_path / "sheet.csv").write_text("project,field\np,001\n")
    S.materialise_sheet(spark, str(tmp_path / "sheet.csv"), ("sheets", "fields"))
    assert rows(spark.table("sheets.fields")) == [{"project": "p", "field": "001"}]


def test_recache_goes_on_after_a_failure(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS cache")
    spark.sql("CREATE DATABASE IF NOT EXISTS views")
    spark.sql("CREATE OR REPLACE VIEW views.v1 AS SELECT 1 AS x")
    control = spark.createDataFrame(
        [
            (2, None, None, "spark_catalog", "cache", "second", "spark_catalog", "cache", "first"),
            (1, None, None, "spark_catalog", "cache", "first", "spark_catalog", "views", "v1"),
            (None, None, None, "spark_catalog", "cache", "last", "spark_catalog", "views", "none"),
        ],
        "launch_order int, schedule int, month_update int, cache_project string, cache_dataset string, "
        "cache_table string, source_project string, source_dataset string, source_view string",
    )
    done = R.run_recaches(spark, R.due_recaches(control, DAY(2024, 3, 10))).collect()
    assert [(r.destination.split("`")[5], r.status) for r in done] == [("first", "ok"), ("second", "ok"), ("last", "failed")]
    assert spark.table("cache.second").collect()[0].x == 1 and done[2].error


def test_changed_files_and_view_deployment(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS gate")
    base = tmp_path / "Projects" / "spark_catalog" / "gate" / "views"
    base.mkdir(parents=True)
    (base / "good.sql").write_text("CREATE OR REPLACE VIEW `spark_catalog`.`gate`.`good` AS\nSELECT 1 AS x")
    (base / "broken.sql").write_text("CREATE OR REPLACE VIEW spark_catalog.gate.broken AS SELECT * FROM gate.nothing")
    here = "Projects/spark_catalog/gate/views/"
    changes = spark.createDataFrame(
        [(here + "good.sql", False), (here + "broken.sql", False), (here + "gone.sql", True)], "path string, deleted boolean"
    )
    files = FI.read_changed_files(spark, str(tmp_path), changes)
    gated = V.gate_views(files)
    assert {r["path"].split("/")[-1]: r["verdict"] for r in rows(gated)} == {
        "good.sql": "deploy", "broken.sql": "deploy", "gone.sql": "deleted",
    }
    done = S.run_statements(spark, V.view_ddl(gated)).collect()
    assert sorted(r.status for r in done) == ["failed", "ok"]
    assert spark.table("gate.good").collect()[0].x == 1


def test_metadata_round_trip_through_the_catalog(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS mart")
    spark.sql("CREATE TABLE mart.m_20240310 (a STRING COMMENT 'old a', b INT) USING parquet COMMENT 'old'")
    spark.sql("CREATE TABLE mart.m_20240301 (a STRING) USING parquet")
    targets = spark.createDataFrame([("p", "mart", "m_"), ("p", "nowhere", "x")], "project string, dataset string, `table` string")
    listing, failures = C.list_tables(spark, targets)
    assert [r["dataset"] for r in rows(failures)] == ["nowhere"]
    tables, columns, failed = C.describe_tables(spark, listing)
    today = tables.selectExpr("max(to_date(modified)) AS d").collect()[0].d
    resolved = M.resolve_targets(targets, tables, today)
    assert {(r["dataset"], r["resolved_table"], r["status"]) for r in rows(resolved)} == {
        ("mart", "m_20240310", "refresh"), ("nowhere", None, "dataset_unlisted"),
    }
    fields = M.field_docs(
        spark.createDataFrame(
            [("p", "mart", "m_", "a", "it's new", "pii")],
            "project string, dataset string, table_name string, field string, field_description string, tag_id string",
        )
    )
    options = M.table_docs(
        spark.createDataFrame(
            [("p", "mart", "m_", "description", None, "new; text"), ("p", "mart", "m_", "label", "tier", "gold")],
            "project string, dataset string, `table` string, `option` string, option_name string, option_value string",
        )
    )
    policy = M.plan_column_policy(resolved, columns, fields, True, True)
    ddl = M.metadata_ddl(tables=M.plan_table_metadata(resolved, tables, options), policy=policy)
    done = S.run_statements(spark, ddl).collect()
    assert len(done) == 4 and all(r.status == "ok" for r in done), done
    tables, columns, failed = C.describe_tables(spark, listing)
    (mart,) = [r for r in rows(tables) if r["table"] == "m_20240310"]
    assert mart["description"] == "new; text" and mart["labels"] == {"tier": "gold"}
    texts = {r["field"]: (r["description"], r["policy_tags"]) for r in rows(columns.where("`table` = 'm_20240310'"))}
    assert texts == {"a": ("it's new", ["pii"]), "b": (None, [])}


def test_combined_results(spark):
    one = spark.createDataFrame([(1, "a")], "x int, y string")
    two = spark.createDataFrame([("b",)], "y string")
    assert rows(S.combine_results(one, two), "y") == [{"x": 1, "y": "a"}, {"x": None, "y": "b"}]


def test_clean_up_takes_only_the_application_s_folder(spark, tmp_path, monkeypatch):
    from martloom import session

    monkeypatch.setattr(session, "shared_folder", lambda _: str(tmp_path))
    (tmp_path / "other").mkdir()
    assert session.stage(frame(spark), "x").count() == 6
    assert (tmp_path / spark.sparkContext.applicationId).exists()
    session.clean_up(spark)
    assert [p.name for p in tmp_path.iterdir()] == ["other"]


def test_changed_files_open_only_their_paths(spark, tmp_path):
    for k in range(10_000):  # a large tree of other files, which is not read
        (tmp_path / f"other{k % 100}").mkdir(exist_ok=True)
        (tmp_path / f"other{k % 100}" / f"f{k}.sql").write_text("x")
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "one.sql").write_text("SELECT 1")
    (tmp_path / "a" / "bad.sql").write_bytes(b"SELECT '\xff'")
    changes = spark.createDataFrame(
        [("a/one.sql", False), ("a/one.sql", False), ("a/bad.sql", False), ("a/gone.sql", True), ("a/missing.sql", False)],
        "path string, deleted boolean",
    )
    got = {r.path: (r.deleted, r.content) for r in FI.read_changed_files(spark, str(tmp_path), changes).collect()}
    assert got == {
        "a/one.sql": (False, "SELECT 1"), "a/bad.sql": (False, "SELECT '�'"), "a/gone.sql": (True, None), "a/missing.sql": (False, None),
    }


def test_inputs_build_on_stored_inputs(spark):
    """What an input builds on is derived once and read back, with the rows of the whole SQL."""
    from martloom.plans import inputs as I

    folder = "/root/testdata/sf0.001"
    for name, needed in (("raw_dictionary", "theme_dictionary"), ("table_schema", "named_orders"), ("catalog_columns", "catalog_tables")):
        whole = spark.sql(f"WITH {I.ctes(name, dialect=I.Spark(folder))} SELECT * FROM {name}")
        found = I.read(spark, folder, name)
        assert (spark.sparkContext.applicationId, folder, needed) in I._STORED
        assert found.exceptAll(whole).isEmpty() and whole.exceptAll(found).isEmpty()
