import datetime

import pytest

from martloom.operators import recache as R
from martloom.operators import viewgate as V

from conftest import rows

CONTROL = (
    "launch_order int, schedule int, month_update int, cache_project string, cache_dataset string, "
    "cache_table string, source_project string, source_dataset string, source_view string"
)


def control(spark, *entries):
    return spark.createDataFrame([(*e, "p", "c", f"t{i}", "p", "v", f"v{i}") for i, e in enumerate(entries)], CONTROL)


def test_calendar(spark):
    frame = control(
        spark, (None, None, None), (5, 0, 0), (1, 7, None), (2, None, 10), (3, 7, 10), (4, 6, None), (4, 7, 9), (6, 1, 10)
    )
    due = R.due_recaches(frame, datetime.date(2024, 3, 10))  # a Sunday
    assert [r.cache_table for r in due.collect()] == ["t2", "t3", "t4", "t1", "t0"]


def gate(spark, path, content, deleted=False, aliases=None):
    files = spark.createDataFrame([(path, deleted, content)], "path string, deleted boolean, content string")
    pairs = None
    if aliases:
        pairs = spark.createDataFrame(aliases, "path_dataset string, query_dataset string")
    (row,) = rows(V.gate_views(files, pairs))
    return row["verdict"]


GOOD = "CREATE OR REPLACE VIEW `p.d.T` AS SELECT 1"


@pytest.mark.parametrize(
    "path, content, verdict",
    [
        ("Projects/p/d/views/t.sql", GOOD, "deploy"),
        ("Projects/p/d/views/T.sql", GOOD, "deploy"),
        ("Projects/p/d/views/t.sql", "CREATE OR REPLACE VIEW p.d.t\nAS SELECT 1", "deploy"),
        ("Projects/p/d/views/t.sql", "CREATE OR REPLACE VIEW `p`.`d`.`t` AS SELECT 1", "deploy"),
        ("Projects/p/d/views/t.sql", "CREATE OR REPLACE VIEW d.t AS SELECT 1", "deploy"),
        ("Other/p/d/views/t.sql", GOOD, "not_projects"),
        ("Projects/p/d/views/t.md", GOOD, "not_sql"),
        ("Projects/t.sql", GOOD, "bad_path"),
        ("Projects/p/d/views/t.sql", "create or replace view `p.d.t` AS SELECT 1", "not_view"),
        ("Projects/p/d/views/t.sql", " " + GOOD, "not_view"),
        ("Projects/p/d/views/t.sql", None, "not_view"),
        ("Projects/p/d/views/t.sql", "CREATE OR REPLACE VIEW", "invalid"),
        ("Projects/p/d/views/t.sql", "CREATE OR REPLACE VIEW t AS SELECT 1", "invalid"),
        ("Projects/x/d/views/t.sql", GOOD, "wrong_project"),
        ("Projects/p/x/views/t.sql", GOOD, "wrong_dataset"),
        ("Projects/p/d/views/x.sql", GOOD, "wrong_table"),
    ],
)
def test_verdicts(spark, path, content, verdict):
    assert gate(spark, path, content) == verdict
    assert gate(spark, path, content, deleted=True) == "deleted"


def test_aliases_hold_one_way(spark):
    pairs = [("d-small", "d")]
    assert gate(spark, "Projects/p/d-small/views/t.sql", GOOD, aliases=pairs) == "deploy"
    other = "CREATE OR REPLACE VIEW `p.d-small.t` AS SELECT 1"
    assert gate(spark, "Projects/p/d/views/t.sql", other, aliases=pairs) == "wrong_dataset"
