"""Queries of the metadata, recache and view gate operators with their SQL twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from martloom.operators import metadata as M
from martloom.operators import recache as R
from martloom.operators import viewgate as V
from martloom.plans import inputs as I
from martloom.session import stage
from martloom.sources import tables as S

# ---- SQL twins ---------------------------------------------------------------------------

_FIELD_DOCS = f"""{I.ctes('table_schema')},
    field_docs AS (SELECT project || '.' || dataset || '.' || table_name AS base_id, field,
                          field_description AS description, tag_id
                   FROM table_schema WHERE project IS NOT NULL GROUP BY 1, 2, 3, 4
                   QUALIFY row_number() OVER (PARTITION BY base_id, field
                           ORDER BY description NULLS FIRST, tag_id NULLS FIRST) = 1)"""

_TABLE_DOCS = f"""{I.ctes('table_metadata')},
    options AS (SELECT project || '.' || dataset || '.' || "table" AS base_id, option, option_name, option_value
                FROM table_metadata WHERE project IS NOT NULL GROUP BY 1, 2, 3, 4),
    texts AS (SELECT base_id, option_value FROM options WHERE option = 'description'
              QUALIFY row_number() OVER (PARTITION BY base_id ORDER BY option_value NULLS FIRST) = 1),
    label_docs AS (SELECT base_id, option_name AS label, max(option_value) AS value
                   FROM options WHERE option = 'label' GROUP BY 1, 2),
    label_lists AS (SELECT base_id, string_agg(label || '=' || value, ',' ORDER BY label) AS labels
                    FROM label_docs GROUP BY 1),
    table_docs AS (SELECT b.base_id, t.base_id IS NOT NULL AS has_description, t.option_value AS description,
                          coalesce(l.labels, '') AS labels
                   FROM (SELECT DISTINCT base_id FROM options) b LEFT JOIN texts t USING (base_id)
                   LEFT JOIN label_lists l USING (base_id))"""

_RESOLVED = f"""{I.ctes('catalog_tables', 'targets')},
    listed AS (SELECT DISTINCT project, dataset FROM catalog_tables),
    exact AS (SELECT t.project, t.dataset, t."table", c."table" AS resolved_table, c.modified
              FROM targets t JOIN catalog_tables c
                ON c.project = t.project AND c.dataset = t.dataset AND c."table" = t."table"
              WHERE t."table" NOT LIKE '%\\_' ESCAPE '\\'),
    dated AS (SELECT t.project, t.dataset, t."table", c."table" AS resolved_table, c.modified
              FROM targets t JOIN catalog_tables c ON c.project = t.project AND c.dataset = t.dataset
               AND regexp_matches(c."table", '^' || t."table" || '_?([0-9]{{8}})?$')
              WHERE t."table" LIKE '%\\_' ESCAPE '\\'
              QUALIFY row_number() OVER (PARTITION BY t.project, t.dataset, t."table" ORDER BY c."table" DESC) = 1),
    hits AS (SELECT * FROM exact UNION ALL SELECT * FROM dated),
    resolved AS (SELECT t.project, t.dataset, t."table", h.resolved_table, h.modified,
        CASE WHEN t."table" = '' THEN 'bad_target' WHEN l.project IS NULL THEN 'dataset_unlisted'
             WHEN h.resolved_table IS NULL THEN CASE WHEN t."table" LIKE '%\\_' ESCAPE '\\' THEN 'no_dated_table' ELSE 'missing' END
             WHEN CAST(h.modified AS DATE) = DATE '2001-08-01' THEN 'refresh' ELSE 'skip_not_today' END AS status
      FROM targets t LEFT JOIN hits h ON h.project = t.project AND h.dataset = t.dataset AND h."table" = t."table"
      LEFT JOIN listed l ON l.project = t.project AND l.dataset = t.dataset)"""

_REFRESHED = """
    refreshed AS (SELECT DISTINCT project, dataset, resolved_table AS "table",
                         project || '.' || dataset || '.' || regexp_replace(resolved_table, '_[0-9]{8}$', '_') AS base_id
                  FROM resolved WHERE status = 'refresh')"""

_COLUMNS = f"""{_RESOLVED}, {_REFRESHED}, {_FIELD_DOCS.replace(I.ctes('named_orders') + ',', '')},
    {I.ctes('catalog_columns').replace(I.ctes('catalog_tables') + ',', '')},
    own AS (SELECT c.*, r.base_id, d.base_id IS NOT NULL AS matched, d.description AS new, d.tag_id AS tag
            FROM catalog_columns c JOIN refreshed r USING (project, dataset, "table")
            LEFT JOIN field_docs d ON d.base_id = r.base_id AND d.field = c.field
            WHERE r.base_id IN (SELECT base_id FROM field_docs))"""


def _columns_sql(update_description: bool) -> str:
    use = "new IS NOT NULL AND new <> ''" if update_description else "FALSE"
    return f"""{_COLUMNS}, column_plan AS (SELECT project, dataset, "table", field, field_type, mode,
        CASE WHEN {use} THEN new ELSE description END AS description, description AS old_description FROM own)"""


def _policy_sql(update_description: bool, update_policy: bool) -> str:
    text = "CASE WHEN matched THEN new ELSE description END" if update_description else "description"
    tags = (
        "CASE WHEN matched THEN coalesce(tag, '') ELSE array_to_string(policy_tags, ',') END"
        if update_policy
        else "array_to_string(policy_tags, ',')"
    )
    return f"""{_COLUMNS}, policy_plan AS (SELECT project, dataset, "table", field, field_type, mode,
        {text} AS description, {tags} AS policy_tags, description AS old_description,
        array_to_string(policy_tags, ',') AS old_policy_tags FROM own)"""


_TABLES = f"""{_RESOLVED}, {_REFRESHED}, {_TABLE_DOCS.replace(I.ctes('named_orders') + ',', '')},
    table_plan AS (SELECT r.project, r.dataset, r."table",
        CASE WHEN NOT has_description OR d.description = '' THEN c.description ELSE d.description END AS description,
        CASE WHEN has_description AND d.labels <> '' THEN d.labels
             ELSE array_to_string([e.key || '=' || e.value for e in map_entries(c.labels)], ',') END AS labels,
        has_description AND d.labels <> '' AS labels_changed,
        CASE WHEN has_description THEN 'ok' ELSE 'no_description' END AS status, r.base_id
      FROM refreshed r JOIN table_docs d USING (base_id)
      LEFT JOIN catalog_tables c ON c.project = r.project AND c.dataset = r.dataset AND c."table" = r."table")"""


def _literal(column: str) -> str:
    return f"'''' || replace(replace(coalesce({column}, ''), '\\', '\\\\'), '''', '\\''') || ''''"


_NAME = "'`' || dataset || '`.`' || \"table\" || '`'"

_DDL = f"""{_policy_sql(True, True)},
    {_TABLES.removeprefix(_RESOLVED + ', ' + _REFRESHED + ',')},
    ddl AS (
    SELECT 1 AS launch_order, project, dataset, "table", field AS item,
           'ALTER TABLE ' || {_NAME} || ' ALTER COLUMN `' || field || '` COMMENT ' || {_literal('description')} AS statement
    FROM policy_plan WHERE description IS DISTINCT FROM old_description
    UNION ALL
    SELECT 2, project, dataset, "table", field,
           'ALTER TABLE ' || {_NAME} || ' SET TBLPROPERTIES (''policy.' || field || ''' = ' || {_literal('policy_tags')} || ')'
    FROM policy_plan WHERE policy_tags IS DISTINCT FROM old_policy_tags
    UNION ALL
    SELECT 3, project, dataset, "table", 'description', 'COMMENT ON TABLE ' || {_NAME} || ' IS '
           || CASE WHEN description IS NULL THEN 'NULL' ELSE {_literal('description')} END
    FROM table_plan WHERE status = 'ok'
    UNION ALL
    SELECT 4, p.project, p.dataset, p."table", l.label,
           'ALTER TABLE ' || {_NAME} || ' SET TBLPROPERTIES (''label.' || label || ''' = ' || {_literal('value')} || ')'
    FROM table_plan p JOIN label_docs l USING (base_id) WHERE labels_changed)"""

_DUE = f"""{I.ctes('recache_control')},
    due AS (SELECT * FROM recache_control
            WHERE coalesce(schedule, 0) IN (0, isodow(DATE '2001-08-01'))
              AND coalesce(month_update, 0) IN (0, day(DATE '2001-08-01')))"""

_GATED = f"""{I.ctes('view_files', 'aliases')},
    split AS (SELECT *, string_split(path, '/') AS p,
                     string_split(replace(regexp_extract(content, '^CREATE OR REPLACE VIEW\\s+([`A-Za-z0-9_.\\-]+)', 1), '`', ''), '.') AS t
              FROM view_files),
    named AS (SELECT path, deleted, content, p[1] AS root, p[2] AS project, p[3] AS dataset,
                     lower(left(p[5], length(p[5]) - 4)) AS "table",
                     CASE WHEN len(t) = 3 THEN t[1] WHEN len(t) = 2 THEN p[2] END AS q_project,
                     t[-2] AS q_dataset, lower(t[-1]) AS q_table FROM split),
    gated AS (SELECT path, project, dataset, "table",
        CASE WHEN deleted THEN 'deleted' WHEN root <> 'Projects' THEN 'not_projects'
             WHEN path NOT LIKE '%.sql' THEN 'not_sql' WHEN "table" IS NULL THEN 'bad_path'
             WHEN left(content, 22) <> 'CREATE OR REPLACE VIEW' THEN 'not_view'
             WHEN q_project IS NULL THEN 'invalid' WHEN q_project <> project THEN 'wrong_project'
             WHEN q_dataset <> dataset AND NOT EXISTS (SELECT 1 FROM aliases a
                  WHERE a.path_dataset = dataset AND a.query_dataset = q_dataset) THEN 'wrong_dataset'
             WHEN q_table <> "table" THEN 'wrong_table' ELSE 'deploy' END AS verdict, content FROM named)"""


# ---- Spark queries -----------------------------------------------------------------------


def _field_docs(spark, d):
    return M.field_docs(I.read(spark, d, "table_schema"))


def _table_docs(spark, d):
    return M.table_docs(I.read(spark, d, "table_metadata"))


def _resolved(spark, d):
    return M.resolve_targets(
        I.read(spark, d, "targets"), I.read(spark, d, "catalog_tables"), I.AS_OF
    )


def _stored_resolved(spark, d):
    """Resolved targets as a small table: the plans join the catalog with it by broadcast."""
    return stage(_resolved(spark, d), "resolved")


def _policy_plan(spark, d, resolved, update_description, update_policy):
    return M.plan_column_policy(
        resolved, I.read(spark, d, "catalog_columns"), _field_docs(spark, d),
        update_description, update_policy,
    )


def _column_plan(spark, d, update_description):
    return M.plan_column_metadata(
        _stored_resolved(spark, d), I.read(spark, d, "catalog_columns"), _field_docs(spark, d),
        update_description,
    )


def _table_plan(spark, d, resolved):
    return M.plan_table_metadata(
        resolved, I.read(spark, d, "catalog_tables"), _table_docs(spark, d)
    )


def _label_text(name="labels"):
    pairs = F.transform(
        F.array_sort(F.map_entries(name)), lambda e: F.concat(e["key"], F.lit("="), e["value"])
    )
    return F.array_join(pairs, ",").alias(name)


def _tag_text(name):
    return F.array_join(name, ",").alias(name)


def query_helper(spark, d):
    """A parametrised query through the query helper."""
    path = f"{d.rstrip('/')}/orders.parquet"
    return S.query(
        spark,
        f"SELECT o_orderstatus, count(*) AS n FROM parquet.`{path}` WHERE o_totalprice > :low GROUP BY 1",
        {"low": 1000.0},
    )


def sql_error_frame(spark, d):
    """The error row of a query on a missing table, beside the rows of a good one."""
    path = f"{d.rstrip('/')}/part.parquet"
    bad = S.read_sql_or_error(spark, "SELECT * FROM no_such_table_anywhere")
    good = S.read_sql_or_error(spark, f"SELECT p_brand, count(*) AS n FROM parquet.`{path}` GROUP BY 1")
    return S.combine_results(good, bad)


def metadata_datasets(spark, d):
    return I.read(spark, d, "targets").select("project", "dataset").distinct()


def metadata_field_docs(spark, d):
    return _field_docs(spark, d)


def metadata_table_docs(spark, d):
    return _table_docs(spark, d).select("base_id", "has_description", "description", _label_text())


def metadata_labels(spark, d):
    return M.label_docs(I.read(spark, d, "table_metadata"))


def _resolve_where(spark, d, dated):
    ends = F.col("table").endswith("_")
    return _resolved(spark, d).where(ends if dated else ~ends)


def metadata_resolve_exact(spark, d):
    return _resolve_where(spark, d, False)


def metadata_resolve_dated(spark, d):
    return _resolve_where(spark, d, True)


def metadata_resolve_all(spark, d):
    return _resolved(spark, d)


def metadata_errors(spark, d):
    return M.resolution_errors(_resolved(spark, d))


def metadata_plan_columns(spark, d):
    return _column_plan(spark, d, True)


def metadata_plan_columns_default(spark, d):
    return _column_plan(spark, d, False)


def metadata_plan_policy(spark, d):
    return _policy_plan(spark, d, _stored_resolved(spark, d), True, True).withColumns(
        {"policy_tags": _tag_text("policy_tags"), "old_policy_tags": _tag_text("old_policy_tags")}
    )


def metadata_plan_tables(spark, d):
    plan = _table_plan(spark, d, _stored_resolved(spark, d))
    return plan.withColumn("labels", _label_text())


def metadata_ddl(spark, d):
    resolved = _stored_resolved(spark, d)
    return M.metadata_ddl(
        tables=_table_plan(spark, d, resolved),
        policy=_policy_plan(spark, d, resolved, True, True),
    )


def recache_due(spark, d):
    return R.due_recaches(I.read(spark, d, "recache_control"), I.AS_OF)


def _gated(spark, d):
    return V.gate_views(I.read(spark, d, "view_files"), I.read(spark, d, "aliases"))


def view_gate(spark, d):
    return _gated(spark, d).drop("content")


def view_gate_by_verdict(spark, d):
    return _gated(spark, d).groupBy("verdict").agg(F.count(F.lit(1)).alias("files"))


def view_ddl(spark, d):
    return V.view_ddl(_gated(spark, d))


def _select(chain: str, body: str) -> str:
    return f"WITH {chain} {body}"


_ENDS = "\"table\" LIKE '%\\_' ESCAPE '\\'"

QUERIES = {
    "query_helper": (
        query_helper,
        "SELECT o_orderstatus, count(*) AS n FROM orders WHERE o_totalprice > 1000 GROUP BY 1",
    ),
    "sql_error_frame": (
        sql_error_frame,
        f"SELECT p_brand, count(*) AS n, NULL::VARCHAR AS error FROM part GROUP BY 1 UNION ALL SELECT NULL, NULL, '{S.SQL_ERROR}'",
    ),
    "metadata_datasets": (
        metadata_datasets,
        _select(I.ctes("targets"), "SELECT DISTINCT project, dataset FROM targets"),
    ),
    "metadata_field_docs": (metadata_field_docs, _select(_FIELD_DOCS, "SELECT * FROM field_docs")),
    "metadata_table_docs": (metadata_table_docs, _select(_TABLE_DOCS, "SELECT * FROM table_docs")),
    "metadata_labels": (metadata_labels, _select(_TABLE_DOCS, "SELECT * FROM label_docs")),
    "metadata_resolve_exact": (
        metadata_resolve_exact,
        _select(_RESOLVED, f"SELECT * FROM resolved WHERE NOT {_ENDS}"),
    ),
    "metadata_resolve_dated": (
        metadata_resolve_dated,
        _select(_RESOLVED, f"SELECT * FROM resolved WHERE {_ENDS}"),
    ),
    "metadata_resolve_all": (metadata_resolve_all, _select(_RESOLVED, "SELECT * FROM resolved")),
    "metadata_errors": (
        metadata_errors,
        _select(
            _RESOLVED,
            """SELECT DISTINCT CASE WHEN status = 'dataset_unlisted' THEN project || '.' || dataset
            ELSE project || '.' || dataset || '.' || "table" END AS name, status
            FROM resolved WHERE status IN ('missing', 'dataset_unlisted', 'bad_target')""",
        ),
    ),
    "metadata_plan_columns": (
        metadata_plan_columns,
        _select(_columns_sql(True), "SELECT * FROM column_plan"),
    ),
    "metadata_plan_columns_default": (
        metadata_plan_columns_default,
        _select(_columns_sql(False), "SELECT * FROM column_plan"),
    ),
    "metadata_plan_policy": (
        metadata_plan_policy,
        _select(_policy_sql(True, True), "SELECT * FROM policy_plan"),
    ),
    "metadata_plan_tables": (
        metadata_plan_tables,
        _select(_TABLES, "SELECT * EXCLUDE (base_id) FROM table_plan"),
    ),
    "metadata_ddl": (metadata_ddl, _select(_DDL, "SELECT * FROM ddl")),
    "recache_due": (
        recache_due,
        _select(_DUE, "SELECT * FROM due ORDER BY coalesce(launch_order, 999999), cache_project, cache_dataset, cache_table"),
    ),
    "view_gate": (view_gate, _select(_GATED, "SELECT * EXCLUDE (content) FROM gated")),
    "view_gate_by_verdict": (
        view_gate_by_verdict,
        _select(_GATED, "SELECT verdict, count(*) AS files FROM gated GROUP BY 1"),
    ),
    "view_ddl": (
        view_ddl,
        _select(_GATED, "SELECT path, content AS statement FROM gated WHERE verdict = 'deploy'"),
    ),
}
