"""Documentation sheets against the table catalog: what to refresh, and with which text."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.operators.joins import lookup_join

DATE_SUFFIX = r"_\d{8}$"
KEYS = ["project", "dataset", "table"]


def dotted_id(project: Column, dataset: Column, table: Column) -> Column:
    return F.concat(project, F.lit("."), dataset, F.lit("."), table)


def base_table(table: Column) -> Column:
    """``name_20240310`` to ``name_``, other names unchanged."""
    return F.regexp_replace(table, DATE_SUFFIX, "_")


def _base_id() -> Column:
    return dotted_id(F.col("project"), F.col("dataset"), base_table(F.col("resolved_table")))


def field_docs(table_schema: DataFrame) -> DataFrame:
    """``base_id, field, description, tag_id``: one row per documented field.

    Repeated rows collapse first (a hash aggregation, before any shuffle); of differing
    ones the smallest (NULL first) stands.
    """
    rows = table_schema.where(F.col("project").isNotNull()).select(
        dotted_id(F.col("project"), F.col("dataset"), F.col("table_name")).alias("base_id"),
        "field",
        F.col("field_description").alias("description"),
        "tag_id",
    )
    first = rows.distinct().groupBy("base_id", "field").agg(F.min(F.struct("description", "tag_id")).alias("_first"))
    return first.select("base_id", "field", "_first.description", "_first.tag_id")


def _table_options(table_metadata: DataFrame) -> DataFrame:
    return table_metadata.where(F.col("project").isNotNull()).select(
        dotted_id(F.col("project"), F.col("dataset"), F.col("table")).alias("base_id"),
        "option",
        "option_name",
        "option_value",
    ).distinct()


def label_docs(table_metadata: DataFrame) -> DataFrame:
    """``base_id, label, value``: one row per label, the largest value of a repeat."""
    labels = _table_options(table_metadata).where("option = 'label' and option_name is not null")
    return labels.groupBy("base_id", F.col("option_name").alias("label")).agg(
        F.max("option_value").alias("value")
    )


def table_docs(table_metadata: DataFrame) -> DataFrame:
    """``base_id, has_description, description, labels`` of every table in the sheet.

    The map holds the distinct labels of one table, as the catalog entry does; repeats are
    folded per label before the rows of a table meet.
    """
    is_text = F.col("option") == "description"
    folded = (
        _table_options(table_metadata)
        .groupBy("base_id", "option", "option_name")
        .agg(
            F.min(F.struct("option_value")).alias("_first"),
            F.max("option_value").alias("_last"),
        )
    )
    is_label = (F.col("option") == "label") & F.col("option_name").isNotNull()
    label = F.when(is_label, F.struct("option_name", "_last"))
    docs = folded.groupBy("base_id").agg(
        F.count(F.when(is_text, True)).alias("_texts"),
        F.min(F.when(is_text, F.col("_first"))).alias("_text"),
        F.map_from_entries(F.array_sort(F.collect_list(label))).alias("labels"),
    )
    return docs.select(
        "base_id",
        (F.col("_texts") > 0).alias("has_description"),
        F.col("_text.option_value").alias("description"),
        "labels",
    )


def dated_candidates(catalog: DataFrame) -> DataFrame:
    """Latest table per name a dated target can have: ``project, dataset, table`` (the
    target), ``resolved_table, modified``.

    A catalog name answers to target ``t_`` if it is ``t_``, ``t__``, ``t_20240310`` or
    ``t__20240310``. Cutting the digits leaves ``t_`` or ``t__``, so each name has at most
    two targets and the match is an equality. The latest name is kept before the join: a
    mart with a table for every day costs one row.
    """
    stem = F.regexp_replace("table", r"\d{8}$", "")
    shorter = F.when(stem.endswith("__"), F.regexp_replace(stem, "_$", ""))
    named = catalog.where(stem.endswith("_")).select(
        "project",
        "dataset",
        F.col("table").alias("resolved_table"),
        "modified",
        F.explode(F.array_compact(F.array(stem, shorter))).alias("_target"),
    )
    latest = named.groupBy("project", "dataset", F.col("_target").alias("table")).agg(
        F.max(F.struct("resolved_table", "modified")).alias("_latest")
    )
    return latest.select(*KEYS, "_latest.resolved_table", "_latest.modified")


def exact_candidates(catalog: DataFrame) -> DataFrame:
    """Catalog tables under their own name, in the shape of ``dated_candidates``."""
    return catalog.groupBy(*KEYS).agg(
        F.max("table").alias("resolved_table"), F.max("modified").alias("modified")
    )


def resolve_targets(
    targets: DataFrame, catalog: DataFrame, as_of: datetime.date, listed: DataFrame | None = None
) -> DataFrame:
    """``project, dataset, table, resolved_table, modified, status`` of every target.

    A target ending in ``_`` stands for its latest dated table. Statuses: ``refresh``
    (modified on ``as_of``), ``skip_not_today``, ``missing``, ``dataset_unlisted``,
    ``no_dated_table``, ``bad_target`` (an empty name). ``listed`` holds the
    ``project, dataset`` whose listing succeeded; by default those of the catalog.
    """
    if listed is None:
        listed = catalog
    datasets = listed.select("project", "dataset").distinct().withColumn("_listed", F.lit(True))
    exact = exact_candidates(catalog.where(~F.col("table").endswith("_")))
    # one lookup for both kinds: a target ending in '_' can only meet dated candidates
    candidates = exact.unionByName(dated_candidates(catalog))
    found = lookup_join(targets, candidates, KEYS, "left")
    known = lookup_join(found, datasets, ["project", "dataset"], "left", F.col("table"))
    dated = F.col("table").endswith("_")
    status = (
        F.when(F.coalesce(F.col("table"), F.lit("")) == "", "bad_target")
        .when(F.col("_listed").isNull(), "dataset_unlisted")
        .when(F.col("resolved_table").isNull(), F.when(dated, "no_dated_table").otherwise("missing"))
        .when(F.to_date("modified") == F.lit(as_of), "refresh")
        .otherwise("skip_not_today")
    )
    return known.select(*KEYS, "resolved_table", "modified", status.alias("status"))


def resolution_errors(resolved: DataFrame) -> DataFrame:
    """Targets that could not be resolved, with the dotted name to report."""
    failed = F.col("status").isin("missing", "dataset_unlisted", "bad_target")
    name = F.when(
        F.col("status") == "dataset_unlisted", F.concat_ws(".", "project", "dataset")
    ).otherwise(F.concat_ws(".", *KEYS))
    return resolved.where(failed).select(name.alias("name"), "status").distinct()


def _refreshed(resolved: DataFrame) -> DataFrame:
    return (
        resolved.where("status = 'refresh'")
        .select("project", "dataset", "resolved_table", _base_id().alias("base_id"))
        .distinct()
    )


def _documented_columns(resolved: DataFrame, columns: DataFrame, docs: DataFrame) -> DataFrame:
    """Columns of the refreshed tables the sheet has rows for, with the sheet's texts."""
    tables = docs.select("base_id").distinct()
    chosen = lookup_join(_refreshed(resolved), tables, ["base_id"], "inner")
    at = chosen.withColumnRenamed("resolved_table", "table")
    own = lookup_join(columns, at, KEYS, "inner", F.col("field"))
    sheet = docs.select(
        "base_id",
        "field",
        F.col("description").alias("_new"),
        F.col("tag_id").alias("_tag"),
        F.lit(True).alias("_matched"),
    )
    return lookup_join(own, sheet, ["base_id", "field"], "left")


def plan_column_metadata(
    resolved: DataFrame, columns: DataFrame, docs: DataFrame, update_description: bool = False
) -> DataFrame:
    """Columns with the description to set: the sheet's if not empty and wanted, else the
    present one. Types, modes and policy tags stay."""
    wanted = F.lit(update_description) & (F.coalesce(F.col("_new"), F.lit("")) != "")
    return _documented_columns(resolved, columns, docs).select(
        *KEYS,
        "field",
        "field_type",
        "mode",
        F.when(wanted, F.col("_new")).otherwise(F.col("description")).alias("description"),
        F.col("description").alias("old_description"),
    )


def plan_column_policy(
    resolved: DataFrame,
    columns: DataFrame,
    docs: DataFrame,
    update_description: bool = False,
    update_policy: bool = False,
) -> DataFrame:
    """Columns with the description and policy tags to set.

    Here a column found in the sheet takes the sheet's description even where that is empty
    or NULL. With ``update_policy`` it takes the sheet's tag; a NULL tag means no tag.
    """
    matched = F.coalesce(F.col("_matched"), F.lit(False))
    tags = F.array_compact(F.array("_tag"))
    return _documented_columns(resolved, columns, docs).select(
        *KEYS,
        "field",
        "field_type",
        "mode",
        F.when(matched & F.lit(update_description), F.col("_new"))
        .otherwise(F.col("description"))
        .alias("description"),
        F.when(matched & F.lit(update_policy), tags)
        .otherwise(F.col("policy_tags"))
        .alias("policy_tags"),
        F.col("description").alias("old_description"),
        F.col("policy_tags").alias("old_policy_tags"),
    )


def plan_table_metadata(resolved: DataFrame, tables: DataFrame, docs: DataFrame) -> DataFrame:
    """Description and labels to set on every refreshed table the sheet has rows for.

    A new description, NULL included, replaces the present one unless it is ''. Labels are
    replaced only by a non-empty set. A table whose sheet has no description row gets the
    status ``no_description`` and keeps both.
    """
    present = tables.select(
        *KEYS, F.col("description").alias("old_description"), F.col("labels").alias("old_labels")
    )
    at = _refreshed(resolved).withColumnRenamed("resolved_table", "table")
    found = lookup_join(at, docs, ["base_id"], "inner").join(present, KEYS, "left")
    ok = F.col("has_description")
    keep_text = ~ok | (F.coalesce(F.col("description"), F.lit("-")) == "")
    set_labels = ok & (F.size("labels") > 0)
    return found.select(
        *KEYS,
        F.when(keep_text, F.col("old_description"))
        .otherwise(F.col("description"))
        .alias("description"),
        F.when(set_labels, F.col("labels")).otherwise(F.col("old_labels")).alias("labels"),
        set_labels.alias("labels_changed"),
        F.when(ok, "ok").otherwise("no_description").alias("status"),
    )


def sql_string(value: Column) -> Column:
    """A SQL literal of a text; NULL becomes ''."""
    escaped = F.replace(F.coalesce(value, F.lit("")), F.lit("\\"), F.lit("\\\\"))
    return F.concat(F.lit("'"), F.replace(escaped, F.lit("'"), F.lit("\\'")), F.lit("'"))


def _quoted_name() -> Column:
    return F.concat(F.lit("`"), F.col("dataset"), F.lit("`.`"), F.col("table"), F.lit("`"))


def _step(order: int, item: Column, statement: Column) -> Column:
    return F.struct(
        F.lit(order).alias("launch_order"), item.alias("item"), statement.alias("statement")
    )


def _property(key: Column, value: Column) -> Column:
    return F.concat(
        F.lit("ALTER TABLE "), _quoted_name(), F.lit(" SET TBLPROPERTIES ("),
        sql_string(key), F.lit(" = "), sql_string(value), F.lit(")"),
    )


def _column_steps(plan: DataFrame) -> Column:
    comment = F.concat(
        F.lit("ALTER TABLE "), _quoted_name(), F.lit(" ALTER COLUMN `"), F.col("field"),
        F.lit("` COMMENT "), sql_string(F.col("description")),
    )
    changed = ~F.col("description").eqNullSafe(F.col("old_description"))
    steps = [F.when(changed, _step(1, F.col("field"), comment))]
    if "policy_tags" in plan.columns:
        tag = _property(
            F.concat(F.lit("policy."), F.col("field")), F.array_join("policy_tags", ",")
        )
        retagged = ~F.col("policy_tags").eqNullSafe(F.col("old_policy_tags"))
        steps.append(F.when(retagged, _step(2, F.col("field"), tag)))
    return F.array_compact(F.array(*steps))


def _table_steps() -> Column:
    text = F.when(F.col("description").isNull(), "NULL").otherwise(sql_string(F.col("description")))
    comment = F.concat(F.lit("COMMENT ON TABLE "), _quoted_name(), F.lit(" IS "), text)
    labels = F.transform(
        F.map_entries("labels"),
        lambda e: _step(4, e["key"], _property(F.concat(F.lit("label."), e["key"]), e["value"])),
    )
    described = F.array(_step(3, F.lit("description"), comment))
    return F.when(F.col("labels_changed"), F.concat(described, labels)).otherwise(described)


def metadata_ddl(
    columns: DataFrame | None = None, tables: DataFrame | None = None, policy: DataFrame | None = None
) -> DataFrame:
    """``launch_order, project, dataset, table, item, statement``: one row per change.

    Columns come first, then table descriptions, then labels, one statement per label.
    Policy tags are kept as the table property ``policy.<field>``. Every plan is read once:
    all statements of a row come from one generator.
    """
    parts = [
        plan.select(*KEYS, F.inline(_column_steps(plan)))
        for plan in (columns, policy)
        if plan is not None
    ]
    if tables is not None:
        parts.append(tables.where("status = 'ok'").select(*KEYS, F.inline(_table_steps())))
    ddl = parts[0]
    for part in parts[1:]:
        ddl = ddl.unionByName(part)
    return ddl.select("launch_order", *KEYS, "item", "statement")
