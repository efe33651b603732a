"""Control tables derived from the test tables.

Each input is one SQL text for both engines; a dialect object fills in the few spots where
they differ. Everything is derived row by row from whole tables and grows with them.
"""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession

from martloom.functions import text as T
from martloom.session import new_path

AS_OF = datetime.date(2001, 8, 1)


class Spark:
    """Spark SQL spellings; tables are read from the Parquet files of a folder."""

    table = "`table`"
    string = "string"

    def __init__(self, folder: str):
        self.folder = folder.rstrip("/")

    def t(self, name: str) -> str:
        return f"parquet.`{self.folder}/{name}.parquet`"

    def ymd(self, column: str) -> str:
        return f"date_format({column}, 'yyyyMMdd')"

    def numbers(self, last: int) -> str:
        return f"LATERAL explode(sequence(1, {last})) AS s(n)"

    def words(self, column: str) -> str:
        return f"LATERAL explode(split({column}, r'{T.TOKEN_BREAK}')) AS s(token)"

    def matches(self, column: str, pattern: str) -> str:
        return f"{column} RLIKE r'{pattern}'"

    def swap(self, column: str, pattern: str, by: str) -> str:
        return f"regexp_replace({column}, '{pattern}', '{by}')"

    def days(self, low: str, high: str) -> str:
        return f"explode(sequence({low}, {high}))"

    def plus(self, column: str, days: int) -> str:
        return f"date_add({column}, {days})"

    def isodow(self, column: str) -> str:
        return f"(weekday({column}) + 1)"

    def empty_map(self) -> str:
        return "map()"

    def label_map(self, key: str, value: str) -> str:
        return f"map({key}, {value})"

    def no_tags(self) -> str:
        return "cast(array() as array<string>)"

    def tags(self, value: str) -> str:
        return f"array({value})"

    def split_words(self, column: str) -> str:
        return f"split({column}, ' ')"

    def share(self, words: str, k: int, parts: int) -> str:
        """The k-th of ``parts`` equal shares of an array of words, joined by spaces."""
        low, high = f"({k} * size({words})) div {parts}", f"({k + 1} * size({words})) div {parts}"
        return f"array_join(slice({words}, 1 + {low}, {high} - {low}), ' ')"


class Duck(Spark):
    """DuckDB spellings."""

    table = '"table"'
    string = "varchar"

    def __init__(self):
        super().__init__("")

    def t(self, name: str) -> str:
        return name

    def ymd(self, column: str) -> str:
        return f"strftime({column}, '%Y%m%d')"

    def numbers(self, last: int) -> str:
        return f"(SELECT unnest(range(1, {last + 1})) AS n) s"

    def words(self, column: str) -> str:
        return f"(SELECT unnest(regexp_split_to_array({column}, '{T.TOKEN_BREAK}')) AS token) s"

    def matches(self, column: str, pattern: str) -> str:
        return f"regexp_matches({column}, '{pattern}')"

    def swap(self, column: str, pattern: str, by: str) -> str:
        return f"regexp_replace({column}, '{pattern}', '{by}', 'g')"

    def days(self, low: str, high: str) -> str:
        return f"CAST(unnest(generate_series({low}, {high}, INTERVAL 1 DAY)) AS DATE)"

    def plus(self, column: str, days: int) -> str:
        return f"CAST({column} + INTERVAL ({days}) DAY AS DATE)"

    def isodow(self, column: str) -> str:
        return f"isodow({column})"

    def empty_map(self) -> str:
        return "map()"

    def label_map(self, key: str, value: str) -> str:
        return f"MAP {{{key}: {value}}}"

    def no_tags(self) -> str:
        return "CAST([] AS varchar[])"

    def tags(self, value: str) -> str:
        return f"[{value}]"

    def split_words(self, column: str) -> str:
        return f"string_split({column}, ' ')"

    def share(self, words: str, k: int, parts: int) -> str:
        low, high = f"({k} * len({words})) // {parts}", f"({k + 1} * len({words})) // {parts}"
        return f"array_to_string({words}[1 + {low} : {high}], ' ')"


def _theme_dictionary(q) -> str:
    return f"""
    SELECT lang AS industry, source AS subindustry, lower(token) AS keyword,
           CAST(1 + count(*) % 10 AS DOUBLE) AS weight
    FROM {q.t('documents')}, {q.words('text')}
    WHERE length(token) > 2 AND {q.matches('lower(token)', T.WORD)}
    GROUP BY lang, source, lower(token) HAVING count(*) > 1"""


def _raw_dictionary(q) -> str:
    """The dictionary with a second row of another weight for every third length."""
    return f"""
    SELECT industry, subindustry, keyword, weight FROM theme_dictionary
    UNION ALL
    SELECT industry, subindustry, keyword, weight + 2 FROM theme_dictionary
    WHERE length(keyword) % 3 = 0"""


LATIN_LETTERS, CYRILLIC_LETTERS = "abcdefghijklmnopqrstuvwxyz", "абцдефгхийклмнопярстувшхыз"


def _rich_parts(q) -> str:
    """Seven equal shares of the words of every page's whole text, of two pages in three in Cyrillic letters."""
    clean = q.swap(q.swap("lower(text)", "[^a-z ]+", " "), " +", " ")

    def letters(piece: str) -> str:
        return f"CASE WHEN page_id % 3 = 0 THEN {piece} ELSE translate({piece}, '{LATIN_LETTERS}', '{CYRILLIC_LETTERS}') END"

    pieces = ", ".join(f"{letters(q.share('w', k, 7))} AS t{k}" for k in range(7))
    return f"""
    SELECT page_id, url, {pieces}
    FROM (SELECT page_id, url, {q.split_words("piece")} AS w
          FROM (SELECT page_id, url, CASE WHEN page_id % 13 = 5 THEN '' ELSE trim({clean}) END AS piece
                FROM {q.t('pages')} JOIN {q.t('documents')} ON doc_id = page_id) x) y"""


def _rich_pages(q) -> str:
    """Pages with every segment, names that only begin like a tag, and failed fetches."""
    return """
    SELECT page_id, url, CASE WHEN page_id % 11 <> 0 THEN
        '<html><head><META name="keywords" content="' || t0 || '"><meta content="' || t1 || '" name=description>'
        || '<title lang="x">' || t2 || '</title><script>var a = "<h1>no</h1>";</script></head><body><header class=a>'
        || '<p>head</p></header><header-bar>' || t3 || '</header-bar><h1-x></h1-x><h1>' || t4 || '</h1><h2 id="q">' || t5
        || '</h2><p >' || t6 || '</p><footer >foot</footer></body></html>' END AS html
    FROM rich_parts"""


def _rich_dictionary(q) -> str:
    return f"""
    SELECT industry, subindustry, translate(keyword, '{LATIN_LETTERS}', '{CYRILLIC_LETTERS}') AS keyword, weight
    FROM raw_dictionary"""


def _themes(q) -> str:
    return f"SELECT lang AS industry, source AS subindustry FROM {q.t('documents')}"


def _lemmas(q) -> str:
    return f"""
    SELECT token,
           CASE WHEN token LIKE '%s' THEN left(token, CAST(length(token) AS INT) - 1) ELSE token END AS lemma,
           CASE length(token) % 4 WHEN 0 THEN 'NOUN' WHEN 1 THEN 'ADJ' WHEN 2 THEN 'VERB' ELSE 'ADP' END AS pos
    FROM (SELECT DISTINCT lower(token) AS token FROM {q.t('pages')}, {q.words('html')}) w
    WHERE token <> ''"""


def _answers(q) -> str:
    good = """'{"категория": "' || lang || '", "подкатегория": "' || source || '"}'"""
    return f"""
    SELECT url AS domain,
           CASE WHEN page_id % 11 = 0 THEN '{{"категория": "' || lang || '", '
                WHEN page_id % 13 = 0 THEN '{{"категория": "x' || lang || '", "подкатегория": "' || source || '"}}'
                WHEN page_id % 17 = 0 THEN '{{"категория": "' || lang || '"}}'
                WHEN page_id % 19 = 0 THEN 'Ответ: {{"категория": "' || lang || '" и всё}}'
                WHEN page_id % 7 = 0 THEN 'Вот ответ: ' || {good} || ' - готово'
                ELSE {good} END AS response
    FROM {q.t('pages')} JOIN {q.t('documents')} ON doc_id = page_id"""


def _named_orders(q) -> str:
    """Mart and reference table of every order."""
    return f"""
    SELECT 'proj' AS project, 'ds_' || (o_custkey % 5) AS dataset,
           'mart_' || (o_custkey % 50) || '_' AS mart, 'ref_' || (o_custkey % 30) AS ref,
           o_custkey % 50 AS k, o_custkey % 30 AS r, o_orderkey AS okey, o_orderdate AS odate
    FROM {q.t('orders')}"""


def _catalog_tables(q) -> str:
    return f"""
    SELECT project, dataset, {q.table}, description,
           CASE WHEN num % 2 = 0 THEN TIMESTAMP '2001-08-01 06:00:00' ELSE CAST(last_date AS TIMESTAMP) END AS modified,
           CASE WHEN num % 4 = 1 THEN {q.label_map("'old'", "'v' || num")} END AS labels
    FROM (
      SELECT project, dataset, tbl AS {q.table}, num, max(odate) AS last_date,
             CASE WHEN num % 3 > 0 THEN 'about ' || tbl END AS description
      FROM (
        SELECT project, dataset, k AS num, odate,
               mart || CASE WHEN okey % 1000 = 7 THEN '_' ELSE '' END || {q.ymd('odate')} AS tbl
        FROM named_orders
        UNION ALL
        SELECT project, dataset, r AS num, odate, ref AS tbl FROM named_orders) x
      GROUP BY project, dataset, tbl, num) y"""


def _catalog_columns(q) -> str:
    return f"""
    SELECT project, dataset, {q.table}, 'f' || n AS field,
           CASE n % 3 WHEN 0 THEN 'STRING' WHEN 1 THEN 'INT64' ELSE 'FLOAT64' END AS field_type,
           'NULLABLE' AS mode,
           CASE WHEN n % 2 = 1 THEN 'old text ' || n END AS description,
           CASE WHEN n = 1 THEN {q.tags("'pii'")} ELSE {q.no_tags()} END AS policy_tags
    FROM catalog_tables, {q.numbers(7)}"""


def _table_schema(q) -> str:
    return f"""
    SELECT CASE WHEN okey % 97 = 0 THEN NULL ELSE project END AS project, dataset, table_name,
           'f' || n AS field,
           CASE n WHEN 2 THEN '' WHEN 3 THEN NULL WHEN 5 THEN 'text 5 v' || (okey % 2)
                  ELSE 'text ' || n || ' of ' || table_name END AS field_description,
           CASE WHEN n <> 4 THEN 'tag_' || n END AS tag_id
    FROM (SELECT project, dataset, mart AS table_name, okey FROM named_orders
          UNION ALL SELECT project, dataset, ref AS table_name, okey FROM named_orders) x,
         {q.numbers(6)}"""


def _table_metadata(q) -> str:
    return f"""
    SELECT CASE WHEN okey % 97 = 0 THEN NULL ELSE project END AS project, dataset, tbl AS {q.table},
           CASE n WHEN 1 THEN 'description' ELSE 'label' END AS option,
           CASE n WHEN 2 THEN 'owner' WHEN 3 THEN 'tier' END AS option_name,
           CASE WHEN n = 2 THEN 'team_' || (num % 3)
                WHEN n = 3 THEN CASE WHEN okey % 2 = 0 THEN 'gold' ELSE 'silver' END
                WHEN num % 7 = 3 THEN '' WHEN num % 7 = 4 THEN NULL
                ELSE 'Mart ' || tbl END AS option_value
    FROM (SELECT project, dataset, mart AS tbl, k AS num, okey FROM named_orders
          UNION ALL SELECT project, dataset, ref AS tbl, r AS num, okey FROM named_orders) x,
         {q.numbers(3)}
    WHERE NOT (n = 1 AND num % 7 = 5) AND NOT (n > 1 AND num % 7 = 6)"""


def _targets(q) -> str:
    return f"""
    SELECT DISTINCT project, dataset, mart AS {q.table} FROM named_orders
    UNION ALL SELECT DISTINCT project, dataset, ref AS {q.table} FROM named_orders
    UNION ALL SELECT 'proj', 'ds_' || r_regionkey, 'gone_' || r_regionkey FROM {q.t('region')}
    UNION ALL SELECT 'proj', 'ds_' || r_regionkey, 'none_' || r_regionkey || '_' FROM {q.t('region')}
    UNION ALL SELECT 'proj', 'ds_' || r_regionkey, '' FROM {q.t('region')}
    UNION ALL SELECT 'proj', 'other_' || n_nationkey, 'ref_' || n_nationkey FROM {q.t('nation')}"""


def _recache_control(q) -> str:
    return f"""
    SELECT CASE WHEN p_partkey % 3 > 0 THEN CAST(p_partkey % 100 AS INT) END AS launch_order,
           nullif(CAST(p_partkey % 9 AS INT), 8) AS schedule,
           CASE WHEN p_partkey % 4 = 0 THEN p_size % 31 END AS month_update,
           'proj' AS cache_project, 'cache' AS cache_dataset, 'cache_' || p_partkey AS cache_table,
           'proj' AS source_project, 'views' AS source_dataset, 'v_' || p_partkey AS source_view
    FROM {q.t('part')}"""


def _view_files(q) -> str:
    return f"""
    SELECT CASE WHEN k % 101 = 0 THEN 'Projects/proj/' || tbl || '.sql'
                ELSE CASE WHEN k % 5 = 0 THEN 'Scripts' ELSE 'Projects' END || '/proj/ds_' || (k % 6)
                     || CASE WHEN k % 8 = 1 THEN '-small' ELSE '' END || '/views/' || tbl
                     || CASE WHEN k % 7 = 0 THEN '.md' ELSE '.sql' END END AS path,
           k % 17 = 0 AS deleted,
           CASE WHEN k % 11 = 0 THEN 'create or replace view x AS SELECT 1'
                WHEN k % 29 = 0 THEN 'CREATE OR REPLACE VIEW (SELECT 1)'
                WHEN k % 31 = 0 THEN 'CREATE OR REPLACE VIEW `ds_' || (k % 6) || '`.' || upper(tbl) || ' AS SELECT ' || k
                ELSE 'CREATE OR REPLACE VIEW `' || CASE WHEN k % 13 = 0 THEN 'other' ELSE 'proj' END
                     || '.ds_' || CASE WHEN k % 19 = 0 THEN 'x' ELSE '' END || (k % 6) || '.'
                     || CASE WHEN k % 23 = 0 THEN 'w_' ELSE '' END || tbl || '` AS SELECT ' || k || ' AS c' END AS content
    FROM (SELECT p_partkey AS k, 'V_' || p_partkey AS tbl FROM {q.t('part')}) x"""


def _aliases(q) -> str:
    return f"""
    SELECT DISTINCT 'ds_' || (p_partkey % 6) || '-small' AS path_dataset,
           'ds_' || (p_partkey % 6) AS query_dataset
    FROM {q.t('part')} WHERE p_partkey % 6 <> 3"""


def _history(q) -> str:
    return f"""
    SELECT o_orderpriority AS series_id, CAST(o_orderdate AS DATE) AS ds, round(sum(o_totalprice), 2) AS y
    FROM {q.t('orders')} GROUP BY 1, 2
    UNION ALL
    SELECT event_type, CAST(ts AS DATE), round(sum(value), 2) FROM {q.t('events')} GROUP BY 1, 2"""


def _calendar(q) -> str:
    return f"""
    SELECT CAST(ds AS {q.string}) || ' 00:00:00' AS ds,
           CASE WHEN {q.isodow('ds')} >= 6 THEN 0.0 ELSE 1.0 END AS dow,
           CASE WHEN day({q.plus('ds', 1)}) = 1 THEN 1.0 ELSE 0.0 END AS month_end
    FROM (SELECT {q.days('lo', q.plus('hi', 800))} AS ds
          FROM (SELECT min(ds) AS lo, max(ds) AS hi FROM history) e) c"""


def _gapped_calendar(q) -> str:
    """The calendar with holes: every 13th of a month, and every odd day after the history's last."""
    day = f"CAST(left(ds, 10) AS DATE)"
    return f"""
    SELECT * FROM calendar
    WHERE NOT (day({day}) = 13 OR ({day} > (SELECT max(ds) FROM history) AND day({day}) % 2 = 1))"""


def _hyperparameters(q) -> str:
    return f"""
    SELECT p AS forecastMarker, DATE '2001-01-01' AS date, CAST(0.05 AS DOUBLE) AS changepoint_prior_scale,
           CAST(10 AS DOUBLE) AS seasonality_prior_scale, CAST(NULL AS DOUBLE) AS holidays_prior_scale,
           'additive' AS seasonality_mode, 'dow' AS regressors, 'SELECT 1' AS sql
    FROM (SELECT DISTINCT o_orderpriority AS p FROM {q.t('orders')}) x WHERE p <> '5-LOW'
    UNION ALL
    SELECT p, DATE '2001-06-01',
           CASE left(p, 1) WHEN '1' THEN 0.1 WHEN '3' THEN 0.5 WHEN '4' THEN 0.01 END,
           CASE left(p, 1) WHEN '2' THEN NULL ELSE 5.0 END,
           CASE left(p, 1) WHEN '4' THEN 1.0 END,
           CASE left(p, 1) WHEN '3' THEN 'multiplicative' WHEN '1' THEN 'additive' END,
           CASE left(p, 1) WHEN '1' THEN 'dow, month_end' WHEN '3' THEN 'dow,unknown' END,
           CASE left(p, 1) WHEN '1' THEN 'SELECT stored' END
    FROM (SELECT DISTINCT o_orderpriority AS p FROM {q.t('orders')}) x WHERE p <> '5-LOW'"""


def _requests(q) -> str:
    return f"""
    SELECT series_id AS forecastMarker, 'sender ' || left(series_id, 1) AS sender,
           CASE WHEN series_id LIKE '2%' THEN 'SELECT given' END AS sql_query,
           CASE left(series_id, 1) WHEN '1' THEN '30' WHEN '2' THEN 'x' WHEN '3' THEN '90' END AS forecasting_period,
           CASE WHEN series_id LIKE '3%' THEN '2001-06-01' END AS fake_yesterday,
           CASE left(series_id, 1) WHEN '4' THEN 'false' WHEN '1' THEN 'true' END AS use_hypo,
           CASE WHEN series_id NOT LIKE '5%' THEN 'true' END AS error_output
    FROM (SELECT DISTINCT series_id FROM history) h
    UNION ALL
    SELECT 'ghost_' || r_name, NULL, NULL, NULL, NULL, NULL, NULL FROM {q.t('region')}"""


def _shared_requests(q) -> str:
    """Two senders for every marker: one with a long horizon, one that cuts its history."""
    return f"""
    SELECT series_id || '/long' AS request_id, series_id AS forecastMarker, 'a' AS sender, CAST(NULL AS {q.string}) AS sql_query,
           '60' AS forecasting_period, CAST(NULL AS {q.string}) AS fake_yesterday, 'false' AS use_hypo, 'true' AS error_output
    FROM (SELECT DISTINCT series_id FROM history) h
    UNION ALL
    SELECT series_id || '/cut', series_id, 'b', NULL, '7', CAST({q.plus('newest', -40)} AS {q.string}), 'false', 'true'
    FROM (SELECT series_id, max(ds) AS newest FROM history GROUP BY series_id) h"""


INPUTS = {
    "theme_dictionary": (_theme_dictionary, ()),
    "raw_dictionary": (_raw_dictionary, ("theme_dictionary",)),
    "rich_parts": (_rich_parts, ()),
    "rich_pages": (_rich_pages, ("rich_parts",)),
    "rich_dictionary": (_rich_dictionary, ("raw_dictionary",)),
    "themes": (_themes, ()),
    "lemmas": (_lemmas, ()),
    "answers": (_answers, ()),
    "named_orders": (_named_orders, ()),
    "catalog_tables": (_catalog_tables, ("named_orders",)),
    "catalog_columns": (_catalog_columns, ("catalog_tables",)),
    "table_schema": (_table_schema, ("named_orders",)),
    "table_metadata": (_table_metadata, ("named_orders",)),
    "targets": (_targets, ("named_orders",)),
    "recache_control": (_recache_control, ()),
    "view_files": (_view_files, ()),
    "aliases": (_aliases, ()),
    "history": (_history, ()),
    "calendar": (_calendar, ("history",)),
    "gapped_calendar": (_gapped_calendar, ("calendar", "history")),
    "hyperparameters": (_hyperparameters, ()),
    "requests": (_requests, ("history",)),
    "shared_requests": (_shared_requests, ("history",)),
}


def _chain(names: tuple[str, ...] | list[str]) -> list[str]:
    order: list[str] = []
    for name in names:
        for needed in [*_chain(INPUTS[name][1]), name]:
            if needed not in order:
                order.append(needed)
    return order


def ctes(*names: str, dialect=None) -> str:
    """Comma-separated ``name AS (...)`` of the inputs and what they build on."""
    q = dialect or Duck()
    return ",\n".join(f"{name} AS ({INPUTS[name][0](q)})" for name in _chain(names))


# Inputs that add or change rows of another one, which is stored in as many parts as there are cores.
ROW_BY_ROW = {"raw_dictionary", "rich_pages", "rich_dictionary", "catalog_columns", "table_schema", "table_metadata"}

_STORED: dict[tuple[str, str, str], str] = {}


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """An input as a stored table, derived once per application and folder of test tables.

    Control tables are stored tables wherever the operators are used; deriving them anew in
    every branch of a plan would measure the derivation. What an input builds on is stored too.
    """
    key = (spark.sparkContext.applicationId, folder.rstrip("/"), name)
    if key not in _STORED:
        sql, needed = INPUTS[name]
        for other in needed:
            read(spark, folder, other)
        stored = {other: f"SELECT * FROM parquet.`{_STORED[(*key[:2], other)]}`" for other in needed}
        steps = ", ".join(f"{step} AS ({text})" for step, text in [*stored.items(), (name, sql(Spark(folder)))])
        derived = spark.sql(f"WITH {steps} SELECT * FROM {name}")
        path = new_path(spark, f"input-{name}")
        if name not in ROW_BY_ROW:
            # the test tables are single files: spread what is derived from them over the cores
            derived = derived.repartition(spark.sparkContext.defaultParallelism)
        derived.write.parquet(path)
        _STORED[key] = path
    return spark.read.parquet(_STORED[key])


def pages(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/pages.parquet").select("page_id", "url", "html")
