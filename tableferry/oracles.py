"""Independent SQL oracles (DuckDB dialect) for the registered queries.

Each entry computes the same result as ``queries.QUERIES[name]`` directly from the
fixture tables with plain SQL — windows, joins and aggregates written out by hand —
so a mismatch points at the Spark operator.
"""

from __future__ import annotations

# The fixture tables' columns in order, with their Spark types.
SCHEMAS = {
    "region": [("r_regionkey", "int"), ("r_name", "string")],
    "nation": [("n_nationkey", "int"), ("n_name", "string"), ("n_regionkey", "int")],
    "customer": [("c_custkey", "bigint"), ("c_name", "string"), ("c_nationkey", "int"),
                 ("c_acctbal", "double"), ("c_mktsegment", "string")],
    "supplier": [("s_suppkey", "bigint"), ("s_name", "string"), ("s_nationkey", "int"),
                 ("s_acctbal", "double")],
    "part": [("p_partkey", "bigint"), ("p_name", "string"), ("p_brand", "string"), ("p_type", "string"),
             ("p_size", "int"), ("p_retailprice", "double")],
    "orders": [("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"),
               ("o_totalprice", "double"), ("o_orderdate", "timestamp_ntz"), ("o_orderpriority", "string")],
    "lineitem": [("l_orderkey", "bigint"), ("l_partkey", "bigint"), ("l_suppkey", "bigint"),
                 ("l_linenumber", "int"), ("l_quantity", "double"), ("l_extendedprice", "double"),
                 ("l_discount", "double"), ("l_tax", "double"), ("l_returnflag", "string"),
                 ("l_linestatus", "string"), ("l_shipdate", "timestamp_ntz")],
    "events": [("event_id", "bigint"), ("ts", "timestamp_ntz"), ("user_id", "bigint"),
               ("event_type", "string"), ("value", "double"), ("props", "string")],
    "documents": [("doc_id", "bigint"), ("text", "string"), ("lang", "string"), ("source", "string"),
                  ("n_chars", "bigint")],
    "labels": [("doc_id", "bigint"), ("quality", "int"), ("toxic", "int")],
    "pages": [("page_id", "bigint"), ("url", "string"), ("html", "string")],
    "benchmark": [("item_id", "bigint"), ("text", "string")],
    "conversations": [("conv_id", "bigint"), ("turn", "bigint"), ("role", "string"), ("text", "string")],
    "embeddings": [("vec_id", "bigint"), ("embedding", "array<float>"), ("label", "int")],
}
TPCH = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]
ALL = TPCH + ["events", "documents", "labels", "pages", "benchmark", "conversations", "embeddings"]
KEYS = {
    "region": ["r_regionkey"], "nation": ["n_nationkey"], "customer": ["c_custkey"],
    "supplier": ["s_suppkey"], "part": ["p_partkey"], "orders": ["o_orderkey"], "lineitem": [],
    "events": ["event_id"], "documents": ["doc_id"], "labels": ["doc_id"], "pages": ["page_id"],
    "benchmark": ["item_id"], "conversations": ["conv_id", "turn"], "embeddings": ["vec_id"],
}
DAMAGED = {"customer": "c_acctbal", "supplier": "s_acctbal", "part": "p_retailprice", "orders": "o_totalprice"}
PLAN = ["region", "nation", "supplier", "customer", "part", "orders", "lineitem", "partsupp"]
NL = "chr(10)"

# Source-system type of each Spark type: (data_type, precision, scale, length kind).
SOURCE_TYPE = {
    "int": ("int", 10, 0, None), "bigint": ("bigint", 19, 0, None), "double": ("float", 53, None, None),
    "string": ("nvarchar", None, None, "chars"), "timestamp_ntz": ("datetime2", None, None, None),
    "array<float>": ("array<float>", None, None, None),
}
EXTREME_TYPES = ("int", "bigint", "decimal", "numeric", "float", "real", "money")


def _q(s) -> str:
    return "NULL" if s is None else "'" + str(s).replace("'", "''") + "'"


def _n(x, t) -> str:
    return f"CAST({'NULL' if x is None else x} AS {t})"


def _numeric(table):
    return [c for c, t in SCHEMAS[table] if SOURCE_TYPE[t][0] in EXTREME_TYPES]


def counts_cte(tables=ALL) -> str:
    return " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in tables
    )


def catalog_cte(tables=ALL, declared: dict | None = None) -> str:
    """``catalog``: INFORMATION_SCHEMA.COLUMNS of the fixture, text lengths from the data."""
    declared = declared or {}
    rows, lens = [], []
    for t in tables:
        for pos, (c, st) in enumerate(SCHEMAS[t], start=1):
            dt, p, s, kind = SOURCE_TYPE[st]
            ident = 1 if KEYS[t] == [c] and dt in ("int", "bigint") else 0
            length_override = False
            if (t, c) in declared:
                dt, length, p, s = declared[(t, c)]
                length_override = True
            rows.append(
                f"SELECT 'dbo' AS table_schema, '{t}' AS table_name, '{c}' AS column_name, "
                f"'{dt}' AS data_type, {_q(kind)} AS length_kind, {_n(p, 'INTEGER')} AS numeric_precision, "
                f"{_n(s, 'INTEGER')} AS numeric_scale, 'YES' AS is_nullable, {pos} AS ordinal_position, "
                f"{ident} AS is_identity, CAST(NULL AS VARCHAR) AS column_default, "
                f"{'true' if length_override else 'false'} AS length_declared"
            )
            if kind == "chars":
                lens.append(
                    f"SELECT '{t}' AS table_name, '{c}' AS column_name, "
                    f"CAST(max(length({c})) AS BIGINT) AS max_length FROM {t}"
                )
    return f"""cols AS ({' UNION ALL '.join(rows)}),
lens AS ({' UNION ALL '.join(lens)}),
catalog AS (
  SELECT c.table_schema, c.table_name, c.column_name, c.data_type,
         CASE WHEN c.length_kind IS NULL OR c.length_declared THEN CAST(NULL AS BIGINT)
              WHEN l.max_length > 4000 THEN CAST(-1 AS BIGINT) ELSE l.max_length END
           AS character_maximum_length,
         c.numeric_precision, c.numeric_scale, c.is_nullable, c.ordinal_position, c.is_identity,
         c.column_default
  FROM cols c LEFT JOIN lens l ON c.table_name = l.table_name AND c.column_name = l.column_name)"""


CURRENT_CASE = """CASE
  WHEN lower(trim(data_type)) IN ('varchar','nvarchar') THEN
    CASE WHEN character_maximum_length = -1 OR character_maximum_length > 16383 THEN 'LONGTEXT'
         WHEN character_maximum_length > 0 THEN 'VARCHAR(' || character_maximum_length || ')'
         ELSE 'VARCHAR(255)' END
  WHEN lower(trim(data_type)) IN ('char','nchar') THEN
    CASE WHEN character_maximum_length > 0 AND character_maximum_length <= 255 THEN 'CHAR(' || character_maximum_length || ')'
         WHEN character_maximum_length > 255 THEN 'VARCHAR(' || character_maximum_length || ')'
         ELSE 'CHAR(1)' END
  WHEN lower(trim(data_type)) IN ('decimal','numeric') THEN
    'DECIMAL(' || coalesce(CAST(numeric_precision AS VARCHAR), '18') || ',' || coalesce(CAST(numeric_scale AS VARCHAR), '0') || ')'
  WHEN lower(trim(data_type)) = 'binary' THEN
    CASE WHEN character_maximum_length > 0 THEN 'BINARY(' || character_maximum_length || ')' ELSE 'BINARY(1)' END
  WHEN lower(trim(data_type)) = 'varbinary' THEN
    CASE WHEN character_maximum_length = -1 OR character_maximum_length > 65535 THEN 'LONGBLOB'
         WHEN character_maximum_length > 0 THEN 'VARBINARY(' || character_maximum_length || ')'
         ELSE 'VARBINARY(255)' END
  WHEN lower(trim(data_type)) IN ('int') THEN 'INT'
  WHEN lower(trim(data_type)) = 'bigint' THEN 'BIGINT'
  WHEN lower(trim(data_type)) = 'smallint' THEN 'SMALLINT'
  WHEN lower(trim(data_type)) = 'tinyint' THEN 'TINYINT'
  WHEN lower(trim(data_type)) = 'bit' THEN 'TINYINT(1)'
  WHEN lower(trim(data_type)) = 'money' THEN 'DECIMAL(19,4)'
  WHEN lower(trim(data_type)) = 'smallmoney' THEN 'DECIMAL(10,4)'
  WHEN lower(trim(data_type)) = 'float' THEN 'DOUBLE'
  WHEN lower(trim(data_type)) = 'real' THEN 'FLOAT'
  WHEN lower(trim(data_type)) IN ('datetime','smalldatetime') THEN 'DATETIME'
  WHEN lower(trim(data_type)) IN ('datetime2','datetimeoffset') THEN 'DATETIME(6)'
  WHEN lower(trim(data_type)) = 'date' THEN 'DATE'
  WHEN lower(trim(data_type)) = 'time' THEN 'TIME'
  WHEN lower(trim(data_type)) = 'text' THEN 'TEXT'
  WHEN lower(trim(data_type)) IN ('ntext','xml','geography','geometry') THEN 'LONGTEXT'
  WHEN lower(trim(data_type)) = 'image' THEN 'LONGBLOB'
  WHEN lower(trim(data_type)) = 'uniqueidentifier' THEN 'VARCHAR(36)'
  WHEN lower(trim(data_type)) = 'sql_variant' THEN 'TEXT'
  WHEN lower(trim(data_type)) = 'hierarchyid' THEN 'VARCHAR(892)'
  WHEN lower(trim(data_type)) IN ('timestamp','rowversion') THEN 'BINARY(8)'
  ELSE 'TEXT' END"""

LEGACY_CASE = """CASE
  WHEN lower(data_type) IN ('decimal','numeric') THEN
    CASE WHEN numeric_precision IS NOT NULL AND numeric_precision <> 0 AND numeric_scale IS NOT NULL
         THEN 'DECIMAL(' || numeric_precision || ',' || numeric_scale || ')' ELSE 'DECIMAL(10,2)' END
  WHEN lower(data_type) IN ('varchar','nvarchar') THEN
    CASE WHEN character_maximum_length > 16383 THEN 'TEXT'
         WHEN character_maximum_length > 0 THEN 'VARCHAR(' || character_maximum_length || ')'
         ELSE 'TEXT' END
  WHEN lower(data_type) IN ('char','nchar') THEN
    CASE WHEN character_maximum_length > 255 THEN 'VARCHAR(' || character_maximum_length || ')'
         WHEN character_maximum_length > 0 THEN 'CHAR(' || character_maximum_length || ')'
         ELSE 'CHAR(1)' END
  WHEN lower(data_type) = 'int' THEN 'INT'
  WHEN lower(data_type) = 'bigint' THEN 'BIGINT'
  WHEN lower(data_type) = 'smallint' THEN 'SMALLINT'
  WHEN lower(data_type) = 'tinyint' THEN 'TINYINT'
  WHEN lower(data_type) = 'bit' THEN 'BOOLEAN'
  WHEN lower(data_type) = 'money' THEN 'DECIMAL(19,4)'
  WHEN lower(data_type) = 'float' THEN 'DOUBLE'
  WHEN lower(data_type) = 'real' THEN 'FLOAT'
  WHEN lower(data_type) IN ('datetime','datetime2') THEN 'DATETIME'
  WHEN lower(data_type) = 'date' THEN 'DATE'
  WHEN lower(data_type) = 'time' THEN 'TIME'
  WHEN lower(data_type) = 'text' THEN 'TEXT'
  WHEN lower(data_type) = 'ntext' THEN 'LONGTEXT'
  WHEN lower(data_type) = 'uniqueidentifier' THEN 'VARCHAR(36)'
  ELSE 'TEXT' END"""

DECLARED = {
    ("documents", "text"): ("nvarchar", None, None, None),
    ("part", "p_partkey"): ("tinyint", None, 3, 0),
    ("part", "p_retailprice"): ("real", None, 24, None),
    ("events", "ts"): ("datetime", None, None, None),
}


def mapped_cte(tables=ALL, declared=None, profile="current") -> str:
    case = CURRENT_CASE if profile == "current" else LEGACY_CASE
    return catalog_cte(tables, declared) + f",\nmapped AS (SELECT *, {case} AS target_type FROM catalog)"


def damaged(t: str) -> str:
    """The damaged target of table ``t`` as a subquery."""
    if t not in DAMAGED:
        return f"(SELECT * FROM {t})"
    k, col = KEYS[t][0], DAMAGED[t]
    cols = ", ".join(
        f"CASE WHEN substring(md5(CAST({k} AS VARCHAR)), 1, 2) = 'ff' THEN {c} + 1.0 ELSE {c} END AS {c}"
        if c == col else c
        for c, _ in SCHEMAS[t]
    )
    return f"(SELECT {cols} FROM {t} WHERE substring(md5(CAST({k} AS VARCHAR)), 1, 1) <> '0')"


def pages_cte(table="orders", key="o_orderkey", size=1000) -> str:
    return f"""pages AS (
  SELECT CAST((rn - 1) // {size} + 1 AS BIGINT) AS batch_no, count(*) AS n_rows,
         min({key}) AS first_key, max({key}) AS last_key
  FROM (SELECT {key}, row_number() OVER (ORDER BY {key}) AS rn FROM {table}) GROUP BY 1)"""


def names_cte() -> str:
    return catalog_cte() + """,
name_inputs AS (
  SELECT DISTINCT name FROM (
    SELECT table_schema || '.' || table_name || '.' || column_name AS name FROM catalog
    UNION ALL SELECT table_schema || '.' || table_name FROM catalog
    UNION ALL SELECT '[' || table_schema || '].[' || table_name || ']' FROM catalog
    UNION ALL SELECT table_name FROM catalog
    UNION ALL SELECT c_mktsegment || CASE WHEN c_custkey % 2 = 0 THEN '.' ELSE '_' END || 'C' || (c_custkey // 3) FROM customer
    UNION ALL SELECT CASE s_suppkey % 5 WHEN 0 THEN '  ' WHEN 1 THEN '[dbo].[' || s_name || ']' WHEN 2 THEN '.S' || s_suppkey
      WHEN 3 THEN 'S' || s_suppkey || '.' ELSE 'dbo.Händler_' || s_suppkey END FROM supplier))"""


def _target_name(col="name") -> str:
    conv = f"replace(replace(replace({col}, '[', ''), ']', ''), '.', '_')"
    return (
        f"CASE WHEN {col} IS NOT NULL AND NOT regexp_full_match({col}, '\\s*') "
        f"AND regexp_full_match({conv}, '[\\p{{L}}\\p{{Nd}}_]+') THEN {conv} END"
    )


def _preview(col) -> str:
    return f"CASE WHEN length({col}) > 50 THEN substring({col}, 1, 47) || '...' ELSE {col} END"


def _validation_rows(tables=ALL, source=None, target=None) -> str:
    """Per table: counts, and extremes equality (only evaluated when counts match)."""
    parts = []
    for t in tables:
        src = source(t) if source else t
        tgt = target(t) if target else damaged(t)
        num = _numeric(t)
        s_aggs = ", ".join(["count(*) AS sc"] + [f"min({c}) AS smin_{c}, max({c}) AS smax_{c}" for c in num])
        t_aggs = ", ".join(["count(*) AS tc"] + [f"min({c}) AS tmin_{c}, max({c}) AS tmax_{c}" for c in num])
        eq = " AND ".join(
            ["true"] + [f"smin_{c} IS NOT DISTINCT FROM tmin_{c} AND smax_{c} IS NOT DISTINCT FROM tmax_{c}" for c in num]
        )
        parts.append(
            f"SELECT '{t}' AS table_name, sc AS source_count, tc AS target_count, sc = tc AS record_count_match, "
            f"CASE WHEN sc = tc AND sc > 0 THEN least(sc, 100) = least(tc, 100) ELSE sc = tc AND sc = 0 END AS sample_data_match, "
            f"CASE WHEN sc = tc AND sc > 0 THEN ({eq}) ELSE sc = tc AND sc = 0 END AS extreme_values_match "
            f"FROM (SELECT {s_aggs} FROM {src}) s, (SELECT {t_aggs} FROM {tgt}) t"
        )
    body = " UNION ALL ".join(parts)
    return (
        f"SELECT *, record_count_match AND sample_data_match AND extreme_values_match AS data_consistency "
        f"FROM ({body})"
    )


def _verify_rows() -> str:
    parts = []
    for t in ALL:
        ncol = len(SCHEMAS[t])
        parts.append(
            f"SELECT 'dbo.{t}' AS source_table, '{t}' AS target_table, "
            f"(SELECT count(*) FROM {t}) AS source_rows, (SELECT count(*) FROM {damaged(t)}) AS target_rows, "
            f"CAST({ncol} AS BIGINT) AS source_columns, CAST({ncol} AS BIGINT) AS target_columns"
        )
    return (
        "SELECT *, source_rows = target_rows AS row_count_match, source_columns = target_columns AS column_count_match, "
        "source_rows = target_rows AND source_columns = target_columns AS is_valid FROM ("
        + " UNION ALL ".join(parts) + ")"
    )


def _transfer_rows() -> str:
    parts = []
    for t in ALL:
        ncol = len(SCHEMAS[t])
        parts.append(
            f"SELECT 'dbo.{t}' AS source_table, 'dbo_{t}' AS target_table, true AS success, "
            f"(SELECT count(*) FROM {t}) AS row_count, CAST(NULL AS VARCHAR) AS error, "
            f"(SELECT count(*) FROM {t}) AS source_rows, (SELECT count(*) FROM {t}) AS target_rows, "
            f"CAST({ncol} AS BIGINT) AS source_columns, CAST({ncol} AS BIGINT) AS target_columns, "
            f"true AS row_count_match, true AS column_count_match, true AS is_valid"
        )
    return " UNION ALL ".join(parts)


_FAMILIES = {"tinyint": "BIGINT", "smallint": "BIGINT", "int": "BIGINT", "bigint": "BIGINT", "float": "DOUBLE", "double": "DOUBLE",
             "string": "VARCHAR", "date": "DATE", "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP"}


def _unique_sets(max_size=3) -> str:
    """Every set of up to ``max_size`` columns of every table, counted; then the unique ones without a unique part."""
    from itertools import combinations

    sets = []
    for t in ALL:
        columns = [c for c, kind in SCHEMAS[t] if kind in _FAMILIES]
        for size in range(1, max_size + 1):
            for s in combinations(columns, size):
                row = s[0] if size == 1 else f"({', '.join(s)})"
                whole = " AND ".join(f"count({c}) = count(*)" for c in s)
                listed = ", ".join(f"'{c}'" for c in s)
                sets.append(f"SELECT '{t}' AS t, [{listed}] AS c, (SELECT count(DISTINCT {row}) = count(*) AND {whole} FROM {t}) AS u")
    return f"""sets AS MATERIALIZED ({' UNION ALL '.join(sets)}),
keys AS MATERIALIZED (SELECT t AS table_name, array_to_string(c, ',') AS key_columns, CAST(len(c) AS INTEGER) AS size FROM sets x
  WHERE u AND NOT EXISTS (SELECT 1 FROM sets y WHERE y.u AND y.t = x.t AND len(y.c) < len(x.c) AND list_has_all(x.c, y.c)))"""


def _narrowest(table, column, spark_type, as_text=False) -> str:
    """The narrowest type of one column: every candidate cast there and back, the first that all values survive."""
    kind, precision, scale, _ = SOURCE_TYPE[spark_type]
    text = f"CAST({column} AS VARCHAR)" if spark_type != "double" else f"CAST(CAST({column} AS DECIMAL(18,2)) AS VARCHAR)"
    value = text if as_text else column
    kind, spark_type = ("nvarchar", "string") if as_text else (kind, spark_type)
    mapped = {"int": "INT", "bigint": "BIGINT", "float": "DOUBLE", "nvarchar": "VARCHAR(255)", "datetime2": "DATETIME(6)"}.get(kind, "TEXT")
    casts = {"TINYINT": "TINYINT", "SMALLINT": "SMALLINT", "INT": "INTEGER", "BIGINT": "BIGINT"}

    def survives(target):
        there = f"TRY_CAST(v AS {target})"
        return f"bool_and(coalesce(CAST({there} AS {'VARCHAR' if spark_type == 'string' else 'DOUBLE'}) = v, false))"

    whole = " ".join(f"WHEN {survives(c)} THEN '{t}'" for t, c in casts.items())
    digits = "max(length(regexp_extract(v, '^-?0*([0-9]*)', 1)))"
    shown = "length(regexp_extract(v, '[.]([0-9]+)$', 1))"
    day = "WHEN bool_and(date_trunc('day', v) = v) THEN 'DATE' WHEN bool_and(date_trunc('second', v) = v) THEN 'DATETIME' ELSE 'DATETIME(6)'"
    rules = {
        "string": f"""{whole}
  WHEN bool_and(regexp_full_match(v, '-?(0|[1-9][0-9]*)[.][0-9]+') AND NOT regexp_full_match(v, '-0[.]0+'))
    AND min({shown}) = max({shown}) AND {digits} + max({shown}) <= 38
    THEN 'DECIMAL(' || ({digits} + max({shown})) || ',' || max({shown}) || ')'
  WHEN {survives('DATE')} THEN 'DATE'
  WHEN {survives('TIMESTAMP')} THEN CASE WHEN bool_and(date_trunc('second', TRY_CAST(v AS TIMESTAMP)) = TRY_CAST(v AS TIMESTAMP))
    THEN 'DATETIME' ELSE 'DATETIME(6)' END
  WHEN max(length(v)) <= 16383 THEN 'VARCHAR(' || greatest(max(length(v)), 1) || ')'
  WHEN max(strlen(v)) <= 65535 THEN 'TEXT' WHEN max(strlen(v)) <= 16777215 THEN 'MEDIUMTEXT' ELSE 'LONGTEXT'""",
        "double": f"{whole} WHEN {survives('FLOAT')} THEN 'FLOAT' ELSE 'DOUBLE'",
        "timestamp_ntz": day,
    }
    rule = rules.get(spark_type, f"{whole} ELSE 'BIGINT'" if spark_type in ("int", "bigint") else "ELSE 'TEXT'")
    chosen = f"CASE WHEN count(v) = 0 THEN '{mapped}' {rule} END" if rule[:4] != "ELSE" else f"'{mapped}'"
    return (f"SELECT '{table}' AS table_name, '{column}' AS column_name, '{kind}' AS source_type, count(v) AS n_values, "
            f"'{mapped}' AS mapped_type, {chosen} AS target_type FROM (SELECT {value} AS v FROM {table}) "
            "WHERE v IS NOT NULL")


def _inclusions() -> str:
    """Every pair of columns of one family, counted value by value."""
    parts = []
    for family in sorted(set(_FAMILIES.values())):
        values = [
            f"SELECT DISTINCT '{t}' AS t, '{c}' AS c, CAST({c} AS {family}) AS v FROM {t} WHERE {c} IS NOT NULL"
            for t in ALL for c, kind in SCHEMAS[t] if _FAMILIES.get(kind) == family
        ]
        if values:
            parts.append(f"""SELECT a.t AS child_table, a.c AS child_column, b.t AS parent_table, b.c AS parent_column, min(n) AS n_values
  FROM (SELECT *, count(*) OVER (PARTITION BY t, c) AS n FROM ({' UNION ALL '.join(values)})) a JOIN ({' UNION ALL '.join(values)}) b USING (v)
  WHERE a.t <> b.t OR a.c <> b.c GROUP BY ALL HAVING count(*) = min(n)""")
    return f"inclusions AS MATERIALIZED ({' UNION ALL '.join(parts)})"


def _references() -> str:
    """Inclusions in the chosen key of another table, names equal but for a prefix of one or two letters."""
    return """chosen AS (SELECT table_name, min_by(key_columns, (size, key_columns)) AS key_columns FROM keys GROUP BY table_name),
refs AS MATERIALIZED (SELECT i.* FROM inclusions i JOIN keys k ON k.table_name = parent_table AND k.key_columns = parent_column AND k.size = 1
  WHERE child_table <> parent_table AND regexp_replace(child_column, '^[a-z]{1,2}_', '') = regexp_replace(parent_column, '^[a-z]{1,2}_', ''))"""


def _migration_rows(tables=ALL) -> str:
    planned = [t for t in PLAN if t in tables]
    remaining = sorted(t for t in tables if t not in PLAN)
    parts = []
    for i, t in enumerate(planned + remaining, start=1):
        phase = "planned" if t in planned else "remaining"
        parts.append(
            f"SELECT '{t}' AS table_name, '{phase}' AS phase, {i} AS pos, true AS structure_ok, true AS data_ok, "
            f"n AS total_records, n AS migrated_rows, CAST(ceil(n / 1000) AS BIGINT) AS batches, "
            f"CAST(NULL AS VARCHAR) AS error FROM (SELECT count(*) AS n FROM {t})"
        )
    return " UNION ALL ".join(parts)


def _html(v="v") -> str:
    def mark(c):
        return f"CASE WHEN {c} THEN '✓' ELSE '✗' END"

    return (
        "'<tr class=\"' || CASE WHEN data_consistency THEN 'status-ok' ELSE 'status-error' END || '\">' || "
        "'<td>' || table_name || '</td>' || "
        "'<td>' || format('{:,}', source_count) || '</td>' || "
        "'<td>' || format('{:,}', target_count) || '</td>' || "
        f"'<td>' || {mark('record_count_match')} || '</td>' || "
        f"'<td>' || {mark('sample_data_match')} || '</td>' || "
        f"'<td>' || {mark('extreme_values_match')} || '</td>' || "
        f"'<td>' || {mark('data_consistency')} || '</td>' || '</tr>'"
    )


def _documents_reasons() -> str:
    """W4 rejection reasons for documents against its declared target types."""
    return (
        "nullif(concat_ws(',', "
        "CASE WHEN length(text) > 255 THEN 'text:length' END, "
        "CASE WHEN length(lang) > (SELECT max(length(lang)) FROM documents) THEN 'lang:length' END, "
        "CASE WHEN length(source) > (SELECT max(length(source)) FROM documents) THEN 'source:length' END), '')"
    )


def _orphans() -> str:
    fks = [
        ("nation", "n_regionkey", "region", "r_regionkey"),
        ("customer", "c_nationkey", "nation", "n_nationkey"),
        ("supplier", "s_nationkey", "nation", "n_nationkey"),
        ("orders", "o_custkey", "customer", "c_custkey"),
        ("lineitem", "l_orderkey", "orders", "o_orderkey"),
        ("lineitem", "l_partkey", "part", "p_partkey"),
        ("lineitem", "l_suppkey", "supplier", "s_suppkey"),
    ]
    parts = []
    for child, fk, parent, pk in fks:
        ck = (KEYS[child] or [fk])[0]
        parts.append(
            f"SELECT '{child}' AS child_table, '{fk}' AS fk_column, '{parent}' AS parent_table, "
            f"CAST(c.{ck} AS BIGINT) AS child_key, CAST(c.{fk} AS BIGINT) AS fk_value "
            f"FROM {damaged(child)} c WHERE c.{fk} IS NOT NULL AND NOT EXISTS "
            f"(SELECT 1 FROM {damaged(parent)} p WHERE p.{pk} = c.{fk})"
        )
    return " UNION ALL ".join(parts)


def _lossy(table) -> str:
    parts = []
    for c, st in SCHEMAS[table]:
        parts.append(f"SELECT '{table}' AS table_name, '{c}' AS column_name, "
                     f"(SELECT target_type FROM mapped WHERE table_name = '{table}' AND column_name = '{c}') AS target_type, "
                     f"(SELECT count(*) FROM {table} WHERE {c} IS NOT NULL AND {_lossy_pred(table, c)}) AS lossy_rows")
    return " UNION ALL ".join(parts)


def _lossy_pred(table, c) -> str:
    if (table, c) == ("part", "p_partkey"):
        return "try_cast(p_partkey AS TINYINT) IS NULL"
    if (table, c) == ("part", "p_retailprice"):
        return "CAST(CAST(p_retailprice AS FLOAT) AS DOUBLE) <> p_retailprice"
    if (table, c) == ("events", "ts"):
        return "date_trunc('second', ts) <> ts"
    return "false"


def _legacy_ddl() -> str:
    sep = f"',' || {NL} || '  '"
    pk_rows = " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{', '.join('`' + k + '`' for k in KEYS[t])}' AS pk"
        for t in ALL if KEYS[t]
    )
    return (
        "WITH " + mapped_cte(profile="legacy") + f""",
pks AS ({pk_rows}),
ddl_cols AS (SELECT table_name, string_agg('`' || column_name || '` ' || target_type ||
           CASE WHEN is_nullable = 'YES' THEN ' NULL' ELSE ' NOT NULL' END, {sep} ORDER BY ordinal_position) AS body
         FROM mapped GROUP BY table_name)
SELECT c.table_name, 'CREATE TABLE `' || c.table_name || '` (' || {NL} || '  ' ||
       c.body || CASE WHEN p.pk IS NOT NULL THEN {sep} || 'PRIMARY KEY (' || p.pk || ')' ELSE '' END ||
       {NL} || ') ENGINE=InnoDB DEFAULT CHARSET=utf8mb4 COLLATE=utf8mb4_bin' AS ddl
FROM ddl_cols c LEFT JOIN pks p ON c.table_name = p.table_name"""
    )


def _build() -> dict[str, str]:
    o: dict[str, str] = {}
    cnt = counts_cte()
    o["scan_full"] = "SELECT * FROM orders"
    o["scan_paged"] = f"WITH {pages_cte()} SELECT batch_no, n_rows, first_key, last_key FROM pages"
    o["list_base_tables"] = (
        f"SELECT 'dbo' AS table_schema, table_name, 'dbo.' || table_name AS full_name, row_count FROM ({cnt})"
    )
    o["table_row_counts"] = f"SELECT table_name, row_count FROM ({cnt})"
    o["table_structure"] = (
        "WITH " + catalog_cte() + f""", counts AS ({cnt})
SELECT c.table_name, c.table_schema, string_agg(c.column_name, ',' ORDER BY c.ordinal_position) AS column_list,
       CAST(count(*) AS BIGINT) AS column_count, any_value(n.row_count) AS row_count
FROM catalog c JOIN counts n ON c.table_name = n.table_name GROUP BY c.table_name, c.table_schema"""
    )
    o["column_catalog"] = (
        "WITH " + catalog_cte() + """
SELECT table_schema, table_name, column_name, lower(trim(data_type)) AS data_type,
       character_maximum_length AS max_length, numeric_precision AS precision, numeric_scale AS scale,
       upper(is_nullable) = 'YES' AS is_nullable, ordinal_position, coalesce(is_identity, 0) = 1 AS is_identity
FROM catalog"""
    )
    o["column_catalog_legacy"] = (
        "WITH " + catalog_cte() + """
SELECT table_schema, table_name, column_name, data_type, character_maximum_length, numeric_precision,
       numeric_scale, is_nullable, column_default, ordinal_position FROM catalog"""
    )
    o["column_catalog_sys"] = (
        "WITH " + catalog_cte() + """
SELECT table_schema, table_name, column_name, data_type,
       CASE WHEN data_type IN ('varchar', 'nvarchar', 'char', 'nchar') THEN
            CASE WHEN character_maximum_length = -1 THEN NULL
                 WHEN data_type IN ('nvarchar', 'nchar') THEN character_maximum_length * 2
                 ELSE character_maximum_length END END AS character_maximum_length,
       CASE WHEN data_type IN ('decimal', 'numeric', 'float', 'real') THEN numeric_precision END AS numeric_precision,
       CASE WHEN data_type IN ('decimal', 'numeric') THEN numeric_scale END AS numeric_scale,
       is_nullable, column_default, ordinal_position
FROM catalog"""
    )
    o["stream_transfer"] = "SELECT * FROM orders"
    o["stream_progress"] = (
        "SELECT CAST(4 AS BIGINT) AS batches, count(*) AS n_rows, count(*) AS rows_done, CAST(100.0 AS DOUBLE) AS percent, true AS rates_agree FROM orders"
    )
    o["schema_probe"] = """SELECT p.ordinal_position, p.column_name, p.type_code, p.data_type,
       CASE p.column_name WHEN 'text' THEN (SELECT CAST(max(length(text)) AS BIGINT) FROM documents)
                          WHEN 'lang' THEN (SELECT CAST(max(length(lang)) AS BIGINT) FROM documents)
                          WHEN 'source' THEN (SELECT CAST(max(length(source)) AS BIGINT) FROM documents) END
         AS max_length, p.is_nullable
FROM (VALUES (1, 'doc_id', -5, 'varchar', 'YES'), (2, 'text', 12, 'varchar', 'YES'),
  (3, 'lang', 12, 'varchar', 'YES'), (4, 'source', 12, 'varchar', 'YES'), (5, 'n_chars', -5, 'varchar', 'YES'))
  AS p(ordinal_position, column_name, type_code, data_type, is_nullable)"""
    o["top_n_preview"] = "SELECT c_custkey, c_name, c_acctbal FROM customer ORDER BY c_custkey LIMIT 3"
    src_names = (
        f"SELECT table_name FROM ({cnt}) WHERE row_count IS NOT NULL "
        "UNION ALL SELECT 'customer_' || c_custkey FROM customer"
    )
    tgt_counts = " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {damaged(t)}" for t in ALL
    )
    tgt_list = (
        f"SELECT table_name FROM ({tgt_counts}) WHERE row_count IS NOT NULL "
        f"UNION ALL SELECT 'customer_' || c_custkey FROM {damaged('customer')}"
    )
    o["known_tables"] = f"SELECT table_name FROM ({src_names}) WHERE table_name IN ({tgt_list})"
    o["unknown_tables"] = f"SELECT table_name FROM ({src_names}) WHERE table_name NOT IN ({tgt_list})"
    o["missing_tables"] = (
        f"SELECT table_name FROM ({src_names}) WHERE lower(table_name) NOT IN "
        f"(SELECT lower(upper(table_name)) FROM ({tgt_list}))"
    )
    o["narrowest_types"] = " UNION ALL ".join(_narrowest(t, c, st) for t in ALL for c, st in SCHEMAS[t])
    o["narrowest_types_text"] = " UNION ALL ".join(
        _narrowest(t, c, st, as_text=True) for t in ("orders", "lineitem", "events") for c, st in SCHEMAS[t])
    o["minimal_keys"] = f"WITH {_unique_sets()} SELECT * FROM keys"
    o["inclusion_dependencies"] = f"WITH {_inclusions()} SELECT * FROM inclusions"
    found = f"WITH RECURSIVE {_unique_sets()},\n{_inclusions()},\n{_references()}"
    o["primary_keys"] = found + """
SELECT 'dbo' AS table_schema, table_name, unnest(string_split(key_columns, ',')) AS column_name,
  CAST(unnest(range(1, len(string_split(key_columns, ',')) + 1)) AS INTEGER) AS key_ordinal FROM chosen"""
    o["foreign_keys"] = found + """
SELECT 'dbo' AS table_schema, child_table AS table_name, child_column AS column_name, parent_table AS referenced_table_name,
  parent_column AS referenced_column_name FROM refs JOIN chosen ON chosen.table_name = parent_table AND key_columns = parent_column"""
    o["load_levels"] = found + f""",
paths AS (SELECT t, 0 AS level FROM (VALUES {', '.join(f"('{t}')" for t in ALL)}) x(t)
  UNION SELECT child_table, level + 1 FROM paths JOIN refs ON parent_table = t WHERE level < 20)
SELECT t AS table_name, CAST(max(level) AS INTEGER) AS level, CAST(NULL AS VARCHAR) AS ring FROM paths GROUP BY t"""
    o["load_batched"] = "SELECT * FROM customer"
    o["load_transactional"] = "SELECT *, 1 AS version, true AS second_load_failed FROM customer"
    keyed = ", ".join(f"('{t}', '{c}', {i})" for t, key in KEYS.items() for i, c in enumerate(key, start=1))
    created = """
SELECT m.table_name, m.column_name, m.ordinal_position, m.target_type, k.key_ordinal, k.key_ordinal IS NULL AS takes_null
FROM mapped m LEFT JOIN (VALUES """ + keyed + """) k(table_name, column_name, key_ordinal) USING (table_name, column_name)"""
    o["created_tables"] = "WITH " + mapped_cte() + created
    o["migrate_structures"] = "WITH " + mapped_cte(profile="legacy") + created
    o["optimize_files"] = " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS row_count, 'optimized' AS status, CAST(NULL AS VARCHAR) AS error, "
        f"count(*) > 1 AS was_split, 1 AS files_after FROM {t}" for t in ALL
    )
    o["file_extremes"] = " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{c}' AS column_name, count(*) AS row_count, count(*) - count({c}) AS null_count, "
        f"CAST(min({c}) AS BIGINT) AS min_value, CAST(max({c}) AS BIGINT) AS max_value FROM {t}"
        for t in ALL for c, kind in SCHEMAS[t] if kind in ("int", "bigint")
    )
    in_order = """WITH numbered AS (
  SELECT row_number() OVER (ORDER BY p_partkey) AS row_no, *, p_partkey < -128 OR p_partkey > 127 AS bad FROM part),
counted AS (SELECT *, sum(CASE WHEN bad THEN 1 ELSE 0 END) OVER (ORDER BY row_no) AS errors FROM numbered)
"""
    o["fallback_rows"] = in_order + "SELECT row_no, p_partkey, p_name FROM counted WHERE NOT bad AND errors <= 10"
    o["fallback_errors"] = in_order + (
        "SELECT row_no, p_partkey, 'p_partkey:range' AS reject_reasons, errors = 11 AS stops FROM counted WHERE bad AND errors <= 11"
    )
    o["rejected_cells"] = f"""
SELECT p_partkey, 'p_partkey' AS column_name, CAST(p_partkey AS VARCHAR) AS value, '1264' AS code FROM part WHERE p_partkey > 127
UNION ALL SELECT p_partkey, 'p_name', {_preview('p_name')}, '1406' FROM part WHERE length(p_name) > 8
UNION ALL SELECT p_partkey, 'p_brand', {_preview('p_brand')}, '1406' FROM part WHERE strlen(p_brand) > 7
UNION ALL SELECT p_partkey, 'p_type', {_preview('p_type')}, '1292' FROM part WHERE try_cast(p_type AS DATE) IS NULL AND p_type IS NOT NULL
UNION ALL SELECT p_partkey, 'p_retailprice', CAST(p_retailprice AS VARCHAR), '1264' FROM part WHERE try_cast(p_retailprice AS DECIMAL(5,2)) IS NULL"""
    first = "c_mktsegment IN ('AUTOMOBILE', 'BUILDING')"
    o["load_rowwise"] = f"""SELECT c_custkey, c_name, c_mktsegment, CAST(length(c_name) AS BIGINT) AS c_name_len,
       CAST(NULL AS INTEGER) AS c_nationkey, CAST(NULL AS DOUBLE) AS c_acctbal FROM customer WHERE {first}
UNION ALL SELECT c_custkey, NULL, c_mktsegment, NULL, c_nationkey, c_acctbal FROM customer WHERE NOT ({first})"""
    o["align_columns"] = f"""SELECT c_custkey, c_name, CAST(NULL AS INTEGER) AS c_nationkey, CAST(NULL AS DOUBLE) AS c_acctbal,
       c_mktsegment FROM customer WHERE {first}
UNION ALL SELECT c_custkey, NULL, c_nationkey, c_acctbal, c_mktsegment FROM customer WHERE NOT ({first})"""
    o["load_chunk_plan"] = f"""WITH {pages_cte()}
SELECT batch_no, n_rows, CAST(ceil(n_rows / 100) AS BIGINT) AS n_chunks,
       CASE WHEN n_rows = 1 THEN 'single' WHEN n_rows <= 100 THEN 'executemany' ELSE 'chunked' END AS insert_mode,
       batch_no % 50 = 0 OR batch_no = (SELECT max(batch_no) FROM pages) AS commit_after
FROM pages"""
    reasons = _documents_reasons()
    o["quarantine_bad"] = (
        f"SELECT * FROM (SELECT doc_id, text, lang, source, n_chars, {reasons} AS reject_reasons FROM documents) "
        "WHERE reject_reasons IS NOT NULL"
    )
    o["quarantine_good"] = (
        f"SELECT doc_id, text, lang, source, n_chars FROM documents WHERE {reasons} IS NULL"
    )
    o["reject_preview"] = (
        f"SELECT doc_id, {_preview('text')} AS text, reject_reasons FROM ("
        + o["quarantine_bad"] + ") ORDER BY doc_id LIMIT 5"
    )
    o["reject_summary"] = (
        f"SELECT count(*) AS rejected_rows, count(*) > 10 AS too_many_errors FROM ({o['quarantine_bad']})"
    )
    o["map_types"] = (
        "WITH " + mapped_cte() + """
SELECT table_name, column_name, ordinal_position, data_type, character_maximum_length, numeric_precision,
       numeric_scale, target_type FROM mapped"""
    )
    o["map_types_legacy"] = (
        "WITH " + mapped_cte(profile="legacy") + """
SELECT table_name, column_name, ordinal_position, data_type, character_maximum_length, numeric_precision,
       numeric_scale, target_type FROM mapped"""
    )
    o["column_definitions"] = (
        "WITH " + mapped_cte() + """
SELECT table_name, column_name, ordinal_position, target_type AS type_definition,
       upper(is_nullable) = 'YES' AS is_nullable, false AS auto_increment_preserve,
       coalesce(is_identity = 1, false) AS auto_increment_create FROM mapped"""
    )
    o["render_ddl"] = (
        "WITH " + mapped_cte() + f"""
SELECT table_schema || '.' || table_name AS source_table, table_schema || '_' || table_name AS target_table,
       'CREATE TABLE IF NOT EXISTS `' || table_schema || '_' || table_name || '` (' || {NL} ||
       string_agg('  `' || column_name || '` ' || target_type ||
                  CASE WHEN upper(is_nullable) = 'YES' THEN ' NULL' ELSE ' NOT NULL' END, ',' || {NL}
                  ORDER BY ordinal_position) ||
       {NL} || ') ENGINE=InnoDB DEFAULT CHARSET=utf8mb4 COLLATE=utf8mb4_unicode_ci' AS ddl,
       CAST(NULL AS VARCHAR) AS error
FROM mapped GROUP BY table_schema, table_name"""
    )
    o["render_ddl_legacy"] = _legacy_ddl()
    tn = _target_name("name")
    o["target_names"] = (
        "WITH " + names_cte() + f" SELECT name, {tn} AS target_table, ({tn}) IS NOT NULL AS is_valid FROM name_inputs"
    )
    o["source_names"] = (
        "WITH " + names_cte() + f""", flat AS (SELECT DISTINCT {tn} AS name FROM name_inputs)
SELECT name, CASE WHEN name IS NOT NULL AND NOT regexp_full_match(name, '\\s*') THEN replace(name, '_', '.') END
  AS source_table FROM flat"""
    )
    o["valid_names"] = (
        "WITH " + names_cte() + f""", allnames AS (
  SELECT name FROM name_inputs UNION SELECT {tn} FROM name_inputs WHERE ({tn}) IS NOT NULL)
SELECT name, coalesce(regexp_full_match(name, '[\\p{{L}}\\p{{Nd}}_]+'), false) AS is_valid FROM allnames"""
    )
    stripped = "replace(replace(name, '[', ''), ']', '')"
    o["schema_part"] = (
        "WITH " + names_cte() + f"""
SELECT name, nullif(regexp_extract({stripped}, '^(.*)\\.[^.]*$', 1), '') AS schema_part FROM name_inputs"""
    )
    o["table_part"] = (
        "WITH " + names_cte() + f"""
SELECT name, CASE WHEN NOT regexp_full_match(name, '\\s*')
  THEN coalesce(nullif(regexp_extract({stripped}, '\\.([^.]+)$', 1), ''), {stripped}) END AS table_part
FROM name_inputs"""
    )
    o["name_collisions"] = (
        "WITH " + names_cte() + f""", src AS (SELECT DISTINCT {stripped} AS name FROM name_inputs),
flat AS (SELECT name, {tn} AS target_table FROM src)
SELECT target_table, count(*) AS n_sources, string_agg(name, ',' ORDER BY name) AS sources
FROM flat WHERE target_table IS NOT NULL GROUP BY target_table HAVING count(*) > 1"""
    )
    o["duplicate_keys"] = (
        "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber "
        "HAVING count(*) > 1"
    )
    o["too_long"] = (
        "SELECT doc_id, 'text' AS column_name, CAST(length(text) AS BIGINT) AS length FROM documents "
        "WHERE length(text) > 255"
    )
    o["out_of_range"] = (
        "SELECT p_partkey, 'p_partkey' AS column_name, CAST(p_partkey AS VARCHAR) AS value FROM part "
        "WHERE p_partkey < -128 OR p_partkey > 127 "
        "UNION ALL SELECT p_partkey, 'p_size', CAST(p_size AS VARCHAR) FROM part "
        "WHERE p_size < -2147483648 OR p_size > 2147483647"
    )
    o["bad_dates"] = """SELECT o_orderkey, 'o_orderdate' AS column_name, v AS value
FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN strftime(o_orderdate, '%Y-13-%d')
             WHEN o_orderkey % 11 = 0 THEN 'n/a' ELSE CAST(o_orderdate AS VARCHAR) END AS v FROM orders)
WHERE v IS NOT NULL AND coalesce(try_strptime(v, '%Y-%m-%d %H:%M:%S'), try_strptime(v, '%Y-%m-%d %H:%M:%S.%f'),
      try_strptime(v, '%Y-%m-%d'), try_strptime(v, '%Y/%m/%d')) IS NULL"""
    o["suspect_cells"] = (
        f"SELECT doc_id, 'text' AS column_name, {_preview('text')} AS value, '1406' AS code "
        "FROM documents WHERE length(text) > 255"
    )
    decl = "WITH " + mapped_cte(["part", "events", "documents"], DECLARED)
    o["conform_table"] = """SELECT try_cast(p_partkey AS TINYINT) AS p_partkey, p_name, p_brand, p_type, p_size,
       CAST(p_retailprice AS FLOAT) AS p_retailprice FROM part"""
    o["conform_failures"] = decl + """
SELECT m.column_name, m.target_type,
       CASE WHEN m.column_name = 'p_partkey'
            THEN (SELECT count(*) FROM part WHERE p_partkey IS NOT NULL AND try_cast(p_partkey AS TINYINT) IS NULL)
            ELSE 0 END AS failed_casts
FROM mapped m WHERE m.table_name = 'part'"""
    o["normalize_nulls"] = """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
  CASE WHEN isnan(l_quantity) THEN NULL ELSE l_quantity END AS l_quantity,
  CASE WHEN isnan(l_extendedprice) THEN NULL ELSE l_extendedprice END AS l_extendedprice,
  CASE WHEN isnan(l_discount) THEN NULL ELSE l_discount END AS l_discount,
  CASE WHEN l_orderkey % 5 = 0 OR isnan(l_tax) THEN NULL ELSE l_tax END AS l_tax,
  l_returnflag, l_linestatus, l_shipdate FROM lineitem"""
    o["format_timestamps"] = (
        "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, user_id, event_type, value, props FROM events"
    )
    o["parse_date_text"] = """SELECT o_orderkey, o_orderdate_text,
  strftime(coalesce(try_strptime(o_orderdate_text, '%Y-%m-%d'), try_strptime(o_orderdate_text, '%Y/%m/%d')), '%Y-%m-%d')
    AS o_orderdate
FROM (SELECT o_orderkey, strftime(o_orderdate, '%Y/%-m/%-d') AS o_orderdate_text FROM orders)"""
    o["lossy_rows"] = decl + " " + _lossy("part") + " UNION ALL " + _lossy("events")
    num = _numeric("orders")
    o["extreme_values"] = " UNION ALL ".join(
        f"SELECT 'orders' AS table_name, '{c}' AS column_name, {i} AS ordinal, "
        f"CAST(min({c}) AS DOUBLE) + 0.0 AS min_value, CAST(max({c}) AS DOUBLE) + 0.0 AS max_value FROM orders"
        for i, c in enumerate(num, start=1)
    )
    o["verify_tables"] = _verify_rows()
    o["verification_summary"] = (
        f"SELECT count(*) FILTER (WHERE is_valid) AS verify_passed, count(*) FILTER (WHERE NOT is_valid) AS verify_failed, "
        f"count(*) AS verify_total, count(*) FILTER (WHERE NOT is_valid) = 0 AS overall_success FROM ({_verify_rows()})"
    )
    o["validate_tables"] = _validation_rows()
    o["sample_match"] = " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, least(s, 100) AS source_sample, least(d, 100) AS target_sample, "
        f"least(s, 100) = least(d, 100) AS sample_match FROM (SELECT count(*) AS s FROM {t}), "
        f"(SELECT count(*) AS d FROM {damaged(t)})"
        for t in ALL
    )
    o["extreme_match"] = " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{c}' AS column_name, CAST(smin AS DOUBLE) + 0.0 AS source_min, "
        f"CAST(smax AS DOUBLE) + 0.0 AS source_max, CAST(tmin AS DOUBLE) + 0.0 AS target_min, "
        f"CAST(tmax AS DOUBLE) + 0.0 AS target_max, "
        f"smin IS NOT DISTINCT FROM tmin AND smax IS NOT DISTINCT FROM tmax AS match "
        f"FROM (SELECT min({c}) AS smin, max({c}) AS smax FROM {t}), "
        f"(SELECT min({c}) AS tmin, max({c}) AS tmax FROM {damaged(t)})"
        for t in ALL for c in _numeric(t)
    )
    o["validate_database"] = (
        "SELECT count(*) AS tables, count(*) FILTER (WHERE data_consistency) AS consistent_tables, "
        f"coalesce(bool_and(data_consistency), true) AS overall_success FROM ({_validation_rows()})"
    )
    vals = [c for c, _ in SCHEMAS["customer"] if c != "c_custkey"]
    changed = "concat_ws(',', " + ", ".join(
        f"CASE WHEN s.{c} IS DISTINCT FROM t.{c} THEN '{c}' END" for c in vals
    ) + ")"
    first = "substring(md5(CAST(c_custkey AS VARCHAR)), 1, 1)"
    o["content_diff"] = f"""WITH moved AS (
  SELECT c_custkey, CASE WHEN {first} <> 'd' THEN c_name END AS c_name, c_nationkey, c_acctbal,
         CASE WHEN {first} = 'd' THEN c_name ELSE c_mktsegment END AS c_mktsegment FROM {damaged('customer')}),
target AS (SELECT * FROM moved UNION ALL SELECT * FROM moved WHERE {first} = 'a'
  UNION ALL SELECT -1 - c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM moved WHERE {first} = 'b'),
t AS (SELECT c_custkey, count(*) AS n, {", ".join(f"first({c}) AS {c}" for c in vals)} FROM target GROUP BY c_custkey),
both_sides AS (
  SELECT coalesce(s.c_custkey, t.c_custkey) AS c_custkey,
         CASE WHEN s.c_custkey IS NULL THEN 'extra' WHEN t.c_custkey IS NULL THEN 'missing' WHEN t.n > 1 THEN 'duplicate'
              WHEN {changed} <> '' THEN 'changed' END AS status, {changed} AS columns
  FROM customer s FULL JOIN t ON s.c_custkey = t.c_custkey)
SELECT c_custkey, status, CASE WHEN status = 'changed' THEN columns END AS changed_columns
FROM both_sides WHERE status IS NOT NULL"""
    parts = [f"SELECT 'customer' AS table_name, c_custkey AS key_value, status, changed_columns FROM ({o['content_diff']})"]
    for t in ("supplier", "part", "orders"):
        k = KEYS[t][0]
        cols = "concat_ws(',', " + ", ".join(
            f"CASE WHEN s.{c} IS DISTINCT FROM t.{c} THEN '{c}' END" for c, _ in SCHEMAS[t] if c != k
        ) + ")"
        parts.append(f"""SELECT '{t}', s.{k}, CASE WHEN t.{k} IS NULL THEN 'missing' ELSE 'changed' END,
  CASE WHEN t.{k} IS NOT NULL THEN {cols} END FROM {t} s LEFT JOIN {damaged(t)} t ON s.{k} = t.{k}
WHERE t.{k} IS NULL OR {cols} <> ''""")
    o["content_diff_tree"] = " UNION ALL ".join(parts)
    lines = ", ".join(c for c, _ in SCHEMAS["lineitem"])
    copied = ", ".join("l_quantity + CASE WHEN first = '02' THEN 1 ELSE 0 END AS l_quantity" if c == "l_quantity" else c
                       for c, _ in SCHEMAS["lineitem"])
    o["content_diff_sketch"] = f"""WITH marked AS (
  SELECT *, substring(md5(l_orderkey || ':' || l_linenumber), 1, 2) AS first FROM lineitem),
target AS (SELECT {copied} FROM marked WHERE first <> '00' UNION ALL SELECT {copied} FROM marked WHERE first = '01'),
counted AS (SELECT {lines}, sum(side) AS n FROM (SELECT *, 1 AS side FROM lineitem UNION ALL SELECT *, -1 FROM target)
  GROUP BY {lines})
SELECT {lines}, CASE WHEN n > 0 THEN 'missing' ELSE 'extra' END AS status, CAST(abs(n) AS BIGINT) AS n_rows
FROM counted WHERE n <> 0"""
    o["content_diff_sketch_full"] = o["content_diff_sketch"]
    o["content_diff_digest"] = o["content_diff"]
    o["content_diff_exact"] = o["content_diff"]
    ovals = [c for c, _ in SCHEMAS["orders"] if c != "o_orderkey"]
    ochanged = "concat_ws(',', " + ", ".join(
        f"CASE WHEN s.{c} IS DISTINCT FROM t.{c} THEN '{c}' END" for c in ovals
    ) + ")"
    o["limit_n"] = "SELECT least(100, count(*)) AS n_rows, least(100, count(*)) AS n_keys, least(100, count(*)) AS n_known FROM orders"
    o["sample_diff"] = f"""SELECT s.o_orderkey,
  CASE WHEN t.o_orderkey IS NULL THEN 'missing' WHEN {ochanged} <> '' THEN 'changed' ELSE 'match' END AS status,
  CASE WHEN t.o_orderkey IS NOT NULL AND {ochanged} <> '' THEN {ochanged} END AS changed_columns
FROM (SELECT * FROM orders ORDER BY md5('sample:' || CAST(o_orderkey AS VARCHAR)), o_orderkey LIMIT 100) s
LEFT JOIN {damaged('orders')} t ON s.o_orderkey = t.o_orderkey"""
    o["boundary_rows"] = f"""WITH {pages_cte()}, tgt AS (SELECT o_orderkey FROM {damaged('orders')})
SELECT batch_no, first_key, last_key,
  EXISTS (SELECT 1 FROM tgt WHERE o_orderkey = first_key) AS first_present,
  EXISTS (SELECT 1 FROM tgt WHERE o_orderkey = last_key) AS last_present,
  EXISTS (SELECT 1 FROM tgt WHERE o_orderkey = first_key) AND EXISTS (SELECT 1 FROM tgt WHERE o_orderkey = last_key)
    AS batch_ok
FROM pages"""
    o["boundary_rows_composite"] = """WITH tgt AS (SELECT conv_id, turn FROM conversations
  WHERE substring(md5(conv_id || ':' || turn), 1, 1) <> '0'),
numbered AS (SELECT conv_id, turn, row_number() OVER (ORDER BY conv_id, turn) AS rn FROM conversations),
pages AS (SELECT (rn - 1) // 100 + 1 AS batch_no, arg_min(conv_id, rn) AS conv_id, arg_min(turn, rn) AS turn,
  arg_max(conv_id, rn) AS last_conv_id, arg_max(turn, rn) AS last_turn FROM numbered GROUP BY 1),
looked AS (SELECT *, EXISTS (SELECT 1 FROM tgt t WHERE t.conv_id = p.conv_id AND t.turn = p.turn) AS first_present,
  EXISTS (SELECT 1 FROM tgt t WHERE t.conv_id = p.last_conv_id AND t.turn = p.last_turn) AS last_present FROM pages p)
SELECT *, first_present AND last_present AS batch_ok FROM looked"""
    o["orphan_rows"] = _orphans()
    plan_vals = ", ".join(f"({i}, {_q(t)})" for i, t in enumerate(PLAN, start=1))
    plan_rows = (
        f"SELECT t AS table_name, CAST(p AS INTEGER) AS pos FROM (VALUES {plan_vals}) v(p, t) "
        f"UNION ALL SELECT 'customer_' || c_custkey, CAST(c_custkey + {len(PLAN) + 1} AS INTEGER) FROM customer WHERE c_custkey % 4 = 0"
    )
    o["remaining_tables"] = (
        f"SELECT table_name FROM ({tgt_list}) WHERE table_name NOT IN (SELECT table_name FROM ({plan_rows}))"
    )
    o["planned_tables"] = (
        f"SELECT table_name, pos FROM ({plan_rows}) WHERE table_name IN (SELECT table_name FROM ({tgt_list}))"
    )
    o["sample_rows"] = "SELECT * FROM orders ORDER BY md5('sample:' || CAST(o_orderkey AS VARCHAR)), o_orderkey LIMIT 100"
    o["transfer_table"] = (
        "SELECT 'dbo.orders' AS source_table, 'dbo_orders' AS target_table, true AS success, "
        "count(*) AS row_count, CAST(NULL AS VARCHAR) AS error FROM orders"
    )
    o["transfer_all"] = _transfer_rows()
    o["transfer_all_single_pass"] = _transfer_rows()
    o["transfer_transactional"] = _transfer_rows()
    o["run_summary"] = (
        f"SELECT CAST(count(*) FILTER (WHERE success) AS BIGINT) AS success_count, "
        f"CAST(count(*) FILTER (WHERE NOT success) AS BIGINT) AS fail_count, count(*) AS table_count, "
        f"CAST(sum(row_count) AS BIGINT) AS total_rows, '' AS failed_tables FROM ({_transfer_rows()})"
    )
    o["migrate_table"] = (
        "SELECT 'orders' AS table_name, count(*) AS total_records, count(*) AS migrated_rows, "
        "CAST(ceil(count(*) / 1000) AS BIGINT) AS batches, true AS success, CAST(NULL AS VARCHAR) AS error FROM orders"
    )
    o["migrate_database"] = _migration_rows()
    o["migration_verdict"] = (
        f"SELECT count(*) AS total_tables, count(*) FILTER (WHERE structure_ok) AS structures_ok, "
        f"count(*) FILTER (WHERE data_ok) AS data_ok, '' AS failed_tables, 'all' AS verdict, true AS success, "
        f"true AS strict_success FROM ({_migration_rows()})"
    )
    o["batch_progress"] = f"""WITH {pages_cte()}
SELECT 'orders' AS table_name, batch_no, n_rows,
  CAST(sum(n_rows) OVER (ORDER BY batch_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS rows_done,
  CAST(sum(n_rows) OVER () AS BIGINT) AS total_rows,
  least(CAST(100.0 AS DOUBLE) * CAST(batch_no AS DOUBLE) * CAST(1000.0 AS DOUBLE)
        / CAST(sum(n_rows) OVER () AS DOUBLE), CAST(100.0 AS DOUBLE)) AS percent,
  batch_no % 50 = 0 OR batch_no = max(batch_no) OVER () AS logged
FROM pages"""
    same = _validation_rows(ALL, source=lambda t: t, target=lambda t: t)
    o["validate_action"] = same
    maint = " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS row_count, 'optimized' AS status FROM {t}" for t in ALL
    )
    o["maintenance_report"] = maint
    o["optimize_action"] = maint
    o["run_all"] = " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, true AS data_ok, count(*) AS migrated_rows, true AS data_consistency, "
        f"'optimized' AS status FROM {t}" for t in ALL
    )
    o["validation_report"] = f"SELECT table_name, {_html()} AS html_row FROM ({_validation_rows()})"
    o["error_log_json"] = f"""WITH paged AS (
  SELECT CAST((row_number() OVER (ORDER BY doc_id) - 1) // 1000 + 1 AS BIGINT) AS batch_no,
         {reasons} AS reject_reasons FROM documents),
errs AS (SELECT batch_no, count(*) FILTER (WHERE reject_reasons IS NOT NULL) AS n FROM paged GROUP BY batch_no)
SELECT 'documents' AS table_name, batch_no AS batch_number,
  '{{"table_name":"documents","batch_number":' || batch_no || ',"error_message":"' || n || ' rows rejected"}}' AS json
FROM errs WHERE n > 0"""
    return o


ORACLES: dict[str, str] = _build()
