"""Keys and references read from the data, for sources whose catalog declares none (S10, S11, J1), and the load order that
follows from them (T2, JOB3).

* :func:`minimal_keys`: minimal unique column combinations, level by level over the lattice of column sets. A bounded sample
  refutes most candidates (two equal rows anywhere disprove a key), slices by the hash of a column, each larger than the one
  before, most of the others; what they leave is checked on all rows.
* :func:`inclusion_dependencies`: every value is grouped to the set of columns that hold it; a column is included in
  another if all sets that hold the one hold the other. One shuffle of distinct values for all columns of all tables.
* :func:`reference_candidates`: inclusions into single-column keys, with a mark for names that agree;
  :func:`key_usage` gives keys and references in the catalog's form, so that S10 and S11 read them like declared ones.
* :func:`load_levels`: topological levels of the reference graph by joins; tables that refer to each other in a ring form one
  component, which is named and takes one level.
"""

from __future__ import annotations

from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableferry.session import materialize
from tableferry.sources.tables import Database

#: Rows of a table that may refute key candidates on the driver; a hint that saves work, never a decision for a key.
SAMPLE_ROWS = 10_000
#: Rows of the first slice by hash that may refute key candidates, how much larger each next slice is, and the parts of
#: a table below which a slice saves nothing against all rows.
SLICE_ROWS = 50_000
SLICE_GROWTH = 16
LEAST_PARTS = 4
#: Characters of a text's extremes that are compared when inclusions are ruled out.
EXTREME_CHARS = 64
KEYS_SCHEMA = "table_name string, key_columns string, size int"
INCLUSION_SCHEMA = "child_table string, child_column string, parent_table string, parent_column string, n_values bigint"


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


def _family(kind: T.DataType) -> str | None:
    """Types whose values can be compared with each other; None for nested types, which are neither keys nor references."""
    if isinstance(kind, T.IntegralType):
        return "int"
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return "float"
    if isinstance(kind, (T.StringType, T.CharType, T.VarcharType)):
        return "text"
    if isinstance(kind, T.DecimalType):
        return f"decimal{kind.scale}"
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType, T.BinaryType)):
        return kind.simpleString()
    return None


def _value(kind: T.DataType, name: str) -> Column:
    """A cell as short text that is equal for equal values of a family: long texts and bytes by their MD5."""
    family = _family(kind)
    if family == "text":
        return F.when(F.octet_length(_c(name)) > 32, F.concat(F.lit("#"), F.md5(_c(name).cast("binary")))).otherwise(F.concat(F.lit("'"), _c(name)))
    if family == "binary":
        return F.md5(_c(name))
    if family == "float":
        return (_c(name).cast("double") + F.lit(0.0)).cast("string")  # -0.0 equals 0.0
    return _c(name).cast("string")


# --------------------------------------------------------------------------- S10


def _next_level(failed: set[frozenset], keys: list[frozenset], size: int) -> list[frozenset]:
    """Column sets of ``size`` whose smaller parts are all no keys."""
    columns = sorted({c for f in failed for c in f})
    if size == 1:
        return []
    found = set()
    for f in failed:
        for c in columns:
            s = f | {c}
            if len(s) == size and all(s - {x} in failed for x in s):
                found.add(s)
    return sorted((s for s in found if not any(k <= s for k in keys)), key=sorted)


def _native(kind: T.DataType, name: str) -> Column:
    """A cell that groups and hashes like :func:`_value`: numbers and times as they are, texts and bytes short."""
    family = _family(kind)
    if family == "float":
        return F.when(F.isnan(_c(name)), F.lit(float("nan"))).otherwise(_c(name).cast("double") + F.lit(0.0))
    return _value(kind, name) if family in ("text", "binary") else _c(name)


def _repeats(df: DataFrame, cells: list[Column]) -> bool:
    """Whether two of all rows are equal in ``cells``: by their hashes, and where two agree by the cells themselves."""
    digest = F.xxhash64(*cells)
    witness = df.groupBy(digest.alias("h")).agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(1).collect()
    if not witness:
        return False

    def found(part: DataFrame) -> bool:
        return not part.groupBy(*cells).agg(F.count(F.lit(1)).alias("__n")).where("__n > 1").limit(1).isEmpty()

    return found(df.where(digest == witness[0]["h"])) or found(df)


def _keys_of(df: DataFrame, max_size: int, sample_rows: int, slice_rows: int) -> list[list[str]]:
    order = [f.name for f in df.schema.fields if _family(f.dataType) is not None]
    if not order:
        return []
    kinds = {f.name: f.dataType for f in df.schema.fields}
    cells = {c: _native(kinds[c], c) for c in order}
    texts = {c: _value(kinds[c], c) for c in order}
    told = df.agg(F.count(F.lit(1)).alias("n"), *[F.count(_c(c)).alias(f"c{i}") for i, c in enumerate(order)], *[F.approx_count_distinct(_c(c)).alias(f"d{i}") for i, c in enumerate(order)]).first()
    rows = told["n"]
    # A key column takes no NULL.
    columns = [c for i, c in enumerate(order) if told[f"c{i}"] == rows]
    distinct = {c: told[f"d{i}"] * 1.5 + 10 for i, c in enumerate(order)}  # far above the sketch's error of 5 %
    sample = df.select(*[texts[c].alias(f"k{order.index(c)}") for c in columns]).limit(sample_rows).toPandas()

    def refuted(s: frozenset) -> bool:
        return bool(sample.duplicated([f"k{order.index(c)}" for c in s]).any())

    def in_slice(sets: list[frozenset], parts: int) -> list[frozenset]:
        """The sets without two equal rows among those whose most diverse column falls into one of ``parts`` parts by its hash;
        equal rows fall into the same part, so what is found is two equal rows of the table. One pass for all sets."""
        anchors = {s: max(sorted(s), key=distinct.get) for s in sets}
        hit = {c: F.pmod(F.xxhash64(F.lit(parts), cells[c]), F.lit(parts)) == 0 for c in set(anchors.values())}
        told = F.array(*[F.when(hit[anchors[s]], F.struct(F.lit(i).alias("i"), F.array(*[texts[c] for c in sorted(s)]).alias("k"))) for i, s in enumerate(sets)])
        seen = df.where(reduce(Column.__or__, hit.values())).select(F.inline(F.array_compact(told)))
        twice = {r["i"] for r in seen.groupBy("i", "k").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("i").distinct().collect()}
        return [s for i, s in enumerate(sets) if i not in twice]

    keys: list[frozenset] = []
    level = [frozenset([c]) for c in columns]
    for size in range(1, max_size + 1):
        # Fewer combinations than rows can't be unique; neither can what repeats in the sample or in a slice.
        open_ = [s for s in level if _fits(s, distinct, rows) and not refuted(s)]
        parts = rows // slice_rows
        while open_ and parts >= LEAST_PARTS:
            open_ = in_slice(open_, parts)
            parts //= SLICE_GROWTH
        with ThreadPoolExecutor(max_workers=4) as pool:
            unique = [s for s, twice in zip(open_, pool.map(lambda s: _repeats(df, [cells[c] for c in sorted(s)]), open_)) if not twice]
        keys += unique
        level = _next_level(set(level) - set(unique), keys, size + 1)
        if not level:
            break
    return [sorted(k, key=order.index) for k in keys]


def _fits(columns: Iterable[str], distinct: dict[str, float], rows: int) -> bool:
    combined = 1.0
    for c in columns:
        combined *= distinct[c]
    return combined >= rows


def minimal_keys(spark: SparkSession, db: Database, max_size: int = 3, sample_rows: int = SAMPLE_ROWS, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """(table_name, key_columns, size): every set of up to ``max_size`` columns without NULLs that no two rows share and of which no
    smaller part is one; columns comma-joined in table order. Every single column of an empty or one-row table is a key."""
    names = db.names()
    with ThreadPoolExecutor(max_workers=4) as pool:
        found = pool.map(lambda t: _keys_of(db.table(t), max_size, sample_rows, slice_rows), names)
        rows = [(t, ",".join(k), len(k)) for t, keys in zip(names, found) for k in keys]
    return spark.createDataFrame(rows, KEYS_SCHEMA)


# --------------------------------------------------------------------------- S11, J1


def _extremes(df: DataFrame, columns: list[str]) -> dict[str, tuple]:
    """The smallest and largest value of each column (texts cut), None for a column without values; one aggregate."""
    def end(c: str, f) -> Column:
        kind = df.schema[c].dataType
        if _family(kind) == "text":
            return f(F.substring(_c(c), 1, EXTREME_CHARS))
        if _family(kind) == "float":
            return f(F.when(~F.isnan(_c(c)), _c(c).cast("double")))
        return f(_c(c))

    row = df.agg(*[end(c, f).alias(f"{n}{i}") for i, c in enumerate(columns) for n, f in (("lo", F.min), ("hi", F.max))], *[F.count(_c(c)).alias(f"n{i}") for i, c in enumerate(columns)]).first()
    return {c: (row[f"lo{i}"], row[f"hi{i}"]) for i, c in enumerate(columns) if row[f"n{i}"]}


def inclusion_dependencies(spark: SparkSession, db: Database) -> DataFrame:
    """(child_table, child_column, parent_table, parent_column, n_values): every pair of columns of one type family, in one
    table or two, where each distinct value of the child is one of the parent's; NULLs play no part, a column without values is no child.

    Columns that no other's extremes can enclose or be enclosed by are left out of the pass over the values."""
    numbered: list[tuple[str, str, str]] = []
    ends: dict[int, tuple] = {}
    names = db.names()

    def profiled(t: str) -> dict:
        columns = [f.name for f in db.table(t).schema.fields if _family(f.dataType) is not None]
        return _extremes(db.table(t), columns) if columns else {}

    with ThreadPoolExecutor(max_workers=8) as pool:
        found = dict(zip(names, pool.map(profiled, names)))
    for t in names:
        for c, e in found[t].items():
            ends[len(numbered)] = e
            numbered.append((t, c, _family(db.table(t).schema[c].dataType)))

    def possible(a: int, b: int) -> bool:
        if a == b or numbered[a][2] != numbered[b][2]:
            return False
        (lo, hi), (p_lo, p_hi) = ends[a], ends[b]
        if None in (lo, hi, p_lo, p_hi):  # only NaN in one of them: the values decide
            return True
        return p_lo <= lo and hi <= p_hi

    pairs = [(a, b) for a in ends for b in ends if possible(a, b)]
    used = {x for p in pairs for x in p}
    parts = []
    for t in names:
        mine = [i for i in used if numbered[i][0] == t]
        if mine:
            kinds = {i: db.table(t).schema[numbered[i][1]].dataType for i in mine}
            cells = F.array(*[F.struct(F.lit(i).alias("col"), F.concat(F.lit(f"{numbered[i][2]}:"), _value(kinds[i], numbered[i][1])).alias("value")) for i in mine])
            parts.append(db.table(t).select(F.inline(cells)).where("value IS NOT NULL").distinct())
    if not pairs:
        return spark.createDataFrame([], INCLUSION_SCHEMA)
    values = reduce(DataFrame.unionByName, parts)
    # At most one row for each column and value is left, so a frequent value is no crowd; then a row for each set of columns.
    sets = values.groupBy("value").agg(F.sort_array(F.collect_list("col")).alias("cols")).groupBy("cols").agg(F.count(F.lit(1)).alias("n"))
    both = sets.select("n", "cols", F.explode("cols").alias("a")).select("n", "a", F.explode("cols").alias("b"))
    shared = both.groupBy("a", "b").agg(F.sum("n").alias("n"))
    total = shared.where("a = b").select("a", F.col("n").alias("n_values"))
    included = shared.where("a <> b").join(total, "a").where("n = n_values")
    told = spark.createDataFrame([(i, t, c) for i, (t, c, _) in enumerate(numbered)], "i int, t string, c string")
    child = told.select(F.col("i").alias("a"), F.col("t").alias("child_table"), F.col("c").alias("child_column"))
    parent = told.select(F.col("i").alias("b"), F.col("t").alias("parent_table"), F.col("c").alias("parent_column"))
    return included.join(child, "a").join(parent, "b").select("child_table", "child_column", "parent_table", "parent_column", "n_values")


def _stem(column: str) -> Column:
    """A column's name without a prefix of one or two letters."""
    return F.regexp_replace(F.lower(column), "^[a-z]{1,2}_", "")


def reference_candidates(inclusions: DataFrame, keys: DataFrame) -> DataFrame:
    """Inclusions of another table's column in a single-column key, with ``same_name``: names equal but for a short prefix."""
    single = keys.where("size = 1").select(F.col("table_name").alias("parent_table"), F.col("key_columns").alias("parent_column"))
    found = inclusions.where("child_table <> parent_table").join(single, ["parent_table", "parent_column"])
    return found.withColumn("same_name", _stem("child_column") == _stem("parent_column")).select(
        "child_table", "child_column", "parent_table", "parent_column", "n_values", "same_name"
    )


def key_usage(schema: str, keys: DataFrame, references: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(key_column_usage, referential_constraints) in the catalog's form: of each table its shortest key (ties: by name) as
    ``PK_<table>``, and each reference with agreeing names to such a key as ``FK_<table>_<column>``."""
    first = keys.groupBy("table_name").agg(F.min(F.struct("size", "key_columns")).alias("k"))
    named = F.concat(F.lit("PK_"), "table_name")
    pk = first.select(
        F.lit(schema).alias("table_schema"), "table_name", named.alias("constraint_name"),
        F.posexplode(F.split("k.key_columns", ",")).alias("p", "column_name"),
    ).select("table_schema", "table_name", "column_name", "constraint_name", (F.col("p") + 1).alias("ordinal_position"))
    parents = first.where("k.size = 1").select(F.col("table_name").alias("parent_table"), F.col("k.key_columns").alias("parent_column"))
    fk = references.where("same_name").join(parents, ["parent_table", "parent_column"]).select(
        "child_table", "child_column", F.concat_ws("_", F.lit("FK"), "child_table", "child_column", "parent_table").alias("constraint_name"),
        F.concat(F.lit("PK_"), "parent_table").alias("unique_constraint_name"),
    )
    usage = pk.unionByName(fk.select(
        F.lit(schema).alias("table_schema"), F.col("child_table").alias("table_name"), F.col("child_column").alias("column_name"),
        "constraint_name", F.lit(1).alias("ordinal_position"),
    ))
    return usage, fk.select("constraint_name", "unique_constraint_name")


# --------------------------------------------------------------------------- T2, JOB3


def _rings(edges: DataFrame) -> DataFrame:
    """(table_name, ring) of the tables that refer to each other in a ring; ring: its smallest name. Pairs that reach each other,
    by doubling the length of the paths in each round."""
    reach = materialize(edges.select(F.col("child").alias("x"), F.col("parent").alias("y")).distinct())
    n = reach.count()
    while True:
        longer = reach.alias("p").join(reach.alias("q"), F.col("p.y") == F.col("q.x")).select(F.col("p.x").alias("x"), F.col("q.y").alias("y"))
        reach = materialize(reach.unionByName(longer).distinct())
        m = reach.count()
        if m == n:
            break
        n = m
    back = reach.select(F.col("x").alias("y"), F.col("y").alias("x"))
    return reach.join(back, ["x", "y"], "left_semi").groupBy(F.col("x").alias("table_name")).agg(F.min("y").alias("ring"))


def load_levels(tables: DataFrame, references: DataFrame) -> DataFrame:
    """(table_name, level, ring): parents stand on lower levels than their children, tables without parents on level 0.

    ``tables``: table_name; ``references``: child_table, parent_table. References to tables that are not listed or to the table
    itself set no order. Tables of a ring share its level; ``ring`` is the smallest name among them, else null.

    Metadata of a catalog: one join and one checkpoint for each level, nothing on the driver."""
    listed = tables.select("table_name").distinct()
    edges = references.select(F.col("child_table").alias("child"), F.col("parent_table").alias("parent")).where("child <> parent").distinct()
    edges = edges.join(listed.select(F.col("table_name").alias("child")), "child", "left_semi").join(listed.select(F.col("table_name").alias("parent")), "parent", "left_semi")
    edges = materialize(edges)

    def peeled(open_: DataFrame, by: str, at: str) -> DataFrame:
        """The references that are left once tables without any at the ``by`` end are taken away, again and again."""
        while True:
            left = materialize(open_.join(open_.select(F.col(by).alias(at)).distinct(), at, "left_semi"))
            if left.count() == open_.count():
                return left
            open_ = left

    # Only what stays after taking away first and last tables, round by round, can be in a ring.
    core = peeled(peeled(edges, "child", "parent"), "parent", "child")
    rings = materialize(_rings(core)) if not core.isEmpty() else tables.sparkSession.createDataFrame([], "table_name string, ring string")
    nodes = materialize(listed.join(rings, "table_name", "left").withColumn("node", F.coalesce("ring", "table_name")))
    of = nodes.select("table_name", "node")
    between = edges.join(of.select(F.col("table_name").alias("child"), F.col("node").alias("c")), "child").join(of.select(F.col("table_name").alias("parent"), F.col("node").alias("p")), "parent")
    between = materialize(between.where("c <> p").select("c", "p").distinct())
    level, found, open_ = 0, None, materialize(nodes.select("node").distinct())
    while not open_.isEmpty():
        waiting = between.join(open_.select(F.col("node").alias("p")), "p", "left_semi").select(F.col("c").alias("node")).distinct()
        now = materialize(open_.join(waiting, "node", "left_anti").withColumn("level", F.lit(level)))
        found = now if found is None else found.unionByName(now)
        open_ = materialize(open_.join(now, "node", "left_anti"))
        level += 1
    if found is None:
        return tables.sparkSession.createDataFrame([], "table_name string, level int, ring string")
    return nodes.join(found, "node").select("table_name", "level", "ring")
