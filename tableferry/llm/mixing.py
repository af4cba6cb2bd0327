"""Operator 4, mixing sources to target weights: hierarchical budgeting, in DataFrame operations only.

The rows form a tree, by default domain - language - source. A node's budget is dealt to its children by their weights; a child
whose rows cannot use its share (its capacity is its tokens times :data:`MAX_EPOCHS`) keeps its capacity, and what it leaves goes to its
siblings. Only what all siblings together cannot use comes back to their parent's siblings, since a parent's capacity is the sum
of its children's. Each level is dealt by windows over the children of one parent: ordered by capacity per weight,
the first ones are full as long as their capacity is below their share of what is left. All in whole tokens.

A leaf takes whole epochs of its rows and, of the last epoch, a prefix of as many tokens as are left, in the order of a hash
seeded with the epoch. The prefix's end is found from sums over ranges of the hash, so that only one range of a leaf is ever
ordered, and stays one cut-off key per leaf: a large leaf is never gathered.

Defined results: null and blank texts have no tokens and are never taken; a null level is a child named ``(none)``; equal rows
(id and text) share a key and go in together or not at all; a weight that is not given is 1; an empty table gives no rows; a key's
32 hex digits and the tokens times the weights must fit (tokens x sum of weights below 2**63).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tableferry.llm.textkit import read_table, stored

MAX_EPOCHS = 3
#: Rows of a leaf in one range of the hash, about.
RANGE_ROWS = 2000
SPACE = 1 << 28


def tokens(text: Column) -> Column:
    """Words between white space."""
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def _weight(level: str, weights: dict[str, dict[str, int]]) -> Column:
    out = F.lit(1).cast("long")
    for name, weight in weights.get(level, {}).items():
        out = F.when(F.col(level) == name, F.lit(weight).cast("long")).otherwise(out)
    return out


def budgets(leaves: DataFrame, levels: list[str], weights: dict[str, dict[str, int]], share: float, max_epochs: int) -> DataFrame:
    """``leaves`` (levels, n_tokens, n_rows) with ``budget``: whole tokens, ``share`` of all tokens in sum if the capacities allow."""
    percent = round(100 * share)
    tree = leaves.withColumn("capacity", F.col("n_tokens") * max_epochs).withColumn("budget", F.expr(f"(sum(n_tokens) over ()) * {percent} div 100"))
    for depth, level in enumerate(levels):
        above, own = levels[:depth], levels[: depth + 1]
        # One row for each child of the level: its capacity, its weight, the budget of its parent.
        child = tree.groupBy(*own).agg(F.sum("capacity").alias("c"), F.max("budget").alias("b")).withColumn("w", _weight(level, weights))
        parent = Window.partitionBy(*(above or [F.lit(0)]))
        order = parent.orderBy(F.col("c") / F.col("w"), level)
        before = order.rowsBetween(Window.unboundedPreceding, -1)
        after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
        child = child.withColumn("taken", F.coalesce(F.sum("c").over(before), F.lit(0))).withColumn("rest", F.sum("w").over(after))
        child = child.withColumn("full", F.col("c") * F.col("rest") <= (F.col("b") - F.col("taken")) * F.col("w"))
        child = child.withColumn("left", F.col("b") - F.coalesce(F.sum(F.when(F.col("full"), F.col("c"))).over(parent), F.lit(0)))
        child = child.withColumn("open", F.sum(F.when(~F.col("full"), F.col("w"))).over(parent))
        upto = F.coalesce(F.sum(F.when(~F.col("full"), F.col("w"))).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)), F.lit(0))
        child = child.withColumn("upto", upto)
        # Differences of running shares: they add up to what is left.
        part = F.expr("CASE WHEN full THEN c ELSE left * upto div open - left * (upto - w) div open END").alias("budget")
        dealt = child.select(*(F.col(x).alias(f"__{x}") for x in own), part)
        same = [F.col(x) == F.col(f"__{x}") for x in own]
        tree = tree.drop("budget").join(dealt, same).drop(*(f"__{x}" for x in own))
    return tree.drop("capacity")


def order_key(seed: int, epoch: Column, doc_id: Column, digest: Column) -> Column:
    return F.md5(F.concat_ws(":", F.lit(seed).cast("string"), epoch.cast("string"), F.coalesce(doc_id.cast("string"), F.lit("")), digest).cast("binary"))


def mix(docs: DataFrame, levels: list[str], weights: dict[str, dict[str, int]], share: float, max_epochs: int = MAX_EPOCHS, seed: int = 17, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(rows: levels, doc_id, digest of the text, n_tokens; leaves: levels, n_tokens, n_rows, budget, epochs, cutoff).

    A row is taken ``epochs`` times, and once more if its key of epoch number ``epochs`` is not above ``cutoff``."""
    digest = F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary"))
    rows = docs.select(*(F.coalesce(F.col(x).cast("string"), F.lit("(none)")).alias(x) for x in levels), F.col(doc_id).alias("doc_id"), digest.alias("digest"), tokens(F.col(text)).alias("n_tokens"))
    rows = stored(rows.where("n_tokens > 0"), "tokens")
    leaves = rows.groupBy(*levels).agg(F.sum("n_tokens").alias("n_tokens"), F.count("*").alias("n_rows"))
    leaves = budgets(stored(leaves, "leaves"), levels, weights, share, max_epochs)
    leaves = stored(leaves.withColumns({"epochs": F.expr("budget div n_tokens"), "rest": F.expr("budget % n_tokens"), "ranges": F.expr(f"n_rows div {RANGE_ROWS} + 1")}), "budgets")
    keyed = rows.join(leaves.select(*levels, "epochs", "rest", "ranges"), levels).where("rest > 0")
    keyed = keyed.withColumn("key", order_key(seed, F.col("epochs"), F.col("doc_id"), F.col("digest")))
    keyed = keyed.withColumn("range", F.expr(f"cast(conv(substring(key, 1, 7), 16, 10) as bigint) * ranges div {SPACE}")).select(*levels, "rest", "range", "key", "n_tokens")
    sums = keyed.groupBy(*levels, "rest", "range").agg(F.sum("n_tokens").alias("s"))
    upto = F.sum("s").over(Window.partitionBy(*levels).orderBy("range"))
    edge = stored(sums.withColumn("upto", upto).where("upto - s <= rest AND upto > rest").select(*levels, "range", (F.col("upto") - F.col("s")).alias("before")), "edges")
    inside = keyed.join(edge, [*levels, "range"]).groupBy(*levels, "range", "rest", "before", "key").agg(F.sum("n_tokens").alias("n"))
    running = F.sum("n").over(Window.partitionBy(*levels, "range").orderBy("key"))
    last = inside.withColumn("sum", F.col("before") + running).where("sum <= rest").groupBy(*levels).agg(F.max("key").alias("last"))
    # Where the edge range starts behind the prefix's end, all keys below the range belong to it.
    floor_ = edge.join(leaves.select(*levels, "ranges"), levels).withColumn("floor", F.lower(F.lpad(F.hex(F.expr(f"(range * {SPACE} + ranges - 1) div ranges")), 7, "0")))
    cut = floor_.join(last, levels, "left").select(*levels, F.coalesce("last", "floor").alias("cutoff"))
    return rows, stored(leaves.join(cut, levels, "left").select(*levels, "n_tokens", "n_rows", "budget", "epochs", "cutoff"), "cutoffs")


def epochs(seed: int = 17) -> Column:
    """How often a row joined with its leaf is taken."""
    key = order_key(seed, F.col("epochs"), F.col("doc_id"), F.col("digest"))
    return F.col("epochs") + F.coalesce((key <= F.col("cutoff")).cast("long"), F.lit(0))


#: Weights of the registered query; the domain of a source is a fixed function of its name.
WEIGHTS = {"domain": {"web": 5, "books": 3, "code": 2}, "lang": {"en": 6, "fr": 3, "de": 3, "es": 2}, "source": {"src0": 4}}
LEVELS = ["domain", "lang", "source"]
SHARE = 0.9


def with_domain(docs: DataFrame) -> DataFrame:
    first = F.substring(F.md5(F.coalesce("source", F.lit("")).cast("binary")), 1, 1)
    return docs.withColumn("domain", F.when(first < "6", "web").when(first < "b", "books").otherwise("code"))


def q_op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, leaves = mix(with_domain(read_table(spark, sf_dir, "documents")), LEVELS, WEIGHTS, SHARE)
    taken = rows.join(leaves.drop("n_tokens"), LEVELS).withColumn("n_epochs", epochs())
    return taken.where("n_epochs > 0").select("doc_id", *LEVELS, "n_tokens", F.col("budget").alias("leaf_budget"), "n_epochs")


def _sql_level(depth: int) -> str:
    own, level = LEVELS[: depth + 1], LEVELS[depth]
    cases = " ".join(f"WHEN '{k}' THEN {v}" for k, v in WEIGHTS[level].items())
    part = f"PARTITION BY {', '.join(LEVELS[:depth])}" if depth else ""
    return f"""
c{depth} AS (
  SELECT {', '.join(own)}, CAST(sum(n_tokens) * {MAX_EPOCHS} AS BIGINT) AS c, max(budget) AS b, CASE {level} {cases} ELSE 1 END AS w
  FROM t{depth} GROUP BY {', '.join(own)}),
o{depth} AS (
  SELECT *, CAST(coalesce(sum(c) OVER (k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS taken,
    CAST(sum(w) OVER (k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS BIGINT) AS rest
  FROM c{depth} WINDOW k AS ({part} ORDER BY c / w, {level})),
f{depth} AS (SELECT *, c * rest <= (b - taken) * w AS is_full FROM o{depth}),
l{depth} AS (
  SELECT *, CAST(b - coalesce(sum(c) FILTER (is_full) OVER ({part}), 0) AS BIGINT) AS spare, CAST(sum(w) FILTER (NOT is_full) OVER ({part}) AS BIGINT) AS open_w,
    CAST(coalesce(sum(w) FILTER (NOT is_full) OVER ({part} ORDER BY c / w, {level} ROWS UNBOUNDED PRECEDING), 0) AS BIGINT) AS upto
  FROM f{depth}),
t{depth + 1} AS (
  SELECT t.* EXCLUDE (budget), CASE WHEN is_full THEN c ELSE spare * upto // open_w - spare * (upto - w) // open_w END AS budget
  FROM t{depth} t JOIN l{depth} USING ({', '.join(own)}))"""


OP4_SQL = f"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '(none)') AS lang, coalesce(source, '(none)') AS source,
    CASE WHEN substr(md5(coalesce(source, '')), 1, 1) < '6' THEN 'web' WHEN substr(md5(coalesce(source, '')), 1, 1) < 'b' THEN 'books' ELSE 'code' END AS domain,
    md5(coalesce(text, '')) AS digest, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS n_tokens
  FROM documents),
r AS (SELECT * FROM d WHERE n_tokens > 0),
leaf AS (SELECT domain, lang, source, CAST(sum(n_tokens) AS BIGINT) AS n_tokens FROM r GROUP BY ALL),
t0 AS (SELECT *, CAST(sum(n_tokens) OVER () * {round(100 * SHARE)} // 100 AS BIGINT) AS budget FROM leaf),{','.join(map(_sql_level, range(3)))},
e AS (SELECT domain, lang, source, n_tokens AS leaf_tokens, budget, budget // n_tokens AS epochs, budget % n_tokens AS rest FROM t3),
k AS (SELECT r.*, budget, epochs, rest, md5(concat('17:', epochs, ':', coalesce(CAST(doc_id AS VARCHAR), ''), ':', digest)) AS key FROM r JOIN e USING (domain, lang, source)),
s AS (SELECT *, sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY key RANGE UNBOUNDED PRECEDING) AS upto FROM k)
SELECT doc_id, domain, lang, source, n_tokens, budget AS leaf_budget, CAST(epochs + CASE WHEN upto <= rest THEN 1 ELSE 0 END AS BIGINT) AS n_epochs
FROM s WHERE epochs + CASE WHEN upto <= rest THEN 1 ELSE 0 END > 0
"""
