"""Mixing sources to target weights by hierarchical budgeting, with DataFrame functions only.

The levels (domain, language, source) form a tree. From the root down, a node's token budget is split over its
children by weight; a child whose subtree cannot hold its share (all its tokens, `epochs` times) takes what it holds,
and the shortage goes to its siblings by weight. Only what the whole node cannot hold stays with the node's parent,
whose other children get it: siblings come before ancestors. Shares are whole tokens, rounded down.

A leaf with budget b and s tokens takes every document b div s times, and of one more epoch the documents that stand
first in that epoch's seeded order, while their tokens sum to at most b mod s. The order is the MD5 of seed, epoch and
doc_id. Its first three digits cut a leaf into 4096 buckets: running sums go over buckets, and only in the one bucket that
the budget ends in are documents put in order. There rows of one doc_id and length are counted, not sorted; where only some
of them fit, those are picked by running counts over 4096 slices of their row numbers. So neither a leaf nor a document
number with a third of all rows is one task.

Edge cases: NULL in a level is the node ''; a NULL doc_id sorts as the text ''; documents without words (NULL or
empty text) are never taken; equal hashes (repeated rows) are ordered by token count, and of rows that agree in that as
well as many are taken as fit; a node of weight 0 gets nothing; an empty table or a budget of 0 gives no rows. Columns
besides the levels, doc_id and text are not looked at; those of `keep` come along as they are, but for names that the
result has already.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from opticlake.llm.catalog import query
from opticlake.operators.joins import join_per_key
from opticlake.session import materialize

WORD = r"[^\x20\x09-\x0D]+"
#: Leaves up to this number are sent to all executors; more are joined by a shuffle.
BROADCAST_LEAVES = 100_000

Weights = dict[tuple[str, ...], int]


def _weight_rows(spark: SparkSession, weights: Weights, levels: list[str], depth: int) -> DataFrame:
    rows = [(*path, weight) for path, weight in weights.items() if len(path) == depth]
    schema = T.StructType([T.StructField(c, T.StringType()) for c in levels[:depth]] + [T.StructField("weight", T.LongType())])
    return spark.createDataFrame(rows, schema)


def split_budget(children: DataFrame, parent: list[str], names: list[str]) -> DataFrame:
    """Children (cap, weight, budget of the parent) with `share`, their part of the budget."""
    usable = children.where((F.col("weight") > 0) & (F.col("cap") > 0))
    order = Window.partitionBy(*parent).orderBy(F.col("cap") / F.col("weight"), *names)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.partitionBy(*parent)
    left = F.col("budget") - F.coalesce(F.sum("cap").over(before), F.lit(0))
    marked = usable.withColumn("full", F.col("cap") * F.sum("weight").over(onward) <= F.col("weight") * left)
    kept = F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))).over(whole), F.lit(0))
    others = F.sum(F.when(~F.col("full"), F.col("weight"))).over(whole)
    shared = marked.withColumn("kept", kept).withColumn("others", others)
    return shared.withColumn("share", F.expr("CASE WHEN full THEN cap ELSE (weight * (budget - kept)) div others END"))


def leaf_budgets(leaves: DataFrame, levels: list[str], weights: Weights, budget: Column, epochs: int) -> DataFrame:
    """Leaves (levels, tokens) with `budget` tokens each. `budget` may use `tokens`, there the sum over all leaves."""
    spark = leaves.sparkSession
    sized = leaves.withColumn("cap", F.col("tokens") * epochs)
    total = leaves.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens")).select(budget.cast("long").alias("budget")).first()["budget"]
    above = None
    for depth in range(1, len(levels) + 1):
        path, parent = levels[:depth], levels[: depth - 1]
        nodes = sized.groupBy(*path).agg(F.sum("cap").alias("cap"))
        nodes = nodes.join(_weight_rows(spark, weights, levels, depth), path, "left").fillna({"weight": 1})
        nodes = nodes.withColumn("budget", F.lit(total)) if above is None else nodes.join(above, parent)
        above = split_budget(nodes, parent, path[-1:]).select(*path, F.col("share").alias("budget"))
    return sized.drop("cap").join(above, levels)


def mix_sources(docs: DataFrame, levels: list[str], weights: Weights, budget: Column, seed: int, epochs: int = 1,
                keep: list[str] = ()) -> DataFrame:
    """One row per taken document and epoch: doc_id, levels, epoch (from 0), n_tokens, and the columns of `keep`."""
    if any(w < 0 or w > 1000 for w in weights.values()):
        raise ValueError("weights are whole numbers from 0 to 1000")
    tokens = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    names = {"doc_id", *levels, "epoch", "n_tokens"}
    keep = [c for c in keep if c.lower() not in {n.lower() for n in names}]
    kept = [F.struct(*keep).alias("_kept")] if keep else []
    counted = materialize(
        docs.select("doc_id", *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in levels], tokens.alias("n_tokens"),
                    F.monotonically_increasing_id().alias("_row"), *kept)
        .where("n_tokens > 0"), "mix-counted")
    leaves = counted.groupBy(*levels).agg(F.sum("n_tokens").alias("tokens"))
    budgets = materialize(
        leaf_budgets(leaves, levels, weights, budget, epochs).where("budget > 0")
        .select(*levels, F.expr("budget div tokens").alias("whole"), F.expr("budget % tokens").alias("rest")), "mix-budgets")
    few = budgets.count() <= BROADCAST_LEAVES

    def per_leaf(rows: DataFrame, right: DataFrame, how: str) -> DataFrame:
        return rows.join(F.broadcast(right), levels, how) if few else join_per_key(rows, right, levels, how)

    def ordered(rows: DataFrame) -> DataFrame:
        order = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("whole").cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
        return rows.withColumn("_order", order).withColumn("_bucket", F.substring("_order", 1, 3))

    # Where a leaf's budget ends is one row of it: the rows, with all they carry, are told by that and are not exchanged.
    upto = Window.partitionBy(*levels).orderBy("_bucket")
    narrow = ordered(per_leaf(counted.select("doc_id", *levels, "n_tokens"), budgets.where("rest > 0"), "inner"))
    sums = narrow.groupBy(*levels, "rest", "_bucket").agg(F.sum("n_tokens").alias("_in"))
    ends = sums.withColumn("_start", F.sum("_in").over(upto) - F.col("_in")).where(F.col("_start") < F.col("rest"))
    ends = ends.groupBy(*levels).agg(F.max(F.struct("_bucket", "_start", "_in")).alias("_end"))
    ends = ends.select(*levels, F.col("_end._bucket").alias("_last"), F.col("_end._start").alias("_start"), F.col("_end._in").alias("_in"))
    taken = materialize(budgets.join(ends, levels, "left"), "mix-ends")
    rows = ordered(per_leaf(counted, taken, "inner"))
    # Only the bucket that a budget ends in may be one that does not fit as a whole.
    fits = (F.col("_bucket") < F.col("_last")) | ((F.col("_bucket") == F.col("_last")) & (F.col("_start") + F.col("_in") <= F.col("rest")))
    cut = _prefix(materialize(rows.where((F.col("_bucket") == F.col("_last")) & ~fits), "mix-cut"), levels)
    out = ["doc_id", *levels, "epoch", "n_tokens", *(["_kept.*"] if keep else [])]
    copies = F.col("whole") + F.coalesce(fits, F.lit(False)).cast("int")
    full = rows.withColumn("_copies", copies.cast("int")).where("_copies > 0").withColumn("epoch", F.explode(F.sequence(F.lit(0), F.col("_copies") - 1)))
    return full.select(*out).unionByName(cut.withColumn("epoch", F.col("whole").cast("int")).select(*out))


def _prefix(rows: DataFrame, levels: list[str]) -> DataFrame:
    """The rows of the buckets that budgets end in (one of each leaf) which still fit, in the order of the epoch."""
    alike = [*levels, "_order", "n_tokens"]
    running = Window.partitionBy(*levels).orderBy("_order", "n_tokens")
    counts = rows.groupBy(*alike, "_start", "rest").agg(F.count("*").alias("_c"))
    own = F.col("_c") * F.col("n_tokens")
    counts = counts.withColumn("_left", F.col("rest") - F.col("_start") - (F.sum(own).over(running) - own))
    room = counts.where("_left > 0").select(*alike, "_c", F.expr("least(_c, _left div n_tokens)").alias("_room")).where("_room > 0")
    met = join_per_key(rows, room, alike, "inner")
    whole = met.where("_c = _room").select(*rows.columns)
    # At most one group of a leaf is taken in part.
    some = met.where("_c > _room").withColumn("_slice", F.pmod(F.xxhash64("_row"), F.lit(4096)))
    upto = F.sum("_n").over(Window.partitionBy(*levels).orderBy("_slice"))
    slices = some.groupBy(*levels, "_slice", F.col("_room").alias("_take")).agg(F.count("*").alias("_n"))
    slices = slices.withColumn("_left", F.col("_take") - (upto - F.col("_n"))).where("_left > 0").select(*levels, "_slice", "_n", "_left")
    dealt = join_per_key(some, slices, [*levels, "_slice"], "inner")
    inner = dealt.where("_n <= _left").select(*rows.columns)
    place = F.row_number().over(Window.partitionBy(*levels, "_slice").orderBy("_row"))
    last = dealt.where("_n > _left").withColumn("_place", place).where("_place <= _left").select(*rows.columns)
    return whole.unionByName(inner).unionByName(last)


#: Weights by path; nodes that are not listed have weight 1.
WEIGHTS: Weights = {
    ("d0",): 1, ("d1",): 2, ("d2",): 3, ("d3",): 4, ("d1", "de"): 5, ("d3", "es"): 3, ("d0", "en"): 4, ("d2", "en", "src2"): 6,
}
LEVELS = ["domain", "lang", "source"]
SEED, EPOCHS = 17, 2


def with_domain(docs: DataFrame) -> DataFrame:
    """Documents with a domain, d0 to d3 by the number in the source's name, in place of a column of that name."""
    number = F.try_to_number(F.nullif(F.regexp_extract("source", "([0-9]{1,9})$", 1), F.lit("")), F.lit("999999999")).cast("int")
    return docs.withColumn("domain", F.concat(F.lit("d"), F.coalesce(number % 4, F.lit(0)).cast("string")))


def mix_documents(docs: DataFrame, keep: list[str] = ()) -> DataFrame:
    """Half of all tokens, at most two epochs of each leaf."""
    return mix_sources(with_domain(docs), LEVELS, WEIGHTS, F.expr("tokens div 2"), SEED, EPOCHS, keep)


def _level_sql(depth: int) -> str:
    path, parent = LEVELS[:depth], ["root", *LEVELS[: depth - 1]]
    rows = [(*p, w) for p, w in WEIGHTS.items() if len(p) == depth]
    values = ", ".join("(" + ", ".join(f"'{x}'" if isinstance(x, str) else str(x) for x in r) + ")" for r in rows)
    return f"""
weights{depth}({', '.join(path)}, weight) AS (VALUES {values}),
nodes{depth} AS (
  SELECT n.*, coalesce(w.weight, 1) AS weight, a.budget FROM (
    SELECT 0 AS root, {', '.join(path)}, sum(tokens)::BIGINT * {EPOCHS} AS cap FROM leaves GROUP BY {', '.join(path)}) n
  LEFT JOIN weights{depth} w USING ({', '.join(path)}) JOIN above{depth - 1} a USING ({', '.join(parent)})
), marked{depth} AS (
  SELECT *, cap * sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
    <= weight * (budget - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS sated
  FROM nodes{depth} WHERE weight > 0 AND cap > 0
  WINDOW o AS (PARTITION BY {', '.join(parent)} ORDER BY cap / weight, {path[-1]})
), above{depth} AS (
  SELECT root, {', '.join(path)}, CASE WHEN sated THEN cap ELSE
    (weight * (budget - coalesce(sum(CASE WHEN sated THEN cap END) OVER p, 0))) // (sum(CASE WHEN NOT sated THEN weight END) OVER p) END AS budget
  FROM marked{depth} WINDOW p AS (PARTITION BY {', '.join(parent)})
)"""


SQL = f"""
WITH counted AS (
  SELECT doc_id, 'd' || coalesce(CAST(nullif(regexp_extract(source, '([0-9]{{1,9}})$', 1), '') AS INT) % 4, 0) AS domain,
    coalesce(lang, '') AS lang, coalesce(source, '') AS source, len(regexp_extract_all(text, '{WORD}')) AS n_tokens FROM documents
), leaves AS (
  SELECT domain, lang, source, sum(n_tokens) AS tokens FROM counted WHERE n_tokens > 0 GROUP BY ALL
), above0 AS (SELECT 0 AS root, sum(tokens) // 2 AS budget FROM leaves),
{','.join(_level_sql(d) for d in (1, 2, 3))},
taken AS (
  SELECT domain, lang, source, budget // tokens AS whole, budget % tokens AS rest
  FROM above3 JOIN leaves USING (domain, lang, source) WHERE budget > 0
), placed AS (
  SELECT *, sum(n_tokens) OVER (PARTITION BY domain, lang, source
    ORDER BY md5('{SEED}:' || CAST(whole AS BIGINT) || ':' || doc_id), n_tokens ROWS UNBOUNDED PRECEDING) AS upto
  FROM counted JOIN taken USING (domain, lang, source) WHERE n_tokens > 0
)
SELECT doc_id, domain, lang, source, CAST(e AS INTEGER) AS epoch, n_tokens
FROM placed, unnest(range(CAST(whole AS BIGINT) + CASE WHEN upto <= rest THEN 1 ELSE 0 END)) AS t(e)
"""


@query("op10_mix_sources", SQL)
def op10_mix_sources(spark: SparkSession, sf: str) -> DataFrame:
    return mix_documents(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang", "source"))
