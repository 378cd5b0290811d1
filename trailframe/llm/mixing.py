"""Mixing sources to target weights: hierarchical budgets, then a seeded prefix of each leaf.

Leaves are (domain, language, source). The token budget flows down the tree by weight. A node never gets more than its
leaves hold (``max_epochs`` times their tokens), and what it can't take goes to its siblings in proportion to their
weights; since a parent's own limit is the sum of its children's, a shortage reaches the parent's siblings only once all
children are full. One sort by limit over weight gives the fill level of a node's children in closed form.

A leaf repeats all its rows for as many whole epochs as its budget covers and then takes the prefix of one more epoch, in
the order of ``md5(seed:epoch:doc_id)``, up to and with the row that reaches the budget. The cut is found in two steps:
token sums per hash bucket, then a running sum inside the single bucket that holds the cut, so a leaf with a third of all
rows is never sorted as a whole. Rows are then chosen by a plain comparison with the leaf's cut.

Defined cases: null domains, languages or sources form leaves of their own with the default weights; null and blank texts
have no tokens and come with any epoch that reaches them; rows of equal order key (repeated doc_ids) are taken together; a
leaf with a weight of zero gets nothing; no tokens at all gives no rows. Extra columns pass through ``select_documents``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from trailframe.llm.common import word_count
from trailframe.session import materialize

SEED = 20
#: Share of all tokens that the mixture holds.
FRACTION = 0.5
MAX_EPOCHS = 2
DOMAINS = ("web", "books", "code", "forum")
DOMAIN_WEIGHTS = {"web": 0.4, "books": 0.3, "code": 0.2, "forum": 0.1}
LANG_WEIGHTS = {"en": 0.55, "de": 0.15, "fr": 0.15, "es": 0.1}
DEFAULT_WEIGHT = 0.05
#: Rows that a hash bucket of a leaf holds on average.
BUCKET_ROWS = 4096
TREE = ("domain", "lang", "source")
LEAF = "__leaf"
TIE = "__tie"
#: Leaf tables of at most so many rows (under 30 MB) are broadcast; larger ones are joined by a shuffle.
BROADCAST_LEAVES = 200_000


def domain_of(source: Column) -> Column:
    """Stand-in for a source catalogue: the number at the end of a source's name picks its domain."""
    number = F.regexp_extract(source, "[0-9]{1,9}$", 0)
    names = F.array(*[F.lit(x) for x in DOMAINS])
    return F.when(number != "", F.get(names, (F.when(number != "", number).cast("int") % len(DOMAINS))))


def weight_of(name: Column, weights: dict[str, float]) -> Column:
    chosen = F.lit(DEFAULT_WEIGHT)
    for key, weight in weights.items():
        chosen = F.when(name == key, F.lit(float(weight))).otherwise(chosen)
    return chosen


def leaf_key() -> Column:
    return F.concat_ws("/", *[F.coalesce(F.concat(F.lit("="), F.col(c)), F.lit("-")) for c in TREE])


def fill(nodes: DataFrame, parent: list[str], order: list[str]) -> DataFrame:
    """Adds ``given``: the parent's ``budget`` shared among its children by ``weight``, none above its ``limit``."""
    by = W.partitionBy(*parent) if parent else W.partitionBy(F.lit(0))
    ratio = F.col("limit") / F.col("weight")
    ordered = by.orderBy(ratio, *[F.col(c).asc_nulls_first() for c in order])
    before = F.coalesce(F.sum("limit").over(ordered.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0))
    open_weight = F.sum("weight").over(ordered.rowsBetween(W.currentRow, W.unboundedFollowing))
    level = (F.col("budget") - before) / open_weight
    marked = nodes.withColumn("level", level).withColumn("full", F.col("limit") <= F.col("level") * F.col("weight"))
    top = F.max(F.when(~F.col("full"), F.col("level"))).over(by)
    return marked.withColumn("given", F.when(F.col("full"), F.col("limit")).otherwise(top * F.col("weight"))).drop("level", "full")


def budgets(leaves: DataFrame, fraction: float, max_epochs: int) -> DataFrame:
    """Token budget of every leaf; ``leaves`` has the tree columns and ``tokens``."""
    leaves = (leaves.withColumn("limit", (F.col("tokens") * max_epochs).cast("double"))
              .withColumn("w1", weight_of(F.col("domain"), DOMAIN_WEIGHTS)).withColumn("w2", weight_of(F.col("lang"), LANG_WEIGHTS))
              .filter((F.col("w1") > 0) & (F.col("w2") > 0)))
    domains = leaves.groupBy("domain").agg(F.sum("limit").alias("limit"), F.first("w1").alias("weight"), F.sum("tokens").alias("tokens"))
    everything = F.sum("tokens").over(W.partitionBy(F.lit(0)))
    room = F.sum("limit").over(W.partitionBy(F.lit(0)))
    domains = fill(domains.withColumn("budget", F.least(everything * F.lit(float(fraction)), room)), [], ["domain"])
    langs = leaves.groupBy("domain", "lang").agg(F.sum("limit").alias("limit"), F.first("w2").alias("weight"))
    above = domains.select(F.col("domain").alias("d"), F.col("given").alias("budget"))
    langs = fill(langs.join(above, F.col("domain").eqNullSafe(F.col("d"))).drop("d"), ["domain"], ["lang"])
    above = langs.select(F.col("domain").alias("d"), F.col("lang").alias("l"), F.col("given").alias("budget"))
    own = leaves.withColumn("weight", F.lit(1.0)).join(
        above, F.col("domain").eqNullSafe(F.col("d")) & F.col("lang").eqNullSafe(F.col("l"))).drop("d", "l", "w1", "w2")
    return fill(own, ["domain", "lang"], ["source"]).select(
        *TREE, "tokens", F.floor(F.round("given", 3)).cast("long").alias("budget"))


def order_key(epoch: Column, doc_id: Column, tie: Column, seed: int) -> Column:
    """Place of a row in an epoch: by hash of its id; rows of one id (or of none) follow each other by ``tie``."""
    return F.concat(F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(doc_id.cast("string"), F.lit("null")))), tie)


def tie_key() -> Column:
    """Hash of the text, then a number of the row. Only for tables that are written before the key is used."""
    return F.concat(F.lpad(F.hex(F.xxhash64("text")), 16, "0"), F.lpad(F.hex(F.monotonically_increasing_id()), 16, "0"))


def at_leaves(rows: DataFrame, leaves: DataFrame, known: int) -> DataFrame:
    """``rows`` joined to the leaf table of ``known`` rows, without dealing them by leaf while that table is small."""
    return rows.join(F.broadcast(leaves) if known <= BROADCAST_LEAVES else leaves, LEAF)


def plan(counted: DataFrame, fraction: float, max_epochs: int, seed: int) -> tuple[DataFrame, int]:
    """One row per leaf: whole epochs and, for the partial one, the last order key taken (null: none); and their number."""
    sums = counted.groupBy(*TREE).agg(F.sum("n_tokens").alias("tokens"), F.count(F.lit(1)).alias("rows"))
    sums = materialize(sums, "mix-leaves")
    largest, known = sums.agg(F.max("rows"), F.count(F.lit(1))).first()
    largest = largest or 1
    digits = max(1, math.ceil(math.log(max(largest / BUCKET_ROWS, 1), 16)))
    made = budgets(sums.filter(F.col("tokens") > 0).select(*TREE, "tokens"), fraction, max_epochs)
    leaves = materialize(
        made.select(leaf_key().alias(LEAF), "budget", F.floor(F.col("budget") / F.col("tokens")).cast("int").alias("epochs"),
                    (F.col("budget") % F.col("tokens")).alias("rest")), "mix-budgets")
    keyed = at_leaves(counted, leaves.filter(F.col("rest") > 0), known).select(
        LEAF, "n_tokens", "rest", order_key(F.col("epochs"), F.col("doc_id"), F.col(TIE), seed).alias("key"))
    keyed = keyed.withColumn("bucket", F.substring("key", 1, digits))
    buckets = keyed.groupBy(LEAF, "bucket").agg(F.sum("n_tokens").alias("tokens"), F.first("rest").alias("rest"))
    running = F.sum("tokens").over(W.partitionBy(LEAF).orderBy("bucket"))
    cut = (buckets.withColumn("upto", running).filter((F.col("upto") >= F.col("rest")) & (F.col("upto") - F.col("tokens") < F.col("rest")))
           .groupBy(LEAF).agg(F.min_by("bucket", "bucket").alias("bucket"),
                              F.min_by(F.col("upto") - F.col("tokens"), F.col("bucket")).alias("before")))
    cut = F.broadcast(cut) if known <= BROADCAST_LEAVES else cut  # one row a leaf
    inside = keyed.join(cut, [LEAF, "bucket"]).withColumn(
        "upto", F.col("before") + F.sum("n_tokens").over(W.partitionBy(LEAF).orderBy("key")))
    last = inside.filter(F.col("upto") >= F.col("rest")).groupBy(LEAF).agg(F.min("key").alias("cut_key"))
    return materialize(leaves.select(LEAF, "epochs").join(last, LEAF, "left"), "mix-plan"), known


def select(rows: DataFrame, leaves: DataFrame, known: int, seed: int) -> DataFrame:
    """``rows`` (with doc_id and the leaf key) once per epoch that takes them, with column ``__epoch``."""
    partial = F.col("cut_key").isNotNull() & (order_key(F.col("epochs"), F.col("doc_id"), F.col(TIE), seed) <= F.col("cut_key"))
    times = F.col("epochs") + F.when(partial, 1).otherwise(0)
    return (at_leaves(rows, leaves, known).withColumn("__times", times).filter(F.col("__times") > 0)
            .withColumn("__epoch", F.explode(F.sequence(F.lit(0), F.col("__times") - 1)))
            .drop("__times", "epochs", "cut_key", TIE))


def counted(docs: DataFrame, tie: Column | None = None) -> DataFrame:
    found = docs.select("doc_id", domain_of(F.col("source")).alias("domain"), "lang", "source",
                        word_count(F.col("text")).alias("n_tokens"), (tie_key() if tie is None else tie).alias(TIE))
    return materialize(found.withColumn(LEAF, leaf_key()), "mix-counted")


def mixture(docs: DataFrame, fraction: float = FRACTION, max_epochs: int = MAX_EPOCHS, seed: int = SEED) -> DataFrame:
    """(doc_id, domain, lang, source, n_tokens, epoch) of every row of the mixture."""
    rows = counted(docs)
    return select(rows, *plan(rows, fraction, max_epochs, seed), seed).select(
        "doc_id", *TREE, "n_tokens", F.col("__epoch").cast("long").alias("epoch"))


def select_documents(docs: DataFrame, fraction: float, max_epochs: int = 1, seed: int = SEED) -> DataFrame:
    """The mixture's rows of ``docs`` with all their columns."""
    columns = docs.columns
    docs = materialize(docs.withColumn(TIE, tie_key()), "mix-docs")
    leaves, known = plan(counted(docs, F.col(TIE)), fraction, max_epochs, seed)
    leaves = leaves.select(
        LEAF, F.col("epochs").alias("__epochs"), F.col("cut_key").alias("__cut"))
    key = F.concat_ws("/", *[F.coalesce(F.concat(F.lit("="), c), F.lit("-")) for c in (
        domain_of(F.col("source")), F.col("lang"), F.col("source"))])
    partial = F.col("__cut").isNotNull() & (order_key(F.col("__epochs"), F.col("doc_id"), F.col(TIE), seed) <= F.col("__cut"))
    times = F.col("__epochs") + F.when(partial, 1).otherwise(0)
    return (at_leaves(docs.withColumn(LEAF, key), leaves, known).withColumn("__times", times).filter(F.col("__times") > 0)
            .withColumn("__epoch", F.explode(F.sequence(F.lit(0), F.col("__times") - 1))).select(*columns))


def _case(column: str, weights: dict[str, float]) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN {v}::DOUBLE" for k, v in weights.items()) + f" ELSE {DEFAULT_WEIGHT}::DOUBLE END"


def _fill_sql(name: str, source: str, parent: str, order: str) -> str:
    by = f"PARTITION BY {parent} " if parent else ""
    return f"""
{name}_a AS (
  SELECT *, (budget - coalesce(sum(lim) OVER ({by}ORDER BY lim / weight, {order} NULLS FIRST
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0)) /
    sum(weight) OVER ({by}ORDER BY lim / weight, {order} NULLS FIRST
      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lvl FROM {source}),
{name} AS (
  SELECT *, CASE WHEN lim <= lvl * weight THEN lim
    ELSE max(CASE WHEN lim <= lvl * weight THEN NULL ELSE lvl END) OVER ({by}) * weight END AS given FROM {name}_a)"""


def oracle(fraction: float = FRACTION, max_epochs: int = MAX_EPOCHS) -> str:
    return f"""
WITH c AS (
  SELECT doc_id, lang, source, [{", ".join(f"'{x}'" for x in DOMAINS)}][
      try_cast(nullif(regexp_extract(source, '[0-9]{{1,9}}$'), '') AS INT) % {len(DOMAINS)} + 1] AS domain,
    len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS n_tokens FROM documents),
leaf AS (
  SELECT domain, lang, source, sum(n_tokens)::BIGINT AS tokens, (sum(n_tokens) * {max_epochs})::DOUBLE AS lim
  FROM c GROUP BY ALL HAVING sum(n_tokens) > 0),
d0 AS (
  SELECT domain, sum(lim) AS lim, {_case('domain', DOMAIN_WEIGHTS)} AS weight,
    least(sum(sum(tokens)) OVER () * {fraction}::DOUBLE, sum(sum(lim)) OVER ()) AS budget FROM leaf GROUP BY domain),
{_fill_sql('d1', 'd0', '', 'domain').strip()},
l0 AS (
  SELECT leaf.domain, leaf.lang, sum(leaf.lim) AS lim, {_case('leaf.lang', LANG_WEIGHTS)} AS weight, any_value(d1.given) AS budget
  FROM leaf JOIN d1 ON leaf.domain IS NOT DISTINCT FROM d1.domain GROUP BY leaf.domain, leaf.lang),
{_fill_sql('l1', 'l0', 'domain', 'lang').strip()},
s0 AS (
  SELECT leaf.*, 1.0::DOUBLE AS weight, l1.given AS budget FROM leaf
  JOIN l1 ON leaf.domain IS NOT DISTINCT FROM l1.domain AND leaf.lang IS NOT DISTINCT FROM l1.lang),
{_fill_sql('s1', 's0', 'domain, lang', 'source').strip()},
b AS (
  SELECT domain, lang, source, tokens, floor(round(given, 3))::BIGINT // tokens AS epochs,
    floor(round(given, 3))::BIGINT % tokens AS rest FROM s1),
k AS (
  SELECT c.*, epochs, rest, md5('{SEED}:' || epochs || ':' || coalesce(doc_id::VARCHAR, 'null')) AS k FROM c
  JOIN b ON c.domain IS NOT DISTINCT FROM b.domain AND c.lang IS NOT DISTINCT FROM b.lang AND c.source IS NOT DISTINCT FROM b.source),
r AS (
  SELECT *, sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY k) AS upto FROM k),
t AS (
  SELECT *, min(CASE WHEN upto >= rest THEN k END) OVER (PARTITION BY domain, lang, source) AS cut FROM r)
SELECT doc_id, domain, lang, source, n_tokens, unnest(range(epochs + CASE WHEN rest > 0 AND k <= cut THEN 1 ELSE 0 END)) AS epoch FROM t
"""


ORACLE = oracle()
