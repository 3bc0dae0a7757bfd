"""Mixing sources to target weights by hierarchical budgeting, in DataFrame operations only.

Documents hang on a tree (domain, language, source). The total budget of tokens is passed down:
a node's budget is shared among its children by weight; a child that cannot use its share even
with ``max_epochs`` repeats of all it has (the sum of what its leaves can give) keeps what it
can, and the shortage is shared among its siblings by weight, again up to what they have. So a
shortage stays among siblings as long as these can take it, and only what a whole subtree
cannot give comes to the subtree's own siblings, one level up. Shares are whole tokens, rounded
down, in decimal arithmetic.

A leaf with budget ``b`` and ``have`` tokens gives ``b div have`` whole epochs, and of the next
epoch the longest prefix, in that epoch's seeded order (MD5 of seed, epoch and id), whose tokens
fit in the rest. The prefix is found without sorting a leaf: sums by the first hex digits of
the order key, running totals over these few buckets, and an order inside the one bucket where
the rest ends. A leaf may hold any share of all rows; no text is shuffled. What passes through one
task at a node are its children's totals, never documents.

Nulls in a level's column are the child ``''``; null token counts are 0; a null id orders as
the text ``null``. Rows of one id have one place in the order and are taken together. A leaf
without tokens, or with weight 0, gives nothing. An empty table gives an empty result. The
result's columns are those of the input and ``epoch``, which replaces a column of that name.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import chain

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from diffloom.llm.common import fresh
from diffloom.session import materialize

#: Hex digits of the order key that make a bucket.
BUCKET_DIGITS = 3
Weights = Mapping[str, Mapping[str, int]]
#: The weight of a child that its level's table does not name.
OTHER = "*"


def word_count(text: Column) -> Column:
    """Tokens of a text: its runs of other than ASCII white space."""
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def domain_of(source: Column) -> Column:
    """A domain for tables that name sources only: four groups by the source's MD5."""
    digit = F.substring(F.md5(F.coalesce(source, F.lit(""))), 1, 1)
    return F.when(digit < "4", "a").when(digit < "8", "b").when(digit < "c", "c").otherwise("d")


def order_key(seed: int, epoch: Column, doc_id: Column) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(doc_id.cast("string"), F.lit("null"))))


def _weight(column: str, table: Mapping[str, int]) -> Column:
    other = F.lit(table.get(OTHER, 1))
    named = [F.lit(x) for x in chain.from_iterable(kv for kv in table.items() if kv[0] != OTHER)]
    return (F.coalesce(F.element_at(F.create_map(*named), F.col(column)), other) if named else other).cast("decimal(38,0)")


def budgets(leaves: DataFrame, levels: Sequence[str], weights: Weights, total: Column, max_epochs: int) -> DataFrame:
    """``leaves`` (the levels and ``have``) with each leaf's ``budget``; ``total``: the whole budget."""
    whole = "decimal(38,0)"
    cur = leaves.withColumn("cap", (F.col("have") * max_epochs).cast(whole)).withColumn("budget", total.cast(whole))
    for depth, level in enumerate(levels):
        path = list(levels[:depth + 1])
        nodes = (cur.groupBy(*path).agg(F.sum("cap").alias("cap"), F.max("budget").alias("above"))
                 .withColumn("w", _weight(level, weights.get(level, {}))).filter("w > 0"))
        parent = Window.partitionBy(*path[:-1]) if depth else Window.partitionBy(F.lit(0))
        full_first = parent.orderBy(F.col("cap").cast("double") / F.col("w").cast("double"), level)
        nodes = (nodes.withColumn("left", F.col("above") - F.sum("cap").over(full_first.rowsBetween(Window.unboundedPreceding, -1)))
                 .withColumn("left", F.coalesce("left", "above"))
                 .withColumn("open", F.sum("w").over(full_first.rowsBetween(0, Window.unboundedFollowing)))
                 .withColumn("full", F.col("cap").cast("decimal(25,0)") * F.col("open").cast("decimal(12,0)")
                             <= F.col("left").cast("decimal(25,0)") * F.col("w").cast("decimal(12,0)")))
        rest = F.col("above") - F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))).over(parent), F.lit(0))
        nodes = (nodes.withColumn("rest", rest.cast("decimal(25,0)"))
                 .withColumn("among", F.sum(F.when(~F.col("full"), F.col("w"))).over(parent).cast("decimal(12,0)"))
                 .withColumn("share", F.when(F.col("full"), F.col("cap").cast("long"))
                             .otherwise(F.expr("(rest * cast(w as decimal(12,0))) div among"))))
        share = nodes.select(*[F.col(p).alias(f"_{p}") for p in path], F.col("share").cast(whole).alias("_share"))
        same = [F.col(p) == F.col(f"_{p}") for p in path]
        cur = (cur.join(share, same).withColumn("budget", F.col("_share")).drop("_share", *[f"_{p}" for p in path]))
    return cur.select(*levels, "have", F.col("budget").cast("long").alias("budget"))


def plan(rows: DataFrame, levels: Sequence[str], weights: Weights, seed: int, max_epochs: int, percent: int) -> DataFrame:
    """One row for each leaf: ``budget``, whole ``epochs``, and the ``cut`` up to which the order
    keys of the next epoch are taken. ``rows``: the levels, ``id`` and ``tokens``."""
    levels = list(levels)
    leaves = rows.groupBy(*levels).agg(F.sum("tokens").alias("have")).filter("have > 0")
    leaves = materialize(leaves, "mix-leaves")
    total = (int(leaves.agg(F.sum(F.col("have").cast("decimal(38,0)"))).first()[0] or 0)) * percent // 100  # one number
    shared = budgets(leaves, levels, weights, F.lit(total), max_epochs)
    shared = materialize(shared.withColumn("epochs", F.expr("budget div have")).withColumn("rest", F.expr("budget % have")),
                         "mix-budgets")
    keyed = (rows.join(shared.filter("rest > 0").select(*levels, "epochs", "rest"), levels)
             .withColumn("key", order_key(seed, F.col("epochs"), F.col("id")))
             .withColumn("bucket", F.substring("key", 1, BUCKET_DIGITS)).select(*levels, "rest", "bucket", "key", "tokens"))
    sums = keyed.groupBy(*levels, "bucket").agg(F.sum("tokens").alias("n"), F.max("rest").alias("rest"))
    running = Window.partitionBy(*levels).orderBy("bucket")
    ended = (sums.withColumn("until", F.sum("n").over(running)).filter("until > rest")
             .groupBy(*levels).agg(F.min(F.struct("bucket", (F.col("until") - F.col("n")).alias("before"))).alias("e"))
             .select(*levels, F.col("e.bucket").alias("bucket"), F.col("e.before").alias("before")))
    ended = materialize(ended, "mix-ends")
    inside = keyed.join(ended, [*levels, "bucket"])
    at = Window.partitionBy(*levels).orderBy("key")  # a range frame: rows of one key together
    last = (inside.withColumn("until", F.col("before") + F.sum("tokens").over(at)).filter("until <= rest")
            .groupBy(*levels).agg(F.max("key").alias("last")))
    return (shared.join(ended.select(*levels, "bucket"), levels, "left").join(last, levels, "left")
            .select(*levels, "budget", "epochs",
                    F.when(F.col("rest") == 0, "").otherwise(F.coalesce("last", "bucket", F.lit("g"))).alias("cut")))


def mix(df: DataFrame, levels: Sequence[str], weights: Weights, tokens: str, id_col: str = "doc_id", seed: int = 0,
        max_epochs: int = 2, percent: int = 50) -> DataFrame:
    """The selected rows of ``df``, once for each ``epoch`` in which they are taken. The total budget
    is ``percent`` of the tokens that ``df`` has."""
    df = df.drop("epoch")
    names = [f"level_{k}" for k in range(len(levels))]
    by_name = {n: weights.get(c, {}) for n, c in zip(names, levels)}
    path = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for n, c in zip(names, levels)]
    rows = materialize(df.select(*path, F.col(id_col).alias("id"), F.coalesce(F.col(tokens), F.lit(0)).cast("long").alias("tokens")),
                       "mix-rows")
    leaves = materialize(plan(rows, names, by_name, seed, max_epochs, percent), "mix-plan")
    own = {n: fresh(df, f"__{n}") for n in [*names, "epochs", "cut", "epoch"]}
    leaves = leaves.select(*[F.col(n).alias(own[n]) for n in [*names, "epochs", "cut"]])
    named = df.select("*", *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(own[n]) for n, c in zip(names, levels)])
    found = named.join(leaves, [own[n] for n in names])
    part = order_key(seed, F.col(own["epochs"]), F.col(id_col)) <= F.col(own["cut"])
    copies = (F.col(own["epochs"]) + part.cast("int")).cast("int")
    found = found.filter(copies > 0).withColumn(own["epoch"], F.explode(F.sequence(F.lit(0), copies - 1)))
    return found.select(*[F.col(f"`{c}`") for c in df.columns], F.col(own["epoch"]).alias("epoch"))


# production parameters of the query and the pipeline

LEVELS = ("domain", "lang", "source")
WEIGHTS: Weights = {"domain": {"a": 40, "b": 30, "c": 20, "d": 10},
                    "lang": {"en": 55, "de": 15, "fr": 15, "es": 10, OTHER: 5}, "source": {OTHER: 1}}
SEED, MAX_EPOCHS, PERCENT = 42, 2, 60
