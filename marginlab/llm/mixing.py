"""Mixing sources to target weights: a budget of tokens handed down a tree, and a seeded prefix of each leaf.

DataFrame functions only. A node's budget is shared among its children by weight.
A child whose documents (times ``max_epochs``) hold less than its share is filled,
and what it leaves goes to its siblings by their weights; only if all siblings are
full does the rest go to the parent's siblings. A leaf passes over its documents
as often as its budget allows, and takes from the last epoch the longest prefix, in
an order seeded for the leaf's epoch, that the rest of the budget holds.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marginlab.llm.text import n_words
from marginlab.session import new_shared_path

#: Hexadecimal digits of the order (32) and of the hash of the row (16) that the steps towards a cut look at.
ORDER_STEPS, ROW_STEPS, PLACE_DIGITS = (2, 4, 32), (34, 36), 48
#: Rows of one order in a leaf that are told apart in one step.
CROWD = 100_000
_EXACT = "decimal(18,0)"


@dataclass(frozen=True)
class Level:
    """A level of the tree: its name, a document's node there, and a node's weight among its siblings.

    ``weight`` is a whole number, over the names of this and higher levels; nodes of weight 0 get nothing.
    """

    name: str
    node: Column
    weight: Column


def _share(children: DataFrame, parents: list[str], name: str) -> DataFrame:
    """Add ``got`` to children (``cap``, ``weight``, the parent's ``budget``)."""
    family = Window.partitionBy(*parents, "budget")
    by_fill = family.orderBy(F.col("cap").cast("double") / F.col("weight").cast("double"), name)
    before = by_fill.rowsBetween(Window.unboundedPreceding, -1)

    def earlier(c: str) -> Column:
        return F.coalesce(F.sum(c).over(before), F.lit(0)).cast(_EXACT)

    df = children.where("weight > 0").withColumns(
        {"cap_before": earlier("cap"), "weight_before": earlier("weight"), "weights": F.sum("weight").over(family)}
    )
    # Children in the order in which they fill up: the full ones come first.
    left = (F.col("weights") - F.col("weight_before")).cast(_EXACT)
    full = F.col("cap") * left <= F.col("weight") * (F.col("budget") - F.col("cap_before")).cast(_EXACT)
    df = df.withColumn("full", full)
    none = F.lit(0).cast(_EXACT)
    used = F.sum(F.when(F.col("full"), F.col("cap")).otherwise(none)).over(family)
    open_weight = F.sum(F.when(F.col("full"), none).otherwise(F.col("weight"))).over(family)
    df = df.withColumns({"rest": (F.col("budget") - used).cast(_EXACT), "open_weight": open_weight.cast(_EXACT)})
    part = F.expr("weight * rest div nullif(open_weight, 0)").cast(_EXACT)
    got = F.when(F.col("full"), F.col("cap")).otherwise(part)
    return df.select(*parents, name, got.alias("got"))


def leaf_budgets(leaves: DataFrame, levels: Sequence[Level], budget: int, max_epochs: int) -> DataFrame:
    """(level names, tokens, got) of each leaf that has tokens and weight; ``leaves`` has one row per leaf.

    What a node can take is the sum over its leaves that have weight on every level.
    """
    for level in levels:
        leaves = leaves.where(level.weight > 0)
    names = [x.name for x in levels]
    parents, above = [], None
    for level in levels:
        path = [*parents, level.name]
        nodes = leaves.groupBy(*path).agg((F.sum("tokens") * max_epochs).cast(_EXACT).alias("cap"))
        nodes = nodes.where("cap > 0").withColumn("weight", level.weight.cast(_EXACT))
        if above is None:
            nodes = nodes.withColumn("budget", F.lit(budget).cast(_EXACT))
        else:
            nodes = nodes.join(above.withColumnRenamed("got", "budget"), parents)
        above, parents = _share(nodes, parents, level.name), path
    return leaves.join(above, names).select(*names, "tokens", F.col("got").cast("long").alias("got"))


def _order(seed: int, epoch: Column, key: str) -> Column:
    """Hexadecimal text that puts the documents of an epoch in its order."""
    parts = [F.lit(str(seed)), epoch.cast("string"), F.coalesce(F.col(f"`{key}`").cast("string"), F.lit(""))]
    return F.md5(F.concat_ws(":", *parts))


def _stored(df: DataFrame, path: str) -> DataFrame:
    """The table written and read: Spark then knows its size and broadcasts it only if it is small."""
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _cuts(rows: DataFrame, leaves: DataFrame, names: list[str], path: str) -> DataFrame:
    """For each leaf with a part epoch, the first ``place`` that its rest does not hold, and how many rows of it fit (``fit``).

    ``rows`` has the level names, ``place`` and ``n``. Sums by the leading digits of
    the place find the digits at which the rest is used up, then the following
    digits among these alone. Sums are partial before they move, so neither a leaf with
    a third of all rows, nor a key, nor equal rows that make up as much meet in a task.
    """
    cut = leaves.where("rest > 0").select(*names, "rest", F.lit("").alias("head"), F.lit(0).cast("long").alias("before"))
    steps, done = [*ORDER_STEPS, PLACE_DIGITS], 0
    while steps:
        digits, done = steps.pop(0), done + 1
        here = rows.join(cut, names).where(F.expr("startswith(place, head)"))
        here = here.withColumn("digits", F.substring("place", 1, digits))
        sums = here.groupBy(*names, "rest", "before", "digits").agg(F.sum("n").alias("n"), F.count("*").alias("rows"))
        running = Window.partitionBy(*names, "rest", "before").orderBy("digits")
        sums = sums.withColumn("upto", F.col("before") + F.sum("n").over(running))
        over = sums.where("upto > rest").select(*names, "rest", F.struct("digits", "upto", "n", "rows").alias("over"))
        cut = over.groupBy(*names, "rest").agg(F.min("over").alias("over"))
        cut = cut.select(
            *names, "rest", F.col("over.digits").alias("head"), F.expr("over.upto - over.n").alias("before"), "over.n", "over.rows"
        )
        cut = _stored(cut, f"{path}/cut-{done}")
        if digits == ORDER_STEPS[-1] and (cut.agg(F.max("rows")).first()[0] or 0) > CROWD:
            steps = [*ROW_STEPS, *steps]
        if steps:
            cut = cut.drop("n", "rows")
    # Rows of one place are equal, so they have equally many tokens.
    return cut.select(*names, F.struct(F.col("head").alias("place"), F.expr("(rest - before) div (n div rows)").alias("fit")).alias("cut"))


def mix(
    docs: DataFrame, levels: Sequence[Level], budget: int | float, max_epochs: int = 1, seed: int = 0,
    key: str = "doc_id", text: str = "text", out: str = "__mix",
) -> DataFrame:
    """The chosen rows of ``docs`` with ``out`` (struct of the level names, ``n_tokens`` and ``epoch``), once per epoch.

    Tokens are words. ``budget`` is a number of tokens, or a fraction of all of them if it is a float. All shares
    are whole numbers, rounded down. A document that does not fit ends its leaf's prefix.

    Texts do not move: the choice is a comparison with the leaf's cut. Documents
    are added up before a shuffle, however many a leaf has.

    A null text has no tokens; a null level is a node named ''. Leaves without
    tokens or weight get nothing. Rows that share a key come in the order of a
    hash of all their columns; of equal rows at the end of a prefix as many are taken as
    fit. An empty table gives an empty result. Extra columns are kept, whatever their names; one named ``out`` is replaced.
    """
    spark, names = docs.sparkSession, [x.name for x in levels]
    path = new_shared_path(spark, "mix")
    every = [F.col(f"`{c}`") for c in docs.columns]
    nodes = F.struct(
        *[F.coalesce(x.node.cast("string"), F.lit("")).alias(x.name) for x in levels],
        n_words(F.col(f"`{text}`")).alias("n_tokens"),
    )
    marked = docs.select(
        F.struct(*[c for c, n in zip(every, docs.columns) if n != out]).alias("row"), nodes.alias("mix"),
        F.col(f"`{key}`").alias("key"), F.lower(F.lpad(F.hex(F.xxhash64(*every)), 16, "0")).alias("tie"),
    )
    marked.select("key", "tie", "mix.*").write.parquet(f"{path}/rows")
    rows = spark.read.parquet(f"{path}/rows").withColumnRenamed("n_tokens", "n")
    leaves = _stored(rows.groupBy(*names).agg(F.sum("n").alias("tokens")), f"{path}/leaves")
    total = leaves.agg(F.sum("tokens")).first()[0] or 0
    most = int(budget * total) if isinstance(budget, float) else budget
    got = leaf_budgets(leaves, levels, most, max_epochs)
    got = got.withColumn("epochs", F.expr("got div tokens")).withColumn("rest", F.expr("got % tokens"))
    got = _stored(got.select(*names, "epochs", "rest"), f"{path}/budgets")
    seeded = rows.join(got, names).withColumn("place", F.concat(_order(seed, F.col("epochs"), "key"), "tie"))
    seeded = seeded.select(*names, "n", "place")
    # One row per leaf; with its size known, texts stay where they are.
    plan = got.join(_cuts(seeded, got, names, path), names, "left")
    plan = _stored(plan.select(F.struct(*names).alias("leaf"), "epochs", "cut"), f"{path}/plan")
    placed = marked.withColumn("leaf", F.struct(*[F.col(f"mix.{n}").alias(n) for n in names])).join(plan, "leaf")
    place = F.concat(_order(seed, F.col("epochs"), "key"), "tie")
    extra = F.when(F.coalesce(place < F.col("cut.place"), F.lit(False)), 1).otherwise(0)
    chosen = placed.withColumn("times", (F.col("epochs") + extra).cast("int")).where("times > 0")
    chosen = chosen.select("row", "mix", F.explode(F.expr("sequence(0, times - 1)")).alias("epoch"))
    if plan.where("cut.fit > 0").limit(1).count():
        # Equal rows that fit in part: one of them, as often as it fits.
        equal = placed.where((place == F.col("cut.place")) & (F.col("cut.fit") > 0)).groupBy("leaf")
        equal = equal.agg(*[F.any_value(c).alias(c) for c in ("row", "mix", "epochs", "cut")])
        equal = equal.withColumn("copy", F.explode(F.expr("sequence(1L, cut.fit)")))
        chosen = chosen.unionByName(equal.select("row", "mix", F.col("epochs").cast("int").alias("epoch")))
    return chosen.select("row.*", F.struct("mix.*", "epoch").alias(out))


def domain_tree(source: str = "source", lang: str = "lang") -> list[Level]:
    """Domain, language, source: the domain of a source is its number modulo 4 (0 without a number)."""
    number = F.coalesce(F.expr(f"try_cast(regexp_extract(`{source}`, '([0-9]{{1,9}})$', 1) as int)"), F.lit(0))
    by_domain = F.expr("case domain when 'd0' then 4 when 'd1' then 3 when 'd2' then 2 else 1 end")
    by_lang = F.expr("case lang when 'en' then 5 when 'de' then 2 when 'fr' then 2 else 1 end")
    return [
        Level("domain", F.concat(F.lit("d"), (number % 4).cast("string")), by_domain),
        Level("lang", F.col(f"`{lang}`"), by_lang),
        Level("source", F.col(f"`{source}`"), F.lit(1)),
    ]
