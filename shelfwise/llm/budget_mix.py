"""Mixing sources to target weights by hierarchical budgeting, in DataFrame operations.

The sources form a tree of ``levels`` (domain, language, source). A token
budget flows down it by weight. A child gets no more than it can supply (its
tokens times the greatest number of epochs); what it can't take goes to its
siblings by their weights, and only what all siblings can't take stays with
the ancestors, whose own siblings take it in the same way. Each leaf then reads
its documents in epochs, each in a seeded order of its own: all of them as
often as its budget allows, and a prefix by tokens of the epoch after.

The tree is a table with a row for each node. Among the children of a node,
sorted by supply over weight, running sums give the level up to which all are
filled. Orders
are hashes; their first three hexadecimal digits cut a leaf into 4096 buckets,
so prefix sums run over bucket totals, and documents are sorted only in the one
bucket where a leaf's budget ends. No leaf is gathered or sorted whole.

Defined cases: a document without tokens (null or empty text) is never chosen;
a null level value is a node of its own, with the default weight; equal ids are
in one place of the order, by tokens; a node with weight 0 gets nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import scratch

SEED = 17
EPOCHS = 2
SHARE = 0.6
DEFAULT_WEIGHT = 10
#: The mixture of the registered query. Weights are relative among siblings and whole numbers.
DOMAINS = ("web", "books", "news", "reference")
WEIGHTS = ({"web": 40, "books": 30, "news": 20, "reference": 10}, {"en": 50, "de": 20, "fr": 20, "es": 10}, {})


def tokens_of(text: Column) -> Column:
    """Estimated tokens: a quarter of the UTF-8 bytes, rounded up."""
    return F.ceil(F.octet_length(text) / F.lit(4)).cast("bigint")


def domain_of(source: str) -> Column:
    """The domain of a source name that ends in a number (by its last digits); null for others."""
    number = f"try_cast(nullif(regexp_extract({source}, '([0-9]{{1,18}})$', 1), '') as bigint)"
    return F.expr(f"get(array({', '.join(repr(d) for d in DOMAINS)}), cast(pmod({number}, {len(DOMAINS)}) as int))")


def _weight(column: str, weights: dict[str, int], default: int) -> Column:
    pairs = " ".join(f"when '{k}' then {int(w)}" for k, w in sorted(weights.items()))
    return F.expr(f"case {column} {pairs} else {int(default)} end" if pairs else str(int(default))).cast("bigint")


def budgets(leaves: DataFrame, levels: list[str], total: int, weights=WEIGHTS, epochs: int = EPOCHS,
            default: int = DEFAULT_WEIGHT) -> DataFrame:
    """(levels..., supply, budget) from (levels..., supply): whole tokens for every leaf, top down."""
    nodes = leaves.select(*levels, "supply", (F.col("supply") * epochs).alias("room"))
    above: DataFrame | None = None
    for depth, level in enumerate(levels):
        path = levels[: depth + 1]
        here = nodes.groupBy(*path).agg(F.sum("room").alias("room"), F.sum("supply").alias("supply"))
        here = here.withColumn("weight", _weight(level, weights[depth] if depth < len(weights) else {}, default)) \
            .where("weight > 0")
        if above is None:
            here = here.withColumn("given", F.lit(total).cast("bigint"))
        else:
            up = above.select(*[F.col(c).alias(f"_u{i}") for i, c in enumerate(path[:-1])], F.col("budget").alias("given"))
            cond = None
            for i, c in enumerate(path[:-1]):
                one = F.col(c).eqNullSafe(F.col(f"_u{i}"))
                cond = one if cond is None else cond & one
            here = here.join(up, cond).drop(*[f"_u{i}" for i in range(depth)])
        order = [(F.col("room") / F.col("weight")).asc(), *[F.col(c).asc_nulls_first() for c in path]]
        among = W.partitionBy(*path[:-1]) if path[:-1] else W.partitionBy(F.lit(0))
        before = among.orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
        here = (here.withColumn("_taken", F.coalesce(F.sum("room").over(before), F.lit(0)))
                .withColumn("_left", F.sum("weight").over(among) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
                # what a unit of weight gets grows while children are used up and falls after: its top is the level
                .withColumn("_unit", F.max((F.col("given") - F.col("_taken")).cast("double") / F.col("_left")).over(among))
                .withColumn("budget", F.greatest(F.lit(0), F.least(
                    F.col("room"), F.floor(F.col("_unit") * F.col("weight")).cast("bigint"))).cast("bigint")))
        above = here.select(*path, "supply", "budget")
    return above


def mix(docs: DataFrame, levels: list[str], total: int | None = None, share: float = SHARE, weights=WEIGHTS,
        epochs: int = EPOCHS, seed: int = SEED, id_col: str = "id", tokens_col: str = "tokens") -> DataFrame:
    """(id, levels..., tokens, copies) of the chosen documents; ``copies`` counts the epochs that include them.

    ``docs`` has id, ``levels`` and tokens; ``total`` defaults to ``share`` of its tokens.
    """
    base = scratch(docs.select(F.col(id_col).alias("id"), *levels, F.col(tokens_col).alias("tokens"))
                   .where("tokens > 0"), "mix-documents")
    leaves = scratch(base.groupBy(*levels).agg(F.sum("tokens").alias("supply")), "mix-leaves")
    if total is None:
        total = int((leaves.agg(F.sum("supply")).first()[0] or 0) * share)
    given = scratch(budgets(leaves, levels, total, weights, epochs).withColumn(
        "whole", F.expr("cast(budget div supply as int)")).withColumn("rest", F.expr("budget % supply")), "mix-budgets")
    # the epoch that is read in part has an order of its own
    on = None
    for c in levels:
        one = base[c].eqNullSafe(given[c])
        on = one if on is None else on & one
    ranked = base.join(given, on).select(
        "id", *[base[c] for c in levels], "tokens", "whole", "rest",
        F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("whole"), F.coalesce(F.col("id").cast("string"), F.lit("")))
              .cast("binary")).alias("place")).withColumn("bucket", F.substring("place", 1, 3))
    ranked = scratch(ranked, "mix-ranked")
    keys = ranked.select(*levels).columns
    before = W.partitionBy(*keys).orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    cells = (ranked.groupBy(*keys, "bucket").agg(F.sum("tokens").alias("held"), F.first("rest").alias("rest"))
             .withColumn("ahead", F.coalesce(F.sum("held").over(before), F.lit(0)))
             .select(*[F.col(c).alias(f"_c{i}") for i, c in enumerate(keys)], F.col("bucket").alias("_b"), "ahead",
                     F.when(F.col("ahead") + F.col("held") <= F.col("rest"), "all")
                     .when(F.col("ahead") < F.col("rest"), "some").otherwise("none").alias("part")))
    cells = scratch(cells, "mix-cells")
    on = F.col("bucket") == F.col("_b")
    for i, c in enumerate(keys):
        on = on & F.col(c).eqNullSafe(F.col(f"_c{i}"))
    placed = ranked.join(cells, on)
    inside = W.partitionBy(*keys, "bucket").orderBy("place", "id", "tokens").rowsBetween(W.unboundedPreceding, 0)
    edge = placed.where("part = 'some'").withColumn("sum", F.sum("tokens").over(inside) + F.col("ahead")) \
        .select("id", *keys, "tokens", (F.col("whole") + (F.col("sum") <= F.col("rest")).cast("int")).alias("copies"))
    sure = placed.where("part <> 'some'").select(
        "id", *keys, "tokens", (F.col("whole") + (F.col("part") == "all").cast("int")).alias("copies"))
    return sure.unionByName(edge).where("copies > 0")


def with_tree(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, domain, lang, source, tokens) of documents."""
    return docs.select(F.col(id_col).alias("id"), domain_of("source").alias("domain"), "lang", "source",
                       tokens_of(F.col(text_col)).alias("tokens"))


LEVELS = ["domain", "lang", "source"]


def mixed(docs: DataFrame, **options) -> DataFrame:
    """``docs`` as the mixture has it: each row as often as its epochs include it, all columns kept."""
    named = {c: f"_in_{i}" for i, c in enumerate(docs.columns)}
    inner = docs.select([F.col(f"`{c}`").alias(n) for c, n in named.items()])
    key = named["doc_id"]
    copies = mix(with_tree(docs), LEVELS, **options).groupBy("id").agg(F.max("copies").alias("copies"))
    return (inner.join(copies, inner[key].eqNullSafe(copies["id"]))
            .withColumn("_n", F.explode(F.sequence(F.lit(1), F.col("copies"))))
            .select([F.col(n).alias(c) for c, n in named.items()]))
