"""Mixing sources to target weights by hierarchical budgets; DataFrame and SQL functions only.

Sources form a tree domain / language / source.  A token budget is handed
down: at each node the children share their parent's budget in proportion to
their weights, none gets more than the tokens below it can give in
``max_epochs`` epochs, and what a child cannot take goes to its siblings.
Since a node is never given more than its whole subtree can take, a shortage
leaves a node only when all children there are full, and is then shared among
the node's own siblings.

A leaf takes whole epochs of its documents, then the prefix of one more epoch:
documents in the order of md5(seed : epoch : doc_id) as long as the tokens
before them are below the rest of the budget.  (The last one may exceed it;
equal doc_ids stand and fall together.)  The prefix is found in two levels,
sums of 4096 blocks of the order and then the one block that holds the end, so
a leaf with a third of all documents is no single task.

Tokens are words.  A null lang or source is a leaf name of its own, "unknown";
null text has no tokens; a row without tokens takes nothing from a budget.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import stored

WORD = r"[^\x20\x09-\x0D]+"
LEVELS = ("domain", "lang", "source")
UNKNOWN = "unknown"
BLOCK_DIGITS = 3  # hex digits of the order key that name a block


@dataclass(frozen=True)
class Mix:
    """Target weights by level (a name without an entry has ``default``), budget and epochs.

    A domain is a regular expression's first group in ``source``, modulo the
    number of ``domains``: a rule that can be stated for any set of sources.
    """

    domains: tuple[str, ...] = ("web", "books", "forums")
    weights: dict[str, dict[str, float]] = field(
        default_factory=lambda: {
            "domain": {"web": 0.5, "books": 0.3, "forums": 0.2},
            "lang": {"en": 0.4, "de": 0.2, "fr": 0.2, "es": 0.2},
            "source": {},
        }
    )
    default: float = 0.1
    budget_share: float = 1.0  # of all tokens
    max_epochs: int = 2
    seed: int = 17


def domain_of(source: Column, mix: Mix) -> Column:
    number = F.regexp_extract(F.coalesce(source, F.lit("")), r"(\d{1,9})$", 1)
    names = F.array(*[F.lit(d) for d in mix.domains])
    return F.when(number != "", F.get(names, number.cast("int") % len(mix.domains))).otherwise(F.lit(UNKNOWN))


def leaf_columns(mix: Mix) -> dict[str, Column]:
    source = F.col("source").cast("string")
    return {
        "domain": domain_of(source, mix),
        "lang": F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)),
        "source": F.coalesce(source, F.lit(UNKNOWN)),
    }


def token_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def order_key(mix: Mix, epoch: Column) -> Column:
    doc = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    return F.md5(F.concat_ws(":", F.lit(str(mix.seed)), epoch.cast("string"), doc).cast("binary"))


def _weight(level: str, mix: Mix) -> Column:
    out = F.lit(float(mix.default))
    for name, weight in mix.weights.get(level, {}).items():
        out = F.when(F.col(level) == name, F.lit(float(weight))).otherwise(out)
    return out


def share_out(nodes: DataFrame, parent: list[str], name: str) -> DataFrame:
    """``nodes`` (parent columns, name, weight, cap, budget of the parent) with ``given``.

    Children in the order of capacity for weight: those whose capacity is
    below their share of what is left are full, the others share the rest.
    """
    group = Window.partitionBy(*parent) if parent else Window.partitionBy(F.lit(0))
    order = group.orderBy(F.col("ratio"), F.col(name))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    ranked = nodes.withColumn("ratio", F.when(F.col("weight") > 0, F.col("cap") / F.col("weight")).otherwise(F.lit(0.0)))
    ranked = ranked.withColumn(
        "level",
        F.when(
            F.sum("weight").over(onward) > 0,
            (F.least("budget", F.sum("cap").over(group)) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(onward),
        ).otherwise(F.lit(0.0)),
    )
    full = F.col("ratio") <= F.col("level")
    rest = F.max(F.when(~full, F.col("level"))).over(group)
    return ranked.withColumn("given", F.when(full, F.col("cap")).otherwise(F.col("weight") * rest)).drop("ratio", "level")


def leaf_budgets(rows: DataFrame, mix: Mix) -> DataFrame:
    """(domain, lang, source, tokens, budget, epochs, rest) of every leaf of ``rows`` (leaf columns, n_tokens)."""
    leaves = stored(rows.groupBy(*LEVELS).agg(F.sum("n_tokens").alias("tokens")), "mix-leaves")
    weights = {level: _weight(level, mix) for level in LEVELS}
    live = (weights["domain"] > 0) & (weights["lang"] > 0) & (weights["source"] > 0)
    leaves = leaves.withColumn("cap", F.when(live, F.col("tokens") * float(mix.max_epochs)).otherwise(F.lit(0.0)))
    total = leaves.agg((F.sum("tokens") * float(mix.budget_share)).alias("budget"))

    parent_cols: list[str] = []
    given: DataFrame | None = None
    for depth, level in enumerate(LEVELS, 1):
        path = list(LEVELS[:depth])
        nodes = leaves.groupBy(*path).agg(F.sum("cap").alias("cap")).withColumn("weight", weights[level])
        if given is None:
            nodes = nodes.join(F.broadcast(total))  # one row
        else:
            nodes = nodes.join(given, parent_cols)
        given = share_out(nodes, parent_cols, level).select(*path, F.col("given").alias("budget"))
        parent_cols = path
    out = leaves.select(*LEVELS, "tokens").join(given, list(LEVELS))
    budget = F.floor(F.col("budget") + 1e-6).cast("long")
    epochs = F.when(F.col("tokens") > 0, F.floor(budget / F.col("tokens"))).otherwise(F.lit(0)).cast("long")
    out = out.select(*LEVELS, "tokens", budget.alias("budget"), epochs.alias("epochs"))
    return out.withColumn("rest", F.col("budget") - F.col("epochs") * F.col("tokens"))


def leaf_cutoffs(rows: DataFrame, mix: Mix) -> DataFrame:
    """Leaf columns, ``epochs`` taken whole, and ``cutoff``: the last order key taken of the next one (or null)."""
    budgets = stored(leaf_budgets(rows, mix), "mix-budgets")
    keyed = rows.join(budgets.where("rest > 0").select(*LEVELS, "epochs", "rest"), list(LEVELS))
    key = order_key(mix, F.col("epochs"))
    keyed = keyed.select(*LEVELS, "n_tokens", "rest", key.alias("key"), F.substring(key, 1, BLOCK_DIGITS).alias("block"))
    blocks = keyed.groupBy(*LEVELS, "block").agg(F.sum("n_tokens").alias("n_tokens"), F.max("rest").alias("rest"))
    above = Window.partitionBy(*LEVELS).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("before", F.coalesce(F.sum("n_tokens").over(above), F.lit(0)))
    end = blocks.where("before < rest").groupBy(*LEVELS).agg(F.max(F.struct("block", "before")).alias("end"))
    end = end.select(*LEVELS, F.col("end.block").alias("block"), F.col("end.before").alias("before"))
    inside = keyed.join(end, [*LEVELS, "block"])
    # Equal keys are peers: the default frame ends after the last of them.
    upto = Window.partitionBy(*LEVELS).orderBy("key")
    inside = inside.groupBy(*LEVELS, "key").agg(F.sum("n_tokens").alias("n_tokens"), F.max("rest").alias("rest"), F.max("before").alias("before"))
    inside = inside.withColumn("start", F.col("before") + F.sum("n_tokens").over(upto) - F.col("n_tokens"))
    cutoffs = inside.where("start < rest").groupBy(*LEVELS).agg(F.max("key").alias("cutoff"))
    return budgets.select(*LEVELS, "epochs").join(cutoffs, list(LEVELS), "left")


def _stored_cutoffs(rows: DataFrame, mix: Mix) -> DataFrame:
    """The cut-offs as a table of their own: joined to it, a leaf with a third of all rows can be split (or the
    table broadcast), which AQE cannot do to a join that shares a shuffle with an aggregate."""
    return stored(leaf_cutoffs(rows, mix), "mix-cutoffs")


def _taken(rows: DataFrame, cutoffs: DataFrame, mix: Mix) -> DataFrame:
    """A row for each epoch in which a row of ``rows`` is taken; leaf columns stand in ``LEVELS``."""
    last = F.coalesce(order_key(mix, F.col("epochs")) <= F.col("cutoff"), F.lit(False))
    copies = F.col("epochs") + F.when(last, 1).otherwise(0)
    joined = rows.join(cutoffs, list(LEVELS)).withColumn("copies", copies).where("copies > 0")
    return joined.withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1))).drop("copies", "epochs", "cutoff")


def _narrow(docs: DataFrame, mix: Mix) -> DataFrame:
    leaf = leaf_columns(mix)
    return docs.select("doc_id", *[leaf[c].alias(c) for c in LEVELS], token_count(F.col("text").cast("string")).alias("n_tokens"))


def mixture(docs: DataFrame, mix: Mix | None = None) -> DataFrame:
    """(doc_id, domain, lang, source, n_tokens, epoch): a row for each time a document is taken."""
    mix = mix or Mix()
    rows = stored(_narrow(docs, mix), "mix-rows")
    return _taken(rows, _stored_cutoffs(rows, mix), mix).select("doc_id", *LEVELS, "n_tokens", "epoch")


def take_mixture(docs: DataFrame, mix: Mix | None = None) -> DataFrame:
    """The rows of ``docs``, each as often as it is taken, all columns as they are; the texts are not shuffled
    as long as the cut-offs (a row for each leaf) are small enough for Spark to broadcast."""
    mix = mix or Mix()
    rows = stored(_narrow(docs, mix), "mix-rows")
    leaf = leaf_columns(mix)
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    taken = _taken(docs.select("doc_id", *[leaf[c].alias(c) for c in LEVELS], whole), _stored_cutoffs(rows, mix), mix)
    return taken.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


def mixture_sql(mix: Mix | None = None) -> str:
    """DuckDB SQL for :func:`mixture`, without its blocks."""
    mix = mix or Mix()

    def weight(level: str) -> str:
        cases = " ".join(f"WHEN {level} = '{n}' THEN {float(w)!r}::DOUBLE" for n, w in mix.weights.get(level, {}).items())
        return f"CASE {cases} ELSE {float(mix.default)!r}::DOUBLE END" if cases else f"{float(mix.default)!r}::DOUBLE"

    names = "[" + ", ".join(f"'{d}'" for d in mix.domains) + "]"
    ctes = [
        f"""rows AS (
  SELECT doc_id, coalesce(lang, '{UNKNOWN}') AS lang, coalesce(source, '{UNKNOWN}') AS source,
         CASE WHEN regexp_extract(coalesce(source, ''), '(\\d{{1,9}})$', 1) <> ''
              THEN {names}[regexp_extract(source, '(\\d{{1,9}})$', 1)::INTEGER % {len(mix.domains)} + 1] ELSE '{UNKNOWN}' END AS domain,
         coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS n_tokens
  FROM documents)""",
        f"""leaves AS (
  SELECT *, CASE WHEN ({weight("domain")}) > 0 AND ({weight("lang")}) > 0 AND ({weight("source")}) > 0
            THEN tokens * {float(mix.max_epochs)!r}::DOUBLE ELSE 0::DOUBLE END AS cap
  FROM (SELECT domain, lang, source, sum(n_tokens)::BIGINT AS tokens FROM rows GROUP BY ALL))""",
        f"b0 AS (SELECT (sum(tokens) * {float(mix.budget_share)!r}::DOUBLE)::DOUBLE AS budget FROM leaves)",
    ]
    for depth, level in enumerate(LEVELS, 1):
        path = ", ".join(LEVELS[:depth])
        parents = ", ".join(LEVELS[: depth - 1])
        group = f"PARTITION BY {parents}" if parents else ""
        join = f"JOIN b{depth - 1} USING ({parents})" if parents else "CROSS JOIN b0"
        ctes += [
            f"n{depth} AS (SELECT *, CASE WHEN weight > 0 THEN cap / weight ELSE 0 END AS ratio FROM "
            f"(SELECT {path}, sum(cap) AS cap, any_value({weight(level)}) AS weight FROM leaves GROUP BY {path}) {join})",
            f"l{depth} AS (SELECT *, CASE WHEN sum(weight) OVER onward > 0 THEN (least(budget, sum(cap) OVER (whole)) "
            f"- coalesce(sum(cap) OVER before, 0)) / sum(weight) OVER onward ELSE 0 END AS level FROM n{depth} "
            f"WINDOW whole AS ({group}), "
            f"before AS ({group} ORDER BY ratio, {level} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), "
            f"onward AS ({group} ORDER BY ratio, {level} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))",
            f"b{depth} AS (SELECT {path}, CASE WHEN ratio <= level THEN cap "
            f"ELSE weight * max(level) FILTER (ratio > level) OVER ({group}) END AS budget FROM l{depth})",
        ]
    ctes += [
        """cut AS (SELECT *, budget - epochs * tokens AS rest FROM (
  SELECT domain, lang, source, tokens, floor(b3.budget + 1e-6)::BIGINT AS budget,
         CASE WHEN tokens > 0 THEN floor(floor(b3.budget + 1e-6)::BIGINT / tokens)::BIGINT ELSE 0 END AS epochs
  FROM leaves JOIN b3 USING (domain, lang, source)))""",
        f"""keyed AS (SELECT rows.*, epochs, rest, md5('{mix.seed}:' || epochs || ':' || coalesce(doc_id::VARCHAR, '')) AS key
  FROM rows JOIN cut USING (domain, lang, source))""",
        """started AS (SELECT *, sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY key)
    - sum(n_tokens) OVER (PARTITION BY domain, lang, source, key) AS start FROM keyed)""",
        """taken AS (SELECT *, epochs + CASE WHEN start < rest THEN 1 ELSE 0 END AS copies FROM started)""",
    ]
    return (
        "WITH " + ",\n".join(ctes) + "\nSELECT doc_id, domain, lang, source, n_tokens, unnest(range(copies))::BIGINT AS epoch FROM taken WHERE copies > 0"
    )
