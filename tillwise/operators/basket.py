"""Market-basket analysis: cleaning, baskets, frequent itemsets, rules.

Spark-first replacements for the single-machine steps:

* the dense invoices x items boolean matrix becomes one array of item codes
  per invoice (``collect_set``), so memory is O(lines), not O(invoices x items);
* Apriori becomes Spark ML's parallel FP-Growth, given a threshold between the
  smallest count that passes and the one below it, so it mines the frequent
  itemsets and no others; with a longest itemset, a level-wise miner over
  vertical bitmaps takes its place, which never counts a longer one;
* rules -- every split of a frequent itemset into a non-empty antecedent and
  consequent -- grow their consequents item by item; since confidence only
  falls as a consequent grows, a split below the minimum is not grown;
* descriptions come from a distributed mode per item (two-level aggregate).
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

# ------------------------------------------------------------------ cleaning

def clean_steps(df: DataFrame) -> list[tuple[str, Column]]:
    """The cumulative cleaning predicates, in the order they are applied."""
    s1 = F.col("invoice_number").isNotNull() & F.col("item_code").isNotNull()
    s2 = s1 & (F.col("is_return") == 0)
    s3 = s2 & (F.col("is_anonymous") == 0)
    s4 = s3 & (F.col("quantity") > 0)
    return [("after_missing", s1), ("after_returns", s2),
            ("after_anonymous", s3), ("after_positive_qty", s4)]


def clean_report(df: DataFrame) -> DataFrame:
    """Rows left after each cleaning step, in one pass (no job per step).

    The de-duplicated count is a distinct count of (invoice, item) among
    the rows passing every filter.
    """
    steps = clean_steps(df)
    last = steps[-1][1]
    counts = [F.count(F.lit(1)).alias("initial_rows")]
    counts += [F.count_if(cond).alias(name) for name, cond in steps]
    counts.append(F.countDistinct(F.when(last, F.col("invoice_number")), F.col("item_code"))
                   .alias("after_dedup"))
    r = df.agg(*counts)
    return r.select("*", (F.col("initial_rows") - F.col("after_dedup")).alias("rows_removed"),
                    F.round(F.try_divide((F.col("initial_rows") - F.col("after_dedup")) * 100.0,
                                         F.col("initial_rows")), 1).alias("pct_removed"))


def preprocess(df: DataFrame) -> DataFrame:
    """Drop missing keys, returns, anonymous lines, non-positive quantities,
    then keep one row per (invoice_number, item_code).

    The kept description of a duplicated pair is the smallest non-null one
    (the file order that decided it on a single machine does not exist in
    a distributed table).  Map-side partial aggregation makes this safe
    for an invoice or item holding a large share of the lines.
    """
    steps = clean_steps(df)
    return (df.filter(steps[-1][1])
              .groupBy("invoice_number", "item_code")
              .agg(F.min("item_description").alias("item_description")))


# ------------------------------------------------------------------ baskets

def baskets(clean_lines: DataFrame) -> DataFrame:
    """invoice_number, items: the sorted distinct item codes of each invoice."""
    return (clean_lines.groupBy("invoice_number")
                       .agg(F.array_sort(F.collect_set("item_code")).alias("items")))


# ------------------------------------------------------------------ itemsets

def frequent_itemsets(basket_df: DataFrame, min_support: float,
                      max_len: int | None = None, n_baskets: int | None = None,
                      num_partitions: int | None = None) -> DataFrame:
    """items (sorted array), freq, support, length -- every frequent itemset.

    The test is ``freq / n >= min_support`` in double precision.  It is turned
    into the smallest passing count first, so the miner neither loses an
    itemset on the boundary nor grows one below it.  With ``max_len``
    the itemsets are mined level by level (``itemsets_by_level``).

    Runs jobs (the basket count, the mining) when called.
    """
    if not 0 < min_support <= 1:
        raise ValueError(f"the minimum support is a share above 0 and up to 1, not {min_support}")
    if max_len is not None and max_len < 1:
        raise ValueError(f"the longest itemset needs at least one item, not {max_len}")
    level = basket_df.storageLevel
    cached = level.useMemory or level.useDisk   # the caller's cache already serves both passes
    items = basket_df.select("items")
    if not cached:  # the count and the mining passes share one computation
        items = items.persist()
    ensure_checkpoint_dir(basket_df.sparkSession)
    try:
        n = n_baskets if n_baskets is not None else items.count()
        if n == 0:
            return basket_df.sparkSession.createDataFrame(
                [], "items array<string>, freq bigint, support double, length int")
        least = smallest_passing_count(min_support, n)
        if max_len is not None:
            found = itemsets_by_level(items, least, max_len)
        else:
            # half a count below the smallest passing one: no other count lies between
            fp = FPGrowth(itemsCol="items", minSupport=(least - 0.5) / n, minConfidence=1.0)
            if num_partitions:
                fp.setNumPartitions(num_partitions)
            found = fp.fit(items).freqItemsets.select(
                F.array_sort("items").alias("items"), F.col("freq").cast("bigint").alias("freq"))
        out = (found.withColumn("support", F.col("freq").cast("double") / F.lit(float(n)))
                    .withColumn("length", F.size("items")))
        # FP-Growth's itemsets are a lazy RDD over its input; writing them
        # once (they are few next to the baskets) keeps the rule joins, which
        # read them repeatedly, from mining again.
        return out.checkpoint(eager=True)
    finally:
        if not cached:
            items.unpersist()


def smallest_passing_count(min_support: float, n: int) -> int:
    """The least count c >= 1 with c / n >= min_support in double precision."""
    c = max(1, math.floor(min_support * n) - 1)
    while c / n < min_support:
        c += 1
    return c


def itemsets_by_level(items: DataFrame, least: int, max_len: int) -> DataFrame:
    """items (sorted), freq: itemsets of at most ``max_len`` items in at least ``least`` baskets.

    Vertical sets: baskets are numbered, and the baskets of an itemset are the bits of 64-basket
    words, one row (itemset, block, word) for each word that is not zero.  Items are
    counted first; pairs of frequent items are counted by a join of the lines on
    their basket, so an invoice of many items is many rows and never one array of
    pairs.  From then on two itemsets of equal prefix and block give a longer one by
    the AND of their words, and its count is the sum of the bits.  Only words of frequent
    itemsets reach the next level, and the last level keeps none.

    Runs a few jobs a level when called.
    """
    ids = items.select(F.monotonically_increasing_id().alias("_b"), "items")
    # written once: the numbers must not change when a task runs again
    lines = ids.select("_b", F.explode("items").alias("item")).checkpoint(eager=True)
    ones = lines.groupBy("item").agg(F.count(F.lit(1)).alias("freq")).filter(F.col("freq") >= least)
    ones = ones.select(F.array("item").alias("items"), "freq").checkpoint(eager=True)
    found = [ones]
    if max_len > 1:
        kept = lines.join(ones.select(F.col("items")[0].alias("item")), "item", "left_semi").select("_b", "item")
        pairs = kept.alias("a").join(kept.alias("b"), "_b").filter(F.col("a.item") < F.col("b.item")) \
                    .select("_b", F.col("a.item").alias("x"), F.col("b.item").alias("y"))
        twos = pairs.groupBy("x", "y").agg(F.count(F.lit(1)).alias("freq")).filter(F.col("freq") >= least).checkpoint(eager=True)
        found.append(twos.select(F.array("x", "y").alias("items"), "freq"))
    if max_len > 2:
        bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod("_b", F.lit(64)).cast("int"))
        words = (pairs.join(twos, ["x", "y"], "left_semi")
                      .groupBy(F.array("x").alias("prefix"), F.col("y").alias("last"), F.shiftrightunsigned("_b", 6).alias("block"))
                      .agg(F.bit_or(bit).alias("word")).checkpoint(eager=True))
    for length in range(3, max_len + 1):
        a, b = words.alias("a"), words.alias("b")
        both = a.join(b, ["prefix", "block"]).filter(F.col("a.last") < F.col("b.last"))
        longer = both.select(F.concat("prefix", F.array("a.last")).alias("prefix"), F.col("b.last").alias("last"), "block",
                             F.col("a.word").bitwiseAND(F.col("b.word")).alias("word")).filter(F.col("word") != 0)
        counts = longer.groupBy("prefix", "last").agg(F.sum(F.bit_count("word")).alias("freq")).filter(F.col("freq") >= least).checkpoint(eager=True)
        found.append(counts.select(F.concat("prefix", F.array("last")).alias("items"), "freq"))
        if length == max_len or counts.isEmpty():
            break
        words = longer.join(counts, ["prefix", "last"], "left_semi").checkpoint(eager=True)
    return reduce(DataFrame.unionByName, found)


# ------------------------------------------------------------------ rules

def association_rules(itemsets: DataFrame, min_confidence: float | None = None,
                      min_lift: float = 1.0) -> DataFrame:
    """All rules A -> C with A, C non-empty, A u C frequent, lift >= min_lift,
    then confidence >= min_confidence.

    Level by level: the first consequents hold one item; a split that passes
    the minimum confidence is grown by items behind its consequent's last one,
    the others are not, since moving an item from A to C can only raise s(A)
    and so lower the confidence.  With no minimum every split is grown.  Each
    level is one join with the itemset supports; there are at most as many
    levels as the longest itemset has items minus one.  Metrics: support
    s(AC), confidence s(AC)/s(A), lift conf/s(C), leverage
    s(AC) - s(A)s(C), conviction (1 - s(C))/(1 - conf), infinite at conf 1.

    Runs a job per level when called.
    """
    ensure_checkpoint_dir(itemsets.sparkSession)
    sup = itemsets.select("items", "support")
    a = sup.select(F.col("items").alias("antecedents"), F.col("support").alias("antecedent_support"))
    c = sup.select(F.col("items").alias("consequents"), F.col("support").alias("consequent_support"))
    longest = itemsets.agg(F.max("length")).first()[0] or 0
    empty = F.array().cast("array<string>")
    level = (itemsets.filter(F.col("length") >= 2)
                     .select("items", "support", empty.alias("consequents")))
    found = []
    for size in range(1, max(longest, 2)):
        last = F.col("consequents")
        behind = F.col("items") if size == 1 else F.filter("items", lambda x: x > F.element_at(last, -1))
        grown = (level.filter(F.size("items") > size)
                      .select("items", "support", "consequents", F.explode(behind).alias("_x"))
                      .select("items", "support", F.concat("consequents", F.array("_x")).alias("consequents")))
        split = grown.withColumn("antecedents", F.array_except("items", "consequents")).join(a, "antecedents")
        if min_confidence is not None:
            split = split.filter(F.col("support") / F.col("antecedent_support") >= F.lit(float(min_confidence)))
        level = split.checkpoint(eager=True)
        found.append(level)
        if size + 1 < longest and level.isEmpty():
            break
    r = reduce(DataFrame.unionByName, found).join(c, "consequents")
    conf = F.col("support") / F.col("antecedent_support")
    r = r.withColumn("confidence", conf)
    r = r.withColumn("lift", F.col("confidence") / F.col("consequent_support"))
    r = r.withColumn("leverage", F.col("support") - F.col("antecedent_support") * F.col("consequent_support"))
    r = r.withColumn("conviction",
                     F.when(F.col("confidence") >= 1.0, F.lit(float("inf")))
                      .otherwise((1.0 - F.col("consequent_support")) / (1.0 - F.col("confidence"))))
    r = r.filter(F.col("lift") >= F.lit(float(min_lift)))
    return r.select("antecedents", "consequents", "antecedent_support", "consequent_support",
                    "support", "confidence", "lift", "leverage", "conviction",
                    F.size("antecedents").alias("antecedent_len"),
                    F.size("consequents").alias("consequent_len"))


# ------------------------------------------------------------------ descriptions

def item_mode(clean_lines: DataFrame) -> DataFrame:
    """item_code, item_description: the most frequent non-null description;
    ties go to the smallest; an item with only null descriptions gets null.

    Two-level aggregate: count per (item, description) with map-side
    combine, then the best pair per item -- no group ever holds raw lines.
    """
    return mode_by(clean_lines, "item_code", "item_description")


def mode_by(df: DataFrame, key: str, value: str) -> DataFrame:
    """key, value: the most frequent non-null value of each key (ties: the
    smallest); a key whose values are all null keeps its row, with null."""
    counts = df.groupBy(key, value).agg(F.count(F.lit(1)).alias("_n"))
    best = F.min(F.struct(F.col(value).isNull().alias("none"), (-F.col("_n")).alias("n"), F.col(value).alias("v")))
    return counts.groupBy(key).agg(best.alias("_b")).select(key, F.col("_b.v").alias(value))


def attach_descriptions(rules: DataFrame, clean_lines: DataFrame) -> DataFrame:
    """Add comma-joined codes and descriptions (in code order) to each rule.

    Unknown codes, or codes whose descriptions are all null, read
    ``Unknown (<code>)``.  Items are exploded with their side and position,
    joined to the mode table (the planner broadcasts it when its runtime
    size is small) and collected back per rule in order.
    """
    modes = item_mode(clean_lines)
    # Fixed value: the text for an item without a description is "Unknown (<code>)".
    keyed = rules.withColumn("antecedent_codes", F.array_join("antecedents", ", ")) \
                 .withColumn("consequent_codes", F.array_join("consequents", ", "))
    rule_cols = keyed.columns
    key = ["antecedents", "consequents"]   # what identifies a rule
    tagged = F.concat(
        F.transform("antecedents", lambda x, i: F.struct(F.lit(0).alias("side"), i.alias("pos"),
                                                            x.alias("item_code"))),
        F.transform("consequents", lambda x, i: F.struct(F.lit(1).alias("side"), i.alias("pos"),
                                                            x.alias("item_code"))))
    exploded = keyed.select(*rule_cols, F.explode(tagged).alias("_t")) \
                    .select(*rule_cols, "_t.side", "_t.pos", "_t.item_code")
    described = exploded.join(modes, "item_code", "left").withColumn(
        "_d", F.coalesce(F.col("item_description"),
                         F.concat(F.lit("Unknown ("), F.col("item_code"), F.lit(")"))))
    rest = [c for c in rule_cols if c not in key]
    per_rule = described.groupBy(*key).agg(
        *[F.first(c).alias(c) for c in rest],   # the same in every row of a rule
        F.array_sort(F.collect_list(F.struct("side", "pos", "_d"))).alias("_parts"))

    def join_side(side: int) -> Column:
        part = F.filter("_parts", lambda p: p["side"] == side)
        return F.array_join(F.transform(part, lambda p: p["_d"]), ", ")

    return per_rule.select(*rule_cols, join_side(0).alias("antecedent_descriptions"),
                           join_side(1).alias("consequent_descriptions"))


def sort_rules(rules: DataFrame) -> DataFrame:
    """Lift desc, confidence desc; codes break the remaining ties."""
    return rules.orderBy(F.col("lift").desc(), F.col("confidence").desc(),
                         "antecedent_codes", "consequent_codes")


def top_described(rules: DataFrame, clean_lines: DataFrame, n: int = 5) -> DataFrame:
    """The n best rules with their descriptions: the limit comes first, so only n rules are described."""
    keyed = rules.withColumn("antecedent_codes", F.array_join("antecedents", ", ")) \
                 .withColumn("consequent_codes", F.array_join("consequents", ", "))
    best = sort_rules(keyed).limit(n).drop("antecedent_codes", "consequent_codes")
    return sort_rules(attach_descriptions(best, clean_lines))


def top_rules(rules: DataFrame, n: int = 5) -> DataFrame:
    """The n best rules by lift then confidence (TakeOrderedAndProject: a top-n
    per partition, then one merge of at most n x partitions rows)."""
    return sort_rules(rules).limit(n)


# ------------------------------------------------------------------ pipeline

@dataclass
class BasketResult:
    clean_lines: DataFrame
    baskets: DataFrame
    itemsets: DataFrame
    rules: DataFrame
    summary: DataFrame
    cleaning: DataFrame

    def release(self) -> None:
        """Drop the cached cleaned lines and baskets once the outputs are written."""
        self.clean_lines.unpersist()
        self.baskets.unpersist()


def market_basket(df: DataFrame, min_support: float = 0.01, min_confidence: float = 0.2,
                  max_len: int | None = None, strict: bool = True) -> BasketResult:
    """The whole basket job on the cleaned transaction table.

    Parameter checks raise ``ValueError``.  With ``strict`` the four empty
    outcomes raise too (nothing left after cleaning, no frequent itemset, no
    rule, no rule above the confidence); otherwise they come back as empty
    frames.  The lines and baskets are cached until ``release`` (or until an
    error); itemsets and rules are checkpointed, so each is computed once.
    """
    check_basket_parameters(min_support, min_confidence, max_len)
    lines = preprocess(df).persist()
    b = baskets(lines).persist()
    try:
        n = b.count()
        if strict and n == 0:
            raise ValueError("cleaning left no line to mine")
        its = frequent_itemsets(b, min_support, max_len, n_baskets=n)
        if strict and its.isEmpty():
            raise ValueError(f"no itemset reaches the support {min_support}; a lower support may find some")
        plain = association_rules(its, min_confidence).checkpoint(eager=True)
        if strict and plain.isEmpty():
            if association_rules(its, None).isEmpty():
                raise ValueError("the frequent itemsets give no rule of positive association")
            raise ValueError(f"no rule reaches the confidence {min_confidence}; a lower confidence may find some")
        # the counts read the plain rules: descriptions change no count
        return BasketResult(lines, b, its, attach_descriptions(plain, lines),
                            summarize(b, lines, its, plain), clean_report(df))
    except BaseException:
        b.unpersist()
        lines.unpersist()
        raise


def check_basket_parameters(min_support: float, min_confidence: float, max_len: int | None) -> None:
    for name, value in (("support", min_support), ("confidence", min_confidence)):
        if not 0 < value <= 1:
            raise ValueError(f"the minimum {name} is a share above 0 and up to 1, not {value}")
    if max_len is not None and max_len < 1:
        raise ValueError(f"the longest itemset needs at least one item, not {max_len}")


def summarize(basket_df: DataFrame, clean_lines: DataFrame, itemsets: DataFrame,
              rules: DataFrame) -> DataFrame:
    """One row: transactions, unique products, frequent itemsets, rules
    (three scalar subqueries next to the basket count)."""
    return basket_df.agg(F.count(F.lit(1)).alias("n_transactions")).select(
        "n_transactions",
        clean_lines.agg(F.countDistinct("item_code")).scalar().alias("n_products"),
        itemsets.agg(F.count(F.lit(1))).scalar().alias("n_itemsets"),
        rules.agg(F.count(F.lit(1))).scalar().alias("n_rules"))
