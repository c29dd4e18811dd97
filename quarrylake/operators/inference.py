"""Missing codes in tiers of falling confidence."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .windows import most_frequent


def _share_a_piece(names: DataFrame, entries: DataFrame, most_ratio: float) -> DataFrame:
    """names (__n) with the entries (__cn, __cc) that can lie within the ratio; no such pair is lost.

    An entry of length m can be at most t = m * ratio / (1 - ratio) edits from a name within the ratio. Cut into t + 1 pieces,
    one of them stands unchanged in the name, at most t places from its own: so a name is asked for its own pieces of every
    length an entry can have, at those places, and the two meet by equality of (m, piece's number, piece).
    """
    edits = lambda m: F.floor(m * F.lit(most_ratio / (1 - most_ratio)) + F.lit(1e-9)).cast("int")
    begin = lambda m, t, i: F.floor(i * m / (t + 1)).cast("int")
    m, t, i, p = map(F.col, ("__m", "__t", "__i", "__p"))
    entries = entries.withColumn("__m", F.length("__cn")).withColumn("__t", edits(m)).withColumn("__i", F.explode(F.sequence(F.lit(0), t)))
    entries = entries.withColumn("__piece", F.substring(F.col("__cn"), begin(m, t, i) + 1, begin(m, t, i + 1) - begin(m, t, i))).drop("__t")
    n = F.length("__n")
    reach = F.floor(n * F.lit(most_ratio / (1 - most_ratio)) + F.lit(1e-9)).cast("int")
    asked = names.withColumn("__m", F.explode(F.sequence(F.greatest(n - reach, F.lit(0)), n + reach))).withColumn("__t", edits(m)).withColumn("__i", F.explode(F.sequence(F.lit(0), t)))
    asked = asked.withColumns({"__b": begin(m, t, i), "__l": begin(m, t, i + 1) - begin(m, t, i)})
    first, last = F.greatest(F.col("__b") - t, F.lit(0)), F.least(F.col("__b") + t, n - F.col("__l"))
    asked = asked.filter(first <= last).withColumn("__p", F.explode(F.sequence(first, last)))
    asked = asked.select("__n", "__m", "__i", F.substring(F.col("__n"), p + 1, F.col("__l")).alias("__piece")).distinct()
    return asked.join(entries, ["__m", "__i", "__piece"]).select("__n", "__cn", "__cc").distinct()


def infer_codes(items: DataFrame, catalogue: DataFrame, item: str, name: str, group: str, code: str, most_ratio: float = 0.15) -> DataFrame:
    """items with inferred_code, tier and confidence.

    SOURCE: the item's own code (1.0). EXACT_NAME: the catalogue's entry of that name (0.95; the least code of several).
    FUZZY_NAME: the entry whose name is nearest by edit distance, if within most_ratio of the longer length and strictly nearer
    than any other code's (1 - ratio). GROUP: the most frequent code of the group (0.4). UNMAPPED (0). Catalogue columns are
    `name`, `group`, `code`; it is met only by the distinct names that are in no tier yet, over pieces of names that any pair
    within the ratio must share. Null names skip the name tiers, null groups the group tier.
    """
    cat = catalogue.select(F.col(name).alias("__cn"), F.col(group).alias("__cg"), F.col(code).alias("__cc")).dropna(subset=["__cc"])
    exact = cat.filter("__cn is not null").groupBy(F.col("__cn").alias(name)).agg(F.min("__cc").alias("__exact"))
    rows = items.join(exact, name, "left")
    todo = rows.filter(F.col(code).isNull() & F.col("__exact").isNull() & F.col(name).isNotNull()).select(F.col(name).alias("__n")).distinct()
    close = _share_a_piece(todo, cat.filter("__cn is not null").select("__cn", "__cc").distinct(), most_ratio)
    close = close.withColumn("__d", F.levenshtein("__n", "__cn")).withColumn("__r", F.col("__d") / F.greatest(F.length("__n"), F.length("__cn")))
    near = close.filter(F.col("__r") <= most_ratio).groupBy("__n", "__cc").agg(F.min("__d").alias("__d"), F.min("__r").alias("__r"))
    w = Window.partitionBy("__n").orderBy("__d", "__cc")
    best = near.withColumn("__rank", F.row_number().over(w)).withColumn("__next", F.lead("__d").over(w)).filter("__rank = 1 and (__next is null or __next > __d)")
    best = best.select(F.col("__n").alias(name), F.col("__cc").alias("__fuzzy"), "__r")
    modal = most_frequent(cat.withColumnRenamed("__cg", group), [group], "__cc").select(group, F.col("__cc").alias("__modal")).filter(F.col(group).isNotNull())
    rows = rows.join(best, name, "left").join(modal, group, "left")
    tier = F.when(F.col(code).isNotNull(), "SOURCE").when(F.col("__exact").isNotNull(), "EXACT_NAME").when(F.col("__fuzzy").isNotNull(), "FUZZY_NAME").when(F.col("__modal").isNotNull(), "GROUP").otherwise("UNMAPPED")
    sure = F.when(F.col("tier") == "SOURCE", 1.0).when(F.col("tier") == "EXACT_NAME", 0.95).when(F.col("tier") == "FUZZY_NAME", F.round(1 - F.col("__r"), 4)).when(F.col("tier") == "GROUP", 0.4).otherwise(0.0)
    rows = rows.withColumn("tier", tier).withColumn("confidence", sure).withColumn("inferred_code", F.coalesce(code, "__exact", "__fuzzy", "__modal"))
    return rows.drop("__exact", "__fuzzy", "__modal", "__r")
