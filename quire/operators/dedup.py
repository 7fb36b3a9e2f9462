"""Headers and footers of a document: affixes that its texts repeat are cut, longest first."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions import text as X
from quire.options import Options


def affix_counts(texts: DataFrame, key: str = "key", text: str = "chunk_text", opts: Options = Options()) -> DataFrame:
    """`key, side, affix, n`: affixes longer than `affix_min` that more than `affix_count` texts of a document share."""
    head = X.strip(F.left(F.col(text), F.lit(opts.affix_length)))
    tail = X.strip(F.right(F.col(text), F.lit(opts.affix_length)))
    both = texts.select(F.col(key).alias("key"), F.explode(F.array(F.struct(F.lit("prefix").alias("side"), head.alias("affix")), F.struct(F.lit("suffix").alias("side"), tail.alias("affix")))).alias("a"))
    counted = both.select("key", "a.side", "a.affix").where(F.length("affix") > opts.affix_min).groupBy("key", "side", "affix").agg(F.count(F.lit(1)).alias("n"))
    return counted.where(F.col("n") > opts.affix_count)


def strip_affixes(texts: DataFrame, affixes: DataFrame, text: str = "chunk_text", only: Column | None = None) -> DataFrame:
    """Texts (with `key`) after at most one prefix and one suffix is cut; adds `removed` (array of flags).

    Where several affixes fit the longest is taken.  A document has few common affixes (at most its texts
    over `affix_count`); they come as one array for each document.  With `only`, other rows stay as they are.
    """
    may = F.lit(True) if only is None else only
    side = lambda s: F.collect_list(F.when(F.col("side") == s, F.col("affix")))
    per = affixes.groupBy("key").agg(side("prefix").alias("_pre"), side("suffix").alias("_suf"))
    j = texts.join(per, "key", "left")
    longest = lambda c: F.get(F.array_sort(c, lambda a, b: F.length(b) - F.length(a)), F.lit(0))
    j = j.withColumn("_p", longest(F.filter("_pre", lambda p: may & F.startswith(F.col(text), p))))
    cut = F.when(F.col("_p").isNotNull(), X.strip(F.substr(F.col(text), F.length("_p") + 1))).otherwise(F.col(text))
    j = j.withColumn("_t", cut).withColumn("_s", longest(F.filter("_suf", lambda s: may & F.endswith(F.col("_t"), s))))
    done = F.when(F.col("_s").isNotNull(), X.strip(F.left(F.col("_t"), F.length("_t") - F.length("_s")))).otherwise(F.col("_t"))
    flags = F.filter(F.array(F.when(F.col("_p").isNotNull(), F.lit("removed_header")), F.when(F.col("_s").isNotNull(), F.lit("removed_footer"))), lambda x: x.isNotNull())
    return j.withColumn(text, done).withColumn("removed", flags).drop("_pre", "_suf", "_p", "_t", "_s")
