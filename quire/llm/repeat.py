"""Repetition inside a single document.

The share of a document is the part of its word runs (`n` consecutive words, one run from each start)
that equal a run starting earlier in the same text: (runs - distinct runs) / runs.  Words are maximal
runs of letters and numbers of the lower-cased text.  Line and sentence shares are measured likewise.

Cutoffs are not fixed: a mergeable quantile sketch (KLL) of the shares is kept for each language and
source; sketches merge upwards to language and to the whole corpus.  A group's cutoff is its own quantile
and its parent's, weighted by its documents and by PRIOR documents; the same holds for languages in the corpus.  So
every group's own sketch counts, more the larger it is.  Documents are joined with their group's cutoff and filtered.
All of it is partial aggregation of fixed-size sketches, exact up to K documents: a hot language or source costs no
more than any other.

Results: a null, empty or wordless text has 0 words, 0 runs and share 0.0, a text of fewer than `n`
words has 0 runs; null language and source form groups of their own; repeated rows stay; long texts are
read whole.  Only the named columns are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Documents that the parent's quantile counts for, and items that a sketch keeps exactly.
PRIOR, K = 20, 1024


def words(text: Column) -> Column:
    """Array of maximal runs of letters and numbers of the lower-cased text."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def _share(total: Column, distinct: Column) -> Column:
    return F.when(total > 0, (total - distinct) / total).otherwise(F.lit(0.0))


def repetition(df: DataFrame, key: str = "doc_id", text: str = "text", groups: tuple[str, ...] = ("lang", "source"), n: int = 6) -> DataFrame:
    """`key`, the group columns, `words, runs, repeated_runs, run_share, line_share, sentence_share`."""
    text_col = F.coalesce(F.col(text), F.lit(""))
    # Each run becomes one 64-bit hash of n neighbouring word hashes, so the distinct set holds longs.
    hashes = F.transform(words(text_col), lambda w: F.xxhash64(w))
    runs = lambda w: F.when(
        F.size(w) >= n, F.transform(F.sequence(F.lit(1), F.size(w) - (n - 1)), lambda i: F.xxhash64(F.slice(w, i, F.lit(n))))
    ).otherwise(F.array().cast("array<bigint>"))
    clean = lambda pieces: F.filter(F.transform(pieces, lambda x: F.trim(F.regexp_replace(F.lower(x), r"\s+", " "))), lambda x: x != "")
    pair = lambda a: F.struct(F.size(a).cast("bigint").alias("all"), F.size(F.array_distinct(a)).cast("bigint").alias("distinct"))
    counted = df.select(
        key,
        *groups,
        _once(hashes, lambda w: F.struct(F.size(w).cast("bigint").alias("n"), _once(runs(w), pair).alias("r"))).alias("_w"),
        _once(clean(F.split(text_col, r"\n")), pair).alias("_l"),
        _once(clean(F.split(text_col, r"(?<=[.!?。！？])\s*")), pair).alias("_s"),
    )
    return counted.select(
        key,
        *groups,
        F.col("_w.n").alias("words"),
        F.col("_w.r.all").alias("runs"),
        (F.col("_w.r.all") - F.col("_w.r.distinct")).alias("repeated_runs"),
        _share(F.col("_w.r.all"), F.col("_w.r.distinct")).alias("run_share"),
        _share(F.col("_l.all"), F.col("_l.distinct")).alias("line_share"),
        _share(F.col("_s.all"), F.col("_s.distinct")).alias("sentence_share"),
    )


def _once(value: Column, body) -> Column:
    """`body` of a value that is computed once: lambda variables are bound, projected columns are inlined again."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def cutoffs(shares: DataFrame, value: str, quantile: float, at_least: float, at_most: float, lang: str = "lang", source: str = "source") -> DataFrame:
    """`lang, source, n, cutoff` of every group: its quantile from mergeable sketches.

    The quantile of a group is drawn towards that of its language, and that towards the corpus', by the weight
    of PRIOR documents.  The result is held between `at_least` and `at_most`.  One row for each group; sketches
    have a fixed size, and only sketches travel.
    """
    leaf = shares.groupBy(lang, source).agg(F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_double(F.col(value), F.lit(K)).alias("sk"))
    by_lang = leaf.groupBy(F.col(lang).alias("_lang")).agg(F.sum("n").alias("n_lang"), F.kll_merge_agg_double("sk", F.lit(K)).alias("sk_lang"))
    whole = by_lang.agg(F.kll_merge_agg_double("sk_lang", F.lit(K)).alias("sk_all"))
    q = lambda sk: F.kll_sketch_get_quantile_double(sk, F.lit(quantile))
    drawn = lambda n, own, parent: (n * own + PRIOR * parent) / (n + PRIOR)
    # one row per group on either side, and exactly one row in `whole`
    joined = leaf.join(by_lang, F.col(lang).eqNullSafe(F.col("_lang"))).join(F.broadcast(whole))
    own = drawn(F.col("n"), q(F.col("sk")), drawn(F.col("n_lang"), q(F.col("sk_lang")), q(F.col("sk_all"))))
    return joined.select(lang, source, "n", F.least(F.greatest(own, F.lit(at_least)), F.lit(at_most)).alias("cutoff"))


def heavy(
    shares: DataFrame,
    limits: DataFrame,
    value: str = "run_share",
    min_words: int = 40,
    lang: str = "lang",
    source: str = "source",
    broadcast_groups: int = 100_000,
) -> DataFrame:
    """Documents of at least `min_words` words whose share reaches their group's cutoff.

    The cutoffs are one row per group; they are broadcast if there are at most `broadcast_groups`
    of them and joined by shuffle beyond that.
    """
    limits = limits.select(F.col(lang).alias("_lang"), F.col(source).alias("_source"), "cutoff")
    if limits.limit(broadcast_groups + 1).count() <= broadcast_groups:
        limits = F.broadcast(limits)
    on = F.col(lang).eqNullSafe(F.col("_lang")) & F.col(source).eqNullSafe(F.col("_source"))
    return shares.where(F.col("words") >= min_words).join(limits, on).where(F.col(value) >= F.col("cutoff")).drop("_lang", "_source")
