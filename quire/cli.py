"""python -m quire.cli INPUT_ROOT [-o OUTPUT] [-s SHARED] [--lenient]: pack all folders of a parser's output.

Without -o every document's files go to `output` in its own folder, with it to OUTPUT/<doc_id>.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from quire.options import COUNTERS, Options
from quire.plans.pipeline import pack
from quire.runtime import ship
from quire.sources.parser_dirs import discovered, image_listing, listing, load_pages
from quire.sources.writers import shared_files, write_all

#: The figures of the self-check, with their labels.
CHECKED = {
    "skipped_low_value_sections": "sections of contents, lists and revisions left out",
    "skipped_weak_figures": "weak figures left out",
    "subfigure_fragments_merged": "parts folded into figures",
    "oversized_table_chunks": "oversized table chunks",
    "aside_noise": "texts at page sides left out",
}


def run(spark: SparkSession, root: str, out: str | None = None, shared: str | None = None, lenient: bool = False, opts: Options = Options()) -> dict[str, int]:
    """Pack everything below `root`; returns the counters added up over all documents."""
    ship(spark)
    files, bad = load_pages(spark, root, strict=not lenient)
    images = image_listing(spark, root).withColumnRenamed("dirname", "key")
    packed = pack(files, images, opts, key="dirname")
    found = discovered(listing(spark, root))
    folder = F.concat(F.lit(out.rstrip("/") + "/"), F.col("doc_id")) if out else F.concat(F.lit(root.rstrip("/") + "/"), F.col("dirname"), F.lit("/output"))
    docs = files.join(found, "dirname").select(F.col("dirname").alias("key"), "doc_id", "doc_title", F.concat(F.lit(root.rstrip("/") + "/"), F.col("dirname")).alias("source_dir"), F.col("files_all").alias("input_files_all"), F.col("files_used").alias("input_files_used"), folder.alias("folder"))
    packed.events = packed.events.unionByName(bad, allowMissingColumns=True)
    write_all(packed, docs, opts)
    if shared:
        shared_files(packed.chunks, docs, shared).write.format("noop").mode("overwrite").save()
    return packed.stats.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in COUNTERS]).first().asDict()


def report(total: dict[str, int]) -> str:
    """The counters of a run and the five figures of its self-check."""
    counts = [f"{k}: {total[k]}" for k in COUNTERS if k not in CHECKED]
    return "\n".join([*counts, "self-check", *[f"  {label}: {total[k]}" for k, label in CHECKED.items()]])


def main() -> None:
    a = argparse.ArgumentParser(description=__doc__)
    a.add_argument("root")
    a.add_argument("-o", "--output")
    a.add_argument("-s", "--shared")
    a.add_argument("--lenient", action="store_true", help="report folders without a content list instead of stopping")
    g = a.parse_args()
    print(report(run(SparkSession.builder.appName("quire").getOrCreate(), g.root, g.output, g.shared, g.lenient)))


if __name__ == "__main__":
    main()
