"""``python -m tabulith FILES OUT``: extracts the regions of page layouts to files of JSON.

For each document OUT has NAME_canonical.json and NAME_simplified.json. ``--confident`` goes by scored
candidates instead of titles, ``--tables`` leaves notes out, ``--parser module:function`` reads other files.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from tabulith.operators import tables
from tabulith.sources.pages import read_layout
from tabulith.sources.sinks import write_documents


def main() -> None:
    args = argparse.ArgumentParser(prog="tabulith", description=__doc__.splitlines()[0])
    args.add_argument("files")
    args.add_argument("out")
    args.add_argument("--confident", action="store_true")
    args.add_argument("--tables", action="store_true")
    args.add_argument("--parser")
    args.add_argument("--pattern")
    a = args.parse_args()
    spark = SparkSession.builder.appName("tabulith").getOrCreate()
    options = {k: v for k, v in (("parser", a.parser), ("pattern", a.pattern)) if v}
    block, word, segment, drawing, page = read_layout(spark, a.files, "block", "word", "segment", "drawing", "page", **options)
    if a.confident:
        regions = tables.extract_confident(block, word, segment, drawing, page)
        regions = tables.without_notes(regions) if a.tables else regions
    else:
        regions = (tables.extract_tables if a.tables else tables.extract_regions)(block, word, segment, page)
    for line in write_documents(regions, a.out):
        print(line)
    spark.stop()


if __name__ == "__main__":
    main()
