"""``python -m tabulith.tune LABELS``: the best settings of the grid for labelled regions, and how many tie.

``--metric`` is accuracy, precision, recall or f1; ``--top`` how many settings are shown; ``--allow`` and ``--deny`` name
files of terms to score against in place of the own ones.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from tabulith.operators.labelled import labelled_regions
from tabulith.operators.scoring import grid_search, search_summary
from tabulith.sources.stores import load_labelled, load_terms
from tabulith.storage import stored

#: Fewer sources than this leave most settings tied.
FEW_SOURCES = 3


def report(labels: DataFrame, metric: str = "accuracy", top: int = 5, allow: DataFrame | None = None, deny: DataFrame | None = None) -> list[str]:
    """Lines that tell the sources, the ties and the best settings; one line if there are no labels."""
    regions = stored(labelled_regions(labels, allow, deny), "labelled")
    if regions.isEmpty():
        return ["no labelled regions"]
    found = stored(grid_search(regions, metric=metric), "settings")
    s = search_summary(found, regions, metric, "source_pdf").first()
    lines = [f"{regions.count()} labelled regions of {s['n_sources']} sources" + (": too few to tell settings apart" if s["n_sources"] < FEW_SOURCES else "")]
    lines.append(f"{s['n_best']} of {s['n_settings']} settings reach the best {metric}, {s['best']:.3f}")
    best = found.orderBy(found[metric].desc(), "combo_id").limit(top).collect()
    return lines + [" ".join(f"{c}={row[c]:g}" for c in found.columns) for row in best]


def main() -> None:
    args = argparse.ArgumentParser(prog="tabulith.tune", description=__doc__.splitlines()[0])
    args.add_argument("labels")
    args.add_argument("--metric", default="accuracy", choices=["accuracy", "precision", "recall", "f1"])
    args.add_argument("--top", type=int, default=5)
    args.add_argument("--allow")
    args.add_argument("--deny")
    a = args.parse_args()
    spark = SparkSession.builder.appName("tabulith.tune").getOrCreate()
    allow, deny = (load_terms(spark, x) if x else None for x in (a.allow, a.deny))
    print(*report(load_labelled(spark, a.labels), a.metric, a.top, allow, deny), sep="\n")
    spark.stop()


if __name__ == "__main__":
    main()
