"""SimHash near-duplicates, linked within a Hamming distance, found through pivot distance tables.

Distinct fingerprints fall into buckets: 64 bits are cut into ``distance + 2`` blocks, and two
fingerprints within the distance agree in at least two blocks, so each pair meets in the bucket of
some two blocks. Every fingerprint carries its Hamming distances to many reference fingerprints; a
pair in a bucket is discarded where these differ by more than the distance in any coordinate, and
what survives is verified.

A bucket with more than MOST_IN_BUCKET distinct fingerprints (a dense cluster) is not paired. Its
members go the exact other way: two fingerprints are within 2 bits if and only if some value lies
within 1 bit of both, so members are tied to the 65 values within 1 bit of them, and a value ties at
most 65 fingerprints. Links are kept up to connection: the components are those of all links.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulith.llm import chunks
from tabulith.llm.components import components
from tabulith.llm.work import prepare, stash, text_key

SEED = 42
SHINGLE = 3
DISTANCE = 2
PIVOTS = 16
MOST_IN_BUCKET = 64


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """Bit i is 1 if it is set in over half of the shingles' hashes; 0 for a text without words."""
    words = text.lower().split()  # on bytes: A-Z, and the six ASCII spaces
    if not words:
        return 0
    if len(words) < shingle:
        hashes = [xxhash.xxh64_intdigest(b" ".join(words), SEED)]
    else:
        digest, joined = xxhash.xxh64_intdigest, b" ".join
        hashes = [digest(joined(x), SEED) for x in zip(*(words[i:] for i in range(shingle)), strict=False)]
    bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    set_bits = 2 * bits.sum(0, dtype=np.int64) > len(hashes)
    return int(np.packbits(set_bits, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """doc_id, fp (the 64 bits as long), text_key, points; null text is empty."""
    prepare(docs.sparkSession)
    keys = text_key(docs, id_col, text_col)
    frame = docs.select(keys[0].alias("doc_id"), keys[1].alias("text_key"), keys[2].alias("points"), docs[text_col].alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks.pieces(batches):
            values = [fingerprint(x or b"", shingle) for x in pc.cast(part.column(3), pa.large_binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([*part.columns[:3], pa.array(np.array(values, np.uint64).view(np.int64))], names=["doc_id", "text_key", "points", "fp"])

    return frame.mapInArrow(run, f"doc_id {frame.schema['doc_id'].dataType.simpleString()}, text_key long, points int, fp long")


def pivots(n: int = PIVOTS) -> list[int]:
    """Reference fingerprints: hashes of their numbers, as signed longs."""
    return [xxhash.xxh64_intdigest(f"pivot {i}".encode(), SEED) - (1 << 63) for i in range(n)]


def _hamming(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def _near_pivots(a: str, b: str, distance: int) -> Column:
    """Whether no coordinate of two pivot tables differs by more than the distance."""
    out = F.lit(True)
    for i in range(PIVOTS):
        out = out & (F.abs(F.col(a)[i] - F.col(b)[i]) <= distance)
    return out


def links(prints: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Edges (a, b) whose components are those of all pairs of prints(fp) within the distance.

    prints holds distinct values. Buckets up to MOST_IN_BUCKET give every pair within the distance;
    larger ones, for distance 2, ties through the values within 1 bit.
    """
    if distance != DISTANCE:
        raise ValueError("large buckets have an exact way for distance 2")
    n = distance + 2
    width = 64 // n
    mask = F.lit((1 << width) - 1)
    block = [F.shiftrightunsigned("fp", i * width).bitwiseAND(mask) for i in range(n)]
    keys = F.array(*(F.struct(F.lit(k).alias("k"), F.shiftleft(block[i], width).bitwiseOR(block[j]).alias("v")) for k, (i, j) in enumerate(combinations(range(n), 2))))
    bucketed = prints.select("fp", F.explode(keys).alias("key")).select("fp", "key.k", "key.v")
    size = bucketed.groupBy("k", "v").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    met = stash(bucketed.join(size, ["k", "v"]), "buckets")
    table = F.array(*(_hamming(F.col("fp"), F.lit(p)) for p in pivots()))
    small = met.where(F.col("n") <= MOST_IN_BUCKET).select("k", "v", "fp", table.alias("d"))
    left, right = small.select("k", "v", F.col("fp").alias("a"), F.col("d").alias("da")), small.select("k", "v", F.col("fp").alias("b"), F.col("d").alias("db"))
    pairs = left.join(right, ["k", "v"]).where((F.col("a") < F.col("b")) & _near_pivots("da", "db", distance) & (_hamming(F.col("a"), F.col("b")) <= distance))
    dense = met.where(F.col("n") > MOST_IN_BUCKET).select("fp").distinct()
    flips = F.array(F.lit(0).cast("long"), *(F.lit(1 << i if i < 63 else -(1 << 63)) for i in range(64)))
    tied = dense.select("fp", F.explode(flips).alias("flip")).select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("z"))
    stars = tied.join(tied.groupBy("z").agg(F.min("fp").alias("b"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"), "z").where("fp <> b")
    return pairs.select("a", "b").unionByName(stars.select(F.col("fp").alias("a"), "b"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """One row per row of docs: doc_id, fp, component_id (smallest id reachable), text_key, points.

    Documents with equal fingerprints are linked, those without words too. Null ids come last: a
    component of nulls only has a null id. An empty table gives no rows; rows alike share all values.
    """
    seen = stash(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    least = stash(seen.groupBy("fp").agg(F.min("doc_id").alias("least")), "prints")
    ends = components(links(least.select("fp")))
    of_print = stash(least.join(ends, F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("component", "fp").alias("component")), "print_components")
    smallest = of_print.groupBy("component").agg(F.min("least").alias("component_id"))
    classes = of_print.join(smallest, "component").select("fp", "component_id")
    return seen.join(classes, "fp").select("doc_id", "fp", "component_id", "text_key", "points")


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
