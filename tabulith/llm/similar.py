"""Near-duplicates by similarity of shingles: SimHash with pivot distance tables, then verification.

Two texts at a Jaccard similarity of 0.8 differ in at most 0.152 of their SimHash bits: ten of 64, too many
for a few blocks of equal bits. So a text has a SimHash of 2,048 bits, and pairs meet where one of KEYS
stretches of KEY_BITS bits is equal; 128 further bits, in no stretch, discard those that differ in too many.
Then the distances of the first 64 bits to the pivots discard those whose coordinates differ too much,
and so does a similarity of their smallest hashes that is below what is asked for by more
than a sample's error. The survivors' similarity is that of both whole sets of distinct shingles,
made again from the texts of pairs left. SimHashes are of distinct shingles too, so that how
many bits differ follows from the similarity, however often a passage is repeated.

A shingle's hash bits are the majority of three signed rows of a Hadamard matrix, drawn by its hash; a text's
sums over all its shingles then take one fast transform, not a sum for each bit.

Not all pairs that share a key are looked at further: in dense groups they grow with the square of the group. First each text is held
against two of those that it meets, the one of the smallest number and the one that differs in the fewest bits, and again with
those outside the component that this gives (TIES rounds). Then all pairs are taken whose texts are still in different
components: a pair within one adds nothing to it.

Where over MOST_IN_BUCKET / 2 pairs a member of a bucket differ in few bits, the bucket has a centre: the member whose bits
differ least from those most of its members have, or in later rounds the one that differs least from the
shingles that most of its members have. Each is first met with the centre alone. Buckets whose centres are then in one component are merged
and met with the centre of all their members, as theirs may each lack what the others share. A member outside the
centre's component is not similar to the centre, and if its set of shingles differs from the
centre's in none of the places where another's does, the two are no more similar to each other: so
a link that is still missing joins texts with a common difference from the centre. Members are
listed by the shingles in which they differ from it, those that the centre lacks first, and only by
as many of them as a pair may leave unmatched plus one (a prefix filter). Lists with few members of
one side are met; longer ones are the next round's buckets. A list's members agree in its shingle,
so that differences become fewer and rounds end. A group whose longer lists have more members in all than it has itself, as where
no member is near to what the others share, goes the plain way instead: all its pairs that share a key, of different components, that differ in few bits. Differences are those of whole sets: no link between
components is lost. Only the choice of a centre, which may be any member, goes by the smallest hashes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import groupby, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulith.llm import chunks
from tabulith.llm.components import components
from tabulith.llm.simhash import SEED, _hamming, _near_pivots, pivots
from tabulith.llm.work import keep_rows, partitions, prepare, stash, text_key

SHINGLE = 5
SIMILARITY = 0.8
#: Bits of a SimHash, in the order of a fixed permutation: 128 to tell pairs apart, then KEYS keys of KEY_BITS bits.
PRINT = 2048
#: 0.9986 of pairs at a similarity of 0.8 share a key (0.848 of their bits agree).
KEYS, KEY_BITS = 88, 16
SKETCH = 256
#: Most bits of 64 and of 128 between the SimHashes of two sets at the similarity: means of 10 and 19, deviations of 3 and 4.
MOST_BITS, MOST_BITS_128 = 24, 37
#: Keys in a task's part of the buckets, all pairs looked at together, and members up to which all pairs of a bucket are looked at.
ENTRIES, TOGETHER, LOOKED_AT = 1 << 20, 1 << 23, 1 << 12
#: Half as many pairs a member make a bucket crowded.
MOST_IN_BUCKET = 6
#: A list of differences is met where one of its sides has at most so many members.
FEW = 64
#: How far below the similarity that of two full sketches may be: six deviations of a sample of SKETCH at 0.8.
MARGIN = 0.15
#: Shingles by which two sketches that are whole may differ from the sets, as 32 bits may agree by chance.
CHANCE = 2
#: Hashes that a task holds before it hands their counts on.
COUNTED = 1 << 20
#: Parts that a bucket's members are dealt over.
SALTS = 32
#: Rows by which a bucket's counts from all tasks are merged before they meet.
MERGED = 256
#: Texts whose SimHashes are made together, and bytes of text whose shingles are: larger blocks would be mapped anew for each step.
ROWS, PIECE = 32, 1 << 19
ENTRY = np.dtype([("bucket", "<u4"), ("node", "<i8"), ("low", "<u8"), ("high", "<u8")])
#: Entries of texts whose component is known.
PLACED = np.dtype([*ENTRY.descr, ("component", "<i8")])
#: Rounds in which texts are held against two others each.
TIES = 1


def shingles(texts: pa.Array, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct 64-bit hashes of each lower-cased text's shingles in ascending order, and where each text's begin, with the
    end (a text of fewer words is one shingle)."""
    first, codes, distinct = chunks.words(texts)
    digest = xxhash.xxh64_intdigest
    value = np.fromiter(map(digest, chunks.strings(pc.cast(distinct, pa.large_binary())), repeat(SEED)), np.uint64, len(distinct))
    factors = np.array([digest(f"word {i}", SEED) | 1 for i in range(shingle)], np.uint64)
    words = np.concatenate([value[codes], np.zeros(shingle, np.uint64)])
    n = np.diff(first)
    bounds = np.concatenate([[0], np.cumsum(np.maximum(1, n - shingle + 1))])
    at = np.repeat(first[:-1] - bounds[:-1], np.diff(bounds)) + np.arange(bounds[-1])
    out = np.zeros(bounds[-1], np.uint64)
    for i, factor in enumerate(factors):
        out += words[at + i] * factor
    for k in np.flatnonzero(n < shingle):
        out[bounds[k]] = (words[first[k] : first[k + 1]] * factors[: n[k]]).sum()
    out = chunks.mix(out, np.uint64(0))
    return _distinct(out, bounds)


def _distinct(values: np.ndarray, bounds: np.ndarray, most: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Each stretch's distinct values in ascending order, the smallest most of them if given, and the stretches' new bounds."""
    for i, j in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        values[i:j].sort()
    new = np.ones(len(values), bool)
    new[1:] = values[1:] != values[:-1]
    new[bounds[:-1]] = True
    if most is not None:
        upto = np.cumsum(new)
        new &= upto - np.repeat(upto[bounds[:-1]], np.diff(bounds)) < most
    return values[new], np.concatenate([[0], np.cumsum(new)])[bounds]


def simhashes(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A row of PRINT / 16 values of 16 bits for each stretch of hashes: a bit is 1 where the sum of its shingles' signs is over 0."""
    order, out = np.random.default_rng(SEED).permutation(PRINT), []
    for at in range(0, len(bounds) - 1, ROWS):
        ends = bounds[at : at + ROWS + 1]
        drawn = chunks.mix(hashes[ends[0] : ends[-1]], np.uint64(2))
        row = np.repeat(np.arange(len(ends) - 1) * PRINT, np.diff(ends))
        sums = np.zeros((len(ends) - 1) * PRINT)
        for i in range(3):
            bits = (drawn >> np.uint64(16 * i)).astype(np.uint16)
            sums += np.bincount(row + bits % PRINT, 1 - 2.0 * (bits >= 1 << 15), len(sums))
        sums = sums.astype(np.float32).reshape(-1, PRINT)
        width = 1
        while width < PRINT:
            pair = sums.reshape(len(sums), -1, 2, width)
            sums = np.stack([pair[:, :, 0] + pair[:, :, 1], pair[:, :, 0] - pair[:, :, 1]], 2).reshape(len(sums), PRINT)
            width *= 2
        out.append(np.packbits(np.take(sums, order, 1) > 0, axis=1, bitorder="little").view("<u2"))
    return np.concatenate(out)


def _binary(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Stretches of values as an array of binary values."""
    ends = (bounds * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(values))])


def _sketches(texts: pa.Array, shingle: int) -> list[pa.Array]:
    """SimHash's first 64 bits, the next 64, keys, smallest 32-bit hashes, and a hash of the whole, of texts' distinct shingles."""
    hashes, bounds = shingles(texts, shingle)
    bits = simhashes(hashes, bounds)
    fp = np.ascontiguousarray(bits[:, :8]).view("<i8")
    keys = np.ascontiguousarray(bits[:, 8 : 8 + KEYS])
    small = _distinct((chunks.mix(hashes, np.uint64(1)) >> np.uint64(32)).astype("<u4"), bounds, SKETCH)
    node = [xxhash.xxh64_intdigest(hashes[i:j].tobytes(), SEED) - (1 << 63) for i, j in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
    return [pa.array(fp[:, 0].copy()), pa.array(fp[:, 1].copy()), _binary(keys.reshape(-1), np.arange(len(keys) + 1) * KEYS), _binary(*small), pa.array(node, pa.int64())]


def sketch(text: bytes, shingle: int) -> tuple[int, list[int], bytes, int]:
    """SimHash, keys, smallest 32-bit hashes, and a hash of the whole, of a text's distinct shingles."""
    fp, _, keys, small, node = (x[0].as_py() for x in _sketches(pa.array([text.lower().decode()], pa.large_string()), shingle))
    return fp, np.frombuffer(keys, "<u2").tolist(), small, node


def sketches(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """doc_id, text_key, points, fp, fp2, keys, sketch, node; null text is empty."""
    prepare(docs.sparkSession)
    keys = text_key(docs, id_col, text_col)
    frame = docs.select(keys[0].alias("doc_id"), keys[1].alias("text_key"), keys[2].alias("points"), docs[text_col].alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks.pieces(batches, most=PIECE):
            yield pa.RecordBatch.from_arrays([*part.columns[:3], *_sketches(chunks.texts(part, lower=True), shingle)], names=["doc_id", "text_key", "points", "fp", "fp2", "keys", "sketch", "node"])

    return frame.mapInArrow(run, f"doc_id {frame.schema['doc_id'].dataType.simpleString()}, text_key long, points int, fp long, fp2 long, keys binary, sketch binary, node long")


def _centre(found: np.ndarray) -> int:
    """The node of entries whose bits differ least from those that most of them have (ties: the smallest)."""
    far = np.zeros(len(found), np.int64)
    for half in ("low", "high"):
        bits = np.unpackbits(np.ascontiguousarray(found[half]).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        most = np.packbits(2 * bits.sum(0, dtype=np.int64) > len(found), bitorder="little").view("<u8")[0]
        far += np.bitwise_count(found[half] ^ most)
    return int(found["node"][far == far.min()].min())


def _buckets(found: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Entries in order of their bucket, and where those of several begin and how many they are."""
    found = found[np.argsort(found["bucket"], kind="stable")]
    starts = np.flatnonzero(np.r_[True, found["bucket"][1:] != found["bucket"][:-1]])
    sizes = np.diff(np.r_[starts, len(found)])
    return found, starts[sizes > 1], sizes[sizes > 1]


def _pairs_in_buckets(found: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Places of both entries, bits that differ and the bucket of pairs in the same bucket whose bits may be those of similar sets, many
    buckets at a time; not those in one component."""
    low, high = (np.ascontiguousarray(found[x]) for x in ("low", "high"))
    home = np.ascontiguousarray(found["component"]) if "component" in found.dtype.names else None
    cut = np.cumsum(sizes * (sizes - 1) // 2) // TOGETHER
    for part in np.split(np.arange(len(starts)), np.flatnonzero(np.diff(cut)) + 1):
        run = np.repeat(part, sizes[part])
        i = np.arange(len(run)) + np.repeat(starts[part] - np.cumsum(sizes[part]) + sizes[part], sizes[part])
        end, out, d = starts[run] + sizes[run], [], 0
        while len(i):
            d += 1
            more = i + d < end
            i, end, run = i[more], end[more], run[more]
            differing = np.bitwise_count(low[i] ^ low[i + d]) + np.bitwise_count(high[i] ^ high[i + d])
            near = differing <= MOST_BITS_128
            if home is not None:
                near &= home[i] != home[i + d]
            out.append((i[near], i[near] + d, differing[near], run[near]))
        if out:
            yield tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _crowded(members: np.ndarray) -> tuple[np.ndarray, np.ndarray, bool]:
    return np.full(len(members), _centre(members)), members["node"], True


def met_in_buckets(found: np.ndarray, stars: bool = True) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
    """Nodes a and b of pairs within entries of the same bucket whose bits may be those of similar sets, and whether b is rather a member
    of a crowded bucket, a its centre. Pairs and buckets within one component are left out. Without stars, no bucket counts as crowded."""
    found, starts, sizes = _buckets(found)
    large = (sizes > LOOKED_AT) & stars
    for at, n in zip(starts[large], sizes[large], strict=True):
        members = found[at : at + n]
        if "component" not in found.dtype.names or (members["component"] != members["component"][0]).any():
            yield _crowded(members)
    starts, sizes, node = starts[~large], sizes[~large], found["node"]
    for left, right, _, of in _pairs_in_buckets(found, starts, sizes):
        pairs = np.bincount(of, minlength=len(starts))
        full = np.zeros(len(starts), bool)
        for k in np.flatnonzero((2 * pairs > MOST_IN_BUCKET * (np.minimum(sizes, pairs + 1))) & stars):
            full[k] = True
            own = of == k
            yield _crowded(found[np.union1d(left[own], right[own])])
        plain = ~full[of]
        a, b = node[left[plain]], node[right[plain]]
        yield np.minimum(a, b), np.maximum(a, b), False


def ties_in_buckets(found: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """node, first, its component, nearest, the bits that differ from it: for each node of a pair in a bucket, the other that comes first by
    component and number, and the one of the fewest bits. A bucket that is not looked at ties all members to its centre."""
    found, starts, sizes = _buckets(found)
    node, home = found["node"], found["component" if "component" in found.dtype.names else "node"]
    for at, n in zip(starts[sizes > LOOKED_AT], sizes[sizes > LOOKED_AT], strict=True):
        members = found[at : at + n]
        centre = at + int(np.argmax(members["node"] == _centre(members)))
        bits = np.bitwise_count(members["low"] ^ found["low"][centre]) + np.bitwise_count(members["high"] ^ found["high"][centre])
        centre_of = np.full(n, node[centre])
        yield members["node"], centre_of, np.full(n, home[centre]), centre_of, bits
    keep = sizes <= LOOKED_AT
    for left, right, bits, _ in _pairs_in_buckets(found, starts[keep], sizes[keep]):
        own, other, bits = np.r_[left, right], np.r_[right, left], np.r_[bits, bits]
        if not len(own):
            continue
        first, near = np.lexsort((node[other], home[other], node[own])), np.lexsort((node[other], bits, node[own]))
        new = np.r_[True, np.diff(node[own[first]]) != 0]
        first, near = first[new], near[new]
        yield node[own[first]], node[other[first]], home[other[first]], node[other[near]], bits[near]


def _by_bucket(nodes: DataFrame, met: Callable[[np.ndarray], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """What met gives for the entries of each part of the buckets of nodes(node, fp, fp2, keys, and component if known)."""
    entry, parts = PLACED if "component" in nodes.columns else ENTRY, max(partitions(nodes.sparkSession), -(-nodes.count() * KEYS // ENTRIES))
    columns = {"node": "node", "low": "fp", "high": "fp2", "component": "component"}
    columns = {name: columns[name] for name in entry.names[1:]}

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Entries by parts of the buckets, a row for each part."""
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.frombuffer(b"".join(batch.column("keys").to_pylist()), "<u2").reshape(-1, KEYS)
            out = np.empty(keys.size, entry)
            out["bucket"] = (keys + (np.arange(KEYS, dtype=np.uint32) << np.uint32(KEY_BITS))).reshape(-1)
            for name, column in columns.items():
                out[name] = np.repeat(batch.column(column).to_numpy().view(entry[name]), KEYS)
            part = out["bucket"].astype(np.int64) * parts // (KEYS << KEY_BITS)
            out = out[np.argsort(part, kind="stable")]
            which, n = np.unique(part, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(which, pa.int32()), _binary(out, np.concatenate([[0], np.cumsum(n)]))], names=["part", "entries"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = ((p, x) for batch in batches for p, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))
        for _, of_part in groupby(rows, lambda x: x[0]):
            yield from met(np.frombuffer(b"".join(x for _, x in of_part), entry))

    entries = nodes.select("keys", *columns.values()).mapInArrow(dealt, "part int, entries binary")
    return entries.repartition(parts, "part").sortWithinPartitions("part").mapInArrow(run, schema)


def candidates(nodes: DataFrame, stars: bool = True) -> DataFrame:
    """a, b, star of nodes(node, fp, fp2, keys, and component if known): pairs that share a key and differ in few bits, not of one component;
    in crowded buckets members b of a centre a, unless without stars."""

    def run(found: np.ndarray) -> Iterator[pa.RecordBatch]:
        for a, b, star in met_in_buckets(found, stars):
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(np.full(len(a), star))], names=["a", "b", "star"])

    return _by_bucket(nodes, run, "a long, b long, star boolean").distinct()


def ties(nodes: DataFrame) -> DataFrame:
    """a, first, nearest of nodes as for candidates: for each node that candidates names, two of those that it meets."""

    def run(found: np.ndarray) -> Iterator[pa.RecordBatch]:
        for columns in ties_in_buckets(found):
            yield pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in columns], names=["a", "first", "home", "nearest", "bits"])

    found = _by_bucket(nodes, run, "a long, first long, home long, nearest long, bits long").where("a <> first or a <> nearest")
    return found.groupBy("a").agg(F.min(F.struct("home", "first"))["first"].alias("first"), F.min(F.struct("bits", "nearest"))["nearest"].alias("nearest"))


def whole_sets(docs: DataFrame, seen: DataFrame, wanted: DataFrame, shingle: int, id_col: str, text_col: str) -> DataFrame:
    """node, whole (its distinct shingles' hashes) of wanted(node), made again from one text each."""
    key = seen.join(wanted, "node", "left_semi").groupBy("node").agg(F.min(F.struct("text_key", "points")).alias("x")).select("node", F.col("x.text_key").alias("k"), F.col("x.points").alias("p"))
    keys = text_key(docs, id_col, text_col)
    texts = docs.select(keys[1].alias("k"), keys[2].alias("p"), docs[text_col].alias("text"))
    frame = texts.join(key, ["k", "p"]).dropDuplicates(["node"]).select("node", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks.pieces(batches, most=PIECE):
            yield pa.RecordBatch.from_arrays([part.column(0), _binary(*shingles(chunks.texts(part, lower=True), shingle))], names=["node", "whole"])

    return frame.mapInArrow(run, "node long, whole binary")


def jaccard(a: bytes, b: bytes, most: int = SKETCH) -> float:
    """Share of common values in two sketches' union, or among its smallest if a sketch has most values."""
    x, y = np.frombuffer(a, "<u4"), np.frombuffer(b, "<u4")
    most = most if max(len(x), len(y)) >= most else len(x) + len(y)
    both = np.sort(np.concatenate([x, y]))
    common = both[1:] == both[:-1]
    distinct = both[np.r_[True, ~common]]
    top = distinct[min(most, len(distinct)) - 1]
    return float((both[1:][common] <= top).sum() / min(most, len(distinct)))


def possible(a: bytes, b: bytes, similarity: float) -> bool:
    """Whether sets with these sketches may have the similarity."""
    size = max(len(a), len(b)) // 4
    return jaccard(a, b) >= similarity - (MARGIN if size >= SKETCH else CHANCE / size)


def set_similarity(a: bytes, b: bytes) -> float:
    """Jaccard similarity of two whole sets."""
    x, y = np.frombuffer(a, "<u8"), np.frombuffer(b, "<u8")
    common = len(np.intersect1d(x, y, True))
    return common / (len(x) + len(y) - common)


def _kept(pairs: DataFrame, of_node: DataFrame, column: str, test: Callable[[bytes, bytes], bool]) -> DataFrame:
    """Those of pairs(a, b) whose nodes' values in a column of of_node pass a test."""
    full = lambda n: of_node.select(F.col("node").alias(n), F.col(column).alias(f"s{n}"))
    met = pairs.join(full("a"), "a").join(full("b"), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sa, sb = batch.column("sa"), batch.column("sb")
            good = pa.array([test(x.as_py(), y.as_py()) for x, y in zip(sa, sb, strict=True)], pa.bool_())
            yield batch.select(["a", "b"]).filter(good)

    return met.select("a", "b", "sa", "sb").mapInArrow(run, "a long, b long")


def _possible(pairs: DataFrame, nodes: DataFrame, similarity: float) -> DataFrame:
    """Those of pairs(a, b) of nodes(node, fp, sketch) whose SimHashes and sketches may be those of similar sets."""
    side = lambda n: nodes.select(F.col("node").alias(n), F.col("fp").alias(f"f{n}"))
    table = lambda n: F.array(*(_hamming(F.col(f"f{n}"), F.lit(p)) for p in pivots())).alias(f"d{n}")
    near = pairs.distinct().join(side("a"), "a").join(side("b"), "b").select("a", "b", "fa", "fb", table("a"), table("b"))
    near = near.where(_near_pivots("da", "db", MOST_BITS) & (_hamming(F.col("fa"), F.col("fb")) <= MOST_BITS)).select("a", "b")
    return stash(_kept(near, nodes, "sketch", lambda x, y: possible(x, y, similarity)), "possible")


def _similar(near: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Those of near(a, b) whose sets(node, whole) have the similarity."""
    return _kept(near, sets, "whole", lambda x, y: set_similarity(x, y) >= similarity)


def _verified(pairs: DataFrame, nodes: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    return _similar(_possible(pairs, nodes, similarity), sets, similarity)


def differences(centre: bytes, member: bytes, similarity: float) -> tuple[np.ndarray, int, int]:
    """Hashes in one of two whole sets, the member's own first, and the lengths of two prefixes of them.

    Where a member that is not similar to the centre and any other of its texts are similar, a hash is
    in the first's prefix of the first length and in the other's of the second.
    """
    c, m = np.frombuffer(centre, "<u8"), np.frombuffer(member, "<u8")
    out = np.concatenate([np.setdiff1d(m, c, True), np.setdiff1d(c, m, True)])
    unmatched = int(len(m) * (1 - similarity) / similarity + 1e-9)
    excess = (len(m) - len(c)) * (1 - similarity) / (1 + similarity)
    common = max(1, len(out) - unmatched, int((len(out) - excess) // 2) + 1)
    return out, min(len(out), unmatched + 1), max(0, len(out) - common + 1)


def _to_members(groups: DataFrame, of_group: DataFrame) -> DataFrame:
    """groups(group, member) with the columns of of_group(group): a large group is dealt over SALTS parts."""
    many = of_group.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return groups.withColumn("salt", F.pmod("member", F.lit(SALTS)).cast("int")).join(many, ["group", "salt"]).drop("salt")


def _centred(groups: DataFrame, nodes: DataFrame) -> DataFrame:
    """group, member, and centre: the member that differs least from the hashes most of its group have (ties: the smallest).

    Hashes count where over half of a task's members of the group have them; a centre may be any member."""
    known = stash(groups.join(nodes.select(F.col("node").alias("member"), "sketch"), "member").select("group", "member", "sketch"), "members")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One row for each group in a task: its members there, and the hashes that over half of them have, with counts."""
        held, n = [], 0
        for batch in batches:
            sketches = batch.column("sketch").to_pylist()
            held.append((batch.column("group").to_numpy(), [len(x) // 4 for x in sketches], np.frombuffer(b"".join(sketches), "<u4")))
            n += len(held[-1][2])
            if n > COUNTED:
                yield totals(held)
                held, n = [], 0
        if held:
            yield totals(held)

    def totals(held: list[tuple]) -> pa.RecordBatch:
        member_group, sizes, value = (np.concatenate(x) for x in zip(*held, strict=True))
        groups, members = np.unique(member_group, return_counts=True)
        group = np.searchsorted(groups, np.repeat(member_group, sizes.astype(np.int64)))
        pairs, k = np.unique(group.astype(np.uint64) << np.uint64(32) | value, return_counts=True)
        group, value = (pairs >> np.uint64(32)).astype(np.int64), pairs.astype(np.uint32)
        most = 2 * k > members[group]
        cut = np.searchsorted(group[most], np.arange(len(groups) + 1)).tolist()
        lists = [pa.array([x[most][i:j].astype("<u4").tobytes() for i, j in zip(cut[:-1], cut[1:], strict=True)], pa.binary()) for x in (value, k)]
        return pa.RecordBatch.from_arrays([pa.array(groups), pa.array(members), *lists], names=["group", "n", "hashes", "counts"])

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The parts of a row as one part."""
        for batch in batches:
            sizes, common, counts = [], [], []
            for parts in batch.column("parts").to_pylist():
                hashes, k = (np.frombuffer(b"".join(p[c] for p in parts), "<u4") for c in ("hashes", "counts"))
                found, at = np.unique(hashes, return_inverse=True)
                total = np.bincount(at, k, len(found))
                sizes.append(sum(p["n"] for p in parts))
                most = 2 * total > sizes[-1]
                common.append(found[most].tobytes()), counts.append(total[most].astype("<u4").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("group"), pa.array(sizes, pa.int64()), pa.array(common, pa.binary()), pa.array(counts, pa.binary())], names=["group", "n", "hashes", "counts"])

    part = "group long, n long, hashes binary, counts binary"
    parts = known.select("group", "sketch").mapInArrow(counted, part)
    # a part has at most twice as many hashes as a sketch; a group has a part from each task, merged by MERGED and then in one
    for salt in (F.pmod(F.spark_partition_id(), F.lit(MERGED)), F.lit(0)):
        lists = parts.withColumn("salt", salt).groupBy("group", "salt").agg(F.collect_list(F.struct("n", "hashes", "counts")).alias("parts"))
        parts = lists.select("group", "parts").mapInArrow(merged, part)
    majority = stash(parts.select("group", F.col("hashes").alias("common")), "majorities")

    def distance(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = zip(batch.column("common").to_pylist(), batch.column("sketch").to_pylist(), strict=True)
            found = [len(np.setxor1d(np.frombuffer(c, "<u4"), np.frombuffer(m, "<u4"))) for c, m in both]
            yield pa.RecordBatch.from_arrays([batch.column("group"), batch.column("member"), pa.array(found, pa.int64())], names=["group", "member", "differing"])

    far = _to_members(known, majority).select("group", "member", "common", "sketch").mapInArrow(distance, "group long, member long, differing long")
    centres = far.groupBy("group").agg(F.min(F.struct("differing", "member")).alias("x")).select("group", F.col("x.member").alias("centre"))
    return _to_members(known.select("group", "member"), centres)


def _lists(groups: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Members of groups(group, centre, member, component) with several components, by the hashes in which they differ
    from the centre: group, hash, member, component, far and any, whether the hash is in either prefix."""
    home = F.max(F.when(F.col("centre") == F.col("member"), F.col("component")))
    several = groups.groupBy("group").agg(F.min("component").alias("c0"), F.max("component").alias("c1"), home.alias("home"), F.first("centre").alias("centre")).where("c0 <> c1")
    centres = several.join(sets.select(F.col("node").alias("centre"), F.col("whole").alias("sc")), "centre").select("group", "home", "sc")
    known = groups.where("centre <> member").drop("centre").join(sets.select(F.col("node").alias("member"), F.col("whole").alias("sm")), "member")
    met = _to_members(known, centres).select("group", "member", "component", "home", "sc", "sm")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks.pieces(batches, "sm"):
            row, hashes, far, near = [], [], [], []
            outside = pc.not_equal(batch.column("component"), batch.column("home")).to_pylist()
            for i, (c, m, o) in enumerate(zip(batch.column("sc"), batch.column("sm"), outside, strict=True)):
                found, first, second = differences(c.as_py(), m.as_py(), similarity)
                first *= o
                most = max(first, second)
                at = np.arange(most)
                row.append(np.full(most, i)), hashes.append(found[:most].view(np.int64)), far.append(at < first), near.append(at < second)
            like = batch.select(["group", "member", "component"]).take(pa.array(np.concatenate(row), pa.int64()))
            yield pa.RecordBatch.from_arrays([*like.columns, pa.array(np.concatenate(hashes), pa.int64()), pa.array(np.concatenate(far)), pa.array(np.concatenate(near))], names=["group", "member", "component", "hash", "far", "any"])

    return met.mapInArrow(run, "group long, member long, component long, hash long, far boolean, any boolean")


def _joined(ends: DataFrame, links: DataFrame) -> DataFrame:
    """Components of ends(node, component) after links(a, b) have been added."""
    return components(ends.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(links))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, similarity: float = SIMILARITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, text_key, points, component (a hash that its members share).

    Texts with the same shingles are one node, texts without words too; an empty table gives no rows.
    """
    seen = stash(sketches(docs, id_col, text_col, shingle), "sketches")
    nodes = stash(seen.groupBy("node").agg(*(F.first(c).alias(c) for c in ("fp", "fp2", "keys", "sketch"))), "nodes")
    tied = stash(ties(nodes), "ties")
    met = tied.select(F.explode(F.array("a", "first", "nearest")).alias("node")).distinct()
    nodes = stash(nodes.join(met, "node", "left_semi"), "met")  # all others share no key with a text that differs in few bits
    sets = stash(whole_sets(docs, seen, nodes.select("node"), shingle, id_col, text_col), "sets")
    ends = components(_verified(_tied(tied), nodes, sets, similarity))
    for _ in range(TIES - 1):
        ends = _joined(ends, _verified(_tied(ties(_placed(nodes, ends))), nodes, sets, similarity))
    met = stash(candidates(_placed(nodes, ends)), "pairs")
    groups = met.where("star").select(F.col("a").alias("group"), F.col("a").alias("centre"), F.col("b").alias("member"))
    ends = _joined(ends, _verified(met.where("a <> b").select("a", "b"), nodes, sets, similarity))
    if groups.limit(1).count():
        homes = groups.select("group").distinct().join(ends, F.col("group") == F.col("node"), "left").select("group", F.coalesce("component", "group").alias("home"))
        merged = _to_members(groups.select("group", "member"), homes).select(F.col("home").alias("group"), "member").distinct()
        groups = stash(_centred(merged, nodes), "groups")
        ends = _joined(ends, _verified(_stars(groups), nodes, sets, similarity))
    while groups.limit(1).count():
        placed = groups.join(ends, F.col("member") == F.col("node"), "left").select("group", "centre", "member", F.coalesce("component", "member").alias("component"))
        lists = stash(_lists(stash(placed, "placed"), sets, similarity), "lists")
        sides = [F.count(F.when(F.col(x), 1)).alias(f"n_{x}") for x in ("far", "any")]
        of_list = lists.groupBy("group", "hash").agg(*sides, F.min("component").alias("c0"), F.max("component").alias("c1")).where("n_far > 0 and n_any > 0 and c0 <> c1")
        met = stash(lists.join(of_list.drop("c0", "c1"), ["group", "hash"]), "met")
        few = met.where(F.least("n_far", "n_any") <= FEW)
        side = lambda x, n: few.where(x).select("group", "hash", F.col("member").alias(n), F.col("component").alias(f"c{n}"))  # noqa: B023, E731
        more = side("far", "x").join(side("any", "y"), ["group", "hash"]).where("cx <> cy").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
        more = stash(more.distinct(), "more")
        long = met.where(F.least("n_far", "n_any") > FEW).select("group", "hash", "member")
        multiplied = stash(long.groupBy("group").count().join(groups.groupBy("group").agg(F.count(F.lit(1)).alias("n")), "group").where("count > n").select("group"), "multiplied")
        if multiplied.limit(1).count():
            plain = groups.join(multiplied, "group", "left_semi").select(F.explode(F.array("centre", "member")).alias("node")).distinct()
            plain = candidates(_placed(nodes.join(plain, "node", "left_semi"), ends), stars=False).select("a", "b")
            more, long = more.unionByName(plain), long.join(multiplied, "group", "left_anti")
        groups = stash(_centred(long.select(F.xxhash64("group", "hash").alias("group"), "member"), nodes), "groups")
        ends = _joined(ends, _verified(more.unionByName(_stars(groups)), nodes, sets, similarity))
    of_node = ends.select(F.col("node").alias("n"), "component")
    return seen.join(of_node, F.col("node") == F.col("n"), "left").select("doc_id", "text_key", "points", F.coalesce("component", F.col("node")).alias("component"))


def _placed(nodes: DataFrame, ends: DataFrame) -> DataFrame:
    """nodes with their component so far: their own number if none."""
    of_node = ends.select(F.col("node").alias("n"), F.col("component").alias("c"))
    return nodes.join(of_node, F.col("node") == F.col("n"), "left").select("node", "fp", "fp2", "keys", F.coalesce("c", "node").alias("component"))


def _tied(found: DataFrame) -> DataFrame:
    """Pairs (a, b) of ties, a the smaller."""
    each = found.select("a", F.explode(F.array("first", "nearest")).alias("b"))
    return each.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def _stars(groups: DataFrame) -> DataFrame:
    return groups.where("centre <> member").select(F.col("centre").alias("a"), F.col("member").alias("b"))


def drop_near_duplicates(docs: DataFrame, shingle: int = SHINGLE, similarity: float = SIMILARITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of docs for each component, with all its columns: the smallest id (null last), then text key."""
    found = stash(near_duplicates(docs, shingle, similarity, id_col, text_col), "components")
    first = found.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key", "points")).alias("x")).select("x.doc_id", "x.text_key", "x.points")
    tied = found.groupBy("doc_id", "text_key", "points").agg(F.count(F.lit(1)).alias("ties"))
    right = tied.select(F.col("doc_id").alias("k0"), F.col("text_key").alias("k1"), F.col("points").alias("k2"), "ties")
    keep = right.join(first, F.col("k0").eqNullSafe(first["doc_id"]) & (F.col("k1") == first["text_key"]) & (F.col("k2") == first["points"]), "left_semi")
    return keep_rows(docs, text_key(docs, id_col, text_col), keep)
