"""Near-duplicate components by an exact Jaccard join on word shingles.

The documents-by-shingles incidence matrix is multiplied with its transpose in
blocks. Size-derived bounds keep most of it out:

* Two sets that reach the threshold differ in at most D shingles, by their sizes. The
  range of shingle hashes is cut into more than D parts, so that at least one part is
  the same in both. Only hashes of parts are dealt out to find which documents can
  meet at all; they form candidate clusters. A part holds several shingles (about 9 at
  0.9), and parts of nothing but frequent shingles count only for documents that need
  them, so sharing a passage does not make two documents candidates.
* Whole sets of a cluster come together, and the product of their incidence rows
  is accumulated block by block. Sizes bound the columns of each block of rows,
  and overlaps below the size-derived bound are discarded.
* A cluster too large for a task is cut into chunks. Chunks and a few leaders meet
  first; then only what is left outside the cluster's largest component meets all
  chunks. A group of near copies thus costs in proportion to its size.

Equal sets are one node, in every step, so copies cost nothing but their row.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from genoframe.llm.batches import returning_memory, small_batches
from genoframe.llm.components import components
from genoframe.llm.shingles import shingle_sets
from genoframe.llm.textscan import mixed
from genoframe.plans.shared import shared_folder, shared_path, shuffles_removed

WORDS = 3
PERCENT = 90
# Bits of the filter for texts that are read again: 2 MB at most.
FILTER_BITS = 24
ENTRIES_PER_BLOCK = 1 << 19
# Buckets of the frequency sketch of shingles: 4 MB as 32-bit counts, whatever the
# input. It says which shingles are frequent; the result does not depend on it.
SKETCH_BITS = 20
# Steps between the numbers of parts that sets of different sizes agree on.
PART_STEP = 1.5
# Tells the hash of an empty part from that of any content.
EMPTY = 0x3C6EF372FE94F82B
# Nodes and shingles that one task multiplies.
CHUNK_NODES = 4096
CHUNK_SHINGLES = 1 << 22
# A digest that more than one row in so many has is hot: there are no more hot ones.
HOT_SHARE = 10_000
# Stands for a null id where rows are compared, fixed value: the least long.
NO_ID = -(1 << 63)
# Nodes of a size step that meet every chunk of a large cluster, on average.
LEADERS = 64
# Words of 64 bits in the filter of ids that go: some 10 MB at most where it is broadcast.
ID_WORDS = 1 << 18


def _needed(difference: int) -> int:
    """Parts for sets that differ in so many shingles: one more, and some to spare
    for parts that are empty in both."""
    return difference + 1 + (difference > 0) + -(-3 * difference // 100)


def _part_numbers() -> tuple[list[int], list[int]]:
    """The numbers of parts in use, and the largest difference each is enough for."""
    numbers, differences, m = [], [], 1
    while m < 1 << 40:
        low, high = 0, m
        while low < high:
            middle = (low + high + 1) // 2
            low, high = (middle, high) if _needed(middle) <= m else (low, middle - 1)
        numbers.append(m)
        differences.append(low)
        m = max(m + 1, int(m * PART_STEP))
    return numbers, differences


PART_NUMBERS, PART_DIFFERENCES = _part_numbers()


@lru_cache(maxsize=100_000)
def partitions_of(n: int, percent: int) -> tuple[tuple[int, int], ...]:
    """Numbers of parts at which a set of size n meets those it can link to, and of how
    many of them it is sure that they are not all of the equal ones.

    Sets of sizes n and k differ in ``(n + k) (1 - t) / (1 + t)`` shingles at most if
    they reach the threshold t, and k is between t n and n / t. Both take the first
    number of parts that is enough for their difference.
    """
    least, most = n - (-percent * n // 100), n + 100 * n // percent
    low, high = (total * (100 - percent) // (100 + percent) for total in (least, most))
    first, last = (bisect_left(PART_NUMBERS, _needed(d)) for d in (low, high))
    return tuple(
        (PART_NUMBERS[i], PART_NUMBERS[i] - 1 - min(high, PART_DIFFERENCES[i]))
        for i in range(first, last + 1)
    )


def part_keys(members: np.ndarray, percent: int, frequent: np.ndarray) -> np.ndarray:
    """Hashes of the parts of a set, for each number of parts that it takes.

    Of m parts at most D differ, and so at least ``m - D`` are equal. Parts with a
    shingle that is not frequent count first. If there are so many others that the
    equal ones may all be among them, parts of frequent shingles count as well; and
    empty parts, if there are so many of them.
    """
    content, top = mixed(members), members >> np.uint64(32)
    rare = ~frequent[(members >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]
    keys = []
    for m, others in partitions_of(len(members), percent):
        salt = mixed(np.array([m], dtype=np.uint64))
        part = top * np.uint64(m) >> np.uint64(32)
        starts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
        filled = part[starts]
        hashes = mixed(np.add.reduceat(content, starts) + mixed(filled + salt))
        telling = np.logical_or.reduceat(rare, starts)
        if m - np.count_nonzero(telling) > others:
            keys.append(hashes)
        else:
            keys.append(hashes[telling])
        if m - len(starts) > others:
            empty = np.setdiff1d(np.arange(m, dtype=np.uint64), filled)
            keys.append(mixed(mixed(empty + salt) ^ np.uint64(EMPTY)))
    return np.concatenate(keys)


def _digest(members: np.ndarray) -> bytes:
    """128 bits that stand for a set."""
    low = mixed(members).sum(dtype=np.uint64)
    high = mixed(members ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64)
    return np.array([low, high], dtype=np.uint64).tobytes()


def _node(digest: bytes) -> int:
    """The digest's first 64 bits as a signed integer; a collision only makes a
    candidate cluster larger."""
    return int.from_bytes(digest[:8], "little", signed=True)


def _table(**columns: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(columns)


def _measure(words: int):
    """Task over texts: size and digest of each document's set, and the task's counts
    of shingles by bucket."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << SKETCH_BITS, dtype=np.int32)
        for batch in batches:
            sizes, digests = [], []
            for members in shingle_sets(batch["text"], words):
                sizes.append(len(members))
                digests.append(_digest(members))
                np.add.at(counts, (members >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), 1)
            yield _table(
                doc_id=batch["doc_id"],
                n=pa.array(sizes, pa.int64()),
                digest=pa.array(digests, pa.binary()),
                node=pa.array([_node(digest) for digest in digests], pa.int64()),
                counts=pa.nulls(len(sizes), pa.binary()),
            )
        yield _table(
            doc_id=pa.nulls(1, pa.int64()),
            n=pa.nulls(1, pa.int64()),
            digest=pa.nulls(1, pa.binary()),
            node=pa.nulls(1, pa.int64()),
            counts=_packed(counts),
        )

    return measure


def _packed(counts: np.ndarray) -> pa.Array:
    return pa.array([zlib.compress(counts.tobytes(), 1)], pa.binary())


def _summed(packed: Iterator[bytes]) -> np.ndarray:
    """Sum of packed counts; 2**31 and more all count as that."""
    total = np.zeros(1 << SKETCH_BITS, dtype=np.int64)
    for data in packed:
        total += np.frombuffer(zlib.decompress(data), dtype=np.int32)
    return np.minimum(total, np.iinfo(np.int32).max).astype(np.int32)


def _sum_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    packed = (data.as_py() for batch in batches for data in batch["counts"])
    yield _table(counts=_packed(_summed(packed)))


def _frequent(measured: DataFrame) -> np.ndarray:
    """Which buckets count far more shingles than their share, over all documents.

    Tasks sum the counts of the tasks before them, sixteen to one."""
    parts = measured.where("counts IS NOT NULL").select("counts")
    tasks = parts.count()
    while tasks > 16:
        tasks = -(-tasks // 16)
        parts = parts.repartition(tasks).mapInArrow(_sum_counts, "counts binary")
    counts = _summed(bytes(row["counts"]) for row in parts.collect())
    mean = counts.mean()
    return counts > mean + 6 * np.sqrt(mean + 1)


class Forest:
    """Union-find over arbitrary integers."""

    def __init__(self) -> None:
        self.parent: dict[int, int] = {}

    def root(self, x: int) -> int:
        parent = self.parent
        top = x
        while (above := parent.get(top, top)) != top:
            top = above
        while (above := parent.get(x, x)) != top:
            parent[x], x = top, above
        return top

    def link(self, x: int, y: int) -> None:
        x, y = self.root(x), self.root(y)
        if x != y:
            self.parent[max(x, y)] = min(x, y)

    def edges(self) -> tuple[list[int], list[int]]:
        nodes = list(self.parent)
        return nodes, [self.root(x) for x in nodes]


def _meet(keys: np.ndarray, nodes: np.ndarray, forest: Forest) -> tuple[np.ndarray, np.ndarray]:
    """Link nodes that share a key; each key goes on with one of its nodes."""
    order = np.argsort(keys, kind="stable")
    keys, nodes = keys[order], nodes[order]
    new = np.ones(len(keys), dtype=bool)
    new[1:] = keys[1:] != keys[:-1]
    starts = np.flatnonzero(new)
    heads = nodes[starts][np.cumsum(new) - 1]
    apart = heads != nodes
    pairs = np.unique(np.stack([heads[apart], nodes[apart]]), axis=1)
    for x, y in zip(*pairs.tolist()):
        forest.link(x, y)
    return keys[starts], nodes[starts]


def _parts(words: int, percent: int, frequent: np.ndarray):
    """Task over texts: (key, node) of parts, and edges (node, root) between nodes that
    meet inside the task.

    Nodes that meet send their common key once, so however many near copies there
    are, a key goes on a few times per task.
    """

    def met(
        keys: list[np.ndarray], nodes: list[np.ndarray], forest: Forest
    ) -> pa.RecordBatch:
        common, heads = _meet(np.concatenate(keys), np.concatenate(nodes), forest)
        return _table(
            key=pa.array(common.view(np.int64)),
            node=pa.array(heads),
            root=pa.nulls(len(heads), pa.int64()),
        )

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest, seen = Forest(), set()
        keys: list[np.ndarray] = []
        nodes: list[np.ndarray] = []
        held = 0
        for batch in batches:
            for members in shingle_sets(batch["text"], words):
                if not len(members):
                    continue
                node = _node(_digest(members))
                if node in seen:
                    continue
                seen.add(node)
                keys.append(part_keys(members, percent, frequent))
                nodes.append(np.full(len(keys[-1]), node, dtype=np.int64))
                held += len(keys[-1])
                if held > ENTRIES_PER_BLOCK:
                    yield met(keys, nodes, forest)
                    keys, nodes, held = [], [], 0
        if keys:
            yield met(keys, nodes, forest)
        u, v = forest.edges()
        yield _table(
            key=pa.nulls(len(u), pa.int64()),
            node=pa.array(u, pa.int64()),
            root=pa.array(v, pa.int64()),
        )

    return parts


def _meet_across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task over entries dealt by key: nodes of different tasks that share a key."""
    forest, keys, nodes = Forest(), [], []
    for batch in batches:
        entries = batch.filter(batch["key"].is_valid())
        keys.append(entries["key"].to_numpy().view(np.uint64))
        nodes.append(entries["node"].to_numpy())
        edges = batch.filter(batch["key"].is_null())
        for x, y in zip(edges["node"].to_pylist(), edges["root"].to_pylist()):
            forest.link(x, y)
    if keys:
        _meet(np.concatenate(keys), np.concatenate(nodes), forest)
    u, v = forest.edges()
    yield _table(u=pa.array(u, pa.int64()), v=pa.array(v, pa.int64()))


def _bits(nodes: np.ndarray, carriers: np.ndarray, bits: int) -> np.ndarray:
    both = mixed(nodes.view(np.uint64)) ^ carriers.view(np.uint64)
    return (mixed(both) >> np.uint64(64 - bits)).astype(np.int64)


def _carrier_filter(clusters: DataFrame, bits: int) -> np.ndarray:
    """Bit array with the (node, carrier) of all clusters, or-ed in tasks first."""

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(1 << bits, dtype=bool)
        for batch in batches:
            found[_bits(batch["node"].to_numpy(), batch["carrier"].to_numpy(), bits)] = True
        yield _table(counts=pa.array([zlib.compress(np.packbits(found).tobytes(), 1)], pa.binary()))

    def unite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros((1 << bits) // 8, dtype=np.uint8)
        for batch in batches:
            for packed in batch["counts"]:
                found |= np.frombuffer(zlib.decompress(packed.as_py()), dtype=np.uint8)
        yield _table(counts=pa.array([zlib.compress(found.tobytes(), 1)], pa.binary()))

    filled = clusters.select("node", "carrier").mapInArrow(fill, "counts binary")
    parts = filled.repartition(16).mapInArrow(unite, "counts binary").collect()
    found = np.zeros((1 << bits) // 8, dtype=np.uint8)
    for row in parts:
        found |= np.frombuffer(zlib.decompress(bytes(row["counts"])), dtype=np.uint8)
    return found


def _whole_sets(words: int, bits: int, wanted: np.ndarray):
    """Task over rows: whole sets of the rows that may carry a node, by the filter.

    A node's carrier is the least row that has its set, so a row after a lesser one
    with the same set is not it. What the filter lets through beside the carriers
    finds no partner when (node, carrier) is joined.
    """

    def packed(sets: list[tuple[bytes, int, np.ndarray]]) -> pa.RecordBatch:
        return _table(
            node=pa.array([_node(digest) for digest, _, _ in sets], pa.int64()),
            carrier=pa.array([row for _, row, _ in sets], pa.int64()),
            digest=pa.array([digest for digest, _, _ in sets], pa.binary()),
            shingles=pa.array([members.tobytes() for _, _, members in sets], pa.binary()),
        )

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least: dict[bytes, int] = {}
        sets, held = [], 0
        for batch in batches:
            rows = batch["carrier"].to_pylist()
            for row, members in zip(rows, shingle_sets(batch["text"], words)):
                digest = _digest(members)
                if not len(members) or least.get(digest, row + 1) <= row:
                    continue
                place = int(_bits(np.array([_node(digest)]), np.array([row]), bits)[0])
                if wanted[place >> 3] >> (7 - (place & 7)) & 1:
                    least[digest] = row
                    sets.append((digest, row, members))
                    held += len(members)
                    if held > ENTRIES_PER_BLOCK:
                        yield packed(sets)
                        sets, held = [], 0
        yield packed(sets)

    return whole


def overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Block of the incidence product: how many shingles each pair shares.

    The shingles are taken a range at a time, so long sets need no more memory.
    """
    total = sum(map(len, left)) + sum(map(len, right))
    ranges = -(-total // ENTRIES_PER_BLOCK)
    counts = np.zeros((len(left), len(right)), dtype=np.int64)
    bounds = [(r << 64) // ranges for r in range(1, ranges)]
    for low, high in zip([0, *bounds], [*bounds, None]):

        def inside(members: np.ndarray) -> np.ndarray:
            start = np.searchsorted(members, np.uint64(low))
            end = len(members) if high is None else np.searchsorted(members, np.uint64(high))
            return members[start:end]

        if ranges == 1:
            counts += _range_overlaps(left, right)
        else:
            counts += _range_overlaps([inside(m) for m in left], [inside(m) for m in right])
    return counts


def _range_overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Shingles of many sets are multiplied as dense columns, a thousand at a time;
    for the others the few pairs that each one makes are counted."""
    sets = [*left, *right]
    owner = np.repeat(np.arange(len(sets)), [len(members) for members in sets])
    values = np.concatenate(sets)
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    shape = (len(left), len(right))
    if not len(values):
        return np.zeros(shape, dtype=np.int64)
    starts = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))
    lengths = np.diff(np.append(starts, len(values)))
    # Owners ascend inside a shingle: those of the left come first.
    shingle = np.repeat(np.arange(len(starts)), lengths)
    on_left = np.bincount(shingle[owner < len(left)], minlength=len(starts))
    on_right = lengths - on_left
    pairs = on_left * on_right
    heavy = pairs > max(64, shape[0] * shape[1] // 64)
    wide = np.flatnonzero(heavy)
    column = np.full(len(starts), -1)
    column[wide] = np.arange(len(wide))
    column = column[shingle]
    dense_counts = np.zeros(shape, dtype=np.float32)
    for base in range(0, len(wide), 1024):
        here = (column >= base) & (column < base + 1024)
        dense = np.zeros((len(sets), min(1024, len(wide) - base)), dtype=np.float32)
        dense[owner[here], column[here] - base] = 1
        dense_counts += dense[: len(left)] @ dense[len(left) :].T
    counts = dense_counts.astype(np.int64).ravel()
    light = np.flatnonzero(~heavy & (pairs > 0))
    parts = np.array_split(light, int(pairs[light].sum() >> 20) + 1)
    for part in parts:
        each, width, begin = pairs[part], on_right[part], starts[part]
        k = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
        width_each = np.repeat(width, each)
        row = owner[np.repeat(begin, each) + k // np.maximum(width_each, 1)]
        other = np.repeat(begin + on_left[part], each) + k % np.maximum(width_each, 1)
        np.add.at(counts, row * shape[1] + owner[other] - len(left), 1)
    return counts.reshape(shape)


def linked(
    sets: list[np.ndarray], percent: int, rows: int = 512
) -> Iterator[tuple[int, int]]:
    """Pairs (i, j), i < j, of sets that reach the threshold; ``sets`` ascend by size."""
    sizes = np.array([len(members) for members in sets])
    for start in range(0, len(sets), rows):
        end = min(start + rows, len(sets))
        # Larger sets than this cannot link to any of the rows.
        reach = int(np.searchsorted(sizes, 100 * sizes[end - 1] // percent, side="right"))
        for first in range(start, reach, rows):
            last = min(first + rows, reach)
            shared = overlaps(sets[start:end], sets[first:last])
            union = sizes[start:end, None] + sizes[None, first:last] - shared
            found = np.nonzero(100 * shared >= percent * union)
            for i, j in zip((found[0] + start).tolist(), (found[1] + first).tolist()):
                if i < j:
                    yield i, j


def _multiply(percent: int):
    """Task over some small clusters or a pair of chunks of a large one: the links
    found, as a forest of (digest, root digest)."""

    def links(digests: list[bytes], members: list[bytes]) -> tuple[list[bytes], list[bytes]]:
        by_digest = dict(zip(digests, members))
        order = sorted(by_digest, key=lambda d: (len(by_digest[d]), d))
        sets = [np.frombuffer(by_digest[d], dtype=np.uint64) for d in order]
        forest = Forest()
        if len(sets) == 2:
            a, b = sets
            shared = len(np.intersect1d(a, b, assume_unique=True))
            if 100 * shared >= percent * (len(a) + len(b) - shared):
                forest.link(0, 1)
        elif len(sets) > 2:
            for i, j in linked(sets, percent):
                forest.link(i, j)
        u, v = forest.edges()
        return [order[i] for i in u], [order[i] for i in v]

    def multiply(table: pa.Table) -> pa.Table:
        table = table.sort_by("cluster")
        clusters = table["cluster"].to_numpy()
        cuts = np.flatnonzero(np.diff(clusters)) + 1
        u, v = [], []
        for start, end in zip([0, *cuts], [*cuts, len(clusters)]):
            part = table.slice(start, end - start)
            more = links(part["digest"].to_pylist(), part["shingles"].to_pylist())
            u += more[0]
            v += more[1]
        return pa.table({"u": pa.array(u, pa.binary()), "v": pa.array(v, pa.binary())})

    return multiply


def _small_work(sized: DataFrame, bins: int) -> DataFrame:
    """(node, carrier, cluster, work) of small clusters: they share tasks, each whole in one."""
    return sized.where("NOT large").select(
        "node",
        "carrier",
        F.col("root").alias("cluster"),
        F.concat(F.lit("s"), F.pmod(F.xxhash64("root"), F.lit(bins))).alias("work"),
    )


def _chunked(sized: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Nodes of large clusters with their chunk, and the number of chunks.

    A cluster is cut by size into steps of the threshold, so that sets of a step
    link within it and to the next ones only, and a step by hash into chunks.
    """
    # A little wider than the threshold, so rounding cannot make a link skip a step.
    width = float(np.log(100 / percent)) * 1.001
    step = F.floor(F.log("n") / F.lit(width)).cast("int")
    parts = sized.where("large").withColumn("step", step)
    fill = F.greatest(F.count("*") * 2 / CHUNK_NODES, F.sum("n") * 2 / CHUNK_SHINGLES)
    chunks = parts.groupBy("root", "step").agg(
        F.ceil(fill).cast("int").alias("m"), F.count("*").alias("k")
    )
    placed = parts.join(chunks, ["root", "step"]).select(
        "node", "carrier", "root", "step", "k",
        F.pmod(F.xxhash64("node"), F.col("m")).cast("int").alias("c"),
    )
    return placed, chunks.select("root", "step", "m")


def _near_steps(table: DataFrame) -> DataFrame:
    """The rows once for each step that theirs can link to, as ``other``."""
    return table.withColumn("other", F.explode(F.array(*(F.col("step") + d for d in (-1, 0, 1)))))


def _chunk_work(placed: DataFrame, chunks: DataFrame) -> DataFrame:
    """First round of large clusters: each chunk is a task, and some leaders of each
    step join every chunk that they can link to.

    Near copies link to a leader, directly or over each other, so that most of a
    cluster becomes one component without all its chunks meeting.
    """
    own = placed.select("node", "carrier", "root", "step", "c")
    share = F.ceil(F.col("k") / F.lit(LEADERS))
    leaders = placed.where(F.pmod(F.xxhash64("node", F.lit(1)), share) == 0)
    there = chunks.select("root", F.col("step").alias("other"), "m")
    visiting = _near_steps(leaders.select("node", "carrier", "root", "step")).join(there, ["root", "other"])
    visits = visiting.select(
        "node", "carrier", "root", F.col("other").alias("step"),
        F.explode(F.expr("sequence(0, m - 1)")).alias("c"),
    )
    both = own.union(visits).distinct()
    return both.select(
        "node", "carrier", F.col("root").alias("cluster"),
        F.concat_ws("_", F.lit("l"), "root", "step", "c").alias("work"),
    )


def _rest_work(placed: DataFrame, chunks: DataFrame, labels: DataFrame) -> DataFrame:
    """Second round: nodes outside the largest component of their cluster meet every
    chunk that they can link to. Two nodes of that component need not meet."""
    named = placed.join(labels, "node")
    counts = named.groupBy("root", "label").agg(F.count("*").alias("n"))
    largest = counts.groupBy("root").agg(F.max_by("label", F.struct("n", "label")).alias("most"))
    rest = named.join(largest, "root").where(F.col("label") != F.col("most"))
    rest = rest.select("node", "carrier", "root", "step").distinct()
    parts = rest.groupBy("root", "step").agg(
        F.ceil(F.count("*") * 2 / CHUNK_NODES).cast("int").alias("parts")
    )
    rest = rest.join(parts, ["root", "step"]).withColumn(
        "p", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    )
    there = chunks.select("root", F.col("step").alias("other"), "m")
    rest_side = _near_steps(rest).join(there, ["root", "other"]).select(
        "node", "carrier", "root", "step", "p", "other",
        F.explode(F.expr("sequence(0, m - 1)")).alias("c"),
    )
    meeting = _near_steps(parts).select("root", F.col("other").alias("at"), "step", "parts")
    chunk_side = (
        placed.select("node", "carrier", "root", F.col("step").alias("at"), "c")
        .join(meeting, ["root", "at"])
        .select(
            "node", "carrier", "root", "step",
            F.explode(F.expr("sequence(0, parts - 1)")).alias("p"),
            F.col("at").alias("other"), "c",
        )
    )
    both = rest_side.union(chunk_side).distinct()
    return both.select(
        "node",
        "carrier",
        F.col("root").alias("cluster"),
        F.concat_ws("_", F.lit("r"), "root", "step", "p", "other", "c").alias("work"),
    )


def near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id.

    Words are runs of other than ASCII white space, with A-Z lowered; a document's
    set holds its distinct ``words``-word shingles, or its whole sequence if that
    is shorter. Documents link at a Jaccard similarity of ``percent`` or more, and
    component_id is the smallest id that links reach. Null, empty and blank texts
    have no set and stay alone, under their own id. Rows with a null id take part;
    a component of such rows only has a null id. No documents give no rows; other
    columns are not read.
    """
    with shuffles_removed(docs.sparkSession):
        rows, by_digest, total = _components_by_digest(docs, words, percent)
    alone = rows.where("n = 0").select("doc_id", "n", F.col("doc_id").alias("component_id"))
    together = _with_hot(rows.where("n > 0"), by_digest, total)
    together = together.select("doc_id", "n", "component_id")
    return together.union(alone).select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def _components_by_digest(
    docs: DataFrame, words: int, percent: int
) -> tuple[DataFrame, DataFrame, int]:
    """Size and digest of each row's set, and for each digest its copies and
    component_id, both stored; and the number of rows."""
    spark = docs.sparkSession
    shared_folder(spark)
    small_batches(spark)
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    carrier = F.coalesce("doc_id", F.lit(NO_ID)).alias("carrier")
    folder = shared_path(spark, "sets")
    schema = "doc_id bigint, n bigint, digest binary, node bigint, counts binary"
    texts.mapInArrow(returning_memory(_measure(words)), schema).write.parquet(folder)
    measured = spark.read.schema(schema).parquet(folder)
    rows = measured.where("digest IS NOT NULL").drop("counts")
    frequent = _frequent(measured)

    # Twice the parts that the total of all sizes needs: what the numbers in use add.
    all_rows = rows.agg(F.sum("n").alias("n"), F.count("*").alias("rows")).first()
    total = all_rows["n"] or 0
    entries = 4 * total * (100 - percent) // (100 + percent)
    blocks = int(entries // ENTRIES_PER_BLOCK) + 1
    parts = docs.select("text").mapInArrow(
        returning_memory(_parts(words, percent, frequent)), "key bigint, node bigint, root bigint"
    )
    dealt = parts.repartition(blocks, F.coalesce("key", "root"))
    meetings = dealt.mapInArrow(returning_memory(_meet_across), "u bigint, v bigint")
    clusters = components(meetings)

    sizes = rows.where("n > 0").groupBy("digest").agg(
        F.max("n").alias("n"), F.max("node").alias("node"), F.min(carrier).alias("carrier")
    )
    nodes = clusters.join(sizes, "node")
    totals = nodes.groupBy("root").agg(F.count("*").alias("k"), F.sum("n").alias("all_n"))
    large = (F.col("k") > CHUNK_NODES) | (F.col("all_n") > CHUNK_SHINGLES)
    sized = nodes.join(totals.select("root", large.alias("large")), "root").checkpoint()
    counts = sized.agg(
        F.count("*").alias("nodes"),
        F.sum(F.expr("CASE WHEN NOT large THEN n END")).alias("small_n"),
        F.count_if("large").alias("large"),
    ).first()
    bins = int((counts["small_n"] or 0) // (CHUNK_SHINGLES // 4)) + 1
    bits = min(FILTER_BITS, max(10, int(8 * counts["nodes"]).bit_length()))
    sets = texts.select(carrier, "text").mapInArrow(
        returning_memory(_whole_sets(words, bits, _carrier_filter(sized, bits))),
        "node bigint, carrier bigint, digest binary, shingles binary",
    )

    def links_of(work: DataFrame) -> DataFrame:
        dealt = sets.join(work, ["node", "carrier"]).groupBy("work")
        return dealt.applyInArrow(_multiply(percent), "u binary, v binary")

    placed, chunks = _chunked(sized, percent)
    work = _small_work(sized, bins).union(_chunk_work(placed, chunks))
    links = links_of(work).checkpoint()
    linked_sets = components(links)
    if counts["large"]:
        digests = rows.where("n > 0").select("node", "digest").distinct()
        found = linked_sets.select(F.col("node").alias("digest"), F.col("root").alias("label"))
        labels = digests.join(found, "digest", "left").select(
            "node", F.coalesce("label", "digest").alias("label")
        )
        rest = _rest_work(placed, chunks, labels).checkpoint()
        linked_sets = components(links.union(links_of(rest)))

    firsts = rows.where("n > 0").groupBy("digest").agg(
        F.min("doc_id").alias("first_id"), F.count("*").alias("copies")
    )
    in_component = linked_sets.join(firsts, linked_sets["node"] == firsts["digest"])
    smallest = in_component.groupBy("root").agg(F.min("first_id").alias("smallest"))
    named = in_component.join(smallest, "root").select("digest", "smallest")
    by_digest = firsts.join(named, "digest", "left").select(
        "digest", "copies", F.coalesce("smallest", "first_id").alias("component_id")
    )
    return rows, by_digest.checkpoint(), all_rows["rows"]


def _with_hot(rows: DataFrame, by_digest: DataFrame, total: int) -> DataFrame:
    """Rows with what belongs to their digest, which is stored.

    Digests with more than one in ``HOT_SHARE`` of all rows are at most that many and
    are broadcast; no key of the other rows' shuffle has more than that share.
    """
    is_hot = F.col("copies") > F.lit(total // HOT_SHARE)
    hot, other = F.broadcast(by_digest.where(is_hot)), by_digest.where(~is_hot)
    rest = rows.join(hot.select("digest"), "digest", "left_anti")
    return rows.join(hot, "digest").unionByName(rest.join(other, "digest"))


def keep_one_per_component(
    docs: DataFrame, words: int = WORDS, percent: int = PERCENT
) -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of their component, all columns.

    Rows of a repeated id go together; a row with a null id cannot be named and stays.
    """
    with shuffles_removed(docs.sparkSession):
        found = near_duplicates(docs, words, percent)
        named = found.where("doc_id IS NOT NULL AND NOT doc_id <=> component_id")
        goes = named.select("doc_id").checkpoint()
    return _without(docs, goes)


def _without(docs: DataFrame, goes: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose id is not in ``goes``, which is stored.

    Where the ids are too many to broadcast, a join with them shuffles whole rows: only
    those that a filter of the ids lets through, which is small, are joined.
    """

    def word(doc_id: str) -> str:
        return f"pmod(xxhash64({doc_id}), {ID_WORDS}L)"

    def bit(doc_id: str) -> str:
        return f"shiftleft(1L, int(pmod(shiftright(xxhash64({doc_id}), 32), 64L)))"

    doc_id = "cast(d.doc_id AS bigint)"
    marks = goes.groupBy(F.expr(word("doc_id")).alias("word")).agg(
        F.bit_or(F.expr(bit("doc_id"))).alias("bits")
    )
    marks = F.broadcast(marks).alias("m")
    marked = F.expr(f"{word(doc_id)} = m.word AND m.bits & {bit(doc_id)} <> 0")
    rows = docs.alias("d")
    stays = rows.join(marks, marked, "left_anti")
    asked = rows.join(marks, marked, "left_semi")
    return stays.union(asked.join(goes.alias("g"), F.expr(f"{doc_id} = g.doc_id"), "left_anti"))
