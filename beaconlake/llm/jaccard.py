"""Exact similarity join of shingle sets, with count-vector R-trees.

Documents with equal sets are one node. Two sets link when 100 * common >= 90 * united.

1. Routing. Linking sets of at most u shingles differ in at most 2u/19 of them. At each level of sizes the range of shingle
   hashes is cut into more groups than that, so linking sets agree on whole groups. Every node sends one hash for each
   group, at the level of its size and, near its top, at the next; nodes that share one at a level belong to one cluster
   of that level, so a node is in two clusters at most. Groups of
   hardly any shingles would let unrelated sets meet. There are ``spare`` groups more than needed, so linking sets agree
   on more groups than that, and a node with no more than ``spare`` light groups need not send them: an agreed group is
   light in both sets or in neither. Nodes with more light groups send all. So no linking pair is lost.
   A node also knows how many of its routes a partner must share, all that linking sets agree on but for the light ones it
   did not send. One that shares fewer with all others together has no partner and is left out, twice over:
   texts that share a notice or a turn of words would else chain into clusters that grow with the corpus.
2. R-tree. In a cluster the sets' shingles are counted by hash group. The counts are points of an R-tree, whose boxes
   carry the coordinates' maxima and the range of sizes. The sum of the smaller coordinates bounds the overlap from above,
   so boxes and points that cannot reach the needed overlap are left out, and so are those already joined to the query.
3. Verification. Surviving pairs are intersected exactly. Only links that join two parts leave the task, so a cluster
   of n nodes gives fewer than n rows.

A cluster of more than BLOCK nodes, or of more than SHINGLES shingles, is cut into blocks whose pairs are separate groups.
Texts go to the groups, compressed, and are cut into shingles there: the hashes of a text's shingles take several times its bytes.

Defined cases: a null text, and a text without a word, has an empty set and links with nothing. With one or two words the
whole sequence is the one shingle. A null doc_id is never a component's name unless all its documents lack one.
Documents are joined by their sets alone: those that share a doc_id, or lack one, stay apart unless they link.
Repeated rows are copies of one another. Shingles, sets and the texts of one doc_id are told apart by 64-bit hashes.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beaconlake.llm.common import bounded_batches, raw_texts, tidy
from beaconlake.llm.components import components
from beaconlake.llm.repeats import LAST_ID, Hashes, identified, mixed
from beaconlake.session import written

WORDS = 3
PERCENT = 90
#: Bytes hashed at once; ratio of the sizes at the ends of a level.
SLICE = 2 << 20
LEVEL_RATIO = 1.25
#: Hash groups beyond those needed, in hundredths; rounds in which nodes that share too few routes are left out.
SPARE = 30
PRUNES = 2
#: Hash groups of a count vector, points in a leaf of the tree, leaves in a branch, nodes and shingles of a block.
GROUPS = 128
LEAF = 32
BRANCH = 16
BLOCK = 4096
SHINGLES = 4 << 20
#: Sets, and about how many shingles, intersected with a query at once, before it is seen again which are joined by now.
CHECKED = 256
CHECKED_SHINGLES = 1 << 19

_blank = np.zeros(256, bool)
_blank[[*range(0x09, 0x0E), 0x20]] = True
_place = np.random.default_rng(9).integers(1, 2**63, 8, dtype=np.uint64) | np.uint64(1)


def shingle_sets(texts: list[bytes], words: int = WORDS) -> list[np.ndarray]:
    """The sorted 64-bit hashes of each text's distinct shingles."""
    joined = np.frombuffer(b" " + b" ".join(texts).lower() + b" ", np.uint8)
    blank = _blank[joined]
    first = np.flatnonzero(blank[:-1] & ~blank[1:]) + 1
    end = np.flatnonzero(~blank[:-1] & blank[1:]) + 1
    word = Hashes(joined).of(first, end)
    starts = np.cumsum([1, *(len(t) + 1 for t in texts)])
    bounds = np.searchsorted(first, starts)
    whole = np.zeros(max(len(word) - words + 1, 0), np.uint64)
    for i in range(words):
        whole += word[i : i + len(whole)] * _place[i]
    whole = mixed(whole)
    out = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if b - a >= words:
            out.append(np.unique(whole[a : b - words + 1]))
        elif b > a:
            out.append(mixed(np.sum(word[a:b] * _place[: b - a], keepdims=True) + np.uint64(b - a)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def name(shingles: np.ndarray) -> int:
    """A 64-bit hash of a set."""
    total = mixed(shingles).sum(dtype=np.uint64, keepdims=True) * _place[6]
    total += mixed(shingles ^ _place[5]).sum(dtype=np.uint64, keepdims=True) + np.uint64(len(shingles))
    return int(mixed(total).view(np.int64)[0])


def needed(a: int, b, percent: int = PERCENT):
    """The smallest overlap with which sets of sizes ``a`` and ``b`` link."""
    return -(-percent * (a + b) // (100 + percent))


@functools.lru_cache(maxsize=512)
def level_start(level: int, percent: int) -> int:
    """Smallest size of a level. Linking sets are of one level or of neighbouring ones."""
    if level <= 0:
        return 1
    before = level_start(level - 1, percent)
    return max(before + 1, int(before * max(LEVEL_RATIO, 100.5 / percent)) + 1)


@dataclass(frozen=True)
class Level:
    """How sets of a level are cut: where hash groups begin, a label for each group, what is light, and how many groups
    there are beyond the differences that linking sets can have and one."""

    edges: np.ndarray
    labels: np.ndarray
    light: int
    spare: int


@functools.lru_cache(maxsize=512)
def level_of(level: int, percent: int) -> Level:
    least, top = level_start(level, percent), level_start(level + 1, percent) - 1
    differ = 2 * top * (100 - percent) // (100 + percent)
    spare = (differ + 1) * SPARE // 100 + min(differ, 2)
    groups = differ + 1 + spare
    # the largest groups that are still few enough to be left out by nearly all sets of the level (Poisson counts)
    mean, light, share = least / groups, 0, 0.0
    for size in range(20):
        share += math.exp(-mean) * mean**size / math.factorial(size)
        if 1.6 * share * groups + 0.7 <= spare:
            light = size
    edges = np.arange(1, groups, dtype=np.uint64) * np.uint64(2**64 // groups if groups > 1 else 0)
    labels = mixed(np.arange(groups, dtype=np.uint64) + np.uint64(level << 32) + _place[4])
    return Level(edges, labels, light, spare)


def routes(shingles: np.ndarray, percent: int = PERCENT) -> list[tuple[int, np.ndarray, int]]:
    """For each level where the set can meet a partner, one hash for each of its groups of shingles, and how many of these a
    partner shares at least."""
    n = len(shingles)
    if not n:
        return []
    own = 0
    while level_start(own + 1, percent) <= n:
        own += 1
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(shingles ^ _place[3]))])
    out = []
    for level in (own, own + 1):
        if level > own and 100 * n < percent * level_start(level, percent):
            continue
        plan = level_of(level, percent)
        cuts = np.concatenate([[0], np.searchsorted(shingles, plan.edges), [n]])
        found = mixed((sums[cuts[1:]] - sums[cuts[:-1]]) ^ plan.labels)
        light = np.diff(cuts) <= plan.light
        unsent = int(light.sum())
        if unsent <= plan.spare:
            out.append((level, found[~light], plan.spare + 1 - unsent))
        else:
            out.append((level, found, plan.spare + 1))
    return out


PARTS = pa.schema([("part", pa.int32()), *((c, pa.binary()) for c in ("route", "vertex", "need", "row", "docs"))])
PARTS_DDL = "part int, route binary, vertex binary, need binary, row binary, docs binary"
#: A document: its node, and the node's vertices (one for each level, 0 for none).
DOCS = np.dtype([("id", "<i8"), ("node", "<i8"), ("own", "<i8"), ("next", "<i8"), ("key", "<i8"), ("n", "<i4")])


def _slices(batch: pa.RecordBatch) -> Iterator[tuple[int, list[bytes]]]:
    """Rows of a batch in runs of about SLICE bytes: first row, texts."""
    held, first, total = [], 0, 0
    for i, raw in enumerate(raw_texts(batch)):
        held.append(raw)
        total += len(raw)
        if total >= SLICE:
            yield first, held
            held, first, total = [], i + 1, 0
    if held:
        yield first, held


def routed(parts: int, words: int, percent: int):
    """Routes of each slice's nodes, for each of ``parts`` groups of routes, and the slice's documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys = batch.column("id").to_numpy(), batch.column("key").to_numpy()
            for first, texts in _slices(batch):
                docs = np.zeros(len(texts), DOCS)
                docs["id"], docs["key"] = ids[first : first + len(texts)], keys[first : first + len(texts)]
                needs: dict[int, int] = {}
                route, vertex = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
                for i, shingles in enumerate(shingle_sets(texts, words)):
                    docs["n"][i] = len(shingles)
                    docs["node"][i] = node = name(shingles)
                    for place, (level, found, need) in zip(("own", "next"), routes(shingles, percent)):
                        docs[place][i] = at = int(mixed(np.array([node], np.int64).view(np.uint64) + np.uint64(level)).view(np.int64)[0])
                        if at not in needs:
                            needs[at] = need
                            route.append(found)
                            vertex.append(np.full(len(found), at, np.int64))
                yield from _dealt(np.concatenate(route), np.concatenate(vertex), needs, docs, parts)

    return run


def _dealt(route: np.ndarray, vertex: np.ndarray, needs: dict[int, int], docs: np.ndarray, parts: int) -> Iterator[pa.RecordBatch]:
    """A slice's routes by group of routes; vertices and what they need are written once for each group."""
    part = ((route >> np.uint64(32)) % np.uint64(parts)).astype(np.int32)
    order = np.lexsort((vertex, part))
    bounds = np.searchsorted(part[order], np.arange(parts + 1))
    own = int(docs["id"][0]) % parts
    rows = []
    for p in range(parts):
        chosen = order[bounds[p] : bounds[p + 1]]
        if len(chosen) or p == own:
            unique, row = np.unique(vertex[chosen], return_inverse=True)
            rows.append({
                "part": p, "route": route[chosen].tobytes(), "vertex": unique.tobytes(),
                "need": np.array([min(needs[v], MOST) for v in unique.tolist()], "<u2").tobytes(),
                "row": row.astype(_index_type(len(unique))).tobytes(), "docs": docs.tobytes() if p == own else b"",
            })
    yield pa.RecordBatch.from_pylist(rows, schema=PARTS)


#: What a vertex needs is sent in two bytes; one that needs more is held to this.
MOST = (1 << 16) - 1


def _index_type(n: int) -> str:
    return "<u2" if n <= 1 << 16 else "<u4"


CODEC = "zstd"
PACKED_DDL = "node long, cluster long, blocks long, size long, packed binary"
PACKED = pa.schema([*((c, pa.int64()) for c in ("node", "cluster", "blocks", "size")), ("packed", pa.binary())])
MEMBERS_DDL = "cluster long, left long, right long, node long, shingles binary"
MEMBERS = pa.schema([*((c, pa.int64()) for c in ("cluster", "left", "right", "node")), ("shingles", pa.binary())])
MET_DDL = "shared boolean, a long, b long, own long, next long, key long, n int"
MET = pa.schema([("shared", pa.bool_()), *((c, pa.int64()) for c in ("a", "b", "own", "next", "key")), ("n", pa.int32())])


def met(key: tuple, table: pa.Table) -> pa.Table:
    """Routes that several vertices share (a: route, b: vertex, n: how many routes the vertex must share), a row for each of
    the vertices; and the documents (a: id, b: node) as they came."""
    route = np.frombuffer(b"".join(table.column("route").to_pylist()), "<u8")
    vertices, needs = [np.zeros(0, np.int64)], [np.zeros(0, np.uint16)]
    for unique, need, row in zip(*(table.column(c).to_pylist() for c in ("vertex", "need", "row"))):
        known = np.frombuffer(unique, "<i8")
        at = np.frombuffer(row, _index_type(len(known)))
        vertices.append(known[at])
        needs.append(np.frombuffer(need, "<u2")[at])
    vertex, need = np.concatenate(vertices), np.concatenate(needs)
    order = np.lexsort((vertex, route))
    route, vertex, need = route[order], vertex[order], need[order]
    once = np.ones(len(route), bool)  # a node may come from several slices
    once[1:] = (route[1:] != route[:-1]) | (vertex[1:] != vertex[:-1])
    route, vertex, need = route[once], vertex[once], need[once]
    same = route[1:] == route[:-1]
    shared = np.zeros(len(route), bool)
    shared[1:] |= same
    shared[:-1] |= same
    route, vertex, need = route[shared].view(np.int64), vertex[shared], need[shared]
    docs = np.frombuffer(b"".join(table.column("docs").to_pylist()), DOCS)
    m, d = len(route), len(docs)
    none = np.zeros(m, np.int64)
    columns = {"a": np.concatenate([route, docs["id"]]), "b": np.concatenate([vertex, docs["node"]])}
    for field in ("own", "next", "key"):
        columns[field] = np.concatenate([none, docs[field]]).astype(np.int64)
    columns["n"] = np.concatenate([need, docs["n"]]).astype(np.int32)
    return pa.table({"shared": np.repeat([True, False], [m, d]), **columns}, schema=MET)


def edges(met_rows: DataFrame) -> DataFrame:
    """``a, b``: vertices that share a route, each with the smallest of them, of those that share as many as they need."""
    current = met_rows.where("shared").select(F.col("a").alias("route"), F.col("b").alias("vertex"), F.col("n").alias("need"))
    for _ in range(PRUNES):
        enough = current.groupBy("vertex").agg(F.count("*").alias("found"), F.first("need").alias("need")).where("found >= need")
        left = current.join(enough.select("vertex"), "vertex", "left_semi")
        met_still = left.groupBy("route").agg(F.count("*").alias("found"), F.min("vertex").alias("least")).where("found > 1")
        current = written(left.select("route", "vertex", "need").join(met_still.select("route", "least"), "route"), "jaccard-routes")
    return current.where("vertex <> least").select(F.col("vertex").alias("a"), F.col("least").alias("b")).distinct()


class CountTree:
    """An R-tree of two levels over count vectors, packed by size and by the counts of the widest-spread groups."""

    def __init__(self, sets: list[np.ndarray], groups: int = GROUPS):
        self.sizes = np.array([len(s) for s in sets], np.int64)
        self.counts = np.zeros((len(sets), groups), np.int32)
        for i, s in enumerate(sets):
            self.counts[i] = np.bincount(((s >> np.uint64(17)) % np.uint64(groups)).astype(np.int64), minlength=groups)
        widest = np.argsort(-self.counts.var(axis=0))[:2]
        self.order = np.lexsort((*(self.counts[:, g] for g in widest), self.sizes))
        self.leaf = np.arange(0, len(sets), LEAF)
        self.branch = np.arange(0, len(self.leaf), BRANCH)
        most, size = self.counts[self.order], self.sizes[self.order]
        self.leaf_most = np.maximum.reduceat(most, self.leaf)
        self.leaf_small, self.leaf_large = np.minimum.reduceat(size, self.leaf), np.maximum.reduceat(size, self.leaf)
        self.branch_most = np.maximum.reduceat(self.leaf_most, self.branch)
        self.branch_small = np.minimum.reduceat(self.leaf_small, self.branch)
        self.branch_large = np.maximum.reduceat(self.leaf_large, self.branch)

    def _reach(self, q: int, most: np.ndarray, small: np.ndarray, large: np.ndarray, percent: int) -> np.ndarray:
        """Which boxes may hold a partner of ``q``: by size, and by the summed minima of coordinates."""
        n = self.sizes[q]
        least = np.maximum(small, -(-percent * n // 100))
        fits = (least <= large) & (100 * n >= percent * small)
        return fits & (np.minimum(most, self.counts[q]).sum(1) >= needed(n, least, percent))

    def leaves(self, q: int, percent: int) -> np.ndarray:
        near = np.flatnonzero(self._reach(q, self.branch_most, self.branch_small, self.branch_large, percent))
        inside = (near[:, None] * BRANCH + np.arange(BRANCH)).ravel()
        inside = inside[inside < len(self.leaf)]
        return inside[self._reach(q, self.leaf_most[inside], self.leaf_small[inside], self.leaf_large[inside], percent)]

    def points(self, q: int, chosen: np.ndarray, percent: int) -> np.ndarray:
        return chosen[self._reach(q, self.counts[chosen], self.sizes[chosen], self.sizes[chosen], percent)]


def joining_links(sets: list[np.ndarray], percent: int = PERCENT) -> list[tuple[int, int]]:
    """Links that join all sets which links join, one fewer than each part has members. Empties the list of sets, which are
    not needed once their shingles are numbered."""
    if len(sets) == 2:
        a, b = sets
        common = len(np.intersect1d(a, b, assume_unique=True))
        return [(0, 1)] if common >= needed(len(a), len(b), percent) else []
    tree = CountTree(sets)
    starts = np.cumsum(tree.sizes) - tree.sizes
    # with the sets themselves about 25 bytes for each shingle of the group while the distinct ones are sorted out
    values = np.concatenate(sets)
    values.sort()
    values = values[np.concatenate([[True], values[1:] != values[:-1]])]
    flat = np.empty(int(tree.sizes.sum()), np.int32)
    for s, at in zip(sets, starts.tolist()):
        flat[at : at + len(s)] = np.searchsorted(values, s)
    own = np.zeros(len(values), bool)
    n = len(sets)
    del values, s
    sets.clear()
    part = np.arange(n)
    out = []
    for q in tree.order.tolist():
        mine = flat[starts[q] : starts[q] + tree.sizes[q]]
        own[mine] = True
        packed = part[tree.order]
        strange = np.logical_or.reduceat(packed != part[q], tree.leaf)  # leaves with a point of another part
        near = tree.leaves(q, percent)
        near = (near[strange[near]][:, None] * LEAF + np.arange(LEAF)).ravel()
        near = tree.order[near[near < n]]
        near = tree.points(q, near[part[near] != part[q]], percent)
        share = np.cumsum(tree.sizes[near]) // CHECKED_SHINGLES * len(near) + np.arange(len(near)) // CHECKED
        for chosen in np.split(near, np.flatnonzero(np.diff(share)) + 1):
            chosen = chosen[part[chosen] != part[q]]
            if not len(chosen):
                continue
            sizes = tree.sizes[chosen]
            ends = np.cumsum(sizes)
            at = np.repeat(starts[chosen] - (ends - sizes), sizes) + np.arange(ends[-1])
            common = np.add.reduceat(own[flat[at]].astype(np.int64), ends - sizes)
            for other in chosen[common >= needed(tree.sizes[q], sizes, percent)].tolist():
                if part[other] != part[q]:
                    out.append((q, other))
                    part[part == part[other]] = part[q]
        own[mine] = False
    return out


def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compressed texts of cluster members, one row for each cluster they are in."""
    for batch in batches:
        rows = []
        for node, inside, raw in zip(batch.column("node").to_pylist(), batch.column("inside").to_pylist(), raw_texts(batch)):
            small = pa.compress(raw, codec=CODEC, asbytes=True)
            rows += [(node, c["cluster"], c["blocks"], len(raw), small) for c in inside]
        columns = list(zip(*rows)) or [[] for _ in PACKED]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, PACKED)], schema=PACKED)


def member_sets(words: int):
    """Shingle sets of cluster members, in the order in which their compressed texts come."""

    def cut(rows: list[tuple], texts: list[bytes]) -> pa.RecordBatch:
        sets = [x.tobytes() for x in shingle_sets(texts, words)]
        columns = list(zip(*rows)) or [[] for _ in MEMBERS.names[:-1]]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip([*columns, sets], MEMBERS)], schema=MEMBERS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, texts, total = [], [], 0
            places = zip(*(batch.column(n).to_pylist() for n in ("cluster", "left", "right", "node")))
            for row, size, small in zip(places, batch.column("size").to_pylist(), raw_texts(batch, "packed")):
                rows.append(row)
                texts.append(pa.decompress(small, decompressed_size=size, codec=CODEC, asbytes=True))
                total += size
                if total >= SLICE:
                    yield cut(rows, texts)
                    rows, texts, total = [], [], 0
            if rows:
                yield cut(rows, texts)

    return run


def linked(percent: int):
    """Joining links of each group; rows of a group stand together."""

    def links(members: dict[int, bytes]) -> pa.RecordBatch:
        nodes, sets = list(members), [np.frombuffer(b, "<u8") for b in members.values()]
        members.clear()
        found = joining_links(sets, percent)
        return pa.RecordBatch.from_arrays(
            [pa.array([nodes[a] for a, _ in found], pa.int64()), pa.array([nodes[b] for _, b in found], pa.int64())], names=["a", "b"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held = None, {}
        for batch in batches:
            columns = [batch.column(n).to_pylist() for n in ("cluster", "left", "right", "node", "shingles")]
            for cluster, left, right, node, shingles in zip(*columns):
                if (cluster, left, right) != current:
                    if len(held) > 1:
                        yield links(held)
                    current, held = (cluster, left, right), {}
                held[node] = shingles
        if len(held) > 1:
            yield links(held)

    return run


def dealt_texts(spread: DataFrame, met_rows: DataFrame) -> DataFrame:
    """``cluster, left, right, node, size, packed``: the compressed texts of each pair of blocks of a cluster."""
    docs = met_rows.where(~F.col("shared") & (F.col("n") > 0))
    nodes = docs.groupBy(F.col("b").alias("node")).agg(
        F.min(F.struct(F.col("a").alias("id"), "key")).alias("first"), F.first("own").alias("own"), F.first("next").alias("next"), F.first("n").alias("n")
    )
    vertices = nodes.select("node", "first", "n", F.explode(F.array("own", "next")).alias("vertex")).where("vertex <> 0")
    clusters = components(edges(met_rows))
    placed = clusters.withColumnRenamed("id", "vertex").join(vertices, "vertex")
    blocks = F.ceil(F.greatest(F.count("*") / BLOCK, F.sum("n") / SHINGLES))
    placed = placed.join(placed.groupBy("component").agg(blocks.alias("blocks")), "component")
    members = placed.groupBy("node", "first.id", "first.key").agg(
        F.collect_list(F.struct(F.col("component").alias("cluster"), "blocks")).alias("inside")  # two at most
    )
    texts = spread.select("id", "key", "text").join(members, ["id", "key"]).mapInArrow(tidy(packed), PACKED_DDL)
    block = F.pmod(F.xxhash64("node"), "blocks")
    dealt = texts.withColumn("block", block).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return dealt.select(
        "cluster", F.least("block", "other").alias("left"), F.greatest("block", "other").alias("right"), "node", "size", "packed"
    )


def dealt_sets(spread: DataFrame, met_rows: DataFrame, words: int) -> DataFrame:
    """``cluster, left, right, node, shingles``: the sets of each pair of blocks of a cluster, as ``links`` compares them."""
    return dealt_texts(spread, met_rows).mapInArrow(tidy(member_sets(words)), MEMBERS_DDL)


def links(spread: DataFrame, met_rows: DataFrame, words: int, percent: int) -> DataFrame:
    """Joining links between nodes (a, b) that share a cluster."""
    sets, compare = member_sets(words), linked(percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from compare(sets(batches))

    dealt = dealt_texts(spread, met_rows)
    grouped = dealt.repartition("cluster", "left", "right").sortWithinPartitions("cluster", "left", "right")
    return grouped.mapInArrow(tidy(run), "a long, b long")


def _keyed(docs: DataFrame, *more: Column) -> DataFrame:
    """``identified`` rows with a key of 64 bits, as very many documents may share an id or lack one."""
    return identified(docs, *more).withColumn("key", F.xxhash64("text"))


def join(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``id, key, n_shingles, part, component`` of every document; ``id`` and ``key`` as ``_keyed`` gives them.

    ``part`` is the smallest node of a component (null for an empty set), ``component`` its smallest id.
    """
    bounded_batches(docs.sparkSession)
    spread = _keyed(docs)
    parts = max(32, spread.rdd.getNumPartitions())
    sent = spread.mapInArrow(tidy(routed(parts, words, percent)), PARTS_DDL)
    met_rows = written(sent.repartition(parts, "part").groupBy("part").applyInArrow(met, MET_DDL), "jaccard")
    found = components(written(links(spread, met_rows, words, percent), "jaccard-links"))
    seen = met_rows.where(~F.col("shared"))
    nodes = seen.where("n > 0").groupBy("b").agg(F.min("a").alias("id"))
    found = found.select(F.col("id").alias("b"), F.col("component").alias("part"))
    least = written(nodes.join(found, "b").groupBy("part").agg(F.min("id").alias("least")), "jaccard-names")
    named = nodes.join(found, "b", "left").withColumn("part", F.coalesce("part", "b")).join(least, "part", "left")
    named = named.select("b", "part", F.coalesce("least", "id").alias("component"))
    joined = seen.join(named, "b", "left")
    return joined.select(
        F.col("a").alias("id"), "key", F.col("n").cast("long").alias("n_shingles"), "part",
        F.coalesce("component", "a").alias("component"),
    )


def _id(column: str):
    return F.when(F.col(column) != LAST_ID, F.col(column))


def linked_documents(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every document; a component's id is its smallest doc_id."""
    found = join(docs, words, percent)
    return found.select(_id("id").alias("doc_id"), "n_shingles", _id("component").alias("component_id"))


def kept_documents(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The row of the smallest doc_id of each component, with all columns; of equal rows one stays.

    Documents with an empty set link with nothing and all stay.
    """
    names = docs.columns
    row = F.struct(*[F.col(f"`{n}`") for n in names]).alias("row")
    found = join(docs, words, percent)
    first = found.where("n_shingles > 0").groupBy("part").agg(F.min(F.struct("id", "key")).alias("first"))
    first = first.select("first.id", "first.key")
    empty = found.where("n_shingles = 0").select("id", "key")
    stay = first.unionByName(empty).distinct()
    kept = _keyed(docs, row).join(stay.withColumn("n", F.lit(1)), ["id", "key"])
    words_left = F.length(F.trim(F.regexp_replace(F.coalesce("text", F.lit("")), "[\\x09-\\x0D\\x20]+", " "))) > 0
    single = kept.where(words_left).groupBy("id", "key").agg(F.first("row").alias("row")).select("row")
    return single.unionByName(kept.where(~words_left).select("row")).select(*[F.col("row")[n].alias(n) for n in names])
