"""Near-duplicate groups of documents, by SetSketch registers.

Documents link when their sets of word shingles have a Jaccard similarity of ``percent`` or more; links join documents to
components. Documents with equal sets are one node.

1. Sketch. Each shingle spreads points of a Poisson process over REGISTERS registers; a register keeps the smallest, and
   stores it as the whole part of its logarithm to a base just above one, truncated to 16 bits. Registers of a union are the
   larger ones of its parts, so sketches merge, and two sets have a register in common about as often as the share of
   shingles they have in common.
2. Bands. Registers are taken in BANDS bands of BAND; nodes with an equal band share a bucket. A pair of similarity 0.85
   shares no bucket with a probability of 1e-8, and components need only some of their links.
3. Estimate. The counts of larger, equal and smaller registers of a pair give its likelihood for each similarity. A pair is
   left out if its best estimate lies below the threshold and is e**MARGIN times as likely as the threshold.
4. Verification, on full sets. Each node of a bucket meets the bucket's hub, its smallest node; first one hub for each node,
   then, where that did not join them already, the others. This is linear in the size of a bucket and joins what links to the
   hub. In the buckets where several components are left beside the hub, all pairs of different components are looked at:
   by estimate, then by full sets. There, groups are dealt out in blocks of BLOCK shingles; two blocks of one component
   never meet, so a large group that is joined already costs one pass for each block of others.

Defined cases: a null text, and a text without a word, has an empty set and links with nothing. With fewer words than a
shingle has, the whole sequence is the one shingle. Documents are joined by their sets alone: those that share a doc_id, or
lack one, stay apart unless they link. A component is named by its smallest doc_id; a null one is larger than all others, so
it names a component only if all its documents lack an id. ``kept`` is true where doc_id and component_id are equal or both
null. Repeated rows are equal sets. Texts are read whole and in slices, however long they are. Columns other than doc_id and
text are not read. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beaconlake.llm.components import components
from beaconlake.llm.jaccard import _slices, name, shingle_sets
from beaconlake.llm.repeats import LAST_ID, mixed
from beaconlake.session import written

WORDS = 5
PERCENT = 85
BANDS = 32
BAND = 5
REGISTERS = BANDS * BAND
#: Base of the registers' logarithms, rate of the points of one shingle in one register, largest register.
BASE = 1.001
RATE = 20.0
LARGEST = 2**16 - 1
#: By how much, in natural logarithms, a similarity below the threshold must be likelier before a pair is left out.
MARGIN = 20.0
#: Points drawn at once; members of a hub's chunk; shingles of a block; sets intersected with a set at once.
POINTS = 1 << 20
CHUNK = 2048
BLOCK = 1 << 20
CHECKED = 256

_step = np.uint64(0x9E3779B97F4A7C15)
_weights = np.random.default_rng(11).integers(1, 2**63, BAND + 1, dtype=np.uint64) | np.uint64(1)


def sketches(sets: list[np.ndarray]) -> np.ndarray:
    """Registers of each set of 64-bit hashes, one row a set.

    The points of a shingle come in ascending order, each with a register drawn for it, so a shingle is done when its next
    point lies above all registers of its set.
    """
    sizes = np.array([len(s) for s in sets], np.int64)
    least = np.full(len(sets) * REGISTERS, np.inf)
    owner = np.repeat(np.arange(len(sets)), sizes)
    h = np.concatenate([np.zeros(0, np.uint64), *sets])
    x, drawn = np.zeros(len(h)), 0
    while len(h):
        wide = int(min(64, max(1, POINTS // len(h))))
        points = mixed(h[:, None] + (np.arange(drawn, drawn + wide, dtype=np.uint64) + np.uint64(1)) * _step)
        gaps = np.log(((points >> np.uint64(24)).astype(np.float64) + 0.5) * 2.0**-40) / (-RATE * REGISTERS)
        gaps[:, 0] += x
        at = np.cumsum(gaps, axis=1)
        register = ((points & np.uint64(0xFFFFFF)) * np.uint64(REGISTERS)) >> np.uint64(24)
        np.minimum.at(least, ((owner * REGISTERS)[:, None] + register.astype(np.int64)).ravel(), at.ravel())
        limit = least.reshape(-1, REGISTERS).max(axis=1)
        x, drawn = at[:, -1], drawn + wide
        more = x < limit[owner]
        h, owner, x = h[more], owner[more], x[more]
    with np.errstate(divide="ignore"):
        value = np.floor(1 - np.log(least) / np.log(BASE))
    return np.clip(value, 0, LARGEST).astype(np.uint16).reshape(-1, REGISTERS)


def bands(registers: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each band of each row."""
    parts = registers.reshape(len(registers), BANDS, BAND).astype(np.uint64)
    label = np.arange(BANDS, dtype=np.uint64) * _weights[BAND]
    return mixed((parts * _weights[:BAND]).sum(axis=2, dtype=np.uint64) + label).view(np.int64)


def likelihood(similarity, u, v, larger, equal, smaller):
    """Log-likelihood of a similarity, given a pair's shares of the summed sizes and its register counts."""

    def differ(share):
        return -np.log1p(-np.clip(share, 1e-12, 1) * (BASE - 1) / BASE) / np.log(BASE)

    more, less = differ(u - v * similarity), differ(v - u * similarity)
    return larger * np.log(more) + smaller * np.log(less) + equal * np.log(np.maximum(1 - more - less, 1e-12))


def estimated(n: np.ndarray, m: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, tuple]:
    """The likeliest similarities of pairs of sets of sizes ``n`` and ``m`` with registers ``a`` and ``b``."""
    u = n / (n + m)
    given = (u, 1 - u, (a > b).sum(axis=1), (a == b).sum(axis=1), (a < b).sum(axis=1))
    low, high = np.zeros(len(u)), np.minimum(n, m) / np.maximum(n, m)
    for _ in range(40):
        third = (high - low) / 3
        left = likelihood(low + third, *given) < likelihood(high - third, *given)
        low, high = np.where(left, low + third, low), np.where(left, high, high - third)
    return (low + high) / 2, given


def likely(n: np.ndarray, m: np.ndarray, a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """Which pairs may link: all but those whose sizes rule it out, or whose registers make it e**-MARGIN as likely."""
    fits = 100 * np.minimum(n, m) >= percent * np.maximum(n, m)
    best, given = estimated(n.astype(float), m.astype(float), a, b)
    least = likelihood(np.full(len(best), percent / 100), *given)
    return fits & ((best >= percent / 100) | (likelihood(best, *given) - least <= MARGIN))


def links(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets link."""
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    common = int((a[np.minimum(np.searchsorted(a, b), len(a) - 1)] == b).sum())
    return 100 * common >= percent * (len(a) + len(b) - common)


SEEN = pa.schema([("id", pa.int64()), ("key", pa.int64()), ("node", pa.int64()), ("n", pa.int64()), ("sketch", pa.binary())])
SEEN_DDL = "id long, key long, node long, n long, sketch binary"


def sketched(words: int):
    """Each document's node and size; the sketch of each node once in a slice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in _slices(batch):
                sets = shingle_sets(texts, words)
                nodes = [name(s) if len(s) else None for s in sets]
                first = {node: i for i, node in reversed(list(enumerate(nodes))) if node is not None}
                rows = sorted(first.values())
                made = dict(zip(rows, sketches([sets[i] for i in rows])))
                columns = [
                    batch.column("id").slice(at, len(texts)), batch.column("key").slice(at, len(texts)), pa.array(nodes, pa.int64()),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([made[i].tobytes() if i in made else None for i in range(len(sets))], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, schema=SEEN)

    return run


def _registers(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, REGISTERS)


def _banded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = bands(_registers(batch.column("sketch")))
        node = np.repeat(batch.column("node").to_numpy(), BANDS)
        yield pa.RecordBatch.from_arrays([pa.array(found.ravel()), pa.array(node)], names=["band", "node"])


def _only_likely(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            n, m = batch.column("hub_n").to_numpy(), batch.column("n").to_numpy()
            keep = likely(n, m, _registers(batch.column("hub_sketch")), _registers(batch.column("sketch")), percent)
            yield batch.select(["hub", "node"]).filter(pa.array(keep))

    return run


def _star(words: int, percent: int):
    """Links of a hub with its members; rows stand by hub and chunk, the hub's own before the members'."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub, own = None, np.zeros(0, np.uint64)
        for batch in batches:
            hubs, nodes = batch.column("hub").to_pylist(), batch.column("node").to_pylist()
            found = []
            for at, texts in _slices(batch):
                for i, shingles in enumerate(shingle_sets(texts, words), at):
                    if nodes[i] == hubs[i]:
                        hub, own = hubs[i], shingles
                    elif hubs[i] != hub:
                        raise ValueError(f"the text of hub {hubs[i]} is missing")
                    elif links(own, shingles, percent):
                        found.append((hub, nodes[i]))
            yield _pairs(found)

    return run


def _pairs(found: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([a for a, _ in found], pa.int64()), pa.array([b for _, b in found], pa.int64())], names=["a", "b"]
    )


def joining_links(sets: list[np.ndarray], parts: list[int], percent: int) -> list[tuple[int, int]]:
    """Links between sets of different parts, as many as it takes to join the parts that links join."""
    part = np.unique(parts, return_inverse=True)[1]
    if part.max(initial=0) == 0:
        return []
    sizes = np.array([len(s) for s in sets], np.int64)
    registers = sketches(sets)
    starts = np.cumsum(sizes) - sizes
    values, flat = np.unique(np.concatenate(sets), return_inverse=True)
    own = np.zeros(len(values), bool)
    order = np.argsort(sizes, kind="stable")
    out: list[tuple[int, int]] = []
    for place, q in enumerate(order.tolist()):
        later = order[place + 1 :]
        end = place + 1 + np.searchsorted(sizes[later], sizes[q] * 100 // percent, side="right")
        near = order[place + 1 : end]
        near = near[part[near] != part[q]]
        if not len(near):
            continue
        mine = flat[starts[q] : starts[q] + sizes[q]]
        own[mine] = True
        for first in range(0, len(near), CHECKED):
            chosen = near[first : first + CHECKED]
            chosen = chosen[part[chosen] != part[q]]
            if not len(chosen):
                continue
            q_rows = np.broadcast_to(registers[q], (len(chosen), REGISTERS))
            chosen = chosen[likely(np.full(len(chosen), sizes[q]), sizes[chosen], q_rows, registers[chosen], percent)]
            for other in chosen.tolist():
                if part[other] != part[q]:
                    common = int(own[flat[starts[other] : starts[other] + sizes[other]]].sum())
                    if 100 * common >= percent * (sizes[q] + sizes[other] - common):
                        out.append((q, other))
                        part[part == part[other]] = part[q]
        own[mine] = False
    return out


def _blocks(words: int, percent: int):
    """Joining links of each pair of blocks; rows of a pair stand together."""

    def solved(held: dict[int, tuple[int, np.ndarray]]) -> pa.RecordBatch:
        nodes = list(held)
        found = joining_links([s for _, s in held.values()], [p for p, _ in held.values()], percent)
        return _pairs([(nodes[a], nodes[b]) for a, b in found])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held = None, {}
        for batch in batches:
            rows = list(zip(*(batch.column(n).to_pylist() for n in ("hub", "left", "right", "node", "part"))))
            for at, texts in _slices(batch):
                for (*group, node, part), shingles in zip(rows[at : at + len(texts)], shingle_sets(texts, words)):
                    if group != current:
                        if held:
                            yield solved(held)
                        current, held = group, {}
                    held[node] = (part, shingles)
        if held:
            yield solved(held)

    return run


def _star_links(pairs: DataFrame, held: DataFrame, words: int, percent: int) -> DataFrame:
    """Links (a, b) among pairs of a hub and a node; a hub's members are dealt out in chunks."""
    sizes = pairs.groupBy("hub").agg(F.ceil(F.count("*") / CHUNK).alias("chunks"))
    dealt = written(pairs.join(sizes, "hub").withColumn("chunk", F.pmod(F.xxhash64("node"), "chunks")).drop("chunks"), "sketch-pairs")
    hubs = dealt.select("hub", "chunk").distinct().select("hub", F.col("hub").alias("node"), "chunk")
    rows = dealt.unionByName(hubs).join(held, "node").withColumn("member", F.col("node") != F.col("hub"))
    placed = rows.repartition("hub", "chunk").sortWithinPartitions("hub", "chunk", "member").select("hub", "node", "text")
    return written(placed.mapInArrow(_star(words, percent), "a long, b long"), "sketch-links")


def _joined(parts: DataFrame | None, found: DataFrame) -> DataFrame:
    """Components of links, and of components found before."""
    if parts is not None:
        if found.isEmpty():
            return parts
        found = found.unionByName(parts.select(F.col("id").alias("a"), F.col("component").alias("b")).where("a <> b"))
    return written(components(found), "sketch-parts")


def _part_of(rows: DataFrame, parts: DataFrame, column: str, alias: str) -> DataFrame:
    known = parts.select(F.col("id").alias(column), F.col("component").alias("known"))
    return rows.join(known, column, "left").withColumn(alias, F.coalesce("known", column)).drop("known")


def _rest_links(members: DataFrame, held: DataFrame, words: int, percent: int, block: int) -> DataFrame:
    """Links between different parts of the groups of ``members`` (hub, node, part, n).

    Parts of more than ``block`` shingles have blocks of their own, which do not meet one another; the others share blocks.
    """
    weights = members.groupBy("hub", "part").agg(F.sum("n").alias("weight"))
    small = weights.where(F.col("weight") <= block).groupBy("hub").agg(F.sum("weight").alias("small"))
    sized = written(weights.join(small, "hub", "left"), "sketch-weights")
    alone = F.col("weight") > block
    owner = F.when(alone, F.col("part").cast("string")).otherwise("")
    blocks = F.when(alone, F.ceil(F.col("weight") / block)).otherwise(F.ceil(F.col("small") / block))
    shared = F.pmod(F.xxhash64("part"), blocks)
    sized = sized.select("hub", "part", owner.alias("owner"), blocks.alias("blocks"), shared.alias("shared"))
    number = F.when(F.col("owner") == "", F.col("shared")).otherwise(F.pmod(F.xxhash64("node"), "blocks"))
    named = F.concat_ws("/", "owner", number.cast("string"))
    placed = written(members.join(sized, ["hub", "part"]).select("hub", "node", "part", "owner", named.alias("block")), "sketch-members")
    left = placed.select("hub", "owner", "block").distinct()
    right = left.select("hub", F.col("owner").alias("other"), F.col("block").alias("right"))
    met = left.join(right, "hub").where("block <= right and (owner = '' or owner <> other)")
    sides = met.select("hub", F.col("block").alias("left"), "right", F.explode(F.array_distinct(F.array("block", "right"))).alias("block"))
    rows = placed.select("hub", "node", "part", "block").join(sides, ["hub", "block"]).join(held, "node")
    grouped = rows.repartition("hub", "left", "right").sortWithinPartitions("hub", "left", "right")
    return written(grouped.select("hub", "left", "right", "node", "part", "text").mapInArrow(_blocks(words, percent), "a long, b long"), "sketch-links")


def parts_of(spread: DataFrame, nodes: DataFrame, words: int, percent: int, block: int = BLOCK) -> DataFrame:
    """``id, component`` of every node that links with another; ``nodes`` has node, n, id, key and sketch."""
    rows = nodes.select("node", "sketch").mapInArrow(_banded, "band long, node long")
    buckets = written(rows.groupBy("band").agg(F.min("node").alias("hub"), F.count("*").alias("size")).where("size > 1"), "sketch-buckets")
    met = written(rows.join(buckets, "band").where("node <> hub"), "sketch-met")
    sketch = nodes.select("node", "n", "sketch")
    hub = sketch.select(F.col("node").alias("hub"), F.col("n").alias("hub_n"), F.col("sketch").alias("hub_sketch"))
    pairs = met.select("hub", "node").distinct().join(hub, "hub").join(sketch, "node")
    pairs = pairs.select("hub", "node", "hub_n", "n", "hub_sketch", "sketch").mapInArrow(_only_likely(percent), "hub long, node long")
    pairs = written(pairs, "sketch-likely")

    crowded = met.where("size > 2")
    wanted = pairs.select("node").unionByName(pairs.select(F.col("hub").alias("node"))).unionByName(crowded.select("node")).distinct()
    # copies that share an id, or lack one, are settled in their task, before the shuffle
    texts = spread.groupBy("id", "key").agg(F.first("text").alias("text"))
    held = written(texts.join(nodes.select("node", "id", "key").join(wanted, "node"), ["id", "key"]).select("node", "text"), "sketch-texts")

    least = pairs.groupBy("node").agg(F.min("hub").alias("least"))
    parts = _joined(None, _star_links(least.select(F.col("least").alias("hub"), "node"), held, words, percent))
    others = pairs.join(least, "node").where("hub <> least").select("hub", "node")
    others = _part_of(_part_of(others, parts, "hub", "hub_part"), parts, "node", "part").where("hub_part <> part")
    parts = _joined(parts, _star_links(others.select("hub", "node"), held, words, percent))

    several = _part_of(crowded, parts, "node", "part").groupBy("band").agg(F.min("part").alias("low"), F.max("part").alias("high"))
    several = written(several.where("low <> high").select("band"), "sketch-rest")
    members = crowded.join(several, "band").select("hub", "node").distinct().join(sketch.select("node", "n"), "node")
    members = written(_part_of(members, parts, "node", "part"), "sketch-members")
    return _joined(parts, _rest_links(members, held, words, percent, block))


def grouped(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, block: int = BLOCK) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every document."""
    text = F.col("text").cast("string")
    spread = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias("id"), F.xxhash64(text).alias("key"), text.alias("text"))
    seen = written(spread.mapInArrow(sketched(words), SEEN_DDL), "sketch-seen")
    first = seen.where("node is not null").groupBy("node").agg(
        F.min(F.struct("id", "key")).alias("first"), F.max("n").alias("n"), F.max("sketch").alias("sketch")
    )
    nodes = written(first.select("node", "n", "first.id", "first.key", "sketch"), "sketch-nodes")
    parts = parts_of(spread, nodes, words, percent, block)
    placed = nodes.select("node", "id").join(parts.select(F.col("id").alias("node"), "component"), "node", "left")
    placed = placed.withColumn("component", F.coalesce("component", "node"))
    names = written(
        placed.join(placed.groupBy("component").agg(F.min("id").alias("name")), "component").select("node", "name"), "sketch-names"
    )
    joined = seen.select("id", "node", "n").join(names, "node", "left")
    doc_id = F.when(F.col("id") != LAST_ID, F.col("id"))
    component = F.coalesce("name", "id")
    component = F.when(component != LAST_ID, component)
    return joined.select(
        doc_id.alias("doc_id"), F.col("n").alias("n_shingles"), component.alias("component_id"), doc_id.eqNullSafe(component).alias("kept")
    )
