"""Exact self-join of texts by the Jaccard similarity of their word n-grams, and the components of what it links.

Texts with one set are one class, found by a digest, and joined as one. Classes are joined in three steps.

* Signatures. All n-grams stand in one global order: by how many texts hold them, as a sketch of fixed size counts it
  over all texts, then by hash. Two sets of enough similarity share one of the first n - ceil(0.8 n) + 1 n-grams of
  either. These are shuffled once; n-grams that no other class has among its first drop out at once. Passages that
  many documents share stand at the end of the order, so they are hardly signatures. N-grams whose slot of the sketch
  is far above the mean are dealt to several tasks.
* Hubs. Of the classes at a signature, the smallest is the hub. Pairs of hub and class, as many as rows, however large
  the group, are joined if what they share allows it. Groups whose classes are in one component by then are done.
* Blocks. Signatures that lie in the same classes are put together, with their number as a weight. In a few rounds each
  class goes to the largest of its open groups that it has not been in yet. A group is dealt to chunks of bounded number
  and size, and each two chunks meet in one task: a group of any size costs as many rows as it has classes, times its
  chunks, and no pairs. This is done twice. First with parities: a bit for each slot of hashes, whether an odd number of
  the set's n-grams fall there. Two sets differ in as many n-grams as their parities differ in bits, at least, so a class
  whose parity is too far from all it meets has no link there. Of the others the sets are dealt, in chunks anew; those of
  different components are joined and give a spanning forest of what they link.
* Rest. Pairs of different components that share open groups but met in no block: what two sets share among their first,
  and how much follows after it, bounds what they share at all, and the few that can still be similar enough are joined.
* Prefix tree. The sets to be joined with a hub or in a block are stored as a prefix tree in global (hash) order.
  It is walked depth first. What a common beginning shares with a set is counted once for all sets below, and a
  subtree is left as soon as what remains of its sets can't lead to enough.

So every link between classes is either found or known to lie within a component. Nothing is capped, and no group is
held by one task: hot signatures are salted and counted with partial sums, hubs deal their sets to chunks.

A text without words is linked with nothing, nor is a row without id, which has no component. Rows that repeat an id
count one by one. Graph nodes are 64 bits of a class's digest. An empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from moorage.llm.common import forget_models, join_stored, lean, small_batches
from moorage.llm.components import components
from moorage.llm.shingles import shingle_sets
from moorage.session import materialise

SLOT_BITS = 20  # of the sketch
SKETCH_BLOCKS = 16
PARITY_CHUNK = 1024  # parities that meet others at once
PARITY_CHUNK_BITS = 1 << 22  # and their bits, on average, at least half
CHUNK = 256  # sets of a prefix tree
CHUNK_GRAMS = 1 << 20  # and their n-grams, on average
ROUNDS = 3  # groups of a class that are compared in blocks
WEIGHTS = (1 << 24) - 1  # bits of a group's key that hold its weight; all of them: any weight
STEP = 64  # n-grams between two looks at the bound
HOT, SALTS = 8, 64  # n-grams whose slot counts so many times the mean are dealt to so many tasks

# Fixed value: the similarity, as a fraction.
LEAST, OF = 4, 5


def needed(a: int, b: int) -> int:
    """N-grams that sets of these sizes must share: shared / (a + b - shared) >= LEAST / OF."""
    return -(-LEAST * (a + b) // (OF + LEAST))


def signature_count(size: int) -> int:
    return size - -(-LEAST * size // OF) + 1


def fitting(a: str, b: str) -> Column:
    """Whether sets of these sizes can be similar enough."""
    return F.least(a, b) * OF >= F.greatest(a, b) * LEAST


def slots(grams: np.ndarray) -> np.ndarray:
    return (grams >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def digest_of(grams: np.ndarray) -> bytes | None:
    return hashlib.blake2b(grams.tobytes(), digest_size=16).digest() if len(grams) else None


def node_of(digest: bytes | None) -> int | None:
    """The class as a node of the graph."""
    return int.from_bytes(digest[:8], "little", signed=True) if digest else None


def parity_of(grams: np.ndarray) -> bytes | None:
    """For each slot whether the set has an odd number of n-grams there; slots: the power of two from the size on."""
    if not len(grams):
        return None
    bits = max(64, 1 << (len(grams) - 1).bit_length())
    counts = np.bincount((grams & np.uint64(bits - 1)).astype(np.int64), minlength=bits)
    return np.packbits((counts & 1).astype(np.uint8), bitorder="little").tobytes()


def read_sets(docs: DataFrame) -> DataFrame:
    """doc_id, n, digest and parity of each row, and the counts of each task by block of the sketch: one table, stored."""

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_models()
        counts = np.zeros(1 << SLOT_BITS, np.uint32)
        names = ["doc_id", "n", "digest", "node", "parity", "block", "counts"]
        for batch in small_batches(batches, "text"):
            sets = shingle_sets(batch.column("text"))
            counts += np.bincount(slots(np.concatenate(sets)), minlength=len(counts)).astype(np.uint32)
            digests = [digest_of(s) for s in sets]
            nodes = [node_of(d) for d in digests]
            parities = pa.array(map(parity_of, sets), pa.binary())
            none = parities, pa.nulls(len(sets), pa.int32()), pa.nulls(len(sets), pa.binary())
            columns = [batch.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(digests, pa.binary())]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(nodes, pa.int64()), *none], names=names)
        if counts.any():
            blocks = [zlib.compress(part.tobytes(), 1) for part in np.split(counts, SKETCH_BLOCKS)]
            none = [pa.nulls(len(blocks), kind) for kind in (pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.binary())]
            numbers = pa.array(range(len(blocks)), pa.int32())
            yield pa.RecordBatch.from_arrays([*none, numbers, pa.array(blocks, pa.binary())], names=names)

    schema = "doc_id bigint, n bigint, digest binary, node bigint, parity binary, block int, counts binary"
    return materialise(docs.select("doc_id", "text").mapInArrow(lean(read), schema), "sets")


def sketch(stored: DataFrame) -> np.ndarray:
    """Number of texts by slot, summed over all tasks in two levels; ``1 << SLOT_BITS`` numbers come to the driver."""

    def add(table: pa.Table) -> pa.Table:
        total = np.zeros((1 << SLOT_BITS) // SKETCH_BLOCKS, np.uint64)
        for part in table.column("counts").to_pylist():
            data = zlib.decompress(part)
            total += np.frombuffer(data, np.uint32 if len(data) == 4 * len(total) else np.uint64)
        return pa.table({"block": table.column("block")[:1], "counts": pa.array([zlib.compress(total.tobytes(), 1)], pa.binary())})

    parts = stored.where("block IS NOT NULL").select("block", "counts")
    some = parts.groupBy("block", F.pmod(F.xxhash64("counts"), F.lit(64))).applyInArrow(add, "block int, counts binary")
    rows = {r.block: r.counts for r in some.groupBy("block").applyInArrow(add, "block int, counts binary").collect()}
    empty = np.zeros((1 << SLOT_BITS) // SKETCH_BLOCKS, np.uint64)
    blocks = [np.frombuffer(zlib.decompress(rows[i]), np.uint64) if i in rows else empty for i in range(SKETCH_BLOCKS)]
    return np.concatenate(blocks).astype(np.float32)


def signatures(texts: DataFrame, counts: np.ndarray) -> DataFrame:
    """sig, node and mark of the first n-grams of each text: whether hot, size of the set, place in the global order."""
    sent = texts.sparkSession.sparkContext.broadcast((counts, HOT * float(counts.mean()) + HOT))

    def sign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_models()
        held, hot = sent.value
        for batch in small_batches(batches, "text"):
            sets = [s for s in shingle_sets(batch.column("text")) if len(s)]
            if not sets:
                continue
            parts = [s[np.lexsort((s, held[slots(s)]))[: signature_count(len(s))]] for s in sets]
            lengths = [len(p) for p in parts]
            sigs = np.concatenate(parts)
            sizes = np.repeat(np.array([len(s) for s in sets], np.int64), lengths)
            places = np.concatenate([np.arange(n, dtype=np.int64) for n in lengths])
            marks = (held[slots(sigs)] > hot).astype(np.int64) << 62 | sizes << 31 | places
            nodes = np.repeat(np.array([node_of(digest_of(s)) for s in sets], np.int64), lengths)
            yield pa.RecordBatch.from_arrays([pa.array(sigs.view(np.int64)), pa.array(nodes), pa.array(marks)], names=["sig", "node", "mark"])

    return texts.mapInArrow(lean(sign), "sig bigint, node bigint, mark bigint")


def shared_signatures(signed: DataFrame) -> DataFrame:
    """sig, node, n and place of all signatures that more than one class has; stored."""
    hot = F.shiftright("mark", 62) == 1
    salt = F.when(hot, F.pmod(F.xxhash64("node"), F.lit(SALTS))).otherwise(0).alias("salt")
    group = Window.partitionBy("sig", "salt")
    met = (
        signed.select("sig", "node", "mark", salt)
        .withColumns({"least": F.min("node").over(group), "most": F.max("node").over(group)})
        .where(hot | (F.col("least") < F.col("most")))
    )
    bits = F.lit((1 << 31) - 1)
    n, place = F.shiftright("mark", 31).bitwiseAND(bits).cast("int"), F.col("mark").bitwiseAND(bits).cast("int")
    rows = materialise(met.select("sig", "node", n.alias("n"), place.alias("place"), hot.alias("hot")), "met")
    ends = rows.where("hot").groupBy("sig").agg(F.min("node").alias("least"), F.max("node").alias("most")).where("least < most")
    cold = rows.where("NOT hot").drop("hot")
    members = cold.unionByName(rows.where("hot").drop("hot").join(ends.select("sig"), "sig"))
    # A class comes several times where rows repeat its id.
    return materialise(members.distinct(), "members")


def grouped(members: DataFrame) -> DataFrame:
    """Signatures that lie in the same classes put together: key, node, n, weight (their number), place of the last."""
    alike = F.xxhash64(F.bit_xor(F.xxhash64("node")), F.count("*"), F.min("node"), F.max("node")).alias("key")
    keys = materialise(members.groupBy("sig").agg(alike), "keys")
    rows = members.join(keys, "sig").groupBy("key", "node", "n").agg(F.count("*").alias("weight"), F.max("place").alias("place"))
    # The key ends in the weight, so that lists of keys can be weighed.
    key = F.col("key").bitwiseAND(F.lit(~WEIGHTS)).bitwiseOR(F.least("weight", F.lit(WEIGHTS)))
    return materialise(rows.withColumn("key", key), "groups")


def set_bytes(texts: DataFrame) -> DataFrame:
    """node and the sorted set of each text, as bytes whose order is that of the sets."""

    def build(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_models()
        for batch in small_batches(batches, "text"):
            sets = shingle_sets(batch.column("text"))
            columns = [
                pa.array([node_of(digest_of(s)) for s in sets], pa.int64()),
                pa.array([s.astype(">u8").tobytes() for s in sets], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["node", "grams"])

    return texts.mapInArrow(lean(build), "node bigint, grams binary").where("node IS NOT NULL")


def common_start(a: bytes, b: bytes) -> int:
    """Number of n-grams that two sets begin with alike."""
    size = min(len(a), len(b)) // 8
    differ = np.frombuffer(a, np.uint64, size) != np.frombuffer(b, np.uint64, size)
    first = int(differ.argmax()) if size else 0
    return first if size and differ[first] else size


def tree_join(hub: bytes, sets: list[bytes]) -> list[int]:
    """Places of those sets that are similar enough to the hub.

    The sets in order are the leaves of their prefix tree from left to right, and what neighbours begin with alike are
    its inner nodes. ``shared`` holds for each depth of the current path what it has in common with the hub.
    """
    ask = np.frombuffer(hub, ">u8").astype(np.uint64)
    found: list[int] = []
    shared = np.zeros(1, np.int64)
    before = b""
    for place in sorted(range(len(sets)), key=sets.__getitem__):
        grams = sets[place]
        size = len(grams) // 8
        want = needed(len(ask), size)
        depth = min(common_start(before, grams), len(shared) - 1) if before else 0
        path = [shared[: depth + 1]]
        total = int(shared[depth])
        own = np.frombuffer(grams, ">u8")
        # Down the tree, as long as what remains can still lead to enough.
        while depth < size and total + size - depth >= want:
            part = own[depth : depth + STEP].astype(np.uint64)
            at = np.minimum(np.searchsorted(ask, part), len(ask) - 1)
            path.append(total + np.cumsum(ask[at] == part))
            total = int(path[-1][-1])
            depth += len(part)
        shared, before = np.concatenate(path), grams
        if depth == size and total >= want:
            found.append(place)
    return found


def groups(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, pa.Table]]:
    """Runs of equal keys; they may go on from batch to batch."""
    forget_models()
    held: list[pa.RecordBatch] = []
    current: tuple | None = None
    for batch in batches:
        columns = [batch.column(k).to_numpy() for k in keys]
        edges = np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns], axis=0)) + 1 if len(batch) > 1 else []
        for start, end in zip([0, *edges], [*edges, len(batch)], strict=True):
            if start == end:
                continue
            key = tuple(int(c[start]) for c in columns)
            if key != current and held:
                yield current, pa.Table.from_batches(held)
                held = []
            current = key
            held.append(batch.slice(start, end - start))
    if held:
        yield current, pa.Table.from_batches(held)


def joined(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those pairs (a, b) whose sets are similar enough; stored. ``pairs`` are stored and distinct."""
    chunks = pairs.groupBy("a").agg(F.ceil(F.count("*") / F.lit(CHUNK)).alias("chunks"))
    spread = pairs.join(chunks, "a").select("a", F.pmod(F.xxhash64("b"), "chunks").alias("chunk"), F.col("b").alias("node"))
    hubs = chunks.select("a", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"), F.col("a").alias("node"))
    dealt = spread.unionByName(hubs).join(sets, "node").repartition("a", "chunk").sortWithinPartitions("a", "chunk")

    def match(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (a, _), table in groups(batches, ["a", "chunk"]):
            nodes, grams = table.column("node").to_pylist(), table.column("grams").to_pylist()
            hub = grams[nodes.index(a)]
            others = [i for i, node in enumerate(nodes) if node != a]
            linked = [nodes[others[i]] for i in tree_join(hub, [grams[i] for i in others])]
            if linked:
                yield pa.RecordBatch.from_arrays([pa.array([a] * len(linked), pa.int64()), pa.array(linked, pa.int64())], names=["a", "b"])

    return materialise(dealt.mapInArrow(lean(match), "a bigint, b bigint"), "links")


def ngram_components(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """doc_id, n_shingles and component_id, the smallest id that links lead to, of each row."""
    rows = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    stored = read_sets(rows)
    known = stored.where("block IS NULL")
    full = known.where("doc_id IS NOT NULL AND digest IS NOT NULL")
    classes = materialise(full.groupBy("digest", "node").agg(F.min("doc_id").alias("first"), F.count("*").alias("rows")), "classes")
    labels = linked_classes(rows, stored, full, classes)

    # Classes whose component isn't simply the id of their only row.
    linked = join_stored(classes, labels, ["node"], "inner", 32)
    smallest = linked.groupBy("label").agg(F.min("first").alias("component"))
    named = linked.join(smallest, "label").select("digest", "component")
    copies = join_stored(classes.where("rows > 1"), labels, ["node"], "left_anti", 32).select("digest", F.col("first").alias("component"))
    components_of = materialise(named.unionByName(copies), "components")
    found = join_stored(known.select("doc_id", "n", "digest"), components_of, ["digest"], "left", 48)
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return found.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))


def linked_classes(rows: DataFrame, stored: DataFrame, full: DataFrame, classes: DataFrame) -> DataFrame:
    """node and label of all classes that are linked with another."""
    held = rows.where("doc_id IS NOT NULL")
    # Rows that repeat a class, by ids under which no class is found first.
    copies = classes.where("rows > 1").select("digest", "first")
    again = join_stored(full.select("doc_id", "digest"), copies, ["digest"], "inner", 48).where("doc_id <> first")
    firsts = classes.select(F.col("first").alias("doc_id"))
    twins = materialise(again.select("doc_id").distinct().join(firsts, "doc_id", "left_anti"), "twins")
    texts = join_stored(held, twins, ["doc_id"], "left_anti", 16).select("text")
    members = shared_signatures(signatures(texts, sketch(stored)))

    def wanted(nodes: DataFrame) -> DataFrame:
        return materialise(classes.join(nodes, "node", "left_semi").select(F.col("first").alias("doc_id")), "wanted")

    def sets_of(nodes: DataFrame) -> DataFrame:
        """node and set of these classes, read from their texts."""
        return set_bytes(join_stored(held, wanted(nodes), ["doc_id"], "left_semi", 16).select("text"))

    def checked(pairs: DataFrame) -> DataFrame:
        """The links among pairs (a, b), which are stored."""
        return joined(pairs, sets_of(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()))

    groups_of = grouped(members)
    links = checked(materialise(hub_pairs(groups_of), "pairs"))
    labels = components(links)
    known = join_stored(groups_of, labels, ["node"], "left", 32).withColumn("label", F.coalesce("label", "node"))
    rest = open_groups(known.withColumn("met", F.array().cast("array<bigint>")))
    if rest.isEmpty():
        return labels
    firsts = join_stored(full, wanted(rest.select("node").distinct()), ["doc_id"], "left_semi", 16)
    parities = materialise(firsts.select("node", "parity"), "parities")
    for _ in range(ROUNDS):
        blocks, more = block_links(rest, parities, sets_of)
        links = links.unionByName(more)
        rest = open_groups(relabelled(rest.drop("met").join(blocks, "node"), components(more)))
        if rest.isEmpty():
            break
    else:
        links = links.unionByName(checked(materialise(open_pairs(rest), "pairs")))
    return components(materialise(links, "links"))


def hub_pairs(rows: DataFrame) -> DataFrame:
    """Pairs (a, b) of each class with the smallest of its group, if what they share in such groups allows a link."""
    hubs = rows.groupBy("key").agg(F.min(F.struct("node", "n", "place")).alias("hub"))
    met = rows.join(hubs, "key").where((F.col("node") != F.col("hub.node")) & fitting("n", "hub.n"))
    pairs = met.groupBy(F.col("hub.node").alias("a"), F.col("node").alias("b"), F.col("hub.n").alias("a_n"), F.col("n").alias("b_n"))
    counted = pairs.agg(F.sum("weight").alias("shared"), F.max("hub.place").alias("a_place"), F.max("place").alias("b_place"))
    return counted.where(possible("shared", "a_n", "a_place", "b_n", "b_place")).select("a", "b")


def open_groups(rows: DataFrame) -> DataFrame:
    """Rows of those groups that hold several components and have not met as a whole in one round; stored.

    ``met`` lists the group each class was compared in by round, 0 where it had none left.
    """
    rows = materialise(rows, "labelled")
    ends = rows.groupBy("key").agg(
        F.min("label").alias("least"),
        F.max("label").alias("most"),
        *[F.min(F.get("met", F.lit(i))).alias(f"low_{i}") for i in range(ROUNDS)],
        *[F.max(F.get("met", F.lit(i))).alias(f"high_{i}") for i in range(ROUNDS)],
    )
    whole = F.lit(False)
    for i in range(ROUNDS):
        whole = whole | F.coalesce((F.col(f"low_{i}") == F.col(f"high_{i}")) & (F.col(f"low_{i}") != 0), F.lit(False))
    return materialise(rows.join(ends.where("least < most").where(~whole).select("key"), "key"), "open")


def relabelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """``rows`` with the labels of their labels, where these have one."""
    nearer = labels.select(F.col("node").alias("label"), F.col("label").alias("nearer"))
    return join_stored(rows, nearer, ["label"], "left", 32).withColumn("label", F.coalesce("nearer", "label")).drop("nearer")


def forest(labels: np.ndarray, chunks: np.ndarray, met: np.ndarray, grams: list[bytes]) -> list[tuple[int, int]]:
    """Pairs of labels that connect what the sets of a block link: a spanning forest.

    A block holds one chunk, all of whose sets meet, or two, whose sets meet across. Sets that met in a round before
    (equal numbers in ``met``) or are connected by now are left out.
    """
    order = np.array(sorted(range(len(grams)), key=grams.__getitem__))
    root, chunks, met = labels[order].copy(), chunks[order], met[order]
    sizes = np.array([len(grams[i]) // 8 for i in order])
    across = chunks.min() < chunks.max()
    links = []
    for at in np.flatnonzero(chunks == chunks.min()):
        others = np.flatnonzero(chunks == chunks.max()) if across else np.arange(at + 1, len(order))
        fit = np.minimum(sizes[others], sizes[at]) * OF >= np.maximum(sizes[others], sizes[at]) * LEAST
        again = ((met[others] == met[at]) & (met[at] != 0)).any(axis=1)
        others = others[(root[others] != root[at]) & fit & ~again]
        for place in tree_join(grams[order[at]], [grams[order[i]] for i in others]) if len(others) else ():
            other = others[place]
            if root[other] != root[at]:
                links.append((int(labels[order[at]]), int(labels[order[other]])))
                root[root == root[other]] = root[at]
    return links


def near(labels: np.ndarray, chunks: np.ndarray, met: np.ndarray, sizes: np.ndarray, parities: list[bytes]) -> np.ndarray:
    """Whether each set of a block may be linked with one of another component that it meets there, by their parities."""
    found = np.zeros(len(sizes), bool)
    lengths = np.array([len(p) for p in parities])
    across = chunks.min() < chunks.max()
    for length in np.unique(lengths):
        # Sets of fitting sizes have parities of one length, or one of twice the other's, whose halves are laid over each other.
        rows = np.flatnonzero((lengths == length) | (lengths == 2 * length))
        folded = np.array([np.bitwise_xor.reduce(np.frombuffer(parities[i], "<u8").reshape(-1, length // 8), axis=0) for i in rows])
        shorter, own, size, chunk, before = lengths[rows] == length, labels[rows], sizes[rows], chunks[rows], met[rows]
        for at in np.flatnonzero(chunk == chunks.min()):
            others = np.flatnonzero(chunk == chunks.max()) if across else np.arange(at + 1, len(rows))
            fit = np.minimum(size[others], size[at]) * OF >= np.maximum(size[others], size[at]) * LEAST
            others = others[fit & (own[others] != own[at]) & (shorter[others] | shorter[at])]
            others = others[~((before[others] == before[at]) & (before[at] != 0)).any(axis=1)]
            both = size[others] + size[at]
            differ = np.bitwise_count(folded[others] ^ folded[at]).sum(axis=1, dtype=np.int64)
            close = others[differ <= both - 2 * -(-LEAST * both // (OF + LEAST))]
            found[rows[close]] = True
            found[rows[at]] |= len(close) > 0
    return found


def dealt(chosen: DataFrame, data: DataFrame, most: int, most_grams: int) -> DataFrame:
    """The classes of each block in chunks of so many classes and n-grams, on average, each two of which meet; with ``data``."""
    parts = F.greatest(F.ceil(F.count("*") / F.lit(most)), F.ceil(F.sum("n") / F.lit(most_grams)))
    counts = chosen.where("block <> 0").groupBy("block").agg(F.count("*").alias("members"), parts.alias("parts"))
    placed = chosen.join(counts.where("members > 1").drop("members"), "block")
    placed = placed.withColumn("chunk", F.pmod(F.xxhash64("node", F.lit("chunk")), "parts"))
    other = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)).alias("other")
    chunks = F.least("chunk", "other").alias("low"), F.greatest("chunk", "other").alias("high")
    rows = placed.select("block", "chunk", "node", "n", "label", "met", other)
    rows = rows.select("block", "chunk", "node", "n", "label", "met", *chunks)
    return rows.join(data, "node").repartition("block", "low", "high").sortWithinPartitions("block", "low", "high")


def meetings(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int, pa.Table, np.ndarray, np.ndarray]]:
    """Block, rows, chunks and ``met`` of each two chunks that meet."""
    for (block, low, high), table in groups(batches, ["block", "low", "high"]):
        chunks = table.column("chunk").to_numpy()
        if low == high or chunks.min() < chunks.max():  # else the other chunk is empty
            yield block, table, chunks, np.array(table.column("met").to_pylist(), np.int64).reshape(len(chunks), -1)


def block_links(rest: DataFrame, parities: DataFrame, sets_of: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, DataFrame]:
    """One round of blocks: the classes with their new ``met``, and the links (a, b) of labels it found; both stored."""
    sizes = rest.groupBy("key").agg(F.count("*").alias("size"))
    left = F.when(~F.array_contains("met", F.col("key")), F.struct("size", "key"))
    best = rest.join(sizes, "key").groupBy("node", "n", "label", "met").agg(F.max(left)["key"].alias("block"))
    chosen = materialise(best.withColumn("block", F.coalesce("block", F.lit(0).cast("bigint"))), "blocks")

    def sift(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, table, chunks, met in meetings(batches):
            columns = [table.column(c).to_numpy() for c in ("label", "n", "node")]
            nodes = columns[2][near(columns[0], chunks, met, columns[1].astype(np.int64), table.column("parity").to_pylist())]
            if len(nodes):
                yield pa.RecordBatch.from_arrays([pa.array([block] * len(nodes), pa.int64()), pa.array(nodes)], names=["block", "node"])

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, table, chunks, met in meetings(batches):
            pairs = forest(table.column("label").to_numpy(), chunks, met, table.column("grams").to_pylist())
            if pairs:
                yield pa.RecordBatch.from_arrays([pa.array([p[i] for p in pairs], pa.int64()) for i in (0, 1)], names=["a", "b"])

    columns = ["block", "low", "high", "chunk", "label", "met"]
    bits = dealt(chosen, parities, PARITY_CHUNK, PARITY_CHUNK_BITS).select(*columns, "n", "node", "parity")
    close = materialise(bits.mapInArrow(lean(sift), "block bigint, node bigint").distinct(), "close")
    sets = sets_of(close.select("node"))
    whole = dealt(chosen.join(close, ["block", "node"]), sets, CHUNK, CHUNK_GRAMS).select(*columns, "grams")
    links = materialise(whole.mapInArrow(lean(compare), "a bigint, b bigint"), "links")
    return chosen.select("node", F.concat("met", F.array("block")).alias("met")), links


def open_pairs(rest: DataFrame) -> DataFrame:
    """Pairs (a, b) of classes in different components that met in no block, if what they share allows a link; each once.

    Every class carries the list of its open groups, in the global order. A pair is made in the last group that both
    lists hold, and only if the groups in both can weigh enough and enough can follow.
    """
    lists = rest.groupBy("node").agg(F.sort_array(F.collect_list(F.struct("place", "key")))["key"].alias("keys"))
    full = rest.drop("weight").join(lists, "node")
    other = full.select([F.col(c).alias(f"b_{c}") for c in full.columns])
    met = F.exists(F.zip_with("met", "b_met", lambda a, b: (a == b) & (a != 0)), lambda same: same)
    apart = (F.col("node") < F.col("b_node")) & (F.col("label") != F.col("b_label")) & fitting("n", "b_n") & ~met

    def weighed(total: Column, key: Column) -> Column:
        weight = key.bitwiseAND(F.lit(WEIGHTS))
        return total + F.when(weight == WEIGHTS, F.col("n")).otherwise(weight)

    def last_and_enough(both: Column) -> Column:
        """In the last common group, if the weight of all common groups allows a link."""
        enough = possible(F.aggregate(both, F.lit(0).cast("bigint"), weighed), "n", "place", "b_n", "b_place")
        return (F.get(both, F.size(both) - 1) == F.col("key")) & enough

    once = F.exists(F.array(F.array_intersect("keys", "b_keys")), last_and_enough)
    pairs = full.join(other, (F.col("key") == F.col("b_key")) & apart & once)
    return pairs.select(F.col("node").alias("a"), F.col("b_node").alias("b"))


def possible(shared: str | Column, a_n: str, a_place: str, b_n: str, b_place: str) -> Column:
    """Whether sets of these sizes may be similar enough, by the number of signatures they share.

    Beyond the signatures of the larger set, no more can be shared than what it has left, and after the places of the
    last shared ones no more than what follows these in either set.
    """
    left = F.ceil(F.greatest(a_n, b_n) * LEAST / OF) - 1
    after = F.least(left, F.col(a_n) - F.col(a_place) - 1, F.col(b_n) - F.col(b_place) - 1)
    shared = F.col(shared) if isinstance(shared, str) else shared
    return (shared + after) * (OF + LEAST) >= (F.col(a_n) + F.col(b_n)) * LEAST
