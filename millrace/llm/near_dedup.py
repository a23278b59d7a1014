"""Near-duplicates by MinHash signatures and a multi-index Hamming join.

A document's set is its distinct five-word shingles. ``SYMBOLS`` minima of the
set, ``SYMBOL_BITS`` bits each, are its signature; two sets differ in as many
places as they are dissimilar. The join finds all pairs of signatures that
differ in at most ``MOST_DIFFERENCES`` places: cut into ``CHUNKS`` chunks, some
chunk has at most ``CHUNK_ERRORS`` of them, by pigeonhole, so the two agree on
one of the enumerated choices of the chunk's other places. Each choice is an
index key. Links are confirmed on the full sets.
"""

from __future__ import annotations

import zlib
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from millrace.llm.components import smallest_reachable
from millrace.llm.text import (
    SIMILARITY_PERCENT,
    WORD,
    as_bytes,
    map_batches,
    mixed,
    quoted_col,
    shingle_set,
    whole_row,
)
from millrace.workspace import BROADCAST_BYTES, stage

SYMBOLS = 48
SYMBOL_BITS = 16
CHUNKS = 7
CHUNK_ERRORS = 2
# A pair at the least similarity, 0.75, differs in 12 places on average and in
# more than 20 with a probability of 0.3 %; one at 0.8 with less than 0.01 %.
MOST_DIFFERENCES = CHUNKS * (CHUNK_ERRORS + 1) - 1
# Rows of a bucket that are compared with as many others at a time.
BLOCK_ROWS = 256
# Rows from which on a bucket is compared with its texts, and only links leave it.
LARGE_BUCKET = 16
# Shingles, and rows, of such a bucket that are compared with as many others at a time.
BLOCK_SHINGLES = 1 << 18
LARGE_BLOCK_ROWS = 2048
# Sets that share a shingle up to which their pairs are counted one by one.
FEW_SETS = 16
# Shingles whose sets are multiplied at a time.
PRODUCT_SHINGLES = 4096

# Bits of each symbol that travel with the index rows.
SKETCH_BITS = 2

_U64 = np.uint64
_RANDOM = np.random.default_rng(8)
_FACTORS = _RANDOM.integers(1, 1 << 63, SYMBOLS, dtype=np.uint64) * _U64(2) + _U64(1)
_SHIFTS = _RANDOM.integers(0, 1 << 63, SYMBOLS, dtype=np.uint64)


def chunk_choices() -> list[tuple[int, ...]]:
    """The places of each index key: every chunk without each possible set of errors."""
    return [
        kept
        for chunk in np.array_split(np.arange(SYMBOLS), CHUNKS)
        for kept in combinations(chunk.tolist(), len(chunk) - CHUNK_ERRORS)
    ]


def signatures_of(sets: list[np.ndarray]) -> np.ndarray:
    """One row of symbols per set; no set may be empty."""
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    hashes = np.concatenate(sets)
    out = np.empty((len(sets), SYMBOLS), np.uint16)
    for place in range(SYMBOLS):
        minima = np.minimum.reduceat(hashes * _FACTORS[place] + _SHIFTS[place], starts)
        out[:, place] = (mixed(minima) >> _U64(64 - SYMBOL_BITS)).astype(np.uint16)
    return out


def set_digest(shingles: np.ndarray) -> bytes | None:
    """128 bits that name a set; None for the empty set."""
    return xxhash.xxh3_128_digest(shingles.tobytes()) if len(shingles) else None


def sign(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """id, n_shingles, set_id and signature of every row; the last two NULL without words."""
    rows = docs.select(quoted_col(doc_id).alias("id"), quoted_col(text).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()

    def signed(batch):
        # A few texts at a time, so that very long ones do not add up.
        texts = as_bytes(batch.column(1))
        sets = [shingle_set(t) for t in texts]
        full = [s for s in sets if len(s)]
        packed = iter(signatures_of(full)) if full else iter(())
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array([set_digest(s) for s in sets], pa.binary()),
                pa.array([next(packed).tobytes() if len(s) else None for s in sets], pa.binary()),
            ],
            ["id", "n_shingles", "set_id", "signature"],
        )

    def few(batch):
        for start in range(0, batch.num_rows, 256):
            yield from signed(batch.slice(start, 256))

    return map_batches(
        rows, few, f"id {kind}, n_shingles bigint, set_id binary, signature binary"
    )


def sketched(symbols: np.ndarray) -> list[np.ndarray]:
    """The lowest bits of a signature's symbols, one number for each bit's place."""
    places = _U64(1) << np.arange(SYMBOLS, dtype=np.uint64)
    return [((symbols >> _U64(bit) & _U64(1)) * places).sum(axis=1, dtype=np.uint64) for bit in range(SKETCH_BITS)]


def may_be_near(first: Column, second: Column) -> Column:
    """False only if the sketches show more than ``MOST_DIFFERENCES`` differing symbols."""
    apart = [first[f"bits{n}"].bitwiseXOR(second[f"bits{n}"]) for n in range(SKETCH_BITS)]
    return F.bit_count(reduce(Column.bitwiseOR, apart)) <= MOST_DIFFERENCES


def index_keys(nodes: DataFrame) -> DataFrame:
    """key, node and sketch: each node under all keys of its signature."""
    choices = chunk_choices()
    bits = [f"bits{n}" for n in range(SKETCH_BITS)]

    def keyed(batch):
        symbols = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint16)
        symbols = symbols.reshape(-1, SYMBOLS).astype(np.uint64)
        node = batch.column(0).to_numpy()
        for start in range(0, len(node), 1024):
            part = symbols[start : start + 1024]
            keys = np.empty((len(part), len(choices)), np.uint64)
            for number, places in enumerate(choices):
                key = np.full(len(part), number, np.uint64)
                for place in places:
                    key = mixed(key + _U64(1) + part[:, place])
                keys[:, number] = key
            columns = [node[start : start + 1024], *(b.view(np.int64) for b in sketched(part))]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(keys.ravel().view(np.int64)),
                    *[pa.array(np.repeat(c, len(choices))) for c in columns],
                ],
                ["key", "node", *bits],
            )

    schema = "key bigint, node bigint, " + ", ".join(f"{b} bigint" for b in bits)
    return map_batches(nodes.select("node", "signature"), keyed, schema)


@arrow_udf(T.IntegerType())
def differences(first: pa.Array, second: pa.Array) -> pa.Array:
    """Places in which two signatures differ."""
    x, y = (
        np.frombuffer(b"".join(side.to_pylist()), np.uint16).reshape(-1, SYMBOLS)
        for side in (first, second)
    )
    return pa.array((x != y).sum(axis=1).astype(np.int32))


def within_distance(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs (a, b) whose signatures differ in at most ``MOST_DIFFERENCES`` places."""
    first = nodes.select(F.col("node").alias("a"), F.col("signature").alias("first"))
    second = nodes.select(F.col("node").alias("b"), F.col("signature").alias("second"))
    return (
        pairs.join(first, "a")
        .join(second, "b")
        .where(differences("first", "second") <= MOST_DIFFERENCES)
        .select("a", "b")
    )


def confirmed(pairs: DataFrame, bodies: DataFrame, percent: int = SIMILARITY_PERCENT) -> DataFrame:
    """The pairs whose full shingle sets are as similar as asked.

    ``bodies`` has node and the packed text of one document of the node. The
    second text travels to the first, which is read once for its run of pairs.
    """
    first = bodies.select(F.col("node").alias("a"), F.col("body").alias("first"))
    second = bodies.select(F.col("node").alias("b"), F.col("body").alias("second"))
    joined = pairs.join(second, "b").join(first, "a").select("a", "b", "first", "second")

    def compared(batch):
        links = []
        last, ours = None, None
        for packed, other in zip(*(batch.column(c).to_pylist() for c in (2, 3)), strict=True):
            if packed != last:
                last, ours = packed, shingle_set(zlib.decompress(packed))
            theirs = shingle_set(zlib.decompress(other))
            common = len(np.intersect1d(ours, theirs, assume_unique=True))
            links.append(100 * common >= percent * (len(ours) + len(theirs) - common))
        yield batch.select([0, 1]).filter(pa.array(links, pa.bool_()))

    return map_batches(joined, compared, "a bigint, b bigint")


def _bodies(docs: DataFrame, nodes: DataFrame, pairs: DataFrame, text: str, doc_id: str) -> DataFrame:
    """The packed text of one document of every node in the pairs.

    A node's smallest id finds its text; where no document of it has an id,
    those without one are searched. Copies collapse in the task that reads
    them. If the wanted ids measure small they are broadcast, and other texts
    are neither hashed nor shuffled.
    """
    wanted = stage(
        pairs.select(F.col("a").alias("node"))
        .unionByName(pairs.select(F.col("b").alias("node")))
        .distinct()
        .join(nodes, "node")
        .select("node", "set_id", "least"),
        "wanted",
    )
    fits = wanted.fits(BROADCAST_BYTES)
    chosen = F.broadcast(wanted.df) if fits else wanted.df
    texts = docs.select(quoted_col(doc_id).alias("id"), quoted_col(text).alias("text"))
    known = texts.join(chosen.select(F.col("least").alias("id")), "id", "left_semi")
    unknown = texts.where("id IS NULL")

    def described(batch):
        texts = as_bytes(batch.column(0))
        ids = [set_digest(shingle_set(t)) for t in texts]
        bodies = [None if i is None else zlib.compress(t, 1) for i, t in zip(ids, texts, strict=True)]
        columns = [pa.array(ids, pa.binary()), pa.array(bodies, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, ["set_id", "body"])

    # Hashed behind the join: a condition on a column that is computed row by row
    # would be tested before it, on every text. All documents of a node have one
    # and the same set, so any of them will do.
    found = map_batches(known.unionByName(unknown).select("text"), described, "set_id binary, body binary")
    return (
        found.join(chosen.select("node", "set_id"), "set_id")
        .groupBy("node")
        .agg(F.min("body").alias("body"))
    )


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per input row: id, n_shingles, set_id, node, component_id.

    Documents with equal sets share a ``node``, so copies are one in the join.
    ``component_id`` is the smallest id that links reach, the row's own
    included. Rows without words have no node, no links, and their own id.
    A NULL id never becomes a ``component_id`` unless no row of the component
    has an id. Repeated rows and repeated ids are rows like any other. An
    empty table gives an empty result.

    No bucket is expanded into all pairs at once. A row is compared with the
    central one of its bucket, and links so found join components. In buckets
    that then still hold several, every pair of rows of different components
    is compared: those of large ones in the task that has their texts, which
    only links between components leave, and those of small ones as pairs.
    So two rows with a bucket in common are in one component in the end, or
    were compared.
    """
    signed = stage(sign(docs, text, doc_id), "signatures").df
    nodes = stage(
        signed.where("set_id IS NOT NULL")
        .groupBy("set_id")
        .agg(
            F.min("id").alias("least"),
            F.min("signature").alias("signature"),
            F.max("n_shingles").alias("n_shingles"),
        )
        .withColumn("node", F.monotonically_increasing_id()),
        "nodes",
    ).df
    by_key = Window.partitionBy("key").orderBy("member")
    buckets = stage(
        index_keys(nodes)
        .select("key", F.struct("node", *[f"bits{n}" for n in range(SKETCH_BITS)]).alias("member"))
        .withColumn("before", F.lag("member").over(by_key))
        .withColumn("after", F.lead("member").over(by_key))
        .where("before IS NOT NULL OR after IS NOT NULL")
        .select("key", "member"),
        "buckets",
    ).df
    starred = _stars(buckets)
    pairs = stage(within_distance(starred.distinct(), nodes), "pairs").df
    links = stage(confirmed(pairs, _bodies(docs, nodes, pairs, text, doc_id)), "links").df
    labels = smallest_reachable(links)

    large = stage(_mixed(buckets, labels).where(F.col("size") >= LARGE_BUCKET), "large")
    if large.rows:
        each = large.df.select(F.col("member.node").alias("a")).distinct()
        bodies = _bodies(docs, nodes, each.withColumn("b", F.col("a")), text, doc_id)
        new = stage(_links_in_large(large.df, nodes, bodies), "links")
        if new.rows:
            links = links.unionByName(new.df)
            labels = smallest_reachable(links)

    found = _all_others(_mixed(buckets, labels).where(F.col("size") < LARGE_BUCKET), nodes)
    more = stage(found.join(pairs, ["a", "b"], "left_anti"), "pairs")
    if more.rows:
        new = stage(confirmed(more.df, _bodies(docs, nodes, more.df, text, doc_id)), "links")
        if new.rows:
            labels = smallest_reachable(links.unionByName(new.df))

    placed = (
        nodes.select("set_id", "node", "least")
        .join(labels, "node", "left")
        .withColumn("label", F.coalesce("label", "node"))
    )
    smallest = placed.groupBy("label").agg(F.min("least").alias("smallest"))
    known = placed.join(smallest, "label").select("set_id", F.col("label").alias("node"), "smallest")
    return signed.join(known, "set_id", "left").select(
        "id",
        "n_shingles",
        "set_id",
        "node",
        F.coalesce("smallest", "id").alias("component_id"),
    )


def _stars(buckets: DataFrame) -> DataFrame:
    """Pairs of each bucket's central member with the others.

    The central member is the one that meets most others in all its buckets,
    so of the edited copies of a text it is the text itself, which is more
    similar to each copy than they are to one another.
    """
    node = F.col("member.node")
    size = F.count(F.lit(1)).over(Window.partitionBy("key"))
    met = (
        buckets.select(node.alias("node"), size.alias("size"))
        .groupBy("node")
        .agg(F.sum("size").alias("met"))
    )
    central = Window.partitionBy("key").orderBy(F.desc("met"), "member")
    placed = buckets.withColumn("node", node).join(met, "node")
    starred = placed.select("member", F.first("member").over(central).alias("first"))
    return starred.where(
        (F.col("first.node") != F.col("member.node")) & may_be_near(F.col("first"), F.col("member"))
    ).select(
        F.least("first.node", "member.node").alias("a"),
        F.greatest("first.node", "member.node").alias("b"),
    )


def _mixed(shared: DataFrame, labels: DataFrame) -> DataFrame:
    """key, member, label and the bucket's size, of the rows of buckets that hold several components."""
    whole = Window.partitionBy("key")
    return (
        shared.select("key", "member", F.col("member.node").alias("node"))
        .join(labels, "node", "left")
        .select("key", "member", F.coalesce("label", "node").alias("label"))
        .withColumn("low", F.min("label").over(whole))
        .withColumn("high", F.max("label").over(whole))
        .withColumn("size", F.count(F.lit(1)).over(whole))
        .where("low <> high")
        .select("key", "member", "label", "size")
    )


def common_counts(ours: list[np.ndarray], theirs: list[np.ndarray]) -> np.ndarray:
    """Shingles that each of our sets has in common with each of theirs.

    Shingles of few sets are counted pair by pair; the sets of the others are
    multiplied as rows of zeros and ones.
    """
    n = len(ours)
    sizes = [len(s) for s in (*ours, *theirs)]
    found, shingle = np.unique(np.concatenate([*ours, *theirs]), return_inverse=True)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    is_ours = owner < n
    in_ours = np.bincount(shingle[is_ours], minlength=len(found))
    in_theirs = np.bincount(shingle[~is_ours], minlength=len(found))
    both = (in_ours > 0) & (in_theirs > 0)
    few = both & (in_ours + in_theirs <= FEW_SETS)

    order = np.argsort(shingle, kind="stable")
    order = order[few[shingle[order]]]
    named, holder = shingle[order], owner[order]
    met = []
    for back in range(1, FEW_SETS):
        # Of a shingle's holders ours stand before theirs.
        x, y = holder[:-back], holder[back:]
        pair = (named[:-back] == named[back:]) & (x < n) & (y >= n)
        met.append(x[pair] * len(theirs) + y[pair] - n)
    counts = np.bincount(np.concatenate(met), minlength=n * len(theirs))
    counts = counts.reshape(n, len(theirs)).astype(np.int64)

    many = both & ~few
    column = np.cumsum(many) - 1
    at = many[shingle]
    row, column = owner[at], column[shingle[at]]
    for start in range(0, int(many.sum()), PRODUCT_SHINGLES):
        here = (column >= start) & (column < start + PRODUCT_SHINGLES)
        width = min(PRODUCT_SHINGLES, int(many.sum()) - start)
        has = np.zeros((len(sizes), width), np.float32)
        has[row[here], column[here] - start] = 1
        counts += (has[:n] @ has[n:].T).astype(np.int64)
    return counts


def joining_links(linked: np.ndarray, ours: np.ndarray, theirs: np.ndarray) -> list[tuple[int, int]]:
    """Places of links that join all components, given by label, that any link joins."""
    ours, theirs = ours.copy(), theirs.copy()
    links = []
    for i in np.flatnonzero(linked.any(axis=1)).tolist():
        places = np.flatnonzero(linked[i])
        labels, first = np.unique(theirs[places], return_index=True)
        for label, at in zip(labels.tolist(), places[first].tolist(), strict=True):
            if label != ours[i]:
                links.append((i, at))
                joined = ours[i]
                ours[ours == label] = joined
                theirs[theirs == label] = joined
    return links


def _links_in_large(large: DataFrame, nodes: DataFrame, bodies: DataFrame) -> DataFrame:
    """Links (a, b) that join all components which similar rows of large buckets belong to.

    ``large`` has the rows of ``_mixed``. A bucket is cut into blocks of at most
    ``LARGE_BLOCK_ROWS`` rows and about ``BLOCK_SHINGLES`` shingles, and each
    pair of blocks is compared where both blocks' texts are, on the full sets of
    all rows with a near one. The largest component stands last, and its
    blocks do not meet one another. A pair of blocks yields fewer links than
    it has rows, however many of its rows are similar.
    """
    whole = Window.partitionBy("key")
    place = F.struct("own", "label")
    before = whole.orderBy("own", "label", "node").rowsBetween(Window.unboundedPreceding, -1)
    weight = F.greatest("n_shingles", F.lit(BLOCK_SHINGLES // LARGE_BLOCK_ROWS))
    block = F.floor(F.coalesce(F.sum("weight").over(before), F.lit(0)) / BLOCK_SHINGLES).cast("int")
    placed = (
        large.select("key", "label", F.col("member.node").alias("node"))
        .join(nodes.select("node", weight.alias("weight")), "node")
        .withColumn("own", F.count(F.lit(1)).over(Window.partitionBy("key", "label")))
        .withColumn("block", block)
        .withColumn("largest", place == F.max(place).over(whole))
        .withColumn("alone", F.min("largest").over(Window.partitionBy("key", "block")))
        .withColumn("last", F.max("block").over(whole))
        .withColumn("mixed", F.max(F.when(~F.col("alone"), F.col("block"))).over(whole))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.when(F.col("alone"), F.col("mixed")).otherwise(F.col("last")))))
        .select("key", "node", "label", "block", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"))
    )
    texts = bodies.join(nodes.select("node", "signature"), "node")
    return placed.join(texts, "node").groupBy("key", "x", "y").applyInArrow(_linked_in_blocks, "a bigint, b bigint")


def _linked_in_blocks(rows: pa.Table) -> pa.Table:
    """Links of different components between the rows of two blocks, or of one with itself."""
    x, y = rows["x"][0].as_py(), rows["y"][0].as_py()
    block, node, label = (rows[c].to_numpy() for c in ("block", "node", "label"))
    symbols = np.frombuffer(b"".join(rows["signature"].to_pylist()), np.uint16).reshape(-1, SYMBOLS)
    ours, theirs = np.flatnonzero(block == x), np.flatnonzero(block == y)
    in_ours, in_theirs = np.zeros(len(ours), bool), np.zeros(len(theirs), bool)
    for start in range(0, len(ours), 64):
        here = ours[start : start + 64]
        near = (symbols[here, None] != symbols[theirs][None]).sum(axis=2) <= MOST_DIFFERENCES
        near &= label[here, None] != label[theirs][None]
        in_ours[start : start + 64] = near.any(axis=1)
        in_theirs |= near.any(axis=0)
    ours, theirs = ours[in_ours], theirs[in_theirs]
    links = []
    if len(ours):
        sets = {i: shingle_set(zlib.decompress(rows["body"][i].as_py())) for i in {*ours.tolist(), *theirs.tolist()}}
        first, second = ([sets[i] for i in side.tolist()] for side in (ours, theirs))
        common = common_counts(first, second)
        size, sizes = (np.array([len(s) for s in side]) for side in (first, second))
        linked = 100 * common >= SIMILARITY_PERCENT * (size[:, None] + sizes - common)
        linked &= label[ours][:, None] != label[theirs]
        links = joining_links(linked, label[ours], label[theirs])
    a, b = (np.array([node[side[link[n]]] for link in links], np.int64) for n, side in enumerate((ours, theirs)))
    return pa.table({"a": np.minimum(a, b), "b": np.maximum(a, b)})


def _all_others(mixed_up: DataFrame, nodes: DataFrame) -> DataFrame:
    """Distinct pairs of rows of different components that share a bucket and are near.

    A bucket's components stand one behind another, the largest last, and a
    row meets all rows behind its own component. Buckets are cut into blocks of
    ``BLOCK_ROWS``, and a pair of blocks is one row that holds the signatures of
    both, so a large bucket is no single task's work, and of all pairs only those
    within the distance leave the task that compares them.
    """
    whole = Window.partitionBy("key")
    own = Window.partitionBy("key", "label")
    by_label = whole.orderBy("own", "label")
    placed = (
        mixed_up.withColumn("own", F.count(F.lit(1)).over(own))
        .withColumn("place", F.row_number().over(by_label.orderBy("own", "label", "member")) - 1)
        # The default frame ends with the last row of the same component.
        .withColumn("behind", F.count(F.lit(1)).over(by_label))
        .select("key", "size", "place", "behind", F.col("member.node").alias("node"))
    )
    block = lambda place: F.floor(place / BLOCK_ROWS).cast("int")
    blocks = (
        placed.join(nodes.select("node", "signature"), "node")
        .groupBy("key", block(F.col("place")).alias("block"))
        .agg(
            F.max("size").alias("size"),
            F.min("behind").alias("behind"),
            F.collect_list(F.struct("node", "place", "behind", "signature")).alias("rows"),
        )
    )
    met = F.sequence(block(F.col("behind")), block(F.col("size") - 1))
    first = blocks.where("behind < size").select(
        "key", F.col("rows").alias("ours"), F.explode(met).alias("block")
    )
    second = blocks.select("key", "block", F.col("rows").alias("theirs"))
    pairs = first.join(second, ["key", "block"]).select("ours", "theirs")
    return map_batches(pairs, _near_in_blocks, "a bigint, b bigint").distinct()


def _near_in_blocks(batch: pa.RecordBatch):
    """Pairs of near rows from two blocks, each of a row and one behind its component."""

    def unpacked(column):
        flat = column.flatten()
        numbers = [flat.field(i).to_numpy(zero_copy_only=False) for i in range(3)]
        symbols = np.frombuffer(b"".join(flat.field(3).to_pylist()), np.uint16).reshape(-1, SYMBOLS)
        ends = np.cumsum(column.value_lengths().to_numpy(zero_copy_only=False))
        for start, end in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True):
            yield *[n[start:end] for n in numbers], symbols[start:end]

    for ours, theirs in zip(unpacked(batch.column(0)), unpacked(batch.column(1)), strict=True):
        node, _, behind, symbols = ours
        other, place, _, others = theirs
        for at in range(0, len(node), 64):
            here = slice(at, at + 64)
            apart = (symbols[here, None] != others[None]).sum(axis=2)
            near = (apart <= MOST_DIFFERENCES) & (place[None] >= behind[here, None])
            first, second = np.nonzero(near)
            if len(first):
                x, y = node[here][first], other[second]
                columns = [pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))]
                yield pa.RecordBatch.from_arrays(columns, ["a", "b"])


def keep_one(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The rows that stay, exactly one of each group of near-duplicates, with all columns.

    The row with the smallest id stays. Rows without words are all kept. Rows
    without an id, or with the same smallest id, are told apart by their text.
    """
    marks = near_duplicates(docs, text, doc_id)
    labels = marks.where("node IS NOT NULL").select("set_id", "node").distinct()
    has_words = F.coalesce(quoted_col(text).rlike(WORD), F.lit(False))
    order = F.struct(
        F.col("doc")[doc_id].isNull(), F.col("doc")[doc_id], F.xxhash64(F.col("doc")[text])
    )
    at = docs.columns.index(text)

    def named(batch):
        texts = as_bytes(batch.column(0).field(at))
        ids = [set_digest(shingle_set(t)) for t in texts]
        yield batch.append_column("set_id", pa.array(ids, pa.binary()))

    # Hashed in a step of its own, as in ``_bodies``.
    worded = docs.where(has_words).select(whole_row(docs))
    grouped = (
        map_batches(worded, named, T.StructType([*worded.schema.fields, T.StructField("set_id", T.BinaryType())]))
        .join(labels, "set_id")
        .groupBy("node")
        .agg(F.min_by("doc", order).alias("doc"))
        .select("doc")
    )
    return grouped.unionByName(docs.where(~has_words).select(whole_row(docs))).select("doc.*")
