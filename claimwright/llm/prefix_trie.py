"""The trie of conversation prefixes, built from adaptive radix trees.

A turn becomes a 16-byte big-endian id, a hash of its role and text, and a conversation the string of
its ids. Each task takes a sorted range of these strings and enters them into an adaptive radix tree:
nodes of 4, 16, 48 or 256 children and compressed paths. Only depths at whole ids are nodes of the
trie. A tree's nodes, with the sums over their members, are partial: a node that several trees hold is
the sum of its parts, so a first turn that a third of all conversations share is cut into many trees.
Conversations of more than ``LAYER`` turns are cut into layers; a layer's key begins at a hash of all
turns before it, so keys are short however long a conversation is.

Sums over subtrees need no walk over the trie. The members of a node's child are members of the node,
so the nodes of which a conversation is the smallest member, those it owns, are the lower end of its
path. A subtree's sum is that of what its members own, less what the node's owner owns above it: one
more run through the trees, with these sums as weights.

Defined cases: turns are ordered by number, null first, equal numbers by the id; a null role or text is
empty. Turns without a conversation belong to none and are left out. Repeated rows are turns of their
own. A conversation without turns is a member of the root only. An empty table gives an empty result.
Further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimwright.llm.numbering import numbered, prefix_sums
from claimwright.llm.radix_tree import RadixTree
from claimwright.llm.text import slices, small_batches
from claimwright.session import settle

WIDTH = 16  # bytes of an id
LAYER = 64  # turns of a key
# Bytes of keys and rows that one radix tree takes.
TREE_BYTES, TREE_ROWS = 1 << 20, 10_000
WORDS = r"[^\x20\x09-\x0D]+"

_PARTS = "node binary, parent binary, depth long, words long, conv_id long, sums array<long>, first_end long, ends string"


def turns(conversations: DataFrame) -> DataFrame:
    """``conv_id, position, id, words`` of every turn; the id is in hex."""
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    framed = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    rows = conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        F.substring(F.sha2(framed, 256), 1, 2 * WIDTH).alias("id"),
        F.regexp_count(text, F.lit(WORDS)).cast("long").alias("words"),
        F.monotonically_increasing_id().alias("_row"),
    )
    order = [F.col("turn").asc_nulls_first(), F.col("id").asc(), F.col("_row").asc()]
    placed = numbered(settle(rows, "turns"), ["conv_id"], order, "position")
    return placed.select("conv_id", "position", "id", "words")


def rebuilt(own: DataFrame, every: int = 20, heads: int = 4) -> tuple[DataFrame, DataFrame]:
    """Conversations that share heads: ``(turns, conversations)``.

    Conversation c begins with the first h turns of conversation c - c % ``every``, h being the CRC-32
    of c in decimal modulo ``heads``, and goes on with its own turns after its first h. The remainder of a
    negative c is negative, as in SQL.
    """
    first = [
        F.max(F.when(F.col("position") == i, F.struct("id", "words"))).alias(f"_t{i}") for i in range(heads - 1)
    ]
    convs = settle(own.groupBy("conv_id").agg(F.count(F.lit(1)).alias("_own"), *first), "conversations")
    h = (F.crc32(F.col("conv_id").cast("string")) % heads).cast("int")
    bases = convs.select(
        F.col("conv_id").alias("_base"), F.col("_own").alias("_has"), F.array(*[f"_t{i}" for i in range(heads - 1)]).alias("_head")
    )
    based = (
        convs.select("conv_id", "_own", h.alias("_h"), (F.col("conv_id") - F.col("conv_id") % every).alias("_base"))
        .join(bases, "_base", "left")
        .withColumn("_taken", F.least("_h", F.coalesce("_has", F.lit(0))).cast("int"))
        .withColumn("turns", F.greatest(F.col("_own") - F.col("_h"), F.lit(0)) + F.col("_taken"))
    )
    based = settle(based, "rebuilt")
    shared = based.select("conv_id", F.posexplode(F.slice("_head", F.lit(1), F.col("_taken"))).alias("position", "_turn")).select(
        "conv_id", F.col("position").cast("long").alias("position"), "_turn.id", "_turn.words"
    )
    rest = (
        own.join(based.select("conv_id", "_h", "_taken"), "conv_id")
        .filter("position >= _h")
        .select("conv_id", (F.col("position") - F.col("_h") + F.col("_taken")).alias("position"), "id", "words")
    )
    return shared.unionByName(rest), based.select("conv_id", "turns")


def _start(layer: Column, one: Column, two: Column) -> Column:
    """The key of all turns before a layer."""
    told = F.concat_ws(":", layer.cast("string"), one.cast("string"), two.cast("string"))
    return F.unhex(F.substring(F.sha2(told, 256), 1, 2 * WIDTH))


def segments(own: DataFrame, convs: DataFrame) -> DataFrame:
    """A row per conversation and layer: ``start``, the string of ``ids``, their ``words``, the ``next`` start."""
    listed = own.withColumn("layer", F.expr(f"position div {LAYER}")).groupBy("conv_id", "layer").agg(
        F.sort_array(F.collect_list(F.struct("position", "id", "words"))).alias("_turns")  # at most LAYER
    )
    rows = settle(
        convs.join(listed, "conv_id", "left").select(
            "conv_id",
            "turns",
            F.coalesce("layer", F.lit(0)).alias("layer"),
            F.unhex(F.coalesce(F.array_join("_turns.id", ""), F.lit(""))).alias("ids"),
            F.coalesce("_turns.words", F.array().cast("array<long>")).alias("words"),
        ),
        "segments",
    )
    own_sums = [F.xxhash64(F.lit(i), "layer", "ids").cast("decimal(38,0)").alias(f"_s{i}") for i in (1, 2)]
    rows = rows.select("*", *own_sums)
    most = rows.agg(F.max("layer")).collect()[0][0] or 0
    if most:
        long = rows.filter(F.col("turns") > LAYER)
        before = prefix_sums(long, "conv_id", "layer", ["_s1", "_s2"], most).withColumnsRenamed({"_s1": "_b1", "_s2": "_b2"})
        rows = rows.join(before, ["conv_id", "layer"], "left")
    else:
        rows = rows.withColumns({"_b1": F.lit(None), "_b2": F.lit(None)})
    one, two = (F.coalesce(F.col(f"_b{i}").cast("decimal(38,0)"), F.lit(0).cast("decimal(38,0)")) for i in (1, 2))
    full = F.length("ids") == LAYER * WIDTH
    later = _start(F.col("layer") + 1, (one + F.col("_s1")).cast("decimal(38,0)"), (two + F.col("_s2")).cast("decimal(38,0)"))
    return settle(
        rows.select(
            "conv_id",
            "layer",
            F.when(F.col("layer") > 0, _start(F.col("layer"), one, two)).alias("start"),
            F.when(full, later).alias("next"),
            "ids",
            "words",
            (F.col("turns") <= (F.col("layer") + 1) * LAYER).alias("last"),
        ),
        "keys",
    )


class _Value:
    """What is known of the conversations whose key is the same."""

    __slots__ = ("sums", "least", "next", "ends")

    def __init__(self, least: int, following: bytes | None, weights: int):
        self.sums, self.least, self.next, self.ends = [0] * weights, least, following, []


def _digest(*parts: bytes) -> bytes:
    return hashlib.blake2b(b"".join(parts), digest_size=WIDTH).digest()


def _parts(batch: pa.RecordBatch) -> Iterator[tuple]:
    """The trie nodes of one sorted slice of segments."""
    trees: dict[tuple[int, bytes | None], RadixTree] = {}
    words_of: dict[bytes, int] = {}
    columns = [batch.column(n).to_pylist() for n in ("conv_id", "layer", "start", "next", "ids", "words", "last", "weights")]
    count = len(columns[-1][0])
    for conv, layer, start, following, ids, words, last, weights in zip(*columns):
        for k, n in enumerate(words):
            words_of[ids[k * WIDTH : (k + 1) * WIDTH]] = n
        tree = trees.setdefault((layer, start), RadixTree(WIDTH))
        node = tree.slot(ids)
        if node.value is None:
            node.value = _Value(conv, following, count)
        value = node.value
        value.least = min(value.least, conv)
        for i, w in enumerate(weights):
            value.sums[i] += w
        if last:
            value.ends.append(conv)
    for (layer, start), tree in trees.items():
        tree.total(count)
        walk, sent = tree.aligned(), None
        while True:
            try:
                node, ids, last_id, at_end, above = walk.send(sent)
            except StopIteration:
                break
            value = node.value if at_end else None
            if ids == 0:
                sent = _digest(b"layer", start) if layer else _digest(b"root")
            else:
                sent = _digest(b"layer", value.next) if ids == LAYER else _digest(above, last_id)
            if ids or not layer:  # a later layer's root is a node of the layer before
                ends = sorted(value.ends) if value else []
                yield (
                    sent, above, layer * LAYER + ids, words_of.get(last_id, 0), node.least, node.sums,
                    ends[0] if ends else None, ",".join(map(str, ends)) if ends else None,
                )


def _trees(keys: DataFrame) -> DataFrame:
    """Partial nodes of radix trees over sorted ranges of ``keys``, each with sums of ``weights``."""
    head = F.substring("ids", 1, 4 * WIDTH)  # the bounds of ranges are on the driver, so they are short
    ranged = keys.repartitionByRange("layer", "start", head, "conv_id").sortWithinPartitions(
        "layer", "start", "ids", "conv_id"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [("node", pa.binary()), ("parent", pa.binary()), ("depth", pa.int64()), ("words", pa.int64()),
             ("conv_id", pa.int64()), ("sums", pa.list_(pa.int64())), ("first_end", pa.int64()), ("ends", pa.string())]
        )
        for part in slices(batches, "ids", TREE_BYTES, TREE_ROWS):
            rows = list(_parts(part))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, type=f.type) for c, f in zip(zip(*rows), schema)], schema=schema
            )

    with small_batches(keys.sparkSession):
        return settle(ranged.mapInArrow(run, _PARTS), "parts")


def _sums(parts: DataFrame, names: Sequence[str]) -> list[Column]:
    return [F.sum(F.col("sums")[i]).alias(n) for i, n in enumerate(names)]


def _end_hashes(parts: DataFrame) -> DataFrame:
    """``node, ends_sha256`` of the nodes at which conversations end.

    A node's ids are hashed as a stream of sorted pieces; none holds more than one tree's rows.
    """
    pieces = parts.filter("ends is not null").select("node", "first_end", "ends")
    sorted_pieces = pieces.repartition("node").sortWithinPartitions("node", "first_end")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, state = None, None

        def made(nodes, hashes):
            return pa.RecordBatch.from_arrays([pa.array(nodes, pa.binary()), pa.array(hashes, pa.string())], ["node", "ends_sha256"])

        for batch in batches:
            nodes, hashes = [], []
            for node, ends in zip(batch.column("node").to_pylist(), batch.column("ends").to_pylist()):
                if node == at:
                    state.update(b",")
                else:
                    if state is not None:
                        nodes.append(at)
                        hashes.append(state.hexdigest())
                    at, state = node, hashlib.sha256()
                state.update(ends.encode())
            yield made(nodes, hashes)
        if state is not None:
            yield made([at], [state.hexdigest()])

    return sorted_pieces.mapInArrow(run, "node binary, ends_sha256 string")


def trie(own: DataFrame, convs: DataFrame) -> DataFrame:
    """One row per distinct prefix of the conversations.

    ``own`` has ``conv_id, position, id, words`` with gapless positions, ``convs`` every ``conv_id`` and
    its number of ``turns``. See ``conversation_trie`` for the columns.
    """
    keys = segments(own, convs)
    parts = _trees(keys.withColumn("weights", F.array(F.lit(1).cast("long"))))
    nodes = settle(
        parts.groupBy("node").agg(
            F.max("parent").alias("parent"),
            F.max("depth").alias("depth"),
            F.max("words").alias("words"),
            F.min("conv_id").alias("conv_id"),
            *_sums(parts, ["n_convs"]),
        ),
        "nodes",
    )
    children = nodes.filter("parent is not null").groupBy(F.col("parent").alias("node")).agg(
        F.count(F.lit(1)).alias("n_children")
    )
    nodes = settle(
        nodes.join(children, "node", "left").withColumns(
            {
                "n_children": F.coalesce("n_children", F.lit(0).cast("long")),
                "saved": (F.col("n_convs") - 1) * F.col("words"),
            }
        ),
        "nodes",
    )
    # What each conversation owns: a chain of nodes, the last of which may be a leaf.
    owned = nodes.groupBy("conv_id").agg(
        F.sum("saved").alias("_saved"), F.count_if(F.col("n_children") == 0).alias("_leaves")
    )
    none = F.lit(0).cast("long")
    weights = F.array(F.coalesce("_saved", none), F.coalesce("_leaves", none))
    again = _trees(keys.join(owned, "conv_id", "left").withColumn("weights", weights).drop("_saved", "_leaves"))
    below = again.groupBy("node").agg(*_sums(again, ["_below", "n_leaves"]))
    most = nodes.agg(F.max("depth")).collect()[0][0] or 0
    above = prefix_sums(nodes.select("conv_id", "depth", F.col("saved").alias("_above")), "conv_id", "depth", ["_above"], most)
    parents = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    empty = hashlib.sha256(b"").hexdigest()
    return (
        nodes.join(parents, "parent", "left")
        .join(below, "node")
        .join(above, ["conv_id", "depth"])
        .join(_end_hashes(parts), "node", "left")
        .select(
            "conv_id",
            "depth",
            "parent_conv_id",
            "n_convs",
            "n_children",
            "n_leaves",
            (F.col("_below") - F.col("_above")).alias("saved_tokens"),
            F.coalesce("ends_sha256", F.lit(empty)).alias("ends_sha256"),
        )
    )


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The trie of the conversations as they are.

    A node is named by its smallest member ``conv_id`` and its ``depth``; ``parent_conv_id`` is null for
    the root. ``n_convs`` members, ``n_children``, ``n_leaves`` and ``saved_tokens`` of its subtree (words
    that need not be read again when a prefix is computed once), and the SHA-256 of the conversations
    that end at it.
    """
    own = settle(turns(conversations), "positions")
    convs = own.groupBy("conv_id").agg(F.count(F.lit(1)).alias("turns"))
    return trie(own, convs)


def rebuilt_trie(conversations: DataFrame, every: int = 20, heads: int = 4) -> DataFrame:
    """The trie of the conversations with shared heads, see ``rebuilt``."""
    own, convs = rebuilt(settle(turns(conversations), "positions"), every, heads)
    return trie(own, convs)
