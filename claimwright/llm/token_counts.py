"""Token counts that follow edits without encoding whole documents again.

A document's pre-tokens (the pieces that byte-pair encoding never joins) are the leaves of a segment
tree: every node knows the characters and the tokens below it. An edit replaces a range of code points.
Pre-tokens that end two or more characters before the edit cannot change, as a piece depends on at most
two characters behind it. From the first other one on, the text is cut again until a new cut falls on
an old one behind the edit; only these pieces are encoded, their leaves replaced, and the sums on the
way to the root brought up to date.

The vocabulary is a file of byte-pair ranks; its path and the cutting pattern are parameters. The file
is read on the driver and sent to the tasks, so it need not be on every machine; files over
``MOST_VOCABULARY`` bytes are refused.

Defined cases: a null text is empty and has no tokens; an edit is clipped to the text it is applied
to; edits with a null id or of ids without documents change nothing; edits of a document apply in the
order of ``seq``, and those with equal ``seq`` in the order of their other columns; an edit is applied
to every row of its id; a null replacement is empty. Empty tables give empty results. Further columns
are ignored.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimwright.llm.text import slices

MOST_VOCABULARY = 64 << 20
LEAF = 64  # pre-tokens in a leaf block when the tree is built
_KNOWN = 1 << 17  # pieces whose counts a task remembers


@dataclass
class Vocabulary:
    """Byte-pair ranks and the pattern that cuts a text into pre-tokens."""

    ranks: bytes
    pattern: str

    def __post_init__(self):
        self._ready()

    def _ready(self):
        ranks = {
            base64.b64decode(piece): int(rank)
            for piece, rank in (line.split() for line in self.ranks.splitlines() if line)
        }
        self._encoding = tiktoken.Encoding(
            "ranks", pat_str=self.pattern, mergeable_ranks=ranks, special_tokens={}
        )
        self._cut = regex.compile(self.pattern)
        self._counts: dict[str, int] = {}

    def __reduce__(self):
        return Vocabulary, (self.ranks, self.pattern)

    @classmethod
    def read(cls, path: str, pattern: str) -> Vocabulary:
        with open(path, "rb") as file:
            ranks = file.read(MOST_VOCABULARY + 1)
        if len(ranks) > MOST_VOCABULARY:
            raise ValueError(f"{path} has more than {MOST_VOCABULARY} bytes")
        return cls(ranks, pattern)

    def count(self, piece: str) -> int:
        """Tokens of one pre-token."""
        found = self._counts.get(piece)
        if found is None:
            found = len(self._encoding.encode_ordinary(piece))
            if len(self._counts) >= _KNOWN:
                self._counts.clear()
            if len(piece) <= 32:
                self._counts[piece] = found
        return found

    def pieces(self, text: str, start: int = 0) -> Iterator[tuple[int, int]]:
        """Length and tokens of each pre-token from ``start`` on."""
        count, known = self.count, self._counts
        for match in self._cut.finditer(text, start):
            piece = match[0]
            found = known.get(piece)
            yield len(piece), count(piece) if found is None else found

    def whole(self, text: str) -> int:
        return len(self._encoding.encode_ordinary(text))


class CountTree:
    """A segment tree over the pre-tokens of one text.

    Blocks of pre-tokens are the tree's leaves; ``chars`` and ``tokens`` hold the sums of every node,
    the children of node i at 2 i and 2 i + 1. A block that has grown to four times its size makes the
    tree be built anew from the known counts, without encoding.
    """

    def __init__(self, text: str, vocabulary: Vocabulary):
        self.text, self.vocabulary, self.encoded = text, vocabulary, 0
        self._build(list(vocabulary.pieces(text)))

    def _build(self, pieces: list[tuple[int, int]]) -> None:
        blocks = [pieces[i : i + LEAF] for i in range(0, len(pieces), LEAF)] or [[]]
        self.width = 1 << (len(blocks) - 1).bit_length()
        self.blocks = blocks + [[] for _ in range(self.width - len(blocks))]
        self.chars, self.tokens = [0] * 2 * self.width, [0] * 2 * self.width
        for i, block in enumerate(self.blocks):
            self._sum(i, block)
        for node in range(self.width - 1, 0, -1):
            self._join(node)

    def _sum(self, at: int, block: list[tuple[int, int]]) -> None:
        self.chars[self.width + at] = sum(p[0] for p in block)
        self.tokens[self.width + at] = sum(p[1] for p in block)

    def _join(self, node: int) -> None:
        self.chars[node] = self.chars[2 * node] + self.chars[2 * node + 1]
        self.tokens[node] = self.tokens[2 * node] + self.tokens[2 * node + 1]

    @property
    def total(self) -> int:
        return self.tokens[1]

    def _find(self, offset: int) -> tuple[int, int]:
        """The block that holds a character, and where the block begins."""
        node, begin = 1, 0
        while node < self.width:
            node *= 2
            if offset - begin >= self.chars[node] and self.chars[node + 1]:
                begin += self.chars[node]
                node += 1
        return node - self.width, begin

    def tokens_before(self, offset: int) -> int:
        """Tokens of the pre-tokens that end at or before a character, in logarithmic time."""
        node, begin, total = 1, 0, 0
        while node < self.width:
            node *= 2
            if offset - begin >= self.chars[node]:
                begin += self.chars[node]
                total += self.tokens[node]
                node += 1
        for length, count in self.blocks[node - self.width]:
            begin += length
            if begin > offset:
                break
            total += count
        return total

    def replace(self, start: int, end: int, new: str) -> None:
        """Replace code points ``start`` to ``end`` and count again where it matters."""
        start = min(max(start, 0), len(self.text))
        end = min(max(end, start), len(self.text))
        text = self.text[:start] + new + self.text[end:]
        block, begin = self._find(max(start - 2, 0))
        # The first pre-token that ends later than two characters before the edit.
        index, at = 0, begin
        pieces = self.blocks[block]
        while index < len(pieces) and at + pieces[index][0] + 2 <= start:
            at += pieces[index][0]
            index += 1
        first_block, first_index, cut_from = block, index, at
        fresh: list[tuple[int, int]] = []
        moved, position = len(new) - (end - start), cut_from
        for length, count in self._counted(text, cut_from):
            fresh.append((length, count))
            position += length
            # The old cut that lies where this one does, if it is behind the edit.
            while block < self.width and at < position - moved:
                if index < len(self.blocks[block]):
                    at += self.blocks[block][index][0]
                    index += 1
                else:
                    block, index = block + 1, 0
            if at >= end and at == position - moved:
                break
        else:
            block, index = self.width, 0
        self.text = text
        self._splice(first_block, first_index, block, index, fresh)

    def _counted(self, text: str, start: int) -> Iterator[tuple[int, int]]:
        for piece in self.vocabulary.pieces(text, start):
            self.encoded += 1
            yield piece

    def _splice(self, block: int, index: int, last: int, stop: int, fresh: list[tuple[int, int]]) -> None:
        """Replace the pre-tokens from (block, index) to before (last, stop)."""
        touched = range(block, min(last, self.width - 1) + 1)
        if last == block:
            self.blocks[block][index:stop] = fresh
        else:
            self.blocks[block][index:] = fresh
            for middle in range(block + 1, min(last, self.width)):
                self.blocks[middle] = []
            if last < self.width:
                del self.blocks[last][:stop]
        if len(self.blocks[block]) > 4 * LEAF:
            self._build([p for b in self.blocks for p in b])
            return
        nodes = set()
        for at in touched:
            self._sum(at, self.blocks[at])
            nodes.add((self.width + at) // 2)
        while nodes and max(nodes):
            for node in nodes:
                self._join(node)
            nodes = {node // 2 for node in nodes}


def token_counts(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """``doc_id, n_tokens`` of every row."""
    none = F.expr("cast(null as array<struct<seq:bigint,start:bigint,stop:bigint,new:string>>)")
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"), none.alias("edits"))
    return _apply(rows, vocabulary).select("doc_id", "n_tokens")


def edited_counts(docs: DataFrame, edits: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Token counts of every document before and after its edits.

    ``edits``: ``doc_id, seq, start, stop, new``, in code points of the text that the edit finds.
    Returns ``doc_id, n_tokens, n_edits, n_tokens_after, n_encoded`` and, with the last edit done, the
    new ``n_chars``; ``n_encoded`` is the number of pre-tokens that edits made be encoded again.
    """
    edit = F.struct("seq", "start", "stop", F.coalesce("new", F.lit("")).alias("new"))
    lists = edits.filter("doc_id is not null").groupBy("doc_id").agg(F.sort_array(F.collect_list(edit)).alias("edits"))
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return _apply(rows.join(lists, "doc_id", "left"), vocabulary)


def apply_listed(docs: DataFrame, edits: str, vocabulary: Vocabulary) -> DataFrame:
    """As ``edited_counts``, with each row's edits in a column of it: no join, no shuffle."""
    return _apply(
        docs.select("doc_id", F.col("text").cast("string").alias("text"), F.col(edits).alias("edits")),
        vocabulary,
    )


def _apply(rows: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(vocabulary)  # at most MOST_VOCABULARY bytes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            out = []
            for text, edits in zip(part.column("text").to_pylist(), part.column("edits").to_pylist()):
                if edits:
                    tree = CountTree(text or "", shared.value)
                    before = tree.total
                    for e in edits:
                        tree.replace(e["start"] or 0, e["stop"] or 0, e["new"] or "")
                    out.append((before, len(edits), tree.total, tree.encoded, len(tree.text)))
                else:
                    n = sum(count for _, count in shared.value.pieces(text or ""))
                    out.append((n, 0, n, 0, len(text or "")))
            columns = [pa.array(list(c), pa.int64()) for c in zip(*out)] if out else [pa.array([], pa.int64())] * 5
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), *columns],
                ["doc_id", "n_tokens", "n_edits", "n_tokens_after", "n_encoded", "n_chars"],
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        run,
        f"doc_id {kind}, n_tokens long, n_edits long, n_tokens_after long, n_encoded long, n_chars long",
    )
