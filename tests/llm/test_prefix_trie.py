"""Radix trees against dictionaries, and the trie of conversations against a plain one."""

import hashlib
import random
import re
import zlib

import pytest

from claimwright.llm import prefix_trie
from claimwright.llm.radix_tree import RadixTree

SCHEMA = "conv_id long, turn long, role string, text string, position int, node string"


def turn_id(role, text):
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()[:32]


def plain_trie(rows, heads=True):
    """Every node from all prefixes of all conversations."""
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            own.setdefault(conv, []).append((turn is not None, turn or 0, turn_id(role, text), role, text))
    own = {c: [t[3:] for t in sorted(ts)] for c, ts in own.items()}
    built = dict(own)
    if heads:
        for c, ts in own.items():
            h = zlib.crc32(str(c).encode()) % 4
            built[c] = own.get(int(c / 20) * 20, [])[:h] + ts[h:]
    members = {}
    for c, ts in built.items():
        for d in range(len(ts) + 1):
            members.setdefault(tuple(ts[:d]), []).append(c)
    children = {}
    for path in members:
        if path:
            children.setdefault(path[:-1], []).append(path)

    def subtree(path):
        todo, saved, leaves = [path], 0, 0
        while todo:
            p = todo.pop()
            words = len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
            saved += (len(members[p]) - 1) * words
            leaves += p not in children
            todo += children.get(p, [])
        return leaves, saved

    found = []
    for path, convs in members.items():
        leaves, saved = subtree(path)
        ends = ",".join(str(c) for c in sorted(convs) if len(built[c]) == len(path))
        parent = min(members[path[:-1]]) if path else None
        found.append((min(convs), len(path), parent, len(convs), len(children.get(path, [])), leaves, saved,
                      hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(found, key=str)


def conversations(seed):
    rng = random.Random(seed)
    rows = []
    for conv in range(-25, 130):
        for turn in range(rng.choice([0, 1, 2, 3, 6])):
            rows.append((conv, turn, rng.choice("us"), rng.choice(["hi", "a b c", "", None, "ü x"])))
    long = [(0, k, "u", f"{k % 3} w") for k in range(150)]
    rows = [r for r in rows if r[0] not in (0, 1, 2, 3)] + long
    rows += [(1, t, r, x) for _, t, r, x in long] + [(2, t, r, x if t < 100 else "other") for _, t, r, x in long[:140]]
    rows += [(3, t, r, x) for _, t, r, x in long[:128]]
    rows += [(7, None, "u", "first"), (7, None, None, None), (None, 0, "u", "lost"), rows[5], rows[5], (9, 2**40, "u", "last")]
    return rows


@pytest.mark.parametrize("heads", [False, True])
def test_trie_matches_plain_version(spark, heads):
    rows = conversations(4)
    frame = spark.createDataFrame([(*r, 5, "x") for r in rows], SCHEMA).repartition(3)
    build = prefix_trie.rebuilt_trie if heads else prefix_trie.conversation_trie
    got = sorted(map(tuple, build(frame).collect()), key=str)
    assert got == plain_trie(rows, heads)


def test_empty_table_and_one_conversation_in_many_trees(spark):
    frame = spark.createDataFrame([], SCHEMA)
    assert prefix_trie.rebuilt_trie(frame).count() == 0
    rows = [(c, t, "u", "same words here" if t < 2 else f"{c % 3}") for c in range(25_000) for t in range(3)]
    got = prefix_trie.conversation_trie(spark.createDataFrame([(*r, 5, "x") for r in rows], SCHEMA)).collect()
    assert sorted(map(tuple, got), key=str) == plain_trie(rows, False)


def test_radix_tree_layouts_paths_and_sums():
    rng = random.Random(2)
    ids = [bytes([i, *rng.randbytes(3)]) for i in range(256)] + [b"\1\2\3" + bytes([i]) for i in range(20)]
    keys = {b"".join(rng.choice(ids) for _ in range(rng.randint(0, 3))) for _ in range(3000)}
    tree = RadixTree(4)

    class Value:
        def __init__(self, n):
            self.sums, self.least = [1, n], n

    for n, key in enumerate(sorted(keys)):
        tree.slot(key).value = Value(n)
    assert tree.root.limit == 256 and all(tree.slot(k).value.least == n for n, k in enumerate(sorted(keys)))
    tree.total(2)
    expected = {}
    for n, key in enumerate(sorted(keys)):
        for d in range(0, len(key) + 4, 4):
            old = expected.get(key[:d], (0, 0, n)) if d <= len(key) else None
            if old:
                expected[key[:d]] = (old[0] + 1, old[1] + n, old[2])
    walk, sent, found, limits = tree.aligned(), None, {}, set()
    while True:
        try:
            node, depth, last, at_end, above = walk.send(sent)
        except StopIteration:
            break
        sent = (above or b"") + last
        assert len(sent) == 4 * depth and (sent in keys) == bool(at_end and node.value)
        found[sent] = (*node.sums, node.least)
        limits.add(node.limit)
    assert found == expected and {4, 256} <= limits


def test_layouts_grow_from_four_to_256():
    tree, limits = RadixTree(1), []
    for edge in range(256):
        tree.slot(bytes([edge ^ 0x55]))
        limits.append(tree.root.limit)
    assert [limits.index(n) for n in (4, 16, 48, 256)] == [0, 4, 16, 48]
    assert [e for e, _ in tree.root.below()] == list(range(256))
