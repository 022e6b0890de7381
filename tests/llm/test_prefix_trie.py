"""The prefix trie against plain dictionaries of prefixes."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from wordlake.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, depth string, n_convs int"


def plain(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append(((turn is not None, turn or 0), role or "", text or ""))
    own = {c: [t[1:] for t in sorted(turns)] for c, turns in own.items()}
    made = {}
    for c, turns in own.items():
        h, base = zlib.crc32(str(c).encode()) % 4, int(c / 20) * 20
        made[c] = tuple(own.get(base, [])[:h] + turns[h:])
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in made.items():
        ends[turns].append(c)
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for p in members:
        if p:
            children[p[:-1]] += 1
    for p, m in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        for d in range(len(p) + 1):
            saved[p[:d]] += (len(m) - 1) * words
            leaves[p[:d]] += not children[p]
    sha = lambda p: hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest()
    return sorted(((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p], sha(p)) for p, m in members.items()), key=repr)


def held(spark, rows, parts=3):
    table = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(parts)
    nodes, dictionary = prefix_trie.prefix_trie(table)
    got = sorted((tuple(r) for r in nodes.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256").collect()), key=repr)
    assert got == plain(rows)
    return nodes, dictionary


def chats(seed, n, words=3, turns=6):
    r = random.Random(seed)
    ids = r.sample(range(-30, 3 * n), n)
    return [(c, t, r.choice(["user", "assistant"]), " ".join(r.choice("ab") for _ in range(r.randint(0, words)))) for c in ids for t in range(r.randint(1, turns))]


@pytest.mark.parametrize("limit", [30, 500_000])
def test_shards_of_any_size(spark, monkeypatch, limit):
    monkeypatch.setattr(prefix_trie, "FAN_IN", 2)
    monkeypatch.setattr(prefix_trie, "CHUNK", 3)
    made = prefix_trie.sequences(prefix_trie.rebuilt(_convs(spark, chats(limit, 300))))
    got = sorted((tuple(r)[1:] for r in prefix_trie.prefix_nodes(made, limit).collect()), key=repr)
    assert got == plain(chats(limit, 300))


def _convs(spark, rows):
    turns = prefix_trie.turn_rows(spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA))
    return prefix_trie.encoded(turns, prefix_trie.turn_dictionary(turns))


def test_repeats_nulls_ties_and_hot_conversation(spark):
    rows = [(None, 0, "user", "lost"), (1, None, "user", "first"), (1, 2, None, None), (1, 2, "", ""), (1, 2, "", "a b"), (1, 2, "", "a b"), (1, 1, "bot", "é中  x y\x0bz"), (2, 0, "user", "word " * 50_000), (40, 0, "user", "")]
    rows += [(c, t, "user", f"turn {t}") for c in range(100, 400) for t in range(4)]
    rows += [(c, 0, "ab", "c") for c in range(1000, 1010)] + [(c, 0, "a", "bc") for c in range(1010, 1030)]
    nodes, dictionary = held(spark, rows)
    joined = nodes.join(dictionary, "turn_id")
    assert joined.where("depth = 1 and text like 'turn 0%'").count() == 1 and nodes.where("turn_id is null").count() == 1


def test_turnless_long_and_hot_turn(spark, monkeypatch):
    monkeypatch.setattr("wordlake.llm.common.HOT", 5)
    turnless = [c for c in range(200) if c % 20 and zlib.crc32(str(c).encode()) % 4 > 1][:5]
    held(spark, [(c, 0, "user", "gone") for c in turnless])
    held(spark, [(7, t, "user", str(t % 3)) for t in range(1500)] + [(8, t, "user", str(t % 3)) for t in range(1200)] + [(9, 0, "user", "0")])


def test_empty_table_and_tree_order(spark):
    assert prefix_trie.prefix_trie(spark.createDataFrame([], SCHEMA))[0].count() == 0
    rows = [([i], [1], 1, i, "") for i in range(1023)]
    tree = prefix_trie.Shard.of(rows)

    def height(at):
        return 0 if at < 0 else 1 + max(height(tree.less[at]), height(tree.more[at]))

    assert height(tree.down[0]) == 10
