"""Operator 13 against tries spelled out in plain Python."""

import hashlib
import random
import zlib

import pytest

from lakeconform.llm import prefix_trie

KIND = "conv_id bigint, turn bigint, role string, text string"


def brute(rows):
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            digest = hashlib.md5(f"{len(role or '')}:{role or ''}{text or ''}".encode()).digest()
            own.setdefault(conv, []).append(((turn is not None, turn or 0), digest, (role or "", text or "")))
    turns = {c: [t[2] for t in sorted(v)] for c, v in own.items()}
    rebuilt = {}
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 6
        rebuilt[c] = turns.get(c - c % 100, [])[:h] + turns[c][h:]
    nodes = {}
    for c, seq in rebuilt.items():
        for d in range(len(seq) + 1):
            nodes.setdefault(tuple(seq[:d]), []).append(c)

    def below(node):
        return [n for n in nodes if n[: len(node)] == node]

    found = []
    for node, members in nodes.items():
        tree = below(node)
        ends = sorted(c for c in members if len(rebuilt[c]) == len(node))
        found.append(
            (
                min(members),
                len(node),
                min(nodes[node[:-1]]) if node else None,
                len(members),
                sum(len(n) == len(node) + 1 for n in tree),
                sum(not any(len(m) == len(n) + 1 and m[: len(n)] == n for m in tree) for n in tree),
                sum((len(nodes[n]) - 1) * len(n[-1][1]) for n in tree if n),
                hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
            )
        )
    return sorted(found, key=repr)


def found(spark, rows, kind=KIND):
    return sorted(map(tuple, prefix_trie.prefix_trie(spark.createDataFrame(rows, kind)).collect()), key=repr)


def conversations(seed, n, hot=0.3):
    """Random short turns over few words, so that prefixes are shared; a share are exact copies."""
    draw = random.Random(seed)
    rows = []
    for c in draw.sample(range(1, 1200), n) + [0, 100, 300]:
        copy = draw.random() < hot
        for turn in range(4 if copy else draw.randint(1, 9)):
            rows.append((c, turn, "user" if turn % 2 else "bot", "same" if copy else draw.choice(["", "é", "yes", "no"])))
    return rows


@pytest.mark.parametrize("seed", range(2))
def test_against_plain_python(spark, seed):
    rows = conversations(seed, 150)
    assert found(spark, rows) == brute(rows)


def test_several_rounds_and_frequent_copies(spark, monkeypatch):
    """With few chains to a last block the chains are sorted and peeled again."""
    monkeypatch.setattr(prefix_trie, "LAST_ROWS", 4)
    spark.conf.set("spark.sql.shuffle.partitions", "12")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = conversations(7, 200, hot=0.6)
        assert found(spark, rows) == brute(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_odd_rows(spark):
    rows = [
        (None, 1, "user", "left out"),
        (7, None, None, None),
        (7, 2, "user", "x" * 50_000),
        (7, 2, "user", "x" * 50_000),  # a repeated row is a repeated turn
        (7, 2, None, "tie"),
        (5, 0, "user", "a"),  # fewer turns than are replaced, and no base
        (205, 0, "", ""),
        (200, 1, "user", "b"),
        (200, 0, "user", "a"),
    ]
    got = found(spark, [(*r, "c", 1) for r in rows], KIND + ", path string, n_convs int")
    assert got == brute(rows)
    assert found(spark, []) == []
