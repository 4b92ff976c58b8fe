import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from cellspark.llm import prefix_trie

SCHEMA = "conv_id long, turn int, role string, text string, depth string, k1 string, n_convs string"


def digest(role, text):
    return hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()


def brute(rows):
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            convs[conv].append(((turn is not None, turn or 0, digest(role, text)), role, text))
    own = {c: [(r, t) for _, r, t in sorted(ts)] for c, ts in convs.items()}
    members = defaultdict(list)
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        built = own.get(c - c % 5, [])[:h] + ts[h:]
        for d in range(len(built) + 1):
            members[tuple(built[:d])].append((c, d == len(built)))
    children = defaultdict(int)
    for key in members:
        if key:
            children[key[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for key, convs in members.items():
        for d in range(len(key) + 1):
            leaves[key[:d]] += not children[key]
            saved[key[:d]] += (len(convs) - 1) * (len(key[-1][1].encode()) if key else 0)
    result = []
    for key, convs in members.items():
        ids = ",".join(str(c) for c, ends in sorted(convs) if ends)
        parent = min(c for c, _ in members[key[:-1]]) if key else None
        result.append((min(convs)[0], len(key), parent, len(convs), children[key], leaves[key], saved[key], hashlib.sha256(ids.encode()).hexdigest()))
    return sorted(result, key=lambda r: r[:2])


def found(spark, rows, height=16):
    table = spark.createDataFrame([(*row, "clash", "clash", "clash") for row in rows], SCHEMA)
    return sorted((tuple(r) for r in prefix_trie.trie(table, height).collect()), key=lambda r: r[:2])


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    texts = ["hello", "ünïcode ß", "", None, "long " * 20000, "fine"]
    made = []
    for conv in rng.sample(range(200), 90):
        for turn in range(rng.choice([0, 1, 2, 5, 9, 14])):
            made.append((conv, turn, rng.choice(["user", "assistant", None]), rng.choice(texts[:4] if turn < 3 else texts)))
    # One conversation holds a third of all rows; copies of one; ties, null turns, repeated rows, a null id.
    made += [(77, turn, "user", f"turn {turn % 40}") for turn in range(300)]
    made += [(conv, turn, "user", "the same") for conv in range(1000, 1060) for turn in range(11)]
    made += [(300, None, "user", "first"), (300, 1, "user", "a"), (300, 1, "user", "b"), (300, 1, "user", "b"), (None, 0, "user", "nobody")]
    return made


@pytest.mark.parametrize("height", [2, 3, 16])
def test_trie_equals_brute_force(shipped, rows, height):
    assert found(shipped, rows, height) == brute(rows)


def test_a_conversation_over_many_parts(shipped, rows):
    shipped.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    shipped.conf.set("spark.sql.shuffle.partitions", "23")
    try:
        sums = prefix_trie.turns(shipped.createDataFrame([(*row, "x", "x", "x") for row in rows], SCHEMA))
        assert sums.where("conv_id = 77").select("part").distinct().count() > 2
        places = [r["place"] for r in prefix_trie.whole(sums).where("conv_id = 77").orderBy("place").collect()]
        assert places == list(range(1, len(places) + 1))
        assert found(shipped, rows, 4) == brute(rows)
    finally:
        shipped.conf.set("spark.sql.shuffle.partitions", "4")
        shipped.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_many_ids_at_one_node(shipped, monkeypatch):
    monkeypatch.setattr(prefix_trie, "IDS_IN_CHUNK", 7)
    ends = shipped.range(0, 3000, 1, 5).select(F.lit(1).cast("long").alias("depth"), F.lit(2).cast("long").alias("k1"), (F.col("id") % 3).alias("k2"), F.col("id").alias("conv_id"))
    got = {r["k2"]: r["ends_sha256"] for r in prefix_trie.hashes_of_ids(ends).collect()}
    assert got == {k: hashlib.sha256(",".join(map(str, range(k, 3000, 3))).encode()).hexdigest() for k in range(3)}


def test_no_conversations(shipped):
    assert found(shipped, []) == []
    with pytest.raises(ValueError):
        found(shipped, [(1, 0, "user", "x")], height=1)
