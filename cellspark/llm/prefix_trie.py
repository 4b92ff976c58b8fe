"""The trie of conversations that share their first turns, summed up in bands of depth.

Every conversation is rebuilt from a number of first turns of a base conversation and its own later turns; each
distinct sequence of first turns is a node. A sequence is known by two sums of digests times powers of a base,
modulo 2**61 - 1: sums over a conversation, so they can be made in pieces, a conversation of any length may lie in
many partitions, and the sums of a rebuilt conversation follow from those of its two sources.

Totals over subtrees need no round per level: a node hands its values to its ancestors inside its own band of
``height`` levels, at most ``height`` of them. The tops of all bands form a trie that is ``height`` times lower and is
summed up in the same way; their totals then go to the band above. Rounds grow with the logarithm of the depth.

Defined cases: rows without a conversation id belong to no conversation; a null role or text is empty; turns that
repeat a number go by the MD5 digest of role and text, repeated rows are turns of their own; a null turn comes first;
texts of any length count whole; an empty table has no node, not even a root; other columns are not read. Sequences
of turns that differ are taken as equal only where both 61-bit sums collide.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellspark.llm.common import stored

# Conversations come in families of five and take up to eight turns of the first of the family.
FAMILY = 5
HEAD_SIZES = 9

PRIME = (1 << 61) - 1
BASES = (0x1F3A9C5D7E2B4861, 0x0B7D1E5F93A6C24D)
# Powers of both bases from -8 to 0, by exponent.
_BACK = {-n: tuple(pow(base, -n, PRIME) for base in BASES) for n in range(HEAD_SIZES)}

KEY = ["depth", "k1", "k2"]
IDS_IN_CHUNK = 4096


def head_size(conv_id: Column) -> Column:
    return (F.crc32(conv_id.cast("string")) % HEAD_SIZES).cast("int")


def base_of(conv_id: Column) -> Column:
    return conv_id - conv_id % FAMILY


def turns(conversations: DataFrame) -> DataFrame:
    """``conv_id``, ``part``, the ``place`` inside the part, ``n_bytes`` and sums up to this turn (``p1``, ``p2``) and before it
    (``q1``, ``q2``); one range of conversation and turn per part, so a long conversation lies in several."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text))
    narrow = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", digest.alias("digest"), F.octet_length(text).cast("long").alias("n_bytes")
    )
    order = ["conv_id", "turn", "digest"]
    ordered = narrow.repartitionByRange(*order).sortWithinPartitions(*order)
    schema = "conv_id long, part int, place long, n_bytes long, p1 long, p2 long, q1 long, q2 long"
    return stored(ordered.mapInArrow(_prefix_sums, schema), "turn-sums")


def _prefix_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, conv, place = TaskContext.get().partitionId(), None, 0
    first, second = BASES
    for batch in batches:
        rows = []
        for own, digest, size in zip(batch.column("conv_id").to_pylist(), batch.column("digest").to_pylist(), batch.column("n_bytes").to_pylist(), strict=True):
            if own != conv:
                conv, place, p1, p2, power1, power2 = own, 0, 0, 0, 1, 1
            place += 1
            power1, power2 = power1 * first % PRIME, power2 * second % PRIME
            q1, q2 = p1, p2
            p1 = (p1 + int(digest[:16], 16) * power1) % PRIME
            p2 = (p2 + int(digest[16:], 16) * power2) % PRIME
            rows.append((own, part, place, size, p1, p2, q1, q2))
        columns = list(zip(*rows, strict=True)) or [[]] * 8
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int32() if i == 1 else pa.int64()) for i, c in enumerate(columns)],
            ["conv_id", "part", "place", "n_bytes", "p1", "p2", "q1", "q2"],
        )


def whole(sums: DataFrame) -> DataFrame:
    """Places and sums over whole conversations. Only the first conversation of a part can have turns in an earlier one, so
    what has to be carried over is at most two rows per part."""
    pieces = sums.groupBy("conv_id", "part").agg(F.max("place").alias("n"), F.max_by("p1", "place").alias("p1"), F.max_by("p2", "place").alias("p2"))
    split = pieces.withColumn("parts", F.count("*").over(Window.partitionBy("conv_id"))).where("parts > 1")
    carried, state = {}, {}
    for row in sorted(split.collect(), key=lambda r: (r["conv_id"], r["part"])):
        n, *before = state.get(row["conv_id"], (0, 0, 0))
        carried[row["conv_id"], row["part"]] = (n, *before)
        after = [(s + p * pow(base, n, PRIME)) % PRIME for s, p, base in zip(before, (row["p1"], row["p2"]), BASES, strict=True)]
        state[row["conv_id"]] = (n + row["n"], *after)

    def shift(batches):
        part = None
        for batch in batches:
            columns = {name: batch.column(name).to_pylist() for name in batch.schema.names}
            for i, conv in enumerate(columns["conv_id"]):
                part = columns["part"][i]
                if (conv, part) in carried:
                    n, *before = carried[conv, part]
                    columns["place"][i] += n
                    for name, s, base in zip(("1", "2"), before, BASES, strict=True):
                        for kind in "pq":
                            columns[kind + name][i] = (s + columns[kind + name][i] * pow(base, n, PRIME)) % PRIME
            yield pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in batch.schema], schema=batch.schema)

    return sums.mapInArrow(shift, sums.schema) if carried else sums


def rebuilt(turn_sums: DataFrame) -> DataFrame:
    """One row per rebuilt conversation and depth, from 0: node key, key of the node above, bytes of the last text, and
    whether the conversation ends here."""
    most = HEAD_SIZES - 1
    head = F.struct("place", "p1", "p2", "n_bytes")
    convs = turn_sums.groupBy("conv_id").agg(F.count("*").alias("n"), F.sort_array(F.collect_list(F.when(F.col("place") <= most, head))).alias("head"))
    convs = stored(convs.select("*", head_size(F.col("conv_id")).alias("h"), base_of(F.col("conv_id")).alias("base")), "conversations")
    bases = convs.select(F.col("conv_id").alias("base"), F.col("head").alias("base_head"))
    plans = convs.join(bases, "base", "left").withColumn("m", F.least("h", F.coalesce(F.size("base_head"), F.lit(0))))
    plans = plans.withColumn("length", F.col("m") + F.greatest(F.lit(0), F.col("n") - F.col("h")))

    zero = F.lit(0).cast("long")
    root = plans.select("conv_id", zero.alias("depth"), zero.alias("k1"), zero.alias("k2"), zero.alias("above1"), zero.alias("above2"), zero.alias("n_bytes"), (F.col("length") == 0).alias("ends"))
    taken = plans.where("m > 0").select("conv_id", "length", "base_head", F.posexplode(F.slice("base_head", F.lit(1), F.col("m"))).alias("i", "t"))
    before = F.when(F.col("i") > 0, F.get("base_head", F.col("i") - 1))
    heads = taken.select(
        "conv_id",
        F.col("t.place").alias("depth"),
        F.col("t.p1").alias("k1"),
        F.col("t.p2").alias("k2"),
        F.coalesce(before["p1"], zero).alias("above1"),
        F.coalesce(before["p2"], zero).alias("above2"),
        F.col("t.n_bytes").alias("n_bytes"),
        (F.col("t.place") == F.col("length")).alias("ends"),
    )
    at_m, at_h = F.get("base_head", F.col("m") - 1), F.get("head", F.col("h") - 1)
    joints = plans.where("n > h").select(
        "conv_id",
        "length",
        "h",
        "m",
        *[F.when(F.col("m") > 0, at_m[f"p{i}"]).otherwise(0).alias(f"b{i}") for i in (1, 2)],
        *[F.when(F.col("h") > 0, at_h[f"p{i}"]).otherwise(0).alias(f"s{i}") for i in (1, 2)],
    )
    own = turn_sums.where(F.col("place") > head_size(F.col("conv_id"))).join(joints, "conv_id")

    def keys(batches):
        for batch in batches:
            rows = []
            columns = [batch.column(n).to_pylist() for n in ("conv_id", "place", "n_bytes", "p1", "p2", "q1", "q2", "length", "h", "m", "b1", "b2", "s1", "s2")]
            for conv, place, size, p1, p2, q1, q2, length, h, m, b1, b2, s1, s2 in zip(*columns, strict=True):
                back1, back2 = _BACK[m - h]
                depth = m + place - h
                key = ((b1 + (p1 - s1) * back1) % PRIME, (b2 + (p2 - s2) * back2) % PRIME)
                above = ((b1 + (q1 - s1) * back1) % PRIME, (b2 + (q2 - s2) * back2) % PRIME)
                rows.append((conv, depth, *key, *above, size, depth == length))
            made = list(zip(*rows, strict=True)) or [[]] * 8
            yield pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in made[:7]], pa.array(made[7], pa.bool_())], names)

    names = ["conv_id", "depth", "k1", "k2", "above1", "above2", "n_bytes", "ends"]
    later = own.mapInArrow(keys, "conv_id long, depth long, k1 long, k2 long, above1 long, above2 long, n_bytes long, ends boolean")
    return stored(root.unionByName(heads).unionByName(later), "rebuilt")


def rollup(nodes: DataFrame, paths: DataFrame, values: list[str], height: int = 16) -> DataFrame:
    """``depth, k1, k2`` and the sums of ``values`` over the subtree of every node.

    ``nodes`` hold a key, ``values`` and ``conv_id``, the smallest conversation through the node; ``paths`` the keys of all
    conversations by depth.
    """
    if height < 2:
        raise ValueError("a band needs two levels at least")
    band = F.floor(F.col("depth") / height)
    ways = paths.select(F.col("conv_id").alias("c"), band.alias("b"), *[F.col(k).alias(f"a_{k}") for k in KEY])
    key = [F.col(f"a_{k}").alias(k) for k in KEY]

    def handed(rows: DataFrame, to: Column) -> DataFrame:
        """The values of ``rows`` at their ancestors, themselves included, in band ``to``."""
        met = rows.withColumn("to", to).join(ways, (F.col("c") == F.col("conv_id")) & (F.col("b") == F.col("to")) & (F.col("a_depth") <= F.col("depth")))
        # The smallest conversation of all nodes below is the one of the node itself.
        return met.groupBy(*key).agg(F.min("conv_id").alias("conv_id"), *[F.sum(v).alias(v) for v in values])

    inside = stored(handed(nodes, band), "band-sums")
    if (inside.agg(F.max("depth")).first()[0] or 0) < height:
        return inside.select(*KEY, *values)

    def lower(rows: DataFrame) -> DataFrame:
        return rows.where(F.col("depth") % height == 0).withColumn("depth", band)

    tops = rollup(lower(inside), lower(paths.select("conv_id", *KEY)), values, height)
    tops = lower(inside).drop(*values).join(tops, KEY).withColumn("depth", F.col("depth") * height)
    above = handed(tops.where("depth > 0"), band - 1)
    both = inside.select(*KEY, *values).unionByName(above.select(*KEY, *values))
    return stored(both.groupBy(*KEY).agg(*[F.sum(v).alias(v) for v in values]), "subtree-sums")


def hashes_of_ids(ends: DataFrame) -> DataFrame:
    """SHA-256 of the ascending, comma-joined ids of every key.

    Ids are put in order by range, so one node's ids may lie in many partitions; they are joined there in chunks, and
    only chunks are brought together, where each is hashed and let go before the next is read.
    """
    order = [*KEY, "conv_id"]

    def chunks(batches):
        open_key, first, ids = None, None, []
        for batch in batches:
            out = []
            for depth, k1, k2, conv in zip(*[batch.column(c).to_pylist() for c in order], strict=True):
                key = (depth, k1, k2)
                if key != open_key or len(ids) == IDS_IN_CHUNK:
                    if ids:
                        out.append((*open_key, first, ",".join(map(str, ids))))
                    open_key, first, ids = key, conv, []
                ids.append(conv)
            yield _table(out, [*KEY, "first", "ids"])
        if ids:
            yield _table([(*open_key, first, ",".join(map(str, ids)))], [*KEY, "first", "ids"])

    def hashed(batches):
        open_key, state = None, None
        for batch in batches:
            out = []
            for depth, k1, k2, ids in zip(*[batch.column(c).to_pylist() for c in (*KEY, "ids")], strict=True):
                key = (depth, k1, k2)
                if key == open_key:
                    state.update(b",")
                else:
                    if open_key is not None:
                        out.append((*open_key, state.hexdigest()))
                    open_key, state = key, hashlib.sha256()
                state.update(ids.encode())
            yield _table(out, [*KEY, "ends_sha256"])
        if open_key is not None:
            yield _table([(*open_key, state.hexdigest())], [*KEY, "ends_sha256"])

    joined = ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
    joined = joined.mapInArrow(chunks, "depth long, k1 long, k2 long, first long, ids string")
    return joined.repartition(*KEY).sortWithinPartitions(*KEY, "first").mapInArrow(hashed, "depth long, k1 long, k2 long, ends_sha256 string")


def _table(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * len(names)
    kinds = [pa.string() if n in ("ids", "ends_sha256") else pa.int64() for n in names]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def trie(conversations: DataFrame, height: int = 16) -> DataFrame:
    """One row per node: ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``,
    ``saved_tokens`` and ``ends_sha256``."""
    members = rebuilt(whole(turns(conversations)))
    nodes = members.groupBy(*KEY).agg(
        F.min("conv_id").alias("conv_id"),
        F.count("*").alias("n_convs"),
        *[F.min(c).alias(c) for c in ("above1", "above2", "n_bytes")],
    )
    nodes = stored(nodes, "nodes")
    children = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("above1").alias("k1"), F.col("above2").alias("k2"))
    nodes = nodes.join(children.agg(F.count("*").alias("n_children")), KEY, "left").fillna(0, ["n_children"])
    valued = nodes.select(*KEY, "conv_id", (F.col("n_children") == 0).cast("long").alias("n_leaves"), ((F.col("n_convs") - 1) * F.col("n_bytes")).alias("saved_tokens"))
    totals = rollup(valued, members.select("conv_id", *KEY), ["n_leaves", "saved_tokens"], height)
    ends = hashes_of_ids(members.where("ends"))

    # The root may have any number of children, but it is one row; other parents are met by key.
    root = nodes.where("depth = 0").select((F.col("depth") + 1).alias("depth"), F.col("conv_id").alias("root"))
    parents = nodes.where("depth > 0").select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("above1"), F.col("k2").alias("above2"), F.col("conv_id").alias("parent"))
    found = nodes.join(totals, KEY).join(ends, KEY, "left")
    found = found.join(F.broadcast(root), "depth", "left").join(parents, ["depth", "above1", "above2"], "left")
    return found.select(
        "conv_id",
        "depth",
        F.coalesce("parent", "root").alias("parent_conv_id"),
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
    )
