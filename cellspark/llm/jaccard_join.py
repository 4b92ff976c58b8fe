"""N-gram Jaccard join: a grouped prefix join over sets of word shingles, down to components of linked documents.

1. Documents become sets of 64-bit shingle hashes. Shingles with the smallest hashes, a share fixed by the similarity,
   are counted exactly over all documents: chunks of documents send their distinct ones by ranges of hashes, and get
   back those that stand in two documents or more, with their frequency. All shingles are then put in one order:
   counted ones from rare to frequent, then the others. The first ``size - ceil(t * size) + 1`` of a set are its prefix.
   A document whose prefix holds nothing but shingles of its own links with nobody and is done: most are.
2. Equal sets are one class. Classes with identical prefix and size form one group.
3. Groups that share a prefix shingle are paired and filtered by size, position and parity maps of 1024 bits: two members
   differ in no fewer bits than the maps of their groups' least members do, less the most in which a member of either
   group differs from its least one. A group is paired with itself where it has several members. In the last round a pair
   is met at a shingle only if none of the few before it in both prefixes is shared too: at the first one it always is.
   Of the two groups of a pair one at least is not of the component that most groups at the shingle are of.
4. Pairs of groups that are left are expanded to their members, which are filtered by the bits in which their own maps
   differ, first from the other group's least one. No filter loses a link. Survivors are verified on the whole sets.
5. Pairs are not enumerated where they cannot matter. The first rounds pair every group with one other at a shingle, then
   with some, and their members with a few members each; what is already connected is not paired again. The last round
   takes all remaining pairs of different components, so the components are those of all links. Its groups are cut by
   component, so that one member that is left apart does not pair its whole group with all groups of the others.

Defined cases: a null or empty text has an empty set, links with nothing and is its own component; fewer words than a
shingle are one shingle; repeated rows and equal texts share a class; a null id is never the least one; an empty table
gives an empty result; texts of any length are used whole; other columns are not read.
"""

from __future__ import annotations

import itertools
import math
import zlib
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cellspark.llm.common import components, slices, stored, sum_over_partitions

MAP_WORDS = 16  # 64-bit words of a parity map
CHUNK = 1 << 20  # counted shingles of the documents of a chunk
RANGE = 1 << 20  # counted shingles, before equal ones are merged, of a range of hashes
ROUNDS = (1, 32, None)  # groups that a group is paired with at a shingle; None: all of them
RAYS = 8  # groups, of those, and members of a group that are gone on with
BEFORE = 16  # shingles of a prefix, before one at which a pair is met, that are looked at for an earlier meeting
NOT_COUNTED = 255  # the level of shingles beyond the counted ones
_FACTOR, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


@dataclass(frozen=True)
class Similarity:
    """Shingles of ``words`` words; a link needs ``den * intersection >= num * union``."""

    words: int = 3
    num: int = 90
    den: int = 100

    def prefix(self, size: int) -> int:
        return size + (-self.num * size) // self.den + 1

    def counted(self) -> int:
        """Shingles with smaller hashes are counted: twice a prefix, so that shingles of one document fill most prefixes."""
        return min((1 << 64) - 1, (2 * (self.den - self.num) << 64) // self.den)


def shingles(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct hashes of the shingles of a text, A-Z lower-cased, cut at ASCII white space."""
    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, tokens), np.uint64, len(tokens))
    size = min(words, len(hashes))
    width = len(hashes) - size + 1
    total = np.full(width, size, np.uint64)
    for place in range(size):
        total = (total ^ (total >> np.uint64(29))) * _FACTOR + hashes[place : place + width]
    total = (total ^ (total >> np.uint64(30))) * _MIX
    return np.unique(total ^ (total >> np.uint64(31)))


def _sampled(docs: DataFrame, similarity: Similarity) -> DataFrame:
    """``chunk``, ``doc_id``, ``n`` (set size), ``digest`` of the set, parity ``map`` and ``tokens``: the counted shingles in
    order, with the next ones where they are fewer than a prefix; written to the shared folder."""
    limit = np.uint64(similarity.counted())

    def rows(batches):
        chunk, load = TaskContext.get().partitionId() << 32, 0
        for batch in slices(batches):
            columns = ([], [], [], [], [])
            for text in batch.column("text").to_pylist():
                found = shingles(text, similarity.words)
                few = int(np.searchsorted(found, limit))
                bits = (np.bincount((found & np.uint64(64 * MAP_WORDS - 1)).astype(np.int64), minlength=64 * MAP_WORDS) & 1).astype(np.uint8)
                keep = max(few, similarity.prefix(len(found))) if len(found) else 0
                values = (chunk, len(found), xxhash.xxh3_128_digest(found.tobytes()), np.packbits(bits).tobytes(), found[:keep].tobytes())
                for column, value in zip(columns, values, strict=True):
                    column.append(value)
                load += few
                if load >= CHUNK:
                    chunk, load = chunk + 1, 0
            kinds = (pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], ["doc_id", "chunk", "n", "digest", "map", "tokens"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return stored(docs.select("doc_id", "text").mapInArrow(rows, f"doc_id {kind}, chunk long, n int, digest binary, map binary, tokens binary"), "shingle-samples")


def _repeated(sampled: DataFrame, similarity: Similarity) -> DataFrame:
    """(``chunk``, ``tokens``, ``levels``): the counted shingles of a chunk that stand in several documents of the table, each
    with the binary logarithm of its number of documents.

    A chunk sends a shingle once, however many of its documents hold it, so frequent shingles are no hot keys.
    """
    limit = similarity.counted()
    total = sampled.agg(F.sum(F.octet_length("tokens") / 8)).first()[0] or 0
    ranges = max(1, math.ceil(total / RANGE))
    width = np.uint64(limit // ranges + 1)

    def send(batches):
        for batch in batches:
            chunks = batch.column("chunk").to_numpy()
            borders = [0, *(np.flatnonzero(np.diff(chunks)) + 1), len(chunks)] if len(chunks) else [0]
            for first, stop in itertools.pairwise(borders):
                rows = batch.column("tokens").slice(first, stop - first)
                tokens, counts = np.unique(np.concatenate([np.frombuffer(t.as_py(), np.uint64) for t in rows]), return_counts=True)
                few = int(np.searchsorted(tokens, np.uint64(limit)))
                tokens, counts = tokens[:few], counts[:few].astype(np.uint32)
                places = (tokens // width).astype(np.int64)
                cuts = np.r_[0, np.flatnonzero(np.diff(places)) + 1, few] if few else np.zeros(1, np.int64)
                pieces = [(int(places[a]), tokens[a:b].tobytes(), zlib.compress(counts[a:b].tobytes(), 1)) for a, b in itertools.pairwise(cuts.tolist())]
                if pieces:
                    place, sent, many = zip(*pieces, strict=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([int(chunks[first])] * len(pieces), pa.int64()), pa.array(place, pa.int64()), pa.array(sent, pa.binary()), pa.array(many, pa.binary())],
                        ["chunk", "place", "tokens", "counts"],
                    )

    def count(table: pa.Table) -> pa.Table:
        parts = [np.frombuffer(t.as_py(), np.uint64) for t in table.column("tokens")]
        counts = np.concatenate([np.frombuffer(zlib.decompress(c.as_py()), np.uint32) for c in table.column("counts")])
        inverse = np.unique(np.concatenate(parts), return_inverse=True)[1]
        level = np.ceil(np.log2(np.bincount(inverse, weights=counts))).astype(np.uint8)[inverse]
        ends = np.cumsum([len(p) for p in parts])
        levels = [level[end - len(p) : end] for p, end in zip(parts, ends, strict=True)]
        return pa.table(
            {
                "chunk": table.column("chunk"),
                "tokens": pa.array([p[one > 0].tobytes() for p, one in zip(parts, levels, strict=True)], pa.binary()),
                "levels": pa.array([one[one > 0].tobytes() for one in levels], pa.binary()),
            }
        )

    sent = sampled.select("chunk", "tokens").mapInArrow(send, "chunk long, place long, tokens binary, counts binary")
    return sent.groupBy("place").applyInArrow(count, "chunk long, tokens binary, levels binary").where(F.octet_length("tokens") > 0)


def describe(docs: DataFrame, similarity: Similarity) -> DataFrame:
    """``doc_id``, ``n`` (set size), and for documents whose prefix holds a shingle that may stand elsewhere too: ``digest``
    of the set, ``prefix``, ``prefix_digest``, ``own`` (how many shingles at its start are of this document only) and parity ``map``; written to the shared folder."""
    sampled = _sampled(docs, similarity)
    limit = np.uint64(similarity.counted())
    kind = docs.schema["doc_id"].dataType.simpleString()

    def order(rows: pa.Table, repeated: pa.Table) -> pa.Table:
        known, first = np.unique(np.concatenate([np.zeros(0, np.uint64), *(np.frombuffer(t.as_py(), np.uint64) for t in repeated.column("tokens"))]), return_index=True)
        known_levels = np.concatenate([np.zeros(0, np.uint8), *(np.frombuffer(v.as_py(), np.uint8) for v in repeated.column("levels"))])[first]
        columns = ([], [], [], [], [])
        for n, digest, bits, tokens in zip(*(rows.column(c) for c in ("n", "digest", "map", "tokens")), strict=True):
            tokens = np.frombuffer(tokens.as_py(), np.uint64)
            levels = np.where(tokens < limit, 0, NOT_COUNTED).astype(np.uint8)
            if len(known):
                at = np.minimum(np.searchsorted(known, tokens), len(known) - 1)
                levels = np.where(known[at] == tokens, known_levels[at], levels)
            length = similarity.prefix(n.as_py()) if n.as_py() else 0
            best = np.lexsort((tokens, levels))[:length]
            own = int(np.searchsorted(levels[best], 1))
            if own == length:
                values = (None,) * 5
            else:
                prefix = tokens[best].view(np.int64)
                values = (digest.as_py(), prefix, xxhash.xxh3_128_digest(prefix.tobytes()), own, np.frombuffer(bits.as_py(), np.int64))
            for column, value in zip(columns, values, strict=True):
                column.append(value)
        kinds = (pa.binary(), pa.list_(pa.int64()), pa.binary(), pa.int32(), pa.list_(pa.int64()))
        return pa.Table.from_arrays(
            [rows.column("doc_id"), rows.column("n"), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))],
            ["doc_id", "n", "digest", "prefix", "prefix_digest", "own", "map"],
        )

    both = sampled.groupBy("chunk").cogroup(_repeated(sampled, similarity).groupBy("chunk"))
    made = both.applyInArrow(order, f"doc_id {kind}, n int, digest binary, prefix array<long>, prefix_digest binary, own int, map array<long>")
    return stored(made, "shingle-sets")


def _classes(described: DataFrame) -> DataFrame:
    """One row per distinct set, with a number of its own, that of its group, the least number with its prefix and size, and
    ``away``, the bits in which its map differs from that of its group's least set."""
    first = [F.first(c).alias(c) for c in ("n", "prefix", "prefix_digest", "own", "map")]
    rows = described.where("digest IS NOT NULL").groupBy("digest").agg(F.min("doc_id").alias("least_doc"), *first)
    rows = stored(rows.withColumn("cid", F.monotonically_increasing_id()), "classes")
    groups = rows.groupBy("prefix_digest", "n").agg(F.min("cid").alias("gid"), F.count("*").alias("members"))
    grouped = stored(rows.join(groups, ["prefix_digest", "n"]).drop("prefix_digest"), "grouped-classes")
    several = grouped.where("members > 1")
    least = several.where("cid = gid").select("gid", F.col("map").alias("least_map"))
    away = several.join(least, "gid").select("cid", _differing("map", "least_map").alias("away"))
    return stored(grouped.join(away, "cid", "left").withColumn("away", F.coalesce("away", F.lit(0))), "placed-classes")


def _parts(classes: DataFrame, labels: DataFrame) -> DataFrame:
    """The classes with groups cut by component: ``gid`` is the least number of a group's members in one component."""
    labelled = _labelled(classes, labels, classes.columns)
    least = labelled.groupBy("gid", "label").agg(F.min(F.struct("cid", "map")).alias("least"))
    parts = labelled.join(least, ["gid", "label"]).withColumn("away", _differing("map", "least.map"))
    return stored(parts.withColumn("gid", F.col("least.cid")).select(*classes.columns), "parted-classes")


def _differing(x: str, y: str) -> Column:
    """Bits in which two parity maps differ."""
    return reduce(Column.__add__, [F.bit_count(F.get(x, F.lit(i)).bitwiseXOR(F.get(y, F.lit(i)))) for i in range(MAP_WORDS)])


def _close(x: str, y: str, differing: Column, similarity: Similarity) -> Column:
    """May sets of the sizes of ``x`` and ``y`` link, if their maps differ in no fewer bits?"""
    total = (F.col(f"{x}.n") + F.col(f"{y}.n")).cast("long")
    return (total - differing) * (similarity.den + similarity.num) >= total * (2 * similarity.num)


def _postings(classes: DataFrame) -> DataFrame:
    """(``token``, ``gid``, ``n``, ``at``): groups at the prefix shingles that they share with another group."""
    tokens = classes.where("cid = gid").select("gid", "n", "own", F.posexplode("prefix").alias("at", "token")).where("at >= own").drop("own")
    shared = tokens.groupBy("token").count().where("count > 1").select("token")
    return stored(tokens.join(shared, "token"), "postings")


def _possible(x: str, y: str, similarity: Similarity) -> Column:
    """Size and position filters for groups ``x`` and ``y`` at one shingle."""
    num, den = similarity.num, similarity.den
    a, b, i, j = F.col(f"{x}.n").cast("long"), F.col(f"{y}.n").cast("long"), F.col(f"{x}.at"), F.col(f"{y}.at")
    sizes = F.least(a, b) * den >= F.greatest(a, b) * num
    most = F.least(i, j) + 1 + F.least(a - i - 1, b - j - 1)
    return sizes & (most * (den + num) >= (a + b) * num)


def _labelled(classes: DataFrame, labels: DataFrame | None, columns: Sequence[str] = ("cid", "gid", "n", "members", "map", "away")) -> DataFrame:
    """Members with ``columns`` and ``label``."""
    members = classes.select(*columns)
    if labels is None:
        return members.withColumn("label", F.col("cid"))
    return members.join(labels, members["cid"] == labels["node"], "left").withColumn("label", F.coalesce("label", "cid")).drop("node")


def _group_pairs(postings: DataFrame, members: DataFrame, stars: int | None, similarity: Similarity) -> DataFrame:
    """Distinct pairs (``x``, ``y``) of groups, or of a group with itself, that pass the filters and are not of one component."""
    spans = members.groupBy("gid").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.max("away").alias("radius"))
    rows = postings.join(spans, "gid")
    held = rows.groupBy("token", "low").agg(F.max("high").alias("high"), F.count("*").alias("many"))
    most = F.max(F.struct("many", (-F.col("low")).alias("low")))["low"]
    live = held.groupBy("token").agg(F.min("low").alias("a"), F.max("high").alias("b"), (-most).alias("main")).where("a <> b").select("token", "main")
    least = members.where("cid = gid").select("gid", "map")
    rows = stored(rows.join(live, "token").join(least, "gid"), "live-postings")
    apart = F.greatest(_differing("x.map", "y.map") - F.col("x.radius") - F.col("y.radius"), F.lit(0))
    unlike = (F.least("x.low", "y.low") < F.greatest("x.high", "y.high")) & _possible("x", "y", similarity) & _close("x", "y", apart, similarity)
    # Two groups of the component that most groups at a shingle are of need not meet there.
    rare = (F.col("low") != F.col("main")) | (F.col("high") != F.col("main"))
    if stars is None:
        # Near copies share most of their prefixes, so their pairs would be made once a shingle.
        before = F.collect_list("token").over(Window.partitionBy("gid").orderBy("at").rowsBetween(-BEFORE, -1))
        rows = rows.withColumn("before", before).withColumn("rare", rare)
        here = (F.col("x.token") == F.col("y.token")) & ((F.col("x.gid") < F.col("y.gid")) | ~F.col("y.rare"))
        met = rows.where("rare").alias("x").join(rows.alias("y"), here & unlike & ~F.arrays_overlap("x.before", "y.before"))
        pairs = met.select(F.least("x.gid", "y.gid").alias("x"), F.greatest("x.gid", "y.gid").alias("y")).distinct()
    else:
        # One centre is the least group; several differ from shingle to shingle, so that a group meets many at its shingles.
        number = F.col("gid") if stars == 1 else F.xxhash64("gid", "token")
        ray = F.pmod(F.xxhash64(number), F.lit(stars)).alias("ray")
        centres = rows.groupBy("token", ray).agg(F.min(F.struct(number.alias("number"), "gid", "n", "at", "low", "high", "radius", "map")).alias("r")).select("token", "ray", "r.*")
        met = rows.where(rare).alias("x").join(centres.alias("y"), (F.col("x.token") == F.col("y.token")) & (F.col("x.gid") != F.col("y.gid")) & unlike)
        # Of the centres that a group meets at its shingles, the nearest ones.
        nearest = F.min(F.struct(_differing("x.map", "y.map").alias("bits"), F.col("y.gid").alias("y")))
        pairs = met.groupBy(F.col("x.gid").alias("x"), F.col("ray") % RAYS).agg(nearest.alias("nearest")).select("x", "nearest.y").distinct()
    return pairs.unionByName(spans.where("low < high").select(F.col("gid").alias("x"), F.col("gid").alias("y")))


def _candidates(postings: DataFrame, classes: DataFrame, labels: DataFrame | None, stars: int | None, similarity: Similarity) -> DataFrame:
    """Distinct pairs (``u`` > ``v``) of classes in different components that pass all filters: pairs of groups, expanded."""
    members = _labelled(classes, labels)
    if labels is not None:
        members = stored(members, "labelled-members")
    pairs = _group_pairs(postings, members, stars, similarity)
    if stars is None:
        others = members
    else:
        ray = F.pmod(F.xxhash64("cid"), F.lit(min(stars, RAYS)))
        others = members.groupBy("gid", ray.alias("ray")).agg(F.min(F.struct("cid", "n", "map", "label")).alias("r")).select("gid", "r.*")
    x, y = members.alias("x"), others.alias("y")
    spans = members.groupBy("gid").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.max("away").alias("radius"))
    least = members.where("cid = gid").select("gid", "n", "map").join(spans, "gid").withColumnRenamed("gid", "y")
    # A member of the one group goes on where one of the other's can be near it and is not connected with it.
    apart = F.greatest(_differing("x.map", "p.map") - F.col("p.radius"), F.lit(0))
    near = ((F.col("p.low") != F.col("x.label")) | (F.col("p.high") != F.col("x.label"))) & _close("x", "p", apart, similarity)
    held = pairs.join(least, "y").alias("p").join(x, (F.col("x.gid") == F.col("p.x")) & near)
    close = _close("x", "y", _differing("x.map", "y.map"), similarity)
    once = (F.col("x.gid") != F.col("y.gid")) | (F.col("x.cid") > F.col("y.cid"))
    met = held.join(y, (F.col("y.gid") == F.col("p.y")) & (F.col("x.label") != F.col("y.label")) & once & close)
    return stored(met.select(F.greatest("x.cid", "y.cid").alias("u"), F.least("x.cid", "y.cid").alias("v")).distinct(), "candidate-pairs")


def _sets(docs: DataFrame, classes: DataFrame, pairs: DataFrame, similarity: Similarity) -> DataFrame:
    """(``cid``, ``hashes``) of all classes in ``pairs``, from one document of each.

    A bit map of the wanted ids, of bounded size, spares the work for most other documents.
    """
    wanted = pairs.select(F.explode(F.array("u", "v")).alias("cid")).distinct().join(classes.select("cid", "digest", "least_doc"), "cid")
    wanted = stored(wanted, "wanted-sets")
    size = 1 << min(27, max(16, (16 * wanted.count()).bit_length()))

    def mark(batches):
        bits = np.zeros(size, np.uint8)
        for batch in slices(batches, 4096):
            bits[batch.column("key").to_numpy().view(np.uint64) % np.uint64(size)] = 1
        return np.packbits(bits).view(np.uint32)

    marks = sum_over_partitions(wanted.select(F.xxhash64("least_doc").alias("key")), mark, np.bitwise_or)
    bits = docs.sparkSession.sparkContext.broadcast(np.zeros(size, np.uint8) if marks is None else np.unpackbits(marks.view(np.uint8)))

    def rows(batches):
        for batch in slices(batches):
            near = bits.value[batch.column("key").to_numpy().view(np.uint64) % np.uint64(size)].astype(bool)
            found = [shingles(t, similarity.words).tobytes() for t in batch.column("text").filter(pa.array(near)).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([xxhash.xxh3_128_digest(f) for f in found], pa.binary()), pa.array(found, pa.binary())], ["digest", "hashes"])

    made = docs.select(F.xxhash64("doc_id").alias("key"), "text").mapInArrow(rows, "digest binary, hashes binary")
    return stored(made.join(wanted.select("cid", "digest"), "digest").select("cid", "hashes").dropDuplicates(["cid"]), "sets")


def _verified(docs: DataFrame, classes: DataFrame, pairs: DataFrame, similarity: Similarity) -> DataFrame:
    """The pairs that are links."""
    num, den = similarity.num, similarity.den
    sets = _sets(docs, classes, pairs, similarity)

    def linked(batches):
        for batch in slices(batches):
            keep = []
            for a, b in zip(batch.column("a"), batch.column("b"), strict=True):
                x, y = np.frombuffer(a.as_py(), np.uint64), np.frombuffer(b.as_py(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(den * both >= num * (len(x) + len(y) - both))
            yield batch.select(["u", "v"]).filter(pa.array(keep, pa.bool_()))

    both = pairs.join(sets.select(F.col("cid").alias("v"), F.col("hashes").alias("b")), "v").join(sets.select(F.col("cid").alias("u"), F.col("hashes").alias("a")), "u")
    return stored(both.select("u", "v", "a", "b").mapInArrow(linked, "u long, v long"), "links")


def near_duplicates(docs: DataFrame, similarity: Similarity = Similarity()) -> DataFrame:
    """Per row ``doc_id``, ``n_shingles`` and ``component_id``, the least ``doc_id`` reachable by links."""
    docs = docs.select("doc_id", "text")
    described = describe(docs, similarity)
    classes = _classes(described)
    postings = _postings(classes)
    labels = None
    for stars in ROUNDS:
        parts = classes if labels is None else _parts(classes, labels)
        pairs = _candidates(postings if labels is None else _postings(parts), parts, labels, stars, similarity)
        if pairs.isEmpty():
            continue
        links = _verified(docs, classes, pairs, similarity)
        known = links if labels is None else links.unionByName(labels.select(F.col("node").alias("u"), F.col("label").alias("v")))
        labels = stored(components(known), "labels")
    numbered = classes.select("cid", "digest", "least_doc")
    if labels is not None:
        numbered = numbered.join(labels, numbered["cid"] == labels["node"], "left").withColumn("label", F.coalesce("label", "cid"))
    else:
        numbered = numbered.withColumn("label", F.col("cid"))
    least = numbered.groupBy("label").agg(F.min("least_doc").alias("component_id"))
    of_class = numbered.join(least, "label").select("digest", "component_id")
    size = F.col("n").cast("long").alias("n_shingles")
    alone = described.where("digest IS NULL").select("doc_id", size, F.col("doc_id").alias("component_id"))
    return alone.unionByName(described.where("digest IS NOT NULL").select("doc_id", "n", "digest").join(of_class, "digest").select("doc_id", size, "component_id"))
