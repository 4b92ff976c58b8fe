"""Pairs of groups are filtered by their parity maps, less how far their members are from the least one."""

from cellspark.llm import jaccard_join as module


def test_groups_that_differ_in_too_many_bits_are_not_paired(spark):
    same, other = [0] * module.MAP_WORDS, [-1] * module.MAP_WORDS
    rows = [(1, 1, same, 0), (2, 2, same, 0), (3, 3, other, 0), (4, 4, other, 0), (5, 4, same, 1024)]
    kind = "cid long, gid long, n int, members long, map array<long>, away int, label long"
    members = spark.createDataFrame([(c, g, 100, 1, m, a, c) for c, g, m, a in rows], kind)
    postings = spark.createDataFrame([(7, g, 100, 0) for g in (1, 2, 3, 4)], "token long, gid long, n int, at int")
    found = module._group_pairs(postings, members, None, module.Similarity())
    assert sorted(map(tuple, found.collect())) == [(1, 2), (1, 4), (2, 4), (3, 4), (4, 4)]


def test_groups_that_share_most_of_their_prefixes_are_met_once(spark, monkeypatch):
    """Before, a pair came once for every shingle of 40 that both have."""
    same = [0] * module.MAP_WORDS
    members = spark.createDataFrame([(g, g, 400, 1, same, 0, g) for g in range(1, 7)], "cid long, gid long, n int, members long, map array<long>, away int, label long")
    # Group 6 shares only its first and its last shingle with the others.
    shared = [(t, g, 400, t) for g in range(1, 6) for t in range(40)] + [(t if t in (0, 39) else 100 + t, 6, 400, t) for t in range(40)]
    postings = spark.createDataFrame(shared, "token long, gid long, n int, at int")
    met, distinct = [], type(postings).distinct

    def counted(rows):
        if rows.columns == ["x", "y"]:
            met.append(rows.count())
        return distinct(rows)

    monkeypatch.setattr(type(postings), "distinct", counted)
    found = module._group_pairs(postings, members, None, module.Similarity())
    assert sorted(map(tuple, found.collect())) == [(x, y) for x in range(1, 7) for y in range(x + 1, 7)]
    assert met == [10 + 5 * 2]


def test_a_member_left_apart_does_not_pair_its_whole_group(spark, monkeypatch):
    """Before, all 41 members of group 1 met all 40 groups of their own component: 1,640 rows."""
    same = [0] * module.MAP_WORDS
    kind = "cid long, gid long, n int, members long, own int, prefix array<long>, map array<long>, away int"
    rows = [(1 + i, 1, 100, 41, 0, [7], same, 0) for i in range(41)] + [(100 + i, 100 + i, 100, 1, 0, [7], same, 0) for i in range(40)]
    classes = spark.createDataFrame(rows, kind)
    labels = spark.createDataFrame([(r[0], 1) for r in rows if r[0] != 41], "node long, label long")
    made, join, frame = [], type(classes).join, type(classes)

    def counted(self, *arguments):
        out = join(self, *arguments)
        made.append(out.count())
        return out

    monkeypatch.setattr(frame, "join", counted)
    whole = module._candidates(module._postings(classes), classes, labels, None, module.Similarity())
    assert sorted(map(tuple, whole.collect())) == [(41, i) for i in range(1, 41)] + [(i, 41) for i in range(100, 140)]
    assert max(made) < 250
    made.clear()
    parts = module._parts(classes, labels)
    cut = module._candidates(module._postings(parts), parts, labels, None, module.Similarity())
    assert sorted(map(tuple, cut.collect())) == sorted(map(tuple, whole.collect()))
    assert max(made) < 250
