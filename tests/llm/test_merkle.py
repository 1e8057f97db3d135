import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from quarryline.llm import merkle


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def tree(nodes, fanout=3):
    """Root, and per node its steps (siblings to the left, to the right)."""
    paths, members = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        up, over = [], []
        for i in range(0, len(nodes), fanout):
            run = nodes[i : i + fanout]
            for j, inside in enumerate(members[i : i + fanout]):
                for d in inside:
                    paths[d].append((run[:j], run[j + 1 :]))
            up.append(sha(*run))
            over.append([d for inside in members[i : i + fanout] for d in inside])
        nodes, members = up, over
    return nodes[0], paths


def expected(rows, fanout=3):
    """rows: (group, order, leaf, tampered); results in the same order."""
    groups = {}
    for at, (group, order, leaf, _) in enumerate(rows):
        groups.setdefault(group, []).append(((order is not None, order or 0), leaf, at))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: tree([leaf for _, leaf, _ in sorted(groups[g])], fanout) for g in names}
    root, tops = tree([trees[g][0] for g in names], fanout)
    out = [None] * len(rows)
    for g, top in zip(names, tops):
        for (_, _, at), path in zip(sorted(groups[g]), trees[g][1]):
            path, x = path + top, rows[at][3]
            for left, right in path:
                x = sha(*left, x, *right)
            out[at] = (trees[g][0], root, sha(*[h for left, right in path for h in left + right]), x, x == root)
    return out


def key(row):
    return tuple(str(x) for x in row)


@pytest.mark.parametrize("levels, fanout", [(6, 3), (1, 3), (2, 2)])
def test_trees_of_every_size(spark, levels, fanout):
    """Groups of 1 to 30 leaves and one of 200, in rounds of different height."""
    rows = [(f"g{n:02}", i, sha(f"{n} {i}"), sha(f"{n} {i % 7}")) for n in [*range(1, 31), 200] for i in range(n)]
    rows += [(None, 5, sha("x"), sha("x")), (None, None, sha("y"), sha("y")), ("", 1, sha("z"), sha("")), ("é", 1, sha("e"), sha("e"))]
    rows += [("g07", 3, sha("tie"), sha("tie"))] * 3  # ties, and repeated rows
    frame = spark.createDataFrame(
        [(*r, "kept", i) for i, r in enumerate(rows)], "g string, o long, leaf string, changed string, tree string, path long"
    )
    got = merkle.manifest(frame.repartition(7), "g", ["o"], "changed", levels, fanout).collect()
    want = [(*r, "kept", i, *e) for i, (r, e) in enumerate(zip(rows, expected(rows, fanout)))]
    # Rows that are equal but for a column that is not ordered by may take each other's place.
    same = lambda r: key(r[:4]) if r[2] == sha("tie") else key(r)
    assert sorted(same(r) for r in got) == sorted(same(r) for r in want)


def test_one_leaf_is_the_root(spark):
    frame = spark.createDataFrame([("a", 1, sha("x"))], "g string, o long, leaf string")
    row = merkle.manifest(frame, "g", ["o"]).first()
    assert row.subroot == row.root == row.folded_root == sha("x") and row.proof_sha256 == sha("") and row.verified


def test_documents_with_odd_rows(spark):
    rows = [(i, f"line {i}\nend", f"s{i % 3}", "en", 10, "x") for i in range(40)]
    rows += [(None, None, None, None, None, None), (50, None, "s1", None, 3, ""), (51, "", "", "de", 0, "q"), (52, "\n" * 10, "s1", "", 10, "q")]
    rows += [rows[3], rows[3], (53, "ü\n" * 50_000, "s2", "en", 100_000, "q")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, n_chars long, leaf string")
    plain = []
    for doc_id, text, source, lang, n_chars, _ in rows:
        changed = text and text.replace("\n", "") if zlib.crc32(str("" if doc_id is None else doc_id).encode()) % 2 == 0 else text
        head = field(doc_id) + field(source) + field(lang) + field(n_chars)
        plain.append((source, doc_id, sha(head + field(text)), sha(head + field(changed))))
    want = [(r[1], r[2], *e) for r, e in zip(plain, expected(plain))]
    got = merkle.document_manifest(frame.repartition(4)).collect()
    assert sorted(key(r) for r in got) == sorted(key(r) for r in want)
    assert {r.verified for r in got} == {True, False}
    empty = merkle.document_manifest(frame.limit(0))
    assert empty.count() == 0 and empty.columns == merkle.document_manifest(frame).columns


def test_errors(spark):
    frame = spark.createDataFrame([("a", 1, None)], "g string, o long, leaf string")
    with pytest.raises(Exception, match="a leaf is null"):
        merkle.manifest(frame, "g", ["o"]).collect()
    with pytest.raises(ValueError, match="Root"):
        merkle.manifest(frame.withColumn("Root", F.lit(1)), "g", ["o"])


def test_one_exchange_per_round(spark):
    nodes = spark.range(1000).selectExpr("string(id % 3) AS tree", "id AS pos", "1000L AS n", "sha2(string(id), 256) AS h")
    plan = merkle._climb(nodes, 6, 3)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("Sort ") == 1 and plan.count("Window ") == 6
