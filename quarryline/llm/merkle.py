"""Merkle manifest of a dataset by slot pivot: one tree per group, and a tree over the groups.

A node's place among its siblings is a base-``FANOUT`` digit of its position. Conditional aggregates over a parent spread its
children into ``FANOUT`` slot columns: concatenated they hash to the parent, and without the own slot they are the siblings
that a proof needs. Several levels share one shuffle: a block of ``FANOUT ** LEVELS`` consecutive nodes is dealt to a task
once and sorted by its digits once, and every level is a window over one digit less. A group of any size is thereby cut into
blocks of bounded size, and only one node of each block goes on to the next round.

Texts are read once, for the hashes of the rows; nothing but digests is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarryline.operators.scale import number_rows, small_join
from quarryline.session import stage

FANOUT = 3
LEVELS = 6  # levels in one round: a block of 729 digests
_HEX = 64


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of the parts, concatenated; null parts count as nothing."""
    return F.sha2(F.concat_ws("", *parts), 256)


def field(value: Column) -> Column:
    """``-`` for null, else the byte count, ``:`` and the value, so that no two rows have the same encoding."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*values: Column) -> Column:
    return digest(*[field(v) for v in values])


# A step from a node to its parent: the node's slot, and its siblings from left to right.
_STEP = "array<struct<slot:int,others:string>>"


def _climb(nodes: DataFrame, levels: int, fanout: int) -> DataFrame:
    """Nodes (tree, pos, n, h, ...) with ``path`` and the node above, ``up``, ``levels`` levels higher.

    ``n`` is the number of nodes of the tree on this level. A tree that is down to one node takes no further step.
    """
    digits = [f"_d{i}" for i in range(levels)]
    rows = nodes.withColumn("block", F.floor(F.col("pos") / F.lit(fanout**levels)))
    places = {d: F.pmod(F.floor(F.col("pos") / F.lit(fanout**i)), F.lit(fanout)).cast("int") for i, d in enumerate(digits)}
    rows = rows.withColumns(places)
    # One exchange and one sort: each window's keys are a prefix of those of the window before.
    rows = rows.repartition("tree", "block").sortWithinPartitions("tree", "block", *reversed(digits))
    rows = rows.withColumns({"up": F.col("h"), "_n": F.col("n"), "path": F.array().cast(_STEP)})
    for i in range(levels):
        parent = Window.partitionBy("tree", "block", *reversed(digits[i + 1 :]))
        slots = [f"_s{j}" for j in range(fanout)]
        rows = rows.withColumns({s: F.max(F.when(F.col(digits[i]) == j, F.col("up"))).over(parent) for j, s in enumerate(slots)})
        others = F.concat_ws("", *[F.when(F.col(digits[i]) != j, F.col(s)) for j, s in enumerate(slots)])
        step = F.struct(F.col(digits[i]).alias("slot"), others.alias("others"))
        more = F.col("_n") > 1
        rows = rows.withColumns(
            {
                "path": F.when(more, F.concat("path", F.array(step))).otherwise(F.col("path")),
                "up": F.when(more, digest(*[F.col(s) for s in slots])).otherwise(F.col("up")),
                "_n": F.ceil(F.col("_n") / F.lit(fanout)),
            }
        ).drop(*slots)
    return rows.drop(*digits)


def _trees(nodes: DataFrame, most: int, levels: int, fanout: int) -> tuple[DataFrame, DataFrame]:
    """(nodes with ``path`` to their tree's root, roots (tree, root)). ``most`` is the size of the largest tree."""
    carried = [c for c in nodes.columns if c not in ("tree", "pos", "n", "h")]
    rounds = []
    while True:
        rows = stage(_climb(nodes, levels, fanout))
        rounds.append(rows)
        most = -(-most // fanout**levels)
        first = rows.where(F.col("pos") == F.col("block") * F.lit(fanout**levels))
        nodes = first.select("tree", F.col("block").alias("pos"), F.col("_n").alias("n"), F.col("up").alias("h"))
        if most <= 1:
            break
    roots = nodes.select("tree", F.col("h").alias("root"))
    above = None
    for rows in reversed(rounds):
        if above is not None:  # (tree, block) has at most fanout ** levels rows, so no key is hot
            higher = above.select("tree", F.col("pos").alias("block"), F.col("path").alias("_higher"))
            rows = rows.join(higher, ["tree", "block"]).withColumn("path", F.concat("path", "_higher"))
        above = rows.select("tree", "pos", *[c for c in rows.columns if c in carried], "path")
    return above, roots


def fold(start: Column, path: Column) -> Column:
    """The root that ``start`` leads to with the siblings of ``path``."""

    def step(node: Column, at: Column) -> Column:
        cut = at["slot"] * _HEX
        others = at["others"]
        return F.sha2(F.concat(F.substring(others, F.lit(1), cut), node, F.substring(others, cut + 1, F.length(others))), 256)

    return F.aggregate(path, start, step)


def manifest(
    rows: DataFrame, group: str, order: Sequence[str], tampered: str | None = None, levels: int = LEVELS, fanout: int = FANOUT
) -> DataFrame:
    """Adds ``subroot``, ``root``, ``proof_sha256``, ``folded_root`` and ``verified`` to rows with a digest ``leaf``.

    Per value of ``group`` the leaves ascend by ``order`` (nulls first), and every ``fanout`` consecutive nodes become their
    digest until one remains, the subroot; the subroots, by group (null first, bytewise), lead to the root in the same
    way. ``proof_sha256`` is the digest of all siblings on the way, left to right and level by level. ``folded_root`` is
    recomputed from the digest in column ``tampered`` (the leaf itself where there is none) with the original siblings.

    A null group is a group of its own. Rows that are equal in ``order`` are ordered by their leaf; equal rows have
    places of their own and the same results in any order. A null leaf is an error. No rows give no rows. Columns
    of ``rows`` pass through, whatever they are called, but for the five added names, which must be free.
    """
    names = rows.columns
    added = ("subroot", "root", "proof_sha256", "folded_root", "verified")
    clash = [c for c in names if c.lower() in added]
    if clash:
        raise ValueError(f"columns {clash} would be overwritten")
    # Own names in a struct cannot clash with the columns used here.
    whole = F.struct(*[F.col(f"`{c}`").alias(c) for c in names])
    checked = F.coalesce(F.col("leaf"), F.raise_error(F.lit("a leaf is null")))
    keyed = stage(
        rows.select(
            field(F.col(f"`{group}`")).alias("tree"), F.col(f"`{group}`").cast("string").alias("_group"),
            F.struct(*[F.col(f"`{c}`").alias(f"_{i}") for i, c in enumerate(order)]).alias("_order"),
            checked.alias("h"), whole.alias("_row"),
        )
    )
    sizes = stage(keyed.groupBy("tree").agg(F.first("_group").alias("_group"), F.count("*").alias("n")))
    most = sizes.agg(F.max("n")).first()[0]
    if most is None:
        return rows.select(
            "*", *[F.lit(None).cast("string").alias(c) for c in added[:4]], F.lit(None).cast("boolean").alias("verified")
        )
    numbered = number_rows(keyed.drop("_group"), ["tree"], [F.col("_order"), F.col("h")], "_at")
    nodes = small_join(numbered, sizes.select("tree", "n"), ["tree"], spread="h")
    nodes = nodes.select("tree", (F.col("_at") - 1).alias("pos"), "n", "h", "_row")
    leaves, subroots = _trees(nodes, most, levels, fanout)

    subroots = stage(subroots)
    groups = sizes.count()
    ordered = number_rows(sizes.select("tree", "_group").join(subroots, "tree"), [], [F.col("_group")], "_at")
    tops = ordered.select(
        F.lit(0).alias("tree"), (F.col("_at") - 1).alias("pos"), F.lit(groups).cast("bigint").alias("n"),
        F.col("root").alias("h"), F.col("tree").alias("_tree"),
    )
    # Staged, as a literal is no key that windows could share one exchange by.
    to_root, roots = _trees(stage(tops), groups, levels, fanout)
    root = roots.first()["root"]
    above = to_root.select(F.col("_tree").alias("tree"), F.col("path").alias("_above")).join(
        subroots.withColumnRenamed("root", "subroot"), "tree"
    )
    full = small_join(leaves, stage(above), ["tree"], spread="pos").withColumn("path", F.concat("path", "_above"))
    start = F.col("_row")[tampered] if tampered else F.col("_row")["leaf"]
    out = full.select(
        *[F.col("_row")[c].alias(c) for c in names], "subroot", F.lit(root).alias("root"),
        F.sha2(F.concat_ws("", F.col("path")["others"]), 256).alias("proof_sha256"), fold(start, F.col("path")).alias("folded_root"),
    )
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def tampered_leaves(docs: DataFrame) -> DataFrame:
    """(doc_id, source, leaf, tampered): the digest of each row of ``documents``, and that of the row as somebody changed it.

    Where 2 divides the crc32 of the decimal doc_id, tampering deletes the line feeds of the text. A null doc_id (crc32
    of the empty text is 0) is tampered with, too; a null text stays null. Columns beyond the five are not part of a leaf.
    """
    col, original = F.col, ["doc_id", "source", "lang", "n_chars"]
    chosen = F.crc32(F.coalesce(col("doc_id").cast("string"), F.lit("")).cast("binary")) % 2 == 0
    changed = F.when(chosen, F.replace(col("text"), F.lit("\n"), F.lit(""))).otherwise(col("text"))
    plain = [col(c) for c in original]
    return docs.select("doc_id", "source", leaf(*plain, col("text")).alias("leaf"), leaf(*plain, changed).alias("tampered"))


def document_manifest(docs: DataFrame) -> DataFrame:
    proven = manifest(tampered_leaves(docs), "source", ["doc_id"], "tampered")
    return proven.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
