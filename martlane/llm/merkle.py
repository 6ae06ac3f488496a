"""Merkle manifest of a table: a digest tree per group, and one over the groups' roots.

A leaf is the digest of a row's fields. In each group leaves stand in order; on each level
every FAN consecutive nodes become one, the digest of their digests as text, until one is
left. The groups' last nodes, in the order of the groups, form a tree of the same kind.

The nodes of a level are rows with a place. Lag and lead columns at fixed offsets, masked
by a node's slot in its run and the run's length, are its siblings; the first node of
each run hashes the parent and goes on to the next level. Runs never cross a multiple of
FAN, so the windows of a level are cut into blocks of BLOCK places: a group with a third
of all rows is spread over blocks, as its places come from sorted ranges. Each level is a
written table. Going down again, a node's path is its siblings followed by its parent's.

Defined results: a null field counts as ``-`` and an empty one as ``0:``; leaves of one
group whose order column is equal (or null, which comes first) go by their digest, so
equal rows are leaves each for itself; a null group is a group of its own and comes first;
a text of any length is one field, hashed in the row; an empty table gives an empty
result; columns that are no field are ignored unless carried, and may have any name.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martlane.llm.common import written
from martlane.operators.rank import placed, placed_within

FAN = 3
BLOCK = FAN**9  # places whose windows run in one task
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(text: Column) -> Column:
    """The SHA-256 of a text's UTF-8 bytes, as lowercase hex digits."""
    return F.sha2(text.cast("binary"), 256)


def leaf(*fields: Column) -> Column:
    """The digest of all fields in order, each as its length in bytes, a colon and its text."""

    def part(field: Column) -> Column:
        text = field.cast("string")
        sized = F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
        return F.coalesce(sized, F.lit("-"))

    return digest(F.concat(*map(part, fields)))


def fold(start: Column, path: Column) -> Column:
    """The digest at the end of a path that begins at ``start``."""
    return F.aggregate(path, start, lambda node, at: digest(F.concat(at["before"], node, at["after"])))


def siblings(path: Column) -> Column:
    """All digests of a path, level by level, left to right."""
    return F.array_join(F.transform(path, lambda at: F.concat(at["before"], at["after"])), "")


def _with_siblings(nodes: DataFrame) -> DataFrame:
    """Nodes with the digests of their run before and after them; ``parent`` on the first of each run."""
    slot = F.col("place") % FAN
    run = F.least(F.lit(FAN), F.col("rows") - F.col("place") + slot)
    block = F.col("place") - F.col("place") % BLOCK
    window = Window.partitionBy("tree", block).orderBy("place")
    before = [F.when(slot >= k, F.lag("hash", k).over(window)) for k in range(FAN - 1, 0, -1)]
    after = [F.when(slot + k < run, F.lead("hash", k).over(window)) for k in range(1, FAN)]
    found = nodes.withColumn("before", F.concat_ws("", *before)).withColumn(
        "after", F.concat_ws("", *after)
    )
    return found.withColumn("parent", F.when(slot == 0, digest(F.concat("hash", "after"))))


def trees(leaves: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(the leaves with their paths, the last node of each tree).

    Leaves have tree, place (from 0 in the tree), rows (of the tree) and hash; further
    columns stay.
    """
    levels = [written(_with_siblings(leaves), "merkle-0")]
    tall = levels[0].agg(F.max("rows")).first()[0] or 0
    tops = [levels[0].filter("rows = 1").select("tree", "hash")]
    while FAN ** len(levels) < tall or len(levels) == 1 < tall:
        below = levels[-1].filter(f"rows > 1 and place % {FAN} = 0")
        now = below.selectExpr(
            "tree", f"place div {FAN} place", f"(rows + {FAN - 1}) div {FAN} rows", "parent hash"
        )
        levels.append(written(_with_siblings(now), f"merkle-{len(levels)}"))
        tops.append(levels[-1].filter("rows = 1").select("tree", "hash"))
    if tall > 1:
        last = levels[-1].filter(f"rows > 1 and place % {FAN} = 0")
        tops.append(last.select("tree", F.col("parent").alias("hash")))
    top = tops[0]
    for more in tops[1:]:
        top = top.unionAll(more)

    paths = None
    for level in reversed(levels):
        none = F.array().cast("array<struct<before:string,after:string>>")
        own = F.when(F.col("rows") > 1, F.array(F.struct("before", "after"))).otherwise(none)
        at = level.withColumn("path", own).drop("before", "after", "parent")
        if paths is not None:
            above = paths.select("tree", F.col("place").alias("up"), F.col("path").alias("rest"))
            at = at.withColumn("up", F.expr(f"place div {FAN}")).join(above, ["tree", "up"], "left")
            longer = F.concat("path", F.coalesce("rest", none))
            at = at.withColumn("path", longer).drop("up", "rest")
        paths = at
    return paths, top


def manifest(
    rows: DataFrame,
    fields: Sequence[str] = FIELDS,
    group: str = "source",
    order: str = "doc_id",
    carry: Mapping[str, Column] | None = None,
) -> DataFrame:
    """``order``, leaf, path, subroot, root and the ``carry`` columns, for every row.

    ``path`` has the siblings on each level up to the root, as structs of the digests
    before and after the node; ``fold(leaf, path)`` is the root again.
    """
    carried = F.struct(F.lit(0), *[c.alias(name) for name, c in (carry or {}).items()])
    hashed = rows.select(
        F.col(group).alias("tree_group"),
        F.col(order).alias("tree_order"),
        leaf(*[F.col(c) for c in fields]).alias("hash"),
        carried.alias("carried"),
    )
    in_order = [F.col("tree_order").asc_nulls_first(), F.col("hash").asc()]
    placing = placed_within(hashed, {"tree_group": F.col("tree_group").asc_nulls_first()}, in_order)
    leaves = placing.select(
        F.col("group_start").alias("tree"),
        "place",
        F.col("group_rows").alias("rows"),
        *("hash", "tree_order", "carried"),
    )
    found, tops = trees(leaves)

    # A group's number is its place among all rows, so the numbers are in the groups' order.
    roots = written(tops, "merkle-subroots")
    upper = placed(roots, [F.col("tree").asc()]).select(
        F.lit(0).cast("long").alias("tree"),
        "place",
        F.lit(roots.count()).cast("long").alias("rows"),
        "hash",
        F.col("tree").alias("of_group"),
    )
    over, root = trees(upper)
    above = over.select(
        F.col("of_group").alias("tree"), F.col("hash").alias("subroot"), F.col("path").alias("rest")
    )
    return found.join(above, "tree").select(
        F.col("tree_order").alias(order),
        F.col("hash").alias("leaf"),
        F.concat("path", "rest").alias("path"),
        "subroot",
        root.select("hash").scalar().alias("root"),
        *[F.col(f"carried.{name}") for name in carry or {}],
    )


def verified(docs: DataFrame) -> DataFrame:
    """Leaves, roots and proofs of documents, each folded from a leaf that may be tampered with.

    Tampering deletes the line breaks of the text where the CRC-32 of doc_id is even.
    """
    bare = F.replace(F.col("text"), F.lit("\n"), F.lit(""))
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    changed = leaf(*[bare if c == "text" else F.col(c) for c in FIELDS])
    forged = F.when(even & F.contains("text", F.lit("\n")), changed)
    proofs = manifest(docs, carry={"forged": forged})
    folded = fold(F.coalesce("forged", "leaf"), F.col("path"))
    return proofs.select(
        *("doc_id", "leaf", "subroot", "root"),
        digest(siblings(F.col("path"))).alias("proof_sha256"),
        folded.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


# The same in DuckDB: lists of digests for each level, and CRC-32 from its table of 256 entries.
ORACLE = """
WITH RECURSIVE crc_table AS (
    SELECT list(list_reduce([n] || range(8),
        lambda c, _: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY n) AS t
    FROM (SELECT unnest(range(256)) AS n)
),
leaves AS (
    SELECT doc_id, source,
        sha256(p || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
        sha256(p || coalesce(strlen(bare) || ':' || bare, '-')) AS forged,
        xor(list_reduce([4294967295] || list_transform(range(1, length(id) + 1), lambda i: ascii(id[i])),
            lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS crc
    FROM (
        SELECT *, doc_id::VARCHAR AS id, replace(text, chr(10), '') AS bare,
            coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id::VARCHAR, '-')
            || coalesce(strlen(source) || ':' || source, '-')
            || coalesce(strlen(lang) || ':' || lang, '-')
            || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars::VARCHAR, '-') AS p
        FROM documents
    ), crc_table
),
placed AS (
    SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place
    FROM leaves
),
up AS (
    SELECT source, 0 AS level, list(leaf ORDER BY place) AS nodes FROM placed GROUP BY source
    UNION ALL
    SELECT source, level + 1, list_transform(range((len(nodes) + 2) // 3),
        lambda i: sha256(array_to_string(nodes[3 * i + 1:3 * i + 3], '')))
    FROM up WHERE len(nodes) > 1
),
subroots AS (
    SELECT source, nodes[1] AS subroot,
        row_number() OVER (ORDER BY encode(source) NULLS FIRST) - 1 AS place
    FROM up WHERE len(nodes) = 1
),
over_up AS (
    SELECT 0 AS level, list(subroot ORDER BY place) AS nodes FROM subroots
    UNION ALL
    SELECT level + 1, list_transform(range((len(nodes) + 2) // 3),
        lambda i: sha256(array_to_string(nodes[3 * i + 1:3 * i + 3], '')))
    FROM over_up WHERE len(nodes) > 1
),
steps AS (
    SELECT p.source, p.place, u.level, u.nodes, (p.place // (3 ** u.level)::BIGINT)::BIGINT AS spot
    FROM placed p JOIN up u ON u.source IS NOT DISTINCT FROM p.source AND len(u.nodes) > 1
    UNION ALL
    SELECT p.source, p.place, 1000 + o.level, o.nodes, (s.place // (3 ** o.level)::BIGINT)::BIGINT
    FROM placed p JOIN subroots s ON s.source IS NOT DISTINCT FROM p.source
    JOIN over_up o ON len(o.nodes) > 1
),
paths AS (
    SELECT source, place, list([array_to_string(nodes[spot - spot % 3 + 1:spot], ''),
        array_to_string(nodes[spot + 2:spot - spot % 3 + 3], '')] ORDER BY level) AS path
    FROM steps GROUP BY source, place
),
proofs AS (
    SELECT p.doc_id, p.leaf, s.subroot, (SELECT nodes[1] FROM over_up WHERE len(nodes) = 1) AS root,
        sha256(coalesce(array_to_string(list_transform(path, lambda x: x[1] || x[2]), ''), '')) AS proof_sha256,
        list_reduce([['', CASE WHEN doc_id IS NOT NULL AND crc % 2 = 0 THEN forged ELSE leaf END]] || coalesce(path, []),
            lambda a, x: ['', sha256(x[1] || a[2] || x[2])])[2] AS folded_root
    FROM placed p
    JOIN subroots s ON s.source IS NOT DISTINCT FROM p.source
    LEFT JOIN paths a ON a.source IS NOT DISTINCT FROM p.source AND a.place = p.place
)
SELECT *, folded_root = root AS verified FROM proofs
"""
