"""A Merkle manifest of a dataset: a hash tree a group, one tree over the groups, and proofs that fold from kept midstates.

H is lowercase hex SHA-256 of its inputs, digests going in as hex text. Nodes follow each other in runs of ``fanout``, each run
becomes the H of its nodes, and this repeats while several are left.

The tree is cut into blocks of some ``BLOCK`` consecutive nodes, each worked on by itself: a block of leaves gives one node of
the next tier, and so on until a group has one block; the roots of the groups are the leaves of the last tree. On the way back
down every tier hands its nodes the path above them, so no task sees more than a block and a path.

Within a block each parent keeps a copy of its hash state before every child slot. Folding a changed node resumes the copy of
its slot with the replacement and the siblings to its right; what is left of it is not hashed again. For the levels above a
block the states before its slots are made once and copied for each of its leaves."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chainlytics.llm.tables import kept, table
from chainlytics.session import shuffle_width

#: Nodes of a block, at most.
BLOCK = 1024

#: Columns of a document that its leaf covers, in this order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

DIGEST = 64
BLOCKS = "g string, block bigint, n bigint, ids array<bigint>, digests binary, others binary, root string"
PATHS = "g string, i bigint, lefts array<string>, rights array<string>, subroot string"
PROOFS = "doc_id bigint, g string, position bigint, leaf string, subroot string, root string, siblings array<string>, folded_root string"


def field(value: Column) -> Column:
    """``-`` for null, else UTF-8 length, colon, value."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(columns: Mapping[str, Column]) -> Column:
    return F.sha2(F.concat(*[field(c) for c in columns.values()]), 256)


def height_of(fanout: int) -> int:
    """Levels of a whole block: as many as keep it within BLOCK nodes, one at least."""
    height = 1
    while fanout ** (height + 1) <= BLOCK:
        height += 1
    return height


class Tree:
    """A tree over some nodes: up to its root, or ``height`` levels if given (then lone nodes are hashed too)."""

    def __init__(self, nodes: Sequence[str], fanout: int, height: int | None = None):
        self.fanout, self.levels, self.states = fanout, [list(nodes)], []
        while len(self.levels[-1]) > 1 if height is None else len(self.states) < height:
            below, above, states = self.levels[-1], [], []
            for first in range(0, len(below), fanout):
                state, slots = hashlib.sha256(), []
                for digest in below[first : first + fanout]:
                    slots.append(state.copy())
                    state.update(digest.encode())
                above.append(state.hexdigest())
                states.append(slots)
            self.levels.append(above)
            self.states.append(states)

    @property
    def root(self) -> str:
        return self.levels[-1][0]

    def path(self, i: int) -> tuple[list[str], list[str]]:
        """What stands left and right of a node and of its ancestors within their runs, level by level."""
        lefts, rights = [], []
        for level in self.levels[:-1]:
            first = i - i % self.fanout
            lefts.append("".join(level[first:i]))
            rights.append("".join(level[i + 1 : first + self.fanout]))
            i //= self.fanout
        return lefts, rights

    def fold(self, i: int, replacement: str) -> str:
        """The root with a node replaced."""
        for level, states in zip(self.levels, self.states):
            first = i - i % self.fanout
            state = states[i // self.fanout][i - first].copy()
            state.update(replacement.encode())
            for digest in level[i + 1 : first + self.fanout]:
                state.update(digest.encode())
            replacement = state.hexdigest()
            i //= self.fanout
        return replacement


class Above:
    """The levels over a block, with the state before the block's slot in each."""

    def __init__(self, lefts: Sequence[str], rights: Sequence[str]):
        self.steps = [(hashlib.sha256(left.encode()), right.encode()) for left, right in zip(lefts, rights)]

    def fold(self, replacement: str) -> str:
        for before, right in self.steps:
            state = before.copy()
            state.update(replacement.encode())
            state.update(right)
            replacement = state.hexdigest()
        return replacement


def siblings(lefts: Sequence[str], rights: Sequence[str]) -> list[str]:
    """Single digests of a path, level by level and from left to right."""
    return [side[k : k + DIGEST] for level in zip(lefts, rights) for side in level for k in range(0, len(side), DIGEST)]


def numbered(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """``rows`` with their place i within g, in the order given, and the number n of rows of g.

    Rows are sorted in ranges and written; a place is a row's number in its range plus the group's rows in the ranges
    before, of which there is a count a range and group. So a group of any size is spread over ranges."""
    spark = rows.sparkSession
    keys = [F.col("g"), *[F.asc_nulls_first(c) for c in order]]
    spread = rows.repartitionByRange(shuffle_width(spark), *keys).sortWithinPartitions(*keys)
    placed = kept(spread.select("*", F.spark_partition_id().alias("_range"), F.monotonically_increasing_id().alias("_at")), "numbered")
    whole = Window.partitionBy("g")
    ahead = whole.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    counts = placed.groupBy("g", "_range").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    starts = counts.select("g", "_range", (F.coalesce(F.sum("_n").over(ahead), F.lit(0)) - F.col("_first")).alias("_shift"), F.sum("_n").over(whole).alias("n"))
    return placed.join(starts, ["g", "_range"]).withColumn("i", F.col("_at") + F.col("_shift")).drop("_range", "_at", "_shift")


def _digests(texts: Sequence[str]) -> bytes:
    return bytes.fromhex("".join(texts))


def _texts(raw: bytes) -> list[str]:
    whole = raw.hex()
    return [whole[k : k + DIGEST] for k in range(0, len(whole), DIGEST)]


def _fill_blocks(batches: Iterator[pa.RecordBatch], fanout: int, height: int) -> Iterator[pa.RecordBatch]:
    """Nodes sorted by (g, i), all of a block in one partition, to one row a block."""
    size = fanout**height
    key, held = None, []

    def finished() -> Iterator[pa.RecordBatch]:
        if held:
            (g, block), n = key, held[0]["n"]
            leaves = [row["digest"] for row in held]
            others = [row["other"] or row["digest"] for row in held]
            root = Tree(leaves, fanout, height if n > size else None).root
            columns = ([g], [block], [n], [[row["id"] for row in held]], [_digests(leaves)], [_digests(others)], [root])
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=[c.split()[0] for c in BLOCKS.split(", ")])

    for batch in batches:
        for row in batch.to_pylist():
            own = row["g"], row["i"] // size
            if own != key:
                yield from finished()
                key, held = own, []
            held.append(row)
    yield from finished()


def _tier(nodes: DataFrame, fanout: int, label: str) -> DataFrame:
    """Blocks over nodes (g, i, n, digest, and for leaves id and other), written."""
    height = height_of(fanout)
    size = fanout**height
    extra = [F.col(c) if c in nodes.columns else F.lit(None).cast(kind).alias(c) for c, kind in (("id", "bigint"), ("other", "string"))]
    rows = nodes.select("g", "i", "n", "digest", *extra, F.floor(F.col("i") / size).alias("_block"))
    dealt = rows.repartition(shuffle_width(nodes.sparkSession), "g", "_block").sortWithinPartitions("g", "i").drop("_block")
    return kept(dealt.mapInArrow(lambda it: _fill_blocks(it, fanout, height), BLOCKS), label)


def _tiers(nodes: DataFrame, fanout: int, label: str) -> list[DataFrame]:
    """Tiers of blocks, until each g has one."""
    size = fanout ** height_of(fanout)
    tiers = [_tier(nodes, fanout, f"{label}-0")]
    while (tiers[-1].agg(F.max("block")).first()[0] or 0) > 0:
        above = tiers[-1].select("g", F.col("block").alias("i"), F.ceil(F.col("n") / size).alias("n"), F.col("root").alias("digest"))
        tiers.append(_tier(above, fanout, f"{label}-{len(tiers)}"))
    return tiers


def _descend(batches: Iterator[pa.RecordBatch], fanout: int, height: int) -> Iterator[pa.RecordBatch]:
    """Blocks with the path above them to the whole paths of their nodes."""
    size = fanout**height
    for batch in batches:
        for row in batch.to_pylist():
            nodes = _texts(row["digests"])
            tree = Tree(nodes, fanout, height if row["n"] > size else None)
            paths = [tree.path(i) for i in range(len(nodes))]
            columns = (
                pa.array([row["g"]] * len(nodes), pa.string()), pa.array(np.arange(len(nodes)) + row["block"] * size, pa.int64()),
                pa.array([left + row["lefts"] for left, _ in paths], pa.list_(pa.string())), pa.array([right + row["rights"] for _, right in paths], pa.list_(pa.string())),
                pa.array([row["subroot"]] * len(nodes), pa.string()),
            )
            yield pa.RecordBatch.from_arrays(list(columns), names=["g", "i", "lefts", "rights", "subroot"])


def _prove(batches: Iterator[pa.RecordBatch], fanout: int, height: int, root: str) -> Iterator[pa.RecordBatch]:
    """Blocks of leaves with the path above them to one proof a leaf, folded from what is said to be there now."""
    size = fanout**height
    for batch in batches:
        for row in batch.to_pylist():
            leaves, others = _texts(row["digests"]), _texts(row["others"])
            tree, above = Tree(leaves, fanout, height if row["n"] > size else None), Above(row["lefts"], row["rights"])
            upper = siblings(row["lefts"], row["rights"])
            n = len(leaves)
            proofs = [siblings(*tree.path(i)) + upper for i in range(n)]
            folded = [above.fold(tree.fold(i, other)) for i, other in enumerate(others)]
            columns = (
                pa.array(row["ids"], pa.int64()), pa.array([row["g"]] * n, pa.string()), pa.array(np.arange(n) + row["block"] * size, pa.int64()), pa.array(leaves),
                pa.array([row["subroot"]] * n), pa.array([root] * n), pa.array(proofs, pa.list_(pa.string())), pa.array(folded),
            )
            yield pa.RecordBatch.from_arrays(list(columns), names=[c.split()[0] for c in PROOFS.split(", ")])


@dataclass
class Manifest:
    """Blocks of every tier, of the groups' trees and of the tree over them; ``roots`` has g, subroot and its place i."""

    fanout: int
    tiers: list[DataFrame]
    tops: list[DataFrame]
    roots: DataFrame
    root: str | None

    def _paths(self, tiers: list[DataFrame], above: DataFrame) -> DataFrame:
        """Paths of all nodes under ``tiers``, from the paths (by g) of their roots."""
        fanout, height = self.fanout, height_of(self.fanout)
        for blocks in reversed(tiers):
            joined = blocks.join(above.withColumnRenamed("i", "block"), ["g", "block"]).select("g", "block", "n", "digests", "lefts", "rights", "subroot")
            above = kept(joined.mapInArrow(lambda it: _descend(it, fanout, height), PATHS), "paths")
        return above

    def proofs(self) -> DataFrame:
        """doc_id, g (see :func:`build`), position in it, leaf, subroot, root, siblings and folded_root of every row."""
        spark = self.roots.sparkSession
        if self.root is None:
            return spark.createDataFrame([], PROOFS)
        empty = F.array().cast("array<string>")
        start = self.tops[-1].select("g", F.lit(0).cast("bigint").alias("i"), empty.alias("lefts"), empty.alias("rights"), F.lit(None).cast("string").alias("subroot"))
        named = self._paths(self.tops, start).drop("g", "subroot").join(self.roots, "i")
        above = self._paths(self.tiers[1:], named.select("g", F.lit(0).cast("bigint").alias("i"), "lefts", "rights", "subroot"))
        joined = self.tiers[0].join(above.withColumnRenamed("i", "block"), ["g", "block"])
        fanout, height, root = self.fanout, height_of(self.fanout), self.root
        return joined.mapInArrow(lambda it: _prove(it, fanout, height, root), PROOFS)


def build(docs: DataFrame, changed: Mapping[str, Column] | None = None, fields: Sequence[str] = FIELDS, group: str = "lang", key: str = "doc_id", fanout: int = 2) -> Manifest:
    """The manifest of ``docs``: one tree for each value of ``group``, leaves in ascending order of ``key`` (a bigint).

    A leaf covers ``fields``. ``changed`` gives for some of them the values found now; a proof then folds from the leaf of
    those, and differs from the root where they are not the same.

    Rows without a key come first, rows that share one follow each other by their leaves; equal rows are leaves of their own.
    Null fields are ``-``, so they differ from empty texts. Groups are ordered by the bytes of their value, the null group
    first; ``g`` is empty for it and else ``=`` and the value. A lone row of a lone group is its own root; an empty table has
    no root and no proofs. Further columns of ``docs`` are not read. Texts of any length are hashed whole, in the JVM.
    """
    if fanout < 2:
        raise ValueError("fanout must be 2 or more")
    columns = {name: F.col(name) for name in fields}
    now = {**columns, **{name: value for name, value in (changed or {}).items() if name in columns}}
    same = F.lit(True)
    for name in set(changed or {}) & set(columns):
        same &= now[name].eqNullSafe(columns[name])
    g = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("")).alias("g")
    rows = docs.select(g, F.col(key).cast("bigint").alias("id"), leaf(columns).alias("digest"), F.when(~same, leaf(now)).alias("other"))
    tiers = _tiers(numbered(kept(rows, "leaves"), ["id", "digest", "other"]), fanout, "tier")
    subroots = tiers[-1].select(F.lit("").alias("g"), F.col("g").alias("name"), F.col("root").alias("digest"))
    placed = kept(numbered(subroots, ["name"]), "subroots")
    tops = _tiers(placed, fanout, "top")
    roots = placed.select(F.col("name").alias("g"), F.col("digest").alias("subroot"), "i")
    found = tops[-1].select("root").first()
    return Manifest(fanout, tiers, tops, roots, None if found is None else found[0])


def op11_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's proof, where n_chars of some documents was tampered with."""
    tampered = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(7)) == 0
    n_chars = F.when(tampered, F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    found = build(table(spark, folder, "documents"), {"n_chars": n_chars}).proofs()
    proof = F.sha2(F.concat_ws("", "siblings"), 256).alias("proof_sha256")
    return found.select("doc_id", "leaf", "subroot", "root", proof, "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


_FIELD = "CASE WHEN {0} IS NULL THEN '-' ELSE strlen({0}::VARCHAR) || ':' || {0}::VARCHAR END"
_LEAF = "sha256(" + " || ".join(_FIELD.format(c) for c in FIELDS[:3]) + " || {0} || " + _FIELD.format("text") + ")"

ORACLE = f"""
    WITH RECURSIVE coded AS (
        SELECT *, coalesce('=' || lang, '') AS g,
               list_reduce([4294967295] || flatten([[ascii(c), 0, 0, 0, 0, 0, 0, 0] FOR c IN string_split(doc_id::VARCHAR, '')]),
                           lambda a, e: xor(xor(a, e) >> 1, 3988292384 * (xor(a, e) & 1))) AS crc
        FROM documents),
    hashed AS (
        SELECT doc_id, g, {_LEAF.format(_FIELD.format("n_chars"))} AS d,
               {_LEAF.format(_FIELD.format("(n_chars + CASE WHEN xor(crc, 4294967295) % 7 = 0 THEN 1 ELSE 0 END)"))} AS other
        FROM coded),
    base AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, d) - 1 AS i, count(*) OVER (PARTITION BY g) AS n FROM hashed),
    up AS (
        SELECT g, 0 AS level, i, d, n FROM base
        UNION ALL
        SELECT g, level + 1, i // 2, sha256(string_agg(d, '' ORDER BY i)), any_value((n + 1) // 2) FROM up WHERE n > 1 GROUP BY g, level, i // 2),
    subroots AS (SELECT g, d AS subroot, row_number() OVER (ORDER BY g) - 1 AS i, count(*) OVER () AS n FROM up WHERE n = 1),
    top AS (
        SELECT 0 AS level, i, subroot AS d, n FROM subroots
        UNION ALL
        SELECT level + 1, i // 2, sha256(string_agg(d, '' ORDER BY i)), any_value((n + 1) // 2) FROM top WHERE n > 1 GROUP BY level, i // 2),
    sides AS (
        SELECT g, level, i, CASE WHEN i % 2 = 1 THEN lag(d) OVER w ELSE '' END AS l, CASE WHEN i % 2 = 0 THEN coalesce(lead(d) OVER w, '') ELSE '' END AS r
        FROM up WHERE n > 1 WINDOW w AS (PARTITION BY g, level ORDER BY i)),
    top_sides AS (
        SELECT level, i, CASE WHEN i % 2 = 1 THEN lag(d) OVER w ELSE '' END AS l, CASE WHEN i % 2 = 0 THEN coalesce(lead(d) OVER w, '') ELSE '' END AS r
        FROM top WHERE n > 1 WINDOW w AS (PARTITION BY level ORDER BY i)),
    walk AS (
        SELECT doc_id, g, d AS leaf, 0 AS level, i, n, '' AS proof, coalesce(other, d) AS folded FROM base
        UNION ALL
        SELECT w.doc_id, w.g, w.leaf, w.level + 1, w.i // 2, (w.n + 1) // 2, w.proof || s.l || s.r, sha256(s.l || w.folded || s.r)
        FROM walk w JOIN sides s ON s.g = w.g AND s.level = w.level AND s.i = w.i),
    climb AS (
        SELECT doc_id, leaf, subroot, 0 AS level, t.i, t.n, proof, folded FROM walk w JOIN subroots t ON t.g = w.g WHERE w.n = 1
        UNION ALL
        SELECT c.doc_id, c.leaf, c.subroot, c.level + 1, c.i // 2, (c.n + 1) // 2, c.proof || s.l || s.r, sha256(s.l || c.folded || s.r)
        FROM climb c JOIN top_sides s ON s.level = c.level AND s.i = c.i)
    SELECT c.doc_id, c.leaf, c.subroot, t.d AS root, sha256(c.proof) AS proof_sha256, c.folded AS folded_root, c.folded = t.d AS verified
    FROM climb c, (SELECT d FROM top WHERE n = 1) t WHERE c.n = 1"""
