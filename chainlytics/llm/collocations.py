"""Collocations from depth-truncated suffix trees, built group by group after ERA's vertical partitioning.

A suffix is a word of a piece of text and the words that follow it there, ``longest`` at most. All suffixes of a corpus form
one tree whose node counts are the phrase counts. The tree is never built whole:

* **Vertical partitioning.** Prefixes of one word are counted. One with more than ``budget`` occurrences is extended by a
  word and counted again, until every prefix fits or has one word less than a whole path; the suffixes of prefixes that are
  still too frequent are told apart by their whole path. Prefixes fall into slots by hash (at most 2^20, so their weights are
  a bounded table), and slots are packed into groups of about ``budget`` occurrences, the heaviest slot first.
* **Leaves.** A task sorts the suffixes of some megabytes of text and sends each group its distinct paths with their totals,
  as compressed columns over a vocabulary of their own.
* **Subtrees.** A group's leaves are merged and sorted; a node at depth j is a run of equal first j words, and its count is
  the sum of the leaf totals below it. One group is in memory at a time. Counts of prefixes that were extended are known from
  the partitioning.

No word, pair or passage is hot after that: its occurrences are leaf totals, and a frequent prefix is spread over groups.
64-bit hashes stand for (language, word); products are computed in DECIMAL(38)."""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chainlytics.llm.arrays import between, mix, prefix_hash
from chainlytics.llm.tables import kept, table
from chainlytics.session import shuffle_width

#: Occurrences a group holds, and the most prefixes that are extended at a length: beyond it the budget grows.
BUDGET, MOST_EXTENDED = 4_000_000, 100_000

#: Bytes of text a task sorts at a time; a longer piece without a delimiter is taken whole.
WINDOW = 4 << 20

#: What ends a piece of text, and the language of rows without one.
DELIMITERS, UNKNOWN = b".,;:!?\n\x0b\x0c\r", "und"

CLASSES = bytes(10 if c in DELIMITERS else 32 if c in b" \t" else c + 32 if 65 <= c <= 90 else c for c in range(256))
CUT = re.compile(b"[" + re.escape(DELIMITERS) + b"]")

WORDS = "id bigint, lang string, word string, n bigint"
PREFIXES = "lang string, prefix bigint, path array<bigint>, n bigint"
LEAVES = "group int, lang string, leaves int, words int, packed binary"
NODES = "lang string, path array<bigint>, a bigint"

_codec = pa.Codec("zstd", 1)


def windows(batches: Iterator[pa.RecordBatch], size: int = WINDOW) -> Iterator[tuple[str, bytes]]:
    """(lang, text) rows as (lang, some megabytes of whole pieces), texts of a language one after another."""
    waiting: dict[str, list[bytes]] = {}
    held: dict[str, int] = {}
    for batch in batches:
        langs = batch.column("lang").to_pylist()
        for lang, text in zip(langs, batch.column("text").cast(pa.binary()).to_pylist()):
            if text:
                waiting.setdefault(lang, []).append(text)
                held[lang] = held.get(lang, 0) + len(text) + 1
        while held and sum(held.values()) >= size:
            lang = max(held, key=held.get)
            yield from _pieces(lang, waiting.pop(lang), size)
            del held[lang]
    for lang, texts in waiting.items():
        yield from _pieces(lang, texts, size)


def _pieces(lang: str, texts: list[bytes], size: int) -> Iterator[tuple[str, bytes]]:
    data, first = b"\n".join(texts), 0
    while first < len(data):
        found = CUT.search(data, first + size) if len(data) - first > 2 * size else None
        last = found.end() if found else len(data)
        yield lang, data[first:last]
        first = last


def tokens(lang: str, data: bytes) -> tuple[np.ndarray, np.ndarray, pa.Array, np.ndarray]:
    """Number of each word in a vocabulary, number of its piece, the vocabulary, and the 64-bit hashes of its words."""
    raw = np.frombuffer(data.translate(CLASSES), dtype=np.uint8)
    cut = raw == 10
    inside = ~(cut | (raw == 32))
    edge = np.flatnonzero(np.diff(np.concatenate(([0], inside.view(np.int8), [0]))))
    starts, sizes = edge[::2], edge[1::2] - edge[::2]
    piece = np.cumsum(cut, dtype=np.int32)[starts]
    offsets = np.zeros(len(starts) + 1, dtype=np.int64)
    np.cumsum(sizes, out=offsets[1:])
    letters = raw[inside]
    whole = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(letters)])
    coded = whole.dictionary_encode()
    words = coded.dictionary
    bounds = np.frombuffer(words.buffers()[1], dtype=np.int64)[words.offset : words.offset + len(words) + 1]
    if not len(words):
        return np.zeros(0, np.int64), piece, words, np.zeros(0, np.uint64)
    sums = prefix_hash(np.frombuffer(words.buffers()[2], dtype=np.uint8)[: bounds[-1]])
    name = np.frombuffer(lang.encode() + b"\0", dtype=np.uint8)
    ids = mix(between(sums, bounds[:-1], bounds[1:]) ^ between(prefix_hash(name), np.zeros(1, np.int64), np.array([len(name)]))[0])
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), piece, words, ids


def chained(path: np.ndarray, following: np.ndarray) -> np.ndarray:
    """Hash of a path and one more word."""
    return mix(path * np.uint64(0x9E3779B97F4A7C15) + following)


def _slot(prefix: np.ndarray, bits: int) -> np.ndarray:
    return (prefix >> np.uint64(64 - bits)).astype(np.int64)


def suffixes(words: np.ndarray, piece: np.ndarray, depth: int) -> list[np.ndarray]:
    """The columns of all suffixes with two words at least: vocabulary numbers from 1, 0 after the end of a piece."""
    n = len(words)
    if n < 2:
        return [np.zeros(0, dtype=np.int64)] * depth
    start = np.flatnonzero(piece[1:] == piece[:-1])
    columns = [words[start] + 1]
    for k in range(1, depth):
        at = np.minimum(start + k, n - 1)
        columns.append(np.where((start + k < n) & (piece[at] == piece[start]), words[at] + 1, 0))
    return columns


def totals(columns: list[np.ndarray], counts: np.ndarray, size: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct paths in order, with the sums of their counts. ``size``: above all numbers in the columns."""
    if not len(counts):
        return columns, counts
    if size ** len(columns) < 2**63:
        key = columns[0].astype(np.int64)
        for column in columns[1:]:
            key = key * size + column
        order = np.argsort(key, kind="stable")
        key = key[order]
        fresh = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    else:
        order = np.lexsort(columns[::-1])
        changed = np.zeros(len(order) - 1, dtype=bool)
        for column in columns:
            own = column[order]
            changed |= own[1:] != own[:-1]
        fresh = np.flatnonzero(np.concatenate(([True], changed)))
    return [column[order[fresh]] for column in columns], np.add.reduceat(counts[order], fresh)


@dataclass(frozen=True)
class Partitioning:
    """Prefixes that were extended, by their length, as sorted hashes; the group of each slot."""

    depth: int
    bits: int = 0
    extended: list[np.ndarray] = field(default_factory=list)
    groups: np.ndarray | None = None

    def is_extended(self, prefix: np.ndarray, length: int) -> np.ndarray:
        own = self.extended[length - 1] if length <= len(self.extended) else np.zeros(0, dtype=np.uint64)
        if not len(own):
            return np.zeros(len(prefix), dtype=bool)
        return own[np.minimum(np.searchsorted(own, prefix), len(own) - 1)] == prefix

    def group_of(self, paths: list[np.ndarray]) -> np.ndarray:
        """The group of each path of word hashes (0: end): that of its shortest prefix that was not extended."""
        prefix, open_ = paths[0], self.is_extended(paths[0], 1)
        for length in range(2, self.depth + 1):
            longer = chained(prefix, paths[length - 1])
            prefix = np.where(open_, longer, prefix)
            open_ = open_ & self.is_extended(prefix, length)
        return self.groups[_slot(prefix, self.bits)]


def packed(weights: dict[int, int], bits: int, budget: int) -> np.ndarray:
    """Group of every slot: the heaviest slot first, each to the group with most room left."""
    number = max(1, -(-sum(weights.values()) // budget))
    out = (np.arange(1 << bits) % number).astype(np.int32)  # slots without a weight of their own
    rooms = [(0, g) for g in range(number)]
    for slot in sorted(weights, key=lambda s: (-weights[s], s)):
        load, group = heapq.heappop(rooms)
        out[slot] = group
        heapq.heappush(rooms, (load + weights[slot], group))
    return out


def _count_words(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for lang, data in windows(batches, size):
        index, _, words, ids = tokens(lang, data)
        if len(words):
            counts = np.bincount(index, minlength=len(words))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids.view(np.int64)), pa.array([lang] * len(words), pa.string()), words.cast(pa.large_string()).cast(pa.string()), pa.array(counts.astype(np.int64))],
                names=["id", "lang", "word", "n"],
            )


def _hashes(columns: list[np.ndarray], ids: np.ndarray) -> list[np.ndarray]:
    known = np.concatenate((np.zeros(1, dtype=np.uint64), ids))
    return [known[column] for column in columns]


def _paths(columns: list[np.ndarray]) -> pa.Array:
    n, length = len(columns[0]), len(columns)
    flat = np.stack(columns, axis=1).reshape(-1).view(np.int64) if n else np.zeros(0, dtype=np.int64)
    return pa.ListArray.from_arrays(pa.array(np.arange(0, n * length + 1, length, dtype=np.int32)), pa.array(flat))


def _count_prefixes(batches: Iterator[pa.RecordBatch], length: int, so_far: Partitioning, size: int) -> Iterator[pa.RecordBatch]:
    """Occurrences of the prefixes of ``length`` words that continue an extended one."""
    for lang, data in windows(batches, size):
        index, piece, words, ids = tokens(lang, data)
        columns = suffixes(index, piece, length)
        hashes = _hashes(columns, ids)
        prefix, wanted = hashes[0], so_far.is_extended(hashes[0], 1)
        for k in range(2, length + 1):
            prefix = chained(prefix, hashes[k - 1])
            wanted &= columns[k - 1] > 0
            if k < length:
                wanted &= so_far.is_extended(prefix, k)
        if not wanted.any():
            continue
        distinct, first, counts = np.unique(prefix[wanted], return_index=True, return_counts=True)
        path = _paths([h[wanted][first] for h in hashes])
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(distinct), pa.string()), pa.array(distinct.view(np.int64)), path, pa.array(counts.astype(np.int64))], names=["lang", "prefix", "path", "n"])


def _send_leaves(batches: Iterator[pa.RecordBatch], parting: Partitioning, size: int) -> Iterator[pa.RecordBatch]:
    for lang, data in windows(batches, size):
        index, piece, words, ids = tokens(lang, data)
        columns = suffixes(index, piece, parting.depth)
        columns, counts = totals(columns, np.ones(len(columns[0]), dtype=np.int64), len(words) + 1)
        if not len(counts):
            continue
        groups = parting.group_of(_hashes(columns, ids))
        order = np.argsort(groups, kind="stable")
        groups = groups[order]
        edges = np.flatnonzero(np.concatenate(([True], groups[1:] != groups[:-1], [True])))
        rows: list[list] = [[], [], [], [], []]
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
            own = order[a:b]
            for column, value in zip(rows, (int(groups[a]), lang, *_pack([c[own] for c in columns], counts[own], ids))):
                column.append(value)
        kinds = (pa.int32(), pa.string(), pa.int32(), pa.int32(), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(column, kind) for column, kind in zip(rows, kinds)], names=["group", "lang", "leaves", "words", "packed"])


def _pack(columns: list[np.ndarray], counts: np.ndarray, ids: np.ndarray) -> tuple[int, int, bytes]:
    """Leaves in path order as (their number, size of their vocabulary, both compressed byte plane by byte plane)."""
    used = np.unique(np.concatenate(columns))
    used = used[used > 0]
    local = [np.where(c > 0, np.searchsorted(used, c) + 1, 0) for c in columns]
    local[0] = np.diff(local[0], prepend=0)  # rises
    planes = np.stack([*local, counts]).astype("<u4").view(np.uint8).reshape(len(columns) + 1, -1, 4).transpose(0, 2, 1)
    return len(counts), len(used), _codec.compress(ids[used - 1].astype("<u8").tobytes() + planes.tobytes(), asbytes=True)


def _unpack(leaves: int, words: int, raw: bytes, depth: int) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    data = _codec.decompress(raw, 8 * words + 4 * leaves * (depth + 1), asbytes=True)
    ids = np.frombuffer(data, dtype="<u8", count=words)
    planes = np.frombuffer(data, dtype=np.uint8, offset=8 * words).reshape(depth + 1, 4, leaves).transpose(0, 2, 1)
    numbers = np.ascontiguousarray(planes).view("<u4").reshape(depth + 1, leaves).astype(np.int64)
    return ids, [np.cumsum(numbers[0]), *numbers[1:depth]], numbers[depth]


def subtree(parts: list[tuple[int, int, bytes]], parting: Partitioning, least: int) -> Iterator[tuple[list[np.ndarray], np.ndarray]]:
    """Per depth from 2 the nodes of a group's tree with a count of at least ``least``: (columns of word hashes, counts)."""
    opened = [_unpack(*part, parting.depth) for part in parts]
    ids = np.unique(np.concatenate([own for own, _, _ in opened]))
    places = [np.concatenate(([0], np.searchsorted(ids, own) + 1)) for own, _, _ in opened]
    columns = [np.concatenate([place[cols[k]] for place, (_, cols, _) in zip(places, opened)]) for k in range(parting.depth)]
    counts = np.concatenate([own for _, _, own in opened])
    del opened, places
    columns, leaf_totals = totals(columns, counts, len(ids) + 1)
    changed = np.zeros(len(leaf_totals), dtype=bool)
    changed[0] = True
    for depth, column in enumerate(columns, 1):
        changed[1:] |= column[1:] != column[:-1]
        if depth == 1:
            continue
        nodes = np.flatnonzero(changed)
        a = np.add.reduceat(leaf_totals, nodes)
        good = (a >= least) & (column[nodes] > 0)
        paths = _hashes([c[nodes[good]] for c in columns[:depth]], ids)
        prefix, split = paths[0], parting.is_extended(paths[0], 1)
        for length in range(2, depth + 1):
            prefix = chained(prefix, paths[length - 1])
            split &= parting.is_extended(prefix, length)
        yield [p[~split] for p in paths], a[good][~split]


def _grow(batches: Iterator[pa.RecordBatch], parting: Partitioning, least: int) -> Iterator[pa.RecordBatch]:
    """One group after another of a partition sorted by group and language."""
    last, parts = None, []

    def finished():
        if parts:
            for columns, a in subtree(parts, parting, least):
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array([last[1]] * len(a), pa.string()), _paths(columns), pa.array(a)], names=["lang", "path", "a"])

    for batch in batches:
        for row in batch.to_pylist():
            key = row["group"], row["lang"]
            if key != last:
                yield from finished()
                last, parts = key, []
            parts.append((row["leaves"], row["words"], row["packed"]))
    yield from finished()


def nodes(docs: DataFrame, longest: int, least: int, budget: int = BUDGET, window: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """(words: id, lang, word, n) and (phrases of 2 to ``longest`` words that occur ``least`` times: lang, path of ids, a),
    both written. ``docs`` has lang and text; see :func:`collocations`."""
    spark = docs.sparkSession
    texts = docs.select(F.coalesce(F.col("lang"), F.lit(UNKNOWN)).alias("lang"), "text")
    counted = texts.mapInArrow(lambda it: _count_words(it, window), WORDS)
    words = kept(counted.groupBy("id", "lang", "word").agg(F.sum("n").alias("n")), "words")
    total = words.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    budget = max(budget, -(-total // MOST_EXTENDED))
    bits = min(20, max(10, (16 * total // budget).bit_length()))

    def weights(prefixes: DataFrame, column: str) -> dict[int, int]:
        own = prefixes.where(F.col("n") <= budget).groupBy(F.shiftrightunsigned(column, 64 - bits).alias("slot")).agg(F.sum("n").alias("n"))
        return {row["slot"]: row["n"] for row in own.collect()}  # 2^bits rows at most

    def frequent(prefixes: DataFrame, column: str) -> np.ndarray:
        """Hashes of the prefixes over the budget: MOST_EXTENDED at most, as each has 1 / MOST_EXTENDED of all words."""
        return np.sort(np.array([row[0] for row in prefixes.where(F.col("n") > budget).select(column).collect()], dtype=np.int64).view(np.uint64))

    load, extended, known = weights(words, "id"), [frequent(words, "id")], None
    for length in range(2, longest):
        if not len(extended[-1]):
            break
        so_far = Partitioning(longest, bits, list(extended))
        found = texts.mapInArrow(lambda it, n=length, p=so_far: _count_prefixes(it, n, p, window), PREFIXES)
        found = kept(found.groupBy("lang", "prefix", "path").agg(F.sum("n").alias("n")), "prefixes")
        extended.append(frequent(found, "prefix"))
        for slot, n in weights(found, "prefix").items():
            load[slot] = load.get(slot, 0) + n
        own = found.where((F.col("n") > budget) & (F.col("n") >= least)).select("lang", "path", F.col("n").alias("a"))
        known = own if known is None else known.unionByName(own)
    parting = Partitioning(longest, bits, extended, packed(load, bits, budget))
    groups = int(parting.groups.max()) + 1
    leaves = texts.mapInArrow(lambda it: _send_leaves(it, parting, window), LEAVES)
    dealt = leaves.repartitionById(groups, "group").sortWithinPartitions("group", "lang")
    grown = dealt.mapInArrow(lambda it: _grow(it, parting, least), NODES)
    return words, kept(grown if known is None else grown.unionByName(known), "nodes")


def collocations(docs: DataFrame, longest: int = 3, least: int = 10, share: int = 50, top: int = 2000, budget: int = BUDGET, window: int = WINDOW) -> DataFrame:
    """The best ``top`` phrases of 2 to ``longest`` words of each language: lang, rank, phrase, a, l, r, n, score.

    A phrase occurs ``least`` times at least (a) and is scored by its weakest cut into a first part (l times) and a rest
    (r times), floor(1000000 a a / (l r)), ties to the shorter first part. Phrases within a longer one that has ``share`` per
    cent of their occurrences are left out. n is the number of words of the language. Equal scores go by a, then by the
    phrase's bytes.

    Null and empty texts hold no word; a null lang is ``und``; words may be of any length; repeated rows count as often
    as they occur; an empty table gives no rows. ``docs`` may have any other columns, they are not read. A group's leaves
    must fit a task's memory, some 60 bytes an occurrence of ``budget``.
    """
    spark = docs.sparkSession
    words, found = nodes(docs, longest, least, budget, window)
    langs = words.groupBy("lang").agg(F.sum("n").alias("n"))
    size = F.size("path")
    counts = words.where(F.col("n") >= least).select(F.array("id").alias("part"), F.col("n").alias("times")).unionByName(found.select(F.col("path").alias("part"), F.col("a").alias("times")))
    cuts = found.select("lang", "path", "a", F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
    cuts = cuts.withColumns({"first": F.expr("slice(path, 1, k)"), "rest": F.expr("slice(path, k + 1, size(path) - k)")})
    cuts = cuts.join(counts.select(F.col("part").alias("first"), F.col("times").alias("l")), "first")
    cuts = cuts.join(counts.select(F.col("part").alias("rest"), F.col("times").alias("r")), "rest")
    exact = {c: F.col(c).cast("decimal(19,0)") for c in ("a", "l", "r")}
    squared = F.lit(1_000_000).cast("decimal(7,0)") * exact["a"].cast("decimal(15,0)") * exact["a"].cast("decimal(15,0)")
    cuts = cuts.withColumns({"_top": squared, "_under": exact["l"] * exact["r"]}).withColumn("score", F.expr("_top div _under"))
    scored = cuts.groupBy("lang", "path").agg(
        F.first("a").alias("a"), F.min_by(F.struct("l", "r", "score"), F.struct("score", "k")).alias("cut")
    ).select("lang", "path", "a", "cut.*")

    if longest > 2:
        inner = "flatten(transform(sequence(2, size(path) - 1), m -> transform(sequence(1, size(path) - m + 1), s -> slice(path, s, m))))"
        within = found.where(size > 2).select(F.explode(F.expr(inner)).alias("path"), F.col("a").alias("longer"))
        covered = within.groupBy("path").agg(F.max("longer").alias("longer"))
        scored = scored.join(covered, "path", "left").where(F.col("longer").isNull() | (100 * F.col("longer") < share * F.col("a"))).drop("longer")

    # Cut down by numbers before any text is fetched; a language's rows are dealt over salts, so that none is one task's.
    salted = scored.withColumn("_salt", F.pmod(F.xxhash64("path"), F.lit(shuffle_width(spark))))
    by_number = Window.partitionBy("lang", "_salt").orderBy(F.desc("score"), F.desc("a"))
    ahead = kept(salted.withColumn("_rank", F.rank().over(by_number)).where(F.col("_rank") <= top).drop("_rank"), "ranked")
    named = ahead.select("path", F.posexplode("path").alias("at", "id")).join(words.select("id", "word"), "id")
    phrases = named.groupBy("path").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("at", "word"))), lambda w: w["word"]), " ").alias("phrase"))
    told = ahead.join(phrases, "path")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    told = told.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "_salt").orderBy(*order))).where(F.col("rank") <= top)
    told = told.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    return told.join(langs, "lang").select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op13_collocations(spark: SparkSession, folder: str) -> DataFrame:
    """The first 2,000 collocations of two or three words of each language."""
    return collocations(table(spark, folder, "documents"))


ORACLE = r"""
    WITH pieces AS (
        SELECT doc_id, coalesce(lang, 'und') AS lang,
               unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
        FROM documents),
    listed AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM pieces),
    grams AS (
        SELECT lang, m, array_to_string(ws[i : i + m - 1], ' ') AS phrase, ws[i : i + m - 1] AS path
        FROM (SELECT lang, ws, m, unnest(range(1, len(ws) - m + 2)) AS i FROM listed, (SELECT unnest([1, 2, 3]) AS m))),
    f AS (SELECT lang, m, phrase, any_value(path) AS path, count(*) AS a FROM grams GROUP BY lang, m, phrase),
    langs AS (SELECT lang, sum(a)::BIGINT AS n FROM f WHERE m = 1 GROUP BY lang),
    candidates AS (SELECT * FROM f WHERE m > 1 AND a >= 10),
    cuts AS (
        SELECT c.lang, c.m, c.phrase, c.a, k, l.a AS l, r.a AS r,
               ((1000000::HUGEINT * c.a * c.a) // (l.a::HUGEINT * r.a))::BIGINT AS score
        FROM (SELECT *, unnest(range(1, m)) AS k FROM candidates) c
        JOIN f l ON l.lang = c.lang AND l.m = k AND l.phrase = array_to_string(c.path[1 : k], ' ')
        JOIN f r ON r.lang = c.lang AND r.m = c.m - k AND r.phrase = array_to_string(c.path[k + 1 : c.m], ' ')),
    weakest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, m, phrase ORDER BY score, k) = 1),
    covered AS (
        SELECT lang, sub, max(a) AS longer
        FROM (SELECT lang, a, unnest([array_to_string(path[1 : 2], ' '), array_to_string(path[2 : 3], ' ')]) AS sub FROM candidates WHERE m = 3)
        GROUP BY lang, sub),
    left_over AS (
        SELECT w.* FROM weakest w LEFT JOIN covered v ON w.m = 2 AND v.lang = w.lang AND v.sub = w.phrase
        WHERE v.longer IS NULL OR 100 * v.longer < 50 * w.a),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM left_over)
    SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN langs USING (lang) WHERE rank <= 2000"""
