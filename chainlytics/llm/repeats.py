"""Removal of every byte that a repeated string of ``LENGTH`` bytes covers, by suffix arrays over shards.

Not every place of the corpus needs sorting. Each window of LENGTH bytes has an anchor: the place of its smallest
GRAM-byte hash. Equal windows have equal anchors at equal places, so a window can only be repeated by one whose anchor has
the same hash. Neighbouring windows share an anchor and travel as one stretch (some 290 bytes a stretch, one a 90 bytes),
first only as two hashes: of the anchor and of the whole stretch.

* An anchor that occurs once: none of its windows is repeated.
* Equal stretches: all their windows are repeated, nothing needs comparing.
* Different stretches with one anchor: one of each kind is fetched. A shard takes anchors until ``SHARD`` bytes are reached
  and sorts the suffixes of its stretches by Larsson-Sadakane refinement (ranks by 8 bytes, then doubled; only groups not
  yet told apart are sorted again). Kasai's common prefixes follow in text order: where the byte before a suffix equals
  the one before its neighbour the prefix is one shorter than the last one, elsewhere it is compared. A window is repeated
  if its suffix shares LENGTH bytes with a neighbour in the order.
* An anchor with more stretches than a shard holds is dealt to several shards. Their windows, as sorted hashes of LENGTH
  bytes, are merged across shards by binary search, dealt by ranges of the hash.

Hashes are 64-bit; strings in one shard are compared byte by byte."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chainlytics.llm.arrays import between, mix, parts, prefix_hash, ranges
from chainlytics.llm.bitmap import bitmap, only
from chainlytics.llm.tables import kept, table
from chainlytics.session import shuffle_width

#: Bytes of a repeated string, bytes an anchor is chosen by.
LENGTH, GRAM = 200, 24

#: Bytes of a shard's stretches, and stretches of one anchor in a shard.
SHARD, MOST = 400_000, 4_096

KEY = "__text_key"
STRETCH = "bucket int, anchors binary, stretches binary, texts binary, keys binary, starts binary, counts binary, leads binary"
FOUND = "kind int, key bigint, start bigint, end bigint, anchor bigint, stretch bigint, windows int, lead int, kinds int, alone boolean"


def anchors(data: np.ndarray, bounds: np.ndarray, length: int = LENGTH):
    """Stretches of the texts: (text, first window, number of windows, place of the anchor), in order of their places."""
    none = np.zeros(0, dtype=np.int64)
    sizes = np.diff(bounds)
    long = np.flatnonzero(sizes >= length)
    if len(long) == 0:
        return none, none, none, none, None
    sums = prefix_hash(data)
    width = length - GRAM + 1
    n = len(data) - GRAM + 1
    at = np.arange(n)
    # The upper half of the hash decides, then the place.
    packed = (between(sums, at, at + GRAM) & np.uint64(0xFFFFFFFF00000000)) | at.astype(np.uint64)
    rows = -(-n // width)
    grid = np.full(rows * width, np.uint64(0xFFFFFFFFFFFFFFFF))
    grid[:n] = packed
    grid = grid.reshape(rows, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    windows = ranges(bounds[:-1][long], sizes[long] - length + 1)
    least = np.minimum(behind[windows], ahead[windows + width - 1])
    place = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    text = np.repeat(long, sizes[long] - length + 1)
    first = np.flatnonzero(np.r_[True, (place[1:] != place[:-1]) | (text[1:] != text[:-1])])
    return text[first], windows[first], np.diff(np.r_[first, len(windows)]), place[first], sums


def _send(batches: Iterator[pa.RecordBatch], buckets: int, length: int) -> Iterator[pa.RecordBatch]:
    names = [f.split()[0] for f in STRETCH.split(", ")]
    kinds = [pa.int32(), *[pa.binary()] * 7]
    for batch in batches:
        for rows, data, bounds in parts(batch):
            text, start, count, place, sums = anchors(data, bounds, length)
            if len(text) == 0:
                continue
            keys = np.asarray(rows.column(KEY).to_numpy(zero_copy_only=False), dtype=np.int64)
            # Anchors have the smallest hashes around; mixed once more they are spread evenly again.
            anchor = mix(between(sums, place, place + GRAM))
            stretch = mix(between(sums, start, start + count + length - 1) + (place - start).astype(np.uint64))
            order = np.argsort(anchor, kind="stable")
            to = ((anchor[order] >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
            cuts = np.searchsorted(to, np.arange(buckets + 1, dtype=np.uint64))
            out = []
            for b in np.flatnonzero(np.diff(cuts)).tolist():
                own = order[cuts[b] : cuts[b + 1]]
                used, local = np.unique(text[own], return_inverse=True)
                out.append(
                    [b, anchor[own].tobytes(), stretch[own].tobytes(), local.astype(np.uint16).tobytes(), keys[used].tobytes()]
                    + [(start[own] - bounds[text[own]]).astype(np.uint32).tobytes(), count[own].astype(np.uint16).tobytes(), (place - start)[own].astype(np.uint16).tobytes()]
                )
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*out), kinds)], names=names)


def _found(**columns) -> pa.RecordBatch:
    n = len(next(iter(columns.values())))
    kinds = {"kind": pa.int32(), "windows": pa.int32(), "lead": pa.int32(), "kinds": pa.int32(), "alone": pa.bool_()}
    arrays, names = [], []
    for field in FOUND.split(", "):
        name = field.split()[0]
        kind = kinds.get(name, pa.int64())
        value = columns.get(name)
        arrays.append(pa.nulls(n, kind) if value is None else pa.array(np.asarray(value), kind))
        names.append(name)
    return pa.RecordBatch.from_arrays(arrays, names=names)


def _pair(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Repeated stretches as byte ranges of texts (kind 0); one of each kind of stretch of anchors with several (kind 1)."""
    columns: list[list] = [[] for _ in range(6)]
    for batch in batches:
        for row in batch.to_pylist():
            keys = np.frombuffer(row["keys"], dtype=np.int64)
            for column, value in zip(
                columns,
                (np.frombuffer(row["anchors"], dtype=np.uint64), np.frombuffer(row["stretches"], dtype=np.uint64), keys[np.frombuffer(row["texts"], dtype=np.uint16)])
                + tuple(np.frombuffer(row[c], dtype=t) for c, t in (("starts", np.uint32), ("counts", np.uint16), ("leads", np.uint16))),
            ):
                column.append(value)
    if not columns[0]:
        return
    anchor, stretch, key, start, count, lead = (np.concatenate(c) for c in columns)
    del columns
    order = np.lexsort((stretch, anchor))
    anchor, stretch, key, start, count, lead = anchor[order], stretch[order], key[order], start[order].astype(np.int64), count[order].astype(np.int64), lead[order]
    fresh = np.flatnonzero(np.r_[True, (anchor[1:] != anchor[:-1]) | (stretch[1:] != stretch[:-1])])
    times = np.diff(np.r_[fresh, len(anchor)])
    again = np.repeat(times > 1, times)
    for k in range(0, len(anchor), 100_000):
        own = np.flatnonzero(again[k : k + 100_000]) + k
        if len(own):
            yield _found(kind=np.zeros(len(own), dtype=np.int32), key=key[own], start=start[own], end=start[own] + count[own] + length - 1)
    edges = np.flatnonzero(np.r_[True, anchor[fresh][1:] != anchor[fresh][:-1]])
    kinds = np.diff(np.r_[edges, len(fresh)])
    alone = np.add.reduceat((times == 1).astype(np.int64), edges) > 0
    mixed = np.repeat((kinds > 1) & alone, kinds)
    kinds = np.repeat(kinds, kinds)
    ask, kinds, single = fresh[mixed], kinds[mixed], times[mixed] == 1
    for k in range(0, len(ask), 100_000):
        own = ask[k : k + 100_000]
        yield _found(
            kind=np.ones(len(own), dtype=np.int32), key=key[own], start=start[own], anchor=anchor[own].view(np.int64), stretch=stretch[own].view(np.int64),
            windows=count[own].astype(np.int32), lead=lead[own].astype(np.int32), kinds=kinds[k : k + 100_000].astype(np.int32), alone=single[k : k + 100_000],
        )


PIECE = "anchor bigint, salt int, kinds int, key bigint, start bigint, windows int, alone boolean, piece binary"


def _fetch(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Rows (key, text, asked stretches) to the bytes of each stretch."""
    names = [f.split()[0] for f in PIECE.split(", ")]
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.binary()]
    for batch in batches:
        for rows, data, bounds in parts(batch):
            out = []
            for n, (key, asked) in enumerate(zip(rows.column(KEY).to_pylist(), rows.column("asked").to_pylist())):
                for a in asked:
                    s = int(bounds[n]) + a["start"]
                    out.append((a["anchor"], a["salt"], a["kinds"], key, a["start"], a["windows"], a["alone"], data[s : s + a["windows"] + length - 1].tobytes()))
                if len(out) >= 2_000 or n + 1 == rows.num_rows and out:
                    yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*out), kinds)], names=names)
                    out = []


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Order of all suffixes, by Larsson-Sadakane refinement."""
    n = len(text)
    wide = np.zeros(n + 8, dtype=np.uint64)
    wide[:n] = text
    key = np.zeros(n, dtype=np.uint64)
    for k in range(8):
        key |= wide[k : k + n] << np.uint64(8 * (7 - k))
    order = np.argsort(key).astype(np.int32)
    ordered = key[order]
    # Suffixes shorter than 8 bytes were filled up with zeros; equal ones are told apart by their length, shorter first.
    size = np.minimum(n - order, 8)
    if n:
        alike = np.flatnonzero(np.isin(ordered, key[max(0, n - 7) :]))
        order[alike] = order[alike][np.lexsort((size[alike], ordered[alike]))]
        size = np.minimum(n - order, 8)
    fresh = np.ones(n, dtype=bool)
    fresh[1:] = (ordered[1:] != ordered[:-1]) | (size[1:] != size[:-1])
    del key, wide
    place = np.arange(n, dtype=np.int32)
    # Ranks count from 1; 0 stands for what lies past the end.
    rank = np.zeros(n + 1, dtype=np.int32)
    rank[order] = np.maximum.accumulate(np.where(fresh, place, 0)) + 1
    step = 8
    while True:
        single = fresh.copy()
        single[:-1] &= fresh[1:]
        open_at = np.flatnonzero(~single).astype(np.int32)
        if len(open_at) == 0:
            return order
        own = order[open_at]
        pair = rank[own].astype(np.uint64) << np.uint64(32) | rank[np.minimum(own + step, n)].astype(np.uint64)
        within = np.argsort(pair)
        own, pair = own[within], pair[within]
        order[open_at] = own
        new = np.ones(len(own), dtype=bool)
        new[1:] = pair[1:] != pair[:-1]
        fresh[open_at] = new
        rank[own] = np.maximum.accumulate(np.where(new, open_at, 0)) + 1
        step *= 2


def common_prefixes(text: np.ndarray, order: np.ndarray) -> np.ndarray:
    """For each place in the order, the common prefix with the suffix before it (0 for the first): Kasai's rule, all at once.

    In text order a suffix shares at least one byte less with its neighbour than the one before it did. It shares exactly
    that where the bytes before the two suffixes are equal; the other places are compared, 8 bytes at a time."""
    n = len(order)
    neighbour = np.full(n, -1, dtype=np.int64)
    neighbour[order[1:]] = order[:-1]
    here = np.arange(n)
    follows = (here > 0) & (neighbour > 0)
    follows[follows] = (text[here[follows] - 1] == text[neighbour[follows] - 1]) & (neighbour[here[follows] - 1] == neighbour[follows] - 1)
    shared = np.zeros(n, dtype=np.int64)
    wide = np.zeros(n + 8, dtype=np.uint64)
    wide[:n] = text
    word = np.zeros(n + 1, dtype=np.uint64)
    for k in range(8):
        word[:n] |= wide[k : k + n] << np.uint64(8 * k)
    at = np.flatnonzero(~follows & (neighbour >= 0))
    size = np.zeros(len(at), dtype=np.int64)
    live = np.arange(len(at))
    while len(live):
        a, b = at[live] + size[live], neighbour[at[live]] + size[live]
        room = np.minimum(n - a, n - b)
        differ = word[np.minimum(a, n)] ^ word[np.minimum(b, n)]
        low = differ & (~differ + np.uint64(1))
        same = np.where(differ == 0, 8, np.floor(np.log2(np.maximum(low, 1).astype(np.float64))).astype(np.int64) // 8)
        size[live] += np.minimum(same, room)
        live = live[(same == 8) & (room > 8)]
    shared[at] = size
    base = np.where(follows, -1, here)
    last = np.maximum.accumulate(base)
    shared = np.maximum(shared[last] - (here - last), 0)
    shared[neighbour < 0] = 0
    return shared[order]


def repeated_windows(pieces: list[bytes], counts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the first ``counts`` windows of each piece: (piece, window, whether another window of the shard is equal)."""
    sizes = np.array([len(p) for p in pieces], dtype=np.int64) + 1
    text = np.frombuffer(b"\xff".join(pieces) + b"\xff", dtype=np.uint8)  # a byte that no UTF-8 text has
    starts = np.cumsum(sizes) - sizes
    order = suffix_array(text)
    shared = common_prefixes(text, order)
    most = np.maximum(shared, np.r_[shared[1:], 0])
    by_place = np.zeros(len(text), dtype=bool)
    by_place[order] = most >= length
    piece = np.repeat(np.arange(len(pieces)), counts)
    window = ranges(np.zeros(len(pieces), dtype=np.int64), counts)
    return piece, window, by_place[starts[piece] + window]


RESULT = "key bigint, start bigint, end bigint, anchor bigint, salt int, hashes binary, owners binary"


def _sort_shards(batches: Iterator[pa.RecordBatch], length: int, most: int, shard: int) -> Iterator[pa.RecordBatch]:
    """Rows of PIECE, sorted by (anchor, salt), to byte ranges; anchors in several shards also give their windows."""
    names = [f.split()[0] for f in RESULT.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary()]
    held: list[tuple] = []
    size, at = 0, None

    def done():
        counts = np.array([h[5] for h in held], dtype=np.int64)
        piece, window, again = repeated_windows([h[7] for h in held], counts, length)
        alone = np.array([h[6] for h in held])
        out = []
        hit = again & alone[piece]
        edges = np.flatnonzero(hit & ~np.r_[False, hit[:-1] & (piece[1:] == piece[:-1])])
        stops = np.flatnonzero(hit & ~np.r_[hit[1:] & (piece[1:] == piece[:-1]), False])
        for a, b in zip(edges.tolist(), stops.tolist()):
            h = held[piece[a]]
            out.append((h[3], h[4] + int(window[a]), h[4] + int(window[b]) + length, None, None, None, None))
        shared = [n for n, h in enumerate(held) if h[2] > most]
        if shared:
            anchor, salt = held[shared[0]][:2]
            first = np.cumsum(counts) - counts
            hashes, owners = [], []
            for n in shared:
                raw = np.frombuffer(held[n][7], dtype=np.uint8)
                w = np.arange(held[n][5])
                hashes.append(between(prefix_hash(raw), w, w + length))
                # Only windows with no equal in their own shard wait for an answer of the others.
                asks = alone[n] & ~again[first[n] : first[n] + len(w)]
                owners.append(np.c_[np.full(len(w), held[n][3]), held[n][4] + w, asks])
            own, at = np.unique(np.concatenate(hashes), return_index=True)
            out.append((None, None, None, anchor, salt, own.tobytes(), np.concatenate(owners).astype(np.int64)[at].tobytes()))
        if out:
            return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*out), kinds)], names=names)
        return None

    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in (f.split()[0] for f in PIECE.split(", ")))):
            if row[:2] != at and held and (size >= shard or row[2] > most or held[0][2] > most):
                if (found := done()) is not None:
                    yield found
                held, size = [], 0
            at = row[:2]
            held.append(row)
            size += len(row[7]) + 1
    if held and (found := done()) is not None:
        yield found


CROSS = "bucket int, salt int, hashes binary, owners binary"


def _deal(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """A shard's windows, sorted and cut into ranges of the hash."""
    for batch in batches:
        out = []
        for salt, hashes, owners in zip(*(batch.column(c).to_pylist() for c in ("salt", "hashes", "owners"))):
            h = np.frombuffer(hashes, dtype=np.uint64)
            own = np.frombuffer(owners, dtype=np.int64).reshape(-1, 3)
            order = np.argsort(h, kind="stable")
            h, own = h[order], own[order]
            cuts = np.searchsorted(((h >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32), np.arange(buckets + 1, dtype=np.uint64))
            out += [(b, salt, h[cuts[b] : cuts[b + 1]].tobytes(), own[cuts[b] : cuts[b + 1]].tobytes()) for b in np.flatnonzero(np.diff(cuts)).tolist()]
        yield pa.RecordBatch.from_arrays([pa.array([o[c] for o in out], k) for c, k in enumerate((pa.int32(), pa.int32(), pa.binary(), pa.binary()))], names=["bucket", "salt", "hashes", "owners"])


def _merge(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Windows that occur in several runs, found by binary search of each run in the others of the same range."""
    runs = []
    for batch in batches:
        runs += [(b, np.frombuffer(h, dtype=np.uint64), np.frombuffer(o, dtype=np.int64).reshape(-1, 3)) for b, h, o in zip(*(batch.column(c).to_pylist() for c in ("bucket", "hashes", "owners")))]
    runs.sort(key=lambda r: r[0])
    for n in range(len(runs)):
        if n and runs[n][0] == runs[n - 1][0]:
            continue
        group = [r for r in runs[n:] if r[0] == runs[n][0]]
        merged = np.sort(np.concatenate([h for _, h, _ in group]), kind="stable")
        for _, h, own in group:
            twice = np.searchsorted(merged, h, side="right") - np.searchsorted(merged, h, side="left") > 1
            hit = own[twice & (own[:, 2] == 1)]
            if len(hit):
                yield pa.RecordBatch.from_arrays([pa.array(hit[:, 0]), pa.array(hit[:, 1]), pa.array(hit[:, 1] + length)], names=["key", "start", "end"])


def _unite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ranges of a text, in any order, to its maximal runs."""
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    for batch in batches:
        out = []
        for found in batch.column("found").to_pylist():
            runs: list[dict] = []
            for r in sorted(found, key=lambda r: r["start"]):
                if runs and r["start"] <= runs[-1]["end"]:
                    runs[-1]["end"] = max(runs[-1]["end"], r["end"])
                else:
                    runs.append(dict(r))
            out.append(runs)
        yield pa.RecordBatch.from_arrays([batch.column(KEY), pa.array(out, kind)], names=[KEY, "spans"])


def marked(docs: DataFrame, length: int = LENGTH, most: int = MOST, shard: int = SHARD) -> DataFrame:
    """``docs`` with a column spans: the maximal runs (start, end: bytes of the UTF-8 text) that repeated strings of
    ``length`` bytes cover, in order; an empty list where there are none.

    A string is repeated if it also starts anywhere else, in the same or any other row. Strings do not cross rows. Null and
    empty texts, and texts shorter than ``length`` bytes, have no spans. Repeated rows repeat each other's text, so all of a
    text of at least ``length`` bytes is marked in each. Rows without a doc_id take part. An empty table gives an empty
    result. A column named spans is replaced; other columns stay."""
    spark = docs.sparkSession
    width = shuffle_width(spark)
    base = docs.drop("spans")
    # Rows of one id and text have the same spans, so a hash of both names them.
    rows = base.withColumn(KEY, F.xxhash64("doc_id", "text"))
    texts = rows.select(KEY, "text")
    sent = texts.mapInArrow(lambda it: _send(it, width, length), STRETCH).repartition(width, "bucket")
    found = kept(sent.mapInArrow(lambda it: _pair(it, length), FOUND), "stretches")

    salt = F.when(F.col("kinds") > most, F.pmod(F.xxhash64("stretch"), F.ceil(F.col("kinds") / (most // 2)))).otherwise(0).cast("int")
    asked = found.where("kind = 1").withColumn("salt", salt).groupBy(F.col("key").alias(KEY)).agg(F.collect_list(F.struct("anchor", "salt", "kinds", "start", "windows", "alone")).alias("asked"))
    asked = kept(asked, "asked")
    wanted = spark.sparkContext.broadcast(bitmap(asked, KEY))
    near = texts.mapInArrow(lambda it: only(it, wanted.value, KEY, True), texts.schema)
    single = near.groupBy(KEY).agg(F.first("text").alias("text"))
    pieces = single.join(asked.hint("merge"), KEY).mapInArrow(lambda it: _fetch(it, length), PIECE)
    dealt = pieces.repartition(width, "anchor", "salt").sortWithinPartitions("anchor", "salt")
    sorted_shards = kept(dealt.mapInArrow(lambda it: _sort_shards(it, length, most, shard), RESULT), "shards")

    across = sorted_shards.where("hashes is not null").select("salt", "hashes", "owners")
    crossed = across.mapInArrow(lambda it: _deal(it, width), CROSS).repartition(width, "bucket").mapInArrow(lambda it: _merge(it, length), "key bigint, start bigint, end bigint")
    covered = found.where("kind = 0").select("key", "start", "end").unionByName(sorted_shards.where("key is not null").select("key", "start", "end")).unionByName(crossed)
    by_text = covered.groupBy(F.col("key").alias(KEY)).agg(F.collect_list(F.struct("start", "end")).alias("found"))
    spans = kept(by_text.mapInArrow(_unite, f"{KEY} bigint, spans array<struct<start:bigint,end:bigint>>"), "spans")

    hit = spark.sparkContext.broadcast(bitmap(spans, KEY))
    none = F.from_json(F.lit("[]"), "array<struct<start:bigint,end:bigint>>")
    clear = rows.mapInArrow(lambda it: only(it, hit.value, KEY, False), rows.schema).withColumn("spans", none)
    touched = rows.mapInArrow(lambda it: only(it, hit.value, KEY, True), rows.schema).join(spans.hint("merge"), KEY, "left").withColumn("spans", F.coalesce("spans", none))
    return clear.select(*base.columns, "spans").unionByName(touched.select(*base.columns, "spans"))


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows, data, bounds in parts(batch):
            raw, out = data.tobytes(), []
            for n, spans in enumerate(rows.column("spans").to_pylist()):
                a, b = int(bounds[n]), int(bounds[n + 1])
                digest, at, gone = hashlib.sha256(), a, 0
                for s in spans:
                    digest.update(raw[at : a + s["start"]])
                    at = a + s["end"]
                    gone += s["end"] - s["start"]
                digest.update(raw[at:b])
                out.append((b - a, gone, len(spans), digest.hexdigest()))
            columns = list(zip(*out))
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), *(pa.array(c, pa.int64()) for c in columns[:3]), pa.array(columns[3], pa.string())], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def digests(spans: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of rows with text and spans."""
    return spans.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", "spans").mapInArrow(_digest, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string")


def _cut(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows, data, bounds in parts(batch):
            raw, out = data.tobytes(), []
            for n, spans in enumerate(rows.column("spans").to_pylist()):
                a, b = int(bounds[n]), int(bounds[n + 1])
                left, at = [], a
                for s in spans:
                    # A character that is cut in two goes as a whole.
                    first, last = a + s["start"], a + s["end"]
                    while first > at and first < b and raw[first] & 0xC0 == 0x80:
                        first -= 1
                    while last < b and raw[last] & 0xC0 == 0x80:
                        last += 1
                    left.append(raw[at:first])
                    at = last
                out.append(b"".join([*left, raw[at:b]]).decode("utf-8") if spans else rows.column("text")[n].as_py())
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string()) if c == "text" else rows.column(c) for c in names], names=names)


def without_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``docs`` with the marked bytes taken out of text; a character that is only partly marked goes as a whole."""
    found = marked(docs, length)
    names = [c for c in found.columns if c != "spans"]
    return found.mapInArrow(lambda it: _cut(it, names), found.select(*[f"`{c}`" for c in names]).schema)


def op6_repeats(spark: SparkSession, folder: str) -> DataFrame:
    """Repeated 200-byte strings over all documents."""
    return digests(marked(table(spark, folder, "documents").select("doc_id", "text")))
