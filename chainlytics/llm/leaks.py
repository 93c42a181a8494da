"""Benchmark decontamination by pigeonhole edit matching.

A test item of m bytes may stand in a text with up to k = RATE % of m edits (insert, delete, replace one byte). Cut into
k + 1 pieces, at least one piece then stands there unchanged, so exact hits of pieces (one automaton over all items) find
every place in question. A place is kept if enough of the item's 4-byte strings occur around it (k edits spoil at most 4k
of them), and is settled by Myers' bit-parallel edit distance, the item's bytes being the bits of one number. Items of
less than ``SHORT`` bytes that may have no edits are found where they stand as whole words.

Texts and items are compared with A-Z lower-cased and runs of white space as one blank. Items are sent to the tasks in
blocks of at most ``BLOCK`` bytes, one pass over the texts a block."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chainlytics.llm.arrays import LOWER, SEPARATOR, parts, ranges
from chainlytics.llm.tables import table

#: Edits in a hundred bytes; bytes an item must have to be looked for; bytes of items sent to the tasks at once.
RATE, LEAST, BLOCK = 10, 1, 8 << 20

#: Items of fewer bytes must begin and end where words do, as ordinary words hold them; bytes that belong to words.
SHORT, LETTERS = 10, frozenset(b"0123456789abcdefghijklmnopqrstuvwxyz") | frozenset(range(0x80, 0x100))

#: Length of the strings counted before the edit distance, width of a band of diagonals seen as one place.
GRAM, BAND = 4, 64

MATCH = "doc_id bigint, item_id bigint, distance int, start bigint, end bigint"


def normal(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes with white space made single, their bounds, and the place each came from."""
    blank = SEPARATOR[data]
    keep = np.ones(len(data), dtype=bool)
    keep[1:] = ~(blank[1:] & blank[:-1])
    keep[bounds[:-1][bounds[:-1] < len(data)]] = True
    at = np.flatnonzero(keep)
    out = LOWER[data[at]]
    out[blank[at]] = 0x20
    return out, np.r_[0, np.cumsum(keep)][bounds], at


def myers(pattern: bytes, text: bytes) -> tuple[int, int]:
    """Smallest edit distance of the pattern to any part of the text, and where the first such part ends."""
    m = len(pattern)
    marks: dict[int, int] = defaultdict(int)
    for k, c in enumerate(pattern):
        marks[c] |= 1 << k
    full, top = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score = full, 0, m
    best, end = m, 0
    get = marks.get
    for at, c in enumerate(text, 1):
        x = get(c, 0) | minus
        d = (((x & plus) + plus) ^ plus) | x
        hp = minus | (full & ~(d | plus))
        hm = plus & d
        if hp & top:
            score += 1
        elif hm & top:
            score -= 1
        hp, hm = (hp << 1) & full, (hm << 1) & full
        y = get(c, 0) | minus
        plus = hm | (full & ~(y | hp))
        minus = hp & y
        if score < best:
            best, end = score, at
    return best, end


def whole_word(item: bytes, text: bytes, first: int, last: int) -> int:
    """Where the item first stands in text[first:last] without a word going on before or after it, or -1."""
    at = text.find(item, first, last)
    while at >= 0:
        end = at + len(item)
        inside = at > 0 and text[at - 1] in LETTERS and item[0] in LETTERS
        if not inside and not (end < len(text) and text[end] in LETTERS and item[-1] in LETTERS):
            return at
        at = text.find(item, at + 1, last)
    return -1


class Items:
    """Normalised items, their budgets, and the automaton of their pieces; built where it is used."""

    def __init__(self, rows: list[tuple[int, str]], rate: int = RATE, least: int = LEAST):
        self.ids, self.texts, self.budgets = [], [], []
        for key, text in rows:
            raw = np.frombuffer((text or "").encode("utf-8"), dtype=np.uint8)
            own = normal(raw, np.array([0, len(raw)]))[0].tobytes().strip(b" ")
            if len(own) >= least:
                self.ids.append(key)
                self.texts.append(own)
                self.budgets.append(len(own) * rate // 100)
        pieces = defaultdict(list)
        for n, (own, budget) in enumerate(zip(self.texts, self.budgets)):
            cuts = [len(own) * j // (budget + 1) for j in range(budget + 2)]
            for a, b in zip(cuts[:-1], cuts[1:]):
                pieces[own[a:b].decode("latin-1")].append((n, a))
        self.automaton = None
        if pieces:
            import ahocorasick

            self.automaton = ahocorasick.Automaton()
            for piece, places in pieces.items():
                self.automaton.add_word(piece, (len(piece), places))
            self.automaton.make_automaton()

    def candidates(self, text: str) -> set[tuple[int, int]]:
        """(item, band of diagonals) of all piece hits."""
        found = set()
        for end, (size, places) in self.automaton.iter(text):
            for n, a in places:
                found.add((n, (end + 1 - size - a) // BAND))
        return found

    def search(self, data: np.ndarray, bounds: np.ndarray) -> list[tuple[int, int, int, int, int]]:
        """(text, item, distance, start, end) of the best place of each item in each text; offsets are bytes of the text."""
        if self.automaton is None or len(data) == 0:
            return []
        norm, edges, origin = normal(data, bounds)
        whole = norm.tobytes().decode("latin-1")
        by_item = defaultdict(list)
        for t in range(len(bounds) - 1):
            a, b = int(edges[t]), int(edges[t + 1])
            for n, band in self.candidates(whole[a:b]) if b > a else ():
                size, budget = len(self.texts[n]), self.budgets[n]
                first = max(a, a + band * BAND - budget)
                last = min(b, a + band * BAND + BAND + size + budget)
                if last - first >= size - budget:
                    by_item[n].append((t, first, last))
        grams = _grams(norm)
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        for n, places in by_item.items():
            item, budget = self.texts[n], self.budgets[n]
            mark = np.zeros(1 << 16, dtype=bool)
            mark[_grams(np.frombuffer(item, dtype=np.uint8))] = True
            need = len(item) - GRAM + 1 - GRAM * budget
            at = np.array(places, dtype=np.int64)
            sizes = at[:, 2] - at[:, 1] - GRAM + 1
            seen = mark[grams[ranges(at[:, 1], np.maximum(sizes, 0))]]
            held = np.r_[0, np.cumsum(seen)]
            ends = np.cumsum(np.maximum(sizes, 0))
            enough = held[ends] - held[ends - np.maximum(sizes, 0)] >= need
            for t, first, last in at[enough].tolist():
                if budget == 0 and len(item) < SHORT:
                    a, b = int(edges[t]), int(edges[t + 1])
                    before = max(a, first - 1)
                    place = whole_word(item, norm[before : min(b, last + 1)].tobytes(), first - before, last - before)
                    found = (0, before + place, before + place + len(item))
                    if place >= 0 and ((t, n) not in best or found < best[t, n]):
                        best[t, n] = found
                    continue
                window = norm[first:last].tobytes()
                distance, end = myers(item, window)
                if distance > budget:
                    continue
                _, back = myers(item[::-1], window[:end][::-1])
                found = (distance, first + end - back, first + end)
                if (t, n) not in best or found < best[t, n]:
                    best[t, n] = found
        return [(t, n, d, int(origin[a] - bounds[t]), int(origin[b - 1] + 1 - bounds[t])) for (t, n), (d, a, b) in sorted(best.items())]


def _grams(data: np.ndarray) -> np.ndarray:
    """16-bit hashes of all strings of GRAM bytes."""
    n = len(data) - GRAM + 1
    if n <= 0:
        return np.zeros(0, dtype=np.int64)
    code = np.zeros(n, dtype=np.uint32)
    for k in range(GRAM):
        code |= data[k : k + n].astype(np.uint32) << np.uint32(8 * k)
    return ((code * np.uint32(0x9E3779B1)) >> np.uint32(16)).astype(np.int64)


def _matches(batches: Iterator[pa.RecordBatch], rows: list, rate: int, least: int) -> Iterator[pa.RecordBatch]:
    items = Items(rows, rate, least)
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64()]
    for batch in batches:
        for own, data, bounds in parts(batch):
            ids = own.column("doc_id").to_pylist()
            out = [(ids[t], items.ids[n], d, a, b) for t, n, d, a, b in items.search(data, bounds)]
            columns = zip(*out) if out else [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names=[f.split()[0] for f in MATCH.split(", ")])


def _clean(batches: Iterator[pa.RecordBatch], rows: list, rate: int, least: int) -> Iterator[pa.RecordBatch]:
    items = Items(rows, rate, least)
    for batch in batches:
        for own, data, bounds in parts(batch):
            dirty = np.zeros(own.num_rows, dtype=bool)
            dirty[[t for t, *_ in items.search(data, bounds)]] = True
            yield own.filter(pa.array(~dirty))


def blocks(benchmark: DataFrame) -> Iterator[list[tuple[int, str]]]:
    """The items in lists of about BLOCK bytes at most (one longer item is a list)."""
    rows = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), "text").where("text is not null")
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = 1 + 2 * total // BLOCK
    for k in range(count):
        yield [tuple(r) for r in rows.where(F.pmod(F.xxhash64("text", "item_id"), F.lit(count)) == k).orderBy("item_id", "text").collect()]


def matches(docs: DataFrame, benchmark: DataFrame, rate: int = RATE, least: int = LEAST) -> DataFrame:
    """(doc_id, item_id, distance, start, end): the best place of each item in each row's whole text, as byte offsets.

    Null and empty texts match nothing; null and empty items, and items of less than ``least`` bytes, are not looked
    for; items of less than ``SHORT`` bytes are, as whole words. Repeated rows and repeated items are reported each; rows without a doc_id and items without an
    item_id are reported with null. Without texts or items the result is empty. Other columns are not read."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    out = None
    for block in blocks(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(block)
        found = rows.mapInArrow(lambda it, s=shared: _matches(it, s.value, rate, least), MATCH)
        out = found if out is None else out.unionByName(found)
    return out


def clean(docs: DataFrame, benchmark: DataFrame, rate: int = RATE, least: int = LEAST) -> DataFrame:
    """``docs`` without the rows that hold an item; all columns, otherwise as ``matches``."""
    for block in blocks(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(block)
        docs = docs.mapInArrow(lambda it, s=shared: _clean(it, s.value, rate, least), docs.schema)
    return docs


def op4_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    """Benchmark items found in documents."""
    return matches(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
