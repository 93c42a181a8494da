"""Byte-pair encoding with word ends, and decoding; long unsplit words by tree concatenation.

A text is normalised and split into words as the tokenizer does it; a distinct word is merged once per task by the
tokenizer's model. A word longer than ``LONG`` characters has no place where merges surely stop, so it is cut in halves,
and those again, down to ``SEGMENT`` characters. Segments are rows of their own and are merged by any task. Going up the
tree, the two token lists of a cut are joined: tokens next to the cut are taken back, a few at first and twice as many each
time, and their characters are merged anew, until the new tokens agree with the kept ones on both sides. They agree if
each pair of neighbours over the seam, merged by itself, gives just that pair; a sequence in which every pair of
neighbours does so is the one the merges give for the whole word, so the result is exact."""

from __future__ import annotations

import gc
import hashlib
import json
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chainlytics.llm.arrays import give_back, parts
from chainlytics.llm.tables import kept, table
from chainlytics.llm.tokens import LETTER, NUMBER, SPACE, byte_characters, load, plain
from chainlytics.session import shuffle_width

#: Characters of a word from which on it is cut, and the most of a segment.
LONG, SEGMENT = 8_192, 4_096

#: Most bytes that one character of a text has when it is normalised (musical notes with a flag: three characters of four).
WIDEST = 12

#: Longest word that a task keeps the ids of, and most words it keeps; when full it starts anew.
MEMO_CHARS, MEMO_WORDS = 48, 500_000

#: The word pattern for lower-cased text up to U+017F; alternatives that exclude each other by their first characters are
#: put in order of frequency.
WORD = re.compile(rf"[{LETTER}]+|'s|'t|'re|'ve|'m|'ll|'d|[{NUMBER}]|[^{SPACE}{LETTER}{NUMBER}]+")

CODED = "row bigint, doc_id bigint, ids array<int>, word int, segment int, place int, piece string"


class Coder:
    """A tokenizer file with a memo of words. ``split`` and ``merge`` work on characters that stand for bytes."""

    def __init__(self, path: str):
        from tokenizers.models import BPE

        self.tokenizer = load(path)
        self.ending = self.tokenizer.model
        text = json.loads(self.tokenizer.to_str())
        model = text["model"]
        self.suffix = model.get("end_of_word_suffix") or ""
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        #: The same merges for a segment that does not end its word.
        self.inner = BPE(vocab=model["vocab"], merges=merges) if self.suffix else self.ending
        self.names = {i: t for t, i in model["vocab"].items()}
        self.special = {t["content"]: t["id"] for t in text["added_tokens"]}
        self.at_special = re.compile("(" + "|".join(re.escape(t) for t in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None
        self.characters = byte_characters()
        self.memo: Words = Words(self)

    def split(self, text: str) -> list:
        """Words of a text in byte characters; special tokens as their ids."""
        out = []
        for k, section in enumerate(self.at_special.split(text) if self.at_special else [text]):
            if k % 2:
                out.append(self.special[section])
            elif section:
                out += [w for w, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(self.tokenizer.normalizer.normalize_str(section))]
        return out

    def merge(self, piece: str, ends: bool = True) -> list[int]:
        return [t.id for t in (self.ending if ends else self.inner).tokenize(piece)]

    def characters_of(self, ids) -> str:
        joined = "".join(self.names[i] for i in ids)
        return joined[: -len(self.suffix)] if self.suffix and joined.endswith(self.suffix) and self.names[ids[-1]].endswith(self.suffix) else joined

    def agree(self, left: int, right: int, ends: bool) -> bool:
        return self.merge(self.characters_of([left]) + self.characters_of([right]), ends) == [left, right]

    def join(self, left: list[int], right: list[int], ends: bool) -> list[int]:
        """The ids of a word's two halves put together; ``ends``: the right half ends the word."""
        if not left or not right:
            return left + right
        take = 1
        while True:
            i, j = min(take, len(left)), min(take, len(right))
            last = ends and j == len(right)
            fresh = self.merge(self.characters_of(left[-i:]) + self.characters_of(right[:j]), last)
            before = i == len(left) or self.agree(left[-i - 1], fresh[0], last and len(fresh) == 1)
            after = j == len(right) or self.agree(fresh[-1], right[j], ends and j + 1 == len(right))
            if before and after:
                return left[:-i] + fresh + right[j:]
            take *= 2

    def tree(self, halves: list[list[int]], ends: bool = True) -> list[int]:
        """Segments of a word, merged each by itself, joined two by two."""
        if len(halves) <= 1:
            return halves[0] if halves else []
        middle = len(halves) // 2
        return self.join(self.tree(halves[:middle], False), self.tree(halves[middle:], ends), ends)


class Words(dict):
    """Word -> its ids as little-endian 32-bit integers. Keys are words of lower-cased plain text."""

    def __init__(self, coder: Coder):
        super().__init__()
        self.coder = coder

    def __missing__(self, word: str) -> bytes:
        plain_word = word.isascii() and word.isalnum()
        ids = array("I", self.coder.merge(word if plain_word else word.encode("utf-8").decode("latin-1").translate(self.coder.characters))).tobytes()
        if len(word) <= MEMO_CHARS:
            if len(self) >= MEMO_WORDS:
                self.clear()
            self[word] = ids
        return ids


#: The tokenizers and memos of a task.
_coders: dict[str, Coder] = {}


def coder_of(path: str) -> Coder:
    if path not in _coders:
        _coders[path] = Coder(path)
    return _coders[path]


def _forget() -> None:
    """Give back the tokenizers and memos of a task: Spark's Python workers outlive it, and later stages need the memory."""
    _coders.clear()
    gc.collect()
    give_back()


def segments(word: str, size: int = SEGMENT) -> list[str]:
    """A word cut in halves, and those again, until none is longer than ``size``."""
    if len(word) <= size:
        return [word]
    middle = len(word) // 2
    return segments(word[:middle], size) + segments(word[middle:], size)


def _encode(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    """Rows of CODED: every text with the ids of its words, long ones left out; segments of long words as further rows
    with the place in the text's ids where their word belongs."""
    coder, row = coder_of(path), TaskContext.get().partitionId() << 33
    words = coder.memo
    for batch in batches:
        for rows, _, _ in parts(batch):
            keys, found, extra = [], [], []
            for doc, text in zip(rows.column("doc_id").to_pylist(), rows.column("text").to_pylist()):
                text = text or ""
                easy = plain(text)
                pieces = WORD.findall(text.lower()) if easy else coder.split(text)
                if len(text) > LONG // 4 and any(not isinstance(p, int) and len(p) > LONG // 4 for p in pieces):
                    raw, count = bytearray(), 0
                    for p in pieces:
                        mapped = p if not easy else p.encode("utf-8").decode("latin-1").translate(coder.characters)
                        if not isinstance(p, int) and len(mapped) > LONG:
                            extra += [(row, doc, count, k, len(raw) // 4, s) for k, s in enumerate(segments(mapped))]
                            count += 1
                        else:
                            raw += array("I", [p] if isinstance(p, int) else coder.merge(mapped)).tobytes()
                    found.append(bytes(raw))
                elif easy:
                    found.append(b"".join(map(words.__getitem__, pieces)))
                else:
                    found.append(array("I", [i for p in pieces for i in ([p] if isinstance(p, int) else coder.merge(p))]).tobytes())
                keys.append((row, doc))
                row += 1
            more = len(extra)
            sizes = np.array([len(x) // 4 for x in found] + [0] * more, dtype=np.int64)
            ids = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32)), pa.array(np.frombuffer(b"".join(found), dtype=np.int32), pa.int32()))
            none = [None] * len(keys)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([k[0] for k in keys] + [e[0] for e in extra], pa.int64()),
                    pa.array([k[1] for k in keys] + [e[1] for e in extra], pa.int64()),
                    ids,
                    *(pa.array(none + [e[c] for e in extra], kind) for c, kind in ((2, pa.int32()), (3, pa.int32()), (4, pa.int32()), (5, pa.string()))),
                ],
                names=["row", "doc_id", "ids", "word", "segment", "place", "piece"],
            )
    del coder, words
    _forget()


def _merge_segments(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    coder = coder_of(path)
    for batch in batches:
        last = batch.column("last").to_pylist()
        ids = [coder.merge(p, end) for p, end in zip(batch.column("piece").to_pylist(), last)]
        yield pa.RecordBatch.from_arrays([batch.column(c) for c in ("row", "word", "segment", "place")] + [pa.array(ids, pa.list_(pa.int32()))], names=["row", "word", "segment", "place", "ids"])
    del coder
    _forget()


def _join_words(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    """Rows (row, word, segment, place, ids), sorted, the text's own row first (word -1), to whole texts."""
    coder, state = coder_of(path), None

    def done():
        row, doc, ids, words = state
        out, at = [], 0
        for place, halves in words.values():
            out += ids[at:place] + coder.tree(halves)
            at = place
        return pa.RecordBatch.from_arrays([pa.array([doc], pa.int64()), pa.array([out + ids[at:]], pa.list_(pa.int32()))], names=["doc_id", "ids"])

    for batch in batches:
        for r in batch.to_pylist():
            if r["word"] < 0:
                if state is not None:
                    yield done()
                state = (r["row"], r["doc_id"], r["ids"], {})
            else:
                state[3].setdefault(r["word"], (r["place"], []))[1].append(r["ids"])
    if state is not None:
        yield done()


def encode(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids) of every row's whole text, as the tokenizer file encodes it without adding special tokens.

    Null and empty texts have no ids; special tokens spelt out in a text are special tokens, as in the library. Repeated
    rows are encoded each; rows without a doc_id stay; an empty table gives an empty result; other columns are not read."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    coded = rows.mapInArrow(lambda it: _encode(it, path), CODED)
    width = shuffle_width(spark)
    # Texts with long words are few; they are found first, so that all others pass without being written. Whether a word of
    # the texts in question is cut is what coding them says.
    doubtful = rows.where(F.length("text") > LONG // 4).where(F.col("text").rlike(rf"[^\s]{{{LONG // WIDEST},}}"))
    cut_words = doubtful.mapInArrow(lambda it: _encode(it, path), CODED).where("piece is not null")
    if cut_words.limit(1).count() == 0:
        return coded.select("doc_id", "ids")
    coded = kept(coded, "coded")
    pieces = coded.where("piece is not null")
    ends = pieces.groupBy("row", "word").agg(F.max("segment").alias("end"))
    parted = pieces.select("row", "word", "segment", "place", "piece").join(ends, ["row", "word"]).withColumn("last", F.col("segment") == F.col("end")).drop("end")
    merged = parted.repartition(width, "row", "word", "segment").mapInArrow(lambda it: _merge_segments(it, path), "row bigint, word int, segment int, place int, ids array<int>")
    whole = coded.where("piece is null").select("row", "doc_id", "ids")
    cut = pieces.select("row").distinct()
    own = whole.join(cut, "row").select("row", "doc_id", F.lit(-1).alias("word"), F.lit(0).alias("segment"), F.lit(0).alias("place"), "ids")
    both = own.unionByName(merged.withColumn("doc_id", F.lit(None).cast("bigint"))).repartition(width, "row").sortWithinPartitions("row", "word", "segment")
    joined = both.mapInArrow(lambda it: _join_words(it, path), "doc_id bigint, ids array<int>")
    return whole.join(cut, "row", "left_anti").select("doc_id", "ids").unionByName(joined)


def _decode(batches: Iterator[pa.RecordBatch], path: str, digests: bool, with_ids: bool = False) -> Iterator[pa.RecordBatch]:
    tokenizer = load(path)
    names = [tokenizer.id_to_token(i) or "" for i in range(tokenizer.get_vocab_size())]
    for batch in batches:
        ids = batch.column("ids")
        bounds = np.frombuffer(ids.buffers()[1], dtype=np.int32)[ids.offset : ids.offset + len(ids) + 1].tolist() if len(ids) else [0]
        flat = np.asarray(ids.values.to_numpy(zero_copy_only=False), dtype="<u4")
        out = []
        for a, b in zip(bounds[:-1], bounds[1:]):
            own = flat[a:b]
            text = " ".join(map(names.__getitem__, own.tolist())) if tokenizer.decoder is None else tokenizer.decode(own.tolist(), skip_special_tokens=False)
            out.append((b - a, hashlib.sha256(own.tobytes()).hexdigest(), hashlib.sha256(text.encode("utf-8")).hexdigest()) if digests else (text,))
        columns = list(zip(*out)) if out else ([(), (), ()] if digests else [()])
        if digests:
            made = [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.string()), pa.array(columns[2], pa.string())]
            kept_too = ["doc_id", "ids"] if with_ids else ["doc_id"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept_too), *made], names=[*kept_too, "n_tokens", "ids_sha256", "decoded_sha256"])
        else:
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(columns[0], pa.string())], names=["doc_id", "text"])
    del tokenizer, names
    give_back()


def decode(coded: DataFrame, path: str) -> DataFrame:
    """(doc_id, text): the library's decode of each row's ids, special tokens kept. No ids give an empty text."""
    return coded.select("doc_id", "ids").mapInArrow(lambda it: _decode(it, path, False), "doc_id bigint, text string")


def round_trip(coded: DataFrame, path: str, with_ids: bool = False) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of rows (doc_id, ids) and their decoded texts; ids too if asked for."""
    fields = "doc_id bigint, ids array<int>, " if with_ids else "doc_id bigint, "
    return coded.select("doc_id", "ids").mapInArrow(lambda it: _decode(it, path, True, with_ids), fields + "n_tokens bigint, ids_sha256 string, decoded_sha256 string")


def op5_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """All documents encoded and decoded again."""
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    return round_trip(encode(table(spark, folder, "documents"), path), path)
