"""Token ids of a public byte-level vocabulary, stored as ORC.

ORC does the storage work named for this operator: a stripe holds the ids as run-length encoded integers, a row index with
the smallest and largest document id for every ``row.index.stride`` rows, and a Bloom filter on the document id. A reader
takes stripes in parallel and skips files, stripes and row groups by that metadata alone.

Documents are range-partitioned by id before they are encoded, so the files follow each other in id order; a document's
first position is the sum of the files before its own (one number a file) plus the documents before it in the file."""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chainlytics.llm.arrays import parts
from chainlytics.llm.tables import table
from chainlytics.session import shuffle_width, workspace

#: Letters, numbers and white space up to U+017F; no Unicode version changes their classes.
LETTER, NUMBER, SPACE = r"A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u017f", r"0-9\xb2\xb3\xb9\xbc-\xbe", r"\t-\r \x85\xa0"

#: The split pattern of the byte-level vocabulary for such characters. Its alternatives exclude each other by their first
#: characters, so the most frequent one comes first.
SPLIT = re.compile(rf" ?[{LETTER}]+| ?[{NUMBER}]+|'s|'t|'re|'ve|'m|'ll|'d| ?[^{SPACE}{LETTER}{NUMBER}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")

OTHER = re.compile("[^\x00-\u017f]")


def plain(text: str) -> bool:
    """True if SPLIT holds for a text and it has nothing that may be a special token; others go to the tokenizer whole."""
    if "<|" in text:
        return False
    if text.isascii():
        return True
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return OTHER.search(text) is None
    return True


def byte_characters() -> dict[int, int]:
    """The character that stands for each byte in a byte-level vocabulary: printable ones stand for themselves, the others
    follow from U+0100 on."""
    same = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in same]
    return {b: b for b in same} | {b: 256 + k for k, b in enumerate(others)}


#: Longest piece that a task keeps the ids of, and most pieces it keeps; when full it starts anew.
MEMO_CHARS, MEMO_PIECES = 48, 500_000

#: Ids, bytes: an ORC stripe and the rows a row index entry and a Bloom filter stand for.
STRIPE_BYTES, INDEX_ROWS = 64 << 20, 1_000

STORED = "doc_id bigint, ids array<int>, n_tokens bigint"


class Memo(dict):
    """Piece -> its ids as little-endian 32-bit integers, by the tokenizer's model."""

    def __init__(self, tokenizer):
        super().__init__()
        self.tokenizer, self.model = tokenizer, tokenizer.model
        self.characters = byte_characters()
        self.blank = chr(self.characters[0x20])

    def whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def __missing__(self, piece: str) -> bytes:
        if piece.isascii() and piece[1:].isalnum() and piece[0] == " ":
            mapped = self.blank + piece[1:]  # the usual case, without a table
        else:
            mapped = piece.encode("utf-8").decode("latin-1").translate(self.characters)
        ids = array("I", [t.id for t in self.model.tokenize(mapped)]).tobytes()
        if len(piece) <= MEMO_CHARS:
            if len(self) >= MEMO_PIECES:
                self.clear()
            self[piece] = ids
        return ids


def load(path: str):
    """The tokenizer of a file, without truncation and padding; it runs in the task's own thread."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


#: A worker process keeps its tokenizers and memos from task to task.
_memos: dict[str, Memo] = {}


def memo_of(path: str) -> Memo:
    if path not in _memos:
        _memos[path] = Memo(load(path))
    return _memos[path]


def encode_batches(batches: Iterator[pa.RecordBatch], path: str, end_id: int | None) -> Iterator[pa.RecordBatch]:
    """(doc_id, text) to (doc_id, ids, n_tokens). A text's pieces are what the tokenizer splits it into, and each distinct
    piece is encoded by the tokenizer once, so a text costs a lookup a word."""
    memo = memo_of(path)
    end = b"" if end_id is None else np.array([end_id], dtype="<u4").tobytes()
    for batch in batches:
        for rows, _, _ in parts(batch):
            found = []
            for text in rows.column("text").to_pylist():
                text = text or ""
                found.append((b"".join(map(memo.__getitem__, SPLIT.findall(text))) if plain(text) else memo.whole(text)) + end)
            sizes = np.array([len(x) // 4 for x in found], dtype=np.int64)
            flat = pa.array(np.frombuffer(b"".join(found), dtype=np.int32), type=pa.int32())
            bounds = pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32))
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.ListArray.from_arrays(bounds, flat), pa.array(sizes)], names=["doc_id", "ids", "n_tokens"])


def write_ids(docs: DataFrame, path: str, vocabulary: str, end_id: int | None, files: int | None = None) -> None:
    """Encode ``text`` of every row and write (doc_id, ids, n_tokens) as ORC files in ascending doc_id order.

    Null texts are empty: they hold the end id alone. A row without a doc_id comes first; rows that share a doc_id are all
    kept, next to each other and in the order of their texts' hashes. An empty table gives files without rows. Other columns of
    ``docs`` are not read.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.xxhash64("text").alias("hash"))
    # The cuts come from a sample of the sort keys, so these are numbers, not texts.
    spread = rows.repartitionByRange(files or shuffle_width(spark), "doc_id", "hash").sortWithinPartitions("doc_id", "hash")
    coded = spread.select("doc_id", "text").mapInArrow(lambda it: encode_batches(it, vocabulary, end_id), STORED)
    (
        coded.write.option("compression", "zstd")
        .option("orc.stripe.size", STRIPE_BYTES)
        .option("orc.row.index.stride", INDEX_ROWS)
        .option("orc.create.index", "true")
        .option("orc.bloom.filter.columns", "doc_id")
        .option("orc.bloom.filter.fpp", "0.01")
        .orc(path)
    )


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """The stored rows; a filter on doc_id reaches the files' statistics and Bloom filters."""
    return spark.read.schema(STORED).orc(path)


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows == 0:
            continue
        ids = batch.column("ids")
        bounds = np.frombuffer(ids.buffers()[1], dtype=np.int32)[ids.offset : ids.offset + len(ids) + 1]
        flat = memoryview(np.asarray(ids.values.to_numpy(zero_copy_only=False), dtype="<u4")).cast("B")
        crc = [zlib.crc32(flat[4 * a : 4 * b]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.diff(bounds).astype(np.int64)), pa.array(crc, pa.int64()), batch.column("block"), batch.column("place"), batch.column("file")], names=["doc_id", "n_tokens", "ids_crc32", "block", "place", "file"])


def positions(stored: DataFrame) -> DataFrame:
    """Per stored document: doc_id, start (ids of all documents before it), n_tokens and ids_crc32, from the files."""
    spark = stored.sparkSession
    file = F.regexp_extract("_metadata.file_name", r"part-(\d+)", 1).cast("int").alias("file")
    rows = stored.select("doc_id", "ids", F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("place"), file)
    measured = rows.mapInArrow(_measure, "doc_id bigint, n_tokens bigint, ids_crc32 bigint, block bigint, place bigint, file int")
    before, total = [], 0
    for row in stored.groupBy(file).agg(F.sum("n_tokens").alias("held")).orderBy("file").collect():
        before.append((row["file"], total))
        total += row["held"]
    starts = spark.createDataFrame(before, "file int, before bigint")
    ahead = Window.partitionBy("file").orderBy("block", "place").rowsBetween(Window.unboundedPreceding, -1)
    return measured.join(starts, "file").select("doc_id", (F.col("before") + F.coalesce(F.sum("n_tokens").over(ahead), F.lit(0))).alias("start"), "n_tokens", "ids_crc32")


def op3_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """All documents encoded, written and read back."""
    import public_tokenizers

    path = workspace(spark, "token-ids")
    write_ids(table(spark, folder, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"), 2)
    return positions(read_ids(spark, path))
