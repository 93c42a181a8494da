"""Text quality by a byte-level convolutional network in numpy.

A text is its UTF-8 bytes, and the whole of it is read. A layer of learned filters looks at ``WIDTH`` neighbouring bytes
through a learned vector for each byte value; a second group of inputs says for each byte whether the byte 1 .. ``LAGS``
places before it is the same, averaged over a block, which shows what repeats. Outputs are max-pooled over chunks of two
neighbouring blocks, so chunks overlap by half and cover the text to its last byte. A hidden layer gives each chunk a
logit; the logit of a text is the mean of its chunks' logits.

Training (on the driver) uses a bounded sample of labelled rows and every chunk of their texts; scoring uses every
byte of every text. A filter's response to a byte at a place is a table lookup, so scoring needs no matrix of windows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chainlytics.llm.arrays import parts
from chainlytics.llm.tables import table

#: Bytes a filter sees, size of a byte's vector, filters, hidden units, bytes of a block, lags compared.
WIDTH, DEPTH, FILTERS, HIDDEN, BLOCK, LAGS = 4, 8, 12, 16, 128, 24

#: Labelled texts of each class to train on, whole; chunks of a step; chunks of a text in a turn, if it has as many.
SAMPLE, STEP, CHUNKS = 1_500, 64, 4

#: A text is of good quality from this probability on.
CUT = 0.3

#: Bytes handled at a time when scoring.
SLICE = 1 << 18


class Network:
    """Parameters of the network; plain arrays, so it can be sent to tasks (some 20 KB)."""

    def __init__(self, seed: int = 11):
        r = np.random.default_rng(seed)
        self.byte = r.normal(0, 0.5, (256, DEPTH)).astype(np.float32)
        self.filters = r.normal(0, 0.3, (WIDTH, DEPTH, FILTERS)).astype(np.float32)
        self.bias = np.zeros(FILTERS, dtype=np.float32)
        self.hidden = r.normal(0, 0.3, (FILTERS + LAGS, HIDDEN)).astype(np.float32)
        self.hidden_bias = np.zeros(HIDDEN, dtype=np.float32)
        self.out = r.normal(0, 0.3, HIDDEN).astype(np.float32)
        self.out_bias = np.zeros(1, dtype=np.float32)
        self.scale, self.shift = 1.0, 0.0

    def weights(self) -> list[np.ndarray]:
        return [self.byte, self.filters, self.bias, self.hidden, self.hidden_bias, self.out, self.out_bias]

    def tables(self) -> list[np.ndarray]:
        """Response of every filter to every byte at each of its places."""
        return [np.ascontiguousarray(self.byte @ self.filters[k]) for k in range(WIDTH)]

    def logits(self, features: np.ndarray) -> np.ndarray:
        return np.maximum(features @ self.hidden + self.hidden_bias, 0) @ self.out + self.out_bias[0]


def block_features(data: np.ndarray, bounds: np.ndarray, network: Network) -> tuple[np.ndarray, np.ndarray]:
    """Features of the blocks of all texts and the number of blocks of each; an empty text has one block of zeros."""
    sizes = np.diff(bounds)
    blocks = np.maximum(1, -(-sizes // BLOCK))
    starts = np.repeat(bounds[:-1], blocks) + BLOCK * (np.arange(blocks.sum()) - np.repeat(np.cumsum(blocks) - blocks, blocks))
    ends = np.minimum(starts + BLOCK, np.repeat(bounds[1:], blocks))
    out = np.zeros((len(starts), FILTERS + LAGS), dtype=np.float32)
    tables = network.tables()
    n = len(data)
    if n == 0:
        return out, blocks
    full = np.flatnonzero(ends > starts)
    # Filters see up to WIDTH - 1 bytes past a block's end, within the text; past the text they see nothing.
    text_end = np.repeat(bounds[1:], sizes)
    for first in range(0, len(full), SLICE // BLOCK):
        own = full[first : first + SLICE // BLOCK]
        a, b = int(starts[own[0]]), int(ends[own[-1]])
        response = np.tile(network.bias, (b - a, 1))
        for k, t in enumerate(tables):
            stop = min(b + k, n)
            seen = t[data[a + k : stop]]
            seen[np.arange(a + k, stop) >= text_end[a : stop - k]] = 0
            response[: stop - k - a] += seen
        out[own, :FILTERS] = np.maximum(np.maximum.reduceat(response, starts[own] - a, axis=0), 0)
    size = np.maximum(1, ends - starts)
    edges = np.minimum(starts, n - 1)
    place = np.arange(n) - np.repeat(bounds[:-1], sizes)
    for lag in range(1, LAGS + 1):
        same = np.zeros(n, dtype=np.uint8)
        same[lag:] = data[lag:] == data[:-lag] if lag < n else 0
        same[: min(lag, n)] = 0
        same[place < lag] = 0
        out[full, FILTERS + lag - 1] = np.add.reduceat(same, edges[full], dtype=np.float32) / size[full]
    return out, blocks


def chunk_features(data: np.ndarray, bounds: np.ndarray, network: Network) -> tuple[np.ndarray, np.ndarray]:
    """Each block max-pooled with the next one of its text; the number of chunks of each text."""
    pooled, blocks = block_features(data, bounds, network)
    last = np.zeros(len(pooled), dtype=bool)
    last[np.cumsum(blocks) - 1] = True
    joined = pooled.copy()
    inner = np.flatnonzero(~last)
    joined[inner] = np.maximum(pooled[inner], pooled[inner + 1])
    # A text of several blocks has one chunk less than blocks.
    keep = ~last | np.repeat(blocks == 1, blocks)
    return joined[keep], np.maximum(1, blocks - 1)


def probabilities(data: np.ndarray, bounds: np.ndarray, network: Network) -> np.ndarray:
    features, chunks = chunk_features(data, bounds, network)
    logit = np.add.reduceat(network.logits(features), np.cumsum(chunks) - chunks) / chunks
    return 1 / (1 + np.exp(-np.clip(network.scale * logit + network.shift, -30, 30)))


def _windows(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All bytes, and for every chunk of every text the number of its text, its start, and the text's end."""
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    bounds = np.r_[0, np.cumsum(sizes)]
    chunks = np.maximum(1, -(-(sizes - BLOCK) // BLOCK))
    owner = np.repeat(np.arange(len(texts)), chunks)
    starts = bounds[owner] + BLOCK * (np.arange(len(owner)) - np.repeat(np.cumsum(chunks) - chunks, chunks))
    return np.frombuffer(b"".join(texts), dtype=np.uint8), owner, starts, bounds


def _pieces(data: np.ndarray, first: np.ndarray, starts: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of some chunks with what lies LAGS before and WIDTH - 1 after them in their text (-1: nothing), and the shares of
    bytes that are equal at each lag."""
    span = 2 * BLOCK
    at = starts[:, None] + np.arange(-LAGS, span + WIDTH - 1)[None]
    there = (at >= first[:, None]) & (at < last[:, None])
    pieces = np.where(there, data[np.clip(at, 0, max(0, len(data) - 1))] if len(data) else 0, -1).astype(np.int16)
    now = pieces[:, LAGS : LAGS + span]
    known = np.maximum(1, (now >= 0).reshape(-1, 2, BLOCK).sum(axis=2))
    lags = np.empty((len(pieces), LAGS), dtype=np.float32)
    for lag in range(1, LAGS + 1):
        same = (now == pieces[:, LAGS - lag : LAGS - lag + span]) & (now >= 0)
        lags[:, lag - 1] = (same.reshape(-1, 2, BLOCK).sum(axis=2) / known).max(axis=1)
    return pieces[:, LAGS:], lags


def train(texts: list[bytes], labels: np.ndarray, share: float | None = None, seed: int = 11, rounds: int = 6) -> Network:
    """Fit by Adam on the cross entropy of single chunks in ``rounds`` turns, in which every chunk of every text has its turn; then scale the texts' mean logits to probabilities for a share of
    label 1 as given (default: as in the labels).

    Without both labels among the texts the network gives their share of label 1 to every text (0.5 without texts)."""
    network = Network(seed)
    labels = np.asarray(labels, dtype=np.float32)
    if len(labels) == 0 or labels.min() == labels.max():
        network.scale = 0.0
        only = (labels.sum() + 0.5) / (len(labels) + 1)
        network.shift = float(np.log(only / (1 - only)))
        return network
    rng = np.random.default_rng(seed)
    data, owner, starts, bounds = _windows(texts)
    marks = labels[owner]
    # Each turn takes the next chunks of every text in an order drawn once: CHUNKS, or so many more that all have their turn;
    # together these weigh as CHUNKS would.
    chunks = np.bincount(owner)
    usual = np.minimum(CHUNKS, chunks)
    taken = np.maximum(usual, -(-chunks // rounds))
    drawn, base = np.lexsort((rng.random(len(owner)), owner)), np.cumsum(chunks) - chunks
    weight = (usual / taken)[owner]
    for value in (0, 1):
        weight[marks == value] *= 0.5 * usual.sum() / usual[labels == value].sum()
    weight = weight.astype(np.float32)
    moments = [(np.zeros_like(w), np.zeros_like(w)) for w in network.weights()]
    step = 0
    for turn in range(rounds):
        text = np.repeat(np.arange(len(texts)), taken)
        place = np.arange(len(text)) - np.repeat(np.cumsum(taken) - taken, taken)
        order = rng.permutation(drawn[base[text] + (turn * taken[text] + place) % chunks[text]])
        for first in range(0, len(order), STEP):
            own = order[first : first + STEP]
            step += 1
            pieces, lags = _pieces(data, bounds[owner[own]], starts[own], bounds[owner[own] + 1])
            for (m, v), w, g in zip(moments, network.weights(), _gradients(network, pieces, lags, marks[own], weight[own])):
                m *= 0.9
                m += 0.1 * g
                v *= 0.999
                v += 0.001 * g * g
                w -= 0.004 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-7)
    _calibrate(network, texts, labels, float(labels.mean()) if share is None else share)
    return network


def _gradients(net: Network, pieces: np.ndarray, lags: np.ndarray, marks: np.ndarray, weight: np.ndarray) -> list[np.ndarray]:
    n, span = len(pieces), 2 * BLOCK
    there = pieces >= 0
    seen = net.byte[np.maximum(pieces, 0)] * there[:, :, None]
    response = sum(seen[:, k : k + span] @ net.filters[k] for k in range(WIDTH)) + net.bias
    response = np.where(there[:, :span, None], response, -1e9)
    at = response.argmax(axis=1)
    pooled = np.take_along_axis(response, at[:, None, :], axis=1)[:, 0]
    live = pooled > 0
    features = np.concatenate([np.maximum(pooled, 0), lags], axis=1)
    before = features @ net.hidden + net.hidden_bias
    after = np.maximum(before, 0)
    logit = after @ net.out + net.out_bias[0]
    slope = (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - marks) * weight / n
    back = np.outer(slope, net.out) * (before > 0)
    pooled_back = (back @ net.hidden.T)[:, :FILTERS] * live
    byte, filters = np.zeros_like(net.byte), np.zeros_like(net.filters)
    rows = np.arange(n)[:, None]
    for k in range(WIDTH):
        index = np.minimum(at + k, pieces.shape[1] - 1)
        value = pieces[rows, index]
        ok = (value >= 0) * pooled_back
        vectors = net.byte[np.maximum(value, 0)]
        filters[k] = np.einsum("nfd,nf->df", vectors, ok)
        np.add.at(byte, np.maximum(value, 0), ok[:, :, None] * net.filters[k].T[None])
    return [byte, filters, pooled_back.sum(axis=0), features.T @ back, back.sum(axis=0), after.T @ slope, np.array([slope.sum()], dtype=np.float32)]


def _calibrate(network: Network, texts: list[bytes], labels: np.ndarray, share: float) -> None:
    """Scale and shift of the logits by logistic regression on the texts, classes weighted as they are in the corpus."""
    logits = []
    for raw in texts:
        features, _ = chunk_features(np.frombuffer(raw, dtype=np.uint8), np.array([0, len(raw)]), network)
        logits.append(network.logits(features).mean())
    x, y = np.array(logits, dtype=np.float64), labels.astype(np.float64)
    w = np.where(y == 1, share / y.mean(), (1 - share) / (1 - y.mean()))
    scale, shift = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(scale * x + shift, -30, 30)))
        g = np.array([(w * (p - y) * x).sum() + 1e-2 * (scale - 1), (w * (p - y)).sum()])
        h = w * p * (1 - p)
        matrix = np.array([[(h * x * x).sum() + 1e-2, (h * x).sum()], [(h * x).sum(), h.sum() + 1e-6]])
        move = np.linalg.solve(matrix, g)
        scale, shift = scale - float(np.clip(move[0], -1, 1)), shift - float(np.clip(move[1], -1, 1))
    network.scale, network.shift = max(scale, 0.05), shift


def labelled(docs: DataFrame, labels: DataFrame, label: str, held_out, sample: int = SAMPLE) -> tuple[list[bytes], np.ndarray, float | None]:
    """Texts and labels to train on, and the share of label 1 among all that may be learned from: of each class the ``sample`` rows with the smallest hash of their id, none held out.

    This bounded sample of rows is all that is fitted on, with their whole texts. Labels that are neither 0 nor 1 and rows without
    text are left out; a document labelled twice counts for each label. Rows that share a doc_id all count, up to four times
    ``sample`` rows in all, in the order of that hash."""
    spark = docs.sparkSession
    known = labels.select("doc_id", F.col(label).cast("int").alias("label")).where(~held_out(F.col("doc_id"))).distinct()
    counts = {r["label"]: r["count"] for r in known.where("label in (0, 1)").groupBy("label").count().collect()}
    picked = None
    for value in (0, 1):
        own = known.where(F.col("label") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
        picked = own if picked is None else picked.unionByName(own)
    chosen = spark.createDataFrame([tuple(r) for r in picked.collect()], "doc_id bigint, label int")
    rows = docs.where(F.col("text").isNotNull()).select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    rows = rows.orderBy(F.xxhash64("doc_id"), "doc_id", "label", "text").limit(4 * sample)
    found = [(row["text"].encode("utf-8"), row["label"]) for row in rows.select("text", "label").toLocalIterator()]
    share = counts[1] / (counts[0] + counts[1]) if len(counts) == 2 else None
    return [t for t, _ in found], np.array([y for _, y in found], dtype=np.float32), share


def score_batches(batches: Iterator[pa.RecordBatch], network: Network, keep: list[str]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows, data, bounds in parts(batch):
            yield pa.RecordBatch.from_arrays([*(rows.column(c) for c in keep), pa.array(probabilities(data, bounds, network).astype(np.float64))], names=[*keep, "score"])


def score(docs: DataFrame, network: Network) -> DataFrame:
    """``docs`` with a column score (0 to 1, the probability of good quality) for every row, from all its bytes.

    Null and empty texts have the score of an empty text; repeated rows are scored each; an empty table gives an empty
    result. A column named score is replaced; other columns stay."""
    keep = [c for c in docs.columns if c != "score"]
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields if f.name != "score")
    shared = docs.sparkSession.sparkContext.broadcast(network)
    return docs.select(*[f"`{c}`" for c in keep]).mapInArrow(lambda it: score_batches(it, shared.value, keep), f"{fields}, score double")


def _accepted(batches: Iterator[pa.RecordBatch], network: Network, cut: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows, data, bounds in parts(batch):
            yield rows.filter(pa.array(probabilities(data, bounds, network) >= cut))


def accepted(docs: DataFrame, network: Network, cut: float = CUT) -> DataFrame:
    """The rows of ``docs`` whose text is of good quality with probability ``cut`` at least; all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(network)
    return docs.mapInArrow(lambda it: _accepted(it, shared.value, cut), docs.schema)


def held_out(doc_id):
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fitted(docs: DataFrame, labels: DataFrame) -> Network:
    return train(*labelled(docs, labels, "quality", held_out))


def op8_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Quality of every document."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    scored = score(docs, fitted(docs, table(spark, folder, "labels")))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))
