"""Language-model scores: a log-bilinear model over word classes, and exact word counts within them.

Every token falls in one of ``CLASSES`` classes: the most frequent words and the text's end are classes of their own, any
other word belongs to one of ``RARE`` classes by its last bytes. The model predicts a token's class from the classes of the
two tokens before it: their vectors, each through a matrix for its place, add up to a prediction that is compared with
every class's vector. It is trained by noise-contrastive estimation on the class trigrams of all training texts, summed in
Spark into a table whose size the number of classes bounds; the frequent words come from the words of all of them. When
scoring, the distinct contexts of a part go through one matrix product and are normalised over all classes. Within a
rare class a word has probability (count + 1) / (sum of the class's counts + its distinct words + 1), where the last 1 is
for all words never seen, so the probabilities of all known tokens and of "some unknown word" add up to 1.

Counts cover all training texts and are never held in one place. A part (some 2 MB of texts) sends each bucket of word
hashes its distinct words, with the number of times each of its texts has them; a bucket adds up the counts and answers
each part with one number a text. Frequent words are counted as classes, a fixed number of counters a text, so no bucket
gets more of one word than the rare words have."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chainlytics.llm.arrays import LOWER, between, parts, prefix_hash, words
from chainlytics.llm.tables import kept, table
from chainlytics.session import shuffle_width

#: Classes in all, those of rare words, words of context, size of a vector.
CLASSES, RARE, CONTEXT, DEPTH = 256, 64, 2, 32

#: Class of the text's end, the first class of rare words, and the number that stands before a text's first token.
END, FIRST_RARE, BEFORE = CLASSES - RARE - 1, CLASSES - RARE, CLASSES

#: Noise tokens a token is told from, steps a pass, passes over all contexts.
NOISE, STEPS, PASSES = 64, 512, 48

#: Contexts of one nearest class, cells of a row of counts (context and class), words held before they are sent on.
SECOND, CELLS, HELD = CLASSES + 1, (CLASSES + 1) * CLASSES, 1 << 20

WORDS = "bucket int, words binary, times binary"
TRIGRAMS = "near int, cells binary, times binary"
EXCHANGE = "bucket int, part bigint, kind int, words binary, classes binary, holders binary, texts binary, times binary, train binary"
ANSWER = "part bigint, kind int, place int, value double, blob binary"


class LogBilinear:
    """Vectors and matrices of the model (some 100 KB) and the hashes of the words that are classes of their own."""

    def __init__(self, top: np.ndarray, seed: int = 3):
        r = np.random.default_rng(seed)
        self.order = np.argsort(top)
        self.top = top[self.order]
        self.given = r.normal(0, 0.1, (CLASSES + 1, DEPTH)).astype(np.float32)
        self.places = np.stack([np.eye(DEPTH, dtype=np.float32) * 0.5 for _ in range(CONTEXT)])
        self.wanted = r.normal(0, 0.1, (CLASSES, DEPTH)).astype(np.float32)
        self.bias = np.zeros(CLASSES, dtype=np.float32)

    def classes(self, hashes: np.ndarray, suffix: np.ndarray) -> np.ndarray:
        """Class of each word from its hash and its last bytes."""
        out = FIRST_RARE + suffix % RARE
        if len(self.top):
            at = np.minimum(np.searchsorted(self.top, hashes), len(self.top) - 1)
            hit = self.top[at] == hashes
            out[hit] = self.order[at[hit]]
        return out

    def log10(self, contexts: np.ndarray) -> np.ndarray:
        """Normalised log10 probabilities of all classes after each context (rows of class numbers, nearest first)."""
        predicted = sum(self.given[contexts[:, k]] @ self.places[k] for k in range(CONTEXT))
        logits = predicted @ self.wanted.T + self.bias
        logits -= logits.max(axis=1, keepdims=True)
        logits -= np.log(np.exp(logits).sum(axis=1, keepdims=True))
        return logits * np.float32(1 / np.log(10))


def tokenised(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes, last bytes (as a number) and text numbers of the words."""
    starts, ends, owner = words(data, bounds)
    lower = LOWER[data]
    if len(starts) == 0:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64), owner
    last, one_before = lower[ends - 1].astype(np.int64), lower[np.maximum(ends - 2, starts)].astype(np.int64)
    return between(prefix_hash(lower), starts, ends), last * 31 + one_before, owner


def sequences(model: LogBilinear, data: np.ndarray, bounds: np.ndarray):
    """All tokens of texts with their ends: (classes, text of each token, where words stand, hashes, text of each word)."""
    hashes, suffix, owner = tokenised(data, bounds)
    n = len(bounds) - 1
    counts = np.bincount(owner, minlength=n)
    at = np.arange(len(hashes)) + owner
    classes = np.full(len(hashes) + n, END, dtype=np.int64)
    classes[at] = model.classes(hashes, suffix)
    return classes, np.repeat(np.arange(n), counts + 1), at, hashes, owner


def contexts_of(classes: np.ndarray, text: np.ndarray) -> np.ndarray:
    """The classes of the tokens before each token, nearest first."""
    out = np.full((len(classes), CONTEXT), BEFORE, dtype=np.int64)
    for k in range(1, CONTEXT + 1):
        same = text[k:] == text[:-k]
        out[k:, k - 1][same] = classes[:-k][same]
    return out


def frequent(hashes: np.ndarray, times: np.ndarray) -> np.ndarray:
    """Places of the most frequent words, of equally frequent ones those of the smallest hashes."""
    return np.lexsort((hashes, -times))[:END]


def cells_of(classes: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct class trigrams as nearest class * CELLS + second * CLASSES + class, and how often each occurs."""
    contexts = contexts_of(classes, text)
    return np.unique((contexts[:, 0] * SECOND + contexts[:, 1]) * CLASSES + classes, return_counts=True)


def train(texts: list[bytes], seed: int = 3) -> LogBilinear:
    """Choose the frequent words of texts in memory and fit the model on them; ``fitted`` does it for a table."""
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    bounds = np.r_[0, np.cumsum([len(t) for t in texts])].astype(np.int64)
    found, times = np.unique(tokenised(data, bounds)[0], return_counts=True)
    model = LogBilinear(found[frequent(found, times)], seed)
    classes, text, *_ = sequences(model, data, bounds)
    cells, times = cells_of(classes, text)
    counts = np.zeros((SECOND * SECOND, CLASSES), dtype=np.float32)
    counts.reshape(-1)[cells] = times
    return fit(model, counts, seed)


def fit(model: LogBilinear, counts: np.ndarray, seed: int = 3) -> LogBilinear:
    """Noise-contrastive estimation from the counts of all classes (columns) after all contexts (rows). Each pass goes over
    every context; noise is not drawn but weighed by its probability. Without counts all classes are equal."""
    sizes = counts.sum(axis=1, dtype=np.float64)
    held, total = np.flatnonzero(sizes), sizes.sum()
    if len(held) == 0:
        return model
    noise = counts.sum(axis=0, dtype=np.float64) + 1.0
    noise /= noise.sum()
    log_noise = np.log(noise * NOISE).astype(np.float32)
    model.bias[:] = np.log(noise)
    values = [model.given, model.places, model.wanted, model.bias]
    squares = [np.full_like(v, 1e-3) for v in values]
    rng = np.random.default_rng(seed)
    for turn in range(PASSES):
        rate = np.float32(0.1 / (1 + turn) ** 0.5)
        for own in np.array_split(rng.permutation(held), min(STEPS, len(held))):
            share = counts[own] * np.float32(min(STEPS, len(held)) / total)
            for value, square, slope in zip(values, squares, _slopes(model, own, share, log_noise)):
                square += slope * slope
                value += rate * slope / np.sqrt(square)
    return model


def _slopes(model: LogBilinear, own, share, log_noise):
    """Ascent directions of the log-likelihood of telling the tokens after some contexts from noise."""
    contexts = [own // SECOND, own % SECOND]
    given = [model.given[c] for c in contexts]
    predicted = sum(g @ model.places[k] for k, g in enumerate(given))
    told = 1 / (1 + np.exp(-np.clip(predicted @ model.wanted.T + model.bias - log_noise, -30, 30)))
    slope = share * (1 - told) - share.sum(axis=1, keepdims=True) * np.exp(log_noise) * told
    back = slope @ model.wanted
    vectors, places = np.zeros_like(model.given), np.zeros_like(model.places)
    for k in range(CONTEXT):
        places[k] = given[k].T @ back
        np.add.at(vectors, contexts[k], back @ model.places[k].T)
    return vectors, places, slope.T @ predicted, slope.sum(axis=0)


def class_scores(model: LogBilinear, classes: np.ndarray, text: np.ndarray, n: int) -> np.ndarray:
    """Sum over each text's tokens of the log10 probability of the token's class."""
    contexts = contexts_of(classes, text)
    code = contexts[:, 0]
    for k in range(1, CONTEXT):
        code = code * (CLASSES + 1) + contexts[:, k]
    _, first, which = np.unique(code, return_index=True, return_inverse=True)
    which = which.ravel()
    out = np.empty(len(classes), dtype=np.float64)
    order = np.argsort(which, kind="stable")
    edges = np.searchsorted(which[order], np.arange(0, len(first) + 4_096, 4_096))
    for k in range(len(edges) - 1):
        own = order[edges[k] : edges[k + 1]]
        if len(own):
            table = model.log10(contexts[first[k * 4_096 : (k + 1) * 4_096]])
            out[own] = table[which[own] - k * 4_096, classes[own]]
    return np.bincount(text, weights=out, minlength=n)


def _send(batches: Iterator[pa.RecordBatch], model: LogBilinear, buckets: int) -> Iterator[pa.RecordBatch]:
    """(doc_id, text, train) to the rows of EXCHANGE: a part's own row, and one for each bucket it has words for."""
    part = TaskContext.get().partitionId() << 33
    names = [f.split()[0] for f in EXCHANGE.split(", ")]
    kinds = [pa.int32(), pa.int64(), pa.int32(), *[pa.binary()] * 6]
    for batch in batches:
        for rows, data, bounds in parts(batch):
            n = rows.num_rows
            train = np.asarray(rows.column("train").to_pylist(), dtype=np.uint8)
            classes, text, at, hashes, owner = sequences(model, data, bounds)
            tf = np.bincount(text * CLASSES + classes, minlength=n * CLASSES).astype(np.uint32)
            ids = rows.column("doc_id")
            raw = np.asarray(ids.fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64)
            absent = np.asarray(ids.is_null().to_numpy(zero_copy_only=False), dtype=np.uint8)
            out = [[part % buckets, part, 0, raw.tobytes(), absent.tobytes(), class_scores(model, classes, text, n).tobytes(), zlib.compress(tf.tobytes(), 1), None, train.tobytes()]]
            rare = np.flatnonzero(classes[at] >= FIRST_RARE)
            if len(rare):
                order = rare[np.lexsort((owner[rare], hashes[rare]))]
                h, o = hashes[order], owner[order]
                pair = np.flatnonzero(np.r_[True, (h[1:] != h[:-1]) | (o[1:] != o[:-1])])
                times = np.diff(np.r_[pair, len(h)])
                h, o, c = h[pair], o[pair], (classes[at][order][pair] - FIRST_RARE).astype(np.uint8)
                word = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
                holders = np.diff(np.r_[word, len(h)])
                # The top bits deal words to buckets, so a bucket's words are one stretch of the sorted ones.
                to = ((h[word] >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
                cuts = np.searchsorted(to, np.arange(buckets + 1, dtype=np.uint64))
                pairs = np.r_[word, len(h)]
                for b in np.flatnonzero(np.diff(cuts)).tolist():
                    w = slice(cuts[b], cuts[b + 1])
                    p = slice(pairs[cuts[b]], pairs[cuts[b + 1]])
                    out.append([b, part, 1, h[word[w]].tobytes(), c[word[w]].tobytes(), holders[w].astype(np.uint16).tobytes(), o[p].astype(np.uint16).tobytes(), times[p].astype(np.uint32).tobytes(), train.tobytes()])
            part += n
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*out), kinds)], names=names)


def _answers(rows: list[list]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.float64(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)], names=[f.split()[0] for f in ANSWER.split(", ")])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The buckets of a task: counts of their words, an answer to each part (kind 1), the parts' own rows (kind 0), and
    sums for the whole corpus (kind 2: tokens by class, 3: distinct words and counts of rare classes)."""
    own, totals = [], np.zeros(CLASSES)
    for batch in batches:
        for row in batch.to_pylist():
            if row["kind"] == 0:
                n = len(row["train"])
                tf = np.frombuffer(zlib.decompress(row["texts"]), dtype=np.uint32).reshape(n, CLASSES)
                totals += tf[np.frombuffer(row["train"], dtype=bool)].sum(axis=0, dtype=np.float64)
                blob = np.int64(n).tobytes() + row["words"] + row["classes"] + row["holders"] + row["train"] + row["texts"]
                yield _answers([[row["part"], 0, None, None, blob]])
            else:
                own.append(row)
    sums = [[None, 2, k, float(v), None] for k, v in enumerate(totals) if v]
    if own:
        hashes = np.concatenate([np.frombuffer(r["words"], dtype=np.uint64) for r in own])
        classes = np.concatenate([np.frombuffer(r["classes"], dtype=np.uint8) for r in own])
        taught = []
        for r in own:
            holders = np.frombuffer(r["holders"], dtype=np.uint16).astype(np.int64)
            train = np.frombuffer(r["train"], dtype=bool)[np.frombuffer(r["texts"], dtype=np.uint16)]
            taught.append(np.add.reduceat(np.frombuffer(r["times"], dtype=np.uint32) * train, np.cumsum(holders) - holders))
        _, first, which = np.unique(hashes, return_index=True, return_inverse=True)
        counts = np.bincount(which.ravel(), weights=np.concatenate(taught))
        seen = counts > 0
        distinct = np.bincount(classes[first][seen], minlength=RARE)
        sums += [[None, 3, k, float(v), None] for k, v in enumerate(distinct) if v]
        per_word = np.log10(counts + 1)[which.ravel()]
        known = seen[which.ravel()]
        done = 0
        for r in own:
            holders = np.frombuffer(r["holders"], dtype=np.uint16)
            share = slice(done, done + len(holders))
            done += len(holders)
            texts, times = np.frombuffer(r["texts"], dtype=np.uint16), np.frombuffer(r["times"], dtype=np.uint32)
            n = len(r["train"])
            logs = np.bincount(texts, weights=times * np.repeat(per_word[share], holders), minlength=n)
            has = np.bincount(texts, weights=times * np.repeat(known[share], holders), minlength=n)
            yield _answers([[r["part"], 1, None, None, np.concatenate([logs, has]).tobytes()]])
    if sums:
        yield _answers(sums)


def _finish(batches: Iterator[pa.RecordBatch], tokens: np.ndarray, distinct: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Answers of a part added up and turned into its texts' scores. Rows come sorted by part, its own row first."""
    total = tokens.sum()
    types = (tokens[:FIRST_RARE] > 0).sum() + distinct.sum()
    size = np.log10(total + types + 1)
    top_log = np.where(np.arange(CLASSES) < FIRST_RARE, np.log10(tokens + 1), 0)
    rare_size = np.zeros(CLASSES)
    rare_size[FIRST_RARE:] = np.log10(tokens[FIRST_RARE:] + distinct + 1)
    top_known = np.where(np.arange(CLASSES) < FIRST_RARE, tokens > 0, False)

    def done(state):
        n, raw, absent, scores, tf, train, logs, known = state
        count = tf.sum(axis=1, dtype=np.int64)
        base = tf @ top_log + logs - count * size
        score = scores + logs - tf @ rare_size
        ids = pa.array(raw, pa.int64(), mask=absent)
        held = pa.array(~train)
        return pa.RecordBatch.from_arrays(
            [ids, held, pa.array(count), pa.array((tf @ top_known + known).astype(np.int64)), pa.array(np.full(n, int(total))), pa.array(base), pa.array(score)],
            names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
        )

    at, state = None, None
    for batch in batches:
        for part, kind, blob in zip(batch.column("part").to_pylist(), batch.column("kind").to_pylist(), batch.column("blob")):
            raw = blob.as_buffer()
            if kind == 0:
                if state is not None:
                    yield done(state)
                n = int(np.frombuffer(raw, dtype=np.int64, count=1)[0])
                ids = np.frombuffer(raw, dtype=np.int64, count=n, offset=8)
                absent = np.frombuffer(raw, dtype=np.uint8, count=n, offset=8 + 8 * n).astype(bool)
                scores = np.frombuffer(memoryview(raw)[8 + 9 * n : 8 + 17 * n].tobytes(), dtype=np.float64)
                train = np.frombuffer(raw, dtype=bool, count=n, offset=8 + 17 * n)
                tf = np.frombuffer(zlib.decompress(memoryview(raw)[8 + 18 * n :]), dtype=np.uint32).reshape(n, CLASSES)
                at, state = part, [n, ids, absent, scores, tf, train, np.zeros(n), np.zeros(n)]
            else:
                if part != at:
                    raise ValueError(f"answers without the part's own row: {part}")
                both = np.frombuffer(raw, dtype=np.float64)
                state[6] = state[6] + both[: state[0]]
                state[7] = state[7] + both[state[0] :]
    if state is not None:
        yield done(state)


def held_out(doc_id):
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 7 == 2, F.lit(False))


def _frame(rows: list[tuple], fields: str) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)], names=[f.split()[0] for f in fields.split(", ")])


def _words(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """Texts to rows of WORDS: the distinct words of a task and their counts, by buckets of hashes."""
    hashes, times = [], []

    def sent():
        found, sums = _summed(hashes, times)
        to = ((found >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
        cuts = np.searchsorted(to, np.arange(buckets + 1, dtype=np.uint64))
        return _frame([(b, found[cuts[b] : cuts[b + 1]].tobytes(), sums[cuts[b] : cuts[b + 1]].tobytes()) for b in np.flatnonzero(np.diff(cuts)).tolist()], WORDS)

    for batch in batches:
        for _, data, bounds in parts(batch):
            found, sums = np.unique(tokenised(data, bounds)[0], return_counts=True)
            if len(found):
                hashes.append(found)
                times.append(sums)
            if sum(map(len, hashes)) > HELD:
                found, sums = _summed(hashes, times)
                hashes, times = [found], [sums]
                if len(found) > HELD // 2:
                    yield sent()
                    hashes, times = [], []
    if hashes:
        yield sent()


def _summed(keys: list[np.ndarray], times: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, and the sums of their counts."""
    found, which = np.unique(np.concatenate(keys), return_inverse=True)
    sums = np.zeros(len(found), dtype=np.int64)
    np.add.at(sums, which.ravel(), np.concatenate(times))
    return found, sums


def _frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of WORDS, all of a bucket in one task, to one with the most frequent words of the task's buckets."""
    rows = [(h.as_buffer(), t.as_buffer()) for batch in batches for h, t in zip(batch.column("words"), batch.column("times"))]
    if rows:
        found, sums = _summed([np.frombuffer(h, dtype=np.uint64) for h, _ in rows], [np.frombuffer(t, dtype=np.int64) for _, t in rows])
        best = frequent(found, sums)
        yield _frame([(0, found[best].tobytes(), sums[best].tobytes())], WORDS)


def _trigrams(batches: Iterator[pa.RecordBatch], model: LogBilinear) -> Iterator[pa.RecordBatch]:
    """Texts to rows of TRIGRAMS: a task's counts, a row for each nearest class."""
    counts = np.zeros(SECOND * CELLS, dtype=np.int64)
    for batch in batches:
        for _, data, bounds in parts(batch):
            classes, text, *_ = sequences(model, data, bounds)
            cells, times = cells_of(classes, text)
            counts[cells] += times
    yield from _rows(enumerate(counts.reshape(SECOND, CELLS)))


def _rows(counts) -> Iterator[pa.RecordBatch]:
    for near, own in counts:
        cells = np.flatnonzero(own)
        if len(cells):
            yield _frame([(near, zlib.compress(cells.astype(np.uint32).tobytes(), 1), zlib.compress(own[cells].tobytes(), 1))], TRIGRAMS)


def _unpacked(cells: bytes, times: bytes) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(zlib.decompress(cells), dtype=np.uint32), np.frombuffer(zlib.decompress(times), dtype=np.int64)


def _sum_trigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of TRIGRAMS, all of a nearest class in one task, to one row for each."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for near, cells, times in zip(batch.column("near").to_pylist(), batch.column("cells"), batch.column("times")):
            at, own = _unpacked(cells.as_buffer(), times.as_buffer())
            sums.setdefault(near, np.zeros(CELLS, dtype=np.int64))[at] += own
    yield from _rows(sorted(sums.items()))


def fitted(docs: DataFrame) -> LogBilinear:
    """The model, its frequent words chosen from all words of all rows and fitted on all their class trigrams."""
    spark = docs.sparkSession
    buckets = shuffle_width(spark)
    texts = docs.select("text")
    sent = texts.mapInArrow(lambda it: _words(it, buckets), WORDS).repartition(buckets, "bucket")
    best = sent.mapInArrow(_frequent, WORDS).collect()
    found = np.concatenate([np.zeros(0, dtype=np.uint64), *(np.frombuffer(r["words"], dtype=np.uint64) for r in best)])
    times = np.concatenate([np.zeros(0, dtype=np.int64), *(np.frombuffer(r["times"], dtype=np.int64) for r in best)])
    model = LogBilinear(found[frequent(found, times)])
    shared = spark.sparkContext.broadcast(model)
    sums = texts.mapInArrow(lambda it: _trigrams(it, shared.value), TRIGRAMS).repartition(buckets, "near").mapInArrow(_sum_trigrams, TRIGRAMS)
    counts = np.zeros((SECOND, CELLS), dtype=np.float32)
    for row in sums.toLocalIterator():
        at, own = _unpacked(row["cells"], row["times"])
        counts[row["near"], at] = own
    return fit(model, counts.reshape(SECOND * SECOND, CLASSES))


def score(docs: DataFrame, is_held_out=held_out) -> DataFrame:
    """For every row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score (log10).

    Tokens are the words ``[^\\x20\\x09-\\x0D]+``, A-Z lower-cased, and one end a text; counts come from the rows that are not
    held out. Null and empty texts have the end alone. Rows without a doc_id are trained on. Repeated rows count and are
    scored each. An empty table gives an empty result; if all rows are held out, no token is known and N is 0. Other
    columns are not read."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", (~is_held_out(F.col("doc_id"))).alias("train"))
    model = fitted(rows.where("train").select("doc_id", "text"))
    buckets = shuffle_width(spark)
    shared = spark.sparkContext.broadcast(model)
    sent = rows.mapInArrow(lambda it: _send(it, shared.value, buckets), EXCHANGE).repartition(buckets, "bucket")
    answers = kept(sent.mapInArrow(_count, ANSWER), "word-counts")
    sums = answers.where("kind >= 2").groupBy("kind", "place").agg(F.sum("value").alias("value")).collect()
    tokens, distinct = np.zeros(CLASSES), np.zeros(RARE)
    for row in sums:
        (tokens if row["kind"] == 2 else distinct)[row["place"]] = row["value"]
    by_part = answers.where("kind < 2").select("part", "kind", "blob").repartition(buckets, "part").sortWithinPartitions("part", "kind")
    return by_part.mapInArrow(lambda it: _finish(it, tokens, distinct), "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double")


def op2_language_model(spark: SparkSession, folder: str) -> DataFrame:
    """Scores of all documents."""
    return score(table(spark, folder, "documents").select("doc_id", "text"))
