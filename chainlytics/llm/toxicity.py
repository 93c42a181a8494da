"""Toxicity by a support vector machine on a subsequence string kernel with Nystroem landmarks.

The kernel of two words sums over all triples of characters they share as subsequences, gaps allowed: a triple that spans
n places counts DECAY^n in each word, up to SPAN places apart, divided by the words' lengths in the same measure. An insult
with inserted characters, another ending or a spelling in single letters so stays close to the plain one. Words are
lower-cased (A-Z); punctuation inside them is dropped, marks stand for their ends, and neighbouring one-letter words are
read as one word.

Training (on the driver) takes a bounded sample of labelled texts. A text is toxic if its worst word is, so positive
examples are found in turns: first the words that labelled toxic texts share and clean ones lack, then each toxic text's
highest-scoring word; negatives are words of clean texts, the highest-scoring ones among them in each turn. Landmark words
give Nystroem features, on which the machine (squared hinge loss) is solved by Newton steps. As the kernel is a sum over
triples, the landmarks fold exactly into one weight a triple, so a word of any text is scored by table lookups (1 MB) and
each distinct word of a part only once. Every word of every text is scored; the text's score is that of its worst word."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chainlytics.llm.arrays import LOWER, PART_BYTES, SEPARATOR, between, parts, prefix_hash
from chainlytics.llm.quality import labelled
from chainlytics.llm.tables import table

#: Weight a place of a triple's span; most places between its first and last character.
DECAY, SPAN = 0.6, 5

#: Characters of a word looked at together; longer words are read in pieces that overlap by half.
LONGEST_WORD = 24

#: Labelled texts of each class to train on, landmark words, turns of training, machines whose mean is taken.
SAMPLE, LANDMARKS, TURNS, FITS = 2_000, 160, 5, 4

#: A text is called toxic from this probability on.
CUT = 0.3

#: Codes of characters. 0: nothing, 1-26: letters, 27: digits, 28-61: other characters, 62, 63: word ends.
START, END, CODES = 62, 63, 64
CODE = np.zeros(256, dtype=np.uint8)
CODE[97:123] = np.arange(1, 27)
CODE[48:58] = 27
CODE[128:192] = 28 + np.arange(64) % 34

#: (second, third) places of a triple after its first, and their weight.
SHAPES = [(a, b, DECAY ** (b + 1)) for b in range(2, SPAN + 1) for a in range(1, b)]


def units(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of texts as codes: (codes, starts, ends, text of each word). Long words come as overlapping pieces."""
    none = np.zeros(0, dtype=np.int64)
    codes = CODE[LOWER[data]]
    keep = np.flatnonzero(codes)
    if len(keep) == 0:
        return codes[:0], none, none, none
    text = np.searchsorted(bounds, keep, side="right") - 1
    gaps = np.cumsum(SEPARATOR[data])[keep]
    fresh = np.r_[True, (gaps[1:] != gaps[:-1]) | (text[1:] != text[:-1])]
    starts = np.flatnonzero(fresh)
    sizes = np.diff(np.r_[starts, len(keep)])
    # One character is one code: the first byte of a longer character has none.
    single = sizes == 1
    joined = np.r_[False, single[1:] & single[:-1] & (text[starts[1:]] == text[starts[:-1]])]
    starts = starts[~joined]
    ends = np.r_[starts[1:], len(keep)]
    owner = text[starts]
    long = np.flatnonzero(ends - starts > LONGEST_WORD)
    if len(long):
        step = LONGEST_WORD // 2
        pieces = -(-(ends[long] - starts[long] - LONGEST_WORD) // step) + 1
        first = np.repeat(starts[long], pieces) + step * (np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces))
        last = np.minimum(first + LONGEST_WORD, np.repeat(ends[long], pieces))
        rest = np.ones(len(starts), dtype=bool)
        rest[long] = False
        starts, ends, owner = np.r_[starts[rest], first], np.r_[ends[rest], last], np.r_[owner[rest], np.repeat(owner[long], pieces)]
    return codes[keep], starts, ends, owner


def distinct(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct words: their hashes, where each first stands, and the number of each word's distinct one."""
    return np.unique(between(prefix_hash(codes), starts, ends), return_index=True, return_inverse=True)


def padded(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Words as rows, between their end marks and filled up with zeros for the widest triple."""
    sizes = ends - starts
    width = int(sizes.max()) + 2
    rows = np.zeros((len(starts), width + SPAN), dtype=np.int32)
    place = np.arange(width - 2)
    inside = place < sizes[:, None]
    at = np.minimum(starts[:, None] + place, len(codes) - 1)
    rows[:, 1 : width - 1] = np.where(inside, codes[at], 0)
    rows[:, 0] = START
    rows[np.arange(len(starts)), sizes + 1] = END
    return rows


def norms(sizes: np.ndarray) -> np.ndarray:
    """The length of a word in the kernel's measure, each occurrence of a triple counted by itself."""
    longest = LONGEST_WORD + 2
    table = np.zeros(longest + 1)
    for n in range(longest + 1):
        table[n] = np.sqrt(sum(max(0, n - b) * w * w for _, b, w in SHAPES)) or 1.0
    return table[sizes + 2]


def triples(rows: np.ndarray) -> Iterator[tuple[np.ndarray, float]]:
    """For each shape the numbers of the triples at all places (0 in any of their characters: none) and the weight."""
    width = rows.shape[1] - SPAN
    first = rows[:, :width] * (CODES * CODES)
    for a, b, weight in SHAPES:
        last = rows[:, b : b + width]
        yield np.where(last > 0, first + rows[:, a : a + width] * CODES + last, 0), weight


def folded(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Kernel sums of words against landmarks already folded into a weight a triple."""
    out = np.zeros(len(starts), dtype=np.float32)
    order = np.argsort(ends - starts, kind="stable")
    for first in range(0, len(order), 20_000):
        own = order[first : first + 20_000]
        total = np.zeros(len(own), dtype=np.float32)
        for index, weight in triples(padded(codes, starts[own], ends[own])):
            total += np.float32(weight) * weights[index].sum(axis=1)
        out[own] = total
    return out / norms(ends - starts).astype(np.float32)


class Machine:
    """A weight for each triple, an offset, and the scale that turns margins into probabilities."""

    def __init__(self):
        self.weights = np.zeros(CODES**3, dtype=np.float32)
        self.offset, self.scale, self.shift = 0.0, 1.0, 0.0
        self.floor = -3.0

    def worst(self, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Margin of the worst word of each text; the floor for texts without words."""
        out = np.full(len(bounds) - 1, self.floor)
        codes, starts, ends, owner = units(data, bounds)
        if len(starts):
            _, first, which = distinct(codes, starts, ends)
            np.maximum.at(out, owner, (folded(codes, starts[first], ends[first], self.weights) + self.offset)[which.ravel()])
        return out

    def probabilities(self, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.scale * self.worst(data, bounds) + self.shift, -30, 30)))


def _vocabulary(texts: list[bytes]):
    """Distinct words of texts (codes, starts, ends) and the distinct pairs of text and word, in order of the texts. Texts
    are read a part at a time."""
    known, held, pairs, size, first = {}, [], [], 0, 0
    while first < len(texts):
        last, total = first, 0
        while last < len(texts) and (last == first or total + len(texts[last]) <= PART_BYTES):
            total += len(texts[last])
            last += 1
        own = texts[first:last]
        codes, starts, ends, owner = units(np.frombuffer(b"".join(own), dtype=np.uint8), np.r_[0, np.cumsum([len(t) for t in own])])
        if len(starts):
            hashes, at, which = distinct(codes, starts, ends)
            numbers = np.empty(len(hashes), dtype=np.int64)
            for k, (h, a, b) in enumerate(zip(hashes.tolist(), starts[at].tolist(), ends[at].tolist())):
                if h not in known:
                    known[h] = len(held)
                    held.append(codes[a:b].tobytes())
                numbers[k] = known[h]
            pairs.append(np.unique((owner + first) << 32 | numbers[which.ravel()]))
        first = last
    sizes = np.array([len(w) for w in held], dtype=np.int64)
    both = np.concatenate(pairs) if pairs else np.zeros(0, dtype=np.int64)
    return np.frombuffer(b"".join(held), dtype=np.uint8), np.cumsum(sizes) - sizes, np.cumsum(sizes), both >> 32, both & 0xFFFFFFFF


def _landmark_matrix(codes, starts, ends) -> tuple[np.ndarray, np.ndarray]:
    """Triples that occur in the landmarks, and each landmark's normalised value for them."""
    found, values, owners = [], [], []
    rows = padded(codes, starts, ends)
    for index, weight in triples(rows):
        n, place = np.nonzero(index)
        found.append(index[n, place])
        owners.append(n)
        values.append(np.full(len(n), weight))
    numbers, which = np.unique(np.concatenate(found), return_inverse=True)
    matrix = np.zeros((len(numbers) + 1, len(starts)), dtype=np.float32)
    np.add.at(matrix, (which.ravel(), np.concatenate(owners)), np.concatenate(values))
    return numbers, matrix / norms(ends - starts).astype(np.float32)


def _kernels(codes, starts, ends, numbers, matrix) -> np.ndarray:
    """Kernel values of words with all landmarks."""
    place = np.full(CODES**3, len(numbers), dtype=np.int32)
    place[numbers] = np.arange(len(numbers))
    out = np.zeros((len(starts), matrix.shape[1]), dtype=np.float32)
    order = np.argsort(ends - starts, kind="stable")
    for first in range(0, len(order), 512):
        own = order[first : first + 512]
        for index, weight in triples(padded(codes, starts[own], ends[own])):
            out[own] += np.float32(weight) * matrix[place[index]].sum(axis=1)
    return out / norms(ends - starts).astype(np.float32)[:, None]


def _stretched(codes, starts, ends, rng, times: int = 4) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The given words again with one letter put in at a random place, ``times`` each, appended to the codes: further
    positive examples, so that the machine leaves room for inserted characters."""
    made = []
    for a, b in zip(starts.tolist(), ends.tolist()):
        for at in rng.integers(a + 1, b, times) if 4 <= b - a < LONGEST_WORD else ():
            made.append(np.r_[codes[a:at], np.uint8(rng.integers(1, 27)), codes[at:b]])
    sizes = np.array([len(x) for x in made], dtype=np.int64)
    first = len(codes) + np.cumsum(sizes) - sizes
    return np.concatenate([codes, *made]).astype(np.uint8), first, first + sizes


def _solve(x: np.ndarray, y: np.ndarray, cost: np.ndarray) -> np.ndarray:
    """Newton steps for 1/2 |w|^2 + sum cost * max(0, 1 - y x.w)^2; the last column of x is the offset's."""
    w = np.zeros(x.shape[1])
    for _ in range(30):
        near = y * (x @ w) < 1
        if not near.any():
            break
        own, c = x[near], cost[near]
        new = np.linalg.solve(np.eye(x.shape[1]) + 2 * (own.T * c) @ own, 2 * own.T @ (c * y[near]))
        if np.abs(new - w).max() < 1e-6:
            break
        w = new
    return w


def train(texts: list[bytes], labels: np.ndarray, share: float | None = None, seed: int = 5) -> Machine:
    """Fit the machine, and its probabilities for a share of label 1 as given (default: as in the labels). Without both labels every text gets that of the labels (0.5 without texts)."""
    machine = Machine()
    labels = np.asarray(labels, dtype=np.float64)
    if len(labels) == 0 or labels.min() == labels.max():
        only = (labels.sum() + 0.5) / (len(labels) + 1)
        machine.scale, machine.shift = 0.0, float(np.log(only / (1 - only)))
        return machine
    rng = np.random.default_rng(seed)
    codes, starts, ends, text, word = _vocabulary(texts)
    n = len(starts)
    toxic = labels[text] == 1
    in_toxic = np.bincount(word[toxic], minlength=n)
    in_clean = np.bincount(word[~toxic], minlength=n)
    clean_words = np.flatnonzero(in_clean)
    odds = (in_toxic + 0.1) / (labels.sum() + 0.2) / ((in_clean + 0.1) / ((1 - labels).sum() + 0.2))
    merit = np.where((in_toxic >= 2) & (odds > 8), in_toxic, 0).astype(np.float64)
    t_text, t_word = text[toxic], word[toxic]
    edges = np.flatnonzero(np.r_[True, t_text[1:] != t_text[:-1]])

    def best(values: np.ndarray) -> np.ndarray:
        """The word of the highest value in each toxic text."""
        own = values[t_word]
        top = np.maximum.reduceat(own, edges)
        at = np.flatnonzero(own == np.repeat(top, np.diff(np.r_[edges, len(own)])))
        return t_word[at[np.r_[True, t_text[at][1:] != t_text[at][:-1]]]]

    chosen = best(merit)
    # Copies of a text are one witness: texts are taken together by the smallest hash of their words.
    witness = np.repeat(np.minimum.reduceat(rng.permutation(n)[t_word], edges), np.diff(np.r_[edges, len(t_word)]))
    seen = np.bincount(np.unique(witness * n + t_word) % n, minlength=n)
    rate = labels.mean()
    uses = np.bincount(np.minimum(in_toxic + in_clean, 60), minlength=61)[::-1].cumsum()[::-1]
    # So many witnesses that about one word would have them by chance.
    least = next((k for k in range(2, 60) if rate**k * uses[k] <= 1), 60)
    shown = np.flatnonzero((odds > 8) & (seen >= least))
    positive = np.unique(np.r_[shown, chosen[merit[chosen] > 0]])
    if len(positive) == 0:
        positive = np.unique(best(odds))
    def fit(positive: np.ndarray, rng) -> tuple[np.ndarray, float]:
        """Weights and offset of one machine, from the first examples on."""
        hard = np.zeros(0, dtype=np.int64)
        common = positive[np.argsort(-in_toxic[positive], kind="stable")][: LANDMARKS // 2]
        own_codes, more_starts, more_ends = _stretched(codes, starts[common], ends[common], rng)
        stretched = n + np.arange(len(more_starts))
        own_starts, own_ends = np.r_[starts, more_starts], np.r_[ends, more_ends]
        for _ in range(TURNS):
            negative = np.unique(np.r_[rng.choice(clean_words, min(6_000, len(clean_words)), replace=False), hard, clean_words[np.argsort(-in_clean[clean_words])[:500]]])
            negative = np.setdiff1d(negative, positive)
            by_use = positive[np.argsort(-in_toxic[positive], kind="stable")]
            near = hard if len(hard) else negative
            marks = np.unique(np.r_[by_use[: LANDMARKS // 2], rng.choice(near, min(LANDMARKS // 4, len(near)), replace=False), rng.choice(negative, min(LANDMARKS // 4, len(negative)), replace=False)])
            numbers, matrix = _landmark_matrix(own_codes, own_starts[marks], own_ends[marks])
            between_marks = _kernels(own_codes, own_starts[marks], own_ends[marks], numbers, matrix).astype(np.float64)
            values, vectors = np.linalg.eigh((between_marks + between_marks.T) / 2)
            good = values > values.max() * 1e-4
            whiten = vectors[:, good] / np.sqrt(values[good])
            wanted = np.r_[positive, stretched]
            own = np.r_[wanted, negative]
            x = _kernels(own_codes, own_starts[own], own_ends[own], numbers, matrix) @ whiten
            y = np.r_[np.ones(len(wanted)), -np.ones(len(negative))]
            cost = np.where(y > 0, 0.5 * len(own) / len(wanted), 0.5 * len(own) / max(1, len(negative))) * 4
            w = _solve(np.c_[x, np.full(len(x), 3.0)], y, cost)
            weights = np.zeros(CODES**3, dtype=np.float32)
            weights[numbers] = (matrix[:-1] @ (whiten @ w[:-1])).astype(np.float32)
            weights[0] = 0
            offset = float(3.0 * w[-1])
            margin = folded(codes, starts, ends, weights) + offset
            positive = np.r_[positive[in_clean[positive] == 0], best(np.where(in_clean > 0.02 * (1 - labels).sum(), -9, margin))]
            positive = np.unique(np.r_[shown, positive[margin[positive] > -0.5]])
            if len(positive) == 0:
                positive = np.unique(best(margin))
            hard = clean_words[np.argsort(-margin[clean_words])[:2_000]]
        return weights, offset

    # Machines differ by the words drawn; their mean is one machine again, as margins are linear in the weights.
    fits = [fit(positive, np.random.default_rng(seed + k)) for k in range(FITS)]
    machine.weights = np.mean([w for w, _ in fits], axis=0, dtype=np.float32)
    machine.offset = float(np.mean([o for _, o in fits]))
    margin = folded(codes, starts, ends, machine.weights) + machine.offset
    top = np.full(len(texts), machine.floor)
    np.maximum.at(top, text, margin[word])
    _calibrate(machine, top, labels, labels.mean() if share is None else share)
    return machine


def _calibrate(machine: Machine, top: np.ndarray, labels: np.ndarray, share: float) -> None:
    """Logistic regression of the label on the worst margin, classes weighted as they are in the corpus."""
    weight = np.where(labels == 1, share / labels.mean(), (1 - share) / (1 - labels.mean()))
    scale, shift = 1.0, 0.0
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(scale * top + shift, -30, 30)))
        h = weight * p * (1 - p)
        g = np.array([(weight * (p - labels) * top).sum() + 0.05 * (scale - 1), (weight * (p - labels)).sum()])
        m = np.array([[(h * top * top).sum() + 0.05, (h * top).sum()], [(h * top).sum(), h.sum() + 1e-6]])
        move = np.clip(np.linalg.solve(m, g), -1, 1)
        scale, shift = scale - float(move[0]), shift - float(move[1])
    machine.scale, machine.shift = max(scale, 0.05), shift


def score_batches(batches: Iterator[pa.RecordBatch], machine: Machine, keep: list[str]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows, data, bounds in parts(batch):
            yield pa.RecordBatch.from_arrays([*(rows.column(c) for c in keep), pa.array(machine.probabilities(data, bounds).astype(np.float64))], names=[*keep, "score"])


def score(docs: DataFrame, machine: Machine) -> DataFrame:
    """``docs`` with a column score (0 to 1, the probability of being toxic) for every row, from all its words.

    Null and empty texts, and texts without letters or digits, have the score of the lowest margin; repeated rows are
    scored each; an empty table gives an empty result. A column named score is replaced; other columns stay."""
    keep = [c for c in docs.columns if c != "score"]
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields if f.name != "score")
    shared = docs.sparkSession.sparkContext.broadcast(machine)
    return docs.select(*[f"`{c}`" for c in keep]).mapInArrow(lambda it: score_batches(it, shared.value, keep), f"{fields}, score double")


def held_out(doc_id):
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of every document."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    scored = score(docs, train(*labelled(docs, table(spark, folder, "labels"), "toxic", held_out, SAMPLE)))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))
