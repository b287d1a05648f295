"""Document quality from a linear-chain conditional random field over lines."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import documents, free_name, with_columns
from .pieces import slices

#: Bounds of the training sample: documents of each label, and characters of one document.
SAMPLE_PER_LABEL = 2_000
SAMPLE_CHARS = 100_000

_KINDS = ("lower", "upper", "digit", "stop", "symbol", "space", "other")
_KIND = np.full(256, _KINDS.index("other"), np.uint8)
for _name, _chars in (
    ("lower", b"abcdefghijklmnopqrstuvwxyz"),
    ("upper", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    ("digit", b"0123456789"),
    ("stop", b".,;:?!'\"()-"),
    ("symbol", b"#$%&*+/<=>@[\\]^_`{|}~"),
    ("space", b" \t\r\n\x0b\x0c"),
):
    _KIND[list(_chars)] = _KINDS.index(_name)
_SALT = np.random.default_rng(11).integers(1 << 63, size=256, dtype=np.uint64) | np.uint64(1)

#: Cut points of the measures of a line; a measure becomes the indicators of being above each of them.
_SHARES = (0.002, 0.01, 0.03, 0.08, 0.2, 0.4, 0.7)
_CUTS = {
    "bytes": (8, 24, 64, 128, 256, 512, 1024, 4096),
    "word_bytes": (2, 3, 4, 5, 6, 8, 11, 16, 30),
    **{k: _SHARES for k in ("upper", "digit", "stop", "symbol", "other")},
    "repeated": (0.01, 0.03, 0.1, 0.3, 0.6),
    "same_line": (0.5,),
}
WIDTH = sum(map(len, _CUTS.values()))


def line_features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Indicators of every line, its length in bytes plus one, and where the lines of each text begin (and the last end).

    Every text has at least one line; an empty one is a line of no bytes.
    """
    data = np.frombuffer(("\n".join(texts.to_pylist()) + "\n").encode("utf-8", "surrogatepass"), np.uint8)
    ends = np.flatnonzero(data == 10)
    starts = np.append(0, ends[:-1] + 1)
    size = ends - starts + 1  # with the line end, which counts as white space
    n_lines = 1 + pc.count_substring(texts, "\n").to_numpy(zero_copy_only=False)
    of_text = np.append(0, np.cumsum(n_lines))
    kind = _KIND[data]
    count = {k: np.add.reduceat((kind == v).view(np.int8), starts, dtype=np.int64) for v, k in enumerate(_KINDS)}
    blank = kind == _KINDS.index("space")
    word_ends = np.flatnonzero(blank & ~np.append(True, blank[:-1]))
    n_words = np.diff(np.searchsorted(word_ends, np.append(starts, len(data))))
    # a hash of every word: the sum of its bytes' salts, taken from running sums
    total = np.cumsum(_SALT[data] * ~blank)
    at_ends = total[word_ends] if len(word_ends) else np.empty(0, np.uint64)
    words = np.diff(at_ends, prepend=np.uint64(0))
    repeated = np.append(False, words[1:] == words[:-1])
    repeats = np.diff(np.append(0, np.cumsum(repeated))[np.searchsorted(word_ends, np.append(starts, len(data)))])
    line_hash = np.diff(total[ends], prepend=np.uint64(0))
    same = np.append(False, line_hash[1:] == line_hash[:-1]) & (n_words > 0)
    same[of_text[:-1]] = False
    inked = np.maximum(size - count["space"], 1)
    measures = {"bytes": size, "word_bytes": inked / np.maximum(n_words, 1), "repeated": repeats / np.maximum(n_words, 1), "same_line": same}
    measures |= {k: count[k] / inked for k in ("upper", "digit", "stop", "symbol", "other")}
    indicators = [measures[k] > cut for k, cuts in _CUTS.items() for cut in cuts]
    return np.stack(indicators, 1).astype(np.float32), size, of_text


@dataclass
class Chain:
    """Weights of the good label over the bad one: of a line, of the lines before and after it, and of pairs of labels."""

    weights: np.ndarray  # (3 * WIDTH + 1,)
    pairs: np.ndarray  # (2, 2), from label, to label

    def emissions(self, lines: np.ndarray, of_text: np.ndarray) -> np.ndarray:
        own, before, after = (lines @ self.weights[k * WIDTH : (k + 1) * WIDTH] for k in range(3))
        first, last = np.zeros(len(lines), bool), np.zeros(len(lines), bool)
        first[of_text[:-1]] = last[of_text[1:] - 1] = True
        own = own + self.weights[-1]
        own += np.where(first, 0, np.append(0, before[:-1])) + np.where(last, 0, np.append(after[1:], 0))
        return own

    def marginals(self, score: np.ndarray, of_text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per line the log odds of being good; per text the sums of its pair marginals; per text the log of the partition function.

        Forward and backward recurrences step along all texts at once, longest first.
        """
        n = np.diff(of_text)
        order = np.argsort(-n, kind="stable")
        starts, n = of_text[:-1][order], n[order]
        longest = int(n[0]) if len(n) else 0
        alive = np.searchsorted(-n, -np.arange(longest), "left")  # texts with more than t lines
        forward = np.zeros((len(score), 2))
        for t in range(longest):
            k = alive[t]
            at = starts[:k] + t
            if t:
                last = forward[at - 1]
                forward[at] = np.logaddexp(last[:, :1] + self.pairs[0], last[:, 1:] + self.pairs[1])
            forward[at, 1] += score[at]
        backward = np.zeros((len(score), 2))
        for t in range(longest - 2, -1, -1):
            at = starts[: alive[t + 1]] + t
            after = backward[at + 1].copy()
            after[:, 1] += score[at + 1]
            backward[at] = np.logaddexp(after[:, :1] + self.pairs[:, 0], after[:, 1:] + self.pairs[:, 1])
        ends = of_text[1:] - 1
        log_z = np.logaddexp(forward[ends, 0], forward[ends, 1])
        both = forward + backward
        text_of_line = np.repeat(np.arange(len(of_text) - 1), np.diff(of_text))
        inner = np.ones(len(score), bool)
        inner[ends] = False
        inner = np.flatnonzero(inner)
        joint = forward[inner][:, :, None] + self.pairs + backward[inner + 1][:, None, :]
        joint[:, :, 1] += score[inner + 1][:, None]
        joint = np.exp(joint - log_z[text_of_line[inner]][:, None, None])
        sums = np.zeros((len(of_text) - 1, 2, 2))
        np.add.at(sums, text_of_line[inner], joint)
        return both[:, 1] - both[:, 0], sums, log_z

    def scores(self, texts: pa.Array) -> np.ndarray:
        """Per text the mean chance of its lines to be good, weighted by their lengths."""
        lines, size, of_text = line_features(texts)
        odds, _, _ = self.marginals(self.emissions(lines, of_text), of_text)
        good = 1 / (1 + np.exp(-np.clip(odds, -40, 40)))
        return np.add.reduceat(good * size, of_text[:-1]) / np.add.reduceat(size, of_text[:-1])


def train(texts: pa.Array, labels: np.ndarray, weights: np.ndarray, steps: int = 150, ridge: float = 2e-3) -> Chain:
    """Fit a chain to texts whose lines all take their text's label, by full-batch Adam on the conditional likelihood."""
    lines, _, of_text = line_features(texts)
    n = np.diff(of_text)
    own = np.repeat(labels, n).astype(float)
    share = np.repeat(weights / weights.sum(), n)
    first, last = np.zeros(len(lines), bool), np.zeros(len(lines), bool)
    first[of_text[:-1]] = last[of_text[1:] - 1] = True
    before, after = np.vstack([lines[:1] * 0, lines[:-1]]), np.vstack([lines[1:], lines[:1] * 0])
    before[first], after[last] = 0, 0
    matrix = np.hstack([lines, before, after, np.ones((len(lines), 1), np.float32)])
    del lines, before, after
    chain = Chain(np.zeros(matrix.shape[1]), np.zeros((2, 2)))
    seen = np.zeros((len(labels), 2, 2))
    seen[np.arange(len(labels)), labels, labels] = n - 1
    state = np.zeros((2, len(chain.weights) + 4))
    for step in range(1, steps + 1):
        odds, sums, _ = chain.marginals((matrix @ chain.weights.astype(np.float32)).astype(float), of_text)
        good = 1 / (1 + np.exp(-np.clip(odds, -40, 40)))
        slope = np.append((share * (own - good)).astype(np.float32) @ matrix, ((weights / weights.sum())[:, None, None] * (seen - sums)).sum(0).ravel())
        slope -= ridge * np.append(chain.weights, chain.pairs.ravel())
        state = np.array([[0.9], [0.99]]) * state + np.array([[0.1], [0.01]]) * np.array([slope, slope**2])
        move = 0.1 * (state[0] / (1 - 0.9**step)) / (np.sqrt(state[1] / (1 - 0.99**step)) + 1e-8)
        chain = Chain(chain.weights + move[:-4], chain.pairs + move[-4:].reshape(2, 2))
    return chain


def held_out(doc_id: Column) -> Column:
    """True for the third of documents that no model may learn from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, per_label: int = SAMPLE_PER_LABEL, most_chars: int = SAMPLE_CHARS) -> Chain:
    """A chain trained on a bounded sample of the labelled documents that are not held out.

    Of each label, the ``per_label`` documents of the least hash, without those of more than
    ``most_chars`` characters; each label weighs what it has among all training rows. A sample without
    both labels gives a chain that scores every text by the share of good rows (one half without rows).
    """
    rows = labels.where(~held_out(F.col("doc_id")) & F.col("quality").isin(0, 1)).select("doc_id", "quality")
    share = {q: n for q, n in rows.groupBy("quality").count().collect()}
    once = rows.dropDuplicates(["doc_id"])
    bad, good = (once.where(F.col("quality") == q).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_label) for q in (0, 1))
    # at most two times per_label ids, and as many texts of at most most_chars characters
    picked = documents(docs).join(F.broadcast(bad.unionByName(good)), "doc_id").where(F.length("text") <= most_chars)
    sample = picked.groupBy("doc_id").agg(F.min("text").alias("text"), F.min("quality").alias("quality")).orderBy("doc_id").toArrow()
    quality = sample.column("quality").to_numpy().astype(int)
    if len(set(quality)) < 2:
        good = (share.get(1, 0) + 1) / (sum(share.values()) + 2)
        return Chain(np.append(np.zeros(3 * WIDTH), np.log(good / (1 - good))), np.zeros((2, 2)))
    weights = np.where(quality == 1, share[1] / (quality == 1).sum(), share[0] / (quality == 0).sum())
    return train(sample.column("text").combine_chunks(), quality, weights)


def quality_scores(docs: DataFrame, chain: Chain, new: str = "score") -> DataFrame:
    """``docs`` with the score of each text, 0 to 1, in the further column ``new`` (with underscores if the name is taken).

    Null texts score as empty ones, which are one line of no bytes. Whole texts are read,
    in batches of bounded bytes. Equal texts score alike; no shuffle.
    """

    def start():
        return lambda texts: [pa.array(np.concatenate([np.empty(0), *(chain.scores(some) for some in slices(texts, 1 << 20))]))]

    return with_columns(docs, f"{new} double", start)


def keep_good(docs: DataFrame, chain: Chain, least: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose text scores at least ``least``, with their columns as they were."""
    score = free_name(docs, "quality_score")
    return quality_scores(docs, chain, score).where(F.col(score) >= least).select(*docs.columns)
