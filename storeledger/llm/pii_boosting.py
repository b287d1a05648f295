"""Personal data: fixed rules, and boosted trees over candidate spans.

Spans that the rules of a kind accept always count. High-recall generators propose
further, overlapping spans; boosted trees judge their format and context, and
those above a calibrated threshold are added where they overlap no accepted span.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import documents, free_name, text_of, with_columns

KINDS = ("email", "ip", "card", "phone")
Span = tuple[int, int, int]  # kind, start, end

#: Bounds of the training sample: documents, characters of one document, candidates.
SAMPLE_DOCS = 4_000
SAMPLE_CHARS = 100_000
SAMPLE_CANDIDATES = 60_000

_HINT = re.compile(r"[0-9@]")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for k, digit in enumerate(reversed(digits)):
        n = int(digit) * (1 + k % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _emails(text: str) -> list[Span]:
    """As the pattern ``local+@domain`` finds them, in time linear in the text: a local part is the run before its sign."""
    found, done, at = [], 0, text.find("@")
    while at >= 0:
        if at >= done and (domain := _DOMAIN.match(text, at)):
            start = at
            while start > done and text[start - 1] in _LOCAL:
                start -= 1
            if start < at:
                found.append((0, start, domain.end()))
                done = domain.end()
        at = text.find("@", at + 1)
    return found


def base_spans(text: str) -> list[Span]:
    """Spans the rules accept, leftmost and without overlaps within a kind, by start and then kind."""
    if not _HINT.search(text):
        return []
    found = _emails(text)
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            found.append((1, *m.span()))
    for m in _CARD.finditer(text):
        digits = re.sub(r"[^0-9]", "", m[0])
        if 14 <= len(digits) <= 19 and luhn(digits):
            found.append((2, *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
                found.append((3, *m.span()))
    return sorted(found, key=lambda s: (s[1], s[0]))


#: Generators by kind: anything that has the rough shape, valid or not. Runs are bounded, so each takes linear time.
_SHAPES = (
    (0, re.compile(r"(?<![\w.%+-])[\w.%+-]{1,64}(?:@|\s?[\[(](?:at|AT)[\])]\s?)[\w-]{1,63}(?:(?:\.|\s?[\[(](?:dot|DOT)[\])]\s?)[\w-]{1,63}){0,5}")),
    (1, re.compile(r"(?<![0-9.])[0-9]{1,3}(?:[.,][0-9]{1,3}){3}(?![0-9])")),
    (2, re.compile(r"(?<![0-9])[0-9]++(?:[ .-][0-9]++){0,7}+")),
    (3, re.compile(r"(?<![0-9])\+?\(?[0-9]{1,4}\)?(?:[ ().-]{1,2}[0-9]{2,5}){1,5}(?![0-9])")),
    (3, re.compile(r"(?<![0-9+])[0-9]{8,15}(?![0-9])")),
)
_AT = re.compile(r"@|[\[(](?:at|AT)[\])]")


def candidates(text: str) -> list[Span]:
    """Overlapping proposals of the generators, every one once, by start, kind and end."""
    found = set()
    for kind, shape in _SHAPES:
        if _AT.search(text) if kind == 0 else _HINT.search(text):
            found.update((kind, *m.span()) for m in shape.finditer(text) if kind != 2 or 8 <= len(re.sub("[^0-9]", "", m[0])) <= 24)
    return sorted(found, key=lambda s: (s[1], s[0], s[2]))


_SPELT_AT, _SPELT_DOT = re.compile(r"\s?[\[(](?:at|AT)[\])]\s?"), re.compile(r"\s?[\[(](?:dot|DOT)[\])]\s?")
_EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")


def masked(own: str, kind: int) -> str:
    """A candidate without the signs by which the rules tell it: spelt-out signs written, ``+`` left out, separators alike."""
    if kind == 0:
        return _SPELT_DOT.sub(".", _SPELT_AT.sub("@", own))
    if kind == 1:
        return own.replace(",", ".")
    return re.sub("[.-]", " ", own) if kind == 2 else own.lstrip("+")


def possible(own: str, kind: int) -> bool:
    """Whether a masked candidate can be of its kind at all: a whole address, parts up to 255, a card's sum, a phone's digits."""
    if kind == 0:
        return _EMAIL.fullmatch(own) is not None
    if kind == 1:
        return all(int(p) <= 255 for p in own.split("."))
    digits = re.sub("[^0-9]", "", own)
    return 14 <= len(digits) <= 19 and luhn(digits) if kind == 2 else 10 <= len(digits) <= 15


def features(text: str, span: Span) -> list[float]:
    """Format of a span, masked, and of what stands around it."""
    kind, start, end = span
    own = masked(text[start:end], kind)
    # a plus sign nearby is masked too, as it shifts what is seen of the surroundings
    before, after = text[max(0, start - 32) : start].replace("+", "")[-24:], text[end : end + 32].replace("+", "")[:24]
    digits = [c for c in own if "0" <= c <= "9"]
    runs = [len(r) for r in re.findall(r"[0-9]+", own)] or [0]
    tail = re.split(r"[^A-Za-z0-9]+", own)[-1]
    left, right = text[max(0, start - 1) : start], text[end : end + 1]
    return [
        *(float(kind == k) for k in range(4)),
        len(own), len(digits), len(digits) / max(1, len(own)), len(runs), max(runs), min(runs), runs[0], runs[-1],
        own.count("."), own.count("-"), own.count(" "), float("(" in own), float(possible(own, kind)),
        sum(c.isalpha() for c in own), len(tail), float(tail.isalpha()), float(own[:1] == "0"),
        float(digits[:1] == ["4"]), len(set(digits)), float(not left or left.isspace()), float(not right or right.isspace()),
        float(left.isalnum()), float(right.isalnum()), float(left in "+-.@/#=" and left != ""), float(right in "-.@/#=%" and right != ""),
        sum(c.isdigit() for c in before), sum(c.isdigit() for c in after), float(":" in before[-3:]),
    ]


@dataclass
class Trees:
    """Boosted trees of depth three; ``thresholds`` are the least log odds, by kind, at which a span is added."""

    splits: list[tuple[np.ndarray, np.ndarray, np.ndarray]]  # features, cut points and leaf values of each tree
    start: float
    thresholds: np.ndarray

    def log_odds(self, rows: np.ndarray) -> np.ndarray:
        total = np.full(len(rows), self.start)
        for which, cuts, leaves in self.splits:
            at = np.zeros(len(rows), int)
            for _ in range(3):
                at = 2 * at + 1 + (rows[np.arange(len(rows)), which[at]] > cuts[at])
            total += leaves[at - 7]
        return total


NO_TREES = Trees([], -40.0, np.full(4, np.inf))


def _tree(bins: np.ndarray, edges: list[np.ndarray], slope: np.ndarray, curve: np.ndarray, rate: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """One tree by histograms of slope and curvature over binned features; also the leaf of each row."""
    n, width = bins.shape
    which, cuts, at = np.zeros(7, int), np.full(7, np.inf), np.zeros(n, int)
    most = max(len(e) for e in edges) + 1
    for node in range(7):
        rows = np.flatnonzero(at == node)
        best = (1e-6, 0, None)
        for f in range(width) if len(rows) > 1 else ():
            g = np.cumsum(np.bincount(bins[rows, f], slope[rows], most))
            h = np.cumsum(np.bincount(bins[rows, f], curve[rows], most))
            gain = g**2 / (h + 1) + (g[-1] - g) ** 2 / (h[-1] - h + 1) - g[-1] ** 2 / (h[-1] + 1)
            k = int(np.argmax(gain[:-1])) if len(edges[f]) else 0
            if len(edges[f]) > k and gain[k] > best[0]:
                best = (gain[k], f, k)
        if best[2] is not None:
            which[node], cuts[node] = best[1], edges[best[1]][best[2]]
        at[rows] = 2 * node + 1 + (bins[rows, which[node]] > best[2] if best[2] is not None else 0)
    leaf = at - 7
    value = np.bincount(leaf, slope, 8) / (np.bincount(leaf, curve, 8) + 1)
    return which, cuts, rate * value, leaf


def boost(rows: np.ndarray, labels: np.ndarray, precision: float = 0.98, trees: int = 60, rate: float = 0.2, wrong: np.ndarray | None = None) -> Trees:
    """Trees fitted on two thirds of the rows; thresholds calibrated on the rest.

    Labels are positive or unknown (Elkan and Noto, 2008): the trees give the chance that a candidate is
    labelled, and that over the labelled share, which is the mean chance of held-back labelled candidates
    of the kind, is the chance that it is personal data; it is none for the candidates in ``wrong``.
    Of each kind, the threshold is the least score from which on the held-back candidates are
    personal data in at least ``precision`` of the cases by these chances (one more miss assumed); a
    kind that never gets there adds nothing.
    """
    if len(set(labels)) < 2:
        return NO_TREES
    fold = np.arange(len(rows)) % 3 == 2
    edges = [np.unique(np.quantile(rows[~fold, f], np.linspace(0, 1, 33)))[:-1] for f in range(rows.shape[1])]
    bins = np.stack([np.searchsorted(e, rows[:, f], "left") for f, e in enumerate(edges)], 1)
    mean = np.clip(labels[~fold].mean(), 1e-3, 1 - 1e-3)
    model = Trees([], float(np.log(mean / (1 - mean))), np.full(4, np.inf))
    score = np.full((~fold).sum(), model.start)
    for _ in range(trees):
        chance = 1 / (1 + np.exp(-score))
        which, cuts, leaves, leaf = _tree(bins[~fold], edges, labels[~fold] - chance, chance * (1 - chance), rate)
        model.splits.append((which, cuts, leaves))
        score += leaves[leaf]
    for kind in range(4):
        some = np.flatnonzero(fold & (rows[:, kind] > 0))
        if not labels[some].any():
            continue
        odds = model.log_odds(rows[some])
        order = np.argsort(-odds, kind="stable")
        chance = 1 / (1 + np.exp(-odds))
        true = np.where(labels[some] > 0, 1.0, np.minimum(1, chance / chance[labels[some] > 0].mean()))
        if wrong is not None:
            true[wrong[some]] = 0
        right = np.cumsum(true[order]) / (np.arange(len(some)) + 2)
        ends = np.append(np.diff(odds[order]) != 0, True) if len(some) else np.empty(0, bool)
        good = np.flatnonzero((right >= precision) & ends)
        if len(good):
            model.thresholds[kind] = odds[order][good[-1]]
    return model


def fit(docs: DataFrame, n_docs: int = SAMPLE_DOCS, most_chars: int = SAMPLE_CHARS) -> Trees:
    """Trees learned from a bounded sample of documents that hold a digit or an at sign.

    The rules teach the trees: a candidate is labelled if a rule accepts just that span as
    that kind. Others are unknown, and wrong if they cannot be of their kind; those that overlap an
    accepted span can never be added and teach nothing. The signs by which the rules tell
    a kind are masked, so the trees must judge by shape and surroundings.
    """
    rows = documents(docs).where(F.col("text").rlike("[0-9@]") & (F.length("text") <= most_chars)).select("text", F.xxhash64("text").alias("h"))
    # the texts of least hash; a threshold keeps all but about twice as many where they are
    different = rows.agg(F.approx_count_distinct("h")).first()[0]
    below = min((1 << 63) - 1, int(2 * n_docs / max(different, 1) * (1 << 64)) - (1 << 63))
    few = rows.where(F.col("h") <= F.lit(below)).groupBy("h").agg(F.min("text").alias("text"))
    texts = [r.text for r in few.orderBy("h").limit(n_docs).collect()]
    taught, labels, wrong = [], [], []
    for text in texts:
        base, covered = base_spans(text), bytearray(len(text))
        accepted = set(base)
        for _, start, end in base:
            covered[start:end] = b"\1" * (end - start)
        for span in candidates(text):
            kind, start, end = span
            if len(labels) < SAMPLE_CANDIDATES and (span in accepted or covered.find(1, start, end) < 0):
                taught.append(features(text, span))
                labels.append(float(span in accepted))
                wrong.append(span not in accepted and not possible(masked(text[start:end], kind), kind))
    return boost(np.array(taught, float), np.array(labels), wrong=np.array(wrong)) if labels else NO_TREES


def all_spans(text: str, model: Trees) -> tuple[list[Span], list[Span]]:
    """The accepted spans, and those with the added ones, both by start and then kind."""
    base = base_spans(text)
    more = candidates(text)
    if not more:
        return base, base
    odds = model.log_odds(np.array([features(text, s) for s in more], float))
    taken, covered = list(base), bytearray(len(text))
    for _, start, end in base:
        covered[start:end] = b"\1" * (end - start)
    for k in sorted(range(len(more)), key=lambda k: (-odds[k], more[k][1], more[k][0])):
        kind, start, end = more[k]
        if odds[k] >= model.thresholds[kind] and covered.find(1, start, end) < 0:
            taken.append(more[k])
            covered[start:end] = b"\1" * (end - start)
    return base, sorted(taken, key=lambda s: (s[1], s[0], s[2]))


def _written(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)


def personal_data(docs: DataFrame, model: Trees) -> DataFrame:
    """Per row of ``docs`` its ``doc_id``, counts of accepted spans by kind, their hash, and all spans.

    Whole texts, null as empty (no spans); repeated rows stay repeated; an empty table
    gives an empty one; extra columns are left out. No shuffle.
    """

    def start():
        def spans(texts: pa.Array) -> list[pa.Array]:
            counts, hashes, written = np.zeros((4, len(texts)), np.int64), [], []
            for row, text in enumerate(texts.to_pylist()):
                base, every = all_spans(text, model)
                for kind, _, _ in base:
                    counts[kind, row] += 1
                hashes.append(hashlib.sha256(_written(base).encode()).hexdigest())
                written.append(_written(every))
            return [*map(pa.array, counts), pa.array(hashes, pa.string()), pa.array(written, pa.string())]

        return spans

    new = "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"
    return with_columns(documents(docs), new, start).drop("text")


def redact(text: str, spans: list[Span]) -> str:
    """The text with every span, overlapping ones together, replaced by the first one's kind in brackets."""
    out, done = [], 0
    for kind, start, end in spans:
        if start >= done:
            out += [text[done:start], f"[{KINDS[kind].upper()}]"]
        done = max(done, end)
    return "".join([*out, text[done:]])


def redacted_texts(docs: DataFrame, model: Trees, new: str = "redacted") -> DataFrame:
    """``docs`` with each text's redacted form in the further column ``new`` (with underscores if the name is taken)."""

    def start():
        return lambda texts: [pa.array([redact(t, all_spans(t, model)[1]) for t in texts.to_pylist()], pa.string())]

    return with_columns(docs, f"{new} string", start)


def redact_documents(docs: DataFrame, model: Trees) -> DataFrame:
    """``docs`` with redacted texts, ``n_chars`` set to their lengths, and all other columns as they were.

    A null text stays null.
    """
    clean = free_name(docs, "redacted")
    text: Column = F.when(F.col("text").isNotNull(), F.col(clean))
    changed = redacted_texts(docs, model, clean).withColumn("text", text)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        changed = changed.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length(text_of())).cast(kind))
    return changed.select(*docs.columns)
