"""Licence scan: a trained paragraph classifier, confirmed by templates.

Sparse word n-grams (one and two words, hashed) feed a softmax regression over
licence families and *unknown*.  It learns from variants of published passages
and, as unknown, from paragraphs of the corpus (a bounded sample, ``NEGATIVES``
documents or so, by least hash) and from shuffled passages.  A held-out part sets the
temperature of its probabilities and the probability below which a paragraph is
unknown.  A family that is predicted is confirmed if one of its templates
matches enough three-word runs of the paragraph, close together.

A paragraph is a block of lines that have words, so a line of comment marks alone
ends it as a blank one does.  Each line of it is read in overlapping windows, so
that a notice inside prose stands out, and so is the paragraph as a whole, so that
a wrapped notice does.  Every paragraph of every text is classified.

Defined cases: a null or empty text has no paragraphs; nothing is found in an
empty corpus; ties go to the family first in order; rows repeat as they are.  A
very long text is read window by window; ``keep`` columns pass through and others,
also of clashing names, are not read; an empty table gives no rows.
"""

from __future__ import annotations

import bisect
import random
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import hash_sample, map_batches, slices, text_bytes
from .hashing import LOWER, mix, prefix_sums, spans, word_spans
from .license_templates import TEMPLATES

UNKNOWN = "unknown"
BITS = 16
#: Words of a window and between windows.
WINDOW, STRIDE = 40, 20
#: Documents that unknown paragraphs are drawn from, and paragraphs drawn; variants of each passage.
NEGATIVES, PARAGRAPHS, VARIANTS = 1000, 8000, 60
#: Share of matching runs in the stretch that a template matches, and runs that match at least (or all of a short template).
CONFIRMED, RUNS = 0.6, 8
_SCALE = 12.0

_WORDY = LOWER.copy()
_WORDY[:128][[not chr(b).isalnum() and chr(b) != "\n" for b in range(128)]] = 32


def _cut(head: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """First word and end of each window of the stretches that begin at ``head``."""
    size = np.diff(np.append(head, end))
    n = np.maximum(1, -(-(size - WINDOW) // STRIDE) + 1)
    inside = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    first = np.repeat(head, n) + inside * STRIDE
    return first, np.minimum(first + WINDOW, np.repeat(head + size, n))


def windows(raw: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]:
    """Word hashes; first and last word of each window, the bytes where each word
    starts and ends, paragraph of each window; how many windows, the first ones,
    are within a line (the others cross lines of their paragraph)."""
    text = _WORDY[raw]
    start, end, count = word_spans(text, rows)
    words = spans(prefix_sums(text, 0), start, end, 0)
    doc = np.repeat(np.arange(len(count)), count)
    line = np.cumsum(raw == 10)[start] if len(start) else np.empty(0, np.int64)
    other = doc[1:] != doc[:-1]
    begin = [np.flatnonzero(np.concatenate([[True], other | (np.diff(line) > gap)])) if len(start) else np.empty(0, np.int64) for gap in (0, 1)]
    (first, last), (wide, far) = _cut(begin[0], len(start)), _cut(begin[1], len(start))
    across = line[wide] != line[far - 1]
    first, last, lines = np.append(first, wide[across]), np.append(last, far[across]), len(first)
    return words, first, last, np.stack([start, end], axis=1), np.searchsorted(begin[1], first, "right") - 1, lines


def buckets(words: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Feature buckets of all windows, one after another, and where each starts:
    words and pairs of words."""
    size = last - first
    place = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size) + np.repeat(first, size)
    one = words[place] >> np.uint64(64 - BITS)
    after = np.minimum(place + 1, len(words) - 1)
    two = mix(words[place] * np.uint64(3) + words[after]) >> np.uint64(64 - BITS)
    two = np.where(place + 1 < np.repeat(last, size), two, one)  # the last word stands for itself again
    return np.stack([one, two], axis=1).ravel().astype(np.int64), 2 * (np.cumsum(size) - size)


@dataclass
class Model:
    families: list[str]  # the last is unknown
    weights: np.ndarray  # buckets x families
    bias: np.ndarray
    temperature: float
    threshold: float

    def probabilities(self, flat: np.ndarray, heads: np.ndarray) -> np.ndarray:
        size = np.diff(np.append(heads, len(flat)))
        logits = _SCALE * np.add.reduceat(self.weights[flat], heads, axis=0) / size[:, None] + self.bias
        return softmax(logits / self.temperature)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets, heads, and the text of each window."""
    data = [t.encode() for t in texts]
    rows = np.concatenate([[0], np.cumsum([len(d) for d in data])])
    words, first, last, at, _, _ = windows(np.frombuffer(b"".join(data), np.uint8), rows)
    flat, heads = buckets(words, first, last)
    return flat, heads, np.searchsorted(rows, at[first, 0], "right") - 1


def runs_of(text: str) -> set[tuple[str, ...]]:
    w = re.findall(r"[^\W_]+", text.lower())
    return {tuple(w[i : i + 3]) for i in range(len(w) - 2)} or {tuple(w)}


_RUNS = {f: [runs_of(t) for t in many] for f, many in TEMPLATES.items()}


def overlap(text: str, family: str) -> float:
    """How much of the stretch that a template of the family matches, at best, is
    the template's: matching three-word runs, of all runs from the first to the
    last that match.  Fewer runs than the template has, or ``RUNS``, are no match."""
    w = re.findall(r"[^\W_]+", text.lower())
    own = [tuple(w[i : i + 3]) for i in range(len(w) - 2)] or [tuple(w)]
    best = 0.0
    for template in _RUNS[family]:
        at = [i for i, r in enumerate(own) if r in template]
        if len(at) >= min(len(template), RUNS):
            best = max(best, len(at) / (at[-1] - at[0] + 1))
    return best


def examples(prose: list[str], seed: int = 3) -> tuple[list[str], list[str]]:
    """Texts to learn from and their families."""
    rng = random.Random(seed)
    words = [w for t in prose[:500] for w in t.split()[:40]] or ["a"]
    texts, labels = [], []
    for family, many in TEMPLATES.items():
        for template in many:
            own = template.split()
            for v in range(VARIANTS):
                w = list(own)
                if v:
                    lo = rng.randrange(max(1, len(w) // 3)) if len(w) > 12 else 0
                    w = [x for x in w[lo : lo + WINDOW] if len(own) < 8 or rng.random() > 0.08]
                    w = [rng.choice(words) for _ in range(rng.randint(0, 8))] + w + [rng.choice(words) for _ in range(rng.randint(0, 8))]
                texts.append(" ".join(w))
                labels.append(family)
            for _ in range(VARIANTS // 4):  # its words, but not its passage
                w = own + [rng.choice(words) for _ in range(len(own))]
                rng.shuffle(w)
                texts.append(" ".join(w[: max(4, len(own))]))
                labels.append(UNKNOWN)
    return texts + prose, labels + [UNKNOWN] * len(prose)


def fit(prose: list[str], steps: int = 120) -> Model:
    """The model, from the templates and paragraphs that hold no licence."""
    families = [*TEMPLATES, UNKNOWN]
    texts, labels = examples([p for p in prose if all(overlap(p, f) < 0.3 for f in TEMPLATES)])
    flat, heads, of = _features(texts)
    target = np.array([families.index(labels[i]) for i in of])
    size = np.diff(np.append(heads, len(flat)))
    # a fifth of the examples, those of whole variants, is held out to calibrate on
    out = of % 5 == 4
    used, flat = np.unique(flat, return_inverse=True)
    window = np.repeat(np.arange(len(heads)), size)
    goal = np.eye(len(families))[target]
    weight = np.where(out, 0.0, 1.0)[:, None] * (1 / np.bincount(target, minlength=len(families)))[target][:, None]
    weight /= weight.sum()
    w, b = np.zeros((len(used), len(families))), np.zeros(len(families))
    m, v, mb, vb = np.zeros_like(w), np.zeros_like(w), np.zeros_like(b), np.zeros_like(b)

    def logits() -> np.ndarray:
        return _SCALE * np.add.reduceat(w[flat], heads, axis=0) / size[:, None] + b

    for step in range(1, steps + 1):
        error = (softmax(logits()) - goal) * weight
        part = (error * _SCALE / size[:, None])[window]
        grad = np.stack([np.bincount(flat, part[:, c], len(used)) for c in range(len(families))], axis=1) + 1e-6 * w
        for x, g, a, s in ((w, grad, m, v), (b, error.sum(axis=0), mb, vb)):
            a += 0.1 * (g - a)
            s += 0.001 * (g * g - s)
            x -= 0.2 * (a / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)
    held, truth = logits()[out], target[out]
    loss = {t: -np.log(softmax(held / t)[np.arange(len(truth)), truth] + 1e-12).mean() for t in np.geomspace(0.3, 8, 25)}
    temperature = min(loss, key=loss.get)
    p = softmax(held / temperature)[:, :-1].max(axis=1)
    unknown = np.sort(p[truth == len(families) - 1])
    threshold = float(np.clip(unknown[int(0.98 * (len(unknown) - 1))] if len(unknown) else 0.5, 0.3, 0.9))
    weights = np.zeros((1 << BITS, len(families)), np.float32)
    weights[used] = w
    return Model(families, weights, b.astype(np.float32), float(temperature), threshold)


def learn(df: DataFrame, text_col: str = "text") -> Model:
    """Fit on a bounded sample of the corpus' paragraphs (see ``NEGATIVES``)."""
    texts = df.where(F.col(text_col).isNotNull()).select(F.col(text_col).alias("text"))
    rows = hash_sample(texts, "text", texts.count(), NEGATIVES).distinct().limit(2 * NEGATIVES).collect()
    rows.sort()
    lines = [line.split() for r in rows for line in r["text"].split("\n")]
    parts = [" ".join(w[i : i + WINDOW]) for w in lines for i in range(0, len(w), WINDOW)]
    random.Random(1).shuffle(parts)
    return fit(parts[:PARAGRAPHS])


def scan(df: DataFrame, model: Model, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",), confirmed: float = CONFIRMED) -> DataFrame:
    """``keep`` columns, ``n_paragraphs``, ``n_predicted`` (paragraphs with a
    predicted family) and ``licenses``: array of (family, probability, overlap,
    start, end) of confirmed windows, in bytes of the text's UTF-8."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    kind = pa.list_(pa.struct([("family", pa.string()), ("probability", pa.float64()), ("overlap", pa.float64()), ("start", pa.int64()), ("end", pa.int64())]))

    def fn(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        raw, rows = text_bytes(batch.column(0))
        n = batch.num_rows
        paragraphs, predicted, found = np.zeros(n, np.int64), np.zeros(n, np.int64), [[] for _ in range(n)]
        m = shared.value
        for lo, hi in slices(rows, 1 << 20):
            part, own = raw[rows[lo] : rows[hi]], rows[lo : hi + 1] - rows[lo]
            words, first, last, at, paragraph, lines = windows(part, own)
            if not len(first):
                continue
            doc = np.searchsorted(own, at[first, 0], "right") - 1
            p = m.probabilities(*buckets(words, first, last))
            best = p[:, :-1].argmax(axis=1)
            some = np.flatnonzero((p[np.arange(len(p)), best] >= m.threshold) & (p[np.arange(len(p)), best] > p[:, -1]))
            heads = np.unique(paragraph, return_index=True)[1]
            np.add.at(paragraphs, lo + doc[heads], 1)
            seen, known = set(), {}
            for i in some.tolist():
                a, b = int(at[first[i], 0]), int(at[last[i] - 1, 1])
                family, d = m.families[best[i]], int(doc[i])
                if paragraph[i] not in seen:
                    seen.add(paragraph[i])
                    predicted[lo + d] += 1
                share = overlap(part[a:b].tobytes().decode("utf-8", "replace"), family)
                if share >= confirmed:
                    # across lines, what a line of the window has shown already is no other notice
                    heads_, ends = known.setdefault((d, family), ([], []))
                    if i < lines:
                        heads_.append(a)
                        ends.append(b)
                    elif (k := bisect.bisect_left(heads_, a)) < len(ends) and ends[k] <= b:
                        continue
                    found[lo + d].append({"family": family, "probability": float(p[i, best[i]]), "overlap": share, "start": a - int(own[d]), "end": b - int(own[d])})
        for f in found:
            f.sort(key=lambda x: (x["start"], x["end"]))
        return {"n_paragraphs": pa.array(paragraphs, pa.int64()), "n_predicted": pa.array(predicted, pa.int64()), "licenses": pa.array(found, kind)}

    return map_batches(df, (text_col,), keep, "n_paragraphs bigint, n_predicted bigint, licenses array<struct<family: string, "
                       "probability: double, overlap: double, start: bigint, end: bigint>>", fn)
