"""Language identification by multilingual mixture inference.

Learning counts hashed byte n-grams per language over every labelled document
(a Spark aggregate; the model is languages x buckets, whatever the corpus).  A
document is cut into short runs of n-grams; each run was written in one
language, and expectation-maximisation over the runs estimates the document's
language proportions.  The language set is chosen among the nested sets of the
likeliest languages by penalised likelihood.

Defined cases: a null text or one without a letter is ``und`` with score 0 and
no languages; with nothing learned every document is ``und``; ties go to the
language first in order; a text too short for one n-gram is padded with blanks;
rows repeat as they are.  A very long text is read whole, in memory in proportion
to its runs; ``keep`` columns pass through and others, also of clashing names, are
not read; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_batches, ship, slices, text_bytes, tidy

BUCKETS = 1 << 16
#: n-grams in a run, and how often n-grams overlap (their log likelihoods are divided by it).
RUN, OVERLAP = 48, 4.0
STEPS = 12
#: What one more language must gain, in units of log(number of runs).
PENALTY = 2.0
UND = "und"

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_LETTER = np.zeros(256, bool)
_LETTER[97:123] = _LETTER[128:] = True
_FOLD[: 128][~_LETTER[:128] & ~((np.arange(128) >= 65) & (np.arange(128) < 91))] = 32


def grams(raw: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all 4-byte n-grams whose middle is in a word, document by
    document, and how many each document has."""
    text = _FOLD[raw]
    if len(text) < 4:
        return np.empty(0, np.uint32), np.zeros(len(rows) - 1, np.int64)
    letter = _LETTER[text]
    ok = letter[1:-2] & letter[2:-1]
    over = (rows[1:-1, None] + np.array([-3, -2, -1])).ravel()  # n-grams that would leave their document
    ok[over[(over >= 0) & (over < len(ok))]] = False
    at = np.flatnonzero(ok)
    four = np.ndarray((len(text) - 3,), "<u4", text, strides=(1,))[at]
    return (four * np.uint32(2654435761)) >> np.uint32(16), np.diff(np.searchsorted(at, rows))


def _padded(raw: np.ndarray, rows: np.ndarray, one: int) -> np.ndarray:
    own = np.concatenate([[32, 32], raw[rows[one] : rows[one + 1]], [32, 32, 32]]).astype(np.uint8)
    text = _FOLD[own]
    letter = _LETTER[text]
    at = np.flatnonzero(letter[:-3] | letter[1:-2] | letter[2:-1] | letter[3:])
    return (np.ndarray((len(text) - 3,), "<u4", text, strides=(1,))[at] * np.uint32(2654435761)) >> np.uint32(16)


def learn(df: DataFrame, text_col: str = "text", lang_col: str = "lang") -> tuple[list[str], np.ndarray]:
    """Languages in order, and their log probabilities (languages x buckets)."""
    ship(df.sparkSession)
    known = df.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            raw, rows = text_bytes(batch.column(1))
            lang = np.array(batch.column(0).to_pylist(), object)
            for lo, hi in slices(rows, 4 << 20):
                got, n = grams(raw[rows[lo] : rows[hi]], rows[lo : hi + 1] - rows[lo])
                of = np.repeat(lang[lo:hi], n)
                for name in set(lang[lo:hi]):
                    sums[name] = sums.get(name, 0) + np.bincount(got[of == name], minlength=BUCKETS)
        for name, n in sums.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(n[at], pa.int64())],
                names=["lang", "bucket", "n"])

    parts = known.mapInArrow(tidy(count), "lang string, bucket int, n bigint")
    model = parts.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    langs = sorted(set(model["lang"]))
    sums = np.zeros((len(langs), BUCKETS))
    sums[model["lang"].map({x: i for i, x in enumerate(langs)}).to_numpy(int), model["bucket"].to_numpy(int)] = model["n"]
    smooth = sums + 0.1
    return langs, np.log(smooth / smooth.sum(axis=1, keepdims=True))


def _em(runs: np.ndarray, of: np.ndarray, count: np.ndarray, allowed: np.ndarray, steps: int) -> tuple[np.ndarray, np.ndarray]:
    """Proportions (documents x languages) and log likelihoods; ``runs`` has the
    log likelihood of each run, ``of`` its document (in order)."""
    share = allowed / allowed.sum(axis=1, keepdims=True)
    top = runs.max(axis=1, keepdims=True)
    like = np.exp(runs - top)
    heads = np.concatenate([[0], np.cumsum(count)[:-1]])
    for _ in range(steps):
        part = like * share[of]
        part /= part.sum(axis=1, keepdims=True) + 1e-300
        share = np.add.reduceat(part, heads, axis=0) / count[:, None]
    total = np.log((like * share[of]).sum(axis=1) + 1e-300) + top[:, 0]
    return share, np.add.reduceat(total, heads)


def proportions(got: np.ndarray, n: np.ndarray, log_p: np.ndarray) -> np.ndarray:
    """Language proportions of documents that have n-grams (all ``n`` > 0);
    languages outside the chosen set have 0."""
    blocks = -(-n // RUN)
    first = np.concatenate([[0], np.cumsum(n)[:-1]])
    of = np.repeat(np.arange(len(n)), blocks)
    inside = np.arange(len(of)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    starts = first[of] + inside * RUN
    runs = np.stack([np.add.reduceat(row[got], starts) for row in log_p], axis=1) / OVERLAP
    everything = np.ones((len(n), len(log_p)))
    share, _ = _em(runs, of, blocks, everything, STEPS)
    order = np.argsort(-share, axis=1, kind="stable")
    best = np.zeros_like(share)
    best[np.arange(len(n)), order[:, 0]] = 1
    # in a long text, runs of a hundredth outweigh the penalty: only a single run needs no choice
    mixed = np.flatnonzero((blocks > 1) | (share[np.arange(len(n)), order[:, 0]] < 0.98)) if share.shape[1] > 1 else []
    if len(mixed):
        pick = np.isin(of, mixed)
        sub, count = runs[pick], blocks[mixed]
        sub_of = np.repeat(np.arange(len(mixed)), count)
        cost = np.full(len(mixed), np.inf)
        allowed = np.zeros((len(mixed), share.shape[1]))
        for size in range(1, share.shape[1] + 1):
            allowed[np.arange(len(mixed)), order[mixed, size - 1]] = 1
            got_share, fit = _em(sub, sub_of, count, allowed, STEPS)
            price = -fit + PENALTY * (size - 1) * np.log(count + 1)
            better = price < cost
            cost[better] = price[better]
            best[mixed[better]] = got_share[better]
    return best


def predict(df: DataFrame, model: tuple[list[str], np.ndarray], text_col: str = "text",
            keep: tuple[str, ...] = ("doc_id",), has_letter: str | None = None) -> DataFrame:
    """``keep`` columns, ``lang_pred``, ``score`` (its proportion) and
    ``languages``: array of (lang, share), largest share first.  With
    ``has_letter``, also a column of that name: whether the text has a letter,
    whatever was learned."""
    langs, log_p = model
    shared = df.sparkSession.sparkContext.broadcast(log_p.astype(np.float32))
    kind = pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())]))

    def fn(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        column = batch.column(0)
        raw, rows = text_bytes(column)
        pred, score, sets = [UND] * len(column), [0.0] * len(column), [[] for _ in range(len(column))]
        lettered = np.zeros(len(column), bool)
        for lo, hi in slices(rows, 4 << 20) if langs or has_letter else ():
            part, own = raw[rows[lo] : rows[hi]], rows[lo : hi + 1] - rows[lo]
            # a text whose only letter-like bytes belong to other characters has no letter
            letters = np.add.reduceat(np.append(_ASCII[part], 0), own[:-1])
            lettered[lo:hi] = [size and (ascii_ or any(c.isalpha() for c in column[lo + i].as_py()))
                               for i, (size, ascii_) in enumerate(zip(np.diff(own).tolist(), letters.tolist(), strict=True))]
            if not langs:
                continue
            got, n = grams(part, own)
            short = np.flatnonzero((n == 0) & lettered[lo:hi]).tolist()
            docs = np.flatnonzero((n > 0) & lettered[lo:hi])
            if len(docs) < np.count_nonzero(n):
                got = got[np.repeat(np.isin(np.arange(hi - lo), docs), n)]
            todo, count = [docs], [n[docs]]
            if short:
                more = [_padded(part, own, int(i)) for i in short]
                got = np.concatenate([got, *more])
                todo.append(np.array(short))
                count.append(np.array([len(x) for x in more]))
            todo, count = np.concatenate(todo).astype(int), np.concatenate(count).astype(int)
            if not len(todo):
                continue
            share = proportions(got, count, shared.value)
            for i, s in zip(todo, share, strict=True):
                top = np.argsort(-s, kind="stable")
                pred[lo + i], score[lo + i] = langs[top[0]], float(min(1.0, s[top[0]]))
                sets[lo + i] = [{"lang": langs[j], "share": float(s[j])} for j in top if s[j] > 0]
        out = {"lang_pred": pa.array(pred, pa.string()), "score": pa.array(score, pa.float64()), "languages": pa.array(sets, kind)}
        return out | ({has_letter: pa.array(lettered)} if has_letter else {})

    added = "lang_pred string, score double, languages array<struct<lang: string, share: double>>" + (f", {has_letter} boolean" if has_letter else "")
    return map_batches(df, (text_col,), keep, added, fn)


_ASCII = np.zeros(256, np.int64)
_ASCII[65:91] = _ASCII[97:123] = 1


def held_out(id_col: str = "doc_id") -> Column:
    """Whether a document is kept from learning; a null id is."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(True))
