"""Character n-grams of texts, hashed, as sparse counts; and their products with matrices of log-probabilities.

Whole batches are worked on at once in numpy. Texts are lower-cased and padded
by a blank on either side; those without a letter have no n-grams.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import regex

BITS = 16
ORDERS = (1, 2, 3)
#: Log-probabilities are whole numbers of this part of a nat, so that sums don't depend on their order.
SCALE = 1024.0
#: Languages counted at a time: 128 MB of counts.
LANGUAGES = 256
#: Characters in a slice of a long text, and in a batch of the product.
_SLICE, _CHARS = 1 << 18, 1 << 18
_LETTER = regex.compile(r"\p{L}")


def slices(texts: list[str | None]):
    """(rows, lengths, characters, leads) of runs of texts; long ones in slices of which each repeats the ``lead`` last characters."""
    rows, parts, leads, size = [], [], [], 0
    for i, t in enumerate(texts):
        if t is None or not _LETTER.search(t):
            continue
        t = f" {t.lower()} "
        step = max(ORDERS) - 1
        for at in range(0, len(t), _SLICE):
            lead = min(at, step)
            part = t[at - lead : at + _SLICE]
            rows.append(i)
            parts.append(part)
            leads.append(lead)
            size += len(part)
            if size >= _CHARS:
                yield _run(rows, parts, leads)
                rows, parts, leads, size = [], [], [], 0
    if rows:
        yield _run(rows, parts, leads)


def _run(rows: list[int], parts: list[str], leads: list[int]):
    chars = np.frombuffer("".join(parts).encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.array(rows), np.array([len(p) for p in parts]), chars, np.array(leads)


def grams(lengths: np.ndarray, chars: np.ndarray, leads: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all n-grams of one order, and how many each text has: the sparse matrix, row by row."""
    n = len(chars) - order + 1
    if n <= 0:
        return np.empty(0, np.uint32), np.zeros(len(lengths), np.int64)
    h = chars[:n] * np.uint32(0x9E3779B1)
    for j in range(1, order):
        h = (h ^ (h >> np.uint32(15))) * np.uint32(0x85EBCA77) + chars[j : j + n]
    h = (h ^ (h >> np.uint32(13))) * np.uint32(0xC2B2AE3D)
    # an n-gram belongs to the text it starts in if it ends there; those that a slice before had are left out
    ends = np.cumsum(lengths)
    skip = np.maximum(0, leads - (order - 1))
    first, last = ends - lengths + skip, ends - (order - 1)
    last = np.maximum(first, last)
    inside = np.zeros(len(chars) + 1, np.int64)
    np.add.at(inside, first, 1)
    np.add.at(inside, last, -1)
    return (h >> np.uint32(32 - BITS))[np.cumsum(inside)[:n] > 0], last - first


def counted(batches):
    """(lang, text) -> (lang, bucket, n), summed over the partition, or over as many languages as fit."""
    total: dict[str, np.ndarray] = {}

    def counts():
        for lang, row in total.items():
            at = np.nonzero(row)[0]
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at)), pa.array(at, pa.int32()), pa.array(row[at])], ["lang", "bucket", "n"])
        total.clear()

    for batch in batches:
        langs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for rows, lengths, chars, leads in slices(texts):
            for order in ORDERS:
                b, n = grams(lengths, chars, leads, order)
                for i, part in zip(rows, np.split(b, np.cumsum(n)[:-1]), strict=True):
                    if langs[i] not in total:
                        if len(total) >= LANGUAGES:
                            yield from counts()
                        total[langs[i]] = np.zeros(1 << BITS, np.int64)
                    np.add.at(total[langs[i]], part, 1) if len(part) < 1 << 12 else np.add(total[langs[i]], np.bincount(part, minlength=1 << BITS), out=total[langs[i]])
    yield from counts()


def log_probabilities(counts: pa.Table, languages: list[str]) -> np.ndarray:
    """Counts (lang, bucket, n) -> smoothed log-probabilities, buckets x languages."""
    at = {x: i for i, x in enumerate(languages)}
    dense = np.full((len(languages), 1 << BITS), 0.5)
    dense[[at[x] for x in counts["lang"].to_pylist()], counts["bucket"].to_numpy()] += counts["n"].to_numpy()
    log = np.log(dense / dense.sum(axis=1, keepdims=True))
    return np.ascontiguousarray(np.rint(log.T * SCALE).astype(np.int32))


def sums(texts: list[str | None], matrix: np.ndarray, prior: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log-probabilities of each text with each language of a block, and which texts have n-grams at all."""
    out = np.tile(prior, (len(texts), 1))
    seen = np.zeros(len(texts), bool)
    step = max(1, (1 << 24) // max(1, matrix.shape[1]))  # cells looked up at a time
    for rows, lengths, chars, leads in slices(texts):
        for order in ORDERS:
            b, n = grams(lengths, chars, leads, order)
            own = np.repeat(rows, n)
            for at in range(0, len(b), step):
                part, who = b[at : at + step], own[at : at + step]
                starts = np.concatenate([[0], np.nonzero(np.diff(who))[0] + 1])
                np.add.at(out, who[starts], np.add.reduceat(matrix[part], starts, axis=0, dtype=np.int64))
        seen[rows] = True
    return out, seen
