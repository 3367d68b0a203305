"""Runs of windows that share an anchor: the common ground of the two span operators.

A window is L neighbouring symbols of one document.  Each window chooses the
least of its k-symbol names (winnowing), so equal windows choose equal names at
equal places.  Neighbouring windows that choose the same place form a run; a run
is named by its anchor (the chosen k-symbol name) and by its class (anchor, place
in the run, length and all symbols).  Runs of one class agree in every window, so
they are compared as one; only runs whose anchor has several classes are opened
into single windows.
"""

from __future__ import annotations

import numpy as np

from quern.llm.vectors import U, grams, minimizers, mix, prefix, spans


def find_runs(symbols: np.ndarray, first: np.ndarray, length: int, k: int) -> tuple[np.ndarray, ...]:
    """Of documents laid end to end (first: where each begins, and the end): document, begin, windows, place of the anchor,
    anchor and class of each run."""
    sums = prefix(symbols)
    names = grams(sums, k)
    chosen = minimizers(names, length - k + 1)
    size = np.diff(first)
    if not len(chosen) or size.max() < length:
        z = np.zeros(0, np.int64)
        return z, z, z, z, z.astype(U), z.astype(U)
    # a run ends where the choice changes, where a document begins, and where its last window is
    new = np.zeros(len(chosen) + 1, bool)
    new[1:-1] = chosen[1:] != chosen[:-1]
    has = size >= length
    new[first[:-1][has]] = True
    new[(first[1:] - length + 1)[has]] = True
    begin = np.flatnonzero(new)
    end = np.append(begin[1:], len(chosen))
    doc = np.searchsorted(first, begin, "right") - 1
    inside = begin + length <= first[np.minimum(doc + 1, len(size))]
    begin, end, doc = begin[inside], end[inside], doc[inside]
    anchor = chosen[begin]
    n, lead, name = end - begin, anchor - begin, names[anchor]
    body = spans(sums, begin, end + (length - 1))
    kind = mix(mix(body) + name + (n * 1_000_003 + lead).astype(U))
    return doc, begin - first[doc], n, lead, name, kind
