"""Repetition rules from a suffix array of every text's words.

The words of many texts form one array in which words of different texts never compare
equal.  Prefix doubling sorts its suffixes (only those still tied are sorted again), the kept
rank of each doubling gives the longest common prefix of neighbours, and the intervals of
neighbours with a long common prefix are the maximal repeated substrings.  The union of their
spans and the longest of them decide, beside plain counts of words, symbols, lines and
five-word windows.  Whole texts are used; a text longer than a slice is sorted alone.

Null and empty texts have no words, fail the base rule and are not kept.  Repeated rows give
repeated results, rows without an id keep a null id, an empty table gives an empty result, and
columns other than the two that are named play no part.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.llm.common import map_batches, slices, utf8

SYMBOLS = b"#*$%&|<>"
WINDOW = 5
#: words of the shortest repeat that counts, most covered fraction, and words of the longest repeat allowed
SHORTEST, FRACTION, LONGEST = 10, 0.15, 40

RESULT = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, n_covered long, longest_repeat long, n_repeats long, spans array<struct<start: long, stop: long>>, kept boolean"
)


class _Numbers(dict):
    def __missing__(self, key):
        number = self[key] = len(self)
        return number


def suffix_order(symbols: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, list[tuple[int, np.ndarray]]]:
    """Suffix order of an array that holds several texts, and per doubling (length, rank by that many symbols).

    ``stops`` has each position's text end.  Symbols of different texts must differ.
    """
    n = len(symbols)
    order = np.argsort(symbols, kind="stable")
    ordered = symbols[order]
    first = np.r_[True, ordered[1:] != ordered[:-1]]
    rank = np.empty(n, dtype=np.int64)
    rank[order] = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    levels, length = [], 1
    while True:
        levels.append((length, rank.copy()))
        tied = ~(first & np.r_[first[1:], True])
        places = np.flatnonzero(tied)  # slots of groups with several members
        if not len(places):
            return order, levels
        members = order[places]
        ahead = members + length
        key = rank[members] * (n + 1) + np.where(ahead < stops[members], rank[np.minimum(ahead, n - 1)] + 1, 0)
        by = np.argsort(key, kind="stable")
        members, key = members[by], key[by]
        order[places] = members
        new = np.r_[True, key[1:] != key[:-1]]
        first[places] = new
        rank[members] = places[np.maximum.accumulate(np.where(new, np.arange(len(places)), 0))]
        length *= 2


def neighbour_lcp(order: np.ndarray, levels: list[tuple[int, np.ndarray]], least: int) -> np.ndarray:
    """Common prefix length of each suffix and the one before it in order; 0 where shorter than ``least``."""
    n = len(order)
    lcp = np.zeros(n, dtype=np.int64)
    if n < 2:
        return lcp
    enough = max((k for k, (size, _) in enumerate(levels) if size <= least), default=0)
    rank = levels[enough][1]
    at = np.flatnonzero(rank[order[1:]] == rank[order[:-1]]) + 1
    a, b, shared = order[at], order[at - 1], np.zeros(len(at), dtype=np.int64)
    for size, rank in reversed(levels):
        i, j = a + shared, b + shared
        inside = (i < n) & (j < n)
        same = inside & (rank[np.minimum(i, n - 1)] == rank[np.minimum(j, n - 1)])
        shared += size * same
    lcp[at] = np.where(shared >= least, shared, 0)
    return lcp


def intervals(lcp: list[int]) -> list[tuple[int, int, int]]:
    """The (length, first, last) intervals of a run of common prefix lengths between neighbours 0..len."""
    found, stack = [], []
    for k, value in enumerate([*lcp, 0]):
        left = k
        while stack and stack[-1][0] >= value:
            length, left = stack.pop()
            if length > value:
                found.append((length, left, k))
        if value:
            stack.append((value, left))
    return found


def repeats(texts: list[list[int]], shortest: int = SHORTEST, window: int = WINDOW) -> list[dict]:
    """Per text: words in repeated windows, union spans of maximal repeats, the longest, and how many there are."""
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    bounds = np.r_[0, np.cumsum(sizes)]
    n = int(bounds[-1])
    if not n:
        return [{"n_repeat_words": 0, "spans": [], "longest": 0, "n_repeats": 0} for _ in texts]
    ids = np.fromiter((w for t in texts for w in t), dtype=np.int64, count=n)
    text = np.repeat(np.arange(len(texts)), sizes)
    order, levels = suffix_order(text * (int(ids.max()) + 1) + ids, bounds[1:][text])
    lcp = neighbour_lcp(order, levels, min(window, shortest))
    reach = np.zeros(n, dtype=np.int64)  # longest prefix of each suffix that stands elsewhere in its text
    reach[order] = np.maximum(lcp, np.r_[lcp[1:], 0])

    def covered(size: int) -> np.ndarray:
        at = np.flatnonzero(reach >= size)
        edges = np.bincount(at, minlength=n + 1) - np.bincount(at + size, minlength=n + 1)
        return np.cumsum(edges[:n]) > 0

    in_windows = np.add.reduceat(np.r_[covered(window), False].astype(np.int64), bounds[:-1]) * (sizes > 0)
    marks = covered(shortest)
    longest = np.maximum.reduceat(np.r_[reach, 0], bounds[:-1]) * (sizes > 0)
    # a run of neighbours with a common prefix lies in one text; an interval counts if it can't be extended to the left
    counts = np.zeros(len(texts), dtype=np.int64)
    long = np.where(lcp >= shortest, lcp, 0)
    before = np.where(np.isin(order, bounds[:-1]), -1, ids[order - 1])
    at = np.flatnonzero(long)
    for run in np.split(at, np.flatnonzero(np.diff(at) > 1) + 1) if len(at) else []:
        base = run[0] - 1
        prior = before[base : run[-1] + 1].tolist()
        starts = 0
        if len(run) == 1:
            starts = int(prior[0] != prior[1] or prior[0] < 0)
        else:
            changes = np.r_[0, np.cumsum([x != y or x < 0 for x, y in zip(prior, prior[1:])])]
            starts = sum(int(changes[last] > changes[first]) for _, first, last in intervals(long[run].tolist()))
        counts[text[order[base]]] += starts
    out = []
    for k, (a, b) in enumerate(zip(bounds[:-1], bounds[1:])):
        spans = []
        if longest[k] >= shortest:
            edges = np.flatnonzero(np.diff(np.r_[0, marks[a:b].astype(np.int8), 0]))
            spans = list(zip(edges[::2].tolist(), edges[1::2].tolist()))
        out.append({
            "n_repeat_words": int(in_windows[k]), "spans": spans, "n_repeats": int(counts[k]),
            "longest": int(longest[k]) if longest[k] >= shortest else 0,
        })
    return out


def quality_rules(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
    shortest: int = SHORTEST, fraction: float = FRACTION, longest: int = LONGEST,
) -> DataFrame:
    """Counts, repeat spans (in words) and verdict of every row."""

    def start():
        def judge(rows: dict):
            raw = utf8(rows["text"])
            for a, b in slices(raw):
                yield some(rows["doc_id"][a:b], raw[a:b])

        def some(keys: list, raw: list[bytes]) -> dict:
            numbers = _Numbers()
            out: dict = {name.split()[0]: [] for name in (
                "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                "n_covered", "longest_repeat", "n_repeats", "spans", "kept")}
            words = [t.split() for t in raw]
            found = repeats([list(map(numbers.__getitem__, w)) for w in words], shortest)
            for key, t, w, r in zip(keys, raw, words, found):
                lines = [x for x in t.split(b"\n") if x.split(None, 1)] if b"\n" in t else []
                n = len(w)
                joined = b"".join(w)
                covered = sum(y - x for x, y in r["spans"])
                failed = n < 10 or 100 * r["n_repeat_words"] > 20 * n
                row = (
                    key, n, len(joined) if joined.isascii() else len(joined.decode("utf-8", "surrogatepass")),
                    len(t) - len(t.translate(None, SYMBOLS)), len(lines) - len(set(lines)), r["n_repeat_words"], failed,
                    covered, r["longest"], r["n_repeats"], [{"start": x, "stop": y} for x, y in r["spans"]],
                    not failed and covered <= fraction * n and r["longest"] <= longest,
                )
                for name, value in zip(out, row):
                    out[name].append(value)
            return out

        return judge

    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return map_batches(source, RESULT, start)
