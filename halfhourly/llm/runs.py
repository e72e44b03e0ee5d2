"""Periodic runs of words, found on a grammar of the texts.

A run is a stretch of consecutive words with smallest period q (words q apart are equal), at
least ``max(MIN_WORDS, MIN_EXPONENT * q)`` words long, that no neighbouring word extends.

1. **Re-Pair** over the word ids of an Arrow batch: the most frequent pair of neighbouring
   symbols becomes a nonterminal, until no pair occurs twice.  Replacements that do not touch
   each other commute, so a round takes every occurrence whose pair is more frequent than the
   pairs overlapping it (ties by code; ``aaa`` from the left), and only pairs that may still
   repeat are counted again.  A nonterminal serves all texts of the batch, copies share theirs.
2. **Crossing runs, once a nonterminal**: the part of a run inside a nonterminal's expansion
   that crosses the seam between its two sides, read at its first occurrence.  Candidate
   periods come from grams of K = 1, 2, 4, ... words: inside a run of period K/2 < q <= K the
   next occurrence of a K-gram is exactly q words on (a primitive word occurs in its square
   only at the ends), and a run of four periods that crosses a seam holds such a gram at one
   of the offsets 0, K/2, ..., 2K before the seam.  What is left is extended word by word.
   The seams between the symbols of the start rule are treated alike.
3. **Translation**: each occurrence of a nonterminal in the derivation is one replacement of
   step 1, whose position was noted; its runs are shifted there.
4. **Merging**: pieces of the same period that overlap by a period or more belong to one run.
   A run lies whole in the lowest node that holds it and crosses that node's seam, so after
   merging exactly the maximal runs are left.

All comparisons are of word ids: exact, no hashing.  Work and memory follow the batch piece (or
the one text larger than it); no shuffle.  Defined cases: null or empty text, or white space only:
no words, no runs, collapsed text ``''``; null doc_id is carried; repeated rows are treated each;
several best runs: the smallest start, then the smallest period; an empty table gives an
empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from halfhourly.llm.common import rebatch, space_words

MIN_WORDS, MIN_EXPONENT = 6, 4
SCHEMA = ("doc_id long, n_words long, runs array<struct<start: bigint, length: bigint, period: bigint>>, "
          "best struct<start: bigint, length: bigint, period: bigint>, collapsed string")


class Grammar(NamedTuple):
    """Nonterminals at their first occurrence, their occurrences, and the start rule."""
    begin: np.ndarray   # text position, a nonterminal
    seam: np.ndarray    # where its right side starts
    end: np.ndarray
    rule: np.ndarray    # an occurrence's nonterminal
    at: np.ndarray      # its text position
    start: np.ndarray   # positions of the start rule's symbols


def re_pair(words: np.ndarray, doc: np.ndarray) -> Grammar:
    """The grammar of ``words`` (ids from 0); no pair reaches from one ``doc`` into the next."""
    symbol, pos, end = words.astype(np.int64), np.arange(len(words)), np.arange(1, len(words) + 1)
    live = doc[:-1] == doc[1:]  # pairs, by their left symbol, that may occur twice
    fresh, base, rules, occurrences = int(symbol.max(initial=-1)) + 1, 0, [], []
    while True:
        at = np.flatnonzero(live)
        kinds, kind, count = np.unique(symbol[at] * fresh + symbol[at + 1], return_inverse=True, return_counts=True)
        often = count[kind] > 1
        live[at[~often]] = False
        at, kind = at[often], kind[often]
        if not len(at):
            break
        rank = np.empty(len(kinds), np.int64)
        rank[np.lexsort((kinds, count))] = np.arange(1, len(kinds) + 1)
        mine = rank[kind]
        around = np.zeros(len(symbol) + 1, np.int64)
        around[at + 1] = mine
        left, right = around[at], around[at + 2]
        head = np.flatnonzero(left != mine)  # of stretches of one kind: every other pair of them is free
        offset = np.arange(len(at)) - np.repeat(head, np.diff(np.r_[head, len(at)]))
        taken = (offset % 2 == 0) & ((left < mine) | (offset > 0)) & (right <= mine)
        used = np.bincount(kind[taken], minlength=len(kinds)) > 1
        taken &= used[kind]
        if not taken.any():  # the strongest pair overlaps itself only
            live[at[mine == mine.max()]] = False
            continue
        at, kind = at[taken], kind[taken]
        number = np.cumsum(used) - 1
        first = np.unique(kind, return_index=True)[1]
        rules.append((pos[at[first]], pos[at[first] + 1], end[at[first] + 1]))
        occurrences.append((base + number[kind], pos[at]))
        symbol[at] = fresh + number[kind]
        end[at] = end[at + 1]
        fresh, base = fresh + len(first), base + len(first)
        keep, changed = np.ones(len(symbol), bool), np.zeros(len(symbol), bool)
        keep[at + 1], changed[at] = False, True
        old = np.append(live, False)[keep]
        symbol, pos, end, doc, changed = symbol[keep], pos[keep], end[keep], doc[keep], changed[keep]
        live = (changed[:-1] | changed[1:] | old[:-1]) & (doc[:-1] == doc[1:])
    none = np.empty(0, np.int64)
    parts = [np.concatenate(p) if p else none for p in ([r[i] for r in rules] for i in range(3))]
    return Grammar(*parts, *(np.concatenate([o[i] for o in occurrences]) if occurrences else none for i in range(2)), pos)


def near_repeats(words: np.ndarray, doc: np.ndarray, stop: np.ndarray):
    """(K, positions, periods): K-grams, K = 1, 2, 4, ..., whose next occurrence in their text is q words on, K/2 < q <= K."""
    n, k = len(words), 1
    at, code = np.arange(n), doc.astype(np.int64) * (int(words.max(initial=0)) + 1) + words
    gram = np.empty(n, np.int64)
    while len(at):
        order = np.argsort(code, kind="stable")
        at, code = at[order], code[order]
        same = code[1:] == code[:-1]
        gap = at[1:] - at[:-1]
        close = same & (gap <= k) & (2 * gap > k)
        yield k, at[:-1][close], gap[close]
        twice = np.r_[same, False] | np.r_[False, same]
        gram[:] = -1
        gram[at[twice]] = np.cumsum(np.r_[True, ~same])[twice]
        at = np.sort(at[twice])
        at = at[at + 2 * k <= stop[at]]
        at = at[gram[at + k] >= 0]
        code = gram[at] * (n + 1) + gram[at + k]
        k *= 2


def _differs(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the common beginning of two views of equal length."""
    done, step = 0, 32
    while done < len(a):
        ne = a[done:done + step] != b[done:done + step]
        if ne.any():
            return done + int(ne.argmax())
        done, step = done + step, step * 4
    return len(a)


def crossing(words: np.ndarray, doc: np.ndarray, stop: np.ndarray, begin: np.ndarray, seam: np.ndarray,
             end: np.ndarray) -> np.ndarray:
    """Rows (window, start, end, period): in each window [begin, end) the parts of runs that cross its seam."""
    order = np.argsort(seam, kind="stable")
    seams, found = seam[order], []
    for k, at, period in near_repeats(words, doc, stop):
        tried = []
        for offset in range(0, 2 * k + 1, max(k // 2, 1)):
            lo, hi = (np.searchsorted(seams, at + offset, side) for side in ("left", "right"))
            many = hi - lo
            each = np.repeat(np.arange(len(at)), many)
            window = order[np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + lo[each]]
            i, q = at[each], period[each]
            fits = (begin[window] <= i) & (i + q + k <= end[window]) & (end[window] - begin[window] >= MIN_EXPONENT * q)
            tried.append(np.stack([window[fits], q[fits], i[fits]], axis=1))
        rows = np.unique(np.concatenate(tried), axis=0) if tried else np.empty((0, 3), np.int64)
        seen, reach = None, 0
        for w, q, i in rows.tolist():
            if (w, q) == seen and i + q <= reach:
                continue  # inside the stretch just measured
            a, b = int(begin[w]), int(end[w])
            last = i + q + _differs(words[i:b - q], words[i + q:b])
            s = i - _differs(words[a:i][::-1], words[a + q:i + q][::-1])
            seen, reach = (w, q), last
            if s < seam[w] < last and last - s >= max(MIN_WORDS, MIN_EXPONENT * q):
                found.append((w, s, last, q))
    return np.array(found, np.int64).reshape(-1, 4)


def maximal(s: np.ndarray, e: np.ndarray, q: np.ndarray, n: int) -> np.ndarray:
    """Rows (start, end, period) of the runs that the pieces make up, by start and period."""
    if not len(s):
        return np.empty((0, 3), np.int64)
    order = np.lexsort((e, s, q))
    s, e, q = s[order], e[order], q[order]
    lift = q * (n + 1)  # periods apart, so that one running maximum serves all
    top = np.maximum.accumulate(e + lift)
    head = np.r_[True, s[1:] + lift[1:] + q[1:] > top[:-1]]
    first = np.flatnonzero(head)
    runs = np.stack([s[first], np.maximum.reduceat(e, first), q[first]], axis=1)
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def find_runs(words: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All runs of the texts laid end to end (``sizes`` words each): rows (start, end, period)."""
    n = len(words)
    if not n:
        return np.empty((0, 3), np.int64)
    doc = np.repeat(np.arange(len(sizes)), sizes)
    stop = np.cumsum(sizes)
    first = (stop - sizes)[doc]
    stop = stop[doc]
    g = re_pair(words, doc)
    inner = g.start[g.start > first[g.start]]  # seams of the start rule, within the whole text
    hits = crossing(words, doc, stop, np.r_[g.begin, first[inner]], np.r_[g.seam, inner], np.r_[g.end, stop[inner]])
    nonterminal = hits[:, 0] < len(g.begin)
    own, rest = hits[nonterminal], hits[~nonterminal]
    by_rule = np.argsort(g.rule, kind="stable")
    lo, hi = (np.searchsorted(g.rule[by_rule], own[:, 0], side) for side in ("left", "right"))
    many = hi - lo
    each = np.repeat(np.arange(len(own)), many)
    where = g.at[by_rule[np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + lo[each]]]
    shift = where - g.begin[own[each, 0]]
    return maximal(np.r_[own[each, 1] + shift, rest[:, 1]], np.r_[own[each, 2] + shift, rest[:, 2]],
                   np.r_[own[each, 3], rest[:, 3]], n)


def _best(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run with the greatest length / period, compared exactly; the earliest of equals."""
    best = None
    for r in runs:
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    return best


def collapse(docs: DataFrame, prepare: Callable[[int | None, list[str]], list[str]] | None = None) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): its runs, the strongest of them, and the text with each
    run cut down to its first period (words joined by one space).  ``prepare(doc_id, words)`` may replace the words first."""
    def run(it):
        for pdf in rebatch(it, "text", 2_000_000):
            ids, texts, codes = {}, [], []
            doc_ids = [None if pd.isna(d) else int(d) for d in pdf["doc_id"]]
            for doc_id, text in zip(doc_ids, pdf["text"]):
                words = space_words(text or "")
                if prepare is not None:
                    words = prepare(doc_id, words)
                texts.append(words)
                codes += [ids.setdefault(w, len(ids)) for w in words]
            sizes = np.array([len(w) for w in texts], np.int64)
            begin = np.cumsum(sizes) - sizes
            runs = find_runs(np.array(codes, np.int64), sizes)
            owner = np.searchsorted(begin + sizes, runs[:, 0], "right")
            cover = np.zeros(len(codes) + 1, np.int64)
            np.add.at(cover, runs[:, 0] + runs[:, 2], 1)
            np.add.at(cover, runs[:, 1], -1)
            kept = np.cumsum(cover[:-1]) == 0
            of: dict[int, list[tuple[int, int, int]]] = {}
            for d, (s, e, q) in zip(owner.tolist(), runs.tolist()):
                of.setdefault(d, []).append((s - int(begin[d]), e - s, q))
            collapsed = [" ".join(w) if d not in of else
                         " ".join([w[i] for i in np.flatnonzero(kept[begin[d]:begin[d] + sizes[d]])])
                         for d, w in enumerate(texts)]
            as_rows = lambda r: dict(zip(("start", "length", "period"), r))
            best = [_best(of.get(d, [])) for d in range(len(texts))]
            yield pd.DataFrame({
                "doc_id": pd.array(doc_ids, "Int64"), "n_words": sizes,
                "runs": [[as_rows(r) for r in of.get(d, [])] for d in range(len(texts))],
                "best": [as_rows(b) if b else None for b in best], "collapsed": collapsed})
    return docs.select("doc_id", "text").mapInPandas(run, SCHEMA)
