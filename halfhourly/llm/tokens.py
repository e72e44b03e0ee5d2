"""Token counts by a compiled cascade of deterministic transducers.

The byte-level BPE of a tokenizer file is compiled into two transducers:

* **boundaries**: over character classes, eight states.  Its input symbols carry the bounded
  look-ahead the split pattern needs (the next two characters), so one left-to-right
  run marks where pieces start.  A batch's texts are laid end to end and cut into
  chunks; each chunk gives a state map (entry state -> exit state), the maps are
  composed by a parallel prefix scan, and every chunk then marks its starts from
  its true entry state.  All chunks advance in lockstep, so one very long text is
  as parallel as many short ones.
* **merges**: over bytes, annotated with the change of the token count.  The last token of
  the encoding of every prefix is unique and depends only on the last tokens at
  the earlier boundaries that a token can still reach back to; those (with their
  counts) are the state.  States are made when first reached and kept, so frequent
  pieces are walks in a table.  A token may follow another only if the merges would
  not have joined across the seam before building it (Berglund, van der Merwe:
  Formalizing BPE tokenization, 2023).

A piece's count is remembered; a document's is the sum over its pieces.  Added tokens in
a text are one token each and end the pieces around them, the library's default.

Defined cases: null or empty text: 0 bytes, 0 tokens; very long texts: bounded by the batch
piece they are in; repeated rows: counted each; null doc_id is carried; an empty table gives
an empty result; extra columns are ignored.
"""

from __future__ import annotations

import json
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame

from halfhourly.llm.common import rebatch

LETTER, NUMBER, OTHER, SHORT, LONG, SPACES, BLANK, BREAK = range(8)  # input symbols
IN_LETTERS, IN_NUMBERS, IN_OTHERS, AFTER_BLANK, IN_SPACES, ONE_MORE, TWO_MORE, FRESH = range(8)  # states
CHUNK = 64
PIECES, STATES = 1_000_000, 500_000  # remembered pieces and automaton states, then forgotten


def _boundary_tables() -> tuple[np.ndarray, np.ndarray]:
    """next[state, symbol] and starts[state, symbol]; symbols + 8 begin a new text, + 16 stand still."""
    run = {LETTER: IN_LETTERS, NUMBER: IN_NUMBERS, OTHER: IN_OTHERS, SHORT: IN_OTHERS, LONG: IN_OTHERS, SPACES: IN_SPACES}
    to = np.zeros((8, 17), np.uint8)
    starts = np.zeros((8, 17), bool)
    for state in range(8):
        for symbol in range(8):
            if symbol in (BLANK, BREAK):
                goes, new = (AFTER_BLANK if symbol == BLANK else FRESH), True
            elif symbol == LETTER and state in (ONE_MORE, TWO_MORE):
                goes, new = (FRESH if state == ONE_MORE else ONE_MORE), False
            elif run[symbol] == state or (state == AFTER_BLANK and symbol != SPACES):
                goes, new = run[symbol], False
            else:
                goes, new = {SHORT: ONE_MORE, LONG: TWO_MORE}.get(symbol, run[symbol]), True
            to[state, symbol], starts[state, symbol] = goes, new
    to[:, 8:16], starts[:, 8:16] = to[FRESH, :8], True
    to[:, 16] = np.arange(8)
    return to, starts


_TO, _STARTS = _boundary_tables()


@lru_cache(1)
def _classes() -> np.ndarray:
    """Code point -> 0 letter, 1 number, 2 other, 5 white space."""
    out = np.full(0x110000, OTHER, np.uint8)
    text = "".join(chr(c) if not 0xD800 <= c < 0xE000 else "!" for c in range(0x110000))
    for pattern, symbol in ((r"\p{L}+", LETTER), (r"\p{N}+", NUMBER), (r"\p{White_Space}+", SPACES)):
        for m in regex.finditer(pattern, text):
            out[m.start():m.end()] = symbol
    return out


def _symbols(codes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The transducer's input: class and look-ahead of each character; ``first`` marks text starts."""
    kind = _classes()[codes]
    n = len(codes)
    after = np.r_[codes[1:], 0]
    after2 = np.r_[codes[2:], 0, 0][:n]
    ends = np.r_[first[1:], True]
    ends2 = ends | np.r_[ends[1:], True]
    space = kind == SPACES
    before_text = space & ~ends & ~np.r_[space[1:], True]
    symbol = kind.copy()
    symbol[before_text] = np.where(codes[before_text] == 32, BLANK, BREAK)
    mark = (codes == 39) & ~ends
    short = mark & np.isin(after, [ord(c) for c in "stmd"])
    long_ = mark & ~ends2 & (((after == ord("r")) | (after == ord("v"))) & (after2 == ord("e"))
                             | (after == ord("l")) & (after2 == ord("l")))
    symbol[short], symbol[long_] = SHORT, LONG
    return symbol + 8 * first.astype(np.uint8)


def scan(maps: np.ndarray) -> np.ndarray:
    """Inclusive prefix composition of state maps (chunks x states), in log2(chunks) steps."""
    out, step = maps.copy(), 1
    while step < len(out):
        out[step:] = np.take_along_axis(out[step:], out[:-step].astype(np.intp), axis=1)
        step *= 2
    return out


def piece_starts(codes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Positions where pieces start."""
    n = len(codes)
    if not n:
        return np.empty(0, np.int64)
    symbols = np.full(-(-n // CHUNK) * CHUNK, 16, np.uint8)
    symbols[:n] = _symbols(codes, first)
    lanes = np.ascontiguousarray(symbols.reshape(-1, CHUNK).T)
    flat, wide = _TO.T.ravel(), lanes.astype(np.intp) * 8
    state = np.full(lanes.shape[1], FRESH, np.uint8)
    open_, maps = np.arange(len(state)), np.tile(np.arange(8, dtype=np.uint8), (len(state), 1))
    for row in wide:  # a chunk whose states have met has a constant map from there on
        state = flat[row + state]
        if len(open_):
            maps = flat[row[open_, None] + maps]
            apart = (maps != state[open_, None]).any(axis=1)
            open_, maps = open_[apart], maps[apart]
    whole = np.repeat(state[:, None], 8, axis=1)
    whole[open_] = maps
    state = np.r_[np.uint8(FRESH), scan(whole)[:-1, FRESH]]
    begun, marks = _STARTS.T.ravel(), np.empty(lanes.shape, bool)
    for i, row in enumerate(wide):
        at = row + state
        marks[i], state = begun[at], flat[at]
    return np.flatnonzero(marks.T.ravel()[:n])


class Merges:
    """The byte transducer of one tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.added = sorted((t["content"] for t in spec.get("added_tokens", [])), key=len, reverse=True)
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in printable]
        byte = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}
        raw = lambda s: bytes(byte[c] for c in s)
        self.token = {bytes([b]): b for b in range(256)}
        self.halves: list[tuple[int, int] | None] = [None] * 256
        self.joined: dict[tuple[int, int], int] = {}
        for pair in spec["model"]["merges"]:
            a, b = (raw(s) for s in (pair.split(" ") if isinstance(pair, str) else pair))
            t = len(self.halves)  # tokens are numbered by merge rank
            self.halves.append((self.token[a], self.token[b]))
            self.token.setdefault(a + b, t)
            self.joined[self.token[a], self.token[b]] = t
        self.heads = {t[:i] for t in self.token for i in range(len(t))}
        self.seams: dict[tuple[int, int], bool] = {}
        self.whole: dict[bytes, bool] = {}
        self.clear()

    def clear(self) -> None:
        self.known: dict = {}
        self.steps: list[dict[int, tuple[int, int]]] = []
        self.states: list[tuple] = []
        self._state((b"", (-1,), (0,)))

    def _state(self, key: tuple) -> int:
        if key not in self.known:
            self.known[key] = len(self.states)
            self.states.append(key)
            self.steps.append({})
        return self.known[key]

    def _encode(self, text: bytes) -> list[int]:
        parts = list(text)
        while len(parts) > 1:
            rank, at = min((self.joined.get((a, b), 1 << 30), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if rank == 1 << 30:
                break
            parts[at:at + 2] = [rank]
        return parts

    def _reachable(self, text: bytes) -> bool:
        """Whether the token of these bytes is what the merges make of them."""
        if text not in self.whole:
            self.whole[text] = self._encode(text) == [self.token[text]]
        return self.whole[text]

    def _follows(self, a: int, b: int) -> bool:
        """Whether token b may stand after token a: undoing the later merge of the two sides step by step,
        no merge across the seam comes before the merges that built what stands beside it."""
        key = a, b
        if key in self.seams:
            return self.seams[key]
        limit, ok = 1 << 30, None
        while ok is None:
            if self.joined.get((a, b), 1 << 30) < limit:
                ok = False
            elif self.halves[a] is None and self.halves[b] is None:
                ok = True
            elif a > b:  # on the left the later merge is undone first; equal ranks merge left to right
                limit, a = a, self.halves[a][1]
            else:
                limit, b = b + 1, self.halves[b][0]
        self.seams[key] = ok
        return ok

    def _step(self, state: int, byte: int) -> tuple[int, int]:
        tail, lasts, counts = self.states[state]
        tail = tail + bytes([byte])
        for j, last in enumerate(lasts):
            t = self.token.get(tail[j:])
            if t is not None and (last < 0 or self._follows(last, t)) and self._reachable(tail[j:]):
                break
        change = counts[j] + 1
        lasts, counts = (*lasts, t), (*(c - change for c in counts), 0)
        cut = next(j for j in range(len(tail) + 1) if tail[j:] in self.heads or j == len(tail))
        to = self._state((tail[cut:], lasts[cut:], counts[cut:]))
        self.steps[state][byte] = to, change
        return to, change

    def count(self, piece: str) -> int:
        if len(self.states) > STATES:
            self.clear()
        state = total = 0
        steps = self.steps
        for b in piece.encode("utf-8", "surrogatepass"):
            got = steps[state].get(b)
            state, change = got if got is not None else self._step(state, b)
            total += change
        return total


class _Pieces(dict):
    def __init__(self, merges: Merges):
        super().__init__()
        self.merges = merges

    def __missing__(self, piece: str) -> int:
        if len(self) >= PIECES:
            self.clear()
        n = self[piece] = self.merges.count(piece)
        return n


@lru_cache(4)
def compiled(path: str) -> _Pieces:
    """Once a worker process and file."""
    return _Pieces(Merges(path))


def count_texts(texts: list[str], path: str) -> np.ndarray:
    """Tokens of each text."""
    pieces = compiled(path)
    total = np.zeros(len(texts), np.int64)
    segments, owner = [], []
    for i, text in enumerate(texts):
        parts = [text]
        for added in pieces.merges.added:
            if added in text:
                parts = [x for p in parts for x in p.split(added)]
                total[i] += text.count(added)
        segments += [p for p in parts if p]
        owner += [i for p in parts if p]
    if not segments:
        return total
    text = "".join(segments)
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    begin = np.cumsum([0, *map(len, segments)])[:-1]
    first = np.zeros(len(codes), bool)
    first[begin] = True
    starts = piece_starts(codes, first)
    cuts = starts.tolist()
    counts = np.fromiter(map(pieces.__getitem__, map(text.__getitem__, map(slice, cuts, [*cuts[1:], len(text)]))),
                         np.int64, len(cuts))
    np.add.at(total, owner, np.add.reduceat(counts, np.searchsorted(starts, begin)))
    return total


def counts(docs: DataFrame, path: str, limit: int = 1024) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit per row; ``path`` must exist on every executor."""
    def run(it):
        for pdf in rebatch(it, "text", 1_000_000):
            texts = [t or "" for t in pdf["text"]]
            n = count_texts(texts, path)
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "n_bytes": [len(t.encode("utf-8", "surrogatepass")) for t in texts],
                                "n_tokens": n, "over_limit": n > limit})
    return docs.select("doc_id", "text").mapInPandas(
        run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
