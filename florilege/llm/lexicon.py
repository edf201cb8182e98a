"""A minimal acyclic transducer from words to token ids, kept in flat arrays that workers map into memory."""

from __future__ import annotations

import base64
import heapq
from functools import lru_cache

import numpy as np


@lru_cache(maxsize=4)
def load_ranks(path: str) -> dict[bytes, int]:
    """Merge ranks (= token ids) of a byte-level vocabulary file: base64 token and rank on each line."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Token ids of one pre-token: always joins the neighbouring pair of lowest rank, the leftmost of equals.

    A heap over linked parts keeps this at n log n, so a piece of a million bytes is no trouble.
    """
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    n = len(piece)
    ends = list(range(1, n + 1))  # end of the part that starts at i
    before = list(range(-1, n - 1))
    alive = [True] * n
    heap = []
    for i in range(n - 1):
        r = ranks.get(piece[i : i + 2])
        if r is not None:
            heap.append((r, i, i + 1, i + 2))
    heapq.heapify(heap)
    while heap:
        _, i, mid, end = heapq.heappop(heap)
        if not alive[i] or ends[i] != mid or mid >= n or not alive[mid] or ends[mid] != end:
            continue
        alive[mid] = False
        ends[i] = end
        if end < n:
            before[end] = i
            r = ranks.get(piece[i : ends[end]])
            if r is not None:
                heapq.heappush(heap, (r, i, end, ends[end]))
        p = before[i]
        if p >= 0:
            r = ranks.get(piece[p:end])
            if r is not None:
                heapq.heappush(heap, (r, p, i, end))
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : ends[i]]])
        i = ends[i]
    return out


def build(words: list[bytes], ids: list[list[int]]) -> dict[str, np.ndarray]:
    """The transducer of sorted, distinct, non-empty words.

    Words are added in order to a minimal automaton (states with equal continuations are one, so suffixes are
    shared). Each transition outputs the number of words that sort before the ones through it; the outputs of a path
    add up to the word's number, at which its ids stand.
    """
    arcs: list[dict[int, int]] = [{}]
    final = [False]
    register: dict[tuple, int] = {}
    path = [0]  # states along the word added last
    last = b""

    def freeze(down_to: int) -> None:
        for depth in range(len(path) - 1, down_to, -1):
            state = path[depth]
            key = (final[state], *arcs[state].items())
            same = register.setdefault(key, state)
            if same != state:
                arcs[path[depth - 1]][last[depth - 1]] = same
        del path[down_to + 1 :]

    for w in words:
        common = 0
        while common < len(last) and common < len(w) and last[common] == w[common]:
            common += 1
        freeze(common)
        for b in w[common:]:
            arcs.append({})
            final.append(False)
            arcs[path[-1]][b] = len(arcs) - 1
            path.append(len(arcs) - 1)
        final[path[-1]] = True
        last = w
    freeze(0)
    # words below each state, deepest first; then flat arcs sorted by (state, byte)
    below: dict[int, int] = {}
    stack = [(0, False)]
    while stack:
        s, done = stack.pop()
        if s in below:
            continue
        if done:
            below[s] = int(final[s]) + sum(below[t] for t in arcs[s].values())
        else:
            stack.append((s, True))
            stack.extend((t, False) for t in arcs[s].values() if t not in below)
    number = {s: i for i, s in enumerate(sorted(below))}
    keys, to, skip = [], [], []
    for s in sorted(below):
        ahead = int(final[s])
        for b in sorted(arcs[s]):
            t = arcs[s][b]
            keys.append(number[s] * 256 + b)
            to.append(number[t])
            skip.append(ahead)
            ahead += below[t]
    lens = np.fromiter(map(len, ids), np.int64, len(ids))
    return {
        "keys": np.array(keys, np.int64),
        "to": np.array(to, np.int64),
        "skip": np.array(skip, np.int64),
        "final": np.array([final[s] for s in sorted(below)], np.int64),
        "starts": np.concatenate(([0], np.cumsum(lens))).astype(np.int64),
        "ids": np.array([i for x in ids for i in x], np.int64),
    }


NAMES = ("keys", "to", "skip", "final", "starts", "ids")


def pack(arrays: dict[str, np.ndarray]) -> bytes:
    """One file: six sizes, then the arrays, all int64."""
    sizes = np.array([len(arrays[n]) for n in NAMES], np.int64)
    return sizes.tobytes() + b"".join(arrays[n].astype(np.int64).tobytes() for n in NAMES)


class Lexicon:
    """The transducer of a file, mapped into memory (all workers of a machine share its pages)."""

    def __init__(self, path: str):
        data = np.memmap(path, np.int64, "r")
        at = len(NAMES)
        for name, size in zip(NAMES, data[:at]):
            setattr(self, name, data[at : at + int(size)])
            at += int(size)

    def find(self, words: list[bytes]) -> np.ndarray:
        """The number of each word, -1 for unknown ones; all words take their steps together."""
        n = len(words)
        result = np.full(n, -1, np.int64)
        if not n or not len(self.keys):
            return result
        lens = np.fromiter(map(len, words), np.int64, n)
        data = np.frombuffer(b"".join(words), np.uint8).astype(np.int64)
        starts = np.concatenate(([0], np.cumsum(lens)[:-1]))
        live = np.arange(n)
        state, total = np.zeros(n, np.int64), np.zeros(n, np.int64)
        step = 0
        while len(live):
            done = lens[live] == step
            end = live[done]
            result[end] = np.where(self.final[state[end]] == 1, total[end], -1)
            live = live[~done]
            if not len(live):
                break
            key = state[live] * 256 + data[starts[live] + step]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            hit = self.keys[at] == key
            live, at = live[hit], at[hit]
            state[live] = self.to[at]
            total[live] += self.skip[at]
            step += 1
        return result

    def output(self, number: int) -> np.ndarray:
        return self.ids[self.starts[number] : self.starts[number + 1]]
