"""BLAKE3 (the public specification) over a batch of short texts at once, and the identifiers made from it."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from florilege.functions.text import collapse_ws

# Fixed values of the specification: initial words, order of message words from round to round, flags.
_IV = np.array([0x6A09E667, 0xBB67AE85, 0x3C6EF372, 0xA54FF53A, 0x510E527F, 0x9B05688C, 0x1F83D9AB, 0x5BE0CD19], np.uint32)
_ORDER = [2, 6, 3, 10, 7, 0, 4, 13, 1, 11, 12, 5, 9, 14, 15, 8]
_START, _END, _PARENT, _ROOT = 1, 2, 4, 8
_CHUNK, _BLOCK = 1024, 64


def _mix(v: list[np.ndarray], a: int, b: int, c: int, d: int, x: np.ndarray, y: np.ndarray) -> None:
    turn = lambda w, n: (w >> np.uint32(n)) | (w << np.uint32(32 - n))
    v[a] = v[a] + v[b] + x
    v[d] = turn(v[d] ^ v[a], 16)
    v[c] = v[c] + v[d]
    v[b] = turn(v[b] ^ v[c], 12)
    v[a] = v[a] + v[b] + y
    v[d] = turn(v[d] ^ v[a], 8)
    v[c] = v[c] + v[d]
    v[b] = turn(v[b] ^ v[c], 7)


def _compress(cv: np.ndarray, words: np.ndarray, counter: np.ndarray, size: np.ndarray, flags: np.ndarray) -> np.ndarray:
    """New chaining values (lanes by 8) of one block in each lane."""
    n = len(cv)
    m = [words[:, i] for i in range(16)]
    v = [cv[:, i] for i in range(8)] + [np.full(n, _IV[i], np.uint32) for i in range(4)]
    v += [counter.astype(np.uint32), np.zeros(n, np.uint32), size.astype(np.uint32), flags.astype(np.uint32)]
    for r in range(7):
        for k, (a, b, c, d) in enumerate(((0, 4, 8, 12), (1, 5, 9, 13), (2, 6, 10, 14), (3, 7, 11, 15), (0, 5, 10, 15), (1, 6, 11, 12), (2, 7, 8, 13), (3, 4, 9, 14))):
            _mix(v, a, b, c, d, m[2 * k], m[2 * k + 1])
        if r < 6:
            m = [m[i] for i in _ORDER]
    return np.stack([v[i] ^ v[i + 8] for i in range(8)], axis=1)


def blake3_hex16(texts: list[bytes]) -> list[str]:
    """The first 16 hex digits of each text's hash. Blocks of all chunks of all texts go through the rounds together."""
    if not texts:
        return []
    lens = np.array([len(t) for t in texts])
    chunks = np.maximum(1, -(-lens // _CHUNK))
    owner = np.repeat(np.arange(len(texts)), chunks)
    index = np.arange(len(owner)) - np.repeat(np.cumsum(chunks) - chunks, chunks)
    data = np.zeros((len(owner), _CHUNK), np.uint8)
    sizes = np.minimum(_CHUNK, lens[owner] - index * _CHUNK)
    for row, (o, i) in enumerate(zip(owner, index)):
        part = texts[o][i * _CHUNK : (i + 1) * _CHUNK]
        data[row, : len(part)] = np.frombuffer(part, np.uint8)
    words = data.view("<u4").reshape(len(owner), 16, 16)
    blocks = np.maximum(1, -(-sizes // _BLOCK))
    single = chunks[owner] == 1
    cv = np.tile(_IV, (len(owner), 1))
    for b in range(int(blocks.max())):
        at = np.flatnonzero(blocks > b)
        last = blocks[at] == b + 1
        flags = np.where(b == 0, _START, 0) | np.where(last, _END, 0) | np.where(last & single[at], _ROOT, 0)
        size = np.clip(sizes[at] - b * _BLOCK, 0, _BLOCK)
        cv[at] = _compress(cv[at], words[at, b], index[at], size, flags)
    result: list[str] = []
    start = np.cumsum(chunks) - chunks
    for t, n in enumerate(chunks):
        nodes = [cv[start[t] + i] for i in range(n)]
        result.append((nodes[0] if n == 1 else _tree(nodes)).astype("<u4").tobytes()[:8].hex())
    return result


def _tree(nodes: list[np.ndarray], root: bool = True) -> np.ndarray:
    if len(nodes) == 1:
        return nodes[0]
    half = 1 << (len(nodes) - 1).bit_length() - 1
    left, right = _tree(nodes[:half], False), _tree(nodes[half:], False)
    flags = np.array([_PARENT | (_ROOT if root else 0)])
    return _compress(_IV[None, :], np.concatenate((left, right))[None, :], np.zeros(1), np.array([_BLOCK]), flags)[0]


@F.pandas_udf(T.StringType())
def hash16(texts: pd.Series) -> pd.Series:
    """Null stays null."""
    known = texts.notna()
    out = pd.Series([None] * len(texts), dtype=object)
    out[known.to_numpy()] = blake3_hex16([t.encode("utf-8", "surrogatepass") for t in texts[known]])
    return out


def content_key(text: Column) -> Column:
    return F.lower(collapse_ws(text))


def quote_key(title: Column, path: Column, index: Column) -> Column:
    return F.concat_ws("\n", title, F.array_join(path, "/"), index.cast("string"))
