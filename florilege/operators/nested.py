"""Nested JSON texts into flat parent-linked rows by vectorised structural indexing.

All texts of a batch are laid into one byte array. Bitmaps of quotes, escapes, brackets and delimiters are built
over the whole array; prefix sums give the in-string mask and the nesting depth; keys, array positions and spans
come from the structural characters alone. Only then are the paths of the wanted containers put together.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_NUMBER = re.compile(r"-?(?:0|[1-9]\d*)(?:\.\d+)?(?:[eE][+-]?\d+)?|true|false|null", re.ASCII)
_STRING = re.compile(r'"(?:[^"\\\x00-\x1f]|\\(?:["\\/bfnrt]|u[0-9a-fA-F]{4}))*"')
_BLANK = re.compile(r"[ \t\n\r]*")


def _valid_deep(text: str) -> bool:
    """JSON grammar check without recursion, for texts nested deeper than the C reader goes."""
    at, stack, want = _BLANK.match(text).end(), [], "value"
    while at < len(text):
        c = text[at]
        if want in ("value", "value]"):
            if c == "]" and want == "value]":
                stack.pop()
                at, want = at + 1, "after"
            elif c in "[{":
                stack.append(c)
                at, want = at + 1, "value]" if c == "[" else "key}"
            else:
                m = _STRING.match(text, at) or _NUMBER.match(text, at)
                if not m:
                    return False
                at, want = m.end(), "after"
        elif want in ("key", "key}"):
            if c == "}" and want == "key}":
                stack.pop()
                at, want = at + 1, "after"
            else:
                m = _STRING.match(text, at)
                at = _BLANK.match(text, m.end()).end() if m else at
                if not m or text[at : at + 1] != ":":
                    return False
                at, want = at + 1, "value"
        elif not stack:
            return False
        elif c == ",":
            at, want = at + 1, "value" if stack[-1] == "[" else "key"
        elif c == ("]" if stack[-1] == "[" else "}"):
            stack.pop()
            at += 1
        else:
            return False
        at = _BLANK.match(text, at).end()
    return want == "after" and not stack


def _refuse(name: str) -> None:
    raise ValueError(name)


def is_json(text: str) -> bool:
    """Whether the text is one whole valid JSON value (no NaN, no trailing text)."""
    try:
        json.loads(text, parse_constant=_refuse)
        return True
    except RecursionError:
        return _valid_deep(text)
    except ValueError:
        return False


def structural_index(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, ...]:
    """Structural characters of the texts laid end to end in ``data`` (uint8), the i-th from ``starts[i]``.

    Returns positions, depths (an opening bracket has the depth outside of it), characters and the index of the
    text each stands in, all for brackets, colons and commas outside of strings.
    """
    back = data == 92
    # an escape is a backslash at an even distance from the start of its run of backslashes
    run_start = np.where(back & ~np.concatenate(([False], back[:-1])), np.arange(len(data)), 0)
    run_start = np.maximum.accumulate(run_start)
    escape = back & ((np.arange(len(data)) - run_start) % 2 == 0)
    escaped = np.concatenate(([False], escape[:-1]))
    quote = (data == 34) & ~escaped
    text_of = np.zeros(len(data), np.int32)
    inner = starts[1:][starts[1:] < len(data)]
    np.add.at(text_of, inner, 1)
    text_of = np.cumsum(text_of, dtype=np.int32)
    total = np.cumsum(quote, dtype=np.int64)
    before = np.concatenate(([0], total[:-1]))
    outside = (before - before[starts[text_of]]) % 2 == 0
    outside &= ~quote
    opening, closing = ((data == 91) | (data == 123)) & outside, ((data == 93) | (data == 125)) & outside
    marks = np.flatnonzero(opening | closing | (((data == 44) | (data == 58)) & outside))
    step = opening[marks].astype(np.int32) - closing[marks]
    level = np.cumsum(step, dtype=np.int32)
    owner = text_of[marks]
    first = np.searchsorted(owner, np.arange(len(starts)))
    base = np.where(first > 0, level[np.maximum(first, 1) - 1], 0) if len(level) else np.zeros(len(starts), np.int32)
    depth = level - base[owner] - np.maximum(step, 0)
    return marks, depth, data[marks], owner


def nested_paths(texts: list[str], steps: dict[tuple[str, str], str], root: str) -> tuple[list[int], list[str], list[str]]:
    """Wanted objects of each valid text: index of the text, path, parent path.

    ``steps`` maps (letter of the parent, member name) to the letter of the array's elements; ``root`` is the letter
    of the elements of the top array, whose parent letter is ''. Only objects give rows; other elements (null,
    numbers, arrays) keep their position.
    """
    rows_text: list[int] = []
    rows_path: list[str] = []
    rows_parent: list[str] = []
    if not texts:
        return rows_text, rows_path, rows_parent
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    lens = np.fromiter(map(len, raw), np.int64, len(raw))
    starts = np.concatenate(([0], np.cumsum(lens)[:-1]))
    joined = b"".join(raw)
    data = np.frombuffer(joined, np.uint8)
    marks, depth, chars, owner = structural_index(data, starts)
    if not len(marks):
        return rows_text, rows_path, rows_parent
    # the container of every mark is the last bracket opened one level up: one running maximum over marks and
    # opened brackets sorted by level, as a level's first event is always a bracket that opens it
    n = len(marks)
    opens = (chars == 91) | (chars == 123)
    inside = np.where((chars == 93) | (chars == 125), depth, depth - 1)
    order = np.arange(n)
    brackets = np.flatnonzero(opens)
    level = np.concatenate((depth[brackets], inside))
    event = np.concatenate((brackets, order))
    by = np.lexsort((event, level))
    opened = np.where(by < len(brackets), event[by], -1)
    last = np.maximum.accumulate(np.where(opened >= 0, np.arange(len(by)), -1))
    holder = np.full(n, -1, np.int64)
    member = by >= len(brackets)
    held = last[member]
    holder[event[by][member]] = np.where((held >= 0) & (level[by][member] >= 0), opened[np.maximum(held, 0)], -1)
    commas = chars == 44
    # position of an element = commas of its container before it, by a prefix sum over marks sorted by container
    by = np.lexsort((order, holder))
    seen = np.cumsum(commas[by])
    head = np.searchsorted(holder[by], holder[by])
    base = np.where(head > 0, seen[np.maximum(head, 1) - 1], 0)
    position = np.empty(n, np.int64)
    position[by] = seen - base
    letter: dict[int, str] = {}  # mark of an array's bracket -> letter of its elements
    node: dict[int, tuple[str, str]] = {}  # mark of an object's bracket -> (letter, path)
    prev_colon = np.concatenate(([False], chars[:-1] == 58))
    for m in np.flatnonzero(opens):
        h = int(holder[m])
        if chars[m] == 91:
            if h < 0:
                letter[m] = root
            elif h in node and prev_colon[m]:
                end = int(marks[m - 1])
                # the key is the string that ends before the colon; it starts after the previous mark
                key = joined[int(marks[m - 2]) + 1 : end].strip()
                name = key[1:-1].decode("utf-8", "replace") if b"\\" not in key else json.loads(key)
                if to := steps.get((node[h][0], name)):
                    letter[m] = to
        elif h in letter:
            array_holder = int(holder[h])
            parent = node[array_holder][1] if array_holder >= 0 else ""
            path = f"{parent}.{letter[h]}{position[m]}" if parent else f"{letter[h]}{position[m]}"
            node[int(m)] = (letter[h], path)
            rows_text.append(int(owner[m]))
            rows_path.append(path)
            rows_parent.append(parent)
    return rows_text, rows_path, rows_parent


#: The letters of a path.
SECTION_STEPS = {("s", "sections"): "s", ("s", "blocks"): "b", ("b", "annotations"): "a", ("b", "turns"): "t"}


def flatten_json(df: DataFrame, id_col: str, json_col: str, steps: dict[tuple[str, str], str], root: str, batch_chars: int = 4_000_000) -> DataFrame:
    """One row (root_id, node_path, parent_path) per wanted object of the JSON texts in ``json_col``.

    Null, empty, cut-off or otherwise invalid texts give no rows; texts of any length and depth are read whole
    (up to ``batch_chars`` characters are indexed at a time, one text at least). A text under several
    rows of one id gives each object once.
    """
    schema = "root_id bigint, node_path string, parent_path string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def emit(ids: list, texts: list[str]) -> pa.RecordBatch:
            t, p, q = nested_paths(texts, steps, root)
            return pa.RecordBatch.from_arrays([pa.array([ids[i] for i in t], pa.int64()), pa.array(p, pa.string()), pa.array(q, pa.string())], ["root_id", "node_path", "parent_path"])

        for b in batches:
            ids, texts, size = [], [], 0
            for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if not is_json(t):
                    continue
                ids.append(i)
                texts.append(t)
                size += len(t)
                if size >= batch_chars:
                    yield emit(ids, texts)
                    ids, texts, size = [], [], 0
            if texts:
                yield emit(ids, texts)

    src = df.select(F.col(id_col).cast("long").alias("root_id"), F.col(json_col).alias("j")).where("root_id is not null and j is not null")
    # a revision that was delivered twice gives each object once
    return src.mapInArrow(run, schema).distinct()


def flatten_array(df: DataFrame, id_col: str, array_col: str, letter: str) -> DataFrame:
    """Top-level rows of an array of structs; null elements keep their position and give no row."""
    src = df.select(F.col(id_col).cast("long").alias("root_id"), F.posexplode(F.col(array_col)).alias("pos", "e"))
    src = src.where("root_id is not null and e is not null")
    return src.select("root_id", F.concat(F.lit(letter), F.col("pos").cast("string")).alias("node_path"), F.lit("").alias("parent_path"))
