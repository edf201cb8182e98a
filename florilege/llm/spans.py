"""Long exact spans shared between documents, and repeated lines.

``shared_spans`` finds every character that lies in a passage of at least ``least`` characters that also stands in
another document, at any alignment. ``repeated_units`` is plain line or paragraph hashing: it keeps the earliest
occurrence of each normalised unit and reports all later ones with their offsets.

Both group digests of units over the whole corpus. Lines can't give passages that begin and end anywhere, so the
units of ``shared_spans`` are windows: (1) anchors, windows of half a passage chosen by the content, so that any
passage has one at the same place wherever it stands; anchors of one document only are dropped; (2) for the rest,
the surroundings in which a passage with this anchor can lie. Members of an anchor are compared window by window
through digests at equal distance from the anchor, never pair by pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from florilege.functions.text import collapse_ws
from florilege.session import dropped, hot_keys, salted_join, spread, written

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_MIX = np.uint64(0xBF58476D1CE4E5B9)
_CHARS = 1_000_000


_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def _powers(n: int, base: np.uint64 = _BASE) -> np.ndarray:
    p = np.full(n, base, np.uint64)
    p[0] = 1
    return np.multiply.accumulate(p)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def window_hashes(codes: np.ndarray, size: int) -> np.ndarray:
    """64-bit digest of each window of ``size`` code points (uint64): a polynomial over mixed code points from prefix
    sums modulo 2^64, scaled to the highest power so that equal windows agree, then mixed."""
    n = len(codes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    power = _powers(len(codes) + 1)
    prefix = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_mixed(codes + np.uint64(1)) * power[:-1], dtype=np.uint64)))
    return _mixed((prefix[size:] - prefix[:-size]) * _powers(n, _INVERSE))


def _sliding_min(x: np.ndarray, size: int) -> np.ndarray:
    """Minimum of each ``size`` neighbours: running minima from both ends of blocks of that size."""
    n = len(x)
    full = -(-n // size) * size
    padded = np.concatenate((x, np.full(full - n, np.iinfo(x.dtype).max, x.dtype))).reshape(-1, size)
    left = np.minimum.accumulate(padded, axis=1).ravel()
    right = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[: n - size + 1], left[size - 1 : n])


def anchors(codes: np.ndarray, least: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and digests of the anchors of a text: those windows of ``size`` that are the least, by digest, of some
    ``least - size + 1`` neighbours. Any ``least`` characters hold one, chosen by these characters alone."""
    h = window_hashes(codes, size)
    span = least - size + 1
    if len(h) < span:
        return np.zeros(0, np.int64), h[:0]
    low = _sliding_min(h, span)
    # a window is chosen if the greatest of the minima over neighbourhoods that hold it is its own digest
    top = np.iinfo(np.uint64).max
    pad = np.concatenate((np.zeros(span - 1, np.uint64), low, np.zeros(span - 1, np.uint64)))
    at = np.flatnonzero(top - _sliding_min(top - pad, span) == h)
    return at, h[at]


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)


def _anchor_rows(docs: DataFrame, least: int, size: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(d: list, p: list, h: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(d)), pa.array(np.concatenate(p).astype(np.int32)), pa.array(np.concatenate(h).view(np.int64))], ["doc", "pos", "h"])

        for b in batches:
            d, p, h, n = [], [], [], 0
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                at, hs = anchors(_codes(text), least, size)
                d.append(np.full(len(at), doc, np.int64))
                p.append(at)
                h.append(hs)
                n += len(at)
                if n > 100_000:
                    yield out(d, p, h)
                    d, p, h, n = [], [], [], 0
            if n:
                yield out(d, p, h)

    return docs.mapInArrow(run, "doc bigint, pos int, h bigint")


def _contexts(hits: DataFrame, docs: DataFrame, least: int, size: int) -> DataFrame:
    """(h, doc, pos[], left, context): the text around each shared anchor; equal ones of a document are one row."""
    reach = least - size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(rows: dict, doc: list, key: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in key], pa.int64()), pa.array(doc, pa.int64()), pa.array(list(rows), pa.list_(pa.int32())), pa.array([k[1] for k in key], pa.int32()), pa.array([k[2] for k in key], pa.string())],
                ["h", "doc", "pos", "left", "context"],
            )

        for b in batches:
            rows, docs_, keys = [], [], []
            for doc, text, found in zip(*(b.column(i).to_pylist() for i in range(3))):
                same: dict[tuple[int, int, str], list[int]] = {}
                for x in found:
                    p = x["pos"]
                    left = min(p, reach)
                    same.setdefault((x["h"], left, text[p - left : p + least]), []).append(p)
                for k, v in same.items():
                    rows.append(v)
                    docs_.append(doc)
                    keys.append(k)
                if len(rows) > 5_000:
                    yield out(rows, docs_, keys)
                    rows, docs_, keys = [], [], []
            if rows:
                yield out(rows, docs_, keys)

    per_doc = hits.groupBy("doc").agg(F.collect_list(F.struct("h", "pos")).alias("found"))  # bounded by the document's length
    joined = docs.join(per_doc, "doc").select("doc", "text", "found")
    return joined.mapInArrow(run, "h bigint, doc bigint, pos array<int>, left int, context string")


def _windows_of(contexts: list[str], lefts: np.ndarray, least: int, reach: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Member, distance of the window's start from the anchor (0 to -reach, given as its negative) and digest of all
    windows that hold the anchor."""
    lens = np.fromiter(map(len, contexts), np.int64, len(contexts))
    starts = np.cumsum(lens) - lens
    # one pass over all contexts end to end; windows that reach into the next context aren't taken
    h = window_hashes(_codes("".join(contexts)), least)
    take = np.clip(np.minimum(lens - least, lefts) + 1, 0, None)
    who = np.repeat(np.arange(len(contexts)), take)
    ends = np.cumsum(take)
    start = np.arange(len(who)) - np.repeat(ends - take, take)
    return who, lefts[who] - start, h[starts[who] + start]


def _spans_of(pos: list[list[int]], who: np.ndarray, dist: np.ndarray, least: int) -> tuple[list[int], list[int], list[int]]:
    """Member, start and end of the runs of shared windows of each member."""
    order = np.lexsort((-dist, who))
    who, dist = who[order], dist[order]
    if not len(who):
        return [], [], []
    breaks = np.flatnonzero((np.diff(who) != 0) | (-np.diff(dist) > 1)) + 1
    first, last = np.concatenate(([0], breaks)), np.concatenate((breaks, [len(who)])) - 1
    m, s, e = [], [], []
    for a, b in zip(first, last):
        for p in pos[who[a]]:
            m.append(int(who[a]))
            s.append(int(p - dist[a]))
            e.append(int(p - dist[b] + least))
    return m, s, e


_SPAN = "doc bigint, s int, e int"


def _compare_groups(members: DataFrame, least: int, size: int, rows: int = 4_000) -> DataFrame:
    """Shared windows within whole anchor groups of bounded size; tasks take them group after group, many at a time."""
    reach = least - size

    def compare(h: np.ndarray, doc: np.ndarray, pos: list, left: np.ndarray, context: list[str]) -> pa.RecordBatch:
        who, dist, win = _windows_of(context, left, least, reach)
        order = np.lexsort((doc[who], win, dist, h[who]))
        w, d, x = who[order], dist[order], win[order]
        if len(w):
            new = np.concatenate(([True], (h[w[1:]] != h[w[:-1]]) | (np.diff(d) != 0) | (x[1:] != x[:-1])))
            first = np.flatnonzero(new)
            last = np.concatenate((first[1:], [len(w)])) - 1
            several = (doc[w[first]] != doc[w[last]])[np.cumsum(new) - 1]
            w, d = w[several], d[several]
        m, s, e = _spans_of(pos, w, d, least)
        return pa.RecordBatch.from_arrays([pa.array(doc[np.array(m, np.int64)], pa.int64()), pa.array(s, pa.int32()), pa.array(e, pa.int32())], ["doc", "s", "e"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None

        def done(t: pa.Table) -> pa.RecordBatch:
            h, doc, left = (t.column(n).to_numpy() for n in ("h", "doc", "left"))
            return compare(h, doc, t.column("pos").to_pylist(), left.astype(np.int64), t.column("context").to_pylist())

        for b in batches:
            held = pa.Table.from_batches([b]) if held is None else pa.concat_tables([held, pa.Table.from_batches([b])])
            if held.num_rows < rows:
                continue
            h = held.column("h").to_numpy()
            cut = int(np.searchsorted(h, h[-1]))  # the last group may go on in the next batch
            for a, z in _group_portions(h[:cut], rows):
                yield done(held.slice(a, z - a))
            held = held.slice(cut).combine_chunks()
        if held is not None and held.num_rows:
            for a, z in _group_portions(held.column("h").to_numpy(), rows):
                yield done(held.slice(a, z - a))

    return spread(members, "h").sortWithinPartitions("h").select("h", "doc", "pos", "left", "context").mapInArrow(run, _SPAN)


def _group_portions(h: np.ndarray, rows: int) -> Iterator[tuple[int, int]]:
    """Cuts sorted keys between groups into portions of about ``rows``."""
    start = 0
    while start < len(h):
        end = start + rows
        if end < len(h):
            low = int(np.searchsorted(h, h[end]))
            end = low if low > start else int(np.searchsorted(h, h[end], "right"))
        end = min(end, len(h))
        yield start, end
        start = end


def _compare_hot(members: DataFrame, least: int, size: int) -> DataFrame:
    """The same for anchors with very many members: windows as rows, grouped with partial sums over the cluster."""
    reach = least - size

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for a in range(0, b.num_rows, 2_000):
                part = b.slice(a, 2_000)
                who, dist, h = _windows_of(part.column(2).to_pylist(), part.column(1).to_numpy(), least, reach)
                anchor, doc = part.column(0).to_numpy()[who], part.column(3).to_numpy()[who]
                yield pa.RecordBatch.from_arrays([pa.array(anchor), pa.array(dist.astype(np.int32)), pa.array(h.view(np.int64)), pa.array(doc)], ["h", "dist", "win", "doc"])

    rows = members.select("h", "left", "context", "doc").mapInArrow(explode, "h bigint, dist int, win bigint, doc bigint")
    shared = rows.groupBy("h", "dist", "win").agg(F.min("doc").alias("a"), F.max("doc").alias("b"), F.count("*").alias("n")).where("a <> b").select("h", "dist", "win", "n")
    shared = written(shared, "windows")
    # the shared windows of an anchor are joined back by digest; a window that very many share goes to many tasks
    again = members.select("h", "left", "context", "doc", "pos").mapInArrow(_explode_with_pos(least, reach), "h bigint, dist int, win bigint, doc bigint, pos array<int>")
    key = ["h", "dist", "win"]
    hit = salted_join(again, shared.select(*key), key, "doc", hot_keys(shared, key), "left_semi")
    start = F.explode("pos").alias("p")
    return hit.select("doc", "dist", start).select("doc", (F.col("p") - F.col("dist")).alias("s"), (F.col("p") - F.col("dist") + least).alias("e"))


def _explode_with_pos(least: int, reach: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for a in range(0, b.num_rows, 2_000):
                part = b.slice(a, 2_000)
                who, dist, h = _windows_of(part.column(2).to_pylist(), part.column(1).to_numpy(), least, reach)
                anchor, doc = part.column(0).to_numpy()[who], part.column(3).to_numpy()[who]
                pos = part.column(4).take(pa.array(who))
                yield pa.RecordBatch.from_arrays([pa.array(anchor), pa.array(dist.astype(np.int32)), pa.array(h.view(np.int64)), pa.array(doc), pos], ["h", "dist", "win", "doc", "pos"])

    return run


def _merge(spans: DataFrame) -> DataFrame:
    """Unions of touching spans of each document."""
    by = Window.partitionBy("doc").orderBy("s", "e")
    upto = F.max("e").over(by.rowsBetween(Window.unboundedPreceding, -1))
    marked = spans.withColumn("new", F.when(upto.isNull() | (F.col("s") > upto), 1).otherwise(0))
    island = marked.withColumn("island", F.sum("new").over(by))
    return island.groupBy("doc", "island").agg(F.min("s").alias("s"), F.max("e").alias("e"))


def shared_spans(df: DataFrame, id_col: str, text_col: str, least: int = 160, size: int = 80, hot_members: int = 4_000) -> DataFrame:
    """(id, span_start, span_end): the longest stretches of each document whose every character lies in a passage of at
    least ``least`` code points that also stands in another document.

    Positions count code points from 0, the end not included; nothing is normalised; stretches that touch are one.
    Rows with a null id or text and texts shorter than ``least`` have no stretches. Two rows with one id are one
    document: what stands in both isn't shared by that. Passages repeated only within a document don't count. An
    empty table gives no rows. ``hot_members`` only decides where an anchor's members are compared as rows over the
    cluster instead of in one task; it changes no result.
    """
    docs = df.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text")).where(F.col("doc").isNotNull() & (F.length("text") >= least))
    # whole copies: one representative goes on, the copies are shared from end to end
    ident = docs.select("doc", F.md5("text").alias("m"), F.length("text").alias("n"))
    same = written(ident.groupBy("m", "n").agg(F.min("doc").alias("first"), F.max("doc").alias("last"), F.count("*").alias("c")).where("first <> last"), "copies")
    copies = salted_join(ident, same, ["m", "n"], "doc", hot_keys(same, ["m", "n"], "c")).select("doc", "n", "first", "last")
    whole = copies.select("doc", F.lit(0).alias("s"), F.col("n").alias("e"))
    extra = copies.where("doc <> first").select("doc").distinct()

    rows = _anchor_rows(docs, least, size).join(extra, "doc", "left_anti")
    rows = written(rows, "anchors")
    shared = rows.groupBy("h").agg(F.min("doc").alias("a"), F.max("doc").alias("b"), F.count("*").alias("n")).where("a <> b")
    shared = written(shared.select("h", "n"), "shared")
    hits = salted_join(rows, shared.select("h"), ["h"], "doc", hot_keys(shared, ["h"]))
    contexts = written(_contexts(hits.select("doc", "h", "pos"), docs, least, size), "contexts")
    dropped(rows, shared)
    hot = written(contexts.groupBy("h").agg(F.count("*").alias("n")).where(F.col("n") > hot_members), "hot")
    cold = _compare_groups(contexts.join(hot.select("h"), "h", "left_anti"), least, size)
    spans = cold.unionByName(_compare_hot(salted_join(contexts, hot.select("h"), ["h"], "doc", hot_keys(hot, ["h"]), "left_semi"), least, size))
    return _merge(spans.unionByName(whole)).select(F.col("doc").alias(id_col), F.col("s").cast("long").alias("span_start"), F.col("e").cast("long").alias("span_end"))


def repeated_units(df: DataFrame, id_col: str, text_col: str, by: str = "line", least: int = 40) -> DataFrame:
    """(id, unit_start, unit_end, first_id, first_start) of every unit that isn't the first of its kind.

    A unit is a line (or paragraph, between empty lines), normalised by letter case and white space; units of fewer than ``least`` normalised characters
    aren't looked at. The first is the earliest by (id, start). Offsets are of the text as it is. Rows with a null id or text have no units.
    Digests are pre-aggregated to the earliest occurrence before they are shuffled, and a unit that a third of all rows hold is spread on the way back.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut = "\n" if by == "line" else "\n\n"
        for b in batches:
            ids, starts, ends, units = [], [], [], []
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                at = 0
                for u in text.split(cut):
                    ids.append(doc)
                    starts.append(at)
                    ends.append(at + len(u))
                    units.append(u)
                    at += len(u) + len(cut)
            for a in range(0, len(ids), 50_000):
                z = slice(a, a + 50_000)
                yield pa.RecordBatch.from_arrays([pa.array(ids[z], pa.int64()), pa.array(starts[z], pa.int64()), pa.array(ends[z], pa.int64()), pa.array(units[z], pa.string())], ["id", "s", "e", "u"])

    src = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("t")).where("id is not null and t is not null")
    units = src.mapInArrow(run, "id bigint, s bigint, e bigint, u string").withColumn("u", F.lower(collapse_ws(F.col("u"))))
    units = written(units.where(F.length("u") >= least).select("id", "s", "e", F.md5("u").alias("m")), "units")
    first = written(units.groupBy("m").agg(F.min(F.struct("id", "s")).alias("first"), F.count("*").alias("n")).where("n > 1"), "first")
    found = salted_join(units, first.drop("n"), ["m"], "id", hot_keys(first, ["m"])).where((F.col("id") != F.col("first.id")) | (F.col("s") != F.col("first.s")))
    return found.select(F.col("id").alias(id_col), F.col("s").alias("unit_start"), F.col("e").alias("unit_end"), F.col("first.id").alias("first_id"), F.col("first.s").alias("first_start"))


def without_repeats(df: DataFrame, id_col: str, text_col: str, by: str = "line", least: int = 40) -> DataFrame:
    """(id, text, kept): each row's text without the units that ``repeated_units`` reports, and where the units that stay stood
    in the original, as array<struct<start, end>>.

    Null texts stay null with an empty ``kept``; rows with a null id stay whole. Ids should be unique: of rows with one id, a unit goes only
    where it stands at a reported place. A document of which nothing is left has an empty text."""
    cut = "\n" if by == "line" else "\n\n"
    gone = repeated_units(df.select(id_col, text_col), id_col, text_col, by, least).select(F.col(id_col).alias("_id"), F.struct("unit_start", "unit_end").alias("u"))
    gone = gone.groupBy("_id").agg(F.collect_list("u").alias("gone"))  # bounded by the document's length
    src = df.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_t")).join(gone, "_id", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, kept = [], []
            for t, found in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                away = {(x["unit_start"], x["unit_end"]) for x in found or ()}
                at, left, places = 0, [], []
                for u in () if t is None else t.split(cut):
                    if (at, at + len(u)) not in away:
                        left.append(u)
                        places.append({"start": at, "end": at + len(u)})
                    at += len(u) + len(cut)
                texts.append(None if t is None else cut.join(left))
                kept.append(places)
            span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string()), pa.array(kept, pa.list_(span))], [id_col, "text", "kept"])

    return src.mapInArrow(run, f"{id_col} bigint, text string, kept array<struct<start:bigint,end:bigint>>")
