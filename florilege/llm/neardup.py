"""Near-duplicate texts by a grouped prefix join over word shingles.

A text is the set of its runs of ``words`` words, worked out once. Texts are collapsed twice: equal normalised texts to one, and texts
whose prefixes (the rarest shingles, as many as any similar text must share one of) and sizes are equal to one group.
Group pairs that share a prefix shingle are filtered by size and position; what is left, and each group in itself, is expanded to
pairs of texts, which parity bits filter before they are verified on the whole sets. Similar texts come out as classes
(``similar_classes``) or expanded to pairs of rows (``similar_pairs``).
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from florilege.functions.text import collapse_ws
from florilege.session import dropped, hot_keys, most_frequent, salted_join, written


def words_of(text: Column) -> Column:
    """The longest runs of letters or digits."""
    return F.regexp_extract_all(text, F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def shingles(found: Column, words: int) -> Column:
    """The set of 64-bit digests of the runs of ``words`` among the words ``found``."""

    def of(w: Column) -> Column:
        last = F.size(w) - words
        runs = F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(words)]))
        return F.when(last >= 0, F.array_distinct(runs)).otherwise(F.array().cast("array<bigint>"))

    return F.get(F.transform(F.array(found), of), 0)


def _prefixes(sets: DataFrame, common: np.ndarray, num: int, den: int) -> DataFrame:
    """(tid, size, prefix, b1, b2): shingles in one global order, the common ones last and by ascending count; a prefix is
    as long as needed for similar sets (at least num/den of their union shared) to have one shingle of it in common.

    b1 and b2 are 128 bits, each the parity of the whole set's shingles that hash to it: sets that differ in few
    shingles differ in few bits."""
    order = np.argsort(common)
    by_value = common[order]
    shared = sets.sparkSession.sparkContext.broadcast((by_value, order + 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        value, rank = shared.value
        for b in batches:
            arr = b.column(1)
            flat, offs = arr.flatten().to_numpy(), np.diff(arr.offsets.to_numpy())
            row = np.repeat(np.arange(len(offs)), offs)
            late = np.zeros(len(flat), np.int64)
            if len(value) and len(flat):
                at = np.minimum(np.searchsorted(value, flat), len(value) - 1)
                late = np.where(value[at] == flat, rank[at], 0)
            by = np.lexsort((flat, late, row))
            take = offs - -(-offs * num // den) + 1
            start = np.cumsum(offs) - offs
            place = np.arange(len(flat)) - start[row]
            kept = flat[by][place < take[row]]
            ends = np.concatenate(([0], np.cumsum(np.minimum(take, offs)))).astype(np.int32)
            bit, half = np.int64(1) << (flat & 63), (flat >> 6) & 1
            parity = [np.zeros(len(offs), np.int64), np.zeros(len(offs), np.int64)]
            for k in (0, 1):
                np.bitwise_xor.at(parity[k], row, np.where(half == k, bit, 0))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(offs.astype(np.int32)), pa.ListArray.from_arrays(pa.array(ends), pa.array(kept)), *map(pa.array, parity)], ["tid", "size", "prefix", "b1", "b2"])

    return sets.select("tid", "set").mapInArrow(run, "tid bigint, size int, prefix array<bigint>, b1 bigint, b2 bigint")


#: Rows of a side of the pair join that a task gets, about.
_ROWS = 200_000


def _pairs(rows: DataFrame, key: str, ident: str, keep: Column, hot: DataFrame, block: int, also: list[str], n: int = 0) -> DataFrame:
    """Pairs (a_..., b_... of ident and of the columns ``also``) of rows that share ``key``, with ``keep`` on the pair and
    a's ident below b's.

    ``hot`` (key, m), a written table, has at least all keys of more than ``block`` rows. Their rows are cut into blocks by a hash of ident, and
    each pair of blocks is a join key of its own, so that no task gets a whole hot key. ``n``, the number of rows, sets the
    number of tasks, whatever the session's partitions for shuffles are.
    """
    tasks = max(rows.sparkSession.sparkContext.defaultParallelism, -(-n // _ROWS))
    rest = [c for c in rows.columns if c != key]
    out = [f"{s}_{c}" for s in "ab" for c in (ident, *also)]

    def side(df: DataFrame, name: str, low: str = "", high: str = "") -> DataFrame:
        at = [F.col(low).alias("_p"), F.col(high).alias("_q")] if low else []
        return df.select(F.col(key).alias("_key"), *at, *[F.col(c).alias(f"{name}_{c}") for c in rest])

    def join(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
        # the one shuffle that the join needs anyway
        left, right = (x.repartition(tasks, *on) for x in (left, right))
        return left.join(right, on).where((F.col(f"a_{ident}") < F.col(f"b_{ident}")) & keep).select(*out)

    if not hot.take(1):
        return join(side(rows, "a"), side(rows, "b"), ["_key"])
    cold = rows.join(hot.select(key), key, "left_anti")
    cold = join(side(cold, "a"), side(cold, "b"), ["_key"])
    blocks = hot.select(key, F.ceil(F.col("m") / block).cast("int").alias("_blocks"))
    cut = salted_join(rows, blocks, [key], ident, hot_keys(hot, [key], "m")).withColumn("_x", F.pmod(F.xxhash64(F.lit(3), ident), F.col("_blocks")).cast("int"))
    cut = cut.select("*", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)).alias("_y"))
    return cold.unionByName(join(side(cut, "a", "_x", "_y"), side(cut, "b", "_y", "_x"), ["_key", "_p", "_q"]))


def _expand(pairs: DataFrame, side: str, many: DataFrame, hot: list[int], out: list[str], own: list[Column]) -> DataFrame:
    """Replaces the group in column ``side`` by each of its members: columns ``out`` of ``many`` (gid, ...). Groups outside
    ``many`` are their own member, with the values ``own``."""
    several = salted_join(many.withColumnRenamed("gid", side), pairs, [side], out[0], hot)
    lone = pairs.join(many.select(F.col("gid").alias(side)).distinct(), side, "left_anti").withColumns(dict(zip(out, own)))
    return several.unionByName(lone).drop(side)


class Similar(NamedTuple):
    """Written tables of a run: all texts as (id, m), their classes of equal text (m, tid, copies), and the similar ones among
    these (x, y), each pair once."""

    rows: DataFrame
    classes: DataFrame
    pairs: DataFrame


def _apart(a: str, b: str) -> Column:
    """In how many shingles two sets differ at least, by their parity bits."""
    return F.bit_count(F.col(f"{a}b1").bitwiseXOR(F.col(f"{b}b1"))) + F.bit_count(F.col(f"{a}b2").bitwiseXOR(F.col(f"{b}b2")))


def _close(a: Column, b: Column, apart: Column, num: int, den: int) -> Column:
    """Whether sets of these sizes that differ in ``apart`` shingles can be similar."""
    return (a + b - apart) * (num + den) >= 2 * (a + b) * num


def similar(df: DataFrame, id_col: str, text_col: str, words: int, least_words: int, num: int, den: int, common: int, block: int) -> Similar:
    low = df.select(F.col(id_col).cast("long").alias("id"), F.lower(F.col(text_col)).alias("t")).where("id is not null and t is not null")
    found = low.select("id", "t", words_of(F.col("t")).alias("w")).where(F.size("w") >= least_words)
    base = written(found.select("id", F.unhex(F.md5(collapse_ws(F.col("t")))).alias("m"), shingles(F.col("w"), words).alias("set")), "base")
    texts = base.groupBy("m").agg(F.min("id").alias("tid"), F.min_by("set", "id").alias("set"), F.count("*").alias("copies"))
    sets = written(texts.withColumn("size", F.size("set")), "sets")
    rows, classes = written(base.select("id", "m"), "rows"), written(sets.select("m", "tid", "copies"), "classes")
    dropped(base)

    counts = written(sets.select(F.explode("set").alias("s")).groupBy("s").agg(F.count("*").alias("n")).where("n > 1"), "shingles")
    top = most_frequent(counts, "s", common)
    prefixed = _prefixes(sets, np.array(top[::-1], np.int64), num, den)
    prefixed = written(prefixed.withColumns({"g": F.xxhash64("prefix"), "h": F.xxhash64(F.lit(1), "prefix")}), "prefixes")

    # groups of one prefix and one size
    key = ["g", "h", "size"]
    groups = written(prefixed.groupBy(*key).agg(F.min("tid").alias("gid"), F.count("*").alias("m")).where("m > 1"), "groups")
    many = written(salted_join(prefixed.select(*key, "tid", "b1", "b2"), groups, key, "tid", hot_keys(groups, key, "m")).select("gid", "tid", "size", "b1", "b2"), "members")
    hot_groups = hot_keys(groups, ["gid"], "m")
    heads = prefixed.join(many.where("gid <> tid").select("tid"), "tid", "left_anti").join(groups.select("gid", F.lit(True).alias("several")), F.col("tid") == F.col("gid"), "left").drop("gid")
    # a group's bits are its members' own; only those of a lone text can filter pairs of groups
    bits = [F.when(F.col("several").isNull(), F.col(b)).alias(b) for b in ("b1", "b2")]
    heads = heads.select(F.col("tid").alias("gid"), "size", *bits, F.posexplode("prefix").alias("pos", "s"))

    sa, sb = F.col("a_size"), F.col("b_size")
    fits = (
        (F.least(sa, sb) * den >= F.greatest(sa, sb) * num)
        # the shared part can't be larger than this shingle and all after it in either set
        & ((1 + F.least(sa - 1 - F.col("a_pos"), sb - 1 - F.col("b_pos"))) * (num + den) >= (sa + sb) * num)
        & F.coalesce(_close(sa, sb, _apart("a_", "b_"), num, den), F.lit(True))
    )
    hot = written(counts.where(F.col("n") > block).select("s", F.col("n").alias("m")), "hot")
    pairs = _pairs(heads.select("s", "gid", "size", "pos", "b1", "b2"), "s", "gid", fits, hot, block, ["size", "b1", "b2"], prefixed.agg(F.sum(F.size("prefix"))).first()[0] or 0)
    pairs = written(pairs.distinct(), "pairs")
    dropped(counts, hot)
    across = pairs
    for side, out in (("a", "x"), ("b", "y")):
        names = [out, f"{out}_size", f"{out}_b1", f"{out}_b2"]
        members = many.select("gid", *[F.col(c).alias(n) for c, n in zip(("tid", "size", "b1", "b2"), names)])
        across = _expand(across, f"{side}_gid", members, hot_groups, names, [F.col(f"{side}_{c}") for c in ("gid", "size", "b1", "b2")])
    across = across.where(_close(F.col("x_size"), F.col("y_size"), _apart("x_", "y_"), num, den)).select("x", "y")
    hot = written(groups.where(F.col("m") > block).select("gid", "m"), "hot")
    inside = _pairs(many, "gid", "tid", _close(sa, sb, _apart("a_", "b_"), num, den), hot, block, [])
    found = written(across.unionByName(inside.select(F.col("a_tid").alias("x"), F.col("b_tid").alias("y"))), "candidates")
    dropped(prefixed, groups, many, pairs, hot)

    # verified on whole sets; a text in very many pairs is spread by its partner
    loads = [written(found.groupBy(side).agg(F.count("*").alias("n")), "load") for side in ("x", "y")]
    hot_x, hot_y = hot_keys(loads[0], ["x"]), hot_keys(loads[1], ["y"])
    found = salted_join(found, sets.select(F.col("tid").alias("x"), F.col("set").alias("sx")), ["x"], "y", hot_x)
    found = salted_join(found, sets.select(F.col("tid").alias("y"), F.col("set").alias("sy")), ["y"], "x", hot_y)
    shared = found.select("x", "y", F.size(F.array_intersect("sx", "sy")).alias("o"), (F.size("sx") + F.size("sy")).alias("n"))
    done = written(shared.where(F.col("o") * den >= (F.col("n") - F.col("o")) * num).select("x", "y"), "similar")
    dropped(sets, *loads)
    return Similar(rows, classes, done)


def similar_classes(df: DataFrame, id_col: str, text_col: str, words: int = 3, least_words: int = 12, num: int = 1, den: int = 2, common: int = 200_000, block: int = 2_000) -> DataFrame:
    """(id, class_id, n_links): every row of at least ``least_words`` words with the least id among the rows of equal normalised
    text, and the number of other texts that are similar to it, each counted once however often it was copied.

    The form for whole corpora: copies aren't expanded to pairs. Null ids and texts and shorter texts have no row; the rest is as in ``similar_pairs``."""
    found = similar(df, id_col, text_col, words, least_words, num, den, common, block)
    both = found.pairs.select(F.col("x").alias("tid")).unionByName(found.pairs.select(F.col("y").alias("tid")))
    links = both.groupBy("tid").agg(F.count("*").alias("n"))
    of = found.classes.join(links, "tid", "left").select("m", "copies", F.col("tid").alias("class_id"), F.coalesce("n", F.lit(0)).cast("long").alias("n_links"))
    hot = hot_keys(found.classes, ["m"], "copies")
    return salted_join(found.rows, of.drop("copies"), ["m"], "id", hot).select(F.col("id").alias(id_col), "class_id", "n_links")


def similar_pairs(df: DataFrame, id_col: str, text_col: str, words: int = 3, least_words: int = 12, num: int = 1, den: int = 2, common: int = 200_000, block: int = 2_000) -> DataFrame:
    """(id_1, id_2), id_1 < id_2: rows of at least ``least_words`` words whose texts still differ once lower-cased, trimmed
    and with white space made one space, and whose shingle sets share at least num/den of their union.

    Rows with a null id or text have no pairs, nor have texts of fewer words; repeated ids are one row each and no pair with themselves. All rows of similar
    texts are paired, copies too; equal texts aren't. Texts are read whole; an empty table gives no rows; other columns are
    ignored. ``common`` bounds the list of most frequent shingles that the driver gets to order prefixes by (it changes
    no result), ``block`` the rows of one key in a task.
    """
    found = similar(df, id_col, text_col, words, least_words, num, den, common, block)
    # texts to their rows: copies by digest, everything else stands for itself
    copied = found.classes.where("copies > 1")
    copies = salted_join(found.rows, copied.select("m", "tid"), ["m"], "id", hot_keys(copied, ["m"], "copies"))
    copies = written(copies.select(F.col("tid").alias("gid"), F.col("id").alias("member")), "copies")
    hot = hot_keys(copied, ["tid"], "copies")
    full = found.pairs
    for side, out in (("x", "i"), ("y", "j")):
        full = _expand(full, side, copies.withColumnRenamed("member", out), hot, [out], [F.col(side)])
    full = full.where("i <> j")
    return full.select(F.least("i", "j").alias(f"{id_col}_1"), F.greatest("i", "j").alias(f"{id_col}_2"))
