"""Variant spellings of names: suffix blocking and comparison by longest common subsequences."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from florilege.session import hot_keys, salted_join, spread, written

# Stand-ins for unnamed people.
NOBODY = {
    "anonymous", "anon", "unknown", "unnamed", "uncredited", "various", "traditional", "trad", "nn", "n n", "na", "n a", "none", "null",
    "nobody", "someone", "author unknown", "unknown author", "voice", "voices", "narrator", "extra", "extras", "himself", "herself",
    "themselves", "themself", "self", "tba", "tbd", "xxx", "not given", "not known", "not credited", "unidentified", "ensemble", "cast", "other", "others", "et al",
}
# Forms of address and marks of descent that aren't part of a name.
TITLES = {
    "mr", "mrs", "ms", "miss", "mister", "dr", "doctor", "prof", "professor", "sir", "dame", "lord", "lady", "rev", "reverend", "fr", "father",
    "st", "hon", "capt", "captain", "col", "colonel", "gen", "general", "lt", "sgt", "sergeant", "maj", "major", "madame", "mme", "mlle",
    "monsieur", "herr", "frau", "don", "dona", "senor", "senora", "president", "senator", "judge", "king", "queen", "prince", "princess", "saint",
    "jr", "sr", "junior", "senior", "ii", "iii", "iv", "phd", "md", "esq",
}
# Short forms of words in names of organisations.
SHORT_WORDS = {
    "soc": "society", "univ": "university", "inst": "institute", "co": "company", "corp": "corporation", "assoc": "association", "assn": "association",
    "acad": "academy", "coll": "college", "dept": "department", "intl": "international", "natl": "national", "comm": "committee", "lib": "library",
    "mus": "museum", "bros": "brothers", "fed": "federation", "org": "organisation", "ctr": "center", "centre": "center",
}
# Words that mark an organisation, and words that carry nothing there.
ORGANISATION = {*SHORT_WORDS.values(), "guild", "club", "league", "union", "board", "council", "ministry", "bureau", "office", "school", "church", "courier", "press", "weavers", "letters", "orchestra", "theatre", "theater", "party", "group", "band", "choir"}
FILLERS = {"of", "for", "the", "and", "a", "an", "de", "la", "le", "et", "und", "der", "die", "das"}
# Familiar forms of given names.
NICKNAMES = """
abby abigail; ada adelaide; al albert alfred alan; alex alexander alexandra; alf alfred; andy andrew; angie angela; ann anna; annie anna; archie archibald;
art arthur; babs barbara; barb barbara; bart bartholomew; bea beatrice; becky rebecca; bella isabel isabella; ben benjamin; bernie bernard; bert albert herbert hubert bertha robert;
bertie albert herbert; bess elizabeth; bessie elizabeth; beth elizabeth; betsy elizabeth; betty elizabeth; bill william; billy william; bob robert; bobby robert; caddie caroline;
carrie caroline; cathy catherine; charlie charles; chas charles; chris christopher christian christine; chuck charles; cissy cecilia; clem clement; con conrad cornelius; connie constance;
dan daniel; danny daniel; dave david; davy david; deb deborah; debbie deborah; della delia adele; dick richard; doll dorothy; dolly dorothy; dom dominic; don donald; dot dorothy; dottie dorothy;
doug douglas; ed edward edgar edmund; eddie edward edgar edmund; ella eleanor ellen; ellie eleanor ellen; eliza elizabeth; ernie ernest; etta henrietta; fanny frances; flo florence;
flossie florence; fran frances; frank francis franklin; fred frederick alfred; freddie frederick; fritz frederick; gabe gabriel; gene eugene; geoff geoffrey; georgie george; gert gertrude; gerry gerald; gil gilbert; gina regina;
ginny virginia; greg gregory; gus gustav augustus august; hal harold henry; hank henry; harry harold henry; hattie harriet; herb herbert; hettie henrietta; ike isaac; iz isabel; izzy isabel isidore;
jack john; jackie jacqueline; jake jacob; jan janet; jeff geoffrey jeffrey; jen jennifer; jenny jennifer; jerry jerome gerald jeremiah; jess jessica; jessie jessica; jim james; jimmy james; jo josephine joanna; joe joseph;
joey joseph; john jonathan; johnny john; jon jonathan; josh joshua; josie josephine; judy judith; kate catherine katherine katrina; kathy catherine katherine; katie catherine katherine; ken kenneth; kit christopher katherine; kitty catherine katherine; larry laurence lawrence;
len leonard; lenny leonard; leo leopold leonard; les leslie; lettie charlotte letitia; libby elizabeth; lil lilian; lily lilian; liz elizabeth; lizzie elizabeth; lottie charlotte; lou louis louisa; lucy lucille; maddie madeleine; mag margaret; maggie margaret; mamie mary;
manny emanuel; marge margaret; marty martin; mattie mathilda; matt matthew; maude mathilda; max maximilian; meg margaret; mel melvin melanie; mick michael; mike michael; millie mildred millicent; mina minerva; minnie minerva; moe moses maurice; molly mary; nan anna; nancy anna;
nat nathaniel nathan; nate nathaniel nathan; ned edward edmund; nell eleanor ellen helen; nellie eleanor ellen helen; nettie annette; nick nicholas; nicky nicholas; nora eleanor; norm norman; ollie oliver olivia; paddy patrick; pam pamela; pat patrick patricia; patty patricia; paula pauline; peg margaret; peggy margaret;
penny penelope; pete peter; phil philip; polly mary; ray raymond; reg reginald; rich richard; rick richard; rob robert; robbie robert; robin robert; ron ronald; rosie rosemary rosalind; roz rosalind; rudy rudolf; rube reuben; sadie sarah; sal sarah; sally sarah; sam samuel; sandy alexander; seb sebastian;
sid sidney; sol solomon; stan stanley; steve stephen; stevie stephen; sue susan; susie susan; syl sylvia; tabby tabitha; ted edward theodore; teddy edward theodore; terry terence theresa; tess theresa; thad thaddeus; theo theodore; tilly mathilda; tim timothy; tina christina; toby tobias; tom thomas;
tommy thomas; tony anthony anton; trish patricia; ursa ursula; val valentine valerie; vern vernon; vicky victoria; vic victor victoria; vin vincent; vince vincent; viv vivian; wally walter; walt walter; will william; willie william; winnie winifred; zeke ezekiel
"""
# Given names of one slip's distance from others, which are names of their own.
DISTINCT = set(
    "ada ida eva ava nora dora cora flora lora laura joan joel john jean emil emma ella elsa elias carl karl clara alan alma anna hannah "
    "julia julius julian marian marion maria marie mary martha paul paula rosa rose ruth roy ray lucas lucy luke jonas jonah june jane janet "
    "silas simon amos moses otto olga iris irene ivan ian eric erica edith judith enoch ezra vera vernon viola victor victoria helen ellen "
    "gerald gerard harold homer horace bertha martin marvin oscar peter philip rachel rebecca sarah sandra stella sylvia thomas".split()
)
_FORMAL = {w[0]: frozenset(w) for w in (row.split() for row in NICKNAMES.replace("\n", " ").split(";"))}


def plain(text: str) -> str:
    """Lower case without accents and without characters that aren't letters, digits, commas or spaces."""
    decomposed = unicodedata.normalize("NFKD", text.replace("ß", "ss").replace("ø", "o").replace("Ø", "o").replace("ł", "l").replace("Ł", "l"))
    t = "".join(c for c in decomposed if not unicodedata.combining(c)).lower()
    t = re.sub(r"[’'`´]s?\b", "", t)
    return re.sub(r"[^\w,]+|_", " ", t).strip()


class Name(NamedTuple):
    family: str
    given: tuple[str, ...]
    words: tuple[str, ...]  # of an organisation, sorted; empty for a person


@lru_cache(maxsize=200_000)
def parse(text: str) -> Name | None:
    """The parts of a name; None for stand-ins and texts without letters."""
    outer = re.sub(r"[(\[][^()\[\]]*[)\]]", " ", text)
    t = plain(outer) or plain(text)
    bare = t.replace(",", " ")
    if " ".join(bare.split()) in NOBODY or not any(c.isalpha() for c in bare):
        return None
    words = [SHORT_WORDS.get(w, w) for w in bare.split()]
    if any(w in ORGANISATION for w in words) and len(words) > 1:
        return Name("", (), tuple(sorted(w for w in words if w not in FILLERS)) or tuple(words))
    head, comma, tail = t.partition(",")
    rest = [w for w in tail.replace(",", " ").split() if w not in TITLES]
    first = [w for w in head.split() if w not in TITLES]
    if comma and rest and first:
        return Name(first[-1] if len(first) == 1 else " ".join(first), tuple(rest), ())
    tokens = first or head.split()
    if not tokens:
        return None
    if len(tokens) > 1 and len(tokens[-1]) == 1 and len(tokens[0]) > 1 and all(len(x) == 1 for x in tokens[1:]):
        return Name(tokens[0], tuple(tokens[1:]), ())  # family name first, then initials
    return Name(tokens[-1], tuple(tokens[:-1]), ())


def subsequence(a: str, b: str) -> int:
    """Length of the longest common subsequence, by bits of a machine word."""
    if len(a) < len(b):
        a, b = b, a
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for c in b:
        match = row & places.get(c, 0)
        row = ((row + match) | (row - match)) & full
    return len(a) - row.bit_count()


def ratio(a: str, b: str) -> float:
    return 1.0 if a == b else 2 * subsequence(a, b) / (len(a) + len(b)) if a and b else 0.0


def _close(a: str, b: str, least: float) -> bool:
    """Equal but for about one slip (two in long words)."""
    if a == b:
        return True
    if min(len(a), len(b)) < 3 or abs(len(a) - len(b)) > 2:
        return False
    common = subsequence(a, b)
    off = max(len(a), len(b)) - common
    return 2 * common / (len(a) + len(b)) >= least and off <= (1 if min(len(a), len(b)) < 8 else 2)


def _formal(g: str) -> frozenset[str]:
    return _FORMAL.get(g, frozenset((g,)))


FULL, INITIAL, NONE = 2, 1, 0


@lru_cache(maxsize=200_000)
def given_match(a: str, b: str) -> int:
    """How two given names agree: as names (also familiar forms and slips), by an initial, or not."""
    if a == b:
        return FULL if len(a) > 1 else INITIAL
    if len(a) == 1 or len(b) == 1:
        x, y = (a, b) if len(a) == 1 else (b, a)
        return INITIAL if any(f[0] == x for f in _formal(y)) else NONE
    fa, fb = _formal(a), _formal(b)
    if fa & fb:
        return FULL
    # slips are only looked for between forms that aren't both known names
    if a in KNOWN and b in KNOWN:
        return NONE
    return FULL if any(_close(x, y, 0.75) for x in fa for y in fb if not (x in KNOWN and y in KNOWN)) else NONE


#: Given names known as such, by the fixed tables only: others that differ by a slip inside a family are taken for one.
KNOWN = frozenset(f for s in _FORMAL.values() for f in s) | DISTINCT


def match(a: Name, b: Name) -> int:
    """FULL: the same one; INITIAL: the same as far as initials tell; NONE: another."""
    if a.words or b.words:
        if len(a.words) != len(b.words):
            return NONE
        left = list(b.words)
        slips = 0
        for w in a.words:
            best = max(left, key=lambda x: ratio(w, x))
            if not _close(w, best, 0.8):
                return NONE
            slips += w != best
            left.remove(best)
        return FULL if slips <= 2 else NONE
    best = _person(a, b)
    if best < FULL and not best:
        # family and given name may have changed places
        if len(a.given) == 1 and len(a.given[0]) > 1:
            best = max(best, _person(Name(a.given[0], (a.family,), ()), b))
        if best < FULL and len(b.given) == 1 and len(b.given[0]) > 1:
            best = max(best, _person(a, Name(b.given[0], (b.family,), ())))
    return best


def _person(a: Name, b: Name) -> int:
    if not _close(a.family, b.family, 0.8):
        return NONE
    if not a.given or not b.given:
        return FULL if a.family == b.family and not a.given and not b.given else NONE
    how = given_match(a.given[0], b.given[0])
    if not how:
        return NONE
    for x, y in zip(a.given[1:], b.given[1:]):
        if not given_match(x, y):
            return NONE
    if how == FULL and a.family != b.family and a.given[0] != b.given[0] and not (_formal(a.given[0]) & _formal(b.given[0])):
        # slips in both parts: only if they are slight
        return FULL if ratio(a.family, b.family) >= 0.85 and ratio(a.given[0], b.given[0]) >= 0.8 else NONE
    return how


def related(a: Name, b: Name) -> bool:
    """A weaker test, for names that both agree in full with a third one."""
    if match(a, b):
        return True
    if a.words or b.words or not (a.given and b.given):
        return False
    return given_match(a.given[0], b.given[0]) == FULL and ratio(a.family, b.family) >= 0.78


def _keys(text: str, shortest: int) -> Iterator[tuple[str, str, list[str]]]:
    """(token, ..., beginnings of the other tokens, one that is empty where there are none) of each token of a name that is long enough.
    Short ones only count where names may have nothing else in common: as a family name, or as a given name in its place."""
    n = parse(text)
    if n is None:
        return
    tokens = list(dict.fromkeys(n.words or (*n.family.split(), *n.given)))
    forms = {t: {t} | (set(_formal(t)) if t in n.given else set()) for t in tokens}
    least = min(3, shortest)
    family = n.words or n.family.split()
    short = set() if any(len(t) >= least for t in family) else set(family)
    if len(n.given) == 1 and len(n.given[0]) > 1:
        short.add(n.given[0])
    for t in tokens:
        others = sorted({o[:k] for u in tokens if u != t for o in forms[u] for k in (1, 2)}) or [""]
        for f in sorted(forms[t]):
            if len(f) >= least or f == t and t in short:
                yield f, t, others


def _keyed(values: DataFrame, shortest: int, common: int) -> DataFrame:
    """(key, field, v, name): all keys under which names are compared, as ``linked_names`` says."""

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: tuple[list, ...] = ([], [], [], [], [], [])
            for field, name, v in zip(*(c.to_pylist() for c in b.columns)):
                for token, source, others in _keys(name, shortest):
                    for size in range(min(shortest, len(token)), len(token) + 1):
                        for o, x in zip(out, (field, v, name, token[-size:], size == len(token), others)):
                            o.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(o, t) for o, t in zip(out, (pa.string(), pa.int64(), pa.string(), pa.string(), pa.bool_(), pa.list_(pa.string())))], ["field", "v", "name", "suffix", "whole", "others"])

    suffixes = written(values.select("field", "name", "v").mapInArrow(index, "field string, v bigint, name string, suffix string, whole boolean, others array<string>"), "suffixes")
    size = suffixes.groupBy("field", "suffix").agg(F.count_distinct("v").alias("n"))
    size = written(size, "sizes")
    marked = salted_join(suffixes, size, ["field", "suffix"], "v", hot_keys(size, ["field", "suffix"]))
    good = marked.where(F.col("n") <= common)
    shortest_good = Window.partitionBy("field", "v", "token").orderBy(F.length("suffix"))
    # a token's suffixes end alike, so its last letters tell it apart within the name well enough
    good = good.withColumn("token", F.substring("suffix", -shortest, shortest)).withColumn("k", F.row_number().over(shortest_good)).where("k = 1")
    plain_keys = good.select(F.concat_ws("|", "field", "suffix").alias("key"), "field", "v", "name")
    refined = marked.where((F.col("n") > common) & ((F.length("suffix") == shortest) | F.col("whole"))).select("field", "v", "name", "suffix", F.explode("others").alias("o"))
    refined = refined.select(F.concat_ws("|", "field", "suffix", "o").alias("key"), "field", "v", "name")
    return plain_keys.unionByName(refined).distinct()


def _block_pairs(rows: DataFrame, counts: DataFrame, block: int, columns: list[str]) -> DataFrame:
    """All pairs of rows of one ``key``, in both orders and with themselves, as columns with 1 and 2 behind their names.
    ``counts`` (key, m), a written table, has the keys of several rows: those of more than ``block`` are cut into blocks by a
    hash, and each pair of blocks is a join key of its own."""
    blocks = counts.select("key", F.ceil(F.col("m") / block).cast("int").alias("_n"))
    cut = salted_join(rows, blocks, ["key"], columns[1], hot_keys(counts, ["key"], "m")).withColumn("_x", F.pmod(F.xxhash64(F.lit(3), *columns), F.col("_n")).cast("int"))
    cut = cut.select("*", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)).alias("_y"))
    side = lambda k, p, q: cut.select("key", F.col(p).alias("_p"), F.col(q).alias("_q"), *[F.col(c).alias(f"{c}{k}") for c in columns])
    return side(1, "_x", "_y").join(side(2, "_y", "_x"), ["key", "_p", "_q"])


def linked_names(df: DataFrame, id_col: str, fields: dict[str, str | None], shortest: int = 4, common: int = 60, block: int = 1_000) -> DataFrame:
    """(field, id_1, id_2), id_1 < id_2: rows whose names in a field are different strings for one person or organisation.

    ``fields`` maps a column to a condition (SQL) on the rows it is read from, or None. Fields aren't compared with
    each other. Null, blank and stand-in names link nothing; equal strings aren't linked; all rows of linked strings are
    paired. Rows with a null id are left out. Extra columns and an empty table do no harm.

    Blocking: each token of ``shortest`` letters or more is indexed by its suffixes. A suffix that more than ``common``
    distinct names have is first refined with the beginnings (one and two letters) of the name's other tokens. A name with several other tokens stands under each, a name of one token under an empty beginning.
    A family name of fewer than three letters, and a given name that may stand in its place, are indexed whole.
    A refined key of more than ``block`` names is cut into blocks that are compared pair by pair, so no task gets a hot one; none is given up, so
    the comparisons grow with the square of the names that share a suffix and a beginning.
    The shortest suffix that isn't common stands for all longer ones of the token.
    """
    parts = []
    for field, condition in fields.items():
        rows = df.where(condition) if condition else df
        parts.append(rows.select(F.lit(field).alias("field"), F.col(id_col).cast("long").alias("id"), F.col(field).alias("name")))
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    rows = rows.where("id is not null and name is not null")
    values = written(rows.groupBy("field", "name").agg(F.min("id").alias("v"), F.count("*").alias("n")), "names")

    keyed = written(_keyed(values, shortest, common), "keys")
    counts = written(keyed.groupBy("key").agg(F.count("*").alias("m")).where("m > 1"), "counts")
    pairs = _block_pairs(keyed.select("key", "field", "v", "name"), counts, block, ["field", "v", "name"])
    pairs = pairs.where("v1 < v2 or (v1 = v2 and name1 < name2)").select(F.col("field1").alias("field"), "v1", F.col("name1").alias("n1"), "v2", F.col("name2").alias("n2")).distinct()
    pairs = spread(pairs)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n1, n2 = b.column(2).to_pylist(), b.column(4).to_pylist()
            how = [match(x, y) if (x := parse(s)) and (y := parse(t)) else NONE for s, t in zip(n1, n2)]
            found = pa.RecordBatch.from_arrays([b.column(0), b.column(2), b.column(4), pa.array(how, pa.int32())], ["field", "n1", "n2", "how"])
            yield found.filter(pa.array([h > NONE for h in how]))

    def compare_again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sure = b.column(3).to_pylist()
            keep = [(related if ok else match)(parse(x), parse(y)) for x, y, ok in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), sure)]
            yield b.select(["field", "n1", "n2"]).filter(pa.array([bool(k) for k in keep]))

    first = written(pairs.mapInArrow(compare, "field string, n1 string, n2 string, how int"), "linked")
    # names that share no suffix meet over a third name that both agree with
    back = first.select("field", F.col("n2").alias("n1"), F.col("n1").alias("n2"), "how")
    both = first.unionByName(back)
    # a name with very many links is cut into blocks too
    near = both.select(F.concat_ws("|", "field", "n1").alias("key"), "field", "n2", "how")
    load = written(near.groupBy("key").agg(F.count("*").alias("m")).where("m > 1"), "load")
    over = _block_pairs(near, load, block, ["field", "n2", "how"]).where("n21 < n22")
    over = over.groupBy(F.col("field1").alias("field"), F.col("n21").alias("n1"), F.col("n22").alias("n2")).agg(F.max((F.col("how1") == FULL) & (F.col("how2") == FULL)).alias("sure"))
    second = over.join(both.select("field", "n1", "n2"), ["field", "n1", "n2"], "left_anti").mapInArrow(compare_again, "field string, n1 string, n2 string")
    linked = written(first.select("field", "n1", "n2").unionByName(second), "linked")
    hot = hot_keys(values, ["field", "name"])
    left = salted_join(rows, linked.withColumnRenamed("n1", "name"), ["field", "name"], "id", hot).select("field", F.col("n2").alias("name"), F.col("id").alias("i"))
    full = salted_join(rows, left, ["field", "name"], "id", hot).select("field", "i", F.col("id").alias("j")).where("i <> j")
    return full.select("field", F.least("i", "j").alias(f"{id_col}_1"), F.greatest("i", "j").alias(f"{id_col}_2"))
