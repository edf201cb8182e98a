"""Free-entered values to the entries of a reference list: an automaton for mentions, token sets for the rest.

Nothing here knows the entries of any list: forms of entries, abbreviations and inflections follow from rules, and other
wordings are given with the list as aliases.
"""

from __future__ import annotations

import math
import re
import unicodedata
import uuid
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from florilege.llm.names import ratio, subsequence
from florilege.session import hot_keys, salted_join, spread, written

# Short forms of words in entries.
SHORT = {
    "university": ["univ", "u"], "press": ["pr"], "publishing": ["pub", "publ"], "company": ["co"], "brothers": ["bros"], "and": ["n", "und", "et"],
    "verlag": ["vlg"], "editions": ["ed", "eds"], "house": ["hse"],
}
# Words around an entry that say nothing about which it is.
AROUND = set(
    "vol volume volumes book part no number ed edition editions rev revised paperback hardcover hardback reprint new novel ltd inc llc limited "
    "incorporated plc gmbh i ii iii iv v 1 2 3 4 5 1st 2nd 3rd 4th first second third in from see".split()
)
STOP = {"the", "a", "an", "of", "and", "for", "in", "from", "to", "on", "at", "by", "with"}
# Texts that only say that the value is missing, normalised.
NO_VALUE = {"", "n a", "na", "none", "null", "nil", "tbd", "tba", "xxx", "unknown", "not given", "various", "s n", "sn", "s l", "n d", "anonymous", "untitled", "privately printed", "self published"}


def norm(text: str) -> str:
    """Lower case without accents; ``&`` is a word; everything but letters and digits is a space."""
    t = unicodedata.normalize("NFKD", text)
    t = "".join(c for c in t if not unicodedata.combining(c)).lower().replace("&", " and ").replace("ß", "ss")
    t = re.sub(r"[’'`´]", "", t)
    return " ".join(re.sub(r"[\W_]+", " ", t).split())


def _seen(word: str) -> str:
    """A word as a scanner may see it: shapes that look alike are one."""
    return word.replace("1", "l").replace("0", "o").replace("rn", "m").replace("vv", "w")


def slips(a: str, b: str) -> int:
    """Edits between two words: insertions, deletions, substitutions and swaps of neighbours."""
    if a == b:
        return 0
    n, m = len(a), len(b)
    before, last, row = [], [], list(range(m + 1))
    for i in range(1, n + 1):
        before, last, row = last, row, [i] + [0] * m
        for j in range(1, m + 1):
            same = a[i - 1] == b[j - 1]
            row[j] = min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (not same))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                row[j] = min(row[j], before[j - 2] + 1)
    return row[m]


def allowed(word: str) -> int:
    """Slips that a word of its length may have."""
    return 0 if len(word) < 3 else 1 if len(word) < 6 else 2


def _shorter(word: str) -> set[str]:
    """The word and what is left of it without one or two letters: words of at most two slips have one of these in common."""
    once = {word[:i] + word[i + 1 :] for i in range(len(word))}
    return {word} | once | {w[:i] + w[i + 1 :] for w in once for i in range(len(w))}


def _letters(text: str) -> int:
    """The letters of a text as bits; a slip changes two at most."""
    bits = 0
    for c in set(text):
        bits |= 1 << (ord(c) & 63)
    return bits


#: Words of the list up to this length are looked up by ``_shorter``, longer ones are compared one by one.
_INDEXED = 24
#: Likeness of a word for another word of the list that is one slip away: it may be a slip, but most likely it means itself.
_OTHER_WORD = 0.25
#: Share of an entry's mean word weight that a word costs which is in the value but neither in the entry nor known to go around entries.
_UNKNOWN = 0.125
_VOWELS = re.compile("[aeiouy]")


class Canon:
    """The entries of one field, ready for matching.

    ``entries`` are (ref_id, text), ``aliases`` (other wording, text of its entry). The automaton and all indexes are of the size of
    the reference list, which is given as a list and so bounded by the driver. ``min_score`` is the least likeness, from 0
    to 1, of the token sets of a value and its entry.
    """

    def __init__(self, entries: list[tuple[int, str]], aliases: Iterable[tuple[str, str]] = (), min_score: float = 0.7):
        import ahocorasick

        self.entries = sorted(entries)
        self.min_score = min_score
        self.forms: dict[int, str] = {}
        owner: dict[str, int] = {}
        for ref, text in self.entries:
            n = norm(text)
            if not n:
                continue
            self.forms[ref] = n
            owner.setdefault(n, ref)
        listed = dict(owner)
        for wording, text in aliases:
            if (ref := listed.get(norm(text))) and norm(wording):
                owner.setdefault(norm(wording), ref)
        for ref, n in self.forms.items():
            for form in self._variants(n):
                if form not in listed:
                    owner.setdefault(form, ref)
        self.owner = owner
        self.automaton = ahocorasick.Automaton()
        for form, ref in owner.items():
            self.automaton.add_word(f" {form} ", (form, ref))
        if owner:
            self.automaton.make_automaton()
        self.tokens = {ref: n.split() for ref, n in self.forms.items()}
        df = Counter(t for ts in self.tokens.values() for t in set(ts))
        self.weight = {t: 0.1 if t in STOP else math.log(1 + len(self.tokens) / k) for t, k in df.items()}
        self.vocabulary = {t for t in df if len(t) > 2}
        self.words = {t for form in owner for t in form.split()}
        self.begun: dict[str, set[str]] = defaultdict(set)  # beginnings of words, as abbreviations
        self.initial: dict[str, set[str]] = defaultdict(set)
        for t in df:
            self.initial[t[0]].add(t)
            for k in range(3, len(t) - 1):
                self.begun[t[:k]].add(t)
        self.squeezed = {ref: _seen(self._core(n).replace(" ", "")) for ref, n in self.forms.items()}
        self.shorter: dict[str, set[str]] = defaultdict(set)
        self.long: dict[int, set[str]] = defaultdict(set)
        self.full: dict[str, set[str]] = defaultdict(set)
        for t in df:
            for form in {t, _seen(t)}:
                if len(form) > _INDEXED:
                    self.long[len(form)].add(t)
                else:
                    for x in _shorter(form):
                        self.shorter[x].add(t)
            for x in SHORT.get(t, ()):
                self.full[x].add(t)
        # each entry stands under its rarest word, those of small words only under their trigrams
        self.content = {ref: {t for t in ts if t not in STOP} for ref, ts in self.tokens.items()}
        self.under: dict[str, list[int]] = defaultdict(list)
        self.small: dict[str, set[int]] = defaultdict(set)
        self.joined: dict[frozenset[str], dict[int, list[tuple[int, int]]]] = defaultdict(lambda: defaultdict(list))
        for ref, content in self.content.items():
            if content:
                self.under[min(content, key=lambda t: (df[t], t))].append(ref)
            for g in () if content else self._grams(self.forms[ref]):
                self.small[g].add(ref)
            b = self.squeezed[ref]
            self.joined[frozenset(AROUND.intersection(self.tokens[ref]))][len(b)].append((_letters(b), ref))
        self.near: dict[tuple[str, bool], dict[str, float]] = {}
        self.ordered = sorted({(f, ref) for ref, n in self.forms.items() for f in (n, self._core(n))})

    @staticmethod
    def _core(n: str) -> str:
        words = n.split()
        while len(words) > 1 and words[0] in ("the", "a", "an"):
            words = words[1:]
        return " ".join(words)

    @staticmethod
    def _grams(n: str) -> set[str]:
        t = _seen(n.replace(" ", ""))
        return {t[i : i + 3] for i in range(len(t) - 2)}

    def _variants(self, n: str) -> Iterator[str]:
        core = self._core(n)
        if core != n and (len(core.split()) > 1 or len(core) > 3):
            yield core
        short = [n]
        for word, forms in SHORT.items():
            short += [re.sub(rf"\b{word}\b", f, s) for s in short for f in forms if re.search(rf"\b{word}\b", s)]
        yield from short[1:]
        if n.endswith(" publishing company"):
            yield n[: -len(" company")]
        if n.endswith(" university press"):
            yield n[: -len("university press")] + "up"
            yield n[: -len("university press")] + "u p"

    def mentions(self, n: str) -> list[tuple[int, int, int]]:
        """(start, end, ref) of the longest mentions that don't overlap, in order of place."""
        if not self.owner:
            return []
        found = [(end - len(form) - 1, end, ref) for end, (form, ref) in self.automaton.iter(f" {n} ")]
        found.sort(key=lambda x: (x[0] - x[1], x[0]))
        kept: list[tuple[int, int, int]] = []
        for s, e, ref in found:
            if all(e <= a + 1 or s >= b for a, b, _ in kept):
                kept.append((s, e, ref))
        return sorted(kept)

    def match(self, value: str) -> int:
        """The entry that a value stands for, 0 for none: an entry or alias itself, else the most specific of the longest
        mention (of equal ones the first) and the entry of likest words."""
        n = norm(value)
        if n in NO_VALUE:
            return 0
        if n in self.owner:
            return self.owner[n]
        found = self.mentions(n)
        if not found:
            found = self.mentions(" ".join(map(self._uninflected, n.split())))
        named = max(found, key=lambda x: (x[1] - x[0], -x[0])) if found else None
        if not named and _BROKEN_OFF.search(value):
            return self._cut(n)
        if named and len(self.forms[named[2]].split()) >= len(n.split()):
            return named[2]
        dotted = frozenset(norm(w) for w in _DOTTED.findall(value))
        return self._similar(n, dotted, len(self.content[named[2]]) if named else -1) or (named[2] if named else 0)

    def _uninflected(self, word: str) -> str:
        """A word that isn't the list's as one that is, without its ending."""
        if word not in self.words:
            for end in ("s", "es", "ed", "ing"):
                if word.endswith(end) and len(word) - len(end) > 2 and word[: -len(end)] in self.vocabulary:
                    return word[: -len(end)]
        return word

    def _cut(self, n: str) -> int:
        """A value that breaks off: the entry that goes on from it, if it is the only one."""
        fits = set()
        for head in {n, self._core(n)}:
            at = bisect_left(self.ordered, (head, 0))
            while at < len(self.ordered) and self.ordered[at][0].startswith(head) and len(fits) < 2:
                fits.add(self.ordered[at][1])
                at += 1
        if not fits:
            s = _seen(self._core(n).replace(" ", ""))
            fits = {ref for ref, q in self.squeezed.items() if len(s) > 4 and (_letters(q[: len(s)]) ^ _letters(s)).bit_count() <= 4 and slips(q[: len(s)], s) <= allowed(s)}
        return fits.pop() if len(fits) == 1 else 0

    def _similar(self, n: str, dotted: frozenset[str] = frozenset(), above: int = -1) -> int:
        """By token sets: the entry of more than ``above`` words (small ones don't count) with the highest score from ``min_score`` on. Of equal ones the one with most of the
        value's words counts ("Volume II" is part of some entries and goes around others), then the lowest ref_id."""
        words = set(n.split())
        best: tuple[float, int, int] | None = None
        for ref in self._possible(n, dotted):
            if len(self.content[ref]) <= above:
                continue
            score = self._score(n, ref, dotted)
            if score >= self.min_score:
                key = (-score, -len(words.intersection(self.tokens[ref])), ref)
                best = min(best, key) if best else key
        return best[2] if best else 0

    def _possible(self, n: str, dotted: frozenset[str]) -> set[int]:
        """All entries that ``_score`` may accept, whatever their number: those of which every word that isn't small is
        there but for slips, those that run together are as long and of the same letters but for two slips, and those of small words only that share a trigram."""
        words = n.split()
        there = {t for w in set(words) for t in self._near(w, w in dotted)}
        out = {ref for t in there for ref in self.under.get(t, ()) if self.content[ref] <= there}
        if self.small:
            out.update(*(self.small.get(g, ()) for g in self._grams(n)))
        around = AROUND.intersection(words)
        made: dict[frozenset[str], tuple[int, int]] = {}
        for kept, lengths in self.joined.items():
            kept &= around
            if kept not in made:
                a = _seen(self._core(" ".join(w for w in words if w not in AROUND or w in kept)).replace(" ", ""))
                made[kept] = len(a), _letters(a)
            size, bits = made[kept]
            for k in range(max(size - 2, 7), size + 3):
                out.update(ref for x, ref in lengths.get(k, ()) if (x ^ bits).bit_count() <= 4)
        return out

    def _near(self, word: str, dotted: bool) -> dict[str, float]:
        """The words of the list that ``word`` may stand for, and how likely: 1 for itself, its short forms and shapes that look
        alike. ``dotted``: a full stop follows, so it may be an abbreviation."""
        found = self.near.get((word, dotted))
        if found is None:
            near = set(self.full.get(word, ()))
            for form in {word, _seen(word)}:
                if len(form) <= _INDEXED + 2:
                    near.update(*(self.shorter.get(x, ()) for x in _shorter(form)))
                for k in range(len(form) - 2, len(form) + 3):
                    near.update(self.long.get(k, ()))
            found = {t: k for t in near if (k := self._likeness(word, t))}
            if dotted and word not in self.words:
                found |= dict.fromkeys(self.begun.get(word, ()), 1.0)
            if len(word) > 2 and word not in self.words and not _VOWELS.search(word[1:]):  # consonants alone
                found |= {t: 1.0 for t in self.initial.get(word[0], ()) if len(t) > len(word) and subsequence(word, t) == len(word)}
            if len(self.near) < 200_000:
                self.near[word, dotted] = found
        return found

    def _score(self, n: str, ref: int, dotted: frozenset[str]) -> float:
        """Likeness of the value's words and the entry's, 0 where a word of the entry lacks that isn't small.

        The entry's words by weight, each times its likeness to the value's word for it, over all of them and a share for each
        word left that is neither small, a number nor known to go around entries. Words run together or torn apart
        count by slips of the whole."""
        target, words = self.tokens[ref], n.split()
        left = list(words)
        likeness = dict.fromkeys(range(len(target)), 0.0)
        for exact in (True, False):
            for i, t in enumerate(target):
                if not likeness[i] and left:
                    w = t if exact else max(left, key=lambda w: self._near(w, w in dotted).get(t, 0.0))
                    k = (1.0 if t in left else 0.0) if exact else self._near(w, w in dotted).get(t, 0.0)
                    if k:
                        likeness[i] = k
                        left.remove(w)
        score = 0.0
        if all(likeness[i] or t in STOP for i, t in enumerate(target)):
            rest = [w for w in left if w not in AROUND and w not in STOP and not w.isdigit()]
            # "teh", "annd": slips of small words
            rest = [w for w in rest if not any(abs(len(w) - len(s)) < 2 and slips(w, s) <= 1 for s in STOP if len(s) > 1)]
            weights = [self.weight[t] for t in target]
            whole = sum(weights)
            counted = sum(1 for t in target if t not in STOP) or 1
            score = sum(w * (likeness[i] or (1.0 if t in STOP else 0.0)) for i, (t, w) in enumerate(zip(target, weights))) / (whole + len(rest) * _UNKNOWN * whole / counted)
        if score < self.min_score and len(words) != len(target):
            a, b = _seen(self._core(" ".join(w for w in words if w not in AROUND or w in target)).replace(" ", "")), self.squeezed[ref]
            if abs(len(a) - len(b)) <= 2 and len(b) > 6 and max(len(a), len(b)) - subsequence(a, b) <= 2 and (k := slips(a, b)) <= 2:
                score = max(score, 1 - (k + 0.5) / len(b))
        return score

    def _likeness(self, word: str, target: str) -> float:
        """How likely ``word`` was meant for ``target``, by its slips; 0 if it is too far off or a word of its own."""
        if word == target or (target in SHORT and word in SHORT[target]):
            return 1.0
        a, b = _seen(word), _seen(target)
        if a == b:
            return 1.0
        if min(len(a), len(b)) < 2 or abs(len(a) - len(b)) > 2:
            return 0.0
        k = min(slips(a, b), slips(word, target))
        if target in STOP:
            return 1 - k / 4 if len(target) > 2 and k <= 2 and word not in self.vocabulary else 0.0
        if word in self.vocabulary:  # another word of the list: one slip may have made it
            return _OTHER_WORD if k == 1 and len(b) > 2 else 0.0
        if k > max(allowed(b), 2 if len(b) == 5 else 0) or (k > 1 and ratio(a, b) < 0.65):
            return 0.0
        return 1 - k / len(b)


#: A value that breaks off; a word with a full stop.
_BROKEN_OFF = re.compile(r"(?:\.\.\.|…)\s*[\"”']?\s*$")
_DOTTED = re.compile(r"([^\W_]+)\.")
#: Matchers of this Python worker, of the last call only: they are built once a worker, not once a task.
_made: dict[tuple[str, str], Canon] = {}


def _canon(run: str, field: str, entries: list[tuple[int, str]], aliases: list[tuple[str, str]]) -> Canon:
    if (run, field) not in _made:
        for old in [k for k in _made if k[0] != run]:
            del _made[old]
        _made[run, field] = Canon(entries, aliases)
    return _made[run, field]


def map_values(df: DataFrame, id_col: str, fields: list[str], canon: DataFrame, aliases: dict[str, list[tuple[str, str]]] | None = None, max_entries: int = 200_000) -> DataFrame:
    """(id, field, ref_id) of each non-null value that isn't exactly an entry of its field; ref_id 0 for none.

    ``canon`` (ref_id, field, canonical) is the reference list; ``aliases`` has, by field, other wordings and the entries they
    stand for. The list goes to every worker, so its size is checked:
    beyond ``max_entries`` the call fails rather than flood the workers. Distinct values are matched once and joined
    back; a value that a third of all rows have is one lookup and spread in the join. Blank values and those that only say that the value is missing give 0.
    Null values give no row, null ids are kept, repeated rows give repeated rows, empty tables none; entries that are null or blank match nothing,
    of equal entries the lowest ref_id counts; values of any length are matched whole.
    """
    spark = df.sparkSession
    listed = canon.select(F.col("ref_id").cast("long"), "field", "canonical").where(F.col("field").isin(fields) & F.col("canonical").isNotNull() & F.col("ref_id").isNotNull())
    rows = listed.limit(max_entries + 1).collect()
    if len(rows) > max_entries:
        raise ValueError(f"the reference list has more than {max_entries} entries")
    entries: dict[str, list[tuple[int, str]]] = defaultdict(list)
    for r in rows:
        entries[r["field"]].append((r["ref_id"], r["canonical"]))
    shared = spark.sparkContext.broadcast(dict(entries))
    known_as, token = aliases or {}, uuid.uuid4().hex
    long = df.select(F.col(id_col).alias("_id"), F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("value")) for f in fields])).alias("x")).select("_id", "x.*").where("value is not null")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        exact: dict[str, set[str]] = {}
        for b in batches:
            out: list[int | None] = []
            for f, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if f not in exact:
                    exact[f] = {t for _, t in shared.value.get(f, [])}
                out.append(None if v in exact[f] else _canon(token, f, shared.value.get(f, []), known_as.get(f, [])).match(v))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.int64())], ["field", "value", "n", "ref_id"])

    values = long.groupBy("field", "value").agg(F.count("*").alias("n"))
    known = written(spread(values).mapInArrow(run, "field string, value string, n bigint, ref_id bigint").where("ref_id is not null"), "canon")
    return salted_join(long, known.drop("n"), ["field", "value"], "_id", hot_keys(known, ["field", "value"])).select(F.col("_id").alias(id_col), "field", "ref_id")
