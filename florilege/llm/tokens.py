"""Encoding of a corpus with a byte-level BPE vocabulary through a transducer of its frequent words."""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from florilege.llm.lexicon import Lexicon, build, load_ranks, merge, pack
from florilege.session import most_frequent, put_file, shared_path, written

#: Fixed value: how a text is cut into pieces before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Characters that a worker handles at a time (one text at least).
_CHARS = 1_500_000
#: Pieces that a worker remembers before it starts anew.
_REMEMBER = 300_000


def vocabulary(name: str = "byte_bpe_50k.tiktoken") -> str:
    """Path of an installed public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _portions(texts: list[str | None], chars: int = _CHARS) -> Iterator[tuple[int, int]]:
    start = size = 0
    for i, t in enumerate(texts):
        size += len(t or "")
        if size >= chars:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def word_counts(df: DataFrame, text_col: str, max_bytes: int) -> DataFrame:
    """(piece, n) over all texts; each task sums up before the shuffle, in bounded memory. Longer pieces are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        find = regex.compile(PATTERN).findall
        counts: Counter[str] = Counter()

        def out() -> pa.RecordBatch:
            kept = [(p, n) for p, n in counts.items() if len(p) <= max_bytes]
            return pa.RecordBatch.from_arrays([pa.array([p for p, _ in kept], pa.string()), pa.array([n for _, n in kept], pa.int64())], ["piece", "n"])

        for b in batches:
            for t in b.column(0).to_pylist():
                counts.update(find(t))
                if len(counts) > _REMEMBER:
                    yield out()
                    counts.clear()
        yield out()

    parts = df.select(text_col).where(F.col(text_col).isNotNull()).mapInArrow(run, "piece string, n bigint")
    return parts.groupBy("piece").agg(F.sum("n").alias("n"))


def _store(spark: SparkSession, data: bytes) -> str:
    """Puts ``data`` into the shared folder and has it sent to every executor; gives the file's name."""
    name = f"lexicon-{uuid.uuid4().hex}.bin"
    uri = f"{shared_path(spark, 'lexicon')}/{name}"
    put_file(spark, uri, data)
    spark.sparkContext.addFile(uri)
    return name


def make_lexicon(df: DataFrame, text_col: str, vocab_path: str, max_words: int = 40_000, max_bytes: int = 48) -> str:
    """Compiles the ``max_words`` most frequent pieces of the corpus (at most ``max_bytes`` bytes each; both bound what
    the driver gets, neither changes a result) into a transducer file on every executor."""
    counts = written(word_counts(df, text_col, max_bytes).where("n > 1"), "words")
    ranks = load_ranks(vocab_path)
    words = sorted(w for p in most_frequent(counts, "piece", max_words) if 0 < len(w := p.encode()) <= max_bytes)
    return _store(df.sparkSession, pack(build(words, [merge(w, ranks) for w in words])))


class _Encoder:
    def __init__(self, lexicon_path: str, vocab_path: str):
        import regex

        self.find = regex.compile(PATTERN).findall
        self.lexicon, self.vocab_path = Lexicon(lexicon_path), vocab_path
        self.forget()

    def forget(self) -> None:
        self.code: dict[str, int] = {}
        self.sizes: list[int] = []
        self.found: list[np.ndarray] = []

    def learn(self, pieces: list[str]) -> None:
        raw = [p.encode() for p in pieces]
        for piece, b, number in zip(pieces, raw, self.lexicon.find(raw)):
            ids = self.lexicon.output(int(number)) if number >= 0 else np.array(merge(b, load_ranks(self.vocab_path)), np.int64)
            self.code[piece] = len(self.found)
            self.found.append(ids)
            self.sizes.append(len(ids))

    def encode(self, texts: list[str | None], with_ids: bool) -> tuple[np.ndarray, np.ndarray | None]:
        """Number of ids of each text, and all ids end to end."""
        if len(self.code) > _REMEMBER:
            self.forget()
        pieces: list[str] = []
        per_text = np.zeros(len(texts), np.int64)
        for i, t in enumerate(texts):
            if t:
                now = self.find(t)
                per_text[i] = len(now)
                pieces += now
        self.learn([p for p in dict.fromkeys(pieces) if p not in self.code])
        codes = np.fromiter(map(self.code.__getitem__, pieces), np.int64, len(pieces))
        sizes = np.array(self.sizes, np.int64)
        each = sizes[codes] if len(codes) else np.zeros(0, np.int64)
        ends = np.concatenate(([0], np.cumsum(each)))
        text_ends = np.cumsum(per_text)
        counts = np.diff(np.concatenate(([0], ends[text_ends])))
        if not with_ids:
            return counts, None
        table = np.concatenate(self.found) if self.found else np.zeros(0, np.int64)
        base = np.concatenate(([0], np.cumsum(sizes)[:-1])) if len(sizes) else np.zeros(1, np.int64)
        at = np.repeat(base[codes] - ends[:-1], each) + np.arange(ends[-1]) if len(codes) else np.zeros(0, np.int64)
        return counts, table[at].astype(np.int32)


def encode(df: DataFrame, id_col: str, text_col: str, vocab_path: str, lexicon: str | None = None, only_count: bool = False) -> DataFrame:
    """(id, ids) of every row, or (id, n_tokens) with ``only_count``.

    Null and empty texts give an empty list (0). Special tokens don't exist here: their strings are ordinary text.
    Texts of any length are read whole. Repeated rows give repeated rows, null ids are kept, other columns are ignored.
    """
    name = lexicon or make_lexicon(df, text_col, vocab_path)
    src = df.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _Encoder(SparkFiles.get(name), vocab_path)
        for b in batches:
            texts = b.column(1).to_pylist()
            for start, end in _portions(texts):
                counts, ids = enc.encode(texts[start:end], not only_count)
                key = b.column(0).slice(start, end - start)
                if only_count:
                    yield pa.RecordBatch.from_arrays([key, pa.array(counts, pa.int64())], [id_col, "n_tokens"])
                else:
                    offsets = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
                    yield pa.RecordBatch.from_arrays([key, pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids, pa.int32()))], [id_col, "ids"])

    return src.mapInArrow(run, f"{id_col} bigint, " + ("n_tokens bigint" if only_count else "ids array<int>"))


def decode(df: DataFrame, id_col: str, ids_col: str, vocab_path: str) -> DataFrame:
    """(id, text): what ``encode`` was given, but for null texts, which come back empty. Null lists give an empty text; an id that the
    vocabulary doesn't have is an error; bytes that aren't UTF-8 (cut lists) come out as replacement characters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = {i: p for p, i in load_ranks(vocab_path).items()}
        for b in batches:
            texts = [b"".join(map(pieces.__getitem__, ids or ())).decode("utf-8", "replace") for ids in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], [id_col, "text"])

    return df.select(F.col(id_col).cast("long"), F.col(ids_col)).mapInArrow(run, f"{id_col} bigint, text string")
