import base64
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from florilege.llm.lexicon import Lexicon, build, load_ranks, merge, pack
from florilege.llm.packing import pack_items, shortest_pack_first
from florilege.llm.tokens import PATTERN, decode, encode, vocabulary


@pytest.fixture(scope="module")
def exact():
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(vocabulary(), "rb"))}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


@given(st.text(max_size=30))
@settings(max_examples=300, deadline=None)
def test_merge_of_any_piece(text):
    import regex

    ranks = load_ranks(vocabulary())
    vocab = {v: k for k, v in ranks.items()}
    for piece in regex.findall(PATTERN, text):
        assert b"".join(vocab[i] for i in merge(piece.encode(), ranks)) == piece.encode()


def test_lexicon(tmp_path):
    r = random.Random(1)
    words = sorted({bytes(r.choice(b"abc") for _ in range(r.randrange(1, 7))) for _ in range(400)} | {" été".encode()})
    ids = [[i, i + 1][: 1 + i % 2] for i in range(len(words))]
    made = build(words, ids)
    assert len(made["final"]) < sum(map(len, words)) / 2  # suffixes are shared
    (tmp_path / "x").write_bytes(pack(made))
    lex = Lexicon(str(tmp_path / "x"))
    assert [lex.output(n).tolist() for n in lex.find(words)] == ids
    assert set(lex.find([b"abcabcabc", b"", b"zz", words[3] + b"z"]).tolist()) == {-1}
    (tmp_path / "y").write_bytes(pack(build([], [])))
    assert Lexicon(str(tmp_path / "y")).find([b"a"]).tolist() == [-1]


TEXTS = [None, "", " ", "Hello world, it's <|endoftext|>!", "été 東京 \U0001f600 ‍ x", "a\n\n  b\t", "z" * 30_000, "ab " * 20_000, "Hello world"]


def test_encode(spark, exact):
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(TEXTS)] + [(None, "x", 1), (1, "", 1)], "doc_id bigint, text string, _t int")
    for only in (False, True):
        got = [tuple(r) for r in encode(df, "doc_id", "text", vocabulary(), only_count=only).collect()]
        want = [(i, exact(t or "")) for i, t in enumerate(TEXTS)] + [(None, exact("x")), (1, [])]
        assert sorted(got, key=repr) == sorted([(i, len(x) if only else x) for i, x in want], key=repr)
    assert encode(df.limit(0), "doc_id", "text", vocabulary()).count() == 0
    back = decode(encode(df, "doc_id", "text", vocabulary()), "doc_id", "ids", vocabulary())
    assert sorted((tuple(r) for r in back.collect()), key=repr) == sorted([(i, t or "") for i, t in enumerate(TEXTS)] + [(None, "x"), (1, "")], key=repr)
    cut = spark.createDataFrame([(1, None), (2, [])], "doc_id bigint, ids array<int>")
    assert [r[1] for r in decode(cut, "doc_id", "ids", vocabulary()).collect()] == ["", ""]


@given(st.dictionaries(st.integers(1, 50), st.integers(1, 30), max_size=20))
@settings(max_examples=200, deadline=None)
def test_patterns_hold_all_items(histogram):
    seen = {}
    for count, lengths in shortest_pack_first(dict(histogram), 50):
        assert sum(lengths) <= 50
        for n in lengths:
            seen[n] = seen.get(n, 0) + count
    assert seen == histogram


def test_pack(spark):
    r = random.Random(2)
    data = [(i, r.choice([0, 3, 3, 3, 40, 99, 100, 101, 250, r.randrange(1, 300)])) for i in range(700)] + [(900, None), (5, 7)]
    df = spark.createDataFrame(data, "doc_id bigint, n bigint")
    got = pack_items(df, "doc_id", "n", [(1, 100), (2, 1000), (3, None), (None, 5), (4, 0)]).collect()
    for cap_id, cap in ((1, 100), (2, 1000)):
        mine = [x for x in got if x["capacity_id"] == cap_id]
        assert len(mine) == sum(max(1, -(-(n or 0) // cap)) for _, n in data)
        assert sum(x["n_tokens"] for x in mine) == sum(n or 0 for _, n in data)
        room = {}
        for x in sorted((x for x in mine if x["n_tokens"]), key=lambda x: (x["container_id"], x["start"])):
            assert x["start"] >= room.get(x["container_id"], 0)
            room[x["container_id"]] = x["start"] + x["n_tokens"]
        assert max(room.values()) <= cap and sorted(room) == list(range(len(room)))
        assert len(room) <= 1.15 * sum(n or 0 for _, n in data) / cap + 1
    assert {x["capacity_id"] for x in got} == {1, 2} and pack_items(df.limit(0), "doc_id", "n", [(1, 9)]).count() == 0 and pack_items(df, "doc_id", "n", []).count() == 0


def test_every_capacity_is_filled(spark, tmp_path, monkeypatch):
    from florilege.llm import queries

    spark.createDataFrame([(1, "a word")], "doc_id bigint, text string").write.parquet(str(tmp_path / "documents.parquet"))
    spark.range(1, 1202).selectExpr("id as capacity_id", "id + 10 as capacity_tokens").write.parquet(str(tmp_path / "pack_capacity.parquet"))
    monkeypatch.setattr(queries, "pack_items", lambda sizes, id_col, size_col, capacities: capacities)
    assert sorted(queries.p9_containers(spark, str(tmp_path))) == [(i, i + 10) for i in range(1, 1202)]
