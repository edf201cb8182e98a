import json

from hypothesis import given, settings
from hypothesis import strategies as st

from florilege.operators.nested import SECTION_STEPS, _valid_deep, flatten_array, flatten_json, is_json, nested_paths


def brute(text):
    out = []

    def walk(array, letter, parent):
        for i, o in enumerate(array if isinstance(array, list) else []):
            if isinstance(o, dict):
                path = f"{parent}.{letter}{i}" if parent else f"{letter}{i}"
                out.append((path, parent))
                for (own, key), to in SECTION_STEPS.items():
                    if own == letter and key in o:
                        walk(o[key], to, path)

    walk(json.loads(text), "s", "")
    return sorted(out)


leaf = st.none() | st.booleans() | st.integers() | st.text(alphabet='ab"\\[]{},:é\n', max_size=6)
tree = st.recursive(leaf, lambda c: st.lists(c, max_size=4) | st.dictionaries(st.sampled_from(["sections", "blocks", "annotations", "turns", "text"]), c, max_size=4), max_leaves=30)


@given(st.lists(tree, min_size=1, max_size=5), st.sampled_from([None, 1]), st.booleans())
@settings(max_examples=300, deadline=None)
def test_index_agrees_with_a_walk(values, indent, ascii_only):
    texts = [json.dumps(v, indent=indent, ensure_ascii=ascii_only) for v in values]
    t, p, q = nested_paths(texts, SECTION_STEPS, "s")
    assert sorted(zip(t, p, q)) == sorted((i, *x) for i, text in enumerate(texts) for x in brute(text))
    assert all(map(_valid_deep, texts))


@given(st.text(alphabet='[]{},:"\\atrue1.e-n ull', max_size=14))
@settings(max_examples=500, deadline=None)
def test_grammar(text):
    assert _valid_deep(text) == is_json(text)


def test_deep_and_broken():
    deep = "[" + '{"sections":[' * 3000 + "]}" * 3000 + "]"
    assert is_json(deep) and len(nested_paths([deep], SECTION_STEPS, "s")[0]) == 3000
    assert not is_json(deep[:-1]) and not is_json("[NaN]") and not is_json("") and nested_paths([], SECTION_STEPS, "s") == ([], [], [])


def test_frames(spark, rows):
    df = spark.createDataFrame([(1, '[{"blocks":[null,{"turns":[{}]}]}]', 5), (1, '[{"blocks":[null,{"turns":[{}]}]}]', 6), (2, None, 1), (3, "", 1), (4, '[{"a":', 1), (None, "[{}]", 1), (5, "null", 1)], "root_id bigint, j string, node_path int")
    want = [(1, "s0", ""), (1, "s0.b1", "s0"), (1, "s0.b1.t0", "s0.b1")]
    assert rows(flatten_json(df, "root_id", "j", SECTION_STEPS, "s")) == want
    assert flatten_json(df.limit(0), "root_id", "j", SECTION_STEPS, "s").count() == 0
    arr = spark.createDataFrame([(1, [None, ("x",)], 1), (2, [], 1), (3, None, 1)], "id bigint, a array<struct<k:string>>, pos int")
    assert rows(flatten_array(arr, "id", "a", "a")) == [(1, "a1", "")]
