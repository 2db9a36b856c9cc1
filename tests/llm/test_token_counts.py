"""Edit-aware counts against encoding the edited text as a whole."""

import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from offerloom.llm.packing import default_vocabulary
from offerloom.llm.token_counts import Counter, TokenTree, count_tokens

COUNTER = Counter(default_vocabulary())
TEXT = st.text(alphabet="ab 1'sé\n\t.!lre", max_size=400)
EDIT = st.tuples(st.integers(-3, 420), st.integers(0, 60), st.text(alphabet="ab 1's\n.", max_size=30))


@settings(max_examples=300, deadline=None)
@given(TEXT, st.lists(EDIT, max_size=5))
def test_tree_equals_a_new_cut(text, edits):
    tree = TokenTree(text, COUNTER)
    for start, remove, insert in edits:
        a = min(max(start, 0), len(text))
        text = text[:a] + insert + text[min(a + remove, len(text)) :]
        tree.edit(start, remove, insert)
        assert [p for block in tree.pieces for p in block] == COUNTER.cut(text)
        assert tree.total == len(COUNTER.encode(text)) and tree.length == len(text)


def test_an_edit_encodes_its_surroundings_only():
    tree = TokenTree("word " * 20_000, COUNTER)
    before = tree.encoded
    tree.edit(50_001, 3, "xyz")
    assert tree.encoded - before < 20


def test_counts_nulls_and_repeats(spark):
    schema = "doc_id long, text string, edits array<struct<start:long,remove:long,insert:string>>, n_tokens string"
    rows = [
        (1, "Some text here.", [(0, 4, "Any"), (10**9, 0, " End")], "x"),
        (1, "Some text here.", [(0, 4, "Any"), (10**9, 0, " End")], "x"),
        (2, None, [(0, 5, "new"), None, (None, None, None)], "x"),
        (None, "", None, None),
    ]
    got = sorted(map(tuple, count_tokens(spark.createDataFrame(rows, schema)).collect()), key=repr)
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    size = lambda t: len(tokenizer.encode(t, add_special_tokens=False).ids)
    for r in got:
        if r[0] == 1:
            assert r[1:4] == (size("Some text here."), size("Any text here. End"), 18)
    assert [r[1:4] for r in got if r[0] == 2] == [(0, size("new"), 3)]
    assert [r[1:] for r in got if r[0] is None] == [(0, 0, 0, 0, 0)]
    assert len(got) == 4
    assert count_tokens(spark.createDataFrame([], schema)).count() == 0
