import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from sparkscan.llm import bpe
from sparkscan.llm.byte_ids import byte_vocabulary

from .cases import documents, texts

FILES = ["word_bpe_49k.json", "byte_bpe_50k.json"]
PATHS = {f: public_tokenizers.path(f) for f in FILES}
LIBRARY = {f: Tokenizer.from_file(PATHS[f]) for f in FILES}
BITS = st.sampled_from(["<|endoftext|>", "<|startoftext|>", "'s", "'LL", " ", "\n", "é", "é", "ς", "中", "1", "ab", "the", "tion", "\x1c", "\xa0"])
TEXT = st.lists(st.one_of(BITS, st.text(max_size=6)), max_size=30).map("".join).map(lambda t: t.encode("utf-8", "ignore").decode())


def ids_of(file, text):
    return LIBRARY[file].encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("file", FILES)
@settings(max_examples=150, deadline=None)
@given(text=TEXT)
def test_equals_library(file, text):
    own = bpe.vocabulary(PATHS[file])
    ids = own.encode([text])[0]
    assert np.frombuffer(ids, "<u4").tolist() == ids_of(file, text)
    assert own.decode(ids) == LIBRARY[file].decode(ids_of(file, text), skip_special_tokens=False)


@settings(max_examples=100, deadline=None)
@given(text=TEXT)
def test_compiled_encoder_equals_library(text):
    ids = byte_vocabulary(PATHS[FILES[1]]).encode([text])[0]
    assert np.frombuffer(ids, "<u4").tolist() == ids_of(FILES[1], text)


@pytest.mark.parametrize("word", ["ab" * 3000, "a" * 999, "é" * 700, "thethethe" * 50])
@pytest.mark.parametrize("file", FILES)
def test_long_words(file, word):
    assert np.frombuffer(bpe.vocabulary(PATHS[file]).encode([word])[0], "<u4").tolist() == ids_of(file, word)


def test_proposals_are_verified():
    own = bpe.vocabulary(PATHS[FILES[0]])
    words = [w for w in " ".join(t or "" for _, t in texts()).lower().split() if w.isalpha() and w.isascii()]
    differ = 0
    for word in set(words):
        exact = own.merged(word.encode())
        proposed = own.propose(word.encode())
        pairs = np.array([proposed[:-1], proposed[1:]])
        assert (own.compatible(pairs[0], pairs[1]).all() and own.reachable[proposed].all()) == (proposed == exact)
        differ += proposed != exact
    assert differ


def test_operator(spark):
    rows = [(i, t) for i, t in texts()]
    out = bpe.encode(documents(spark), PATHS[FILES[0]], decoded=True)
    assert out.columns == ["doc_id", "n_tokens", "ids", "decoded"]
    want = sorted((str(i), ids_of(FILES[0], t or ""), LIBRARY[FILES[0]].decode(ids_of(FILES[0], t or ""), skip_special_tokens=False)) for i, t in rows)
    got = sorted((str(r.doc_id), np.frombuffer(r.ids, "<u4").tolist(), r.decoded) for r in out.collect())
    assert got == want
    assert all(r.n_tokens * 4 == len(r.ids) for r in out.collect())
    again = bpe.decode(out, PATHS[FILES[0]])
    assert sorted((str(r.doc_id), r.decoded) for r in again.collect()) == [(i, d) for i, _, d in want]
    assert bpe.encode(documents(spark, []), PATHS[FILES[0]]).collect() == []
