import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from bucketlens.llm.tokens import CHUNK_BYTES, words

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="abAB éÉ\u2028\u0085\t\n\x1f.", max_size=40)), max_size=6))
def test_keys_stand_for_words(texts):
    own = words(texts)
    flat = [w for t in texts for w in plain(t)]
    assert len(own.keys) == len(flat)
    assert [len(own.of(i)) for i in range(len(texts))] == [len(plain(t)) for t in texts]
    by_word = {}
    for w, k in zip(flat, own.keys.tolist()):
        assert by_word.setdefault(w, k) == k
    assert len(set(by_word.values())) == len(by_word)


def test_chunks_do_not_change_keys():
    text = "word " * (CHUNK_BYTES // 4) + "y" * (CHUNK_BYTES + 10) + " Word"
    keys = words([text, "word"]).keys
    assert len(keys) == CHUNK_BYTES // 4 + 3
    assert len(np.unique(keys)) == 2 and keys[0] == keys[-1] == keys[-2]
