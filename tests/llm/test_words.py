import random
import re

import numpy as np

from paneltide.llm.words import hash_words, shingles


def test_hashes_equal_exactly_where_words_are_equal():
    rnd = random.Random(4)
    alphabet = "abAB é_1日, .\n!ßÇç"
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 300))) for _ in range(200)] + [None, ""]
    w = hash_words(texts)
    named = {}
    for i, t in enumerate(texts):
        found = [(m[0].lower(), m.start(), m.end()) for m in re.finditer(r"\w+", t or "")]
        lo, hi = w.first[i], w.first[i + 1]
        assert [(s, e) for _, s, e in found] == list(zip(w.start[lo:hi].tolist(), w.end[lo:hi].tolist(), strict=True))
        for (word, _, _), h in zip(found, w.hashes[lo:hi].tolist(), strict=True):
            assert named.setdefault(word, h) == h
    assert len(set(named.values())) == len(named) > 300


def test_shingles_are_of_the_sequence():
    w = hash_words(["a b c a b c x", "b a c"])
    s = shingles(w.hashes[:7], 3)
    assert s[0] == s[3] and len(set(s.tolist())) == 4
    assert shingles(w.hashes[7:], 3)[0] not in s
    assert len(shingles(w.hashes[:2], 3)) == 0 and len(np.unique(w.hashes)) == 4
