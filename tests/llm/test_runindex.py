import random

import numpy as np
import pytest

from plumbline.llm.runindex import repeated_places


@pytest.mark.parametrize("seed", range(12))
def test_against_brute_force(seed):
    rng = random.Random(seed)
    match = rng.choice([3, 5, 8, 11, 20])
    base = bytes(rng.choice(b"ab\x00\xff") for _ in range(40))
    strings, owner = [], []
    for _ in range(rng.randrange(1, 40)):
        s = bytearray(base[rng.randrange(20) : rng.randrange(20, 41)])
        for _ in range(rng.randrange(3)):
            if s:
                s[rng.randrange(len(s))] = rng.choice(b"abc")
        strings.append(bytes(s) + bytes(rng.choice(b"ab") for _ in range(rng.randrange(12))))
        owner.append(rng.randrange(15))
    want = {
        (i, p)
        for i, s in enumerate(strings)
        for p in range(len(s) - match + 1)
        if any(o < owner[i] and s[p : p + match] in t for t, o in zip(strings, owner))
    }
    s, t = repeated_places(strings, np.array(owner), match)
    assert {*zip(s.tolist(), t.tolist())} == want


def test_empty():
    assert len(repeated_places([], np.zeros(0, np.int64), 5)[0]) == 0
    assert len(repeated_places([b"", b"a"], np.array([1, 2]), 5)[0]) == 0
