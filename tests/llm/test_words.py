from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from cellar.llm.words import ALNUM, LOWER, Words, slices
from tests.llm.helpers import WORD

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="aB9 \n\t\u00a0é漢😀|-\x00", max_size=40)), max_size=8)


@settings(max_examples=60, deadline=None)
@given(TEXTS, st.integers(1, 60))
def test_words_are_those_of_the_pattern(texts, size):
    got = []
    for i, j, offsets, data in slices(pa.array(texts, pa.string()), size):
        w = Words(offsets, data)
        for d in range(j - i):
            got.append([data[w.starts[k] : w.ends[k]].tobytes().decode() for k in range(w.first[d], w.first[d + 1])])
    assert got == [WORD.findall(t or "") for t in texts]


@settings(max_examples=60, deadline=None)
@given(TEXTS)
def test_lower_case_words(texts):
    got = []
    for i, j, offsets, data in slices(pa.array(texts, pa.string())):
        low = LOWER[data]
        w = Words(offsets, low, ALNUM)
        got += [[low[w.starts[k] : w.ends[k]].tobytes().decode() for k in range(w.first[d], w.first[d + 1])] for d in range(j - i)]
    assert got == [re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) for t in texts]


@settings(max_examples=60, deadline=None)
@given(TEXTS, st.integers(1, 4))
def test_equal_ngrams_have_equal_hashes(texts, k):
    seen: dict[int, tuple] = {}
    for size in (7, 1 << 20):  # whatever slice a text falls in
        for i, j, offsets, data in slices(pa.array(texts, pa.string()), size):
            w = Words(offsets, data)
            at, g = w.ngrams(w.hashes(), k)
            found = [[] for _ in range(j - i)]
            for a, x in zip(at.tolist(), g.tolist()):
                found[w.doc[a]].append(x)
            for d in range(j - i):
                words = WORD.findall(texts[i + d] or "")
                grams = [tuple(words[p : p + k]) for p in range(len(words) - k + 1)]
                assert len(found[d]) == len(grams)
                for x, gram in zip(found[d], grams):
                    assert seen.setdefault(x, gram) == gram
    assert len(set(seen.values())) == len(seen)


def test_sliced_arrays_are_read_from_their_offset():
    a = pa.array(["aa bb", None, "cc dd ee", "f"]).slice(1, 2)
    (i, j, offsets, data), = slices(a)
    w = Words(offsets, data)
    assert (i, j) == (0, 2) and w.n.tolist() == [0, 3] and np.all(np.diff(offsets) == [0, 8])
