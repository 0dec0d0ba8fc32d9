"""Words, hashes and windows of Arrow text against plain Python."""

import random

import numpy as np
import pyarrow as pa
import pytest

from estratos.llm import arrow_text as at
from estratos.llm.substrings import sliding_least


@pytest.mark.parametrize("limit", [1, 7, 1 << 20])
def test_words_are_those_of_split(limit):
    rng = random.Random(1)
    texts = [None, "", " ", "a", " a", "a "] + ["".join(rng.choice("ab \t\n\x0b\x0c\ré") for _ in range(rng.randrange(30))) for _ in range(300)]
    got = []
    for chunk in at.chunks(pa.array(texts), limit):
        found = at.words(chunk)
        spelled = [chunk.data[a:b].tobytes() for a, b in zip(found.start, found.end, strict=True)]
        got += [spelled[found.offsets[i] : found.offsets[i + 1]] for i in range(len(chunk.bounds) - 1)]
    assert got == [(t or "").encode().split() for t in texts]


def test_sliced_arrays_start_at_their_offset():
    column = pa.array(["zero", "one two", None, "three"])[1:]
    (chunk,) = at.chunks(column)
    assert chunk.data.tobytes() == b"one twothree" and chunk.bounds.tolist() == [0, 7, 7, 12]


def test_no_texts_no_chunks():
    assert list(at.chunks(pa.array([], pa.string()))) == []


def test_equal_words_have_equal_hashes_and_others_do_not():
    rng = random.Random(2)
    spelled = ["".join(rng.choice("abcdé") for _ in range(rng.randrange(1, 9))) for _ in range(4000)]
    (chunk,) = at.chunks(pa.array([" ".join(spelled[:2000]), " ".join(spelled[2000:])]))
    hashes = at.word_hashes(chunk, at.words(chunk)).tolist()
    assert len(set(zip(spelled, hashes, strict=True))) == len(set(spelled)) == len(set(hashes))


def test_windows_stay_within_documents():
    starts, own = at.windows(np.array([0, 4, 4, 6, 11]), 3)
    assert starts.tolist() == [0, 1, 6, 7, 8] and own.tolist() == [0, 2, 2, 2, 5]


def test_window_hashes_depend_on_order_and_content():
    hashes = np.array([5, 6, 7, 5, 6, 7, 6, 5, 7], dtype=np.uint64)
    got = at.window_hashes(hashes, np.array([0, 3, 6]), 3)
    assert got[0] == got[1] != got[2]


@pytest.mark.parametrize("width", [1, 2, 5, 41])
def test_sliding_least(width):
    values = np.random.default_rng(1).integers(0, 1000, 200).astype(np.uint64)
    assert sliding_least(values, width).tolist() == [int(values[i : i + width].min()) for i in range(200 - width + 1)]
