"""Arrays of a worker stay small however long the texts of a batch are together."""

import tracemalloc

import numpy as np
import pytest
from pulsegrid.llm import pieces, quality


@pytest.fixture
def model():
    rng = np.random.default_rng(1)
    return quality.QualityModel(rng.normal(size=(quality.STEMS, quality.DIM)).astype(np.float32), rng.normal(size=(2 * quality.SHAPES, quality.DIM)).astype(np.float32), None)


def test_pooling_takes_tens_of_megabytes_and_changes_nothing(model):
    texts = [" ".join(f"w{(i * j) % 97}" for j in range(i % 500)) for i in range(2000)] + ["", " ", "x " * 200_000]
    want = np.concatenate([model._pooled([t]) for t in texts])
    tracemalloc.start()
    got = model.pooled(texts[:-1])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sum(map(len, texts[:-1])) > 1_500_000 and peak < 30_000_000
    assert np.array_equal(got, want[:-1]) and np.array_equal(model.pooled(texts), want)
    assert model.pooled([]).shape == (0, 2 * quality.DIM + 1)


def test_context_sums_do_not_depend_on_the_step(monkeypatch):
    texts = [" ".join(f"w{(i * j) % 53}" for j in range(i)) for i in range(120)]
    whole = quality.context_sums(texts)
    monkeypatch.setattr(quality, "WORDS_PER_STEP", 7)
    assert all(np.array_equal(a, b) for a, b in zip(whole, quality.context_sums(texts), strict=True))


def test_a_word_is_solved_once_when_it_is_looked_up():
    asked = []
    words = pieces.PackedWords(lambda w: asked.append(w) or [len(w)])
    assert [words["ab"], words["ab"], words["abc"]] == [np.array([n], "<u4").tobytes() for n in (2, 2, 3)]
    assert asked == ["ab", "abc"]
