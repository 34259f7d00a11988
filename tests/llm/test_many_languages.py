"""More languages than a signed byte counts."""

import numpy as np
import pytest

from delaylens.llm import langid


@pytest.mark.parametrize("count", [129, 200, 300])
def test_viterbi_with_many_labels(count):
    rng = np.random.default_rng(count)
    lengths = np.array([3, 1, 5, 2])
    scores = rng.normal(size=(lengths.sum(), count)) - 60.0
    want = rng.integers(count - 3, count, len(lengths)).repeat(lengths)
    scores[np.arange(len(scores)), want] += 50.0
    assert langid.viterbi(scores, lengths, 4.0).tolist() == want.tolist()
    # a switch inside a document
    scores = np.full((4, count), -60.0)
    scores[:2, 0] = scores[2:, count - 1] = 0.0
    assert langid.viterbi(scores, np.array([4]), 4.0).tolist() == [0, 0, count - 1, count - 1]
