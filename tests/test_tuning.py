"""Guided search: better as it goes, halved folds, every drawn value in effect."""

import numpy as np
import pytest

from wardline.operators import tuning


def seeded(kind, trials):
    draw = np.random.default_rng(5)
    return {t: {n: tuning._from_unit(how, low, high, draw.random()) for n, how, low, high in tuning.SPACES[kind]} for t in range(trials)}


@pytest.mark.parametrize("kind", sorted(tuning.SPACES))
def test_last_trials_beat_the_first(kind):
    """A smooth score with its top inside the space; 40 trials, three folds of slightly differing level."""
    def score(drawn, fold):
        units = [tuning._to_unit(how, low, high, drawn[n]) for n, how, low, high in tuning.SPACES[kind]]
        return 1 - sum((u - 0.7) ** 2 for u in units) + 0.01 * fold

    calls = []
    found = tuning.search(kind, seeded(kind, 40), 40, 3, lambda d, f: calls.append(f) or score(d, f))
    assert [r["trial"] for r in found] == list(range(40))
    first, last = (np.median([r["score"] for r in part]) for part in (found[:10], found[-10:]))
    assert last > first + 0.05
    assert len(calls) == sum(r["folds"] for r in found) < 3 * 40  # some trials were not given all folds
    again = tuning.search(kind, seeded(kind, 40), 40, 3, score)
    assert [r["drawn"] for r in again] == [r["drawn"] for r in found]
    for r in found:
        for name, how, low, high in tuning.SPACES[kind]:
            assert low <= r["drawn"][name] <= high and (how != "int" or r["drawn"][name] == int(r["drawn"][name]))


def test_time_out_is_reported():
    with pytest.warns(UserWarning, match="ended after"):
        assert tuning.search("random_forest", seeded("random_forest", 8), 8, 3, lambda d, f: 0.5, max_seconds=-1) == []


def test_every_drawn_value_changes_the_parameters():
    for kind, space in tuning.SPACES.items():
        base = {n: tuning._from_unit(how, low, high, 0.5) for n, how, low, high in space}
        for name, how, low, high in space:
            moved = [tuning.to_params(kind, {**base, name: tuning._from_unit(how, low, high, u)}) for u in (0.0, 1.0)]
            assert moved[0] != moved[1], (kind, name)
