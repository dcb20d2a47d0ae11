"""The effect of a run of requests, against replaying the run."""

from __future__ import annotations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import folds
from tradelake.operators.admission import FULL, _Pieces, effect_of, replay

times = st.lists(st.integers(0, 300), max_size=60).map(sorted)
runs = st.lists(st.integers(0, 300), min_size=1, max_size=80).map(sorted)


@pytest.mark.parametrize("look_every", [1, 3, 128])
@settings(max_examples=200, deadline=None)
@given(before=times, run=runs, cut=st.integers(1, 79), capacity=st.integers(1, 6),
       step=st.integers(1, 40))
def test_effect_chains_like_a_replay(look_every, before, run, cut, capacity, step):
    _Pieces.LOOK_EVERY = look_every
    *_, value = replay([capacity * t for t in before], FULL, step, capacity)
    first = before[-1] if before else 0
    scaled = np.array([capacity * (first + t) for t in run])
    whole = effect_of(scaled, step, capacity, FULL)
    parts = [part for part in (scaled[:cut], scaled[cut:]) if len(part)]
    effects = [effect_of(part, step, capacity, FULL) for part in parts]
    chained = effects[0].then(effects[1]) if len(effects) > 1 else effects[0]
    for start in (FULL, value, max(FULL, value - 1), max(FULL, value - step // 2)):
        *_, after = replay(scaled.tolist(), start, step, capacity)
        assert whole.of(start) == chained.of(start) == after


@settings(max_examples=300, deadline=None)
@given(times, st.integers(1, 6), st.integers(1, 40))
def test_replay_is_a_token_bucket(run, capacity, window):
    passed, *_ = replay([capacity * t for t in run], FULL, window, capacity)
    flags = [i in set(passed) for i in range(len(run))]
    assert flags == folds.bucket(run, capacity, window)


@pytest.mark.parametrize("gap", [1, 3, 20, 40, 100])
def test_effect_stays_small_and_right_at_any_load(gap):
    _Pieces.LOOK_EVERY = 128
    run = np.random.default_rng(gap).integers(0, 2 * gap, 20_000).cumsum() * 500
    effect = effect_of(run, 10_000, 500, FULL)
    assert len(effect.low) < 4 * 500
    for start in (FULL, int(run[0]), int(run[0]) + 10_000, int(run[0]) - 1_234_567):
        *_, after = replay(run.tolist(), start, 10_000, 500)
        assert effect.of(start) == after
