"""One value against many: the exact law at any size."""

import pandas as pd
import pytest

from reviewmill.functions import special


def test_one_value_against_many():
    one = special.mann_whitney_pvalue.func
    m = 1_000_001
    got = one(*(pd.Series([float(x)] * 1) for x in (m, 1, m, 0)))
    assert got[0] == pytest.approx(2 / (m + 1))
    for u in range(8):
        small = one(*(pd.Series([float(x)]) for x in (u, 7, 1, 0)))
        assert small[0] == pytest.approx(min(1.0, 2 * special.mann_whitney_exact(max(u, 7 - u), 1, 7)))
