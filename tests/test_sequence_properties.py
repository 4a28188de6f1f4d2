"""Property tests for the ordering core: for random key skew, chunk sizes and halos, chunked
windows and prefix sums must equal a plain per-key computation in pandas."""

from __future__ import annotations

import numpy as np
import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from barspark.operators import sequence as Q


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    sizes=st.lists(st.integers(min_value=1, max_value=120), min_size=1, max_size=4),
    chunk_rows=st.integers(min_value=3, max_value=50),
    back=st.integers(min_value=0, max_value=6),
    fwd=st.integers(min_value=0, max_value=6),
    seed=st.integers(min_value=0, max_value=10_000),
)
def test_chunked_lag_lead_and_prefix_equal_pandas(spark, sizes, chunk_rows, back, fwd, seed):
    rng = np.random.default_rng(seed)
    parts = []
    for i, n in enumerate(sizes):
        parts.append(pd.DataFrame({"k": f"K{i}", "t": np.sort(rng.choice(10_000, size=n, replace=False)), "v": rng.integers(0, 9, n)}))
    pdf = pd.concat(parts).sample(frac=1, random_state=seed).reset_index(drop=True)
    df = spark.createDataFrame(pdf, "k string, t long, v long")

    rows = Q.frame(df, ["k"], ["t"], back=back, fwd=fwd, chunk_rows=chunk_rows)
    w = Q.chunk_window(["k"], ["t"])
    rows = rows.withColumns(
        {
            "lag_v": F.lag("v", back).over(w) if back else F.lit(None).cast("long"),
            "lead_v": F.lead("v", fwd).over(w) if fwd else F.lit(None).cast("long"),
            "pos": Q.position(["k"], ["t"]),
        }
    )
    summed = Q.prefix_sum(rows, ["k"], F.col("v"), "cum", ["t"])
    got = Q.core_only(summed).select("k", "t", "lag_v", "lead_v", "pos", "cum").toPandas()
    got = got.sort_values(["k", "t"]).reset_index(drop=True)

    want = pdf.sort_values(["k", "t"]).reset_index(drop=True)
    g = want.groupby("k")["v"]
    want["lag_v"] = g.shift(back) if back else np.nan
    want["lead_v"] = g.shift(-fwd) if fwd else np.nan
    want["pos"] = want.groupby("k").cumcount()
    want["cum"] = g.cumsum()
    assert len(got) == len(want)
    for c in ("lag_v", "lead_v"):
        assert got[c].astype("float").fillna(-1).tolist() == want[c].astype("float").fillna(-1).tolist(), c
    assert got["pos"].tolist() == want["pos"].tolist()
    assert got["cum"].tolist() == want["cum"].tolist()
