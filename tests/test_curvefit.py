"""Decay fits: no join of a patient's sums to its rows, and long patients that pad no others."""

import numpy as np
import pandas as pd

from genoframe.plans import curvefit as cf


def curve(pid, n):
    t = np.linspace(0, 60, n)
    return pd.DataFrame({"pid": pid, "_t": t, "_y": cf._model(t, 20.0 + pid % 40, 3.0), "_d500": np.nan, "_dx0": np.nan})


def test_a_long_patient_pads_no_others(monkeypatch):
    pdf = pd.concat([curve(7, 20_000), *[curve(100 + i, 8) for i in range(40)]], ignore_index=True)
    shapes, plain = [], cf.fit_batch
    monkeypatch.setattr(cf, "fit_batch", lambda ids, t, *a: shapes.append(t.shape) or plain(ids, t, *a))
    got = pd.concat(cf._fit_rows(pdf, "pid")).set_index("pid")
    assert len(got) == 41 and len(shapes) > 1 and all(p * n <= cf.CELLS or p == 1 for p, n in shapes)
    assert np.allclose(got["D50"], 20 + got.index % 40) and np.allclose(got["Dx"], 3)


def test_no_join_back(spark):
    rows = [(p, float(t), 48 / (1 + np.exp((t - 30.0 - p) / 4))) for p in range(30) for t in range(0, 60, 2 if p % 3 else 25)] + [(99, 1.0, 40.0), (None, 1.0, 3.0)]
    out = cf.fit_d50(spark.createDataFrame([(p, t, float(y)) for p, t, y in rows], "pid long, t double, total double"))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") <= 2 and "Join" not in plan
    got = {r.pid: r for r in out.collect()}
    inside = pd.Series([p for p, _, y in rows if p is not None and 1 <= y <= 48]).value_counts()
    assert set(got) == set(inside[inside >= 3].index) and 20 < len(got) < 30 and all(abs(r.D50 - 30 - p) < 1e-4 and abs(r.Dx - 4) < 1e-4 for p, r in got.items())
