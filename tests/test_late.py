import random

from conftest import rows
from helpers import T0, frame

from eventide.operators import Count, sliding_agg
from eventide.operators.late import admit_from, late_rows, watermark_at_arrival
from eventide.plans import jobs


def _data(n=300, seed=2):
    random.seed(seed)
    # mostly ordered arrival with some rows up to 90 s late
    out, t = [], T0
    for i in range(n):
        t += random.randint(0, 4)
        late = random.randint(0, 90) if random.random() < 0.2 else 0
        out.append((f"/u{random.randint(0, 6)}", t - late, i))
    return out


def _py_wm(data, delay):
    wm, m = {}, None
    for url, t, i in sorted(data, key=lambda r: r[2]):
        wm[i] = None if m is None else (m - delay) * 1000
        m = t if m is None else max(m, t)
    return wm


def test_watermark_two_level_equals_loop(spark):
    data = _data()
    df = frame(spark, "url string, ts_s long, seq long", data)
    wm = _py_wm(data, 5)
    for block in (1 << 20, 16, 3):
        got = dict(rows(watermark_at_arrival(df, "ts", "seq", "5 seconds", block=block), "seq", "wm_ms"))
        assert got == wm, block
    late = [r[0] for r in rows(late_rows(df, "ts", "seq", "5 seconds"), "seq")]
    assert late == sorted(i for u, t, i in data if wm[i] is not None and t * 1000 < wm[i])


def test_allowed_lateness_sliding_counts(spark):
    data = _data()
    df = frame(spark, "url string, ts_s long, seq long", data)
    wm = _py_wm(data, 5)
    size, slide, lateness = 60, 5, 20
    expect = {}
    for url, t, i in data:
        last = t - t % slide
        for s in range(last, t - size, -slide):
            e = (s + size) * 1000
            if wm[i] is None or e - 1 + lateness * 1000 > wm[i]:
                expect[(url, e)] = expect.get((url, e), 0) + 1
    adm = admit_from(df, "ts", "seq", "5 seconds", f"{lateness} seconds")
    for method in ("panes", "expand"):
        got = rows(sliding_agg(adm, f"{size} seconds", f"{slide} seconds", [Count("cnt")], keys=["url"],
                               admit="admit_ms", method=method), "url", "window_end", "cnt")
        assert got == sorted((k[0], k[1], v) for k, v in expect.items()), method
    # the job form ranks the same admitted counts
    top = jobs.top_urls(df, 2, f"{size} seconds", f"{slide} seconds", delay="5 seconds",
                        lateness=f"{lateness} seconds")
    by_window = {}
    for (url, e), c in expect.items():
        by_window.setdefault(e, []).append((-c, url))
    exp_top = sorted((e, r + 1, u, -c) for e, v in by_window.items() for r, (c, u) in enumerate(sorted(v)[:2]))
    assert rows(top, "window_end", "rank", "url", "cnt") == exp_top
