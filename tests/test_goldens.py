"""Golden cases, and folds against sequential models on random series."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.functions import names
from tidemark.operators import boxes, classify, ledger, select, series, states, threshold
from tidemark.sources import files, sinks

DEMO = [5] * 8 + [6, 7] + [8] * 9 + [7] + [6] * 8


def as_series(spark, *lists):
    return spark.createDataFrame([(v, s, int(c)) for v, xs in enumerate(lists) for s, c in enumerate(xs)], "video_id long, second long, c long")


@pytest.mark.parametrize(("variation", "spans", "events"), [(0, [(0, 7), (10, 18), (20, 27)], [(10, 3, 0.94), (20, -2, 0.8067)]), (1, [(0, 8), (9, 19), (20, 27)], [(9, 3, 0.67), (20, -2, 0.6567)])])
def test_states(spark, variation, spans, events):
    found = states.stable_periods(as_series(spark, DEMO), shortest=5, variation=variation)
    assert sorted((r.start_second, r.end_second) for r in found.collect()) == spans
    got = states.state_events(found).orderBy("second").collect()
    assert [(r.second, r.count_change) for r in got] == [e[:2] for e in events]
    assert [r.confidence for r in got] == pytest.approx([e[2] for e in events], abs=1e-4)


def test_repair(spark):
    df = as_series(spark, [7, 7, 7, 9, 7, 7], [7, 7, 7, 5, 7, 7])
    spikes = {(r.video_id, r.second): r.c for r in series.remove_spikes(df).collect()}
    assert [spikes[0, s] for s in range(6)] == [7] * 6
    dips = {(r.video_id, r.second): r.c for r in series.remove_dips(df).collect()}
    assert [dips[1, s] for s in range(6)] == [7] * 6


def model_repair(c, longest, dip):
    c, out, n, i = list(c), list(c), len(c), 0
    while i < n - longest - 1:
        back = next((k for k in range(1, longest + 2) if (c[i + k] >= c[i] if dip else c[i + k] <= c[i])), None)
        if back and back >= 2 and not (dip and c[i + back] - c[i] > 1):
            out[i + 1 : i + back] = [c[i]] * (back - 1)
            i += back
        else:
            i += 1
    return out


def test_repair_against_model(spark):
    rng = np.random.default_rng(1)
    lists = [rng.integers(0, 4, int(rng.integers(1, 25))).tolist() for _ in range(150)]
    for longest, dip in ((1, False), (2, False), (3, True)):
        fixed = (series.remove_dips if dip else series.remove_spikes)(as_series(spark, *lists), longest=longest)
        got = {}
        for r in fixed.orderBy("video_id", "second").collect():
            got.setdefault(r.video_id, []).append(r.c)
        assert [got[i] for i in range(len(lists))] == [model_repair(x, longest, dip) for x in lists]


def model_threshold(c, smooth, error, hold):
    n, c = len(c), np.array(c)
    s = np.array([np.mean([c[min(max(i + o, 0), n - 1)] for o in range(-(smooth // 2), smooth - smooth // 2)]) for i in range(n)])
    out, t = [], 0
    while t < n:
        a, b = max(0, t - error), min(n, t + hold)
        before, after = (s[a:t].mean() if t > a else 0.0), s[t:b].mean()
        if after - before >= 0.8 - 1e-12 and after >= 1 - 1e-12 and a > 0:
            up = next((i for i in range(max(t, 1), b) if c[i] > c[i - 1] and len(c[i : i + 3]) >= 2 and (c[i : i + 3] >= c[i]).sum() >= max(1, len(c[i : i + 3]) * 0.6)), None)
            if up is not None and c[up] > c[max(0, up - 3) : up].max():
                out.append((up, "arrival"))
                t = up + 2
                continue
        if before - after >= 1 - 1e-12 and after <= max(0.5, before - 1) + 1e-12:
            down = next((i for i in range(max(t, 1), min(b, n - 1)) if c[i] < c[max(0, i - 2) : i].mean() - 0.5), t)
            out.append((down, "departure"))
            t = down + 2
            continue
        t += 1
    return out


def test_threshold_against_model(spark):
    rng = np.random.default_rng(2)
    lists = [np.repeat(rng.integers(0, 4, 12), rng.integers(1, 12, 12)).tolist() for _ in range(60)]
    got = {i: [] for i in range(len(lists))}
    for r in threshold.detect(as_series(spark, *lists), smooth=1).collect():
        got[r.video_id].append((r.second, r.type))
    for i, xs in enumerate(lists):
        # order of detection: a departure may be reported at a second before an earlier one's
        assert sorted(got[i]) == sorted(model_threshold(xs, 1, 10, 8)), xs


def model_states(c, shortest, variation):
    out, i = [], 0
    while i < len(c):
        j = i
        while j + 1 < len(c) and max(c[i : j + 2]) - min(c[i : j + 2]) <= variation:
            j += 1
        if j - i + 1 >= shortest:
            out.append((i, j))
            i = j + 1
        else:
            i += 1
    return out


@pytest.mark.parametrize("variation", [0, 1, 2])
def test_states_against_model(spark, variation):
    rng = np.random.default_rng(3)
    lists = [np.repeat(rng.integers(0, 5, 10), rng.integers(1, 7, 10)).tolist() for _ in range(50)]
    got = {i: [] for i in range(len(lists))}
    for r in states.stable_periods(as_series(spark, *lists), shortest=4, variation=variation).collect():
        got[r.video_id].append((r.start_second, r.end_second))
    assert [sorted(got[i]) for i in range(len(lists))] == [model_states(x, 4, variation) for x in lists]


def matches(spark, truth, found):
    t = spark.createDataFrame([("f", i, k, s) for i, (k, s) in enumerate(truth)], "file string, truth_no long, type string, second long")
    f = spark.createDataFrame([("f", i, k, s) for i, (k, s) in enumerate(found)], "file string, found_no long, type string, second long")
    return sorted((r.truth_no, r.found_no) for r in select.match_nearest(t, f, 3).collect())


def test_matching(spark):
    found = [("arrival", 11), ("arrival", 14), ("departure", 10)]
    assert matches(spark, [("arrival", 10), ("arrival", 12)], found) == [(0, 0), (1, 1)]
    assert matches(spark, [("arrival", 12), ("arrival", 10)], found) == [(0, 0)]


def test_names(spark):
    stems = ["FAR3_20250630T122002_raw", "Rost3_20200519_113548", "12_BONDEN3_(192.168.1.128)_2025-06-16_00.00.00_64803_raw", "X_20259940T000000", "none"]
    rows = spark.createDataFrame([(i, s) for i, s in enumerate(stems)], "i int, s string").select("i", names.start_time(F.col("s")).cast("string").alias("t"), names.station_of(F.col("s")).alias("st")).orderBy("i").collect()
    assert [r.t for r in rows] == ["2025-06-30 12:20:02", "2020-05-19 11:35:48", "2025-06-16 00:00:00", None, None]
    assert [r.st for r in rows][:3] == ["FAR3", "ROST3", "BONDEN3"]


def test_scan(spark, tmp_path):
    text = "frame,class,confidence,xmin,ymin,xmax,ymax\n0,adult,0.25,50,60,90,100\n25,adult,bad,50,60,90,100\n50,fish,0.9,,60,90,100\n75,adult,0.2,50,60,90,100\n100,adult,0.9,10,60,90,100\n"
    (tmp_path / "FAR3_20250630T122002_raw.csv").write_text(text)
    rows = files.read_detections(spark, str(tmp_path), edge=True).collect()
    assert [(r.video_id, r.station, r.frame) for r in rows] == [("FAR3_20250630T122002", "FAR3", 0)]
    assert files.rejected(spark, str(tmp_path)).count() == 2
    assert files.list_files(spark, str(tmp_path), "*_raw.csv").count() == 1
    assert files.read_or_empty(spark, str(tmp_path / "no"), "a int").count() == 0


def test_per_second_and_empty(spark):
    df = spark.createDataFrame([(1, 0, "adult", 0.5, 0.0, 0.0, 2.0, 2.0), (1, 3, "other", 0.5, 0.0, 0.0, 2.0, 2.0)], "video_id long, second long, class string, confidence double, xmin double, ymin double, xmax double, ymax double")
    rows = series.per_second(df, ("adult",)).orderBy("second").collect()
    assert [(r.second, r.count_adult, r.count_total) for r in rows] == [(0, 1, 1), (1, 0, 0), (2, 0, 0), (3, 0, 0)]
    assert rows[0].adult_mean_x == 1.0 and rows[1].adult_mean_x is None
    assert series.per_second(df.limit(0), ("adult",)).count() == 0


def test_feature_defaults_and_gates(spark):
    events = spark.createDataFrame([(1, 1)], "event_id long, arrival_with_fish_stage2 int")
    none = spark.createDataFrame([], "event_id long, frame long, class string, confidence double, xmin double, ymin double, xmax double, ymax double")
    row = classify.features(events, none).first()
    assert (row.fish_first_frame_ratio, row.fish_bird_mean_distance, row.fish_bird_min_distance, row.fish_to_bird_first_frame_ratio_gap, row.total_frames) == (1.0, 9999.0, 9999.0, 1.0, 0)
    gated = classify.features(events, none).withColumns({"event_type": F.lit("arrival"), "stage3_status": F.lit("completed"), "has_detections": F.lit(False)})
    assert classify.classify(gated).first().rule_hits == ["missing_detections_csv"]
    assert classify.classify(gated.withColumn("stage3_status", F.lit(None).cast("string"))).first().rule_hits == ["stage3_not_completed"]
    assert classify.classify(gated.withColumn("event_type", F.lit("departure"))).first().rule_hits == ["non_arrival_event"]


def test_upsert_and_ledger(spark):
    old = spark.createDataFrame([("a", 1, "x"), ("b", 1, "y")], "station string, event_id int, v string")
    new = spark.createDataFrame([("a", 1, "z"), ("c", 9, "w")], "station string, event_id int, v string")
    once = sinks.upsert(old, new, ["station", "event_id"])
    assert sorted(map(tuple, once.collect())) == [("a", 1, "z"), ("b", 1, "y"), ("c", 9, "w")]
    assert sorted(map(tuple, sinks.upsert(once, new, ["station", "event_id"]).collect())) == sorted(map(tuple, once.collect()))
    jobs = spark.createDataFrame([(1, 1, "completed", 0), (1, 2, "pending", 0), (2, 1, "pending", 0), (2, 2, "pending", 0)], "video_id long, stage int, status string, retry_count int").withColumns({"priority_score": F.lit(1.0), "discovered_at": F.current_timestamp()})
    assert sorted((r.video_id, r.stage) for r in ledger.ready(jobs).collect()) == [(1, 2), (2, 1)]


def test_suppression(spark):
    df = spark.createDataFrame([(1, "a", 0.9, 0.0, 0.0, 10.0, 10.0, 1), (1, "a", 0.9, 0.0, 0.0, 10.0, 10.0, 2), (1, "a", 0.5, 20.0, 0.0, 30.0, 10.0, 3)], "frame long, class string, confidence double, xmin double, ymin double, xmax double, ymax double, event_id long")
    assert sorted(r.event_id for r in boxes.suppress(df, ["frame", "class"]).collect()) == [1, 3]


def test_logistic_reaches_the_optimum(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(400, 3)) * [1, 30, 0.2] + [0, 100, 5]
    y = (rng.random(400) < 1 / (1 + np.exp(-(x[:, 0] + (x[:, 1] - 100) / 20)))).astype(float)
    x[5, 2] = np.nan
    df = spark.createDataFrame([(*map(float, r[:2]), None if np.isnan(r[2]) else float(r[2]), 4.0, float(t)) for r, t in zip(x, y)], "a double, b double, c double, same double, y double")
    names_ = ["a", "b", "c", "same"]
    model = classify.fit_logistic(df, names_, "y", l2=0.05)
    z = np.column_stack([x, np.full(400, 4.0)])
    z = np.where(np.isnan(z), model["means"], z)
    z = (z - model["means"]) / model["stds"]
    w, b = np.array(model["weights"]), model["bias"]

    def loss(w, b):
        eta = z @ w + b
        return np.mean(np.logaddexp(0, eta) - y * eta) + 0.025 * w @ w

    err = 1 / (1 + np.exp(-(z @ w + b))) - y
    assert np.abs(z.T @ err / 400 + 0.05 * w).max() < 1e-8 and abs(err.mean()) < 1e-8
    assert model["stds"][3] == 1.0 and model["loss"] == pytest.approx(loss(w, b))
    assert all(loss(w + d, b + d[0]) >= loss(w, b) for d in rng.normal(size=(50, 4)) * 0.1)
    assert classify.fit_logistic(df.limit(0), names_, "y")["weights"] == [0.0] * 4


def test_rule_search_chooses_on_validation(spark):
    rows = [(k, float(k % 7), float(k % 5) * 10, int(k % 7 >= 3 and k % 5 <= 2)) for k in range(200)]
    df = spark.createDataFrame(rows, "id long, a double, d double, y int")
    out = classify.search_rule(df, "y", [("a", ">=", [1, 3, 5]), ("d", "<=", [0, 20, 40])], F.col("id") % 4 == 0)
    best = out.where("chosen").collect()
    assert out.count() == 9 and [(r.a, r.d, r.f1) for r in best] == [(3.0, 20.0, 1.0)]
    for r in out.collect():
        said = [(i % 4 == 0, y, a >= r.a and d <= r.d) for i, a, d, y in rows]
        assert r.tp == sum(v and y and s for v, y, s in said) and r.train_fp == sum(not v and not y and s for v, y, s in said)


def test_mahalanobis_against_model(spark, monkeypatch):
    from tidemark.operators import grid

    monkeypatch.setattr(grid, "CHUNK", 7)
    rng = np.random.default_rng(4)
    x = rng.normal(size=(40, 6))
    df = spark.createDataFrame([(k % 2, k, x[k].tolist()) for k in range(40)], "label long, vec_id long, v array<double>")
    got = {r.vec_id: r.score for r in grid.mahalanobis(df, "label", "vec_id", "v", 5).collect()}
    assert len(got) == 40
    for label in (0, 1):
        own = list(range(label, 40, 2))
        for i, k in enumerate(own):
            past = x[own[max(0, i - 5) : i]]
            if len(past) < 2:
                assert got[k] is None
                continue
            off = x[k] - past.mean(axis=0)
            cov = np.cov(past, rowvar=False) + 1e-6 * np.eye(6)
            assert got[k] == pytest.approx(np.sqrt(off @ np.linalg.pinv(cov) @ off), rel=1e-6)


def test_components_and_cells(spark):
    from tidemark.operators import grid

    rng = np.random.default_rng(6)
    x = rng.normal(size=(60, 4)) @ np.diag([5, 2, 1, 0.5])
    df = spark.createDataFrame([(k, x[k].tolist()) for k in range(60)], "vec_id long, v array<double>")
    got = np.array([r.pca for r in grid.principal_components(df, "v", 2).orderBy("vec_id").collect()])
    _, _, axes = np.linalg.svd(x - x.mean(axis=0))
    for j in range(2):
        axis = axes[j] * np.sign(axes[j][np.abs(axes[j]).argmax()])
        assert np.allclose(got[:, j], x @ axis, atol=1e-6)
    points = rng.random((300, 2)) * [800, 600]
    cells = grid.adaptive_cells(points, 800, 600, 16)
    area = sum((c[3] - c[1]) * (c[4] - c[2]) for c in cells)
    assert len(cells) <= 16 and area == pytest.approx(800 * 600) and sum(c[5] for c in cells) == 300
    for _, x1, y1, x2, y2, n in cells:
        assert n == ((points[:, 0] >= x1) & (points[:, 0] < x2) & (points[:, 1] >= y1) & (points[:, 1] < y2)).sum()


def test_settings(tmp_path, monkeypatch):
    from tidemark.sources import config

    monkeypatch.setenv("ROOT_OF_IT", "/data")
    path = tmp_path / "run.json"
    path.write_text('{"video_sources": ["$ROOT_OF_IT/a", "${ROOT_OF_IT}/b"], "confidence": 0.4}')
    assert config.load(str(path)).video_sources == ["/data/a", "/data/b"]
    for text in ('{"confidence": 2}', '{"nonsense": 1}', "[1]", '{"stations": "x"}', '{"first_date": "2024-02-01", "last_date": "2024-01-01"}'):
        path.write_text(text)
        with pytest.raises(ValueError):
            config.load(str(path))
    path.write_text("")
    assert config.load(str(path)) == config.Settings()


def test_nms_and_walks_of_many(spark):
    """Selections grow in proportion to their candidates."""
    df = spark.range(200_000).selectExpr("1 video", "id at", "id + 3 resume")
    assert select.jump_select(df, "video", "at", "resume").count() == 66_667
    one = spark.range(20_000).selectExpr("'f' file", "id truth_no", "'x' type", "id * 10 second")
    assert select.match_nearest(one, one.withColumnRenamed("truth_no", "found_no"), 3).count() == 20_000


def test_long_series_with_variation(spark):
    series_ = [k // 50 % 3 for k in range(20_000)]
    found = states.stable_periods(as_series(spark, series_), shortest=5, variation=1)
    assert found.agg(F.sum("duration")).first()[0] == 20_000
