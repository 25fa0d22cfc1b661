import numpy as np
import zlib

from tabloom.llm import additive_quality as a

SF_DIR = "/root/testdata/sf0.1"


def test_held_out_documents(spark):
    docs, labels = (spark.read.parquet(f"{SF_DIR}/{t}.parquet") for t in ("documents", "labels"))
    model = a.train(docs, labels.where(~a.held_out("doc_id")), "quality")
    got = a.score_documents(docs, model).join(labels, "doc_id").where(a.held_out("doc_id")).collect()
    assert len(got) > 500
    right = sum((r.score >= 0.3) == bool(r.quality) for r in got)
    assert right >= 0.97 * len(got)
    assert all(r.score >= 0.3 for r in got if r.quality)


def test_scores_are_sums_of_table_entries():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(3000, 4))
    y = ((x[:, 0] > 0.3) ^ (x[:, 1] * x[:, 2] > 0)).astype(float)
    model = a.fit(x, y, a.Fit(pairs=3))
    assert (1, 2) in [(p, q) for p, q, *_ in model.pairs]
    for row, got in zip(x[:50], a.score(model, x[:50])):
        total = model.start
        for value, cuts, table in zip(row, model.cuts, model.tables):
            total += table[sum(value >= c for c in cuts)]
        for i, j, left, right, grid in model.pairs:
            total += grid[sum(row[i] >= c for c in left), sum(row[j] >= c for c in right)]
        assert np.isclose(got, 1 / (1 + np.exp(-total)))


def test_pairs_learn_what_single_features_cannot():
    rng = np.random.default_rng(4)
    x = rng.uniform(-1, 1, size=(4000, 3))
    y = (x[:, 0] * x[:, 2] > 0).astype(float)
    with_pairs = ((a.score(a.fit(x, y, a.Fit(rounds=30)), x) > 0.5) == y).mean()
    without = ((a.score(a.fit(x, y, a.Fit(rounds=30, pairs=0)), x) > 0.5) == y).mean()
    assert with_pairs > 0.95 and without < 0.7


def test_no_labels_or_one_kind(spark, odd, none):
    empty = spark.createDataFrame([], "doc_id bigint, quality int")
    model = a.train(odd, empty, "quality")
    assert {r.score for r in a.score_documents(odd, model).collect()} == {0.5}
    ones = odd.selectExpr("doc_id", "1 quality").where("doc_id is not null")
    scores = [r.score for r in a.score_documents(odd, a.train(odd, ones, "quality")).collect()]
    assert len(scores) == odd.count() and all(0.99 < s <= 1 for s in scores)
    assert a.score_documents(none, model).count() == 0


def test_the_sample_is_bounded(spark):
    docs = spark.range(500).selectExpr("id doc_id", "concat('text ', id) text")
    labels = spark.range(500).selectExpr("id doc_id", "cast(id % 2 as int) quality")
    assert a.train(docs, labels, "quality", a.Fit(rows=4)).tables[0].tolist() == [0.0]


def test_a_labelled_key_on_a_third_of_all_rows(spark, monkeypatch):
    """What reaches the driver is bounded by Fit.rows, however often a labelled key repeats."""
    rows = spark.range(30_000).selectExpr("if(id % 3 = 0, -1, id) doc_id", "if(id = 3, null, concat('text ', id % 7)) text")
    labels = spark.createDataFrame([(-1, 1), (-1, 1), (-1, 0), (1, 0), (2, 1), (None, 1), (4, None)], "doc_id bigint, quality int")
    seen = []
    monkeypatch.setattr(a, "fit", lambda x, y, how: seen.append(sorted(y)))
    for limit in (1, 3, 5, 100):
        a.train(rows, labels, "quality", a.Fit(rows=limit))
        assert len(seen[-1]) <= limit
    assert seen[-1] == [0, 0, 1, 1]


def brute_tree(g, h, place, bins, shrink, depth):
    """Values per bin: the best cut by trying every one, then each side by itself."""
    inside = [k for k in range(len(place)) if bins[0] <= place[k] < bins[1]]
    total_g, total_h = sum(g[k] for k in inside), sum(h[k] for k in inside)
    best, at = total_g**2 / (total_h + shrink) + 1e-9, None
    for cut in range(bins[0] + 1, bins[1]) if depth else ():
        left = [k for k in inside if place[k] < cut]
        lg, lh = sum(g[k] for k in left), sum(h[k] for k in left)
        gain = lg**2 / (lh + shrink) + (total_g - lg) ** 2 / (total_h - lh + shrink)
        if gain > best + 1e-12:
            best, at = gain, cut
    if at is None:
        return [total_g / (total_h + shrink)] * (bins[1] - bins[0])
    sides = [(bins[0], at), (at, bins[1])]
    return [v for side in sides for v in brute_tree(g, h, place, side, shrink, depth - 1)]


def test_fitting_against_plain_loops():
    """Cyclic boosting of four-leaf trees, then of trees on pairs that cut once in either direction."""
    rng = np.random.default_rng(9)
    x = np.round(rng.normal(size=(120, 3)), 1)
    y = ((x[:, 0] > 0) ^ (x[:, 1] * x[:, 2] > 0.2)).astype(float)
    how = a.Fit(bins=5, rounds=3, pairs=1, grid=4, pair_rounds=2)
    model = a.fit(x, y, how)
    mean = y.mean()
    score = [np.log(mean / (1 - mean))] * len(y)
    slopes = lambda: zip(*[(t - (p := 1 / (1 + np.exp(-s))), p * (1 - p)) for s, t in zip(score, y)])
    quantiles = lambda f, n: sorted(set(np.quantile(x[:, f], [i / n for i in range(1, n)]).tolist()))
    tables = []
    places = []
    for f in range(3):
        cuts = quantiles(f, how.bins)
        places.append([sum(v >= c for c in cuts) for v in x[:, f]])
        tables.append([0.0] * (len(cuts) + 1))
    for _ in range(how.rounds):
        for table, place in zip(tables, places):
            g, h = slopes()
            for b, v in enumerate(brute_tree(g, h, place, (0, len(table)), how.shrink, 2)):
                table[b] += how.step * v
                for k in range(len(y)):
                    if place[k] == b:
                        score[k] += how.step * v
    for got, wanted in zip(model.tables, tables):
        assert np.allclose(got, wanted)

    def pair_gain(p, q, g, h):
        cuts = [quantiles(f, how.grid) for f in (p, q)]
        cell = [tuple(sum(v >= c for c in cs) for v, cs in zip(row, cuts)) for row in x[:, [p, q]]]
        whole = sum(g) ** 2 / (sum(h) + how.shrink)
        best = None
        for i in range(1, len(cuts[0]) + 1):
            for j in range(1, len(cuts[1]) + 1):
                sums = {}
                for k, (r, c) in enumerate(cell):
                    side = (r < i, c < j)
                    before = sums.get(side, (0, 0))
                    sums[side] = (before[0] + g[k], before[1] + h[k])
                gain = sum(s**2 / (t + how.shrink) for s, t in sums.values()) - whole
                if best is None or gain > best[0] + 1e-9:
                    best = (gain, i, j, sums)
        return best, cell

    g, h = slopes()
    chosen = max([(0, 1), (0, 2), (1, 2)], key=lambda p: pair_gain(*p, g, h)[0][0])
    assert [p[:2] for p in model.pairs] == [chosen]
    for _ in range(how.pair_rounds):
        g, h = slopes()
        (_, i, j, sums), cell = pair_gain(*chosen, g, h)
        for k, (r, c) in enumerate(cell):
            s, t = sums[r < i, c < j]
            score[k] += how.step * s / (t + how.shrink)
    assert np.allclose(a.score(model, x), 1 / (1 + np.exp(-np.array(score))))


def test_held_out_rule(spark):
    got = spark.range(200).selectExpr("id doc_id").withColumn("h", a.held_out("doc_id")).collect()
    assert all(r.h == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)


def test_odd_features():
    for text in ("", " ", "🙂", "a" * 100_000, "x\n" * 1000):
        assert np.isfinite(a.features_of(text)).all() and len(a.features_of(text)) == len(a.FEATURES)
