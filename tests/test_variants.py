"""Stored variants of a weight table: what is packed comes back as what is scored."""
import numpy as np

from sparkfeat.operators import variants as VA


def test_packed_variants_come_back(spark):
    r = np.random.default_rng(3)
    rows = [(layer, i, j, float(r.normal())) for layer, (a, b) in enumerate([(6, 5), (5, 4), (4, 3)]) for j in range(-1, a) for i in range(b)]
    wt = spark.createDataFrame(rows, "layer int, row int, col int, value double").repartition(3)
    sizes = {x["variant"]: x for x in VA.stored_sizes(wt).collect()}
    n = len(rows)
    assert all(x["n_weights"] == n for x in sizes.values())
    assert sizes["float32"]["size_bytes"] == 4 * n and sizes["float16"]["size_bytes"] == 2 * n
    assert sizes["int8_dynamic"]["size_bytes"] == n + 24 and sizes["int8_full"]["size_bytes"] == n + 48 + 64
    assert sizes["pruned_70"]["size_bytes"] < 2 * n and sizes["pruned_70"]["n_zero"] > 0.65 * n
    for v in VA.VARIANTS:
        want = VA.make_variant(wt, v).toPandas().sort_values(["layer", "row", "col"])["value"].to_numpy()
        got = VA.unpack(VA.pack(wt, v)).toPandas().sort_values(["layer", "at"])["value"].to_numpy()
        assert np.allclose(got, want, rtol=1e-6 if v in ("pruned_70", "float32") else 1e-12, atol=1e-12), v


def _net(r, spark, sizes=(6, 5, 4, 3)):
    rows = [(layer, i, j, float(r.normal())) for layer, (a, b) in enumerate(zip(sizes, sizes[1:])) for j in range(-1, a) for i in range(b)]
    return spark.createDataFrame(rows, "layer int, row int, col int, value double").repartition(3)


def _by_hand(net, x):
    """One row through the network, a whole number at a time."""
    scale, zero = net.points[0]
    h = [max(-128, min(127, round(v / scale + zero))) for v in x]
    for i, (W, b, w_scale, w_zero) in enumerate(net.layers):
        z_scale, z_zero = net.points[i + 1]
        out = []
        for o in range(W.shape[1]):
            acc = sum((h[k] - zero) * (int(W[k, o]) - int(w_zero)) for k in range(len(h))) + round((b[o] - w_zero) / scale)
            out.append(max(-128, min(127, round(acc * (scale * w_scale / z_scale)) + z_zero)))
        if i < len(net.layers) - 1:
            scale, zero = 1 / 256, -128
            out = [max(-128, min(127, round(1 / (1 + np.exp(-(z - z_zero) * z_scale)) * 256 - 128))) for z in out]
        h = out
    return h


def test_whole_number_network(spark):
    r = np.random.default_rng(4)
    wt = _net(r, spark)
    X = r.normal(size=(300, 6)) * 2
    df = spark.createDataFrame([(i, [float(v) for v in x], 0) for i, x in enumerate(X)] + [(999, None, 0)],
                               "id long, x array<double>, label int").repartition(5)
    cal = VA.calibrate(df, wt, "x")
    points = {p["point"]: p for p in cal.collect()}
    assert sorted(points) == [0, 1, 2, 3]
    assert (points[0]["low"], points[0]["high"]) == (X.min(), X.max())
    assert all(p["low"] <= 0 <= p["high"] and -128 <= p["zero"] <= 127 for p in points.values())
    one = VA.input_range(df, "x").first()
    assert one == points[0]
    net = VA.integer_net(wt, cal)
    codes = net.codes(X)
    assert codes.dtype == np.int8
    assert all(_by_hand(net, x) == list(map(int, c)) for x, c in zip(X[:40], codes))
    full = df.where("x is not null")
    got = VA.score(full, {"float32": VA.make_variant(wt, "float32"), "int8_full": net}, "x", "id", "label").toPandas()
    both = got.pivot(index="id", columns="variant", values="pred")
    assert len(both) == 300 and (both["float32"] == both["int8_full"]).mean() >= 0.9
    assert (both["int8_full"].to_numpy() == codes.argmax(1)).all()


def test_input_codes_clamp_and_constant_input(spark):
    df = spark.createDataFrame([(1, [0.0, 0.0]), (2, [9.0, -9.0])], "id long, x array<double>")
    r = VA.input_range(df.where("id = 1"), "x").first()
    assert (r["scale"], r["low"], r["high"]) == (1.0, 0.0, 0.0)
    r = VA.input_range(spark.createDataFrame([(1, [1.0, -1.0, float("nan"), None])], "id long, x array<double>"), "x").first()
    assert (r["low"], r["high"]) == (-1.0, 1.0)
    got = df.select(VA.input_codes(df.x, r["scale"], r["zero"]).alias("c")).collect()
    assert list(got[1]["c"]) == [127, -128] and got[0]["c"][0] == r["zero"]


def test_points_must_match_layers(spark):
    wt = _net(np.random.default_rng(1), spark)
    none = spark.createDataFrame([], "point int, low double, high double, scale double, zero long")
    try:
        VA.integer_net(wt, none)
    except ValueError as e:
        assert "calibrated points" in str(e)
    else:
        raise AssertionError("a network without calibration was built")
