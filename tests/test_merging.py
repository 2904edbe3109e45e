import numpy as np
import pytest

from modelyard.operators import merging as G
from modelyard.operators import parameters as P

SCHEMA = "model_id string, tensor string, shape array<bigint>, vals array<float>"


def make(spark, models, size=7):
    rows = [
        (m, t, list(v.shape), v.astype(np.float32).ravel().tolist())
        for m, ts in models.items()
        for t, v in ts.items()
    ]
    return P.chunked(spark.createDataFrame(rows, SCHEMA), "vals", size)


def back(df, shapes):
    out = {t: np.full(int(np.prod(s)) if s else 1, np.nan, dtype=np.float32) for t, s in shapes.items()}
    for r in P.elements(df, "tensor").collect():
        out[r.tensor][r.idx] = r.value
    return {t: v.reshape(shapes[t]) for t, v in out.items()}


@pytest.fixture(scope="module")
def weights():
    """One tensor holds far more than a third of all elements; some do not match."""
    rng = np.random.default_rng(5)
    shapes = {"hot": (40, 25), "a": (3, 4), "b": (5,), "scalar": (), "const": (9,)}
    models = {
        m: {t: np.asarray(rng.normal(scale=0.1, size=s), dtype=np.float32) for t, s in shapes.items()}
        for m in ("base", "x", "y", "z")
    }
    for m in models:
        models[m]["const"] = np.full(9, 0.5 if m == "base" else 0.75, dtype=np.float32)
    models["y"]["a"] = models["y"]["a"].reshape(4, 3)
    del models["z"]["b"], models["x"]["b"], models["y"]["b"]
    models["y"]["extra"] = np.ones(3, dtype=np.float32)
    # Ties in magnitude at the threshold.
    models["x"]["hot"][:20] = models["base"]["hot"][:20] + np.float32(0.25)
    models["y"]["hot"][5:25] = models["base"]["hot"][5:25]
    return models


def shapes_of(models, name="base"):
    return {t: v.shape for t, v in models[name].items()}


def matching(models, names, key):
    base = models["base"]
    return [models[m][key] for m in names if key in models[m] and models[m][key].shape == base[key].shape]


def ref_ties(models, names, density, scaling):
    out = {}
    for key, b in models["base"].items():
        ds = []
        for w in matching(models, names, key):
            d = w - b
            flat = np.sort(np.abs(d).ravel())[::-1]
            k = max(1, int(flat.size * density))
            ds.append(np.where(np.abs(d) < flat[k - 1], np.float32(0), d))
        if not ds:
            out[key] = b
            continue
        s = np.stack(ds).astype(np.float64)
        sign = np.where(np.sign(s).sum(0) < 0, -1, 1)
        mask = np.sign(s) == sign
        out[key] = (b + scaling * (s * mask).sum(0) / np.maximum(mask.sum(0), 1)).astype(np.float32)
    return out


def check(df, want, models, name="base"):
    got = back(df, shapes_of(models, name))
    for key, w in want.items():
        np.testing.assert_allclose(got[key], w, rtol=1e-6, atol=1e-6, err_msg=key)


@pytest.mark.parametrize("density", [1.0, 0.7, 0.31, 0.0])
def test_ties(spark, weights, density):
    params = make(spark, weights)
    check(
        G.ties(params, "base", ["x", "y", "z"], density, 0.5),
        ref_ties(weights, ["x", "y", "z"], density, 0.5), weights,
    )


def test_ties_does_not_depend_on_partitions_or_chunks(spark, weights):
    a = back(G.ties(make(spark, weights, 3).repartition(9), "base", ["x", "y"]), shapes_of(weights))
    b = back(G.ties(make(spark, weights, 1000).coalesce(1), "base", ["x", "y"]), shapes_of(weights))
    for key in a:
        np.testing.assert_array_equal(a[key], b[key])


def test_ties_of_one_model_at_full_density_is_scaled_delta(spark, weights):
    got = back(G.ties(make(spark, weights), "base", ["x"], 1.0, 0.5), shapes_of(weights))
    b, x = weights["base"]["hot"], weights["x"]["hot"]
    np.testing.assert_allclose(got["hot"], b + 0.5 * (x - b), atol=1e-6)


def test_thresholds_over_many_magnitudes(spark):
    rng = np.random.default_rng(2)
    base = {"w": np.zeros(3000, dtype=np.float32)}
    x = (rng.choice([-1, 1], 3000) * 2.0 ** rng.uniform(-140, 100, 3000)).astype(np.float32)
    x[:400] = 0
    models = {"base": base, "x": {"w": x}}
    joined = G.joined_once(make(spark, models, 64), "base", ["x"])
    for density in (0.01, 0.5, 0.86, 0.87, 1.0):
        got = G.trim_thresholds(joined, 1, density).first().threshold
        k = max(1, int(3000 * density))
        assert np.float32(got) == np.sort(np.abs(x))[::-1][k - 1]


def test_summaries_bracket_the_rank(spark):
    """Few points, many chunks, merged as a tree: the brackets hold, and are narrow."""
    rng = np.random.default_rng(6)
    n = 40_000
    one = {"w": np.zeros(n, np.float32), "flat": np.zeros(500, np.float32), "none": np.zeros(0, np.float32)}
    x = rng.normal(size=n).astype(np.float32)
    x[rng.random(n) < 0.2] = np.float32(0.25)  # many equal magnitudes
    flat = np.full(500, 3, np.float32)
    odd = x.copy()
    odd[5], odd[6] = np.nan, np.inf
    models = {"base": one, "x": {"w": x, "flat": flat, "none": one["none"]}, "y": {"w": odd}}
    joined = G.joined_once(make(spark, models, 200), "base", ["x", "y"], points=16)
    for density in (0.003, 0.4, 0.95, 1.0):
        for fan in (5, 1000):
            found = {(r.tensor, r.model): r for r in G.brackets(joined, 2, density, fan, 64).collect()}
            assert set(found) == {("w", 0), ("w", 1), ("flat", 0)}
            for (tensor, model), r in found.items():
                bits = np.sort(np.abs(models["xy"[model]][tensor]).view(np.int32))[::-1]
                k = max(1, int(len(bits) * density))
                assert r.k == k and r.low <= bits[k - 1] < r.high
                inside = np.count_nonzero((bits > r.low) & (bits < r.high))
                assert inside < 0.35 * len(bits)
        cut = {(r.tensor, r.model): r.threshold for r in G.trim_thresholds(joined, 2, density).collect()}
        assert set(cut) == set(found)
        for (tensor, model), limit in cut.items():
            bits = np.sort(np.abs(models["xy"[model]][tensor]).view(np.int32))[::-1]
            assert np.float32(limit).view(np.int32) == bits[max(1, int(len(bits) * density)) - 1]


def test_task_arithmetic(spark, weights):
    names = ["x", "y", "z"]
    want = {
        k: b + 0.5 * sum((w - b for w in matching(weights, names, k)), np.zeros_like(b))
        for k, b in weights["base"].items()
    }
    params = make(spark, weights)
    check(G.task_arithmetic(params, "base", names, 0.5), want, weights)
    check(G.task_arithmetic(params, "base", names, 0.0), weights["base"], weights)


def test_breadcrumbs(spark, weights):
    def ref(names):
        out = {}
        for k, b in weights["base"].items():
            ds = [w - b for w in matching(weights, names, k)]
            if not ds:
                out[k] = b
                continue
            s = np.stack(ds)
            mean = s.astype(np.float64).mean(0)
            agree = (np.sign(s) == np.sign(s)[0]).all(0)
            out[k] = b + np.where(agree & (np.abs(mean) >= 0.01), mean, 0)
        return out

    params = make(spark, weights)
    for names in (["x", "y", "z"], ["z", "x", "y"], ["x"]):
        check(G.breadcrumbs(params, "base", names), ref(names), weights)


def test_slerp(spark, weights):
    def ref(a, b, alpha):
        v, w = a.astype(np.float64).ravel(), b.astype(np.float64).ravel()
        n, m = np.linalg.norm(v), np.linalg.norm(w)
        if n < 1e-8 or m < 1e-8:
            return (1 - alpha) * a + alpha * b
        theta = np.arccos(np.clip((v / n) @ (w / m), -1, 1))
        if abs(theta) < 1e-6:
            return (1 - alpha) * a + alpha * b
        mix = np.sin((1 - alpha) * theta) * v + np.sin(alpha * theta) * w
        return (mix / np.sin(theta)).reshape(a.shape)

    params = make(spark, weights)
    for alpha in (0.0, 0.3, 1.0):
        want = {
            k: ref(a, weights["y"][k], alpha) if k in weights["y"] and weights["y"][k].shape == a.shape else a
            for k, a in weights["x"].items()
        }
        check(G.slerp(params, "x", "y", alpha), want, weights, "x")
    same = {"base": weights["base"], "twin": weights["base"], "zero": {k: v * 0 for k, v in weights["base"].items()}}
    check(G.slerp(make(spark, same), "base", "twin", 0.4), weights["base"], same)
    check(G.slerp(make(spark, same), "base", "zero", 0.4), {k: 0.6 * v for k, v in weights["base"].items()}, same)
    flipped = {"base": weights["base"], "neg": {k: -v for k, v in weights["base"].items()}}
    G.slerp(make(spark, flipped), "base", "neg").count()


def test_dare_keeps_about_density_and_is_repeatable(spark):
    n = 40_000
    models = {"base": {"w": np.zeros(n, np.float32)}, "x": {"w": np.ones(n, np.float32)}}
    params = make(spark, models, 4096)
    one = back(G.dare_ties(params, "base", ["x"], 0.7, 1.0, seed=3), {"w": (n,)})["w"]
    two = back(G.dare_ties(params.repartition(11), "base", ["x"], 0.7, 1.0, seed=3), {"w": (n,)})["w"]
    np.testing.assert_array_equal(one, two)
    kept = one > 0
    assert abs(kept.mean() - 0.7) < 0.01
    np.testing.assert_allclose(one[kept], 1 / 0.7, rtol=1e-6)
    # No pattern along the index: neighbours are kept independently.
    assert abs((kept[1:] & kept[:-1]).mean() - 0.49) < 0.015


@pytest.mark.parametrize("elements", [1 << 24, 400])
def test_low_rank(spark, monkeypatch, elements):
    """In one block per column chunk, and in a grid of many."""
    monkeypatch.setattr(G, "BLOCK_ELEMENTS", elements)
    rng = np.random.default_rng(4)
    rows, cols, rank, width = 2100, 10, 3, 4
    w, b, a = rng.normal(size=(rows, cols)), rng.normal(size=(rows, rank)), rng.normal(size=(rank, cols))
    cut = lambda v: [(c, v[c * width : (c + 1) * width].tolist()) for c in range(-(-cols // width))]
    weight = spark.createDataFrame(
        [("t", i, c, c * width, p) for i in range(rows) for c, p in cut(w[i])]
        + [("other", 0, 0, 0, [1.0, 2.0]), ("t", rows, 0, 0, w[0][:width].tolist())],  # no side A; no factors
        "tensor string, row bigint, chunk int, start bigint, values array<float>",
    )
    side_a = spark.createDataFrame(
        [("t", r, c, p) for r in range(rank) for c, p in cut(a[r])],
        "tensor string, r int, chunk int, values array<double>",
    )
    side_b = spark.createDataFrame(
        [("t", i, b[i].tolist()) for i in range(rows)], "tensor string, row bigint, factors array<double>"
    )
    got = np.zeros((rows, cols))
    rest = []
    for r in P.elements(G.merge_low_rank(weight, side_a, side_b, rank, 6.0), "tensor", "row").collect():
        if r.tensor == "t" and r.row < rows:
            got[r.row, r.idx] = r.value
        else:
            rest.append((r.tensor, r.idx, r.value))
    left = [("t", k, np.float32(v)) for k, v in enumerate(w[0][:width])]
    assert sorted(rest) == [("other", 0, 1.0), ("other", 1, 2.0), *left]
    np.testing.assert_allclose(got, w + 2.0 * b @ a, atol=1e-5)


def test_dispatch(spark, weights):
    params = make(spark, weights)
    with pytest.raises(ValueError, match="Unknown strategy"):
        G.merge_models(params, "average", ["base", "x"])
    for strategy in ("slerp", "ties", "dare_ties", "task_arithmetic", "breadcrumbs"):
        merged = G.merge_models(params, strategy, ["base", "x", "z"], name="out")
        n = P.elements(merged).filter("model_id = 'out'").count()
        assert n == sum(v.size for v in weights["base"].values())


def test_layers(spark, weights):
    params = make(spark, {"m": {
        "model.embed_tokens.weight": np.ones((2, 3)), "model.layers.0.self_attn.q_proj.weight": np.ones((2, 2)),
        "model.layers.0.post_attention_layernorm.weight": np.ones(2), "lm_head.weight": np.ones(4),
        "model.norm.weight": np.ones(2), "transformer.scale": np.float32(1).reshape(()),
    }})
    kinds = {r.tensor: r.kind for r in P.layer_groups(params).collect()}
    assert kinds["model.layers.0.post_attention_layernorm.weight"] == "attention"
    assert kinds["lm_head.weight"] == "head" and kinds["model.norm.weight"] == "norm"
    assert "transformer.scale" not in kinds
    tree = P.architecture_listing(params).collect()
    assert [r.depth for r in tree] == [0, 1, 2, 1, 2, 2, 2, 2, 1, 2]
    assert tree[0].params_m == pytest.approx(19e-6)
