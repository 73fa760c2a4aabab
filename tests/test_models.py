import json
import os

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from headway import schema as S
from headway.operators import encoding, gradient_descent, grouped, models, pieces, steps, wide_descent, wide_logistic
from headway.operators.gradient_descent import GradientDescentLogistic
from headway.operators.wide_descent import WideDescentLogistic, WideDescentModel
from headway.plans import training


def bus_rows(spark, n=32):
    """Drawn rows of the linear models' feature table; late trips are frequent in the evening and on route 00."""
    rng = np.random.default_rng(17)
    rows = []
    for _ in range(n):
        numbers = [float(x) for x in rng.normal(size=len(S.LINEAR_NUMERIC))]
        route = str(rng.choice(["00", "17", "9A"]))
        late = int(numbers[0] + (route == "00") + rng.normal() > 0.5)
        levels = {"route_id": route, "season": str(rng.integers(1, 5)), "direction_id": str(rng.choice(["in", "out"]))}
        rows.append((*numbers, *[levels.get(c, f"{c}-{rng.integers(3)}") for c in S.LINEAR_CATEGORICAL], late))
    names = [f"{c} double" for c in S.LINEAR_NUMERIC] + [f"{c} string" for c in S.LINEAR_CATEGORICAL] + ["is_delayed int"]
    return spark.createDataFrame(rows, ", ".join(names))


def test_logistic_fits_and_survives_saving(spark, tmp_path):
    df = bus_rows(spark)
    model = models.FittedModel(models.fit_logistic(df), S.LINEAR_NUMERIC + S.LINEAR_CATEGORICAL)
    scored = model.score(df)
    assert scored.columns == [*df.columns, "pred_proba_delayed", "pred_label"]
    before = sorted(r["pred_proba_delayed"] for r in scored.collect())
    assert len(before) == 32 and all(0 <= p <= 1 for p in before)
    model.save(str(tmp_path / "model"))
    again = models.FittedModel.load(spark, str(tmp_path / "model"))
    assert sorted(r["pred_proba_delayed"] for r in again.score(df).collect()) == pytest.approx(before)
    with pytest.raises(ValueError, match="missing required columns: hour"):
        again.score(df.drop("hour"))
    names = {r["feature"] for r in models.coefficients(model.pipeline, df).collect()}
    assert "hour_scaled" in names and any("route_id" in n and n.endswith("00") for n in names)


def test_unseen_levels_become_zero_vectors(spark):
    train = spark.createDataFrame([("a",), ("b",), ("b",)], "v string")
    test = spark.createDataFrame([("a",), ("z",), (None,)], "v string")
    stages = PipelineModel(list(encoding.fit_one_hot(train, ["v"])))
    got = [r[0] for r in stages.transform(test).select(vector_to_array("v_onehot")).collect()]
    assert got == [[1.0, 0.0], [0.0, 0.0], [0.0, 0.0]]
    codes = encoding.apply_ordinal(test, "v", encoding.ordinal_table(train, "v"))
    assert [r["v_code"] for r in codes.collect()] == [0, -1, -2]


def test_levels_are_counted_exactly(spark):
    df = spark.range(50).select(F.col("id").cast("string").alias("a"), F.lit(None).cast("string").alias("b"))
    encoding.check_levels(df, ["a", "b"], 50)
    with pytest.raises(ValueError, match="too many levels to index: a;"):
        encoding.check_levels(df, ["a", "b"], 49)


def test_statistics_come_from_train_only(spark):
    train = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,), (None,)], "x double")
    test = spark.createDataFrame([(None,), (100.0,)], "x double")
    medians = encoding.fit_medians(train, ["x"])
    assert medians == {"x": 2.5}
    assert sorted(r["x"] for r in encoding.fill_medians(test, medians).collect()) == [2.5, 100.0]
    mean, deviation = encoding.fit_scaling(train, ["x"])["x"]
    assert (mean, deviation) == (2.5, pytest.approx(np.std([1, 2, 3, 4])))
    assert encoding.fit_scaling(train.where("x = 1"), ["x"])["x"] == (1.0, 1.0)


def test_rare_stops_and_class_weights(spark):
    df = spark.createDataFrame([("a", 1), ("a", 0), ("b", 0), ("c", 0), (None, 0)], "stop_id string, y int")
    assert encoding.frequent_values(df, "stop_id", 2) == ["a", "b"]
    listed = encoding.bucket_rare(df, "stop_id", ["a", "b"])
    joined = encoding.bucket_by_table(df, "stop_id", df, 2)
    want = ["a", "a", "b", "other", "other"]
    assert sorted(r["stop_id"] for r in listed.collect()) == want
    assert sorted(r["stop_id"] for r in joined.collect()) == want
    assert encoding.class_weights(df, "y") == {0: 5 / 8, 1: 5 / 2}
    with pytest.raises(ValueError, match="both classes"):
        encoding.class_weights(df.where("y = 0"), "y")


def by_hand(x, y, steps, rate, alpha, start, joint, eps):
    """Dense full-batch descent written out with numpy."""
    w, b, losses = start.copy(), 0.0, []
    if joint:
        b, w = w[0], w[1:]
    for _ in range(steps):
        p = 1 / (1 + np.exp(-(x @ w + b)))
        slope, bias_slope = x.T @ (p - y) / len(y) + alpha * w, (p - y).mean()
        w, b = w - rate * slope, b - rate * bias_slope
        losses.append(-np.mean(y * np.log(p + eps) + (1 - y) * np.log(1 - p + eps)) + alpha / 2 * (w**2).sum())
    return w, b, losses


@pytest.mark.parametrize("held", [1 << 30, 0])
@pytest.mark.parametrize("joint", [False, True])
def test_descent_equals_dense_numpy(spark, joint, held, monkeypatch):
    monkeypatch.setattr(gradient_descent, "HELD_BYTES", held)
    rng = np.random.default_rng(1)
    a, c = rng.normal(size=60), rng.integers(0, 3, 60)
    y = (a + c + rng.normal(size=60) > 1).astype(float)
    df = spark.createDataFrame([(float(i), int(j), int(k)) for i, j, k in zip(a, c, y, strict=True)], "a double, c int, is_delayed int")
    eps = 1e-15 if joint else 1e-12
    model = GradientDescentLogistic(
        numericCols=["a"], indexCols=["c"], learningRate=0.3, maxIter=5, alpha=0.01, tol=0.0, biasInWeights=joint, eps=eps, seed=3
    ).fit(df)
    x = np.column_stack([a, *[(c == k).astype(float) for k in range(3)]])
    start = np.random.default_rng(3).normal(0, 0.01, 4 + joint)
    w, b, losses = by_hand(x, y, 5, 0.3, 0.01, start, joint, eps)
    assert model.getOrDefault("weights") == pytest.approx(w.tolist())
    assert model.getOrDefault("intercept") == pytest.approx(b)
    assert model.getOrDefault("lossHistory") == pytest.approx(losses)
    assert 0 <= model.accuracy(df) <= 1


def test_a_step_scans_packed_rows(spark):
    """A row per batch instead of a row per row of the table, with all its numbers and codes."""
    rows = spark.createDataFrame([(2.0, 1.0, i / 8.0, i % 3, -1) for i in range(50)], "n double, s double, x double, c int, d int")
    packed = gradient_descent.packed(rows.coalesce(1), 1).collect()
    assert len(packed) == 1
    numbers = np.frombuffer(packed[0].numbers).reshape(3, 50)
    codes = np.frombuffer(packed[0].codes, dtype=np.int32).reshape(2, 50)
    assert numbers[2].tolist() == [i / 8.0 for i in range(50)] and set(numbers[0]) == {2.0}
    assert codes[0].tolist() == [i % 3 for i in range(50)] and set(codes[1]) == {-1}


def test_columns_that_go_together_share_a_dictionary(spark):
    """Sums over packed rows are those over the rows; stops and what belongs to them become one code."""
    rng = np.random.default_rng(8)
    stop = np.sort(rng.integers(-1, 40, 900))
    count = np.where(rng.random(900) < 0.1, 3.0, 1.0)
    columns = [count, np.floor(rng.random(900) * (count + 1)), rng.normal(size=900), np.cos(stop), stop % 7, stop, rng.integers(0, 2, 900)]
    starts = [2, 42]
    batch = pa.RecordBatch.from_arrays([pa.array(c, pa.float64() if i < 4 else pa.int32()) for i, c in enumerate([*columns[:4], *columns[5:]])], list("nsxzcd"))
    state, rules = gradient_descent.State(0.2, rng.normal(size=44)), gradient_descent.Rules(1.0, 0.1, 0.0, 0.0, 1e-12, True, False, 1)
    packed = list(gradient_descent.grouped_rows(2, starts, 44)(iter([batch.slice(0, 500), batch.slice(500)])))
    rows, simple, dense, groups = json.loads(packed[0].column(0)[0].as_py())
    assert len(packed) == 1 and (rows, simple, dense) == (900, int((count == 1).sum()), [0])
    assert len(groups) == 1 and groups[0][:2] == [[1], 2] and groups[0][3] <= 82
    total = np.zeros(47)
    grouped.add_grouped(total, 0.2, np.append(state.weights, 0.0), 1e-12, packed[0])
    assert total[:-1] == pytest.approx(rules.sums(state, [c.to_numpy() for c in batch.columns], 2, starts), rel=1e-9)


@pytest.mark.parametrize("tasks", [0, 2, 32])
def test_tasks_make_many_steps_in_a_job(spark, tasks, monkeypatch):
    """3,500 steps take a job for many of them, not a job each, with the weights of a job each."""
    monkeypatch.setattr(gradient_descent, "HELD_BYTES", 0)
    monkeypatch.setattr(steps, "EXCHANGING_TASKS", tasks)
    ways = []
    for way in ("_one", "_many"):
        plain = getattr(steps.Steps, way)
        monkeypatch.setattr(steps.Steps, way, lambda self, *a, plain=plain, way=way: ways.append(way) or plain(self, *a))
    rng = np.random.default_rng(4)
    rows = [(float(rng.normal()), int(rng.integers(0, 9)), int(rng.integers(0, 2))) for _ in range(300)]
    df = spark.createDataFrame(rows, "a double, c int, is_delayed int").repartition(4)
    settings = dict(numericCols=["a"], indexCols=["c"], maxIter=14, tol=0.0, learningRate=0.3)
    many = GradientDescentLogistic(**settings).fit(df)
    parallel = spark.sparkContext.defaultParallelism
    assert ways[:1] == (["_many"] if parallel <= tasks else ["_one"])
    monkeypatch.setattr(gradient_descent, "HELD_BYTES", 1 << 30)
    held = GradientDescentLogistic(**settings).fit(df)
    for name in ("weights", "lossHistory"):
        assert many.getOrDefault(name) == pytest.approx(held.getOrDefault(name), rel=1e-9)


@pytest.mark.parametrize("limit", [1 << 30, 0])
def test_pieces_are_mapped_where_they_are_scanned(spark, limit, monkeypatch):
    """A scan plans no query and takes its rows from a local copy, which is made again when it is lost."""
    monkeypatch.setattr(pieces, "DRIVER_BYTES", limit)
    rows = spark.createDataFrame([(2.0, 1.0, float(i), i % 3) for i in range(90)], "n double, s double, x double, c int")
    scanned = pieces.Pieces(gradient_descent.packed(rows.repartition(3, "x"), 1), "pieces")

    def added(total, batch, state):
        values = pieces.matrix(batch.column(0)[0], np.float64, 3)
        codes = pieces.matrix(batch.column(1)[0], np.int32, 1)
        total[:3] += np.bincount(codes[0], values[2] * state, 3)
        total[3] += values.shape[1]

    want = [sum(i for i in range(90) if i % 3 == k) * 2.0 for k in range(3)] + [90.0]
    assert scanned.sums(4, 2.0, added).tolist() == want
    copies = [c for files in scanned.files.map(lambda p: pieces.local_copy(p)).glom().collect() for c in files]
    assert len(copies) == 3 and all(os.path.exists(c) for c in copies)
    os.remove(copies[0])
    assert scanned.sums(4, 2.0, added).tolist() == want
    scanned.close()
    assert not any(os.path.exists(c) for c in copies)


def test_pieces_are_written_row_by_row(spark):
    """Packed rows go from the task that packs them to an Arrow file; none passes the JVM or waits for the others."""
    rows = spark.createDataFrame([(1.0, 0.0, float(i), 1, f"s{i // 4:02d}") for i in range(90)], "w double, a double, x double, c int, l string")
    whole = wide_logistic.packing(3, 1)

    def pack(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 8):
                yield from whole(iter([batch.slice(start, 8)]))

    scanned = pieces.Pieces(rows.coalesce(1), "rows", pack)
    (path,) = scanned.paths
    found = [b.num_rows for b in pieces.mapped(path)]
    assert path.endswith(".arrow") and found == [1] * 12
    levels = scanned.table(lambda p: (pa.RecordBatch.from_arrays([b.column(2).flatten()], ["l"]) for b in pieces.mapped(p)), "l string")
    assert {r.l for r in levels.collect()} == {f"s{k:02d}" for k in range(23)}
    scanned.close()


@pytest.mark.parametrize("held", [1 << 30, 0])
def test_resumed_descent_equals_an_uninterrupted_one(spark, tmp_path, held, monkeypatch):
    monkeypatch.setattr(gradient_descent, "HELD_BYTES", held)
    rng = np.random.default_rng(2)
    rows = [(float(rng.normal()), int(rng.integers(0, 3)), int(rng.integers(0, 2))) for _ in range(80)]
    df = spark.createDataFrame(rows + rows[:20], "a double, c int, is_delayed int").coalesce(1)

    def fit(steps, folder):
        return GradientDescentLogistic(
            numericCols=["a"], indexCols=["c"], maxIter=steps, tol=0.0, learningRate=0.3, stateDir=folder, stateEvery=2
        ).fit(df)

    folder = str(tmp_path / "state")
    whole = fit(9, "")
    assert len(fit(5, folder).getOrDefault("lossHistory")) == 5
    states = spark.read.parquet(folder)
    assert sorted(r.step for r in states.collect()) == [2, 4, 5]
    again = fit(9, folder)
    for name in ("weights", "intercept", "lossHistory"):
        assert again.getOrDefault(name) == pytest.approx(whole.getOrDefault(name), rel=1e-12)
    other = GradientDescentLogistic(numericCols=["a"], maxIter=3, tol=0.0, stateDir=folder).fit(df)
    assert len(other.getOrDefault("lossHistory")) == 3  # other settings don't take up that state


def wide_rows(spark, n=240):
    """A hot level with a third of the rows, many rare ones, nulls, and numbers."""
    rng = np.random.default_rng(5)
    stop = ["hot" if k % 3 == 0 else f"s{int(rng.integers(0, 60)):02d}" for k in range(n)]
    line = [None if k % 17 == 0 else "ABCDEFG"[int(rng.integers(0, 7))] for k in range(n)]
    a = rng.normal(size=n)
    y = (a + np.array([len(s) for s in stop]) - 3 + rng.normal(size=n) > 0).astype(int)
    rows = list(zip(map(float, a), stop, line, map(int, y), strict=True))
    return spark.createDataFrame(rows, "a double, stop string, line string, is_delayed int")


@pytest.mark.parametrize("joint", [False, True])
@pytest.mark.parametrize("limit", [5, 30])
def test_weights_in_a_table_equal_weights_on_the_driver(spark, joint, limit):
    df = wide_rows(spark)
    settings = dict(numeric=["a"], categorical=["stop", "line"], maxIter=4, learningRate=0.5, tol=0.0, alpha=0.01, biasInWeights=joint)
    near = models.fit_gradient_descent(df, **settings)
    wide = models.fit_gradient_descent(df, max_levels=limit, **settings)
    last = wide.stages[-1]
    assert isinstance(last, WideDescentModel)
    held = last.level_weights(spark).groupBy("held").count().collect()
    assert {r["held"] for r in held} == {True, False}
    one, other = ({r.feature: r.coefficient for r in models.coefficients(m, df).collect()} for m in (near, wide))
    assert one.keys() == other.keys()
    assert [other[k] for k in one] == pytest.approx(list(one.values()), rel=1e-9, abs=1e-12)
    assert last.getOrDefault("intercept") == pytest.approx(near.stages[-1].getOrDefault("intercept"), rel=1e-9)
    assert last.getOrDefault("lossHistory") == pytest.approx(near.stages[-1].getOrDefault("lossHistory"), rel=1e-9)
    odd = df.limit(20).unionByName(df.limit(5).withColumn("stop", F.lit("unseen")))
    scores = [sorted(r.p for r in models.score(m, odd).select(F.col("pred_proba_delayed").alias("p")).collect()) for m in (near, wide)]
    assert scores[1] == pytest.approx(scores[0], rel=1e-9)


@pytest.mark.parametrize("tasks", [0, 32])
def test_weights_of_one_wide_column_lie_with_its_rows(spark, tmp_path, tasks, monkeypatch):
    """No step joins a table where one column alone is wide, resumed or not; weights are those on the driver."""
    monkeypatch.setattr(steps, "EXCHANGING_TASKS", tasks)
    monkeypatch.setattr(wide_descent, "HOT_ROWS", 70)
    monkeypatch.setattr(WideDescentLogistic, "_step", None)
    df = wide_rows(spark).repartition(3)
    settings = dict(numericCols=["a"], levelCols=["stop", "line"], learningRate=0.5, tol=0.0, biasInWeights=True)
    fit = lambda most, **more: WideDescentLogistic(maxIter=most, heldLevels=30, **settings, **more).fit(df)
    whole, folder = fit(13), str(tmp_path / "state")
    fit(5, stateDir=folder, stateEvery=2)
    again = fit(13, stateDir=folder, stateEvery=2)
    found = {(r.block, r.level): (r.held, r.weight) for r in whole.level_weights(spark).collect()}
    assert [k for k, v in found.items() if k[0] == 0 and v[0]] == [(0, "hot")] and len(found) > 60
    assert {(r.block, r.level): r.weight for r in again.level_weights(spark).collect()} == pytest.approx({k: v[1] for k, v in found.items()}, rel=1e-12)
    monkeypatch.undo()
    joined = WideDescentLogistic(maxIter=13, heldLevels=5, **settings).fit(df)
    assert whole.getOrDefault("lossHistory") == pytest.approx(joined.getOrDefault("lossHistory"), rel=1e-9)
    assert {(r.block, r.level): r.weight for r in joined.level_weights(spark).collect()} == pytest.approx({k: v[1] for k, v in found.items()}, rel=1e-9)


def test_wide_descent_resumes_stops_saves_and_refuses(spark, tmp_path):
    df = wide_rows(spark, 90)

    def fit(steps, folder="", **more):
        return WideDescentLogistic(
            numericCols=["a"], levelCols=["stop", "line"], heldLevels=4, maxIter=steps, learningRate=0.5,
            stateDir=folder, stateEvery=2, weightsDir=str(tmp_path / "weights"), **{"tol": 0.0, **more},
        ).fit(df)

    folder = str(tmp_path / "state")
    whole = fit(5)
    fit(3, folder)
    assert sorted(r.step for r in spark.read.parquet(f"{folder}/states").collect()) == [2, 3]
    again = fit(5, folder)
    assert again.getOrDefault("lossHistory") == pytest.approx(whole.getOrDefault("lossHistory"), rel=1e-12)
    tables = [{(r.block, r.level): r.weight for r in m.level_weights(spark).collect()} for m in (whole, again)]
    assert tables[1] == pytest.approx(tables[0], rel=1e-12)
    assert len(fit(9, tol=10.0).getOrDefault("lossHistory")) == 1
    PipelineModel([again]).write().overwrite().save(str(tmp_path / "m"))
    loaded = PipelineModel.load(str(tmp_path / "m"))
    assert loaded.transform(df).select("prediction").collect() == again.transform(df).select("prediction").collect()
    with pytest.raises(ValueError, match="two classes"):
        WideDescentLogistic(numericCols=["a"], levelCols=["stop"]).fit(df.where("is_delayed = 1"))


@pytest.mark.parametrize("hot", [20, 1000])
def test_logistic_beyond_the_levels_of_a_driver_equals_the_one_on_it(spark, hot, monkeypatch):
    """Rare levels' weights never reach the driver, the optimum is the same; two such columns are refused."""
    monkeypatch.setattr(wide_logistic.fit, "__defaults__", (1000, hot))
    monkeypatch.setattr(wide_logistic, "PACKED_ROWS", 50)
    df = wide_rows(spark, 400).repartition(3)
    near = models.fit_logistic(df, numeric=["a"], categorical=["stop", "line"])
    wide = models.fit_logistic(df, numeric=["a"], categorical=["stop", "line"], max_levels=30)
    levels = wide.stages[-1].level_weights(spark).collect()
    assert len(levels) == len({(r.block, r.level) for r in levels}) == len(wide.stages[-1].level_weights(spark).distinct().collect())
    assert any(r.held and r.level == "hot" for r in levels) == (hot == 20)
    odd = df.unionByName(df.where("a > 1.5").withColumn("stop", F.lit("unseen")).withColumn("line", F.lit(None).cast("string")))
    scores = [models.score(m, odd).orderBy("a", "stop").select("pred_proba_delayed").toPandas() for m in (near, wide)]
    assert np.abs(scores[0] - scores[1]).to_numpy().max() < 1e-3
    names = [{r.feature for r in models.coefficients(m, df).collect()} for m in (near, wide)]
    assert len(names[0]) == len(names[1])
    with pytest.raises(encoding.TooManyLevels, match="line"):
        models.fit_logistic(df, numeric=["a"], categorical=["stop", "line"], max_levels=3)


def test_start_weights_are_those_of_one_generator_per_block():
    block = gradient_descent.START_BLOCK
    all_of = gradient_descent.start_weights(7, 0.1, np.arange(2 * block + 5))
    assert all_of[:block] == pytest.approx(np.random.default_rng(7).normal(0, 0.1, block))
    some = np.array([2 * block + 1, 3, block])
    assert gradient_descent.start_weights(7, 0.1, some) == pytest.approx(all_of[some])


def test_equal_rows_are_folded(spark):
    rows = [(1.0, 0, 1), (1.0, 0, 0), (2.0, 1, 0), (2.0, 1, 1), (3.0, 0, 1)]
    one = spark.createDataFrame(rows * 3, "a double, c int, is_delayed int")
    many = spark.createDataFrame(rows * 300, "a double, c int, is_delayed int").repartition(7)
    fits = [GradientDescentLogistic(numericCols=["a"], indexCols=["c"], maxIter=20).fit(d) for d in (one, many)]
    assert fits[0].getOrDefault("weights") == pytest.approx(fits[1].getOrDefault("weights"))


def test_descent_stops_and_refuses(spark, tmp_path):
    df = spark.createDataFrame([(1.0, 1), (-1.0, 0)], "a double, is_delayed int")
    model = GradientDescentLogistic(numericCols=["a"], maxIter=50, tol=10.0).fit(df)
    assert len(model.getOrDefault("lossHistory")) == 1
    with pytest.raises(ValueError, match="two classes"):
        GradientDescentLogistic(numericCols=["a"]).fit(df.where("a > 0"))
    PipelineModel([model]).write().overwrite().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m")).stages[0]
    assert again.getOrDefault("weights") == model.getOrDefault("weights")


def test_descent_ignores_unseen_levels(spark):
    df = bus_rows(spark)
    model = models.fit_gradient_descent(df, maxIter=2)
    odd = df.withColumn("route_id", F.lit("99"))
    assert models.score(model, odd).where("pred_proba_delayed is null").count() == 0


def forest_rows(spark):
    rows = bus_rows(spark, 200).withColumnsRenamed({"is_delayed": "label"})
    return rows.withColumn("wind_dir_deg", F.lit(10.0)).withColumn("id", F.monotonically_increasing_id())


def test_forest(spark):
    df = forest_rows(spark)
    settings = models.ForestSettings(trees=5, max_depth=4, min_leaf=5, top_stops=3)
    model = models.fit_forest(df, "label", settings)
    importances = models.feature_importances(model, spark).collect()
    assert len(importances) == 22 and sum(r["importance"] for r in importances) == pytest.approx(1.0)
    scored = models.evaluation_table(model, df.withColumn("stop_id", F.lit("unseen")), "label", argmax=True)
    assert scored.where("y_proba between 0 and 1").count() == 200


def test_parameter_mapping():
    names = [models.feature_subset(v) for v in (None, "auto", "SQRT", "log2", "5", 7, 0.5)]
    assert names == ["all", "all", "sqrt", "log2", "5", "7", "0.5"]
    for wrong in ("most", "-1", "0", ""):
        with pytest.raises(ValueError, match="max_features"):
            models.feature_subset(wrong)
    assert [models.rows_per_tree(v, 10) for v in (None, 0, 0.3, 1, 4, 40)] == [1.0, 1.0, 0.3, 1.0, 0.4, 1.0]
    with pytest.raises(ValueError, match="max_samples"):
        models.rows_per_tree(-1, 10)


def test_one_half_is_delayed_for_the_scorer_only(spark):
    df = spark.createDataFrame([(0.5,), (0.49,), (0.51,)], "pred_proba_delayed double")
    assert [r["pred_label"] for r in models.label_at(df).collect()] == [1, 0, 1]


def test_two_stages_learn_something(spark):
    from headway.operators import metrics
    from headway.plans import tables as D
    from headway.plans.table_queries import labelled_shipments

    rows = labelled_shipments(spark, "/root/testdata/sf0.001")
    run = training.train_gradient_descent(rows, 5.0, D.SHIPMENT_SPLITS, maxIter=3, learningRate=0.5)
    summary = run.summary.first()
    assert summary["rows_train"] + summary["rows_val"] == summary["rows_train_val"]
    document = training.metrics_document(run).collect()
    assert len(document) == 1 and document[0]["test"]["support"] == summary["rows_test"]
    assert metrics.overall(run.test).first()["support"] == summary["rows_test"]


def test_medians(spark):
    df = spark.createDataFrame([(float(i % 7), i * 0.5, None) for i in range(100)], "a double, b double, c double")
    want = {"a": 3.0, "b": 24.75}
    assert encoding.fit_medians(df, ["a", "b", "c"]) == want


def test_samples_and_empty_splits_of_a_protocol(spark):
    df = forest_rows(spark).withColumn("service_date", F.lit("2023-02-01").cast("date"))
    settings = models.ForestSettings(trees=2, max_depth=3, min_leaf=5, top_stops=3)
    run = training.train_forest(df, settings, sample=training.Sample(max_rows=150, keys=["stop_id", "hour"]), rejected=7)
    summary = run.summary.first()
    assert summary["rows_rejected"] == 7 and summary["rows_val"] == 0 and summary["split_date_0"] == "2023-01-01"
    assert 0 < summary["rows_train"] <= 150
    document = training.metrics_document(run).first()
    assert document["validation"]["support"] == 0 and document["validation"]["roc_auc"] is None
    half = training.Sample(fraction=0.5, seed=1, keys=["stop_id", "hour"])
    assert half.of(df).count() == half.of(df).count() < df.count()
