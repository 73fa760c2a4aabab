"""Queries for fitted transforms, models and scoring."""

from __future__ import annotations

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from headway.functions import text
from headway.operators.cleaning import rejected_delays
from headway.operators import encoding, features, metrics, models, profiles, splits
from headway.plans import oracle
from headway.plans import tables as D
from headway.plans import training
from headway.plans.profile_queries import late_trips
from headway.plans.registry import query
from headway.plans.table_queries import labelled_shipments, weathered
from headway.session import materialise

CUT = "DATE '2024-01-21'"
LATE = "CAST(CASE WHEN delay_minutes >= 5.0 THEN 1 ELSE 0 END AS BIGINT)"


def late_split(spark, folder):
    return splits.split_at(late_trips(spark, folder), D.TRIP_SPLIT)


# ---- fitted transforms -----------------------------------------------------

FILLED = ["air_temp_c", "precip_mm", "cloud_cover"]


@query(
    "SELECT trip_id, "
    + ", ".join(
        f"round(coalesce({c}, (SELECT median({c}) FROM weathered WHERE service_date < {CUT})), 6) AS {c}" for c in FILLED
    )
    + " FROM weathered",
    ("weathered",),
)
def median_imputation(spark, folder):
    train, _ = late_split(spark, folder)
    rows = weathered(spark, folder).select("trip_id", *FILLED)
    return encoding.fill_medians(rows, encoding.fit_medians(train, FILLED))


SCALED = ["hour", "weekday", "time_point_order", "delay_minutes"]


@query(
    "SELECT trip_id, "
    + ", ".join(
        f"round(({c} - (SELECT avg({c}) FROM trips WHERE service_date < {CUT})) / "
        f"(SELECT stddev_pop({c}) FROM trips WHERE service_date < {CUT}), 6) AS {c}"
        for c in SCALED
    )
    + f" FROM trips WHERE service_date >= {CUT}",
    ("trips",),
)
def standardised(spark, folder):
    train, test = splits.split_at(D.trips(spark, folder), D.TRIP_SPLIT)
    return encoding.scale(test.select("trip_id", *SCALED), encoding.fit_scaling(train, SCALED))


@query(
    f"""SELECT trip_id, coalesce(point_type, (SELECT point_type FROM trips WHERE service_date < {CUT} AND point_type IS NOT NULL
    GROUP BY 1 ORDER BY count(*) DESC, point_type LIMIT 1)) AS point_type FROM trips WHERE service_date >= {CUT}""",
    ("trips",),
)
def most_frequent_imputation(spark, folder):
    train, test = splits.split_at(D.trips(spark, folder), D.TRIP_SPLIT)
    _, filled = encoding.fill_most_frequent(train, ["point_type"], test)
    return filled.select("trip_id", "point_type")


CODES = f"""codes AS (SELECT weather_condition, CAST(row_number() OVER (ORDER BY weather_condition) - 1 AS BIGINT) AS code
    FROM (SELECT DISTINCT weather_condition FROM weathered WHERE service_date < {CUT} AND weather_condition IS NOT NULL))"""


@query(
    f""", {CODES} SELECT trip_id, coalesce(code, -1) AS slot FROM weathered LEFT JOIN codes USING (weather_condition)""",
    ("weathered",),
)
def one_hot_slots(spark, folder):
    """The position of the one in each row's one-hot vector, -1 for the zero vector."""
    train, _ = late_split(spark, folder)
    stages = encoding.fit_one_hot(train, ["weather_condition"])
    rows = PipelineModel(list(stages)).transform(weathered(spark, folder))
    hot = vector_to_array("weather_condition_onehot")
    return rows.select("trip_id", (F.array_position(hot, F.lit(1.0)) - 1).alias("slot"))


@query(
    f""", {CODES} SELECT trip_id, CASE WHEN weather_condition IS NULL THEN -2 ELSE coalesce(code, -1) END AS weather_condition_code
    FROM weathered LEFT JOIN codes USING (weather_condition)""",
    ("weathered",),
)
def ordinal_codes(spark, folder):
    train, _ = late_split(spark, folder)
    table = encoding.ordinal_table(train, "weather_condition")
    rows = weathered(spark, folder).select("trip_id", "weather_condition")
    return encoding.apply_ordinal(rows, "weather_condition", table).drop("weather_condition")


TARGET = f"""prior AS (SELECT avg({LATE}) AS prior FROM trips WHERE service_date < {CUT}),
    means AS (SELECT stop_id, count(*) AS n, avg({LATE}) AS mean, sum({LATE}) AS total FROM trips WHERE service_date < {CUT} GROUP BY 1)"""


@query(
    f""", {TARGET} SELECT trip_id, round(coalesce(prior * (1 - 1 / (1 + exp(-(n - 20) / 10.0))) + mean / (1 + exp(-(n - 20) / 10.0)), prior), 6)
    AS stop_id_target FROM trips CROSS JOIN prior LEFT JOIN means USING (stop_id)""",
    ("trips",),
)
def target_encoding(spark, folder):
    train, _ = late_split(spark, folder)
    table, prior = encoding.target_table(train, "stop_id", "is_delayed")
    rows = D.trips(spark, folder).select("trip_id", "stop_id")
    return encoding.apply_target(rows, "stop_id", table, prior).drop("stop_id")


@query(
    f""", {TARGET} SELECT trip_id, round(coalesce((total + 10 * prior) / (n + 10), prior), 6) AS stop_id_target
    FROM trips CROSS JOIN prior LEFT JOIN means USING (stop_id)""",
    ("trips",),
)
def target_encoding_m_estimate(spark, folder):
    train, _ = late_split(spark, folder)
    table, prior = encoding.target_table(train, "stop_id", "is_delayed", method="m_estimate")
    rows = D.trips(spark, folder).select("trip_id", "stop_id")
    return encoding.apply_target(rows, "stop_id", table, prior).drop("stop_id")


@query(
    f"""SELECT trip_id, CASE WHEN stop_id IN (SELECT stop_id FROM trips WHERE service_date < {CUT} GROUP BY 1
    ORDER BY count(*) DESC, stop_id LIMIT 300) THEN stop_id ELSE 'other' END AS stop_id FROM trips""",
    ("trips",),
)
def frequent_stops(spark, folder):
    train, _ = splits.split_at(D.trips(spark, folder), D.TRIP_SPLIT)
    return encoding.bucket_by_table(D.trips(spark, folder).select("trip_id", "stop_id"), "stop_id", train, 300)


@query(
    """SELECT label, n, round(total / (2.0 * n), 6) AS class_weight FROM
    (SELECT label, count(*) AS n, CAST(sum(count(*)) OVER () AS DOUBLE) AS total FROM labelled WHERE split = 'train' GROUP BY 1)""",
    ("labelled",),
)
def class_weights(spark, folder):
    train = splits.training_rows(labelled_shipments(spark, folder), 1)
    weights = encoding.class_weights(train, "label")
    return encoding.add_class_weight(train, "label", weights).groupBy("label", "class_weight").agg(
        F.count(F.lit(1)).alias("n")
    )


@query(
    f"""SELECT trip_id, round({" + ".join(
        f"(coalesce({c}, (SELECT median({c}) FROM late)) - (SELECT avg(coalesce({c}, (SELECT median({c}) FROM late))) FROM late))"
        f" / (SELECT stddev_pop(coalesce({c}, (SELECT median({c}) FROM late))) FROM late)"
        for c in ["hour", "air_temp_c"]
    )} + 2, 6) AS total FROM late""",
    ("late",),
)
def assembled_vectors(spark, folder):
    """Sum of each row's feature vector: two scaled numbers and two one-hot blocks."""
    rows = late_trips(spark, folder)
    stages, scaled, _ = models.linear_stages(rows, ["hour", "air_temp_c"], ["direction_id", "route_id"])
    vectors = PipelineModel(models.assembled(stages, scaled)).transform(rows)
    total = F.aggregate(vector_to_array("features"), F.lit(0.0), lambda a, x: a + x)
    return vectors.select("trip_id", total.alias("total"))


# ---- gradient descent ------------------------------------------------------

STEPS, RATE, ALPHA = 3, 0.5, 0.001


# The joint-bias run: random start weights, and a norm that is reached before the last step.
JOINT_STEPS, JOINT_SCALE, JOINT_TOL = 6, 0.3, 0.12


def joint_start():
    """Bias and weights as the estimator draws them with its default seed."""
    return np.random.default_rng(42).normal(0.0, JOINT_SCALE, len(oracle.descent_names()) + 1)


def descent(rows, **settings):
    settings = {"maxIter": STEPS, "tol": 0.0, "startScale": 0.0} | settings
    rows = rows.withColumn("point_type", text.category(F.col("point_type")))
    return models.fit_gradient_descent(
        rows, "is_delayed", oracle.DESCENT_NUMERIC, list(oracle.DESCENT_LEVELS),
        learningRate=RATE, alpha=ALPHA, **settings,
    ), rows


def weights_table(model, rows):
    last = model.stages[-1]
    extra = [("bias", last.getOrDefault("intercept"))]
    extra += [(f"loss_{i}", v) for i, v in enumerate(last.getOrDefault("lossHistory"), start=1)]
    named = models.coefficients(model, rows).toDF("name", "value")
    return named.unionByName(rows.sparkSession.createDataFrame(extra, "name string, value double"))


@query(oracle.descent_weights(STEPS, RATE, ALPHA, 1e-12))
def descent_weights(spark, folder):
    model, rows = descent(late_trips(spark, folder))
    return weights_table(model, rows)


@query(oracle.descent_weights(STEPS, RATE, ALPHA, 1e-12))
def descent_weights_any_cardinality(spark, folder):
    """As if the driver could hold no more than three levels a column: the others' weights lie in a table."""
    model, rows = descent(late_trips(spark, folder), max_levels=3)
    return weights_table(model, rows)


@query(oracle.descent_stopped(JOINT_STEPS, RATE, ALPHA, 1e-15, joint_start(), JOINT_TOL))
def descent_weights_joint_bias(spark, folder):
    """The bias starts at random like a weight and counts in the norm that ends the descent."""
    model, rows = descent(
        late_trips(spark, folder), biasInWeights=True, eps=1e-15, maxIter=JOINT_STEPS,
        startScale=JOINT_SCALE, tol=JOINT_TOL,
    )
    return weights_table(model, rows)


@query(oracle.descent_scores(STEPS, RATE, ALPHA, 1e-12))
def descent_scores(spark, folder):
    model, rows = descent(late_trips(spark, folder))
    return model.transform(rows).select(
        "trip_id",
        vector_to_array("rawPrediction")[1].alias("score"),
        vector_to_array("probability")[1].alias("probability"),
        F.col("prediction").cast("long").alias("predicted"),
    )


@query(oracle.descent_ranking(STEPS, RATE, ALPHA, 1e-12, 20))
def coefficient_ranking(spark, folder):
    model, rows = descent(late_trips(spark, folder))
    return profiles.largest_by_size(models.coefficients(model, rows), "coefficient", "feature", 20)


# ---- scoring ---------------------------------------------------------------


@query(
    """SELECT trip_id, round(y_proba, 6) AS pred_proba_delayed,
    CAST(CASE WHEN y_proba >= 0.7 THEN 1 ELSE 0 END AS BIGINT) AS pred_label FROM scored""",
    ("scored",),
)
def threshold_labels(spark, folder):
    rows = D.scored_trips(spark, folder).select("trip_id", F.col("y_proba").alias("pred_proba_delayed"))
    return models.label_at(rows, 0.7)


# ---- models without an SQL twin --------------------------------------------


def model_rows(spark, folder):
    """Labelled shipments, written once: fitting the encoders alone reads them several times."""
    return materialise(labelled_shipments(spark, folder), "labelled")


def scalar_metrics(run):
    """Validation and test metrics as two rows."""
    parts = [
        metrics.evaluation(table).drop("classification_report", "confusion_matrix").withColumn("split", F.lit(name))
        for name, table in (("val", run.validation), ("test", run.test))
    ]
    return parts[0].unionByName(parts[1])


@query()
def logistic_two_stage(spark, folder):
    rows = labelled_shipments(spark, folder)
    return scalar_metrics(training.train_logistic(rows, 5.0, D.SHIPMENT_SPLITS))


OPTIMUM_NUMERIC, OPTIMUM_CATEGORICAL = ["hour", "air_temp_c", "precip_mm"], ["direction_id", "point_type", "season"]


@query(
    " UNION ALL ".join(
        [f"SELECT '{c}_scaled' AS feature, CAST(0 AS DOUBLE) AS slope" for c in OPTIMUM_NUMERIC]
        + [
            f"SELECT DISTINCT '{c}_filled_onehot_' || {c}, CAST(0 AS DOUBLE) FROM labelled WHERE split = 'train'"
            for c in OPTIMUM_CATEGORICAL[:2]
        ]
        + [f"SELECT 'season_filled_onehot_{k}', CAST(0 AS DOUBLE)" for k in range(1, 5)]
    ),
    ("labelled",),
)
def logistic_optimum(spark, folder):
    """The slope of the penalised loss at the fitted weights: nothing at the one optimum."""
    rows = features.linear_features(labelled_shipments(spark, folder), 5.0)
    train = materialise(splits.training_rows(rows, 1), "optimum")
    model = models.fit_logistic(train, numeric=OPTIMUM_NUMERIC, categorical=OPTIMUM_CATEGORICAL)
    slopes = models.logistic_slopes(model, train, "is_delayed")
    return slopes.withColumn("slope", F.round("slope", 3) + F.lit(0.0))


@query()
def descent_two_stage(spark, folder):
    """Both stages under the published settings: 800 steps at most, or a norm of the slopes below 1e-4."""
    rows = labelled_shipments(spark, folder)
    return scalar_metrics(training.train_gradient_descent(rows, 5.0, D.SHIPMENT_SPLITS))


@query()
def forest_two_stage(spark, folder):
    rows = labelled_shipments(spark, folder)
    return scalar_metrics(training.train_forest(rows, FOREST, D.SHIPMENT_SPLITS))


# The published parameters: 100 trees of depth 14.
FOREST = models.ForestSettings()


@query()
def forest_importances(spark, folder):
    train = splits.training_rows(model_rows(spark, folder), 1)
    return models.feature_importances(models.fit_forest(train, "label", FOREST), spark)


@query(
    """SELECT split, count(*) AS support, round(avg(label), 6) AS positive_rate, count(*) AS with_probability,
    CAST(0 AS BIGINT) AS other_label, CAST(22 AS BIGINT) AS n_features, CAST(1 AS DOUBLE) AS importance
    FROM labelled GROUP BY split""",
    ("labelled",),
)
def forest_determined(spark, folder):
    """What the data fix of a forest: rows and rates per split, probabilities, labels at one half, summed importance."""
    rows = model_rows(spark, folder)
    model = models.fit_forest(splits.training_rows(rows, 1), "label", FOREST)
    parts = models.feature_importances(model, spark).agg(
        F.count(F.lit(1)).alias("n_features"), F.round(F.sum("importance"), 6).alias("importance")
    ).first()
    scored = models.score(model, rows)
    agrees = (F.col("pred_proba_delayed") >= 0.5).cast("int") == F.col("pred_label")
    return scored.groupBy("split").agg(
        F.count(F.lit(1)).alias("support"),
        F.avg("label").alias("positive_rate"),
        F.count_if(F.col("pred_proba_delayed").between(0, 1)).alias("with_probability"),
        F.count_if(~agrees).alias("other_label"),
        F.lit(parts["n_features"]).alias("n_features"),
        F.lit(parts["importance"]).alias("importance"),
    )


@query()
def forest_scores(spark, folder):
    """All rows scored by a forest fitted on the training rows."""
    rows = model_rows(spark, folder)
    model = models.fit_forest(splits.training_rows(rows, 1), "label", FOREST)
    return models.score(model, rows).select(
        "service_date", "route_id", "stop_id", "time_point_order", "label", "pred_proba_delayed", "pred_label"
    )


@query()
def notebook_logistic(spark, folder):
    rows = D.shipments(spark, folder).withColumn("delay_minutes", F.col("delay_seconds") / 60.0)
    _, evaluated = training.train_notebook_logistic(rows, "2000-01-01")
    return metrics.overall(evaluated)


@query(
    """SELECT count(*) AS rows_total, count(*) FILTER (split = 'train') AS rows_train,
    count(*) FILTER (split = 'val') AS rows_val, count(*) FILTER (split = 'test') AS rows_test,
    count(*) FILTER (split <> 'test') AS rows_train_val,
    round(avg(label) FILTER (split = 'train'), 6) AS positive_rate_train,
    round(avg(label) FILTER (split = 'val'), 6) AS positive_rate_val,
    round(avg(label) FILTER (split = 'test'), 6) AS positive_rate_test,
    round(avg(label) FILTER (split <> 'test'), 6) AS positive_rate_train_val,
    (SELECT count(*) FILTER (delay_seconds IS NULL OR abs(delay_seconds) > 7200) FROM shipments) AS rows_rejected,
    CAST(5 AS DOUBLE) AS delay_threshold_minutes, '1999-01-01' AS split_date FROM labelled""",
    ("labelled", "shipments"),
)
def run_summary(spark, folder):
    """What a training run reports beside its metrics."""
    rejected = rejected_delays(D.shipments(spark, folder)).first()["rows_rejected"]
    return training.split_summary(
        labelled_shipments(spark, folder), "label", rejected, delay_threshold_minutes=5.0, split_date="1999-01-01"
    )


@query()
def notebook_descent(spark, folder):
    rows = D.shipments(spark, folder).withColumn("delay_minutes", F.col("delay_seconds") / 60.0)
    _, evaluated = training.train_notebook_descent(rows, "2000-01-01")
    return metrics.overall(evaluated)


@query()
def legacy_logistic(spark, folder):
    rows = weathered(spark, folder)
    _, evaluated = training.train_legacy_logistic(rows, "trip_id")
    return metrics.overall(evaluated)
