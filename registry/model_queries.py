"""Features, training, tuning, scoring."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Window
from pyspark.sql import functions as F

from hexledger.functions import cells
from hexledger.operators import features, hierarchy, models, rows, search
from hexledger.plans import classification, regression
from hexledger.session import materialize, scratch_path
from registry.bindings import Tables
from registry.core import query
from registry.join_queries import CUSTOMER_CELL_SQL, CUSTOMER_SQL, rounded_std

_CAPPED = "SELECT * FROM tx WHERE \"sum\" <= 200000"
_TRAINING_SQL = f"""
    SELECT customer_id, h3_09, coalesce(total_transactions, 0) AS total_transactions,
           coalesce(unique_mcc_count, 0) AS unique_mcc_count,
           coalesce(avg_transaction_amount, 0) AS avg_transaction_amount,
           coalesce(std_transaction_amount, 0) AS std_transaction_amount,
           CAST(coalesce(max_time_slot, 0) AS smallint) AS max_time_slot,
           CAST(coalesce(min_time_slot, 0) AS smallint) AS min_time_slot,
           coalesce(location_transaction_count, 0) AS location_transaction_count,
           coalesce(location_avg_amount, 0) AS location_avg_amount,
           coalesce(location_unique_mcc_count, 0) AS location_unique_mcc_count, lat, lon,
           coalesce(tags_key, 'Unknown') AS tags_key
    FROM withdrawals LEFT JOIN ({CUSTOMER_SQL.replace('FROM tx', 'FROM (' + _CAPPED + ')')}) USING (customer_id)
    LEFT JOIN ({CUSTOMER_CELL_SQL.replace('FROM tx', 'FROM (' + _CAPPED + ')')}) USING (customer_id, h3_09)
    JOIN locations USING (h3_09) LEFT JOIN cell_tags USING (h3_09)"""


@query(
    "tokenize",
    """SELECT id, array_to_string(string_split_regex(lower(upper(place_name)), '\\s'), '|') AS tokens FROM places""",
)
def _(t):
    loud = t.places.select("id", F.upper("place_name").alias("text"))
    return features.tokenize(loud, "text", "words").select("id", F.concat_ws("|", "words").alias("tokens"))


# Which bucket a term falls into is the hash's own affair; that every term is counted once is not.
@query(
    "hashing_tf",
    """SELECT h3_09_center AS h3_09, 25 AS n_buckets,
              CAST(sum(len(string_split_regex(place_name, '\\s'))) AS double) AS n_terms FROM places GROUP BY 1""",
)
def _(t):
    vectors = features.cell_tag_vectors(t.places).select("h3_09", vector_to_array("tags_features").alias("v"))
    total = F.aggregate("v", F.lit(0.0), lambda a, x: a + x)
    return vectors.select("h3_09", F.size("v").alias("n_buckets"), total.alias("n_terms"))


_SCALED = ["sum", "avg", "min", "max"]


@query(
    "standard_scale",
    "SELECT customer_id, h3_09, datetime_id, mcc_code, "
    + ", ".join(f'round("{c}" / (SELECT stddev_samp("{c}") FROM tx), 6) AS {c}_scaled' for c in _SCALED)
    + " FROM tx",
)
def _(t):
    scaled = features.scaled_columns(t.transactions, _SCALED)
    return scaled.select(
        "customer_id",
        "h3_09",
        "datetime_id",
        "mcc_code",
        *[F.round(f"{c}_scaled", 6).alias(f"{c}_scaled") for c in _SCALED],
    )


@query(
    "assemble",
    "SELECT h3_09, customer_id, "
    + ", ".join(f'CAST(coalesce("{c}", 0) AS double) AS slot_{c}' for c in features.CLASSIFICATION_FEATURES)
    + " FROM tx",
)
def _(t):
    assembled = features.assemble(t.transactions.na.fill(0, subset=["std"]), features.CLASSIFICATION_FEATURES)
    slots = vector_to_array("features")
    return assembled.select(
        "h3_09",
        "customer_id",
        *[slots[i].alias(f"slot_{c}") for i, c in enumerate(features.CLASSIFICATION_FEATURES)],
    )


@query(
    "string_index",
    """SELECT h3_09, CAST(row_number() OVER (ORDER BY count(*) DESC, h3_09) - 1 AS double) AS label
       FROM tx GROUP BY h3_09""",
)
def _(t):
    cells = t.transactions.select("h3_09")
    return features.string_index(cells, "h3_09", "label")


@query("index_to_string", "SELECT h3_09, h3_09 AS decoded FROM withdrawals")
def _(t):
    cells = t.withdrawals.select("h3_09")
    labels = features.string_index(cells, "h3_09", "label")
    indexed = cells.join(labels, "h3_09")
    return features.index_to_string(indexed, "label", "decoded", labels).drop("label")


@query("training_set", _TRAINING_SQL)
def _(t):
    capped = rows.amount_cap(t.transactions)
    return rounded_std(features.training_set(t.withdrawals, capped, t.locations, t.places))


@query(
    "classification_set",
    """SELECT h3_09, customer_id, datetime_id, "count", "sum", "avg", "min", "max", coalesce(std, 0) AS std,
              count_distinct, mcc_code, coalesce(tags_key, 'Не известно') AS tags_key
       FROM tx JOIN withdrawals USING (h3_09, customer_id) JOIN locations USING (h3_09)
       LEFT JOIN cell_tags USING (h3_09)""",
)
def _(t):
    return features.classification_set(t.withdrawals, t.transactions, t.locations, t.places)


@lru_cache(maxsize=4)
def _regression_split(app: str, sf_dir: str, spark):
    t = Tables(spark, sf_dir)
    return regression.prepared_split(t.transactions, t.withdrawals, t.locations, t.places)


@lru_cache(maxsize=4)
def _classification_split(app: str, sf_dir: str, spark):
    t = Tables(spark, sf_dir)
    return classification.prepared_split(t.transactions, t.withdrawals, t.locations, t.places)


def regression_split(t):
    return _regression_split(t.spark.sparkContext.applicationId, t.sf_dir, t.spark)


def classification_split(t):
    return _classification_split(t.spark.sparkContext.applicationId, t.sf_dir, t.spark)


# The split of the training rows by the md5 of their key, as in load_or_build.
_SPLIT_SQL = """
    SELECT *, CAST('0x' || substr(md5(concat_ws('|', CAST(customer_id AS varchar), h3_09)), 1, 8) AS bigint) % 100 < 80
              AS in_train FROM ({rows})"""
_UNROUNDED_SQL = _TRAINING_SQL.replace('round(stddev_samp("sum"), 4)', 'stddev_samp("sum")')
_SCALED_SQL = ", ".join(
    f"round(coalesce({c} / nullif((SELECT stddev_samp({c}) FROM s WHERE in_train), 0), 0), 6) AS {c}"
    for c in features.NUMERIC_FEATURES
)


@query(
    "feature_pipeline",
    f"""WITH s AS ({_SPLIT_SQL.format(rows=_UNROUNDED_SQL)}), n AS (
            SELECT h3_09_center AS h3_09, CAST(sum(len(string_split_regex(place_name, '\\s'))) AS double) AS terms
            FROM places GROUP BY 1)
        SELECT customer_id, h3_09, {_SCALED_SQL}, coalesce(terms, 1) AS tag_terms
        FROM s LEFT JOIN n USING (h3_09)""",
)
def _(t):
    train, test = regression_split(t)
    names = features.feature_names(train)
    slots = train.unionByName(test).select("customer_id", "h3_09", vector_to_array("features").alias("f"))
    at = {n: F.col("f")[i] for i, n in enumerate(names)}
    tags = [n for n in names if n not in features.NUMERIC_FEATURES]
    return slots.select(
        "customer_id",
        "h3_09",
        *[F.round(at[n], 6).alias(n) for n in features.NUMERIC_FEATURES],
        sum((at[n] for n in tags), F.lit(0.0)).alias("tag_terms"),
    )


# A fit whose predictions must average to the labels' mean over the rows it was fitted on: a free intercept, or
# leaves that are means (the first boosted tree predicts them, the others fit what is left, which sums to 0).
_MEAN_KEEPING = ("linear", "decision_tree", "gbt")
_POSITION_ROWS = "SELECT customer_id, h3_09, lat, lon FROM withdrawals JOIN locations USING (h3_09)"


def _train_sql(kind):
    """The error of the constant prediction, and what the fitted predictions must average to."""
    mean = "round(avg({c}) FILTER (in_train), 6)" if kind in _MEAN_KEEPING else "CAST(NULL AS double)"
    parts = " UNION ALL ".join(
        f"""SELECT '{kind}' AS model, '{c}' AS coord, count(*) FILTER (in_train) AS n_train,
                   count(*) FILTER (NOT in_train) AS n_test,
                   round(avg(abs({c} - (SELECT avg({c}) FROM s WHERE in_train))) FILTER (NOT in_train), 6)
                       AS baseline_mae, {mean.format(c=c)} AS mean_fitted, true AS fits_as_mean,
                   true AS mae_is_near_or_below FROM s"""
        for c in ("lon", "lat")
    )
    return f"WITH s AS ({_SPLIT_SQL.format(rows=_POSITION_ROWS)}) {parts}"


def _train(kind):
    def run(t):
        train, test = regression_split(t)
        fitted = models.train_coordinates(train, test, kind)
        on_train = fitted.lat.transform(fitted.lon.transform(train))
        checks = [
            F.struct(
                F.lit(c).alias("coord"),
                F.round(F.avg(f"predicted_{c}"), 6).alias("mean_fitted"),
                # No worse, if a penalty leaves nothing but the mean.
                (F.avg(F.pow(F.col(f"predicted_{c}") - F.col(c), 2)) <= F.var_pop(c) * (1 + 1e-9)).alias("fits_as_mean"),
                F.count("*").alias("n_train"),
            )
            for c in ("lon", "lat")
        ]
        held = on_train.agg(F.array(*checks).alias("c")).select(F.inline("c"))
        scored = test.agg(F.count("*").alias("n_test")).scalar()
        mean = F.col("mean_fitted") if kind in _MEAN_KEEPING else F.lit(None).cast("double")
        return fitted.metrics.join(held, "coord").select(
            "model",
            "coord",
            "n_train",
            scored.alias("n_test"),
            F.round("baseline_mae", 6).alias("baseline_mae"),
            mean.alias("mean_fitted"),
            "fits_as_mean",
            (F.col("mae") <= 1.25 * F.col("baseline_mae")).alias("mae_is_near_or_below"),
        )

    return run


for _kind, _name in (
    ("linear", "train_linear"),
    ("decision_tree", "train_decision_tree"),
    ("random_forest", "train_random_forest"),
    ("gbt", "train_gbt"),
):
    query(_name, _train_sql(_kind))(_train(_kind))


def _fold_sql(*keys):
    """The fold of a row: the md5 of its key, as in with_folds."""
    text = ", ".join(f"CAST({k} AS varchar)" for k in keys)
    return f"CAST('0x' || substr(md5(concat_ws('|', 'fold', {text})), 1, 8) AS bigint) % 100 % {models.FOLDS}"


# The error of the mean of the other folds' rows: what a penalty beyond all bounds must come to.
_CONSTANT_SQL = f"""
    SELECT {{c}} AS y, fold, (SELECT avg({{c}}) FROM f o WHERE o.fold <> f.fold) AS mean FROM f"""
_FOLDS_SQL = f"""
    WITH s AS ({_SPLIT_SQL.format(rows=_POSITION_ROWS)}),
    f AS (SELECT *, {_fold_sql("customer_id", "h3_09")} AS fold FROM s WHERE in_train)"""
_OVERWHELMING = {"elasticNetParam": 1.0, "regParam": 1e6}


def _search_sql(grid, constant):
    """Every grid point of both coordinates over all folds; the constant point with its exact mean error."""
    names = ", ".join(f"('{search.named(p)}')" for p in search.grid_points(grid))
    parts = [
        f"""SELECT coord, settings, {models.FOLDS} AS folds, CAST(NULL AS double) AS avg_rmse, true AS measured
            FROM (VALUES ('lon'), ('lat')) c(coord), (VALUES {names}) n(settings)"""
    ]
    if constant:
        parts += [
            f"""SELECT '{c}' AS coord, '{search.named(constant)}' AS settings, {models.FOLDS} AS folds,
                       round(avg(rmse), 6) AS avg_rmse, true AS measured
                FROM (SELECT fold, sqrt(avg((y - mean) * (y - mean))) AS rmse
                      FROM ({_CONSTANT_SQL.format(c=c)}) GROUP BY fold)"""
            for c in ("lon", "lat")
        ]
    return _FOLDS_SQL + " UNION ALL ".join(parts)


def _searched(results, constant=None):
    error = F.when(F.col("settings") == (search.named(constant) if constant else ""), F.round("avg_metric", 6))
    return search.report(results).select(
        F.col("target").alias("coord"),
        "settings",
        "folds",
        error.alias("avg_rmse"),
        (F.col("avg_metric") > 0).alias("measured"),
    )


@query("cross_validate", _search_sql(models.GRIDS["linear"], _OVERWHELMING))
def _(t):
    train, _ = regression_split(t)
    path = scratch_path(t.spark, "search")
    models.regression_search(train, "linear", models.GRIDS["linear"], path)
    overwhelming = {k: [v] for k, v in _OVERWHELMING.items()}
    # The second search finds the first one's results under the same path and adds its own.
    return _searched(models.regression_search(train, "linear", overwhelming, path)[0], _OVERWHELMING)


@query("search_gbt", _search_sql(models.GRIDS["gbt"], None))
def _(t):
    train, _ = regression_split(t)
    return _searched(models.regression_search(train, "gbt", models.GRIDS["gbt"], scratch_path(t.spark, "search"))[0])


_CLASSIFIED_ROWS_SQL = """
    SELECT h3_09, customer_id, datetime_id, mcc_code,
           CAST('0x' || substr(md5(concat_ws('|', CAST(customer_id AS varchar), h3_09, CAST(datetime_id AS varchar),
                CAST(mcc_code AS varchar))), 1, 8) AS bigint) % 100 < 80 AS in_train
    FROM tx JOIN withdrawals USING (h3_09, customer_id) JOIN locations USING (h3_09)"""


def _scores_sql(*names, constant=None):
    """The rows scored, and for the model that can only name the most frequent training cell how often it is right."""
    parts = [
        f"""SELECT '{n}' AS model, count(*) AS n_scored, CAST(NULL AS bigint) AS n_right, true AS is_recounted
            FROM s WHERE NOT in_train"""
        for n in names
    ]
    if constant:
        parts.append(
            f"""SELECT '{constant}' AS model, count(*) AS n_scored,
                       count(*) FILTER (h3_09 = (SELECT h3_09 FROM s WHERE in_train GROUP BY h3_09
                                                 ORDER BY count(*) DESC, h3_09 LIMIT 1)) AS n_right,
                       true AS is_recounted FROM s WHERE NOT in_train"""
        )
    return f"WITH s AS ({_CLASSIFIED_ROWS_SQL}) " + " UNION ALL ".join(parts)


def _classified(t, estimator):
    train, test = classification_split(t)
    return models.train_classifier(models.classifier_stages(), estimator, train).transform(test)


def _scores(t, scored: dict, exact=()):
    """The accuracy of each model against its right predictions, counted in SQL from the stored scored rows."""
    rows = []
    for name, df in scored.items():
        stored = materialize(df.select("label", "prediction"), "scored")
        counted = t.spark.sql(
            "SELECT count(*) AS n, count_if(label = prediction) AS ok FROM {scored}", scored=stored
        ).first()
        right = abs(models.accuracy(stored) * counted.n - counted.ok) < 1e-6
        rows.append((name, counted.n, counted.ok if name in exact else None, right))
    return t.spark.createDataFrame(rows, "model string, n_scored long, n_right long, is_recounted boolean")


@query("train_logistic", _scores_sql("logistic", constant="constant"))
def _(t):
    constant = models.logistic(**_OVERWHELMING)
    fits = {"logistic": _classified(t, models.logistic()), "constant": _classified(t, constant)}
    return _scores(t, fits, exact=["constant"])


@query("train_rf_classifier", _scores_sql("rf_classifier", constant="constant"))
def _(t):
    # One tree without a split, fitted on all rows as they are.
    constant = models.rf_classifier(numTrees=1, maxDepth=0, bootstrap=False)
    fits = {"rf_classifier": _classified(t, models.rf_classifier()), "constant": _classified(t, constant)}
    return _scores(t, fits, exact=["constant"])


@query("train_mlp", _scores_sql("mlp"))
def _(t):
    train, test = classification_split(t)
    stages = models.classifier_stages()
    # One class per training cell and one for cells not seen.
    classes = train.select("h3_09").distinct().count() + 1
    network = models.mlp_pipeline(stages, len(features.CLASSIFICATION_FEATURES) + 2, classes)
    return _scores(t, {"mlp": network.fit(train).transform(test)})


# One network for each digit in which the training cells differ; every row gets a cell of full resolution.
@query(
    "train_cell_network",
    f"""WITH s AS ({_CLASSIFIED_ROWS_SQL})
        SELECT 'cell_network' AS model, count(*) AS n_scored, count(*) AS n_named, 7 AS widest_output,
               (SELECT count(*) FROM (SELECT r FROM s, range(1, 10) t(r) WHERE in_train GROUP BY r
                HAVING count(DISTINCT (CAST('0x' || h3_09 AS bigint) >> CAST(45 - 3 * r AS bigint)) & 7) > 1)) AS n_levels
        FROM s WHERE NOT in_train""",
)
def _(t):
    train, test = classification_split(t)
    # The label's own index is not needed: a cell is its digits.
    stages = [s for s in models.classifier_stages() if not s.hasParam("outputCol") or s.getOutputCol() != "label"]
    before = Pipeline(stages=stages).fit(train)
    network = hierarchy.fit_cell_network(before.transform(train))
    scored = network.transform(before.transform(test))
    full = cells.cell_is_valid(F.col("predicted_cell")) & (cells.cell_resolution(F.col("predicted_cell")) == 9)
    return scored.agg(F.count("*").alias("n_scored"), F.count_if(full).alias("n_named")).select(
        F.lit("cell_network").alias("model"),
        "n_scored",
        "n_named",
        F.lit(network.widest_output).alias("widest_output"),
        F.lit(len(network.levels)).cast("long").alias("n_levels"),
    )


def _comparison_sql():
    """Both published grids over all folds, and the rows that the two best models scored."""
    parts = [
        f"""SELECT '{n}' AS model, settings, {models.FOLDS} AS folds, n AS n_scored, true AS is_recounted,
                   true AS is_share FROM (VALUES {", ".join(f"('{search.named(p)}')" for p in search.grid_points(g))})
                   v(settings), (SELECT count(*) AS n FROM s WHERE NOT in_train)"""
        for n, g in classification.GRIDS.items()
    ]
    return f"WITH s AS ({_CLASSIFIED_ROWS_SQL}) " + " UNION ALL ".join(parts)


@query("model_comparison", _comparison_sql())
def _(t):
    train, test = classification_split(t)
    stages = models.classifier_stages()
    found, fitted = models.tune_classifiers(stages, classification.MAKERS, classification.GRIDS, train)
    scores = _scores(t, {name: model.transform(test) for name, model in fitted.items()})
    share = F.col("avg_metric").between(0, 1)
    return found.join(scores, F.col("target") == F.col("model")).select(
        "model", "settings", "folds", "n_scored", "is_recounted", share.alias("is_share")
    )


def _parameters_sql(*kinds):
    names = ", ".join(f"('{n}')" for n in [*(f"tag_feature_{i}" for i in range(25)), *features.NUMERIC_FEATURES])
    kinds_sql = ", ".join(f"('{k}', '{kind}')" for k, kind in kinds)
    return f"""SELECT feature, kind, model_type, coord_type, true AS is_number,
                      CASE WHEN kind = 'importance' THEN 1.0::double END AS total FROM (VALUES {names}) f(feature),
               (VALUES {kinds_sql}) k(model_type, kind), (VALUES ('lon'), ('lat')) c(coord_type)"""


def _named(parameters):
    number = F.col("value").isNotNull() & ~F.isnan("value")
    summed = F.round(F.sum("value").over(Window.partitionBy("model_type", "coord_type")), 6)
    total = F.when(F.col("kind") == "importance", summed)
    return parameters.select(
        "feature", "kind", "model_type", "coord_type", number.alias("is_number"), total.alias("total")
    )


@query("model_parameters", _parameters_sql(("decision_tree", "importance")))
def _(t):
    train, test = regression_split(t)
    return _named(models.coordinate_parameters(models.train_coordinates(train, test, "decision_tree"), t.spark))


@query("save_model_params", _parameters_sql(("linear", "coefficient"), ("decision_tree", "importance")))
def _(t):
    train, test = regression_split(t)
    path = scratch_path(t.spark, "model_params")
    for kind in ("linear", "decision_tree"):
        fitted = models.train_coordinates(train, test, kind)
        models.save_model_params(models.coordinate_parameters(fitted, t.spark), path)
    return _named(t.spark.read.parquet(path))


# Under an overwhelming penalty the model is the mean of the training rows, whose error SQL knows.
@query(
    "save_metrics",
    f"""WITH s AS ({_SPLIT_SQL.format(rows=_POSITION_ROWS)}),
        e AS (SELECT abs(lon - (SELECT avg(lon) FROM s WHERE in_train)) AS lon,
                     abs(lat - (SELECT avg(lat) FROM s WHERE in_train)) AS lat FROM s WHERE NOT in_train)
        SELECT 'linear' AS model, round(avg(lon), 6) AS longitude_mae, round(avg(lat), 6) AS latitude_mae,
               'elasticNetParam=1.0, maxIter=100, num_folds=3, regParam=1000000.0, solver=normal' AS settings FROM e""",
)
def _(t):
    train, test = regression_split(t)
    path = scratch_path(t.spark, "metrics")
    fitted = models.train_coordinates(train, test, "linear", **_OVERWHELMING)
    settings = {**models.REGRESSION_SETTINGS["linear"], **_OVERWHELMING, "num_folds": models.FOLDS}
    record = models.metrics_record(fitted, settings, t.spark)
    models.save_metrics(record, path)
    stored = t.spark.read.schema(record.schema).json(path)
    entries = F.transform(F.array_sort(F.map_entries("model_params")), lambda e: F.concat_ws("=", e["key"], e["value"]))
    return stored.select(
        "model",
        F.round("longitude_mae", 6).alias("longitude_mae"),
        F.round("latitude_mae", 6).alias("latitude_mae"),
        F.array_join(entries, ", ").alias("settings"),
    )


@query(
    "save_model",
    f"SELECT h3_09, customer_id, true AS same FROM ({_CLASSIFIED_ROWS_SQL}) WHERE NOT in_train",
)
def _(t):
    train, test = classification_split(t)
    path = scratch_path(t.spark, "model")
    fitted = models.train_classifier(models.classifier_stages(), models.logistic(), train)
    models.save_model(fitted, path)
    in_session = fitted.transform(test).withColumnRenamed("prediction", "here")
    both = models.load_pipeline(path).transform(in_session.select(*test.columns, "here"))
    return both.select("h3_09", "customer_id", (F.col("prediction") == F.col("here")).alias("same"))


@query(
    "batch_score",
    f"""SELECT customer_id, h3_09, true AS same FROM (
        {_SPLIT_SQL.format(rows="SELECT customer_id, h3_09 FROM withdrawals JOIN locations USING (h3_09)")})
        WHERE NOT in_train""",
)
def _(t):
    train, test = regression_split(t)
    columns = features.NUMERIC_FEATURES
    plain = features.assemble(train.drop("features"), columns)
    model = models.regressor("linear", "lon", "here", regParam=0.0, elasticNetParam=0.0).fit(plain)
    weights, intercept = np.asarray(model.coefficients.toArray()), float(model.intercept)
    scored = models.batch_score(test, columns, lambda x: x @ weights + intercept)
    both = model.transform(features.assemble(scored.drop("features"), columns))
    same = F.abs(F.col("prediction") - F.col("here")) < 1e-9
    return both.select("customer_id", "h3_09", same.alias("same"))
