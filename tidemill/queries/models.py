"""Model jobs on the tables."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tidemill.ml import features, jobs
from tidemill.operators.sampling import cut_point
from tidemill.registry import query

NUMBERS = ["l_quantity", "l_discount", "l_tax"]
KEYS = ["l_orderkey", "l_linenumber"]
PRICE = "l_extendedprice"


def priced(t, label=None):
    """Quantity, discount and tax of every line with its price."""
    lines = t.lineitem.withColumn("label", F.col(PRICE) if label is None else label)
    return features.assemble(lines, NUMBERS, [*KEYS, "label"])


def band():
    """Seven classes of quantity."""
    return F.least(F.floor(F.col("l_quantity") / 7.5), F.lit(6)).cast("double")


def banded(t):
    lines = t.lineitem.withColumn("label", band())
    return features.assemble(lines, [PRICE, "l_discount", "l_tax"], [*KEYS, "label"])


def confusion_of(model, test):
    return jobs.confusion(model.transform(test), "label", "prediction")


@query(
    "ml_index",
    """select event_type, cast(row_number() over (order by count(*) desc, event_type) - 1 as
       double) as idx from events group by 1""",
)
def ml_index(t):
    _, indexed = features.index_labels(t.events.select("event_type"), "event_type", "idx")
    return indexed.select("event_type", "idx").distinct()


def least_squares_sql(source: str) -> str:
    """Weights k1, k2, k3 and the intercept from the normal equations."""
    return f"""with src as (select * from lineitem{source}), m as (
         select covar_pop(l_quantity, l_quantity) as a, covar_pop(l_quantity, l_discount)
         as b, covar_pop(l_quantity, l_tax) as c, covar_pop(l_discount, l_discount) as d,
         covar_pop(l_discount, l_tax) as e, covar_pop(l_tax, l_tax) as f,
         covar_pop(l_quantity, l_extendedprice) as x, covar_pop(l_discount, l_extendedprice) as y,
         covar_pop(l_tax, l_extendedprice) as z, avg(l_quantity) as mq, avg(l_discount) as md,
         avg(l_tax) as mt, avg(l_extendedprice) as mp from src),
       s as (select *, a * (d * f - e * e) - b * (b * f - c * e) + c * (b * e - c * d) as det
         from m),
       w as (select *,
         (x * (d * f - e * e) - b * (y * f - e * z) + c * (y * e - d * z)) / det as k1,
         (a * (y * f - e * z) - x * (b * f - c * e) + c * (b * z - y * c)) / det as k2,
         (a * (d * z - y * e) - b * (b * z - y * c) + x * (b * e - d * c)) / det as k3 from s),
       k as (select k1, k2, k3, mp - k1 * mq - k2 * md - k3 * mt as k0 from w)"""


SPLIT_SQL = "md5('11|' || l_orderkey || '|' || l_linenumber) {} '" + cut_point(0.8) + "'"


@query(
    "ml_linreg",
    least_squares_sql("")
    + """ select 'l_quantity' as term, round(k1, 3) as weight from k
       union all select 'l_discount', round(k2, 3) from k
       union all select 'l_tax', round(k3, 3) from k
       union all select 'intercept', round(k0, 3) from k""",
)
def ml_linreg(t):
    """Least-squares weights, equal to the normal equations."""
    model = jobs.linear_regression(priced(t), "label")
    weights = dict(zip(NUMBERS, map(float, model.coefficients)), intercept=model.intercept)
    table = t.spark.createDataFrame(list(weights.items()), "term string, weight double")
    return table.withColumn("weight", F.round("weight", 3))


@query(
    "ml_linreg_error",
    least_squares_sql(" where " + SPLIT_SQL.format("<"))
    + f""" select count(*) as cnt, round(avg(abs(k0 + k1 * l_quantity + k2 * l_discount +
       k3 * l_tax - l_extendedprice)), 4) as mean_error from lineitem, k
       where {SPLIT_SQL.format(">=")}""",
)
def ml_linreg_error(t):
    """Trained on one part of the lines, mean absolute error on the other."""
    train, test = features.split(priced(t), KEYS)
    scored = jobs.linear_regression(train, "label").transform(test)
    error = F.avg(F.abs(F.col("prediction") - F.col("label")))
    return scored.agg(F.count(F.lit(1)).alias("cnt"), F.round(error, 4).alias("mean_error"))


@query(
    "ml_linreg_predict",
    least_squares_sql(" where " + SPLIT_SQL.format("<"))
    + f""" select l_orderkey, l_linenumber, l_extendedprice as label, round(k0 + k1 * l_quantity
       + k2 * l_discount + k3 * l_tax, 2) as prediction from lineitem, k
       where {SPLIT_SQL.format(">=")}""",
)
def ml_linreg_predict(t):
    train, test = features.split(priced(t), KEYS)
    scored = jobs.linear_regression(train, "label").transform(test)
    return scored.select(*KEYS, "label", F.round("prediction", 2).alias("prediction"))


@query(
    "ml_gradient",
    """with recursive r as (select l_quantity / 50 as q, l_discount as d, l_tax as t,
         l_extendedprice / 100000 as y from lineitem),
       m as (select avg(q*q) as qq, avg(q*d) as qd, avg(q*t) as qt, avg(d*d) as dd,
         avg(d*t) as dt, avg(t*t) as tt, avg(q*y) as qy, avg(d*y) as dy, avg(t*y) as ty from r),
       w as (select 0 as i, 0::double as a, 0::double as b, 0::double as c
         union all
         select i + 1, a - 0.5 / sqrt(i + 1) * (a*qq + b*qd + c*qt - qy),
           b - 0.5 / sqrt(i + 1) * (a*qd + b*dd + c*dt - dy),
           c - 0.5 / sqrt(i + 1) * (a*qt + b*dt + c*tt - ty) from w, m where i < 20)
       select 'quantity' as term, round(a, 9) as weight from w where i = 20
       union all select 'discount', round(b, 9) from w where i = 20
       union all select 'tax', round(c, 9) from w where i = 20""",
)
def ml_gradient(t):
    """Twenty gradient steps of a falling length over all lines, on scaled columns."""
    rows = t.lineitem.select(
        (F.col("l_quantity") / 50).alias("quantity"),
        F.col("l_discount").alias("discount"),
        F.col("l_tax").alias("tax"),
        (F.col(PRICE) / 100000).alias("price"),
    )
    terms = ["quantity", "discount", "tax"]
    weights = jobs.gradient_descent(rows, terms, "price", iterations=20, step=0.5)
    table = t.spark.createDataFrame(list(zip(terms, weights)), "term string, weight double")
    return table.withColumn("weight", F.round("weight", 9))


@query("ml_elastic_net")
def ml_elastic_net(t):
    """Category index, vector and elastic net as one fitted chain, scored on unseen lines."""
    rows = t.lineitem.select(*KEYS, "l_returnflag", *NUMBERS, PRICE)
    train, test = features.split(rows, KEYS)
    model = jobs.elastic_net_stages("l_returnflag", NUMBERS, PRICE).fit(train)
    names = features.label_names(model.stages[0], "_category", "category")
    scored = model.transform(test)
    return names.transform(scored).select(*KEYS, "category", PRICE, "prediction")


@query("ml_logreg")
def ml_logreg(t):
    dear = (F.col(PRICE) > 50000).cast("double")
    train, test = features.split(priced(t, dear), KEYS)
    return confusion_of(jobs.logistic_regression(train, "label"), test)


@query("ml_dtree")
def ml_dtree(t):
    train, test = features.split(banded(t), KEYS)
    return confusion_of(jobs.decision_tree(train, "label"), test)


@query("ml_regtree")
def ml_regtree(t):
    train, test = features.split(priced(t), KEYS)
    scored = jobs.regression_tree(train, "label").transform(test)
    return scored.select(*KEYS, "label", "prediction")


@query("ml_rf")
def ml_rf(t):
    train, test = features.split(banded(t), KEYS)
    return confusion_of(jobs.random_forest(train, "label"), test)


def vectors(t):
    return features.from_array(t.embeddings, "embedding", ["vec_id", "label"])


@query("ml_kmeans")
def ml_kmeans(t):
    points = vectors(t)
    return jobs.kmeans(points).transform(points).select("vec_id", "prediction")


@query("ml_elbow")
def ml_elbow(t):
    return jobs.elbow(vectors(t))


@query("ml_gmm")
def ml_gmm(t):
    points = features.assemble(t.lineitem, [PRICE, *NUMBERS], KEYS)
    scored = jobs.gaussian_mixture(points, iterations=20).transform(points)
    return scored.groupBy("prediction").agg(F.count(F.lit(1)).alias("cnt"))


@query("ml_als")
def ml_als(t):
    """Quantity of a part from a supplier, predicted for unseen pairs."""
    ratings = t.lineitem.groupBy("l_suppkey", "l_partkey").agg(F.avg("l_quantity").alias("rating"))
    ratings = ratings.select(
        F.col("l_suppkey").cast("int").alias("user"),
        F.col("l_partkey").cast("int").alias("item"),
        "rating",
    )
    train, test = features.split(ratings, ["user", "item"], 0.9)
    model = jobs.als(train, "user", "item", "rating")
    known = F.when(~F.isnan("prediction"), F.col("prediction"))  # NULL: a cold user or item
    return model.transform(test).select("user", "item", "rating", known.alias("prediction"))


@query(
    "ml_fpgrowth",
    """with names as (select unnest(['click', 'error', 'purchase', 'signup', 'view']) as item,
         unnest([1, 2, 4, 8, 16]) as bit),
       baskets as (select user_id, cast(ts as date) as day, bit_or(bit) as mask from events
         join names on event_type = item group by 1, 2),
       sets as (select s, string_agg(item, ',' order by item) as items
         from range(1, 32) r(s) join names on (s & bit) > 0 group by s)
       select items, count(*) as freq from sets join baskets on (mask & s) = s group by items
       having count(*) >= ceil(0.05 * (select count(*) from baskets))""",
)
def ml_fpgrowth(t):
    """Frequent sets of event types within a user's day."""
    day = F.col("ts").cast("date").alias("day")
    pairs = t.events.select("user_id", day, "event_type").distinct()
    baskets = pairs.groupBy("user_id", "day").agg(F.collect_set("event_type").alias("types"))
    return jobs.frequent_sets(baskets, "types", 0.05)


@query("ml_pca")
def ml_pca(t):
    points = vectors(t)
    placed = jobs.principal_components(points).transform(points)
    values = vector_to_array("components")
    return placed.select("vec_id", *[values[i].alias(f"c{i + 1}") for i in range(3)])


@query(
    "ml_confusion",
    """select cast(quality as double) as label, cast(toxic as double) as prediction,
       count(*) as cnt from labels group by 1, 2""",
)
def ml_confusion(t):
    pairs = t.labels.select(F.col("quality").cast("double"), F.col("toxic").cast("double"))
    return jobs.confusion(pairs, "quality", "toxic")


@query(
    "ml_accuracy",
    """select round(avg(case when quality = toxic then 1.0 else 0.0 end), 6) as accuracy
       from labels""",
)
def ml_accuracy(t):
    pairs = t.labels.select(
        F.col("quality").cast("double").alias("label"),
        F.col("toxic").cast("double").alias("prediction"),
    )
    accuracy = jobs.class_metric(pairs, "label", "accuracy")
    return t.spark.createDataFrame([(round(accuracy, 6),)], "accuracy double")
