"""What is determined about fitted models and samples, as rows that SQL can give too.

The models themselves are registered beside this; their predictions depend on the solver, but
which rows come out, that a prediction is in its domain, and the result on labels that are a
plain function of the features do not.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tidemill.ml import features, jobs
from tidemill.queries.models import KEYS, PRICE, SPLIT_SQL, vectors
from tidemill.registry import all_queries, query
from tidemill.session import materialize

BAND_SQL = "cast(least(floor(l_quantity / 7.5), 6) as double)"
UNSEEN = SPLIT_SQL.format(">=")
CONFUSION_SQL = f"""select {BAND_SQL} as label, {BAND_SQL} as prediction, count(*) as cnt
       from lineitem where {UNSEEN} group by 1, 2"""


def bands(t):
    """Lines whose label is a step function of the one feature, in two parts."""
    band = F.least(F.floor(F.col("l_quantity") / 7.5), F.lit(6)).cast("double")
    lines = t.lineitem.withColumn("label", band)
    return features.split(features.assemble(lines, ["l_quantity"], [*KEYS, "label"]), KEYS)


def confusion(model, test):
    return (
        model.transform(test)
        .groupBy("label", "prediction")
        .agg(F.count(F.lit(1)).alias("cnt"))
    )


@query("ml_dtree_known", CONFUSION_SQL)
def ml_dtree_known(t):
    """A tree finds the steps of its label: nothing off the diagonal."""
    train, test = bands(t)
    return confusion(jobs.decision_tree(train, "label", bins=64), test)


@query("ml_rf_known", CONFUSION_SQL)
def ml_rf_known(t):
    train, test = bands(t)
    return confusion(jobs.random_forest(train, "label", bins=64), test)


@query(
    "ml_regtree_known",
    f"select l_orderkey, l_linenumber, {BAND_SQL} as prediction from lineitem where {UNSEEN}",
)
def ml_regtree_known(t):
    train, test = bands(t)
    scored = jobs.regression_tree(train, "label", bins=64).transform(test)
    return scored.select(*KEYS, F.round("prediction", 6).alias("prediction"))


@query(
    "ml_elastic_net_rows",
    f"""select l_orderkey, l_linenumber, l_returnflag as category, l_extendedprice,
       true as positive from lineitem where {UNSEEN}""",
)
def ml_elastic_net_rows(t):
    """The unseen lines with their category back from its index, and a price above zero."""
    scored = all_queries()["ml_elastic_net"].build(t)
    return scored.select(*KEYS, "category", PRICE, (F.col("prediction") > 0).alias("positive"))


@query("ml_kmeans_nearest", "select vec_id, true as nearest from embeddings")
def ml_kmeans_nearest(t):
    """Every point is in the cluster of the centre that is nearest to it."""
    points = vectors(t)
    model = jobs.kmeans(points)
    centres = [c.tolist() for c in model.clusterCenters()]
    distances = [
        F.aggregate(
            F.zip_with("point", F.array(*map(F.lit, centre)), lambda x, y: (x - y) * (x - y)),
            F.lit(0.0),
            lambda total, x: total + x,
        )
        for centre in centres
    ]
    scored = model.transform(points).withColumn("point", vector_to_array(features.FEATURES))
    own = F.get(F.array(*distances), F.col("prediction"))
    return scored.select("vec_id", (own <= F.least(*distances) + 1e-9).alias("nearest"))


@query("ml_elbow_costs", f"select unnest({list(jobs.ELBOW_KS)}) as k, true as positive")
def ml_elbow_costs(t):
    costs = all_queries()["ml_elbow"].build(t)
    return costs.select(F.col("k").cast("int").alias("k"), (F.col("cost") > 0).alias("positive"))


@query("ml_gmm_total", "select count(*) as cnt, true as known from lineitem")
def ml_gmm_total(t):
    """Every line is in one of the three components."""
    counts = all_queries()["ml_gmm"].build(t)
    known = F.bool_and(F.col("prediction").between(0, 2))
    return counts.agg(F.sum("cnt").alias("cnt"), known.alias("known"))


RATED_SQL = """ratings as (select l_suppkey as "user", l_partkey as item, avg(l_quantity) as rating,
         md5('11|' || l_suppkey || '|' || l_partkey) < '{}' as train
         from lineitem group by 1, 2)"""


@query(
    "ml_als_rows",
    "with "
    + RATED_SQL.format(format(round(0.9 * 16**8), "08x"))
    + """ select cast("user" as integer) as "user", cast(item as integer) as item,
       round(rating, 6) as rating,
       "user" in (select "user" from ratings where train)
         and item in (select item from ratings where train) as known
       from ratings where not train""",
)
def ml_als_rows(t):
    """Every unseen pair comes out, without a prediction where its user or item is cold."""
    return all_queries()["ml_als"].build(t).select(
        "user", "item", F.round("rating", 6).alias("rating"),
        F.col("prediction").isNotNull().alias("known"),
    )


@query(
    "ml_top_items",
    """select cast(u as integer) as "user", cast(n as integer) as place, true as scored,
       true as best from (select distinct l_suppkey as u from lineitem where l_suppkey % 20 = 0),
       range(1, 6) r(n)""",
)
def ml_top_items(t):
    """The five best items for the users divisible by 20. Each has the score that the model gives
    the pair, and no item that the user has bought and that is not listed scores higher."""
    pairs = t.lineitem.groupBy("l_suppkey", "l_partkey").agg(F.avg("l_quantity").alias("rating"))
    pairs = pairs.select(
        F.col("l_suppkey").cast("int").alias("user"),
        F.col("l_partkey").cast("int").alias("item"),
        "rating",
    )
    model = jobs.als(pairs, "user", "item", "rating", rank=8, iterations=3)
    chosen = pairs.where("user % 20 = 0")
    best = materialize(jobs.top_items(model, chosen.select("user").distinct(), 5), "best")
    scored = model.transform(best.withColumnRenamed("rating", "told"))
    told = scored.select("user", "item", "place", "told", (F.abs(F.col("told") - F.col("prediction")) < 1e-4).alias("scored"))
    bought = model.transform(chosen.select("user", "item")).join(best, ["user", "item"], "left_anti")
    rest = bought.groupBy("user").agg(F.max("prediction").alias("rest"))
    holds = F.col("told") >= F.coalesce("rest", F.lit(float("-inf"))) - 1e-4
    return told.join(rest, "user", "left").select("user", "place", "scored", holds.alias("best"))


# points whose groups lie far apart: a group per flag, spread by discount and tax
APART_SQL = """(select l_returnflag as flag, l_discount + case l_returnflag when 'A' then 100 else 0 end as x,
    l_tax + case l_returnflag when 'N' then 100 else 0 end as y from lineitem)"""
GROUPS_SQL = f"select round(avg(x), 5) as x, round(avg(y), 5) as y, count(*) as cnt from {APART_SQL} group by flag"


def apart(t):
    flag = lambda name: F.when(F.col("l_returnflag") == name, 100).otherwise(0)
    points = t.lineitem.select(
        *KEYS, (F.col("l_discount") + flag("A")).alias("x"), (F.col("l_tax") + flag("N")).alias("y")
    )
    return features.assemble(points, ["x", "y"], [*KEYS])


def groups_found(t, model, centres):
    """The centre of each group as the model has it, and the points that it puts there."""
    rows = [(n, float(c[0]), float(c[1])) for n, c in enumerate(centres)]
    named = t.spark.createDataFrame(rows, "prediction int, x double, y double")
    counts = model.transform(apart(t)).groupBy("prediction").agg(F.count(F.lit(1)).alias("cnt"))
    return counts.join(F.broadcast(named), "prediction").select(  # a row per group
        F.round("x", 5).alias("x"), F.round("y", 5).alias("y"), "cnt"
    )


@query("ml_kmeans_known", GROUPS_SQL)
def ml_kmeans_known(t):
    """Centres are the means of the groups, members their rows."""
    model = jobs.kmeans(apart(t))
    return groups_found(t, model, model.clusterCenters())


@query("ml_gmm_known", GROUPS_SQL)
def ml_gmm_known(t):
    model = jobs.gaussian_mixture(apart(t))
    return groups_found(t, model, [g.mean for g in model.gaussians])


@query(
    "ml_elbow_known",
    f"""with g as (select *, avg(x) over (partition by flag) as mx, avg(y) over (partition by flag)
         as my from {APART_SQL})
       select 3::integer as k, round(sum((x - mx) ** 2 + (y - my) ** 2), 4) as cost,
         true as less from g""",
)
def ml_elbow_known(t):
    """The cost of three groups is the sum of squares within them, and two cost more."""
    costs = {r["k"]: r["cost"] for r in jobs.elbow(apart(t), [2, 3]).collect()}
    rows = [(3, round(costs[3], 4), costs[3] < costs[2] / 100)]
    return t.spark.createDataFrame(rows, "k int, cost double, less boolean")


@query(
    "ml_pca_known",
    """with p as (select l_quantity as x, l_extendedprice / 1000 as y from lineitem),
       v as (select var_samp(x) as a, var_samp(y) as c, covar_samp(x, y) as b from p)
       select round((a + c) / 2 + sqrt(((a - c) / 2) ** 2 + b * b), 6) as first,
         round((a + c) / 2 - sqrt(((a - c) / 2) ** 2 + b * b), 6) as second from v""",
)
def ml_pca_known(t):
    """Variances along two axes are the eigenvalues of the covariance."""
    points = t.lineitem.select(*KEYS, "l_quantity", (F.col(PRICE) / 1000).alias("price"))
    assembled = features.assemble(points, ["l_quantity", "price"], KEYS)
    model = jobs.principal_components(assembled, 2)
    placed = model.transform(assembled).select(vector_to_array(model.getOutputCol()).alias("p"))
    spread = [F.round(F.var_samp(F.get("p", F.lit(n))), 6) for n in range(2)]
    return placed.agg(spread[0].alias("first"), spread[1].alias("second"))


HALF_SQL = "cast(case when l_quantity > 25 then 1 else 0 end as double)"


@query(
    "ml_logreg_known",
    f"""select {HALF_SQL} as label, {HALF_SQL} as prediction, count(*) as cnt from lineitem
       where {UNSEEN} group by 1""",
)
def ml_logreg_known(t):
    """A label that a line parts is found: nothing off the diagonal."""
    rows = t.lineitem.select(*KEYS, "l_quantity", (F.col("l_quantity") > 25).cast("double").alias("label"))
    train, test = features.split(features.assemble(rows, ["l_quantity"], [*KEYS, "label"]), KEYS)
    return confusion(jobs.logistic_regression(train, "label", iterations=100), test)


@query("ml_pca_axes", "select true as uncorrelated, true as falling")
def ml_pca_axes(t):
    """The components of all points are uncorrelated, and each has no more variance than the
    one before."""
    points = vectors(t)
    _, projected = principal(points)
    a, b, c = (F.get("p", F.lit(n)) for n in range(3))
    row = projected.select(vector_to_array("pca").alias("p")).agg(
        F.greatest(*[F.abs(F.corr(x, y)) for x, y in ((a, b), (a, c), (b, c))]).alias("most"),
        (F.var_samp(a) >= F.var_samp(b)).alias("first"),
        (F.var_samp(b) >= F.var_samp(c)).alias("second"),
    )
    falling = F.col("first") & F.col("second")
    return row.select((F.col("most") < 1e-6).alias("uncorrelated"), falling.alias("falling"))


def principal(points):
    model = jobs.principal_components(points)
    return model, model.transform(points).withColumnRenamed(model.getOutputCol(), "pca")


@query(
    "ml_class_metrics",
    """with c as (select unnest([0.0, 1.0]) as label),
       n as (select label, count(*) filter (quality = label and toxic = label) as hit,
         count(*) filter (toxic = label) as given, count(*) filter (quality = label) as held
         from c, labels group by 1)
       select cast(label as double) as label, round(hit / given, 6) as precision,
         round(hit / held, 6) as recall,
         round(2.0 * hit / (given + held), 6) as f from n""",
)
def ml_class_metrics(t):
    """Precision, recall and F of each class, from one pass over the pairs."""
    pairs = t.labels.select(
        F.col("quality").cast("double").alias("label"),
        F.col("toxic").cast("double").alias("prediction"),
    )
    return jobs.class_metrics(pairs, "label").select(
        "label", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f")]
    )


@query("sample_bernoulli_share", "select true as near, true as inside from range(1)")
def sample_bernoulli_share(t):
    """A fifth of the rows, within five standard errors, and no row that is not in the table."""
    drawn = all_queries()["sample_bernoulli"].build(t)
    total = t.events.agg(F.count(F.lit(1)).alias("n"))
    taken = drawn.agg(F.count(F.lit(1)).alias("m"), F.count_distinct("event_id").alias("d"))
    error = 5 * F.sqrt(F.col("n") * 0.2 * 0.8)
    return total.join(taken, F.lit(True)).select(
        (F.abs(F.col("m") - 0.2 * F.col("n")) <= error).alias("near"),
        (F.col("m") == F.col("d")).alias("inside"),
    )


@query(
    "agg_summary",
    """select 'count' as summary, cast(count(l_quantity) as varchar) as l_quantity from lineitem
       union all select 'min', cast(min(l_quantity) as varchar) from lineitem
       union all select 'max', cast(max(l_quantity) as varchar) from lineitem""",
)
def agg_summary(t):
    return t.lineitem.select("l_quantity").summary("count", "min", "max")


@query(
    "cogroup_function",
    """with a as (select o_custkey as key, count(*) as orders, sum(o_totalprice) as spent
         from orders group by 1),
       b as (select user_id as key, count(*) as events from events group by 1)
       select coalesce(a.key, b.key) as key, coalesce(orders, 0) as orders,
         coalesce(events, 0) as events, round(coalesce(spent, 0), 2) as spent
       from a full join b on a.key = b.key""",
)
def cogroup_function(t):
    """Both groups of a key in one call of a function. Each side is added up by key before, so
    a call gets one row of a key and side at most, however many rows the key has."""
    from tidemill.operators.joins import cogroup_apply

    orders = t.orders.groupBy(F.col("o_custkey").alias("key")).agg(
        F.count(F.lit(1)).alias("orders"), F.sum("o_totalprice").cast("double").alias("spent")
    )
    events = t.events.groupBy(F.col("user_id").alias("key")).agg(F.count(F.lit(1)).alias("events"))
    both = cogroup_apply(
        orders, events, "key", orders_and_events, "key long, orders long, events long, spent double"
    )
    return both.withColumn("spent", F.round("spent", 2))


def orders_and_events(orders, events):
    """A row per key of either side."""
    import pyarrow as pa
    import pyarrow.compute as pc

    def column(rows, name, kind):
        here = rows[name] if name in rows.column_names else pa.nulls(rows.num_rows)
        some = pc.fill_null(here.cast(kind), 0)
        return pc.if_else(pc.is_nan(some), 0.0, some) if kind == pa.float64() else some

    kinds = {"orders": pa.int64(), "events": pa.int64(), "spent": pa.float64()}
    sides = [
        pa.table({"key": rows["key"], **{n: column(rows, n, kind) for n, kind in kinds.items()}})
        for rows in (orders, events)
    ]
    both = pa.concat_tables(sides).group_by("key").aggregate([(n, "sum") for n in kinds])
    return both.rename_columns([n.removesuffix("_sum") for n in both.column_names])
