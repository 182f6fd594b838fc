"""NULL and NaN handling."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemill.queries.projections import LABELLED_SQL, labelled
from tidemill.registry import query


@query(
    "nan_check",
    """select event_id, isnan(reading) as is_nan from
       (select event_id, case when value < 10 then 'nan'::double else value end as reading
        from events)""",
)
def nan_check(t):
    reading = F.when(F.col("value") < 10, F.lit(float("nan"))).otherwise(F.col("value"))
    return t.events.select("event_id", F.isnan(reading).alias("is_nan"))


@query("na_drop", f"select * from ({LABELLED_SQL}) where quality is not null")
def na_drop(t):
    return labelled(t).na.drop(subset=["quality"])


@query(
    "na_drop_any",
    f"select * from ({LABELLED_SQL}) where quality is not null and toxic is not null"
    " and lang is not null",
)
def na_drop_any(t):
    return labelled(t).na.drop()


@query(
    "na_fill",
    f"""select doc_id, coalesce(lang, 'unknown') as lang, coalesce(quality, -1) as quality,
       coalesce(toxic, 0) as toxic from ({LABELLED_SQL})""",
)
def na_fill(t):
    return labelled(t).na.fill({"lang": "unknown", "quality": -1, "toxic": 0})


@query(
    "na_replace",
    f"""select doc_id, case lang when 'en' then 'english' when 'fr' then 'french' else lang end
       as lang, quality, toxic from ({LABELLED_SQL})""",
)
def na_replace(t):
    return labelled(t).na.replace({"en": "english", "fr": "french"}, subset=["lang"])
