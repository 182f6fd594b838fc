"""Scalar functions."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from tidemill.functions import dates, jsons, text
from tidemill.registry import query

AS_OF = datetime.date(2002, 1, 15)
MONDAY = datetime.date(2024, 1, 8)


@query(
    "fn_math",
    """select p_partkey, power(p_size, 2) as squared, round(p_retailprice / 7, 3) as seventh,
       sqrt(p_retailprice) as root, abs(20 - p_size) as distance from part""",
)
def fn_math(t):
    return t.part.select(
        "p_partkey",
        F.power("p_size", F.lit(2)).alias("squared"),
        F.round(F.col("p_retailprice") / 7, 3).alias("seventh"),
        F.sqrt("p_retailprice").alias("root"),
        F.abs(F.lit(20) - F.col("p_size")).alias("distance"),
    )


@query(
    "fn_date_parts",
    """select event_id, cast(year(ts) as integer) as y, cast(week(ts) as integer) as w,
       cast(minute(ts) as integer) as m from events""",
)
def fn_date_parts(t):
    return t.events.select(
        "event_id",
        F.year("ts").alias("y"),
        F.weekofyear("ts").alias("w"),
        F.minute("ts").alias("m"),
    )


@query(
    "fn_date_arith",
    """select o_orderkey, cast(o_orderdate as date) + 30 as due,
       cast(o_orderdate as date) - 1 as eve,
       cast(date '2002-01-15' - cast(o_orderdate as date) as integer) as age_days from orders""",
)
def fn_date_arith(t):
    day = F.col("o_orderdate").cast("date")
    return t.orders.select(
        "o_orderkey",
        F.date_add(day, 30).alias("due"),
        F.date_sub(day, 1).alias("eve"),
        F.datediff(F.lit(AS_OF), day).alias("age_days"),
    )


@query(
    "fn_epoch",
    """select event_id, cast(epoch(date_trunc('second', ts)) as bigint) as seconds,
       strftime(ts, '%Y/%m/%d') as day_text from events""",
)
def fn_epoch(t):
    written = F.date_format("ts", dates.DATE_TIME)
    return t.events.select(
        "event_id",
        dates.epoch_seconds(written).alias("seconds"),
        dates.reformat_date(written, dates.DATE_TIME, "yyyy/MM/dd").alias("day_text"),
    )


@query(
    "fn_age",
    """with d as (select o_orderkey, cast(o_orderdate as date) as b, date '2002-01-15' as a
       from orders)
       select o_orderkey, round(((year(a) - year(b)) * 12 + month(a) - month(b) +
         case when day(a) = day(b) or (a = last_day(a) and b = last_day(b)) then 0
         else (day(a) - day(b)) / 31.0 end) / 12, 2) as years from d""",
)
def fn_age(t):
    day = F.col("o_orderdate").cast("date")
    return t.orders.select(
        "o_orderkey", dates.years_between(F.lit(AS_OF), day, 2).alias("years")
    )


@query(
    "week_filter",
    """select event_id, user_id, cast(ts as date) as day,
       cast(date_trunc('week', ts) as date) as monday from events
       where ts >= timestamp '2024-01-08' and ts < timestamp '2024-01-15'""",
)
def week_filter(t):
    day = F.col("ts").cast("date")
    return t.events.filter(dates.in_week(F.col("ts"), F.lit(MONDAY))).select(
        "event_id", "user_id", day.alias("day"), dates.week_start(day).alias("monday")
    )


@query(
    "fn_datetime_utils",
    """select event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') as written,
       cast(epoch(date_trunc('second', ts)) as bigint) * 1000 as millis,
       strftime(cast(ts as date) - 1, '%Y-%m-%d') as eve,
       strftime(cast(ts as date) - 1, '%Y%m%d') as eve_compact from events""",
)
def fn_datetime_utils(t):
    day = F.col("ts").cast("date")
    millis = dates.text_to_millis(F.date_format("ts", dates.DATE_TIME))
    return t.events.select(
        "event_id",
        dates.millis_to_text(millis).alias("written"),
        millis.alias("millis"),
        dates.day_before(day).alias("eve"),
        dates.day_before(day, dates.DAY_COMPACT).alias("eve_compact"),
    )


@query(
    "fn_iso_cleanup",
    """select event_id, date_trunc('second', ts) as cleaned from events""",
)
def fn_iso_cleanup(t):
    zones = F.array(*[F.lit(z) for z in ("+0800", ".000Z", "-05:00", "+08:00")])
    zone = F.get(zones, (F.col("event_id") % 4).cast("int"))
    iso = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), zone)
    cleaned = dates.iso_text_to_timestamp(iso).cast("timestamp_ntz")
    return t.events.select("event_id", cleaned.alias("cleaned"))


@query(
    "fn_split",
    r"""select doc_id, cast(len(regexp_split_to_array(text, '\s+')) as integer) as pieces,
       regexp_split_to_array(text, '\s+')[1] as first_piece from documents""",
)
def fn_split(t):
    pieces = F.split("text", r"\s+")
    return t.documents.select(
        "doc_id", F.size(pieces).alias("pieces"), F.get(pieces, F.lit(0)).alias("first_piece")
    )


@query(
    "fn_regexp_replace",
    "select doc_id, regexp_replace(text, '[aeiou]+', '#', 'g') as masked from documents",
)
def fn_regexp_replace(t):
    return t.documents.select(
        "doc_id", F.regexp_replace("text", "[aeiou]+", "#").alias("masked")
    )


@query(
    "fn_regexp_extract",
    r"""select page_id, regexp_extract(url, '^(https?)://([^/?#]+)', 1) as scheme,
       regexp_extract(url, '^(https?)://([^/?#]+)', 2) as host from pages""",
)
def fn_regexp_extract(t):
    pattern = "^(https?)://([^/?#]+)"
    return t.pages.select(
        "page_id",
        F.regexp_extract("url", pattern, 1).alias("scheme"),
        F.regexp_extract("url", pattern, 2).alias("host"),
    )


@query(
    "fn_substring",
    """select c_custkey, substring(c_name, 1, 2) as head, trim('  ' || c_mktsegment || ' ') as
       segment, lower(c_mktsegment) as low, upper(c_name) as up from customer""",
)
def fn_substring(t):
    return t.customer.select(
        "c_custkey",
        F.substring("c_name", 1, 2).alias("head"),
        F.trim(F.concat(F.lit("  "), "c_mktsegment", F.lit(" "))).alias("segment"),
        F.lower("c_mktsegment").alias("low"),
        F.upper("c_name").alias("up"),
    )


def log_lines(t):
    """Access-log lines written from the events; answers without a body have "-" as size."""
    ip = F.concat_ws(
        ".",
        F.lit("10"),
        F.expr("user_id div 65536 % 256"),
        F.expr("user_id div 256 % 256"),
        F.expr("user_id % 256"),
    )
    return t.events.select(
        F.format_string(
            '%s - - [%s +0000] "GET /%s HTTP/1.1" %s',
            ip,
            F.date_format("ts", text.LOG_TIME),
            F.col("event_type"),
            F.when(F.col("event_type") == "view", "304 -").otherwise(
                F.concat(F.lit("200 "), F.col("event_id"))
            ),
        ).alias("line")
    )


@query(
    "log_parse",
    r"""with lines as (
         select '10.' || (user_id // 65536 % 256) || '.' || (user_id // 256 % 256) || '.' ||
           (user_id % 256) || ' - - [' || strftime(ts, '%d/%b/%Y:%H:%M:%S') ||
           ' +0000] "GET /' || event_type || ' HTTP/1.1" ' || case event_type when 'view' then
           '304 -' else '200 ' || event_id end as line from events)
       select regexp_extract(line, '^(\S+)', 1) as ip,
         cast(strptime(regexp_extract(line, '\[(\S+)', 1), '%d/%b/%Y:%H:%M:%S') as date) as day,
         count(*) as hits from lines group by 1, 2""",
)
def log_parse(t):
    return (
        log_lines(t)
        .select(text.log_ip("line").alias("ip"), text.log_day("line").alias("day"))
        .groupBy("ip", "day")
        .agg(F.count(F.lit(1)).alias("hits"))
        .filter(F.col("day").isNotNull())
    )


@query(
    "explode_tags",
    """select page_id, unnest(string_split(url, '/')) as piece from pages""",
)
def explode_tags(t):
    return t.pages.select("page_id", F.explode(F.split("url", "/")).alias("piece"))


@query(
    "fn_field_pick",
    """select event_id, try_cast(trim(replace(replace(string_split(props, '"')[3], ':', ''), '}',
       '')) as bigint) as picked, string_split(props, '"')[12] as missing from events""",
)
def fn_field_pick(t):
    picked = F.trim(F.translate(text.quoted_field("props", 2), ":}", ""))
    return t.events.select(
        "event_id",
        picked.try_cast("bigint").alias("picked"),
        text.quoted_field("props", 11).alias("missing"),
    )


@query(
    "fn_json_path",
    """select event_id, json_extract_string(props, '$.k') as k,
       json_extract_string(props, '$.none') as none from events""",
)
def fn_json_path(t):
    return t.events.select(
        "event_id",
        F.get_json_object("props", "$.k").alias("k"),
        F.get_json_object("props", "$.none").alias("none"),
    )


@query(
    "fn_json_map",
    """select event_id, json_extract_string(props, '$.k') as k, 1 as entries, 0 as bad_entries
       from events""",
)
def fn_json_map(t):
    parsed = jsons.json_map("props")
    return t.events.select(
        "event_id",
        F.try_element_at(parsed, F.lit("k")).alias("k"),
        F.size(parsed).alias("entries"),
        F.size(jsons.json_map("event_type")).alias("bad_entries"),
    )


@query(
    "fn_keys",
    """select event_id, event_type || '-' || user_id as store_key,
       strftime(ts, '%Y%m%d') || ':' || event_type as row_key, 'user@' || user_id as tag
       from events""",
)
def fn_keys(t):
    return t.events.select(
        "event_id",
        text.joined_key("event_type", "user_id", separator="-").alias("store_key"),
        text.joined_key(F.date_format("ts", dates.DAY_COMPACT), "event_type").alias("row_key"),
        text.tagged("user", "user_id").alias("tag"),
    )
