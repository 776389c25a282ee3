"""Row validation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakewarden.operators import profiles, validation as v
from lakewarden.operators.rules import CustomRule, Field, compile_checks
from lakewarden.plans.registry import query

PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")

ORDER_FIELDS = (
    Field("o_orderkey", "long", nullable=False), Field("o_custkey", "long", nullable=False),
    Field("o_totalprice", "double"), Field("o_orderstatus", "string"),
    Field("o_orderpriority", "string"), Field("contact_email", "string"), Field("o_orderdate", "datetime"),
)
ORDER_CUSTOM = (CustomRule("o_orderpriority", "enum", values=PRIORITIES),)
ALL_RULES = ("type", "null", "format", "quality")

# The same rules in SQL: errors and warnings of a faulty order row.
CHECKED = """
checked as (
  select *
    , cast(o_custkey is null as int)
      + cast(o_totalprice is not null and try_cast(o_totalprice as double) is null as int)
      + cast(o_orderpriority not in ('1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', '5-LOW') as int) as n_err
    , cast(not regexp_matches(contact_email, '^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\\.[a-zA-Z]{2,}$') as int)
      + cast(trim(o_orderstatus) = '' as int) + cast(lower(o_totalprice) = 'n/a' as int) as n_warn
    , cast(o_custkey is null as int) as n_null
  from orders_faulty)"""

BATCHES = CHECKED + """,
batches as (
  select cast(year(o_orderdate) as int) as y, cast(month(o_orderdate) as int) as m
    , count(*) as total_records, count(*) filter (n_err = 0) as valid_records
    , count(*) filter (n_err > 0) as error_records, count(*) filter (n_warn > 0) as warning_records
    , cast(sum(n_err) as bigint) as error_count, cast(sum(n_warn) as bigint) as warning_count
    , cast(sum(n_null) as bigint) as nulls
  from checked group by 1, 2)"""

OBJECTS = BATCHES + """,
objects as (
  select y, count(*) as batches, cast(sum(total_records) as bigint) as total_records
    , cast(sum(valid_records + error_records) as bigint) as processed_records
    , cast(sum(error_records) as bigint) as error_records, cast(sum(warning_records) as bigint) as warning_records
    , sum(error_records) / sum(total_records) as error_rate, sum(warning_records) / sum(total_records) as warning_rate
    , sum(nulls) / (7.0 * sum(total_records)) as null_rate
    , case when sum(error_records) > 0 then 'error' when sum(warning_records) > 0 then 'warning' else 'success' end as status
  from batches group by 1)"""


def order_checks(df):
    return compile_checks(df, ORDER_FIELDS, ALL_RULES, ORDER_CUSTOM)


def monthly_batches(t):
    df = t.orders_faulty.withColumn("y", F.year("o_orderdate")).withColumn("m", F.month("o_orderdate"))
    return v.batch_summary(df, ["y", "m"], ORDER_FIELDS, order_checks(df))


def yearly_objects(t):
    return v.object_rollup(monthly_batches(t), ["y"])


def rounded(df, *cols, places=6):
    return df.withColumns({c: F.round(c, places) for c in cols})


def found(df, key, checks):
    return v.record_issues(df, [key], checks).select(key, "field", "type", "severity")


@query("val_type", views=("orders_faulty",), sql="""
select o_orderkey, 'o_totalprice' as field, 'type_mismatch' as type, 'error' as severity
from orders_faulty where try_cast(o_totalprice as double) is null and o_totalprice is not null""")
def val_type(t):
    df = t.orders_faulty
    return found(df, "o_orderkey", compile_checks(df, ORDER_FIELDS, ["type"]))


@query("val_null", sql="""
select d.doc_id, f.field, 'null_constraint' as type, 'error' as severity
from documents d left join labels l on d.doc_id = l.doc_id, (values ('quality'), ('toxic')) as f(field)
where l.quality is null""")
def val_null(t):
    df = t.documents.select("doc_id").join(t.labels, "doc_id", "left")
    fields = [Field("doc_id", "long", False), Field("quality", "integer", False), Field("toxic", "integer", False)]
    return found(df, "doc_id", compile_checks(df, fields, ["null"]))


@query("val_format", sql="""
select page_id, 'url' as field, 'format_invalid' as type, 'warning' as severity
from (select page_id, case when page_id % 7 = 0 then replace(url, 'http', 'htp') else url end as url from pages)
where not regexp_matches(url, '^https?://[^\\s/$.?#].[^\\s]*$')""")
def val_format(t):
    df = t.pages.select("page_id", F.when(F.col("page_id") % 7 == 0, F.replace("url", F.lit("http"), F.lit("htp")))
                        .otherwise(F.col("url")).alias("url"))
    return found(df, "page_id", compile_checks(df, [Field("url", "string")], ["format"]))


@query("val_range", sql="""
with x as (select o_orderkey, o_totalprice - 250000 as net_price, o_totalprice / 4000 as share_percent from orders)
select o_orderkey, 'net_price' as field, 'range_violation' as type, 'warning' as severity from x where net_price < 0
union all
select o_orderkey, 'share_percent', 'range_violation', 'warning' from x where share_percent > 100""")
def val_range(t):
    df = t.orders.select("o_orderkey", (F.col("o_totalprice") - 250000).alias("net_price"),
                         (F.col("o_totalprice") / 4000).alias("share_percent"))
    return found(df, "o_orderkey", compile_checks(
        df, [Field("net_price", "double"), Field("share_percent", "double")], ["range"]))


@query("val_quality", views=("orders_faulty",), sql="""
select o_orderkey, 'o_totalprice' as field, 'data_quality' as type, 'warning' as severity
from orders_faulty where lower(trim(o_totalprice)) = 'n/a'
union all
select o_orderkey, 'o_orderstatus', 'data_quality', 'warning' from orders_faulty where trim(o_orderstatus) = ''""")
def val_quality(t):
    df = t.orders_faulty
    return found(df, "o_orderkey", compile_checks(df, ORDER_FIELDS, ["quality"]))


@query("val_custom_range", sql="""
select l_orderkey, 'l_quantity' as field, 'custom_rule' as type, 'error' as severity
from lineitem where l_quantity < 3 or l_quantity > 45""")
def val_custom_range(t):
    df = t.lineitem.select("l_orderkey", "l_quantity")
    rule = CustomRule("l_quantity", "range", min=3, max=45)
    return found(df, "l_orderkey", compile_checks(df, [Field("l_quantity", "double")], [], [rule]))


@query("val_custom_enum", views=("orders_faulty",), sql="""
select o_orderkey, 'o_orderpriority' as field, 'custom_rule' as type, 'error' as severity
from orders_faulty where o_orderpriority = '9-BOGUS'""")
def val_custom_enum(t):
    df = t.orders_faulty
    return found(df, "o_orderkey", compile_checks(df, ORDER_FIELDS, [], ORDER_CUSTOM))


@query("val_custom_fn", sql="""
select p_partkey, 'p_retailprice' as field, 'custom_rule' as type, 'error' as severity
from part where p_retailprice > 905 and p_size < 10""")
def val_custom_fn(t):
    df = t.part.select("p_partkey", "p_retailprice", "p_size")
    rule = CustomRule("p_retailprice", "custom", fails=(F.col("p_retailprice") > 905) & (F.col("p_size") < 10))
    return found(df, "p_partkey", compile_checks(df, [Field("p_retailprice", "double")], [], [rule]))


@query("val_custom_pattern", sql="""
select d.doc_id, 'lang' as field, 'custom_rule' as type, 'error' as severity
from documents d where not regexp_matches(lang, '^(en|fr)$')
union all
select d.doc_id, 'quality', 'custom_rule', 'error'
from documents d left join labels l on d.doc_id = l.doc_id where l.quality is null""")
def val_custom_pattern(t):
    df = t.documents.select("doc_id", "lang").join(t.labels, "doc_id", "left")
    rules = [CustomRule("lang", "regex", pattern="^(en|fr)$"), CustomRule("quality", "required")]
    return found(df, "doc_id", compile_checks(
        df, [Field("lang", "string"), Field("quality", "integer")], [], rules))


@query("val_record", views=("orders_faulty",), sql="with " + CHECKED + """
select o_orderkey, n_err = 0 as valid, n_err as n_errors, n_warn as n_warnings
  , round(n_err / 7.0, 6) as error_rate, round(n_warn / 7.0, 6) as warning_rate, round(n_null / 7.0, 6) as null_rate
from checked""")
def val_record(t):
    df = t.orders_faulty
    out = v.record_verdict(df, ORDER_FIELDS, order_checks(df)).select(
        "o_orderkey", "valid", F.size("errors").alias("n_errors"), F.size("warnings").alias("n_warnings"),
        "error_rate", "warning_rate", "null_rate")
    return rounded(out, "error_rate", "warning_rate", "null_rate")


@query("val_batch", views=("orders_faulty",), sql="with " + BATCHES + """
select y, m, total_records, valid_records, error_records, warning_records, error_count, warning_count
  , round(error_records / total_records, 6) as error_rate, round(warning_records / total_records, 6) as warning_rate
  , round(nulls / (7.0 * total_records), 6) as null_rate
from batches""")
def val_batch(t):
    return rounded(monthly_batches(t), "error_rate", "warning_rate", "null_rate")


@query("profile_columns", sql="""
with q as (
  select 'l_quantity' as field, 'float' as value_type, l_quantity as v from lineitem
  union all select 'l_discount', 'float', l_discount from lineitem
  union all select 'l_extendedprice', 'float', l_extendedprice from lineitem
  union all select 'l_linenumber', 'integer', l_linenumber from lineitem)
select field, value_type, count(v) as non_null_count, count(*) - count(v) as null_count
  , count(v) / count(*) as population_rate, count(distinct v) as unique_values
  , cast(min(v) as double) as min, cast(max(v) as double) as max, round(avg(v), 4) as mean, round(stddev_pop(v), 4) as stddev
  , cast(null as double) as average_length
from q group by 1, 2
union all
select 'l_returnflag', 'string', count(l_returnflag), count(*) - count(l_returnflag), count(l_returnflag) / count(*)
  , count(distinct l_returnflag), null, null, null, null, avg(length(l_returnflag)) from lineitem""")
def profile_columns(t):
    cols = ["l_quantity", "l_discount", "l_extendedprice", "l_linenumber", "l_returnflag"]
    return rounded(v.profile(t.lineitem, cols), "mean", "stddev", places=4)


@query("profile_merged", sql="""
with q as (
  select 'l_quantity' as field, cast(l_quantity as double) as v, cast(l_quantity as varchar) as t from lineitem
  union all select 'l_extendedprice', cast(l_extendedprice as double), cast(l_extendedprice as varchar) from lineitem
  union all select 'l_linenumber', cast(l_linenumber as double), cast(l_linenumber as varchar) from lineitem
  union all select 'l_returnflag', null, l_returnflag from lineitem)
select field, count(t) as non_null_count, count(*) - count(t) as null_count, min(v) as min, max(v) as max
  , round(avg(v), 4) as mean, round(stddev_pop(v), 4) as stddev, true as distinct_close, true as median_close
  , case field when 'l_returnflag' then 'string' when 'l_linenumber' then 'integer' else 'float' end as value_type
from q group by 1""")
def profile_merged(t):
    """Monthly states merged to the whole; sketches compared with exact counts and ranks."""
    cols = ["l_quantity", "l_extendedprice", "l_linenumber", "l_returnflag"]
    months = profiles.accumulate(t.lineitem.withColumn("month", F.date_trunc("month", "l_shipdate")), cols, ["month"])
    whole = profiles.finish(profiles.merge(months), quantiles=(0.5,))
    exact = v.profile(t.lineitem, cols).select("field", F.col("unique_values").alias("__unique"))
    medians = {r["field"]: r["m"] for r in whole.select("field", F.col("quantiles")[0].alias("m")).collect()}  # a row per column
    ranks = t.lineitem.agg(F.count("*").alias("__n"), *[
        F.array(F.count_if(F.col(c) < medians[c]), F.count_if(F.col(c) <= medians[c])).alias(c) for c in cols[:3]])
    spans = ranks.select("__n", F.inline(F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).alias("__span")) for c in cols[:3]])))
    out = whole.join(exact, "field").join(spans, "field", "left")
    median = (F.col("__span")[0] <= 0.52 * F.col("__n")) & (F.col("__span")[1] >= 0.48 * F.col("__n"))
    return rounded(out.select(
        "field", "non_null_count", "null_count", "min", "max", "mean", "stddev",
        (F.abs(F.col("unique_values") - F.col("__unique")) <= 0.05 * F.col("__unique")).alias("distinct_close"),
        F.coalesce(median, F.lit(True)).alias("median_close"), F.col("value_types")[0]["value_type"].alias("value_type"),
    ), "mean", "stddev", places=4)


@query("profile_types", views=("orders_faulty",), sql="""
select 'props' as field, case when k % 3 = 0 then 'integer' when k % 3 = 1 then 'string' else 'float' end as value_type
  , count(*) as n, round(count(*) / sum(count(*)) over (), 6) as share
from (select cast(json_extract(props, '$.k') as bigint) as k from events) group by 2""")
def profile_types(t):
    k = F.get_json_object("props", "$.k").cast("long")
    text = (F.when(k % 3 == 0, k.cast("string")).when(k % 3 == 1, F.concat(F.lit('"'), k.cast("string"), F.lit('"')))
            .otherwise(F.concat(k.cast("string"), F.lit(".5"))))
    df = t.events.select(F.parse_json(text).alias("props"))
    return rounded(v.type_distribution(df, ["props"]), "share")


@query("profile_samples", sql="""
with x as (
  select distinct 'p_brand' as field, p_brand as value from part
  union select distinct 'p_name', p_name from part)
select field, value, cast(row_number() over (partition by field order by value) as int) as position
from x qualify row_number() over (partition by field order by value) <= 5""")
def profile_samples(t):
    return v.sample_values(t.part, ["p_brand", "p_name"], 5)


@query("val_sample", sql="""
select o_orderkey, o_orderkey // 10000 as batch from orders where substr(md5(cast(o_orderkey as varchar)), 1, 8) < '4ccccccc'""")
def val_sample(t):
    df = t.orders.select("o_orderkey", F.floor(F.col("o_orderkey") / 10000).alias("batch"))
    return v.hash_sample(df, ["o_orderkey"], 0.3)


@query("val_gate", views=("orders_faulty",), sql="with " + CHECKED + """
select o_orderkey, o_orderdate from checked
where o_orderdate not in (select o_orderdate from checked where n_err > 0)""")
def val_gate(t):
    df = t.orders_faulty
    return v.strict_gate(df, ["o_orderdate"], order_checks(df)).select("o_orderkey", "o_orderdate")


@query("val_object", views=("orders_faulty",), sql="with " + OBJECTS + """
select y, batches, total_records, processed_records, error_records, warning_records, status
  , round(error_rate, 6) as error_rate, round(warning_rate, 6) as warning_rate, round(null_rate, 6) as null_rate
from objects""")
def val_object(t):
    return rounded(yearly_objects(t), "error_rate", "warning_rate", "null_rate")


@query("val_alerts", views=("orders_faulty",), sql="with " + OBJECTS + """
select 'error_threshold' as type, cast(y as varchar) as object_name, cast(null as varchar) as field_name
  , case when error_rate / 0.02 >= 3 then 'critical' when error_rate / 0.02 >= 2 then 'high'
      when error_rate / 0.02 >= 1.5 then 'medium' else 'low' end as severity
  , cast(0.02 as double) as threshold, round(error_rate, 6) as actual_value
from objects where error_rate > 0.02
union all
select 'data_quality', cast(year(o_orderdate) as varchar), f, 'low', null, null
from (
  select o_orderdate, 'o_totalprice' as f from orders_faulty where lower(o_totalprice) = 'n/a'
  union all select o_orderdate, 'o_orderstatus' from orders_faulty where trim(o_orderstatus) = '')""")
def val_alerts(t):
    df = t.orders_faulty.withColumn("y", F.year("o_orderdate"))
    quality = v.record_issues(df, ["y"], compile_checks(df, ORDER_FIELDS, ["quality"]))
    out = v.validation_alerts(yearly_objects(t), "y", 0.02, quality_issues=quality)
    return rounded(out.drop("message"), "actual_value")


@query("val_summary", views=("orders_faulty",), sql="with " + OBJECTS + """
select count(*) as total_objects, count(*) filter (status = 'success') as successful_objects
  , count(*) filter (status = 'warning') as warning_objects, count(*) filter (status = 'error') as error_objects
  , cast(sum(total_records) as bigint) as total_records
  , round(sum(error_records) / sum(total_records), 6) as error_rate
  , round(sum(warning_records) / sum(total_records), 6) as warning_rate
  , case when count(*) filter (status = 'error') > 0 then 'error'
      when count(*) filter (status = 'warning') > 0 then 'warning' else 'success' end as overall_status
from objects""")
def val_summary(t):
    return rounded(v.run_summary(yearly_objects(t)), "error_rate", "warning_rate")


@query("recent_reports", sql="""
select event_id, ts, event_type from events order by ts desc, event_id desc limit 25""")
def recent_reports(t):
    return v.recent_reports(t.events.select("event_id", "ts", "event_type"), "ts", "event_id", 25)
