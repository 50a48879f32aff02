"""DuckDB statements that state the expected result of each registered query."""

from __future__ import annotations

TXN = """txn as (
select o.o_orderkey as txn_id, o.o_custkey as customer_id,
  o.o_orderdate + to_minutes(cast(o.o_orderkey * 37 % 1440 as int)) as txn_ts, o.o_totalprice as amount,
  cast(case when n.n_regionkey <> o.o_orderkey % 5 then 0 else 1 end as int) as is_intl,
  cast((o.o_orderkey * 13) % 50 as double) as previous_txns,
  cast(50 + (o.o_custkey * 17) % 400 as double) as average_spend,
  cast((o.o_orderkey * 29) % 2000 as double) as account_age_days,
  c.c_mktsegment as category, o.o_orderpriority as method, o.o_orderstatus as device, n.n_name as location,
  case when (o.o_orderkey * 31) % 10 = 0 then 'Yes' else 'No' end as keyword,
  cast(case when (o.o_orderkey * 7919 + o.o_custkey * 104729) % 1000
    < 30 + case when o.o_orderpriority = '1-URGENT' then 150 else 0 end
         + case when c.c_mktsegment = 'MACHINERY' then 80 else 0 end
         + case when o.o_totalprice > 400000 then 100 else 0 end then 1 else 0 end as int) as label,
  cast((o.o_orderkey * 7919 + o.o_custkey * 31) % 997 as double) / 997 as pseudo_score
from orders o join customer c on o.o_custkey = c.c_custkey join nation n on c.c_nationkey = n.n_nationkey)"""

SPLIT = TXN + """,
placed as (select txn_ts, row_number() over (order by txn_ts, txn_id) - 1 as rn, count(*) over () as n from txn),
cuts as (select max(case when rn = cast(floor(n * cast(0.6 as double)) as bigint) then txn_ts end) as c1,
  max(case when rn = cast(floor(n * cast(0.8 as double)) as bigint) then txn_ts end) as c2 from placed),
sp as (select t.*, case when txn_ts < c1 then 'train' when txn_ts < c2 then 'validation' else 'test' end as split
  from txn t, cuts)"""

SCORED = SPLIT + """,
scored0 as (select *, pseudo_score as fraud_score,
  cast((txn_id * 104729 + customer_id * 17) % 1009 as double) / 1009 as anomaly_score from sp),
scored as (select *, cast(fraud_score >= 0.9 as int) as predicted_fraud, cast(anomaly_score >= 0.9 as int) as anomaly_flag,
  case when fraud_score >= 0.9 then 'Model review' when anomaly_score >= 0.9 then 'Anomaly review' else 'Lower score' end as review_status,
  case split when 'train' then 'in-sample' when 'validation' then 'selection/tuning' else 'held-out evaluation' end as score_context,
  case label when 0 then 'Legitimate' when 1 then 'Fraudulent' end as actual_label
  from scored0)"""

LONG = SCORED + """,
prior as (select avg(label) as p from scored where split = 'train'),
cutoff as (select quantile_cont(anomaly_score, 0.9) as t from scored where split = 'train'),
long as (
  select txn_id, customer_id, split, label, 'Pseudo' as model, 'supervised' as kind, fraud_score as score from scored
  union all select txn_id, customer_id, split, label, 'Mixed', 'supervised',
    fraud_score * 0.7 + label * (cast(txn_id % 7 as double) / 7) * 0.3 from scored
  union all select txn_id, customer_id, split, label, 'Prior', 'baseline', p from scored, prior
  union all select txn_id, customer_id, split, label, 'Anomaly', 'unsupervised', anomaly_score from scored)"""

RAW = TXN + """,
raw0 as (select
  case when txn_id % 997 = 0 then '   ' else 'T' || txn_id end as Transaction_ID,
  'C' || customer_id as Customer_ID,
  case when txn_id % 501 = 0 then 'not-a-date'
       when txn_id % 3 = 0 then strftime(txn_ts, '%Y-%m-%d %H:%M:%S')
       else strftime(txn_ts, '%d-%m-%Y %H:%M') end as Transaction_Date,
  case when txn_id % 401 = 0 then '-1' when txn_id % 403 = 0 then 'bad' when txn_id % 409 = 0 then null
       else cast(amount as varchar) end as Transaction_Amount,
  case when txn_id % 307 = 0 then '2' else cast(is_intl as varchar) end as Is_International,
  case when txn_id % 211 = 0 then '3.5' else cast(cast(previous_txns as bigint) as varchar) end as Previous_Transactions,
  cast(cast(average_spend as bigint) as varchar) as Average_Spend,
  cast(cast(account_age_days as bigint) as varchar) as Account_Age_Days,
  case when txn_id % 89 = 0 then null when txn_id % 5 = 0 then '  ' || category || ' ' else category end as Merchant_Category,
  method as Payment_Method, device as Device_Type, location as Location, keyword as Suspicious_Keyword,
  case when txn_id % 701 = 0 then '7' else cast(label as varchar) end as Fraudulent,
  txn_id as k from txn),
raw as (select * from raw0 union all select * from raw0 where k % 50 = 0),
uniq as (select distinct * exclude (k) from raw),
typed as (select
  nullif(trim(Transaction_ID), '') as txn_id, nullif(trim(Customer_ID), '') as customer_id,
  coalesce(try_strptime(Transaction_Date, '%d-%m-%Y %H:%M'), try_cast(Transaction_Date as timestamp)) as txn_ts,
  case when try_cast(Transaction_Amount as double) >= 0 then try_cast(Transaction_Amount as double) end as amount,
  case when try_cast(Is_International as double) in (0, 1) then cast(Is_International as double) end as is_intl,
  case when try_cast(Previous_Transactions as double) >= 0 and try_cast(Previous_Transactions as double) % 1 = 0
    then cast(Previous_Transactions as double) end as previous_txns,
  cast(Average_Spend as double) as average_spend, cast(Account_Age_Days as double) as account_age_days,
  nullif(trim(Merchant_Category), '') as category, Payment_Method as method, Device_Type as device, Location as location,
  Suspicious_Keyword as keyword,
  case when try_cast(Fraudulent as double) in (0, 1) then cast(Fraudulent as int) end as label,
  Transaction_Amount as raw_amount, Is_International as raw_is_intl, Previous_Transactions as raw_previous_txns,
  Average_Spend as raw_average_spend, Account_Age_Days as raw_account_age_days
  from uniq),
valid as (select * from typed where txn_id is not null and customer_id is not null and txn_ts is not null and label is not null)"""


def ranked(source: str, groups: str = "") -> str:
    """CTE ``rk``: the cumulative table of ``source`` per group and distinct score."""
    g = f"{groups}, " if groups else ""
    part = f"partition by {groups}" if groups else ""
    return f"""pts as (select {g}score, sum(label) as pos, count(*) as alerts from {source} group by {g}score),
rk as (select *, sum(pos) over (w rows unbounded preceding) as cum_pos, sum(alerts) over (w rows unbounded preceding) as cum_alerts,
  sum(pos) over ({part}) as all_pos, sum(alerts) over ({part}) as all_alerts,
  lead(pos) over w as next_pos, lead(alerts) over w as next_alerts
  from pts window w as ({part} order by score desc))"""


def metric_cols(threshold: str) -> str:
    """Select list of the metric record over ``rk`` rows (grouped by the caller)."""
    return f"""cast(sum(alerts) as bigint) as n, cast(sum(pos) as bigint) as positives,
  sum(pos) / sum(alerts) as prevalence, max({threshold}) as threshold,
  coalesce(sum(pos) filter (score >= {threshold}) / nullif(sum(alerts) filter (score >= {threshold}), 0), 0.0) as precision,
  coalesce(coalesce(sum(pos) filter (score >= {threshold}), 0) / nullif(sum(pos), 0), 0.0) as recall,
  2.0 * coalesce(sum(pos) filter (score >= {threshold}), 0)
    / (coalesce(sum(alerts) filter (score >= {threshold}), 0) + sum(pos)) as f1,
  sum((alerts - pos) * (cum_pos - pos / 2.0)) / (sum(pos) * sum(alerts - pos)) as roc_auc,
  sum(pos * (cum_pos / cum_alerts)) / sum(pos) as average_precision,
  sum(pos * (cum_pos / cum_alerts
    + case when cum_alerts > alerts then (cum_pos - pos) / (cum_alerts - alerts) else 1.0 end) / 2.0) / sum(pos) as pr_auc,
  cast(sum(alerts) - sum(pos) - coalesce(sum(alerts - pos) filter (score >= {threshold}), 0) as bigint) as tn,
  cast(coalesce(sum(alerts - pos) filter (score >= {threshold}), 0) as bigint) as fp,
  cast(sum(pos) - coalesce(sum(pos) filter (score >= {threshold}), 0) as bigint) as fn,
  cast(coalesce(sum(pos) filter (score >= {threshold}), 0) as bigint) as tp,
  cast(coalesce(sum(alerts) filter (score >= {threshold}), 0) as bigint) as alert_count,
  coalesce(sum(alerts) filter (score >= {threshold}), 0) / sum(alerts) as alert_rate"""


RATES = ["prevalence", "threshold", "precision", "recall", "f1", "roc_auc", "average_precision", "pr_auc", "alert_rate"]
COUNTS = ["n", "positives", "tn", "fp", "fn", "tp", "alert_count"]


def rounded(source: str, keys: str = "", cols: list[str] | None = None) -> str:
    """Final select over a metric CTE with every rate at nine digits."""
    cols = cols or RATES + COUNTS
    items = [f"round({c}, 9) as {c}" if c in RATES else c for c in cols]
    return f"select {keys + ', ' if keys else ''}{', '.join(items)} from {source}"
