"""Independent SQL oracle (DuckDB dialect) for every query of the catalog.

The oracle is written the *direct* way — history as a join of each sample
with all earlier orders of its member, labels as ``EXISTS`` sub-queries,
sweeps as one query per setting — so that it checks the window-frame
formulation used on Spark rather than repeating it.  Double columns are
rounded to 6 decimals, as the Spark side does.
"""

from __future__ import annotations

from rekindle.config import ADAPTER_A, ADAPTER_B, RevivalConfig
from rekindle.operators.features import CATEGORICAL_COLS, FEATURE_COLS, FEATURE_GROUPS, RATIO_FEATURES, WATCH_LIST

NUMERIC_FEATURES = [c for c in FEATURE_COLS if c not in CATEGORICAL_COLS]
DOUBLE_FEATURES = {
    "hist_total_amount", "hist_avg_ticket", "hist_max_ticket", "hist_total_qty", "personal_ci",
    "gap_std", "gap_cv", "hist_discount_ratio", "hist_coupon_order_ratio", "hist_return_ratio",
    "t0_amount", "t0_discount_ratio", "hist_repeat_sku_ratio", "t0_avg_unit_price",
    "t0_min_unit_price", "t0_max_unit_price", "age_at_t0", "member_card_level",
    "t0_vs_avg_ticket_ratio", "t0_vs_max_ticket_ratio", "sleep_vs_ci_ratio",
    "t0_discount_vs_hist_ratio", "t0_used_coupon_vs_hist", "t0_qty_vs_avg",
    "pre_dormancy_90d_amount"}


def R(e: str) -> str:
    return f"(round({e}, 6) + 0.0)"


def sd(n: str, d: str) -> str:
    """safe division"""
    return (f"(case when ({d}) is null or ({d}) = 0 or ({n}) is null then null "
            f"else cast({n} as double) / cast({d} as double) end)")


def fdays(later: str, earlier: str) -> str:
    return (f"cast(floor(date_diff('microsecond', cast({earlier} as timestamp), "
            f"cast({later} as timestamp)) / 86400000000) as bigint)")


def wrap(body: str, cols: list[str], doubles) -> str:
    sel = ", ".join(R(f'"{c}"') + f' as "{c}"' if c in doubles else f'"{c}"' for c in cols)
    return f"select {sel} from ({body}) _w"


# ----------------------------------------------------------------------------- adapters
BASE = """
li as (
  select l_orderkey, count(distinct l_partkey) as ts_count, cast(sum(l_quantity) as integer) as qty,
         cast(sum(cast(l_extendedprice as decimal(18,2))) as double) as total_price,
         -cast(sum(cast(l_extendedprice as decimal(18,2)) * cast(l_discount as decimal(4,2))) as double)
           as total_discount,
         -cast(sum(case when l_returnflag = 'A' and l_linenumber = 7
                        then cast(l_extendedprice as decimal(18,2)) else cast(0 as decimal(18,2)) end)
               as double) as total_coupon_discount
  from lineitem group by l_orderkey),
oa as (
  select o_custkey as member_id, o_orderkey as order_code, o_orderdate as order_ts,
         case o_orderstatus when 'F' then 'Finish' when 'O' then 'Return' else 'Fail' end as status,
         o_totalprice as sales_amount, ts_count, qty, total_price, total_discount, total_coupon_discount,
         case when o_orderkey % 3 = 0 then 'Web' when o_orderkey % 3 = 1 then 'App' else null end as channel,
         o_orderpriority as payment,
         case when o_orderkey % 5 = 0 then null else concat('S', cast(o_orderkey % 5 as varchar)) end
           as shipping
  from orders left join li on l_orderkey = o_orderkey),
ob as (
  select user_id as member_id, event_id as order_code, ts as order_ts,
         case event_type when 'purchase' then 'Finish' when 'click' then 'Shipping' else 'Fail' end
           as status,
         value as sales_amount, cast(null as bigint) as ts_count, cast(null as integer) as qty,
         cast(null as double) as total_price, cast(null as double) as total_discount,
         cast(null as double) as total_coupon_discount, cast(null as varchar) as channel,
         cast(null as varchar) as payment, cast(null as varchar) as shipping
  from events),
la as (
  select o_custkey as member_id, l_orderkey as order_code, o_orderdate as order_ts,
         case when l_partkey % 11 = 0 then null else l_partkey % 97 end as sale_page_id,
         cast(l_quantity as integer) as qty, l_extendedprice / l_quantity as unit_price,
         case o_orderstatus when 'F' then 'Finish' when 'O' then 'Return' else 'Fail' end as status
  from lineitem join orders on l_orderkey = o_orderkey),
lv as (
  select member_id, order_code, order_ts, sale_page_id, qty, unit_price from la
  where coalesce(status <> 'Fail', true) and unit_price > 0),
ma as (
  select c_custkey as member_id, c_mktsegment as register_source,
         case when c_custkey % 10 = 0 then date '1900-01-01'
              else date '1994-06-01' + cast((c_custkey * 13) % 1500 as integer) end as register_date,
         case when c_custkey % 4 = 0 then null when c_custkey % 2 = 0 then 'F' else 'M' end as gender,
         case when c_custkey % 8 = 0 then date '1900-01-01' when c_custkey % 50 = 1 then date '2020-01-01'
              else date '1945-01-01' + cast((c_custkey * 37) % 15000 as integer) end as birthday,
         case when c_acctbal < 0 then 0 when c_acctbal < 5000 then 10 else 20 end as card_level,
         c_custkey % 3 = 0 as is_app_installed,
         c_custkey % 2 = 0 as optin_email, c_custkey % 5 <> 0 as optin_push,
         case when c_custkey % 7 = 0 then null else true end as optin_sms,
         n_name as country
  from customer left join nation on n_nationkey = c_nationkey),
mc as (
  select member_id, register_source,
         case when register_date = date '1900-01-01' then null else register_date end as register_date,
         gender,
         case when birthday = date '1900-01-01' then null else birthday end as birthday,
         case when card_level = 0 then null else cast(card_level as double) end as card_level,
         is_app_installed, optin_email, optin_push, optin_sms, country
  from ma),
scored as (
  select o_orderkey as id, cast((o_orderkey * 37) % 101 as double) / 100 as score,
         case when (o_orderkey * 7919) % 100 < 20 + ((o_orderkey * 37) % 101) * 0.6 then 1 else 0 end
           as label,
         case when o_orderkey % 3 = 0 then 'test' else 'train' end as split,
         o_totalprice as f1, case when o_orderkey % 9 = 0 then null else o_orderkey % 50 end as f2
  from orders)
"""


def split_case(cfg: RevivalConfig) -> str:
    if cfg.train_end is None:
        return "'train'"
    return (f"case when t0_date <= date '{cfg.train_end}' then 'train' "
            f"when t0_date >= date '{cfg.test_start}' then 'test' else 'embargo' end")


def sample_ctes(p: str, src: str, cfg: RevivalConfig) -> str:
    cutoff = f"t0_date <= date '{cfg.censor_cutoff}'" if cfg.censor_cutoff else "true"
    return f"""
{p}valid as (
  select *, cast(order_ts as date) as date from {src}
  where coalesce(status <> 'Fail', true) and sales_amount > 0),
{p}mdays as (
  select member_id, date, order_code as t0_order_code, order_ts as t0_order_ts from (
    select *, row_number() over (partition by member_id, date
               order by coalesce(status = 'Finish', false) desc, sales_amount desc, order_code) as rn
    from {p}valid) where rn = 1),
{p}gaps0 as (
  select member_id, lag(date) over (partition by member_id order by date) as date_from,
         date as date_to, t0_order_code, t0_order_ts from {p}mdays),
{p}gaps as (
  select member_id, date_from, date_to, cast(date_diff('day', date_from, date_to) as integer) as gap_days,
         t0_order_code, t0_order_ts
  from {p}gaps0 where date_from is not null),
{p}gci as (
  select *, count(gap_days) over w as n_prior, quantile_cont(gap_days, 0.5) over w as med
  from {p}gaps
  window w as (partition by member_id order by date_to rows between unbounded preceding and 1 preceding)),
{p}gthr as (
  select member_id, date_from, date_to, gap_days, t0_order_code, t0_order_ts, n_prior,
         case when n_prior >= 1 then cast(trunc(med) as integer) else {cfg.fallback_ci} end as ci_days,
         case when n_prior >= 2 then 'median' when n_prior = 1 then 'single' else 'fallback' end
           as ci_branch
  from {p}gci),
{p}gthr2 as (
  select *, cast(trunc(greatest({cfg.clip_lo}, least({cfg.clip_hi}, ci_days * {float(cfg.k)})))
                 as integer) as threshold_days
  from {p}gthr),
{p}events as (
  select member_id, date_to as t0_date, t0_order_code, t0_order_ts from {p}gthr2
  where gap_days > threshold_days),
{p}o1 as (
  select * from (select *, row_number() over (partition by order_code order by order_ts, member_id) as rn
                 from {p}valid) where rn = 1),
{p}labelled as (
  select e.*, case when exists (
             select 1 from {p}o1 o where o.member_id = e.member_id and o.order_ts > e.t0_order_ts
               and o.order_ts <= e.t0_order_ts + interval {cfg.window_days} day
               and o.order_code <> e.t0_order_code) then 1 else 0 end as label
  from {p}events e),
{p}split as (select *, {split_case(cfg)} as split from {p}labelled where {cutoff}),
{p}samples as (
  select row_number() over (order by t0_date, member_id, t0_order_code) - 1 as sample_id,
         label, member_id, t0_date, t0_order_code, split, t0_order_ts
  from {p}split where split <> 'embargo')
"""


def flagged_cte(name: str, src: str) -> str:
    return f"""
{name} as (
  select member_id, order_code, order_ts, status, sales_amount, ts_count, qty, total_price,
         total_discount, total_coupon_discount,
         coalesce(channel, 'unknown') as channel, coalesce(payment, 'unknown') as payment,
         coalesce(shipping, 'unknown') as shipping,
         cast(coalesce(status = 'Return', false) as integer) as is_return,
         cast(coalesce(coalesce(status <> 'Fail', true) and sales_amount > 0, false) as integer) as is_valid,
         cast(coalesce(status <> 'Fail', true) as integer) as is_nonfail
  from (select *, row_number() over (partition by order_code order by order_ts, member_id) as rn
        from {src}) where rn = 1)
"""


def history_ctes(p: str, smp: str, ofl: str, cfg: RevivalConfig) -> str:
    """F1 and F6 by explicit history join (sample x earlier orders of the member)."""
    rec = ",\n         ".join(
        f"count(*) filter (where h.order_ts > cast(h.t0_date as timestamp) - interval {n} day) as r{n}"
        for n in cfg.recent_days)
    rec_out = ",\n         ".join(
        f"cast(coalesce(r{n}, 0) as integer) as recent_{n}d_n_orders" for n in cfg.recent_days)
    P = cfg.pre_dormancy_days
    return f"""
{p}hist as (
  select s.sample_id, s.t0_date, o.* from {smp} s
  join {ofl} o on o.member_id = s.member_id and o.order_ts < cast(s.t0_date as timestamp)),
{p}hv as (select * from {p}hist where is_valid = 1),
{p}f1a as (
  select sample_id, count(sales_amount) as n, sum(cast(sales_amount as decimal(38,6))) as amt,
         max(sales_amount) as mx, sum(qty) as qty,
         sum(cast(abs(total_discount) as decimal(38,6))) as disc,
         sum(cast(total_price as decimal(38,6))) as price,
         count(*) filter (where coalesce(total_coupon_discount <> 0, {str(cfg.null_coupon_is_used).lower()}))
           as coupon,
         max(order_ts) as last_ts, min(order_ts) as first_ts
  from {p}hv group by sample_id),
{p}f1r as (select sample_id, count(*) as nf, sum(is_return) as ret from {p}hist
           where is_nonfail = 1 group by sample_id),
{p}hd as (select distinct sample_id, cast(order_ts as date) as d from {p}hv),
{p}hg as (select sample_id, date_diff('day', lag(d) over (partition by sample_id order by d), d) as gap
          from {p}hd),
{p}f1g as (select sample_id, count(gap) as ng, quantile_cont(gap, 0.5) as med, stddev_samp(gap) as sd
           from {p}hg where gap is not null group by sample_id),
{p}mch as (
  select sample_id, v from (
    select sample_id, v, row_number() over (partition by sample_id order by c desc, v) as rn
    from (select sample_id, channel as v, count(*) as c from {p}hv group by 1, 2)) where rn = 1),
{p}mpay as (
  select sample_id, v from (
    select sample_id, v, row_number() over (partition by sample_id order by c desc, v) as rn
    from (select sample_id, payment as v, count(*) as c from {p}hv group by 1, 2)) where rn = 1),
{p}f1 as (
  select s.sample_id,
         {fdays('s.t0_date', 'a.last_ts')} as sleep_days,
         a.n as hist_n_orders,
         cast(a.amt as double) as hist_total_amount,
         {sd('cast(a.amt as double)', 'a.n')} as hist_avg_ticket,
         a.mx as hist_max_ticket,
         case when a.n > 0 then cast(coalesce(a.qty, 0) as double) end as hist_total_qty,
         case when g.ng >= 2 then g.med end as personal_ci,
         case when g.ng >= 2 then g.sd end as gap_std,
         case when g.ng >= 2 then {sd('g.sd', 'g.med')} end as gap_cv,
         case when a.n > 0 then {sd('cast(coalesce(a.disc, 0) as double)',
                                    'cast(coalesce(a.price, 0) as double)')} end as hist_discount_ratio,
         {sd('a.coupon', 'a.n')} as hist_coupon_order_ratio,
         case when r.nf > 0 then {sd('r.ret', 'r.nf')} end as hist_return_ratio,
         coalesce(mch.v, 'unknown') as hist_main_channel,
         coalesce(mpay.v, 'unknown') as hist_main_payment,
         {fdays('s.t0_date', 'a.first_ts')} as member_tenure_days,
         case when {fdays('s.t0_date', 'a.last_ts')} > {cfg.sealed_days} then 1 else 0 end as was_sealed,
         case when a.n = 1 then 1 else 0 end as prior_once_only,
         a.last_ts as max_hist_ts
  from {smp} s left join {p}f1a a using (sample_id) left join {p}f1r r using (sample_id)
       left join {p}f1g g using (sample_id) left join {p}mch mch using (sample_id)
       left join {p}mpay mpay using (sample_id)),
{p}f6a as (
  select h.sample_id,
         {rec}
  from {p}hv h group by 1),
{p}lp as (
  select s.sample_id, cast(s.t0_date as timestamp) - to_days(cast(f.sleep_days as integer)) as lpd
  from {smp} s join {p}f1 f using (sample_id) where f.sleep_days is not null),
{p}f6p as (
  select h.sample_id, count(*) as pn, sum(cast(h.sales_amount as decimal(38,6))) as pa
  from {p}hv h join {p}lp lp using (sample_id)
  where h.order_ts > lp.lpd - interval {P} day and h.order_ts <= lp.lpd group by 1),
{p}f6 as (
  select s.sample_id,
         {rec_out},
         cast(coalesce(pn, 0) as integer) as pre_dormancy_90d_n_orders,
         coalesce(cast(pa as double), 0.0) as pre_dormancy_90d_amount
  from {smp} s left join {p}f6a using (sample_id) left join {p}f6p using (sample_id))
"""


def feature_ctes(cfg: RevivalConfig) -> str:
    promo = ", ".join(str(m) for m in cfg.promo_months)
    return f"""
f2 as (
  select s.sample_id, o.sales_amount as t0_amount, cast(o.ts_count as bigint) as t0_ts_count,
         cast(o.qty as bigint) as t0_qty,
         cast(coalesce(o.total_coupon_discount <> 0, true) as integer) as t0_used_coupon,
         {sd('abs(o.total_discount)', 'o.total_price')} as t0_discount_ratio,
         coalesce(o.channel, 'unknown') as t0_channel, coalesce(o.payment, 'unknown') as t0_payment,
         coalesce(o.shipping, 'unknown') as t0_shipping,
         cast(month(s.t0_date) as integer) as t0_month,
         cast(isodow(s.t0_date) - 1 as integer) as t0_weekday,
         case when isodow(s.t0_date) in (6, 7) then 1 else 0 end as t0_is_weekend,
         case when month(s.t0_date) in ({promo}) then 1 else 0 end as t0_is_big_promo
  from a_samples s left join (select * from ofl where is_valid = 1) o on o.order_code = s.t0_order_code),
hl as (
  select s.sample_id, l.* from a_samples s
  join lv l on l.member_id = s.member_id and l.order_ts < cast(s.t0_date as timestamp)),
h3 as (select sample_id, count(distinct sale_page_id) as nd from hl group by 1),
rp as (select sample_id, sale_page_id, count(*) as c from hl where sale_page_id is not null group by 1, 2),
r3 as (select sample_id, sum(case when c > 1 then 1 else 0 end) as nrep, count(*) as ntot from rp group by 1),
t0l as (
  select s.sample_id, s.member_id, s.t0_date, l.sale_page_id, l.unit_price
  from a_samples s join lv l on l.order_code = s.t0_order_code),
t0a as (
  select sample_id, count(distinct sale_page_id) as t0_n_distinct_salepages,
         cast(sum(cast(unit_price as decimal(38,7))) as double) / count(unit_price) as t0_avg_unit_price,
         min(unit_price) as t0_min_unit_price,
         max(unit_price) as t0_max_unit_price
  from t0l group by 1),
fam as (select distinct t.sample_id from t0l t join hl h on h.sample_id = t.sample_id
        and h.sale_page_id = t.sale_page_id),
famns as (select distinct t.sample_id from t0l t join hl h on h.sample_id = t.sample_id
          and h.sale_page_id is not distinct from t.sale_page_id),
f3 as (
  select s.sample_id, h3.nd as hist_distinct_salepages,
         {sd('r3.nrep', 'r3.ntot')} as hist_repeat_sku_ratio,
         t0a.t0_n_distinct_salepages,
         case when t0a.sample_id is null then null when fam.sample_id is null then 0 else 1 end
           as t0_buys_familiar_product,
         case when t0a.sample_id is null then null when famns.sample_id is null then 0 else 1 end
           as t0_buys_familiar_product_ns,
         t0a.t0_avg_unit_price, t0a.t0_min_unit_price, t0a.t0_max_unit_price
  from a_samples s left join h3 using (sample_id) left join r3 using (sample_id)
       left join t0a using (sample_id) left join fam using (sample_id) left join famns using (sample_id)),
f4 as (
  select s.sample_id, coalesce(m.register_source, 'unknown') as register_source, m.gender,
         {fdays('s.t0_date', 'm.birthday')} / 365.25 as age_at_t0,
         {fdays('s.t0_date', 'm.register_date')} as days_since_register,
         coalesce(m.country, 'unknown') as country_code,
         m.card_level as member_card_level,
         cast(m.is_app_installed as integer) as is_app_installed,
         cast(coalesce(m.optin_email, false) as integer) + cast(coalesce(m.optin_push, false) as integer)
           + cast(coalesce(m.optin_sms, false) as integer) as marketing_optin_count
  from a_samples s left join mc m using (member_id)),
f5 as (
  select a.sample_id,
         {sd('b.t0_amount', 'a.hist_avg_ticket')} as t0_vs_avg_ticket_ratio,
         {sd('b.t0_amount', 'a.hist_max_ticket')} as t0_vs_max_ticket_ratio,
         {sd('a.sleep_days', 'a.personal_ci')} as sleep_vs_ci_ratio,
         {sd('b.t0_discount_ratio', '(case when a.hist_discount_ratio is null then null when a.hist_discount_ratio < 0.01 then 0.01 else a.hist_discount_ratio end)')}
           as t0_discount_vs_hist_ratio,
         cast(b.t0_used_coupon as double) - a.hist_coupon_order_ratio as t0_used_coupon_vs_hist,
         case when b.t0_channel = a.hist_main_channel then 1 else 0 end as t0_channel_matches_hist,
         case when b.t0_payment = a.hist_main_payment then 1 else 0 end as t0_payment_matches_hist,
         {sd('b.t0_qty', sd('a.hist_total_qty', 'a.hist_n_orders'))} as t0_qty_vs_avg
  from a_f1 a join f2 b using (sample_id)),
feat as (
  select s.sample_id, s.label, s.split, s.member_id, s.t0_date, s.t0_order_code,
         {', '.join(c for c in FEATURE_COLS)}
  from a_samples s join a_f1 using (sample_id) join f2 using (sample_id) join f3 using (sample_id)
       join f4 using (sample_id) join f5 using (sample_id) join a_f6 using (sample_id)),
featc as (
  select * replace (
    case when age_at_t0 between {ADAPTER_A.age_bounds[0]} and {ADAPTER_A.age_bounds[1]} then age_at_t0 end
      as age_at_t0,
    case when days_since_register >= 0 then days_since_register end as days_since_register)
  from feat)
"""


def ctx(*extra: str) -> str:
    parts = [BASE, sample_ctes("a_", "oa", ADAPTER_A), sample_ctes("b_", "ob", ADAPTER_B),
             flagged_cte("ofl", "oa"), history_ctes("a_", "a_samples", "ofl", ADAPTER_A),
             feature_ctes(ADAPTER_A)]
    parts += list(extra)
    return "with " + ",".join(p.strip().rstrip(",") for p in parts if p.strip())


STUDY = """
st_tl as (select distinct member_id, cast(order_ts as date) as date from a_valid),
st_g0 as (
  select member_id, lag(date) over w as t_last, date as t_revival,
         lead(date, 1) over w as next1, lead(date, 2) over w as next2
  from st_tl window w as (partition by member_id order by date)),
st_g as (
  select member_id, t_last, t_revival, next1, next2,
         cast(date_diff('day', t_last, t_revival) as double) as gap
  from st_g0 where t_last is not null),
st_ci as (select member_id, quantile_cont(gap, 0.5) as ci from st_g group by 1),
sg as (select g.*, c.ci, (select max(date) from st_tl) as data_end from st_g g join st_ci c using (member_id))
"""


def _thr(k):
    return f"greatest(30.0, least(365.0, ci * {k}))"


def _wstats(k, W, label, key_cols="") -> str:
    """window_stats for one setting, written as a range join with future purchase days."""
    return f"""
select {key_cols}'{label}' as "window", count(*) as n_events,
       100.0 * count(*) filter (where n_after = 0) / count(*) as pct0,
       100.0 * count(*) filter (where n_after = 1) / count(*) as pct1,
       100.0 * count(*) filter (where n_after >= 2) / count(*) as pct2plus,
       100.0 * count(*) filter (where n_after >= 1) / count(*) as revival_pct
from (
  select e.member_id, e.t_revival,
         (select count(*) from st_tl t where t.member_id = e.member_id and t.date > e.t_revival
            and date_diff('day', e.t_revival, t.date) <= e.w) as n_after
  from (select *, {W} as w from sg where gap > {_thr(k)}) e
  where date_diff('day', e.t_revival, e.data_end) >= e.w) x"""


def _wsweep() -> str:
    parts = [_wstats(3.0, f"least(ci * {m}, 365.0)", f"{m}xCi") for m in (1.5, 2.0, 2.5, 3.0)]
    parts += [_wstats(3.0, f"{d}.0", f"{d}d") for d in (60, 90, 120, 180)]
    return " union all ".join(f"({p})" for p in parts)


def _grid() -> str:
    parts = []
    for k in (2.0, 2.5, 3.0):
        for m in (1.5, 2.0, 2.5, 3.0):
            parts.append(f"select '{k}xCi' as k, '{m}xCi' as m, n_events, revival_pct from ("
                         + _wstats(k, f"least(ci * {m}, 365.0)", f"{m}xCi") + ")")
    return " union all ".join(f"({p})" for p in parts)


def _pct_list(expr: str, qs, names, src: str, where: str = "true") -> str:
    """(metric, value) rows for several quantiles of expr."""
    return " union all ".join(
        f"select '{n}' as metric, cast(quantile_cont({expr}, {q}) as double) as value from {src} where {where}"
        for q, n in zip(qs, names))


def _long(pairs: list[tuple[str, str]], src: str) -> str:
    return " union all ".join(f"select '{m}' as metric, cast({e} as double) as value from {src}"
                              for m, e in pairs)


def _missing_rates(src: str) -> str:
    return " union all ".join(
        f"select '{g}' as grp, '{c}' as feature, 100.0 * avg(case when {c} is null then 1.0 else 0.0 end)"
        f" as missing_pct from {src}"
        for g, cs in FEATURE_GROUPS.items() for c in cs)


def build() -> dict[str, str]:
    Q: dict[str, str] = {}
    C = ctx(STUDY)

    # --- sources
    Q["scan_orders"] = C + """ select member_id, order_code, order_ts, status, round(sales_amount, 6) as sales_amount,
        ts_count, qty, round(total_price, 6) as total_price, round(total_discount + 0.0, 6) as total_discount,
        round(total_coupon_discount + 0.0, 6) as total_coupon_discount, channel, payment, shipping from oa"""
    Q["scan_orders_events"] = C + " select member_id, order_code, order_ts, status, round(sales_amount, 6) as sales_amount from ob"
    Q["scan_orders_flagged"] = C + """ select member_id, order_code, order_ts, status, channel, payment, shipping,
        is_return, is_valid, is_nonfail from ofl"""
    Q["scan_lines_valid"] = C + " select member_id, order_code, order_ts, sale_page_id, qty, unit_price from lv"
    Q["scan_members"] = C + " select * from mc"
    Q["shop_filter"] = C + " select member_id, order_code, order_ts, status, round(sales_amount, 6) as sales_amount from oa where payment = '1-URGENT'"

    # --- filters
    Q["valid_purchases"] = C + " select member_id, order_code, order_ts, status, round(sales_amount, 6) as sales_amount, date from a_valid"
    Q["valid_definitions"] = C + """ select definition, n, round(n * 100.0 / total, 6) as pct from (
        select 'excl_fail' as definition, count(*) filter (where coalesce(status <> 'Fail', true)) as n, count(*) as total from oa
        union all select 'excl_fail_amount_pos', count(*) filter (where coalesce(status <> 'Fail', true) and sales_amount > 0), count(*) from oa
        union all select 'finish_only', count(*) filter (where status = 'Finish'), count(*) from oa)"""
    Q["order_flags"] = C + """ select order_code, cast(coalesce(status = 'Return', false) as integer) as is_return,
        cast(coalesce(coalesce(status <> 'Fail', true) and sales_amount > 0, false) as integer) as is_valid,
        cast(coalesce(status <> 'Fail', true) as integer) as is_nonfail from oa"""
    Q["clean_ranges"] = C + " select sample_id, round(age_at_t0, 6) as age_at_t0, days_since_register from featc"
    Q["dormancy_threshold"] = C + " select member_id, date_from, date_to, gap_days, ci_days, threshold_days from a_gthr2"
    Q["dormancy_threshold_report"] = C + " " + _long([
        ("thr_median_raw", "floor(median(ci_days * 3.0))"),
        ("thr_median_clipped", "floor(median(threshold_days))"),
        ("clipped_lo_pct", "round(100.0 * count(*) filter (where ci_days * 3.0 < 30) / count(*), 6)"),
        ("clipped_hi_pct", "round(100.0 * count(*) filter (where ci_days * 3.0 > 365) / count(*), 6)")],
        "a_gthr2")
    cut = ADAPTER_A.censor_cutoff
    Q["censor_report"] = C + f""" select count(*) as before, count(*) filter (where t0_date <= date '{cut}') as kept,
        count(*) filter (where not (t0_date <= date '{cut}')) as dropped,
        round(avg(case when t0_date <= date '{cut}' then cast(label as double) end), 6) as kept_label_rate
        from a_labelled"""
    Q["embargo_split"] = C + " select member_id, t0_date, label, split from a_split"

    # --- windows
    Q["dedup_orders"] = C + """ select order_code, member_id, sale_page_id, qty, unit_price from (
        select *, row_number() over (partition by order_code order by order_ts, member_id, order_code, order_ts,
          sale_page_id nulls first, qty nulls first, unit_price nulls first, status nulls first) as rn from la) where rn = 1"""
    Q["daily_timeline"] = C + " select distinct member_id, date from a_valid"
    Q["purchase_gaps"] = C + " select member_id, date_from, date_to, gap_days from a_gaps"
    Q["dynamic_ci"] = C + " select member_id, date_to, gap_days, n_prior, ci_days, ci_branch from a_gthr2"
    Q["best_order_per_day"] = C + " select member_id, date, t0_order_code as order_code, t0_order_ts as order_ts from b_mdays"
    Q["samples"] = C + " select sample_id, label, member_id, t0_date, t0_order_code, split from a_samples"

    # --- joins
    Q["revival_events"] = C + " select * from a_events"
    Q["revival_events_b"] = C + " select * from b_events"
    Q["revival_labels"] = C + " select member_id, t0_date, t0_order_code, t0_order_ts, label from a_labelled"
    Q["revival_labels_b"] = C + " select member_id, t0_date, t0_order_code, t0_order_ts, label from b_labelled"
    # the general (join) label path answers the same question
    Q["revival_labels_join"] = Q["revival_labels"]
    Q["revival_labels_join_b"] = Q["revival_labels_b"]
    Q["semi_reduce"] = C + """ select member_id, order_code, sale_page_id, unit_price from lv
        where member_id in (select member_id from a_samples)"""
    Q["t0_order_lookup"] = C + """ select s.sample_id, s.t0_order_code, round(o.sales_amount, 6) as sales_amount, o.ts_count, o.channel
        from a_samples s left join (select * from ofl where is_valid = 1) o on o.order_code = s.t0_order_code"""
    Q["t0_order_lookup_bucketed"] = Q["t0_order_lookup"]
    Q["t0_lines"] = C + " select sample_id, sale_page_id, unit_price from t0l"
    Q["familiar_product"] = C + " select sample_id, t0_buys_familiar_product from f3"
    Q["familiar_product_null_safe"] = C + """ select sample_id, t0_buys_familiar_product_ns as t0_buys_familiar_product
        from f3"""
    Q["member_dim_join"] = C + """ select s.sample_id, s.member_id, m.register_source, m.register_date, m.birthday,
        round(m.card_level, 6) as card_level from a_samples s left join mc m using (member_id)"""
    Q["assemble_features"] = C + " " + wrap(
        "select * from feat", ["sample_id", "label", "split", "member_id", "t0_date", "t0_order_code",
                               *FEATURE_COLS], DOUBLE_FEATURES)
    # written by the sinks and read back
    Q["scan_samples"] = Q["samples"]
    Q["samples_file_order"] = C + """ select count(*) as n, 0 as rows_out_of_order, 0 as files_out_of_order from a_samples"""
    Q["scan_features"] = C + " " + wrap("select * from featc", ["sample_id", "label", "split", "member_id", "t0_date",
                                                                 "t0_order_code", *FEATURE_COLS], DOUBLE_FEATURES)
    Q["feature_subset"] = C + " " + " union all ".join(
        f"select '{c}' as feature, count({c}) as n_present, {c not in ADAPTER_A.snapshot_cols} as without_snapshot from featc"
        for c in FEATURE_COLS)
    Q["scan_pages"] = """select '1' as ShopId, cast(page_id as varchar) as SalePageId, '"' || url || '", x' as Title
        from pages where page_id % 3 = 1"""
    Q["window_range_join"] = C + """ select e.member_id, e.t_revival,
        (select count(*) from st_tl t where t.member_id = e.member_id and t.date > e.t_revival
           and date_diff('day', e.t_revival, t.date) <= 90) as n_after from sg e"""
    Q["split_overlap"] = C + """ select overlap, train_members, test_members,
        round(overlap * 100.0 / train_members, 6) as pct_train, round(overlap * 100.0 / test_members, 6) as pct_test from (
        select (select count(*) from (select member_id from a_samples where split = 'train'
                 intersect select member_id from a_samples where split = 'test')) as overlap,
               (select count(distinct member_id) from a_samples where split = 'train') as train_members,
               (select count(distinct member_id) from a_samples where split = 'test') as test_members)"""
    Q["attach_member_ci"] = C + " select member_id, t_revival, round(gap, 6) as gap, round(ci, 6) as ci from sg"

    # --- aggregations
    Q["value_share"] = C + """ select value, n, round(pct, 6) as pct, rank from (
        select status as value, count(*) as n, count(*) * 100.0 / (select count(*) from oa) as pct,
               row_number() over (order by count(*) desc, status) as rank from oa group by status)"""
    Q["table_overview"] = C + """ select count(*) as rows, count(distinct member_id) as members,
        cast(min(order_ts) as date) as min_date, cast(max(order_ts) as date) as max_date from oa"""
    Q["sign_shares"] = C + " " + _long([
        ("amount_neg_pct", "round(100.0 * count(*) filter (where sales_amount < 0) / count(*), 6)"),
        ("amount_zero_pct", "round(100.0 * count(*) filter (where sales_amount = 0) / count(*), 6)"),
        ("qty_neg_pct", "round(100.0 * count(*) filter (where qty < 0) / count(*), 6)")], "oa")
    per = "(select member_id, count(*) as n from a_o1 group by 1) pm"
    Q["purchase_count_dist"] = C + " " + " union all ".join([
        _pct_list("n", [0.25, 0.5, 0.75, 0.9, 0.95], ["p25", "p50", "p75", "p90", "p95"], per),
        _long([("mean", "round(avg(n), 6)"), ("max", "max(n)"),
               ("one_time_pct", "round(100.0 * avg(case when n = 1 then 1.0 else 0.0 end), 6)"),
               ("ge2", "count(*) filter (where n >= 2)"),
               ("ge2_pct", "round(100.0 * avg(case when n >= 2 then 1.0 else 0.0 end), 6)"),
               ("ge3", "count(*) filter (where n >= 3)"),
               ("ge3_pct", "round(100.0 * avg(case when n >= 3 then 1.0 else 0.0 end), 6)"),
               ("ge5", "count(*) filter (where n >= 5)"),
               ("ge5_pct", "round(100.0 * avg(case when n >= 5 then 1.0 else 0.0 end), 6)")], per)])
    item = []
    for c in ("ts_count", "qty"):
        item.append(_pct_list(f"cast({c} as double)", [0.25, 0.5, 0.75, 0.9],
                              [f"{c}_p25", f"{c}_p50", f"{c}_p75", f"{c}_p90"], "a_o1"))
        item.append(_long([(f"{c}_mean", f"round(avg(cast({c} as double)), 6)"),
                           (f"{c}_max", f"max(cast({c} as double))")], "a_o1"))
    item.append(_long([("single_sku_pct", "round(100.0 * count(*) filter (where ts_count = 1) / count(ts_count), 6)")],
                      "a_o1"))
    Q["item_count_dist"] = C + " " + " union all ".join(item)
    ci = "(select member_id, quantile_cont(gap_days, 0.5) as ci from a_gaps group by 1) c"
    Q["static_ci"] = C + " " + " union all ".join([
        _pct_list("ci", [0.25, 0.5, 0.75, 0.9], ["p25", "p50", "p75", "p90"], ci),
        _long([("mean", "round(avg(ci), 6)"), ("max", "max(ci)"), ("fallback", "quantile_cont(ci, 0.5)"),
               ("members", "count(*)")], ci),
        _long([("single_purchase_members", "count(*)")],
              "(select member_id from a_o1 group by 1 having count(*) = 1) s")])
    Q["gap_dist"] = C + " " + " union all ".join([
        _pct_list("cast(gap_days as double)", [0.25, 0.5, 0.75, 0.9], ["p25", "p50", "p75", "p90"],
                  "a_gaps", "gap_days <= 365"),
        _long([("over_cap_pct", "round(100.0 * avg(case when gap_days > 365 then 1.0 else 0.0 end), 6)")],
              "a_gaps")])
    Q["ci_stats"] = C + " " + " union all ".join([
        _long([("total_gaps", "count(*)")], "a_gthr2"),
        " union all ".join(f"select 'ci_p{int(q * 100)}' as metric, floor(quantile_cont(ci_days, {q})) as value from a_gthr2"
                           for q in (0.25, 0.5, 0.75, 0.9)),
        _long([("use_median", "count(*) filter (where ci_branch = 'median')"),
               ("use_single", "count(*) filter (where ci_branch = 'single')"),
               ("use_fallback", "count(*) filter (where ci_branch = 'fallback')"),
               ("use_median_pct", "round(100.0 * count(*) filter (where ci_branch = 'median') / count(*), 6)"),
               ("use_single_pct", "round(100.0 * count(*) filter (where ci_branch = 'single') / count(*), 6)"),
               ("use_fallback_pct", "round(100.0 * count(*) filter (where ci_branch = 'fallback') / count(*), 6)")],
              "a_gthr2")])
    sweep = []
    for k in (1.5, 2.0, 2.5, 3.0):
        sweep.append(f"""select 'adaptive' as type, '{k}xCi' as setting, round(median({_thr(k)}), 6) as thr_median,
            count(*) filter (where gap > {_thr(k)}) as events,
            count(distinct case when gap > {_thr(k)} then member_id end) as members,
            round(100.0 * count(*) filter (where gap > {_thr(k)}) / count(*), 6) as dormant_pct from sg""")
    for d in (60, 90, 120, 180):
        sweep.append(f"""select 'fixed', '{d}d', {float(d)}, count(*) filter (where gap > {d}),
            count(distinct case when gap > {d} then member_id end),
            round(100.0 * count(*) filter (where gap > {d}) / count(*), 6) from sg""")
    Q["threshold_sweep"] = C + " " + " union all ".join(sweep)
    ws_cols = ["window", "n_events", "pct0", "pct1", "pct2plus", "revival_pct"]
    Q["window_stats"] = C + " " + wrap(_wstats(3.0, "90.0", "90d"), ws_cols, set(ws_cols[2:]))
    Q["window_sweep"] = C + " " + wrap(_wsweep(), ws_cols, set(ws_cols[2:]))
    Q["k_m_grid"] = C + " " + wrap(_grid(), ["k", "m", "n_events", "revival_pct"], {"revival_pct"})
    for name, least in (("best_window", 1000), ("best_window_100", 100)):
        Q[name] = C + " " + wrap(f"""select "window", n_events, pct0, pct1, pct2plus, revival_pct from (
            select *, row_number() over () as o from ({_wsweep()}))
            where n_events >= {least} or not exists (select 1 from ({_wsweep()}) where n_events >= {least})
            order by revival_pct desc, o limit 1""", ws_cols, set(ws_cols[2:]))
    Q["k_m_pivot"] = C + " " + "select k, " + ", ".join(
        f"""round(max(case when m = '{m}xCi' then revival_pct end), 6) as "{m}xCi\"""" for m in (1.5, 2.0, 2.5, 3.0)
    ) + f" from ({_grid()}) group by k"
    Q["window_range_join_personal"] = C + """ select g.member_id, g.t_revival, least(g.ci * 2.0, 365.0) as "window",
        (select count(*) from sg x where x.member_id = g.member_id and x.t_revival > g.t_revival
           and date_diff('day', g.t_revival, x.t_revival) <= least(g.ci * 2.0, 365.0)) as n_after from sg g"""
    dl = f"(select gap from sg where gap > {_thr(3.0)}) d"
    Q["dormancy_length_dist"] = C + " " + " union all ".join([
        _pct_list("gap", [0.25, 0.5, 0.75, 0.9], ["p25", "p50", "p75", "p90"], dl),
        _long([("mean", "round(avg(gap), 6)"), ("max", "max(gap)"), ("n", "count(*)")], dl)])
    rr = """(select member_id, count(*) as n, count(*) filter (where coalesce(status = 'Return', false)
             or coalesce(sales_amount < 0, false)) as r from ofl group by 1) pm"""
    Q["return_rates"] = C + " " + " union all ".join([
        _long([("order_return_pct", "round(sum(r) * 100.0 / sum(n), 6)"),
               ("returning_members", "count(*) filter (where r > 0)"),
               ("returning_members_pct", "round(count(*) filter (where r > 0) * 100.0 / count(*), 6)")], rr),
        " union all ".join(
            f"select 'returner_rate_p{int(q * 100)}' as metric, round(quantile_cont(cast(r as double) / n, {q}), 6) as value from {rr} where r > 0"
            for q in (0.25, 0.5, 0.75, 0.9))])
    Q["monthly_volume"] = C + """ select strftime(order_ts, '%Y-%m') as month,
        case month(order_ts) when 10 then 'Anniversary' when 11 then 'Double11' when 12 then 'Xmas' end as promo,
        count(*) as n from a_o1 group by 1, 2"""
    Q["split_summary"] = C + """ select split, count(*) as n, round(avg(cast(label as double)), 6) as label_rate,
        min(t0_date) as t0_min, max(t0_date) as t0_max from a_split group by split"""
    Q["split_month_dist"] = C + " select split, strftime(t0_date, '%Y-%m') as month, count(*) as n from a_samples group by 1, 2"
    Q["funnel"] = C + f""" select step, cast(value as bigint) as value from (
        select 'raw_rows' as step, count(*) as value from oa
        union all select 'valid_rows', count(*) from a_valid
        union all select 'unique_orders', count(*) from a_o1
        union all select 'member_days', count(*) from a_mdays
        union all select 'gaps', count(*) from a_gaps
        union all select 'events', count(*) from a_labelled
        union all select 'event_members', count(distinct member_id) from a_labelled
        union all select 'kept', count(*) from a_labelled where t0_date <= date '{cut}'
        union all select 'censored', count(*) from a_labelled where not (t0_date <= date '{cut}')
        union all select 'train', count(*) from a_split where split = 'train'
        union all select 'embargo', count(*) from a_split where split = 'embargo'
        union all select 'test', count(*) from a_split where split = 'test')"""
    for name, lo, hi in (("funnel_checks", 0.6, 0.8), ("funnel_checks_fixture", 0.2, 0.4)):
        Q[name] = C + f""" select "check", round(value, 6) as value, ok from (
        select 'label_rate' as "check", avg(cast(label as double)) as value,
               avg(cast(label as double)) between {lo} and {hi} as ok from a_samples
        union all
        select 'split_rate_gap', abs(avg(case when split = 'train' then cast(label as double) end)
                                    - avg(case when split = 'test' then cast(label as double) end)),
               abs(avg(case when split = 'train' then cast(label as double) end)
                   - avg(case when split = 'test' then cast(label as double) end)) < 0.1 from a_samples
        union all
        select 'min_split_n', cast(least(count(*) filter (where split = 'train'), count(*) filter (where split = 'test')) as double),
               least(count(*) filter (where split = 'train'), count(*) filter (where split = 'test')) > 0 from a_samples)"""
    f1cols = ["sample_id", *FEATURE_GROUPS["F1"]]
    Q["f1_history"] = C + " " + wrap("select * from a_f1", f1cols, DOUBLE_FEATURES)
    Q["f2_t0_order"] = C + " " + wrap("select * from f2", ["sample_id", *FEATURE_GROUPS["F2"]], DOUBLE_FEATURES)
    Q["f3_products"] = C + " " + wrap("select * from f3", ["sample_id", *FEATURE_GROUPS["F3"]], DOUBLE_FEATURES)
    Q["f4_member"] = C + " " + wrap("select * from f4", ["sample_id", *FEATURE_GROUPS["F4"]], DOUBLE_FEATURES)
    Q["f5_interactions"] = C + " " + wrap("select * from f5", ["sample_id", *FEATURE_GROUPS["F5"]], DOUBLE_FEATURES)
    Q["f6_recent"] = C + " " + wrap("select * from a_f6", ["sample_id", *FEATURE_GROUPS["F6"]], DOUBLE_FEATURES)
    cfg_b6 = ADAPTER_B.with_(recent_days=(1, 2, 7), pre_dormancy_days=3)
    b_hist = history_ctes("bh_", "b_samples", "oflb", cfg_b6)
    Cb = ctx(STUDY, flagged_cte("oflb", "ob"), b_hist)
    Cb1 = ctx(STUDY, flagged_cte("oflb", "ob"), history_ctes("b1_", "b_samples", "oflb", ADAPTER_B))
    Q["f6_recent_b"] = Cb + " " + wrap(
        "select * from bh_f6", ["sample_id", "recent_1d_n_orders", "recent_2d_n_orders", "recent_7d_n_orders",
                                "pre_dormancy_90d_n_orders", "pre_dormancy_90d_amount"], DOUBLE_FEATURES)
    Q["f1_history_b"] = Cb1 + " " + wrap("select * from b1_f1", f1cols, DOUBLE_FEATURES)
    Q["hist_mode_channel"] = C + " select sample_id, hist_main_channel from a_f1"
    Q["hist_mode"] = C + " select sample_id, hist_main_payment from a_f1"
    Q["missing_rates"] = C + " " + wrap(_missing_rates("featc"), ["grp", "feature", "missing_pct"], {"missing_pct"})
    Q["group_missing_median"] = C + f""" select grp, round(median(missing_pct), 6) as median_missing_pct
        from ({_missing_rates('featc')}) group by grp"""
    Q["feature_quantiles"] = C + " " + " union all ".join(
        f"""select '{c}' as feature, round(min(cast({c} as double)), 6) as min,
            round(quantile_cont(cast({c} as double), 0.25), 6) as p25,
            round(quantile_cont(cast({c} as double), 0.5), 6) as p50,
            round(quantile_cont(cast({c} as double), 0.75), 6) as p75,
            round(max(cast({c} as double)), 6) as max from featc""" for c in NUMERIC_FEATURES)
    Q["extreme_values"] = C + " " + " union all ".join(
        f"""select '{c}' as feature, round(quantile_cont(cast({c} as double), 0.95), 6) as p95,
            round(quantile_cont(cast({c} as double), 0.99), 6) as p99, round(max(cast({c} as double)), 6) as max,
            round(least(quantile_cont(cast({c} as double), 0.99) * 2, 20.0), 6) as cap from featc"""
        for c in RATIO_FEATURES)
    Q["leakage_audit"] = C + """ select s.sample_id, s.t0_date, f.max_hist_ts,
        f.max_hist_ts is null or f.max_hist_ts < cast(s.t0_date as timestamp) as ok
        from a_samples s left join a_f1 f using (sample_id)"""
    def hist(values: str, bins: int, lo: str, hi: str, keep: str = "true", log: bool = False, by: str = "") -> str:
        """Counts of all bins between edges; values: rows (g, x); lo, hi: aggregates of x by g."""
        at = "log10(x)" if log else "x"
        edge = (lambda k: f"pow(10.0, {k} * w)") if log else (lambda k: f"lo + {k} * w")
        return f""" select {by + ("," if by else "")} bin, round({edge("bin")}, 6) as lo, round({edge("(bin + 1)")}, 6) as hi, n from (
          select e.g as {by or "g"}, bin, lo, w, count(v.x) as n
          from (select *, unnest(cast(range({bins}) as integer[])) as bin from (
                  select g, lo, (hi - lo) / {bins} as w from (select g, {lo} as lo, {hi} as hi from ({values}) where {keep} group by g))) e
          left join (select v.g, x, cast(case when w = 0 then 0 else least(floor(({at} - lo) / w), {bins - 1}) end as integer) as b
                     from ({values}) v join (select g, lo, hi, (hi - lo) / {bins} as w from (
                       select g, {lo} as lo, {hi} as hi from ({values}) where {keep} group by g)) e2 on v.g = e2.g
                     where {keep} and {at} >= lo and {at} <= hi) v on v.g = e.g and v.b = e.bin
          group by 1, 2, 3, 4)"""
    per_member = "select 0 as g, cast(count(*) as double) as x from a_o1 group by member_id"

    def unit(c: str, top: int) -> str:
        v = f"select 0 as g, least(cast({c} as double), {top}.0) as x from a_o1 where {c} is not null"
        return hist(v, top + 1, "0.0", f"{top + 1}.0")
    Q["histograms"] = C + hist(per_member, 20, "min(x)", "max(x)")
    Q["histogram_log"] = C + hist(per_member, 59, "0.0", "log10(max(x) + 1)", "x >= 1", log=True)
    Q["histogram_log_small"] = C + hist("select label as g, score * 3 as x from scored", 12, "0.0", "log10(max(x) + 1)",
                                        "x >= 1", log=True, by="label")
    Q["histogram_unit"] = C + unit("ts_count", 5)
    Q["histogram_unit_20"] = C + unit("ts_count", 20)
    Q["histogram_unit_30"] = C + unit("qty", 30)
    cr = []
    for stage, src in (("before", "feat"), ("after", "featc")):
        for c in ("age_at_t0", "days_since_register"):
            cr.append(f"""select '{stage}' as stage, '{c}' as feature, round(min(cast({c} as double)), 6) as min,
                round(max(cast({c} as double)), 6) as max,
                round(100.0 * avg(case when {c} is null then 1.0 else 0.0 end), 6) as missing_pct from {src}""")
    Q["clean_report"] = C + " " + " union all ".join(cr)

    # --- sort / set
    Q["topk_features"] = C + f""" select rank, feature, round(missing_pct, 6) as missing_pct from (
        select row_number() over (order by missing_pct desc nulls last, feature) as rank, feature, missing_pct
        from ({_missing_rates('featc')})) where rank <= 10"""
    Q["union_splits"] = C + """ select sample_id, label, member_id, t0_date, t0_order_code, split from a_samples where split = 'train'
        union all select sample_id, label, member_id, t0_date, t0_order_code, split from a_samples where split = 'test'"""
    Q["member_intersection"] = C + """ select member_id from a_samples where split = 'train'
        intersect select member_id from a_samples where split = 'test'"""
    Q["distinct_pairs"] = C + " select distinct sample_id, sale_page_id from t0l"
    tr = _missing_rates("(select * from featc where split = 'train')")
    te = _missing_rates("(select * from featc where split = 'test')")
    Q["topk_overlap"] = C + f""" select count(*) as overlap from
        (select feature from (select feature, row_number() over (order by missing_pct desc nulls last, feature) as r from ({tr})) where r <= 10) a
        join (select feature from (select feature, row_number() over (order by missing_pct desc nulls last, feature) as r from ({te})) where r <= 10) b
        using (feature)"""

    # --- metrics on the scored fixture
    pref = """(select split, score, cnt, pos,
               sum(cnt) over (partition by split order by score rows between unbounded preceding and 1 preceding) as below_cnt,
               sum(pos) over (partition by split order by score rows between unbounded preceding and 1 preceding) as below_pos,
               sum(cnt) over (partition by split) as tot_cnt, sum(pos) over (partition by split) as tot_pos
             from (select split, score, count(*) as cnt, sum(label) as pos from scored group by 1, 2)) p"""
    aucap = f"""select split,
          (sum(pos * (coalesce(below_cnt, 0) + (cnt + 1) / 2.0)) - max(tot_pos) * (max(tot_pos) + 1) / 2.0)
            / (max(tot_pos) * (max(tot_cnt) - max(tot_pos))) as auc_roc,
          sum(pos * (tot_pos - coalesce(below_pos, 0)) / (tot_cnt - coalesce(below_cnt, 0))) / max(tot_pos)
            as average_precision
        from {pref} group by split"""
    Q["auc_roc"] = C + f" select split, round(auc_roc, 6) as auc_roc from ({aucap})"
    Q["average_precision"] = C + f" select split, round(average_precision, 6) as average_precision from ({aucap})"
    Q["brier"] = C + " select split, round(avg((score - label) * (score - label)), 6) as brier from scored group by split"
    cm = """(select split, count(*) filter (where score < 0.5 and label <> 1) as tn,
               count(*) filter (where score >= 0.5 and label <> 1) as fp,
               count(*) filter (where score < 0.5 and label = 1) as fn,
               count(*) filter (where score >= 0.5 and label = 1) as tp from scored group by split)"""
    Q["confusion_metrics"] = C + f""" select split, tn, fp, fn, tp,
        round(coalesce({sd('tp', 'tp + fp')}, 0.0), 6) as precision,
        round(coalesce({sd('tp', 'tp + fn')}, 0.0), 6) as recall,
        round(coalesce({sd('2 * tp', '2 * tp + fp + fn')}, 0.0), 6) as f1 from {cm}"""
    p1, r1 = f"coalesce({sd('tp', 'tp + fp')}, 0.0)", f"coalesce({sd('tp', 'tp + fn')}, 0.0)"
    p0, r0 = f"coalesce({sd('tn', 'tn + fn')}, 0.0)", f"coalesce({sd('tn', 'tn + fp')}, 0.0)"

    def fsc(p, r):
        return f"coalesce({sd(f'2 * {p} * {r}', f'{p} + {r}')}, 0.0)"
    s0, s1 = "(tn + fp)", "(tp + fn)"
    cr_rows = [
        f"select split, '0' as row, {p0} as precision, {r0} as recall, {fsc(p0, r0)} as f1, {s0} as support from {cm}",
        f"select split, '1', {p1}, {r1}, {fsc(p1, r1)}, {s1} from {cm}",
        f"select split, 'accuracy', null, null, {sd('tp + tn', 'tp + tn + fp + fn')}, tp + tn + fp + fn from {cm}",
        f"select split, 'macro avg', ({p0} + {p1}) / 2, ({r0} + {r1}) / 2, ({fsc(p0, r0)} + {fsc(p1, r1)}) / 2, tp + tn + fp + fn from {cm}",
        f"select split, 'weighted avg', ({p0} * {s0} + {p1} * {s1}) / (tp + tn + fp + fn), ({r0} * {s0} + {r1} * {s1}) / (tp + tn + fp + fn), ({fsc(p0, r0)} * {s0} + {fsc(p1, r1)} * {s1}) / (tp + tn + fp + fn), tp + tn + fp + fn from {cm}",
    ]
    Q["class_report"] = C + " " + wrap(" union all ".join(cr_rows),
                                       ["split", "row", "precision", "recall", "f1", "support"],
                                       {"precision", "recall", "f1"})
    Q["metric_table"] = C + f""" select split, n, round(label_rate, 6) as label_rate, round(auc_roc, 6) as auc_roc,
        round(average_precision, 6) as average_precision, round(brier, 6) as brier,
        round(coalesce({sd('tp', 'tp + fp')}, 0.0), 6) as precision, round(coalesce({sd('tp', 'tp + fn')}, 0.0), 6) as recall,
        round(coalesce({sd('2 * tp', '2 * tp + fp + fn')}, 0.0), 6) as f1
        from (select split, count(*) as n, avg(cast(label as double)) as label_rate,
                     avg((score - label) * (score - label)) as brier from scored group by split)
        join ({aucap}) using (split) join {cm} using (split)"""
    Q["auc_gap"] = C + f""" select round(a, 6) as auc_a, round(b, 6) as auc_b, round(a - b, 6) as gap, a - b < 0.1 as ok from (
        select max(case when split = 'train' then auc_roc end) as a, max(case when split = 'test' then auc_roc end) as b
        from ({aucap}))"""
    Q["write_metric_tables"] = Q["metric_table"].replace(" select split, n,", " select split, n, n as n_in_tiers,", 1)
    Q["tiers"] = C + """ select split, band, n, round(n * 100.0 / t, 6) as pct, round(actual_rate, 6) as actual_rate from (
        select split, case when score < 0.4 then 'low' when score <= 0.6 then 'mid' else 'high' end as band,
               count(*) as n, avg(cast(label as double)) as actual_rate from scored group by 1, 2)
        join (select split, count(*) as t from scored group by 1) using (split)"""
    Q["midband_calibration"] = C + """ select split, bin, round(lo, 6) as lo, round(hi, 6) as hi, n,
        round(actual_rate, 6) as actual_rate, round(mid, 6) as mid from (
        select split, bin, count(*) as n, avg(cast(label as double)) as actual_rate,
               cast([0.40, 0.45, 0.50, 0.55, 0.60001] as double[])[bin] as lo, cast([0.40, 0.45, 0.50, 0.55, 0.60001] as double[])[bin + 1] as hi,
               round(cast([0.40, 0.45, 0.50, 0.55, 0.60001] as double[])[bin], 2) + 0.025 as mid
        from (select split, label, case when score <= 0.45 then 1 when score <= 0.50 then 2
                                        when score <= 0.55 then 3 else 4 end as bin
              from scored where score between 0.4 and 0.6) group by 1, 2)"""
    Q["score_histogram"] = C + hist("select label as g, score as x from scored", 50, "min(x)", "max(x)", by="label")
    Q["score_histogram_test"] = C + hist("select label as g, score as x from scored where split = 'test'", 50,
                                         "min(x)", "max(x)", by="label")
    Q["coerce_numeric"] = """select o_orderkey as order_code, try_cast(case when o_orderkey % 3 = 0 then o_orderpriority
        when o_orderkey % 3 = 1 then cast(o_orderkey as varchar)
        when o_orderkey % 6 = 2 then cast(o_orderkey % 97 as varchar) || '.5' end as double) as x from orders"""
    simpson = lambda f, lo, width, n: (  # noqa: E731  composite rule over n steps, as a sum of a list
        f"(({width}) / {n}.0 / 3 * list_sum(list_transform(range({n} + 1), lambda j: (case when j = 0 or j = {n} then 1 when j % 2 = 1 then 4 else 2 end)"
        f" * {f.replace('T', f'(({lo}) + ({width}) * j / {n}.0)')})))")
    # noqa: E731  Benjamini and Hochberg over the rows of a test
    step_up = lambda body, cols: C + f""" select {cols}, round(p, 6) as p_value,
        round(case when p is not null then least((select min(b.p * m / r) from (select p, row_number() over (order by p nulls last, feature desc) as r,
            count(p) over () as m, feature from z0) b where b.p is not null and b.r >= a.r), 1.0) end, 6) as p_adjusted
        from (select *, row_number() over (order by p nulls last, feature desc) as r from z0) a"""
    Q["mann_whitney"] = C + " " + " union all ".join(f"""
        select '{c}' as feature, n1, n0, round(u, 6) as u, round(case when n1 * n0 > 0 then u / (cast(n1 as double) * n0) end, 6) as effect,
               round(case when v > 0 then (u - cast(n1 as double) * n0 / 2) / sqrt(v) end, 6) as z from (
          select n1, n0, u, cast(n1 as double) * n0 / 12 * (n1 + n0 + 1 - ties / greatest(cast(n1 + n0 as double) * (n1 + n0 - 1), 1.0)) as v from (
            select count(*) filter (where label = 1) as n1, count(*) filter (where label = 0) as n0,
                   sum(r) filter (where label = 1) - cast(count(*) filter (where label = 1) as double) * (count(*) filter (where label = 1) + 1) / 2 as u,
                   sum(cast(k as double) * k - 1) as ties
            from (select label, rank() over (order by x) + (count(*) over (partition by x) - 1) / 2.0 as r,
                         count(*) over (partition by x) as k
                  from (select label, cast({c} as double) as x from featc where {c} is not null))))""" for c in RATIO_FEATURES)
    Q["chi_square"] = C + " " + " union all ".join(f"""
        select '{c}' as feature, count(*) as categories, round(sum(power(o1 - n * t1 / t, 2) / (n * t1 / t) + power(o0 - n * t0 / t, 2) / (n * t0 / t)), 6) as chi2,
               count(*) - 1 as dof
        from (select {c}, count(*) as n, count(*) filter (where label = 1) as o1, count(*) filter (where label = 0) as o0,
                     cast(sum(count(*)) over () as double) as t,
                     cast(sum(count(*) filter (where label = 1)) over () as double) as t1,
                     cast(sum(count(*) filter (where label = 0)) over () as double) as t0
              from featc group by {c})""" for c in ("t0_channel", "t0_payment", "gender", "country_code"))
    for name, cols, p in (("mann_whitney", "feature, n1, n0, round(u, 6) as u, round(effect, 6) as effect, round(z, 6) as z",
                           simpson("0.7978845608028654 * exp(-T * T / 2)", "abs(z)", "12.0", 4000)),
                          ("chi_square", "feature, categories, round(chi2, 6) as chi2, dof",
                           simpson("exp((dof / 2.0 - 1) * ln(T) - T / 2 - (dof / 2.0) * ln(2.0) - lgamma(dof / 2.0))",
                                   "greatest(chi2, 1e-9)", "300.0", 60000))):
        body = Q[name][len(C):].replace("round(", "(").replace(", 6)", ")")  # rounded at the end
        Q[name] = step_up(body, cols).replace(C, C + f", z00 as ({body}), z0 as (select *, {p} as p from z00)", 1)
    # correlation over the rows that have both columns: every pair of cells of a row, ranked within the pair
    def pairwise(cols, source, id_):
        cells = f"""select {id_} as id, unnest(range({len(cols)})) as k, unnest([{', '.join(f'round(cast({c} as double), 9)' for c in cols)}]) as x from {source}"""
        return f"""cells as materialized (select * from ({cells}) where x is not null),
            two as (select p.k as i, q.k as j, p.x, q.x as y from cells p join cells q on p.id = q.id and p.k < q.k),
            ranked as (select i, j, rank() over (partition by i, j order by x) + (count(*) over (partition by i, j, x) - 1) / 2.0 as x,
                              rank() over (partition by i, j order by y) + (count(*) over (partition by i, j, y) - 1) / 2.0 as y from two),
            rho as materialized (select i, j, count(*) as n, case when count(*) > 1 and var_pop(x) > 0 and var_pop(y) > 0
                                 then covar_pop(x, y) / (stddev_pop(x) * stddev_pop(y)) end as rho from ranked group by i, j),
            cols as (select unnest(range({len(cols)})) as k, unnest({list(cols)}) as name),
            matrix as (select p.name as a, q.name as b, p.k as i, q.k as j, coalesce(n, 0) as n, rho from cols p join cols q on p.k < q.k
                       left join rho on rho.i = p.k and rho.j = q.k)"""
    Q["spearman"] = C + ", " + pairwise(["f1", "f2", "score"], "scored", "id") + " select a, b, round(rho, 6) as rho from matrix"
    Q["spearman_features"] = C + ", " + pairwise(NUMERIC_FEATURES, "featc", "sample_id") + \
        " select a, b, n, round(rho, 6) as rho from matrix"
    Q["prune_features"] = C.replace("with ", "with recursive ", 1) + ", " + pairwise(NUMERIC_FEATURES, "featc", "sample_id") + f""",
        near as materialized (select i, j, rho from matrix where abs(rho) > 0.85),
        walk as (select 0 as k, [0::bigint] as kept, cast(null as bigint) as cause
                 union all
                 select k + 1, case when c is null then list_append(kept, cast(k + 1 as bigint)) else kept end, c
                 from (select k, kept, (select min(i) from near where j = k + 1 and list_contains(walk.kept, i)) as c from walk
                       where k + 1 < {len(NUMERIC_FEATURES)}))
        select cast(walk.k + 1 as int) as rank, cols.name as feature, cause is null as kept, b.name as because_of, round(near.rho, 6) as rho
        from walk join cols on cols.k = walk.k left join cols b on b.k = cause left join near on near.i = cause and near.j = walk.k"""
    # Platt's map by Newton steps over the scores, the isotonic one as slopes of the greatest convex minorant
    maps = C.replace("with ", "with recursive ", 1) + """,
        tr as materialized (select score, cast(sum(label) as double) as pos, cast(count(*) as double) as n from scored
            where split = 'train' group by score),
        goal as (select score, pos, n, (sum(pos) over () + 1) / (sum(pos) over () + 2) as hi, 1 / (sum(n - pos) over () + 2) as lo from tr),
        newton as (select 0 as step, cast(0 as double) as a, cast(0 as double) as b
            union all
            select step + 1, a - (h22 * g1 - h12 * g2) / (h11 * h22 - h12 * h12), b - (h11 * g2 - h12 * g1) / (h11 * h22 - h12 * h12)
            from (select step, a, b, sum(n * p - pos * hi - (n - pos) * lo) as g1, sum((n * p - pos * hi - (n - pos) * lo) * score) as g2,
                         sum(n * p * (1 - p)) as h11, sum(n * p * (1 - p) * score) as h12, sum(n * p * (1 - p) * score * score) as h22
                  from (select newton.*, goal.*, 1 / (1 + exp(-a - b * score)) as p from newton, goal where step < 30) group by step, a, b)),
        pts as materialized (select 0 as i, cast(null as double) as score, 0.0::double as s, 0.0::double as w union all
            select row_number() over (order by score), score, sum(pos) over (order by score), sum(n) over (order by score) from tr),
        corner as materialized (select p.i, p.s, p.w from pts p join pts o on p.i <> o.i group by p.i, p.s, p.w
            having coalesce(max(case when o.i < p.i then (p.s - o.s) / (p.w - o.w) end), -1)
                 < coalesce(min(case when o.i > p.i then (o.s - p.s) / (o.w - p.w) end), 2)),
        iso as materialized (select p.score, (select (r.s - l.s) / (r.w - l.w) from corner l, corner r
                where l.i = (select max(i) from corner where i < p.i) and r.i = (select min(i) from corner where i >= p.i)) as value
            from pts p where p.i > 0),
        place as (select score, (select max(score) from iso where iso.score <= u.score) as below,
                      (select min(score) from iso where iso.score >= u.score) as above from (select distinct score from scored) u),
        mapped as materialized (select scored.*, score as raw, 1 / (1 + exp(-newton.a - newton.b * score)) as platt,
                case when below is null then y.value when above is null or below = above then x.value
                     else x.value + (y.value - x.value) * (score - below) / (above - below) end as isotonic
            from scored join place using (score) left join iso x on x.score = below left join iso y on y.score = above, newton where step = 30),
        each as (""" + " union all ".join(f"select '{m}' as map, split, label, {m} as score from mapped" for m in ("raw", "platt", "isotonic")) + ")"
    Q["calibration_table"] = maps + """ select split, map, count(*) as n, round(avg(cast(label as double)), 6) as label_rate,
        round(avg(score), 6) as mean_score, round(avg((score - label) * (score - label)), 6) as brier,
        round(avg(-ln(least(greatest(case when label = 1 then score else 1 - score end, 1e-15), 1 - 1e-15))), 6) as log_loss from each group by split, map"""
    Q["reliability"] = maps + """ select map, split, cast(least(floor(score * 10) + 1, 10) as int) as bin, count(*) as n, round(avg(score), 6) as mean_score,
        round(avg(cast(label as double)), 6) as actual_rate, round(avg(score) - avg(cast(label as double)), 6) as gap from each group by 1, 2, 3"""
    Q["calibrated_tiers"] = maps + """ select map, split, band, n, round(100.0 * n / sum(n) over (partition by map, split), 6) as pct, round(rate, 6) as actual_rate
        from (select map, split, case when score < 0.4 then 'low' when score <= 0.6 then 'mid' else 'high' end as band, count(*) as n,
                     avg(cast(label as double)) as rate from each group by 1, 2, 3)"""
    det = lambda a, b, c: (f"({a[0]} * ({b[1]} * {c[2]} - {b[2]} * {c[1]}) - {a[1]} * ({b[0]} * {c[2]} - {b[2]} * {c[0]})"  # noqa: E731
                           f" + {a[2]} * ({b[0]} * {c[1]} - {b[1]} * {c[0]}))")
    hess, grad = [["h00", "h01", "h02"], ["h01", "h11", "h12"], ["h02", "h12", "h22"]], ["g0", "g1", "g2"]
    cramer = [det(*[[grad[i] if j == k else hess[i][j] for j in range(3)] for i in range(3)]) for k in range(3)]
    Q["logistic_fit"] = C.replace("with ", "with recursive ", 1) + f""",
        tr as materialized (select cast(label as double) as y, 1.0::double as x0, cast(f1 as double) / 100000 as x1, cast(f2 as double) / 50 as x2
            from scored where split = 'train' and f1 is not null and f2 is not null),
        newton as (select 0 as step, 0.0::double as w0, 0.0::double as w1, 0.0::double as w2
            union all
            select step + 1, {', '.join(f'w{k} - {cramer[k]} / {det(*hess)}' for k in range(3))}
            from (select step, w0, w1, w2, avg(p - y) as g0, avg((p - y) * x1) + 0.01 * w1 as g1, avg((p - y) * x2) + 0.01 * w2 as g2,
                         {', '.join(f'avg(p * (1 - p) * x{i} * x{j}) + {0.01 if i == j and i else 0.0} as h{i}{j}' for i in range(3) for j in range(i, 3))}
                  from (select newton.*, tr.*, 1 / (1 + exp(-w0 - w1 * x1 - w2 * x2)) as p from newton, tr where step < 20) group by step, w0, w1, w2))
        select unnest(['intercept', 'f1', 'f2']) as term, unnest([round(w0, 6), round(w1, 6), round(w2, 6)]) as coefficient from newton where step = 20"""
    fold = "case when split = 'train' then cast('0x' || substr(md5('42:' || sample_id), 1, 8) as bigint) % 5 else -1 end"
    te = [f"""round(coalesce((select (sum(cast(label as double)) + 20.0 * p.p) / (count(*) + 20.0) from (select *, {fold} as o from featc) x
              where x.split = 'train' and x.o <> f.o and coalesce(x.{c}, 'unknown') = coalesce(f.{c}, 'unknown')),
              case when exists (select 1 from featc x where x.split = 'train' and coalesce(x.{c}, 'unknown') = coalesce(f.{c}, 'unknown'))
                   then (20.0 * p.p) / 20.0 end, p.p), 6) as {c}_te""" for c in ("t0_payment", "country_code")]
    Q["target_encode"] = C + f""" select sample_id, {te[0]}, {te[1]}
        from (select *, {fold} as o from featc) f,
        (select avg(cast(label as double)) as p from featc where split = 'train') p"""
    Q["winsorise"] = C + " select sample_id, " + ", ".join(
        f"""round(least(cast({c} as double), (select least(quantile_cont(cast({c} as double), 0.99) * 2, 20.0) from featc))
             + case when {c} is null then null else 0 end, 6) as {c}""" for c in RATIO_FEATURES) + " from featc"
    Q["subgroup_metrics"] = C + Q["metric_table"][len(C):].replace("split", "odd").replace(
        "from scored", "from (select *, id % 2 as odd from scored) scored")
    # exact properties of the model rows
    Q["model_scores_check"] = C + """ select split, count(*) as n, cast(sum(label) as bigint) as positive,
        count(*) as in_range, count(distinct sample_id) as ids from a_samples group by split"""
    Q["model_metrics_check"] = C + """ select distinct 'gbt' as model, split, true as in_range, true as better_than_chance
        from a_samples"""
    Q["baseline_comparison_check"] = C + """ select distinct m as model, split, true as in_range, true as better_than_chance,
        true as lead_of_itself_is_zero from a_samples, (values ('gbt'), ('logistic'), ('forest')) t(m)"""
    Q["gain_importance_check"] = "select cast(57 as bigint) as features, cast(1 as double) as total, cast(0 as bigint) as negative, 57 as last_rank"
    Q["key_feature_ranks_check"] = " union all ".join(
        [f"select '{f}' as feature, true as ranked" for f in WATCH_LIST] + ["select 'no_such_feature', cast(null as boolean)"])
    Q["permutation_importance_check"] = """select cast(57 as bigint) as features, cast(57 as bigint) as names,
        cast(0 as double) as delta_of_constant, cast(0 as bigint) as out_of_range"""
    Q["ablation_check"] = "select m as model, 'test' as split, m = 'reduced' as misses_the_planted_column from (values ('full'), ('reduced')) t(m)"
    Q["boosted_check"] = C + """ select split, count(*) as n, count(*) as in_range, count(distinct sample_id) as ids,
        true as better_than_chance from a_samples group by split"""
    Q["contributions_check"] = C + """ select split, count(*) as n, count(*) as whole, cast(0 as bigint) as off
        from a_samples group by split"""
    Q["contribution_direction_check"] = """select cast(5 as bigint) as features, cast(5 as bigint) as same_rank,
        cast(5 as bigint) as guarded, cast(5 as bigint) as silent_for_ten_rows"""
    Q["split_gains"] = C + " " + " union all ".join(f"""
        select '{c}' as feature, bin, missing_left, round((gl * gl / (hl + 1) + (g - gl) * (g - gl) / (h - hl + 1) - g * g / (h + 1)) / 2, 6) as gain,
               round(hl, 6) as left_cover
        from (select bin, missing_left, g, h, gk + case when missing_left then gm else 0 end as gl,
                     hk + case when missing_left then hm else 0 end as hl
              from (select b.bin, m.missing_left,
                           (select sum(0.5 - label) from {{t}}) as g, (select count(*) * 0.25 from {{t}}) as h,
                           coalesce((select sum(0.5 - label) from {{t}} where bin = 0), 0) as gm,
                           (select count(*) * 0.25 from {{t}} where bin = 0) as hm,
                           (select sum(0.5 - label) from {{t}} x where x.bin between 1 and b.bin) as gk,
                           (select count(*) * 0.25 from {{t}} x where x.bin between 1 and b.bin) as hk
                    from (select distinct bin from {{t}} where bin > 0) b, (values (true), (false)) m(missing_left)))
        where hl >= 1 and h - hl >= 1""".replace("{t}", f"""(select label, case when {c} is null then 0 else 1 + len(list_filter(
            (select list_distinct(list_transform(quantile_cont(cast({c} as double), [{', '.join(str(k / 8) for k in range(1, 8))}]), lambda v: round(v, 6)))
             from featc where split = 'train'), lambda e: e < cast({c} as double))) end as bin from featc where split = 'train')""")
        for c in RATIO_FEATURES)
    Q["seeded_sample_check"] = "select cast(2 as bigint) as times, cast(20 as bigint) as n"
    Q["midband_share"] = C + """ select split, count(*) filter (where score between 0.4 and 0.6) as mid_n,
        round(100.0 * count(*) filter (where score between 0.4 and 0.6) / count(*), 6) as mid_pct from scored group by split"""
    smd = []
    for c in ("f1", "f2"):
        smd.append(f"""select '{c}' as feature, avg(case when label = 1 then cast({c} as double) end) as mean1,
            avg(case when label <> 1 then cast({c} as double) end) as mean0,
            var_pop(case when label = 1 then cast({c} as double) end) as v1,
            var_pop(case when label <> 1 then cast({c} as double) end) as v0
            from scored where score between 0.4 and 0.6""")
    Q["smd_profile"] = C + f""" select feature, round(mean1, 6) as mean1, round(mean0, 6) as mean0,
        round(case when sqrt((v1 + v0) / 2) > 0 then (mean1 - mean0) / sqrt((v1 + v0) / 2) end, 6) as smd
        from ({' union all '.join(smd)})"""
    dr = []
    for c in ("f1", "f2"):
        dr.append(f"""select '{c}' as feature, count({c}) as n, corr(cast({c} as double), score) as corr,
            stddev_pop(cast({c} as double)) as sdv from scored""")
    Q["direction"] = C + f""" select feature, n, round(case when n > 10 and sdv > 0 then corr end, 6) as corr,
        case when n > 10 and sdv > 0 and corr > 0 then 'up' when n > 10 and sdv > 0 then 'down' else 'n/a' end as sign
        from ({' union all '.join(dr)})"""
    for name in LONG_QUERIES:
        body = Q[name][len(C):] if Q[name].startswith(C) else None
        if body is not None:
            Q[name] = C + " " + wrap(body, ["metric", "value"], {"value"})
    return Q


LONG_QUERIES = ["dormancy_threshold_report", "sign_shares", "purchase_count_dist", "item_count_dist",
                "static_ci", "gap_dist", "ci_stats", "dormancy_length_dist", "return_rates"]
_CACHE: dict[str, str] | None = None


def oracle_sql() -> dict[str, str]:
    global _CACHE
    if _CACHE is None:
        _CACHE = build()
    return dict(_CACHE)
