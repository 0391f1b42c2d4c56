"""DuckDB SQL that states, independently, what each query must return."""

from __future__ import annotations

from loanpanel.sources.fixtures import STATIC
from loanpanel.sources.profile import PAY_PLAN, PLAN_CODE

N1, N2, WINDOW, SEED, LEVEL_SEED = 20_000, 10_000, 24, 10, 11

# The tables the queries are read from, as common table expressions.
TABLES = """
fx_om as materialized (
  select o_custkey as k, cast(date_trunc('month', o_orderdate) as date) as m,
         cast(sum(cast(round(o_totalprice * 100) as bigint)) as bigint) as cents,
         max(o_orderstatus) as st, max(o_orderpriority) as pr
  from orders group by 1, 2),
fx_b as materialized (select k, min(m) as fp, max(m) as lp, cast(sum(cents) as bigint) as tot from fx_om group by 1),
fx_loan as materialized (
  select c_custkey as loan_id, fp as fp_dt, lp as last_dt,
    lpad(cast(c_nationkey as varchar), 3, '0') as zip3, concat('S', cast(c_nationkey as varchar)) as state,
    case when c_nationkey % 5 = 0 then '00000' else lpad(cast(c_nationkey * 7 as varchar), 5, '0') end as msa,
    c_mktsegment as purpose, cast(600 + c_custkey % 200 as int) as fico, cast(60 + c_custkey % 40 as int) as ltv,
    cast(60 + c_custkey % 40 + case when c_custkey % 4 = 0 then 10 else 0 end as int) as cltv,
    cast(1 + c_custkey % 2 as int) as num_borr, case when c_custkey % 6 = 0 then 'Y' else 'N' end as ppen,
    case when c_custkey % 3 = 0 then 180 when c_custkey % 3 = 1 then 240 else 360 end as term,
    3e0 + (c_custkey % 40) / 10e0 as rate, tot / 100e0 * 1.25e0 as prop_val,
    tot / 100e0 * (c_custkey % 11) / 10e0 as fcl_pro_net, cast(year(fp) as varchar) as vintage,
    cast(('0x' || substr(md5(cast(c_custkey as varchar)), 1, 7))::bigint % 20 as int) as bucket,
    case when c_custkey % 17 = 0 then 'fico' when c_custkey % 19 = 0 then 'dti' else '' end as failed,
    c_custkey % 23 = 0 as all_failed
  from customer join fx_b on c_custkey = k),
fx_cal as (
  select k, fp, lp, tot, cast(unnest(generate_series(fp, lp, interval 1 month)) as date) as m from fx_b),
fx_month as materialized (
  select c.k as loan_id, c.m as month, cast(datediff('month', c.fp, c.m) as int) as age_fp_dt,
    (c.tot - cast(sum(coalesce(o.cents, 0)) over w as bigint)) / 100e0 as upb,
    cast(datediff('month', max(case when o.k is not null then c.m end) over w, c.m) as int) as dq,
    case when c.k % 13 = 0 then 0e0 else 3e0 + (c.k % 40) / 10e0 end as cur_rate,
    case when c.k % 5 = 0 and max(case when o.pr = '5-LOW' then 1 else 0 end) over w = 1 then 'Y' else 'N' end as mod,
    case when c.m < c.lp then '00' when o.st = 'F' then '01' when o.st = 'P' and c.k % 2 = 0 then '03'
         when o.st = 'P' then '09' else '00' end as zb,
    case when c.k % 7 = 0 then 'T' else 'N' end as bap,
    case when o.k is null then 'unknown' else concat('SV', cast(o.cents % 5 as varchar)) end as servicer
  from fx_cal c left join fx_om o on o.k = c.k and o.m = c.m
  window w as (partition by c.k order by c.m rows between unbounded preceding and current row)),
fx_econ as materialized (
  select c_custkey as zip, lpad(cast(c_nationkey as varchar), 3, '0') as zip3, cast(g.m as date) as month,
    100e0 + c_nationkey + 0.4e0 * datediff('month', date '1995-01-01', g.m) as zip3_hpi,
    3e0 + ((c_custkey + datediff('month', date '1995-01-01', g.m)) % 50) / 10e0 as unemp_rate,
    2000e0 + c_acctbal as lbr_force,
    6e0 + (datediff('month', date '1995-01-01', g.m) % 24) / 12e0 as mort_fix30,
    5.5e0 + (datediff('month', date '1995-01-01', g.m) % 24) / 12e0 as mort_fix15,
    4e0 + (datediff('month', date '1995-01-01', g.m) % 24) / 12e0 as treas10,
    20000e0 + 100 * c_nationkey as q10, 30000e0 + 100 * c_nationkey as q25, 50000e0 + 100 * c_nationkey as q50,
    80000e0 + 100 * c_nationkey as q75, 120000e0 + 100 * c_nationkey as q90,
    case when c_nationkey % 5 = 0 then '' else concat('MSA', cast(c_nationkey as varchar)) end as msa_name,
    concat('S', cast(c_nationkey as varchar)) as state,
    case when c_nationkey = 3 then 0 else 120 + 30 * (c_nationkey % 4) end as fc_days,
    case when c_nationkey % 2 = 0 then 'Judicial' else 'Non-Judicial' end as fc_type
  from customer, (select unnest(generate_series(date '1995-01-01', date '2001-12-01', interval 1 month)) as m) g),
fx_z as (
  select *, exp(('0x' || substr(md5(concat(cast(o_orderkey as varchar), '|0')), 1, 7))::bigint / 268435456e0
      + case when o_orderstatus = 'F' then 0.25e0 else 0e0 end + 0.6e0) as e0,
    exp(('0x' || substr(md5(concat(cast(o_orderkey as varchar), '|1')), 1, 7))::bigint / 268435456e0
      + case when o_orderstatus = 'O' then 0.25e0 else 0e0 end) as e1,
    exp(('0x' || substr(md5(concat(cast(o_orderkey as varchar), '|2')), 1, 7))::bigint / 268435456e0
      + case when o_orderstatus = 'P' then 0.25e0 else 0e0 end) as e2
  from orders),
fx_scored as (
  select o_orderkey as id, o_orderpriority as slicer, o_totalprice as feature, o_orderstatus as level,
    case o_orderstatus when 'F' then 0 when 'O' then 1 else 2 end as obs_class,
    cast(date_trunc('month', o_orderdate) as date) as month,
    e0 / (e0 + e1 + e2) as p0, e1 / (e0 + e1 + e2) as p1, e2 / (e0 + e1 + e2) as p2
  from fx_z)"""

# Every as-of row of every loan, with its history features.
PANEL = """
hist as (
  select l.*, t.month as ao_dt, t.age_fp_dt as ao_age, t.upb as ao_upb, t.dq as ao_dq, t.cur_rate as ao_rate,
    t.mod as ao_mod, t.zb as ao_zb, t.bap as ao_bap, year(t.month) * 12 + month(t.month) as mi,
    l.term - t.age_fp_dt as ao_rem_term,
    case when t.cur_rate > 0 then t.cur_rate / 1200e0 else 0.001e0 / 1200e0 end as ao_r,
    max(least(t.dq, 6)) over lag12 as max12,
    cast(count(*) filter (where t.dq = 1) over lag12 as int) as ao_times30,
    cast(count(*) filter (where t.dq = 2) over lag12 as int) as ao_times60,
    cast(count(*) filter (where t.dq >= 3) over lag12 as int) as ao_times90p,
    cast(least(36, count(*) filter (where t.dq = 0) over prior) as int) as ao_months_cur,
    coalesce(last_value(case when t.servicer <> 'unknown' then t.servicer end ignore nulls) over prior, 'other') as servicer
  from fx_loan l join fx_month t using (loan_id)
  window lag12 as (partition by l.loan_id order by year(t.month) * 12 + month(t.month)
                   range between 12 preceding and 1 preceding),
         prior as (partition by l.loan_id order by t.month rows between unbounded preceding and 1 preceding)),
every as (
  select *, case when msa = '00000' then state else msa end as msa_loc, ao_age // 12 as age_yr,
    case when cltv > ltv then 'Y' else 'N' end as has_second, case when num_borr > 1 then 'Y' else 'N' end as co_borr,
    case when ao_age <= 36 and ppen = 'Y' then 'Y' else 'N' end as ppen36, 'Overall' as no_groups,
    least(ao_dq, 6) as ao_dq_cap6, cast(ao_dt - interval 12 month as date) as lag12,
    greatest(coalesce(max12, 0), 0) as ao_max_dq12,
    ao_r * ao_upb / (1e0 - pow(1e0 + ao_r, -ao_rem_term)) as ao_payment,
    case when ao_times30 > 0 then 'Y' else 'N' end as ao_prior30,
    case when ao_times60 > 0 then 'Y' else 'N' end as ao_prior60,
    case when ao_times90p > 0 then 'Y' else 'N' end as ao_prior90p
  from hist where failed <> 'fico' and not all_failed and ao_rem_term > 0),
panel as materialized (
  select * from every where ao_age >= 0 and ao_dq >= 0 and ao_dq <= 24 and ao_upb > 10000 and ao_zb = '00')"""

PAIRS = """
raw_pairs as (
  select p.*, t.month as trg_dt, t.dq as trg_dq, t.cur_rate as trg_rate, t.mod as trg_mod, t.zb as trg_zb,
    t.bap as trg_bap, t.age_fp_dt as trg_age, p.term - t.age_fp_dt as trg_rem_term,
    cast(datediff('month', p.ao_dt, t.month) as int) as fcst_month,
    case when t.cur_rate > 0 then t.cur_rate / 1200e0 else 0.01e0 / 1200e0 end as trg_r
  from {sample} p join fx_month t using (loan_id)
  where t.month >= p.ao_dt and datediff('month', p.ao_dt, t.month) <= 180 and p.term - t.age_fp_dt > 0),
pairs as (
  select *, ao_upb * pow(1e0 + ao_r, fcst_month) - ao_payment * (pow(1e0 + ao_r, fcst_month) - 1e0) / ao_r as trg_upb_exp,
    concat(cast(year(trg_dt) as varchar), 'Q', cast(quarter(trg_dt) as varchar)) as trg_yr_qtr,
    case when year(trg_dt) >= 1999 then cast(year(trg_dt) as varchar) else 'Before 1999' end as periods,
    case when trg_dt between date '1999-04-01' and date '2001-04-01' then 'Y' else 'N' end as covid,
    case when trg_zb = '03' then 'Y' else 'N' end as short_sale,
    case when trg_mod = 'Y' then 1 else 0 end as target_mod,
    case when trg_mod = 'Y' or trg_bap in ('T', 'F', 'R') then 1 else 0 end as target_assist,
    greatest(0, least(12, trg_dq)) as target_dq,
    case trg_zb when '00' then 0 when '01' then 1 else 2 end as target_death,
    case trg_zb when '00' then greatest(0, least(12, trg_dq)) when '01' then 13 else 14 end as target_status
  from raw_pairs)"""

WINDOWED = f"""
pos as materialized (
  select *, cast(row_number() over (partition by loan_id order by month) as int) as i,
    cast(count(*) over (partition by loan_id) as int) as size
  from fx_month),
ends as materialized (
  select p.*, a.i as f_index, coalesce(e.i, a.size) as l_index, cast(p.ao_dt + interval {WINDOW} month as date) as trg_dt,
    {WINDOW} as window_, p.ao_age + {WINDOW} as trg_age, p.term - p.ao_age - {WINDOW} as trg_rem_term
  from panel p join pos a on a.loan_id = p.loan_id and a.month = p.ao_dt
  left join pos e on e.loan_id = p.loan_id and e.month = cast(p.ao_dt + interval {WINDOW} month as date)
  where p.term - p.ao_age - {WINDOW} > 0),
events as (
  select n.loan_id, n.ao_dt, max(case when t.zb = '01' then 1 else 0 end) as target_pp,
    max(case when t.zb in ('03', '09') then 1 else 0 end) as target_default,
    max(case when t.dq >= 4 then 1 else 0 end) as target_dq120, max(case when t.mod = 'Y' then 1 else 0 end) as target_mod
  from ends n join pos t on t.loan_id = n.loan_id and t.i between n.f_index and n.l_index group by 1, 2),
windowed as (
  select n.*, v.target_pp, v.target_default, v.target_dq120, v.target_mod, n.ao_age + n.l_index - n.f_index as end_age,
    {WINDOW} as fcst_month, t.zb as trg_zb, case when t.cur_rate = 0 then n.ao_rate else t.cur_rate end as trg_rate,
    case when n.ao_rate > 0 then n.ao_rate / 1200e0 else 0.01e0 / 1200e0 end as trg_r,
    case when n.ao_rate > 0 then n.ao_rate / 1200e0 else n.ao_r end as pay_r,
    n.ao_upb * pow(1e0 + n.ao_r, {WINDOW}) - n.ao_payment * (pow(1e0 + n.ao_r, {WINDOW}) - 1e0) / n.ao_r as trg_upb_exp,
    concat(cast(year(n.trg_dt) as varchar), 'Q', cast(quarter(n.trg_dt) as varchar)) as trg_yr_qtr,
    case when year(n.trg_dt) >= 1999 then cast(year(n.trg_dt) as varchar) else 'Before 1999' end as periods,
    case when n.trg_dt between date '1999-04-01' and date '2001-04-01' then 'Y' else 'N' end as covid
  from ends n join events v using (loan_id, ao_dt) join pos t on t.loan_id = n.loan_id and t.i = n.l_index)"""

# Windows of histories with months missing, by dates alone.
GAPS = f"""
gap as (select * from fx_month where (year(month) * 12 + month(month) + loan_id) % 9 <> 4),
gends as (
  select p.loan_id, p.ao_dt, p.ao_age, e.month is not null as ends, cast(p.ao_dt + interval {WINDOW} month as date) as trg_dt
  from panel p join gap a on a.loan_id = p.loan_id and a.month = p.ao_dt
  left join gap e on e.loan_id = p.loan_id and e.month = cast(p.ao_dt + interval {WINDOW} month as date)
  where p.term - p.ao_age - {WINDOW} > 0),
gw as (
  select loan_id, ao_dt, cast(count(*) filter (month <= ao_dt) as int) as f_index, cast(count(*) as int) as l_index,
    cast(max(ao_age) + count(*) filter (month > ao_dt) as int) as end_age, arg_max(zb, month) as trg_zb,
    max(case when month >= ao_dt and zb = '01' then 1 else 0 end) as target_pp,
    max(case when month >= ao_dt and zb in ('03', '09') then 1 else 0 end) as target_default,
    max(case when month >= ao_dt and dq >= 4 then 1 else 0 end) as target_dq120,
    max(case when month >= ao_dt and mod = 'Y' then 1 else 0 end) as target_mod
  from gends n join gap t using (loan_id) where not ends or month <= trg_dt group by loan_id, ao_dt)"""

ECON = """
e as (
  select zip3, month, avg(zip3_hpi) as hpi, sum(unemp_rate * lbr_force) / sum(lbr_force) as unemp_rate,
    sum(lbr_force) as lbr_force, max(mort_fix30) as mort_fix30, max(mort_fix15) as mort_fix15, max(treas10) as treas10,
    max(q10) as income10, max(q25) as income25, max(q50) as income50, max(q75) as income75, max(q90) as income90,
    case when max(msa_name) = '' then max(state) else max(msa_name) end as msa_name_loc, max(fc_days) as fc_days,
    max(fc_type) as fc_type
  from fx_econ group by 1, 2)"""

FULL = """
joined as (
  select w.*, w.pay_r * w.trg_upb_exp / (1e0 - pow(1e0 + w.pay_r, -w.trg_rem_term)) as trg_payment,
    b.msa_name_loc as msa_loc_name, b.hpi as trg_hpi, c.hpi as ao_hpi, d.hpi as org_hpi, y.hpi as y20_hpi,
    b.unemp_rate as trg_unemp_rate, c.unemp_rate as ao_unemp_rate, b.lbr_force as trg_lbr, d.lbr_force as org_lbr,
    b.mort_fix15 as trg15, b.mort_fix30 as trg30, d.mort_fix15 as org15, d.mort_fix30 as org30,
    b.income50 as trg_income50, b.fc_days as trg_fc_days, b.fc_type as trg_fc_type,
    case when w.term <= 180 then 1e0 when w.term >= 360 then 0e0 else (360 - w.term) / 180e0 end as rt15_wt
  from {rows} w join e b on b.zip3 = w.zip3 and b.month = w.trg_dt join e c on c.zip3 = w.zip3 and c.month = w.ao_dt
  join e d on d.zip3 = w.zip3 and d.month = w.fp_dt join e y on y.zip3 = w.zip3 and y.month = date '1998-01-01'),
valued as (
  select *, 100e0 * (trg_hpi / org_hpi - 1) as trg_d_hpi, prop_val * (trg_hpi / org_hpi) as trg_prop_val,
    prop_val * (ao_hpi / org_hpi) as ao_prop_val, prop_val * (y20_hpi / org_hpi) as y20_prop_val,
    rate - (rt15_wt * org15 + (1 - rt15_wt) * org30) as org_spread, rt15_wt * trg15 + (1 - rt15_wt) * trg30 as new_rate,
    30 * (ao_dq + fcst_month) / nullif(cast(trg_fc_days as double), 0) as fc_ratio,
    1200e0 * (trg_lbr - org_lbr) / nullif(org_lbr * (ao_age + fcst_month), 0) as growth
  from joined),
full_rows as (
  select *, (new_rate / 1200e0) * trg_upb_exp / (1e0 - pow(1e0 + new_rate / 1200e0, -term)) as new_payment,
    case when abs(growth) < 25 then growth else 25e0 end as trg_lbr_growth,
    case when fc_ratio < 1.5e0 then fc_ratio else 1.5e0 end as trg_fc_time
  from valued)"""

SIX = "['<.1', '.1-.25', '.25-.5', '.5-.75', '.75-.9', '>.9']"


def h28(*cols: str, seed: int = SEED) -> str:
    text = " || '|' || ".join(f"cast({c} as varchar)" for c in cols)
    return f"cast(('0x' || substr(md5({text} || '|{seed}'), 1, 7)) as bigint)"


def sql(select: str, *parts: str) -> str:
    return "with " + ",".join([TABLES, *parts]) + "\n" + select


def rates(rows: str, cols: str, n: int, name: str = "rates") -> str:
    """Strata table: cap c with sum(min(n, c)) = target, found where it first fits below a stratum size."""
    return f"""
{name}_n as (select {cols}, count(*) as n from {rows} group by all),
{name}_run as (
  select n, ({n} - coalesce(sum(n) over (order by n rows between unbounded preceding and 1 preceding), 0))
    / cast(count(*) over () - row_number() over (order by n) + 1 as double) as cap from {name}_n),
{name} as (
  select *, coalesce(least(1e0, (select cap from {name}_run where cap <= n order by n, cap desc limit 1) / n), 1e0) as rate
  from {name}_n)"""


def draw(rows: str, cols: list[str], keys: list[str], n: int, name: str, label: str) -> str:
    on = " and ".join(f"r.{c} = s.{c}" for c in cols)
    keyed = h28(*[f"s.{k}" for k in keys])
    return rates(rows, ", ".join(cols), n, label) + f""",
{name} as (select s.* from {rows} s join {label} r on {on} where {keyed} < r.rate * 268435456)"""


def quantile(rows: str, by: str, value: str, name: str) -> str:
    """Smallest value whose cumulative share reaches p."""
    cuts = ", ".join(
        f"min({value}) filter (where rn >= greatest(ceil({p}e0 * n), 1)) as q{i}"
        for i, p in enumerate((0.1, 0.25, 0.5, 0.75, 0.9)))
    return f"""
{name}_rn as (
  select {by}, {value}, row_number() over (partition by {by} order by {value}) as rn,
    count(*) over (partition by {by}) as n from {rows} where {value} is not null),
{name} as (select {by}, {cuts} from {name}_rn group by {by})"""


def group_no(value: str, q: str) -> str:
    return " + ".join(["1", *[f"cast({value} > {q}.q{i} as int)" for i in range(5)]])


AVERAGES = """count(*) as n, round(avg(fit), 7) as avg_fit, round(avg(obs), 7) as avg_obs,
  round(avg(obs) - 1.96e0 * stddev_samp(obs) / sqrt(count(*)), 7) as low,
  round(avg(obs) + 1.96e0 * stddev_samp(obs) / sqrt(count(*)), 7) as high"""


def binary(cols: tuple[int, ...] = (0,), digits: int | None = None, slice_: str = "'Overall'") -> str:
    fit = " + ".join(f"p{c}" for c in cols)
    fit = fit if digits is None else f"round({fit}, {digits})"
    seen = ", ".join(map(str, cols))
    return f"""
b as (select *, {fit} as fit, case when obs_class in ({seen}) then 1e0 else 0e0 end as obs, {slice_} as slice
      from fx_scored)"""


def ks_sql(cols=(0,), slice_="'Overall'") -> str:
    return sql("""select slice, round(100 * max(abs(c1 / n1 - c0 / n0)), 6) as ks,
      cast(max(n0) as bigint) as n0, cast(max(n1) as bigint) as n1 from (
      select slice, fit, sum(obs) over w as c1, sum(1 - obs) over w as c0, sum(obs) over s as n1, sum(1 - obs) over s as n0
      from b window w as (partition by slice order by fit range between unbounded preceding and current row),
                    s as (partition by slice)) group by slice""", binary(cols, None, slice_))


def decile_sql(cols=(0,), digits=None, slice_="'Overall'") -> str:
    return sql(f"select slice, decile, {AVERAGES} from d group by slice, decile", binary(cols, digits, slice_), f"""
d as (select *, cast(ntile(10) over (partition by slice order by fit, {h28('id', seed=0)}, id) as int) as decile from b)""")


def split_sql(model: str, assess: str, out: str) -> str:
    return sql(f"""select case when bucket < 10 then 'model' when bucket < 15 then 'validate' else 'assess' end as part,
      count(*) as n, {out} from panel
      where case when bucket < 15 then {model} else {assess} end group by 1""", PANEL)


Z_STATS = """
st as (select avg(fico) as mf, stddev_samp(fico) as sf, avg(ltv) as ml, stddev_samp(ltv) as sl,
         avg(rate) as mr, stddev_samp(rate) as sr from fx_loan where bucket < 10)"""
NET = Z_STATS + """,
x as (select loan_id, fico, ltv, num_borr, (fico - mf) / sf as z1, (ltv - ml) / sl as z2, cast(num_borr = 1 as int) as o1,
        cast(num_borr = 2 as int) as o2 from fx_loan, st),
hid as (select *, 0.5e0 * z1 + 0.2e0 * z2 + 0.1e0 * o1 - 0.3e0 * o2 + 0.1e0 as h1,
          -0.25e0 * z1 + 0.3e0 * z2 + 0.2e0 * o1 as h2,
          0.1e0 * z1 - 0.4e0 * z2 + 0.3e0 * o1 + 0.2e0 * o2 - 0.1e0 as h3 from x),
outs as (select *, exp(0.4e0 * h1 + 0.1e0 * h2 - 0.5e0 * h3 + 0.05e0) as a0,
          exp(-0.2e0 * h1 + 0.3e0 * h2 + 0.2e0 * h3 - 0.05e0) as a1 from hid)"""

MARGINAL = binary(slice_="slicer") + f""",
smp as (select * from (select *, row_number() over (partition by slice order by {h28('id', seed=LEVEL_SEED)}, id) as rn from b)
        where rn <= 1000),
{quantile('smp', 'slice', 'fit', 'mq').lstrip()},
grp as (select s.*, 7 - ({group_no('s.fit', 'mq')}) as grp from smp s join mq using (slice))"""


def economic(select: str) -> str:
    return sql(f"select loan_id, ao_dt, {select} from full_rows", PANEL, WINDOWED, ECON,
               FULL.format(rows="(select * from windowed where trg_zb in ('00', '01', '03', '09'))"))


def two_stage(select: str, *more: str) -> str:
    return sql(select, PANEL, draw("panel", ["state", "ao_dq_cap6"], ["loan_id", "ao_dt"], N1, "first_pass", "r1"),
               PAIRS.format(sample="first_pass"),
               "\nhazard as (select * from pairs where trg_zb = '00' and fcst_month > 0)",
               draw("hazard", ["fcst_month"], ["loan_id", "ao_dt", "trg_dt"], N2, "second_pass", "r2"), *more)


def assessed(feature: str, slicer: str, curve: str | None) -> str:
    """Of the rows ``held``: sizes of deciles and slices, and observed means of segments and of a curve."""
    classes = curve is not None
    parts = [f"""select 'segment' as of, cast({slicer} as varchar) as slice, cast({feature} as varchar) as level, count(*) as n,
      round(avg(obs), 6) as obs from held group by all"""]
    for label, by in (("overall", "'Overall'"), ("sliced", f"cast({slicer} as varchar)")):
        parts.append(f"""select '{label} decile', slice, cast(d as varchar), n // 10 + cast(d <= n % 10 as int), 0e0
          from (select {by} as slice, count(*) as n from held group by 1), range(1, 11) t(d) where n // 10 + cast(d <= n % 10 as int) > 0""")
        parts.append(f"""select '{label} {'classes' if classes else 'rows'}', {by}, 'all', count(*),
          {'round(avg(obs), 6)' if classes else '0e0'} from held group by all""")
    if curve:
        parts.append(f"select 'curve', 'Overall', cast({curve} as varchar), count(*), round(avg(obs), 6) from held group by all")
    return " union all ".join(parts)


def oracle() -> dict[str, str]:
    pairs = PAIRS.format(sample="panel")
    strata = ["state", "ao_dq_cap6"]
    keys1, keys2 = ["loan_id", "ao_dt"], ["loan_id", "ao_dt", "trg_dt"]
    out: dict[str, str] = {}

    out["nested_history"] = sql("""select loan_id, cast(row_number() over (partition by loan_id order by month) - 1 as int)
      as pos, month, age_fp_dt, round(upb, 2) as upb, dq, mod, zb from fx_month""")
    out["source_filter"] = sql("""select bucket, fico, loan_id, ltv from fx_loan
      where purpose <> 'BUILDING' and bucket < 10""")
    out["good_loan"] = sql("select loan_id, state, vintage from fx_loan where failed <> 'fico' and not all_failed")
    out["as_of_panel"] = sql("""select loan_id, ao_dt, msa_loc, ao_age, age_yr, has_second, co_borr, ppen36, no_groups,
      ao_dq, ao_dq_cap6, round(ao_upb, 2) as ao_upb, ao_mod, ao_bap, ao_zb, ao_rem_term from panel""", PANEL)
    out["ao_history"] = sql("""select loan_id, ao_dt, lag12, ao_max_dq12, ao_times30, ao_times60, ao_times90p,
      ao_months_cur, ao_prior30, ao_prior60, ao_prior90p from every""", PANEL)
    out["ao_servicer"] = sql("select loan_id, ao_dt, servicer from every", PANEL)
    out["ao_payment"] = sql("""select loan_id, ao_dt, round(ao_rate, 6) as ao_rate, round(ao_r, 10) as ao_r, ao_rem_term,
      round(ao_payment, 4) as ao_payment from every""", PANEL)
    out["as_of_panel_pay_plan"] = sql("select loan_id, ao_dt, msa_loc, ao_dq, ao_max_dq12, ao_zb from panel", PANEL)

    sums = ", ".join(f"cast(sum({c}) as bigint) as sum_{c}" for c in
                     ("fcst_month", "trg_dq", "trg_age", "trg_rem_term", "target_dq"))
    out["target_pairs"] = sql(f"""select trg_yr_qtr, periods, covid, short_sale, count(*) as n, {sums},
      min(trg_dt) as first_dt, max(ao_dt) as last_ao from pairs group by 1, 2, 3, 4""",
                              PANEL, pairs)
    out["target_status"] = sql("""select target_status, target_death, target_dq, count(*) as n from pairs
      group by 1, 2, 3""", PANEL, pairs)
    out["target_assist"] = sql("""select target_mod, target_assist, trg_bap, ao_mod, count(*) as n from pairs
      group by 1, 2, 3, 4""", PANEL, pairs)
    out["target_assist_pay_plan"] = sql("""select case when trg_mod = 'Y' or trg_bap = 'T' then 1 else 0 end as target_assist,
      case when trg_bap = 'T' then 'Y' else 'N' end as trg_pay_pl, 'N' as trg_reo, 'SV0' as servicer, count(*) as n
      from pairs group by 1, 2""", PANEL, pairs)
    out["trg_upb_exp"] = sql("""select fcst_month, count(*) as n, round(avg(trg_upb_exp), 2) as avg_upb_exp,
      round(avg(pay_r * trg_upb_exp / (1e0 - pow(1e0 + pay_r, -trg_rem_term))), 3) as avg_payment,
      round(avg(trg_r), 9) as avg_r
      from (select *, case when trg_rate > 0 then trg_r else ao_r end as pay_r from pairs) group by 1""", PANEL, pairs)
    out["target_filtered"] = sql("""select fcst_month, trg_dq, count(*) as n from pairs
      where trg_zb = '00' and fcst_month > 0 group by 1, 2""", PANEL, pairs)

    active = "trg_zb in ('00', '01', '03', '09')"
    def row_hash(*columns: str) -> str:
        parts = ", ".join(f"cast({c} as varchar)" for c in columns)
        return f"cast(sum(('0x' || substr(md5(concat_ws('|', {parts}, 'row')), 1, 7))::bigint) as bigint) as row_hash"

    out["target_window"] = sql(f"""select loan_id, ao_dt, window_ as "window", trg_dt, trg_age, fcst_month, f_index,
      l_index, end_age, trg_zb, round(trg_rate, 6) as trg_rate, target_pp, target_default, target_dq120, target_mod,
      trg_yr_qtr, periods, covid from windowed where {active}""", PANEL, WINDOWED)
    out["window_balance"] = sql(f"""select loan_id, count(*) as n, {row_hash("ao_dt", "trg_rem_term")}, round(sum(trg_r), 9) as trg_r,
      round(sum(trg_upb_exp), 2) as trg_upb_exp,
      round(sum(pay_r * trg_upb_exp / (1e0 - pow(1e0 + pay_r, -trg_rem_term))), 3) as trg_payment
      from windowed where {active} group by 1""", PANEL, WINDOWED)
    events = ", ".join(f"cast(sum({c}) as bigint) as {c}" for c in
                       ("target_pp", "target_default", "target_dq120", "target_mod", "end_age"))
    out["target_window_pay_plan"] = sql(f"""select msa_loc, trg_yr_qtr, count(*) as n, {events} from windowed
      where {active} group by 1, 2""", PANEL, WINDOWED)
    out["censor_guard"] = sql(f"""select ao_dt, count(*) as n, cast(sum(target_dq120) as bigint) as dq120 from windowed
      where {active} and ao_dt <= (select max(month) from fx_month) - interval {WINDOW} month group by 1""", PANEL, WINDOWED)

    out["strata_counts"] = sql("""select state, ao_dt, ao_dq_cap6, count(*) as n from panel group by 1, 2, 3""", PANEL)
    out["strata_rates"] = sql("""select state, ao_dq_cap6, n, round(rate, 9) as rate, round(rate * n, 6) as expected
      from rates""", PANEL, rates("panel", "state, ao_dq_cap6", N2))
    out["stratified_sample"] = sql("select loan_id, ao_dt, state, ao_dq_cap6, ao_max_dq12, ao_months_cur, servicer from drawn",
                                   PANEL, draw("panel", strata, keys1, N2, "drawn", "rates"))
    out["history_strata_sample"] = sql("select loan_id, ao_dt, ao_max_dq12, purpose from drawn", PANEL,
                                       draw("panel", ["ao_max_dq12", "purpose"], keys1, N2, "drawn", "rates"))
    four = ["state", "ao_dt", "ao_age", "ao_dq_cap6"]
    out["four_strata_sample"] = sql("select loan_id, ao_dt, state, ao_age, ao_dq_cap6 from drawn",
                                    PANEL, draw("panel", four, keys1, N2, "drawn", "rates"))
    out["sample_tables"] = sql("""select state, ao_dq_cap6, r.n, round(rate, 9) as rate, coalesce(d.n, 0) as drawn
      from rates r left join (select state, ao_dq_cap6, count(*) as n from drawn group by all) d using (state, ao_dq_cap6)""",
                               PANEL, draw("panel", strata, keys1, N1, "drawn", "rates"))
    out["read_tables"] = sql("""select 'loans' as source, zip3, count(distinct loan_id) as n, count(*) as entries
      from fx_loan join fx_month using (loan_id) group by zip3
      union all select 'econ', zip3, count(*), count(distinct month) from fx_econ group by zip3""")
    out["stratified_sample_exact"] = sql(f"""select loan_id, ao_dt, state, ao_dq_cap6, ao_max_dq12, ao_months_cur, servicer
      from (select p.*, r.take,
        row_number() over (partition by p.state, p.ao_dq_cap6 order by {h28('loan_id', 'ao_dt')}, loan_id, ao_dt) as rn
      from panel p join takes r on p.state = r.state and p.ao_dq_cap6 = r.ao_dq_cap6) where rn <= take""",
                                         PANEL, rates("panel", "state, ao_dq_cap6", N2), f"""
whole as (select *, cast(floor(round(rate * n, 6)) as bigint) as w from rates),
takes as (select state, ao_dq_cap6, w + case when w < n and row_number() over (
    partition by w < n order by {h28('state', 'ao_dq_cap6')}, state, ao_dq_cap6)
    <= (select round(sum(rate * n)) - sum(w) from whole) then 1 else 0 end as take from whole)""")
    out["random_sample"] = sql(f"""select loan_id, ao_dt from panel
      where {h28('loan_id', 'ao_dt')} < least(1e0, {N2}e0 / (select count(*) from panel)) * 268435456""", PANEL)
    out["per_slice_sample"] = sql(f"""select loan_id, ao_dt, state from (select *, row_number() over (
      partition by state order by {h28('loan_id', 'ao_dt', seed=LEVEL_SEED)}, loan_id, ao_dt) as rn from panel) where rn <= 500""", PANEL)
    out["sample_after_sample"] = sql(f"""select loan_id, ao_dt, state, ao_dq_cap6 from (select *, row_number() over (
      partition by state order by {h28('loan_id', 'ao_dt', seed=LEVEL_SEED)}, loan_id, ao_dt) as rn from first) where rn <= 100""",
                                     PANEL, draw("panel", ["state", "ao_dq_cap6"], ["loan_id", "ao_dt"], N2, "first", "rates"))
    out["history_disorder"] = out["ao_history"]
    out["nest_repeats"] = out["nested_history"]
    gaps = sql("""select w.*, p.path from gw w, (select unnest(['loan join', 'sampled']) as path) p""", PANEL, GAPS)
    out["window_gaps"] = gaps
    out["two_stage_sample"] = two_stage(
        "select loan_id, ao_dt, trg_dt, fcst_month, trg_dq, ao_dq_cap6 from second_pass")
    out["balanced_target_sample"] = sql("select loan_id, ao_dt, trg_dt, target_status, round(trg_upb_exp, 3) as trg_upb_exp from drawn", PANEL, pairs,
                                        draw("pairs", ["target_status"], keys2, N2, "drawn", "rates"))

    out["rollup_econ"] = sql("""select zip3, month, round(hpi, 6) as hpi, round(unemp_rate, 6) as unemp_rate,
      round(lbr_force, 3) as lbr_force, round(mort_fix30, 6) as mort_fix30, round(mort_fix15, 6) as mort_fix15,
      round(treas10, 6) as treas10, income10, income25, income50, income75, income90, msa_name_loc, fc_days, fc_type
      from e""", ECON)
    out["multi_date_join"] = sql("""select p.loan_id, p.ao_dt, round(a.hpi, 6) as ao_hpi, round(o.hpi, 6) as org_hpi,
      round(y.hpi, 6) as y20_hpi, round(a.unemp_rate, 6) as ao_unemp_rate, round(o.unemp_rate, 6) as org_unemp_rate,
      a.fc_type as ao_fc_type from panel p join e a on a.zip3 = p.zip3 and a.month = p.ao_dt
      join e o on o.zip3 = p.zip3 and o.month = p.fp_dt join e y on y.zip3 = p.zip3 and y.month = date '1998-01-01'""",
                                 PANEL, ECON)
    out["zip_lookup"] = sql(f"""select p.loan_id, count(*) as n, {row_hash("p.ao_dt", "o.fc_type")},
      round(sum(a.unemp_rate), 5) as ao_unemp_rate, round(sum(o.unemp_rate), 5) as org_unemp_rate,
      round(sum(a.lbr_force), 1) as ao_lbr_force
      from panel p join fx_econ a on a.zip = p.loan_id and a.month = p.ao_dt
      join fx_econ o on o.zip = p.loan_id and o.month = p.fp_dt group by 1""", PANEL)
    out["econ_losses"] = sql(f"""select u.lookup, u.lost, n as n_rows from (
      select count(*) as n, count(*) filter (where b.month is null) as l1, count(*) filter (where c.month is null) as l2,
        count(*) filter (where d.month is null) as l3, count(*) filter (where y.month is null) as l4,
        count(*) filter (where b.month is null or c.month is null or d.month is null or y.month is null) as l5
      from windowed w left join e b on b.zip3 = w.zip3 and b.month = w.trg_dt
      left join e c on c.zip3 = w.zip3 and c.month = w.ao_dt left join e d on d.zip3 = w.zip3 and d.month = w.fp_dt
      left join e y on y.zip3 = w.zip3 and y.month = date '1998-01-01' where {active}) t,
      lateral (values ('trg', l1), ('ao', l2), ('org', l3), ('y20', l4), ('any', l5)) u(lookup, lost)""",
                             PANEL, WINDOWED, ECON)
    out["prop_values"] = economic("""msa_loc_name, round(ln(trg_prop_val), 7) as log_trg_prop_val,
      round(ln(ao_prop_val), 7) as log_ao_prop_val, round(ln(y20_prop_val), 7) as log_y20_prop_val,
      round(100e0 * ao_upb / ao_prop_val, 3) as ao_eltv, round(100e0 * trg_upb_exp / trg_prop_val, 3) as trg_eltv,
      round(trg_d_hpi, 7) as trg_d_hpi""")
    out["refi_incentive"] = economic("""round(rt15_wt, 4) as rt15_wt, round(org_spread, 4) as org_spread,
      round(new_rate, 4) as new_rate, round(new_payment, 4) as new_payment,
      round(12e0 * (trg_payment - new_payment), 4) as trg_refi_incentive""")
    out["lbr_growth"] = economic("""round(trg_lbr_growth, 5) as trg_lbr_growth, round(trg_unemp_rate, 5) as trg_unemp_rate,
      round(ao_unemp_rate, 5) as ao_unemp_rate""")
    out["fc_time"] = economic("""least(12, ao_dq + fcst_month) as trg_dq_max, trg_fc_days, trg_fc_type,
      round(trg_fc_time, 6) as trg_fc_time, round(fcl_pro_net / trg_prop_val, 6) as target_net_pro""")
    out["pti"] = economic("""round(least(100e0, 1200e0 * trg_payment / trg_income50), 4) as trg_pti50, trg_income50""")
    out["window_training_table"] = sql("""select loan_id, ao_dt, trg_dt, f_index, l_index, end_age, target_pp,
      target_dq120, round(trg_upb_exp, 3) as trg_upb_exp from drawn""",
        PANEL, draw("panel", strata, keys1, N1, "first_pass", "r1"),
        WINDOWED.replace("from panel p", "from first_pass p"),
        f"\nopen_rows as (select * from windowed where {active})",
        draw("open_rows", ["trg_dt"], keys2, N2, "drawn", "r2"))
    out["training_table"] = two_stage(
        """select loan_id, ao_dt, trg_dt, fcst_month, round(trg_upb_exp, 3) as trg_upb_exp, round(trg_hpi, 6) as trg_hpi,
        round(y20_hpi, 6) as y20_hpi, round(trg_lbr_growth, 5) as trg_lbr_growth, round(org_spread, 6) as org_spread
        from full_rows""", ECON,
        FULL.format(rows="(select *, case when trg_rate > 0 then trg_r else ao_r end as pay_r from second_pass)"))

    for profile in (PLAN_CODE, PAY_PLAN):
        known = {c: f"f.{c}" for c in STATIC} | {"msa_d": "f.msa", "servicer": "'SV0'"}
        lists = {c: known.get(c, f"concat('{c}-', cast(f.loan_id % {7 + k} as varchar))") for k, c in enumerate(profile.static)} | {
            "trg_dt": "f.trg_dt", "trg_dq": "t.dq", "trg_mod": "t.mod", "trg_zb": "t.zb", "trg_io_rem": "t.dq + t.age_fp_dt % 5",
            "trg_bap": "t.bap", "trg_program": "concat('P', cast(t.dq % 3 as varchar))", "trg_age": "t.age_fp_dt",
            "trg_reo": "case when t.dq % 2 = 0 then 'Y' else 'N' end", "trg_pay_pl": "case when f.loan_id % 7 = 0 then 'Y' else 'N' end"}
        sums = {"rate": ("f.rate", 6), "prop_val": ("f.prop_val", 5), "fcl_pro_net": ("f.fcl_pro_net", 4),
                "trg_upb_act": ("t.upb", 3), "trg_rate": ("t.cur_rate", 6)}
        whole = row_hash(*[lists[c] for c in (*profile.static, *profile.monthly) if c not in sums and c != "loan_id"])
        out[f"all_columns_{profile.name}"] = two_stage(
            f"""select f.loan_id, count(*) as n, {whole}, {", ".join(f"round(sum({e}), {d}) as {c}" for c, (e, d) in sums.items())}
            from joined f join fx_month t on t.loan_id = f.loan_id and t.month = f.trg_dt group by 1""", ECON,
            FULL.format(rows="(select *, case when trg_rate > 0 then trg_r else ao_r end as pay_r from second_pass)"))
    paid = "(select *, case when trg_rate > 0 then trg_r else ao_r end as pay_r from {})"
    out["job_hazard"] = two_stage(
        assessed("purpose", "ao_dq_cap6", "trg_yr_qtr"), ECON, FULL.format(rows=paid.format("second_pass")),
        "\nheld as (select *, case when target_dq between 4 and 12 then 1e0 else 0e0 end as obs from full_rows where bucket >= 15)")
    out["job_window"] = sql(
        assessed("vintage", "purpose", "vintage"), PANEL, draw("panel", strata, keys1, N1, "first_pass", "r1"),
        WINDOWED.replace("from panel p", "from first_pass p"), f"\nopen_rows as (select * from windowed where {active})",
        draw("open_rows", ["trg_dt"], keys2, N2, "drawn", "r2"), ECON, FULL.format(rows="drawn"),
        "\nheld as (select *, cast(target_pp as double) as obs from full_rows where bucket >= 15)")
    out["job_regression"] = sql(
        assessed("trg_fc_type", "short_sale", None), PANEL, "\nexits as (select * from every where ao_zb in ('03', '09'))",
        draw("exits", ["state"], keys1, N1, "first_pass", "r1"), PAIRS.format(sample="first_pass"),
        "\nsame_month as (select * from pairs where fcst_month = 0)",
        draw("same_month", ["ao_zb"], keys2, N2, "second_pass", "r2"), ECON, FULL.format(rows=paid.format("second_pass")),
        "\nheld as (select *, fcl_pro_net / trg_prop_val as obs from full_rows where bucket >= 15)")
    out["bucket_split"] = split_sql("true", "true", "count(distinct loan_id) as n_loans")
    out["out_of_time_split"] = split_sql("year(ao_dt) < 1999", "year(ao_dt) >= 1999",
                                         "min(ao_dt) as first_dt, max(ao_dt) as last_dt")
    out["feature_stats"] = sql(" union all ".join(
        f"""select '{c}' as feature, round(avg({c}), 4) as mean, round(stddev_samp({c}), 4) as sd from fx_loan
        where bucket < 10""" for c in ("fico", "ltv", "rate", "prop_val")))
    levels = " union all ".join(
        f"select '{c}' as feature, cast({c} as varchar) as level, {o} as ord, count(*) as n from fx_loan "
        f"where bucket < 10 group by 1, 2, 3"
        for c, o in (("purpose", "null::double"), ("state", "null::double"), ("term", "term::double"),
                     ("num_borr", "num_borr::double")))
    out["level_index"] = sql(f"""select feature, level,
      cast(row_number() over (partition by feature order by ord, level) - 1 as int) as idx, n,
      row_number() over (partition by feature order by n desc, ord, level) = 1 as is_default from ({levels})""")
    out["normalized"] = sql("""select loan_id, round((fico - mf) / sf, 6) as z_fico, round((ltv - ml) / sl, 6) as z_ltv,
      round((rate - mr) / sr, 6) as z_rate from fx_loan, st""", Z_STATS)

    def fitted(c: str) -> str:
        return f"""{c}_l as (select {c}, cast(row_number() over (order by {c}) - 1 as int) as i,
          row_number() over (order by count(*) desc, {c}) as by_n from fx_loan where state <> 'S3' group by 1)"""

    out["unseen_default"] = sql("""select loan_id, l.state, l.purpose,
      coalesce(s.i, (select i from state_l where by_n = 1)) as i_state,
      coalesce(p.i, (select i from purpose_l where by_n = 1)) as i_purpose
      from fx_loan l left join state_l s on s.state = l.state left join purpose_l p on p.purpose = l.purpose""",
                                "\n" + fitted("state"), "\n" + fitted("purpose"))
    hot = [f"case when d.r = {i} then 1e0 else 0e0 end as x{i}" for i in range(5)]
    hot += [f"case when term = {t} then 1e0 else 0e0 end as x{5 + i}" for i, t in enumerate((180, 240, 360))]
    out["one_hot"] = sql(f"""select loan_id, {', '.join(hot)} from fx_loan
      join (select purpose, row_number() over (order by purpose) - 1 as r from fx_loan where bucket < 10 group by 1) d
      using (purpose)""")

    out["coalesce_target"] = sql("select id, round(fit, 9) as fit, obs from b", binary((1, 2)))
    out["score_softmax"] = sql("""select loan_id, round(a0 / (a0 + a1), 8) as p0, round(a1 / (a0 + a1), 8) as p1
      from outs""", NET)
    out["score_embedded"] = sql("""select loan_id, round(greatest(z + 0.5e0 * i, 0)
      + 2 * greatest(-z + 0.25e0 * i + 0.5e0 * (1 - i) + 0.1e0, 0) + 0.5e0, 7) as y
      from (select loan_id, (fico - mf) / sf as z, case term when 180 then 0 when 240 then 1 else 2 end as i
            from fx_loan, st)""", Z_STATS)
    out["log_odds_feature"] = sql("""select loan_id, round(ln(a0 / a1), 7) as lo_first, round(ln(a1 / a0), 7) as lo_last
      from outs""", NET)
    out["nested_input_models"] = sql("select loan_id, round(2 * ln(a0 / a1) + 1, 7) as lo2 from outs", NET)
    out["saved_input_models"] = out["nested_input_models"]
    out["export_scored"] = sql("""select id, level, round(p0, 9) as first, round(p1 + p2, 9) as rest from fx_scored""")

    out["bias_start"] = sql(" union all ".join(
        f"""select {j} as class, count(*) as n, cast(0 as bigint) as bad,
        round(avg(cast(obs_class = {j} as int)), 9) as rate, round(avg(ln(p{j} / p2)), 9) as mean_log_odds,
        round(ln(avg(cast(obs_class = {j} as int)) / avg(cast(obs_class = 2 as int))) - avg(ln(p{j} / p2)), 8) as start
        from fx_scored""" for j in (0, 1)))
    out["bias_fit"] = sql("""select obs_class as class,
      round(count(*) / (select count(*) from fx_scored), 5) as mean_p from fx_scored group by 1""")

    out["curves"] = sql("""select cast(month as varchar) as level, count(*) as n, round(avg(fit), 7) as avg_fit,
      round(avg(obs), 7) as avg_obs from b group by 1""", binary())
    out["curves_quantile"] = sql(f"""select {SIX}[{group_no('b.feature', 'q')}] as level, count(*) as n,
      round(avg(fit), 7) as avg_fit, round(avg(obs), 7) as avg_obs from b join q using (slice) group by 1""",
                                 binary(), quantile("b", "slice", "feature", "q"))
    out["ks"] = ks_sql()
    out["ks_by_slice"] = ks_sql((2,), "slicer")
    out["class_cdfs"] = sql("""select distinct slice, fit, cast(n0 as bigint) as n0_total, cast(n1 as bigint) as n1_total,
      round(c0 / n0, 9) as cdf0, round(c1 / n1, 9) as cdf1 from (
      select slice, fit, sum(obs) over w as c1, sum(1 - obs) over w as c0, sum(obs) over s as n1, sum(1 - obs) over s as n0
      from b window w as (partition by slice order by fit range between unbounded preceding and current row),
                    s as (partition by slice))""", binary((0,), 2, "slicer"))
    out["decile"] = decile_sql()
    out["decile_by_slice"] = decile_sql((1, 2), None, "slicer")
    out["decile_ties"] = decile_sql((0,), 1, "slicer")
    out["segment"] = sql(f"""select slice, 'level' as feature, level as segment, {AVERAGES} from b group by 1, 2, 3
      union all select slice, 'slicer', slicer, {AVERAGES} from b group by 1, 2, 3""", binary())
    out["segment_quantile"] = sql(f"""select slice, 'level' as feature, level as segment, {AVERAGES} from b group by 1, 2, 3
      union all select slice, 'feature', {SIX}[{group_no('b.feature', 'q')}], {AVERAGES} from b join q using (slice)
      group by 1, 2, 3""", binary(slice_="slicer"), quantile("b", "slice", "feature", "q"))
    out["axis_range"] = sql("""select slice, round(least(f.q0, o.q0), 8) as low, round(greatest(f.q4, o.q4), 8) as high
      from f join o using (slice)""", binary(slice_="slicer"), quantile("b", "slice", "fit", "f"),
                            quantile("b", "slice", "obs", "o"))
    out["group_quantiles"] = sql("select state, " + ", ".join(f"round(q{i}, 2) as q{i}" for i in range(5)) + " from q",
                                 PANEL, quantile("panel", "state", "ao_upb", "q"))
    out["distribution_summary"] = sql("""select slice, count(*) as n, round(avg(feature), 3) as mean,
      round(stddev_samp(feature), 3) as sd, min(feature) as "min", max(feature) as "max", any_value(q0) as q10,
      any_value(q1) as q25, any_value(q2) as q50, any_value(q3) as q75, any_value(q4) as q90
      from b join q using (slice) group by slice""", binary(slice_="slicer"), quantile("b", "slice", "feature", "q"))
    five = ", ".join(f'round(quantile_cont({{0}}, {p}), {{1}}) as "{m}"' for p, m in
                     ((0.0, "min"), (0.25, "q25"), (0.5, "median"), (0.75, "q75"), (1.0, "max")))
    out["marginal_distribution"] = sql(f"""select slice, grp, count(*) as n, {five.format('feature', 5)} from grp
      group by 1, 2""", MARGINAL)
    out["marginal_levels"] = sql("select slice, grp, level, count(*) as n from grp group by 1, 2, 3", MARGINAL)
    out["marginal_response"] = sql("""select slice, grp, round(at_, 6) as at, count(*) as n, """
                                   + five.format("p0", 6).replace("quantile_cont(p0", "quantile_cont(p") + """
      from (select *, 0.5e0 * z1 + 0.2e0 * z2 + 0.1e0 * o1 - 0.3e0 * o2 + 0.1e0 as h1,
              -0.25e0 * z1 + 0.3e0 * z2 + 0.2e0 * o1 as h2,
              0.1e0 * z1 - 0.4e0 * z2 + 0.3e0 * o1 + 0.2e0 * o2 - 0.1e0 as h3,
              exp(0.4e0 * h1 + 0.1e0 * h2 - 0.5e0 * h3 + 0.05e0) as a0,
              exp(-0.2e0 * h1 + 0.3e0 * h2 + 0.2e0 * h3 - 0.05e0) as a1, a0 / (a0 + a1) as p from moved)
      group by slice, grp, at_""", NET, f"""
b as (select loan_id, fico, z2, o1, o2, cast(num_borr as varchar) as slice, a0 / (a0 + a1) as fit from outs),
smp as (select * from (select *, row_number() over (partition by slice order by {h28('loan_id', seed=LEVEL_SEED)}, loan_id) as rn from b)
        where rn <= 10000)""", quantile("smp", "slice", "fit", "mq"), f"""
grp as (select s.*, 7 - ({group_no('s.fit', 'mq')}) as grp from smp s join mq using (slice)),
span as (select slice, grp, quantile_cont(fico, 0.1) as lo, quantile_cont(fico, 0.9) as hi from grp group by 1, 2),
grid as (select distinct slice, grp, lo + (hi - lo) * (i / 9e0) as at_ from span, range(10) r(i)),
moved as (select g.*, at_, (at_ - mf) / sf as z1 from grp g join grid using (slice, grp), st)""")
    out["linear_fit"] = sql("""select count(*) as n, round(regr_slope(rate, fico), 7) as slope,
      round(regr_intercept(rate, fico), 5) as intercept, round(100 * regr_r2(rate, fico), 4) as r2
      from fx_loan where bucket < 10""")
    out["softmax_rates"] = sql("""select purpose, count(*) as n, count(*) filter (fico + ltv > 780) as n_hi,
      count(*) filter (not coalesce(fico + ltv > 780, false)) as n_lo from fx_loan where bucket < 10 group by 1""")
    out["model_warm_start"] = sql("select count(*) as n, 0.0::double as gap, true as went_on from fx_loan where bucket < 10")
    out["r_squared"] = sql("""select slicer as slice, count(*) as n,
      round(100 * (1 - avg((feature - feature * p0 * 2) * (feature - feature * p0 * 2)) / var_pop(feature)), 6) as r2
      from fx_scored group by 1""")
    return out
