"""SQL for each registered query, written for DuckDB on the same parquet tables.

The text is independent of the Spark code: global windows, correlated ranks and
pairwise counts are fine here, where only small data is checked.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations, product

from lendlens.operators.segments import CORRELATED

_CTES: dict[str, tuple[tuple[str, ...], str]] = {}


def _cte(name: str, text: str, *needs: str) -> None:
    _CTES[name] = (needs, text)


def _with(body: str, *needs: str) -> str:
    """``body`` preceded by the CTEs it needs, in dependency order."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        for other in _CTES[name][0]:
            visit(other)
        if name not in ordered:
            ordered.append(name)

    for name in needs:
        visit(name)
    if not ordered:
        return body
    return "with " + ",\n".join(f"{n} as ({_CTES[n][1]})" for n in ordered) + "\n" + body


def _rd(expression: str, digits: int = 6) -> str:
    return f"round(cast({expression} as double) + {10.0**-digits / 70!r}, {digits}) + 0e0"


def _out(body: str, d6: Sequence[str] = (), d2: Sequence[str] = (), big: Sequence[str] = (), d9: Sequence[str] = ()) -> str:
    """Round the named doubles and widen the named counts of a sub-select."""
    parts = [f"{_rd(c, 6)} as {c}" for c in d6]
    parts += [f"{_rd(c, 2)} as {c}" for c in d2]
    parts += [f"{_rd(c, 9)} as {c}" for c in d9]
    parts += [f"cast({c} as bigint) as {c}" for c in big]
    return f"select * replace ({', '.join(parts)}) from ({body})"


_SINGLE = ("EXT_SOURCE_MEAN", "EXT_SOURCE_MIN", "EXT_SOURCE_WEIGHTED", "EXT_SOURCE_PRODUCT")


def _score(multiplier: int, modulus: int) -> str:
    return f"(7e0*((o_orderkey*57)%991)/991+3e0*((o_orderkey*{multiplier})%{modulus})/{modulus})/1e1"


_cte(
    "apps",
    f"""select o_orderkey as SK_ID_CURR,
 cast(case when (o_orderkey*57)%991+(o_orderkey*13)%600<300 then 1 else 0 end as integer) as TARGET,
 o_totalprice as AMT_CREDIT,
 (c_acctbal+1e3)*2e1 as AMT_INCOME_TOTAL,
 case when o_orderkey%97=0 then null else o_totalprice/(6+o_orderkey%55) end as AMT_ANNUITY,
 case when o_orderkey%89=0 then null else o_totalprice*(7e-1+5e-2*(o_orderkey%10)) end as AMT_GOODS_PRICE,
 case when o_orderkey%211=0 then null else cast(1+o_custkey%5 as double) end as CNT_FAM_MEMBERS,
 case when o_orderpriority='5-LOW' then 'Revolving loans' else 'Cash loans' end as NAME_CONTRACT_TYPE,
 case when o_orderkey%400=0 then 'XNA' when o_custkey%3=0 then 'M' else 'F' end as CODE_GENDER,
 case when o_orderkey%701=0 then 'Unknown' when o_custkey%4=0 then 'Single / not married' else 'Married' end as NAME_FAMILY_STATUS,
 c_mktsegment as NAME_EDUCATION_TYPE,
 case when o_custkey%3=1 then null else c_mktsegment end as OCCUPATION_TYPE,
 case when o_custkey%10<7 then 'Y' else 'N' end as FLAG_OWN_REALTY,
 case when o_custkey%5<2 then 'Y' else 'N' end as FLAG_OWN_CAR,
 cast(-(6600+(o_custkey*7919)%20000) as bigint) as DAYS_BIRTH,
 cast(case when o_custkey%6=0 then 365243 else -((o_custkey*104729)%9000) end as bigint) as DAYS_EMPLOYED,
 case when o_orderkey%2=0 then null else {_score(31, 997)} end as EXT_SOURCE_1,
 case when o_orderkey%499=0 then null else {_score(71, 977)} end as EXT_SOURCE_2,
 case when o_orderkey%5=0 then null else {_score(83, 983)} end as EXT_SOURCE_3,
 case when o_orderkey%7=0 then null else cast(o_custkey%4 as double) end as AMT_REQ_CREDIT_BUREAU_YEAR,
 case when o_orderkey%301=0 then null else cast(o_custkey%3 as double) end as DEF_30_CNT_SOCIAL_CIRCLE,
 cast(1+n_regionkey%3 as integer) as REGION_RATING_CLIENT_W_CITY
from orders join customer on o_custkey=c_custkey join nation on c_nationkey=n_nationkey""",
)
_DAY = "date_diff('day', date '2001-12-31', cast(l_shipdate as date))"
_cte(
    "inst",
    f"""select l_orderkey as SK_ID_CURR, cast(l_linenumber as integer) as NUM_INSTALMENT_NUMBER,
 cast({_DAY} as integer) as DAYS_INSTALMENT,
 cast(case when l_partkey%53=0 then null else {_DAY}+(l_partkey%21)-12 end as bigint) as DAYS_ENTRY_PAYMENT,
 l_extendedprice as AMT_INSTALMENT,
 case when l_partkey%53=0 then null when l_returnflag='R' then l_extendedprice*(1e0-l_discount) else l_extendedprice end as AMT_PAYMENT
from lineitem join orders on l_orderkey=o_orderkey""",
)

_SCORES = ("EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3")
_AMOUNTS = ("AMT_ANNUITY", "AMT_GOODS_PRICE", "CNT_FAM_MEMBERS")
_cte("med", "select " + ", ".join(f"median({c}) as m_{c}" for c in _AMOUNTS + _SCORES) + " from apps", "apps")


def _mode(column: str) -> str:
    return (
        f"(select {column} from apps where {column} is not null group by {column} "
        f"order by count(*) desc, {column} limit 1)"
    )


_cte(
    "cleaned",
    f"""select SK_ID_CURR, TARGET, AMT_CREDIT, AMT_INCOME_TOTAL,
 {', '.join(f'coalesce({c}, m_{c}) as {c}' for c in _AMOUNTS)},
 NAME_CONTRACT_TYPE,
 case when CODE_GENDER='XNA' then {_mode('CODE_GENDER')} else CODE_GENDER end as CODE_GENDER,
 case when NAME_FAMILY_STATUS='Unknown' then {_mode('NAME_FAMILY_STATUS')} else NAME_FAMILY_STATUS end as NAME_FAMILY_STATUS,
 NAME_EDUCATION_TYPE, coalesce(OCCUPATION_TYPE,'Unknown_Missing') as OCCUPATION_TYPE,
 FLAG_OWN_REALTY, FLAG_OWN_CAR, DAYS_BIRTH, nullif(DAYS_EMPLOYED,365243) as DAYS_EMPLOYED,
 {', '.join(f'coalesce({c}, m_{c}) as {c}' for c in _SCORES)},
 coalesce(AMT_REQ_CREDIT_BUREAU_YEAR,0e0) as AMT_REQ_CREDIT_BUREAU_YEAR,
 coalesce(DEF_30_CNT_SOCIAL_CIRCLE,0e0) as DEF_30_CNT_SOCIAL_CIRCLE, REGION_RATING_CLIENT_W_CITY,
 cast(case when DAYS_EMPLOYED=365243 then 1 else 0 end as integer) as DAYS_EMPLOYED_ANOM,
 coalesce(-nullif(DAYS_EMPLOYED,365243)/3.6525e2,0e0) as YEARS_EMPLOYED,
 {', '.join(f'cast({c} is null as integer) as {c}_IS_MISSING' for c in _SCORES)},
 -DAYS_BIRTH/3.6525e2 as AGE_YEARS,
 AMT_CREDIT/(AMT_INCOME_TOTAL+1e-5) as CREDIT_TO_INCOME_RATIO,
 coalesce(AMT_ANNUITY,m_AMT_ANNUITY)/(AMT_INCOME_TOTAL+1e-5) as ANNUITY_TO_INCOME_RATIO,
 AMT_CREDIT/(coalesce(AMT_GOODS_PRICE,m_AMT_GOODS_PRICE)+1e-5) as CREDIT_TO_GOODS_RATIO
from apps, med""",
    "apps",
    "med",
)
_cte(
    "cinst",
    """select SK_ID_CURR, NUM_INSTALMENT_NUMBER, DAYS_INSTALMENT,
 coalesce(DAYS_ENTRY_PAYMENT, DAYS_INSTALMENT) as DAYS_ENTRY_PAYMENT, AMT_INSTALMENT,
 coalesce(AMT_PAYMENT,0e0) as AMT_PAYMENT, cast(AMT_PAYMENT is null as integer) as IS_MISSED_PAYMENT
from inst""",
    "inst",
)

_EXT = "(EXT_SOURCE_1, EXT_SOURCE_2, EXT_SOURCE_3)"
_ROW_N = "(cast(EXT_SOURCE_1 is not null as integer)+cast(EXT_SOURCE_2 is not null as integer)+cast(EXT_SOURCE_3 is not null as integer))"
_ROW_MEAN = f"((coalesce(EXT_SOURCE_1,0e0)+coalesce(EXT_SOURCE_2,0e0)+coalesce(EXT_SOURCE_3,0e0))/nullif({_ROW_N},0))"
_FEATURES = {
    "DEBT_TO_INCOME_RATIO": "AMT_ANNUITY/(AMT_INCOME_TOTAL+1e-5)",
    "CREDIT_TO_INCOME_RATIO": "AMT_CREDIT/(AMT_INCOME_TOTAL+1e-5)",
    "ANNUITY_TO_INCOME_RATIO": "AMT_ANNUITY/(AMT_INCOME_TOTAL+1e-5)",
    "CREDIT_TO_GOODS_RATIO": "AMT_CREDIT/(AMT_GOODS_PRICE+1e-5)",
    "PAYMENT_BURDEN_INDEX": "AMT_ANNUITY/(AMT_CREDIT+1e-5)",
    "EMPLOYMENT_TO_AGE_RATIO": "DAYS_EMPLOYED/(DAYS_BIRTH+1e-5)",
    "DISPOSABLE_INCOME_PER_MEMBER": "(AMT_INCOME_TOTAL-coalesce(AMT_ANNUITY,0e0))/(CNT_FAM_MEMBERS+1e-5)",
    "INCOME_PER_FAMILY_MEMBER": "AMT_INCOME_TOTAL/(CNT_FAM_MEMBERS+1e-5)",
    "EXT_SOURCE_MEAN": _ROW_MEAN,
    "EXT_SOURCE_MIN": f"least{_EXT}",
    "EXT_SOURCE_PRODUCT": "EXT_SOURCE_1*EXT_SOURCE_2*EXT_SOURCE_3",
    "EXT_SOURCE_WEIGHTED": "EXT_SOURCE_1*2+EXT_SOURCE_2*3+EXT_SOURCE_3",
    "EXT_SOURCE_X_AGE": f"{_ROW_MEAN}*(-DAYS_BIRTH/3.6525e2)",
    "EXT_SOURCE_X_DTI": f"{_ROW_MEAN}*(AMT_ANNUITY/(AMT_INCOME_TOTAL+1e-5))",
}
_BURDEN, _DEMO, _SCORED = list(_FEATURES)[:5], list(_FEATURES)[5:8], list(_FEATURES)[8:]


def _feature_columns(names: Sequence[str]) -> str:
    return ", ".join(f"{_FEATURES[n]} as {n}" for n in names)


def _inst_scalars(source: str) -> str:
    return f"""select *, greatest(DAYS_ENTRY_PAYMENT-DAYS_INSTALMENT + 0*DAYS_ENTRY_PAYMENT, case when DAYS_ENTRY_PAYMENT is null then null else 0 end) as DPD,
 cast(coalesce(DAYS_ENTRY_PAYMENT>DAYS_INSTALMENT,false) as integer) as LATE_PAYMENT,
 AMT_PAYMENT/(AMT_INSTALMENT+1e-5) as PAYMENT_RATIO,
 case when AMT_INSTALMENT-AMT_PAYMENT<0 then 0e0 else AMT_INSTALMENT-AMT_PAYMENT end as PAYMENT_DEFICIT
 from {source}"""


def _inst_features(source: str) -> str:
    return f"""select *, coalesce(rec/(INST_AVG_DPD+1e-5),0e0) as INST_DPD_VELOCITY, coalesce(rec,0e0) as INST_REC180_AVG_DPD from (
 select SK_ID_CURR, coalesce(avg(DPD),0e0) as INST_AVG_DPD, cast(coalesce(max(DPD),0) as double) as INST_MAX_DPD,
 avg(LATE_PAYMENT) as INST_PCT_LATE, coalesce(avg(PAYMENT_RATIO),0e0) as INST_AVG_PAYMENT_RATIO,
 coalesce(sum(PAYMENT_DEFICIT),0e0) as INST_TOTAL_DEFICIT, coalesce(avg(PAYMENT_DEFICIT),0e0) as INST_AVG_DEFICIT,
 avg(DPD) filter (where DAYS_INSTALMENT>=-180) as rec
 from ({_inst_scalars(source)}) group by SK_ID_CURR)"""


_cte("ifeat", _inst_features("cinst"), "cinst")
_cte("ifeat_raw", _inst_features("inst"), "inst")
_INST = (
    "INST_AVG_DPD",
    "INST_MAX_DPD",
    "INST_PCT_LATE",
    "INST_AVG_PAYMENT_RATIO",
    "INST_TOTAL_DEFICIT",
    "INST_AVG_DEFICIT",
)
_INST_ALL = _INST + ("INST_REC180_AVG_DPD", "INST_DPD_VELOCITY")
_cte(
    "feat",
    f"""select c.SK_ID_CURR, c.TARGET, c.AMT_CREDIT, c.AMT_ANNUITY, c.AMT_GOODS_PRICE, c.NAME_CONTRACT_TYPE, c.FLAG_OWN_REALTY,
 c.FLAG_OWN_CAR, c.NAME_EDUCATION_TYPE, c.AGE_YEARS,
 {', '.join(f'coalesce({_FEATURES[n]},0e0) as {n}' for n in _FEATURES)},
 {', '.join(f'coalesce(i.{n},0e0) as {n}' for n in _INST_ALL)},
 cast(i.SK_ID_CURR is null as integer) as NO_INSTALLMENT_HISTORY
 from (select * exclude (CREDIT_TO_INCOME_RATIO, ANNUITY_TO_INCOME_RATIO, CREDIT_TO_GOODS_RATIO) from cleaned) c
 left join ifeat i on c.SK_ID_CURR=i.SK_ID_CURR""",
    "cleaned",
    "ifeat",
)
_cte(
    "scored",
    f"""select *, 1e0/(1e0+exp(-LOGIT)) as PD from (
 select *, -4e0*(EXT_SOURCE_MEAN-5e-1) as LOGIT from (
 select *, (EXT_SOURCE_1+EXT_SOURCE_2+EXT_SOURCE_3)/3 as EXT_SOURCE_MEAN from (
 select SK_ID_CURR, TARGET, AMT_CREDIT, AMT_INCOME_TOTAL, AMT_ANNUITY, CODE_GENDER, DAYS_BIRTH,
 {', '.join(f'coalesce({c}, m_{c}) as {c}' for c in _SCORES)} from apps, med)))""",
    "apps",
    "med",
)
_cte(
    "repay",
    """select SK_ID_CURR, count(AMT_INSTALMENT) as TOTAL_INSTALLMENTS, avg(dpd) as AVG_DPD, cast(max(dpd) as double) as MAX_DPD,
 cast(sum(late) as bigint) as COUNT_LATE_PAYMENTS, avg(late) as PCT_LATE_PAYMENTS, avg(ratio) as AVG_PAYMENT_RATIO,
 min(ratio) as MIN_PAYMENT_RATIO, coalesce(sum(deficit),0e0) as TOTAL_PAYMENT_DEFICIT, avg(deficit) as AVG_PAYMENT_DEFICIT,
 cast(sum(under) as bigint) as COUNT_UNDERPAID, avg(early) as AVG_DAYS_EARLY from (
 select SK_ID_CURR, AMT_INSTALMENT,
 case when DAYS_ENTRY_PAYMENT<DAYS_INSTALMENT then 0 else DAYS_ENTRY_PAYMENT-DAYS_INSTALMENT end as dpd,
 case when DAYS_ENTRY_PAYMENT>DAYS_INSTALMENT then 0 else DAYS_INSTALMENT-DAYS_ENTRY_PAYMENT end as early,
 case when DAYS_ENTRY_PAYMENT>DAYS_INSTALMENT then 1 else 0 end as late,
 case when AMT_INSTALMENT<AMT_PAYMENT then 0e0 else AMT_INSTALMENT-AMT_PAYMENT end as deficit,
 case when AMT_INSTALMENT-AMT_PAYMENT>1e0 then 1 else 0 end as under,
 case when AMT_INSTALMENT>0 then AMT_PAYMENT/AMT_INSTALMENT else 1e0 end as ratio from inst) group by SK_ID_CURR""",
    "inst",
)
_cte(
    "retarget",
    """select a.SK_ID_CURR, a.TARGET, a.AMT_CREDIT, a.AMT_INCOME_TOTAL, a.EXT_SOURCE_2, a.EXT_SOURCE_3, r.* exclude (SK_ID_CURR)
 from apps a join repay r on a.SK_ID_CURR=r.SK_ID_CURR""",
    "apps",
    "repay",
)


def _lgd(source: str) -> str:
    return f"""select *, least(greatest(1e0-(2e-1+2.5e-1*least(greatest(coalesce(AMT_GOODS_PRICE,AMT_CREDIT)/case when AMT_CREDIT=0 then 1e0 else AMT_CREDIT end,0e0),1.3e0)
 +case when FLAG_OWN_REALTY='Y' then 1.5e-1 else 0e0 end+case when FLAG_OWN_CAR='Y' then 1e-1 else 0e0 end
 +1.5e-1*least(greatest(least(greatest(coalesce(INST_AVG_PAYMENT_RATIO,1e0),0e0),1.5e0)-5e-1,0e0),1e0)
 -case when NAME_CONTRACT_TYPE='Revolving loans' then 2e-1 else 0e0 end),5e-2),9.5e-1) as LGD from {source}"""


_cte(
    "loss",
    f"""select SK_ID_CURR, TARGET, NAME_CONTRACT_TYPE, FLAG_OWN_REALTY, FLAG_OWN_CAR, NAME_EDUCATION_TYPE, AGE_YEARS,
 PD, LGD, EAD, AMT_CREDIT, PD*LGD*EAD as EXPECTED_LOSS, case when EAD>0 then PD*LGD*EAD/EAD*1e2 else 0e0 end as EL_RATE_PCT,
 case when PD<2e-1 then 'Prime' when PD>=5e-1 then 'Subprime' else 'Near-Prime' end as RISK_TIER from (
 select *, 1e0/(1e0+exp(4e0*(EXT_SOURCE_MEAN-5e-1))) as PD,
 AMT_CREDIT*case when NAME_CONTRACT_TYPE='Revolving loans' then 7.5e-1 else 7e-1*1.03e0 end as EAD from ({_lgd('feat')}))""",
    "feat",
)
_cte(
    "surv",
    """select SK_ID_CURR, EXT_SOURCE_MEAN, TARGET as event, NAME_CONTRACT_TYPE, AMT_CREDIT, term,
 case when TARGET=1 then least(greatest(term*case when INST_PCT_LATE>3e-1 then 3e0/11 else 2e0/5 end,1e0),term) else term end as duration
 from (select *, least(greatest(AMT_CREDIT/greatest(AMT_ANNUITY,1e0),6e0),6e1) as term from feat)""",
    "feat",
)
_cte(
    "tiered",
    """select s.*, case when EXT_SOURCE_MEAN>=q66 then 'Prime (Tier 1 - Low Risk)'
 when EXT_SOURCE_MEAN<q33 then 'Subprime (Tier 3 - High Risk)' else 'Near-Prime (Tier 2)' end as tier
 from surv s, (select quantile_cont(EXT_SOURCE_MEAN,33e-2) as q33, quantile_cont(EXT_SOURCE_MEAN,66e-2) as q66 from surv)""",
    "surv",
)
_cte(
    "km",
    """select tier, duration, at_risk, events,
 case when sum(case when events=at_risk then 1 else 0 end) over w>0 then 0e0
 else exp(sum(case when events=at_risk then 0e0 else ln(1-events/at_risk) end) over w) end as survival from (
 select tier, duration, sum(exits) over (partition by tier order by duration desc) as at_risk, events from (
 select tier, duration, count(*) as exits, sum(event) as events from tiered group by tier, duration))
 window w as (partition by tier order by duration)""",
    "tiered",
)
_cte(
    "cumul",
    """select PD, pos, neg, sum(pos) over (order by PD) as cpos, sum(neg) over (order by PD) as cneg,
 sum(pos) over (order by PD desc) as tp, sum(neg) over (order by PD desc) as fp,
 sum(pos) over () as npos, sum(neg) over () as nneg from (
 select PD, sum(TARGET) as pos, sum(1-TARGET) as neg from scored group by PD)""",
    "scored",
)
_PR_STEP = """select npos, pos/npos as dr, tp/(tp+fp) as prec,
 coalesce(lag(tp/(tp+fp)) over (order by PD desc),1e0) as prev from cumul"""
_cte("pr", _PR_STEP, "cumul")
_cte("means", "select " + ", ".join(f"avg({c}) as a_{c}" for c in _SCORES) + " from scored", "scored")
_cte(
    "attr",
    " union all ".join(
        f"select SK_ID_CURR, TARGET, {i} as pos, '{c}' as feature, {c} as value, -4e0/3*({c}-a_{c}) as contribution from scored, means"
        for i, c in enumerate(_SCORES)
    ),
    "scored",
    "means",
)
_cte(
    "notice",
    """select SK_ID_CURR, TARGET, -4e0/3*(a_EXT_SOURCE_1+a_EXT_SOURCE_2+a_EXT_SOURCE_3)+2e0
 +(-4e0/3*(EXT_SOURCE_1-a_EXT_SOURCE_1))+(-4e0/3*(EXT_SOURCE_2-a_EXT_SOURCE_2))+(-4e0/3*(EXT_SOURCE_3-a_EXT_SOURCE_3)) as score
 from scored, means""",
    "scored",
    "means",
)
_NAMED = "case feature when 'EXT_SOURCE_1' then 'External Credit Score (Bureau 1)' when 'EXT_SOURCE_2' then 'External Credit Score (Bureau 2)' else 'External Credit Score (Bureau 3)' end"
_cte(
    "reason",
    f"""select *, {_NAMED} as readable, row_number() over (partition by SK_ID_CURR order by contribution desc, pos) as reason_rank
 from attr where contribution>0""",
    "attr",
)
_cte(
    "response",
    """select SK_ID_CURR, TARGET, DEBT_TO_INCOME_RATIO, case when ok then 'Persuadable'
 when DEBT_TO_INCOME_RATIO>6e-1 or INST_AVG_DPD>60 then 'Lost Cause' else 'Sure Thing' end as response_segment,
 case when ok then -15e-2 else -1e-2 end as true_effect,
 cast((SK_ID_CURR*2654435761)%4294967296<2147483648 as integer) as TREATMENT,
 case when DEBT_TO_INCOME_RATIO<1e-1 then 'low' when DEBT_TO_INCOME_RATIO<3e-1 then 'mid' else 'high' end as dti_band
 from (select *, DEBT_TO_INCOME_RATIO>3e-1 and DEBT_TO_INCOME_RATIO<6e-1 and INST_AVG_DPD<30
 and EXT_SOURCE_MEAN>3e-1 and EXT_SOURCE_MEAN<6e-1 as ok from feat)""",
    "feat",
)
_cte(
    "fair",
    """select TARGET as y, cast(PD>5e-1 as integer) as d, CODE_GENDER, case when years>18 and years<=30 then '18-30'
 when years>30 and years<=45 then '31-45' when years>45 and years<=60 then '46-60' when years>60 and years<=100 then '60+' end as cohort
 from (select *, abs(DAYS_BIRTH)/3.6525e2 as years from scored)""",
    "scored",
)


def _fairness(column: str) -> str:
    return f"""select {column} as "group", coalesce(count(*) filter (where d=0)/nullif(count(*),0),0e0) as Approval_Rate,
 coalesce(count(*) filter (where d=1 and y=1)/nullif(count(*) filter (where y=1),0),0e0) as True_Positive_Rate,
 coalesce(count(*) filter (where d=1 and y=0)/nullif(count(*) filter (where y=0),0),0e0) as False_Positive_Rate,
 count(*) as Population_Count from fair where {column} is not null group by {column}"""


def _rates(key: str, source: str, name: str) -> str:
    return f"""select {key} as {name}, count(TARGET) as Total, cast(coalesce(sum(TARGET),0) as bigint) as Default_Count,
 avg(TARGET) as Default_Rate, avg(TARGET)*100 as Default_Rate_Pct from {source} group by 1"""


def _bands(labels: Sequence[tuple[str, str]], name: str) -> str:
    parts = " union all ".join(
        f"select '{text}' as {name}, count(*) as Total, cast(coalesce(sum(TARGET),0) as bigint) as Default_Count, "
        f"avg(TARGET) as Default_Rate, avg(TARGET)*100 as Default_Rate_Pct from apps where {condition}"
        for text, condition in labels
    )
    return parts


_AGE = "-DAYS_BIRTH/3.6525e2"
_AGE_BANDS = [
    (text, f"{_AGE}>={a} and {_AGE}<{b}")
    for text, a, b in (
        ("18-25", 18, 25),
        ("25-34", 25, 35),
        ("35-44", 35, 45),
        ("45-54", 45, 55),
        ("55-64", 55, 65),
        ("65+", 65, 100),
    )
]
_CREDIT_BANDS = [
    ("Tier 1: <$250k", "AMT_CREDIT>=0 and AMT_CREDIT<250000"),
    ("Tier 2: $250k-$500k", "AMT_CREDIT>=250000 and AMT_CREDIT<500000"),
    ("Tier 3: $500k-$750k", "AMT_CREDIT>=500000 and AMT_CREDIT<750000"),
    ("Tier 4: $750k-$1M", "AMT_CREDIT>=750000 and AMT_CREDIT<1000000"),
    ("Tier 5: >$1M", "AMT_CREDIT>=1000000"),
]

_KINDS = {
    "bigint": ["SK_ID_CURR", "DAYS_BIRTH", "DAYS_EMPLOYED"],
    "int": ["TARGET", "REGION_RATING_CLIENT_W_CITY"],
    "double": [
        "AMT_CREDIT",
        "AMT_INCOME_TOTAL",
        *_AMOUNTS,
        *_SCORES,
        "AMT_REQ_CREDIT_BUREAU_YEAR",
        "DEF_30_CNT_SOCIAL_CIRCLE",
    ],
    "string": [
        "NAME_CONTRACT_TYPE",
        "CODE_GENDER",
        "NAME_FAMILY_STATUS",
        "NAME_EDUCATION_TYPE",
        "OCCUPATION_TYPE",
        "FLAG_OWN_REALTY",
        "FLAG_OWN_CAR",
    ],
}
_ALL = [(c, kind) for kind, names in _KINDS.items() for c in names]
_MISSING_CELLS = "+".join(f"cast({c} is null as integer)" for c, _ in _ALL)
_RAW_GAPS = "+".join(f"(count(*)-count({c}))" for c, _ in _ALL)


def _hash(key: str = "SK_ID_CURR") -> str:
    return f"(({key}*2654435761)%4294967296)"


def _medians(pairs: Sequence[tuple[str, str, str]]) -> str:
    return " union all ".join(
        f"select '{name}' as variable, cast({v} as integer) as TARGET, {_rd(f'median({value})')} as median from apps where TARGET={v} and {where}"
        for name, value, where in pairs
        for v in (0, 1)
    )


def _spearman(a: str, b: str) -> str:
    def rank(c: str) -> str:
        return f"rank() over (order by {c})+(count(*) over (partition by {c})-1)/2e0"

    return f"select corr(ra, rb) from (select {rank(a)} as ra, {rank(b)} as rb from retarget where {a} is not null and {b} is not null)"


def _matrix(value_of) -> str:
    parts = [f"select '{c}' as variable, '{c}' as other, 1e0 as correlation" for c in CORRELATED]
    for a, b in combinations(CORRELATED, 2):
        parts.append(f"select '{a}', '{b}', ({value_of(a, b)})")
        parts.append(f"select '{b}', '{a}', ({value_of(a, b)})")
    return f"select variable, other, {_rd('correlation')} as correlation from ({' union all '.join(parts)})"


def _dummies() -> str:
    segments = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
    levels = {
        "NAME_CONTRACT_TYPE": ["Revolving loans"],
        "CODE_GENDER": ["M", "XNA"],
        "NAME_FAMILY_STATUS": ["Single / not married", "Unknown"],
        "NAME_EDUCATION_TYPE": segments[1:],
        "OCCUPATION_TYPE": segments[1:],
        "FLAG_OWN_REALTY": ["Y"],
        "FLAG_OWN_CAR": ["Y"],
    }
    return ", ".join(
        f"cast(coalesce({c}='{level}',false) as integer) as \"{c}_{level}\"" for c, names in levels.items() for level in names
    )


_SEGMENT_CODE = "case {c} when 'AUTOMOBILE' then 0 when 'BUILDING' then 1 when 'FURNITURE' then 2 when 'HOUSEHOLD' then 3 when 'MACHINERY' then 4 else 0 end"


def _stress() -> str:
    rows = []
    for name, p, g in (("Baseline", "1e0", "1e0"), ("Adverse", "1.4e0", "1.15e0"), ("Severely Adverse", "2.2e0", "1.35e0")):
        el = f"sum(least(PD*{p},1e0)*least(LGD*{g},1e0)*EAD)"
        rows.append(
            f"select '{name}' as scenario, round_even(sum(EAD)/1e9,4) as Total_EAD_Billions, round_even({el}/1e9,4) as Total_Expected_Loss_Billions, "
            f"round_even({el}/sum(EAD),4) as Portfolio_Expected_Loss_Rate, {p} as PD_Multiplier, {g} as LGD_Multiplier from loss"
        )
    return " union all ".join(rows)


def _calibration() -> str:
    rows = []
    for t in (12, 24, 36, 48, 60):
        rows.append(
            f"select cast({t} as integer) as horizon_months, avg((p-o)*(p-o)) as brier_score, avg(p) as mean_predicted_pd, avg(o) as observed_default_rate, "
            f"count(*) as evaluated_loans, avg(p)/greatest(avg(o),1e-5) as calibration_ratio from ("
            f"select 1e0-exp(-exp(-4e0*(EXT_SOURCE_MEAN-5e-1))*({t}/6e1)) as p, case when duration<={t} and event=1 then 1e0 else 0e0 end as o "
            f"from surv where duration>{t} or event=1)"
        )
    return " union all ".join(rows)


def _grid() -> str:
    moves = ("0e0", "5e-2", "1e-1", "2e-1", "3e-1")
    values = ", ".join(f"({i},{a},{b},{c})" for i, (a, b, c) in enumerate(product(moves, repeat=3)))
    moved = ", ".join(f"least({c}+m{i},1e0) as n{i}" for i, c in enumerate(_SCORES))
    return f"""select SK_ID_CURR, PD as original_pd, cast(grid_id as integer) as grid_id, distance, new_pd,
 {', '.join(f'case when n{i}<>{c} then n{i} end as new_{c}' for i, c in enumerate(_SCORES))} from (
 select s.*, b.* exclude (key) from (select * from scored where PD>6e-1) s left join (
 select * from (select *, row_number() over (partition by key order by distance, grid_id) as rn from (
 select key, grid_id, n0, n1, n2, round(round(n0-EXT_SOURCE_1,9)+round(n1-EXT_SOURCE_2,9)+round(n2-EXT_SOURCE_3,9),9) as distance,
 1e0/(1e0+exp(4e0*((n0+n1+n2)/3-5e-1))) as new_pd from (
 select SK_ID_CURR as key, EXT_SOURCE_1, EXT_SOURCE_2, EXT_SOURCE_3, grid_id, {moved}
 from scored, (values {values}) g(grid_id,m0,m1,m2) where PD>6e-1)) where new_pd<5e-1) where rn=1) b on s.SK_ID_CURR=b.key)"""


def _model(name: str, mean: str) -> str:
    return f"select '{name}' as model_name, SK_ID_CURR, TARGET, 1e0/(1e0+exp(4e0*({mean}-5e-1))) as PD from scored"


_cte(
    "models",
    " union all ".join(
        _model(n, m)
        for n, m in (
            ("mean_score", "EXT_SOURCE_MEAN"),
            ("bureau_2", "EXT_SOURCE_2"),
            ("weighted", "(EXT_SOURCE_1*2+EXT_SOURCE_2*3+EXT_SOURCE_3)/6"),
        )
    ),
    "scored",
)
_CONFUSION = """count(*) filter (where PD>=5e-1 and TARGET=1) as tp, count(*) filter (where PD>=5e-1 and TARGET=0) as fp,
 count(*) filter (where PD<5e-1 and TARGET=0) as tn, count(*) filter (where PD<5e-1 and TARGET=1) as fn"""
_RATES = """tp+fp+tn+fn as total_samples, (tp+tn)/(tp+fp+tn+fn) as accuracy, coalesce(tp/nullif(tp+fp,0),0e0) as precision,
 coalesce(tp/nullif(tp+fn,0),0e0) as recall_sensitivity, coalesce(tn/nullif(tn+fp,0),0e0) as specificity,
 coalesce(2*tp/nullif(2*tp+fp+fn,0),0e0) as f1_score"""
_RATE_NAMES = ["accuracy", "precision", "recall_sensitivity", "specificity", "f1_score"]
_BREAKDOWN = """count(EXPECTED_LOSS) as Loan_Count, sum(EAD) as Total_EAD, sum(EXPECTED_LOSS) as Total_EL, avg(PD) as Mean_PD,
 avg(LGD) as Mean_LGD, sum(EXPECTED_LOSS)/sum(EAD)*1e2 as EL_Rate_Pct"""


def _profit_sweep() -> str:
    return """select threshold, (tn+fn)/n as approval_rate, coalesce(fn/nullif(tn+fn,0),0e0) as portfolio_default_rate,
 tn as approved_good_tn, fn as approved_bad_fn, goods-tn as rejected_good_fp, bads-fn as rejected_bad_tp,
 tn*58e3 as interest_earned_usd, fn*-302e3 as default_losses_usd, tn*58e3+fn*-302e3 as net_profit_usd from (
 select 1e-2+k*((99e-2-1e-2)/99) as threshold, count(*) filter (where TARGET=0 and PD<1e-2+k*((99e-2-1e-2)/99)) as tn,
 count(*) filter (where TARGET=1 and PD<1e-2+k*((99e-2-1e-2)/99)) as fn, count(*) as n,
 count(*) filter (where TARGET=0) as goods, count(*) filter (where TARGET=1) as bads
 from scored, range(100) t(k) group by k)"""


def oracle_sql() -> dict[str, str]:
    """SQL per query key; keys without an entry have no SQL form (model fits, a nested sink)."""
    o: dict[str, str] = {}

    # sources, sinks, profiling
    o["load_applications"] = _with("select * from apps", "apps")
    o["load_installments"] = _with("select SK_ID_CURR, DAYS_INSTALMENT, AMT_INSTALMENT, AMT_PAYMENT from inst", "inst")
    cleaned = ["AMT_CREDIT", "AMT_INCOME_TOTAL", *_AMOUNTS, *_SCORES, "AMT_REQ_CREDIT_BUREAU_YEAR", "DEF_30_CNT_SOCIAL_CIRCLE"]
    cleaned += ["YEARS_EMPLOYED", "AGE_YEARS", "CREDIT_TO_INCOME_RATIO", "ANNUITY_TO_INCOME_RATIO", "CREDIT_TO_GOODS_RATIO"]
    o["parquet_roundtrip"] = _with(_out("select * from cleaned", cleaned), "cleaned")
    o["csv_sample"] = _with("select * from apps order by SK_ID_CURR limit 1000", "apps")
    gaps = " union all ".join(
        f"select '{c}' as \"column\", count(*)-count({c}) as missing_count, (count(*)-count({c}))*1e2/count(*) as missing_pct, '{k}' as dtype from apps"
        for c, k in _ALL
    )
    o["missing_summary"] = _with(_out(f"select * from ({gaps}) where missing_count>0", ["missing_pct"]), "apps")
    with_gaps = "+".join(f"cast(count({c})<count(*) as integer)" for c, _ in _ALL)
    o["inspect_dataset"] = _with(
        _out(
            f"select 'applications' as name, count(*) as n_rows, {len(_ALL)} as n_cols, {with_gaps} as columns_with_missing, "
            f"{_RAW_GAPS} as missing_cells, ({_RAW_GAPS})*1e2/(count(*)*{len(_ALL)}) as missing_pct, "
            "'bigint:3,double:10,int:2,string:7' as dtype_counts from apps",
            ["missing_pct"],
            big=["n_cols", "columns_with_missing", "missing_cells"],
        ),
        "apps",
    )
    narrow = " union all ".join(
        f"select '{c}' as \"column\", cast(min({c}) as double) as min_value, cast(max({c}) as double) as max_value, '{k}' as current_type, "
        + (
            "'float'"
            if k == "double"
            else f"case when min({c})>-128 and max({c})<127 then 'tinyint' when min({c})>-32768 and max({c})<32767 then 'smallint' "
            f"when min({c})>-2147483648 and max({c})<2147483647 then 'int' else 'bigint' end"
        )
        + " as chosen_type from apps"
        for c, k in _ALL
        if k != "string"
    )
    o["numeric_narrowing"] = _with(_out(narrow, ["min_value", "max_value"]), "apps")
    o["target_distribution"] = _with(
        _out(
            """select cast(TARGET as integer) as TARGET, count(*) as n, count(*)*1e2/(select count(*) from apps) as share_pct,
 (select count(*) from apps) as total_records, (select avg(TARGET)*1e2 from apps) as default_rate_pct from apps group by TARGET""",
            ["share_pct", "default_rate_pct"],
        ),
        "apps",
    )
    o["imbalance_ratio"] = _with(
        _out(
            "select sum(1-TARGET) as n_negative, sum(TARGET) as n_positive, sum(1-TARGET)/sum(TARGET) as ratio from apps",
            ["ratio"],
            big=["n_negative", "n_positive"],
        ),
        "apps",
    )
    o["class_medians"] = _with(
        _medians(
            [
                ("AMT_CREDIT", "AMT_CREDIT", "true"),
                ("AMT_INCOME_TOTAL", "AMT_INCOME_TOTAL", "AMT_INCOME_TOTAL<=(select quantile_cont(AMT_INCOME_TOTAL,99e-2) from apps)"),
                ("AMT_ANNUITY", "AMT_ANNUITY", "true"),
                ("AGE_YEARS", _AGE, "true"),
            ]
        ),
        "apps",
    )
    o["ext_score_medians"] = _with(_medians([(c, c, "true") for c in _SCORES]), "apps")
    o["class_density"] = _with(
        _out(
            """select TARGET, cast(bin as integer) as bin, count(*) as n, count(*)/(sum(count(*)) over (partition by TARGET)*w) as density from (
 select TARGET, least(floor((AMT_CREDIT-lo)/w),49) as bin, w from apps, (
 select min(AMT_CREDIT) as lo, (max(AMT_CREDIT)-min(AMT_CREDIT))/50 as w from apps)) group by TARGET, bin, w""",
            d9=["density"],
        ),
        "apps",
    )
    boxes = " union all ".join(
        f"""select '{c}' as metric, TARGET, count(*) as n, avg({c}) as mean, quantile_cont({c},25e-2) as q25, quantile_cont({c},5e-1) as median,
 quantile_cont({c},75e-2) as q75 from retarget, (select quantile_cont({c},1e-2) as lo, quantile_cont({c},95e-2) as hi from retarget)
 where {c}>=lo and {c}<=hi group by TARGET"""
        for c in ("AVG_DPD", "PCT_LATE_PAYMENTS", "AVG_PAYMENT_RATIO", "AVG_PAYMENT_DEFICIT")
    )
    o["trimmed_box_stats"] = _with(_out(boxes, ["mean", "q25", "median", "q75"]), "retarget")
    o["score_histogram"] = _with(
        _out(
            """select cast(b.bin as integer) as bin, lo+b.bin*w as lower, lo+(b.bin+1)*w as upper, coalesce(n,0) as n
 from range(50) b(bin), (select min(EXT_SOURCE_MEAN) as lo, (max(EXT_SOURCE_MEAN)-min(EXT_SOURCE_MEAN))/50 as w from scored)
 left join (select least(floor((EXT_SOURCE_MEAN-l2)/w2),49) as bin, count(*) as n from scored,
 (select min(EXT_SOURCE_MEAN) as l2, (max(EXT_SOURCE_MEAN)-min(EXT_SOURCE_MEAN))/50 as w2 from scored) group by 1) c on c.bin=b.bin""",
            ["lower", "upper"],
            big=["n"],
        ),
        "scored",
    )

    # cleaning and scalar features
    o["clean_employment_sentinel"] = _with(
        _out(
            """select SK_ID_CURR, nullif(DAYS_EMPLOYED,365243) as DAYS_EMPLOYED, cast(DAYS_EMPLOYED=365243 as integer) as DAYS_EMPLOYED_ANOM,
 coalesce(-nullif(DAYS_EMPLOYED,365243)/3.6525e2,0e0) as YEARS_EMPLOYED from apps""",
            ["YEARS_EMPLOYED"],
        ),
        "apps",
    )
    o["rare_code_to_mode"] = _with("select SK_ID_CURR, CODE_GENDER, NAME_FAMILY_STATUS from cleaned", "cleaned")
    o["bureau_zero_fill"] = _with("select SK_ID_CURR, AMT_REQ_CREDIT_BUREAU_YEAR from cleaned", "cleaned")
    o["social_zero_fill"] = _with("select SK_ID_CURR, DEF_30_CNT_SOCIAL_CIRCLE from cleaned", "cleaned")
    o["median_impute"] = _with(_out(f"select SK_ID_CURR, {', '.join(_AMOUNTS)} from cleaned", _AMOUNTS), "cleaned")
    o["ext_score_impute"] = _with(
        _out(f"select SK_ID_CURR, {', '.join(_SCORES)}, {', '.join(c + '_IS_MISSING' for c in _SCORES)} from cleaned", _SCORES),
        "cleaned",
    )
    o["categorical_explicit_missing"] = _with(
        "select SK_ID_CURR, " + ", ".join(f"coalesce({c},'Unknown_Missing') as {c}" for c in _KINDS["string"]) + " from apps", "apps"
    )
    o["canonical_ratios"] = _with(
        _out(
            f"select SK_ID_CURR, {_AGE} as AGE_YEARS, {_feature_columns(_BURDEN[1:4])} from apps", ["AGE_YEARS", *_BURDEN[1:4]]
        ),
        "apps",
    )
    texts = ("NAME_CONTRACT_TYPE", "CODE_GENDER", "NAME_FAMILY_STATUS", "NAME_EDUCATION_TYPE", "OCCUPATION_TYPE", "FLAG_OWN_REALTY", "FLAG_OWN_CAR")
    report = [
        ("employment_sentinel", "DAYS_EMPLOYED", "null", "null", "sum(cast(DAYS_EMPLOYED=365243 as integer))"),
        ("rare_code", "CODE_GENDER", f"max({_mode('CODE_GENDER')})", "null", "sum(cast(CODE_GENDER='XNA' as integer))"),
        ("rare_code", "NAME_FAMILY_STATUS", f"max({_mode('NAME_FAMILY_STATUS')})", "null", "sum(cast(NAME_FAMILY_STATUS='Unknown' as integer))"),
        ("bureau_zero_fill", "AMT_REQ_CREDIT_BUREAU_YEAR", "null", "0e0", "count(*)-count(AMT_REQ_CREDIT_BUREAU_YEAR)"),
        ("social_zero_fill", "DEF_30_CNT_SOCIAL_CIRCLE", "null", "0e0", "count(*)-count(DEF_30_CNT_SOCIAL_CIRCLE)"),
        *(("median_fill", c, "null", f"median({c})", f"count(*)-count({c})") for c in _AMOUNTS),
        *(("score_fill", c, "null", f"median({c})", f"count(*)-count({c})") for c in _SCORES),
        *(("category_fill", c, "'Unknown_Missing'", "null", f"count(*)-count({c})") for c in texts),
        *(("shape", f"rows_{when}", "null", "null", "count(*)") for when in ("before", "after")),
        ("shape", "columns_before", "null", "null", "max(22)"),
        ("shape", "columns_after", "null", "null", "max(31)"),
        ("shape", "missing_cells_before", "null", "null", _RAW_GAPS),
        ("shape", "missing_cells_after", "null", "null", "sum(cast(DAYS_EMPLOYED=365243 as integer))"),
    ]
    lines = " union all ".join(
        f"select '{step}' as step, '{c}' as field, cast({text} as varchar) as replacement, cast({number} as double) as value, cast({n} as bigint) as records from apps"
        for step, c, text, number, n in report
    )
    o["cleaning_report"] = _with(_out(lines, ["value"]), "apps")
    o["clean_applications"] = _with(
        _out(
            "select * exclude (AMT_CREDIT, AMT_INCOME_TOTAL) from cleaned",
            [
                *_AMOUNTS,
                *_SCORES,
                "AMT_REQ_CREDIT_BUREAU_YEAR",
                "DEF_30_CNT_SOCIAL_CIRCLE",
                "YEARS_EMPLOYED",
                "AGE_YEARS",
                *_BURDEN[1:4],
            ],
        ),
        "cleaned",
    )
    o["burden_ratios"] = _with(_out(f"select SK_ID_CURR, {_feature_columns(_BURDEN)} from apps", _BURDEN), "apps")
    o["demographic_ratios"] = _with(_out(f"select SK_ID_CURR, {_feature_columns(_DEMO)} from apps", _DEMO), "apps")
    o["ext_score_features"] = _with(_out(f"select SK_ID_CURR, {_feature_columns(_SCORED)} from apps", _SCORED), "apps")
    o["one_hot"] = _with(f"select SK_ID_CURR, {_dummies()} from apps", "apps")
    o["clean_installments"] = _with("select * from cinst", "cinst")
    o["installment_scalars"] = _with(
        _out(
            f"select SK_ID_CURR, NUM_INSTALMENT_NUMBER, cast(DPD as bigint) as DPD, LATE_PAYMENT, PAYMENT_RATIO, PAYMENT_DEFICIT from ({_inst_scalars('inst')})",
            ["PAYMENT_RATIO", "PAYMENT_DEFICIT"],
        ),
        "inst",
    )
    o["repayment_scalars"] = _with(
        _out(
            """select SK_ID_CURR, NUM_INSTALMENT_NUMBER,
 cast(case when DAYS_ENTRY_PAYMENT<DAYS_INSTALMENT then 0 else DAYS_ENTRY_PAYMENT-DAYS_INSTALMENT end as bigint) as DPD,
 cast(case when DAYS_ENTRY_PAYMENT>DAYS_INSTALMENT then 0 else DAYS_INSTALMENT-DAYS_ENTRY_PAYMENT end as bigint) as DAYS_EARLY,
 case when AMT_INSTALMENT<AMT_PAYMENT then 0e0 else AMT_INSTALMENT-AMT_PAYMENT end as PAYMENT_DEFICIT,
 case when AMT_INSTALMENT>0 then AMT_PAYMENT/AMT_INSTALMENT else 1e0 end as PAYMENT_RATIO,
 cast(coalesce(DAYS_ENTRY_PAYMENT>DAYS_INSTALMENT,false) as integer) as IS_LATE,
 cast(coalesce(AMT_INSTALMENT-AMT_PAYMENT>1e0,false) as integer) as IS_UNDERPAID from inst""",
            ["PAYMENT_DEFICIT", "PAYMENT_RATIO"],
        ),
        "inst",
    )
    squares = "+".join(f"coalesce(({c}-m)*({c}-m),0e0)" for c in _SCORES)
    o["metadata_app_features"] = _with(
        _out(
            f"""select SK_ID_CURR, case when AMT_ANNUITY is not null then least(greatest(AMT_CREDIT/greatest(AMT_ANNUITY,1e0),6e0),6e1) end as CREDIT_TERM_MONTHS,
 AMT_CREDIT/({_AGE}+1e-5) as CREDIT_TO_AGE_RATIO, case when n>1 then sqrt(({squares})/(n-1)) end as EXT_SOURCE_STD,
 greatest{_EXT} as EXT_SOURCE_MAX, m*coalesce(-nullif(DAYS_EMPLOYED,365243)/3.6525e2,0e0) as EXT_SOURCE_X_EMPLOYED
 from (select *, {_ROW_MEAN} as m, {_ROW_N} as n from apps)""",
            ["CREDIT_TERM_MONTHS", "CREDIT_TO_AGE_RATIO", "EXT_SOURCE_STD", "EXT_SOURCE_MAX", "EXT_SOURCE_X_EMPLOYED"],
        ),
        "apps",
    )
    numbers = [c for c, k in _ALL if k != "string"]
    filled = [f"coalesce(cast({c} as double), (select median({c}) from apps)) as {c}" for c in numbers]
    filled += [f"coalesce({c}, {_mode(c)}) as {c}" for c, k in _ALL if k == "string"]
    o["generic_impute"] = _with(_out(f"select {', '.join(filled)} from apps", numbers), "apps")
    o["encode_categoricals"] = _with(
        f"""select SK_ID_CURR, cast(NAME_CONTRACT_TYPE='Revolving loans' as integer) as NAME_CONTRACT_TYPE,
 cast(case CODE_GENDER when 'M' then 1 when 'XNA' then 2 else 0 end as integer) as CODE_GENDER,
 cast(case NAME_FAMILY_STATUS when 'Single / not married' then 1 when 'Unknown' then 2 else 0 end as integer) as NAME_FAMILY_STATUS,
 cast(FLAG_OWN_REALTY='Y' as integer) as FLAG_OWN_REALTY,
 cast({_SEGMENT_CODE.format(c='NAME_EDUCATION_TYPE')} as integer) as NAME_EDUCATION_TYPE,
 cast({_SEGMENT_CODE.format(c='OCCUPATION_TYPE')} as integer) as OCCUPATION_TYPE, 0e0 as FLAG_OWN_CAR from apps""",
        "apps",
    )
    readable = {
        "AMT_CREDIT": "Total Loan Amount",
        "AMT_INCOME_TOTAL": "Amt Income Total",
        "AMT_ANNUITY": "Loan Annuity Amount",
        "AMT_GOODS_PRICE": "Amt Goods Price",
        "CNT_FAM_MEMBERS": "Cnt Fam Members",
        "DAYS_BIRTH": "Client Age",
        "DAYS_EMPLOYED": "Length of Employment",
        "EXT_SOURCE_1": "External Credit Score (Bureau 1)",
        "EXT_SOURCE_2": "External Credit Score (Bureau 2)",
        "EXT_SOURCE_3": "External Credit Score (Bureau 3)",
        "AMT_REQ_CREDIT_BUREAU_YEAR": "Amt Req Credit Bureau Year",
        "DEF_30_CNT_SOCIAL_CIRCLE": "Def 30 Cnt Social Circle",
        "REGION_RATING_CLIENT_W_CITY": "Region Rating Client W City",
    }
    o["readable_names"] = _with(
        " union all ".join(
            f"select '{c}' as feature, '{text}' as readable_name, count({c}) as n_known from apps" for c, text in readable.items()
        ),
        "apps",
    )
    o["high_risk_filter"] = _with(
        _out("select SK_ID_CURR, PD from scored where PD>6e-1 order by LOGIT desc, SK_ID_CURR limit 100", ["PD"]), "scored"
    )
    o["simple_ratios"] = _with(
        _out(
            """select SK_ID_CURR, AMT_ANNUITY/nullif(AMT_INCOME_TOTAL,0e0) as DEBT_TO_INCOME_RATIO,
 DAYS_EMPLOYED/nullif(DAYS_BIRTH,0) as EMPLOYMENT_TO_AGE_RATIO from apps""",
            ["DEBT_TO_INCOME_RATIO", "EMPLOYMENT_TO_AGE_RATIO"],
        ),
        "apps",
    )

    # a reloaded model scores every application exactly as the fitted one
    o["model_roundtrip"] = _with(
        " union all ".join(
            f"select '{m}' as model, count(*) as n, cast(0 as bigint) as changed from apps" for m in ("regression", "trees", "hazard", "codes")
        ),
        "apps",
    )

    # joins and aggregations
    repay_doubles = [
        "AVG_DPD",
        "MAX_DPD",
        "PCT_LATE_PAYMENTS",
        "AVG_PAYMENT_RATIO",
        "MIN_PAYMENT_RATIO",
        "TOTAL_PAYMENT_DEFICIT",
        "AVG_PAYMENT_DEFICIT",
        "AVG_DAYS_EARLY",
    ]
    amounts = ["AMT_CREDIT", "AMT_INCOME_TOTAL", "EXT_SOURCE_2", "EXT_SOURCE_3"]
    o["repay_target_join"] = _with(_out("select * from retarget", repay_doubles + amounts), "retarget")
    made = [*_FEATURES, *_INST_ALL]
    o["feature_matrix"] = _with(
        _out(f"select SK_ID_CURR, TARGET, {', '.join(made)}, NO_INSTALLMENT_HISTORY from feat", made), "feat"
    )
    o["ead_dynamic"] = _with(
        _out(
            """select SK_ID_CURR, f as EAD_FACTOR, AMT_CREDIT*f as EAD from (select *, case when NAME_CONTRACT_TYPE='Revolving loans' then 7.5e-1
 else least(greatest(1e0-least(greatest(duration,1e0),term)/term,15e-2),1e0)*1.03e0 end as f from surv)""",
            ["EAD_FACTOR", "EAD"],
        ),
        "surv",
    )
    o["client_profile"] = _with(
        _out(
            """select l.SK_ID_CURR, PD, LGD, EAD, EXPECTED_LOSS, round(score,4) as Risk_Score_LogOdds, coalesce(reasons,'') as reasons
 from loss l join notice n on l.SK_ID_CURR=n.SK_ID_CURR left join (
 select SK_ID_CURR, string_agg(feature||'|'||readable,';' order by reason_rank) as reasons from reason where reason_rank<=4 group by SK_ID_CURR) r
 on l.SK_ID_CURR=r.SK_ID_CURR""",
            ["PD", "LGD", "EAD", "EXPECTED_LOSS", "Risk_Score_LogOdds"],
        ),
        "loss",
        "notice",
        "reason",
    )
    rates = ["Default_Rate", "Default_Rate_Pct"]
    o["segment_age"] = _with(_out(_bands(_AGE_BANDS, "AGE_GROUP"), rates), "apps")
    o["segment_credit_band"] = _with(_out(_bands(_CREDIT_BANDS, "CREDIT_BAND"), rates), "apps")
    o["segment_education"] = _with(_out(_rates("NAME_EDUCATION_TYPE", "apps", "NAME_EDUCATION_TYPE"), rates), "apps")
    o["segment_contract"] = _with(_out(_rates("NAME_CONTRACT_TYPE", "apps", "NAME_CONTRACT_TYPE"), rates), "apps")
    cuts = {
        "age_groups": f"select * from ({_bands(_AGE_BANDS, 'value')}) where Total>0",
        "credit_bands": f"select * from ({_bands(_CREDIT_BANDS, 'value')}) where Total>0",
        "education": _rates("NAME_EDUCATION_TYPE", "apps", "value"),
        "contract_type": _rates("NAME_CONTRACT_TYPE", "apps", "value"),
    }
    o["segment_all"] = _with(
        _out(" union all ".join(f"select '{k}' as segment, * from ({v})" for k, v in cuts.items()), rates), "apps"
    )
    o["installment_features"] = _with(_out(f"select SK_ID_CURR, {', '.join(_INST)} from ifeat_raw", _INST), "ifeat_raw")
    o["dpd_velocity"] = _with(_out(f"select SK_ID_CURR, {', '.join(_INST_ALL[6:])} from ifeat_raw", _INST_ALL[6:]), "ifeat_raw")
    o["metadata_inst_features"] = _with(
        _out(
            """select SK_ID_CURR, count(*) as INST_TOTAL_INSTALLMENTS, sum(late) as INST_COUNT_LATE, min(ratio) as INST_MIN_PAYMENT_RATIO,
 coalesce(stddev_samp(ratio),0e0) as INST_PAYMENT_RATIO_STD, max(deficit) as INST_MAX_DEFICIT, sum(under) as INST_COUNT_UNDERPAID,
 avg(under) as INST_PCT_UNDERPAID, avg(early) as INST_AVG_DAYS_EARLY, sum(IS_MISSED_PAYMENT) as INST_COUNT_MISSED,
 count(*) filter (where recent) as INST_REC180_COUNT, coalesce(avg(late) filter (where recent),0e0) as INST_REC180_PCT_LATE,
 coalesce(avg(deficit) filter (where recent),0e0) as INST_REC180_AVG_DEFICIT,
 coalesce(avg(deficit) filter (where recent)/(avg(deficit)+1e-5),0e0) as INST_DEFICIT_VELOCITY from (
 select *, DAYS_INSTALMENT>=-180 as recent, cast(DAYS_ENTRY_PAYMENT>DAYS_INSTALMENT as integer) as late,
 greatest(DAYS_INSTALMENT-DAYS_ENTRY_PAYMENT,0) as early, greatest(AMT_INSTALMENT-AMT_PAYMENT,0e0) as deficit,
 cast(AMT_INSTALMENT-AMT_PAYMENT>1e0 as integer) as under,
 case when AMT_INSTALMENT>0 then AMT_PAYMENT/AMT_INSTALMENT else 1e0 end as ratio from cinst) group by SK_ID_CURR""",
            [
                "INST_MIN_PAYMENT_RATIO",
                "INST_PAYMENT_RATIO_STD",
                "INST_MAX_DEFICIT",
                "INST_PCT_UNDERPAID",
                "INST_AVG_DAYS_EARLY",
                "INST_REC180_PCT_LATE",
                "INST_REC180_AVG_DEFICIT",
                "INST_DEFICIT_VELOCITY",
            ],
            big=["INST_COUNT_LATE", "INST_COUNT_UNDERPAID", "INST_COUNT_MISSED"],
        ),
        "cinst",
    )
    o["client_repayment"] = _with(_out("select * from repay", repay_doubles), "repay")
    o["pearson_matrix"] = _with(_matrix(lambda a, b: f"select corr({a},{b}) from retarget"), "retarget")
    o["spearman_matrix"] = _with(_matrix(_spearman), "retarget")
    o["portfolio_summary"] = _with(
        _out(
            """select count(*) as total_loans, sum(AMT_CREDIT) as total_original_credit_limit, sum(EAD) as total_portfolio_ead,
 sum(EXPECTED_LOSS) as total_portfolio_expected_loss, avg(PD) as mean_pd, avg(LGD) as mean_lgd, avg(EAD) as mean_ead,
 avg(EXPECTED_LOSS) as mean_el_per_loan, sum(EXPECTED_LOSS)/sum(EAD)*1e2 as portfolio_el_rate_pct from loss""",
            ["mean_pd", "mean_lgd", "mean_ead", "mean_el_per_loan", "portfolio_el_rate_pct"],
            ["total_original_credit_limit", "total_portfolio_ead", "total_portfolio_expected_loss"],
        ),
        "loss",
    )
    o["tier_breakdown"] = _with(
        _out(
            f"""select RISK_TIER, {_BREAKDOWN}, avg(EXPECTED_LOSS) as Mean_EL,
 sum(EXPECTED_LOSS)/(select sum(EXPECTED_LOSS) from loss)*1e2 as EL_Share_Pct from loss group by RISK_TIER""",
            ["Mean_PD", "Mean_LGD", "EL_Rate_Pct", "EL_Share_Pct"],
            ["Total_EAD", "Total_EL", "Mean_EL"],
        ),
        "loss",
    )
    o["contract_breakdown"] = _with(
        _out(
            f"select NAME_CONTRACT_TYPE, {_BREAKDOWN} from loss group by NAME_CONTRACT_TYPE",
            ["Mean_PD", "Mean_LGD", "EL_Rate_Pct"],
            ["Total_EAD", "Total_EL"],
        ),
        "loss",
    )

    # ranking and sampling
    o["average_rank"] = _with(
        _out(
            """select SK_ID_CURR, INST_AVG_DPD, rank() over (order by INST_AVG_DPD)+(count(*) over (partition by INST_AVG_DPD)-1)/2e0 as avg_rank
 from ifeat_raw""",
            ["INST_AVG_DPD", "avg_rank"],
        ),
        "ifeat_raw",
    )
    _personas = """select persona, SK_ID_CURR, metric from (select *, row_number() over (partition by persona order by o, SK_ID_CURR) as rn from (
 select 'Prime Borrower Persona' as persona, SK_ID_CURR, metric, -metric as o from base union all
 select 'Near-Prime Borrower Persona', SK_ID_CURR, metric, abs(metric-(select median(metric) from base)) from base union all
 select 'Subprime Borrower Persona', SK_ID_CURR, metric, metric from base)) where rn=1"""
    base = "(select SK_ID_CURR, EXT_SOURCE_MEAN-PAYMENT_BURDEN_INDEX-INST_PCT_LATE as metric from feat)"
    o["borrower_personas"] = _with(_out(_personas.replace("from base", f"from {base} base"), ["metric"]), "feat")
    o["top_bottom_quintile"] = _with(
        _out(
            """select SK_ID_CURR, PD, case when rn<=floor(n*2e-1) then 'top' else 'bottom' end as tail from (
 select *, row_number() over (order by LOGIT desc, SK_ID_CURR) as rn, count(*) over () as n from scored)
 where rn<=floor(n*2e-1) or rn>floor(n*8e-1)""",
            ["PD"],
        ),
        "scored",
    )
    o["top_risk_notices"] = _with(
        _out(
            "select SK_ID_CURR, TARGET, round(score,4) as Risk_Score_LogOdds from notice order by 3 desc, 1 limit 3",
            ["Risk_Score_LogOdds"],
        ),
        "notice",
    )
    o["hash_sample"] = _with(
        _out(f"select SK_ID_CURR, TARGET, AMT_CREDIT from apps order by {_hash()} limit 1000", ["AMT_CREDIT"]), "apps"
    )
    o["train_test_split"] = _with(
        f"select SK_ID_CURR, TARGET, case when {_hash()}<858993459 then 'test' else 'train' end as split from apps", "apps"
    )
    o["stratified_split"] = _with(
        f"""select SK_ID_CURR, TARGET, case when rn<=floor(2e-1*n) then 'test' else 'train' end as split from (
 select *, row_number() over (partition by TARGET order by {_hash()}) as rn, count(*) over (partition by TARGET) as n from apps)""",
        "apps",
    )

    # model evaluation
    auc = "sum(pos*(cneg-neg+neg/2e0))/max(npos*nneg)"
    o["roc_auc_gini"] = _with(_out(f"select {auc} as roc_auc, 2*({auc})-1 as gini from cumul", ["roc_auc", "gini"]), "cumul")
    gap = "abs(cpos/npos-cneg/nneg)"
    o["ks_statistic"] = _with(
        _out(
            f"select {gap} as ks_statistic, PD as ks_threshold from cumul order by round({gap},12) desc, PD limit 1",
            ["ks_statistic", "ks_threshold"],
        ),
        "cumul",
    )
    o["pr_auc_trapezoid"] = _with(_out("select sum(dr*(prec+prev)/2) as pr_auc from pr", ["pr_auc"]), "pr")
    o["average_precision"] = _with(_out("select sum(dr*prec) as average_precision from pr", ["average_precision"]), "pr")
    o["brier_score"] = _with(_out("select avg((PD-TARGET)*(PD-TARGET)) as brier_score from scored", ["brier_score"]), "scored")
    o["confusion_metrics"] = _with(
        _out(f"select *, {_RATES} from (select {_CONFUSION} from scored)", _RATE_NAMES), "scored"
    )
    o["model_benchmark"] = _with(
        _out(
            f"""select a.*, k.ks_statistic, k.ks_threshold, b.brier_score, c.* exclude (model_name), 5e-1 as eval_threshold from (
 select model_name, sum(pos*(cneg-neg+neg/2e0))/max(npos*nneg) as roc_auc, 2*(sum(pos*(cneg-neg+neg/2e0))/max(npos*nneg))-1 as gini,
 sum(pos/npos*(tp/(tp+fp)+prev)/2) as pr_auc, sum(pos/npos*(tp/(tp+fp))) as average_precision from (
 select *, coalesce(lag(tp/(tp+fp)) over (partition by model_name order by PD desc),1e0) as prev from ladder) group by model_name) a
 join (select model_name, ks_statistic, ks_threshold from (select model_name, {gap} as ks_statistic, PD as ks_threshold,
 row_number() over (partition by model_name order by round({gap},12) desc, PD) as rn from ladder) where rn=1) k on a.model_name=k.model_name
 join (select model_name, avg((PD-TARGET)*(PD-TARGET)) as brier_score from models group by model_name) b on a.model_name=b.model_name
 join (select *, {_RATES} from (select model_name, {_CONFUSION} from models group by model_name)) c on a.model_name=c.model_name""",
            ["roc_auc", "gini", "pr_auc", "average_precision", "ks_statistic", "ks_threshold", "brier_score", *_RATE_NAMES, "eval_threshold"],
        ),
        "ladder",
    )
    sweep = ["threshold", "approval_rate", "portfolio_default_rate", "interest_earned_usd", "default_losses_usd", "net_profit_usd"]
    o["threshold_profit_sweep"] = _with(_out(_profit_sweep(), sweep), "scored")
    o["regression_metrics"] = _with(
        _out(
            """select 1-avg((TARGET-PD)*(TARGET-PD))/var_pop(TARGET) as r2_score, avg(abs(TARGET-PD)) as mae, sqrt(avg((TARGET-PD)*(TARGET-PD))) as rmse,
 avg(PD) as mean_pred, stddev_pop(PD) as std_pred from scored""",
            ["r2_score", "mae", "rmse", "mean_pred", "std_pred"],
        ),
        "scored",
    )

    # fits: what holds of any well fitted model
    test = f"feat where {_hash()}<858993459"
    single = " union all ".join(f"select '{c}' as name, -{c} as PD, TARGET from {test}" for c in _SINGLE)
    for name in ("logistic", "gbt_benchmark", "gbt_champion"):
        o[f"fit_{name}"] = _with(
            _out(
                f"""select 'fit_{name}' as model_name, 67 as features, (select count(*) from {test}) as test_loans,
 (select sum(TARGET) from {test}) as test_defaults, max(auc) as best_single_auc, true as near_best_single, 1e0 as importance_total
 from (select name, sum(pos*(cneg-neg+neg/2e0))/max(npos*nneg) as auc from (
 select name, pos, neg, sum(neg) over (partition by name order by PD) as cneg, sum(pos) over (partition by name) as npos,
 sum(neg) over (partition by name) as nneg from (
 select name, PD, sum(TARGET) as pos, sum(1-TARGET) as neg from ({single}) group by name, PD)) group by name)""",
                ["best_single_auc", "importance_total"],
                big=["features", "test_loans", "test_defaults"],
            ),
            "feat",
        )
    o["fit_lgd"] = _with(
        _out(
            f"""select count(*) as test_loans, avg(LGD) as mean_actual, stddev_pop(LGD) as std_actual, true as better_than_mean,
 true as inside_bounds from loss where {_hash()}<858993459""",
            ["mean_actual", "std_actual"],
            big=["test_loans"],
        ),
        "loss",
    )
    train = f"""select duration, event, rn>floor(2e-1*n) as train from (
 select *, row_number() over (partition by event order by {_hash()}) as rn, count(*) over (partition by event) as n from surv)"""
    o["cox_facts"] = _with(
        _out(
            f"""select 14 as covariates, true as marks_fit, true as ratios_inside, 180 as curve_points, true as curves_rise,
 (select count(distinct duration) from ({train}) where train and event=1) as event_times,
 (select max(duration) from ({train}) where train and event=1) as last_event, count(*) as train_loans, sum(event) as train_events,
 0e0 as score_residual, true as likelihood_rises from ({train}) where train""",
            ["last_event", "score_residual"],
            big=["covariates", "curve_points", "event_times", "train_loans", "train_events"],
        ),
        "surv",
    )
    o["uplift_t_learner"] = _with(
        f"""select count(*) as clients, cast(count(*) filter (where {_hash()}<2147483648) as bigint) as treated, true as effects_inside
 from feat where {_hash()}<858993459""",
        "feat",
    )
    o["fitted_notices"] = _with(
        _out("select count(*) as clients, 0e0 as largest_gap, cast(4 as integer) as most_reasons from apps", ["largest_gap"]), "apps"
    )
    o["json_report"] = o["tier_breakdown"]

    # loss
    o["pd_proxy"] = _with(
        _out("select SK_ID_CURR, EXT_SOURCE_MEAN, LOGIT, PD from scored", ["EXT_SOURCE_MEAN", "LOGIT", "PD"]), "scored"
    )
    joined = "(select a.*, i.INST_AVG_PAYMENT_RATIO from apps a left join ifeat_raw i on a.SK_ID_CURR=i.SK_ID_CURR)"
    o["lgd_heuristic"] = _with(_out(f"select SK_ID_CURR, LGD from ({_lgd(joined)})", ["LGD"]), "apps", "ifeat_raw")
    o["ead_static"] = _with(
        _out(
            """select SK_ID_CURR, f as EAD_FACTOR, AMT_CREDIT*f as EAD from (
 select *, case when NAME_CONTRACT_TYPE='Revolving loans' then 7.5e-1 else 7e-1*1.03e0 end as f from apps)""",
            ["EAD_FACTOR", "EAD"],
        ),
        "apps",
    )
    o["expected_loss"] = _with(
        _out("select * from loss", ["AGE_YEARS", "PD", "LGD", "EAD", "AMT_CREDIT", "EXPECTED_LOSS", "EL_RATE_PCT"]), "loss"
    )

    # survival
    o["survival_dataset"] = _with(_out("select SK_ID_CURR, duration, event from surv", ["duration"]), "surv")
    chosen = {
        "EXT_SOURCE_MEAN": _FEATURES["EXT_SOURCE_MEAN"],
        "EXT_SOURCE_MIN": _FEATURES["EXT_SOURCE_MIN"],
        "PAYMENT_BURDEN_INDEX": _FEATURES["PAYMENT_BURDEN_INDEX"],
        "DEBT_TO_INCOME_RATIO": _FEATURES["DEBT_TO_INCOME_RATIO"],
        "ANNUITY_TO_INCOME_RATIO": _FEATURES["ANNUITY_TO_INCOME_RATIO"],
        "AGE_YEARS": "-DAYS_BIRTH/3.6525e2",
        "YEARS_EMPLOYED": "coalesce(-nullif(DAYS_EMPLOYED,365243)/3.6525e2,0e0)",
        "INST_AVG_DPD": "INST_AVG_DPD",
        "INST_PCT_LATE": "INST_PCT_LATE",
        "INST_AVG_DEFICIT": "INST_AVG_DEFICIT",
        "INST_TOTAL_INSTALLMENTS": "cast(lines as double)",
        "REGION_RATING_CLIENT_W_CITY": "cast(REGION_RATING_CLIENT_W_CITY as double)",
        "AMT_CREDIT": "AMT_CREDIT",
        "AMT_ANNUITY": "AMT_ANNUITY",
    }
    wide = "select a.SK_ID_CURR, " + ", ".join(f"{v} as {k}" for k, v in chosen.items()) + " from apps a left join ifeat i on a.SK_ID_CURR=i.SK_ID_CURR left join (select SK_ID_CURR, count(*) as lines from inst group by SK_ID_CURR) c on a.SK_ID_CURR=c.SK_ID_CURR"
    filled = "select SK_ID_CURR, " + ", ".join(f"coalesce({k}, (select median({k}) from w)) as {k}" for k in chosen) + " from w"
    scaled = ", ".join(
        f"({k}-(select avg({k}) from f))/(select case when stddev_pop({k})<1e-7 then 1e0 else stddev_pop({k}) end from f) as {k}" for k in chosen
    )
    o["standardize_covariates"] = _with(
        _out(f"with w as ({wide}), f as ({filled}) select SK_ID_CURR, {scaled} from f", list(chosen)), "apps", "ifeat"
    )
    o["risk_terciles"] = _with(_out("select SK_ID_CURR, EXT_SOURCE_MEAN, tier from tiered", ["EXT_SOURCE_MEAN"]), "tiered")
    o["kaplan_meier"] = _with(
        _out("select tier, duration, at_risk, events, survival from km", ["duration", "survival"], big=["at_risk", "events"]), "km"
    )
    reads = ", ".join(
        f"coalesce(arg_max(survival, duration) filter (where duration<={m}),1e0) as \"{m}M_Survival\"" for m in (12, 24, 36, 48, 60)
    )
    o["km_milestones"] = _with(
        f"select tier, {', '.join(_rd(chr(34) + f'{m}M_Survival' + chr(34)) + f' as {chr(34)}{m}M_Survival{chr(34)}' for m in (12, 24, 36, 48, 60))} "
        f"from (select tier, {reads} from km group by tier)",
        "km",
    )
    o["concordance_index"] = _with(
        _out(
            """select concordant, tied, comparable, (concordant+tied/2)/comparable as c_index from (
 select cast(sum(case when b.risk<a.risk then a.n*b.n else 0 end) as double) as concordant,
 cast(sum(case when b.risk=a.risk then a.n*b.n else 0 end) as double) as tied, cast(sum(a.n*b.n) as double) as comparable
 from (select risk, m, count(*) as n from cidx where event=1 group by risk, m) a
 join (select risk, m, event, count(*) as n from cidx group by risk, m, event) b on b.m>a.m or (b.m=a.m and b.event=0))""",
            ["concordant", "tied", "comparable", "c_index"],
        ),
        "cidx",
    )
    o["survival_calibration"] = _with(
        _out(_calibration(), ["brier_score", "mean_predicted_pd", "observed_default_rate", "calibration_ratio"]), "surv"
    )

    # explanation, recourse, uplift, fairness, stress
    o["attributions"] = _with(
        _out("select SK_ID_CURR, feature, value, contribution from attr", ["value", "contribution"]), "attr"
    )
    o["adverse_actions"] = _with(
        """select n.SK_ID_CURR, n.TARGET, round(score,4) as Risk_Score_LogOdds, cast(reason_rank as integer) as reason_rank, readable as Feature,
 feature as RawFeatureName, round(contribution,4) as Contribution, round(value,4) as FeatureValue
 from notice n join reason r on n.SK_ID_CURR=r.SK_ID_CURR where reason_rank<=4""",
        "notice",
        "reason",
    )
    o["global_attribution"] = _with(
        _out("select feature, avg(abs(contribution)) as mean_abs_contribution from attr group by feature", ["mean_abs_contribution"]),
        "attr",
    )
    o["counterfactual_grid"] = _with(
        _out(_grid(), ["original_pd", "distance", "new_pd", *(f"new_{c}" for c in _SCORES)]), "scored"
    )
    o["what_if_restructure"] = _with(
        _out(
            """select SK_ID_CURR, scenario, new_annuity, new_credit, new_dti, original_pd, new_pd, new_pd-original_pd as pd_change,
 case when new_pd<5e-1 and original_pd>=5e-1 then 'moved to approve' when new_pd>=5e-1 then 'still rejected' else 'no change' end as verdict from (
 select SK_ID_CURR, scenario, AMT_ANNUITY*fa as new_annuity, AMT_CREDIT*fc as new_credit, AMT_ANNUITY*fa/(AMT_INCOME_TOTAL+1e-6) as new_dti,
 least(greatest(1e0/(1e0+exp(-(LOGIT+least(AMT_ANNUITY/(AMT_INCOME_TOTAL+1e-6),1e0)))),1e-2),95e-2) as original_pd,
 least(greatest(1e0/(1e0+exp(-(LOGIT+least(AMT_ANNUITY*fa/(AMT_INCOME_TOTAL+1e-6),1e0)))),1e-2),95e-2) as new_pd
 from scored, (values ('annuity -20%',8e-1,1e0),('credit -20%',8e-1,8e-1),('annuity +50%',15e-1,1e0)) s(scenario,fa,fc))""",
            ["new_annuity", "new_credit", "new_dti", "original_pd", "new_pd", "pd_change"],
        ),
        "scored",
    )
    o["response_segments"] = _with(
        _out("select SK_ID_CURR, response_segment, true_effect from response", ["true_effect"]), "response"
    )
    cell = """count(*) filter (where TREATMENT=1) as n_treated, count(*) filter (where TREATMENT=0) as n_control,
 avg(TARGET) filter (where TREATMENT=1) as mean_treated, avg(TARGET) filter (where TREATMENT=0) as mean_control,
 avg(TARGET) filter (where TREATMENT=1)-avg(TARGET) filter (where TREATMENT=0) as cate"""
    o["cate_by_cell"] = _with(
        _out(f"select response_segment, {cell} from response group by response_segment", ["mean_treated", "mean_control", "cate"]),
        "response",
    )
    o["uplift_report"] = _with(
        _out(
            f"""select avg(true_effect) filter (where rn<=floor(n*2e-1)) as Persuadables_True_Effect,
 avg(DEBT_TO_INCOME_RATIO) filter (where rn<=floor(n*2e-1)) as Persuadables_Mean_DTI,
 avg(true_effect) filter (where rn>floor(n*8e-1)) as LostCauses_True_Effect,
 avg(DEBT_TO_INCOME_RATIO) filter (where rn>floor(n*8e-1)) as LostCauses_Mean_DTI from (
 select r.*, row_number() over (order by -coalesce(c.cate,0e0) desc, SK_ID_CURR) as rn, count(*) over () as n from response r join (
 select response_segment, dti_band, {cell} from response group by response_segment, dti_band) c
 on r.response_segment=c.response_segment and r.dti_band=c.dti_band)""",
            ["Persuadables_True_Effect", "Persuadables_Mean_DTI", "LostCauses_True_Effect", "LostCauses_Mean_DTI"],
        ),
        "response",
    )
    fair = ["Approval_Rate", "True_Positive_Rate", "False_Positive_Rate"]
    o["fairness_gender"] = _with(_out(_fairness("CODE_GENDER"), fair), "fair")
    o["fairness_age"] = _with(_out(_fairness("cohort"), fair), "fair")
    o["disparate_impact"] = _with(
        _out(
            f"""select "group", Approval_Rate, Approval_Rate/(max(Approval_Rate) over ()) as Disparate_Impact_Ratio from ({_fairness('CODE_GENDER')})""",
            ["Approval_Rate", "Disparate_Impact_Ratio"],
        ),
        "fair",
    )
    o["stress_test"] = _with(_stress(), "loss")
    return o


_cte(
    "ladder",
    """select model_name, PD, pos, neg, sum(pos) over a as cpos, sum(neg) over a as cneg, sum(pos) over d as tp, sum(neg) over d as fp,
 sum(pos) over (partition by model_name) as npos, sum(neg) over (partition by model_name) as nneg from (
 select model_name, PD, sum(TARGET) as pos, sum(1-TARGET) as neg from models group by model_name, PD)
 window a as (partition by model_name order by PD), d as (partition by model_name order by PD desc)""",
    "models",
)
_cte(
    "cidx",
    """select event, -4e0*(EXT_SOURCE_MEAN-5e-1) as risk, cast(duration as double) as m from surv""",
    "surv",
)
