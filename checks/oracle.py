"""DuckDB SQL for every registered query, written another way than the Spark jobs.

The jobs count headers before joining, pivot payer slots, group account sums and join them back;
the SQL joins lines to headers, joins payers once per slot, and uses windows over the guarantor.
"""

# The staged tables, as FIXTURES.md specifies them.
STAGED = {
    "practice": """
        select lpad(cast(r_regionkey % 5 + 1 as varchar), 4, '0') practice_id, r_name practice_name from region""",
    "patient_encounter": """
        select lpad(cast(o_orderkey % 5 + 1 as varchar), 4, '0') practice_id,
               cast(o_orderkey as varchar) enc_id,
               cast(o_orderkey as decimal(11, 0)) enc_nbr,
               case when o_orderkey % 97 = 0 then null else cast(o_custkey as varchar) end guar_id,
               case when o_custkey % 4 = 0 then 'E' else 'P' end guar_type,
               cast(case when o_orderkey % 3 = 0 then o_custkey else o_custkey + 1 end as varchar) person_id,
               case o_orderpriority when '1-URGENT' then 'A' when '2-HIGH' then 'B' when '3-MEDIUM' then 'H'
                    when '4-NOT SPECIFIED' then 'R' else case when o_orderkey % 2 = 0 then 'U' end end enc_status,
               o_orderdate enc_timestamp,
               cast(cast(o_orderdate as date) as varchar) pat_resp_date,
               cast(o_orderkey % 27 as varchar) location_id,
               concat('PT', o_orderstatus) patient_type_id
        from orders""",
    "charges": """
        select lpad(cast(l_orderkey % 5 + 1 as varchar), 4, '0') practice_id,
               cast(l_orderkey as varchar) source_id,
               concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_linenumber) charge_id,
               cast(l_extendedprice as decimal(19, 4)) amt,
               cast(case when l_linenumber in (1, 2) then l_extendedprice else 0 end as decimal(19, 4)) cob1_amt,
               cast(case when l_linenumber in (3, 4) then l_extendedprice else 0 end as decimal(19, 4)) cob2_amt,
               cast(case when l_linenumber = 5 then l_extendedprice else 0 end as decimal(19, 4)) cob3_amt,
               cast(case when l_linenumber in (6, 7) then l_extendedprice else 0 end as decimal(19, 4)) pat_amt
        from lineitem""",
    "trans_detail": """
        select lpad(cast(l_orderkey % 5 + 1 as varchar), 4, '0') practice_id,
               concat_ws('-', l_orderkey % 5 + 1, l_suppkey, l_linestatus, l_returnflag) trans_id,
               concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_linenumber) charge_id,
               cast(l_orderkey as varchar) source_id,
               cast(-l_quantity as decimal(19, 4)) paid_amt,
               cast(-l_discount as decimal(19, 4)) adj_amt,
               case when l_linenumber % 3 = 0 then 'N' else 'Y' end post_ind
        from lineitem""",
    "transactions": """
        select distinct lpad(cast(l_orderkey % 5 + 1 as varchar), 4, '0') practice_id,
               concat_ws('-', l_orderkey % 5 + 1, l_suppkey, l_linestatus, l_returnflag) trans_id,
               case when l_linestatus = 'F' then 'P' else 'T' end source,
               case when l_returnflag = 'N' then null else l_returnflag end type
        from lineitem""",
    "accounts": """
        select concat('A', c_custkey) acct_id, cast(c_custkey as decimal(12, 0)) acct_nbr,
               cast(c_custkey as varchar) guar_id
        from customer""",
    "person": """
        select cast(c_custkey as varchar) person_id,
               case when c_custkey % 11 = 0 then null else c_name end last_name,
               case when c_custkey % 7 = 0 then null else c_mktsegment end first_name
        from customer""",
    "employer_mstr": """
        select cast(c_custkey as varchar) employer_id, c_name as name from customer where c_custkey % 8 = 0""",
    "person_relationship": """
        select cast(c_custkey as varchar) person_id, cast(c_custkey + 1 as varchar) related_person_id,
               cast(c_custkey % 30 as varchar) relation_code
        from customer""",
    "code_tables": """
        select 'relation' code_type, cast(n_nationkey as varchar) code, n_name description from nation
        union all select 'other', cast(n_nationkey as varchar), 'WRONG' from nation""",
    "location_mstr": """
        select cast(n_nationkey as varchar) location_id, n_name location_name from nation""",
    "mstr_lists": """
        select distinct 'pat_type' mstr_list_type, concat('PT', o_orderstatus) mstr_list_item_id,
               concat('Type ', o_orderstatus) mstr_list_item_desc
        from orders where o_orderstatus <> 'P'
        union all select 'fin_class', concat('FC', r_regionkey), r_name from region where r_regionkey < 4""",
    "payer_mstr": """
        select cast(s_suppkey as varchar) payer_id, s_name payer_name,
               concat('FC', s_nationkey % 5) financial_class
        from supplier""",
    "encounter_payer": """
        select cast(l_orderkey as varchar) enc_id, l_linenumber cob, cast(min(l_suppkey) as varchar) payer_id
        from lineitem where l_linenumber <= 4 group by l_orderkey, l_linenumber""",
}

# The flawed tables: as staged, with rows added and ids shortened, and with the row of each key that counts.
_RAW = {f"staged_{name}": text for name, text in STAGED.items()}
FLAWED = {
    **_RAW,
    "typed_encounter": """
        select * replace (case when cast(enc_id as bigint) % 17 <> 0 then guar_type end as guar_type)
        from staged_patient_encounter""",
    "patient_encounter": """
        select * from typed_encounter
        union all
        select * replace (
            case when cast(enc_id as bigint) % 2 = 0 then guar_id || '0' end as guar_id,
            case when cast(enc_id as bigint) % 3 = 0 then 'A' end as enc_status,
            null as location_id)
        from typed_encounter where cast(enc_id as bigint) % 7 = 0""",
    "charge_lines": """
        select * replace (case when cast(source_id as bigint) % 19 <> 0 then amt end as amt) from staged_charges""",
    "charges": """
        select * from charge_lines
        union all
        select * replace (cast(cast(source_id as bigint) + 5 as varchar) as source_id)
        from charge_lines where cast(source_id as bigint) % 23 = 0""",
    "trans_detail": "select * replace (substr(trans_id, 3) as trans_id) from staged_trans_detail",
    "transactions": "select * replace (substr(trans_id, 3) as trans_id) from staged_transactions",
    "accounts": "select * from staged_accounts",
    "practice": "select * from staged_practice",
    "employer_mstr": "select * from staged_employer_mstr",
    "person": """
        select * from (
            select * from staged_person union all select * replace ('Zoe' as first_name) from staged_person)
        qualify row_number() over (
            partition by person_id order by coalesce(last_name, '') || ', ' || coalesce(first_name, '')) = 1""",
    "location_mstr": """
        select location_id, min(location_name) location_name from (
            select * from staged_location_mstr
            union all select location_id, location_name || ' (old)' from staged_location_mstr)
        group by location_id""",
    "listed": """
        select * from staged_mstr_lists
        union all select 'patXtype', 'PTP', 'Type by pattern'""",
    "mstr_lists": """
        select mstr_list_type, mstr_list_item_id, min(mstr_list_item_desc) mstr_list_item_desc from (
            select * from listed
            union all select mstr_list_type, mstr_list_item_id, mstr_list_item_desc || ' (old)' from listed)
        group by all""",
    "payer_mstr": """
        select payer_id, min(payer_name) payer_name, min(financial_class) financial_class from (
            select * from staged_payer_mstr union all select payer_id, null, financial_class from staged_payer_mstr)
        group by payer_id""",
    "person_relationship": "select * from staged_person_relationship",
    "code_tables": "select * from staged_code_tables",
    "encounter_payer": """
        select enc_id, cob, min(payer_id) payer_id from (
            select * from staged_encounter_payer union all select enc_id, cob, null from staged_encounter_payer)
        group by all""",
}

# Named steps on top of the staged tables.
STEPS = {
    "enc": """
        select practice_id, enc_id, guar_id, guar_type, person_id, enc_status, location_id, enc_nbr,
               cast(enc_timestamp as date) dos, pat_resp_date, patient_type_id pat_type
        from patient_encounter
        qualify row_number() over (
            partition by practice_id, enc_id
            order by guar_id nulls last, guar_type nulls last, person_id nulls last, enc_status nulls last,
                     location_id nulls last, enc_nbr nulls last, cast(enc_timestamp as date) nulls last,
                     pat_resp_date nulls last, patient_type_id nulls last) = 1""",
    "charged": """
        select enc.*, coalesce(s.amt, 0) enc_tot_chg, coalesce(s.c1, 0) enc_ins_buc1,
               coalesce(s.c2, 0) enc_ins_buc2, coalesce(s.c3, 0) enc_ins_buc3, coalesce(s.pat, 0) raw_pat_buc
        from enc left join (
            select practice_id, source_id, sum(amt) amt, sum(cob1_amt) c1, sum(cob2_amt) c2,
                   sum(cob3_amt) c3, sum(pat_amt) pat
            from charges group by all) s
          on s.source_id = enc.enc_id and s.practice_id = enc.practice_id""",
    "paid": """
        select d.practice_id, d.source_id enc_id,
               sum(paid_amt) filter (where h.source = 'T') ip,
               sum(adj_amt) filter (where h.source = 'T' and d.post_ind = 'Y' and h.type <> 'R') ia,
               sum(adj_amt) filter (where h.source = 'T' and d.post_ind = 'Y' and h.type = 'R') ir,
               sum(paid_amt) filter (where h.source = 'P') pp,
               sum(adj_amt) filter (where h.source = 'P' and d.post_ind = 'Y' and h.type <> 'R') pa,
               sum(adj_amt) filter (where h.source = 'P' and d.post_ind = 'Y' and h.type = 'R') pr
        from trans_detail d inner join transactions h using (trans_id, practice_id)
        group by all""",
    "moneyed": """
        select c.* exclude (raw_pat_buc),
               case when enc_status = 'A' then 0 else raw_pat_buc end enc_pat_buc,
               case when enc_status = 'A' then raw_pat_buc when enc_status is not null then 0 end enc_bad_debt_amt,
               coalesce(ip, 0) enc_ins_pmt, coalesce(ia, 0) enc_ins_adj, coalesce(ir, 0) enc_ins_ref,
               coalesce(pp, 0) enc_pat_pmt, coalesce(pa, 0) enc_pat_adj, coalesce(pr, 0) enc_pat_ref
        from charged c left join paid p on p.enc_id = c.enc_id and p.practice_id = c.practice_id""",
    "totalled": """
        select *, enc_pat_pmt + enc_pat_adj + enc_pat_ref enc_pat_tot,
               enc_ins_pmt + enc_ins_adj + enc_ins_ref enc_ins_tot,
               enc_ins_buc1 + enc_ins_buc2 + enc_ins_buc3 enc_ins_bal,
               enc_ins_pmt + enc_pat_pmt enc_pmt_tot,
               enc_ins_adj + enc_pat_adj enc_adj_tot,
               enc_ins_ref + enc_pat_ref enc_ref_tot,
               enc_ins_adj + enc_ins_ref + enc_pat_adj + enc_pat_ref enc_ref_adj_amt,
               enc_tot_chg + enc_pat_pmt + enc_pat_adj + enc_pat_ref
                 + enc_ins_pmt + enc_ins_adj + enc_ins_ref enc_bal
        from moneyed""",
    "named": """
        select e.practice_id, e.enc_id, pr.practice_name, a.acct_id, a.acct_nbr, l.location_name,
               m.mstr_list_item_desc pat_type_desc, r.relation_code relationship_id,
               k.description relationship_desc,
               case e.enc_status when 'H' then 'History' when 'B' then 'Billed' when 'R' then 'Rebill'
                    when 'A' then 'Bad Debt' else 'Unbilled' end enc_status_desc,
               case when pp.person_id is not null
                    then coalesce(pp.last_name, '') || ', ' || coalesce(pp.first_name, '') end person_name,
               case when e.guar_type = 'E' then b.name
                    when e.guar_type = 'P' and gp.person_id is not null
                    then coalesce(gp.last_name, '') || ', ' || coalesce(gp.first_name, '') end guar_name
        from enc e
        left join practice pr on pr.practice_id = e.practice_id
        left join accounts a on a.guar_id = e.guar_id
        left join location_mstr l on l.location_id = e.location_id
        left join mstr_lists m on m.mstr_list_item_id = e.pat_type and m.mstr_list_type like 'pat_type'
        left join person_relationship r on r.person_id = e.guar_id and r.related_person_id = e.person_id
        left join code_tables k on k.code = r.relation_code and k.code_type = 'relation'
        left join person pp on pp.person_id = e.person_id
        left join employer_mstr b on b.employer_id = e.guar_id
        left join person gp on gp.person_id = e.guar_id""",
    "payers": """
        select e.practice_id, e.enc_id,
               s1.payer_id payer1_id, p1.payer_name payer1_name, p1.financial_class payer1_fc_id,
               m1.mstr_list_item_desc payer1_fin_class,
               s2.payer_id payer2_id, p2.payer_name payer2_name, p2.financial_class payer2_fc_id,
               m2.mstr_list_item_desc payer2_fin_class,
               s3.payer_id payer3_id, p3.payer_name payer3_name, p3.financial_class payer3_fc_id,
               m3.mstr_list_item_desc payer3_fin_class
        from enc e
        left join encounter_payer s1 on s1.enc_id = e.enc_id and s1.cob = 1
        left join encounter_payer s2 on s2.enc_id = e.enc_id and s2.cob = 2
        left join encounter_payer s3 on s3.enc_id = e.enc_id and s3.cob = 3
        left join payer_mstr p1 on p1.payer_id = s1.payer_id
        left join payer_mstr p2 on p2.payer_id = s2.payer_id
        left join payer_mstr p3 on p3.payer_id = s3.payer_id
        left join mstr_lists m1 on m1.mstr_list_item_id = p1.financial_class and m1.mstr_list_type like 'fin_class'
        left join mstr_lists m2 on m2.mstr_list_item_id = p2.financial_class and m2.mstr_list_type like 'fin_class'
        left join mstr_lists m3 on m3.mstr_list_item_id = p3.financial_class and m3.mstr_list_type like 'fin_class'""",
    "summed": """
        select practice_id, source_id enc_id, charge_id, sum(amt) chgamt, sum(cob1_amt) chgcob1,
               sum(cob2_amt) chgcob2, sum(cob3_amt) chgcob3, sum(pat_amt) chgpat
        from charges where practice_id in ({practices})
        group by all""",
    "settled": """
        select k.practice_id, k.charge_id,
               coalesce(sum(paid_amt) filter (where h.source = 'T'), 0) chginspmt,
               coalesce(sum(adj_amt) filter (where h.source = 'T' and h.type <> 'R'), 0) chginsadj,
               coalesce(sum(adj_amt) filter (where h.source = 'T' and h.type = 'R'), 0) chginsref,
               coalesce(sum(paid_amt) filter (where h.source = 'P'), 0) chgpatpmt,
               coalesce(sum(adj_amt) filter (where h.source = 'P' and h.type <> 'R'), 0) chgpatadj,
               coalesce(sum(adj_amt) filter (where h.source = 'P' and h.type = 'R'), 0) chgpatref
        from (select distinct practice_id, charge_id from summed) k
        left join (trans_detail d inner join transactions h on h.trans_id = d.trans_id)
          on d.practice_id = k.practice_id and d.charge_id = k.charge_id and d.post_ind = 'Y'
        group by all""",
    "owned": """
        select s.*, s.chgcob1 + s.chgcob2 + s.chgcob3 chginsbal, e.guar_id, e.guar_type
        from summed s
        left join (
            select enc_id, guar_id, guar_type from patient_encounter where guar_id is not null
            qualify row_number() over (partition by enc_id order by guar_id, guar_type nulls last) = 1
            ) e on e.enc_id = s.enc_id
        where e.guar_id is not null""",
    "fact": """
        select o.*, t.* exclude (practice_id, charge_id),
               chgamt + chginspmt + chgpatpmt + chginsadj + chgpatadj + chginsref + chgpatref chgencbal
        from owned o inner join settled t on t.practice_id = o.practice_id and t.charge_id = o.charge_id""",
    "f_transactions": """
        select practice_id "Practice_ID", guar_id "Guarantor_ID", enc_id "Enc_ID", charge_id "Charge_ID",
               guar_type "Guar_Type", chgamt "Gross_Charges", chgcob1 "COB1_Bal", chgcob2 "COB2_Bal",
               chgcob3 "COB3_Bal", chgpat "Pat_Bal", chginsbal "Tot_Ins_Bal", chginspmt "Ins_Pmt_Amt",
               chgpatpmt "Pat_Pmt_Amt", chginsadj "Ins_Adj_Amt", chgpatadj "Pat_Adj_Amt",
               chginsref "Ins_Ref_Amt", chgpatref "Pat_Ref_Amt", chgencbal "Curr_Enc_Bal"
        from fact""",
}

CHARGE_BUCKETS = "enc_tot_chg enc_ins_buc1 enc_ins_buc2 enc_ins_buc3".split()
TRANSACTIONS = "enc_ins_pmt enc_ins_adj enc_ins_ref enc_pat_pmt enc_pat_adj enc_pat_ref".split()
TOTALS = "enc_pat_tot enc_ins_tot enc_ins_bal enc_pmt_tot enc_adj_tot enc_ref_tot enc_ref_adj_amt enc_bal".split()
FACT_MONEY = (
    "chgamt chgcob1 chgcob2 chgcob3 chgpat chginsbal"
    " chginspmt chgpatpmt chginsadj chgpatadj chginsref chgpatref chgencbal"
).split()
FACT_TEXT = "practice_id guar_id guar_type enc_id charge_id".split()
WAREHOUSE_TEXT = "Practice_ID Guarantor_ID Enc_ID Charge_ID Guar_Type".split()
WAREHOUSE_MONEY = (
    "Gross_Charges COB1_Bal COB2_Bal COB3_Bal Pat_Bal Tot_Ins_Bal Ins_Pmt_Amt Pat_Pmt_Amt"
    " Ins_Adj_Amt Pat_Adj_Amt Ins_Ref_Amt Pat_Ref_Amt Curr_Enc_Bal"
).split()


def _money(*columns: str) -> str:
    return ", ".join(f"cast({c} as decimal(19, 4)) as {c}" for c in columns)


# Account column <- the encounter column it sums over the guarantor.
_ACCOUNT = {
    **{c.replace("enc_", "acct_"): c for c in [*CHARGE_BUCKETS, *TRANSACTIONS, *TOTALS]},
    "acct_self_buc": "enc_pat_buc",
    "acct_bad_debt_amt": "enc_bad_debt_amt",
}


def _accounts(alias: str) -> str:
    """Windows over the guarantor; an encounter without one belongs to no account."""
    return ", ".join(
        f"cast(case when {alias}.guar_id is null then 0"
        f" else coalesce(sum({alias}.{source}) over (partition by {alias}.guar_id), 0) end"
        f" as decimal(19, 4)) as {name}"
        for name, source in _ACCOUNT.items()
    )


_SCOPE = """
    select distinct w.practice_id, w.enc_id from patient_encounter w
    where w.guar_id in (select guar_id from patient_encounter where {chosen})"""

_RULES = " union all ".join(
    f"""select 'NOT NULL' as rule, '{c}' as column_name, count(*) filter (where "{c}" is null) as violations
        from f_transactions"""
    for c in [*WAREHOUSE_TEXT, *WAREHOUSE_MONEY]
)

BODIES = {
    "encounter_scope": _SCOPE.format(chosen="practice_id = '0001'"),
    "encounter_scope_by_number": _SCOPE.format(
        chosen="practice_id = '0001' and enc_nbr in (5, 10, 25, 100, 1000)"
    ),
    "encounter_attributes": """
        select practice_id, enc_id, guar_id, guar_type, person_id, enc_status, location_id, enc_nbr, dos,
               pat_resp_date, pat_type
        from enc""",
    "account_lookup": """
        select enc.practice_id, enc.enc_id, enc.guar_id, named.acct_id, named.acct_nbr
        from enc inner join named using (practice_id, enc_id)""",
    "payer_slots": "select practice_id, enc_id, payer1_id, payer2_id, payer3_id from payers",
    "encounter_charge_sums": f"""
        select practice_id, enc_id, {_money(*CHARGE_BUCKETS)},
               cast(raw_pat_buc as decimal(19, 4)) as enc_pat_buc
        from charged""",
    "encounter_trans_sums": f"select practice_id, enc_id, {_money(*TRANSACTIONS)} from moneyed",
    "bad_debt_move": f"""
        select practice_id, enc_id, enc_status, {_money("enc_pat_buc", "enc_bad_debt_amt")} from moneyed""",
    "encounter_totals": f"select practice_id, enc_id, {_money(*TOTALS)} from totalled",
    "account_totals": f"select t.practice_id, t.enc_id, t.guar_id, {_accounts('t')} from totalled t",
    "relationship_desc": "select practice_id, enc_id, relationship_id, relationship_desc from named",
    "practice_name": "select practice_id, enc_id, practice_name from named",
    "guarantor_name": """
        select enc.practice_id, enc.enc_id, enc.guar_id, enc.guar_type, named.guar_name
        from enc inner join named using (practice_id, enc_id)""",
    "person_name": """
        select enc.practice_id, enc.enc_id, enc.person_id, named.person_name
        from enc inner join named using (practice_id, enc_id)""",
    "status_desc": """
        select enc.practice_id, enc.enc_id, enc.enc_status, named.enc_status_desc
        from enc inner join named using (practice_id, enc_id)""",
    "location_name": """
        select enc.practice_id, enc.enc_id, enc.location_id, named.location_name
        from enc inner join named using (practice_id, enc_id)""",
    "patient_type_desc": """
        select enc.practice_id, enc.enc_id, enc.pat_type, named.pat_type_desc
        from enc inner join named using (practice_id, enc_id)""",
    "payer_names": """
        select practice_id, enc_id, payer1_id, payer1_name, payer1_fc_id, payer2_id, payer2_name,
               payer2_fc_id, payer3_id, payer3_name, payer3_fc_id
        from payers""",
    "payer_financial_class": """
        select practice_id, enc_id, payer1_fc_id, payer1_fin_class, payer2_fc_id, payer2_fin_class,
               payer3_fc_id, payer3_fin_class
        from payers""",
    "encounter_balances": f"""
        select t.practice_id, n.practice_name, n.acct_id, n.acct_nbr, t.guar_id, t.guar_type, n.guar_name,
               t.person_id, n.person_name, n.relationship_id, n.relationship_desc, t.enc_id, t.enc_status,
               n.enc_status_desc, t.enc_nbr, t.dos, t.pat_resp_date, t.location_id, n.location_name,
               t.pat_type, n.pat_type_desc, p.* exclude (practice_id, enc_id),
               {_money(*CHARGE_BUCKETS, *TRANSACTIONS, *TOTALS, "enc_pat_buc", "enc_bad_debt_amt")},
               {_accounts("t")}
        from totalled t
        inner join named n on n.practice_id = t.practice_id and n.enc_id = t.enc_id
        inner join payers p on p.practice_id = t.practice_id and p.enc_id = t.enc_id
        where t.guar_id in (
            select guar_id from patient_encounter
            where practice_id in ('0001', '0002', '0003', '0004', '0005'))""",
    "charge_sums": f"""
        select practice_id, enc_id, charge_id, {_money(*FACT_MONEY[:5])} from summed""",
    "charge_insurance_balance": """
        select practice_id, enc_id, charge_id,
               cast(chgcob1 + chgcob2 + chgcob3 as decimal(19, 4)) as chginsbal
        from summed""",
    "charge_trans_sums": f"select practice_id, charge_id, {_money(*FACT_MONEY[6:12])} from settled",
    "charge_guarantor": f"select {', '.join(FACT_TEXT)}, {_money(*FACT_MONEY[:6])} from owned",
    "charge_fact": f"select {', '.join(FACT_TEXT)}, {_money(*FACT_MONEY)} from fact",
    "charge_fact_sample": f"""
        select {', '.join(FACT_TEXT)}, {_money(*FACT_MONEY)} from fact
        order by practice_id, enc_id, charge_id limit 100""",
    "fact_load": f"select {', '.join(WAREHOUSE_TEXT)}, {_money(*WAREHOUSE_MONEY)} from f_transactions",
    "fact_contract_violations": f"""
        {_RULES}
        union all
        select 'PRIMARY KEY', 'Charge_ID', count(*) from (
            select "Charge_ID" from f_transactions where "Charge_ID" is not null
            group by "Charge_ID" having count(*) > 1)""",
}


ALL_PRACTICES = "'0001', '0002', '0003', '0004', '0005'"
# Queries that run another one's SQL over other practices.
_LIMITED = {"charge_fact_of_practices": "'0001', '0002', '0003'"}


def full_sql(name: str, tables: dict[str, str] = STAGED) -> str:
    """The SQL of a query over the given billing tables, each a SELECT."""
    chosen = _LIMITED.get(name, ALL_PRACTICES)
    steps = {step: text.replace("{practices}", chosen) for step, text in {**tables, **STEPS}.items()}
    ctes = ",\n".join(f"{step} as ({text})" for step, text in steps.items())
    return f"with {ctes}\n{BODIES[name]}"


BODIES["charge_fact_of_practices"] = BODIES["charge_fact_by_bucket"] = BODIES["charge_fact"]
BODIES["encounter_balances_by_number"] = BODIES["encounter_balances"].replace(
    "where practice_id in ('0001', '0002', '0003', '0004', '0005')",
    "where practice_id = '0001' and enc_nbr in (5, 10, 25, 100, 1000)",
)

FLAWED_BODIES = (
    "encounter_attributes encounter_trans_sums charge_trans_sums encounter_balances charge_fact fact_contract_violations"
).split()

ORACLE_SQL = {
    **{name: full_sql(name) for name in BODIES},
    **{f"flawed_{name}": full_sql(name, FLAWED) for name in FLAWED_BODIES},
}
