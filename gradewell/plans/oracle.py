"""The same queries in plain SQL for DuckDB, written independently of the DataFrame code."""

from __future__ import annotations

from gradewell.sources.applications import APPLICATIONS_SQL

# Chained common table expressions; each query selects from the ones it needs.
STEPS = "with applications as (" + APPLICATIONS_SQL.format(orders="orders", customer="customer") + "),"

STEPS += """
keyed as (
  select *, sha256(concat_ws('||', emp_title, emp_length, home_ownership, annual_inc, zip_code, addr_state,
                             grade, sub_grade, verification_status)) member_id
  from applications),
landed_customers as (
  select member_id, emp_title, emp_length, home_ownership, annual_inc, addr_state, zip_code, 'USA' country, grade,
         sub_grade, verification_status, tot_hi_cred_lim, application_type, annual_inc_joint, verification_status_joint
  from keyed),
landed_loans as (
  select id loan_id, member_id, loan_amnt loan_amount, funded_amnt funded_amount, term loan_term_months,
         int_rate interest_rate, installment monthly_installment, issue_d issue_date, loan_status,
         purpose loan_purpose, title loan_title
  from keyed),
landed_repayments as (
  select id loan_id, total_rec_prncp total_principal_received, total_rec_int total_interest_received,
         total_rec_late_fee total_late_fee_received, total_pymnt total_payment_received,
         last_pymnt_amnt last_payment_amount, last_pymnt_d last_payment_date, next_pymnt_d next_payment_date
  from keyed),
landed_defaulters as (
  select member_id, delinq_2yrs, delinq_amnt, pub_rec, pub_rec_bankruptcies, inq_last_6mths, total_rec_late_fee,
         mths_since_last_delinq, mths_since_last_record
  from keyed),
known_customers as (
  select member_id, emp_title,
         try_cast(regexp_replace(emp_length, '[^0-9]', '', 'g') as int) emp_length,
         home_ownership, annual_inc annual_income,
         case when length(addr_state) > 2 then 'NA' else addr_state end address_state,
         zip_code address_zipcode, country address_country, grade, sub_grade, verification_status,
         tot_hi_cred_lim total_high_credit_limit, application_type, annual_inc_joint join_annual_income,
         verification_status_joint
  from (select distinct * from landed_customers) where annual_inc is not null),
customers as (
  select * replace (coalesce(emp_length, (select cast(floor(avg(emp_length)) as int) from known_customers))
                    as emp_length)
  from known_customers),
loans as (
  select loan_id, member_id, loan_amount, funded_amount,
         cast(trunc(cast(trim(replace(loan_term_months, ' months', '')) as int) / 12) as int) loan_term_years,
         interest_rate, monthly_installment, issue_date, loan_status,
         -- fixed values: the purposes kept
         case when loan_purpose in ('debt_consolidation', 'credit_card', 'home_improvement', 'other',
                                    'major_purchase', 'medical', 'small_business', 'car', 'vacation', 'moving',
                                    'house', 'wedding', 'renewable_energy', 'educational')
              then loan_purpose else 'other' end loan_purpose,
         loan_title
  from (select distinct * from landed_loans)
  where loan_amount is not null and funded_amount is not null and loan_term_months is not null
    and interest_rate is not null and monthly_installment is not null and issue_date is not null
    and loan_status is not null and loan_purpose is not null),
repayments as (
  select loan_id, total_principal_received, total_interest_received, total_late_fee_received,
         cast(case when total_principal_received <> 0 and total_payment_received = 0
                   then total_principal_received + total_interest_received + total_late_fee_received
                   else total_payment_received end as decimal(12,2)) total_payment_received,
         last_payment_amount,
         case when last_payment_date <> '0.0' then last_payment_date end last_payment_date,
         case when next_payment_date <> '0.0' then next_payment_date end next_payment_date
  from (select distinct * from landed_repayments)
  where total_principal_received is not null and total_interest_received is not null
    and total_late_fee_received is not null and total_payment_received is not null
    and last_payment_amount is not null),
defaulters as (
  select * replace (coalesce(cast(trunc(delinq_2yrs) as int), 0) as delinq_2yrs)
  from (select distinct * from landed_defaulters)),
delinq as (
  select member_id, delinq_2yrs, delinq_amnt, cast(trunc(mths_since_last_delinq) as int) mths_since_last_delinq
  from defaulters where delinq_2yrs > 0 or mths_since_last_delinq > 0),
records_enq as (
  select * from defaulters where pub_rec > 0 or pub_rec_bankruptcies > 0 or inq_last_6mths > 0),
detail as (
  select member_id, coalesce(cast(trunc(pub_rec) as int), 0) pub_rec,
         coalesce(cast(trunc(pub_rec_bankruptcies) as int), 0) pub_rec_bankruptcies,
         coalesce(cast(trunc(inq_last_6mths) as int), 0) inq_last_6mths
  from defaulters),
dup_customers as (select member_id, count(*) total from customers group by member_id having count(*) > 1),
dup_delinq as (select member_id, count(*) total from delinq group by member_id having count(*) > 1),
dup_detail as (select member_id, count(*) total from detail group by member_id having count(*) > 1),
bad as (
  select member_id from dup_customers union select member_id from dup_delinq
  union select member_id from dup_detail),
good_customers as (select * from customers where member_id not in (select member_id from bad)),
good_delinq as (select * from delinq where member_id not in (select member_id from bad)),
good_detail as (select * from detail where member_id not in (select member_id from bad)),
one_loans as (select distinct * from loans),
one_repayments as (select distinct * from repayments),
repeated as (
  select loan_id, coalesce(n, 0) n_loans, coalesce(m, 0) n_repayments
  from (select loan_id, count(*) n from one_loans where loan_id is not null group by loan_id)
  full join (select loan_id, count(*) m from one_repayments where loan_id is not null group by loan_id) using (loan_id)
  where n > 1 or m > 1),
single_loans as (select * from one_loans where loan_id not in (select loan_id from repeated)),
single_repayments as (select * from one_repayments where loan_id not in (select loan_id from repeated)),
base as (
  select r.*, l.* exclude (loan_id) from single_repayments r join single_loans l on r.loan_id = l.loan_id),
all_pairs as (select r.*, l.* exclude (loan_id) from repayments r join loans l on r.loan_id = l.loan_id),
dropped as (
  select 'customers' entity, 'annual_inc' missing, count(*) n_rows
  from (select distinct * from landed_customers) where annual_inc is null having count(*) > 0
  union all
  select 'loans', case when loan_amount is null then 'loan_amount' when funded_amount is null then 'funded_amount'
    when loan_term_months is null then 'loan_term_months' when interest_rate is null then 'interest_rate'
    when monthly_installment is null then 'monthly_installment' when issue_date is null then 'issue_date'
    when loan_status is null then 'loan_status' when loan_purpose is null then 'loan_purpose' end missing, count(*)
  from (select distinct * from landed_loans) group by missing having missing is not null
  union all
  select 'loans_repayments', case when total_principal_received is null then 'total_principal_received'
    when total_interest_received is null then 'total_interest_received'
    when total_late_fee_received is null then 'total_late_fee_received'
    when total_payment_received is null then 'total_payment_received'
    when last_payment_amount is null then 'last_payment_amount' end missing, count(*)
  from (select distinct * from landed_repayments) group by missing having missing is not null),
"""

# Points and cut points.
NUMBERS = {
    "unacceptable": 0, "very_bad": 100, "bad": 250, "good": 500, "very_good": 650, "excellent": 800,
    "unacceptable_grade": 750, "very_bad_grade": 1000, "bad_grade": 1500, "good_grade": 2000, "very_good_grade": 2500,
}

# The rules as intervals "low high" of the value, first match wins. Brackets include a bound.
INTERVALS = {
    "last_payment": {
        "repaired": ["(- 0.5) very_bad", "[0.5 1) bad", "[1 1] good", "(1 1.5) very_good", "[1.5 -) excellent"],
        "literal": ["(- 0.5) very_bad", "(0.5 1) bad", "[0.5 0.5] good", "(1 1.5) very_good", "(1.5 -) excellent"],
    },
    "funded": {
        "repaired": ["(- 0.1] excellent", "(0.1 0.3) good", "[0.3 0.5) bad", "[0.5 0.9) very_bad"],
        "literal": ["(- 0.1] excellent", "(0.1 0.3) good", "(- 0.3] bad", "(- 0.5] very_bad", "[1 1] unacceptable"],
    },
    "count": ["[0 0] excellent", "[1 2] bad", "[3 5] very_bad", "(5 -) unacceptable"],
    "total_payment": ["[0.5 -) very_good", "(0 -) good"],
}
# LIKE patterns on the lower-cased text, first match wins.
PATTERNS = {
    "status": {
        "repaired": {"%fully paid%": "excellent", "%current%": "good", "%in grace period%": "bad",
                     "%late (16-30 days)%": "very_bad", "%late (31 - 120 days)%": "very_bad",
                     "%late (31-120 days)%": "very_bad"},
        "literal": {"%fully paid%": "excellent", "%current%": "good", "%in grace period%": "bad",
                    "%late (16-30 days)%": "very_bad", "%late (31 - 120 days)%": "very_bad",
                    "%charged off%": "unacceptable"},
    },
    "home": {"%own": "excellent", "%rent%": "good", "%mortgage%": "bad", "%any%": "unacceptable"},
}


def _intervals(rows: list[str], value: str, numbers: dict[str, int], scale: str = "1", last: str = "") -> str:
    """CASE over intervals; bounds are multiples of `scale`, `last` closes the CASE."""
    branches = []
    for row in rows:
        interval, level = row.rsplit(" ", 1)
        low, high = interval[1:-1].split()
        tests = []
        if low != "-":
            tests.append(f"{value} {'>=' if interval[0] == '[' else '>'} {scale} * {low}")
        if high != "-":
            tests.append(f"{value} {'<=' if interval[-1] == ']' else '<'} {scale} * {high}")
        branches.append(f"when {' and '.join(tests)} then {numbers[level]}")
    return f"case {' '.join(branches)} {last} end"


def _patterns(rows: dict[str, str], text: str, numbers: dict[str, int], last: str = "") -> str:
    branches = [f"when lower({text}) like '{pattern}' then {numbers[level]}" for pattern, level in rows.items()]
    return f"case {' '.join(branches)} {last} end"


def _letters(profile: str, numbers: dict[str, int]) -> str:
    """Letter by cut points; the literal bands end one point below the next cut."""
    cuts = ["very_good_grade", "good_grade", "bad_grade", "very_bad_grade", "unacceptable_grade"]
    branches = [f"when loan_total_score >= {numbers[cuts[0]]} then 'A+'"]
    for letter, low, high in zip("BCDE", cuts[1:], cuts):
        upper = f"< {numbers[high]}" if profile == "repaired" else f"<= {numbers[high]} - 1"
        branches.append(f"when loan_total_score >= {numbers[low]} and loan_total_score {upper} then '{letter}'")
    branches.append(f"when loan_total_score < {numbers[cuts[-1]]} then 'F'")
    return f"case {' '.join(branches)} end"


def _lender_grade(numbers: dict[str, int], last: str) -> str:
    levels = zip("ABCDE", ["excellent", "good", "bad", "very_bad", "unacceptable"])
    points = " ".join(f"when '{letter}' then {numbers[level]}" for letter, level in levels)
    return (f"case when regexp_full_match(a.sub_grade, a.grade || '[1-5]') then case a.grade {points} {last} end "
            f"{last} end")


def _scoring(profile: str = "repaired", numbers: dict[str, int] = NUMBERS, clean_members: bool = False) -> str:
    """The three scoring stages, totals and grades as further steps."""
    worst = numbers["unacceptable"]
    otherwise = f"else {worst}" if profile == "repaired" else ""

    def count(column: str) -> str:
        null_column = column if profile == "repaired" else "delinq"
        return _intervals(INTERVALS["count"], column, numbers, last=f"when {null_column} is null then {worst}")

    last_payment = _intervals(INTERVALS["last_payment"][profile], "last_payment_amount", numbers, "monthly_installment")
    total_payment = _intervals(INTERVALS["total_payment"], "total_payment_received", numbers, "funded_amount",
                               f"else {worst}")
    funded = _intervals(INTERVALS["funded"][profile], "l.funded_amount", numbers, "a.total_high_credit_limit", otherwise)
    home_last = otherwise or f"when l.loan_status is null then {worst}"
    delinq_join = "left join" if clean_members else "join"
    delinq = "coalesce(d.delinq_2yrs, 0)" if clean_members else "d.delinq_2yrs"
    loan_join = "loan_id" if profile == "repaired" else "member_id"
    base = "base" if profile == "repaired" else "all_pairs"
    return f"""
paid_all as (
  select member_id, loan_id, {last_payment} last_payment_pts, {total_payment} total_payment_received_pts from {base}),
payments as (
  select member_id, loan_id, {last_payment} last_payment_pts, {total_payment} total_payment_received_pts
  from {base} where member_id not in (select member_id from bad)),
history as (
  select member_id, loan_id, last_payment_pts, total_payment_received_pts, {count('delinq')} delinq_pts,
         {count('pub_rec')} public_record_pts, {count('pub_rec_bankruptcies')} public_bankruptcies_pts,
         {count('inq_last_6mths')} enq_pts
  from (select p.*, {delinq} delinq, t.pub_rec, t.pub_rec_bankruptcies, t.inq_last_6mths
        from payments p join good_detail t using (member_id) {delinq_join} good_delinq d using (member_id))),
points as (
  select h.*, {_patterns(PATTERNS['status'][profile], 'l.loan_status', numbers, otherwise)} loan_status_pts,
         {_patterns(PATTERNS['home'], 'a.home_ownership', numbers, home_last)} home_pts,
         {funded} funded_amt_pts, {_lender_grade(numbers, otherwise)} grade_pts
  from history h join loans l on h.{loan_join} = l.{loan_join} join good_customers a on a.member_id = h.member_id),
sums as (
  select *, cast((last_payment_pts + total_payment_received_pts) * 0.20 as decimal(13,2)) payment_history_pts,
         cast((delinq_pts + public_record_pts + public_bankruptcies_pts + enq_pts) * 0.45 as decimal(13,2))
           loan_default_history_pts,
         cast((loan_status_pts + home_pts + funded_amt_pts + grade_pts) * 0.35 as decimal(13,2)) financial_health_pts
  from points),
totals as (
  select *, cast(payment_history_pts + loan_default_history_pts + financial_health_pts as decimal(15,2))
            loan_total_score
  from sums),
grades as (
  select member_id, loan_id, payment_history_pts, loan_default_history_pts, financial_health_pts, loan_total_score,
         {_letters(profile, numbers)} loan_grade
  from totals)
"""


def _query(select: str) -> str:
    return STEPS + "done as (select 1)\n" + select


def _scored(select: str, **options) -> str:
    return STEPS + _scoring(**options).lstrip() + select


# Any other set of numbers, to show that none is built in.
CUSTOM_NUMBERS = {
    "unacceptable": 10, "very_bad": 120, "bad": 260, "good": 480, "very_good": 700, "excellent": 900,
    "unacceptable_grade": 700, "very_bad_grade": 950, "bad_grade": 1400, "good_grade": 1900, "very_good_grade": 2300,
}

_KEY = "emp_title, emp_length, home_ownership, annual_inc, zip_code, addr_state, grade, sub_grade, verification_status"

_WIDE_COLUMNS = """
  c.*, l.* exclude (member_id), r.* exclude (loan_id), q.* exclude (member_id), t.* exclude (member_id)"""

_PAYMENTS = "select member_id, loan_id, {} from payments"
_HISTORY = "select member_id, loan_id, {} from history"
_POINTS = "select member_id, loan_id, {} from points"

PAYMENT = "last_payment_pts, total_payment_received_pts"
HISTORY = "delinq_pts, public_record_pts, public_bankruptcies_pts, enq_pts"
HEALTH = "loan_status_pts, home_pts, funded_amt_pts, grade_pts"
_RESULT = ("member_id, loan_id, payment_history_pts, loan_default_history_pts, financial_health_pts, "
           "loan_total_score, loan_grade")


_BY_YEAR = f"""select * from (
  select {_RESULT}, cast(right(issue_date, 4) as int) issue_year
  from grades join (select loan_id, issue_date from loans) using (loan_id))"""

# Points that depend on the member alone, with the credit limit.
_MEMBER_POINTS = f"""
  select d.member_id, {_intervals(INTERVALS["count"], "d.delinq_2yrs", NUMBERS, last="else 0")} delinq_pts,
         {_intervals(INTERVALS["count"], "t.pub_rec", NUMBERS, last="else 0")} public_record_pts,
         {_intervals(INTERVALS["count"], "t.pub_rec_bankruptcies", NUMBERS, last="else 0")} public_bankruptcies_pts,
         {_intervals(INTERVALS["count"], "t.inq_last_6mths", NUMBERS, last="else 0")} enq_pts,
         {_patterns(PATTERNS["home"], "a.home_ownership", NUMBERS, "else 0")} home_pts,
         {_lender_grade(NUMBERS, "else 0")} grade_pts, a.total_high_credit_limit
  from good_customers a join good_delinq d on d.member_id = a.member_id join good_detail t on t.member_id = a.member_id"""


def _class_id(table: str, columns: str) -> str:
    texts = [f"coalesce(length(cast({table}.{c} as varchar)) || ':' || cast({table}.{c} as varchar), '-')" for c in columns.split()]
    return f"md5({' || '.join(texts)})"


# Values of a class, by kind.
_CLASS_COLUMNS = {
    "customers": "emp_title emp_length home_ownership annual_income address_state address_zipcode address_country grade "
                 "sub_grade verification_status total_high_credit_limit application_type join_annual_income "
                 "verification_status_joint",
    "delinq": "delinq_2yrs delinq_amnt mths_since_last_delinq",
    "detail": "pub_rec pub_rec_bankruptcies inq_last_6mths",
}
_FIVE = """customers c join loans l on l.member_id = c.member_id join repayments r on r.loan_id = l.loan_id
  join delinq q on q.member_id = c.member_id join detail t on t.member_id = c.member_id"""


_TOTALS = """
  select * from (select member_id, count(*) n_customers from customers group by member_id)
  join (select member_id, count(*) n_delinq from delinq group by member_id) using (member_id)
  join (select member_id, count(*) n_detail from detail group by member_id) using (member_id)
  join (select member_id, cast(count(*) as decimal(38,0)) n_pairs from all_pairs group by member_id) using (member_id)"""


def _classes(kind: str, letter: str) -> str:
    """Rows of the plain join and rows of the table, by the values of one of its tables."""
    columns = _CLASS_COLUMNS[kind]
    names = ", ".join(columns.split())
    return f"""select x.class_id, {", ".join(f"x.{c}" for c in columns.split())}, n_members, n_copies, n_rows
      from (select {_class_id(letter, columns)} class_id, {", ".join(f"{letter}.{c}" for c in columns.split())},
                   cast(count(*) as decimal(38,0)) n_rows from {_FIVE} group by all) x
      join (select {_class_id(kind, columns)} class_id, count(distinct member_id) n_members, count(*) n_copies from {kind}
            where member_id in (select c.member_id from {_FIVE}) group by {names}) y on x.class_id = y.class_id"""


def _membership() -> str:
    return " union all ".join(
        f"""select '{kind}' kind, member_id, {_class_id(kind, columns)} class_id, count(*) copies from {kind}
            where member_id in (select c.member_id from {_FIVE}) group by member_id, class_id"""
        for kind, columns in _CLASS_COLUMNS.items())


_COUNTED_GRADES = """
  select member_id, payment_history_pts, loan_default_history_pts, financial_health_pts, loan_total_score,
         loan_grade, cast(count(*) as decimal(38,0)) n_rows
  from grades group by all"""


def _skewed(sql: str) -> str:
    """The same over applications of which a third carry the person and the history of one."""
    loan = ["id", "loan_amnt", "funded_amnt", "term", "int_rate", "installment", "issue_d", "loan_status", "purpose", "title",
            "total_rec_prncp", "total_rec_int", "total_rec_late_fee", "total_pymnt", "last_pymnt_amnt", "last_pymnt_d",
            "next_pymnt_d"]
    own = ", ".join(f"a.{c} as {c}" for c in loan)
    skewed = f"""applications as (
      select p.* replace ({own}) from given a join given p on p.id = case when cast(a.id as bigint) % 3 = 0 then (
        select cast(min(cast(id as bigint)) as varchar) from given where annual_inc is not null and delinq_2yrs between 1 and 7)
        else a.id end"""
    at = sql.index("keyed as (")
    before = sql[:at].rstrip().removesuffix(",").replace("applications as (", "given as (", 1)
    return f"{before}, {skewed}),\n{sql[at:]}"


def _one_id(sql: str) -> str:
    """The same over applications of which a third carry one id."""
    at = sql.index("keyed as (")
    before = sql[:at].rstrip().removesuffix(",").replace("applications as (", "given as (", 1)
    one = "select * replace (case when cast(id as bigint) % 3 = 0 then 'n/a' else id end as id) from given"
    return f"{before}, applications as ({one}),\n{sql[at:]}"


def _many_ids(sql: str) -> str:
    """The same over applications of which four share an id, and a fiftieth one."""
    at = sql.index("keyed as (")
    before = sql[:at].rstrip().removesuffix(",").replace("applications as (", "given as (", 1)
    one = """select * replace (case when cast(id as bigint) % 50 = 0 then 'n/a'
      else cast(cast(id as bigint) - cast(id as bigint) % 4 as varchar) end as id) from given"""
    return f"{before}, applications as ({one}),\n{sql[at:]}"


def _hostile(column: str, line_end: str = "") -> str:
    text = ', "quoted", ""twice"" \\ 007 ' + line_end + "end"
    return f"case when {column} like '%3' then '' else {column} || '{text}' end"


def oracle_sql() -> dict[str, str]:
    _expanded = f"select {_WIDE_COLUMNS}, cast(count(*) as decimal(38,0)) n_rows from {_FIVE} group by all"
    default_history = "cast((delinq_pts + public_record_pts + public_bankruptcies_pts + enq_pts) * 0.45 as decimal(13,2))"
    return {
        "csv_inferred_scan": _query(f"select * replace ({_hostile('title')} as title) from applications"),
        "csv_declared_scan": _query(
            f"select * replace ({_hostile('loan_title', chr(10))} as loan_title) from landed_loans"),
        "csv_by_header_scan": _query(f"select * replace ({_hostile('loan_title')} as loan_title) from landed_loans"),
        "csv_bad_cells": _query("""
          select id loan_id, 'loan_amount' column_name, 'twelve' cell from applications where cast(id as bigint) % 10 = 3
          union all select id, 'monthly_installment', 'n/a' from applications where term is null and cast(id as bigint) % 25 <> 8
          union all select id, '_record', id || ',' ||
              case when cast(id as bigint) % 10 = 3 then 'twelve' else cast(loan_amnt as varchar) end ||
              case when cast(id as bigint) % 25 = 7
                   then ',' || case when term is null then 'n/a' else cast(installment as varchar) end || ',left over' else '' end
            from applications where cast(id as bigint) % 25 in (7, 8)"""),
        "csv_good_cells": _query("""
          select id loan_id, case when cast(id as bigint) % 10 <> 3 then loan_amnt end loan_amount,
                 case when term is not null and cast(id as bigint) % 25 <> 8 then installment end monthly_installment
          from applications"""),
        "scores_of_years": _scored(_BY_YEAR + " where issue_year in (2010, 2011)"),
        "scores_year_replaced": "select * from (" + _scored(_BY_YEAR + " where issue_year <> 2010") + ") union all select * from ("
                                + _scored(_BY_YEAR + " where issue_year = 2010", numbers=CUSTOM_NUMBERS) + ")",
        "payment_base_bucketed": _query("select * from base"),
        "member_points_bucketed": _scored(_MEMBER_POINTS),
        "published_generation": _query("select * from landed_customers"),
        "csv_permissive": _query(
            "select id loan_id, case when term is not null then installment end monthly_installment from applications"),
        "csv_sink_roundtrip": _query(f"select * replace ({_hostile('loan_title')} as loan_title) from loans"),
        "medallion_literal": _scored(_COUNTED_GRADES, profile="literal"),
        "medallion_layout": _scored("""
          select 'bronze' layer, 'customers' entity, count(*) n_rows from landed_customers
          union all select 'bronze', 'loans', count(*) from landed_loans
          union all select 'bronze', 'loans_repayments', count(*) from landed_repayments
          union all select 'bronze', 'loans_defaulters', count(*) from landed_defaulters
          union all select 'silver', 'customers', count(*) from customers
          union all select 'silver', 'loans', count(*) from loans
          union all select 'silver', 'loans_repayments', count(*) from repayments
          union all select 'silver', 'loans_defaulters', count(*) from defaulters
          union all select 'silver', 'loans_defaulters_delinq', count(*) from delinq
          union all select 'silver', 'loans_defaulters_records_enq', count(*) from records_enq
          union all select 'silver', 'loans_defaulters_detail_records_enq', count(*) from detail
          union all select 'gold', 'customers', count(*) from good_customers
          union all select 'gold', 'loans_defaulters', count(*) from defaulters
            where member_id not in (select member_id from bad)
          union all select 'gold', 'loans_defaulters_delinq', count(*) from good_delinq
          union all select 'gold', 'loans_defaulters_detail_records_enq', count(*) from good_detail
          union all select 'gold', 'total_files', count(*) from good_customers c
            join loans l on l.member_id = c.member_id join repayments r on r.loan_id = l.loan_id
            join good_delinq q on q.member_id = c.member_id join good_detail t on t.member_id = c.member_id
          union all select 'gold', 'loan_scores', count(*) from grades
          union all select 'silver', 'total_files_counted', count(*) from loans l join repayments using (loan_id)
            where l.member_id in (select member_id from customers) and l.member_id in (select member_id from delinq)
              and l.member_id in (select member_id from detail)
          union all select 'quarantine', 'dropped_rows', count(*) from dropped
          union all select 'quarantine', 'bad_cells', 0
          union all select 'quarantine', 'shared_ids', 0
          union all select 'silver', 'wide_totals', count(*) from (""" + _TOTALS + """)
          union all select 'silver', 'wide_membership', count(*) from (""" + _membership() + f""")
          union all select 'silver', 'wide_customers_classes', count(*) from ({_classes("customers", "c")})
          union all select 'silver', 'wide_delinq_classes', count(*) from ({_classes("delinq", "q")})
          union all select 'silver', 'wide_detail_classes', count(*) from ({_classes("detail", "t")})
          union all select 'quarantine', 'repeated_loans', count(*) from repeated
          union all select 'quarantine', 'bad_data', count(*) from bad"""),
        "catalog_scan": _query("select * from customers"),
        "view_scan": _scored(f"select {_RESULT} from grades"),
        "preview_top10": _query("select * from applications order by id limit 10"),
        "member_id_hash": _query("select id, member_id from keyed"),
        "split_customers": _query("select * from landed_customers"),
        "split_loans": _query("select * from landed_loans"),
        "split_repayments": _query("select * from landed_repayments"),
        "split_defaulters": _query("select * from landed_defaulters"),
        "add_ingest_date": _query(
            "select distinct *, '2024-01-31 12:00:00' ingest_date from landed_defaulters"),
        "dedupe_rows": _query("select distinct * from landed_customers"),
        "fill_mean_emp_length": _query("select emp_length, count(*) n_rows from customers group by emp_length"),
        "clean_customers": _query("select * from customers"),
        "clean_loans": _query("select * from loans"),
        "clean_repayments": _query("select * from repayments"),
        "clean_defaulters": _query("select * from defaulters"),
        "defaulters_delinq": _query("select * from delinq"),
        "defaulters_records_enq": _query("select * from records_enq"),
        "defaulters_detail": _query("select * from detail"),
        "dup_members_customers": _query("select * from dup_customers"),
        "dup_members_delinq": _query("select * from dup_delinq"),
        "dup_members_detail": _query("select * from dup_detail"),
        "dup_members_ranked": _query("select * from dup_detail order by total desc, member_id"),
        "bad_members": _query("select * from bad"),
        "bad_members_union": _query("select * from bad"),
        "exclude_customers": _query("select * from good_customers"),
        "exclude_delinq": _query("select * from good_delinq"),
        "exclude_detail": _query("select * from good_detail"),
        "exclude_not_in": _query("select * from base where not member_id in (select member_id from bad)"),
        "join_wide": _query("""select j.*, x.n n_customers, y.n n_delinq, z.n n_detail from (
              select l.*, r.* exclude (loan_id), cast(count(*) as decimal(38,0)) n_rows from customers c
              join single_loans l on l.member_id = c.member_id join single_repayments r on r.loan_id = l.loan_id
              join delinq q on q.member_id = c.member_id join detail t on t.member_id = c.member_id group by all) j
            join (select member_id, count(*) n from customers group by member_id) x using (member_id)
            join (select member_id, count(*) n from delinq group by member_id) y using (member_id)
            join (select member_id, count(*) n from detail group by member_id) z using (member_id)"""),
        "join_wide_clean": _query(f"""select {_WIDE_COLUMNS} from good_customers c
            join single_loans l on l.member_id = c.member_id join single_repayments r on r.loan_id = l.loan_id
            join good_delinq q on q.member_id = c.member_id join good_detail t on t.member_id = c.member_id"""),
        "join_wide_expanded": _query(_expanded),
        "join_wide_expanded_repeated": _many_ids(_query(_expanded)),
        "wide_customers_classes": _query(_classes("customers", "c")),
        "wide_delinq_classes": _query(_classes("delinq", "q")),
        "wide_detail_classes": _query(_classes("detail", "t")),
        "wide_membership": _query(_membership()),
        "wide_totals": _query(_TOTALS),
        "exclude_not_in_nulls": _query("""
          select 'with_null' list, * from repayments where next_payment_date not in (
            select next_payment_date from repayments where total_principal_received in (100, 200))
          union all select 'known', * from repayments where next_payment_date not in (
            select next_payment_date from repayments where total_principal_received = 200)
          union all select 'empty', * from repayments where next_payment_date not in (
            select next_payment_date from repayments where total_principal_received < 0)"""),
        "shared_person_ids": _query(f"""
          select member_id, count(distinct person) n_persons from (
            select sha256(concat_ws('||', {_KEY})) member_id, ({_KEY}) person from (
              select * replace (case when cast(id as bigint) % 5 = 0 and emp_title is null then emp_length else emp_title end as emp_title,
                                case when not (cast(id as bigint) % 5 = 0 and emp_title is null) then emp_length end as emp_length)
              from applications)) group by member_id having n_persons > 1"""),
        "payment_base_repeated": _many_ids(_query("select *, cast(count(*) as decimal(38,0)) n_pairs from all_pairs group by all")),
        "payment_pairs_repeated": _many_ids(_scored(f"""
          select member_id, {PAYMENT}, cast(count(*) as decimal(38,0)) n_payments
          from (select * from paid_all) group by all""", profile="literal")),
        "loan_grade_literal_repeated": _many_ids(_scored(_COUNTED_GRADES, profile="literal")),
        "payment_base": _query("select * from base"),
        "score_last_payment": _scored(_PAYMENTS.format("last_payment_pts")),
        "score_total_payment": _scored(_PAYMENTS.format("total_payment_received_pts")),
        "score_payment_history": _scored(_PAYMENTS.format(
            PAYMENT + ", cast((last_payment_pts + total_payment_received_pts) * 0.20 as decimal(13,2)) payment_history_pts")),
        "score_delinq": _scored(_HISTORY.format("delinq_pts")),
        "score_public_record": _scored(_HISTORY.format("public_record_pts")),
        "score_bankruptcies": _scored(_HISTORY.format("public_bankruptcies_pts")),
        "score_enquiries": _scored(_HISTORY.format("enq_pts")),
        "score_default_history": _scored(
            f"select member_id, loan_id, {PAYMENT}, {HISTORY}, {default_history} loan_default_history_pts from history"),
        "score_loan_status": _scored(_POINTS.format("loan_status_pts")),
        "score_home": _scored(_POINTS.format("home_pts")),
        "score_funded_amount": _scored(_POINTS.format("funded_amt_pts")),
        "score_grade_pts": _scored(_POINTS.format("grade_pts")),
        "score_financial_health": _scored(
            f"select member_id, loan_id, {HEALTH}, financial_health_pts from totals"),
        "loan_total_score": _scored(
            "select member_id, loan_id, payment_history_pts, loan_default_history_pts, financial_health_pts, "
            "loan_total_score from totals"),
        "loan_grade": _scored(f"select {_RESULT} from grades"),
        "loan_grade_from_wide": _scored(f"select {_RESULT} from grades"),
        "loan_grade_literal": _scored(_COUNTED_GRADES, profile="literal"),
        "loan_grade_incl_clean": _scored(f"select {_RESULT} from grades", clean_members=True),
        "grade_distribution": _scored("select loan_grade, count(*) loans from grades group by loan_grade"),
        "score_custom_params": _scored(f"select {_RESULT} from grades", numbers=CUSTOM_NUMBERS),
        "score_from_conf": _scored(f"select {_RESULT} from grades", numbers=CUSTOM_NUMBERS),
        "dropped_rows": _query("select * from dropped"),
        "dropped_rows_observed": _query("select * from dropped"),
        "payment_base_one_id": _one_id(_query("select * from base")),
        "repeated_loans": _one_id(_query("select * from repeated")),
        "loan_grade_skewed": _skewed(_scored(f"select {_RESULT} from grades")),
    }
