"""The wide table of applications: read from files, or derived from orders and customers.

The derived one stands in where no application file exists: one application per order, one person per
customer. Its text is one query that runs unchanged in Spark SQL and DuckDB; `{orders}` and `{customer}`
name its inputs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from gradewell.schemas import WIDE
from gradewell.sources import files

APPLICATIONS_SQL = """
with b as (select o_orderkey k, c_custkey u, c_mktsegment seg, c_nationkey n, cast(c_acctbal as decimal(12,2)) bal
           from {orders} join {customer} on o_custkey = c_custkey)
select cast(k as string) id,
 case when u%11 <> 0 then seg end emp_title,
 case u%13 when 0 then null when 1 then 'n/a' when 2 then '< 1 year' when 3 then '1 year' when 12 then '10+ years' else cast(u%13-2 as string)||' years' end emp_length,
 case u%6 when 0 then 'OWN' when 1 then 'RENT' when 2 then 'MORTGAGE' when 3 then 'ANY' when 4 then 'OTHER' end home_ownership,
 case when bal >= 0 then cast(bal*10 as decimal(12,2)) end annual_inc,
 case when u%17=0 then 'Unknown' else 'S'||cast(n%10 as string) end addr_state,
 lpad(cast(u%1000 as string),3,'0')||'xx' zip_code,
 substr('ABCDEFG',cast(u%7+1 as int),1) grade,
 substr('ABCDEFG',cast(u%7+1 as int),1)||cast(u%5+1 as string) sub_grade,
 case u%3 when 0 then 'Verified' when 1 then 'Source Verified' else 'Not Verified' end verification_status,
 cast(10000*(1+u%10) + case when u%10=0 then (k%2)*5000 else 0 end as decimal(12,2)) tot_hi_cred_lim,
 case when u%19=0 then 'Joint App' else 'Individual' end application_type,
 case when u%19=0 and bal>=0 then cast(bal*15 as decimal(12,2)) end annual_inc_joint,
 case when u%19=0 then 'Verified' end verification_status_joint,
 cast(1000*(1+k%40) as decimal(12,2)) loan_amnt,
 cast(1000*(1+k%40) as decimal(12,2)) funded_amnt,
 case when k%97=0 then null when k%2=0 then ' 36 months' else ' 60 months' end term,
 cast(5+k%20 as decimal(6,2)) int_rate,
 cast(100*(1+k%5) as decimal(12,2)) installment,
 'Jan-'||cast(2007+k%12 as string) issue_d,
 case k%8 when 0 then 'Fully Paid' when 1 then 'Current' when 2 then 'In Grace Period' when 3 then 'Late (16-30 days)' when 4 then 'Late (31-120 days)' when 5 then 'Charged Off' when 6 then 'Default' else 'Does not meet the credit policy. Status:Fully Paid' end loan_status,
 case k%9 when 0 then 'car' when 1 then 'credit_card' when 2 then 'house' when 3 then 'wedding' when 4 then 'yacht' when 5 then 'other' when 6 then 'medical' when 7 then 'moving' else 'debt_consolidation' end purpose,
 'loan '||cast(k%9 as string) title,
 cast(100*(k%30) as decimal(12,2)) total_rec_prncp,
 cast(10*(k%30) as decimal(12,2)) total_rec_int,
 cast(case when u%4=0 then k%3 else 0 end as decimal(12,2)) total_rec_late_fee,
 cast(case when k%10=0 then 0 else 110*(k%30) end as decimal(12,2)) total_pymnt,
 case when k%101=0 then null else cast(100*(1+k%5)*(case k%7 when 0 then 0 when 1 then 1.25 when 2 then 0.5 when 3 then 0.75 when 4 then 1 when 5 then 1.5 else 2 end) as decimal(12,2)) end last_pymnt_amnt,
 case when k%12=0 then '0.0' else 'Mar-'||cast(2008+k%12 as string) end last_pymnt_d,
 case when k%6=0 then '0.0' when k%6=1 then null else 'Apr-'||cast(2008+k%12 as string) end next_pymnt_d,
 cast(case when u%9=8 then null else u%9 + case when u%23=0 then k%2 else 0 end end as decimal(6,1)) delinq_2yrs,
 cast((u%9)*100 as decimal(12,2)) delinq_amnt,
 cast(case when u%14<8 then u%14 end as decimal(6,1)) pub_rec,
 cast(case when u%15<8 then u%15 end as decimal(6,1)) pub_rec_bankruptcies,
 cast(case when u%16<8 then u%16 end as decimal(6,1)) inq_last_6mths,
 cast(case when u%5=0 then null else u%50 end as decimal(6,1)) mths_since_last_delinq,
 cast(case when u%5=1 then null else u%60 end as decimal(6,1)) mths_since_last_record
from b
"""


def applications(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(
        APPLICATIONS_SQL,
        orders=spark.read.parquet(f"{sf_dir}/orders.parquet"),
        customer=spark.read.parquet(f"{sf_dir}/customer.parquet"),
    )


#: Under which name the quarantine lists records of too many or too few cells.
RECORD = "_record"


def read_applications(spark: SparkSession, path: str, fmt: str = "csv", multi_line: bool = False,
                      null_mark: str = "", keep_bad_cells: bool = False) -> DataFrame:
    """Applications from wide files with any number of further columns, brought to the declared types by name.

    CSV is read as text, so no pass infers types and the person key does not depend on what was inferred. Files may have
    their columns in different orders: each is read by its own header, and one without a declared column is refused. Quoted
    texts may hold commas and doubled quotes; for line ends set `multi_line`, which makes each file one task. A number that
    does not parse becomes NULL and its row is kept; `keep_bad_cells` keeps its text beside the row, in files.BAD_CELLS, for
    a run to write to its quarantine.
    """
    if fmt == "csv":
        record = RECORD if keep_bad_cells else None
        raw = files.read_csv_by_header(spark, path, WIDE.fieldNames(), null_mark, multi_line, record)
    else:
        raw, record = spark.read.format(fmt).load(path), None
    if not keep_bad_cells:
        return raw.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in WIDE])
    return files.typed(raw, WIDE, record)
