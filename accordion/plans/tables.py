"""The engine's inputs as projections of the star-schema tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from accordion.plans.policy import Policy, lookup

AS_OF = date(2001, 8, 2)
POLICY = Policy(as_of=AS_OF)
FIELDS = ["phone", "address", "specialty", "active", "practice_name"]
CLASSES = {"1-URGENT": "gov_self_reported", "2-HIGH": "gov_claims", "3-MEDIUM": "practice_web", "4-NOT SPECIFIED": "regulatory_board", "5-LOW": "geocoder"}


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def field_of(key):
    return F.get(F.array(*map(F.lit, FIELDS)), F.pmod(key, F.lit(len(FIELDS))).cast("int"))


def assertions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An order asserts its status for a field of its customer's record; the priority is
    the kind of source and the order date its age."""
    o = read(spark, sf_dir, "orders")
    return o.select(
        F.col("o_custkey").cast("string").alias("provider_id"),
        field_of(F.col("o_orderkey")).alias("field"),
        F.col("o_orderstatus").alias("value"),
        F.concat(F.lit("raw "), F.col("o_orderstatus")).alias("raw_value"),
        F.lower("o_orderpriority").alias("source_name"),
        F.col("o_orderpriority").alias("source_label"),
        F.coalesce(lookup(CLASSES, F.col("o_orderpriority")), F.lit("geocoder")).alias("source_class"),
        F.lit(None).cast("string").alias("url"),
        F.when(F.pmod(F.col("o_orderkey"), F.lit(7)) != 0, F.to_date("o_orderdate")).alias("data_as_of"),
        F.lit(None).cast("string").alias("snapshot_hash"),
        F.col("o_orderkey").alias("_src_ord"),
    )


ASSERTIONS = """a as (select cast(o_custkey as varchar) as provider_id,
    ['phone', 'address', 'specialty', 'active', 'practice_name'][cast(o_orderkey % 5 + 1 as int)] as field,
    o_orderstatus as value, 'raw ' || o_orderstatus as raw_value, o_orderpriority as source_label,
    case o_orderpriority when '1-URGENT' then 'gov_self_reported' when '2-HIGH' then 'gov_claims' when '3-MEDIUM' then 'practice_web'
        when '4-NOT SPECIFIED' then 'regulatory_board' else 'geocoder' end as source_class,
    case when o_orderkey % 7 <> 0 then cast(o_orderdate as date) end as data_as_of, o_orderkey as _src_ord from orders)"""


def current(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the directory holds for each customer and field (null for one in four)."""
    c = read(spark, sf_dir, "customer")
    rows = c.select(F.col("c_custkey"), F.explode(F.sequence(F.lit(0), F.lit(len(FIELDS) - 1))).alias("_field_ord"))
    held = F.pmod(F.col("c_custkey") + F.col("_field_ord"), F.lit(4)).cast("int")
    cur = F.get(F.array(F.lit("F"), F.lit("O"), F.lit("P")), held)
    return rows.select(F.col("c_custkey").cast("string").alias("provider_id"), F.get(F.array(*map(F.lit, FIELDS)), F.col("_field_ord")).alias("field"), cur.alias("cur"), F.concat(F.lit("raw "), cur).alias("raw_cur"))


CURRENT = """cur as (select cast(c_custkey as varchar) as provider_id, ['phone', 'address', 'specialty', 'active', 'practice_name'][i + 1] as field,
    ['F', 'O', 'P'][cast((c_custkey + i) % 4 + 1 as int)] as cur, 'raw ' || ['F', 'O', 'P'][cast((c_custkey + i) % 4 + 1 as int)] as raw_cur
    from customer, (select unnest([0, 1, 2, 3, 4]) as i))"""


def directory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as directory records, with names, addresses and phones in several styles."""
    c = read(spark, sf_dir, "customer").join(F.broadcast(read(spark, sf_dir, "nation")), F.col("c_nationkey") == F.col("n_nationkey"))
    k = F.col("c_custkey")
    num = k.cast("string")
    firsts, lasts = ["Jane", "John", "Mary", "Omar", "Li", "Ana", "Raj"], ["Smith", "Smyth", "Jones", "O'Neil", "Garcia", "Lee", "Robert", "Rupert", "Ashcraft", "Tymczak", "Pfister"]
    at = lambda values, key: F.get(F.array(*map(F.lit, values)), F.pmod(key, F.lit(len(values))).cast("int"))
    f, l = at(firsts, k), at(lasts, F.floor(k / 3))  # noqa: E741
    name = F.get(F.array(F.concat(f, F.lit(" "), l, F.lit(", MD")), F.concat(f, F.lit(" Q. "), l, F.lit(" Ph.D.")), F.concat(f, F.lit(" "), l), l, F.concat(F.lit("Dr "), f, F.lit(" "), l, F.lit(" MD, FACC, M.D."))), F.pmod(k, F.lit(5)).cast("int"))
    street = at(["Main Street", "N. Bay Rd.", "North Gulf Boulevard Suite 4", "Pine Ridge Road, Unit 7", "1st Avenue West"], F.floor(k / 2))
    place = F.concat((k % 97 + 1).cast("string"), F.lit(" "), street, F.lit(", "), F.initcap("n_name"), F.lit(", FL "), (F.floor(k / 40) % 60000 + 30000).cast("string"))
    ten = F.concat(F.lit("239555"), F.lpad((k % 50 + 1000).cast("string"), 4, "0"))
    phone = F.get(F.array(F.concat(F.lit("("), F.substring(ten, 1, 3), F.lit(") "), F.substring(ten, 4, 3), F.lit("-"), F.substring(ten, 7, 4)), F.concat(F.lit("1-"), ten, F.lit(" ext. 12")), F.concat(ten, F.lit("x7")), F.lit("555-12")), F.pmod(k, F.lit(4)).cast("int"))
    return c.select(
        num.alias("provider_id"), name.alias("provider_name"), F.when(k % 6 != 0, F.concat(F.lit("12345"), F.lpad((F.floor(k / 2) % 90000).cast("string"), 5, "0"))).alias("npi"),
        F.concat(F.col("c_name"), F.lit(", Assoc. Group LLC")).alias("practice_name"), place.alias("address"), phone.alias("phone"), F.lower("c_mktsegment").alias("specialty"), (k % 5 != 0).alias("active"),
        F.when(k % 11 != 0, F.date_sub(F.lit(AS_OF), (k * 13 % 3000).cast("int"))).alias("last_verified_date"), k.alias("_ord"),
    )


DIRECTORY = """dir as (select cast(k as varchar) as provider_id,
    [f || ' ' || l || ', MD', f || ' Q. ' || l || ' Ph.D.', f || ' ' || l, l, 'Dr ' || f || ' ' || l || ' MD, FACC, M.D.'][cast(k % 5 + 1 as int)] as provider_name,
    case when k % 6 <> 0 then '12345' || lpad(cast((k // 2) % 90000 as varchar), 5, '0') end as npi,
    c_name || ', Assoc. Group LLC' as practice_name,
    cast(k % 97 + 1 as varchar) || ' ' || ['Main Street', 'N. Bay Rd.', 'North Gulf Boulevard Suite 4', 'Pine Ridge Road, Unit 7', '1st Avenue West'][cast((k // 2) % 5 + 1 as int)]
        || ', ' || upper(substr(n_name, 1, 1)) || lower(substr(n_name, 2)) || ', FL ' || cast((k // 40) % 60000 + 30000 as varchar) as address,
    ['(239) 555-' || lpad(cast(k % 50 + 1000 as varchar), 4, '0'), '1-239555' || lpad(cast(k % 50 + 1000 as varchar), 4, '0') || ' ext. 12',
        '239555' || lpad(cast(k % 50 + 1000 as varchar), 4, '0') || 'x7', '555-12'][cast(k % 4 + 1 as int)] as phone,
    lower(c_mktsegment) as specialty, k % 5 <> 0 as active,
    case when k % 11 <> 0 then date '2001-08-02' - cast(k * 13 % 3000 as int) end as last_verified_date, k as _ord
    from (select *, c_custkey as k, ['Jane', 'John', 'Mary', 'Omar', 'Li', 'Ana', 'Raj'][cast(c_custkey % 7 + 1 as int)] as f,
        ['Smith', 'Smyth', 'Jones', 'O''Neil', 'Garcia', 'Lee', 'Robert', 'Rupert', 'Ashcraft', 'Tymczak', 'Pfister'][cast((c_custkey // 3) % 11 + 1 as int)] as l
        from customer join nation on c_nationkey = n_nationkey))"""
