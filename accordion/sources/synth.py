"""A seeded two-snapshot world with known truth, made without any driver-side loop.

Every draw is a hash of the row number and a salt, so it does not depend on partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from accordion.functions import normalize
from accordion.plans.policy import lookup

# Scenario shares and how often the truth differs from what sources say.
SCENARIOS = [("no_change", 0.50), ("phone", 0.18), ("move", 0.14), ("deactivation", 0.08), ("conflict", 0.10)]
NOISE = 0.04
#: The places of the generated world.
CITIES = ["Albany, NY 12207", "Boise, ID 83702", "Dayton, OH 45402", "Eugene, OR 97401", "Macon, GA 31201", "Tucson, AZ 85701", "Tulsa, OK 74103"]
STREETS = ["ELM ST", "RIVER RD", "COLLEGE AVE", "MARKET ST", "CEDAR LN", "HILL DR", "STATION PL"]


def draw(row: Column, salt: str, seed: int) -> Column:
    """A number in [0, 1) that SQL engines agree on."""
    digits = F.substring(F.md5(F.concat_ws(":", row.cast("string"), F.lit(salt), F.lit(str(seed)))), 1, 8)
    return F.conv(digits, 16, 10).cast("long") / F.lit(2.0**32)


def pick(row: Column, salt: str, seed: int, values: list[str]) -> Column:
    return F.get(F.array(*map(F.lit, values)), F.floor(draw(row, salt, seed) * len(values)).cast("int"))


def snapshot_world(rows: DataFrame, seed: int = 0) -> DataFrame:
    """From rows (id): provider_id, npi (no two alike), specialty code, scenario, the old and
    the new address and phone, and the ones that turn out true (noise: for one change in
    25 the sources were wrong)."""
    id_ = F.col("id")
    edge, scenario, u = 0.0, None, draw(id_, "scenario", seed)
    for name, share in SCENARIOS[:-1]:
        edge = round(edge + share, 10)
        scenario = F.when(u < edge, name) if scenario is None else scenario.when(u < edge, name)
    scenario = scenario.otherwise(SCENARIOS[-1][0])
    address = lambda s: F.concat(F.floor(draw(id_, f"number{s}", seed) * 9950 + 50).cast("string"), F.lit(" "), pick(id_, f"street{s}", seed, STREETS), F.lit(", "), pick(id_, f"city{s}", seed, CITIES))
    phone = lambda s: F.concat(F.lit("518-555-"), F.floor(draw(id_, f"phone{s}", seed) * 9000 + 1000).cast("string"))
    nine = F.concat(F.lit("1"), F.lpad(F.pmod(id_.cast("long") * 7368787 + seed, F.lit(10**8)).cast("string"), 8, "0"))
    wrong = lambda s: draw(id_, f"noise{s}", seed) < NOISE
    return rows.select(
        F.concat(F.lit("SY_"), id_.cast("string")).alias("provider_id"), normalize.with_check_digit(nine).alias("npi"),
        pick(id_, "specialty", seed, sorted(normalize.SPECIALTY_SEED)).alias("code"), scenario.alias("scenario"),
        address("a").alias("old_address"), phone("a").alias("old_phone"), address("b").alias("new_address"), phone("b").alias("new_phone"),
        F.when(wrong("address"), address("c")).otherwise(address("b")).alias("true_address"), F.when(wrong("phone"), phone("c")).otherwise(phone("b")).alias("true_phone"),
    )


def generate(spark: SparkSession, n: int, seed: int = 0) -> DataFrame:
    return snapshot_world(spark.range(n), seed)


def source_rows(world: DataFrame) -> dict[str, DataFrame]:
    """What the sources hold of a world: directory, registry, claims and web as the readers
    give them, and the truth (provider_id, field, value) with the actions that are right."""
    is_ = lambda *names: F.col("scenario").isin(*names)
    number = F.substring_index("provider_id", "_", -1)
    first, last = F.concat(F.lit("First"), number), F.concat(F.lit("Last"), number)
    label = lookup(normalize.SPECIALTY_SEED, F.col("code"))
    group = F.concat_ws(" ", last, label, F.lit("Group"))
    null = lambda kind="string": F.lit(None).cast(kind)
    directory = world.select("provider_id", F.concat(first, F.lit(" "), last, F.lit(", MD")).alias("provider_name"), "npi", label.alias("specialty"), group.alias("practice_name"), F.col("old_address").alias("address"), F.col("old_phone").alias("phone"), null().alias("website"), F.lit(True).alias("active"), null("date").alias("last_verified_date"), number.cast("long").alias("_ord"))

    def parts(address, street):
        split = F.split(address, ", ")
        return [street(F.get(split, F.lit(0))).alias("address_1"), F.get(split, F.lit(1)).alias("city"), F.substring_index(F.get(split, F.lit(2)), " ", 1).alias("state"), F.substring_index(F.get(split, F.lit(2)), " ", -1).alias("postal_code")]

    new = lambda what, *when: F.when(is_(*when), F.col(f"new_{what}")).otherwise(F.col(f"old_{what}"))
    registry = world.select(
        "npi", F.lit(False).alias("is_organization"), first.alias("first_name"), last.alias("last_name"), F.lit("M.D.").alias("credential"), null().alias("organization_name"),
        F.when(is_("deactivation"), "I").otherwise("A").alias("status"), null("date").alias("data_as_of"), F.col("code").alias("taxonomy_code"), label.alias("taxonomy_desc"),
        *parts(new("address", "move"), F.upper), new("phone", "phone", "move").alias("telephone"), F.concat(first, F.lit(" "), last, F.lit(", M.D.")).alias("display_name"), F.lit(0).cast("long").alias("_ord"),
    )
    claims = world.select("npi", group.alias("practice_name"), *parts(new("address", "move", "conflict"), lambda c: c), new("phone", "phone", "move").alias("phone"), null().alias("last_updated"), F.lit(0).alias("_ord"), null("date").alias("data_as_of"))
    said = F.map_filter(F.create_map(F.lit("address"), F.when(is_("move", "conflict"), F.col("new_address")), F.lit("phone"), F.when(is_("phone", "move"), F.col("new_phone"))), lambda _, v: v.isNotNull())
    source = F.struct(F.lit("practice_web").alias("source_name"), F.lit("Practice Website").alias("source_label"), F.lit("practice_web").alias("source_class"), F.concat(F.lit("https://example.com/"), F.col("provider_id")).alias("url"), F.to_json(said).alias("fields"))
    web = world.where(is_("phone", "move", "conflict")).select("provider_id", F.array(source).alias("sources"))
    one = lambda f, v: F.struct(F.lit(f).alias("field"), v.alias("value"))
    changes = F.array_compact(F.array(
        F.when(is_("phone", "move"), one("phone", F.col("true_phone"))), F.when(is_("move"), one("address", F.col("true_address"))),
        F.when(is_("conflict"), one("address", F.col("new_address"))), F.when(is_("deactivation"), one("active", F.lit("Inactive"))),
    ))
    truth = world.select("provider_id", F.explode(changes).alias("x")).select("provider_id", "x.*")
    action = F.when(is_("phone", "move"), "auto_update").when(is_("deactivation", "conflict"), "human_review").otherwise("no_change")
    return {"directory": directory, "registry": registry, "claims": claims, "web": web, "truth": truth, "expected": world.select("provider_id", action.alias("expected_action"))}
