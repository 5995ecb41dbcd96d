"""Identities of authors and committers, unified by name key and address."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as fn
from .components import connected_components
from .ordering import numbered

FIELDS = ["name", "name_key", "email", "lcemail", "userid", "domain"]


def identities(commits: DataFrame) -> DataFrame:
    """Each exact identity (all six fields) with its commits as author, as committer and in all."""
    roles = F.explode(F.array(*[F.struct(F.col(n).alias("name"), F.col(e).alias("email"), F.lit(r).alias("role")) for n, e, r in (("autname", "autemail", "a"), ("comname", "comemail", "c"))]))
    # rows fall together before the accents of a name are looked at
    g = commits.select(roles.alias("r")).groupBy("r.name", "r.email").agg(F.count_if(F.col("r.role") == "a").alias("authored"), F.count_if(F.col("r.role") == "c").alias("committed"))
    g = g.withColumn("name_key", fn.name_key(F.col("name"), F.col("email"))).withColumn("e", fn.email_parts(F.col("email")))
    return g.select("name", "name_key", "email", "e.lcemail", "e.userid", "e.domain", "authored", "committed", (F.col("authored") + F.col("committed")).alias("total"))


def name_groups(ids: DataFrame) -> DataFrame:
    return ids.groupBy("name_key").agg(F.count(F.lit(1)).alias("identities"))


def unified(ids: DataFrame) -> DataFrame:
    """Adds personid: names that share an address, over any number of steps, are one person, who is called by the key
    with most identities (of equals, the first)."""
    edges = ids.select(F.concat(F.lit("n:"), "name_key").alias("u"), F.concat(F.lit("e:"), "lcemail").alias("v")).distinct()
    parts = connected_components(edges).filter(F.col("node").startswith("n:")).select(F.substring("node", 3, 1 << 30).alias("k"), "component")
    placed = ids.join(parts, ids.name_key == parts.k).drop("k")
    keys = placed.groupBy("component", "name_key").agg(F.count(F.lit(1)).alias("n"))
    best = keys.groupBy("component").agg(F.min_by("name_key", F.struct(-F.col("n"), "name_key")).alias("personid"))
    return placed.join(best, "component").drop("component")


def emails_table(unified_ids: DataFrame, zone: str | None = None) -> DataFrame:
    """The emails table: recordid runs over persons in order and, within one, from most to fewest commits. Rows are
    numbered in ranges of that order. dateadded is the present time, in the session's zone or another."""
    rows = numbered(unified_ids, ["personid", F.desc("total"), F.desc("authored"), "name", "email"], "recordid")
    now = F.current_timestamp() if zone is None else F.convert_timezone(F.lit(zone), F.to_timestamp_ntz(F.current_timestamp()))
    return rows.select(F.col("recordid").cast("int"), "personid", fn.full_email(F.col("name"), F.col("email")).alias("fullemail"), F.col("email").alias("emailaddr"), F.col("name").alias("emailname"), "lcemail", "userid", "domain", F.col("authored").cast("int").alias("autcount"), F.col("committed").cast("int").alias("comcount"), F.date_format(now, "yyyy-MM-dd HH:mm:ss").alias("dateadded"), F.lit(False).alias("checked"), F.lit(None).cast("string").alias("notes"))


def identities_sheet(unified_ids: DataFrame) -> DataFrame:
    """The rows of the identity spreadsheet's first sheet, persons in order, most used identities first."""
    rows = numbered(unified_ids, ["personid", F.desc("total"), F.desc("authored"), "name", "email"], "row")
    return rows.select("row", "personid", "name", "email", "lcemail", "userid", "domain", "total", "authored", "committed")


def stats_sheet(unified_ids: DataFrame) -> DataFrame:
    """The rows of its second sheet: a person's totals and the name that the most used identity prefers."""
    return numbered(person_totals(unified_ids).join(persons_table(unified_ids, fill=True), "personid"), ["personid"], "row").select("row", "personid", "personname", "identities", "total", "authored", "committed")


def persons_table(unified_ids: DataFrame, fill: bool = False) -> DataFrame:
    """Distinct persons. The reference behaviour leaves personname null; fill gives the most used identity's name."""
    if not fill:
        return unified_ids.select("personid").distinct().withColumn("personname", F.lit(None).cast("string"))
    best = F.struct(-F.col("total"), -F.col("authored"), "name", "email")
    return unified_ids.groupBy("personid").agg(F.min_by(fn.preferred_name(F.col("name"), F.col("email")), best).alias("personname"))


def person_totals(unified_ids: DataFrame) -> DataFrame:
    return unified_ids.groupBy("personid").agg(F.count(F.lit(1)).alias("identities"), F.sum("total").alias("total"), F.sum("authored").alias("authored"), F.sum("committed").alias("committed"))
