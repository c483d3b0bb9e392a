"""Reports as tables: fill rates, yields, coverage, acceptance, rollups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The targets of the acceptance report.
TARGETS = (("place_match", 0.90), ("email", 0.85), ("named", 0.40), ("business_id", 0.60), ("deliverable", 0.60))


def fill_rates(df: DataFrame, cols: list[str]) -> DataFrame:
    """(field, filled, total, share): values that are neither null nor empty, in one pass."""
    full = [F.count_if(F.col(c).isNotNull() & (F.col(c).cast("string") != "")).alias(c) for c in cols]
    one = df.agg(F.count("*").alias("total"), *full)
    rows = one.select("total", F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).alias("filled")) for c in cols])).alias("x"))
    return rows.select("x.field", "x.filled", "total", F.round(F.col("x.filled") / F.nullif("total", F.lit(0)), 4).alias("share"))


def yield_by_source(contacts: DataFrame) -> DataFrame:
    return contacts.groupBy("source").agg(F.count("*").alias("n"), F.count("email").alias("with_email"), F.count("contact_name").alias("with_name"))


def coverage_report(venues: DataFrame, places: DataFrame, sites: DataFrame, contacts: DataFrame) -> DataFrame:
    """(measure, n): countries, phones, addresses, sites, crawled sites, venues with any address and with a named one."""
    rows = venues.join(places.select("venue_id", "international_phone"), "venue_id", "left")
    a = rows.groupBy(F.concat(F.lit("country:"), F.coalesce("country", F.lit("none"))).alias("measure")).agg(F.count("*").alias("n"))
    b = rows.agg(F.count(F.coalesce("international_phone", "phone")).alias("phone"), F.count("street_address").alias("address"))
    c = sites.agg(F.count("domain").alias("site"), F.count_if(F.col("crawl_status").isNotNull()).alias("crawled"))
    d = contacts.agg(F.count_distinct(F.when(F.col("email").isNotNull(), F.col("venue_id"))).alias("any_email"), F.count_distinct(F.when(F.col("email").isNotNull() & F.col("contact_name").isNotNull(), F.col("venue_id"))).alias("named"))
    for one in (b, c, d):
        a = a.unionByName(one.unpivot([], one.columns, "measure", "n"))
    return a


def acceptance(venues: DataFrame, matches: DataFrame, business_ids: DataFrame, contacts: DataFrame) -> DataFrame:
    """(measure, n, of, actual, target, met). Deliverable addresses count against verified ones, or all if none is."""
    total = venues.agg(F.count("*").alias("of"))
    who = lambda test: F.count_distinct(F.when(test, F.col("venue_id")))
    mail = F.col("email").isNotNull()
    c = contacts.agg(who(mail).alias("email"), who(mail & F.col("contact_name").isNotNull()).alias("named"), who(F.col("verification_status") == "deliverable").alias("__d"))
    one = c.crossJoin(matches.agg(who(F.col("accepted")).alias("place_match"))).crossJoin(business_ids.agg(F.count_distinct("venue_id").alias("business_id"))).crossJoin(total)
    one = one.withColumn("deliverable", F.when(F.col("__d") == 0, F.col("email")).otherwise(F.col("__d"))).drop("__d")
    rows = one.select("of", F.explode(F.array(*[F.struct(F.lit(k).alias("measure"), F.col(k).alias("n"), F.lit(t).alias("target")) for k, t in TARGETS])).alias("x")).select("x.measure", "x.n", "of", (F.col("x.n") / F.nullif("of", F.lit(0))).alias("actual"), "x.target")
    return rows.withColumn("met", F.coalesce(F.col("actual") >= F.col("target"), F.lit(False)))


def tier_status_counts(sites: DataFrame) -> DataFrame:
    return sites.groupBy("tier", "crawl_status").agg(F.count("*").alias("n"))


def match_method_counts(matches: DataFrame) -> DataFrame:
    return matches.groupBy("method").agg(F.count("*").alias("n"))


def register_totals(matches: DataFrame, groups: DataFrame) -> DataFrame:
    a = matches.agg(F.count_if(F.col("in_employer_register") == 1).alias("employers"), F.count("exclusion_reason").alias("excluded"))
    return a.crossJoin(groups.agg(F.count("*").alias("groups"), F.coalesce(F.sum("venue_count"), F.lit(0)).alias("venues_in_groups")))


def failure_counts(failures: DataFrame) -> DataFrame:
    return failures.groupBy("phase").agg(F.count("*").alias("n"))


def latest_failures(failures: DataFrame, n: int = 40) -> DataFrame:
    return failures.orderBy(F.desc("at"), F.desc("failure_id")).limit(n)


def domain_rollup(off_domain: DataFrame, top: int = 40) -> DataFrame:
    """Per address domain: rows and venues; beyond the top ones a single row `(others)`."""
    from pyspark.sql import Window

    per = off_domain.groupBy("email_domain").agg(F.count("*").alias("n"), F.count_distinct("venue_id").alias("venues"))
    head = per.orderBy(F.desc("n"), "email_domain").limit(top).withColumn("rank", F.row_number().over(Window.orderBy(F.desc("n"), "email_domain")))
    rest = per.join(head.select("email_domain"), "email_domain", "left_anti").agg(F.sum("n").alias("n"), F.sum("venues").alias("venues")).where("n is not null")
    return head.unionByName(rest.select(F.lit("(others)").alias("email_domain"), "n", "venues", F.lit(top + 1).alias("rank")))


def enrichment_counts(contacts: DataFrame, verdicts: DataFrame, companies: DataFrame, matches: DataFrame) -> DataFrame:
    """(measure, n): contacts per source, names judged and people among them, companies loaded and matched."""
    a = contacts.groupBy(F.concat(F.lit("contacts:"), "source").alias("measure")).agg(F.count("*").alias("n"))
    b = verdicts.agg(F.count("*").alias("judged"), F.count_if(F.col("is_person") == 1).alias("people"))
    c = companies.agg(F.count("*").alias("companies_loaded"))
    d = matches.agg(F.count("business_id").alias("venues_matched"))
    for one in (b, c, d):
        a = a.unionByName(one.unpivot([], one.columns, "measure", "n"))
    return a
