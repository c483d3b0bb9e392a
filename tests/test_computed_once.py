"""Expressions over texts stand in a plan once, and made pages are dealt to all cores."""

import random
import re

from pyspark.sql import functions as F

from leadloom.functions.references import REFERENCE, once
from leadloom.operators import harvest
from leadloom.plans import derived_pages

SF = "/root/testdata/sf0.001"


def times(df, piece):
    return df._jdf.queryExecution().optimizedPlan().toString().count(piece)


def test_a_filter_over_a_computed_column_does_not_copy_it(spark):
    df = once(spark.createDataFrame([("a b",), (None,)], "t string"), u=F.regexp_replace("t", "a", "x")).where("u like 'x%' and length(u) > 1").select(F.concat("u", "u").alias("v"))
    assert times(df, "regexp_replace") == 1 and [r["v"] for r in df.collect()] == ["x bx b"]


def test_references_of_a_page_are_read_once_for_source_and_text(spark):
    out = harvest.harvest_contacts(spark.createDataFrame([(1, "<p>a@aoi.fi</p>")], "k int, html string"), ["k"])
    assert times(out, REFERENCE) == 4  # the gaps and the references of the source, and of the text


def test_made_pages_are_dealt_to_all_cores(spark):
    assert derived_pages.page_rows(spark, SF).rdd.getNumPartitions() >= 4


def test_spelt_addresses_are_extracted_once(spark):
    plan = harvest.harvest_contacts(spark.createDataFrame([(1, "a@aoi.fi")], "k int, html string"), ["k"])._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"regexp_extract_all\([^,]*, " + re.escape(harvest.fixed.SPELT_EMAIL), plan)) == 1


def test_spelt_addresses_are_those_of_the_pattern(spark):
    """Against Python's regular expressions, on texts of all the pieces of such addresses."""
    rng, pieces = random.Random(14), ["anna", "at", "ät", "AT", "miuku", "[at]", "( @ )", "@", "aoi", "fi", ".", "dot", "[dot]", "(piste)", "punkt", "{.}", " ", " ", "\n", "-", "x.y", "9", "é"]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randint(3, 14))) for _ in range(3000)]
    rows = spark.createDataFrame(list(enumerate(texts)), "k int, t string")
    got = rows.select("k", F.filter(harvest._found(F.col("t"), F.col("t")), lambda h: h["channel"] == "obfuscated").alias("h")).collect()
    plain = re.compile(f"^(?:{harvest.fixed.EMAIL})$")
    want = {k: [m[0] for m in re.finditer(harvest.fixed.SPELT_EMAIL, t) if not plain.match(m[0].strip(" "))] for k, t in enumerate(texts)}
    assert {r["k"]: [h["raw"] for h in r["h"]] for r in got} == want and sum(map(len, want.values())) > 50
