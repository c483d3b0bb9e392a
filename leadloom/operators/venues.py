"""Jobs over venues: countries, work lists, places, tenure, eligibility, scores."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.components import cut
from ..functions.text import EARTH_M, canonical_slug, haversine_m, host_of, normalise_name, number_of, similarity, street_of

#: The weights of the score's parts.
WEIGHTS = {"tenure": 30.0, "review_count": 20.0, "named_contact": 25.0, "verified_email": 10.0, "michelin": 8.0, "review_score": 7.0, "active_offer": 5.0, "employer_register": 5.0}


def resume_filter(todo: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key isn't done yet."""
    return todo.join(done.select(*keys).distinct(), keys, "left_anti")


def pending_status(rows: DataFrame, column: str, retry: tuple[str, ...]) -> DataFrame:
    """Rows without a status, or with one that is tried again."""
    return rows.where(F.col(column).isNull() | F.col(column).isin(*retry))


def assign_country(venues: DataFrame, dim: DataFrame) -> DataFrame:
    """Adds country and country_source from dim(city_slug, country, source): an Estonian slug decides first, then the
    site's city selector, then the seed list; an unknown slug is unmapped, never defaulted."""
    order = F.when(F.col("country") == "EE", 0).when(F.col("source") == "city_selector", 1).otherwise(2)
    best = dim.groupBy(canonical_slug(F.col("city_slug")).alias("__slug")).agg(F.min_by(F.struct("country", "source"), F.struct(order, "source")).alias("__d"))
    rows = venues.drop("country", "country_source").withColumn("__slug", canonical_slug(F.col("city_slug"))).join(best, "__slug", "left")
    return rows.withColumns({"country": F.col("__d.country"), "country_source": F.coalesce("__d.source", F.lit("unmapped"))}).drop("__slug", "__d")


def recountry(venues: DataFrame, dim: DataFrame) -> DataFrame:
    """Countries anew after dim has grown; where one is found, only the `unmapped city slug` part of the review reason
    goes, and the flag stays if anything of it is left."""
    rows = assign_country(venues, dim)
    kept = F.filter(F.transform(F.split(F.coalesce("review_reason", F.lit("")), ";"), lambda p: F.trim(p)), lambda p: (p != "") & ~p.startswith("unmapped city slug"))
    found = F.col("country").isNotNull()
    reason = F.when(found, F.nullif(F.array_join(kept, "; "), F.lit(""))).otherwise(F.col("review_reason"))
    return rows.withColumns({"needs_review": F.when(found, (F.size(kept) > 0).cast("int")).otherwise(F.col("needs_review")), "review_reason": reason})


def slug_inventory(venues: DataFrame, dim: DataFrame) -> DataFrame:
    """Per slug: venues, least URL and name, mapped or not."""
    rows = venues.groupBy("city_slug").agg(F.count("*").alias("n"), F.min("url").alias("example_url"), F.min("name").alias("example_name"))
    return assign_country(rows, dim).withColumn("status", F.when(F.col("country").isNull(), "unmapped").otherwise("mapped"))


def union_sources(*sources: DataFrame) -> DataFrame:
    """Ids of all sources (venue_id, source), with the sources that gave each joined by +."""
    rows = sources[0]
    for s in sources[1:]:
        rows = rows.unionByName(s)
    return rows.groupBy("venue_id").agg(F.array_join(F.sort_array(F.collect_set("source"), asc=False), "+").alias("provenance"))


def seed_sites(matches: DataFrame) -> DataFrame:
    """(venue_id, domain, base_url) of accepted places that aren't closed and have a web URL."""
    rows = matches.where(F.col("accepted") & F.col("website").rlike("(?i)^https?://") & (F.coalesce("business_status", F.lit("")) != "CLOSED_PERMANENTLY"))
    return rows.select("venue_id", host_of(F.col("website")).alias("domain"), F.lower(F.regexp_extract("website", "(?i)^(https?://[^/?#]+)", 1)).alias("base_url")).where("domain <> ''")


def places_queries(venues: DataFrame, country_names: tuple[tuple[str, str], ...] = (("FI", "Finland"), ("EE", "Estonia"))) -> DataFrame:
    """(venue_id, query_no, query): name, street, city and country; then without the street if that differs."""
    land = F.lit(None).cast("string")
    for code, name in country_names:
        land = F.when(F.col("country") == code, F.lit(name)).otherwise(land)
    part = lambda c: F.nullif(F.trim(c), F.lit(""))
    full, short = F.concat_ws(", ", part("name"), part("street_address"), part("city"), land), F.concat_ws(", ", part("name"), part("city"), land)
    return venues.select("venue_id", F.posexplode(F.array_distinct(F.array(full, short))).alias("query_no", "query"))


def place_candidates_score(venues: DataFrame, places: DataFrame, least_similarity: float = 0.8, most_metres: float = 150.0) -> DataFrame:
    """Each venue's candidate places with similarity, distance_m, accepted and method: by name, by distance, or, only
    where the distance is unknown, by street and postcode. places: venue_id, query_no, place (sources.read_api_captures)."""
    rows = places.join(venues.select("venue_id", "name", "lat", "lng", "street_address", "postal_code"), "venue_id")
    rows = rows.withColumns({"__a": normalise_name(F.col("name")), "__b": normalise_name(F.col("place.displayName.text"))}).withColumn("similarity", similarity(F.col("__a"), F.col("__b")))
    metres = haversine_m(F.col("lat"), F.col("lng"), F.col("place.location.latitude"), F.col("place.location.longitude"))
    theirs = F.col("place.formattedAddress")
    post = F.regexp_extract(F.coalesce(theirs, F.lit("")), "\\b([0-9]{5})\\b", 1)
    rows = rows.withColumns({"distance_m": metres, "__s": street_of(F.col("street_address")), "__t": street_of(theirs), "__n": number_of(F.col("street_address")), "__u": number_of(theirs)})
    number = (F.col("__n") == F.col("__u")) | (F.col("__n") == "") | (F.col("__u") == "")
    rows = rows.withColumn("__same", F.col("distance_m").isNull() & (F.col("__s") != "") & (F.col("__t") != "") & (F.coalesce("postal_code", F.lit("")) == post) & number & (similarity(F.col("__s"), F.col("__t")) >= 0.9))
    method = F.concat_ws("+", F.when(F.col("similarity") >= least_similarity, "name"), F.when(F.col("distance_m") <= most_metres, "distance"), F.when(F.col("__same"), "address"))
    return rows.withColumns({"method": F.when(method == "", "none").otherwise(method), "accepted": method != ""}).drop("__a", "__b", "__s", "__t", "__n", "__u", "__same")


def best_place(candidates: DataFrame) -> DataFrame:
    """One candidate a venue: the first query with an accepted one decides, else the last query with any; within it the
    accepted and then the most similar one."""
    rank = Window.partitionBy("venue_id", "query_no").orderBy(F.desc("accepted"), F.desc("similarity"), "place.id")
    tops = candidates.withColumn("n", F.row_number().over(rank)).where("n = 1").drop("n")
    order = F.when(F.col("accepted"), F.struct(F.lit(0).alias("a"), F.col("query_no").alias("b"))).otherwise(F.struct(F.lit(1).alias("a"), (-F.col("query_no")).alias("b")))
    return tops.groupBy("venue_id").agg(F.min_by(F.struct(*[c for c in tops.columns if c != "venue_id"]), order).alias("p")).select("venue_id", "p.*")


def tenure_buckets(venues: DataFrame, key: str = "venue_id", buckets: int = 4) -> DataFrame:
    """Adds tenure_bucket: floor(rank * buckets / n) + 1 of the rank (from 0) by key.

    The rank is found without one task for all rows: keys are range-partitioned, a partition counts its rows, and the
    counts before it (as many as there are partitions) are added to the ranks within it."""
    ordered = venues.withColumn("__key", F.col(key)).repartitionByRange("__key").sortWithinPartitions("__key").withColumn("__p", F.spark_partition_id())
    ordered = cut(ordered)
    counts = ordered.groupBy("__p").agg(F.count("*").alias("c"))
    before = counts.select("__p", (F.sum("c").over(Window.orderBy("__p")) - F.col("c")).alias("__before"), F.sum("c").over(Window.partitionBy()).alias("__n"))
    rank = F.row_number().over(Window.partitionBy("__p").orderBy("__key")) - 1 + F.col("__before")
    bucket = F.least(F.lit(buckets), F.floor(rank * buckets / F.col("__n")) + 1).cast("int")
    return ordered.join(F.broadcast(before), "__p").withColumn("tenure_bucket", bucket).drop("__p", "__key", "__before", "__n")


def outreach_eligible(venues: DataFrame, matches: DataFrame, places: DataFrame) -> DataFrame:
    """Without venues of excluded companies or closed for good; unknown on either side stays."""
    rows = venues.join(matches.select("venue_id", "exclusion_reason", "company_name"), "venue_id", "left").join(places.select("venue_id", "business_status", "international_phone"), "venue_id", "left")
    return rows.where(F.col("exclusion_reason").isNull() & (F.coalesce("business_status", F.lit("")) != "CLOSED_PERMANENTLY"))


def needy_venues(venues: DataFrame, contacts: DataFrame) -> DataFrame:
    """Venues without a contact that has both an address and a name."""
    return venues.join(contacts.where("email is not null and contact_name is not null").select("venue_id"), "venue_id", "left_anti")


def crosscheck_misses(truth: DataFrame, probes: DataFrame) -> DataFrame:
    """Listed ids whose probe is missing or didn't answer 200."""
    return truth.join(probes.select("venue_id", "http_status"), "venue_id", "left").where(F.coalesce("http_status", F.lit(0)) != 200)


def crosscheck_verdict(counts: DataFrame, least: int = 25) -> DataFrame:
    """Adds verdict to (found, misses): too few to tell comes before any miss."""
    return counts.withColumn("verdict", F.when(F.col("found") < least, "INCONCLUSIVE").when(F.col("misses") > 0, "FAIL").otherwise("PASS"))


def coverage_gaps(known: DataFrame, key: str, sample: int | None = None, seed: int = 0) -> DataFrame:
    """Ids from 1 to the largest that aren't known; a repeatable sample of them if asked for."""
    top = known.agg(F.max(key)).first()[0] or 0
    gaps = known.sparkSession.range(1, top + 1).withColumnRenamed("id", key).join(known.select(key), key, "left_anti")
    return gaps if sample is None else gaps.orderBy(F.xxhash64(key, F.lit(seed)), key).limit(sample)


def scored_venues(venues: DataFrame, matches: DataFrame, groups: DataFrame) -> DataFrame:
    rows = venues.join(matches.select("venue_id", "business_id", "in_employer_register"), "venue_id", "left")
    return rows.join(groups.select("business_id", "venue_count"), "business_id", "left")


def max_review_count(venues: DataFrame) -> DataFrame:
    """One row: the most reviews of any venue, 1 if none has any."""
    return venues.agg(F.coalesce(F.nullif(F.max("review_count"), F.lit(0)), F.lit(1)).alias("max_reviews"))


def priority_score(scored: DataFrame, contacts: DataFrame, all_venues: DataFrame) -> DataFrame:
    """(venue_id, priority_score, components, track). A part that is missing or zero is left out of components; reviews
    count against the most of all venues, whatever `scored` is limited to."""
    c = contacts.groupBy("venue_id").agg(F.count_if(F.col("contact_name").isNotNull() & F.col("email").isNotNull()).alias("named"), F.count_if(F.col("verification_status") == "deliverable").alias("verified"))
    rows = scored.join(c, "venue_id", "left").crossJoin(F.broadcast(max_review_count(all_venues)))
    some = lambda x: F.coalesce(F.col(x).cast("double"), F.lit(0.0)) != 0
    parts = {
        "tenure": (some("tenure_bucket"), (5 - F.col("tenure_bucket")) / 4), "review_count": (some("review_count"), F.least(F.lit(1.0), F.col("review_count") / F.col("max_reviews"))),
        "named_contact": (some("named"), F.lit(1.0)), "verified_email": (some("verified"), F.lit(1.0)), "michelin": (some("is_michelin"), F.lit(1.0)),
        "review_score": (some("review_score"), F.least(F.lit(1.0), F.greatest(F.lit(0.0), (F.col("review_score") - 3.0) / 2.0))), "active_offer": (some("has_active_offer"), F.lit(1.0)), "employer_register": (some("in_employer_register"), F.lit(1.0)),
    }
    built = F.map_from_entries(F.filter(F.array(*[F.when(test, F.struct(F.lit(k).alias("key"), (WEIGHTS[k] * share).cast("double").alias("value"))) for k, (test, share) in parts.items()]), lambda x: x.isNotNull()))
    out = rows.withColumn("components", built)
    total = F.aggregate(F.map_values("components"), F.lit(0.0), lambda a, x: a + x)
    return out.select("venue_id", F.round(total, 2).alias("priority_score"), "components", F.when(F.coalesce("venue_count", F.lit(0)) > 1, "enterprise").otherwise("smb").alias("track"))


def top_by_score(scores: DataFrame, k: int = 15) -> DataFrame:
    return scores.orderBy(F.desc("priority_score"), "venue_id").limit(k)


def limit_first_n(rows: DataFrame, key: str, n: int) -> DataFrame:
    return rows.orderBy(key).limit(n)


def audit_sample(verdicts: DataFrame, n: int, seed: int = 0) -> DataFrame:
    """A repeatable sample of names accepted as people."""
    return verdicts.where("is_person = 1").orderBy(F.xxhash64("name_norm", F.lit(seed)), "name_norm").limit(n)


def verification_queue(contacts: DataFrame, id_col: str = "first_seq") -> DataFrame:
    """Addresses without a verdict, guesses first."""
    return contacts.where("email is not null and verification_status is null").orderBy(F.when(F.col("source") == "pattern_guess", 0).otherwise(1), id_col)


def _band_cells(band: Column, size: float, metres: float) -> Column:
    """Into how many equal cells a band of latitude is cut, so that points within the distance, in this band and the next
    ones, are in the same cell or in neighbours; 1 round the poles."""
    edge = F.least((F.greatest(F.abs(band), F.abs(band + 1)) + 1) * size, F.lit(90.0))
    half = F.sin(F.lit(metres / 2 / EARTH_M)) / F.greatest(F.cos(F.radians(edge)), F.lit(1e-12))
    return F.when(half >= 1, F.lit(1)).otherwise(F.greatest(F.floor(F.lit(math.pi) / F.asin(F.least(half * 1.000001, F.lit(1.0)))), F.lit(1))).cast("long")


#: Points of a cell from which on its right rows are dealt into parts, and the most parts: a left row is copied to each
#: part of its cell, so that what is shuffled grows as the points and not as their pairs.
POINTS_A_TASK, MOST_PARTS = 2000, 16
#: Ids of a place in one row.
IDS_A_PLACE = 100


def _near(left: DataFrame, right: DataFrame, metres: float, points_a_task: int, once: bool) -> DataFrame:
    """Pairs of a left row (ids, lat, lng, no) and a right one within a distance, with metres; the right columns are ids2
    and no2. If `once`, both are the same rows, and a pair of them is met in one order alone, a row with itself too.

    Rows meet by cells: bands of latitude as high as the distance, cut into cells of equal longitude that go round the
    earth, so that cells on either side of the 180th meridian are neighbours. A left row is in one cell, a right one is
    sent to the neighbours as well; a pair meets once. Rows without a place, or beyond a pole, take no part."""
    spark = left.sparkSession
    size = math.degrees(metres / EARTH_M) * 1.000001
    fine = lambda df: df.where(F.col("lat").between(-90, 90) & F.col("lng").isNotNull() & ~F.isnan("lng")).withColumn("band", F.floor(F.col("lat") / size).cast("long"))
    cell = lambda lng, n: F.least(F.floor(F.pmod(lng + 180.0, F.lit(360.0)) / 360.0 * n), n - 1).cast("long")
    a = fine(left.select("ids", "lat", "lng", "no"))
    a = a.withColumn("n", _band_cells(F.col("band"), size, metres)).withColumn("cell", cell(F.col("lng"), F.col("n"))).withColumn("width", 360.0 / F.col("n")).drop("n")
    b = fine(right.select(F.col("ids").alias("ids2"), "lat", "lng", F.col("no").alias("no2"))).withColumn("band", F.explode(F.transform(F.sequence(F.lit(-1), F.lit(1)), lambda d: F.col("band") + d)))
    b = b.withColumn("n", _band_cells(F.col("band"), size, metres)).withColumn("own", cell(F.col("lng"), F.col("n")))
    near = F.array_distinct(F.transform(F.sequence(F.lit(-1), F.lit(1)), lambda d: F.pmod(F.col("own") + d, F.col("n"))))
    b = b.select("ids2", F.col("lat").alias("lat2"), F.col("lng").alias("lng2"), "no2", "band", F.explode(near).alias("cell"))
    # a crowded cell is dealt into parts of its right rows, each with all left ones, so no task has it whole
    crowded = a.groupBy("band", "cell").agg(F.sum(F.size("ids")).alias("n")).where(F.col("n") > points_a_task)
    crowded = F.broadcast(crowded.select("band", "cell", F.least(F.ceil(F.col("n") / points_a_task), F.lit(MOST_PARTS)).cast("int").alias("parts")))
    parts = F.coalesce("parts", F.lit(1))
    a = a.join(crowded, ["band", "cell"], "left").withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("parts")
    b = b.join(crowded, ["band", "cell"], "left").withColumn("part", F.pmod(F.xxhash64("no2"), parts).cast("int")).drop("parts")
    # few bytes, but long work: as many tasks whatever the size
    tasks = max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    a, b = (df.repartition(tasks, "band", "cell", "part") for df in (a, b))
    both = a.join(b.hint("merge"), ["band", "cell", "part"])
    both = both.where("no <= no2") if once else both
    both = both.where((F.abs(F.col("lat2") - F.col("lat")) <= size) & (F.abs(F.pmod(F.col("lng2") - F.col("lng") + 180.0, F.lit(360.0)) - 180.0) <= F.col("width")))
    far = haversine_m(F.col("lat"), F.col("lng"), F.col("lat2"), F.col("lng2"))
    # as an array of one, a distance isn't computed once to be compared and again to be returned
    return both.withColumn("metres", F.explode(F.array(far))).where(F.col("metres") <= metres).select("ids", "ids2", "no", "no2", "metres")


def radius_join(left: DataFrame, right: DataFrame, metres: float, points_a_task: int = POINTS_A_TASK) -> DataFrame:
    """(id, id2, metres) of all pairs of a left and a right point within a distance; both: (id, lat, lng)."""
    a, b = (df.select(F.array("id").alias("ids"), "lat", "lng", F.xxhash64("id").alias("no")) for df in (left, right))
    return _near(a, b, metres, points_a_task, False).select(F.col("ids")[0].alias("id"), F.col("ids2")[0].alias("id2"), "metres")


def _by_place(points: DataFrame, ids_a_place: int) -> DataFrame:
    """(ids, lat, lng, no): points of one place together, about so many ids a row; points without an id are left out."""
    placed = points.where(F.col("id").isNotNull() & F.col("lat").isNotNull() & F.col("lng").isNotNull())
    crowded = placed.groupBy("lat", "lng").agg(F.count("*").alias("n")).where(F.col("n") > ids_a_place)
    crowded = crowded.select("lat", "lng", F.ceil(F.col("n") / ids_a_place).cast("int").alias("parts"))
    part = F.pmod(F.xxhash64("id"), F.coalesce("parts", F.lit(1)))
    rows = placed.join(crowded, ["lat", "lng"], "left").groupBy("lat", "lng", part.alias("part")).agg(F.sort_array(F.collect_list("id")).alias("ids"))
    return cut(rows.select("ids", "lat", "lng", F.monotonically_increasing_id().alias("no")))


def haversine_pairs(points: DataFrame, key: str, lat: Column, lng: Column, metres: float, decimals: int | None = None, points_a_task: int = POINTS_A_TASK, ids_a_place: int = IDS_A_PLACE) -> DataFrame:
    """Pairs of points of one table within a distance, each once, the metres rounded if asked for. Points of one place are
    compared as one and come apart after that, so that only the rows returned are as many as the pairs."""
    places = _by_place(points.select(F.col(key).alias("id"), lat.alias("lat"), lng.alias("lng")), ids_a_place)
    pairs = _near(places, places, metres, points_a_task, True)
    pairs = pairs if decimals is None else pairs.withColumn("metres", F.round("metres", decimals))
    pairs = pairs.select(F.explode("ids").alias("u"), "ids2", "no", "no2", "metres").select("u", F.explode("ids2").alias("v"), "no", "no2", "metres")
    pairs = pairs.where("u < v or (no <> no2 and u > v)")
    return pairs.select(F.least("u", "v").alias("id"), F.greatest("u", "v").alias("id2"), "metres")
