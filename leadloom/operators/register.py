"""Company registers: flattening, officers, exclusion, and matching venues to companies.

Matching is a cascade of joins: by id, by name (a venue's normalised name inside a register name), by name and address,
by website; each tier runs on what the ones before left. The substring join is blocked by each target's rarest
trigram, so it is an equi join with an exact recall for names of three letters and more; shorter ones go by word."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..functions import fixed
from ..functions.references import once
from ..functions.text import fold, host_of, normalise_name, normalise_postcode, normalise_street, with_similarity

_none = lambda c: F.nullif(F.trim(c), F.lit(""))


def _described(descriptions: Column, lang: str) -> Column:
    full = F.filter(descriptions, lambda d: F.coalesce(F.trim(d["description"]), F.lit("")) != "")
    own = F.filter(full, lambda d: d["languageCode"] == lang)
    return F.coalesce(F.try_element_at(own, F.lit(1))["description"], F.try_element_at(full, F.lit(1))["description"])


def register_flatten_fi(raw: DataFrame) -> DataFrame:
    """One flat row a company: every trade name (current before ended, main name first), the visiting address before the
    postal one, registers without ended entries, and flags of its situations."""
    names = F.array_sort(
        F.transform(F.filter(F.coalesce("names", F.array()), lambda n: F.coalesce(F.trim(n["name"]), F.lit("")) != ""), lambda n, k: F.struct(n["endDate"].isNotNull().alias("ended"), (F.coalesce(n["type"], F.lit("")) != "1").alias("other"), k.alias("k"), F.trim(n["name"]).alias("name")))
    )
    address = F.array_sort(
        F.transform(F.coalesce("addresses", F.array()), lambda a, k: F.struct(
            a["endDate"].isNotNull().alias("ended"), (F.coalesce(a["type"], F.lit(0)) != 1).alias("other"), k.alias("k"), a["street"].alias("street"), a["buildingNumber"].alias("number"), a["postCode"].alias("post"),
            F.coalesce(F.try_element_at(F.filter(a["postOffices"], lambda p: p["languageCode"] == "1"), F.lit(1))["city"], F.try_element_at(a["postOffices"], F.lit(1))["city"]).alias("city")))
    )
    entry = lambda kind, register: F.exists(F.coalesce("registeredEntries", F.array()), lambda e: (e["type"] == kind) & (e["register"] == register) & (F.coalesce(e["status"], F.lit("")) != "2") & e["endDate"].isNull())
    blobs = F.transform(F.coalesce("companySituations", F.array()), lambda s: F.lower(F.concat_ws(" ", s["type"], F.array_join(F.transform(F.coalesce(s["descriptions"], F.array()), lambda d: d["description"]), " "))))
    told = lambda words: F.exists(blobs, lambda b: b.rlike("|".join(words)))
    flags = F.filter(F.array(*[F.when(told(words), F.lit(flag)) for flag, words in fixed.FI_SITUATIONS]), lambda f: f.isNotNull())
    flags = F.when((F.size(flags) == 0) & F.exists(blobs, lambda b: F.trim(b) != ""), F.array(F.lit("other"))).otherwise(F.array_sort(flags))
    rows = raw.withColumns({"__n": names, "__a": F.try_element_at(address, F.lit(1))})
    first = F.try_element_at("__n", F.lit(1))["name"]
    return rows.select(
        F.col("businessId").alias("business_id"), first.alias("primary_name"), F.transform("__n", lambda n: n["name"]).alias("names"), F.col("mainBusinessLine.type").alias("main_business_line"), _described(F.col("mainBusinessLine.descriptions"), "1").alias("main_business_desc"),
        normalise_street(F.col("__a.street")).alias("street"), _none(F.lower("__a.number")).alias("building_number"), normalise_postcode(F.col("__a.post")).alias("post_code"), F.col("__a.city").alias("post_office"), _none(F.col("website")).alias("website"),
        "endDate", F.upper("tradeRegisterStatus").alias("trade_status"), entry("41", "7").cast("int").alias("in_employer_register"), entry("80", "6").cast("int").alias("vat_liable"), flags.alias("situation_flags"),
        normalise_name(first).alias("name_norm"), F.array_sort(F.array_distinct(F.filter(F.transform("__n", lambda n: normalise_name(n["name"])), lambda n: n != ""))).alias("names_norm"),
    )


def register_flatten_ee(rows: DataFrame) -> DataFrame:
    """Rows with a code of eight digits: trimmed fields, the postcode's digits, and the row as it was, as JSON."""
    code = F.regexp_replace(F.coalesce("business_id", F.lit("")), "[^0-9]", "")
    return rows.where(F.length(code) == 8).select(code.alias("business_id"), F.trim("name").alias("name"), normalise_name(F.col("name")).alias("name_norm"), F.trim("status").alias("status"), F.trim("address").alias("address"), normalise_postcode(F.col("post_code")).alias("post_code"), F.to_json(F.struct(*rows.columns)).alias("raw_json"))


def board_members(rows: DataFrame) -> DataFrame:
    """Rows whose name has two words or more and none of a legal form; a missing role is a board member's."""
    words = F.filter(F.split(F.trim("person_name"), "\\s+"), lambda w: w != "")
    legal = F.exists(words, lambda w: F.lower(fold(w)).isin(*fixed.LEGAL_FORMS))
    return rows.where((F.size(words) >= 2) & ~legal).withColumn("role", F.coalesce(_none(F.col("role")), F.lit("board member")))


def folded_key(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(fold(c)), "[^a-z0-9]+", "_"), "^_+|_+$", "")


def _entries(record: Column) -> Column:
    """array<struct<key, folded, kind, text>> of a JSON object, in the order of its text: kind is the value's type, text
    is null for what counts as no value (null, an empty text, an empty list); null if it is no object."""
    values = F.from_json(record, "map<string,variant>")
    plain = lambda v: F.coalesce(F.try_variant_get(v, "$", "string"), F.to_json(v))
    empty = lambda v: v.isNull() | F.is_variant_null(v) | plain(v).isin("", "[]")
    return F.transform(F.map_entries(values), lambda e: F.struct(e["key"].alias("key"), folded_key(e["key"]).alias("folded"), F.coalesce(F.schema_of_variant(e["value"]), F.lit("VOID")).alias("kind"), F.when(~empty(e["value"]), plain(e["value"])).alias("text")))


def _pick(entries: Column, hints: tuple[str, ...]) -> Column:
    """The value of the first hint that a key contains, of keys with a value, in their order."""
    rank = lambda folded: F.coalesce(*[F.when(F.contains(folded, F.lit(h)), F.lit(k)) for k, h in enumerate(hints)])
    ranked = F.transform(entries, lambda e, pos: F.struct(F.when(e["text"].isNotNull(), rank(e["folded"])).alias("hint"), pos.alias("pos"), e["text"].alias("text")))
    return F.array_min(F.filter(ranked, lambda x: x["hint"].isNotNull()))["text"]


def _person(entries: Column) -> Column:
    """Struct (person_name, role, ended) of a person's entries: forename and surname, or else one field for both."""
    given, surname = _pick(entries, fixed.GIVEN_NAME_KEYS), _pick(entries, fixed.SURNAME_KEYS)
    both = F.when(given.isNotNull() & surname.isNotNull(), F.trim(F.concat_ws(" ", F.trim(given), F.trim(surname)))).otherwise(F.trim(_pick(entries, fixed.PERSON_NAME_KEYS)))
    return F.struct(F.nullif(both, F.lit("")).alias("person_name"), _pick(entries, fixed.PERSON_ROLE_KEYS).alias("role"), _pick(entries, fixed.ENDED_KEYS).isNotNull().alias("ended"))


def _people(records: DataFrame, list_hints: tuple[str, ...], list_denied: tuple[str, ...]) -> DataFrame:
    """(business_id, own, lists, people): a record's entries, the lists among them whose key may name people (with their
    length), and the entries of each object in these lists that begin with one."""
    text = F.col("record") if isinstance(records.schema["record"].dataType, StringType) else F.to_json("record")
    rows = once(records.select(text.alias("__text")), own=_entries(F.col("__text")), raw=F.from_json("__text", "map<string,string>")).where("own is not null")
    named = lambda e: F.coalesce(F.rlike(e["folded"], F.lit("|".join(list_hints))), F.lit(False)) & ~F.rlike(e["folded"], F.lit("|".join(list_denied)))
    found = F.filter("own", lambda e: e["kind"].startswith("ARRAY") & named(e))
    parts = lambda e: F.coalesce(F.from_json(F.try_element_at("raw", e["key"]), "array<string>"), F.array().cast("array<string>"))
    rows = once(rows, lists=F.transform(found, lambda e: F.struct(e["key"].alias("key"), parts(e).alias("parts"))))
    begins = F.filter("lists", lambda x: F.get(x["parts"], F.lit(0)).startswith("{"))
    people = F.filter(F.transform(F.flatten(F.transform(begins, lambda x: x["parts"])), _entries), lambda p: p.isNotNull())
    return once(rows, business_id=_pick(F.col("own"), fixed.CODE_KEYS), people=people).select("business_id", "own", "lists", "people")


def register_persons(records: DataFrame, list_hints: tuple[str, ...] = fixed.PERSON_LIST_KEYS, list_denied: tuple[str, ...] = fixed.OTHER_LIST_KEYS) -> DataFrame:
    """(business_id, person_name, role, ended) of records whose keys differ by release; records: (record), an object as
    JSON text or variant. A field is the value of the first hint that a key contains. People are in lists whose key has a
    hint; only if no one there has a name is the record a person itself. People who have left are marked ended (and keep
    the record from being a person itself); current_persons leaves them out. Records without a code, without a name or
    that are no objects give no rows.

    A variant has its keys in alphabetical order, which decides where one hint is in several keys; text keeps its own."""
    named = F.filter(F.transform("people", _person), lambda x: x["person_name"].isNotNull())
    itself = _person(F.col("own")).withField("ended", F.lit(False))
    rows = _people(records, list_hints, list_denied).where("business_id is not null")
    rows = once(rows, named=named)
    rows = rows.select("business_id", F.inline(F.when(F.size("named") > 0, F.col("named")).otherwise(F.array(itself))))
    return rows.where("person_name is not null")


def current_persons(records: DataFrame, **lists) -> DataFrame:
    """(business_id, person_name, role) of people who haven't left; a missing role is a board member's."""
    rows = register_persons(records, **lists).where(~F.col("ended"))
    return rows.select("business_id", "person_name", F.coalesce("role", F.lit("board member")).alias("role"))


def person_losses(records: DataFrame, list_hints: tuple[str, ...] = fixed.PERSON_LIST_KEYS, list_denied: tuple[str, ...] = fixed.OTHER_LIST_KEYS) -> DataFrame:
    """One row: records, those without a code, without a list of people and with an empty one, people in lists, those
    without a name, who left, and who are current: why a dump yields as few people as it does."""
    rows = _people(records, list_hints, list_denied)
    coded = F.col("business_id").isNotNull()
    people = F.when(coded, F.transform("people", _person)).otherwise(F.array())
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    of = lambda test: F.size(F.filter("p", test))
    rows = rows.select("business_id", "lists", people.alias("p"))
    return rows.agg(
        F.count("*").alias("records"), F.count_if(~coded).alias("no_code"), F.count_if(coded & (F.size("lists") == 0)).alias("no_list"),
        total(F.when(coded, F.size(F.filter("lists", lambda x: F.size(x["parts"]) == 0)))).alias("empty_lists"), total(F.size("p")).alias("people"), total(of(lambda x: x["person_name"].isNull())).alias("no_name"),
        total(of(lambda x: x["person_name"].isNotNull() & x["ended"])).alias("ended"), total(of(lambda x: x["person_name"].isNotNull() & ~x["ended"])).alias("kept"),
    )


def person_keys(records: DataFrame, list_hints: tuple[str, ...] = fixed.PERSON_LIST_KEYS, list_denied: tuple[str, ...] = fixed.OTHER_LIST_KEYS) -> DataFrame:
    """(level, json_key, n): how often each key occurs in records, as a list of people, and in people."""
    rows = _people(records, list_hints, list_denied)
    keys = lambda level, found: F.transform(found, lambda e: F.struct(F.lit(level).alias("level"), e["key"].alias("json_key")))
    coded = lambda c: F.when(F.col("business_id").isNotNull(), c).otherwise(F.array().cast("array<struct<level:string,json_key:string>>"))
    every = F.concat(keys("record", F.col("own")), coded(keys("list", F.col("lists"))), coded(keys("person", F.flatten("people"))))
    return rows.select(F.inline(every)).groupBy("level", "json_key").agg(F.count("*").alias("n"))


def key_profile(objects: Column, df: DataFrame, top: int = 14) -> DataFrame:
    """The keys that occur most among JSON objects, with their counts."""
    return df.select(F.explode(F.map_keys(F.from_json(objects, "map<string,string>"))).alias("json_key")).groupBy("json_key").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "json_key").limit(top)


def register_load_stats(raw: DataFrame, kept: DataFrame) -> DataFrame:
    """One row: scanned, kept, with_website, employers, the website share and whether it is over 0.2."""
    share = F.col("with_website") / F.greatest("kept", F.lit(1))
    k = kept.agg(F.count("*").alias("kept"), F.count_if(F.col("website").isNotNull()).alias("with_website"), F.coalesce(F.sum("in_employer_register"), F.lit(0)).alias("employers"))
    return raw.agg(F.count("*").alias("scanned")).crossJoin(k).withColumns({"website_share": share, "website_usable": share > 0.2})


def keep_relevant(companies: DataFrame, wanted_ids: DataFrame, wanted_names: DataFrame, target_lines: tuple[str, ...] = fixed.FI_TARGET_LINES) -> DataFrame:
    """Companies whose id is wanted, or whose line of business is a target, or one of whose names is wanted."""
    ids = wanted_ids.select("business_id").distinct().withColumn("__id", F.lit(True))
    names = companies.select("business_id", F.explode("names_norm").alias("name_norm")).join(wanted_names.select("name_norm").distinct(), "name_norm", "left_semi").select("business_id").distinct().withColumn("__name", F.lit(True))
    rows = companies.join(ids, "business_id", "left").join(names, "business_id", "left")
    return rows.where(F.col("__id").isNotNull() | F.col("__name").isNotNull() | F.col("main_business_line").isin(*target_lines)).select(*companies.columns)


def register_exclusion(matches: DataFrame, closing_words: tuple[str, ...] = ("kustutatud", "likvideerimisel", "pankrotis", "deleted", "liquidation", "bankrupt")) -> DataFrame:
    """Adds exclusion_reason: bankruptcy or liquidation, a ceased company, or an Estonian status with a closing word; an
    empty status is active. Restructuring is no exclusion."""
    situation = F.try_element_at(F.array_intersect(F.coalesce("situation_flags", F.array().cast("array<string>")), F.array(*map(F.lit, fixed.FI_EXCLUDED))), F.lit(1))
    ceased = F.col("endDate").isNotNull() | F.coalesce(F.col("trade_status").isin("2", "CEASED", "LAKANNUT"), F.lit(False))
    closed = F.lower(fold(F.coalesce("ee_status", F.lit("")))).rlike("|".join(closing_words))
    return matches.withColumn("exclusion_reason", F.when(F.col("country") == "EE", F.when(closed, F.lit("inactive"))).otherwise(F.coalesce(situation, F.when(ceased, F.lit("ceased")))))


def pending_extracts(business_ids: DataFrame, captured: DataFrame) -> DataFrame:
    """Distinct valid Finnish ids without a captured extract: a group once, not once a venue."""
    return business_ids.where("how = 'checksum_valid'").select("business_id").distinct().join(captured.select("business_id"), "business_id", "left_anti")


def trigrams(c: Column) -> Column:
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(c) - 2), lambda k: F.substring(c, k, 3)))


#: Postings of a trigram in one task.
POSTINGS_A_TASK = 50_000


def _around(text: Column, at: Column) -> list[Column]:
    """The three letters before and behind the trigram at a place (from 1), or as many as there are."""
    first = F.greatest(at - 3, F.lit(1))
    return [F.substring(text, first, at - first).alias("before"), F.substring(text, at + 3, F.lit(3)).alias("behind")]


def substring_pairs(targets: DataFrame, names: DataFrame, postings_a_task: int = POSTINGS_A_TASK) -> DataFrame:
    """(target, name): every target that a name contains. Both tables have one distinct text column of that name.

    Each target looks in the names with its rarest trigram; counts are of all names. A posting is a trigram that some
    target looks for, a hash of the name and the letters on either side, which have to fit before the name itself is
    fetched; names whose hashes are equal are told apart by the last test. A trigram with many postings is spread over
    tasks by name, each with all targets that look for it. Targets of one or two letters look among the names' distinct
    pieces of their length."""
    long = targets.where(F.length("target") >= 3)
    known = names.where(F.length("name") >= 3).select(F.xxhash64("name").alias("id"), "name")
    counts = known.select(F.explode(trigrams(F.col("name"))).alias("gram")).groupBy("gram").agg(F.count("*").alias("n"))
    grams = long.select("target", F.explode(trigrams(F.col("target"))).alias("gram")).join(counts, "gram")
    salts = F.ceil(F.col("n") / postings_a_task).cast("int")
    # a target with a trigram that no name has is in none
    full = grams.groupBy("target").agg(F.min(F.struct("n", "gram")).alias("r"), F.count("*").alias("found")).where(F.col("found") == F.size(trigrams(F.col("target"))))
    rarest = full.select("target", "r.*").withColumn("at", F.call_function("locate", F.col("gram"), F.col("target")))
    rarest = rarest.select("target", "gram", salts.alias("salts"), *[c.alias(f"own_{n}") for c, n in zip(_around(F.col("target"), F.col("at")), ("before", "behind"), strict=True)])
    wanted = rarest.select("gram", "salts").distinct()
    places = F.transform(F.sequence(F.lit(1), F.length("name") - 2), lambda k: F.struct(F.substring("name", k, F.lit(3)).alias("gram"), *_around(F.col("name"), k)))
    posts = known.select("id", F.inline(places)).join(wanted, "gram").withColumn("salt", F.pmod("id", "salts").cast("int")).drop("salts")
    looking = rarest.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).drop("salts")
    fits = F.endswith("before", "own_before") & F.startswith("behind", "own_behind")
    near = posts.join(looking, ["gram", "salt"]).where(fits).select("target", "id").distinct()
    found = near.join(known, "id").where(F.col("name").contains(F.col("target"))).select("target", "name")
    piece = lambda n: names.where(F.length("name") >= n).select("name", F.explode(F.array_distinct(F.transform(F.sequence(F.lit(1), F.length("name") - (n - 1)), lambda k: F.substring("name", k, n)))).alias("target"))
    short = targets.where(F.length("target").between(1, 2)).join(piece(1).unionByName(piece(2)), "target").select("target", "name")
    return found.unionByName(short)


def match_by_business_id(venues: DataFrame, business_ids: DataFrame, companies: DataFrame) -> DataFrame:
    """(venue_id, business_id, confidence 1.0, method): of a venue's harvested ids that exist, a checksum-valid one first,
    then the least."""
    rows = venues.select("venue_id").join(business_ids, "venue_id").join(companies.select("business_id").distinct(), "business_id", "left_semi")
    w = Window.partitionBy("venue_id").orderBy((F.col("how") != "checksum_valid").cast("int"), "business_id")
    return rows.withColumn("n", F.row_number().over(w)).where("n = 1").select("venue_id", "business_id", F.lit(1.0).alias("confidence"), F.lit("business_id").alias("method"))


def match_by_name(venues: DataFrame, companies: DataFrame, accept: float = 0.9, accept_with_address: float = 0.75) -> DataFrame:
    """Best company of each venue by name (similarity of at least `accept`), or by name and address (postcode equal,
    street alike, number equal where both have one). companies: business_id, names_norm, street, building_number,
    post_code; venues: venue_id, name, street, number, postcode. Ties go to the least id."""
    v = venues.select("venue_id", normalise_name(F.col("name")).alias("target"), "street", "number", F.col("postcode").alias("pc")).where("target <> ''")
    c = companies.select("business_id", F.explode("names_norm").alias("name"), F.col("street").alias("c_street"), "building_number", "post_code")
    pairs = with_similarity(substring_pairs(v.select("target").distinct(), c.select("name").distinct()), "target", "name", "score", min(accept, accept_with_address))
    rows = v.join(pairs, "target").join(c, "name")
    one = rows.groupBy("venue_id", "business_id").agg(F.max("score").alias("score"), *[F.first(x).alias(x) for x in ("street", "number", "pc", "c_street", "building_number", "post_code")])
    same_number = F.coalesce((F.lower("number") == F.lower("building_number")) | (F.coalesce("number", F.lit("")) == "") | (F.coalesce("building_number", F.lit("")) == ""), F.lit(True))
    near = (F.coalesce("street", F.lit("")) != "") & (F.coalesce("c_street", F.lit("")) != "") & (normalise_postcode(F.col("pc")) == normalise_postcode(F.col("post_code"))) & same_number
    streets = one.withColumns({"__a": F.when(near, F.col("street")), "__b": F.when(near, F.col("c_street"))})
    one = with_similarity(streets, "__a", "__b", "alike", 0.9)
    both = (F.col("alike") >= 0.9) & (F.col("score") >= accept_with_address)
    scored = one.select("venue_id", "business_id", F.round(F.when(both, F.greatest("score", F.lit(0.95))).when(F.col("score") >= accept, F.col("score")), 3).alias("confidence"), F.when(both, "name_address").otherwise("name").alias("method")).where("confidence is not null")
    w = Window.partitionBy("venue_id").orderBy(F.desc("confidence"), "business_id")
    return scored.withColumn("n", F.row_number().over(w)).where("n = 1").drop("n")


def match_by_website(venues: DataFrame, companies: DataFrame) -> DataFrame:
    """Venues whose site's host, with or without a subdomain, is in a company's website: confidence 0.85."""
    host = F.when(F.col("website").contains("//"), host_of(F.col("website"))).otherwise(F.regexp_replace(F.lower(F.regexp_extract("website", "^([^/?#]*)", 1)), "^www\\.", ""))
    parts = F.split(host, "\\.")
    ends = F.transform(F.sequence(F.lit(1), F.greatest(F.size(parts) - 1, F.lit(1))), lambda k: F.array_join(F.slice(parts, k, F.size(parts)), "."))
    # one company a domain before the join, so that a domain which many companies and venues share makes no pairs
    c = companies.where("website is not null").select("business_id", F.explode(ends).alias("domain")).groupBy("domain").agg(F.min("business_id").alias("business_id"))
    rows = venues.where("domain is not null").select("venue_id", "domain").join(c, "domain").groupBy("venue_id").agg(F.min("business_id").alias("business_id"))
    return rows.select("venue_id", "business_id", F.lit(0.85).alias("confidence"), F.lit("website").alias("method"))


def match_ee(venues: DataFrame, companies: DataFrame) -> DataFrame:
    """match_by_name for companies of one name and a street in one address line."""
    from ..functions.text import number_of, street_of

    c = companies.select("business_id", F.array("name_norm").alias("names_norm"), street_of(F.col("address")).alias("street"), number_of(F.col("address")).alias("building_number"), "post_code")
    return match_by_name(venues, c)


def resolve_registry_match(venues: DataFrame, business_ids: DataFrame, companies: DataFrame) -> DataFrame:
    """(venue_id, business_id, confidence, method, needs_review): the cascade; unmatched venues stay, for review."""
    first = match_by_business_id(venues, business_ids, companies)
    left = venues.join(first.select("venue_id"), "venue_id", "left_anti")
    second = match_by_name(left, companies)
    third = match_by_website(left.join(second.select("venue_id"), "venue_id", "left_anti"), companies)
    found = first.unionByName(second).unionByName(third)
    return venues.select("venue_id").join(found, "venue_id", "left").select("venue_id", "business_id", F.coalesce("confidence", F.lit(0.0)).alias("confidence"), F.coalesce("method", F.lit("none")).alias("method"), F.col("method").isNull().cast("int").alias("needs_review"))


def company_groups(matches: DataFrame) -> DataFrame:
    """Companies (by id and country) with more than one venue."""
    return matches.where("business_id is not null").groupBy("business_id", "country").agg(F.min("company_name").alias("company_name"), F.count("*").alias("venue_count")).where("venue_count > 1")


def _fi(c: Column) -> Column:
    return F.trim(F.translate(F.lower(c), "äöåé", "aoae"))


def extract_officers(extracts: DataFrame) -> DataFrame:
    """(business_id, person_name, surname, given, role, rank) of extracts' texts: rows with a date and no registration
    stamp whose role is a manager's; companies and auditors are left out; birth dates aren't kept. One row a person, in
    the best role."""
    lines = extracts.select("business_id", F.explode(F.split("text", "\r?\n")).alias("line")).select("business_id", F.trim("line").alias("line"))
    lines = lines.where(F.col("line").rlike(fixed.OFFICER_DATE) & ~F.col("line").rlike(fixed.REGISTRATION_STAMP))
    roles = sorted([*(r for r, _, _ in fixed.OFFICER_RANKS), *fixed.AUDITOR_ROLES], key=len, reverse=True)
    role = F.regexp_extract(_fi(F.col("line")), "^(" + "|".join(roles) + ")", 1)
    rest = F.trim(F.regexp_replace(F.expr("substring(line, length(role) + 1)"), fixed.OFFICER_DATE, ""))
    ranks = {r: (k, label) for r, k, label in fixed.OFFICER_RANKS}
    rows = lines.withColumn("role", role).where(F.col("role").isin(*ranks)).withColumn("rest", rest).where(~F.col("rest").rlike(fixed.COMPANY_MARKS))
    words = F.filter(F.split(F.regexp_replace("rest", "^[ ,.]+|[ ,.]+$", ""), "\\s+"), lambda w: w != "")
    rows = rows.withColumn("w", words).where(F.size("w") >= 2).withColumns({"surname": F.col("w")[0], "given": F.array_join(F.slice("w", 2, 100), " ")})
    rank, label = F.lit(None).cast("int"), F.lit(None).cast("string")
    for r, (k, text) in ranks.items():
        rank, label = F.when(F.col("role") == r, k).otherwise(rank), F.when(F.col("role") == r, text).otherwise(label)
    rows = rows.select("business_id", F.concat_ws(" ", "given", "surname").alias("person_name"), "surname", "given", label.alias("role"), rank.alias("rank"))
    return best_officer(rows)


def best_officer(officers: DataFrame) -> DataFrame:
    w = Window.partitionBy("business_id", _fi(F.col("person_name"))).orderBy("rank", "surname")
    return officers.withColumn("n", F.row_number().over(w)).where("n = 1").drop("n")


def extract_registered_contact(extracts: DataFrame) -> DataFrame:
    """(business_id, email, phone, website) as filed; the last such line counts."""
    lines = extracts.select("business_id", F.posexplode(F.split("text", "\r?\n")).alias("pos", "line"))
    key, value = _fi(F.col("line")), F.trim(F.regexp_extract("line", "^\\s*\\S+\\s+(.*)$", 1))
    email = F.when(key.startswith("sahkoposti"), F.nullif(F.lower(F.regexp_extract("line", "[A-Za-z0-9._%+\\-]+@[A-Za-z0-9.\\-]+\\.[A-Za-z]{2,}", 0)), F.lit("")))
    phone = F.when(key.startswith("puhelin") & value.rlike("[0-9]"), value)
    site = F.when(key.startswith("www-osoite"), F.nullif(value, F.lit("")))
    last = lambda c: F.max_by(c, F.when(c.isNotNull(), F.col("pos")))
    return lines.groupBy("business_id").agg(last(email).alias("email"), last(phone).alias("phone"), last(site).alias("website"))


def expand_officers_to_venues(officers: DataFrame, business_ids: DataFrame) -> DataFrame:
    """A company's officers at every venue under its id."""
    return business_ids.select("venue_id", "business_id").distinct().join(officers, "business_id")


def officers_to_contacts(officers: DataFrame, registered: DataFrame, business_ids: DataFrame) -> DataFrame:
    """Rows for an upsert on (venue_id, dedupe_key): officers under their name, and the filed address under itself."""
    people = expand_officers_to_venues(officers, business_ids).select("venue_id", F.lit(None).cast("string").alias("email"), F.col("person_name").alias("contact_name"), F.col("role").alias("contact_role"), F.concat(F.lit("virre:"), normalise_name(F.col("person_name"))).alias("dedupe_key"))
    filed = business_ids.select("venue_id", "business_id").distinct().join(registered.where("email is not null"), "business_id").select("venue_id", "email", F.lit(None).cast("string").alias("contact_name"), F.lit(None).cast("string").alias("contact_role"), F.col("email").alias("dedupe_key"))
    return people.unionByName(filed).withColumns({"source": F.lit("register"), "confidence": F.lit("high")}).dropDuplicates(["venue_id", "dedupe_key"])


def board_contacts(matches: DataFrame, board: DataFrame) -> DataFrame:
    """Incoming contacts: each matched company's board members, by name only, at medium confidence."""
    rows = matches.where("business_id is not null").select("venue_id", "business_id").join(board, "business_id")
    return rows.select("venue_id", F.lit(None).cast("string").alias("email"), F.col("person_name").alias("contact_name"), F.col("role").alias("contact_role"), F.lit("register").alias("source"), F.lit(None).cast("string").alias("source_url"), F.lit("medium").alias("confidence"), F.lit(None).cast("string").alias("verification_status"))
