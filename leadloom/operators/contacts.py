"""Merging contacts, screening their names, and guessing addresses; harvest.py has the extraction from pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.components import cut
from ..functions.references import once
from ..functions.text import clean_email, ee_ids, email_domain, email_local, fi_ids, fold, normalise_name, person_shaped, plausible_email, shared_inbox
from .harvest import harvest_contacts as harvest_contacts

def plain_emails(text: Column) -> Column:
    """Well-formed addresses of a text, lower-cased, distinct, in order."""
    return F.array_distinct(F.transform(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(fixed.EMAIL), F.lit(0)), clean_email))


def best_email_channel(hits: DataFrame, keys: list[str]) -> DataFrame:
    """Of hits with rank and pos, one an address: the highest rank, the first on ties."""
    w = Window.partitionBy(*keys, "email").orderBy(F.desc("rank"), "pos")
    return hits.withColumn("n", F.row_number().over(w)).where("n = 1").drop("n")


def harvest_business_ids(pages: DataFrame, keys: list[str], text: Column, country: str | None = None) -> DataFrame:
    """(keys, business_id, id_country, how): valid Finnish and corroborated Estonian ids, the page's country first."""
    of = lambda ids, c, how: F.transform(ids, lambda i: F.struct(i.alias("business_id"), F.lit(c).alias("id_country"), F.lit(how).alias("how")))
    fi, ee = of(fi_ids(text), "FI", "checksum_valid"), of(ee_ids(text), "EE", "keyword_corroborated")
    both = F.when(F.col(country) == "EE", F.concat(ee, fi)).otherwise(F.concat(fi, ee)) if country else F.concat(fi, ee)
    return pages.select(*keys, F.posexplode(both).alias("pos", "b")).select(*keys, "pos", "b.*")


def harvest_socials(pages: DataFrame, keys: list[str], html: str = "html") -> DataFrame:
    """(keys, platform, handle, url), distinct."""
    def of(name: str, pattern: str) -> Column:
        urls = F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(pattern), F.lit(0))
        return F.transform(urls, lambda u: F.struct(F.lit(name).alias("platform"), F.regexp_extract(u, pattern, 1).alias("handle"), F.regexp_replace(u, "/$", "").alias("url")))

    found = F.concat(*[of(name, pattern) for name, pattern in fixed.SOCIALS])
    return pages.select(*keys, F.inline(found)).where(~F.lower("handle").isin(*fixed.SOCIAL_JUNK) & (F.length("handle") >= 2)).distinct()


def purge_implausible(contacts: DataFrame, **lists) -> DataFrame:
    """Contacts without an address, or with a plausible one."""
    return contacts.where(F.col("email").isNull() | plausible_email(F.col("email"), **lists))


CONTACT = "venue_id bigint, email string, contact_name string, contact_role string, source string, source_url string, confidence string, verification_status string, dedupe_key string, first_seq bigint"


def _filled(df: DataFrame) -> DataFrame:
    """With every column of CONTACT, blanks as nulls, and the name's key."""
    kinds = [c.split() for c in CONTACT.split(", ")]
    cols = {c: F.col(c).cast(kind) if c in df.columns else F.lit(None).cast(kind) for c, kind in kinds}
    cols |= {c: F.nullif(cols[c], F.lit("")) for c, kind in kinds if kind == "string"}
    rows = df.select(*[x.alias(c) for c, x in cols.items()], *(["seq"] if "seq" in df.columns else [F.col("first_seq").alias("seq")]))
    return rows.withColumn("name_norm", F.when(F.col("contact_name").isNotNull(), normalise_name(F.col("contact_name"))))


def resolve_contacts(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """Merges incoming rows (ordered by seq) into each venue's contacts (ordered by first_seq), as if they came one by one.

    A row meets the contact with its address; else the first one with its normalised name, unless both have addresses;
    a name gets its first address so, along with the row's source and confidence, and otherwise only blanks are filled.
    Rows with neither address nor name are refused. Existing contacts with one address are one contact.

    All of it is grouping. Rows of an address are one contact, named by its first row with a name. Rows of a name alone
    are a contact of their own if the first of them comes before any address has the name; that contact takes the first
    new address that comes with the name afterwards, unless an older contact has got the name by then. The remaining rows
    of a name alone give their role to the oldest contact that has the name at their time, which is a running minimum.

    Defined results: rows of one seq are ordered by a hash of their values; a null venue is a venue; empty tables give
    what the other holds; other columns are ignored."""
    key = F.coalesce(F.col("venue_id"), F.lit(-(1 << 63)))
    old = _filled(existing).withColumn("new", F.lit(False))
    new = _filled(incoming).withColumns({"email": F.nullif(F.lower(F.regexp_replace("email", r"(?U)^\s+|\s+$", "")), F.lit("")), "first_seq": F.col("seq"), "new": F.lit(True)})
    new = new.withColumn("dedupe_key", F.coalesce("email", F.concat(F.lit("name:"), "name_norm"))).where("dedupe_key is not null")
    tie = F.xxhash64("email", "contact_name", "contact_role", "source")
    rows = cut(old.unionByName(new).withColumns({"v": key, "t": F.struct("new", "seq", tie.alias("tie"))}))
    row = F.struct(*[c for c in rows.columns if c != "v"])
    when_named = F.when(F.col("contact_name").isNotNull(), F.col("t"))

    # contacts by address, and names without one
    by_email = rows.where("email is not null").groupBy("v", "email").agg(F.min_by(row, "t").alias("first"), F.min_by("contact_name", when_named).alias("named"), F.min_by("name_norm", when_named).alias("n"), F.min(when_named).alias("since"))
    bare = rows.where("email is null and name_norm is not null").withColumnRenamed("name_norm", "n")
    started = bare.groupBy("v", "n").agg(F.min_by(F.struct(*[c for c in bare.columns if c not in ("v", "n")]), "t").alias("start"))
    owners = by_email.where("n is not null").select("v", "n", "email", "since", F.col("first.t").alias("pos"))
    # a contact that lost its name is found by the key that it had
    nameless = rows.where("email is null and name_norm is null and dedupe_key like 'name:%'").groupBy("v", F.expr("substring(dedupe_key, 6)").alias("n")).agg(F.min_by(row, "t").alias("had"))
    alone = started.join(owners.groupBy("v", "n").agg(F.min("since").alias("taken")), ["v", "n"], "left")
    alone = alone.where(~F.col("start.new") | F.col("taken").isNull() | (F.col("start.t") < F.col("taken"))).join(nameless, ["v", "n"], "left")
    alone = cut(alone.select("v", "n", "start", "had", F.coalesce("had.t", "start.t").alias("pos")))

    # the address that a name alone takes
    met = owners.join(alone.select("v", "n", F.col("start.t").alias("began"), F.col("pos").alias("own")), ["v", "n"])
    older = met.where("pos < own").groupBy("v", "n").agg(F.min("since").alias("older"))
    fresh = by_email.where("first.new and first.name_norm is not null").select("v", F.col("first.name_norm").alias("n"), "first").join(alone.select("v", "n", F.col("start.t").alias("began")), ["v", "n"]).where("first.t > began")
    taken = fresh.join(older, ["v", "n"], "left").where("older is null or first.t < older").groupBy("v", "n").agg(F.min_by("first", "first.t").alias("by"))
    taken = cut(taken)
    promoted = taken.select("v", F.col("by.email").alias("email"), F.col("n").alias("of"))
    emails = by_email.join(promoted, ["v", "email"], "left")

    # which contact each row goes to: id is the address, or the name of a contact that began without one
    ids = emails.where("of is null and n is not null").select("v", "n", F.col("since").alias("t"), F.struct("first.t", F.lit("e").alias("kind"), F.col("email").alias("id")).alias("contact"))
    ids = ids.unionByName(alone.select("v", "n", F.col("start.t").alias("t"), F.struct(F.col("pos").alias("t"), F.lit("n").alias("kind"), F.col("n").alias("id")).alias("contact")))
    asking = bare.where("contact_role is not null").select("v", "n", "t", "contact_role")
    line = Window.partitionBy("v", "n").orderBy("t", F.col("contact").isNull()).rowsBetween(Window.unboundedPreceding, 0)
    events = ids.withColumn("contact_role", F.lit(None).cast("string")).unionByName(asking.withColumn("contact", F.lit(None).cast(ids.schema["contact"].dataType)))
    given = events.withColumn("hit", F.min("contact").over(line)).where("contact_role is not null and hit is not null").select("v", F.col("hit.kind").alias("kind"), F.col("hit.id").alias("id"), "t", "contact_role")
    own = rows.where("email is not null and contact_role is not null").join(promoted, ["v", "email"], "left").select("v", F.when(F.col("of").isNull(), "e").otherwise("n").alias("kind"), F.coalesce("of", "email").alias("id"), "t", "contact_role")
    had = nameless.where("had.contact_role is not null").select("v", F.lit("n").alias("kind"), F.col("n").alias("id"), F.col("had.t").alias("t"), F.col("had.contact_role").alias("contact_role"))
    roles = given.unionByName(own).unionByName(had).groupBy("v", "kind", "id").agg(F.min_by("contact_role", "t").alias("role"))

    fields = [c.split()[0] for c in CONTACT.split(", ")]
    plain = emails.where("of is null").select("v", F.lit("e").alias("kind"), F.col("email").alias("id"), *[F.col(f"first.{c}").alias(c) for c in fields if c not in ("contact_name", "contact_role")], F.col("named").alias("contact_name"))
    begun = alone.join(taken, ["v", "n"], "left")
    moved = {c: F.when(F.col("by").isNotNull(), F.col(f"by.{c}")).otherwise(F.when(F.col("had").isNotNull(), F.col(f"had.{c}")).otherwise(F.col(f"start.{c}"))) for c in ("email", "dedupe_key", "source", "source_url", "confidence")}
    kept = {c: F.when(F.col("had").isNotNull(), F.col(f"had.{c}")).otherwise(F.col(f"start.{c}")) for c in ("venue_id", "verification_status", "first_seq")}
    begun = begun.select("v", F.lit("n").alias("kind"), F.col("n").alias("id"), *[x.alias(c) for c, x in (moved | kept).items()], F.col("start.contact_name").alias("contact_name"))
    merged = plain.unionByName(begun).join(roles, ["v", "kind", "id"], "left").withColumn("contact_role", F.col("role")).select(*fields)
    waiting = nameless.join(alone, ["v", "n"], "left_anti").select(*[F.col(f"had.{c}").alias(c) for c in fields])
    empty = rows.where("email is null and name_norm is null and coalesce(dedupe_key, '') not like 'name:%'").select(*fields)
    return merged.unionByName(waiting).unionByName(empty)


def ingest_pages(hits: DataFrame, kinds: DataFrame, key: str = "url") -> DataFrame:
    """Contacts of pages as incoming rows: the source by the page's kind; high if the channel is or a name was found."""
    rows = hits.join(kinds.select(key, "kind"), key, "left")
    sure = (F.col("confidence") == "high") | F.col("contact_name").isNotNull()
    return rows.withColumns({"source": F.concat(F.lit("website_"), F.coalesce("kind", F.lit("other"))), "confidence": F.when(sure, "high").otherwise("medium"), "source_url": F.col(key)})


def name_sites(contacts: DataFrame) -> DataFrame:
    """Distinct venues of each normalised name."""
    return contacts.where("contact_name is not null").groupBy(normalise_name(F.col("contact_name")).alias("name_norm")).agg(F.count_distinct("venue_id").alias("n_sites"))


def group_owners(contacts: DataFrame, matches: DataFrame) -> DataFrame:
    """Of each normalised name at matched venues: companies, venues and the least company id."""
    rows = contacts.where("contact_name is not null").join(matches.where("business_id is not null").select("venue_id", "business_id"), "venue_id")
    # venues are counted where the join has put them: each with the first of its companies, so no venue id goes further
    seen = once(rows.groupBy("venue_id", "contact_name").agg(F.collect_set("business_id").alias("ids")), name_norm=normalise_name(F.col("contact_name")))
    venues = seen.groupBy("venue_id", "name_norm").agg(F.array_distinct(F.flatten(F.collect_list("ids"))).alias("ids"))
    pairs = venues.select("name_norm", F.posexplode("ids").alias("k", "business_id")).groupBy("name_norm", "business_id").agg(F.count_if(F.col("k") == 0).alias("n"))
    return pairs.groupBy("name_norm").agg(F.count("*").alias("n_companies"), F.sum("n").alias("n_venues"), F.min("business_id").alias("company"))


def name_screen(contacts: DataFrame, venues: DataFrame, sites: DataFrame, matches: DataFrame, min_sites: int = 3, prose: tuple[str, ...] | None = None) -> DataFrame:
    """Named contacts with hard and soft reasons against the name. Hard ones clear name and role and leave the address."""
    norm = normalise_name(F.col("contact_name"))
    rows = contacts.where("contact_name is not null").withColumn("name_norm", norm).join(venues.select("venue_id", normalise_name(F.col("name")).alias("venue_norm")), "venue_id")
    rows = rows.join(sites.select("venue_id", "domain"), "venue_id", "left").join(name_sites(contacts), "name_norm", "left").join(group_owners(contacts, matches), "name_norm", "left")
    stem = F.regexp_replace(F.lower(fold(F.coalesce("domain", F.lit("")))), "\\.(fi|ee|com|net|org|eu|se)$", "")
    tokens = F.filter(F.split(stem, "[-. ]+"), lambda t: F.length(t) > 3)
    repeats = (F.col("venue_norm") != "") & (F.col("name_norm") != "") & (F.col("venue_norm").contains(F.col("name_norm")) | F.col("name_norm").contains(F.col("venue_norm")))
    hard = F.array(F.when(~person_shaped(F.col("contact_name"), prose), F.lit("not a person-shaped name")), F.when(repeats, F.lit("repeats the venue's name")), F.when(F.arrays_overlap(tokens, F.split("name_norm", " ")), F.lit("shares a word with the site's domain")))
    owner = (F.col("n_companies") == 1) & (F.col("n_venues") >= 2)
    soft = F.when(F.col("n_sites") >= min_sites, F.when(owner, F.concat(F.lit("group owner under "), F.col("company"))).otherwise(F.concat(F.lit("at "), F.col("n_sites").cast("string"), F.lit(" venues"))))
    kept = F.filter(hard, lambda r: r.isNotNull())
    out = rows.withColumns({"hard": kept, "soft": soft})
    return out.withColumns({"clean_name": F.when(F.size("hard") == 0, F.col("contact_name")), "clean_role": F.when(F.size("hard") == 0, F.col("contact_role"))})


def name_candidates(contacts: DataFrame, verdicts: DataFrame, register_sources: tuple[str, ...] = ("register",)) -> DataFrame:
    """Names not yet judged that some source other than a register gave, with the venues that have them, most first."""
    named = contacts.where("contact_name is not null").groupBy(F.lower("contact_name").alias("name_key")).agg(
        F.min("contact_name").alias("name"), F.min("contact_role").alias("contact_role"), F.min("email").alias("email"), F.count_distinct("venue_id").alias("venues"), F.count_if(~F.col("source").isin(*register_sources)).alias("scraped"))
    fresh = named.where("scraped > 0").withColumn("name_norm", normalise_name(F.col("name"))).join(verdicts.select("name_norm"), "name_norm", "left_anti")
    return fresh.orderBy(F.desc("venues"), "name_key")


def unjudged_count(contacts: DataFrame, verdicts: DataFrame, register_sources: tuple[str, ...] = ("register",)) -> DataFrame:
    """One row: distinct lower-cased names without a verdict on the name as written."""
    scraped = contacts.where(F.col("contact_name").isNotNull() & ~F.col("source").isin(*register_sources)).select(F.lower("contact_name").alias("k")).distinct()
    return scraped.join(verdicts.select(F.lower("name").alias("k")), "k", "left_anti").agg(F.count("*").alias("unjudged"))


def apply_verdicts(contacts: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Names judged no person go with their role (the address stays); others are rewritten as cleaned."""
    v = verdicts.select("name_norm", "is_person", "cleaned_name").dropDuplicates(["name_norm"])
    rows = contacts.withColumn("name_norm", normalise_name(F.col("contact_name"))).join(v, "name_norm", "left")
    no = F.coalesce(F.col("is_person") == 0, F.lit(False))
    name = F.when(no, F.lit(None)).when(F.col("is_person") == 1, F.coalesce(F.nullif("cleaned_name", F.lit("")), "contact_name")).otherwise(F.col("contact_name"))
    return rows.withColumns({"contact_role": F.when(~no, F.col("contact_role")), "contact_name": name}).select(*contacts.columns)


def name_evidence(names: DataFrame, given: DataFrame, name: str = "name") -> DataFrame:
    """Adds first_is_given, any_is_given (either half of a hyphenated name counts), is_address and a hint. given(name):
    folded given names; it joins by name, so it may have any size."""
    words = F.filter(F.split(F.lower(fold(F.trim(F.col(name)))), "\\s+"), lambda w: w != "")
    rows = names.withColumn("__id", F.monotonically_increasing_id())
    parts = rows.select("__id", F.posexplode(words).alias("pos", "w")).select("__id", "pos", F.explode(F.array_distinct(F.concat(F.array("w"), F.split("w", "-")))).alias("w"))
    known = parts.join(given.select(F.lower(fold(F.col("name"))).alias("w")).distinct(), "w", "left_semi").groupBy("__id").agg((F.min("pos") == 0).alias("first_is_given"))
    street = F.exists(words, lambda w: w.rlike("^(tee|pst|mnt|tn|katu|tie|puiestee|maantee)[.,]?$") | w.rlike("^.{3,}(katu|tie|kuja|polku|raitti|vayla|aukio|esplanadi|bulevardi|gatan|vagen|tanav|maantee|puiestee)[.,]?$"))
    out = rows.join(known, "__id", "left").withColumns({"any_is_given": F.col("first_is_given").isNotNull(), "first_is_given": F.coalesce("first_is_given", F.lit(False)), "is_address": street}).drop("__id")
    hint = F.concat_ws("; ", F.when(F.col("first_is_given"), "first word is a known given name").otherwise("first word is not in the given-name list"), F.when(~F.col("first_is_given") & F.col("any_is_given"), "but a later word is a given name"), F.when(F.col("is_address"), "contains a street-name ending"))
    return out.withColumn("hint", hint)


def names_from_addresses(contacts: DataFrame, given: DataFrame) -> DataFrame:
    """Fills a missing name from first.last@ where first is a known given name and the inbox isn't shared."""
    parts = F.filter(F.split(email_local(F.col("email")), "[._+\\-]"), lambda p: (p != "") & ~p.rlike("^[0-9]+$"))
    rows = contacts.withColumn("__parts", F.when(F.col("contact_name").isNull() & F.col("email").contains("@") & ~shared_inbox(F.col("email")), parts)).withColumn("__first", F.try_element_at("__parts", F.lit(1)))
    known = given.select(F.lower(fold(F.col("name"))).alias("__first"), F.lit(True).alias("__known")).distinct()
    second = F.try_element_at("__parts", F.lit(2))
    name = F.when(F.length(second) > 2, F.concat_ws(" ", F.initcap("__first"), F.initcap(second))).when((F.size("__parts") > 1) | (F.length("__first") > 2), F.initcap("__first"))
    return rows.join(known, "__first", "left").withColumn("contact_name", F.coalesce("contact_name", F.when(F.col("__known"), name))).select(*contacts.columns)


def judgement_batch(candidates: DataFrame, given: DataFrame) -> DataFrame:
    """Candidates with their evidence, to be judged elsewhere."""
    return name_evidence(candidates, given, "name").select("name", "contact_role", "email", "venues", "first_is_given", "any_is_given", "is_address", "hint")


def address_candidates(name: Column, domain: Column, known: Column) -> Column:
    """Addresses a person may have, likeliest first; the shape that the domain's known addresses have comes first."""
    words = F.filter(F.split(F.lower(F.regexp_replace(fold(name), "[^\\w\\s\\-]", " ")), "\\s+"), lambda w: (F.length(w) > 1) & ~w.isin(*fixed.NAME_PARTICLES))
    bare = lambda w: F.regexp_replace(w, "[^a-z0-9]", "")
    first, last = bare(F.try_element_at(words, F.lit(1))), bare(F.try_element_at(words, F.lit(-1)))
    host = F.regexp_replace(F.lower(F.trim(domain)), "^www\\.", "")
    at = lambda local: F.concat(local, F.lit("@"), host)
    shapes = [first, F.concat(first, F.lit("."), last), F.concat(F.substring(first, 1, 1), F.lit("."), last), F.concat(first, last)]
    parts = lambda a: F.filter(F.split(email_local(a), "[._\\-]"), lambda p: p != "")
    shape = F.try_element_at(F.filter(F.transform(F.coalesce(known, F.array()), lambda a: F.when(F.size(parts(a)) == 2, F.when(F.length(parts(a)[0]) == 1, "f.last").otherwise("first.last")).when((F.size(parts(a)) == 1) & (F.length(F.get(parts(a), F.lit(0))) > 3), "one")), lambda s: s.isNotNull()), F.lit(1))
    front = F.when(shape == "first.last", F.array(at(shapes[1]))).when(shape == "f.last", F.array(at(shapes[2]))).otherwise(F.array().cast("array<string>"))
    usable = (F.size(words) >= 2) & (first != "") & (last != "") & host.contains(".")
    return F.when(usable, F.array_distinct(F.concat(front, F.array(*[at(s) for s in shapes])))).otherwise(F.array().cast("array<string>"))


def address_patterns(people: DataFrame, needy: DataFrame, sites: DataFrame, contacts: DataFrame) -> DataFrame:
    """The likeliest address of each named person without one at venues that need it, marked as a guess."""
    known = contacts.where("email is not null").groupBy(email_domain(F.col("email")).alias("domain")).agg(F.array_sort(F.collect_set("email")).alias("known"))
    rows = people.where("contact_name is not null and email is null").join(needy.select("venue_id"), "venue_id", "left_semi").join(sites.select("venue_id", "domain").where("domain is not null"), "venue_id").join(known, "domain", "left")
    return rows.withColumn("email", F.try_element_at(address_candidates(F.col("contact_name"), F.col("domain"), F.col("known")), F.lit(1))).where("email is not null").select("venue_id", "contact_name", "email", F.lit("low").alias("confidence"), F.lit("unknown").alias("verification_status"), F.lit("pattern_guess").alias("source"))


def map_verification(results: DataFrame, word: str = "result") -> DataFrame:
    """Adds verification_status and the confidence that follows from a verifier's word."""
    w = F.lower(F.coalesce(word, F.lit("")))
    status = F.when(w.isin("ok", "valid", "deliverable"), "deliverable").when(w.isin("catch_all", "catch-all", "accept_all", "accept-all"), "accept_all").when(w.isin("invalid", "undeliverable", "disposable", "bad"), "undeliverable").otherwise("unknown")
    rows = results.withColumn("verification_status", status)
    s = F.col("verification_status")
    return rows.withColumn("confidence", F.when(s == "deliverable", "verified").when(s == "accept_all", "catchall_guess").when(s == "undeliverable", "low").otherwise("unverified"))


def registrant_names(whois: DataFrame, text: str = "text") -> DataFrame:
    """Adds registrant: the first labelled line of two words or more and at most 80 characters that isn't withheld."""
    lines = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit("(?im)^\\s*(?:registrant(?: name)?|holder|name|person)\\s*[:.]+\\s*(\\S.*?)\\s*$"), F.lit(1))
    fine = F.filter(lines, lambda n: (F.size(F.split(n, "\\s+")) >= 2) & (F.length(n) <= 80) & ~F.lower(n).rlike("privacy|redacted|protected|withheld|gdpr"))
    return whois.withColumn("registrant", F.try_element_at(fine, F.lit(1)))


def jobad_match(ads: DataFrame, venues: DataFrame, text: str = "text") -> DataFrame:
    """Captured job ads that name their venue; ads of an Estonian board count for Estonian venues only."""
    rows = ads.join(venues.select("venue_id", "name", "country"), "venue_id")
    return rows.where(F.lower(text).contains(F.lower("name")) & ((F.col("board_country") == F.col("country")) | F.col("board_country").isNull())).drop("name", "country")


def jobad_contacts(ads: DataFrame, venues: DataFrame, text: str = "text", url: str = "url") -> DataFrame:
    """Incoming contacts of the job ads that name their venue, at medium confidence whatever their channel."""
    found = harvest_contacts(jobad_match(ads, venues, text), ["venue_id", url], text)
    return found.select("venue_id", "email", "contact_name", "contact_role", F.lit("jobad").alias("source"), F.col(url).alias("source_url"), F.lit("medium").alias("confidence"), F.lit(None).cast("string").alias("verification_status"))


def cms_user_contacts(users: DataFrame, url: str = "url") -> DataFrame:
    """Incoming contacts of a content system's users (pages.cms_user_names, with venue_id): names only, at low confidence."""
    none = F.lit(None).cast("string")
    return users.select("venue_id", none.alias("email"), "contact_name", none.alias("contact_role"), F.lit("website_cms_user").alias("source"), F.col(url).alias("source_url"), F.lit("low").alias("confidence"), none.alias("verification_status")).distinct()


def off_domain_chosen(contacts: DataFrame, sites: DataFrame) -> DataFrame:
    """Off-domain contacts among those that the sheet chooses."""
    from .sheet import best_email_contact

    return off_domain_contacts(best_email_contact(contacts), sites)


def off_domain_contacts(contacts: DataFrame, sites: DataFrame) -> DataFrame:
    """Contacts whose address is neither at the venue's site nor at a subdomain of it."""
    domain = email_domain(F.col("email"))
    rows = contacts.where("email is not null").join(sites.select("venue_id", F.lower("domain").alias("site_domain")).where("domain is not null"), "venue_id")
    return rows.withColumn("email_domain", domain).where((domain != F.col("site_domain")) & ~domain.endswith(F.concat(F.lit("."), F.col("site_domain"))))
