"""The merge of contacts against one that reads every row of a venue in order."""

import random

from leadloom.operators import contacts as c

from .test_contacts import INCOMING


def brute(rows):
    out = {}
    for seq, venue, email, name, role, source, *_ in sorted(rows):
        own = out.setdefault(venue, [])
        email, name, role = (email or "").strip().lower() or None, name or None, role or None
        norm, key = (name or "").lower(), f"name:{(name or '').lower()}" if name else None
        if not email and not key:
            continue
        hit, promote = next((x for x in own if email and x["key"] == email), None), False
        if hit is None and key:
            hit = next((x for x in own if x["name"] and x["norm"] == norm), None)
            if hit is not None and email:
                hit, promote = (None, False) if hit["email"] else (hit, True)
        if hit is None:
            own.append({"email": email, "name": name, "role": role, "source": source, "key": email or key, "seq": seq, "norm": norm})
            continue
        if hit["name"] is None and name:
            hit["norm"] = norm
        hit["name"], hit["role"], hit["email"] = hit["name"] or name, hit["role"] or role, hit["email"] or email
        if promote:
            hit |= {"key": email, "source": source}
    return sorted(str((v, x["email"], x["name"], x["role"], x["source"], x["key"], x["seq"])) for v, own in out.items() for x in own)


def resolved(spark, rows):
    got = c.resolve_contacts(spark.createDataFrame([], c.CONTACT), spark.createDataFrame(rows, INCOMING).repartition(3))
    return sorted(str(tuple(r)) for r in got.select("venue_id", "email", "contact_name", "contact_role", "source", "dedupe_key", "first_seq").collect())


def test_as_in_order(spark):
    rng = random.Random(14)
    rows = []
    for k in range(900):
        email = rng.choice([None, None, "", f" X{rng.randint(0, 25)}@A.fi "])
        name = rng.choice([None, f"Anu {'abcdefghijklmnop'[rng.randint(0, 15)]}lo", f"ANU {'abcdefghijklmnop'[rng.randint(0, 15)]}lo"])
        rows.append((k, rng.randint(1, 12), email, name, rng.choice([None, None, f"r{k}"]), f"s{k}", None, "high", None))
    assert resolved(spark, rows) == brute(rows)


def test_a_venue_is_not_merged_in_one_task(spark):
    # one venue with a common name: rows that can't be one contact don't meet, repeats of an address fold away
    rows = [(k, 1, f"a{k % 300}@x{k % 300}.fi", "Info", None, "s", None, "high", None) for k in range(1500)]
    got = c.resolve_contacts(spark.createDataFrame([], c.CONTACT), spark.createDataFrame(rows, INCOMING))
    assert got.count() == 300
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Pandas" not in plan and "Arrow" not in plan  # no rows of a venue, or of linked contacts, meet in a task's memory
