"""JSON semantics: literal messages in, exact rows out."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from crowdpulse.operators.messages import flatten_users, judged, parse_flat, quarantine, usable
from crowdpulse.schemas import USERS, envelope_schema

NOTHING = (None, None, None, None, None)

FLAT_CASES = {
    '{"id":1,"name":"n","email":"e","age":3,"country":"FR"}': (1, "n", "e", 3, "FR"),
    '{"results":[{"id":1}],"ingestion_timestamp":5}': NOTHING,
    '{"name":{"first":"A","last":"B"},"email":"e","dob":{"age":3}}': (
        None, '{"first":"A","last":"B"}', "e", None, None,
    ),
    '{"id":{"name":"x"},"name":"n","age":3}': (None, "n", None, 3, None),
    '{"id":1,"age":"34"}': (1, None, None, None, None),
    '{"id":1,"age":34.0}': (1, None, None, None, None),
    '{"id":1,"age":34.7}': (1, None, None, None, None),
    '{"id":99999999999,"name":"z"}': (None, "z", None, None, None),
    '{"ID":1,"Name":"n"}': NOTHING,
    '{"id":1,"id":2}': (2, None, None, None, None),
    '{"id":1,"zz":2}': (1, None, None, None, None),
    '{"id":1} junk': (1, None, None, None, None),
    '{"id":1, "name":': NOTHING,
    "null": NOTHING,
    "5": NOTHING,
    '[{"id":1}]': NOTHING,
    '[{"id":1},{"id":2}]': NOTHING,
    "": NOTHING,
    "   ": NOTHING,
}


@pytest.mark.parametrize("text", FLAT_CASES)
def test_flat_record(messages, text):
    assert [tuple(row) for row in parse_flat(messages(text)).collect()] == [FLAT_CASES[text]]


def test_flat_keeps_one_row_per_message(messages):
    rows = parse_flat(messages(*FLAT_CASES, None)).collect()
    assert len(rows) == len(FLAT_CASES) + 1


def user(uuid="u1", first="Ana", last="Né", country="France", age=30, gender="female", email="a@b"):
    return {
        "gender": gender,
        "name": {"title": "Ms", "first": first, "last": last},
        "location": {"street": {"number": 1}, "country": country},
        "email": email,
        "login": {"uuid": uuid, "username": "x"},
        "dob": {"date": "1990-01-01T00:00:00Z", "age": age},
        "nat": "FR",
    }


def envelope(*users, stamp=1704067200):
    return json.dumps({"results": users, "info": {"page": 1}, "ingestion_timestamp": stamp})


def test_envelope_gives_the_seven_columns(messages):
    rows = flatten_users(messages(envelope(user(), user("u2", last=None)))).collect()
    when = dt.datetime(2024, 1, 1)
    assert [tuple(row) for row in rows] == [
        ("u1", "female", "Ana Né", "France", 30, "a@b", when),
        ("u2", "female", "Ana", "France", 30, "a@b", when),
    ]
    assert flatten_users(messages("{}")).schema.names == USERS.names


def test_envelope_without_users_gives_no_row(messages):
    empty = messages(envelope(), '{"ingestion_timestamp":1}', "", None, "{bad", "null")
    assert flatten_users(empty).count() == 0


def test_arrival_columns_place_each_user(messages):
    frame = messages(envelope(user("a"), user("b")), envelope(user("c")), first_offset=7, partition=3)
    rows = flatten_users(frame, ("user_id",), with_arrival=True).collect()
    assert [tuple(r) for r in rows] == [("a", 3, 7, 0), ("b", 3, 7, 1), ("c", 3, 8, 0)]


def test_bad_field_keeps_the_rest_of_the_user(messages):
    rows = flatten_users(messages(envelope(user("a", age="34"), user("b")))).collect()
    assert [(r.user_id, r.age, r.country) for r in rows] == [("a", None, "France"), ("b", 30, "France")]


def test_few_columns_parse_few_fields():
    assert envelope_schema(("country",)).simpleString() == (
        "struct<results:array<struct<location:struct<country:string>>>,ingestion_timestamp:bigint>"
    )


def test_json_is_parsed_once(messages):
    counted = flatten_users(messages(envelope(user())).where("offset >= 0")).groupBy("country").count()
    plan = counted._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_every_message_is_usable_or_quarantined(messages):
    frame = messages(
        envelope(user("a"), user(None), user("b")),
        envelope(user("c"), stamp=None),
        envelope(),
        "{bad",
        "   ",
        None,
        "5",
        envelope(user("d", age="x")),
    )
    bad = quarantine(frame).orderBy("offset").collect()
    assert [(r.offset, [tuple(e) for e in r.reasons]) for r in bad] == [
        (0, [(1, "no user_id")]),
        (1, [(0, "no ingestion_time")]),
        (2, [(None, "no users")]),
        (3, [(None, "malformed")]),
        (4, [(None, "empty message")]),
        (5, [(None, "empty message")]),
        (6, [(None, "malformed")]),
    ]
    assert bad[3].value == "{bad"
    good = usable(flatten_users(frame))
    assert sorted(r.user_id for r in good.collect()) == ["a", "b", "d"]
    kept = judged(frame).agg(F.sum(F.greatest(F.col("n_users") - F.size("reasons"), F.lit(0))))
    assert kept.first()[0] == good.count()
    plan = quarantine(frame)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


@pytest.mark.parametrize("stamp", [10**18, 1704067200000, -1, 253_402_300_800])
def test_a_wild_stamp_is_set_aside_and_stops_nothing(messages, stamp):
    frame = messages(envelope(user("a"), stamp=stamp), envelope(user("b")))
    assert [r.user_id for r in usable(flatten_users(frame)).collect()] == ["b"]
    (bad,) = quarantine(frame).collect()
    assert [tuple(e) for e in bad.reasons] == [(0, "bad ingestion_time")]


def test_many_keyless_users_keep_one_copy_of_the_text(messages):
    frame = messages(envelope(*[user(None) for _ in range(200)]))
    (bad,) = quarantine(frame).collect()
    assert [e.pos for e in bad.reasons] == list(range(200))


def test_an_age_of_the_wrong_type_is_told_apart_from_none(messages):
    def user(age):
        return f'{{"login":{{"uuid":"u"}},"dob":{{{age}}}}}'

    ages = ['"age":34', '"age":"x"', '"age":"34"', '"age":34.7', '"age":null', "", '"age":{"a":1}', '"age":99999999999']
    whole = f'{{"results":[{",".join(map(user, ages))}],"ingestion_timestamp":5}}'
    keyless = '{"results":[{"login":{},"dob":{"age":"x"}}],"ingestion_timestamp":5}'
    frame = messages(whole, keyless)
    rows = {r.offset: r for r in quarantine(frame, with_warnings=True).collect()}
    assert [(w.pos, w.reason) for w in rows[0].warnings] == [(i, "bad age") for i in (1, 2, 3, 6, 7)]
    assert rows[0].reasons == [] and rows[1].warnings == []
    stored = flatten_users(frame, ("user_id", "age")).where("user_id IS NOT NULL").collect()
    assert [r.age for r in stored] == [34, None, None, None, None, None, None, None]
    fine = messages('{"results":[{"login":{"uuid":"u"},"dob":{"age":3}}],"ingestion_timestamp":5}')
    assert quarantine(fine, with_warnings=True).count() == 0
    assert [r.offset for r in quarantine(frame).collect()] == [1]
