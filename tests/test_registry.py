from __future__ import annotations

import random
import re
import time
from datetime import date

import pytest

from tidemark.operators import registry
from tidemark.schema import tables
from tidemark.schema.flat import reserved_names

SUFFIX = {"string_value": "str", "int_value": "int", "float_value": "float",
          "double_value": "double"}
EP, UP = "event_params", "user_properties"


def name(spark, triples, taken=()):
    new = spark.createDataFrame(triples, "source string, key string, sub_field string")
    used = spark.createDataFrame([(t,) for t in taken], "column_name string")
    return {tuple(r)[:3]: r.column_name for r in registry.name_columns(new, used).collect()}


@pytest.mark.parametrize("source, key, sub, taken, want", [
    (EP, "ga_session_id", "int_value", (), "ga_session_id_int"),
    (EP, "screen", "string_value", (), "screen_str"),
    (EP, "value", "float_value", (), "value_float"),
    (EP, "value", "double_value", (), "value_double"),
    (UP, "_worth", "int_value", (), "_worth_int"),
    (UP, "user_id", "string_value", (), "up_user_id_str"),
    (UP, "value", "int_value", ("value_int",), "up_value_int"),
    (EP, "value", "int_value", ("value_int",), "ep_value_int"),
    (EP, "value", "int_value", ("value_int", "ep_value_int"), "ep_value_int2"),
    (EP, "odd key?y", "string_value", (), "odd_key_y_str"),
    (EP, "7th_try", "int_value", (), "_7th_try_int"),
    (EP, "", "int_value", (), "_empty_int"),
])
def test_names(spark, source, key, sub, taken, want):
    assert name(spark, [(source, key, sub)], taken) == {(source, key, sub): want}


def test_names_differing_only_in_case_do_not_meet(spark):
    got = name(spark, [(EP, "Screen", "string_value"), (EP, "screen", "string_value")])
    assert got == {(EP, "Screen", "string_value"): "Screen_str",
                   (EP, "screen", "string_value"): "ep_screen_str"}


def one_by_one(triples, taken):
    """The naming rule applied strictly in order."""
    used = {n.lower() for n in reserved_names()} | {t.lower() for t in taken}
    names = {}
    for source, key, sub in sorted(triples, key=lambda t: (t[0], t[1], list(SUFFIX).index(t[2]))):
        stem = re.sub("[^0-9A-Za-z_]", "_", key) or "_empty"
        stem = "_" + stem if stem[0].isdigit() else stem
        stem = "up_user_id" if (source, key) == (UP, "user_id") else stem
        plain = f"{stem}_{SUFFIX[sub]}"
        prefixed = ("ep_" if source == EP else "up_") + plain
        options = [plain, prefixed] + [f"{prefixed}{i}" for i in range(2, 500)]
        chosen = next(o for o in options if o.lower() not in used)
        used.add(chosen.lower())
        names[source, key, sub] = chosen
    return names


@pytest.mark.parametrize("seed", range(3))
def test_names_equal_the_rule_applied_one_by_one(spark, seed):
    rng = random.Random(seed)
    parts = ["a", "ep_a", "up_a", "ep_up_a", "A", "a-", "a.", "a_", "user_id", "up_user_id",
             "ep_ep_a", "1", "_1", "", "geo_city", "ép", "event"]
    triples = {(rng.choice([EP, UP]), rng.choice(parts) + rng.choice(["", "", "!", "-x"]),
                rng.choice(list(SUFFIX))) for _ in range(80)}
    taken = ["a_int", "ep_a_int", "up_a_str2", "ep_a__int", "ep_a_int3"]
    assert name(spark, list(triples), taken) == one_by_one(triples, taken)


def test_numbers_fill_the_gaps(spark):
    """Numbers go to the gaps between the taken ones, in order, past 1 and leading zeros."""
    keys = ["a" + sign for sign in ",;:!?/()[]{}"]
    triples = {(EP, key, "int_value") for key in keys}
    taken = ["a__int", "ep_a__int2", "EP_A__INT4", "ep_a__int5", "ep_a__int1", "ep_a__int07", "ep_a__int11", "ep_a__int99"]
    assert name(spark, list(triples), taken) == one_by_one(triples, taken)


def test_many_clashing_keys(spark):
    """Thousands of keys that clean up to one name, in a few rounds."""
    signs = "!?.,;:/()[]{}<>|^~+*=%&$#@"
    rng = random.Random(4)
    keys = set()
    while len(keys) < 5000:
        keys.add("".join(["n", *rng.choices(signs, k=3), rng.choice("AaBb")]))
    triples = [(EP, key, "int_value") for key in sorted(keys)]
    name(spark, triples[:10])
    started = time.time()
    got = name(spark, triples, ["ep_n____a_int7", "n____b_int"])
    assert time.time() - started < 10
    want, used = {}, {"ep_n____a_int7", "n____b_int"}
    counters = {}
    for source, key, sub in triples:
        plain = re.sub("[^0-9A-Za-z_]", "_", key) + "_int"
        low, number = plain.lower(), counters.get(plain.lower(), 2)
        options = [plain, f"ep_{plain}"]
        chosen = next((o for o in options if o.lower() not in used), None)
        while chosen is None:
            chosen = f"ep_{plain}{number}" if f"ep_{low}{number}" not in used else None
            number += 1
        counters[low] = number
        used.add(chosen.lower())
        want[source, key, sub] = chosen
    assert got == want


FOUND = "source string, key string, sub_field string, _dt date, n bigint"
D1, D2, D3 = date(2024, 1, 1), date(2024, 1, 2), date(2024, 1, 3)


def rows(df):
    return {(r.source, r.key, r.sub_field): (r.column_name, r.column_type, r.first_seen,
                                             r.last_seen, r.n_seen) for r in df.collect()}


def known(spark):
    from datetime import datetime

    first = (EP, "k", "int_value", "old_name_int", "bigint", D2, D2)
    return spark.createDataFrame([
        (*first, 3, datetime(2024, 1, 2)), (*first, 5, datetime(2024, 1, 3)),
    ], tables.REGISTRY)


def test_latest_row_counts(spark):
    assert rows(registry.latest(known(spark))) == {
        (EP, "k", "int_value"): ("old_name_int", "bigint", D2, D2, 5)}


def test_upsert_keeps_the_name_and_adds_the_counts(spark):
    found = spark.createDataFrame([
        (EP, "k", "int_value", D1, 2), (EP, "k", "int_value", D3, 4), (UP, "k", "int_value", D3, 1),
    ], FOUND)
    assert rows(registry.upsert(registry.latest(known(spark)), found)) == {
        (EP, "k", "int_value"): ("old_name_int", "bigint", D2, D3, 11),
        (UP, "k", "int_value"): ("k_int", "bigint", D3, D3, 1),
    }


def test_from_counts_does_not_add_up_on_a_rerun(spark):
    counts = spark.createDataFrame([
        (EP, "k", "int_value", D1, 2), (EP, "k", "int_value", D2, 3)], FOUND)
    want = {(EP, "k", "int_value"): ("old_name_int", "bigint", D1, D2, 5)}
    assert rows(registry.from_counts(registry.latest(known(spark)), counts)) == want
