"""Exact dedup, chat formatting and personal data against plain versions."""

from __future__ import annotations

import hashlib
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from tidemark import session
from tidemark.llm import chat, exact_dedup, pii

ODD = [None, "", "a", "A", "Ä", "ä", "a", "x" * 50_000, "X" * 50_000, None]


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def plain_groups(rows):
    groups = {}
    for i, text in rows:
        groups.setdefault(lower(text), []).append(i)
    return {
        (i, max(ids), len(ids), i == max(ids), hashlib.sha256(key.encode()).hexdigest())
        for key, ids in groups.items()
        for i in ids
    }


@pytest.mark.parametrize("parted", [False, True])
def test_exact_dedup(make_docs, parted):
    docs = make_docs(ODD).withColumn("digest", F.lit("clash")).withColumn("keep_id", F.lit(3))
    got = exact_dedup.dedup(docs, exact_dedup.halves(docs) if parted else None)
    assert {tuple(r) for r in got.collect()} == plain_groups(list(enumerate(ODD)))


def test_exact_dedup_of_nothing(make_docs):
    docs = make_docs([])
    assert exact_dedup.dedup(docs, exact_dedup.halves(docs)).count() == 0
    assert exact_dedup.keep_one(docs).columns == docs.columns


def test_index_persists(spark, make_docs):
    path = session.scratch_path(spark, "index")
    first = exact_dedup.DigestIndex(spark, path)
    first.append(exact_dedup.digests(make_docs([(1, "a"), (2, "b"), (3, "B")])))
    first.drop()
    again = exact_dedup.DigestIndex(spark, path)
    again.append(exact_dedup.digests(make_docs([(4, "A"), (5, "c")])))
    assert sorted(r.keep_id for r in again.rows().collect()) == [1, 3, 5]


@pytest.mark.parametrize("made,opened", [(16, 4), (4, 16)])
def test_index_keeps_its_buckets(spark, make_docs, made, opened):
    """Texts stored by one session are known to the next, whatever its shuffle partitions."""
    path = session.scratch_path(spark, "index")
    docs = make_docs([f"text {i}" for i in range(300)])
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in (made, opened):
            spark.conf.set("spark.sql.shuffle.partitions", str(n))
            index = exact_dedup.DigestIndex(spark, path)
            index.append(exact_dedup.digests(docs))
            assert index.buckets == made
            assert index.rows().count() == index.rows().distinct().count() == 300
            assert exact_dedup.dedup(docs, path=path).where("kept").count() == 300
            index.drop()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    with pytest.raises(exact_dedup.IndexMismatch):
        exact_dedup.DigestIndex(spark, path, made + 1)


def test_indexes_do_not_meet(spark, make_docs):
    """Paths that differ in a sign only, or beyond their last sixty, are indexes of their own."""
    root = session.scratch_path(spark, "index")
    for at, path in enumerate((f"{root}/a-b", f"{root}/a_b", f"{root}/x/{'y' * 70}", f"{root}/z/{'y' * 70}", f"{root}/it's")):
        index = exact_dedup.DigestIndex(spark, path)
        assert index.rows().count() == 0
        index.append(exact_dedup.digests(make_docs([f"{at} {i}" for i in range(5)])))
        assert index.rows().count() == 5
    spark.range(3).write.parquet(f"{root}/other")
    with pytest.raises(exact_dedup.IndexMismatch):
        exact_dedup.DigestIndex(spark, f"{root}/other")


def test_members_read_the_index_by_its_buckets(spark, make_docs):
    index = exact_dedup.DigestIndex(spark, session.scratch_path(spark, "index"))
    seen = exact_dedup.digests(make_docs(["a", "b"]))
    index.append(seen)
    plan = exact_dedup.classes(index, seen)._jdf.queryExecution().toString()
    assert plan.split("Physical Plan")[1].count("Exchange") == 1


def test_keep_one_with_clashing_names(make_docs):
    docs = make_docs([(1, "a"), (1, "a"), (2, "A"), (None, "z"), (-1, "z")])
    for name in ("_id", "_digest", "digest", "DIGEST_", "keep_id", "id"):
        docs = docs.withColumn(name, F.lit(name))
    got = exact_dedup.keep_one(docs)
    assert got.columns == docs.columns
    assert sorted((r.doc_id, r["_id"], r.digest) for r in got.collect()) == [(-1, "_id", "digest"), (2, "_id", "digest")]


def test_index_is_joined_by_its_buckets(spark, make_docs):
    index = exact_dedup.DigestIndex(spark, session.scratch_path(spark, "index"))
    index.append(exact_dedup.digests(make_docs(["a", "b"])))
    new = exact_dedup.digests(make_docs(["a", "c"])).repartition(index.buckets, "digest")
    plan = new.join(index.rows().hint("merge"), "digest", "left_anti")._jdf.queryExecution().toString()
    assert plan.split("Physical Plan")[1].count("Exchange") == 1


def test_keep_one_repeated_rows(make_docs):
    docs = make_docs([(1, "a"), (1, "a"), (1, "b"), (2, "A"), (None, "z"), (None, None)])
    got = sorted((r.doc_id or 0, r.text or "") for r in exact_dedup.keep_one(docs).collect())
    assert got == [(0, ""), (0, "z"), (1, "b"), (2, "A")]


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (2 if k % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def plain_base(text):
    """The base spans by the plain expressions."""
    out = []
    text = text or ""
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append(("email", *m.span()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append(("phone", *m.span()))
    return out


def found(docs):
    rows = pii.spans(docs).collect()
    return {r.doc_id: [(s["kind"], s["first"], s["last"]) for s in r.spans] for r in rows}


def odd_texts(n, seed):
    rng = random.Random(seed)
    bits = ["a", "b.c", "@", ".", "1", "22", "255", "256", "0", "+", "-", " ", "(", ")", "_", "é", "😀",
            "4111111111111111", "4111 1111 1111 1111", "x@y.zz", "1.2.3.4", "+1 202 555 0147", "\n", "00012"]
    return ["".join(rng.choices(bits, k=rng.randint(0, 30))) for _ in range(n)]


def test_pii_base_spans(make_docs):
    texts = [None, "", *odd_texts(1500, 7), "a" * 30_000, "1" * 30_000, "1." * 9_000, "a@" + "b." * 9_000, "+1" * 9_000,
             "x " * 20_000 + "me@here.org"]
    got = found(make_docs(texts))
    for i, text in enumerate(texts):
        assert [s for s in got[i] if s[0] in pii.BASE] == plain_base(text), text


def test_pii_many_matches(make_docs):
    """The time grows with the number of matches in a text."""
    texts = [" ".join(f"10.{i % 256}.{i // 256}.7 a{i}@b.cc" for i in range(n)) for n in (255, 256, 257, 10_000)]
    texts.append("DE89 3704 0044 0532 0130 00 " * 600)
    started = time.time()
    got = found(make_docs(texts))
    assert time.time() - started < 20
    for i, text in enumerate(texts):
        assert [s for s in got[i] if s[0] in pii.BASE] == plain_base(text)
    assert len([s for s in got[4] if s[0] == "iban"]) == 600


def test_pii_ips_with_zeros(make_docs):
    """Parts of zeros, alone and before other digits, up to the limit and over it."""
    ips = ["10.0.0.1", "192.168.0.1", "127.0.0.1", "0.0.0.0", "00.1.2.3", "1.2.3.00", "000.000.000.000", "010.001.1.1",
           "0255.1.1.099", "100.200.250.255", "0256.0.0.0", "1.0.300.0", "0.0.0.1000", "0.0.0", "1.2.3.256", "0" * 3000 + ".0.0.1"]
    texts = [f"at {ip} ok" for ip in ips] + [" ".join(ips)]
    got = found(make_docs(texts))
    assert sum(len(got[i]) for i in range(len(ips))) == 11
    for i, text in enumerate(texts):
        assert [s for s in got[i] if s[0] in pii.BASE] == plain_base(text), text


def test_pii_added_spans_and_scores(make_docs):
    texts = ["IBAN GB82 WEST 1234 5698 7654 32 ok", "code GB82 WEST 1234 5698 7654 33 ok", "my ssn is 123-45-6789", "id 123-45-6789"]
    got = found(make_docs(texts))
    assert got == {0: [("iban", 5, 32)], 1: [], 2: [("ssn", 10, 21)], 3: []}
    near, far = pii.spans(make_docs(["call +1 202 555 0147", "so +1 202 555 0147"])).orderBy("doc_id").collect()
    assert near.spans[0]["score"] > far.spans[0]["score"] >= pii.THRESHOLD


def test_pii_ibans_before_other_words(make_docs):
    """What follows after a space, or a beginning that fails, hides no code."""
    codes = ["DE89 3704 0044 0532 0130 00", "DE89370400440532013000", "GB82 WEST 1234 5698 7654 32", "NO93 8601 1117 947",
             "MT84 MALT 0110 0001 2345 MTLC AST0 01S", "FR14 2004 1010 0505 0001 3M02 606", "LC55HEMM000100010012001200023015"]
    texts, want = [], []
    for code in codes:
        for after in ("", ".", " ok", " Today", " AND", " Bank", " 17", " A", " 0000 0000 0000 0000", " €"):
            for before in ("", "é ", "AB12 ", "AT12 ", "DE00 3704 0044 0532 0130 00 "):
                texts.append(before + code + after)
                want.append([("iban", len(before), len(before) + len(code))])
    texts += [f"{codes[0]} {codes[2]} {codes[1]}", codes[0] + "1", codes[0] + "x", "X" + codes[0], codes[0][:-1], "DE88" + codes[0][4:] + " Bank"]
    want += [[("iban", 0, 27), ("iban", 28, 55), ("iban", 56, 78)], [], [], [], [], []]
    got = found(make_docs(texts))
    for i, text in enumerate(texts):
        assert [s for s in got[i] if s[0] == "iban"] == want[i], text


def test_redact(make_docs):
    rows = pii.redact(make_docs(["é me@x.org and +1 202 555 0147.", None])).orderBy("doc_id").collect()
    assert [r.text for r in rows] == ["é [email] and [phone].", ""]


def plain_chat(rows):
    logs = {}
    for conv, turn, role, text in sorted(set((c, t, r or "user", x or "") for c, t, r, x in rows if c is not None)):
        logs.setdefault(conv, []).append((role, text))
    out = {}
    for conv, said in sorted(logs.items()):
        longer = any(len(o) > len(said) and o[: len(said)] == said for o in logs.values())
        if not longer and said not in [v for v in out.values()]:
            out[conv] = said
    return {
        (c, len(said), "".join(f"<|im_start|>{r}\n{t}<|im_end|>\n" for r, t in said)) for c, said in out.items()
    }


def test_chat(spark):
    rng = random.Random(3)
    rows = []
    base = [[("user" if k % 2 == 0 else "assistant", rng.choice("abc")) for k in range(6)] for _ in range(5)]
    for conv in range(60):
        said = rng.choice(base)[: rng.randint(1, 6)]
        rows += [(conv, k, role, text) for k, (role, text) in enumerate(said)]
    rows += [(99, 0, None, None), (None, 0, "user", "lost"), (98, 0, "user", ""), (97, 0, "user", "q"), (97, 0, "user", "q")]
    rows += [(100 + k, j, "user", f"t{j}") for k in range(30) for j in range(k + 1)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("n", F.lit(7))
    assert {tuple(r) for r in chat.chat_format(frame).collect()} == plain_chat(rows)
    assert chat.chat_format(frame.limit(0)).count() == 0
