"""Spans of personal data against the patterns run in Python."""

from __future__ import annotations

import hashlib
import math
import random
import re

import pytest

from starmart.llm import pii
from starmart.llm.queries import op6_pii


def luhn(d):
    total = 0
    for i, c in enumerate(map(int, reversed(d))):
        c = c * 2 if i % 2 else c
        total += c - 9 if c > 9 else c
    return total % 10 == 0


def base_spans(text):
    out = []
    for kind, pattern in (
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
        ("card", r"[0-9]([\x20-]?[0-9])+"),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
    ):
        for m in re.finditer(pattern, text or ""):
            d = re.sub("[^0-9]", "", m[0])
            ok = {
                "email": True,
                "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else True,
                "card": 16 <= len(d) <= 19 and luhn(d),
                "phone": 8 <= len(d) <= 15,
            }[kind]
            if ok:
                out.append((kind, *m.span()))
    return out


def expected(text):
    found = base_spans(text)
    joined = ",".join(f"{k}:{a}:{b}" for k, a, b in found)
    counts = [sum(k == kind for k, _, _ in found) for kind in pii.KINDS]
    return (*counts, hashlib.sha256(joined.encode()).hexdigest(), found)


ODD = [
    "", None, "a@b.com_x@y.org a..b@c.d. x@y@z.co.uk., é@é.é user@-a-.-b-", "1.2.3.4.5.6.7.8 256.1.1.1 001.02.3.4 0.0.0.0 1.2.3",
    "4111 1111 1111 1111 4111-1111-1111-1111, 4111  1111 1111 1111 41111111111111111111111", "+1 (415) 555-2671 +49 30 123456 +1 2 +12345678 +1234567890123456",
    "😀 日本 a@b.co 10.0.0.1 +1 212 555 0100  12", "1" * 30_000, "a" * 30_000, "a.b" * 9000, "1 " * 20_000, "1." * 20_000, "a@" + "b." * 9000 + "c", "+" * 5000,
    "378282246310005 mail: x (at) example (dot) com, call (415) 555-2671; 2001:0db8:0000:0000:0000:ff00:0042:8329", "1-" * 15_000 + "1",
]


def texts():
    rng = random.Random(6)
    pieces = ["a", "x.y", "@", ".", "..", "-", "_", " ", "1", "23", "255", "4111111111111111", "5500 0000 0000 0004", "+", "(", ")", "é", "\n", "com", "10.1.2.3"]
    return ODD + ["".join(rng.choice(pieces) for _ in range(rng.randint(1, 25))) for _ in range(800)]


def test_strict_spans_equal_the_patterns(spark):
    docs = list(enumerate(texts()))
    df = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id long, text string, spans string").repartition(4)
    got = {r.doc_id: r for r in pii.find(df).collect()}
    assert len(got) == len(docs)
    for i, t in docs:
        *counts, digest, found = expected(t)
        r = got[i]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == counts, t
        assert r.base_sha256 == digest, t
        every = [s.split(":") for s in r.spans.split(",") if s]
        assert {(k, int(a), int(b)) for k, a, b in every} >= set(found)
        assert [(pii.KINDS.index(k), int(a)) for k, a, _ in every] == sorted((pii.KINDS.index(k), int(a)) for k, a, _ in every)


def test_looser_spans_are_added(spark):
    rows = [(i, f"Please call +1 (415) 555-{i:04} or mail me{i}@example.com from 10.0.0.{i % 250} today") for i in range(300)]
    rows += [(1000 + i, f"Please call (415) 555-{i:04} or mail me{i} (at) example (dot) com today") for i in range(30)]
    got = {r.doc_id: r.spans for r in pii.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all("phone:" in got[1000 + i] for i in range(30))
    assert got[0].startswith("email:")


def test_redaction(spark):
    rows = [(1, "mail a@b.com or +1 415 555 2671 now", 1), (2, None, 2), (3, "nothing", 3), (4, "", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, candidates int").drop("candidates")
    got = {r.doc_id: r.text for r in pii.redact(df).collect()}
    assert got == {1: "mail <email> or <phone> now", 2: None, 3: "nothing", 4: ""}


def test_redaction_keeps_columns_of_any_name(spark):
    names = ["_email", "spans", "candidates", "_weights", "kept", "text", "_base", "n"]
    row = ["a@b.com", "s", None, "w", "k", "call +1 415 555 2671", "b", "7"]
    df = spark.createDataFrame([row], ", ".join(f"{n} string" for n in names))
    got = pii.redact(df)
    assert got.columns == names and list(got.first()) == [*row[:5], "call <phone>", *row[6:]]
    alone = spark.createDataFrame([("a@b.com",), (None,)], "body string")
    assert sorted(map(tuple, pii.redact(alone, "body").collect()), key=repr) == [("<email>",), (None,)]


def test_empty_table(spark):
    assert pii.find(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    assert pii.redact(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_estimates_recover_known_reliabilities(spark, monkeypatch):
    """Simulated candidates: labelers that agree get higher rates for personal spans."""
    rows = [(0, i < 270, "a@b.com" if i < 270 else "x (at) y (dot) zz", "mail " if i % 2 and i < 270 else "", "") for i in range(300)]
    df = spark.createDataFrame([((k, 0, 5, b, t, l, r),) for k, b, t, l, r in rows], "c struct<kind:int,start:int,end:int,base:boolean,text:string,left:string,right:string>")
    found = pii.reliabilities(df)
    assert found.personal[0][2] > 0.9 and found.other[0][2] < 0.5 and found.prior[0] > 0.7


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001"])
def test_query_on_the_small_tables(spark, sf):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = op6_pii(spark, sf)
    assert "Python" not in rows._jdf.queryExecution().toString()
    for r in rows.collect():
        *counts, digest, _ = expected(docs[r.doc_id])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == counts and r.base_sha256 == digest


def made(rng, split):
    """(text, gold): one looser span a text, personal or not; train and test use other sentences."""
    a, b, c = rng.randint(201, 989), rng.randint(200, 999), rng.randint(0, 9999)
    name = rng.choice(["jane", "peter", "olga", "zed.kay", "u7"])
    yes = [
        [f"Please call ({a}) {b}-{c:04} tonight", f"tel. 0{a % 90 + 10} {b}{c:04} in the day", f"mail {name} (at) example (dot) com soon"],
        [f"you can dial ({a}) {b}-{c:04} anytime", f"Mobile: 0{a % 90 + 10} {b}{c:04}, thanks", f"Contact {name} [at] example [dot] org"],
    ][split]
    no = [
        [f"see order no {a} {b} {c:04} for it", f"Invoice {a} {b} {c:04} is due", f"isbn 9{a}{b}{c:04}{a} was printed", "we met at noon dot nobody saw"],
        [f"the item number {a} {b} {c:04} sold", f"Ticket: {a} {b} {c:04} closed", f"serial {a}{b}{c:04}{b} was sent", "look at page dot matrix prints"],
    ][split]
    return (rng.choice(yes), True) if rng.random() < 0.5 else (rng.choice(no), False)


def test_looser_spans_of_unseen_sentences(spark):
    """Sentences of the second half have other words; nothing is labelled."""
    rng = random.Random(3)
    docs = [made(rng, i % 2) for i in range(600)]
    rows = [(i, t) for i, (t, _) in enumerate(docs)] + [(1000 + i, f"Call +1 (415) 555-{i:04} or write me{i}@example.com") for i in range(200)]
    got = {r.doc_id: bool(r.spans) for r in pii.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for split in (0, 1):
        pairs = [(got[i], gold) for i, (_, gold) in enumerate(docs) if i % 2 == split]
        right = sum(g and gold for g, gold in pairs)
        assert right / max(sum(g for g, _ in pairs), 1) >= 0.95, split
        assert right / sum(gold for _, gold in pairs) >= 0.9, split


def test_votes_of_context_and_check_digits_decide(spark):
    rows = [
        (0, "order 415 555 2671"), (1, "call 415 555 2671"), (2, "Tel. 030 1234567 is mine"), (3, "pay to IBAN DE89 3704 0044 0532 0130 00 now"),
        (4, "IBAN DE89 3704 0044 0532 0130 01"), (5, "iban GB29NWBK60161331926819."), (6, "a 1300000000123 b"), (7, "write jane at example dot com today"),
        (8, "Contact us at example.com or write to us at example.org"),
    ]
    got = {r.doc_id: r.spans for r in pii.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {0: "", 1: "phone:5:17", 2: "phone:5:16", 3: "card:12:39", 4: "", 5: "card:5:27", 6: "", 7: "email:6:29", 8: ""}
    alone = pii.find(spark.createDataFrame(rows[:1], "doc_id long, text string")).first()
    assert alone.spans == ""


def test_account_check_digits(spark):
    good = ["DE89370400440532013000", "GB29NWBK60161331926819", "FR1420041010050500013M02606", "NL91ABNA0417164300", "NO9386011117947"]
    rows = [(n, True) for n in good] + [(n[:-1] + str((int(n[-1]) + 1) % 10), False) for n in good]
    df = spark.createDataFrame(rows, "n string, ok boolean")
    assert all(r.ok == r.got for r in df.select("ok", pii.account_check(df.n).alias("got")).collect())


def plain_estimates(rows):
    """Expectation-maximisation over single candidates: (group, votes)."""
    kinds = len(pii.KINDS)
    prior = [pii.STRICT_PRIOR] * kinds + [pii.LOOSE_PRIOR] * kinds
    yes, no = list(pii.YES_PERSONAL), list(pii.YES_OTHER)

    def chance(group, votes):
        a, b = prior[group], 1 - prior[group]
        for v, y, n in zip(votes, yes, no, strict=True):
            a *= {1: y, -1: 1 - y, 0: 1}[v]
            b *= {1: n, -1: 1 - n, 0: 1}[v]
        return a / (a + b)

    for _ in range(pii.ITERATIONS):
        p = [chance(*r) for r in rows]
        s = pii.STRENGTH
        of = [[x for x, r in zip(p, rows, strict=True) if r[0] == g] for g in range(2 * kinds)]
        prior = [(sum(x) + s * (pii.STRICT_PRIOR if g < kinds else pii.LOOSE_PRIOR)) / (len(x) + s) for g, x in enumerate(of)]

        def rate(weights, i, start):
            voted = [(w, r[1][i]) for w, r in zip(weights, rows, strict=True) if r[1][i]]
            return (sum(w for w, v in voted if v == 1) + s * start) / (sum(w for w, _ in voted) + s)

        yes = [rate(p, i, pii.YES_PERSONAL[i]) for i in range(pii.LABELERS)]
        no = [rate([1 - x for x in p], i, pii.YES_OTHER[i]) for i in range(pii.LABELERS)]
    return prior, yes, no, [chance(*r) for r in rows]


def test_estimates_and_weights_equal_plain_code(spark):
    rng = random.Random(8)
    rows = [(i, made(rng, i % 2)[0]) for i in range(120)] + [(200 + i, f"from 10.0.0.{i} by x{i}@a.org") for i in range(20)]
    found = pii.candidates(spark.createDataFrame(rows, "doc_id long, text string")).selectExpr("explode(candidates) c")
    c = found["c"]
    cast = pii.votes(c)
    seen = found.select(pii.group_of(c).alias("g"), pii.F.array(*cast).alias("v"), pii.surface(c).alias("f"), c["kind"].alias("k"), c["base"].alias("b")).collect()
    prior, yes, no, p = plain_estimates([(r.g, r.v) for r in seen])
    got = pii.reliabilities(found)
    assert got.prior == pytest.approx(prior)
    assert [x[2] for x in got.personal] == pytest.approx(yes) and [x[2] for x in got.other] == pytest.approx(no)

    of, whole = {}, {}
    for r, x in zip(seen, p, strict=True):
        if not r.b:
            a, b = whole.get(r.k, (0, 0))
            whole[r.k] = a + x, b + 1 - x
            for f in r.f:
                a, b = of.get((r.k, f), (0, 0))
                of[r.k, f] = a + x, b + 1 - x
    s = pii.STRENGTH
    weights = {f: math.log((a + s / 2) / (whole[k][0] + s) / ((b + s / 2) / (whole[k][1] + s))) for (k, f), (a, b) in of.items()}
    learnt = {r.feature: r.weight for r in pii.classifier(found, got).collect()}
    assert learnt == pytest.approx(weights)
    wanted = sum(r.b or math.log(x / (1 - x)) + sum(weights[f] for f in r.f) >= 0 for r, x in zip(seen, p, strict=True))
    spans = pii.decided(pii.candidates(spark.createDataFrame(rows, "doc_id long, text string"))).selectExpr("sum(size(spans)) n").first().n
    assert spans == wanted and 0 < wanted < len(seen)
