import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tollhouse.llm import pii_bootstrap as pii


def naive_luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def naive_base(text):
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    for kind, expression, low, high in ((2, r"[0-9]([\x20-]?[0-9])+", 14, 19), (3, r"\+[0-9][\x20().0-9-]+[0-9]", 10, 15)):
        for m in re.finditer(expression, text):
            digits = re.sub("[^0-9]", "", m[0])
            if low <= len(digits) <= high and (kind == 3 or naive_luhn(digits)):
                out.append((m.start(), kind, m.end()))
    return sorted(out)


@settings(max_examples=1500, deadline=None)
@given(st.text(alphabet="a1270.@+- ()%_é\n", max_size=60))
def test_base_spans_are_those_of_the_expressions(text):
    assert pii.base_spans(text) == naive_base(text)


def test_long_texts_take_linear_time():
    for text in ("a" * 3_000_000, "1" * 300_000 + ".", "1." * 500_000, "@" * 500_000, "+1" * 300_000, "a@" * 300_000, "a@b" * 200_000):
        assert all(e <= len(text) for _, _, e in pii.base_spans(text))


def card(rng, valid=True):
    digits = "4" + "".join(rng.choice("0123456789") for _ in range(14))
    ok = [d for d in "0123456789" if naive_luhn(digits + d)][0]
    return digits + (ok if valid else str((int(ok) + 1) % 10))


def planted():
    """Texts whose contexts tell kinds apart, with identifiers that the expressions miss, and numbers that are none."""
    rng, rows = random.Random(5), []
    for i in range(14):
        tail = "".join(rng.choice("23456789") for _ in range(7))
        rows.append(f"You can ring my mobile phone on +1 (555) {tail[:3]}-{tail[3:]} after lunch, item {i} of the list.")
        rows.append(f"Please charge credit card {card(rng)} expiring soon. Page {i + 100}")
        rows.append(f"they log in from host address 10.{i}.7.{i + 3} every night; it took {i + 2} days")
        rows.append(f"Write to contact mail user{i}@site{i}.example.com for help")
    rows.append("You can ring my mobile phone on 555-201-3344 after lunch")
    rows.append("please charge credit card 4111 1111 1111 1112 expiring soon")
    rows.append("They log in from host address 2001:db8::8a2e:370:7334 every night")
    rows.append("write to contact mail root@localhost for help")
    rows.append("Elsewhere 555-201-3344 stands without its context")
    rows.append("The part number 555-777-8899 is in stock, the order 4111 1111 1111 1113 is not; call 12 times, pay 7 at 300 or 9.9.9.999")
    rows.append("ring my mobile phone on Tuesday after lunch")
    return rows


def brute(texts):
    """Base and added spans, the graph scored with dicts."""
    found = [pii.mentions(t or "", naive_base(t or "")) for t in texts]
    edges = {}
    for m in (m for ms in found for m in ms):
        for p in pii.patterns(m.context):
            kind, mask = edges.get((p, m.value), (-1, 0))
            edges[p, m.value] = max(kind, m.kind), mask | m.mask
    accepted = {}
    for _ in range(pii.ROUNDS):
        sums, n = defaultdict(Counter), Counter()
        for (p, v), (kind, _mask) in edges.items():
            n[p] += 1
            if kind >= 0:
                sums[p][kind] += pii.UNIT
            elif v in accepted:
                sums[p][accepted[v][0]] += accepted[v][1]
        trusted = {}
        for p, of in sums.items():
            k = max(range(4), key=lambda k: (of[k], -k))
            if of[k] / (n[p] + pii.SMOOTHING) >= pii.MIN_CONFIDENCE * pii.UNIT:
                trusted[p] = k, round(-math.log1p(-of[k] / ((n[p] + pii.SMOOTHING) * pii.UNIT)) * pii.UNIT)
        doubt = defaultdict(Counter)
        for (p, v), (kind, mask) in edges.items():
            if kind < 0 and p in trusted and mask >> trusted[p][0] & 1:
                doubt[v][trusted[p][0]] += trusted[p][1]
        accepted = {}
        for v, of in doubt.items():
            k = max(of, key=lambda k: (of[k], -k))
            score = math.floor((1 - math.exp(-of[k] / pii.UNIT)) * pii.UNIT)
            if score >= pii.MIN_SCORE * pii.UNIT:
                accepted[v] = k, score
    return [([tuple(b) for b in naive_base(t or "")], sorted((m.start, accepted[m.value][0], m.end) for m in ms if m.kind < 0 and m.mask and m.value in accepted)) for t, ms in zip(texts, found)]


def result(frame):
    return sorted(repr((r["doc_id"], [tuple(s) for s in r["base"]], [tuple(s) for s in r["added"]])) for r in frame.collect())


def test_same_as_brute_force(documents, corpus):
    texts = planted() + corpus[:10] + ["", None, "Δ 1 " + "é" * 200_000 + " x@y 7", "9" * 60_000]
    rows = [*enumerate(texts), (3, texts[3]), (3, texts[3]), (None, texts[1]), (None, None)]
    want = brute([t for _, t in rows])
    assert result(pii.personal_data(documents(rows))) == sorted(repr((i, b, a)) for (i, _), (b, a) in zip(rows, want))


def test_unseen_identifiers_are_found_and_others_left_alone(documents):
    texts = planted()
    got = {r["doc_id"]: [(pii.KINDS[s["kind"]], texts[r["doc_id"]][s["start"] : s["end"]]) for s in r["added"]] for r in pii.personal_data(documents([*enumerate(texts)])).collect()}
    n = len(texts)
    assert got[n - 7] == [("phone", "555-201-3344")] == got[n - 3]
    assert got[n - 6] == [("card", "4111 1111 1111 1112")]
    assert got[n - 5] == [("ip", "2001:db8::8a2e:370:7334")]
    assert got[n - 4] == [("email", "root@localhost")]
    assert all(not x for i, x in got.items() if i < n - 7 or i > n - 3)


def test_digest_columns(documents):
    text = "+1 (017) 555-7713 a@b.cd 4111111111111111"
    row = pii.personal_data(documents([(1, text)])).select(pii.spans_text(F.concat("base", "added")).alias("spans"), *(pii.span_count(F.col("base"), k).alias(k) for k in pii.KINDS)).first()
    assert row["spans"] == "phone:0:17,email:18:24,card:25:41" and [row[k] for k in pii.KINDS] == [1, 0, 1, 1]


def test_a_pattern_of_mixed_kinds_is_not_trusted(documents):
    rng = random.Random(1)
    texts = [f"we saw {x} yesterday again" for i in range(20) for x in (f"+1 555 {2_000_000 + i}", card(rng))] + ["we saw 555-201-3344 yesterday again"]
    assert all(not r["added"] for r in pii.personal_data(documents([*enumerate(texts)])).collect())


def test_no_rows(documents):
    assert pii.personal_data(documents([(1, "a")]).where("false")).collect() == []


@pytest.mark.parametrize("sf", ["0.001"])
def test_query_against_the_expressions(spark, sf):
    from tollhouse.llm.queries import op11_pii

    docs = spark.read.parquet(f"/root/testdata/sf{sf}/documents.parquet").collect()
    want = {}
    for r in docs:
        base = naive_base(r["text"] or "")
        text = ",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in base)
        want[r["doc_id"]] = (*(sum(k == j for _, k, _ in base) for j in range(4)), hashlib.sha256(text.encode()).hexdigest(), text)
    assert {r["doc_id"]: tuple(r)[1:] for r in op11_pii(spark, f"/root/testdata/sf{sf}").collect()} == want
