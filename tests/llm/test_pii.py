import hashlib
import re
import time

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fieldloom.llm import pii

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def plain(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(int(p[-400:]) > 255 or len(p.lstrip("0")) > 3 for p in m.group().split(".")):
                continue
            if kind == "card" and not (16 <= len(digits) <= 19 and plain_luhn(digits)):
                continue
            if kind == "phone" and not 8 <= len(digits) <= 15:
                continue
            out.append((m.start(), m.end(), kind))
    return out


@settings(max_examples=500, deadline=None)
@given(st.text(alphabet="ab.@-+ 012345(é%", max_size=60))
def test_base_spans_are_the_patterns_matches(text):
    assert pii.base_spans(text) == plain(text)


def test_cards():
    for text in ["4111 1111 1111 1111", "4111-1111-1111-1111 x 4111111111111112", "4111111111111111 0", "٤111111111111111", "9" * 6000]:
        assert pii.base_spans(text) == plain(text)
    assert pii.base_spans("4111 1111 1111 1111") == [(0, 19, "card")]


def test_query(spark, root):
    rows = {r.doc_id: r for r in pii.op1_personal_data(spark, root).collect()}
    docs = spark.read.parquet(f"{root}/documents.parquet").select("doc_id", "text").collect()
    assert len(rows) == len(docs)
    for d in docs:
        base, r = plain(d.text or ""), rows[d.doc_id]
        written = ",".join(f"{k}:{s}:{e}" for s, e, k in base)
        assert r.base_sha256 == hashlib.sha256(written.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == kind for _, _, k in base) for kind in PATTERNS]
        assert set(filter(None, written.split(","))) <= set(r.spans.split(","))


def test_field_adds_spans_and_leaves_other_numbers(spark, root):
    weights = pii.learned(spark.read.parquet(f"{root.replace('sf0.001', 'sf0.01')}/documents.parquet"))

    def added(text):
        return [(text[s:e], k) for s, e, k in pii.added_spans(text, pii.base_spans(text), weights)]

    assert added("call me (310) 555-4510 or 310-555-4511 now") == [("(310) 555-4510", "phone"), ("310-555-4511", "phone")]
    assert added("pay 4111 1111 1111 1111 22 now") == [("4111 1111 1111 1111", "card")]
    assert added("mail bob.x (at) example (dot) com please") == [("bob.x (at) example (dot) com", "email")]
    for clean in ["in 2024-01-02 10:20 and 12345678", "Version 2.0. of 1234567890123456", 'token = "1eb9c654e721b4f812088970e66a6345cee33dd6"', "at 10.5, 20.5 and 1000000"]:
        assert added(clean) == []


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, "a@b.c " * 3000), (3, "a@b.c " * 3000), (None, "1.2.3.4"), (4, "+1 (310) 555-4510")]
    df = spark.createDataFrame([(i, t, 1, 2, "x") for i, t in rows], "doc_id long, text string, n_email int, n_chars int, spans string")
    got = sorted((r.n_email, r.n_ip, r.n_phone, r.spans) for r in pii.find(df, {}).collect())
    assert [g[:3] for g in got] == [(0, 0, 0), (0, 0, 0), (0, 0, 1), (0, 1, 0), (3000, 0, 0), (3000, 0, 0)]
    assert pii.find(df.limit(0), pii.learned(df.limit(0))).count() == 0
    masked = pii.mask_stage(spark, df, "")
    assert masked.columns == df.columns
    assert sorted((r.text or "") for r in masked.where("doc_id in (1, 2, 4) or doc_id is null").collect()) == ["", "", "<ip>", "<phone>"]
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in masked.collect())


def test_addresses_in_long_runs_of_digits():
    import random
    import re
    import time

    stated = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
    rng = random.Random(3)
    for _ in range(3000):
        text = "".join(rng.choice("0123456789....  a") for _ in range(rng.randrange(40)))
        assert [m.span() for m in pii.IP.finditer(text)] == [m.span() for m in stated.finditer(text)]
    start = time.perf_counter()
    assert pii.base_spans("7" * 1_000_000 + " 10.0.0.1") == [(1_000_001, 1_000_009, "ip")]
    assert pii.base_spans("1." * 300_000) and time.perf_counter() - start < 20


def test_a_window_holds_the_whole_address():
    name, host = "first.last" * 6, "h" * 40
    for address in (f"{name} (at) {host} (dot) example (dot) org", f"{name}@{host}.example", f"a [at] {host}[dot]{host}[dot]com"):
        text = "x" * 50 + " write to " + address + " or wait " + "y" * 50
        at = text.index(address)
        assert any(start <= at and at + len(address) <= end for start, end in pii.windows(text))
    # windows are apart, in order and inside the text
    text = f"(at) {host} {'z ' * 90}+1 555 010 9999 {'q ' * 70}{name}{name} (at) b (dot) c {name}@"
    found = pii.windows(text)
    assert found == sorted(found) and len(found) == 3 and found[0][0] == 0 and found[-1][1] == len(text)
    assert all(a[1] < b[0] for a, b in zip(found, found[1:]))


def test_long_runs_of_address_characters_cost_their_length():
    began = time.monotonic()
    assert len(pii.windows(("a" * 50 + "@") * 20_000)) == 1
    assert pii.windows("b" * 1_000_000 + "@") == [(0, 1_000_001)]
    assert time.monotonic() - began < 20


def test_masks_an_address_with_a_long_host(spark, root):
    address = "jane.doe (at) " + "h" * 40 + " (dot) example (dot) org"
    df = spark.read.parquet(f"{root.replace('sf0.001', 'sf0.01')}/documents.parquet")
    row = df.limit(1).withColumn("doc_id", F.lit(10**12)).withColumn("text", F.lit(f"please mail {address} today"))
    kept = pii.mask_stage(spark, df.unionByName(row.select(df.columns)), root).where("doc_id = 1000000000000").first().text
    assert kept == "please mail <email> today"
