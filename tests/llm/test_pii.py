"""Base spans against the plain patterns; the field's added spans; odd rows."""

import hashlib
import random
import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from diffloom.llm import pii
from diffloom.llm import queries as Q

SF = "/root/testdata/sf0.01"
PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def good(kind, s):
    digits = re.sub("[^0-9]", "", s)
    if kind == "ip":
        return all(int(p) <= 255 for p in s.split("."))
    if kind == "card":
        doubled = [int(d) * (1 + k % 2) for k, d in enumerate(reversed(digits))]
        return 14 <= len(digits) <= 19 and sum(sum(map(int, str(v))) for v in doubled) % 10 == 0
    return 10 <= len(digits) <= 15 if kind == "phone" else True


def plain(text):
    found = [(*m.span(), k) for k, p in PLAIN.items() for m in re.finditer(p, text or "") if good(k, m[0])]
    return sorted(found, key=lambda s: (s[0], list(PLAIN).index(s[2])))


def bits(rng):
    return rng.choice(["4111 1111 1111 1111", "4111-1111-1111-1111", "5500000000000004", "1.2.3.4", "255.255.255.255",
                       "256.1.1.1", "1.2.3.4.5.6.7.8", "00001.2.3.004", "a.b@c.d", "a@b", "x@y.z.w@q.r", "@", "@@a.b", "+",
                       "+1 (212) 555-0199", "+1...", "+1-2-3-4-5-6-7-8-9-0", "word", ".", " ", "-", "  ", "\n", "é", "9" * 16,
                       "+123456789012345", "%+-._@a-b.c-d..e", "12", "3"])


def test_base_spans():
    rng = random.Random(2)
    for _ in range(4000):
        text = "".join(bits(rng) for _ in range(rng.randint(0, 12)))
        assert pii.base_spans(text) == plain(text), text


@settings(max_examples=500, deadline=None)
@given(st.text(alphabet="01 9.-+()@ab\n", max_size=60))
def test_base_spans_of_any_text(text):
    assert pii.base_spans(text) == plain(text)


def test_long_runs_take_linear_time():
    for text in ("1" * 300_000, "a@" * 100_000, "1." * 100_000, "+1" + "." * 200_000, "@" * 100_000, "1 " * 100_000, "a" * 500_000 + "@"):
        pii.base_spans(text)
        pii._chunks(text)


def test_field_adds_what_the_patterns_miss(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    field = pii.fit(docs).value
    text = ("Erin +1 (569) 555-6633 4795326016703902 thor. nd 71.129.171.132 4815819516090933 then pas password=32bb02aa3b580bf8ab of "
            "the year 2024 and 12 of 300 pages, chapter 3.4 of v1.2.3")
    base, every = pii.find(text, field)
    added = {(k, text[a:b]) for a, b, k in every} - {(k, text[a:b]) for a, b, k in base}
    assert ("phone", "+1 (569) 555-6633") in added and ("secret", "32bb02aa3b580bf8ab") in added
    assert any(k == "card" and s.endswith("4815819516090933") for k, s in added | {(k, text[a:b]) for a, b, k in base})
    assert not any(s in ("2024", "12", "300", "3.4", "v1.2.3") for _, s in added)
    assert pii.redact(text, every).count("[") == len(every)


def test_secrets_of_any_length_and_of_letters_only(spark):
    field = pii.fit(spark.read.parquet(f"{SF}/documents.parquet")).value
    rng = random.Random(3)
    letters = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"
    token = "".join(rng.choice(letters + "0123456789") for _ in range(400))
    for secret in (token, f"{token[:36]}.{token[36:300]}.{token[300:]}", "correcthorsebattery", "sunshine"):
        for text in (f"then use token={secret} of the page", f"password={secret}", f'12 pages, "secret": "{secret}", end'):
            base, every = pii.find(text, field)
            assert ("secret", secret) in {(k, text[a:b]) for a, b, k in every}, text
            assert secret not in pii.redact(text, every)
    assert pii.find("plain words about a password or a token and correcthorsebattery", field)[1] == []
    for text in ("token=" + "x" * 300_000, "token " * 50_000, "token=a " * 20_000, "token" + " " * 300_000):
        pii._chunks(text)


def test_best_reading_is_the_best_of_all():
    """Dynamic programming against all readings of small neighbourhoods; expected counts against sums over them."""
    import itertools

    import numpy as np
    rng = np.random.default_rng(4)
    text = "mail a@b.c 12 +1 (212) 555-0199 x"
    hood = pii.hoods_of(text)[0]
    field = pii.Field(rng.normal(size=(len(pii.FEATURES), pii.OUT)), rng.normal(size=(pii.OUT + 1,) * 2))
    hood.segments, hood.features = hood.segments[:8], hood.features[:8]

    def readings(at):
        if at == len(hood.chunks):
            yield []
            return
        for rest in readings(at + 1):
            yield [(-1, pii.OUT), *rest]
        for s, (i, j) in enumerate(hood.segments):
            if i == at:
                for kind, rest in itertools.product(range(pii.OUT), readings(j + 1)):
                    yield [(s, kind), *rest]

    def score(reading):
        kinds = [pii.OUT, *(k for _, k in reading)]
        return sum(field.follow[a, b] for a, b in zip(kinds, kinds[1:])) + sum(
            hood.features[s] @ field.weights[:, k] for s, k in reading if s >= 0)

    every = list(readings(0))
    scores = np.array([score(r) for r in every])
    assert field.best(hood, 0.0) == [m for m in every[int(scores.argmax())] if m[0] >= 0]
    p = np.exp(scores - scores.max())
    p /= p.sum()
    want = np.zeros_like(field.weights)
    for r, q in zip(every, p):
        for s, k in r:
            if s >= 0:
                want[:, k] -= q * hood.features[s]
    dw, _ = field.gradient(hood, hood.features, [])
    assert np.allclose(dw, want)


def test_query(spark):
    texts = dict(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect())
    rows = Q.op3_pii(spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        base = plain(texts[r.doc_id])
        listed = [f"{k}:{a}:{b}" for a, b, k in base]
        assert r.base_sha256 == hashlib.sha256(",".join(listed).encode()).hexdigest()
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(s[2] == k for s in base) for k in PLAIN)
        assert set(listed) <= set(r.spans.split(","))


def test_odd_rows(spark):
    df = spark.createDataFrame([(1, None, "a", 3), (2, "", "b", 3), (3, "a@b.cd x " * 3, "c", 3), (3, "a@b.cd x " * 3, "c", 3),
                                (4, "plain " * 50_000 + "1.2.3.4", "d", 3)], "doc_id long, text string, spans string, n_ip int")
    field = spark.sparkContext.broadcast(pii.train([]))
    got = {r.doc_id: r.s for r in df.select("doc_id", pii.spans(F.col("text"), field).alias("s")).collect()}
    assert got[1] == got[2] and got[1].spans == "" and got[3].n_email == 3 and got[4].spans == "ip:300000:300007"
    clean = pii.redacted(df, field)
    assert clean.columns == df.columns
    assert {r.doc_id: r.text for r in clean.collect()}[3] == "[EMAIL] x " * 3
    assert clean.filter("text is null").count() == 1
    assert pii.redacted(df.limit(0), pii.fit(df.limit(0))).count() == 0
