"""Fingerprints: order, insertion and deletion; the edited texts against plain Python."""

import hashlib
import random
import tracemalloc

import numpy as np
from pyspark.sql import functions as F

from diffloom.llm import multiset_hash as M
from diffloom.llm import queries as Q
from diffloom.llm.multiset_hash import combine, edited, fingerprint, from_hex, likeness, to_hex, vectors

SF = "/root/testdata/sf0.001"


def prints(texts):
    return to_hex(*vectors([t.encode() for t in texts]))


def plain(rows):
    """(id, n_chars, edited text, next text) by descending id, nulls last."""
    rows = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] is not None, r[1] or ""))
    out = []
    for k, (i, t) in enumerate(rows):
        j = k + 1
        a, b = t or "", (rows[j] if j < len(rows) else rows[0])[1] or ""
        third = len(a) // 3
        out.append((i, len(a), a[: len(a) - third] + b[:third], b))
    return out


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    texts, want = dict(rows), {i: (n, e, b) for i, n, e, b in plain(rows)}
    got = Q.op10_fingerprints(spark, SF).collect()
    assert len(got) == len(rows)
    for r in got:
        n, e, b = want[r.doc_id]
        assert (r.n_chars, r.edited_sha256) == (n, hashlib.sha256(e.encode()).hexdigest())
        own, changed, following = prints([texts[r.doc_id], e, b])
        assert (r.fingerprint, r.edited_fingerprint) == (own, changed)
        assert abs(r.near_edited - likeness(from_hex([own]), from_hex([changed]))[0]) < 1e-9
        assert abs(r.near_next - likeness(from_hex([own]), from_hex([following]))[0]) < 1e-9
    full = [r for r in got if r.n_chars > 1000]
    assert np.median([r.near_edited for r in full]) > 0.5 > 0.25 > np.median([r.near_next for r in full])


def test_paragraph_order_and_changes(spark):
    rng = random.Random(1)
    lines = [" ".join(rng.choice("abcdefgh") * 3 for _ in range(rng.randint(0, 9))) for _ in range(40)]
    shuffled = rng.sample(lines, len(lines))
    a, b, c = prints(["\n".join(lines), "\n".join(shuffled), "\n".join(lines[1:])])
    assert a == b != c
    df = spark.createDataFrame([("\n".join(lines), "\n".join(lines[1:]), lines[0], None)],
                               "a string, less string, one string, none string")
    row = df.select(combine(fingerprint(F.col("less")), fingerprint(F.col("one"))).alias("more"),
                    combine(fingerprint(F.col("a")), fingerprint(F.col("one")), -1).alias("less"),
                    fingerprint(F.col("none")).alias("none"), combine(F.col("none"), F.col("a")).alias("null")).first()
    assert (row.more, row.less, row.none, row.null) == (a, c, prints([""])[0], None)


def test_odd_rows(spark):
    rows = [(i, f"text number {i} " * (i % 7)) for i in range(50)] + [(None, "no id"), (None, None), (-5, "é🙂" * 5),
           (100, None), (101, ""), (102, "z" * 100_000), (2**62, "\n\n"), (-2**62, "a\nb")]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, id int, fingerprint string")
    for ranges in (1, 3, 40):
        got = edited(df, ranges=ranges).collect()
        assert sorted((str(r.id), r.n_chars, r.edited_text) for r in got) == \
            sorted((str(i), n, e) for i, n, e, _ in plain(rows))
    one = edited(df.filter("doc_id = 3")).collect()
    assert len(one) == 1 and one[0].near_next == 1.0 and one[0].n_chars == len(rows[3][1])
    assert edited(df.limit(0)).count() == 0
    twice = edited(df.union(df), ranges=5).collect()
    assert len(twice) == 2 * len(rows)


def test_equal_texts(spark):
    df = spark.createDataFrame([(i, "same text\nof lines") for i in range(30)], "doc_id long, text string")
    got = edited(df, ranges=4).collect()
    assert len({r.fingerprint for r in got}) == 1 and all(r.near_next == 1.0 for r in got)


def test_long_texts_are_the_sum_of_their_parts(monkeypatch):
    rng = random.Random(3)
    texts = ["\n".join(" ".join(rng.choices("ab cd ef gh".split(), k=rng.randint(0, 5))) for _ in range(rng.randint(0, 400)))
             for _ in range(20)] + ["\n" * 300, "x" * 999 + "\n" + "y z " * 500]
    raw = [t.encode() for t in texts]
    whole = M.vectors(raw)
    monkeypatch.setattr(M, "PART_BYTES", 64)
    parts = M.vectors(raw)
    assert (whole[0] == parts[0]).all() and (whole[1] == parts[1]).all()


def test_memory_of_many_paragraphs():
    for text in (b"\n" * 50_000_000, b"".join(b"%d\n" % i for i in range(1_000_000))):
        tracemalloc.start()
        M.vectors([text])
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < 200_000_000
