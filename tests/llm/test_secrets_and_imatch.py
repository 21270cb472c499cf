"""Secret scans and I-Match fingerprints against plain Python."""

import hashlib
import random
import re
import time

from pyspark.sql import functions as F

from kerbside.llm import imatch, secret_scan

SCHEMA = "doc_id long, text string, lang string, source string, kind int, mark string, row string"


def frame(spark, texts):
    return spark.createDataFrame([(k, t, None, "s", 1, "clash", "") for k, t in texts], SCHEMA)


BASE = [("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A),
         lambda m: len(m[2]) >= 6),
        ("access", re.compile("AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20),
        ("hex", re.compile("[0-9a-f]+"), lambda m: len(m[0]) >= 24)]


def base(text):
    got = [(m.start(), i, f"{k}:{m.start()}:{m.end()}") for i, (k, p, ok) in enumerate(BASE) for m in p.finditer(text or "") if ok(m)]
    return ",".join(x for *_, x in sorted(got))


HEX = "0123456789abcdef" * 3
SECRETS = [(0, None), (1, ""), (2, "pässword=abc secret = 'x' PassWord: token: abcdefghij 😀 api_key=ABCDEFG"),
           (3, f"AKIA{'A' * 15} AKIAAKIA{'B' * 16} {HEX[:23]} {HEX[:24]}g token=\"{HEX[:40]}\""), (4, "token=abcdef " * 3000),
           (5, f"user=anna xx Zx9{'q8W' * 8} {'.' * 1000} Zy8{'r7V' * 8}"), (6, f"postgres://db/x login: bob token=abcdefgh {'-' * 3}"),
           (7, "postgres://db/x alone"), (8, f"AKIA{'Z' * 16} and https://host/a then Zx9{'q8W' * 8}"), (2, "again password = 123456")]


def test_certain_spans_and_links(spark):
    rows = secret_scan.secret_scan(frame(spark, SECRETS)).select(
        "doc_id", secret_scan.listed(F.col("found"), True).alias("base"), secret_scan.listed(F.col("found")).alias("spans")).collect()
    assert sorted((r.doc_id, r.base) for r in rows) == sorted((k, base(t)) for k, t in SECRETS)
    spans = {r.doc_id: r.spans for r in rows if r.doc_id != 2}
    assert spans[5] == "login:0:9,loose:13:40"  # the far run has no partner
    assert "login:" in spans[6] and "endpoint:" in spans[6]
    assert spans[7] == ""
    assert spans[8].startswith("access:0:20,endpoint:25:39,loose:45:")
    assert secret_scan.secret_scan(frame(spark, [])).count() == 0


LONG = "Zx9" + "q8W" * 8
URLS = [(1, "see https://example.com/2019/07/some-long-article-title-42"), (2, f"https://bob:{LONG}@host/db only"),
        (3, f"username={LONG}"), (4, f"user=anna https://host/a{'/b1' * 9} x"), (5, f"https://host/x?{LONG} token=abcdefg"),
        (6, f"user=anna {'.' * 398} {LONG}"), (7, f"user=anna {'.' * 399} {LONG}"), (8, f"user=anna https://host/a token=abcdefgh")]


def test_overlapping_parts_are_no_partners(spark):
    rows = secret_scan.secret_scan(frame(spark, URLS)).select("doc_id", secret_scan.listed(F.col("found")).alias("spans")).collect()
    spans = {r.doc_id: r.spans for r in rows}
    assert spans[1] == spans[3] == ""
    assert spans[2] == "login:8:11,loose:12:39,endpoint:40:47"
    assert spans[4].startswith("login:0:9,loose:")  # the path is a run that an identifier stands beside
    assert "endpoint" not in spans[4] and "endpoint" not in spans[5]  # its own path is no partner of the address
    assert spans[6] == "login:0:9,loose:409:436"
    assert spans[7] == ""
    assert spans[8] == "login:0:9,endpoint:10:24,assign:25:39"


def test_links_against_all_pairs(spark):
    rng = random.Random(8)
    rows, roles = [], secret_scan.ROLES
    for row in range(60):
        for kind in range(len(secret_scan.KINDS)):
            at = rng.randrange(200)
            for _ in range(rng.randrange(4)):  # those of one kind do not overlap
                at += rng.randrange(1, 300)
                rows.append((row, kind, at, end := at + rng.randrange(1, 60)))
                at = end

    def near(x, role):
        return any(y[0] == x[0] and roles[secret_scan.KINDS[y[1]]] == role and (0 <= x[2] - y[3] <= 50 or 0 <= y[2] - x[3] <= 50) for y in parts)

    parts = [x for x in rows if secret_scan.KINDS[x[1]] != "loose" or not any(
        y[0] == x[0] and y[1] < 3 and y[2] < x[3] and x[2] < y[3] for y in rows)]
    want = []
    for x in parts:
        role = roles[secret_scan.KINDS[x[1]]]
        if x[1] < 3 or (role == "secret" and (near(x, "id") or near(x, "endpoint"))) or (role == "id" and near(x, "secret")) or (
                role == "endpoint" and near(x, "id") and near(x, "secret")):
            want.append(x)
    got = secret_scan.linked(spark.createDataFrame(rows, "row long, kind int, start long, end long"), 50).collect()
    assert sorted(map(tuple, got)) == sorted(want)
    assert 0 < sum(x[1] > 2 for x in want) < sum(x[1] > 2 for x in rows)


def test_rows_that_come_often(spark):
    texts = [(1, "one two three four"), *[(2, "five six seven")] * 3000, (3, "eight nine")]
    started = time.time()
    got = imatch.fingerprints(frame(spark, texts)).groupBy("doc_id", "edited_sha256", "next_fingerprint").count().collect()
    assert sorted((r.doc_id, r["count"]) for r in got) == [(1, 1), (2, 3000), (3, 1)]
    assert time.time() - started < 60  # 3,000 times 3,000 rows take minutes


def test_fingerprints(spark):
    words = [f"w{i}" for i in range(300)]
    texts = [(i * 3, " ".join(words[(i * 5 + j * (1 + i % 3)) % 300] for j in range(40 + i % 50))) for i in range(120)]
    texts += [(7, None), (8, ""), (400, texts[5][1]), (401, "É" * 3001 + " zz"), (402, "Solo"), (402, "solo again"), texts[9]]
    got = imatch.fingerprints(frame(spark, texts), rare=0.01, common=0.5, subsets=64).select(
        "*", imatch.likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        imatch.likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next")).collect()
    assert len(got) == len(texts)
    by_id = dict(sorted(texts, reverse=True))
    order = sorted(by_id)
    shas = {r.doc_id: r for r in got if r.doc_id != 402}
    for a, b in zip(order, order[1:] + order[:1]):
        if 402 in (a, b):
            continue
        t, u = by_id[a] or "", by_id[b] or ""
        half = len(t) // 2
        edited = t[:len(t) - half] + u[:half]
        assert shas[a].n_chars == len(t)
        assert shas[a].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert shas[a].next_fingerprint == shas[b].fingerprint
    assert shas[400].fingerprint == shas[15].fingerprint
    long = [r for r in got if r.n_chars > 60 and r.doc_id < 400]
    assert sum(r.near_edited > 0.05 for r in long) > 0.8 * len(long)
    assert all(0 <= x <= 1 for r in got for x in (r.near_edited, r.near_next))
    assert {r.edited_fingerprint == [] for r in got if r.doc_id == 7} == {True}
    assert imatch.fingerprints(frame(spark, [])).count() == 0
    assert [r.n_chars for r in imatch.fingerprints(frame(spark, [(None, "one two")])).collect()] == [7]
