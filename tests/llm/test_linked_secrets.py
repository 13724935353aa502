"""Secrets against plain regular expressions and a pairwise check of scopes."""

from __future__ import annotations

import random
import re

from cadastra.llm import linked_secrets as ls

#: The patterns as they are defined, with lengths tested afterwards.
ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A)
ACCESS, HEX = re.compile(r"AKIA[A-Z0-9]+"), re.compile(r"[0-9a-f]+")
LONGEST = {"AKIA": 20}


def brute(text, scope=ls.SCOPE):
    text = text or ""
    out = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end(), "access") for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end(), "hex") for m in HEX.finditer(text) if len(m[0]) >= 24]
    weak = []
    for m in re.finditer(r"[A-Za-z0-9+/_-]+", text):
        t = m[0]
        small = sum(len(run) for run in re.findall("[a-z]+", t) if len(run) >= 4)
        if re.fullmatch("[A-Z0-9]{16,32}", t) and re.search("[0-9]", t) and re.search("[A-Z]", t):
            weak.append((m.start(), 3, m.end(), "key_id"))
        elif len(t) >= 32 and re.search("[0-9]", t) and re.search("[A-Z]", t) and re.search("[a-z]", t) and 2 * small <= len(t):
            weak.append((m.start(), 4, m.end(), "blob"))
    for m in re.finditer(ls.LOGIN, text, re.A):
        colon = m[0].find(":", 3)
        weak.append((m.start() + (3 if colon < 0 else colon + 1), 5, m.end() - 1, "login"))
    weak += [(m.start(), 6, m.end(), "endpoint") for m in re.finditer(ls.ENDPOINT, text, re.A)]
    role = {k: r for r, kinds in ls.ROLES.items() for k in kinds}
    overlap = lambda x, y: x[0] < y[2] and y[0] < x[2]
    inside = {w for w in weak if w[3] == "blob" and any(e[3] == "endpoint" and overlap(w, e) for e in weak)}
    certain = list(out)
    for w in weak:
        if any(overlap(w, c) for c in certain):
            continue
        others = [o for o in certain + weak if o is not w and role[o[3]] in ls.COMPLEMENTS[role[w[3]]]]
        others = [o for o in others if not ({role[o[3]], role[w[3]]} == {"secret", "endpoint"} and {o, w} & inside)]
        if any(max(w[0] - o[2], o[0] - w[2]) <= scope for o in others):
            out.append(w)
    return ",".join(f"{k}:{s}:{e}" for s, _, e, k in sorted(out))


def texts():
    rng = random.Random(11)
    hexa = lambda n: "".join(rng.choice("0123456789abcdef") for _ in range(n))
    code = lambda n: "".join(rng.choice("ABCDEFGHIJ0123456789") for _ in range(n))
    blob = lambda n: "".join(rng.choice("abcXYZ0123+/_") for _ in range(n))
    makers = [
        lambda: f"token = '{blob(rng.randrange(3, 20))}'", lambda: f"API_KEY:{hexa(30)}", lambda: "secret=token:abcdefgh", lambda: hexa(rng.randrange(20, 30)),
        lambda: "AKIA" + code(rng.randrange(10, 20)), lambda: "AKIAAKIA" + code(14), lambda: code(20), lambda: blob(40), lambda: "https://h.example/é?x=1", lambda: "10.2.33.255",
        lambda: f"pg://me:{blob(rng.randrange(1, 30))}@db.example:5432/x", lambda: f"https://{blob(24)}@a.example/", lambda: "https://a.example:80/me@b.example",
        lambda: "db.example.com:5432", lambda: "section:2024", lambda: "docs/GettingStarted/Version2/InstallationGuide", lambda: f"https://a.example/{blob(36)}",
        lambda: "word " * rng.randrange(60), lambda: "Straße 日本 \U0001f600 ", lambda: "passwd  =  ", lambda: "\n", lambda: "PassWord\"=\"=abcdef-",
    ]
    return [" ".join(rng.choice(makers)() for _ in range(rng.randrange(14))) for _ in range(300)] + [None, "", "token=" + "a1B" * 9000, "deadbeef" * 5 + " " + "f" * 24]


def test_equals_brute_force(spark):
    rows = list(enumerate(texts())) + [(None, "token=abcdef"), (None, "token=abcdef"), (3, "AKIA" + "A" * 16), (3, "AKIA" + "A" * 16)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' AS spans", "1 AS matches", "2 AS fingerprint").repartition(3)
    got = ls.secret_spans(df).select("doc_id", ls.span_text(__import__("pyspark").sql.functions.col("spans")))
    assert sorted((tuple(r) for r in got.collect()), key=str) == sorted(((i, brute(t)) for i, t in rows), key=str)
    assert ls.secret_spans(df.limit(0)).collect() == []


def test_redaction(spark):
    rows = list(enumerate(texts()))
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'own' AS kind", "5 AS start")
    got = {r["doc_id"]: r for r in ls.redacted(df).collect()}
    for i, text in rows:
        want, gone = text, set()
        for span in filter(None, brute(text).split(",")):
            _, a, b = span.split(":")
            gone |= set(range(int(a), int(b))) | {-1}
        if gone:
            intervals = [tuple(map(int, s.split(":")[1:])) for s in brute(text).split(",")]
            want, at = "", 0
            merged = []
            for a, b in sorted(intervals):
                if merged and a <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], b)
                else:
                    merged.append([a, b])
            for a, b in merged:
                want += text[at:a] + "[secret]"
                at = b
            want += text[at:]
        assert got[i]["text"] == want and got[i]["kind"] == "own" and got[i]["start"] == 5


def test_weak_parts_alone_are_not_reported(spark):
    alone = ["see https://a.example/x and https://b.example/y", "code ABCDEFGH12345678 in a text", "1.2.3.4"]
    assert [brute(t) for t in alone] == ["", "", ""]


def spans_of(spark, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = ls.secret_spans(rows).select("doc_id", ls.span_text(__import__("pyspark").sql.functions.col("spans")))
    return [[s.split(":")[0] + " " + text[int(s.split(":")[1]):int(s.split(":")[2])] for s in found.split(",") if s] for text, (_, found) in zip(texts, sorted(map(tuple, got.collect())))]


PAGE = "https://en.wikipedia.org/wiki/2024_Summer_Olympics_opening_ceremony"
BLOB = "wJalrXUtnFEMI/K7MDENG/bPxRfiCYzEXAMPLEKEY"


def test_clean_text_stays(spark):
    clean = [
        f"see {PAGE}", f"see {PAGE} and {PAGE.replace('2024', '2020')}", f"see {PAGE} or https://a.example/ or 1.2.3.4",
        "section:2024 see docs/GettingStarted/Version2/InstallationGuide for it", "at 10:30, note:12, 3.14:1592, chapter:2024",
        "https://a.example/ docs/GettingStarted/Version2/InstallationGuide 1.2.3.4", f"section:2024 K={BLOB}", "write to https://me@a.example/x",
    ]
    assert spans_of(spark, clean) == [[] for _ in clean]
    rows = spark.createDataFrame(list(enumerate(clean)), "doc_id long, text string")
    assert sorted(map(tuple, ls.redacted(rows).collect())) == list(enumerate(clean))
    dated = spark.createDataFrame([(1, "updated:2023 password: hunter22x")], "doc_id long, text string")
    assert ls.redacted(dated).collect() == [(1, "updated:2023 [secret]")]


def test_other_parts_still_confirm(spark):
    code, token = "ASIAQ3EGRTY7ABCD1234", BLOB.replace("/", "_")
    texts = [
        f"{PAGE} {BLOB}", f"{BLOB} at {PAGE}", f"{code} https://a.example/?s={BLOB}", f"https://me:{BLOB}@a.example/x and me@b.example",
        f"https://{token}@a.example/x", f"https://a.example:80/me@b.example {BLOB}", f"postgres://me:{'p4ss/' * 400}w@db:5432/x",
    ]
    assert spans_of(spark, texts) == [
        [f"endpoint {PAGE}", f"blob {BLOB}"], [f"blob {BLOB}", f"endpoint {PAGE}"],
        [f"key_id {code}", f"blob {BLOB}"], [f"endpoint https://me:{BLOB}@a.example/x", f"login {BLOB}"],
        [f"endpoint https://{token}@a.example/x", f"login {token}"],
        ["endpoint https://a.example:80/me@b.example", f"blob {BLOB}"],
        [f"endpoint postgres://me:{'p4ss/' * 400}w@db:5432/x", f"login {'p4ss/' * 400}w"],
    ]


def test_name_value_pairs(spark):
    code = "ASIAQ3EGRTY7ABCD1234"
    texts = [
        f"AWS_ACCESS_KEY_ID={code}\nAWS_SECRET_ACCESS_KEY={BLOB}", f"aws_access_key_id={code}\naws_secret_access_key={BLOB}",
        f"?AccessKeyId={code}&Signature={BLOB}==&v=1", f"first_setting_value={BLOB[:-1]}a\nsecond_setting_value={BLOB}",
        f"aws_access_key_id={code} and http://a.example",
    ]
    pair = [f"key_id {code}", f"blob {BLOB}"]
    assert spans_of(spark, texts) == [pair, pair, pair, [], []]
    rows = spark.createDataFrame([(1, texts[1])], "doc_id long, text string")
    assert ls.redacted(rows).collect() == [(1, "aws_access_key_id=[secret]\naws_secret_access_key=[secret]")]


def test_endpoints_of_any_scheme_and_port(spark):
    ends = ["postgres://db/x", "redis://cache:6379/0", "s3+x://b", "db.example.com:5432", "my_db.internal:80", "localhost:80"]
    texts = [f"{end} K={BLOB}" for end in ends] + [f"HOST={end}\nK={BLOB}" for end in ends]
    both = [[f"endpoint {end}", f"blob {BLOB}"] for end in ends]
    assert spans_of(spark, texts) == both + both


def test_sql_knows_the_same_rules(spark):
    """The SQL counterpart over texts that hold every notation, not only the given documents."""
    import duckdb
    import pandas as pd

    from cadastra.llm.queries import ORACLES

    documents = pd.DataFrame({"doc_id": range(len(texts())), "text": texts()})  # noqa: F841  read by the SQL
    got = {row[0]: row[-1] for row in duckdb.sql(ORACLES["op7_linked_secrets"]).fetchall()}
    assert got == {i: brute(t) for i, t in enumerate(texts())}
