"""Secret scans against a plain all-pairs search over one text."""

import hashlib
import random
import re
import time

import duckdb
import pytest
from compare import difference
from pyspark.sql import functions as F

from tidemark.llm import secrets
from tidemark.llm.sql import SQL

REACH = 200
NAMES = ["password", "PassWd", "secret", "token", "API_KEY", "apikey", "user", "Username", "login", "account", "clientid", "client_id", "key_id", "KeyId", "ſecret", "toKen"]
VALUES = ["abc", "abcdefg", "abcdefgh", "Zz9", "hunter2hunter2", "a.b=c/d+e_f-g", "AKIA" + "Q7" * 8, "AKIAQ7", "Qw3rTy7Uio9Pasd1", "Qw3rTy7Uio9Pas", "0123456789abcdef" * 2, "deadbeef" * 3, "é"]


def one_text(rng):
    out = []
    for _ in range(rng.randrange(0, 14)):
        kind = rng.randrange(7)
        if kind < 2:
            q = rng.choice(["", "'", '"'])
            out.append(f"{rng.choice(NAMES)}{q}{' ' * rng.randrange(3)}{rng.choice([':', '=', ' '])}{' ' * rng.randrange(3)}{q}{rng.choice(VALUES)}{q}")
        elif kind == 2:
            out.append(rng.choice(VALUES))
        elif kind == 3:
            out.append(rng.choice(["https://api.example.com/v1/Qw3rTy7Uio9Pasd1xx", "http://h", "http://db.example.org:99?user=bob", "ftp://x.example.com"]))
        else:
            out.append(rng.choice(["prose words ", "è\U0001f600 ", "-" * 40 + " ", "word " * rng.randrange(1, 45)]))
        out.append(rng.choice([" ", " ", "\n", "\n\n", "\n \t\n", ";"]))
    return "".join(out)


def by_pairs(text):
    """The docstring's rules, one span against each other."""
    text = text or ""
    rules = {
        "assign": (r"(?i:password|passwd|secret|token|api_?key)[\"']? *[:=] *[\"']?(?P<v>[A-Za-z0-9+/_.=-]+)", 8), "access": (r"(?P<v>AKIA[A-Z0-9]+)", 16), "hex": (r"(?P<v>[0-9a-f]+)", 32),
        "identifier": (r"(?i:username|user|login|account|client_?id|key_?id)[\"']? *[:=] *[\"']?(?P<v>[A-Za-z0-9_.@+-]+)", 3), "secret": (r"(?P<v>[A-Za-z0-9+/_-]+)", 16), "endpoint": (r"(?P<v>https?://[A-Za-z0-9._~:/?#@%&=+-]+)", 11),
    }
    found = {k: [m.span() for m in re.finditer(p, text, re.A) if len(m["v"]) >= n] for k, (p, n) in rules.items()}
    base = [(a, k, b) for k in ("assign", "access", "hex") for a, b in found[k]]
    meets = lambda s, others: any(a < s[1] and s[0] < b for a, b in others)
    strong = [(a, b) for a, _, b in base]
    weak = {k: [s for s in found[k] if not meets(s, strong)] for k in ("identifier", "endpoint")}
    mixed = [s for s in found["secret"] if all(re.search(c, text[slice(*s)]) for c in ("[a-z]", "[A-Z]", "[0-9]"))]
    weak["secret"] = [s for s in mixed if not meets(s, strong + weak["identifier"] + weak["endpoint"])]
    scope = lambda s: len(re.findall(r"\n[ \t\r]*\n", text[: s[0]]))
    near = lambda s, t: scope(s) == scope(t) and max(s[0], t[0]) - min(s[1], t[1]) <= REACH
    added = set()
    for i, sure_i in [(s, True) for s in found["access"]] + [(s, False) for s in weak["identifier"]]:
        for s, kind in [(s, k) for k in ("assign", "hex") for s in found[k]] + [(s, "secret") for s in weak["secret"]]:
            if near(i, s):
                ends = [e for e in weak["endpoint"] if near(e, i) and near(e, s)]
                if sure_i or kind != "secret" or ends:
                    added |= {(i[0], "identifier", i[1])} if not sure_i else set()
                    added |= {(s[0], "secret", s[1])} if kind == "secret" else set()
                added |= {(e[0], "endpoint", e[1]) for e in ends}
    key = lambda p: (p[0], secrets.ORDER.index(p[1]))
    show = lambda spans: ",".join(f"{k}:{a}:{b}" for a, k, b in sorted(spans, key=key))
    return (*(len(found[k]) for k in ("assign", "access", "hex")), hashlib.sha256(show(base).encode()).hexdigest(), show([*base, *added]))


def test_secrets_against_all_pairs_and_sql(spark, tmp_path):
    rng = random.Random(12)
    rows = [(k, one_text(rng)) for k in range(1200)] + [(None, None), (None, ""), (5, "login: bob password=abcdefgh"), (5, "login: bob password=abcdefgh")]
    rows.append((2000, "user: bob\n" + "x" * 5000 + "\n" + ("key_id=abcd " + "Qw3rTy7Uio9Pasd1 ") * 300 + "https://api.example.com"))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    out = secrets.digest(secrets.find_secrets(docs.withColumns({c: F.lit("x") for c in ("uid", "base", "parts", "span", "bin", "lo", "scope")})))
    got = sorted((str(r.doc_id), *r[1:]) for r in out.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans").collect())
    assert got == sorted((str(d), *by_pairs(t)) for d, t in rows)
    assert sum("identifier" in r[-1] for r in got) > 50 and sum("endpoint" in r[-1] for r in got) > 20 and sum(",secret" in r[-1] for r in got) > 20
    docs.coalesce(1).write.parquet(f"{tmp_path}/d")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/d/*.parquet'")
    assert difference(out, con, SQL["op12_secrets"]) == ([], [], [])


@pytest.mark.parametrize("text", ["token" + " " * 400_000, "token = " * 60_000, "a" * 1_000_000, "user: ab " * 60_000, "AKIA" * 200_000, "\n \n" * 200_000])
def test_long_texts(spark, text):
    began = time.perf_counter()
    out = secrets.digest(secrets.find_secrets(spark.createDataFrame([(1, text)], "doc_id long, text string"))).collect()
    assert len(out) == 1 and time.perf_counter() - began < 30


def test_empty_table(spark):
    assert secrets.digest(secrets.find_secrets(spark.createDataFrame([], "doc_id string, text string"))).count() == 0
