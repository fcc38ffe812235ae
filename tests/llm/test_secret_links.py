"""Linking of secret parts against brute force and the SQL, on texts in which linking decides."""

import random
import re

import pytest

from tessella.llm import secrets
from tests.compare import duck_rows, spark_rows

PIECES = [
    "user: JohnSmith1985Official", "account: MyCompanyAccount2024", "login=bob", "CLIENT_ID: ab_" + "1a" * 12, "AKIA" + "Q1" * 9, "password = hunter22", "api_key='" + "aB3" * 7 + "'", "deadbeef" * 4,
    "k3v-9xq2_mm81-zt40b", "Zz9" * 7, "https://example.com/Blog/2024/some-title-of-2024", "https://db.example:5432 ", "HOST=db-1-internal-example", "server: s", "plain words only", "é😀", "\n", " " * 190, " " * 30, ", ",
]


def linked(text):
    """All spans by the method, by loops over all pairs."""
    def spans(kind, pattern, keep=lambda m: True):
        return [(m.start(), secrets.KINDS.index(kind), m.end()) for m in re.finditer(pattern, text) if keep(m)]
    base = spans("assign", secrets.ASSIGN, lambda m: len(m[2]) >= 6) + spans("access", secrets.ACCESS) + spans("hex", secrets.HEX)
    named = spans("ident", secrets.IDENT, lambda m: len(m[2]) >= 3) + spans("endpoint", secrets.ENDPOINT)
    taken = base + named + spans("endpoint", secrets.URL)
    runs = spans("secret", secrets.SECRET, lambda m: re.search("[A-Za-z]", m[0]) and re.search("[0-9]", m[0]))
    weak = named + [r for r in runs if not any(t[0] < r[2] and r[0] < t[2] for t in taken)]
    gap = lambda a, b: max(a[0] - b[2], b[0] - a[2])
    out = set(base)
    for w in weak:
        near = [p for p in base + weak if 0 <= gap(w, p) <= secrets.SCOPE]
        idents, hidden = [p for p in near if p[1] in (1, 3)], [p for p in near if p[1] in (0, 2, 4)]
        if (w[1] == 3 and hidden) or (w[1] == 4 and (idents or any(p[1] == 5 for p in near))) or (w[1] == 5 and any(gap(a, b) >= 0 for a in idents for b in hidden)):
            out.add(w)
    return sorted(out)


@pytest.fixture(scope="module")
def made(spark, tmp_path_factory):
    random.seed(5)
    texts = ["".join(f"{random.choice(PIECES)}{random.choice([' ', chr(10), '; '])}" for _ in range(random.randrange(1, 7))) for _ in range(400)]
    folder = tmp_path_factory.mktemp("secrets")
    df = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate([*PIECES, *texts])], "doc_id long, text string, lang string, source string, n_chars long")
    df.toPandas().to_parquet(f"{folder}/documents.parquet")
    return df, str(folder)


def test_links_are_those_of_brute_force(made):
    df, _ = made
    got = {r.id: sorted(map(tuple, r.spans)) for r in secrets.scan_secrets(df).collect()}
    want = {r.doc_id: linked(r.text) for r in df.collect()}
    assert got == want
    kinds = [s[1] for spans in want.values() for s in spans]
    assert min(kinds.count(k) for k in range(6)) > 20


def test_no_piece_confirms_itself(made):
    """URLs with paths, logins, accounts, host settings and runs alone give no weak span."""
    df, _ = made
    alone = {r.id: [s for s in r.spans if s[1] > 2] for r in secrets.scan_secrets(df.filter(f"doc_id < {len(PIECES)}")).collect()}
    hex_login = PIECES.index("CLIENT_ID: ab_" + "1a" * 12)
    assert all(not spans for i, spans in alone.items() if i != hex_login) and not alone[hex_login]


def test_sql_says_the_same(made):
    df, folder = made
    assert spark_rows(secrets.secret_digest(df)) == duck_rows(secrets.ORACLE, folder)
