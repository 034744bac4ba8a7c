import hashlib
import re
import time

import pytest
from oracle_check import connect, differences

from riskstream.llm import licenses, secrets
from riskstream.llm.queries import ORACLE, QUERIES

ASSIGN = re.compile(r"(?ai:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
TRICKY = [
    'token:token"=abcdefgh', "PassWord = 'abc123' APIKEY=ABCDEF api_key:\"zzzzzzz\"", "AKIA" + "A1" * 10 + " AKIAAKIA12", "0123456789abcdef01234567 g" + "f" * 23,
    "paſword=abcdefg toKen=abcdefg", "\U0001f600 secret = abcdefgh", "", "secret=secret=aaaaaaaa", "password password=short password: lengthy",
]


def base_spans(text):
    spans = [(m.start(), 0, f"assign:{m.start()}:{m.end()}") for m in ASSIGN.finditer(text) if len(m[1]) >= 6]
    spans += [(m.start(), 1, f"access:{m.start()}:{m.end()}") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    spans += [(m.start(), 2, f"hex:{m.start()}:{m.end()}") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return [s for _, _, s in sorted(spans)]


def test_secret_base_spans(spark, sf_dir, docs, texts):
    more = spark.createDataFrame(list(enumerate(TRICKY)), "doc_id long, text string")
    table = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    for df in (more, table, docs):
        bodies = {(r[0], r[1] or "") for r in df.select("doc_id", "text").collect()}
        want = {(i, hashlib.sha256(",".join(base_spans(t)).encode()).hexdigest()) for i, t in bodies}
        rows = secrets.secret_digest(secrets.secret_scan(df)).collect()
        assert {(r["doc_id"], r["base_sha256"]) for r in rows} == want
        assert len(rows) == df.count()


def test_all_spans_hold_the_base_ones():
    for text in TRICKY:
        base, spans = secrets.scan_text(text)
        assert set(base) <= set(spans)


@pytest.mark.parametrize(
    ("text", "literals"),
    [
        ("db_password = 'kX82hs71Lq0z'", ["kX82hs71Lq0z"]),
        ('k = "kX82hs71Lq0z"\nsession_secret: k', ["kX82hs71Lq0z"]),
        ('a = "kX82hs71"\nb = a + "Lq0zPw93"\nauth_token = b', ["kX82hs71", "Lq0zPw93"]),
        ('{"client_secret": "kX82hs71Lq0z"}', ["kX82hs71Lq0z"]),
        ("export API_KEY=kX82hs71Lq0z", ["kX82hs71Lq0z"]),
        ("title = 'kX82hs71Lq0z'", []),
        ("password = 'aaaaaaaaaaaa'", []),
        ("password = get_password", []),
        ("password == 'kX82hs71Lq0z'", []),
        ("a = a + a\npassword = a", []),
    ],
)
def test_literals(text, literals):
    assert [text[s:e] for s, e, _ in secrets.literal_spans(text)] == literals


@pytest.mark.parametrize(
    ("text", "literals"),
    [
        ("signing_private_key" + " " * 9 + "= 'kX82hs71Lq0zPw93'", ["kX82hs71Lq0zPw93"]),
        ("private_key" + "\t" * 40 + "=" + " " * 300 + "'kX82hs71Lq0zPw93'", ["kX82hs71Lq0zPw93"]),
        ("k" + " " * 20 + "= 'kX82hs71Lq0zPw93'\nprivate_key = k", ["kX82hs71Lq0zPw93"]),
        ("private_key = 'kX82hs71'" + " " * 20 + "+" + " " * 20 + "'Lq0zPw93'", ["kX82hs71", "Lq0zPw93"]),
        ("private_key" + "_a" * 200 + " = 'kX82hs71Lq0zPw93'", ["kX82hs71Lq0zPw93"]),
        ('config["private_key"] = "kX82hs71Lq0zPw93"', ["kX82hs71Lq0zPw93"]),
        ("config['app'][ 'private_key' ]   => 'kX82hs71Lq0zPw93'", ["kX82hs71Lq0zPw93"]),
        ("--private-key=kX82hs71Lq0zPw93 2private_key = 'Zq81mm02Xk3vTr47'", ["kX82hs71Lq0zPw93", "Zq81mm02Xk3vTr47"]),
        ("title" + " " * 20 + "= 'kX82hs71Lq0zPw93'", []),
        ('config["title"] = "kX82hs71Lq0zPw93"', []),
        ("private_key] = 'kX82hs71Lq0zPw93'", []),
    ],
)
def test_literals_of_aligned_long_and_subscripted_names(text, literals):
    assert [text[s:e] for s, e, _ in secrets.literal_spans(text)] == literals


SECRET = "kX82hs71Lq0zPw93"


@pytest.mark.parametrize(
    ("text", "literals"),
    [
        (f'private_key: str = "{SECRET}"', [SECRET]),
        (f'let authToken: string = "{SECRET}";', [SECRET]),
        (f'private_key: Optional[str] = "{SECRET}"', [SECRET]),
        (f'private_key = """{SECRET}"""', [SECRET]),
        (f"private_key = '''\n  {SECRET}\n  Zq81mm02Xk3vTr47\n'''", [SECRET, "Zq81mm02Xk3vTr47"]),
        (f'private_key = f"{SECRET}"\nauth_token = b\'{SECRET}\'', [SECRET, SECRET]),
        (f"private_key = `{SECRET}`", [SECRET]),
        (f'private_key = ("{SECRET}")', [SECRET]),
        (f'private_key = (\n  "kX82hs71"\n  + "Lq0zPw93"\n)', ["kX82hs71", "Lq0zPw93"]),
        (f'private_key = ["{SECRET}", \'Zq81mm02Xk3vTr47\']', [SECRET, "Zq81mm02Xk3vTr47"]),
        (f'private_key = os.getenv("PRIVATE_KEY_OF_APP", "{SECRET}")', [SECRET]),
        (f'private_key = fetch_private_key("https://keys.example.com/a81")', []),
        (f'a, private_key = 1, "{SECRET}"', [SECRET]),
        (f'private_key, a = "{SECRET}", "Zq81mm02Xk3vTr47"', [SECRET]),
        (f'call(a, private_key="{SECRET}")', [SECRET]),
        (f"private_key: |\n  -----BEGIN KEY-----\n  {SECRET}\n\n  Zq81mm02Xk3vTr47\nother: Vb55nn19Lk2wQp60", [SECRET, "Zq81mm02Xk3vTr47"]),
        (f"<private_key>{SECRET}</private_key><title>Zq81mm02Xk3vTr47</title>", [SECRET]),
        (f'cfg["k"] = "{SECRET}"\nprivate_key = cfg["k"]', [SECRET]),
        (f'cfg["k"] = "{SECRET}"\nother["k"] = "Zq81mm02Xk3vTr47"\nprivate_key = cfg[\'k\']', [SECRET]),
        (f'cfg.k = "{SECRET}"\nprivate_key = cfg["k"]', [SECRET]),
        ("passphrase=correcthorsebat", ["correcthorsebat"]),
        ("f(passphrase=correcthorsebat)", []),
    ],
)
def test_literals_of_source_and_configuration_syntax(text, literals):
    assert [text[s:e] for s, e, _ in secrets.literal_spans(text)] == literals


def test_length_of_bare_words_is_a_parameter():
    assert secrets.literal_spans("passphrase = correcthorsebat") == []
    assert secrets.literal_spans("passphrase = correcthorsebat", bare_length=8) == [(13, 28, 3)]


@pytest.mark.parametrize("text", ["a=(" * 300_000, "a, " * 300_000 + "= 1", "a: |\n" * 200_000, "a=[" + "'x'," * 300_000, "<a>" * 300_000, 'a["b"]' * 150_000])
def test_nested_forms_are_read_in_linear_time(text):
    begin = time.process_time()
    assert secrets.literal_spans(text) == [] and time.process_time() - begin < 20


@pytest.mark.parametrize("text", ["a" * 1_000_000, "1." * 500_000, "a" + " " * 1_000_000, "'" * 500_000, "a = " + " " * 1_000_000, "a b " * 200_000])
def test_long_runs_are_read_in_linear_time(text):
    begin = time.process_time()
    assert secrets.literal_spans(text) == [] and time.process_time() - begin < 10


def test_no_literal_of_a_long_sum_is_left_out():
    pieces = [f"kX{n:04d}qZ" for n in range(3000)]
    text = 'a = ""\n' + "".join(f'a = a + "{piece}"\n' for piece in pieces) + "auth_token = a"
    assert [text[s:e] for s, e, _ in secrets.literal_spans(text) if e > s] == pieces
    doubled = 'a = "kX82hs71Lq0z"\n' + "a = a + a\n" * 5000 + "auth_token = a"
    assert [doubled[s:e] for s, e, _ in secrets.literal_spans(doubled)] == ["kX82hs71Lq0z"]


def test_secrets_of_no_documents(no_docs):
    assert secrets.secret_digest(secrets.secret_scan(no_docs)).count() == 0


def test_licenses_equal_sql(spark, sf_dir):
    con = connect(sf_dir)
    assert differences(QUERIES["op8_licenses"](spark, sf_dir), con, ORACLE["op8_licenses"]) is None


def test_license_edges(spark, docs, no_docs):
    rows = [
        (1, "CC BY-CC by cc  BY"), (2, None), (3, ""), (4, "All rights\nreserved. all RIGHTS reserved"), (5, "xcc by; cc byx"),
        (6, "see: Licensed under the (Apache) License, Version 2.0!\nmore"), (7, "licensed under the apache\nlicense version 2 0"),
        (8, "general public license general public license"), (9, "écc by cc by"),
    ]
    found = {r["doc_id"]: r for r in licenses.license_scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    base = {i: (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) for i, r in found.items()}
    assert base == {
        1: (6, 3, 0, 4, "cc-by"), 2: (0, 0, None, None, ""), 3: (0, 0, None, None, ""), 4: (6, 2, 0, 3, "reserved"), 5: (4, 0, None, None, ""),
        6: (10, 0, None, None, ""), 7: (8, 0, None, None, ""), 8: (6, 2, 0, 3, "gpl"), 9: (3, 0, None, None, ""),
    }
    assert (found[6]["labels"], found[6]["score"]) == ("apache-2.0", 1.0)
    assert (found[7]["labels"], found[7]["score"], found[1]["score"]) == ("", 0.0, 1.0)
    assert licenses.license_scan(docs).count() == docs.count()
    assert licenses.license_scan(no_docs).count() == 0
