"""Secret scan against Python regular expressions and dictionaries."""

from __future__ import annotations

import re
import time
from collections import defaultdict

import duckdb

from unitmesh.llm.secrets import scan_secrets
from unitmesh.llm.sql import OP3_SECRET_SCAN

ASSIGN = re.compile(r"(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A)
KINDS = ["assign", "access", "hex", "owned", "copied"]
BAD = re.compile(r"example|sample|dummy|change_?me|placeholder|your_|xxxx|0000|1234567", re.I)


def base_of(text):
    out = [(m.start(), 0, m.end(), m.group(1)) for m in ASSIGN.finditer(text) if len(m.group(1)) >= 6]
    out += [(m.start(), 1, m.end(), m.group()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m.group()) >= 20]
    return out + [(m.start(), 2, m.end(), m.group()) for m in re.finditer(r"[0-9a-f]+", text) if len(m.group()) >= 24]


def slow(docs):
    found, owners, repos = [], defaultdict(set), defaultdict(set)
    for i, t, s in docs:
        base = base_of(t or "")
        cand = {(e - len(v), e, v) for _, k, e, v in base} | {(m.start(), m.end(), m.group()) for m in re.finditer(r"[A-Za-z0-9_+/=-]{20,}", t or "")}
        found.append((i, base, cand))
        for _, _, v in cand:
            owners[v].add(s)
            repos[v].add((s, i))
    out = []
    for i, base, cand in found:
        added = []
        for b, e, v in cand:
            live = len(v) >= 16 and re.search("[0-9]", v) and re.search("[A-Za-z]", v) and len(set(v)) >= 8 and not BAD.search(v)
            if len(owners[v]) >= 3 or len(repos[v]) >= 10:
                added.append((b, 4, e))
            elif len(owners[v]) == 1 and live:
                added.append((b, 3, e))
        text = lambda x: ",".join(f"{KINDS[k]}:{b}:{e}" for b, k, e in sorted(x))
        base = [(b, k, e) for b, k, e, _ in base]
        out.append((i, *(sum(k == n for _, k, _ in base) for n in range(3)), text(base), text(base + added)))
    return sorted(out, key=str)


def result(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_assign", "n_access", "n_hex", "base", "spans").collect()), key=str)


def check(df):
    assert result(scan_secrets(df)) == slow([(r["doc_id"], r["text"], r["source"]) for r in df.collect()])


def test_whole_table(docs_of, corpus):
    check(docs_of(corpus))


def test_edges(docs_of):
    key = "AKIA" + "ABCDEFGH12345678"
    pairs = [(1, None), (2, ""), (3, f"é😀 token = \"a1b2c3d4e5f6g7h8i9\" {key} {key}"), (4, "secret: token: abcdefgh"), (5, "PASSWORD='x'"),
             (6, "Api_Key=" + "k" * 5), (7, "apikey:abcdef"), (8, "AKIA" + "A" * 15), (9, "AKIAX" * 10), (10, "0123456789abcdef" * 2), (11, "a" * 23),
             (12, "token=" + "9f" * 60000), (None, f"x {key}"), (3, "passwd = longenough"), (14, "ſecret=abcdefgh toKen=abcdefgh"),
             (15, "token=" + "Zx9Kq2Lm4Np6Rt8Vw"), (16, "a b " * 100000 + "token: abc.def/ghi+jkl=123"), (17, "== :: = :"), (18, "token=token=abcdef")]
    check(docs_of(pairs, base="mine", spans=1, _hash="h"))
    assert result(scan_secrets(docs_of([]))) == []


def test_copied_by_three_owners_owned_by_one(docs_of):
    shared, own = "ab12cd34ef56ab78cd90ef12ab34cd56", "ffee1122ddcc3344bbaa5566"
    pairs = [(i, f"k {shared}") for i in range(6)] + [(9, f"k {own}")]
    got = {r["doc_id"]: r["spans"] for r in scan_secrets(docs_of(pairs)).collect()}
    assert got[0] == "hex:2:34,copied:2:34" and got[9] == "hex:2:26,owned:2:26"


def test_copied_by_many_repositories_of_one_owner(docs_of):
    many, few, two = "ab12cd34ef56ab78cd90ef12ab34cd56", "ffee1122ddcc3344bbaa5566", "9f8e7d6c5b4a39281706f5e4"
    # docs_of gives row k the source k % 3: every third row is one owner's
    texts = {3 * k: f"k {many}" for k in range(10)} | {3 * k + 1: f"k {few}" for k in range(9)} | {2: f"k {two}", 30: f"k {two}"}
    docs = docs_of([(i, texts.get(i, "")) for i in range(31)])
    got = {r["doc_id"]: (r["spans"], r["n_owned"], r["n_copied"]) for r in scan_secrets(docs).collect()}
    assert {got[3 * k] for k in range(10)} == {("hex:2:34,copied:2:34", 0, 1)}
    assert {got[3 * k + 1] for k in range(9)} == {("hex:2:26,owned:2:26", 1, 0)}
    assert got[2] == got[30] == ("hex:2:26", 0, 0)  # two owners, few repositories
    # two owners, as many repositories as make a copy
    more = {r["doc_id"]: r["spans"] for r in scan_secrets(docs, copied_repos=2).collect()}
    assert more[2] == more[30] == "hex:2:26,copied:2:26"
    # a value repeated inside one document is in one repository
    same = scan_secrets(docs_of([(1, f"k {few} " * 12)])).first()
    assert (same["n_owned"], same["n_copied"]) == (12, 0)


def test_sql_counts_repositories_of_one_owner(docs_of):
    """One owner's value in ten documents, another's in nine: plain version and SQL agree."""
    many, few = "ab12cd34ef56ab78cd90ef12ab34cd56", "ffee1122ddcc3344bbaa5566"
    texts = {3 * k: f"k {many} token = {many}" for k in range(10)} | {3 * k + 1: f"k {few}" for k in range(9)}
    docs = docs_of([(i, texts.get(i, "")) for i in range(31)])
    check(docs)
    con = duckdb.connect()
    documents = docs.toPandas()  # noqa: F841
    con.register("documents", documents)
    got = {r["doc_id"]: (r["spans"], r["n_owned"], r["n_copied"]) for r in scan_secrets(docs).collect()}
    cur = con.execute(OP3_SECRET_SCAN)
    names = [c[0] for c in cur.description]
    want = {r["doc_id"]: (r["spans"], r["n_owned"], r["n_copied"]) for r in (dict(zip(names, x)) for x in cur.fetchall())}
    assert got == want and got[0][2] == 2 and got[1][1] == 1


def test_time_is_linear_in_matches(docs_of):
    def seconds(n):
        docs = docs_of([(1, " ".join(f"{i:032x}" for i in range(n)))])
        began = time.perf_counter()
        row = scan_secrets(docs).first()
        assert row["n_hex"] == n and row["base"].startswith("hex:0:32,hex:33:65,") and row["base"].endswith(f"hex:{33 * n - 33}:{33 * n - 1}")
        return time.perf_counter() - began

    seconds(10)
    fewer, more = seconds(10_000), seconds(100_000)
    assert more < 15 * fewer + 5
