"""Secret scans: spans against re, the ledger's increments, redaction."""

import random
import re

import pytest
from pyspark.sql import functions as F

from lendwise.llm import secret_ledger as sl
from lendwise.session import scratch_path

# The contract's base patterns, as text.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
KINDS = [("assign", ASSIGN, 2, 8), ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 16), ("hex", re.compile(r"[0-9a-f]+"), 0, 32)]
PARTS = ["password", "Token", "api_key", "APIKEY", "secret", "=", ":", " ", "  ", '"', "'", "abcdefgh", "ab", "AKIA", "ABCDEFGHIJKL", "0123456789abcdef" * 2,
         "é", "😀", "\n", "==", "x.y-z_", "deadbeef", "xoxb-1234567890ab", "ghp_" + "a1" * 18, "-----BEGIN RSA PRIVATE KEY-----"]


def _plain(text):
    found = [(m.start(), o, m.end(), kind) for o, (kind, pattern, group, least) in enumerate(KINDS)
             for m in pattern.finditer(text or "") if len(m.group(group)) >= least]
    return [(kind, a, b) for a, _, b, kind in sorted(found)]


def _scan(docs, ledger, **more):
    return sl.scan(docs, ledger, "doc_id", None, **more)


@pytest.fixture
def ledger(spark):
    return sl.Ledger(spark, scratch_path(spark, "ledger"))


def test_base_spans_equal_leftmost_matches(docs_of, ledger):
    rng = random.Random(11)
    texts = ["".join(rng.choices(PARTS, k=rng.randint(0, 40))) for _ in range(300)]
    texts += ["password=token:longvalue12345", "token==abc", "secret:" + "q" * 9 + " token='" + "w" * 8, None, "", "deadbeef " * 3000]
    got = {r.path: r.findings for r in _scan(docs_of(texts), ledger).collect()}
    base = {"assign", "access", "hex"}
    for i, text in enumerate(texts):
        assert [tuple(f) for f in got[i] if f.kind in base] == _plain(text), text
        starts = [f.start for f in got[i]]
        assert starts == sorted(starts)
    assert any(f.kind not in base for fs in got.values() for f in fs)


def test_only_unseen_pairs_are_scanned(spark, docs_of, ledger):
    first = docs_of(["token = abcdefgh1", "clean", "token = abcdefgh1"])
    _scan(first, ledger).collect()
    pairs = ledger.pairs()
    assert pairs.select("digest").distinct().count() == 2 and pairs.count() == 2 * len(sl.RULES)
    # A moved blob and a new one: only the new one is added.
    second = docs_of(["clean", "secret: zyxwvuts9", "token = abcdefgh1"], first=10)
    got = {r.path: [f.kind for f in r.findings] for r in _scan(second, ledger).collect()}
    assert got == {10: [], 11: ["assign"], 12: ["assign"]}
    assert ledger.pairs().count() == 3 * len(sl.RULES)
    # A new version of one rule scans every blob again for that rule alone.
    rules = tuple(sl.Rule(r.kind, r.scan + "!" if r.kind == "assign" else r.scan, r.group, r.least, 2 if r.kind == "assign" else 1, r.base) for r in sl.RULES)
    got = {r.path: [f.kind for f in r.findings] for r in _scan(second, ledger, rules=rules).collect()}
    assert got == {10: [], 11: [], 12: []}
    assert ledger.pairs().count() == 3 * len(sl.RULES) + 3
    assert ledger.pairs().where("rule_key = 'assign@2'").count() == 3


def test_a_scan_that_died_after_its_findings_is_repeated(docs_of, ledger):
    docs = docs_of(["token = abcdefgh1"])
    _scan(docs, ledger).collect()
    again = sl.Ledger(ledger.spark, scratch_path(ledger.spark, "ledger"))
    again.append(ledger.findings(), ledger.pairs().limit(0))  # findings only
    assert [len(r.findings) for r in _scan(docs, again).collect()] == [1]


def test_versions_and_paths(spark, ledger):
    rows = [("a", 1, "token = abcdefgh1"), ("a", 2, "token = <gone>"), ("b", 1, "token = abcdefgh1"), (None, None, "token = abcdefgh1"), ("a", 1, "token = abcdefgh1")]
    got = sl.scan(spark.createDataFrame(rows, "path string, version int, text string"), ledger).collect()
    assert sorted((str(r.path), str(r.version), len(r.findings)) for r in got) == sorted([("a", "1", 1), ("a", "2", 0), ("b", "1", 1), ("None", "None", 1), ("a", "1", 1)])


def test_redaction(docs_of, ledger):
    texts = ["a token = abcdefgh1 b", "password=" + "0123456789abcdef" * 2, "nothing", None, "", "é token: xxxxxxxx token: yyyyyyyy"]
    docs = docs_of(texts).withColumn("digest", F.lit("own"))
    got = sl.redact(docs, ledger)
    assert got.columns == docs.columns
    assert {r.doc_id: r.text for r in got.collect()} == {0: "a [SECRET] b", 1: "[SECRET]", 2: "nothing", 3: None, 4: "", 5: "é [SECRET] [SECRET]"}


def test_repeated_rows_count_once(spark, docs_of, ledger):
    text = "a token = abcdefgh1 b password: zyxwvuts9 c"
    docs = docs_of([text]).union(docs_of([text])).union(docs_of(["clean"], first=7))
    for _ in range(2):  # the second scan reads the ledger alone
        got = [(r.path, [tuple(f) for f in r.findings]) for r in _scan(docs, ledger).collect()]
        assert sorted(got) == [(0, _plain(text)), (0, _plain(text)), (7, [])]
    assert ledger.findings().count() == 2
    fresh = sl.Ledger(spark, scratch_path(spark, "ledger"))
    assert sorted(r.text for r in sl.redact(docs, fresh).collect()) == ["a [SECRET] b [SECRET] c"] * 2 + ["clean"]


def test_no_key_body_is_left(docs_of, ledger):
    lines = [("MIIEowIBAAKCAQEA0Z%02dx/+Qq" % i).ljust(64, "k") for i in range(600)]
    begin, end, tail = "-----BEGIN RSA PRIVATE KEY-----", "-----END RSA PRIVATE KEY-----", "\n".join([*lines, "Zm9vYg=="])
    fields = "Proc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,0011AA\n\n"
    keys = [f"{begin}\n{tail}\n{end}", f"{begin}\r\n{fields}{tail}\n{end}", begin + "\\n" + "\\n".join(lines) + "\\n" + end,
            f"{begin}\n{tail}", f"{begin}\n{fields}{tail}", f"{begin}\n" + "\n".join([*lines, "Zm9v"]),
            f"{begin}\n{tail}\n{begin}\n{tail}\n{end}", begin]
    texts = [f"before {k}\nafter it - all" for k in keys] + [f"{begin} is a key's first line"]
    got = {r.doc_id: r.text for r in sl.redact(docs_of(texts), ledger).collect()}
    assert [got[i] for i in range(len(keys))] == ["before [SECRET]\nafter it - all"] * 6 + ["before [SECRET]\n[SECRET]\nafter it - all"] + ["before [SECRET]\nafter it - all"]
    assert got[len(keys)] == "[SECRET] is a key's first line"


def test_odd_rows(edge, empty, ledger):
    got = _scan(edge, ledger).collect()
    assert len(got) == edge.count() and all(r.findings == [] for r in got)
    assert _scan(empty, ledger).count() == 0
