import hashlib
import re

from haltwise.llm import secrets
from haltwise.llm.secrets import Rule

ASSIGN = r"""((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
BASE = [
    ("assign", re.compile(ASSIGN), lambda m: len(m[2]) >= 6),
    ("access", re.compile("AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20),
    ("hex", re.compile("[0-9a-f]+"), lambda m: len(m[0]) >= 24),
]


def spans(text):
    found = [
        (m.start(), k, name, m.end())
        for k, (name, pattern, good) in enumerate(BASE)
        for m in pattern.finditer(text or "")
        if good(m)
    ]
    return [(name, a, b) for a, _, name, b in sorted(found)]


def expected(rows):
    out = []
    for doc, text in rows:
        own = spans(text)
        joined = ",".join(f"{n}:{a}:{b}" for n, a, b in own)
        counts = [sum(n == kind for n, _, _ in own) for kind in ("assign", "access", "hex")]
        out.append((doc, *counts, hashlib.sha256(joined.encode()).hexdigest()))
    return sorted(out, key=str)


def got(df):
    columns = ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256"]
    return sorted(map(tuple, secrets.scan_documents(df)[0].select(columns).collect()), key=str)


def test_awkward_documents(awkward):
    assert got(awkward) == expected([(r.doc_id, r.text) for r in awkward.collect()])


def test_documents(documents):
    assert got(documents) == expected([(r.doc_id, r.text) for r in documents.collect()])


def test_empty_table(no_documents):
    assert got(no_documents) == []


def test_more_rules_add_spans(spark):
    text = "-----BEGIN RSA PRIVATE KEY-----\nAPI-KEY token:abcdefg"
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    row = secrets.scan_documents(df)[0].first()
    assert row.spans == "pem:0:31,assign:40:53"
    assert row.n_assign == 1


def test_only_unseen_blobs_and_rule_versions_are_scanned(spark):
    shape = "doc_id long, text string"
    one = spark.createDataFrame([(1, "token=abcdef"), (2, "token=abcdef"), (3, "none")], shape)
    _, ledger = secrets.scan_documents(one)
    assert ledger.count() == 2 * len(secrets.RULES)
    two = spark.createDataFrame([(4, "none"), (5, "token=abcdef"), (6, "secret:zzzzzz")], shape)
    result, added = secrets.scan_documents(two, ledger=ledger)
    assert added.select("digest").distinct().count() == 1
    assert {r.doc_id: r.n_assign for r in result.collect()} == {4: 0, 5: 1, 6: 1}
    # a new version of one rule is due for every blob, the others for none
    rules = [Rule("hex", 2, "[0-9a-f]+", 0, 24), *[r for r in secrets.RULES if r.kind != "hex"]]
    _, more = secrets.scan_documents(two, rules=rules, ledger=ledger.unionByName(added))
    assert {(r.kind, r.version) for r in more.collect()} == {("hex", 2)}
    assert more.count() == 3


def test_redaction_masks_spans_and_keeps_the_rest(awkward):
    _, ledger = secrets.scan_documents(awkward)
    masked = secrets.redact(awkward, ledger, secrets.RULES)
    assert masked.columns == awkward.columns

    def mask(text):
        if text is None:
            return None
        out, at = "", 0
        for _, a, b in spans(text):
            if a >= at:
                out += text[at:a] + "[secret]"
            at = max(at, b)
        return out + text[at:]

    want = sorted(((r.doc_id, mask(r.text)) for r in awkward.collect()), key=str)
    assert sorted(((r.doc_id, r.text) for r in masked.collect()), key=str) == want


def test_steps_scan_each_pair_of_blob_and_rule_version_once(documents):
    result, ledger = secrets.scan_in_steps(documents, [secrets.BASE_RULES, secrets.RULES, secrets.RULES])
    whole, once = secrets.scan_documents(documents)
    assert sorted(map(tuple, result.collect()), key=str) == sorted(map(tuple, whole.collect()), key=str)
    keys = ["digest", "kind", "version"]
    assert ledger.count() == ledger.select(keys).distinct().count() == once.count()
    _, more = secrets.scan_documents(documents, secrets.RULES, ledger)
    assert more.count() == 0
