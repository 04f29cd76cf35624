import hashlib
import re

import pytest

from strandweave.llm.secrets import scan_secrets
from strandweave.tables import Workspace

KINDS = [
    ("assign", re.compile(r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 1, 6),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    ("hex", re.compile(r"[0-9a-f]+"), 0, 24),
]
OPAQUE = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}")
KEY = "AKIA" + "Q7" * 8
RANDOM = "xK9dQ2mZ7pL4wR8tB1vN"


def base(text):
    found = []
    for number, (kind, pattern, group, least) in enumerate(KINDS):
        found += [(m.start(), number, m.end(), kind) for m in pattern.finditer(text or "") if len(m.group(group)) >= least]
    return sorted(found)


def joined(spans):
    return ",".join(f"{kind}:{start}:{end}" for start, _, end, kind in spans)


TEXTS = [
    "password=hunter22 and TOKEN : \"abcdef.gh\"", "token=token:abcdefgh", "api_key='x'", "apikey==abc12", "Passwd=ſecret=abcdef",
    f"é{KEY} {KEY[:19]} AKIA{KEY}", "0" * 24 + " " + "f" * 23 + "g", "secret = " + "a" * 40, f"日本 \U0001f600 token={KEY}", f"see {RANDOM} here",
    "z" * 50000 + " password: 123456 " + "ab" * 5000, "password=abc password=abcdef secret:secret:secretsecret",
]


def test_base_spans_equal_a_scan_by_hand(spark, edge_documents):
    extra = spark.createDataFrame([(100 + i, t, None, "s", None, None, None) for i, t in enumerate(TEXTS)], edge_documents.schema)
    docs = edge_documents.unionByName(extra)
    wanted = sorted((str(r.doc_id), base(r.text)) for r in docs.collect())
    rows = scan_secrets(docs, Workspace(spark)).collect()
    digest = lambda spans: hashlib.sha256(joined(spans).encode()).hexdigest()
    count = lambda spans, kind: sum(s[3] == kind for s in spans)
    assert sorted((str(r.doc_id), r.base_sha256, r.n_assign, r.n_access, r.n_hex) for r in rows) == sorted(
        (i, digest(s), count(s, "assign"), count(s, "access"), count(s, "hex")) for i, s in wanted)
    of = {r.doc_id: r for r in rows}
    assert of[109].spans == "opaque:4:24"
    assert of[101].n_assign == 0 and of[111].n_assign == 2


def test_a_value_that_many_owners_hold_is_an_example(spark):
    rows = [(i, f"token={KEY} {RANDOM}", f"o{i % 3}") for i in range(9)] + [(50, "password=only-mine", "o1"), (51, f"{RANDOM[::-1]} x", "o1")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    of = {r.doc_id: r for r in scan_secrets(docs, Workspace(spark)).collect()}
    assert (of[0].n_live, of[0].n_example) == (0, 3) and "opaque" not in of[0].spans and "assign:0:26" in of[0].spans
    assert (of[50].n_live, of[50].n_example) == (1, 0) and of[51].spans == "opaque:0:20"


def test_copies_of_one_owner_stay_live_and_those_of_two_are_an_example(spark):
    rows = [(i, f"{RANDOM} x", "o") for i in range(40)] + [(100 + i, f"{RANDOM[::-1]} x", f"p{i % 2}") for i in range(20)]
    rows += [(200 + i, f"{RANDOM[:-1]}Z", f"p{i % 2}") for i in range(19)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    got = {r.doc_id: r.spans for r in scan_secrets(docs, Workspace(spark)).collect()}
    assert got == {i: "" if 100 <= i < 200 else "opaque:0:20" for i, _, _ in rows}


def test_opaque_tokens_that_base_spans_touch(spark):
    texts = [f"token={RANDOM}", f"{RANDOM}{'0a' * 12}", f"{'0a' * 12} {RANDOM}", f"{RANDOM}token=abcdefgh", f"{RANDOM} token={KEY} {RANDOM[::-1]}", RANDOM + "/" + KEY]
    docs = spark.createDataFrame([(i, t, "s") for i, t in enumerate(texts)], "doc_id bigint, text string, source string")
    got = {r.doc_id: r.spans for r in scan_secrets(docs, Workspace(spark)).collect()}
    for i, text in enumerate(texts):
        fixed = base(text)
        loose = [(m.start(), 3, m.end(), "opaque") for m in OPAQUE.finditer(text) if all(re.search(c, m.group()) for c in ("[0-9]", "[A-Z]", "[a-z]"))]
        loose = [o for o in loose if not any(b[0] < o[2] and o[0] < b[2] for b in fixed)]
        assert got[i] == joined(sorted(fixed + loose))


def test_a_text_with_very_many_secrets(spark):
    text = "".join(f"{i:024x} token=t{i:06d}; " for i in range(100_000))
    docs = spark.createDataFrame([(1, text, "s")], "doc_id bigint, text string, source string")
    row, = scan_secrets(docs, Workspace(spark)).collect()
    assert (row.n_hex, row.n_assign, row.n_live) == (100_000, 100_000, 200_000)
    assert row.base_sha256 == hashlib.sha256(joined(base(text)).encode()).hexdigest()


def test_no_documents(spark, no_documents):
    assert scan_secrets(no_documents, Workspace(spark)).collect() == []


@pytest.mark.parametrize("name", ["documents"])
def test_given_table(spark, name):
    docs = spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet")
    wanted = sorted((r.doc_id, hashlib.sha256(joined(base(r.text)).encode()).hexdigest()) for r in docs.select("doc_id", "text").collect())
    got = scan_secrets(docs, Workspace(spark)).select("doc_id", "base_sha256").collect()
    assert sorted(map(tuple, got)) == wanted
