import hashlib
import math
import random
import re
from collections import Counter, defaultdict

from prevascope.llm import secrets as op
from prevascope.llm.common import table
from tests.conftest import SAMPLE
from tests.llm.rows import SCHEMA, awkward, rows, with_clashes

#: The patterns as the contract gives them.
ASSIGN = re.compile(r"((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd])|(?:[Pp][Aa][Ss][Ss][Ww][Dd])|(?:[Ss][Ee][Cc][Rr][Ee][Tt])|(?:[Tt][Oo][Kk][Ee][Nn])"
                    r"|(?:[Aa][Pp][Ii]_?[Kk][Ee][Yy]))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")  # fmt: skip


def brute(text):
    text = text or ""
    found = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [("access", m.start(), m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [("hex", m.start(), m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found, key=lambda x: (x[1], ("assign", "access", "hex").index(x[0])))


def digest(spans):
    return hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in spans).encode()).hexdigest()


def test_base_matches_on_random_texts():
    rng = random.Random(5)
    bits = ["token", "Api_KEY", "pass", "word", "passwd", " ", "=", ":", '"', "'", "AKIA", "AB12", "deadbeef", "0123456789abcdef", "ſecret", "é", "."]
    for _ in range(4000):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(0, 25)))
        assert [m[:3] for m in op.base_matches(text)] == brute(text)


def further(text, taken):
    """The other candidates as the docstring gives them."""
    free = lambda m, t: all(e <= m.start() or m.end() <= s for _, s, e in t)
    mixed = lambda v: re.search("[0-9]", v) and re.search("[A-Za-z]", v)
    bits = lambda v: -sum(c / len(v) * math.log2(c / len(v)) for c in Counter(v).values())
    owned = [("owned", *m.span()) for m in re.finditer(r"[A-Za-z0-9+/_=-]{20,}", text) if mixed(m[0]) and bits(m[0]) >= 3.5 and free(m, taken)]
    runs = [m for m in re.finditer(r"[A-Za-z0-9]+", text) if len(m[0]) >= 12 and mixed(m[0]) and free(m, taken + owned)]
    return owned + [("reused", *m.span()) for m in runs]


def value(text, kind, start, end):
    return ASSIGN.match(text[start:end])[2] if kind == "assign" else text[start:end]


def by_hand(data):
    """doc_id -> spans, live and example, from plain counts over (doc_id, text, owner)."""
    data = [(i, t or "", o or "") for i, t, o in data]
    share = {o: n / len(data) for o, n in Counter(o for _, _, o in data).items()}
    found = {i: brute(t) for i, t, _ in data}
    found = {i: found[i] + further(t, found[i]) for i, t, _ in data}
    home, proven = defaultdict(dict), set()
    for i, t, o in sorted(data):
        for span in found[i]:
            v = value(t, *span)
            home[v].setdefault(t, o)  # the owner of the first of equal texts
            if span[0] in ("assign", "access", "hex"):
                proven.add(v)

    def live(v):
        n = Counter(home[v].values())
        d = sum(n.values())
        score = lambda o: n[o] * math.log(0.9 / share[o]) + (d - n[o]) * math.log(0.1 / max(1 - share[o], 1e-12))
        return len(n) == 1 or max(map(score, n)) > 0

    out = {}
    for i, t, _ in data:
        shown, verdicts = [], []
        for span in sorted(found[i], key=lambda x: (x[1], ("assign", "access", "hex", "owned", "reused").index(x[0]))):
            v = value(t, *span)
            alive, uses = live(v), home[v]
            proof = v in proven or (len(uses) > 1 and len(set(uses.values())) == 1)
            if span[0] in ("assign", "access", "hex") or (alive and (span[0] == "owned" or proof)):
                shown.append(":".join(map(str, span)))
                verdicts.append(alive)
        out[i] = (",".join(shown), sum(verdicts), len(verdicts) - sum(verdicts))
    return out


def planted():
    key, strong, short = "AKIA" + "Q7" * 9, "zQ8vT3kLp0XyR5wB2nMc7H", "pq73xk20vv91m"
    data = [(20, f"key {strong} here {key}", "r1"), (21, f"again {strong}", "r1"), (22, f"key {strong} here {key}", "r5")]
    data += [(30 + i, f"sample {strong[::-1]} and token: abcdef{i}", f"r{i}") for i in range(6)]
    data += [(40 + i, f"build {i} of {short}", "r2") for i in range(3)]  # one owner's, in three repositories
    data += [(50 + i, f"part number {short[::-1]} {i}", f"r{i}") for i in range(6)]  # anyone's
    data += [(60, "password = k3yk3yk3yk3yk3y", "r3"), (61, "use k3yk3yk3yk3yk3y to log in", "r3"), (62, "a lone 9876543210zz is none", "r4")]
    data += [(70 + i, "the same text: secret=s3cr3t0fall", f"r{i}") for i in range(6)]  # copies of one repository
    return data + [(100 + i, f"plain text {i}", f"r{i % 6}") for i in range(60)]


def test_ownership_decides(spark):
    data = planted()
    docs = spark.createDataFrame([(i, t, "en", o, 1) for i, t, o in data], SCHEMA)
    got = {r.doc_id: r for r in op.secret_scan(with_clashes(docs)).collect()}
    assert {i: (r.spans, r.n_live, r.n_example) for i, r in got.items()} == by_hand(data)
    assert got[20].spans == "owned:4:26,access:32:54" and got[21].spans == "owned:6:28"
    assert got[32].spans == "assign:34:48" and {f.verdict for f in got[32].findings if f.kind == "owned"} == {"example"}
    assert got[41].spans == "reused:11:24" and got[52].spans == ""
    assert got[61].spans == "reused:4:19" and got[61].n_live == 1 and got[62].spans == ""
    assert got[73].n_live == 1 and got[73].findings[0].repositories == 1 and got[73].findings[0].uses == 6


def test_named_repository(spark):
    """Repositories of a column's own: the six owners' copies are six uses, hence an example."""
    docs = spark.createDataFrame([(i, t, "en", o, 1) for i, t, o in planted()], SCHEMA)
    got = {r.doc_id: r for r in op.secret_scan(docs, repository="doc_id").collect()}
    assert got[73].n_example == 1 and got[73].findings[0].repositories == 6


def test_awkward_rows(spark):
    data = awkward()
    docs = spark.createDataFrame(data, SCHEMA)
    got = op.secret_scan(with_clashes(docs)).collect()
    assert len(got) == len(data)
    expected = Counter((i, digest(brute(t))) for i, t, *_ in data)
    assert Counter((r.doc_id, r.base_sha256) for r in got) == expected
    assert rows(op.secret_scan(docs.limit(0))) == []


def test_sample(spark):
    docs = table(spark, SAMPLE, "documents")
    got = {r.doc_id: r for r in op.secret_scan(docs).collect()}
    data = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    for i, text, _ in data:
        assert got[i].base_sha256 == digest(brute(text)) and got[i].n_hex == sum(s[0] == "hex" for s in brute(text))
    assert {i: (r.spans, r.n_live, r.n_example) for i, r in got.items()} == by_hand(data)
