import hashlib
import math
import random
import re
from collections import Counter

from prevascope.llm import privacy as op
from prevascope.llm import queries
from prevascope.llm.common import table
from tests.conftest import SAMPLE
from tests.llm.rows import SCHEMA, awkward, rows, with_clashes


def digits(text):
    return re.sub("[^0-9]", "", text)


def brute(text):
    """The patterns as the contract gives them."""
    text = text or ""
    found = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            found.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = digits(m[0])
        total = sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(d[::-1]))
        if 13 <= len(d) <= 19 and total % 10 == 0:
            found.append(("card", *m.span()))
    return found + [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(digits(m[0])) <= 15]


def digest(spans):
    return hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in spans).encode()).hexdigest()


def test_base_spans_on_random_texts():
    rng = random.Random(7)
    bits = ["@", ".", "a", "Z9", "%", "é", " ", "-", "+", "(", "1", "25", "255", "256", "001", "4111 1111 1111 1111", "٣", "mail.example.com", "4242424242424242"]
    for _ in range(8000):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(0, 22)))
        assert op.base_spans(text) == brute(text), text


def test_long_runs_take_linear_time():
    for unit in ("a", "1", "1.", "a@", "+1", "+1(", "1-", "@"):
        op.base_spans(unit * 300_000)


def test_sample(spark):
    docs = table(spark, SAMPLE, "documents")
    got = {r.doc_id: r for r in op.private_spans(docs).collect()}
    for r in docs.collect():
        spans = brute(r.text)
        assert got[r.doc_id].base_sha256 == digest(spans)
        text = ",".join(f"{k}:{s}:{e}" for k, s, e in spans)
        assert got[r.doc_id].spans.startswith(text)
        if not spans:
            assert got[r.doc_id].spans == ""


def cooccurring():
    """The clinic 'Zorbl' stands only with one address; 'common' stands everywhere."""
    mail = "anna.k@mail.example.org"
    data = [(100 + i, f"Common text {i} about Zorbl, write to {mail} in 1987.", "en", "s", 1) for i in range(4)]
    return data + [(200 + i, f"Common text about matter {i} of general interest", "en", "s", 1) for i in range(60)]


def test_terms_that_reveal(spark):
    docs = spark.createDataFrame(cooccurring(), SCHEMA)
    found = op.private_spans(with_clashes(docs))
    by_id = {r.doc_id: r for r in found.collect()}
    text = cooccurring()[0][1]
    terms = {text[s.at : s.to].lower() for s in by_id[100].found if s.kind == "term"}
    assert {"zorbl", "1987", "write"} <= terms and not terms & {"common", "text", "about", "anna", "mail"}
    assert all(by_id[200 + i].spans == "" for i in range(60))
    clean = {r.doc_id: r.text for r in op.sanitise(docs, found).collect()}
    assert "anna" not in clean[100] and "Zorbl" not in clean[100] and "<email>" in clean[100] and "<number>" in clean[100]
    assert clean[205] == cooccurring()[9][1]


def test_awkward_rows(spark):
    docs = spark.createDataFrame(awkward(), SCHEMA)
    got = op.private_spans(with_clashes(docs)).collect()
    plain = lambda t: [] if t and set(t) == {"x"} else brute(t)  # noqa: E731  the plain patterns take quadratic time on a long run
    assert Counter((r.doc_id, r.base_sha256) for r in got) == Counter((i, digest(plain(t))) for i, t, *_ in awkward())
    assert rows(op.private_spans(docs.limit(0))) == []


def blank(text):
    for _, s, e in brute(text):
        text = text[:s] + " " * (e - s) + text[e:]
    return text


def by_passage(text, hide=False):
    """The words of each passage; its number counts the ends before it."""
    ends = [m.start() for m in re.finditer(r"\n|[.!?](?=[ \t])", text)]
    out = {}
    for m in re.finditer(r"[0-9a-z\u0080-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), blank(text) if hide else text)):
        out.setdefault(sum(e <= m.start() for e in ends), []).append(m[0])
    near = {sum(e <= s for e in ends) for _, s, _ in brute(text)}
    return out, near


def by_hand(data):
    """The terms that disclose something in each document, from plain counts of passages."""
    own = {i: {(k, t[s:e].lower() if k in ("email", "ip") else digits(t[s:e])) for k, s, e in brute(t)} for i, t in data}
    entities = Counter(e for v in own.values() for e in v)
    holding = Counter(w for _, t in data for p in by_passage(t)[0].values() for w in set(p))
    shown = {}
    for i, t in data:
        parts, near = by_passage(t, True) if own[i] else ({}, set())
        for n, p in parts.items():
            for w in set(p):
                for e in own[i]:
                    shown.setdefault((e, w), []).append((tuple(p), n in near))
    reveals = set()
    for (e, w), found in shown.items():
        share, seen, z = len(found) / holding[w], len({p for p, _ in found}), 1.645
        n = seen / share
        low = (share + z * z / (2 * n) - z * math.sqrt(share * (1 - share) / n + z * z / (4 * n * n))) / (1 + z * z / n)
        if low >= 0.5 and any(near for _, near in found) and entities[e] / len(data) < 0.5:
            reveals.add((e, w))
    words = {i: {w for p in by_passage(t, True)[0].values() for w in p} for i, t in data}
    return {i: {w for w in words[i] if any((e, w) in reveals for e in own[i])} for i, _ in data}


def term_words(row, text):
    return {re.sub("[A-Z]", lambda m: m[0].lower(), text[s.at : s.to]) for s in row.found if s.kind == "term"}


def planted(spark):
    """The sample's documents; every 20th names a person beside an address in one sentence and again in two others."""
    data, names = [], {}
    for n, r in enumerate(sorted(table(spark, SAMPLE, "documents").collect(), key=lambda r: r.doc_id)):
        text = r.text or ""
        if n % 20 == 0:
            name = f"Zorb{n}a"
            names[r.doc_id] = name.lower()
            text += f" Write to {name} at box{n}@mail.example.org in oneoff{n}. {name} will answer. Others ask for {name} too."
        data.append((r.doc_id, text))
    return data, names


def test_terms_equal_counting_by_hand(spark):
    data = planted(spark)[0] + [(10**6 + r[0], r[1]) for r in cooccurring()]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    expected, texts = by_hand(data), dict(data)
    got = {r.doc_id: r for r in op.private_spans(docs).collect()}
    assert {i: term_words(r, texts[i]) for i, r in got.items()} == expected
    assert any(expected.values())


def test_precision_and_recall_on_planted_terms(spark):
    data, names = planted(spark)
    texts = dict(data)
    got = op.private_spans(spark.createDataFrame(data, "doc_id long, text string")).collect()
    found = {(r.doc_id, w) for r in got for w in term_words(r, texts[r.doc_id])}
    right = found & set(names.items())
    assert len(right) == len(names)
    assert len(right) >= 0.9 * len(found), sorted(found - right)
    assert not any(w.startswith("oneoff") for _, w in found)


def test_copies_prove_nothing(spark):
    """A word that stands once stays, however many copies its document has."""
    copies = [(i, "Ask anna@mail.example.org about the xylograph.", "en", "s", 1) for i in range(40)]
    docs = spark.createDataFrame(copies + [(100 + r[0], *r[1:]) for r in cooccurring()], SCHEMA)
    by_id = {r.doc_id: r for r in op.private_spans(docs).collect()}
    assert all(by_id[i].n_term == 0 for i in range(40)) and by_id[200].n_term > 0


def test_query_equals_counting_by_hand(spark):
    data = [(r.doc_id, r.text or "") for r in table(spark, SAMPLE, "documents").collect()]
    expected = by_hand(data)
    texts = dict(data)
    for r in queries.op7_private_spans(spark, SAMPLE).collect():
        spans = [s.split(":") for s in r.spans.split(",") if s.startswith("term:")]
        assert {re.sub("[A-Z]", lambda m: m[0].lower(), texts[r.doc_id][int(a) : int(b)]) for _, a, b in spans} == expected[r.doc_id]
        assert r.n_term == len(spans)


def test_term_counts_by_join_and_by_broadcast(spark, monkeypatch):
    docs = spark.createDataFrame(cooccurring(), SCHEMA)
    expected = rows(op.private_spans(docs).select("doc_id", "spans"))
    monkeypatch.setattr(op, "FREQUENT", 2.0)
    assert rows(op.private_spans(docs).select("doc_id", "spans")) == expected and any("term" in r[1] for r in expected)
