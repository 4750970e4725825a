"""Personal data: identifiers by pattern, and the terms that give them away by co-occurrence.

An identifier (address, number) is a protected entity ``e``. A term ``t`` discloses it if who knows the term is
left with at most ``residual`` bits about the entity: ``-log2 P(e|t)``, where ``P(e|t)`` is the share of the
passages with the term that lie in documents of the entity. Passages end at line breaks and at the end of
sentences. Few passages prove little: ``P(e|t)`` is the lower end of its Wilson interval, whose number of
observations is that of different passages, so that neither a word that stands once nor copies of one passage
disclose anything, however large the corpus. The term must also stand in a passage with an identifier. Such
terms are spans too, and are generalised or removed when a text is sanitised.

A term of many more passages than an entity has cannot disclose it, so each entity has a most that a term may
have, and only terms below it are paired. Entities of the same documents count as one.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prevascope.llm.common import ALNUM, Lookup, bounded_batches, lowered, mixed, row_of, slices, text_bytes, word_hashes
from prevascope.session import materialise

#: Fixed formats of the base matches. Runs are taken whole, which gives the leftmost matches in linear time.
KINDS = ("email", "ip", "card", "phone")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
#: Bits about an entity that may be left for a term to disclose it, and deviations of the lower bound.
RESIDUAL, DEVIATIONS = 1.0, 1.645
#: Passages for each document from which all tasks know a term's count.
FREQUENT = 1e-3
_STEP = np.uint64(0x9E3779B97F4A7C15)

Span = tuple[str, int, int]


def emails(text: str) -> list[Span]:
    """Matches of ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+``, found from the at sign."""
    found, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        match = _DOMAIN.match(text, at + 1) if start < at else None
        if match:
            found.append(("email", start, match.end()))
            done = match.end()
        at = text.find("@", max(done, at + 1))
    return found


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or "0") <= 255


def base_spans(text: str) -> list[Span]:
    """The base matches by kind as listed, then start."""
    found = emails(text)
    if _DIGIT.search(text):
        found += [("ip", *m.span()) for m in _IP.finditer(text) if all(map(_small, m[0].split(".")))]
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 13:
                digits = _digits(m[0])
                if 13 <= len(digits) <= 19 and luhn(digits):
                    found.append(("card", *m.span()))
        if "+" in text:
            found += [("phone", *m.span()) for m in _PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return found


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def _entity(kind: str, value: str) -> str:
    plain = value.lower() if kind in ("email", "ip") else _digits(value)
    return hashlib.sha256(f"{kind}:{plain}".encode()).hexdigest()[:32]


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("at", pa.int64()), ("to", pa.int64())]))


def _scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts, digests, spans, entities, passages, texts = [], [], [], [], [], []
        for text in batch.column("text"):
            text = text.as_py() or ""
            base = base_spans(text)
            counts.append([sum(s[0] == k for s in base) for k in KINDS])
            digests.append(hashlib.sha256(joined(base).encode()).hexdigest())
            spans.append([{"kind": k, "at": s, "to": e} for k, s, e in base])
            entities.append(sorted({_entity(k, text[s:e]) for k, s, e in base}))
            passages.append(int(passage_ends(np.frombuffer(text.encode(), np.uint8)).sum()) + 1 if base else 0)
            texts.append(text if base else None)
        columns = [pa.array(c, pa.int64()) for c in zip(*counts)] if counts else [pa.array([], pa.int64())] * 4
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *columns, pa.array(digests, pa.string()), pa.array(spans, _SPANS),
             pa.array(entities, pa.list_(pa.string())), pa.array(passages, pa.int64()), pa.array(texts, pa.string())],
            names=["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "base", "entities", "passages", "text"],
        )


def passage_ends(raw: np.ndarray) -> np.ndarray:
    """Whether a passage ends at each byte: at line feeds, and at ``.!?`` before a space or tab."""
    after = np.append(raw[1:], 0)
    return (raw == 10) | (((raw == 46) | (raw == 33) | (raw == 63)) & ((after == 32) | (after == 9)))


def outside(text: str, spans: list[dict]) -> bytes:
    """The text in UTF-8 with a space for each byte of the spans, so that positions stay."""
    parts, done = [], 0
    for s in sorted(spans, key=lambda s: s["at"]):
        if s["to"] > done:
            at = max(done, s["at"])
            parts += [text[done:at].encode(), b" " * len(text[at : s["to"]].encode())]
            done = s["to"]
    return b"".join([*parts, text[done:].encode()])


def terms(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and byte positions of the words of one text."""
    return word_hashes(lowered(np.frombuffer(raw, np.uint8)), np.array([0, len(raw)]), ALNUM)


def passage_terms(text: str, base: list[dict]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(term, content, near) for each distinct term of each passage, identifiers left out.

    ``content`` is a hash of the words of the passage, ``near`` whether an identifier begins in it.
    """
    raw = np.frombuffer(text.encode(), np.uint8)
    before = np.cumsum(passage_ends(raw))
    hashes, places = terms(outside(text, base))
    if not len(hashes):
        return hashes, hashes, np.zeros(0, bool)
    passage = before[places]
    _, first, number = np.unique(passage, return_index=True, return_inverse=True)
    nth = (np.arange(len(hashes)) - first[number]).astype(np.uint64)
    content = np.add.reduceat(mixed(hashes + (nth + np.uint64(1)) * _STEP), first)
    points = np.flatnonzero((raw & 0xC0) != 0x80)
    near = np.isin(passage, before[points[[s["at"] for s in base]]])
    _, kept = np.unique(hashes + passage.astype(np.uint64) * _STEP, return_index=True)
    return hashes[kept], content[number[kept]], near[kept]


def _row_terms(frequent):
    """(row, term, content, near, holding) of the terms of each passage that at most ``most`` passages hold; 0 if not known."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup, counts = frequent.value
        for batch in batches:
            for row, text, base, most in zip(*(batch.column(c).to_pylist() for c in ("row", "text", "base", "most"))):
                found, content, near = passage_terms(text, base)
                n = counts[lookup.find(found)]  # -1, an unknown term, is the zero at the end
                kept = n <= most
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(int(kept.sum()), row, np.int64)), pa.array(found[kept].view(np.int64)),
                     pa.array(content[kept].view(np.int64)), pa.array(near[kept]), pa.array(n[kept])],
                    names=["row", "term", "content", "near", "holding"],
                )

    return run


def _passage_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many passages of a batch hold each term."""
    for batch in batches:
        for part in slices(batch, "text"):
            raw, starts = text_bytes(part.column("text"))
            hashes, places = word_hashes(lowered(raw), starts, ALNUM)
            # both grow from place to place, so their sum tells passages apart
            passage = (np.cumsum(passage_ends(raw))[places] + row_of(places, starts)).astype(np.uint64)
            _, first = np.unique(hashes + passage * _STEP, return_index=True)
            distinct, n = np.unique(hashes[first], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(distinct.view(np.int64)), pa.array(n)], names=["term", "n"])


def term_spans(text: str, base: list[dict], wanted: list[int]) -> list[dict]:
    """Where the words with the wanted hashes are, in code points."""
    raw = outside(text, base)
    hashes, places = terms(raw)
    data = np.frombuffer(raw, np.uint8)
    point = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    word = ALNUM[np.frombuffer(raw.translate(bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))), np.uint8)]
    gaps = np.append(np.flatnonzero(~word), len(raw))
    hit = places[np.isin(hashes.view(np.int64), np.array(wanted, np.int64))]
    ends = gaps[np.searchsorted(gaps, hit)] if len(hit) else hit
    return [{"kind": "term", "at": int(point[s]), "to": int(point[e])} for s, e in zip(hit, ends)]


def _all_spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = [term_spans(*x) for x in zip(*(batch.column(c).to_pylist() for c in ("text", "base", "wanted")))]
        yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(out, _SPANS)], names=["row", "extra"])


_SPAN_TYPE = "array<struct<kind:string,at:bigint,to:bigint>>"


def holding_counts(docs: DataFrame) -> DataFrame:
    """(term, holding): how many passages of ``docs`` hold each term."""
    source = docs.select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    counts = source.mapInArrow(_passage_counts, "term long, n long").groupBy("term").agg(F.sum("n").alias("holding"))
    return materialise(counts, "holding")


def protected_entities(each: DataFrame, n_docs: int, residual: float) -> DataFrame:
    """(entity, most) of the entities of ``each`` (row, entity, passages), one of those with the same rows.

    ``most`` is the number of passages beyond which a term cannot disclose the entity. An entity whose documents
    are so many that it bears no more than ``residual`` bits is not protected.
    """
    marks = [F.bit_xor(F.xxhash64("row", F.lit(k))).alias(f"mark_{k}") for k in range(2)]
    counted = each.groupBy("entity").agg(F.count(F.lit(1)).alias("entity_docs"), F.sum("passages").alias("passages"), *marks)
    counted = counted.where(-F.log2(F.col("entity_docs") / n_docs) > residual)
    single = counted.groupBy("entity_docs", "passages", "mark_0", "mark_1").agg(F.min("entity").alias("entity"))
    return single.select("entity", (F.col("passages") * 2.0**residual).alias("most"))


def lower_share(together, holding, seen, z: float):
    """Lower end of the Wilson interval of ``together / holding`` from ``seen`` observations."""
    share = together / holding
    spread = z * F.sqrt(share * (1 - share) / seen + z * z / (4 * seen * seen))
    return (share + z * z / (2 * seen) - spread) / (1 + z * z / seen)


def revealing_terms(pairs: DataFrame, residual: float, deviations: float) -> DataFrame:
    """(entity, term) where the term leaves at most ``residual`` bits about the entity."""
    each = pairs.groupBy("entity", "term", "content").agg(
        F.count(F.lit(1)).alias("n"), F.first("holding").alias("holding"), F.max("near").alias("near")
    )
    both = each.groupBy("entity", "term").agg(
        F.sum("n").alias("together"), F.count(F.lit(1)).alias("seen"), F.first("holding").alias("holding"), F.max("near").alias("near")
    )
    # as many observations as different passages with both stand for among all that hold the term
    share = lower_share(F.col("together"), F.col("holding"), F.col("seen") * F.col("holding") / F.col("together"), deviations)
    return both.where(F.col("near") & (share >= 2.0**-residual)).select("entity", "term")


def private_spans(docs: DataFrame, residual: float = RESIDUAL, deviations: float = DEVIATIONS) -> DataFrame:
    """Personal data in every row of ``docs`` (doc_id, text).

    Returns doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_term and found (the spans as an array
    of kind, at, to in code points: base matches by kind and start, then terms). Every identifier is judged,
    also one of a single document. A term is a span wherever it stands in a document of an entity of which it
    leaves at most ``residual`` bits, by the lower bound of ``deviations`` standard deviations: with the defaults,
    a term found nowhere else takes three different passages. Null text is empty and has no spans; repeated
    rows count as documents of their own, but a repeated passage as one observation; an empty table gives no
    rows. Terms within identifiers never count.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    numbers = ", ".join(f"n_{k} long" for k in KINDS)
    scanned = docs.mapInArrow(
        _scanned, f"doc_id {kind}, {numbers}, base_sha256 string, base {_SPAN_TYPE}, entities array<string>, passages long, text string"
    )
    scanned = materialise(scanned.withColumn("row", F.monotonically_increasing_id()), "identifiers")
    n_docs = max(1, scanned.count())
    holders = scanned.where(F.size("entities") > 0)
    each = holders.select("row", "passages", F.explode("entities").alias("entity"))
    protected = materialise(protected_entities(each, n_docs, residual), "protected")
    own = materialise(each.drop("passages").join(protected, "entity"), "own")
    most = own.groupBy("row").agg(F.max("most").alias("most"))
    shown = holders.select("row", "text", "base").join(most, "row")
    counts = holding_counts(docs)
    # at most 1 / FREQUENT times the terms of a mean document
    known = counts.where(F.col("holding") >= FREQUENT * n_docs).toArrow()
    frequent = Lookup(known.column("term").to_numpy().view(np.uint64)), np.append(known.column("holding").to_numpy(), 0)
    found = shown.mapInArrow(
        _row_terms(spark.sparkContext.broadcast(frequent)), "row long, term long, content long, near boolean, holding long"
    )
    found = materialise(found, "terms")
    rare = counts.where(F.col("holding") < FREQUENT * n_docs)
    looked_up = found.where("holding = 0").drop("holding").join(rare, "term").select(found.columns)
    # the bound of a term that stands only with the entity, its best case
    least = deviations**2 / (2.0**residual - 1)
    judged = found.where("holding > 0").unionByName(looked_up).where(F.col("holding") >= least - 1e-9)
    pairs = judged.join(own, "row").where(F.col("holding") <= F.col("most"))
    pairs = materialise(pairs.select("row", "entity", "term", "content", "near", "holding"), "pairs")
    revealing = materialise(revealing_terms(pairs, residual, deviations), "revealing")
    wanted = pairs.join(revealing, ["entity", "term"], "left_semi").groupBy("row").agg(F.collect_set("term").alias("wanted"))
    extra = holders.select("row", "text", "base").join(wanted, "row")
    extra = extra.mapInArrow(_all_spans, f"row long, extra {_SPAN_TYPE}").withColumnRenamed("row", "r")
    full = scanned.drop("text").join(extra, scanned["row"] == extra["r"], "left")
    found = F.concat("base", F.coalesce("extra", F.array().cast(_SPAN_TYPE)))
    text = F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["at"], s["to"])), ",")
    return full.select(
        "doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", text.alias("spans"),
        F.coalesce(F.size("extra").cast("long"), F.lit(0)).alias("n_term"), found.alias("found"),
    )


def sanitised(text: str, spans: list[dict]) -> str:
    """The text with identifiers and numbers replaced by their kind and other terms removed."""
    parts, done = [], 0
    for s in sorted(spans, key=lambda s: (s["at"], -s["to"])):
        if s["at"] < done:
            continue
        parts.append(text[done : s["at"]])
        if s["kind"] != "term":
            parts.append(f"<{s['kind']}>")
        elif text[s["at"] : s["to"]].isdigit():
            parts.append("<number>")
        done = s["to"]
    return "".join([*parts, text[done:]])


def sanitise(docs: DataFrame, found: DataFrame) -> DataFrame:
    """doc_id and text of ``docs`` with the spans of ``found`` (doc_id, found) generalised or removed.

    doc_id must tell rows apart; rows without spans, and null texts, stay as they are.
    """
    spans = found.where(F.size("found") > 0).select(F.col("doc_id").alias("s_id"), "found")
    both = docs.select("doc_id", "text").join(spans, docs["doc_id"].eqNullSafe(F.col("s_id")), "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, lists = batch.column("text").to_pylist(), batch.column("found").to_pylist()
            out = [sanitised(t, s) if t and s else t for t, s in zip(texts, lists)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, pa.string())], names=["doc_id", "text"])

    bounded_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return both.select("doc_id", "text", "found").mapInArrow(run, f"doc_id {kind}, text string")
