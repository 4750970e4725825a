"""Secrets, told apart by how many repositories and owners share a value.

Each text gives its base matches and further candidates: runs of 20 or more key characters with
letters and digits and at least 3.5 bits of entropy a character (``owned``), and shorter runs of letters
and digits (``reused``). Values are hashed; the hashes are counted by distinct repositories and owners over the
whole corpus. A repository is a class of equal texts unless a column says otherwise, so that mere copies of a
text count once, for the owner of its first row.

A value that stands in ``d`` repositories, ``n`` of them of its main owner, who holds the share ``p`` of all rows, is
either that owner's, most of whose uses are at home, or copied by anyone, in proportion to what they hold. The verdict is the
likelier of the two: ``live`` if ``n ln(HOME / p) + (d - n) ln((1 - HOME) / (1 - p)) > 0``, the main owner being the
one for whom this is largest, or if there is one owner only; else ``example``.

An ``owned`` candidate is a span if its value is live. A ``reused`` one needs proof that it is a secret as well: its value
is one of a base match elsewhere, or one owner uses it in several repositories.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prevascope.llm.common import bounded_batches
from prevascope.session import materialise

#: Fixed formats of the base matches: kind, pattern, group that holds the value, least length.
ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
GENERIC = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
SHORT = re.compile(r"(?<![A-Za-z0-9])[A-Za-z0-9]{12,}(?![A-Za-z0-9])")
KINDS = ("assign", "access", "hex")
FURTHER = ("owned", "reused")
LEAST_ENTROPY = 3.5
#: Share of the uses of an owner's secret that are in repositories of that owner.
HOME = 0.9
_SPACES = re.compile(r"\x20{64,}")

Match = tuple[str, int, int, str]


def entropy(value: str) -> float:
    """Bits a character."""
    n = len(value)
    return -sum(c / n * math.log2(c / n) for c in Counter(value).values())


def base_matches(text: str) -> list[Match]:
    """(kind, start, end, value) of the base matches in the order of start, then kind."""
    found = [("assign", *m.span(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [("access", *m.span(), m[0]) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    found += [("hex", *m.span(), m[0]) for m in HEX.finditer(text)]
    return sorted(found, key=lambda m: (m[1], KINDS.index(m[0])))


def _apart(found: Iterator[re.Match], taken: list[Match]) -> Iterator[re.Match]:
    """The matches with letters and digits that overlap none of ``taken``, which is ordered by start."""
    far = list(accumulate((m[2] for m in taken), max))
    starts = [m[1] for m in taken]
    for m in found:
        before = bisect_left(starts, m.end())  # these start before its end
        if before and far[before - 1] > m.start():
            continue
        if re.search("[0-9]", m[0]) and re.search("[A-Za-z]", m[0]):
            yield m


def further_candidates(text: str, base: list[Match]) -> list[Match]:
    """High-entropy values that no base match overlaps, and shorter ones that overlap neither."""
    owned = [("owned", *m.span(), m[0]) for m in _apart(GENERIC.finditer(text), base) if entropy(m[0]) >= LEAST_ENTROPY]
    taken = sorted(base + owned, key=lambda m: m[1])
    return owned + [("reused", *m.span(), m[0]) for m in _apart(SHORT.finditer(text), taken)]


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


_CANDIDATE = pa.list_(pa.struct([("kind", pa.string()), ("at", pa.int64()), ("to", pa.int64()), ("hash", pa.string())]))


def _scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts, digests, lists, homes = [], [], [], []
        for text, home in zip(batch.column("text"), batch.column("repository")):
            text = text.as_py() or ""
            base = base_matches(text)
            tally = Counter(m[0] for m in base)
            counts.append([tally[k] for k in KINDS])
            digests.append(hashlib.sha256(joined([m[:3] for m in base]).encode()).hexdigest())
            lists.append([
                {"kind": k, "at": s, "to": e, "hash": hashlib.sha256(v.encode()).hexdigest()}
                for k, s, e, v in base + further_candidates(text, base)
            ])
            homes.append(home.as_py() if home.is_valid or not lists[-1] else hashlib.sha256(text.encode()).hexdigest())
        columns = [pa.array(c, pa.int64()) for c in zip(*counts)] if counts else [pa.array([], pa.int64())] * 3
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(homes, pa.string()), batch.column("owner"), *columns, pa.array(digests), pa.array(lists, _CANDIDATE)],
            names=["doc_id", "repository", "owner", "n_assign", "n_access", "n_hex", "base_sha256", "found"],
        )


def owner_shares(docs: DataFrame) -> DataFrame:
    """(owner, share) of the rows of ``docs`` (owner)."""
    return docs.groupBy("owner").agg((F.count(F.lit(1)) / max(docs.count(), 1)).alias("share"))


def ownership(each: DataFrame, shares: DataFrame) -> DataFrame:
    """(hash, repositories, owners, uses, proven, verdict) of the candidates ``each`` (doc_id, repository, owner, kind, hash).

    ``proven`` is whether a base match has the value.
    """
    # hot values shrink to one row for each task, repository and owner before they move
    first = F.min(F.struct("doc_id", "owner")).alias("first")
    proven = F.max(F.col("kind").isin(*KINDS)).alias("proven")
    in_repository = each.groupBy("hash", "repository").agg(first, F.count(F.lit(1)).alias("uses"), proven)
    in_repository = in_repository.select("hash", F.col("first.owner").alias("owner"), "uses", "proven")
    in_owner = in_repository.groupBy("hash", "owner").agg(
        F.count(F.lit(1)).alias("n"), F.sum("uses").alias("uses"), F.max("proven").alias("proven")
    )
    in_owner = materialise(in_owner.join(shares, "owner"), "uses-by-owner")
    total = in_owner.groupBy("hash").agg(
        F.sum("n").alias("repositories"), F.count(F.lit(1)).alias("owners"), F.sum("uses").alias("uses"), F.max("proven").alias("proven")
    )
    elsewhere = F.log(F.lit(1 - HOME) / F.greatest(1 - F.col("share"), F.lit(1e-12)))
    own = F.col("n") * F.log(F.lit(HOME) / F.col("share")) + (F.col("repositories") - F.col("n")) * elsewhere
    several = total.where("owners > 1")
    best = in_owner.join(several, "hash").groupBy("hash").agg(F.max(own).alias("own"))
    verdict = F.when((F.col("owners") == 1) | (F.col("own") > 0), "live").otherwise("example")
    return total.join(best, "hash", "left").withColumn("verdict", verdict).drop("own")


def secret_scan(docs: DataFrame, repository: str | None = None, owner: str = "source") -> DataFrame:
    """Secrets of every row of ``docs`` (doc_id, text, the owner and the repository if one is named).

    Returns doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_live and n_example (all spans by what
    their ownership says) and findings (start, kind, end, value hash, repositories, owners, uses, proven, verdict) of
    all candidates. ``spans`` holds the base matches and the further candidates that are found to be secrets. Null text is
    empty and has no spans; a null repository (if one is named) or owner counts as one of its own. An empty table gives no rows.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    home = name(repository) if repository else F.lit(None).cast("string")
    source = docs.select("doc_id", home.alias("repository"), name(owner).alias("owner"), F.col("text").cast("string").alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    scanned = source.mapInArrow(
        _scanned,
        f"doc_id {kind}, repository string, owner string, n_assign long, n_access long, n_hex long, base_sha256 string, "
        "found array<struct<kind:string,at:bigint,to:bigint,hash:string>>",
    )
    scanned = materialise(scanned.withColumn("row", F.monotonically_increasing_id()), "scanned")
    each = scanned.select("row", "doc_id", "repository", "owner", F.explode("found").alias("f"))
    each = each.select("row", "doc_id", "repository", "owner", "f.*")
    shared = materialise(ownership(each, owner_shares(scanned)), "ownership")
    secret = F.when(F.col("kind").isin(*KINDS), F.lit(True)).otherwise(
        (F.col("verdict") == "live")
        & ((F.col("kind") == FURTHER[0]) | F.col("proven") | ((F.col("owners") == 1) & (F.col("repositories") > 1)))
    )
    judged = each.join(shared, "hash").withColumn("shown", secret)
    finding = F.struct("at", "kind", "to", "hash", "repositories", "owners", "uses", "proven", "verdict", "shown")
    by_row = judged.groupBy("row").agg(F.collect_list(finding).alias("all"))  # at most what one text holds
    order = F.create_map(*[x for i, k in enumerate((*KINDS, *FURTHER)) for x in (F.lit(k), F.lit(i))])
    by_row = by_row.select(
        F.col("row").alias("r"),
        F.array_sort("all", lambda a, b: F.when(
            (a["at"] < b["at"]) | ((a["at"] == b["at"]) & (order[a["kind"]] < order[b["kind"]])), F.lit(-1)
        ).when((a["at"] == b["at"]) & (a["kind"] == b["kind"]), F.lit(0)).otherwise(F.lit(1))).alias("all"),
    )
    counted = scanned.join(by_row, scanned["row"] == by_row["r"], "left")
    findings = F.coalesce("all", F.array().cast(by_row.schema["all"].dataType))
    shown = F.filter(findings, lambda f: f["shown"])
    text = F.array_join(F.transform(shown, lambda f: F.concat_ws(":", f["kind"], f["at"], f["to"])), ",")
    tally = lambda what: F.size(F.filter(shown, lambda f: f["verdict"] == what)).cast("long")
    return counted.select(
        "doc_id", "n_assign", "n_access", "n_hex", "base_sha256", text.alias("spans"),
        tally("live").alias("n_live"), tally("example").alias("n_example"), findings.alias("findings"),
    )
