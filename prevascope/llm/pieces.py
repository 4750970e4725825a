"""SentencePiece encoding and decoding, with sampled segmentations by Gumbel top-k without replacement.

The segmentations of a text are the paths of a lattice of vocabulary pieces, weighted by Zipf's law on the
pieces' ranks. Perturbed A-star search draws the paths with the largest Gumbel-perturbed log probabilities: the
largest of all is a plain sample; what is left of its region falls into parts by the first chunk that
differs, each with a Gumbel bound that is truncated at the value taken; the part with the largest bound gives the
next sample. The bound of the best part after k samples turns each sample's probability into the chance
of its inclusion. No piece spans a space, nor a character that only bytes can spell, so a text is a row
of chunks with lattices of their own, and equal chunks share one.

Random numbers are hashes of seed, row key, sample, chunk and step: they do not depend on how rows are dealt.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from operator import itemgetter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prevascope.llm.common import Lookup, _power_tables, bounded_batches, mixed, slices

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SAMPLES, SEED = 2, 20240601
#: Pieces with a lower score are not for use; their place in the rank law; the widest part of the texts looked at together.
UNUSED, SHIFT = -1e8, 2.7
_WINDOW = 1 << 21
STEM = 3
_SPACE, _OWN_MARK = 0x2581, 0x110001
_C = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


@dataclass(frozen=True)
class Vocabulary:
    """Pieces by id as bytes, and those for the lattice: by hash, with log weight and length."""

    spelling: list
    lookup: Lookup
    ids: np.ndarray
    weights: np.ndarray
    longest: int
    single: np.ndarray  # by code point, whether a piece spells it
    byte_ids: np.ndarray
    byte_weight: float
    stems: Lookup  # the first ``STEM`` characters of longer pieces
    reach: np.ndarray  # and the longest piece with each


@cache
def _symbol_codes() -> np.ndarray:
    return mixed(np.arange(_OWN_MARK + 1, dtype=np.uint64) * _C[0] + np.uint64(1))


def _sums(points: np.ndarray) -> np.ndarray:
    power, _ = _power_tables(len(points))
    out = np.zeros(len(points) + 1, np.uint64)
    np.cumsum(_symbol_codes().take(points) * power[: len(points)], out=out[1:])
    return out


def load(path: str = MODEL, temperature: float = 1.0) -> Vocabulary:
    """Read the model file where the driver runs; scores of a BPE model are ranks, others log probabilities."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    spelling, texts, ids, scores, byte_ids = [], [], [], [], np.zeros(256, np.int32)
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            value = int(piece[3:5], 16)
            byte_ids[value] = i
            spelling.append(bytes([value]))
        elif model.is_control(i) or model.is_unknown(i):
            spelling.append(b"")
        else:
            spelling.append(piece.replace("▁", " ").encode())
            if model.get_score(i) > UNUSED or len(piece) == 1:
                texts.append(piece)
                ids.append(i)
                scores.append(model.get_score(i))
    scores = np.array(scores)
    scores[scores <= UNUSED] = scores[scores > UNUSED].min()  # single characters all stay usable
    ranked = len(scores) > 1 and np.all(scores == np.round(scores))
    weights = (-np.log(-scores + SHIFT) if ranked else scores) / temperature
    points = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
    ends = np.cumsum([len(t) for t in texts])
    sums, inverse = _sums(points), _power_tables(len(points))[1]
    starts = ends - np.array([len(t) for t in texts])
    hashes = (sums[ends] - sums[starts]) * inverse[starts]
    lengths = ends - starts
    long = np.flatnonzero(lengths > STEM)
    stems, which = np.unique((sums[starts[long] + STEM] - sums[starts[long]]) * inverse[starts[long]], return_inverse=True)
    reach = np.zeros(len(stems) + 1, np.int64)
    np.maximum.at(reach, which.ravel(), lengths[long])
    single = np.zeros(_OWN_MARK + 1, bool)
    single[points[starts[lengths == 1]]] = True
    spaces = [t for t in texts if "▁" in t[1:]]
    if spaces or not single[points].all():
        raise ValueError("pieces that span spaces, or characters without a piece of their own, are not supported")
    return Vocabulary(spelling, Lookup(hashes), np.array(ids, np.int32), weights, int((ends - starts).max()), single, byte_ids,
                      float(weights.min()), Lookup(stems), reach)


class Lattices:
    """Lattices of chunks laid end to end.

    Nodes are places, in the order of their distance to the end of the chunk; the last node is every end.
    The edges of node i are ``first[i]`` to ``first[i + 1]``, each with piece id, log probability and next node.
    ``paths`` counts the ways from a node to the end; ``upto`` sums up probabilities over all edges in order.
    """

    def __init__(self, vocabulary: Vocabulary, points: np.ndarray, starts: np.ndarray):
        n = len(points)
        room = np.repeat(starts[1:], np.diff(starts)) - np.arange(n)
        order = np.argsort(room.astype(np.uint16) if n and room.max() < 1 << 16 else room, kind="stable")
        node = np.empty(n + 1, np.int32)
        node[order] = np.arange(n, dtype=np.int32)
        node[n] = n
        self.start = node[starts[:-1]]
        sums, inverse = _sums(points), _power_tables(n)[1]
        at, left, found = np.arange(n, dtype=np.int32), room, []
        for size in range(1, min(vocabulary.longest, int(room.max()) if n else 1) + 1):
            fits = left >= size
            if size == STEM + 1:  # longer pieces begin with few stems
                at, left = at[fits], left[fits]
                reach = vocabulary.reach[vocabulary.stems.find((sums[at + STEM] - sums[at]) * inverse[at])]
                left = np.minimum(left, reach)
                fits = left >= size
            at, left = at[fits], left[fits]
            piece = vocabulary.lookup.find((sums[at + size] - sums[at]) * inverse[at])
            hit = piece >= 0
            found.append((at[hit], piece[hit], size))
            if size == 1:  # what is spelled by bytes is a chunk
                alone = at[~hit]
        degree = np.zeros(n + 1, np.int32)
        degree[node[alone]] = 1
        for places, _, _ in found:
            degree[node[places]] += 1
        self.first = np.zeros(n + 1, np.int64)
        np.cumsum(degree[:n], out=self.first[1:])
        slot, edges = self.first[:n].copy(), int(self.first[-1])
        self.ids, self.next, log = np.empty(edges, np.int32), np.empty(edges, np.int32), np.empty(edges)
        code = points[alone].astype(np.int64)
        code = np.where(code == _OWN_MARK, _SPACE, code)
        odd = slot[node[alone]]
        self.ids[odd], self.next[odd] = -2 - code, n
        log[odd] = vocabulary.byte_weight * (1 + (code >= 0x80) + (code >= 0x800) + (code >= 0x10000))
        for places, piece, size in found:
            own = node[places]
            here = slot[own]
            slot[own] += 1
            self.ids[here], log[here] = vocabulary.ids[piece], vocabulary.weights[piece]
            self.next[here] = np.where(room[places] == size, n, node[places + size])
        total, self.paths, share = np.zeros(n + 1), np.ones(n + 1), np.empty(edges)
        levels = np.searchsorted(room[order], np.arange(1, (int(room.max()) if n else 0) + 2))
        for low, high in zip(levels[:-1], levels[1:]):
            a, b = self.first[low], self.first[high]
            heads, after = self.first[low:high] - a, self.next[a:b]
            value = log[a:b] + total[after]
            owner = np.repeat(np.arange(high - low), degree[low:high])
            top = np.maximum.reduceat(value, heads)
            weight = np.exp(value - top[owner])
            whole = np.add.reduceat(weight, heads)
            total[low:high] = top + np.log(whole)
            share[a:b] = weight / whole[owner]
            log[a:b] = value - total[low:high][owner]
            self.paths[low:high] = np.add.reduceat(self.paths[after], heads)
        self.log, self.upto = log, np.cumsum(share)

    def walk(self, chunk: np.ndarray, uniform) -> tuple[np.ndarray, list]:
        """A path through each chunk's lattice: its log probability, and per step (which, ids); ``uniform(which, step)`` draws."""
        log, steps, step = np.zeros(len(chunk)), [], 0
        which, node, end = np.arange(len(chunk)), self.start[chunk], len(self.first) - 1
        while len(which):
            edge, last = self.first[node], self.first[node + 1] - 1
            goal = np.where(edge > 0, self.upto[edge - 1], 0.0)
            goal += uniform(which, step) * (self.upto[last] - goal)
            open_ = np.flatnonzero((self.upto[edge] <= goal) & (edge < last))
            while len(open_):
                edge[open_] += 1
                at = edge[open_]
                open_ = open_[(self.upto[at] <= goal[open_]) & (at < last[open_])]
            log[which] += self.log[edge]
            steps.append((which, self.ids[edge]))
            node = self.next[edge]
            more = node != end
            which, node, step = which[more], node[more], step + 1
        return log, steps

    def other_path(self, chunk: int, taken: list, draws) -> tuple[float, list]:
        """A path of a chunk that is none of those taken (lists of ids), drawn by its conditional probability."""
        node, end = int(self.start[chunk]), len(self.first) - 1
        rest, log, ids = [tuple(t) for t in taken], 0.0, []
        while node != end:
            edges = list(range(self.first[node], self.first[node + 1]))
            share = []
            for e in edges:
                same = {t[1:] for t in rest if t and t[0] == self.ids[e]}
                full = len(same) >= self.paths[self.next[e]]
                left = 1.0 - sum(np.exp(self._log_from(int(self.next[e]), t)) for t in same)
                share.append(0.0 if same and full else float(np.exp(self.log[e])) * max(left, 1e-12))
            pick, chosen = next(draws) * sum(share), None
            for e, s in zip(edges, share):
                pick -= s
                if s and pick < 0:
                    chosen = e
                    break
            chosen = max(zip(share, edges))[1] if chosen is None else chosen
            log += float(self.log[chosen])
            ids.append(int(self.ids[chosen]))
            rest = [t[1:] for t in rest if t and t[0] == self.ids[chosen]]
            node = int(self.next[chosen])
        return log, ids

    def path_log(self, chunk: int, ids: list) -> float:
        """Log probability of a path of a chunk."""
        return self._log_from(int(self.start[chunk]), ids)

    def _log_from(self, node: int, ids) -> float:
        log = 0.0
        for i in ids:
            a, b = self.first[node], self.first[node + 1]
            e = a + int(np.flatnonzero(self.ids[a:b] == i)[0])
            log += float(self.log[e])
            node = int(self.next[e])
        return log


def chunked(vocabulary: Vocabulary, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of the texts as the model sees them, where chunks start, and the first chunk of each text."""
    points = np.frombuffer("".join([" " + t if t else "" for t in texts]).encode("utf-32-le"), np.uint32).copy()
    points[points == _SPACE] = _OWN_MARK
    points[points == 0x20] = _SPACE
    heads = np.concatenate([[0], np.cumsum([len(t) + 1 if t else 0 for t in texts])])
    spelled = vocabulary.single[points]
    start = (points == _SPACE) | ~spelled
    start[1:] |= ~spelled[:-1]
    start[heads[:-1][heads[:-1] < len(points)]] = True
    starts = np.append(np.flatnonzero(start), len(points))
    return points, starts, np.searchsorted(starts, heads)


def _uniform(keys: np.ndarray, sample: int, chunk: np.ndarray, step: int) -> np.ndarray:
    """In (0, 1), by hash."""
    h = mixed(keys + chunk.astype(np.uint64) * _C[1] + np.array((step + 1) * 1000003 + sample, np.uint64) * _C[2:3])
    return ((h >> np.uint64(11)).astype(np.float64) + 0.5) / float(1 << 53)


class _Paths:
    """The paths of one draw: log probability and ids by chunk."""

    def __init__(self, n: int):
        self.log, self.count = np.zeros(n), np.zeros(n, np.int64)
        self.parts: list = []

    def add(self, low: int, log: np.ndarray, steps: list) -> None:
        n = len(log)
        self.log[low : low + n] = log
        count = np.zeros(n, np.int64)
        for which, _ in steps:
            count[which] += 1
        self.count[low : low + n] = count
        offset = np.cumsum(count) - count
        out = np.zeros(int(count.sum()), np.int32)
        for step, (which, ids) in enumerate(steps):
            out[offset[which] + step] = ids
        self.parts.append(out)

    def close(self) -> None:
        self.ids = np.concatenate(self.parts) if self.parts else np.zeros(0, np.int32)
        self.offset = np.concatenate([[0], np.cumsum(self.count)])

    def piece(self, low: int, high: int) -> np.ndarray:
        return self.ids[self.offset[low] : self.offset[high]]


def _truncated(mass: np.ndarray, bound, uniform: np.ndarray) -> np.ndarray:
    """Gumbel values of location ``mass`` below ``bound``."""
    with np.errstate(divide="ignore", over="ignore", invalid="ignore"):
        gumbel = mass - np.log(-np.log(uniform))
        out = -np.logaddexp(-bound, -gumbel)
    return np.where(np.isfinite(mass), out, -np.inf)


def _left(log: np.ndarray) -> np.ndarray:
    """Log of what a path of this log probability leaves."""
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.log(-np.expm1(np.minimum(log, -1e-12)))


def sampled(vocabulary: Vocabulary, texts: list[str], keys: np.ndarray, k: int) -> list[list[tuple]]:
    """For each text at most ``k`` distinct (ids, log probability, perturbed value, log of inclusion), best first."""
    points, starts, first = chunked(vocabulary, texts)
    n = len(starts) - 1
    text_of = np.repeat(np.arange(len(texts)), np.diff(first))
    own, number = keys[text_of], np.arange(n) - first[text_of]
    draws = [_Paths(n) for _ in range(k)]
    many = np.zeros(n)  # paths of each chunk
    sums, inverse = None, None
    low = 0
    while low < n:
        high = max(low + 1, int(np.searchsorted(starts, starts[low] + _WINDOW, "right")) - 1)
        part, cuts = points[starts[low] : starts[high]], starts[low : high + 1] - starts[low]
        sums, inverse = _sums(part), _power_tables(len(part))[1]
        codes = mixed((sums[cuts[1:]] - sums[cuts[:-1]]) * inverse[cuts[:-1]] + np.diff(cuts).astype(np.uint64))
        same, kinds = pd.factorize(codes)
        one = np.empty(len(kinds), np.int64)
        one[same[::-1]] = np.arange(len(same) - 1, -1, -1)  # where each kind stands first
        lengths = np.diff(cuts)[one]
        offsets = np.concatenate([[0], np.cumsum(lengths)])
        source = np.repeat(cuts[one] - offsets[:-1], lengths) + np.arange(offsets[-1])
        lattice = Lattices(vocabulary, part[source], offsets)
        many[low:high] = lattice.paths[lattice.start][same]
        for s, paths in enumerate(draws):
            key, chunk = own[low:high], number[low:high]
            log, steps = lattice.walk(same, lambda which, step: _uniform(key[which], s, chunk[which], step))  # noqa: B023
            paths.add(low, log, steps)
        low = high
    for paths in draws:
        paths.close()

    out: list[list[tuple]] = []
    states = []
    roots = -np.log(-np.log(_uniform(keys, 1 << 18, np.zeros(len(keys)), 0)))
    one = draws[0].log
    running = np.cumsum(one) - one
    running -= np.repeat(running[np.minimum(first[:-1], max(n - 1, 0))] if n else first[:-1], np.diff(first))
    all_bounds = _truncated(running + np.where(many > 1, _left(one), -np.inf), roots[text_of], _uniform(own, 1 << 19, number, 0))
    for t in range(len(texts)):
        a, b = int(first[t]), int(first[t + 1])
        log = one[a:b]
        # a sample: its ids by source (draw, from chunk) and changed chunks, with its log by chunk
        sample = {"log": log, "draw": [(a, b, 0)], "changed": {}, "value": float(roots[t])}
        states.append({"samples": [sample], "parts": [(sample, 0, all_bounds[a:b], {})]})
    for s in range(1, k):
        todo = []
        for t, state in enumerate(states):
            best = max(state["parts"], key=lambda p: p[2].max(initial=-np.inf), default=None)
            if best is None or not np.isfinite(best[2].max(initial=-np.inf)):
                continue
            at = int(np.argmax(best[2]))
            todo.append((t, best, at))
        if not todo:
            break
        # the lattices of the chunks where they differ, all at once
        chunks = [points[starts[first[t] + p[1] + at] : starts[first[t] + p[1] + at + 1]] for t, p, at in todo]
        lattice = Lattices(vocabulary, np.concatenate(chunks), np.concatenate([[0], np.cumsum([len(c) for c in chunks])]))
        fresh = []
        for i, (t, (base, shift, bounds, taken), at) in enumerate(todo):
            a, b = int(first[t]), int(first[t + 1])
            chunk = shift + at
            value = float(bounds[at])
            before = taken.get(at, [_ids_of(base, draws, a + chunk)])
            drawn = iter(_uniform(keys[t : t + 1], (1 << 20) + s, np.arange(64 + len(chunks[i])), chunk))
            log_at, ids = lattice.other_path(i, before, drawn)
            log = np.concatenate([base["log"][:chunk], [log_at], draws[s].log[a + chunk + 1 : b]])
            cut = [(x, min(y, a + chunk), d) for x, y, d in base["draw"] if x < a + chunk]
            changed = {c: v for c, v in base["changed"].items() if c < chunk} | {chunk: ids}
            sample = {"log": log, "draw": [*cut, (a + chunk, b, s)], "changed": changed, "value": value}
            states[t]["samples"].append(sample)
            # what is left of the part: the same chunk with yet another path, or the new path up to a later chunk
            now = [*before, ids]
            start = float(log[:chunk].sum())
            lost = sum(np.exp(lattice.path_log(i, x)) for x in now)
            again = start + np.log(max(1 - lost, 1e-300)) if len({tuple(x) for x in now}) < lattice.paths[lattice.start[i]] and lost < 1 else -np.inf
            taken[at] = now
            fresh.append((sample, chunk, start, again, value))
        sizes = np.array([len(f[0]["log"]) - f[1] for f in fresh])
        heads = np.cumsum(sizes) - sizes
        rows = np.repeat(np.arange(len(fresh)), sizes)
        log = np.concatenate([f[0]["log"][f[1] :] for f in fresh])
        paths = np.concatenate([many[first[t] + f[1] : first[t + 1]] for (t, _, _), f in zip(todo, fresh)])
        before = np.cumsum(log) - log
        mass = np.array([f[2] for f in fresh])[rows] + before - before[heads][rows] + np.where(paths > 1, _left(log), -np.inf)
        mass[heads] = [f[3] for f in fresh]
        own_keys = keys[[t for t, _, _ in todo]][rows]
        limits = _truncated(mass, np.array([f[4] for f in fresh])[rows], _uniform(own_keys, (1 << 21) + s, np.arange(len(rows)) - heads[rows], 0))
        for (t, part, at), (sample, chunk, *_), low, size in zip(todo, fresh, heads, sizes):
            part[2][at] = limits[low]
            states[t]["parts"].append((sample, chunk + 1, limits[low + 1 : low + size], {}))
    for t, state in enumerate(states):
        a, b = int(first[t]), int(first[t + 1])
        limit = max((p[2].max(initial=-np.inf) for p in state["parts"]), default=-np.inf)
        rows = []
        for sample in state["samples"]:
            ids = np.concatenate([np.zeros(0, np.int32), *_assembled(sample, draws, a)])
            total = float(sample["log"].sum())
            x = total - limit
            inclusion = 0.0 if x > 50 else (x if x < -30 else float(np.log(-np.expm1(-np.exp(x)))))
            rows.append((_with_bytes(vocabulary, ids), total, sample["value"], inclusion))
        out.append(rows)
    return out


def _ids_of(sample: dict, draws: list, chunk: int) -> list:
    for a, b, d in sample["draw"]:
        if a <= chunk < b:
            local = chunk - sample["draw"][0][0]
            return sample["changed"].get(local) or draws[d].piece(chunk, chunk + 1).tolist()
    raise IndexError(chunk)


def _assembled(sample: dict, draws: list, a: int) -> Iterator[np.ndarray]:
    for low, high, d in sample["draw"]:
        at = low
        for c in sorted(c + a for c in sample["changed"] if low <= c + a < high):
            yield draws[d].piece(at, c)
            yield np.array(sample["changed"][c - a], np.int32)
            at = c + 1
        yield draws[d].piece(at, high)


def _with_bytes(vocabulary: Vocabulary, ids: np.ndarray) -> np.ndarray:
    """Characters that no piece spells as the ids of their bytes."""
    odd = np.flatnonzero(ids < -1)
    if not len(odd):
        return ids
    code = -2 - ids[odd]
    if (code < 0x80).all():
        ids[odd] = vocabulary.byte_ids[code]
        return ids
    parts, done = [], 0
    for i in odd:
        parts += [ids[done:i], vocabulary.byte_ids[np.frombuffer(chr(-2 - ids[i]).encode(), np.uint8)]]
        done = i + 1
    return np.concatenate([*parts, ids[done:]]).astype(np.int32)


def decoded(vocabulary: Vocabulary, ids) -> str:
    """The text of a segmentation: the first space is the model's own."""
    return spelled(vocabulary, ids).decode("utf-8", "replace").removeprefix(" ")


def spelled(vocabulary: Vocabulary, ids) -> bytes:
    """The bytes of a segmentation, with the model's own first space."""
    return b"".join(itemgetter(*ids, 0, 0)(vocabulary.spelling)[:-2])


def _encoded(vocabulary, k: int, digest: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary.value
        for batch in batches:
            for part in slices(batch, "text", 2 << 20):
                texts = part.column("text").to_pylist()
                keys = mixed(part.column("key").to_numpy().view(np.uint64))
                owner, number, ids, logs, values, inclusions, equal = [], [], [], [], [], [], []
                for row, found in enumerate(sampled(v, texts, keys, k)):
                    for no, (pieces, log, value, inclusion) in enumerate(found):
                        owner.append(row)
                        number.append(no + 1)
                        ids.append(pieces)
                        logs.append(log)
                        values.append(value)
                        inclusions.append(inclusion)
                        if digest:
                            text = texts[row]
                            equal.append(spelled(v, pieces.tolist()) == (f" {text}".encode() if text else b""))
                sizes = pa.array([len(x) for x in ids], pa.int64())
                columns = [part.column("doc_id").take(pa.array(owner, pa.int64())), pa.array(number, pa.int32()), sizes,
                           pa.array(logs, pa.float64()), pa.array(values, pa.float64()), pa.array(inclusions, pa.float64())]
                if digest:
                    sha = [hashlib.sha256(x.astype("<i4").tobytes()).hexdigest() for x in ids]
                    columns += [pa.array(sha, pa.string()), pa.array(equal, pa.bool_())]
                else:
                    offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
                    flat = pa.array(np.concatenate([np.zeros(0, np.int32), *ids]))
                    columns.append(pa.ListArray.from_arrays(pa.array(offsets), flat))
                names = ["doc_id", "sample_no", "n_pieces", "log_prob", "perturbed", "log_inclusion"]
                yield pa.RecordBatch.from_arrays(columns, names=names + (["pieces_sha256", "round_trip"] if digest else ["pieces"]))

    return run


def encode(docs: DataFrame, samples: int = SAMPLES, seed: int = SEED, path: str = MODEL, digest: bool = False, temperature: float = 1.0) -> DataFrame:
    """Up to ``samples`` distinct segmentations of every row of ``docs`` (doc_id, text), best perturbed value first.

    Returns doc_id, sample_no (from 1), n_pieces, log_prob, perturbed, log_inclusion and pieces (ids); with
    ``digest`` instead of pieces their sha256 (as little-endian 32-bit numbers) and whether they decode to the
    text. Rows draw by their doc_id: repeated rows draw the same, as does a null id wherever it stands. Null and empty
    texts have one segmentation, without pieces. A text with fewer segmentations gives fewer rows. An
    empty table gives none.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    kind = docs.schema["doc_id"].dataType.simpleString()
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    key = F.xxhash64(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    source = docs.select("doc_id", text.alias("text"), key.alias("key"))
    vocabulary = spark.sparkContext.broadcast(load(path, temperature))
    last = "pieces_sha256 string, round_trip boolean" if digest else "pieces array<int>"
    return source.mapInArrow(
        _encoded(vocabulary, samples, digest),
        f"doc_id {kind}, sample_no int, n_pieces long, log_prob double, perturbed double, log_inclusion double, {last}",
    )


def decode(encoded: DataFrame, path: str = MODEL) -> DataFrame:
    """``encoded`` with the column text that its column pieces spell; null pieces give null."""
    vocabulary = encoded.sparkSession.sparkContext.broadcast(load(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary.value
        for batch in batches:
            texts = [None if p is None else decoded(v, p) for p in batch.column("pieces").to_pylist()]
            keep = [n for n in batch.schema.names if n != "text"]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in keep), pa.array(texts, pa.string())], names=[*keep, "text"])

    kept = encoded.drop("text")
    bounded_batches(encoded.sparkSession)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema)
    return kept.mapInArrow(run, f"{fields}, text string")
