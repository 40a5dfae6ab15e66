"""Secrets in texts: base patterns, and formats inferred as probabilistic automata.

The matches of the base patterns are labelled credentials. From a bounded sample of each kind a
prefix tree of their character classes is built and states whose continuations do not differ
statistically are merged (the Alergia test), which gives a small probabilistic automaton per kind.
Every run of credential characters in every text, and its parts between separators, are then scored: by the
likelihood of their format under each automaton, against a character-pair model of such runs counted over all texts.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tideline.llm.buffers import slices, text_bytes
from tideline.llm.tables import table, whole_text

# The patterns of the contract and the order of their kinds.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")  # runs of 16 or more are what is left of all runs when shorter ones are dropped
KINDS = ("assign", "access", "hex", "format")
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
CHARACTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-"
CLASSES = ("0123456789", "abcdef", "ghijklmnopqrstuvwxyz", "ABCDEF", "GHIJKLMNOPQRSTUVWXYZ", "+", "/", "_", ".", "=", "-")
SEPARATORS = ("", "=", "=/", "=/.", "=/.-")  # a run is a candidate whole and cut at the characters of each of these
SHORTEST = 12
SAMPLE = 200
SIGNIFICANCE = 0.05
SMOOTHING = 0.002
MARGIN = 12.0
TYPICAL = 0.02


def base_matches(text: str) -> list[tuple[str, int, int, str]]:
    """Kind, start, end and credential of the base matches, leftmost and non-overlapping per kind."""
    found = []
    low = text.lower()
    if any(k in low for k in KEYWORDS):
        found += [("assign", m.start(), m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        found += [("access", m.start(), m.end(), m[0]) for m in ACCESS.finditer(text) if len(m[0]) >= 18]
    found += [("hex", m.start(), m.end(), m[0]) for m in HEX.finditer(text)]
    return found


def class_table() -> tuple[np.ndarray, np.ndarray]:
    """Class of each byte (-1: no credential character), and log of one over the size of each class."""
    table = np.full(256, -1, np.int64)
    for k, members in enumerate(CLASSES):
        table[[ord(c) for c in members]] = k
    return table, -np.log([len(c) for c in CLASSES])


class Automaton:
    """A probabilistic automaton over character classes, learned by merging states of a prefix tree."""

    def __init__(self, strings: list[str]) -> None:
        table, self.within = class_table()
        self.count, self.end, self.next, self.edge = [0], [0], [{}], [{}]
        for s in sorted(strings):
            at = 0
            for k in table[np.frombuffer(s.encode(), np.uint8)].tolist():
                self.count[at] += 1
                self.edge[at][k] = self.edge[at].get(k, 0) + 1
                if k not in self.next[at]:
                    self.next[at][k] = len(self.count)
                    for column, empty in ((self.count, 0), (self.end, 0), (self.next, {}), (self.edge, {})):
                        column.append(type(empty)())
                at = self.next[at][k]
            self.count[at] += 1
            self.end[at] += 1
        self.merge_states()
        self.compile(strings)

    def alike(self, x: int, y: int) -> bool:
        """Whether two states and all they lead to agree within the Hoeffding bound."""
        stack = [(x, y)]
        while stack:
            x, y = stack.pop()
            if x == y:
                continue
            n, m = self.count[x], self.count[y]
            if not n or not m:
                continue
            bound = math.sqrt(0.5 * math.log(2 / SIGNIFICANCE)) * (1 / math.sqrt(n) + 1 / math.sqrt(m))
            if abs(self.end[x] / n - self.end[y] / m) > bound:
                return False
            for k in self.edge[x].keys() | self.edge[y].keys():
                if abs(self.edge[x].get(k, 0) / n - self.edge[y].get(k, 0) / m) > bound:
                    return False
                if k in self.next[x] and k in self.next[y]:
                    stack.append((self.next[x][k], self.next[y][k]))
        return True

    def fold(self, x: int, y: int) -> None:
        """Adds the counts of the tree below y to those from x on."""
        stack = [(x, y)]
        while stack:
            x, y = stack.pop()
            self.count[x] += self.count[y]
            self.end[x] += self.end[y]
            for k, n in self.edge[y].items():
                self.edge[x][k] = self.edge[x].get(k, 0) + n
                if k in self.next[x]:
                    stack.append((self.next[x][k], self.next[y][k]))
                else:
                    self.next[x][k] = self.next[y][k]

    def merge_states(self) -> None:
        kept = [0]
        while True:
            border = [(s, k) for s in kept for k in self.next[s] if self.next[s][k] not in kept]
            if not border:
                break
            state, k = min(border, key=lambda e: (-self.count[self.next[e[0]][e[1]]], self.next[e[0]][e[1]]))
            young = self.next[state][k]
            for old in kept:
                if self.alike(old, young):
                    self.next[state][k] = old
                    self.fold(old, young)
                    break
            else:
                kept.append(young)
        self.states = kept

    def compile(self, strings: list[str]) -> None:
        """Tables of next states and log probabilities; the last state is for what was never seen."""
        number, size = {s: k for k, s in enumerate(self.states)}, len(CLASSES)
        lost = len(self.states)
        self.go = np.full((lost + 1, size), lost, np.int64)
        self.log = np.full((lost + 1, size), math.log(SMOOTHING / (size + 1)))
        self.stop = np.full(lost + 1, math.log(SMOOTHING / (size + 1)))
        for s, k in number.items():
            for c in range(size):
                share = self.edge[s].get(c, 0) / max(self.count[s], 1)
                self.log[k, c] = math.log((1 - SMOOTHING) * share + SMOOTHING / (size + 1))
                if c in self.next[s]:
                    self.go[k, c] = number[self.next[s][c]]
            self.stop[k] = math.log((1 - SMOOTHING) * self.end[s] / max(self.count[s], 1) + SMOOTHING / (size + 1))
        self.log += self.within[None, :]
        data = np.frombuffer("".join(strings).encode(), np.uint8)
        ends = np.cumsum([len(s) for s in strings])
        own = self.score(class_table()[0][data], ends - [len(s) for s in strings], ends)
        self.floor = float(np.quantile(own / (ends - np.append(0, ends[:-1]) + 1), TYPICAL))

    def score(self, classes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Log likelihood of each span, all spans step by step together."""
        out, state = np.zeros(len(starts)), np.zeros(len(starts), np.int64)
        open_, at = np.arange(len(starts)), starts.copy()
        while len(open_):
            over = at[open_] >= ends[open_]
            done = open_[over]
            out[done] += self.stop[state[done]]
            open_ = open_[~over]
            k = classes[at[open_]]
            out[open_] += self.log[state[open_], k]
            state[open_] = self.go[state[open_], k]
            at[open_] += 1
        return out


def runs_of(solid: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of solid bytes within rows."""
    edge = np.zeros(len(solid) + 1, bool)
    edge[offsets] = True
    before = np.append(False, solid[:-1]) & ~edge[:-1] if len(solid) else solid
    after = np.append(solid[1:], False) & ~edge[1:] if len(solid) else solid
    return np.flatnonzero(solid & ~before), np.flatnonzero(solid & ~after) + 1


def candidate_runs(data: np.ndarray, offsets: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, start and end, in bytes, of the runs of credential characters and of their parts that are long enough.

    Parts are what lies between = / . and -, at each of these or at some, without such characters at
    the ends; and what lies after the last = but those that end the run.
    """
    starts, ends = runs_of(classes >= 0, offsets)
    long = ends - starts >= SHORTEST
    starts, ends = starts[long], ends[long]
    inside = np.zeros(len(data) + 1, np.int8)
    inside[starts] += 1
    inside[ends] -= 1
    solid = np.cumsum(inside[:-1]) > 0
    places, size = np.arange(len(data)), len(data) + 1
    core = solid & ~np.isin(data, np.frombuffer(SEPARATORS[-1].encode(), np.uint8))
    following = np.minimum.accumulate(np.where(core, places, len(data))[::-1])[::-1]  # the next character that is no separator
    previous = np.maximum.accumulate(np.where(core, places, -1)) + 1
    padding = np.minimum.accumulate(np.where(data != ord("="), places, len(data))[::-1])[::-1]  # the next that is no =
    codes = [starts * size + ends]
    for separators in SEPARATORS:
        low, high = runs_of(solid & ~np.isin(data, np.frombuffer(separators.encode(), np.uint8)), offsets)
        long = high - low >= SHORTEST
        low, high = low[long], high[long]
        codes.append(following[low] * size + previous[high - 1])
        if separators == "=" and len(low):
            run_end = ends[np.searchsorted(starts, low, side="right") - 1]
            padded = (high < run_end) & (np.append(padding, len(data))[high] >= run_end)
            codes.append(following[low[padded]] * size + run_end[padded])
    start, end = np.divmod(np.unique(np.concatenate(codes)), size)
    long = end - start >= SHORTEST
    start, end = start[long], end[long]
    return np.searchsorted(offsets, start, side="right") - 1, start, end


def pair_codes() -> np.ndarray:
    codes = np.zeros(256, np.int64)
    codes[[ord(c) for c in CHARACTERS]] = np.arange(1, len(CHARACTERS) + 1)
    return codes


def count_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """pair, count of this task; all other characters are one symbol."""
    codes, size = pair_codes(), len(CHARACTERS) + 1
    total = np.zeros(size * size, np.int64)
    for batch in slices(batches, "text"):
        flat = np.append(0, codes[text_bytes(batch.column("text"))[0]])
        total += np.bincount(flat[:-1] * size + flat[1:], minlength=size * size)
    some = np.flatnonzero(total)
    yield pa.record_batch({"pair": some, "n": total[some]})


def find_labelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        rows = [(kind, s) for text in batch.column("text").to_pylist() for kind, _, _, s in base_matches(text) if len(s) <= 256]
        yield pa.record_batch({"kind": pa.array([r[0] for r in rows], pa.string()), "secret": pa.array([r[1] for r in rows], pa.string())})


def infer(docs: DataFrame, text_column: str = "text") -> tuple[list[Automaton], np.ndarray]:
    """The automata of the kinds, from at most 200 distinct credentials each, and the pair model.

    The sample holds the credentials of up to 256 characters with the least hash; the pairs are counted over all texts.
    """
    texts = docs.select(whole_text(text_column).alias("text"))
    order = Window.partitionBy("kind").orderBy(F.xxhash64("secret"), "secret")
    sample: dict[str, list[str]] = {}
    for row in (
        texts.mapInArrow(find_labelled, "kind string, secret string").distinct()
        .withColumn("place", F.row_number().over(order)).where(F.col("place") <= SAMPLE).collect()
    ):
        sample.setdefault(row.kind, []).append(row.secret)
    size = len(CHARACTERS) + 1
    counts = np.full(size * size, 0.5)
    for row in texts.mapInArrow(count_pairs, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).collect():
        counts[row.pair] += row.n
    pairs = counts.reshape(size, size)
    return [Automaton(sorted(sample[k])) for k in KINDS if k in sample], np.log(pairs / pairs.sum(axis=1, keepdims=True))


def best_apart(found: list[tuple[float, int, int]]) -> list[tuple[str, int, int]]:
    """Spans that do not overlap, of (minus gain, start, end): the greatest gain first."""
    kept: list[tuple[str, int, int]] = []
    groups: list[list[tuple[float, int, int]]] = []
    reach = -1
    for x in sorted(found, key=lambda x: x[1]):
        if x[1] >= reach:
            groups.append([])
        groups[-1].append(x)
        reach = max(reach, x[2])
    for group in groups:
        taken: list[tuple[str, int, int]] = []
        for _, a, b in sorted(group):
            if not any(a < d and c < b for _, c, d in taken):
                taken.append(("format", a, b))
        kept += taken
    return kept


def scanner(automata: list[Automaton], pairs: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """id and spans (kind, start, end, in code points) of each row of (id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes_of, codes = class_table()[0], pair_codes()
        for batch in slices(batches, "text", 1 << 20):
            data, offsets = text_bytes(batch.column("text"))
            classes = classes_of[data]
            row, start, end = candidate_runs(data, offsets, classes)
            gain = np.full(len(row), -np.inf)
            if len(row) and automata:
                flat = codes[data]
                step = np.append(0.0, pairs[np.append(0, flat[:-1]), flat])
                summed = np.cumsum(step)
                plain = summed[end] - summed[start + 1] + pairs[0, flat[start]] + pairs[flat[end - 1], 0]
                for automaton in automata:
                    score = automaton.score(classes, start, end)
                    fits = (score / (end - start + 1) >= automaton.floor) & (score - plain >= MARGIN)
                    gain = np.where(fits, np.maximum(gain, score - plain), gain)
            good = gain > -np.inf
            row, start, end, gain = row[good], start[good], end[good], gain[good]
            points = np.cumsum(np.append(0, (data & 0xC0) != 0x80))
            extra: list[list[tuple[float, int, int]]] = [[] for _ in range(batch.num_rows)]
            for r, g, a, b in zip(row.tolist(), gain.tolist(), (points[start] - points[offsets[row]]).tolist(), (points[end] - points[offsets[row]]).tolist(), strict=True):
                extra[r].append((-g, a, b))
            spans = []
            for text, more in zip(pc.fill_null(batch.column("text"), "").to_pylist(), extra, strict=True):
                base = [(k, a, b) for k, a, b, _ in base_matches(text)]
                new = best_apart([x for x in more if not any(x[1] < b and a < x[2] for _, a, b in base)])
                spans.append([{"kind": k, "start": a, "end": b} for k, a, b in sorted(base + new, key=lambda s: (s[1], KINDS.index(s[0])))])
            yield pa.record_batch({"id": batch.column("id"), "spans": pa.array(spans, pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])))})

    return run


def scan(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per input row: id and spans, an array of (kind, start, end) in code points.

    Base matches are of kind assign, access and hex; a run of credential characters, or a part of it between separators,
    that overlaps none of them and has the likelihood of a credential's format is of kind format; of overlapping ones the likeliest. Spans come by start, then
    kind. A null text counts as empty; repeated rows get equal results.
    """
    id_type = docs.schema[id_column].dataType.simpleString()
    return docs.select(F.col(id_column).alias("id"), whole_text(text_column).alias("text")).mapInArrow(
        scanner(*infer(docs, text_column)), f"id {id_type}, spans array<struct<kind:string,start:bigint,end:bigint>>",
    ).withColumnRenamed("id", id_column)


def span_digests(found: DataFrame, id_column: str = "doc_id") -> DataFrame:
    def joined(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def of_kind(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"] != "format")
    return found.select(
        id_column, *map(of_kind, KINDS[:3]), F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return span_digests(scan(table(spark, sf_dir, "documents").select("doc_id", "text")))
