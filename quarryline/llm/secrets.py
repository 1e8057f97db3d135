"""Secret scans: fixed detectors, and probabilistic automata inferred from what they find.

Learning. The detectors label credentials by kind. At most ``SAMPLE`` different credentials of a kind (smallest hash; up
to ``LONGEST`` characters each) make a prefix tree over character classes, whose states are merged where a Hoeffding
bound finds their next-symbol and stop frequencies compatible. The same is done for the words that touch no span of the
detectors, the background.

Scoring. A word is a run of the characters that labelled credentials are made of, at least as long as the shortest of them.
Every word that the detectors don't cover to its last character is scored: whole, else without full stops at its ends, else
each piece between its full stops. What is scored becomes a span of kind ``format`` where some kind is both as likely per
character as all but the least likely ``STRANGE`` of its labelled credentials, and more likely than the background by
``MARGIN`` in log likelihood. Likelihoods depend on character classes only, so each task remembers what it found for a shape.

A null text is empty; an empty text has no spans. Positions are code points, ends exclusive. Repeated rows give
repeated results. If nothing is labelled, only detectors act (and they find nothing).
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarryline.llm.rows import free_name, slices, texts
from quarryline.session import stage

KINDS = ("assign", "access", "hex")  # fixed order
# Patterns of the detectors. The first group of ``assign`` matches in either case, the rest as written.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
SHORTEST = 6  # of the values that ``ASSIGN`` labels; the other kinds' are longer
WORD = re.compile(rf"[A-Za-z0-9+/_.=-]{{{SHORTEST},}}")
SHAPE = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", "A" * 26 + "a" * 26 + "0" * 10)
MEMO = 200_000  # shapes of up to 64 characters that a task remembers
HINTS = ("passw", "secret", "token", "api")  # every match of ASSIGN has one of them, in lower case

SAMPLE, LONGEST = 1000, 200
ALPHA = 0.05  # of the Hoeffding bound
MARGIN, STRANGE = 12.0, 0.01

Span = tuple[int, int, int]  # start, kind number, end


def detect(text: str) -> list[Span]:
    """Spans of the detectors, leftmost and non-overlapping within a kind, by start and kind."""
    out: list[Span] = []
    low = text.lower()
    if any(h in low for h in HINTS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= SHORTEST]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def covered(base: list[Span]) -> list[tuple[int, int]]:
    """The spans as disjoint stretches, in order."""
    out: list[tuple[int, int]] = []
    for start, _, end in base:
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((start, end))
    return out


def others(text: str, base: list[Span]) -> list[str]:
    """Words that touch no span of the detectors."""
    if not base:
        return WORD.findall(text)
    taken, at, out = covered(base), 0, []
    for m in WORD.finditer(text):
        while at < len(taken) and taken[at][1] <= m.start():
            at += 1
        if at == len(taken) or m.end() <= taken[at][0]:
            out.append(m.group())
    return out


def classes(word: str) -> str:
    """Digit 0, capital A, small letter a; other characters as they are."""
    return "".join("0" if c.isdigit() else "A" if c.isupper() else "a" if c.islower() else c for c in word)


class Automaton:
    """Probabilistic automaton over character classes; "" as a symbol means that the word stops."""

    def __init__(self) -> None:
        self.count: list[dict[str, int]] = [{}]
        self.to: list[dict[str, int]] = [{}]
        self.depth = [0]

    def add(self, word: str) -> None:
        state = 0
        for symbol in classes(word):
            self.count[state][symbol] = self.count[state].get(symbol, 0) + 1
            if symbol not in self.to[state]:
                self.to[state][symbol] = len(self.to)
                self.count.append({})
                self.to.append({})
                self.depth.append(self.depth[state] + 1)
            state = self.to[state][symbol]
        self.count[state][""] = self.count[state].get("", 0) + 1

    def compatible(self, a: int, b: int) -> bool:
        pairs = [(a, b)]
        while pairs:
            a, b = pairs.pop()
            n, m = sum(self.count[a].values()), sum(self.count[b].values())
            if not n or not m:
                continue
            bound = math.sqrt(0.5 * math.log(2 / ALPHA)) * (1 / math.sqrt(n) + 1 / math.sqrt(m))
            for symbol in {*self.count[a], *self.count[b]}:
                if abs(self.count[a].get(symbol, 0) / n - self.count[b].get(symbol, 0) / m) > bound:
                    return False
                x, y = self.to[a].get(symbol), self.to[b].get(symbol)
                if x is not None and y is not None and x != y:
                    pairs.append((x, y))
        return True

    def fold(self, a: int, b: int) -> None:
        """Add the counts of tree state ``b`` and of all below it to ``a``."""
        pairs = [(a, b)]
        while pairs:
            a, b = pairs.pop()
            for symbol, n in self.count[b].items():
                self.count[a][symbol] = self.count[a].get(symbol, 0) + n
            for symbol, below in self.to[b].items():
                if symbol in self.to[a]:
                    pairs.append((self.to[a][symbol], below))
                else:
                    self.to[a][symbol] = below

    def infer(self) -> Automaton:
        """Merge compatible states of equal depth, nearest to the root first.

        States of different depths stay apart: far from the root counts are small, so that nothing would tell them apart,
        and a format would lose its length.
        """
        kept, seen, at = [0], {0}, 0
        while at < len(kept):
            state = kept[at]
            blue, by = next(((t, c) for c, t in sorted(self.to[state].items()) if t not in seen), (None, ""))
            if blue is None:
                at += 1
                continue
            for red in [r for r in kept if self.depth[r] == self.depth[blue]]:
                if self.compatible(red, blue):
                    self.to[state][by] = red
                    self.fold(red, blue)
                    at = min(at, kept.index(red))  # the fold may have given it new states to look at
                    break
            else:
                kept.append(blue)
                seen.add(blue)
        number = {s: k for k, s in enumerate(kept)}
        out = Automaton()
        out.count = [self.count[s] for s in kept]
        out.to = [{c: number[t] for c, t in self.to[s].items()} for s in kept]
        out.depth = [self.depth[s] for s in kept]
        return out

    def log_likelihood(self, word: str) -> float:
        """Of the word with its stop; unseen symbols get a share of their own, after them every symbol is alike."""
        total, state = 0.0, 0
        for symbol in [*classes(word), ""]:
            if state is None:
                total -= math.log(12)
                continue
            seen = self.count[state]
            n = sum(seen.values())
            total += math.log((seen.get(symbol, 0) + 0.001) / (n + 0.012))
            state = self.to[state].get(symbol)
        return total


def learn(words: list[str]) -> Automaton:
    tree = Automaton()
    for word in words:
        tree.add(word)
    return tree.infer()


class Formats:
    def __init__(self, labelled: list[list[str]], plain: list[str]) -> None:
        self.kinds = []
        for words in filter(None, labelled):
            one = learn(words)
            usual = sorted(one.log_likelihood(w) / (len(w) + 1) for w in words)
            self.kinds.append((one, usual[int(STRANGE * len(usual))]))
        self.background = learn(plain) if plain else None
        self.memo: dict[str, tuple[tuple[int, int], ...]] = {}

    def likely(self, word: str) -> bool:
        plain = None
        for one, least in self.kinds:
            found = one.log_likelihood(word)
            if found < least * (len(word) + 1):
                continue
            if plain is None:
                plain = self.background.log_likelihood(word) if self.background else -math.log(12) * (len(word) + 1)
            if found - plain >= MARGIN:
                return True
        return False

    def parts(self, shape: str) -> tuple[tuple[int, int], ...]:
        """Where a word of this shape is a credential, or holds some between its full stops."""
        if self.likely(shape):
            return ((0, len(shape)),)
        if "." not in shape:
            return ()
        a, b = len(shape) - len(shape.lstrip(".")), len(shape.rstrip("."))
        if SHORTEST <= b - a < len(shape) and self.likely(shape[a:b]):
            return ((a, b),)
        return tuple(m.span() for m in re.finditer("[^.]+", shape) if len(m.group()) >= SHORTEST and self.likely(m.group()))

    def spans(self, text: str) -> tuple[list[Span], list[Span]]:
        """(those of the detectors, all)."""
        base = detect(text)
        if not self.kinds:
            return base, base
        taken, at, more = covered(base), 0, []
        for m in WORD.finditer(text.translate(SHAPE)):
            shape, start = m.group(), m.start()
            parts = self.memo.get(shape)
            if parts is None:
                parts = self.parts(shape)
                if len(shape) <= 64:
                    if len(self.memo) >= MEMO:
                        self.memo.clear()
                    self.memo[shape] = parts
            for a, b in parts:
                a, b = start + a, start + b
                while at < len(taken) and taken[at][1] <= a:
                    at += 1
                if at == len(taken) or a < taken[at][0] or taken[at][1] < b:
                    more.append((a, len(KINDS), b))
        return base, sorted(base + more)


def train(docs: DataFrame, sample: int = SAMPLE) -> Formats:
    """Infer the automata; what leaves a task, and what reaches the driver, is ``sample`` different words a kind."""

    def smallest(values: set[str]) -> list[tuple[int, str]]:
        return sorted((zlib.crc32(v.encode("utf-8", "replace")), v) for v in values)[:sample]

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[set[str]] = [set() for _ in range(len(KINDS) + 1)]
        for batch in slices(batches, "text"):
            rows: list[set[str]] = [set() for _ in kept]
            for text in batch.column("text").to_pylist():
                base = detect(text)
                for start, kind, end in base:
                    rows[kind].add(ASSIGN.match(text, start).group(2) if kind == 0 else text[start:end])
                rows[-1].update(others(text, base))
            for kind, words in enumerate(rows):
                new = {w for w in words if len(w) <= LONGEST} - kept[kind]
                if new:
                    kept[kind] = {v for _, v in smallest(kept[kind] | new)}
        for kind, words in enumerate(kept):
            if words:
                hashed = smallest(words)
                last = hashed[-1][0] if len(hashed) == sample else 1 << 32
                yield pa.RecordBatch.from_arrays(
                    [pa.array([kind] * len(hashed), pa.int32()), *(pa.array(c, t) for c, t in zip(zip(*hashed), (pa.int64(), pa.string()))), pa.array([last] * len(hashed), pa.int64())],
                    names=["kind", "hash", "value", "last"],
                )

    rows = stage(texts(docs).select("text").mapInArrow(found, "kind int, hash long, value string, last long"))
    # Whatever one task kept bounds what all keep: few rows beyond the sample are left to be sorted.
    bounds = {r.kind: r.bound for r in rows.groupBy("kind").agg(F.min("last").alias("bound")).collect()}
    kinds: list[list[str]] = []
    for kind in range(len(KINDS) + 1):
        within = rows.where((F.col("kind") == kind) & (F.col("hash") <= bounds.get(kind, -1)))
        kinds.append([r.value for r in within.select("hash", "value").distinct().orderBy("hash", "value").limit(sample).collect()] if kind in bounds else [])
    return Formats(kinds[:-1], kinds[-1])


def _joined(spans: list[Span]) -> str:
    names = (*KINDS, "format")
    return ",".join(f"{names[kind]}:{start}:{end}" for start, kind, end in spans)


def scan(docs: DataFrame, formats: Formats) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans) of every document."""
    rows = texts(docs)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            counts: list[list[int]] = [[], [], []]
            digests, joined = [], []
            for text in batch.column("text").to_pylist():
                base, spans = formats.spans(text)
                for k in range(3):
                    counts[k].append(sum(s[1] == k for s in base))
                digests.append(hashlib.sha256(_joined(base).encode()).hexdigest())
                joined.append(_joined(spans))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in counts), pa.array(digests, pa.string()), pa.array(joined, pa.string())],
                names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(work, f"doc_id {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")


def redact(docs: DataFrame, formats: Formats, mask: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span replaced in ``text`` (overlapping ones by one mask); ``n_chars`` follows. A null text stays null."""

    def clean(text: str) -> str:
        out, done, shown = [], 0, 0
        for start, _, end in formats.spans(text)[1]:
            if start >= done:
                out += [text[shown:start], mask]
            done = shown = max(done, end)
        return "".join([*out, text[shown:]])

    name = free_name(docs, "_clean")
    masked = docs.withColumn(name, F.pandas_udf(lambda s: s.map(clean, na_action="ignore"), "string")("text"))
    new = {"text": F.col(name)} | ({"n_chars": F.when(F.col(name).eqNullSafe(F.col("text")), F.col("n_chars")).otherwise(F.length(name).cast(docs.schema["n_chars"].dataType))} if "n_chars" in docs.columns else {})
    return masked.select(*[new[c].alias(c) if c in new else F.col(f"`{c}`") for c in docs.columns])
