"""BPE encoding and decoding with batched numpy merge rounds.

The symbols of many words stand in one flat array. A round looks up every neighbouring pair by binary search over the
sorted pair keys of the merge table, takes the lowest rank of each word and merges all its places at once; words
without a pair leave the array. A bounded memo of words that were met before (by worker process) keeps frequent
words out of the rounds; it never changes a result.

Reads the JSON files of the ``tokenizers`` library (byte level, with or without a word-end suffix). Null text counts
as empty, an empty text has no ids; texts of any length are encoded whole; repeated rows give repeated results.
Executors import this module, so ship the package (``--py-files``) where they don't share the driver's path.
"""

from __future__ import annotations

import gc
import hashlib
import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from quarryline.llm.rows import slices, texts

# The splitting pattern of byte-level vocabularies, used where a file only says "use_regex".
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
MEMO_ENTRIES = 500_000  # words remembered by a worker process; it starts afresh beyond that
MARKS = frozenset(".,;:!?")  # a word of ASCII letters that ends in one of them is split without the pattern
# Letters that Arrow lower-cases as Python does, that are normal (NFC) in any order, and are one word for the pattern.
LETTERS = "A-Za-zÀ-ÖØ-öø-įı-ſЀ-џ"
PLAIN = rf"\A[{LETTERS}]+[.,;:!?]?\z"
HANGING = re.compile(r" (?=\s|\Z)")  # in a text with a piece that ``_hangs``
Unit = str | tuple[str]  # see Bpe._units
_NONE = np.int32(2**31 - 1)  # rank of a pair that is no merge


def byte_characters() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out, extra = [""] * 256, 0x100
    for byte in range(256):
        if byte in plain:
            out[byte] = chr(byte)
        else:
            out[byte], extra = chr(extra), extra + 1
    return out


def _hangs(piece: Unit) -> bool:
    return not piece or (isinstance(piece, str) and piece[0].isspace())


def _spread(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """``start``, ``start + 1`` and so on for ``size`` places, of all entries in a row."""
    ends = np.cumsum(size)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(start - (ends - size), size)


class Bpe:
    """One tokenizer file: ``encode`` gives ids as little-endian unsigned 16-bit integers, ``decode`` the text."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, vocab = spec["model"], spec["model"]["vocab"]
        suffix = model.get("end_of_word_suffix") or ""
        marks = byte_characters()
        self.first = np.array([vocab.get(c, -1) for c in marks], dtype=np.int32)
        self.last = np.array([vocab.get(c + suffix, -1) for c in marks], dtype=np.int32)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        keys = np.array([vocab[a] << 16 | vocab[b] for a, b in pairs], dtype=np.uint32)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int32)
        self.merged = np.array([vocab[a + b] for a, b in pairs], dtype=np.int32)  # by rank
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.splitter = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.spaced = spec["pre_tokenizer"]["type"] == "ByteLevel"  # a space belongs to the word that follows it
        if self.spaced:
            self.words = regex.compile(BYTE_LEVEL)
        else:
            steps = spec["pre_tokenizer"]["pretokenizers"]
            self.words = regex.compile(next(s["pattern"]["Regex"] for s in steps if s["type"] == "Split"))
        size = max([*vocab.values(), *self.special.values()]) + 1
        assert size <= 1 << 16, "ids must fit into 16 bits"
        back = {c: b for b, c in enumerate(marks)}
        self.bytes_of: list[bytes] = [b""] * size
        for token, number in vocab.items():
            self.bytes_of[number] = bytes(back[c] for c in token.removesuffix(suffix)) if not suffix else token.encode()
        for token, number in self.special.items():
            self.bytes_of[number] = token.encode()
        self.memo: dict[Unit, bytes] = {}
        self.word_memo: dict[str, bytes] = {}
        self.table: tuple[pa.Array, np.ndarray, np.ndarray] | None = None  # see _table

    # --- merge rounds -----------------------------------------------------------------------------------------------

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in a row, and how many each word has. No word is empty."""
        size = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        raw = np.frombuffer(b"".join(words), dtype=np.uint8)
        symbols, ends = self.first[raw], np.cumsum(size) - 1
        symbols[ends] = self.last[raw[ends]]
        owner = np.repeat(np.arange(len(words), dtype=np.int32), size)
        if (symbols < 0).any():  # a byte that the vocabulary lacks
            owner, symbols = owner[symbols >= 0], symbols[symbols >= 0]
        rank = self._rank(symbols, owner, np.arange(len(symbols)))
        done_owner, done_symbols = [], []
        while len(symbols):
            starts = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            lowest = np.repeat(np.minimum.reduceat(rank, starts), np.diff(starts, append=len(symbols)))
            over = lowest == _NONE
            if over.any():
                done_owner.append(owner[over])
                done_symbols.append(symbols[over])
            place = np.flatnonzero((rank == lowest) & ~over)
            changed = np.zeros(len(symbols), bool)
            if len(place):
                # Of places that overlap (equal symbols in a row) every second one counts, from the left.
                run = np.diff(place, prepend=-2) != 1
                start = np.maximum.accumulate(np.where(run, np.arange(len(place)), 0))
                place = place[(np.arange(len(place)) - start) % 2 == 0]
                symbols[place] = self.merged[rank[place]]
                changed[place] = over[place + 1] = True
            keep = ~over
            symbols, owner, rank, changed = symbols[keep], owner[keep], rank[keep], changed[keep]
            # Only pairs that a merge has touched have another rank now.
            changed[:-1] |= changed[1:]
            touched = np.flatnonzero(changed)
            rank[touched] = self._rank(symbols, owner, touched)
        if not done_owner:
            return np.zeros(0, np.int64), np.zeros(len(words), np.int64)
        owner, symbols = np.concatenate(done_owner), np.concatenate(done_symbols)
        return symbols[np.argsort(owner, kind="stable")], np.bincount(owner, minlength=len(words))

    def _rank(self, symbols: np.ndarray, owner: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Merge rank of the pair that begins at each place."""
        if not len(at):
            return np.zeros(0, np.int32)
        right = np.minimum(at + 1, len(symbols) - 1)
        key = symbols[at].astype(np.uint32) << 16 | symbols[right].astype(np.uint32)
        found = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        real = (self.keys[found] == key) & (owner[at] == owner[right]) & (right > at)
        return np.where(real, self.ranks[found], _NONE)

    def _learn(self, units: list[Unit]) -> None:
        """Put the ids of units into the memo."""
        if not units:
            return
        # Words of ASCII letters, alone or before one mark, are split without the pattern, which gives the same.
        plain, marked, other = [], [], []
        for u in units:
            kind = other
            if isinstance(u, str) and u.isascii():
                if u.isalpha():
                    kind = plain
                elif u[-1:] in MARKS and u[:-1].isalpha():
                    kind = marked
            kind.append(u)
        word = " {}".format if self.spaced else str.lower
        plain_words, marked_words = list(map(word, plain)), [word(u[:-1]) for u in marked]
        found = [self.words.findall(self._plain(u)) for u in other]
        words = {*plain_words, *marked_words, *(u[-1] for u in marked), *chain.from_iterable(found)}
        new = [w for w in words if w not in self.word_memo]
        if new:
            ids, lengths = self.merge([w.encode() for w in new])
            packed = ids.astype("<u2").tobytes()
            bounds = np.concatenate([[0], np.cumsum(lengths) * 2]).tolist()
            self.word_memo.update(zip(new, map(packed.__getitem__, map(slice, bounds, bounds[1:]))))
        know = self.word_memo.__getitem__
        self.memo.update(zip(plain, map(know, plain_words)))
        self.memo.update((u, know(w) + know(u[-1])) for u, w in zip(marked, marked_words))
        self.memo.update(zip(other, [know(w[0]) if len(w) == 1 else b"".join(map(know, w)) for w in found]))

    def _plain(self, unit: Unit) -> str:
        """The text that a unit stands for: see ``_units``."""
        if self.spaced:
            return unit[0] if isinstance(unit, tuple) else f" {unit}"
        unit = unicodedata.normalize("NFC", unit)
        return "".join(map(str.lower, unit)) if "Σ" in unit else unit.lower()

    def _units(self, text: str) -> list[Unit]:
        """Pieces of a text that are encoded by themselves, cut at single spaces.

        With ``spaced`` a piece stands for itself with a space in front; the first one, which has none, is a tuple. A piece that is empty or begins with white space belongs to the run of white space before it.
        """
        if not self.spaced:
            return text.replace("\n", " ").split(" ")
        pieces = text.split(" ")
        pieces[0] = (pieces[0],)
        return pieces

    def _joined(self, pieces: list[Unit]) -> list[Unit]:
        out = pieces[:1]
        for piece in pieces[1:]:
            if _hangs(piece):
                last = out[-1]
                out[-1] = (f"{last[0]} {piece}",) if isinstance(last, tuple) else f"{last} {piece}"
            else:
                out.append(piece)
        return out

    def encode(self, batch: list[str]) -> list[bytes]:
        """Packed ids of each text. Nothing made here is cyclic, so the collector rests meanwhile."""
        collects = gc.isenabled()
        gc.disable()
        try:
            return self._encode(batch)
        finally:
            if collects:
                gc.enable()

    def _encode(self, batch: list[str]) -> list[bytes]:
        if len(self.memo) > MEMO_ENTRIES:
            self.memo.clear()
        if len(self.word_memo) > MEMO_ENTRIES:
            self.word_memo.clear()
        parts: list[tuple[int, list[Unit], list[bytes | None]]] = []  # text number, units, their ids as far as known
        missing: dict[Unit, None] = {}
        know = self.memo.get
        for number, text in enumerate(batch):
            pieces = self.splitter.split(text) if self.splitter and "<|" in text else [text]
            for piece in pieces:
                if piece in self.special:
                    parts.append((number, [piece], [self.special[piece].to_bytes(2, "little")]))
                    continue
                units = self._units(piece)
                if None in (known := list(map(know, units))):
                    new = [u for u, ids in zip(units, known) if ids is None]
                    if self.spaced and HANGING.search(piece):  # such pieces never get into the memo
                        new = units = self._joined(units)
                        known = [None] * len(units)
                    missing.update(dict.fromkeys(new))
                parts.append((number, units, known))
        self._learn([u for u in missing if u not in self.memo])
        out = [b""] * len(batch)
        look = self.memo.__getitem__
        for number, units, known in parts:
            out[number] += b"".join([look(u) if ids is None else ids for u, ids in zip(units, known)])
        return out

    def encode_column(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and how many each text has.

        Without ``spaced`` Arrow cuts the texts, numbers the pieces and looks words up, so Python meets only the pieces that are
        more than letters and a mark. Texts that may hold a special token, and other files, go the way of ``encode``. No text is null.
        """
        if not len(column):
            return np.zeros(0, np.uint16), np.zeros(0, np.int64)
        odd = np.full(len(column), self.spaced)
        if self.splitter and not self.spaced:
            odd = pc.match_substring(column, "<|").to_numpy(zero_copy_only=False)
        each = self.encode(column.filter(pa.array(odd)).to_pylist())
        rest = np.frombuffer(b"".join(each), "<u2")
        counts = np.zeros(len(column), np.int64)
        counts[odd] = [len(x) // 2 for x in each]
        if odd.all():
            return rest, counts
        flat, counts[~odd] = self._encode_plain(column.filter(pa.array(~odd)))
        if not odd.any():
            return flat, counts
        out, of_odd = np.empty(len(flat) + len(rest), np.uint16), np.repeat(odd, counts)
        out[of_odd], out[~of_odd] = rest, flat
        return out, counts

    def _encode_plain(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        if len(self.memo) > MEMO_ENTRIES:
            self.memo.clear()
        if len(self.word_memo) > MEMO_ENTRIES:
            self.word_memo.clear()
        cut = pc.split_pattern(pc.replace_substring(column, "\n", " "), " ")
        pieces = cut.flatten().dictionary_encode()
        units = pieces.dictionary
        plain = pc.match_substring_regex(units, PLAIN).to_numpy(zero_copy_only=False)
        # Plain units: a word from the table, and perhaps a mark.
        text = units.filter(pa.array(plain))
        raw = np.frombuffer(text.buffers()[2] or b"", np.uint8)
        final = raw[np.frombuffer(text.buffers()[1], np.int32)[1 : len(text) + 1] - 1] if len(text) else np.zeros(0, np.uint8)
        mark = np.where(np.isin(final, [ord(m) for m in MARKS]), self.last[final], -1)
        word_start, word_size, word_ids = self._table(pc.utf8_lower(pc.utf8_rtrim(text, characters="".join(MARKS))))
        # All others go through the pattern, or come from the memo.
        others = units.filter(pa.array(~plain)).to_numpy(zero_copy_only=False).tolist()
        known = list(map(self.memo.get, others))
        self._learn([u for u, ids in zip(others, known) if ids is None])
        known = list(map(self.memo.__getitem__, others))
        size = np.zeros(len(units), np.int64)
        size[plain], size[~plain] = word_size + (mark >= 0), np.fromiter(map(len, known), np.int64, len(known)) // 2
        ends = np.cumsum(size)
        start, ids = ends - size, np.empty(int(ends[-1]), np.uint16)
        ids[_spread(start[plain], word_size)] = word_ids[_spread(word_start, word_size)]
        ids[ends[plain][mark >= 0] - 1] = mark[mark >= 0]
        ids[_spread(start[~plain], size[~plain])] = np.frombuffer(b"".join(known), "<u2")
        at = pieces.indices.to_numpy()
        ends = np.cumsum(size[at])
        closing = np.diff(cut.offsets.to_numpy()).cumsum() - 1  # last piece of each text; every text has one
        return ids[_spread(start[at], size[at])], np.diff(ends[closing], prepend=0)

    def _table(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where the ids of each word stand in a table, how many these are, and the table, which keeps words of earlier batches."""
        if self.table is None or len(self.table[0]) > MEMO_ENTRIES:
            self.table = pa.array([], words.type), np.zeros(0, np.int64), np.zeros(0, np.uint16)
        words = words.dictionary_encode()
        seen, sizes, ids = self.table
        at = pc.index_in(words.dictionary, value_set=seen).fill_null(-1).to_numpy().astype(np.int64)
        new = words.dictionary.filter(pa.array(at < 0))
        if len(new):
            at[at < 0] = len(seen) + np.arange(len(new))
            more, counts = self.merge(new.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist())
            seen, sizes = pa.concat_arrays([seen, new]), np.concatenate([sizes, counts])
            ids = np.concatenate([ids, more.astype(np.uint16)])
            self.table = seen, sizes, ids
        at = at[words.indices.to_numpy()]
        return (np.cumsum(sizes) - sizes)[at], sizes[at], ids

    def decode(self, ids: np.ndarray) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids.tolist())).decode("utf-8", "replace")


@lru_cache(maxsize=4)
def load(path: str) -> Bpe:
    """One instance per file and worker process, so that its memo lives as long as the worker."""
    return Bpe(path)


def public_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def encode_decode(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded) of every document: ids as binary (unsigned 16-bit), and the text they give."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for batch in slices(batches, "text", 2 << 20):
            ids = bpe.encode(batch.column("text").to_pylist())
            decoded = [bpe.decode(np.frombuffer(x, "<u2")) for x in ids]
            counts = pa.array([len(x) // 2 for x in ids], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), counts, pa.array(ids, pa.binary()), pa.array(decoded, pa.string())],
                names=["doc_id", "n_tokens", "ids", "decoded"],
            )

    rows = texts(docs)
    return rows.mapInArrow(work, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_tokens long, ids binary, decoded string")


def digests(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): the digests of ``encode_decode``, made where the ids are."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for batch in slices(batches, "text", 2 << 20):
            counts, left, right = [], [], []
            for packed in bpe.encode(batch.column("text").to_pylist()):
                ids = np.frombuffer(packed, "<u2")
                counts.append(len(ids))
                left.append(hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest())
                right.append(hashlib.sha256(bpe.decode(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(left, pa.string()), pa.array(right, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    rows = texts(docs)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(work, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
