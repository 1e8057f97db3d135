import bisect
import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from quarryline.llm import bpe, packing

PATH = bpe.public_file("byte_bpe_50k.json")


def check(table, sequences, counts, capacity):
    """Every piece once, no sequence above the capacity, no gap."""
    seen = {s: 0 for s in counts}
    inside = {}
    for size, first, n, sequence, offset in table.tolist():
        assert first == seen[size]
        seen[size] += n
        for q in range(sequence, sequence + n):
            inside.setdefault(q, []).append((offset, size))
    assert seen == counts and set(inside) == set(range(sequences))
    for places in inside.values():
        places.sort()
        end = 0
        for offset, size in places:
            assert offset == end
            end += size
        assert end <= capacity


def best_fit_decreasing(counts, capacity):
    room, used = [], 0
    for size in sorted(counts, reverse=True):
        for _ in range(counts[size]):
            at = bisect.bisect_left(room, size)
            left = room.pop(at) if at < len(room) else capacity
            used += left == capacity
            if left > size:
                bisect.insort(room, left - size)
    return used


@pytest.mark.parametrize("seed", range(6))
def test_plan(seed):
    rng = random.Random(seed)
    capacity = rng.choice([64, 256, 2048])
    counts = {s: rng.randint(1, 40) for s in rng.sample(range(1, capacity + 1), min(50, capacity))}
    table, sequences = packing.plan(counts, capacity)
    check(table, sequences, counts, capacity)
    assert sequences <= best_fit_decreasing(counts, capacity) * 1.03 + 1


def test_hard_sizes():
    """Three of one size fill a sequence, where taking the largest first would mix badly."""
    counts = {1024: 100, 683: 0, 682: 300, 341: 300}
    counts = {s: n for s, n in counts.items() if n}
    table, sequences = packing.plan(counts, 2048)
    check(table, sequences, counts, 2048)
    assert sequences == 200
    assert packing.plan({}, 2048)[1] == 0


def test_documents(spark):
    rng = random.Random(1)
    texts = ["word " * rng.randint(0, 900) for _ in range(60)] + ["", None, "one two " * 6000, "same", "same"]
    rows = [(i if i != 3 else None, t, i) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, sequence_id int")
    got = packing.pack_documents(docs, PATH).collect()
    library = Tokenizer.from_file(PATH)
    expected = {}
    for doc, text, _ in rows:
        ids = np.array(library.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        expected[doc] = ids
    pieces = {}
    for r in got:
        ids = expected[r.doc_id][r.start : r.start + r.length]
        assert len(ids) == r.length <= 2048 and zlib.crc32(ids.tobytes()) == r.ids_crc32
        pieces.setdefault(r.doc_id, []).append((r.piece, r.start, r.length))
    for doc, found in pieces.items():
        found.sort()
        assert [p for p, _, _ in found] == list(range(len(found)))
        assert sum(n for _, _, n in found) == len(expected[doc])
        assert all(n == 2048 for _, _, n in found[1:])
    assert set(pieces) == set(expected)
    inside = {}
    for r in got:
        inside.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in inside.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 2048
    total = sum(map(len, expected.values()))
    assert len(inside) <= total / 2048 + 2
    assert packing.pack_documents(docs.limit(0), PATH).count() == 0
