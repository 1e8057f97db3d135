import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from quarryline.llm import bpe, repair

PATH = bpe.public_file("word_bpe_49k.json")


@pytest.mark.parametrize("seed", range(5))
def test_grammar_round_trip(seed):
    rng = np.random.default_rng(seed)
    ids = rng.choice([3, 3, 3, 7, 8, 9, 10], 30_000).astype(np.uint16)
    ids[5000:9000] = 3
    last = rng.random(len(ids)) < 0.01
    last[-1] = True
    symbols, closed, rules = repair.compress(ids, last, 20)
    assert len(rules) and len(symbols) < len(ids) / 2
    assert (repair.expand(symbols, rules, 20) == ids).all()
    # No rule crosses a document's end.
    sizes = [len(repair.expand(part, rules, 20)) for part in np.split(symbols, np.flatnonzero(closed)[:-1] + 1)]
    assert np.cumsum(sizes).tolist() == (np.flatnonzero(last) + 1).tolist()


def test_nothing_repeats():
    ids = np.arange(100, dtype=np.uint16)
    symbols, _, rules = repair.compress(ids, np.arange(100) == 99, 200)
    assert not len(rules) and (symbols == ids).all()
    assert len(repair.expand(symbols[:0], rules, 200)) == 0


def test_phrases_to_the_end():
    """While rules are free, no pair of symbols stands in ``LEAST`` places of one shard."""
    rng = np.random.default_rng(1)
    phrases = rng.integers(0, 40_000, (60, 40)).astype(np.uint16)
    ids = phrases[rng.integers(0, 60, 6_000)].ravel()
    last = np.zeros(len(ids), bool)
    last[999::1000] = True
    symbols, closed, rules = repair.compress(ids, last, 40_000)
    assert 40_000 + len(rules) < repair.SYMBOLS
    assert (repair.expand(symbols, rules, 40_000) == ids).all()
    key = (symbols[:-1].astype(np.uint32) << 16 | symbols[1:])[~closed[:-1]]
    pairs, counts = np.unique(key, return_counts=True)
    same = (pairs >> 16) == (pairs & 0xFFFF)  # places of one symbol in a row overlap
    assert counts[~same].max(initial=0) < repair.LEAST and len(symbols) < len(ids) / 8


@pytest.mark.parametrize("seed", range(6))
def test_no_frequent_pair_is_overlooked(seed):
    """The last rounds look at some places only, and still leave no pair in ``LEAST`` places."""
    rng = np.random.default_rng(seed)
    ids = (rng.zipf(1.3, 40_000) % 300).astype(np.uint16)
    last = rng.random(len(ids)) < 0.02
    last[-1] = True
    symbols, closed, rules = repair.compress(ids, last, 300)
    assert (repair.expand(symbols, rules, 300) == ids).all()
    key = (symbols[:-1].astype(np.uint32) << 16 | symbols[1:])[~closed[:-1]]
    pairs, counts = np.unique(key, return_counts=True)
    same = (pairs >> 16) == (pairs & 0xFFFF)  # places of one symbol in a row overlap
    assert len(rules) > 100 and counts[~same].max(initial=0) < repair.LEAST


def test_random_access_reads_only_its_rules():
    rng = np.random.default_rng(3)
    ids = rng.integers(0, 6, 40_000).astype(np.uint16)
    last = np.arange(len(ids)) % 8000 == 7999
    symbols, closed, rules = repair.compress(ids, last, 10)
    lengths = np.ones(10 + len(rules), np.uint32)
    for k, (a, b) in enumerate(rules.tolist()):
        lengths[10 + k] = lengths[a] + lengths[b]
    counts = np.diff(np.flatnonzero(closed), prepend=-1).tolist()
    row = {"symbol_counts": counts, "symbols": symbols.tobytes(), "terminals": 10, "rule_lengths": lengths[10:].astype("<u4").tobytes()}
    for number, first, n in [(0, 0, None), (4, 0, None), (2, 5000, 7), (2, 7999, 1), (1, 0, 1), (3, 100, 0), (3, 7990, 100)]:
        stop = 8000 if n is None else min(first + n, 8000)
        expected = ids[8000 * number + first : 8000 * number + stop]
        assert (repair.decode_document({**row, "rules": rules.tobytes()}, number, first, n) == expected).all()
    # All rules that the range of (2, 5000, 7) does not reach into may be anything.
    own = symbols[sum(counts[:2]) : sum(counts[:3])].tolist()
    needed, todo, at = set(), [], 0
    for s in own:
        todo.append((s, at))
        at += int(lengths[s])
    while todo:
        s, at = todo.pop()
        if s >= 10 and at < 5007 and at + int(lengths[s]) > 5000:
            needed.add(s - 10)
            a, b = rules[s - 10].tolist()
            todo += [(a, at), (b, at + int(lengths[a]))]
    poisoned = np.full_like(rules, 0xFFFF)
    poisoned[sorted(needed)] = rules[sorted(needed)]
    assert 0 < len(needed) < len(rules) / 4
    assert (repair.decode_document({**row, "rules": poisoned.tobytes()}, 2, 5000, 7) == ids[21_000:21_007]).all()


def test_documents(spark, tmp_path):
    rng = random.Random(2)
    texts = ["The end, " * rng.randint(0, 400) for _ in range(300)] + ["", None, "same", "same"]
    numbers = list(range(len(texts)))
    rng.shuffle(numbers)
    rows = [(n if n else None, t, 1) for n, t in zip(numbers, texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, part int").repartition(5)
    repair.write_ids(docs, PATH, f"{tmp_path}/ids", shard_tokens=3000)
    got = {r.doc_id: r for r in repair.read_ids(spark, f"{tmp_path}/ids").collect()}
    library, start = Tokenizer.from_file(PATH), 0
    expected = {}
    for doc, text, _ in sorted(rows, key=lambda r: -1 if r[0] is None else r[0]):
        ids = np.array(library.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        r = got[doc]
        assert (r.start, r.n_tokens, bytes(r.ids)) == (start, len(ids), ids.tobytes())
        start += len(ids)
        expected[doc] = ids
    shards = spark.read.parquet(f"{tmp_path}/ids").collect()
    assert len(shards) > 1
    for shard in shards:
        for number in (0, len(shard.doc_ids) - 1):
            assert (repair.decode_document(shard, number) == expected[shard.doc_ids[number]]).all()
    digests = {r.doc_id: r.ids_crc32 for r in repair.round_trip(docs, PATH).collect()}
    assert digests == {d: zlib.crc32(x.tobytes()) for d, x in expected.items()}
    assert repair.round_trip(docs.limit(0), PATH).count() == 0
