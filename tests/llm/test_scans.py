import hashlib
import random
import re

from quarryline.llm import licenses, secrets

HEX = "0123456789abcdef"
ODD = [
    "", None, "password=ab token=abcdefgh", "password=token:abcdefg", 'API_KEY" : "Abc/+=.-_9xyz', "aPiKeY=  'q1w2e3r4'", "tokens = abcdef",
    "AKIA" + "B" * 15, "AKIA" + "B" * 16, "xAKIA" + "A1" * 20 + "z", "g" + "a" * 24 + "g", "a" * 23, "ſecret=abcdefgh", "é secret = 'abcdef' é",
    "token: " + "ab12" * 12, "secret=" + "c" * 30000,
]


def corpus():
    rng = random.Random(8)
    texts = list(ODD)
    for i in range(300):
        word = "".join(rng.choice("abcdefgh") for _ in range(6))
        texts.append(f"{word} {word} file{i}_of_many_words_2024 {word}")
        if i % 2:
            texts[-1] += ' token = "' + "".join(rng.choice(HEX) for _ in range(40)) + '"'
    texts += ["here " + "".join(rng.choice("0123456789ABCDEF") for _ in range(40)) + " there", ODD[2]]
    return texts


def brute(text):
    found = []
    for m in re.finditer(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']? *[:=] *["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m.group(2)) >= 6:
            found.append((m.start(), 0, m.end()))
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 24]
    return sorted(found)


def test_secrets(spark):
    texts = corpus()
    docs = spark.createDataFrame([(i if i != 4 else None, t, "s") for i, t in enumerate(texts)], "doc_id long, text string, spans string")
    formats = secrets.train(docs)
    got = {r.doc_id: r for r in secrets.scan(docs, formats).collect()}
    assert len(got) == len(texts)
    names = ("assign", "access", "hex")
    for i, text in enumerate(texts):
        r, base = got[i if i != 4 else None], brute(text or "")
        joined = ",".join(f"{names[k]}:{a}:{b}" for a, k, b in base)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest(), text[:50]
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(s[1] == k for s in base) for k in range(3))
        assert set(filter(None, joined.split(","))) <= set(r.spans.split(","))
    # Capital hexadecimal digits are no detector's; file names are not credentials.
    plain = [r.spans for i, r in got.items() if i is not None and len(ODD) <= i < len(texts) - 2]
    assert not any("format" in s for s in plain)
    assert secrets.scan(docs.limit(0), formats).count() == 0
    assert not secrets.train(docs.limit(0)).kinds


def test_automata_tell_formats_apart():
    rng = random.Random(1)
    labelled = ["".join(rng.choice(HEX) for _ in range(40)) for _ in range(500)]
    learned = secrets.learn(labelled)
    assert len(learned.to) < 120
    assert learned.log_likelihood("".join(rng.choice(HEX) for _ in range(40))) / 41 > -1.0
    formats = secrets.Formats([labelled], [])
    assert sum(formats.likely("".join(rng.choice(HEX) for _ in range(40))) for _ in range(100)) > 90
    for other in ("".join(rng.choice(HEX) for _ in range(25)), "A" * 40, "ab_cd-ef12" * 4, "".join(rng.choice(HEX) for _ in range(41))):
        assert not formats.likely(other)


def test_redact(spark):
    rows = [(1, 'a token = "abcdef123456" b', 26, "k"), (2, None, 9, "k"), (3, "clean", 5, "k"), (4, "secret=" + "ab" * 20, 47, "k")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long, _clean string")
    got = {r.doc_id: r for r in secrets.redact(docs, secrets.train(docs)).collect()}
    assert got[1].text == 'a [SECRET]" b' and got[1].n_chars == 13
    assert (got[2].text, got[2].n_chars) == (None, 9) and got[3].text == "clean" and got[4].text == "[SECRET]"


def brute_places(text):
    words = licenses.plain_words(text or "")
    out = []
    for phrase, label in licenses.PHRASES:
        want = phrase.split(" ")
        out += [(i, label) for i in range(len(words)) if words[i : i + len(want)] == want]
    return words, out


def test_licenses(spark):
    mit = licenses.TEMPLATES[0][1]
    changed = mit.split(" ")
    changed[9:10] = ["someone", "who"]
    texts = [
        "Released under the MIT License.", "x " * 5 + "UNDER-THE.mit/LICENSE under the mit license", "Licensed under the Apache License, Version 2.0.",
        "CC BY-NC 4.0 cc by nc", "", None, "one", "under the mit", "a b c d e f", mit, "words before " + " ".join(changed) + " after",
        "This work is licensed under the GNU General Public License, version 3.", "éÉ ÀB under the mit license É", "word " * 30000 + "cc by nc",
        "cc by nc " * 3000, "Licensed under the terms of the contract between us",
    ]
    rows = [(i if i != 7 else None, t, "z") for i, t in enumerate(texts)] + [(0, texts[1], "again")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, label string").repartition(3)
    got = licenses.scan(docs).collect()
    assert len(got) == len(rows)
    expected = []
    for doc, text, _ in rows:
        words, places = brute_places(text)
        starts = [i for i, _ in places]
        expected.append((doc, len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places}))))
    key = lambda x: tuple(str(v) for v in x)
    assert sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got), key=key) == sorted(expected, key=key)
    by_text = {r.doc_id: r for r in got if r.doc_id != 0}
    assert by_text[9].labels == "mit" and by_text[10].labels == "mit" and by_text[11].labels == "gpl" and 0.6 <= by_text[10].score < 1
    assert by_text[15].labels == "" and all(0 <= r.score <= 1 for r in got)
    assert licenses.scan(docs.limit(0)).count() == 0


def test_licence_spans_are_verified(spark):
    """A name that is repeated covers its k-grams once; a copy with words put in here and there is still found."""
    name, gpl = "GNU General Public License ", licenses.plain_words(licenses.TEMPLATES[3][1])
    spread = " ".join(w + (" one more" if i in (9, 18) else "") for i, w in enumerate(gpl))
    far = " ".join(gpl[20:]) + " and " + " ".join(gpl[:20])  # both halves stand there, in the wrong order
    texts = ["see the GNU General Public License or the GNU General Public License", name * 3, name * 2000, spread, far, licenses.TEMPLATES[2][1]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.labels, round(r.score, 3)) for r in licenses.scan(docs).collect()}
    n = len(gpl) - 2
    assert got[0] == ("", 0.429) and got[1] == got[2] == ("", 0.286)
    assert got[3] == ("gpl", round((n - 4) / n, 3)) and got[4] == ("gpl", round(18 / n, 3)) and got[5] == ("gpl", 1.0)


def test_every_word_of_the_labelled_alphabet_is_scored(spark):
    """Bare credentials that are short, all digits or dotted, and words around a detector's span."""
    rng = random.Random(3)
    few = lambda chars, n: "".join(rng.choice(chars) for _ in range(n))
    makes = [
        lambda: few("0123456789", 9), lambda: few("ABCDEFGH", 3) + few("0123456789", 4) + few("ABCDEFGH", 1),
        lambda: ".".join(few("ABCDEFGH", 4) + few("0123456789", 3) for _ in range(3)), lambda: "zz-" + few(HEX, 24) + "-QQ9",
    ]
    prose = lambda: " ".join(few("abcdefgh", rng.randint(3, 11)) for _ in range(12))
    learned = [f'{prose()}. token = "{make()}" {prose()}' for make in makes for _ in range(200)]
    bare = [make() for make in makes for _ in range(20)]
    docs = spark.createDataFrame([(t,) for t in learned], "text string").selectExpr("0L AS doc_id", "text")
    formats = secrets.train(docs)
    found = []
    for word in bare:
        for text in (f"{prose()} {word} {prose()}", f"{prose()} {word}. {prose()}"):
            start = text.index(word)
            found.append((start, 3, start + len(word)) in formats.spans(text)[1])
    assert sum(found) >= 0.9 * len(found)
    assert not any(kind == 3 for _ in range(200) for _, kind, _ in formats.spans(prose() + ". " + prose())[1])
    masked = secrets.redact(spark.createDataFrame([(0, f"x {bare[-1]} y")], "doc_id long, text string"), formats).head().text
    assert masked == "x [SECRET] y"
    # The sample doesn't depend on how the rows are cut into tasks.
    one, many = (secrets.train(docs.repartition(n), 40) for n in (1, 7))
    assert [k[0].count for k in one.kinds] == [k[0].count for k in many.kinds] and one.background.count == many.background.count
