import random
import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from veilwork.llm import abuse, leakage, lookalike, mojibake, pieces, pii, tokens

WIDE = "".join(chr(ord(c) + 0xFEE0) for c in "Chen10")


# ---- 1: wrong encoding -----------------------------------------------------------------

def test_mojibake_found_and_restored(spark, monkeypatch):
    clean = ["Körper übel, café “ok” – naïve", "mañana está, Ménière", "привет больной", "Sjögren über Körper"] * 4
    bad = {
        100: ("Körper übel".encode().decode("cp1252"), "Körper übel"),
        101: ("café “ok”".encode().decode("latin_1"), "café “ok”"),
        102: ("naïve".encode().decode("cp437"), "naïve"),
        103: ("Körper".encode("cp1252").decode("utf-8", "replace"), "Körper"),
        104: ("mañana".encode("cp1252").decode("cp1251"), "mañana"),
        105: ("café".encode().decode("cp1252").encode().decode("cp1252"), "café"),
        106: ("привет".encode().decode("cp1251"), "привет"),
        107: ("Ménière".encode().decode("mac_roman"), "Ménière"),
    }
    rows = [(n, t, "x") for n, t in enumerate(clean)] + [(n, t, "x") for n, (t, _) in bad.items()]
    rows += [(200, None, "x"), (201, "", "x"), (202, "   ", "x"), (203, "É” and VERSÃO, Å ½ № → 1·5", "x"), (204, "é" * 50_000, "x"), (100, bad[100][0], "x")]
    df = spark.createDataFrame(rows, "id long, text string, unit string")
    assert {r.id for r in mojibake.find_garbled(df).collect()} == set(bad)
    restored = {r.id: r.text for r in mojibake.restore(df).collect()}
    assert {n: restored[n] for n in bad} == {n: t for n, (_, t) in bad.items()} and set(restored) == set(bad)
    monkeypatch.setattr(mojibake, "BROADCAST_ROWS", 0)  # beyond the bound the fixes are joined
    joined = {r.id: r.text for r in mojibake.restore(df.unionByName(spark.createDataFrame([(None, bad[100][0], "x")], df.schema))).collect()}
    assert joined == restored | {None: bad[100][1]}


def test_units_inside_longer_words_stay():
    words, runs = {"StraЯe": "Straße"}, {"Ã©": "é"}
    assert mojibake.repaired("XXStraЯeYY StraЯe, cafÃ© Ã©", words, runs) == "XXStraЯeYY Straße, café é"


def test_quoted_accent_is_not_garbled(spark):
    """An accent before a closing quote reads like the bytes of an ideograph, which is rarer."""
    rows = [(n, f"a “café” and more {n}") for n in range(40)] + [(50, "锚 one"), (51, "锚 two")]
    assert mojibake.find_garbled(spark.createDataFrame(rows, "id long, text string")).collect() == []


def test_pruned_chains_lose_no_form_of_known_characters():
    known = frozenset("Ã©Â±¤茅CafKörperübel“”–â€œ™éñ�" + "".join(map(chr, range(128))))
    for unit in ("Café", "Körper", "“", "mañana", "—", "привет", "é"):
        full = {f: c for f, c in mojibake.garbled_forms(unit).items() if known.issuperset(f)}
        assert {f: c for f, c in mojibake.garbled_forms(unit, known).items() if known.issuperset(f)} == full, unit


def test_mojibake_empty_table(spark):
    df = spark.createDataFrame([], "id long, text string")
    assert mojibake.find_garbled(df).collect() == [] and mojibake.restore(df).collect() == []


def test_form_hash_is_that_of_spark(spark):
    from pyspark.sql import functions as F

    words = ["", "é", "Ã©", "“long” word ünd 漢字"]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    assert [r[0] for r in df.select(F.xxhash64("w")).collect()] == [mojibake.form_hash(w) for w in words]


# ---- 2: personal information ------------------------------------------------------------

@pytest.fixture(scope="module")
def model():
    return pii.train([], set(), set())


def test_pii_from_the_seeds_alone(spark, model):
    shared = spark.sparkContext.broadcast(model)
    rows = [
        (1, "Reachable at peter.hallow@mail.example most evenings."),
        (2, "Call +1 (555) 555-0142 after six."),
        (3, "MRN: 5512345 checked."),
        (4, "Lives at 44 Birch Road, Westford."),
        (5, "Discussed with Dr. Okafor."),
        (6, None), (7, ""), (8, "  \n"), (9, "[REDACTED] seen."), (10, "BP 120/80, pulse 70."), (11, "word " * 30_000),
        (1, "Reachable at peter.hallow@mail.example most evenings."),
    ]
    df = spark.createDataFrame([(*r, "NAME") for r in rows], "id long, text string, kind string")
    found = {(r.id, r.kind) for r in pii.find_kinds(df, shared).collect()}
    assert {(1, "EMAIL"), (2, "PHONE"), (3, "ID_NUMBER"), (4, "ADDRESS"), (5, "NAME")} <= found
    assert not {n for n, _ in found} & {6, 7, 8, 9, 10, 11} and (1, "NAME") not in found
    masked = {r.id: r.masked for r in pii.mask_entities(df, shared).collect()}
    assert masked[1] == "Reachable at [EMAIL] most evenings." and masked[6] is None and masked[8] == "  \n"
    assert masked[11] == rows[10][1] and masked[10] == rows[9][1]


def test_pii_keeps_all_else_in_stored_form(model):
    text = "½ Zoë… Discussed with Dr. " + WIDE[:4] + "​ – done"
    folded, back = pii.fold_map(text)
    assert len(back) == len(folded) + 1 and back[-1] == len(text)
    (parts,) = pii.label_texts(model, [folded])
    spans = pii.entities(folded, *parts)
    assert all(0 <= back[a] < back[b] <= len(text) for a, b, _ in spans)


def test_pii_alignment():
    text = "Mr. John Smith (555-555-0101) came.\n"
    assert pii.align("Mr. [REDACTED] ([REDACTED]) came.", text) == [(4, 14, "NAME"), (16, 28, "PHONE")]
    assert pii.align("Something else", text) is None


def test_crf_links_pull_repeated_tokens(model):
    toks = pii.tokenize("Mr. Auer left. auer's dog, Auer again, the the")[0]
    assert sorted((toks[a], toks[b]) for a, b in pii.skip_links(toks)) == [("Auer", "Auer"), ("Auer", "auer's"), ("auer's", "Auer")]


def test_crf_marginals_against_brute_force():
    import itertools

    import numpy as np

    from veilwork.llm.crf import SkipChainCRF

    rng = np.random.default_rng(1)
    crf = SkipChainCRF(["O", "A", "B"], lambda t: [])
    crf.trans, crf.start, crf.skip = rng.normal(size=(3, 3)), rng.normal(size=3), 0.0
    e = rng.normal(size=(5, 3))
    want, z = np.zeros((5, 3)), 0.0
    for y in itertools.product(range(3), repeat=5):
        p = np.exp(crf.start[y[0]] + sum(e[i, y[i]] for i in range(5)) + sum(crf.trans[y[i], y[i + 1]] for i in range(4)))
        z += p
        for i in range(5):
            want[i, y[i]] += p
    got = crf.marginals([(e, []), (e[:2], [])], np.arange(3))
    assert np.allclose(got[0], want / z, atol=1e-6)
    crf.skip = 1.0
    linked = crf.marginals([(e, [(0, 4)])], np.arange(3))[0]
    assert np.allclose(linked.sum(1), 1) and not np.allclose(linked, got[0])


def test_long_runs_are_encoded_data_only_by_content():
    import base64
    import hashlib

    for text, part in (
        ("Name=John-Smith;Tel=555-555-0142;MRN=4412345", "John"), ("Name=John-Smith;Tel=555-555-0142;MRN=4412345", "555"),
        ("https://clinic.example/find?name=JohnSmith&tel=555-555-0142&mrn=4412345", "555"), ("/patients/JohnSmith/MaryJones/PeterHallow/NoraQuell/", "Mary"),
        ("患者の名前は山田太郎で電話番号は0312345678です。" * 3, "0312345678"),
    ):
        assert not pii._in_blob(text, text.index(part)), text
    data = hashlib.sha512(b"x").digest()
    for blob in (base64.b64encode(data).decode(), data.hex(), "1234567890" * 5):
        assert all(pii._in_blob(f"see {blob} here", 4 + at) for at in range(0, len(blob), 5))


def test_fold_map_places_long_chunks(spark):
    """Masks cut exactly the stretch, however long the chunk without spaces."""
    from hypothesis import strategies as st

    pad = "é" * 30 + "\u200b" * 7 + "ｘｙ" * 20
    text = f"{pad},Nora​;{pad}"
    folded, back = pii.fold_map(text)
    a = folded.index("Nora")
    assert text[back[a] : back[a + 4 - 1] + 1] == "Nora" and len(back) == len(folded) + 1

    @settings(max_examples=150, deadline=None)
    @given(st.text(alphabet=st.sampled_from("aB1,é\u0301\u200bｘ　ο"), max_size=120))
    def whole(t):
        folded, back = pii.fold_map(t)
        assert folded == "".join(lookalike.canonical(m) for m in __import__("re").findall(r"\s+|\S+", t))
        assert len(back) == len(folded) + 1 and back == sorted(back) and all(p < len(t) for p in back[:-1])

    whole()


PROBES = ("export:Quell,Nora;phone=555-555-0142;ssn=900-12-3456;mrn=4412345;next=1", "https://x.example/find?name=NoraQuell&phone=555-555-0142&ssn=900-12-3456")


def test_entities_in_unbroken_runs(model):
    for text in PROBES:
        (parts,) = pii.label_texts(model, [text])
        found = [text[a:b] for a, b, _ in pii.entities(text, *parts)]
        assert any("555-555-0142" in f for f in found) and any("900-12-3456" in f for f in found), found


def test_blocks_give_what_whole_chains_give(model):
    import numpy as np

    from veilwork.llm import crf

    line = "Seen by Dr. Quorvex at 12 Elm Street, call 555-555-0142 or MRN 7788123 and so on. "
    toks, starts, ends = pii.tokenize(line * 60)
    (field,) = model.emissions([(toks, pii.positional(line * 60, toks, starts, ends))])
    rng = np.random.default_rng(2)
    for e in (field, np.zeros_like(field), rng.normal(0, 1, field.shape).astype(np.float32)):
        (blocks,) = model._chains([e])
        (whole,) = model._batch([e], np.array([True]))
        assert np.abs(blocks - whole).max() < 1e-6
    assert len(toks) > 4 * (crf.BLOCK + crf.CONTEXT)


def test_a_link_decides_where_the_words_around_do_not():
    """A clear mention settles doubtful ones of its group, also through another; unlinked tokens keep their marginals."""
    import numpy as np

    from veilwork.llm.crf import SkipChainCRF

    crf = SkipChainCRF(["O", "A", "B"], lambda t: [])
    crf.pair = np.array([[0.0, -0.7, -0.7], [-0.7, 2.0, -0.7], [-0.7, -0.7, 2.0]])
    e = np.tile(np.array([4.5, 0.0, 0.0]), (30, 1))
    e[3] = [0, 8, 0]
    e[12] = e[25] = [2.0, 0.0, 0.0]

    def marginals(weight):
        crf.skip = weight
        return crf.marginals([(e, [(3, 12), (12, 25)])], np.arange(3))[0]

    none, some, much = map(marginals, (0.0, 0.5, 1.0))
    for k in (12, 25):
        assert none[k, 1] < some[k, 1] < much[k, 1] and none[k].argmax() == 0
    assert much[12].argmax() == 1 and np.allclose(none[:3], much[:3])


def test_link_potential_is_learnt():
    import numpy as np

    pair = pii.link_potential(pii._seed_examples())
    name = pii.LABELS.index("NAME")
    assert np.allclose(pair, pair.T) and pair[name, name] > 0 > pair[0, name]


# ---- 3: look-alikes ----------------------------------------------------------------------

SAME = [
    ("Chen10 ok", WIDE + " ok"),
    ("café au lait", unicodedata.normalize("NFD", "café au lait")),
    ("a b", "a b"), ("a b", "a　b"), ("patient", "pa​tie﻿nt"), ("patient", "pаtіеnt"),
    ("10 µg", "10 μg"), ("Ελένη", "Eλένη"), ("Москва", "Mосква"), ("ᄒ ok", "ᄒ​ ok"),
]
OTHER = [("cafe", "café"), ("Ab", "ab"), ("m²", "m2"), ("½", "1/2"), ("Fuß", "Fuss"), ("a\nb", "a b"), ("…", "..."), ("№", "No")]


def test_lookalikes():
    assert all(lookalike.canonical(a) == lookalike.canonical(b) for a, b in SAME)
    assert all(lookalike.canonical(a) != lookalike.canonical(b) for a, b in OTHER)
    assert lookalike.canonical("Mосква") == "Москва" and lookalike.canonical("pаtіеnt") == "patient"
    assert lookalike.canonical("plain ASCII\n") == "plain ASCII\n"


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.sampled_from("aeé́̈o​оаиμµ  ＡΩÅｶﾞ²½ß각각xñ"), max_size=14))
def test_splicing_equals_whole_normalisation(text):
    """Segments against the same mapping applied to the whole text at once."""
    single, _, words = lookalike._tables()
    whole = unicodedata.normalize("NFD", text.translate(single)).translate(lookalike._TO_LATIN)
    whole = unicodedata.normalize("NFC", whole)
    assert lookalike.canonical(text) == words.sub(lookalike._word, whole)
    assert lookalike.canonical(lookalike.canonical(text)) == lookalike.canonical(text)


def test_pairs(spark):
    rows = [(1, "café", "a"), (2, unicodedata.normalize("NFD", "café"), "a"), (3, "café", "a"), (4, "cafe", "a"), (5, None, "a"), (6, " ", "a"), (7, " ", "a"), (None, "café", "a")]
    df = spark.createDataFrame(rows, "id long, text string, canonical string")
    assert {tuple(r) for r in lookalike.equal_pairs(df).collect()} == {(1, 2), (2, 3)}
    assert lookalike.equal_pairs(df.limit(0)).collect() == []
    out = lookalike.canonicalize(df.select("id", "text")).collect()
    assert [r.canonical for r in out if r.id == 5] == [None]


# ---- 4: pieces ---------------------------------------------------------------------------

def test_strongest_cut_rightmost():
    text = "aaaa. bbb\n\ncccc dd. ee ffff" + "g" * 30
    bounds = pieces.cut(text, 20, 3)
    assert text[: bounds[0][1]].endswith("\n\n")
    assert bounds[0][0] == 0 and bounds[-1][1] == len(text)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab.。 \n\r", max_size=300), st.integers(8, 40), st.integers(0, 7))
def test_pieces_against_brute_force(text, limit, overlap):
    got, strength = pieces.cut(text, limit, overlap), pieces.strengths(text)
    want, start = [], 0
    while len(text) - start > limit:
        near = range(max(start + limit // 2, start + overlap + 1), start + limit + 1)
        wide = range(start + overlap + 1, start + limit + 1)
        window = near if max(strength[p] for p in near) else wide
        top = max(strength[p] for p in window)
        end = max(p for p in window if strength[p] == top) if top else start + limit
        want.append((start, end))
        start = end - overlap
    want.append((start, len(text)))
    assert got == want
    assert text == text[: got[0][1]] + "".join(text[a + overlap : b] for a, b in got[1:])
    assert all(b - a <= limit for a, b in got)


def test_piece_rows(spark):
    rows = [(1, None, 9), (2, "", 9), (3, "short", 9), (4, "x" * 25_000, 9), (4, "x" * 25_000, 9)]
    df = spark.createDataFrame(rows, "id long, text string, piece int")
    out = pieces.split_pieces(df).collect()
    assert [(r.id, r.piece_no, r.piece) for r in out if r.id < 4] == [(1, 0, None), (2, 0, ""), (3, 0, "short")]
    assert sorted(len(r.piece) for r in out if r.id == 4) == [5400, 5400, 10000, 10000, 10000, 10000]
    assert pieces.split_pieces(df.limit(0)).collect() == []


# ---- 6: tokens ---------------------------------------------------------------------------

PATH = f"{tokens.TOKENIZER_DIR}/{tokens.VOCABULARY}"


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab1 .'\n\t é漢🙂 \x1cs<|>"), max_size=400), st.integers(4, 60))
def test_tree_equals_direct_encoding(text, leaf):
    enc = tokens.encoder(PATH, leaf)
    ids = enc.encode(text).tolist()
    assert ids == enc.encoding.encode_ordinary(text) and enc.decode(ids) == text


def test_tokens_of_odd_texts(spark):
    rows = [(1, None), (2, ""), (3, "<|endoftext|>"), (4, " " * 50_000 + "x"), (5, "a" * 100_000), (3, "<|endoftext|>")]
    df = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, n int")
    out = tokens.encode_corpus(df).collect()
    by = {r.doc_id: r.ids for r in out}
    assert len(out) == 6 and by[1] == [] and by[2] == [] and 50256 not in by[3]
    enc = tokens.encoder(PATH)
    assert enc.decode(by[4]) == rows[3][1] and enc.decode(by[5]) == rows[4][1]
    assert tokens.encode_corpus(df.limit(0)).collect() == []


# ---- 7: leakage --------------------------------------------------------------------------

def _passage(seed: int, n: int) -> list[str]:
    rng = random.Random(seed)
    return ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(3, 7))) for _ in range(n)]


def test_leaks(spark):
    item, other = _passage(1, 80), _passage(2, 60)
    items = [(1, "Do as told. " + " ".join(item) + ".", "s"), (2, "Do as told. " + " ".join(other) + ".", "s"), (3, None, "s"), (4, "", "s")]
    fill = _passage(3, 400)
    noisy = item[10:40]
    noisy[6], noisy[15] = "changed", "words"
    del noisy[22]
    docs = [
        (1, " ".join(fill[:50] + item[20:50] + fill[50:90])),
        (2, "> **" + " ".join(noisy).upper().replace(" ", ",\n> ") + "**"),
        (3, " ".join(item[20:40])),
        (4, " ".join(sorted(item))),
        (5, "Do as told. " + " ".join(fill)),
        (6, None), (7, ""), (8, " ".join(fill * 60) + " " + " ".join(other[5:50])),
        (9, "Do as told. " + " ".join(item[:20]) + " -- Page 2 of 9 -- " + "\\n".join(item[20:40])),
        (1, " ".join(fill[:50] + item[20:50] + fill[50:90])),
    ]
    d = spark.createDataFrame([(*r, "s") for r in docs], "doc_id long, text string, suite string")
    i = spark.createDataFrame(items, "item_id long, text string, suite string")
    assert {tuple(r) for r in leakage.leaks(d, i).collect()} == {(1, 1), (2, 1), (8, 2), (9, 1)}
    assert leakage.leaks(d.limit(0), i).collect() == [] and leakage.leaks(d, i.limit(0)).collect() == []


def test_seed_inside_a_short_stretch_is_extended():
    layout = ".....xx............xx.....x.....xx..........x."
    item = [f"w{k}" for k in range(len(layout))]
    doc = [w if c == "." else "zz" for w, c in zip(item, layout)]
    assert leakage.leaked_items(doc, leakage.ItemIndex([(1, item)])) == [1]


def test_tags_of_any_case_are_one_word():
    for tag in ("[REDACTED]", "[redacted]", "[Redacted]", "[Name]", "[PERSON_1]", "[person_1]", "[Patient Name]"):
        assert leakage.words(f"seen by {tag} today") == ["seen", "by", leakage.TAG, "today"], tag
    for plain in ("see [1] today", "[12] and", "level [4.5 mg]", "- [x] done"):
        assert leakage.TAG not in leakage.words(plain), plain
    item = _passage(5, 30)
    for k in (3, 9, 15, 21):
        item[k] = "[REDACTED]"
    index = leakage.ItemIndex([(1, leakage.words(" ".join(item)))])
    assert leakage.leaked_items(leakage.words(" ".join(item).lower()), index) == [1]


def test_items_beyond_the_index_are_joined(spark, monkeypatch):
    item = [(n, " ".join(_passage(n, 40))) for n in range(5)] + [(2, " ".join(_passage(77, 40))), (None, "x"), (9, None), (8, "")]
    docs = [(n, t + " end") for n, t in item[:6]] + [(None, item[1][1]), (30, None), (31, ""), (30, item[4][1] + " " + item[0][1])]
    d = spark.createDataFrame([(*r, 1) for r in docs], "doc_id long, text string, item_id int")
    i = spark.createDataFrame(item, "item_id long, text string")
    want = {(0, 0), (1, 1), (2, 2), (3, 3), (4, 4), (None, 1), (30, 0), (30, 4)}
    assert {tuple(r) for r in leakage.leaks(d, i).collect()} == want
    monkeypatch.setattr(leakage, "INDEX_FINGERPRINTS", 50)
    assert {tuple(r) for r in leakage.leaks(d, i).collect()} == want
    assert leakage.leaks(d.limit(0), i).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10_000), st.integers(25, 60), st.integers(0, 3))
def test_every_passage_with_three_changes_is_found(seed, size, changes):
    rng, item = random.Random(seed), _passage(seed, 120)
    at = rng.randint(0, 120 - size)
    part = item[at : at + size]
    for p in rng.sample(range(1, size - 1), changes):
        part[p] = "zz"
    index = leakage.ItemIndex([(1, item)])
    doc = _passage(seed + 1, 40) + part + _passage(seed + 2, 40)
    assert leakage.leaked_items(doc, index) == ([1] if size >= 25 else [])


@given(st.lists(st.sampled_from("abcd"), max_size=40), st.integers(1, 5))
def test_winnowing_covers_every_window(seq, window):
    h, at = leakage.fingerprints(seq, 3, window)
    full, _ = leakage.fingerprints(seq, 3, 1)
    assert all(full[p] == x for p, x in zip(at, h))
    for a in range(len(full) - window + 1):
        assert min(full[a : a + window]) in set(h[(at >= a) & (at < a + window)])


# ---- 8: abuse ----------------------------------------------------------------------------

def test_abuse(spark):
    ordinary = [("The patient walked twenty metres and was well. Bloods were taken in the morning. She felt stupid for missing a dose.", 0)] * 5
    model = abuse.train(ordinary)
    shared = spark.sparkContext.broadcast(model)
    rows = [
        (1, "a", "The patient walked twenty metres and was well."),
        (2, "a", "Bloods were taken. You are a stupid idiot and everyone knows it. Bloods were taken."),
        (3, None, "YOU ARE A W-O-R-T-H-L-E-S-S P1ECE OF TRASHHHHH"),
        (4, "b", None), (5, "b", ""), (6, "b", "  "), (7, "b", "Bloods were taken in the morning. " * 5000),
        (2, "a", "Bloods were taken. You are a stupid idiot and everyone knows it. Bloods were taken."),
    ]
    df = spark.createDataFrame([(*r, 1.0) for r in rows], "doc_id long, source string, text string, score double")
    out = abuse.score_documents(df, shared).collect()
    assert len(out) == len(rows) and {r.doc_id for r in out if r.concerned} == {2, 3}
    assert {r.doc_id: r.score for r in out if r.doc_id in (4, 5, 6)} == {4: 0.0, 5: 0.0, 6: 0.0}
    assert abuse.score_documents(df.limit(0), shared).collect() == []


def test_abuse_in_short_sentences():
    model = abuse.train([("The patient walked twenty metres and was well. Bloods were taken in the morning.", 0)] * 5)
    lost = ["Fuck you!", "You idiot!", "Arschloch!", "f u c k y o u", "blöde Fotze", "ti ammazzo", "死ね、クズ", "お前は馬鹿だ", "殺してやる", "去死吧，你这个白痴", "死ね", "Bloods were taken. Fuck you. All well."]
    assert [t for t in lost if model.score(t) < model.threshold] == []
    for t in ("Tel.", "No pain.", "All well.", "Mrs. Fox.", "Danke.", "患者は元気です。熱はない。", "..", "m"):
        assert model.score(t) < model.threshold, t
    seeds = abuse._seed_windows()
    assert all(s in seeds for t in ("死ね", "殺してやる", "操你妈", "ti ammazzo") for s in abuse.sentences(t)) and "死ね" in model.toxic.decode()


#: Runs of four words in the seeds that any text in anger may hold.
IDIOMS: set[str] = set()


def test_seeds_do_not_follow_the_tables(spark):
    import re

    words = lambda t: re.findall(r"[^\W_]+", t.lower())
    runs = {" ".join(w[k : k + 4]) for w in map(words, abuse.sentences(abuse.SEEDS)) for k in range(len(w) - 3)} - IDIOMS
    assert max(len(words(s)) for s in abuse.sentences(abuse.SEEDS)) <= 4
    for row in spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where("text IS NOT NULL").select("text").toLocalIterator():
        flat = " ".join(words(row.text))
        assert not [r for r in runs if f" {r} " in f" {flat} "], row.text[:200]


def test_abuse_is_learnt_from_labels(spark):
    """What no seed holds is found where labelled documents hold it, on the same scale for every window."""
    fill = [f"The patient in bay {n} slept, ate {w} and asked for the {v}." for n, w in enumerate(("soup", "bread", "rice", "fish")) for v in ("nurse", "radio", "window", "clock")]
    bad = "may the moths of the cellar gnaw your rotten bones, idiot"
    docs = [(n, f"{fill[n % 16]} {bad if n % 4 == 0 else fill[(n + 3) % 16]}. {fill[(n + 5) % 16]}", n % 4 == 0) for n in range(200)]
    d = spark.createDataFrame([(n, t, "s") for n, t, _ in docs] + [(900, None, "s")], "doc_id long, text string, source string")
    labels = [(n, 1, int(y)) for n, _, y in docs] + [(1, 1, None), (None, 1, 1), (900, 1, 1), (2, 1, 1)]
    model = abuse.fit_from_tables(d, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert "moths of the cellar" in model.toxic.decode() and "moths" not in model.ordinary.decode()
    assert model.score("Then may the moths of the cellar gnaw your rotten bones.") >= model.threshold > model.score(fill[3])
    empty = abuse.fit_from_tables(d.limit(0), spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    assert empty.threshold == abuse.DEFAULT_THRESHOLD and empty.score("you idiot") >= empty.threshold


def test_abuse_learns_from_all_labels(spark):
    """Wording of labelled documents beyond any number of them counts, and the tables give what the fit in memory gives."""
    from pyspark.sql import functions as F

    ids = [r.id for r in spark.range(1300).orderBy(F.xxhash64("id"), "id").collect()]
    bad = {n: "may the moths of the cellar gnaw your rotten bones, idiot" if k >= 1100 else "you are an idiot" for k, n in enumerate(ids)}
    docs = [(n, f"The patient in bay {'abcdefghij'[n % 10]} slept. {bad[n]}.", 1) for n in ids]
    docs += [(n, f"The patient in bay {'abcdefghij'[n % 10]} slept and ate {'bread' if n % 3 else 'rice'}. The moths were gone.", 0) for n in range(2000, 2400)]
    d = spark.createDataFrame([r[:2] for r in docs], "doc_id long, text string")
    model = abuse.fit_from_tables(d, spark.createDataFrame([(n, 1, y) for n, _, y in docs], "doc_id long, quality int, toxic int"))
    assert "moths of the cellar" in model.toxic.decode()
    in_memory = abuse.train([(t, y) for _, t, y in docs])
    assert (model.toxic, model.ordinary) == (in_memory.toxic, in_memory.ordinary)
    scored = [(0.5, 3, 0), (0.1, 1, 0), (0.0, 1, 9), (-0.1, 0, 5)]
    assert abuse.calibrated(scored) == 0.05 and abuse.calibrated([]) == abuse.DEFAULT_THRESHOLD


@given(st.text(alphabet="ab c.!?:;\"')]\n\t\x1c 03@$-…“é\u2028Ω。", max_size=14), st.sampled_from(("", ". ", "! ", '." ', ".\n", ".")))
def test_abuse_breaks_need_no_pattern_in_lone_sentences(text, end):
    """A text whose only break is its end is not split by the general pattern, and comes out the same."""
    normal = abuse.normal_text(text + end)
    general = abuse._BREAK.split(normal) if abuse._BREAKS_HINT.search(normal) else [normal.rstrip(".!?…")]
    assert abuse.sentences(text + end) == [s for part in general for s in abuse._cleaned(part)]


def test_abuse_scores_each_wording_once(monkeypatch):
    model = abuse.train([])
    monkeypatch.setattr(abuse, "_BREAK", None)
    count, score = [], model.window_score
    model.window_score = lambda window: count.append(window) or score(window)
    for name in ("Ward: the patient slept well. ", "the patient  slept well.\n", "The patient slept well.", "THE PATIENT SLEPT WELL.\n\n"):
        assert model.score(name) < model.threshold
    assert sorted(count) == ["patient slept", "slept well", "the patient", "the patient slept well"]


def test_abuse_inside_long_sentences():
    model = abuse.train([("The patient walked twenty metres and was well. Bloods were taken in the morning.", 0)] * 5)
    around = "the patient walked twenty metres and was well and then "
    for insult in ("you are a stupid idiot and everyone knows it", "shut up you scumbag", "fuck you", "halt die fresse, du arschloch"):
        for t in (f"{around}{insult} and bloods were taken in the morning", f"{around * 9}{insult} {around * 9}", f'He told the nurse on the ward "{insult}" and then asked for water.'):
            assert model.score(t) >= model.threshold, t
    for n in (1, 3, 20):
        assert model.score(around * n) < model.threshold
    text = " ".join(f"w{n}" for n in range(60))
    assert set(" ".join(abuse.parts(text)).split()) == set(text.split()) and abuse.parts("x" * 100)


def test_abuse_respelling():
    assert abuse.respelled("you m o r o n s") == "you morons" and abuse.respelled("asssshole") == "asshole"
    assert abuse.normal_text("B1TCH in 2024") == "bitch in 0"


def test_subpackage_is_not_imported_by_the_rest():
    import pathlib
    import re

    root = pathlib.Path(__file__).resolve().parents[2] / "veilwork"
    for path in root.rglob("*.py"):
        if "llm" not in path.parts:
            assert not re.search(r"veilwork\.llm|from \.+llm|import llm", path.read_text()), path


def test_latin_letters_inside_words_of_another_script():
    assert lookalike.canonical("oΩ") == lookalike.canonical("οΩ") == "οΩ"
