"""Operators that SQL cannot express, against plain versions of their rules."""
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import zstandard

from ledgerline.llm import arc_warc, brown_lm, compression_rules, decontam, langid, near_dup, packing, toxicity
from ledgerline.llm.common import SPACES, table
from ledgerline.llm.queries import QUERIES, token_file

SF = "/root/testdata/sf0.01"


def fold(doc_id, n):
    return zlib.crc32(str(doc_id).encode()) % n


# ---- language ----------------------------------------------------------------------------------


def plain_ppm(texts, text, order):
    """Bits of ``text`` under method C without exclusion, by direct counting."""
    seen = defaultdict(Counter)
    for t in texts:
        raw = b"\n" * order + t.encode()
        for i in range(order, len(raw)):
            for m in range(order + 1):
                seen[raw[i - m:i]][raw[i]] += 1
    bits, raw = 0.0, b"\n" * order + text.encode()
    for i in range(order, len(raw)):
        for m in range(order, -1, -1):
            c = seen.get(raw[i - m:i])
            if not c:
                continue
            total, kinds = sum(c.values()), len(c)
            if raw[i] in c:
                bits -= math.log2(c[raw[i]] / (total + kinds))
                break
            bits -= math.log2(kinds / (total + kinds))
        else:
            bits += 8
    return bits


def test_code_lengths_equal_plain_ppm(spark):
    learnt = {"a": ["abra cadabra abra", "bar é"], "b": ["xyz zyx", "", "x\ny"]}
    model = langid.train(spark.createDataFrame([(k, t) for k, v in learnt.items() for t in v], "lang string, text string"))
    texts = ["abra", "zyx abc", "", "q\x00é漢", "a", "xyz zyx xyz abra"]
    raw = b"".join(t.encode() for t in texts)
    got = model.code_lengths(np.frombuffer(raw, np.uint8), np.array([len(t.encode()) for t in texts]))
    for row, t in zip(got, texts, strict=True):
        assert np.allclose(row, [plain_ppm(learnt[k], t, langid.ORDER) for k in model.languages])


def test_languages_of_held_out_documents(spark):
    got = {r.doc_id: r for r in QUERIES["op1_ppm_language"](spark, SF).collect()}
    docs = table(spark, SF, "documents").collect()
    assert len(got) == len(docs) and all(got[d.doc_id].held_out == (fold(d.doc_id, 4) == 2) for d in docs)
    held = [d for d in docs if got[d.doc_id].held_out]
    assert sum(got[d.doc_id].lang_pred == d.lang for d in held) >= 0.98 * len(held)


# ---- scoring -----------------------------------------------------------------------------------


def test_base_scores_and_held_out_gain(spark):
    docs = {d.doc_id: (d.text or "").encode().lower().split() for d in table(spark, SF, "documents").collect()}
    counts = Counter()
    for i, words in docs.items():
        if fold(i, 7) != 2:
            counts.update([*words, brown_lm.END])
    n, v = sum(counts.values()), len(counts)
    base = better = 0.0
    for r in QUERIES["op2_brown_classes"](spark, SF).collect():
        tokens = [*docs[r.doc_id], brown_lm.END]
        want = sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in tokens)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(tokens), sum(counts[t] > 0 for t in tokens), n)
        assert math.isclose(r.base_score, want, rel_tol=1e-9)
        if r.held_out:
            base, better = base + want, better + r.score
    assert better > base


def test_exchange_finds_word_classes():
    rng = random.Random(3)
    kinds = [list(range(0, 6)), list(range(6, 12)), list(range(12, 18))]
    table_ = np.zeros((20, 20))
    for _ in range(20000):  # classes follow each other in a ring
        k = rng.randrange(3)
        table_[rng.choice(kinds[k]), rng.choice(kinds[(k + 1) % 3])] += 1
    got = brown_lm.exchange(table_, np.arange(18) % 3, 3)
    assert [len(set(got[k])) for k in kinds] == [1, 1, 1] and len(set(got)) == 3


def test_class_step_gain_is_the_change_of_likelihood():
    rng = np.random.RandomState(0)
    words = rng.randint(0, 30, (7, 7)).astype(float)
    own = np.array([0, 1, 2, 0, 1, 2])

    def likelihood(classes):
        t = np.zeros((4, 4))
        np.add.at(t, (np.append(classes, 3)[:, None], np.append(classes, 3)[None, :]), words)
        h = brown_lm._h
        return h(t).sum() - h(t.sum(0)).sum() - h(t.sum(1)).sum()

    got = brown_lm.exchange(words, own, 3, rounds=1)
    plain = own.copy()
    for w in range(6):
        plain[w] = max(range(3), key=lambda c: (round(likelihood(np.where(np.arange(6) == w, c, plain)), 6), -c))
    assert math.isclose(likelihood(got), likelihood(plain), rel_tol=1e-9)


def test_every_training_word_has_the_class_of_its_contexts(spark, monkeypatch):
    rng = random.Random(4)
    monkeypatch.setattr(brown_lm, "SEEDS", 40)
    monkeypatch.setattr(brown_lm, "HELD", 500)
    common = [[f"{k}{i}" for i in range(20)] for k in "ab"]  # a word of one kind follows one of the other
    rare = [[f"{k}{i}same" for i in range(300)] for k in "rs"]  # all once and with one ending
    texts = []
    for i in range(300):
        row = [rng.choice(common[j % 2]) for j in range(40)]
        row[10], row[21] = rare[0][i], rare[1][i]
        texts.append((i, " ".join(row)))
    df = spark.createDataFrame(texts, "doc_id bigint, text string").repartition(3)
    vocabulary = brown_lm.count_words(df.select("text"))
    got = {bytes(r.word): (r.n, r["class"]) for r in brown_lm.train(df.select("text"), vocabulary).collect()}
    want = Counter(w for _, t in texts for w in t.encode().split())
    assert {w: n for w, (n, _) in got.items()} == want
    seeds = [w.encode() for w in common[0] + common[1]]
    of_seeds = [{got[w][1] for w in seeds if w.startswith(k)} for k in (b"a", b"b")]
    assert not of_seeds[0] & of_seeds[1]
    of_rare = [Counter(got[w.encode()][1] for w in words) for words in rare]
    assert not of_rare[0].keys() & of_rare[1].keys()  # by their contexts, not by their ending


def test_exchange_step_of_many_words_equals_that_of_one():
    rng = np.random.RandomState(3)
    table_ = rng.randint(0, 50, (6, 6)).astype(float)
    out, into = rng.randint(0, 4, (2, 40, 6)).astype(float)
    out[:, 5] += 1
    into[:, 5] += 1
    assert brown_lm.best_classes(table_, out, into, 4).tolist() == [brown_lm.best_class(table_, a, b, 0.0, 4) for a, b in zip(out, into, strict=True)]


# ---- decontamination ---------------------------------------------------------------------------


def test_proximity_matches(spark):
    docs = spark.createDataFrame([(1, "a lot of zebra here and also quagga words"), (2, "zebra then one two quagga"), (3, "quagga zebra")],
                                 "doc_id bigint, text string")
    items = spark.createDataFrame([(7, "zebra here and quagga")], "item_id bigint, text string")
    rare = {(r.item_id, r.length) for r in decontam.proximity_matches(docs, items, 1).collect()}
    assert decontam.phrase_matches(docs, items).count() == 0 and rare == {(7, 4)}
    assert decontam.proximity_matches(docs, items, 0).count() <= decontam.proximity_matches(docs, items, 3).count()


# ---- toxicity ----------------------------------------------------------------------------------


def test_toxicity_of_held_out_documents(spark):
    labels = {r.doc_id: r.toxic for r in table(spark, SF, "labels").collect()}
    rows = QUERIES["op5_nnpu_toxicity"](spark, SF).collect()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) and r.held_out == (fold(r.doc_id, 3) == 1) for r in rows)
    held = [(labels[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in labels]
    assert sum(p for y, p in held if y == 0) <= 0.02 * len(held)
    assert sum(p for y, p in held if y == 1) >= 0.6 * sum(y for y, _ in held)


def test_nonnegative_step_stays_bounded():
    rng = np.random.RandomState(1)
    x = rng.rand(300, 20).astype(np.float32)
    positive = np.arange(300) < 60
    x[positive, 0] += 1
    w, b = toxicity.nnpu_fit(np.vstack([x, x[:30]]), np.append(positive, np.zeros(30, bool)), 0.2)
    assert np.isfinite(w).all() and w[0] == max(w)


# ---- archives ----------------------------------------------------------------------------------


def test_both_arc_versions_round_trip():
    for version in (1, 2):
        raw = arc_warc.arc_block(version, "f.arc", "20200101000000") + b"\n"
        contents = [b"HTTP/1.1 200 OK\r\nX-Page-Id: 5\r\n\r\nbody\n\nhttp://x 1 2 text/html 9\n", b"", b"no head \x00\xff"]
        for c in contents:
            raw += arc_warc.arc_line(version, "http://a b/\n", "1.2.3.4", "20200102030405", "text/html", len(c), "f.arc") + c + b"\n"
        got = list(arc_warc.parse_arc(raw))
        assert [c for _, _, c in got] == contents and {v for v, _, _ in got} == {version}
        assert got[0][1]["URL"] == "http://a%20b/%0A" and arc_warc.iso_date("20200102030405") == "2020-01-02T03:04:05Z"


def test_wrong_lengths_are_errors():
    import pytest
    raw = arc_warc.arc_block(1, "f", "2020") + b"\n" + arc_warc.arc_line(1, "u", "i", "d", "t", 10, "f") + b"short"
    with pytest.raises(ValueError):
        list(arc_warc.parse_arc(raw))
    record = arc_warc.warc_record("resource", [("WARC-Record-ID", "<a>")], b"block") + b"\r\n\r\n"
    assert [b for _, b in arc_warc.parse_warc(record * 2)] == [b"block"] * 2
    with pytest.raises(ValueError):
        list(arc_warc.parse_warc(record.replace(b"block", b"clock")))


# ---- quality -----------------------------------------------------------------------------------


def plain_repeats(words, size=8):
    found = Counter(tuple(words[i:i + size]) for i in range(len(words) - size + 1))
    hit = set()
    for i in range(len(words) - size + 1):
        if found[tuple(words[i:i + size])] > 1:
            hit.update(range(i, i + size))
    return len(hit)


def test_measures_equal_plain_counts():
    rng = random.Random(5)
    z = zstandard.ZstdCompressor(level=compression_rules.LEVEL)
    for n in (0, 1, 7, 8, 9, 16, 40, 300):
        for kinds in (1, 2, 3, 50):
            text = "".join(rng.choice(["a", "bé", "#", "<x>"][:kinds] if kinds < 5 else [f"w{i}" for i in range(50)]) + rng.choice([" ", "\n", "\t", "  "])
                           for _ in range(n))
            words = text.encode().split()
            got = compression_rules.measure(text, z)
            lines = [x for x in text.split("\n") if x.strip(SPACES)]
            assert got[:5] == (len(words), sum(len(w.decode()) for w in words), sum(c in compression_rules.SYMBOLS for c in text),
                               sum(x in lines[:i] for i, x in enumerate(lines)), plain_repeats(words))
            assert got[5] == (len(words) < 20 or 100 * got[4] > 30 * len(words)) and not (got[5] and got[6])


def test_bands_reject_repeats_and_noise():
    z = zstandard.ZstdCompressor(level=compression_rules.LEVEL)
    rng = random.Random(9)
    vocabulary = ["".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(2, 9))) for _ in range(3000)]
    prose = " ".join(rng.choice(vocabulary) for _ in range(1500))
    noise = " ".join("".join(chr(rng.randint(33, 0x2FFF)) for _ in range(20)) for _ in range(300))
    assert compression_rules.measure(prose, z)[6]
    assert not compression_rules.measure(noise, z)[6]
    assert not compression_rules.measure("x" * 9000 + prose[:400], z)[6]


# ---- near duplicates ---------------------------------------------------------------------------


def plain_components(rows, n, percent):
    sets = {}
    for i, text in rows:
        w = (text or "").encode().lower().split()
        sets[i] = {tuple(w[k:k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in sets:
        for j in sets:
            if i < j and sets[i] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return {i: (len(sets[i]), root(i)) for i in sets}


def test_components_of_edited_copies(spark):
    rng = random.Random(2)
    words = [f"w{i}" for i in range(400)]
    rows, i = [], 0
    for group in range(4):  # copies with few to many edits of one text, so that links are few, many or in chains
        text = [rng.choice(words) for _ in range(60)]
        for _ in range(60):
            copy = list(text)
            for _ in range(rng.randint(0, 7)):
                copy[rng.randrange(60)] = rng.choice(words[:20])
            if group == 3:
                copy = copy[:rng.randint(40, 60)]
            rows.append((i, " ".join(copy)))
            i += 1
    rows += [(i, ""), (i + 1, None), (i + 2, "one"), (i + 3, "ONE"), (i + 4, rows[5][1].upper())]
    want = plain_components(rows, 2, 80)
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dup.find_components(df, shingle=2).collect()}
    assert got == want and len({c for _, c in want.values()}) > 8


def test_pruning_limits_are_beta_tails():
    for n, m in near_dup.least_matches(140, 28, 0.8, 1e-6):
        x = np.linspace(0, 1, 200001)[1:-1]
        for k, below in ((m - 1, True), (m, False)):
            d = np.exp(k * np.log(x) + (n - k) * np.log(1 - x))
            assert (d[x >= 0.8].sum() / d.sum() < 1e-6) == below


# ---- packing -----------------------------------------------------------------------------------


def test_hilbert_curve_visits_neighbours():
    cells = np.array([(a, b, c) for a in range(8) for b in range(8) for c in range(8)])
    keys = packing.hilbert_keys(cells, 3)
    path = cells[np.argsort(keys)]
    assert sorted(keys) == list(range(512)) and (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_pieces_rebuild_the_ids(spark):
    from tokenizers import Tokenizer
    coder = Tokenizer.from_file(token_file())
    docs = {d.doc_id: d.text or "" for d in table(spark, "/root/testdata/sf0.001", "documents").collect()}
    docs.update({-1: "", -2: "two  spaces\n\n and\ttabs 漢字 it's 12,5", -3: "<|pad|> x"})
    df = spark.createDataFrame([(k, v or None) for k, v in docs.items()], "doc_id bigint, text string")
    pieces, rows = defaultdict(list), defaultdict(list)
    for r in packing.pack(df, token_file(), seq_len=512).collect():
        ids = np.frombuffer(r.ids, "<u4")
        assert len(ids) == r.length and zlib.crc32(r.ids) == r.ids_crc32
        pieces[r.doc_id].append((r.start, list(ids), r.doc_tokens))
        rows[r.sequence_id].append((r.offset, r.length))
    for k, text in docs.items():
        want = [*coder.encode(text, add_special_tokens=False).ids, 1]
        assert [i for _, ids, _ in sorted(pieces[k]) for i in ids] == want and {n for *_, n in pieces[k]} == {len(want)}
    assert sorted(rows) == list(range(len(rows)))
    for s, parts in rows.items():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at == 512 or s == len(rows) - 1


def test_added_tokens_have_their_ids(spark, tmp_path):
    import json

    import pytest
    from tokenizers import Tokenizer
    coder = Tokenizer.from_file(token_file())
    texts = ["a<|endoftext|>b", "<|endoftext|>", " <|endoftext|> x  <|endoftext|><|endoftext|>\n", "<|endoftext|", "<<|endoftext|>>", "it's <|pad|>"]
    assert coder.encode(texts[0], add_special_tokens=False).ids == [64, 50256, 65]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: list(np.frombuffer(r.ids, "<u4")) for r in packing.pack(df, token_file(), seq_len=512).collect()}
    assert got == {i: [*coder.encode(t, add_special_tokens=False).ids, 1] for i, t in enumerate(texts)}
    with open(token_file(), encoding="utf-8") as f:
        file = json.load(f)
    file["added_tokens"].append({**file["added_tokens"][0], "id": 50257, "content": "<|endoftext|>x"})
    (tmp_path / "two.json").write_text(json.dumps(file))
    two = Tokenizer.from_file(f"{tmp_path}/two.json")
    for t in ("a<|endoftext|>xy", "<|endoftext|> x<|endoftext|>x"):  # one begins another: the longer one
        assert packing.Encoder(f"{tmp_path}/two.json").ids(t) == two.encode(t, add_special_tokens=False).ids
    file["added_tokens"][0]["lstrip"] = True
    (tmp_path / "strip.json").write_text(json.dumps(file))
    with pytest.raises(ValueError):
        packing.Encoder(f"{tmp_path}/strip.json")


def test_most_frequent_strings_of_each_language(spark):
    rows = [("a", g, 100 - g if g < 20 else 1) for g in range(2000)] + [("b", g, 1) for g in range(30)] + [("c", g, 2) for g in range(4000)]
    counts = spark.createDataFrame(rows, "lang string, gram long, n long")
    got = langid.most_frequent(counts, 1000).toPandas()
    assert got["lang"].value_counts()["b"] == 30  # fewer than asked for: all
    a = got[got["lang"] == "a"]
    assert set(range(20)) <= set(a["gram"])  # all that are more frequent than the ties
    for lang in ("a", "c"):  # only ties: a share of them
        assert 900 < (got["lang"] == lang).sum() < 1100


def test_toxicity_sample_is_bounded_with_a_repeated_id(spark):
    rows = [(1, f"text {i}") for i in range(3000)] + [(2, "same")] * 3000
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = toxicity.sampled_texts(df, df.where("doc_id = 2").select("doc_id"), 100, 500).collect()
    assert len(got) < 700 and sum(r.text == "same" for r in got) == 1


def test_toxicity_sample_is_not_made_smaller_by_repeats(spark):
    rows = [(i, f"text {i}") for i in range(3000)] + [(1, "same")] * 30000 + [(i, "copy") for i in range(30000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = toxicity.sampled_texts(df, df.where("doc_id = 1").select("doc_id"), 100, 500).collect()
    assert 400 < len(got) < 600 and len({r.text for r in got}) == len(got)
    assert {r.text for r in got if any(u.positive for u in r.uses)} == {"text 1", "same", "copy"}
