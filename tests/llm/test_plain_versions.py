"""The classifier's training and the whole pipeline against plain versions; long white space."""
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import xxhash

import corpus_pipeline
from ledgerline.llm import packing, site_lines, toxicity
from ledgerline.llm.queries import token_file

COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
TOXIC = ["vilegrok", "slurpish", "hatemonge", "nastiwump", "grubscum"]
CLEAN = [f"{a}{b}" for a in ("river", "paper", "stone", "light", "garden", "window") for b in ("", "s", "ing", "ed", "like")]


# ---- toxicity ----------------------------------------------------------------------------------


def texts_of(rng, n, toxic):
    out = []
    for _ in range(n):
        words = rng.choices(CLEAN, k=rng.randint(5, 60))
        for _ in range(rng.randint(2, 6) if toxic else 0):
            words.insert(rng.randrange(len(words)), rng.choice(TOXIC))
        out.append(" ".join(words).capitalize())
    return out


def plain_features(text):
    words = text.lower().encode().split()
    n = Counter()
    for w in words:
        w = w.strip(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")
        if w:
            n[w + b" "] += 1
            for k in (4, 5):
                if len(w) > k:
                    n[w[:k]] += 1
    return {f: math.sqrt(k / len(words)) for f, k in n.items()}


def plain_risk_gradient(w, x_p, x_u, prior):
    """Gradient of the corrected risk, one text at a time; below zero, of the clean part turned round."""
    def sig(z):
        return 1 / (1 + math.exp(-z))
    clean, g_clean, g_pos = 0.0, np.zeros(len(w)), np.zeros(len(w))
    for x in x_u:
        z = float(x @ w)
        clean += np.logaddexp(0, z) / len(x_u)
        g_clean += sig(z) * x / len(x_u)
    for x in x_p:
        z = float(x @ w)
        clean -= prior * np.logaddexp(0, z) / len(x_p)
        g_clean -= prior * sig(z) * x / len(x_p)
        g_pos += prior * (sig(z) - 1) * x / len(x_p)
    return g_pos + g_clean if clean >= 0 else -g_clean


def plain_training(rows, toxic_ids, prior, steps):
    """Models; with ``steps`` their fit is checked one text at a time."""
    texts = {t for _, t in rows}
    positives = sorted({t for i, t in rows if i in toxic_ids})
    models = []
    for part in range(toxicity.CLASSIFIERS):
        unlabelled = [t for t in texts if xxhash.xxh64_intdigest(t.encode(), 42) % 4 == part]  # 4 divides 2 ** 64: signs don't matter
        in_p, in_u = (Counter(f for t in ts for f in plain_features(t)) for ts in (positives, unlabelled))
        n_p, n_u = len(positives), len(unlabelled)

        def apart(f, in_p=in_p, in_u=in_u, n_p=n_p, n_u=n_u):
            m = (in_p[f] + in_u[f] + 1) / (n_p + n_u + 2)
            return (in_p[f] / n_p - in_u[f] / n_u) / math.sqrt(m * (1 - m) * (1 / n_p + 1 / n_u))
        chosen = sorted((f for f in in_p if in_p[f] >= 3 and apart(f) >= 3), key=lambda f: (-apart(f), f))[:toxicity.FEATURES]
        chosen.sort()

        def rows_of(ts, chosen=chosen):
            return [np.array([*(plain_features(t).get(f, 0.0) for f in chosen), 1.0]) for t in ts]
        x_p, x_u = rows_of(positives), rows_of(unlabelled)
        w = np.zeros(len(chosen) + 1)
        w[-1] = math.log(prior / (1 - prior))
        m, v = np.zeros(len(w)), np.zeros(len(w))
        for step in range(1, (steps or 0) + 1):
            g = plain_risk_gradient(w, x_p, x_u, prior)
            g[:-1] += 1e-6 * w[:-1]
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
            w -= 0.1 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
        # The library's own fit does the same with numbers of 64 bits, and the library sends it 32 bits, in the order of hashes.
        x = np.array([r[:-1] for r in [*x_p, *x_u]]).reshape(n_p + n_u, len(chosen))
        is_p = np.arange(n_p + n_u) < n_p
        own, bias = toxicity.nnpu_fit(x, is_p, prior, steps or toxicity.STEPS)
        assert not steps or np.abs(own - w[:-1]).max(initial=0) < 1e-4 and abs(bias - w[-1]) < 1e-4
        keys = np.array([xxhash.xxh64_intdigest(t.encode(), 42) for t in [*positives, *unlabelled]], np.uint64).astype(np.int64)
        order = np.lexsort((is_p, keys))
        own, bias = toxicity.nnpu_fit(x[order].astype(np.float32), is_p[order], prior, steps or toxicity.STEPS)
        models.append((dict(zip(chosen, own, strict=True)), bias))
    return models


def plain_score(models, text):
    z = np.mean([b + sum(w.get(f, 0.0) * v for f, v in plain_features(text or "").items()) for w, b in models])
    return 1 / (1 + math.exp(-z))


def test_training_equals_a_plain_version(spark):
    rng = random.Random(2)
    rows = list(enumerate([*texts_of(rng, 30, True), *texts_of(rng, 90, False)]))
    rows += [(500, rows[0][1]), (500, rows[0][1]), (501, rows[40][1])]
    labels = [(i, 0, int(i < 20)) for i in range(60)] + [(None, 1, 1), (7, 1, None)]
    docs = spark.createDataFrame([*rows, (600, None)], "doc_id bigint, text string").repartition(3)
    models = toxicity.train(docs, spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"), steps=40)
    want = plain_training(rows, set(range(20)), 20 / 60, 40)
    assert len(models) == len(want) == 4
    for (w, b), (v, c) in zip(models, want, strict=True):
        assert w.keys() == v.keys() and w
        assert abs(b - c) < 1e-3 and all(abs(w[f] - v[f]) < 1e-3 for f in w)
    got = {r.doc_id: r.score for r in toxicity.score(docs, models).collect()}
    for i, t in [*rows, (600, None)]:
        assert abs(got[i] - plain_score(want, t)) < 1e-3


# ---- packing -----------------------------------------------------------------------------------


def test_long_white_space_has_the_tokenizers_ids():
    from tokenizers import Tokenizer
    path = token_file()
    own, other = packing.encoder(path), Tokenizer.from_file(path)
    rng = random.Random(4)
    texts = [pre + c * n + post for c in (" ", "\n", "\t", "\r\n", "\xa0", "　", " \n", "\x1c") for n in (999, 1001, 2500)
             for pre, post in (("", ""), ("a", "x"), (" a\n", "\n\n"), ("1", "'s"), ("<|endoftext|>", "<|endoftext|>"))]
    texts += ["".join("".join(rng.choices(" \n\t\r\xa0", k=rng.choice((1, 3, 1200)))) + rng.choice(("x", "1 b", "é", ".")) for _ in range(6)) for _ in range(20)]
    texts += [" " * 1_000_000 + "x", "\n" * 1_000_000, "a" + "\t" * 1_000_000 + " b"]
    for t in texts:
        assert own.ids(t) == other.encode(t, add_special_tokens=False).ids, (t[:20], len(t))
    for c in " \n":
        assert len(own.ids(c * 10_000_000)) == len(own.ids(c * 1_000_000)) * 10


# ---- pipeline ----------------------------------------------------------------------------------


def words_of(text, pattern):
    return re.findall(pattern, (text or "").encode().lower().decode())


def plain_pipeline(rows, models, items):
    """Rows that reach packing, by the rules of each stage."""
    rows = [list(r) for r in rows if plain_score(models, r[1]) < toxicity.THRESHOLD]
    total, pages = Counter(r[3] for r in rows), Counter()
    held = {(r[3], line, r[0]) for r in rows if r[1] is not None and r[3] is not None for line in r[1].split("\n") if line.strip(" \t\n\x0b\x0c\r")}
    pages.update((s, line) for s, line, _ in held)
    bad = {k for k, n in pages.items() if n >= site_lines.LEAST_PAGES and n > total[k[0]] * site_lines.RATIO}
    for r in rows:
        if r[1] is not None:
            lines = r[1].split("\n")
            kept = [x for x in lines if (r[3], x) not in bad]
            if len(kept) < len(lines):
                r[1] = "\n".join(kept)
                r[4] = len(r[1])
    sets = []
    for r in rows:
        w = words_of(r[1], r"[^\x20\x09-\x0D]+")
        sets.append({tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    group = list(range(len(rows)))

    def find(i):
        while group[i] != i:
            i = group[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                group[find(i)] = find(j)
    least = {}
    for i, r in enumerate(rows):
        least[find(i)] = min(least.get(find(i), r[0]), r[0])
    rows = [r for i, r in enumerate(rows) if least[find(i)] == r[0]]
    windows = set()
    for t in items:
        w = words_of(t, r"[a-z0-9\x80-\U0010ffff]+")
        windows |= {tuple(w[i:i + 10]) for i in range(max(1, len(w) - 9))} if w else set()
    out = []
    for r in rows:
        w = words_of(r[1], r"[a-z0-9\x80-\U0010ffff]+")
        if not any(tuple(w[i:i + n]) in windows for n in {len(x) for x in windows} for i in range(len(w) - n + 1)):
            out.append(tuple(r))
    return out


def test_pipeline_equals_plain_stages(spark, tmp_path):
    from tokenizers import Tokenizer
    rng = random.Random(6)
    bodies = [*texts_of(rng, 25, True), *texts_of(rng, 60, False)]
    item = "the quick answer of the benchmark is that seven brown foxes jump over lazy dogs"
    rows = []
    for i, t in enumerate(bodies):
        rows.append((i, t + (f"\nown line {i}\nfooter of this site" if i % 2 else ""), "en", f"s{i % 3}", len(t)))
    long = " ".join(rng.choices(CLEAN, k=200))
    rows += [(100, long, "en", "s0", 1), (101, long + " tail", "en", "s1", 1), (102, long.upper(), "de", "s2", 1), (103, None, None, None, None), (104, "", "en", "s0", 0),
             (105, "start " + item + " end", "en", "s1", 1), (106, item.upper(), "en", "s1", 1), (107, "short item", "en", "s1", 1), (108, " " * 5000 + "x", "en", "s1", 1)]
    docs = spark.createDataFrame(rows, COLUMNS).repartition(4)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(i, 0, int(i < 20)) for i in range(70)]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    items = [item, "short item", None, ""]
    spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    models = plain_training([(r[0], r[1]) for r in rows if r[1] is not None], set(range(20)), 20 / 70, None)
    want = {r[0]: r for r in plain_pipeline(rows, models, items)}
    assert 30 < len(want) < 75 and not {101, 102, 105, 106, 107} & want.keys() and {100, 103, 104, 108} <= want.keys()
    pieces = corpus_pipeline.run(spark, str(tmp_path)).collect()
    coder = Tokenizer.from_file(token_file())
    got = {}
    for p in sorted(pieces, key=lambda p: (p.doc_id, p.start)):
        got.setdefault(p.doc_id, []).extend(np.frombuffer(p.ids, "<u4").tolist())
        assert zlib.crc32(p.ids) == p.ids_crc32
    assert got == {i: [*coder.encode(r[1] or "", add_special_tokens=False).ids, 1] for i, r in want.items()}
    places = sorted((p.sequence_id, p.offset, p.length) for p in pieces)
    assert all((a[0] * 2048 + a[1] + a[2]) == b[0] * 2048 + b[1] for a, b in zip(places, places[1:], strict=False)) and places[0][:2] == (0, 0)
